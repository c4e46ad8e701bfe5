"""A landing folder of flat monthly files, written without Spark so that names can be exact."""

import os

import duckdb

SF_DIR = "/root/testdata/sf0.001"
PATTERN = r"orders_\d{4}-\d{2}\.parquet$"

_MONTHS = {
    "1995-01": "*",
    "1995-02": "o_orderkey, o_custkey::DOUBLE AS o_custkey, o_orderstatus, o_totalprice, o_orderdate",
    "1995-03": """o_orderpriority, o_orderdate, o_totalprice AS "O_TotalPrice", 1 AS extra_col,
                  o_orderstatus, o_custkey::INTEGER AS o_custkey, o_orderkey""",
    "1995-04": "*",
}


def write_drift_folder(folder):
    """Four readable months in three sets of types, an unreadable month, and three other names."""
    os.makedirs(folder, exist_ok=True)
    connection = duckdb.connect()
    for month, columns in _MONTHS.items():
        connection.execute(
            f"""COPY (SELECT {columns} FROM '{SF_DIR}/orders.parquet'
                      WHERE strftime(o_orderdate, '%Y-%m') = '{month}')
                TO '{folder}/orders_{month}.parquet' (FORMAT parquet)"""
        )
    for name in (
        "orders_1995-05.parquet",
        "orders_1995-6.parquet",
        "returns_1995-01.parquet",
        "orders_1995-01.parquet.bak",
    ):
        with open(os.path.join(folder, name), "w") as file:
            file.write("not parquet")


def expected_orders():
    return (
        duckdb.connect()
        .execute(
            f"""SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
                       CASE WHEN strftime(o_orderdate, '%Y-%m') = '1995-02' THEN NULL
                            ELSE o_orderpriority END
                FROM '{SF_DIR}/orders.parquet'
                WHERE o_orderdate >= '1995-01-01' AND o_orderdate < '1995-05-01'
                ORDER BY o_orderkey, o_orderdate"""
        )
        .fetchall()
    )
