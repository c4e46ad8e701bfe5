"""Command line: the jobs and the catalog work around them, one command each.

The session's catalog, file systems, endpoints and credentials come from Spark's own configuration.
"""

from __future__ import annotations

import argparse
import sys
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

import moraine as m
from moraine import presets
from moraine.catalog.tables import WRITE_TASK_BYTES
from moraine.settings import PARQUET_SETTINGS, scoped_settings


def schema_of(text: str) -> T.StructType:
    """``trips`` for the trip-record schema, else column definitions as in CREATE TABLE."""
    if text == "trips":
        return presets.TRIP_SCHEMA
    return T.StructType.fromDDL(text)


def types_of(text: str) -> dict[str, str]:
    """``name=type,name=type``, or ``trips`` for the types of the trip-record preview."""
    if text == "trips":
        return dict(presets.TRIP_PREVIEW_TYPES)
    return dict(part.split("=", 1) for part in text.split(",") if part)


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="moraine", description=__doc__)
    parser.add_argument(
        "--rows", type=int, help="print so many rows (default: 20 of data, all of anything else)"
    )
    parser.add_argument("--total", action="store_true", help="also count all rows of what is printed")
    commands = parser.add_subparsers(dest="command", required=True)

    def command(name: str, help: str, *arguments: str) -> argparse.ArgumentParser:
        added = commands.add_parser(name, help=help)
        for argument in arguments:
            added.add_argument(argument)
        return added

    def dated(added: argparse.ArgumentParser, nulls: str | None) -> argparse.ArgumentParser:
        added.add_argument("--time-column", default=presets.TRIP_TIME_COLUMN)
        added.add_argument("--date-column", default=presets.TRIP_DATE_COLUMN)
        if nulls:
            added.add_argument("--zone", default="UTC")
            added.add_argument("--null-dates", choices=["drop", "keep"], default=nulls)
        return added

    ingest = command("ingest", "raw files to a partitioned table", "folder", "table", "location")
    dated(ingest, "drop")
    ingest.add_argument("--pattern", default=presets.TRIP_FILE_PATTERN)
    ingest.add_argument("--schema", default="trips")
    ingest.add_argument("--partition-by", help="columns separated by commas")
    ingest.add_argument("--date-type", choices=["date", "string"], default="date")
    ingest.add_argument("--recursive", action="store_true")
    backfill = command("backfill", "files to a declared table, then rows per day", "glob", "table")
    dated(backfill, "keep")
    for job, default in ((ingest, "quarantine"), (backfill, "raise")):
        job.add_argument("--on-reject", choices=["quarantine", "raise"], default=default)
        job.add_argument("--no-cluster", dest="cluster", action="store_false")
        job.add_argument("--task-bytes", default=WRITE_TASK_BYTES)
        job.add_argument("--replace-despite-rejects", action="store_true")
    ingest.add_argument("--rejects", metavar="PATH", help="also write the files left out, as CSV")
    declare = command("declare", "declare a table like the files", "glob", "table", "location")
    dated(declare, None)
    declare.add_argument("--date-type", choices=["date", "string"], default="date")
    preview = command("preview", "one file with date parts and narrow types", "uri")
    dated(preview, None)
    preview.add_argument("--types", default="trips")
    preview.add_argument("--zone", default="UTC")
    preview.add_argument("--write", metavar="PATH", help="also write by year, month and day")
    preview.add_argument("--save", metavar="TABLE", help="also save as a table by year, month, day")
    command("sales", "the sample sales rows as a table", "table", "location")
    counts = command("counts", "rows per day of a table", "table")
    counts.add_argument("--date-column", default=presets.TRIP_DATE_COLUMN)
    command("sql", "run one SQL statement", "text")
    tables = command("tables", "list tables")
    tables.add_argument("--database")
    command("partitions", "list partitions", "table")
    command("describe", "columns and details of a table", "table")
    repair = command("repair", "register partition folders", "table")
    repair.add_argument("--drop-missing", action="store_true")
    command("drop", "remove an external table, keep its files", "table")
    return parser


_PARTS = ["year", "month", "day"]


# Commands whose rows are data, not the catalog's or a job's own: by default the first are shown.
_DATA = {"preview", "sql", "sales"}
SHOWN_ROWS = 20
REJECTED = 3  # exit code of a job that left files out


@dataclass
class Outcome:
    """The frames there are to show, how many rows of each, whether to count all, the exit code."""

    frames: list[DataFrame]
    rows: int | None = None
    code: int = 0
    total: bool = False


def run(spark: SparkSession, argv: Sequence[str]) -> list[DataFrame]:
    """Do one command in the caller's session; returns the frames there are to show."""
    return do(spark, argv).frames


def do(spark: SparkSession, argv: Sequence[str]) -> Outcome:
    """Do one command in the caller's session."""
    args = vars(_parser().parse_args(argv))
    name, rows, total = args.pop("command"), args.pop("rows"), args.pop("total")
    if rows is None and name in _DATA:
        rows = SHOWN_ROWS
    if name == "ingest":
        kept = args.pop("rejects")
        with scoped_settings(spark, PARQUET_SETTINGS):
            args["schema"] = schema_of(args["schema"])
            if args["partition_by"]:
                args["partition_by"] = args["partition_by"].split(",")
            result = m.ingest(spark, **args)
            if kept:
                result.rejects.coalesce(1).write.mode("overwrite").csv(kept, header=True)
        code = REJECTED if result.rejected else 0
        return Outcome([result.partitions, result.rejects], rows, code, total)
    return Outcome(_frames(spark, name, args), rows, total=total)


def _frames(spark: SparkSession, name: str, args: dict) -> list[DataFrame]:
    with scoped_settings(spark, PARQUET_SETTINGS):
        if name == "backfill":
            return [m.backfill(spark, **args)]
        if name == "declare":
            m.declare_table(spark, **args)
            return [m.describe_table(spark, args["table"])]
        if name == "preview":
            path, table = args.pop("write"), args.pop("save")
            df = m.typed_preview(spark, **{**args, "types": types_of(args["types"])})
            if path:
                m.write_partitions(df, path, _PARTS)
            if table:
                m.save_managed_table(df, table, _PARTS)
            return [df]
        if name == "sales":
            rows, schema = presets.SALES_ROWS, presets.SALES_SCHEMA
            return [m.save_rows(spark, rows, schema, args["table"], args["location"])]
        if name == "counts":
            return [m.daily_counts_sql(spark, args["table"], args["date_column"])]
        if name == "sql":
            return [spark.sql(args["text"])]
        if name == "tables":
            return [m.show_tables(spark, args["database"])]
        if name == "partitions":
            return [m.show_partitions(spark, args["table"])]
        if name == "describe":
            return [m.describe_table(spark, args["table"], extended=True)]
        if name == "repair":
            m.repair_partitions(spark, args["table"], args["drop_missing"])
            return [m.show_partitions(spark, args["table"])]
        location = m.drop_external_table(spark, args["table"])
        return [spark.createDataFrame([(location,)], "location string")]


def show(df: DataFrame, rows: int | None, total: bool = False) -> None:
    """Print the frame, all of it or its first rows; how many there are in all only on request.

    For the first rows no more than these and one more are computed, by which Spark tells that there
    are others.
    """
    if rows is None:
        rows = max(df.count(), 1)  # the catalog, rejects and counts of days
    df.show(rows, truncate=False)
    if total:
        print(f"{df.count()} rows in all")


def main(argv: Sequence[str] | None = None) -> None:
    _parser().parse_args(argv)  # wrong arguments end the program before a session is built
    spark = SparkSession.builder.appName("moraine").enableHiveSupport().getOrCreate()
    try:
        outcome = do(spark, argv)
        for df in outcome.frames:
            show(df, outcome.rows, outcome.total)
    finally:
        spark.stop()
    if outcome.code:
        sys.exit(outcome.code)
