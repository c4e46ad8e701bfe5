"""Expressions and projections: dates, zones, casts, names."""

import datetime as dt

import pytest
from hypothesis import given, settings as hypothesis_settings, strategies as st
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql import types as T

import moraine as m
from moraine.functions.names import by_lower_name, column
from moraine.functions.zones import instant_of, wall_clock_of
from tests.plans import plan_of

NTZ = T.TimestampNTZType()


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def test_safe_date_of_text(spark):
    rows = [("2020-01-05",), ("2020-13-45",), ("2020-02-30",), ("junk",), (None,)]
    df = frame(spark, rows, "s string")
    parsed = df.select(m.safe_date(F.col("s"), T.StringType(), "yyyy-MM-dd").alias("d")).collect()
    assert [r.d for r in parsed] == [dt.date(2020, 1, 5), None, None, None, None]
    without_format = df.select(m.safe_date(F.col("s"), T.StringType()).alias("d")).collect()
    assert without_format == parsed


def test_iso_short_cut_reads_the_same_dates_as_the_format(spark):
    texts = [
        "0000-01-01", "0001-01-01", "9999-12-31", "12345-01-01", "+12345-01-01", "2020-1-5",
        " 2020-01-05", "2020-01-05 ", "2020-01-05x", "2020-01-05T10:00:00", "-2020-01-05", "2020",
        "2020-02-29", "2021-02-29", "1582-10-10", "\u0662020-01-05", "2020-01-05\n", "", None,
    ]
    df = frame(spark, [(t,) for t in texts], "s string")
    by_format = F.try_to_date("s", "yyyy-MM-dd").cast("string")
    ours = m.safe_date(F.col("s"), T.StringType(), "yyyy-MM-dd").cast("string")
    for row in df.select("s", by_format.alias("expected"), ours.alias("got")).collect():
        assert row.got == row.expected, row.s


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_safe_date_does_not_depend_on_ansi(spark, settings, ansi):
    settings("spark.sql.ansi.enabled", ansi)
    df = frame(spark, [("x",), ("2020-01-05",)], "s string")
    got = df.select(m.safe_date(F.col("s"), T.StringType(), "yyyy-MM-dd").alias("d")).collect()
    assert [r.d for r in got] == [None, dt.date(2020, 1, 5)]


def test_safe_date_of_timestamp_ignores_format(spark):
    df = frame(spark, [(dt.datetime(2020, 1, 5, 23, 59),)], "t timestamp_ntz")
    assert df.select(m.safe_date(F.col("t"), NTZ, "dd/MM/yyyy")).first()[0] == dt.date(2020, 1, 5)


def test_null_dates_dropped_or_kept(spark):
    rows = [(1, dt.datetime(2024, 3, 9, 1)), (-1, None)]
    df = frame(spark, rows, "id int, ts timestamp_ntz")
    dropped = m.derive_date_columns(df, "ts").collect()
    assert [r.id for r in dropped] == [1]
    assert dropped[0][2:] == (dt.date(2024, 3, 9), "2024", "03", "09")
    kept = m.derive_date_columns(df, "TS", null_dates="keep").orderBy("id").collect()
    assert kept[0][2:] == (None, None, None, None)
    with pytest.raises(ValueError):
        m.derive_date_columns(df, "ts", null_dates="ignore")


def test_time_column_is_never_guessed(spark):
    with pytest.raises(ValueError, match="pickup_time"):
        m.derive_date_columns(frame(spark, [(1,)], "id int"), "pickup_time")


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_narrowing_casts_give_null_not_wrong_numbers(spark, settings, ansi):
    settings("spark.sql.ansi.enabled", ansi)
    df = frame(
        spark, [(3e10, 1), (float("nan"), 30000000000), (1.9, 2)], "a double, B bigint"
    )
    got = m.cast_columns(df, {"A": "int", "b": "int"})
    assert got.columns == ["a", "B"]
    assert [tuple(r) for r in got.collect()] == [(None, 1), (None, None), (1, 2)]


EDGES = sorted(
    {float(s * (2**b) + d) for b in (7, 15, 31, 63) for s in (-1, 1) for d in (-1.5, -1, -0.5, 0, 0.5, 1)}
    | {0.0, -0.9, 0.9, 1e300, -1e300, float("inf"), float("-inf")}
)
INTEGERS = {"tinyint": 8, "smallint": 16, "int": 32, "bigint": 64}


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_casts_of_fractions_at_the_edges(spark, settings, ansi):
    settings("spark.sql.ansi.enabled", ansi)
    df = frame(spark, [(v, v) for v in [*EDGES, float("nan"), None]], "v double, n double")
    for kind, bits in INTEGERS.items():
        for row in m.cast_columns(df, {"n": kind}).collect():
            cut = None if row.v is None or row.v != row.v or abs(row.v) == float("inf") else int(row.v)
            fits = cut is not None and -(2 ** (bits - 1)) <= cut < 2 ** (bits - 1)
            assert row.n == (cut if fits else None), (kind, row.v)


@hypothesis_settings(max_examples=10, deadline=None)
@given(st.lists(st.integers(-(2**63), 2**63 - 1) | st.integers(-(2**31) - 2, 2**31 + 2), min_size=1))
def test_casts_of_integers(spark, values):
    df = spark.createDataFrame([(v, v) for v in values], "v bigint, n bigint")
    for kind, bits in INTEGERS.items():
        for row in m.cast_columns(df, {"n": kind}).collect():
            assert row.n == (row.v if -(2 ** (bits - 1)) <= row.v < 2 ** (bits - 1) else None)


@hypothesis_settings(max_examples=10, deadline=None)
@given(st.lists(st.floats(width=32) | st.none(), min_size=1))
def test_casts_agree_with_try_cast(spark, values):
    df = spark.createDataFrame([(v, v) for v in values], "v float, n float")
    for kind in ("tinyint", "smallint", "int"):
        got = m.cast_columns(df, {"n": kind}).select("n", F.col("v").try_cast(kind).alias("expected"))
        assert all(row.n == row.expected for row in got.collect())


@hypothesis_settings(max_examples=10, deadline=None)
@given(st.lists(st.text(alphabet="0123456789.+- ex", max_size=6) | st.integers().map(str), min_size=1))
def test_text_to_integers_is_the_lenient_cast(spark, values):
    values = [v for v in values if v.strip(" +-")[:1] != "."] + ["1.9", "-7.", " 5 ", "x", "1.x", None]
    df = spark.createDataFrame([(v, v) for v in values], "v string, n string")
    mode = spark.conf.get("spark.sql.ansi.enabled")
    try:
        spark.conf.set("spark.sql.ansi.enabled", "false")
        expected = [r.n for r in df.select(F.col("v").cast("int").alias("n")).collect()]
    finally:
        spark.conf.set("spark.sql.ansi.enabled", mode)
    assert [r.n for r in m.cast_columns(df, {"n": "int"}).collect()] == expected


def test_widening_is_a_plain_cast_and_narrowing_raises_nothing(spark):
    df = spark.range(1).selectExpr("cast(id as int) as i", "id as l", "cast(id as double) as d")
    plan = plan_of(m.cast_columns(df, {"i": "bigint", "l": "int", "d": "int"}), "simple")
    assert "try_cast" not in plan.lower()


def test_date_column_may_not_be_in_the_schema_already(spark):
    schema = T.StructType([T.StructField("ts", NTZ), T.StructField("Day", T.DateType())])
    df = frame(spark, [(None, None)], schema)
    with pytest.raises(ValueError, match="already has"):
        m.conform_to_schema(df, schema, event_date=("ts", "day"))


def test_cast_of_unknown_column_raises(spark):
    with pytest.raises(ValueError, match="nope"):
        m.cast_columns(frame(spark, [(1,)], "a int"), {"nope": "int"})


def test_dst_gap_date_is_taken_before_the_cast(spark, settings):
    settings("spark.sql.session.timeZone", "America/New_York")
    df = frame(spark, [(dt.datetime(2021, 3, 14, 2, 30),)], "ts timestamp_ntz")
    instants = m.normalize_ntz(df, "America/New_York")
    assert instants.schema["ts"].dataType == T.TimestampType()
    # 02:30 does not exist on that day; the clock shows 03:30, which is 07:30 UTC.
    assert instants.select(F.unix_micros("ts")).first()[0] == 1615707000000000
    conformed = m.conform_to_schema(
        df,
        T.StructType([T.StructField("ts", T.TimestampType())]),
        "America/New_York",
        event_date=("ts", "day"),
    )
    assert conformed.select("day").first()[0] == dt.date(2021, 3, 14)


@pytest.mark.parametrize("session", ["UTC", "America/New_York", "Asia/Kolkata"])
@pytest.mark.parametrize("zone", ["UTC", "Etc/UTC", "Asia/Tokyo", "America/New_York"])
def test_zone_of_the_source_decides_not_the_session(spark, settings, session, zone):
    from zoneinfo import ZoneInfo

    settings("spark.sql.session.timeZone", session)
    clocks = [
        dt.datetime(2024, 7, 1, 23, 30, 0, 123456),
        dt.datetime(2024, 11, 3, 1, 30),
        dt.datetime(1969, 12, 31, 12, 0),
        dt.datetime(2024, 11, 3, 6, 15),
    ]
    df = frame(spark, [(i, c) for i, c in enumerate(clocks)], "i int, ts timestamp_ntz")
    epoch = dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)
    instant = instant_of(F.col("ts"), zone, session)
    got = df.select("i", F.unix_micros(instant).alias("us"), wall_clock_of(instant, zone, session).alias("back"))
    for row in got.collect():
        at = clocks[row.i].replace(tzinfo=ZoneInfo(zone))
        assert row.us == (at - epoch) // dt.timedelta(microseconds=1)
        assert row.back == clocks[row.i]


@pytest.mark.parametrize("session", ["UTC", "America/New_York"])
def test_texts_and_dates_become_instants_in_the_zone(spark, settings, session):
    settings("spark.sql.session.timeZone", session)
    schema = T.StructType([T.StructField("t", T.TimestampType())])
    texts = {
        "2024-07-01 09:00:00": 1719792000,
        "2024-07-01T09:00:00.5": 1719792000,
        "2024-07-01 09:00:00+02:00": 1719817200,
        "2024-07-01T09:00:00Z": 1719824400,
        "2024-07-01": 1719759600,
        "2024-07-01 09:00": 1719792000,
        "junk": None,
    }
    df = frame(spark, [(t,) for t in texts], "t string")
    got = m.conform_to_schema(df, schema, "Asia/Tokyo").select(F.unix_seconds("t")).collect()
    assert [r[0] for r in got] == list(texts.values())
    days = frame(spark, [(dt.date(2024, 7, 1),)], "t date")
    assert m.conform_to_schema(days, schema, "Asia/Tokyo").select(F.unix_seconds("t")).first()[0] == 1719759600


def test_conform_fills_drops_orders_and_casts(spark):
    df = frame(spark, [("7", 1.5, True)], "Fee string, amount double, extra boolean")
    wanted = T.StructType(
        [
            T.StructField("amount", T.LongType()),
            T.StructField("missing", T.DoubleType()),
            T.StructField("fee", T.LongType()),
        ]
    )
    got = m.conform_to_schema(df, wanted)
    assert got.dtypes == [("amount", "bigint"), ("missing", "double"), ("fee", "bigint")]
    assert tuple(got.first()) == (1, None, 7)


def test_conform_keeps_data_of_a_column_spelled_otherwise(spark):
    df = frame(spark, [(2.5,)], "Airport_fee double")
    wanted = T.StructType([T.StructField("airport_fee", T.DoubleType())])
    assert m.conform_to_schema(df, wanted).first().airport_fee == 2.5


def test_names_that_differ_only_in_case_raise(spark, settings):
    settings("spark.sql.caseSensitive", "true")
    df = frame(spark, [(1, 2)], "fee int, Fee int")
    for operator in (
        lambda: m.conform_to_schema(df, T.StructType([T.StructField("fee", T.LongType())])),
        lambda: m.cast_columns(df, {"fee": "bigint"}),
        lambda: m.align_to_columns(df, ["fee"]),
    ):
        with pytest.raises(ValueError, match="differ only in case"):
            operator()


def test_conform_is_one_projection(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    wanted = T.StructType([T.StructField(n, T.DoubleType()) for n in ("l_tax", "l_quantity", "x")])
    plan = plan_of(m.conform_to_schema(df, wanted))
    assert "ReadSchema: struct<l_quantity:double,l_tax:double>" in plan
    assert plan.count("Project") <= 2 and "Python" not in plan


def test_awkward_names(spark):
    df = spark.range(1).select(F.lit(1).alias("a.b"), F.lit(2).alias("c `d"))
    wanted = T.StructType([T.StructField("c `d", T.LongType()), T.StructField("A.B", T.LongType())])
    assert tuple(m.conform_to_schema(df, wanted).first()) == (2, 1)
    assert tuple(m.align_to_columns(df, ["C `D", "a.b"]).first()) == (2, 1)
    assert df.select(column("a.b")).first()[0] == 1


def test_align_raises_on_a_missing_column(spark):
    df = frame(spark, [(1, 2)], "a int, B int")
    assert m.align_to_columns(df, ["b", "A"]).columns == ["b", "A"]
    with pytest.raises(ValueError, match="c"):
        m.align_to_columns(df, ["a", "c"])


def test_union_keeps_duplicates_and_raises_on_missing_names(spark):
    a, b = frame(spark, [(1, "x")], "n int, s string"), frame(spark, [("x", 1)], "s string, n int")
    assert [tuple(r) for r in m.union_by_name([a, b]).collect()] == [(1, "x"), (1, "x")]
    with pytest.raises(AnalysisException):
        m.union_by_name([a, b.drop("s")]).collect()
    with pytest.raises(ValueError):
        m.union_by_name([])
    assert m.union_by_name([], empty=a) is a


def test_partition_equals_takes_text_and_dates(spark):
    day = dt.date(2024, 1, 5)
    df = frame(spark, [(day, "2024-01-05"), (dt.date(2024, 1, 6), "2024-01-06")], "d date, s string")
    for name in ("d", "s"):
        assert m.partition_equals(df, name, "2024-01-05").count() == 1
        assert m.partition_equals(df, name, day).count() == 1
    with pytest.raises(ValueError):
        m.partition_equals(df, "d", "5 January")


def test_daily_counts_puts_null_first(spark):
    df = frame(spark, [(None,), (dt.date(2024, 1, 2),), (dt.date(2024, 1, 1),), (None,)], "d date")
    got = [tuple(r) for r in m.daily_counts(df, "D", "n").collect()]
    assert got == [(None, 2), (dt.date(2024, 1, 1), 1), (dt.date(2024, 1, 2), 1)]


@hypothesis_settings(max_examples=15, deadline=None)
@given(st.lists(st.one_of(st.none(), st.dates(dt.date(1, 1, 1), dt.date(9999, 12, 31))), min_size=1))
def test_both_ways_to_date_parts_agree(spark, days):
    df = spark.createDataFrame([(d,) for d in days], "d date")
    by_text = df.select(*[c.alias(n) for n, c in m.date_parts_by_substring(F.col("d")).items()])
    by_field = df.select(
        F.lpad(F.year("d").cast("string"), 4, "0").alias("year"),
        *[c.alias(n) for n, c in m.date_parts(F.col("d")).items() if n != "year"],
    )
    expected = [
        (f"{d.year:04}", f"{d.month:02}", f"{d.day:02}") if d else (None, None, None) for d in days
    ]
    assert [tuple(r) for r in by_text.collect()] == expected
    assert [tuple(r) for r in by_field.collect()] == expected


@given(st.lists(st.text(alphabet="aAbB", min_size=1, max_size=3)))
def test_by_lower_name_finds_every_clash(names):
    if len({n.lower() for n in names}) == len(names):
        assert list(by_lower_name(names).values()) == names
    else:
        with pytest.raises(ValueError):
            by_lower_name(names)


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz", "date", "string"])
def test_a_day_of_a_column_of_times(spark, kind):
    texts = ["2024-01-04 23:59:59", "2024-01-05 00:00:00", "2024-01-05 23:59:59.999", "2024-01-06 00:00:00", None]
    source = "left(t, 10)" if kind == "string" else f"cast(t as {kind})"
    df = spark.createDataFrame([(t,) for t in texts], "t string").selectExpr(f"{source} as t")
    assert m.partition_equals(df, "t", "2024-01-05").count() == 2
