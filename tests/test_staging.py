"""Data the queries start from."""

import datetime as dt
import glob

from workload.staging import lake


def source(spark, folder):
    """Three years of made-up rows, some without a time and some twice."""
    days = [dt.datetime(2021, 1, 1) + dt.timedelta(days=11 * i) for i in range(100)]
    rows = [(i, None if i % 20 == 7 else day) for i, day in enumerate(days)]
    for name, key, time in (
        ("events", "event_id", "ts"),
        ("orders", "o_orderkey", "o_orderdate"),
        ("lineitem", "l_orderkey", "l_shipdate"),
    ):
        df = spark.createDataFrame(rows + rows[:30], f"{key} bigint, {time} timestamp_ntz")
        df.coalesce(1).write.parquet(f"{folder}/{name}.parquet")
    return rows + rows[:30]


def test_the_lake_is_whole_and_brought_together_without_a_sort(spark, tmp_path, monkeypatch):
    rows = source(spark, str(tmp_path))
    frame, hinted = type(spark.range(0)), []
    real = frame.hint
    monkeypatch.setattr(
        frame, "hint", lambda self, name, *args: hinted.append((name, args[0])) or real(self, name, *args)
    )
    made = lake(spark, str(tmp_path))
    most = int(spark.sparkContext.getConf().get("spark.shuffle.sort.bypassMergeThreshold", "200"))
    assert [name for name, _ in hinted] == ["rebalance"] * 3
    assert all(0 < partitions <= most for _, partitions in hinted)

    counts = spark.table(f"{made.database}.events").groupBy("pickup_date").count()
    by_day = {tuple(row) for row in counts.collect()}
    days = [time and time.date() for _, time in rows]
    assert by_day == {(day, days.count(day)) for day in days}
    months = {time and (time.year, time.month) for _, time in rows}
    for name, partitions in (("events", set(days)), ("orders", months), ("lineitem", months)):
        assert spark.table(f"{made.database}.{name}").count() == len(rows)
        files = glob.glob(f"{made.folder}/files-{name}/**/*.parquet", recursive=True)
        assert len(files) == len(partitions)
