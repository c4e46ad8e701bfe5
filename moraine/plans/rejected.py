"""What a run may replace while files are missing from it, told from footers as far as they tell."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from moraine.catalog.tables import (
    IncompletePartitions,
    partition_values,
    refuse_to_replace,
)
from moraine.functions.dates import local_date
from moraine.functions.zones import session_zone
from moraine.sources.conformed import ConformedFiles
from moraine.sources.footers import read_footers, readable_by_tasks, resolved

_STATED = (T.DateType, T.TimestampType, T.TimestampNTZType)


@dataclass(frozen=True)
class Days:
    """Days a row group's event times span. Both ends have rows; days between them may have."""

    first: dt.date
    last: dt.date


@dataclass
class Touched:
    spans: list[Days]
    undated: bool  # there are rows without a time


def touched_days(
    spark: SparkSession, files: ConformedFiles, time_column: str, zone: str = "UTC"
) -> Touched | None:
    """The days of the event times in the files, by the statistics of their row groups.

    None where these do not tell: a file states none, its times are text or numbers, or only the
    JVM can open it. A row for each distinct span comes to the driver, no more than row groups.
    """
    session, frames, undated = session_zone(spark), [], False
    for group in files.groups:
        field = group.fields.get(time_column.lower())
        if field is None:
            undated = True  # a column the files lack is NULL in all rows
            continue
        if not isinstance(field.dataType, _STATED):
            return None
        if not readable_by_tasks(list(resolved(spark, group.paths).values())):
            return None
        # A file of the group that lacks the column has no row there: its rows have no time.
        stated = read_footers(spark, group.paths, [field.name])
        undated = undated or stated.select("path").distinct().count() < len(set(group.paths))
        ends = [
            local_date(F.col(name).try_cast(field.dataType), field.dataType, zone, session)
            for name in ("least", "most")
        ]
        frames.append(
            stated.select(
                ends[0].cast("string").alias("first"),
                ends[1].cast("string").alias("last"),
                (F.coalesce("nulls", F.lit(0)) > 0).alias("undated"),
                # A group of NULLs alone has no ends, and needs none.
                (F.col("rows") > 0).alias("filled"),
                (F.coalesce("nulls", F.lit(-1)) == F.col("rows")).alias("nothing"),
                F.col("problem").isNotNull().alias("unread"),
            )
        )
    spans: set[Days] = set()
    for frame in frames:
        for row in frame.distinct().collect():
            if row.unread:
                return None
            undated = undated or bool(row.undated)
            if not row.filled or row.nothing:
                continue
            try:
                spans.add(Days(dt.date.fromisoformat(row["first"]), dt.date.fromisoformat(row["last"])))
            except (TypeError, ValueError):  # no statistics, or a year that Python has no date for
                return None
    return Touched(sorted(spans, key=lambda d: (d.first, d.last)), undated)


def partition_days(values: dict[str, str | None], date_column: str) -> Days | None:
    """The days a partition stands for, from its columns; None if these are no dates."""
    own = {name.lower(): value for name, value in values.items()}
    try:
        day = own.get(date_column.lower())
        if day is not None:
            return Days(dt.date.fromisoformat(day), dt.date.fromisoformat(day))
        year = int(own["year"])
        if "month" not in own:
            return Days(dt.date(year, 1, 1), dt.date(year, 12, 31)) if "day" not in own else None
        month = int(own["month"])
        if "day" in own:
            return Days(*[dt.date(year, month, int(own["day"]))] * 2)
        after = dt.date(year + month // 12, month % 12 + 1, 1)
        return Days(dt.date(year, month, 1), after - dt.timedelta(days=1))
    except (KeyError, TypeError, ValueError):
        return None


def guard_partitions(
    rows: DataFrame,
    files: ConformedFiles,
    table: str,
    time_column: str,
    date_column: str,
    zone: str = "UTC",
    null_dates: str = "drop",
) -> None:
    """Raise if files were rejected and the others have rows for partitions the table already has.

    Footers decide where they can: a day at either end of a row group has rows, a day that no row
    group spans has none. Rows are read only for partitions between such ends, by a filter that the
    scan takes; and where footers state no times at all, as ``refuse_to_replace`` does.
    """
    spark = rows.sparkSession
    existing = partition_values(spark, table)
    if not existing:
        return
    touched = touched_days(spark, files, time_column, zone)
    if touched is None:
        refuse_to_replace(rows, table, files.rejected)
        return
    certain, possible = [], []
    for values in existing:
        days = partition_days(values, date_column)
        if days is None:
            # Rows without a date have their own partition; other names are not told by days.
            if not all(value is None for value in values.values()):
                possible.append((values, None))
            elif touched.undated and null_dates == "keep":
                certain.append(values)
            continue
        spans = [s for s in touched.spans if s.first <= days.last and s.last >= days.first]
        ends = {end for s in spans for end in (s.first, s.last)}
        if any(days.first <= end <= days.last for end in ends):
            certain.append(values)
        elif spans:
            possible.append((values, days))
    if certain:
        found = sorted(",".join(f"{n}={v}" for n, v in values.items()) for values in certain)
        raise IncompletePartitions(
            f"{files.rejected} files were rejected, and rows for partitions that table {table} already"
            f" has may be missing: {found}"
        )
    if possible:
        if all(days is not None for _, days in possible):
            first = min(days.first for _, days in possible)
            last = max(days.last for _, days in possible)
            day = F.col(f"`{date_column}`").cast("date")
            rows = rows.where(day.between(F.lit(first), F.lit(last)))
        refuse_to_replace(rows, table, files.rejected)

