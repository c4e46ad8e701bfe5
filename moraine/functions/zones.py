"""Wall-clock times and instants, with the zone always named."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_UTC_NAMES = {"UTC", "ETC/UTC", "GMT", "ETC/GMT", "UCT", "Z", "+00:00"}


def session_zone(spark: SparkSession) -> str:
    return spark.conf.get("spark.sql.session.timeZone")


def same_zone(a: str, b: str) -> bool:
    return a == b or {a.upper(), b.upper()} <= _UTC_NAMES


def instant_of(wall_clock: Column, zone: str, session: str) -> Column:
    """TIMESTAMP_NTZ read as a wall clock in ``zone`` -> TIMESTAMP.

    A plain cast reads the wall clock in the session zone, so it is used only when that is the zone
    asked for. Otherwise the instant is built from the distance to the epoch, which does not pass
    through the session zone and so cannot be bent by its daylight-saving changes.
    """
    if same_zone(zone, session):
        return wall_clock.cast(T.TimestampType())
    utc_clock = F.convert_timezone(F.lit(zone), F.lit("UTC"), wall_clock)
    epoch = F.lit("1970-01-01 00:00:00").cast(T.TimestampNTZType())
    return F.timestamp_seconds((utc_clock - epoch).cast("decimal(20,6)"))


# A time of day followed by an offset or the name of a zone.
TEXT_WITH_ZONE = r":[0-9]{2}.*([A-Za-z]|[+-][0-9:]+)\s*$"


def instant_of_text(text: Column, zone: str, session: str) -> Column:
    """Text -> TIMESTAMP or NULL; a zone written in the text counts, else it is a clock in ``zone``."""
    as_written = text.try_cast(T.TimestampType())
    if same_zone(zone, session):
        return as_written
    clock = instant_of(text.try_cast(T.TimestampNTZType()), zone, session)
    return F.when(text.rlike(TEXT_WITH_ZONE), as_written).otherwise(clock)


def wall_clock_of(instant: Column, zone: str, session: str) -> Column:
    """TIMESTAMP -> TIMESTAMP_NTZ as a clock in ``zone`` shows it."""
    if same_zone(zone, session):
        return instant.cast(T.TimestampNTZType())
    seconds = (F.unix_micros(instant) * F.lit(Decimal("0.000001"))).cast("decimal(18,6)")
    since_epoch = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds)
    utc_clock = F.lit("1970-01-01 00:00:00").cast(T.TimestampNTZType()) + since_epoch
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), utc_clock)
