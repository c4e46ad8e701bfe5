"""Dates and date parts as column expressions; NULL in gives NULL out."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from moraine.functions.zones import instant_of_text, wall_clock_of

TEXT_TYPES = (T.StringType, T.CharType, T.VarcharType)
ISO_FORMAT = "yyyy-MM-dd"
ISO_SHAPE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}\z"
ISO_DATE = r"^[0-9]{4}-(0[1-9]|1[0-2])-(0[1-9]|[12][0-9]|3[01])\z"


def safe_date(value: Column, data_type: T.DataType, fmt: str | None = None) -> Column:
    """The date of a text, date or timestamp column, or NULL where a text is not a date.

    ``fmt`` applies to text only; without it, text in ISO form is read. Timestamps have no format to
    check: their date is taken as it is. Numbers are no dates; see ``local_date`` for times in numbers.
    """
    if isinstance(data_type, T.NumericType):
        return F.lit(None).cast("date")
    if not isinstance(data_type, TEXT_TYPES):
        return F.to_date(value)
    if fmt is None:
        return value.try_cast("date")
    parsed = F.try_to_date(value, fmt)
    if fmt != ISO_FORMAT:
        return parsed
    # Plain ISO text is cast to the same dates. Parsing by format, and casting what is no date, raise
    # and catch an error for each value, so months and days out of range are sorted out before.
    return (
        F.when(value.rlike(ISO_DATE), value.try_cast("date"))
        .when(value.rlike(ISO_SHAPE), F.lit(None).cast("date"))
        .otherwise(parsed)
    )


def local_date(
    value: Column, data_type: T.DataType, zone: str, session: str, fmt: str | None = None
) -> Column:
    """The calendar date in ``zone``.

    Zone-less times already show that zone's clock, so their date is taken directly and never by way
    of an instant; instants are first turned into that clock. Numbers are seconds since the epoch.
    Text without ``fmt`` is an event time: it has the date of the instant it is converted to, so an
    offset in it counts, and what is no time has no date.
    """
    if isinstance(data_type, TEXT_TYPES) and fmt is None:
        value, data_type = instant_of_text(value, zone, session), T.TimestampType()
    if isinstance(data_type, T.NumericType):
        value, data_type = value.try_cast(T.TimestampType()), T.TimestampType()
    if isinstance(data_type, T.TimestampType):
        return F.to_date(wall_clock_of(value, zone, session))
    return safe_date(value, data_type, fmt)


def date_parts(day: Column) -> dict[str, Column]:
    """Year, and zero-padded month and day, as text."""
    return {
        "year": F.year(day).cast("string"),
        "month": F.lpad(F.month(day).cast("string"), 2, "0"),
        "day": F.lpad(F.dayofmonth(day).cast("string"), 2, "0"),
    }


def date_parts_by_substring(day: Column) -> dict[str, Column]:
    """The same three parts cut out of the date's ISO text."""
    text = day.cast("string")
    return {
        "year": F.substring(text, 1, 4),
        "month": F.substring(text, 6, 2),
        "day": F.substring(text, 9, 2),
    }
