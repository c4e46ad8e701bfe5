"""Projections: casting, conforming to a schema, aligning to a table, deriving dates, union."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from moraine.functions.casts import fitting_cast
from moraine.functions.dates import TEXT_TYPES, date_parts, local_date
from moraine.functions.names import by_lower_name, column, require
from moraine.functions.zones import instant_of, instant_of_text, session_zone, wall_clock_of


def _converted(
    value: Column, have: T.DataType, want: T.DataType, zone: str, session: str
) -> Column:
    if have == want:
        return value
    if isinstance(have, T.TimestampNTZType) and isinstance(want, T.TimestampType):
        return instant_of(value, zone, session)
    if isinstance(have, T.DateType) and isinstance(want, T.TimestampType):
        return instant_of(value.cast(T.TimestampNTZType()), zone, session)
    if isinstance(have, TEXT_TYPES) and isinstance(want, T.TimestampType):
        return instant_of_text(value, zone, session)
    if isinstance(have, T.TimestampType) and isinstance(want, T.TimestampNTZType):
        return wall_clock_of(value, zone, session)
    if isinstance(want, T.DateType):
        return local_date(value, have, zone, session)
    return fitting_cast(value, have, want)


def cast_columns(df: DataFrame, types: Mapping[str, T.DataType | str]) -> DataFrame:
    """Cast the named columns in place, in one projection.

    A value that does not fit the new type becomes NULL; it is never wrapped round or saturated.
    """
    wanted = {require(df.columns, name): _data_type(kind) for name, kind in types.items()}
    return df.select(
        *[
            fitting_cast(column(f.name), f.dataType, wanted[f.name]).alias(f.name)
            if f.name in wanted
            else column(f.name)
            for f in df.schema
        ]
    )


def _data_type(kind: T.DataType | str) -> T.DataType:
    return T.DataType.fromDDL(kind) if isinstance(kind, str) else kind


def normalize_ntz(df: DataFrame, zone: str = "UTC") -> DataFrame:
    """Turn every zone-less timestamp into an instant, reading it as a clock in ``zone``."""
    session = session_zone(df.sparkSession)
    return df.select(
        *[
            instant_of(column(field.name), zone, session).alias(field.name)
            if isinstance(field.dataType, T.TimestampNTZType)
            else column(field.name)
            for field in df.schema
        ]
    )


def conform_to_schema(
    df: DataFrame,
    schema: T.StructType,
    zone: str = "UTC",
    event_date: tuple[str, str] | None = None,
) -> DataFrame:
    """Exactly the columns of ``schema``, in its order and types.

    Names are matched without regard to case. Columns the frame lacks are typed NULLs, columns the
    schema lacks are dropped. With ``event_date=(time column, new column)`` the calendar date of the
    time column is added. A stored time or date gives it directly, before any change of type; where
    the time is written as text or a number, the date is that of the converted column, and NULL
    where that is NULL.
    """
    session = session_zone(df.sparkSession)
    have = {name: df.schema[spelled] for name, spelled in by_lower_name(df.columns).items()}
    selected, converted = [], {}
    for field in schema:
        source = have.get(field.name.lower())
        if source is None:
            value = F.lit(None).cast(field.dataType)
        else:
            value = _converted(
                column(source.name), source.dataType, field.dataType, zone, session
            )
        converted[field.name.lower()] = (value, field.dataType)
        selected.append(value.alias(field.name))
    if event_date is not None:
        time_column, date_column = event_date
        require(schema.fieldNames(), time_column)
        if date_column.lower() in by_lower_name(schema.fieldNames()):
            raise ValueError(f"the schema already has a column {date_column!r}")
        source = have.get(time_column.lower())
        if source is None:
            day = F.lit(None).cast("date")
        elif isinstance(source.dataType, (T.NumericType, *TEXT_TYPES)):
            day = local_date(*converted[time_column.lower()], zone, session)
        else:
            day = local_date(column(source.name), source.dataType, zone, session)
        selected.append(day.alias(date_column))
    return df.select(*selected)


def derive_date_columns(
    df: DataFrame,
    time_column: str,
    date_column: str = "pickup_date",
    null_dates: str = "drop",
    zone: str = "UTC",
    fmt: str | None = None,
) -> DataFrame:
    """Add the date of the event-time column and its year, month and day as text.

    The event-time column must be there; no other column is taken in its place. ``null_dates`` says
    whether rows without a date are dropped or kept; kept rows have NULL in all four columns.
    """
    time_name = require(df.columns, time_column)
    day = local_date(
        column(time_name),
        df.schema[time_name].dataType,
        zone,
        session_zone(df.sparkSession),
        fmt,
    )
    return with_date_parts(df.withColumn(date_column, day), date_column, null_dates)


def with_date_parts(df: DataFrame, date_column: str, null_dates: str = "drop") -> DataFrame:
    """Add year, month and day of an existing date column."""
    if null_dates not in ("drop", "keep"):
        raise ValueError(f"null_dates must be 'drop' or 'keep', not {null_dates!r}")
    day = column(date_column)
    if null_dates == "drop":
        df = df.where(day.isNotNull())
    return df.withColumns(date_parts(day))


def align_to_columns(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """The named columns in the given order; a column the frame lacks raises."""
    have = by_lower_name(df.columns)
    columns = list(columns)
    missing = [name for name in columns if name.lower() not in have]
    if missing:
        raise ValueError(f"columns {missing} are not among {df.columns}")
    return df.select(*[column(have[name.lower()]).alias(name) for name in columns])


def align_to_table(df: DataFrame, table: str) -> DataFrame:
    """The columns of a catalog table in its order, as a write by position needs them."""
    return align_to_columns(df, df.sparkSession.table(table).columns)


def union_by_name(frames: Iterable[DataFrame], empty: DataFrame | None = None) -> DataFrame:
    """All rows of all frames, columns matched by name. ``empty`` is returned when there are none."""
    frames = list(frames)
    if not frames:
        if empty is None:
            raise ValueError("no frames to union and no empty frame given")
        return empty
    return reduce(DataFrame.unionByName, frames)
