"""Casts that give NULL for a value that does not fit."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A whole or decimal number written out; its whole part is what an integer column takes.
NUMBER_TEXT = r"^\s*[+-]?[0-9]+(\.[0-9]*)?\s*$"

_BITS = {T.ByteType: 8, T.ShortType: 16, T.IntegerType: 32, T.LongType: 64}


def fitting_cast(value: Column, have: T.DataType, want: T.DataType) -> Column:
    """Cast, or NULL.

    ``try_cast`` raises and catches an error inside the task for each value that does not fit. Where
    a plain test can tell beforehand, as for numbers out of range, such values cost nothing extra.
    Integers take numbers with a fraction, also as text, and cut it off towards zero; NaN is no number.
    """
    if type(want) in _BITS:
        bits = _BITS[type(want)]
        low, high = -(2 ** (bits - 1)), 2 ** (bits - 1)
        if isinstance(have, (T.FloatType, T.DoubleType)):
            number = value.cast("double")
            # Below 64 bits, low - 1 is a double too, and fractions above it are cut off to low.
            above = number >= float(low) if bits == 64 else number > float(low - 1)
            return F.when(above & (number < float(high)), value.cast(want))
        if type(have) in _BITS:
            if _BITS[type(have)] <= bits:
                return value.cast(want)
            return F.when(value.between(low, high - 1), value.cast(want))
        if isinstance(have, T.StringType):
            whole = F.split_part(value, F.lit("."), F.lit(1))
            return F.when(value.rlike(NUMBER_TEXT), whole.try_cast(want))
    return value.try_cast(want)
