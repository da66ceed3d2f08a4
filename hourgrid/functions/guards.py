"""Guarded casts: a value that is not clearly of the wanted type becomes NULL.

Each function takes the column and its source type. Text goes through a
pattern and then a cast; numbers are tested as numbers, because the printed
form of a double (``5.0E-4``) would fail the text pattern.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DateType, NumericType, TimestampNTZType, TimestampType

# The accepted text forms. ``\z`` is the very end of the text;
# ``$`` would also accept a trailing line break.
STARTS_WITH_DATE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}"
UNSIGNED_NUMBER = r"^[0-9]+(\.[0-9]+)?\z"
SIGNED_NUMBER = r"^-?[0-9]+(\.[0-9]+)?\z"


def regex_match(text: Column, pattern: str) -> Column:
    return text.rlike(pattern)


def safe_timestamp(value: Column, source: DataType) -> Column:
    """Zone-less timestamp, or NULL for text that is no date or no valid one."""
    if isinstance(source, (TimestampType, TimestampNTZType, DateType)):
        return value.cast("timestamp_ntz")
    text = value.cast("string")
    return F.when(regex_match(text, STARTS_WITH_DATE), text.try_cast("timestamp_ntz"))


def _finite_number(value: Column, source: DataType, pattern: str, lowest: float | None) -> Column:
    if isinstance(source, NumericType):
        number = value.cast("double")
        accepted = F.lit(True) if lowest is None else number >= lowest
    else:
        text = value.cast("string")
        number = text.try_cast("double")
        accepted = regex_match(text, pattern)
    # NaN compares greater than infinity in Spark, so this drops it as well.
    return F.when(accepted & (F.abs(number) < float("inf")), number)


def safe_udouble(value: Column, source: DataType) -> Column:
    return _finite_number(value, source, UNSIGNED_NUMBER, lowest=0.0)


def safe_double(value: Column, source: DataType) -> Column:
    return _finite_number(value, source, SIGNED_NUMBER, lowest=None)


def safe_uint(value: Column, source: DataType) -> Column:
    """Non-negative number rounded half to even; NULL beyond the int range."""
    return F.rint(safe_udouble(value, source)).try_cast("int")
