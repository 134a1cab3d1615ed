"""Hours, and whole hours since admission, from whatever a time column holds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MS_PER_HOUR = 3_600_000.0
#: Beyond a leap year of hours, numbers are taken to be milliseconds.
MOST_HOURS = 24 * 366
_UNITS = {"hours": 1.0, "s": 3600.0, "ms": 3.6e6, "us": 3.6e9}


def hours_of(column: Column, dtype: T.DataType, scale: float = 1.0) -> Column:
    """Hours as a double: since the epoch for dates and times, of an interval, or numbers times `scale`."""
    if isinstance(dtype, (T.TimestampNTZType, T.TimestampType, T.DateType)):
        return F.unix_millis(column.cast("timestamp")) / F.lit(MS_PER_HOUR)
    if isinstance(dtype, T.DayTimeIntervalType):
        parts = [F.extract(F.lit(p), column).cast("double") * s for p, s in (("DAY", 24.0), ("HOUR", 1.0), ("MINUTE", 1 / 60), ("SECOND", 1 / 3600))]
        return sum(parts[1:], parts[0])
    return column.cast("double") * F.lit(float(scale))


def whole_hours_between(begin: Column, end: Column) -> Column:
    """Whole hours from `begin` to `end` (times), by whole seconds: floored."""
    micros = F.unix_micros(end.cast("timestamp")) - F.unix_micros(begin.cast("timestamp"))
    seconds = (micros - micros % F.lit(1_000_000)) / F.lit(1_000_000.0)  # % has the sign of micros
    return F.floor(seconds / F.lit(3600.0)).cast("long")


def floored_hours(begin: Column, at: Column) -> Column:
    """Whole hours from `begin` to `at`, both in hours as doubles."""
    return F.floor(at - begin).cast("long")


def reference_hours(df: DataFrame, name: str, unit: str | None = None) -> Column:
    """Integer hours of a reference time column: by its type, its stated unit, or its size.

    Without a unit, numbers above MOST_HOURS anywhere in the column mean milliseconds.
    Halves round to even.
    """
    dtype, column = df.schema[name].dataType, F.col(name)
    if unit is None and isinstance(dtype, (T.DayTimeIntervalType, T.TimestampNTZType, T.TimestampType, T.DateType)):
        return F.bround(hours_of(column, dtype), 0).cast("long")
    if unit is None:
        largest = df.agg(F.max(F.abs(column.cast("double")))).first()[0]
        unit = "ms" if largest is not None and largest > MOST_HOURS else "hours"
    return F.bround(column.cast("double") / F.lit(_UNITS[unit]), 0).cast("long")
