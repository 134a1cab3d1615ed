"""Complete hourly grids of stays: times 0, 1, ... up to the end of each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _expand(stays: DataFrame, end: Column) -> DataFrame:
    hours = F.sequence(F.lit(0).cast("long"), F.greatest(end, F.lit(0).cast("long")))
    return stays.select("stay_id", F.explode(hours).alias("time"))


def grid_from_times(stays: DataFrame, max_hours: int | None = 168, rounding: str = "floor") -> DataFrame:
    """stay_id, time of stays with intime/outtime; without or with a negative length only hour 0."""
    if rounding not in ("floor", "ceil"):
        raise ValueError("rounding is 'floor' or 'ceil'")
    micros = F.unix_micros(F.col("outtime").cast("timestamp")) - F.unix_micros(F.col("intime").cast("timestamp"))
    length = (micros - micros % F.lit(1_000_000)) / F.lit(1_000_000.0) / F.lit(3600.0)
    whole = (F.floor if rounding == "floor" else F.ceil)(length).cast("long")
    end = F.when(length.isNull() | (length < 0), F.lit(0).cast("long")).otherwise(whole)
    return _expand(stays, end if max_hours is None else F.least(end, F.lit(max_hours).cast("long")))


def grid_from_hours(stays: DataFrame, max_hours: int | None = None) -> DataFrame:
    """stay_id, time of stays with intime_hours/outtime_hours, always floored.

    Without or with a negative length a stay has `max_hours` (hour 0 if there is no such limit).
    """
    length = F.col("outtime_hours") - F.col("intime_hours")
    end = F.floor(length).cast("long")
    end = end if max_hours is None else F.least(end, F.lit(max_hours).cast("long"))
    unknown = F.lit(max_hours or 0).cast("long")
    return _expand(stays, F.when(length.isNull() | (length < 0), unknown).otherwise(end))
