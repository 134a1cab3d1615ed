"""The independently produced reference: windows and wide table in canonical form."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staygrid.functions.timeunits import reference_hours
from staygrid.schemas import KEYS, find_column

# Names that a reference may give its stay and time columns.
STAY_NAMES = ("stay_id", "icustay_id", "patientunitstayid", "admissionid", "patientid", "CaseID")
TIME_NAMES = ("time", "charttime", "labresultoffset", "measuredat", "Offset")


def with_stay_id(df: DataFrame) -> DataFrame:
    """The frame with its stay column named stay_id (whole numbers)."""
    found = find_column(df, *STAY_NAMES)
    if found is None:
        raise ValueError(f"the reference has none of the stay columns {STAY_NAMES}")
    return df.withColumnRenamed(found, "stay_id").withColumn("stay_id", F.col("stay_id").cast("long"))


def reference_windows(windows: DataFrame, max_hours: int | None = 168, unit: str | None = None) -> DataFrame:
    """stay_id, reference_start, reference_end (capped) and reference_expected_n_timepoints."""
    df = with_stay_id(windows)
    end = reference_hours(df, "end", unit)
    end = end if max_hours is None else F.when(end.isNotNull(), F.least(end, F.lit(max_hours).cast("long")))
    out = df.select("stay_id", reference_hours(df, "start", unit).alias("reference_start"), end.alias("reference_end"))
    return out.withColumn("reference_expected_n_timepoints", F.col("reference_end") - F.col("reference_start") + 1)


def reference_wide(reference: DataFrame, windows: DataFrame, columns: Sequence[str], unit: str | None = None) -> DataFrame:
    """The reference's rows inside its windows, with those of `columns` that it has."""
    df = with_stay_id(reference)
    time = find_column(df, *TIME_NAMES)
    if time is None:
        raise ValueError(f"the reference has none of the time columns {TIME_NAMES}")
    hours = F.col(time).cast("long") if time == "time" and df.schema[time].dataType.simpleString() in ("bigint", "int") and unit is None else reference_hours(df, time, unit)
    kept = [c for c in columns if c not in KEYS and c in df.columns]
    df = df.select("stay_id", hours.alias("time"), *kept)
    inside = df.join(windows.select("stay_id", "reference_start", "reference_end"), "stay_id")
    return inside.where("time between reference_start and reference_end").select(*KEYS, *kept)


def comparable_types(wide: DataFrame, concepts: Sequence[str]) -> DataFrame:
    """Keys as whole numbers and values as single-precision floats (what isn't a number: null)."""
    kept = [c for c in concepts if c in wide.columns]
    return wide.select(*[F.col(k).cast("long") for k in KEYS], *[F.col(f"`{c}`").try_cast("float").alias(c) for c in kept])
