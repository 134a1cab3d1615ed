"""Concept event tables: readers that check, select and cast the columns of the contract."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from staygrid.functions.timeunits import hours_of
from staygrid.schemas import LINK_COLUMNS, STAY_EVENTS, SUBJECT_EVENTS, VERSION_COLUMN, require_columns


def of_version(events: DataFrame, version: str | None) -> DataFrame:
    """Rows of one dataset version, by exact string; all rows if there is no such column or version."""
    if version is None or VERSION_COLUMN not in events.columns:
        return events
    return events.where(F.col(VERSION_COLUMN).cast("string") == version)


def subject_events(events: DataFrame, version: str | None = None) -> DataFrame:
    """subject_id, time (a naive timestamp) and numeric_value."""
    require_columns(events, SUBJECT_EVENTS, "a concept table")
    extra = [c for c in ("concept", "event_id") if c in events.columns]
    return of_version(events, version).select(F.col("subject_id").cast("long"), F.col("time").cast("timestamp_ntz"), F.col("numeric_value").cast("double"), *extra)


def subject_events_in_hours(events: DataFrame, scale: float = 1.0, version: str | None = None) -> DataFrame:
    """subject_id, time_hours, numeric_value and link columns; `scale` turns numeric times into hours."""
    require_columns(events, SUBJECT_EVENTS, "a concept table")
    links = [F.col(c).cast("long") for c in LINK_COLUMNS if c in events.columns]
    extra = [c for c in ("concept", "event_id") if c in events.columns]
    time = hours_of(F.col("time"), events.schema["time"].dataType, scale)
    return of_version(events, version).select(F.col("subject_id").cast("long"), time.alias("time_hours"), F.col("numeric_value").cast("double"), *links, *extra)


def stay_events(events: DataFrame, version: str | None = None) -> DataFrame:
    """stay_id, time (whole hours) and numeric_value of events that are in stays already."""
    require_columns(events, STAY_EVENTS, "a stay-indexed concept table")
    extra = [c for c in ("concept",) if c in events.columns]
    time = F.col("time").cast("long")
    return of_version(events, version).select(F.col("stay_id").cast("long"), time.alias("time"), time.alias("at"), F.col("numeric_value").cast("double"), *extra)


def read_concept(spark: SparkSession, path: str, concept: str | None = None) -> DataFrame:
    """A concept's Parquet table, with its name as a column if given."""
    df = spark.read.parquet(path)
    return df if concept is None else df.withColumn("concept", F.lit(concept))


def dataset_versions(tables: list[DataFrame]) -> list[str] | None:
    """Distinct dataset versions over concept tables; None if one has no such column.

    Each pass looks for one more version: any row of another than those known. Row groups that hold
    a known version alone are passed over by their footers' statistics, so no data is read to confirm
    that there are no more; a pass stops at the first row it finds.
    """
    if not tables or any(VERSION_COLUMN not in t.columns for t in tables):
        return None if tables else []
    found: list[str] = []
    while row := _rows_of_other_versions(tables, found).first():
        found.append(row["v"])
    return sorted(found)


def _rows_of_other_versions(tables: list[DataFrame], known: list[str]) -> DataFrame:
    out = None
    for t in tables:
        v = F.col(VERSION_COLUMN)
        v = v if t.schema[VERSION_COLUMN].dataType == StringType() else v.cast("string")  # a cast would keep the filter from the files
        part = t.where(v.isNotNull())
        for k in known:
            part = part.where(v != k)
        part = part.select(v.alias("v"))
        out = part if out is None else out.union(part)
    return out
