"""Stays: from raw tables, or rebuilt from admission and observation events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from staygrid.functions.timeunits import hours_of
from staygrid.registry import StaySpec
from staygrid.schemas import DATETIME_STAYS, find_column, require_columns


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet table, or CSV (also gzipped) with a header; columns of CSV are strings."""
    return spark.read.parquet(path) if path.endswith(".parquet") else spark.read.csv(path, header=True)


def datetime_stays(table: DataFrame) -> DataFrame:
    """subject_id, hadm_id, stay_id, intime, outtime of a stay table with timestamps."""
    require_columns(table, DATETIME_STAYS, "a stay table")
    ids = [F.col(c).cast("long") for c in DATETIME_STAYS[:3]]
    return table.select(*ids, *[F.col(c).cast("timestamp_ntz") for c in DATETIME_STAYS[3:]])


def normalized_stays(table: DataFrame, spec: StaySpec) -> DataFrame:
    """subject_id, stay_id, intime_hours, outtime_hours of a raw stay table of a dataset.

    Columns are found whatever their case. Times are hours: since the epoch for timestamps,
    numbers times the spec's hours_per_unit otherwise.
    """

    def named(name: str) -> str:
        found = find_column(table, name)
        if found is None:
            raise ValueError(f"the stay table has no column {name!r}")
        return found

    def hours(name: str) -> Column:
        found = named(name)
        kind = table.schema[found].dataType.simpleString()
        column = F.col(found)
        if kind == "string":  # of CSV: a number, or else a timestamp
            time = column.try_cast("timestamp_ntz")
            return F.coalesce(column.try_cast("double") * F.lit(spec.hours_per_unit), F.unix_millis(time.cast("timestamp")) / F.lit(3_600_000.0))
        return hours_of(column, table.schema[found].dataType, spec.hours_per_unit)

    subject, stay = F.col(named(spec.subject)).cast("long"), F.col(named(spec.stay)).cast("long")
    if spec.kind == "discharge_year":
        day = F.concat(F.col(named("hospitaldischargeyear")).cast("string"), F.lit("-01-01 "), F.col(named("hospitaladmittime24")))
        minutes = F.col(named("hospitaladmitoffset")).cast("double")
        begin = F.unix_millis(day.cast("timestamp_ntz").cast("timestamp")) / F.lit(3_600_000.0) - minutes / F.lit(60.0)
        end = begin + F.col(named(spec.end)).cast("double") * F.lit(spec.hours_per_unit)
    elif spec.begin is None:
        begin, end = F.lit(0.0), F.lit(None).cast("double")
    else:
        begin = hours(spec.begin)
        end = F.lit(None).cast("double") if spec.end is None else hours(spec.end)
        if spec.kind == "length":
            end = begin + end
    return table.select(subject.alias("subject_id"), stay.alias("stay_id"), begin.alias("intime_hours"), end.alias("outtime_hours"))


def _hours(df: DataFrame, name: str = "time") -> Column:
    return hours_of(F.col(name), df.schema[name].dataType)


def stays_from_visits(starts: DataFrame, ends: DataFrame) -> DataFrame:
    """Stays of visits: start events left-joined to end events by subject and visit."""
    for name, df in (("visit starts", starts), ("visit ends", ends)):
        require_columns(df, ("subject_id", "time", "visit_occurrence_id"), name)
    keys = [F.col("subject_id").cast("long").alias("subject_id"), F.col("visit_occurrence_id").cast("long").alias("stay_id")]
    begin = starts.select(*keys, _hours(starts).alias("intime_hours"))
    return begin.join(ends.select(*keys, _hours(ends).alias("outtime_hours")), ["subject_id", "stay_id"], "left")


def stays_from_observations(admissions: DataFrame, observations: DataFrame, key: str = "subject_id") -> DataFrame:
    """Stays from an admission (the first) and the last observation of each subject, or of each `key`."""
    for name, df in (("admissions", admissions), ("observations", observations)):
        require_columns(df, {"subject_id", "time", key}, name)
    stay = F.col(key).cast("long").alias("stay_id")
    first = admissions.withColumn("_at", _hours(admissions)).groupBy(stay).agg(
        F.min_by(F.col("subject_id").cast("long"), F.struct("_at", "subject_id")).alias("subject_id"), F.min("_at").alias("intime_hours")
    )
    last = observations.groupBy(stay).agg(F.max(_hours(observations)).alias("outtime_hours"))
    return first.join(last, "stay_id", "left").select("subject_id", "stay_id", "intime_hours", "outtime_hours")
