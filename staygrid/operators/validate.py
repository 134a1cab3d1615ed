"""Checks of one wide table: coverage, ranges, windows against stays, and one concept recomputed."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staygrid.functions.aggregates import check, in_range
from staygrid.operators.compare import _by_concept, concepts_of
from staygrid.operators.mapping import map_by_time
from staygrid.operators.wide import hourly
from staygrid.schemas import KEYS


def column_report(wide: DataFrame, concepts: Sequence[str]) -> dict[str, list[str]]:
    """Concepts that the table lacks, and columns that it has besides."""
    return {"missing": [c for c in concepts if c not in wide.columns], "extra": [c for c in wide.columns if c not in {*KEYS, *concepts}]}


def concept_coverage(wide: DataFrame, concepts: Sequence[str] | None = None) -> DataFrame:
    """How many hours know each concept, and in percent of all rows; most first."""
    concepts = [c for c in (concepts or concepts_of(wide)) if c in wide.columns]
    cells = [x for i, c in enumerate(concepts) for x in (F.count(F.col(f"`{c}`")).alias(f"{i}_n_non_null"), (F.count(F.col(f"`{c}`")) * 100.0 / F.nullif(F.count("*"), F.lit(0))).alias(f"{i}_percent_non_null"))]
    out = _by_concept(wide.agg(F.lit(1).alias("_one"), *cells), concepts, {"n_non_null": "long", "percent_non_null": "double"})
    return out.orderBy(F.desc("n_non_null"), "concept")


def range_report(wide: DataFrame, bounds: Mapping[str, tuple[float | None, float | None]]) -> DataFrame:
    """Observed lowest and highest value of each concept against its bounds."""
    concepts = [c for c in bounds if c in wide.columns]
    cells = []
    for i, c in enumerate(concepts):
        v = F.col(f"`{c}`")
        low, high = (F.lit(b).cast("double") for b in bounds[c])
        cells += [
            F.count(v).alias(f"{i}_n_non_null"), F.min(v).alias(f"{i}_observed_min"), F.max(v).alias(f"{i}_observed_max"), low.alias(f"{i}_range_min"), high.alias(f"{i}_range_max"),
            F.coalesce(F.min(v) < low, F.lit(False)).alias(f"{i}_below_range_min"), F.coalesce(F.max(v) > high, F.lit(False)).alias(f"{i}_above_range_max"),
        ]
    fields = {"n_non_null": "long", **dict.fromkeys(("observed_min", "observed_max", "range_min", "range_max"), "double"), "below_range_min": "boolean", "above_range_max": "boolean"}
    return _by_concept(wide.agg(F.lit(1).alias("_one"), *cells), concepts, fields)


def against_stays(wide: DataFrame, stays: DataFrame, rounding: str = "floor") -> DataFrame:
    """Each stay's first and last hour by its times (of stays with timestamps) beside those the table has for it, and their differences."""
    if rounding not in ("floor", "ceil"):
        raise ValueError("rounding is 'floor' or 'ceil'")
    micros = F.unix_micros(F.col("outtime").cast("timestamp")) - F.unix_micros(F.col("intime").cast("timestamp"))
    length = (micros - micros % F.lit(1_000_000)) / F.lit(1_000_000.0) / F.lit(3600.0)
    named = stays.select("subject_id", "hadm_id", "stay_id", "intime", "outtime", length.alias("los_hours"), F.lit(0).cast("long").alias("expected_start"))
    named = named.withColumn("expected_end", (F.floor if rounding == "floor" else F.ceil)("los_hours").cast("long"))
    held = wide.groupBy("stay_id").agg(F.min("time").alias("dyn_start"), F.max("time").alias("dyn_end"), F.countDistinct("time").alias("dyn_n_timepoints"))
    out = named.join(held, "stay_id", "left").select(*named.columns, *held.columns[1:])
    return out.withColumns({"diff_start": F.col("dyn_start") - F.col("expected_start"), "diff_end": F.col("dyn_end") - F.col("expected_end")})


def recompute_concept(mapped: DataFrame, wide: DataFrame, concept: str, name: str, n: int = 20) -> dict[str, DataFrame]:
    """One concept aggregated anew against the stored column: a summary and the largest differences."""
    again = hourly(mapped, name, concept)
    stored = wide.select(*KEYS, F.col(f"`{concept}`").alias(f"{concept}_final")).where(F.col(f"`{concept}_final`").isNotNull())
    joined = again.join(stored, KEYS).withColumn("abs_diff", F.abs(F.col(f"`{concept}`") - F.col(f"`{concept}_final`")))
    summary = joined.agg(F.count("*").alias("n_compared"), F.max("abs_diff").alias("max_abs_diff"), F.avg("abs_diff").alias("mean_abs_diff"))
    return {"comparison_summary": summary, "largest_differences": joined.orderBy(F.desc("abs_diff"), *KEYS).limit(n), "joined": joined}


def trace_concept(
    raw: DataFrame, stays: DataFrame, wide: DataFrame, concept: str, name: str = "mean", bounds: tuple[float | None, float | None] = (None, None), window: bool = True, n: int = 20,
) -> dict[str, DataFrame]:
    """One concept from its events (subject_id, time, numeric_value) to the wide table: what each step leaves, and the differences."""
    if check(name, concept) in ("first", "last"):
        raise ValueError(f"aggregation {name!r} can't be traced")
    value = [F.min("numeric_value").alias("min_value"), F.max("numeric_value").alias("max_value")]
    time = [F.min("time").alias("min_time"), F.max("time").alias("max_time")]
    filtered = raw.where(in_range(low=bounds[0], high=bounds[1]))
    mapped = map_by_time(filtered, stays, window=window)
    return {
        "raw_summary": raw.agg(F.count("*").alias("rows"), F.countDistinct("subject_id").alias("subjects"), *time, *value), "filtered_summary": filtered.agg(F.count("*").alias("rows"), *value),
        "mapped_summary": mapped.agg(F.count("*").alias("rows"), F.countDistinct("stay_id").alias("stays"), *time), **recompute_concept(mapped, wide, concept, name, n),
    }
