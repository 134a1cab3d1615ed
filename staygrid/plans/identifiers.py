"""Stay identifier spaces: ids are matched only within one space or through a crosswalk."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staygrid import registry
from staygrid.schemas import require_columns


def load_stay_crosswalk(table: DataFrame) -> DataFrame:
    """reference_stay_id and candidate_stay_id, each at most once; ValueError otherwise."""
    require_columns(table, ("reference_stay_id", "candidate_stay_id"), "a stay crosswalk")
    pairs = table.select(F.col("reference_stay_id").cast("long"), F.col("candidate_stay_id").cast("long")).dropna().distinct()
    for column in pairs.columns:
        if duplicated(pairs, [column]).limit(1).count():
            raise ValueError(f"a stay crosswalk must be one-to-one; {column} repeats")
    return pairs


def duplicated(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that more than one row has, and how many."""
    return df.groupBy(*keys).agg(F.count("*").alias("n_rows")).where("n_rows > 1")


def candidate_space(dataset: str, stay_source: str) -> str | None:
    """The space of a wide table's stays; stay_source is 'raw_table' or 'events'."""
    key = dataset.lower()
    return registry.RAW_STAY_SPACES.get(key) if stay_source == "raw_table" else registry.EVENT_STAY_SPACES.get(key)


def version_assumption(basis: str, same_verified: bool) -> str:
    """What a match of stays takes for granted about ids across versions."""
    if basis == "side_by_side_only":
        return "not_applicable"
    if basis == "crosswalk":
        return "crosswalk"
    return "same_verified_version" if same_verified else "unverified_cross_version_stability"


@dataclass(frozen=True)
class StayIds:
    """The spaces of both sides, and a crosswalk if there is one."""

    candidate: str | None
    reference: str | None
    crosswalk: DataFrame | None = None

    @property
    def basis(self) -> str:
        if self.crosswalk is not None:
            return "crosswalk"
        same = self.candidate is not None and self.candidate == self.reference
        return "direct_identifier_match" if same else "side_by_side_only"

    @property
    def matchable(self) -> bool:
        return self.basis != "side_by_side_only"

    def translate(self, reference: DataFrame) -> tuple[DataFrame, DataFrame]:
        """The reference's rows with candidate stay ids, and stays that have no entry."""
        if self.crosswalk is None:
            return reference, reference.select("stay_id").where(F.lit(False))
        pairs = self.crosswalk.withColumnRenamed("reference_stay_id", "stay_id")
        mapped = reference.join(pairs, "stay_id").drop("stay_id").withColumnRenamed("candidate_stay_id", "stay_id")
        unmapped = reference.select("stay_id").distinct().join(pairs, "stay_id", "left_anti")
        return mapped.select(*reference.columns), unmapped
