"""What two wide tables share: stays, concepts and keys, and what a comparison may claim."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staygrid.plans.identifiers import StayIds, version_assumption
from staygrid.plans.versions import VersionPair
from staygrid.schemas import KEYS


def full_scope(versions: VersionPair, stay_ids: StayIds) -> bool:
    """Verified equal versions in one identifier space; a crosswalk covers only the stays it maps."""
    return versions.full and stay_ids.basis == "direct_identifier_match"


def _relationship(matched: bool) -> Column:
    a, b, n = F.col("n_candidate"), F.col("n_reference"), F.col("_shared")
    known = F.when(n == 0, "not_directly_comparable").when((n == a) & (n == b), "equal").when(n == b, "candidate_superset").when(n == a, "reference_superset")
    return known.otherwise("partial_overlap") if matched else F.lit("not_directly_comparable")


def _dimension(name: str, a: DataFrame, b: DataFrame, matched: bool) -> DataFrame:
    """One row of sizes of two identifier sets; nothing is said of what they share if ids don't match."""
    joined = a.distinct().withColumn("_a", F.lit(True)).join(b.distinct().withColumn("_b", F.lit(True)), a.columns, "full")
    return sized(name, joined.agg(F.count("_a").alias("n_candidate"), F.count("_b").alias("n_reference"), F.count_if(F.col("_a") & F.col("_b")).alias("n_common")), matched)


def sized(name: str, counts: DataFrame, matched: bool) -> DataFrame:
    """The row of a dimension from n_candidate, n_reference and n_common."""
    row = counts.withColumnRenamed("n_common", "_shared")
    told = lambda c: c if matched else F.lit(None).cast("long")
    return row.select(
        F.lit(name).alias("dimension"), "n_candidate", "n_reference", told(F.col("_shared")).alias("n_shared"), told(F.col("n_candidate") - F.col("_shared")).alias("n_candidate_only"),
        told(F.col("n_reference") - F.col("_shared")).alias("n_reference_only"), _relationship(matched).alias("relationship"),
    )


def _named(df: DataFrame, concepts: Sequence[str]) -> DataFrame:
    return df.sparkSession.createDataFrame([(c,) for c in concepts if c in df.columns], "concept string")


def named_concepts(candidate: DataFrame, reference: DataFrame, concepts: Sequence[str]) -> DataFrame:
    """Size and relationship of the concepts that both tables have columns of."""
    return _dimension("concepts", _named(candidate, concepts), _named(reference, concepts), True)


def scope_overlap(candidate: DataFrame, reference: DataFrame, concepts: Sequence[str], matchable: bool = True) -> DataFrame:
    """Sizes and relationship of stays, concepts and (stay, time) keys."""
    stays = _dimension("stays", candidate.select("stay_id"), reference.select("stay_id"), matchable)
    return stays.unionByName(named_concepts(candidate, reference, concepts)).unionByName(_dimension("stay_time_keys", candidate.select(*KEYS), reference.select(*KEYS), matchable))


def scope_differences(candidate: DataFrame, reference: DataFrame, concepts: Sequence[str], matchable: bool = True, unmapped: DataFrame | None = None) -> DataFrame:
    """dimension, identifier, side: what one side has alone.

    If ids don't match, both sides' stays are listed whole, without the word 'only'.
    """

    def listed(df: DataFrame, dimension: str, side: str) -> DataFrame:
        return df.select(F.lit(dimension).alias("dimension"), F.col(df.columns[0]).cast("string").alias("identifier"), F.lit(side).alias("side"))

    a, b = candidate.select("stay_id").distinct(), reference.select("stay_id").distinct()
    if matchable:
        parts = [listed(a.join(b, "stay_id", "left_anti"), "stay", "candidate_only"), listed(b.join(a, "stay_id", "left_anti"), "stay", "reference_only")]
    else:
        parts = [listed(a, "stay", "candidate"), listed(b, "stay", "reference")]
    if unmapped is not None:
        parts.append(listed(unmapped.select("stay_id").distinct(), "stay", "reference_without_crosswalk"))
    c, d = _named(candidate, concepts), _named(reference, concepts)
    parts += [listed(c.join(d, "concept", "left_anti"), "concept", "candidate_only"), listed(d.join(c, "concept", "left_anti"), "concept", "reference_only")]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def claims(versions: VersionPair, stay_ids: StayIds, overlap: DataFrame, n_unmapped: int = 0) -> dict[str, object]:
    """Scope, validation level, confidence and counts of a comparison, from its overlap table."""
    rows = {r["dimension"]: r for r in overlap.collect()}  # three rows
    stays, concepts = rows["stays"], rows["concepts"]
    comparable = stay_ids.matchable and bool(stays["n_shared"]) and bool(concepts["n_shared"])
    full = full_scope(versions, stay_ids)
    assumption = version_assumption(stay_ids.basis, versions.full)
    level = "shared_subset_stay_crosswalk" if comparable and versions.full and not full else versions.level(comparable)
    return {
        "comparison_scope": "full" if full else "shared_subset", "validation_level": level, "metrics_restricted_to_shared_scope": not full,
        "candidate_stay_id_space": stay_ids.candidate, "reference_stay_id_space": stay_ids.reference, "stay_comparison_basis": stay_ids.basis,
        "stay_comparison_confidence": "not_comparable" if not stay_ids.matchable else "high" if assumption == "same_verified_version" else "medium",
        "stay_id_version_assumption": assumption,
        "n_scope_shared_stays": stays["n_shared"], "n_scope_candidate_only_stays": stays["n_candidate_only"], "n_scope_reference_only_stays": stays["n_reference_only"],
        "n_scope_reference_stays_without_crosswalk": n_unmapped,
        "n_scope_shared_concepts": concepts["n_shared"], "n_scope_candidate_only_concepts": concepts["n_candidate_only"], "n_scope_reference_only_concepts": concepts["n_reference_only"],
        "stay_relationship": stays["relationship"], "concept_relationship": concepts["relationship"],
    }
