"""Two wide tables joined once, and every report that this one join yields.

The full join by (stay, time) keeps rows of either side alone, so common rows, keys, stays and the report for each
stay are groupings of it. Tables that lie in buckets of stays are joined without an exchange, and a stay's
rows stay in one task until they are counted.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staygrid.operators import compare
from staygrid.schemas import KEYS


@dataclass(frozen=True)
class Paired:
    """rows: keys, the concepts of the candidate and (with the suffix `_ref`) of the reference, and _a, _b: true where that side has the row."""

    rows: DataFrame
    candidate_concepts: tuple[str, ...]
    reference_concepts: tuple[str, ...]

    @classmethod
    def of(cls, candidate: DataFrame, reference: DataFrame, concepts: Sequence[str] | None = None) -> Paired:
        mine, theirs = (tuple(c for c in df.columns if c not in KEYS and (concepts is None or c in concepts)) for df in (candidate, reference))
        a = candidate.select(*KEYS, *[F.col(f"`{c}`") for c in mine], F.lit(True).alias("_a"))
        b = reference.select(*KEYS, *[F.col(f"`{c}`").alias(f"{c}_ref") for c in theirs], F.lit(True).alias("_b"))
        return cls(a.join(b, KEYS, "full"), mine, theirs)

    def held(self) -> Paired:
        """The same with its rows worked out once; let go of them by `rows.unpersist()`."""
        return Paired(self.rows.persist(StorageLevel.MEMORY_AND_DISK), self.candidate_concepts, self.reference_concepts)

    def within(self, stays: DataFrame) -> Paired:
        """Rows of these stays alone."""
        return Paired(self.rows.join(stays.select("stay_id").distinct(), "stay_id", "left_semi"), self.candidate_concepts, self.reference_concepts)

    @property
    def shared(self) -> list[str]:
        return [c for c in self.candidate_concepts if c in self.reference_concepts]

    def common(self) -> DataFrame:
        """As `compare.on_common_keys`."""
        return self.rows.where("_a and _b").select(*KEYS, *[F.col(f"`{c}`") for c in self.shared], *[F.col(f"`{c}_ref`") for c in self.shared])

    def overlap(self, keys: list[str]) -> DataFrame:
        """How many of these keys either side has and both have; keys with nulls match nothing."""
        sides = self.rows.groupBy(*keys).agg(F.coalesce(F.bool_or("_a"), F.lit(False)).alias("a"), F.coalesce(F.bool_or("_b"), F.lit(False)).alias("b"))
        both = F.col("a") & F.col("b")
        for k in keys:
            both = both & F.col(k).isNotNull()
        return sides.agg(F.count_if("a").alias("n_candidate"), F.count_if("b").alias("n_reference"), F.count_if(both).alias("n_common"))

    def _overlap(self, keys: list[str], what: str) -> DataFrame:
        c = F.col
        return self.overlap(keys).select(
            c("n_candidate").alias(f"n_candidate_{what}"), c("n_reference").alias(f"n_reference_{what}"), c("n_common").alias(f"n_common_{what}"),
            (c("n_candidate") - c("n_common")).alias(f"n_only_candidate_{what}"), (c("n_reference") - c("n_common")).alias(f"n_only_reference_{what}"),
        )

    def key_overlap(self) -> DataFrame:
        return self._overlap(KEYS, "keys")

    def stay_overlap(self) -> DataFrame:
        return self._overlap(["stay_id"], "stays")

    def per_stay(self) -> DataFrame:
        return compare.stay_counts(self.rows, self.shared)

    def missingness(self) -> DataFrame:
        return compare.missingness_of(self.common(), self.shared)

    def value_differences(self) -> DataFrame:
        return compare.differences_of(self.common(), self.shared)
