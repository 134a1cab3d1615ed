"""Many comparisons at once: what a table of candidate and reference exports allows to conclude of each pair.

The rules are those of `versions`, `identifiers` and `scope`, as column expressions over a table with a row for each
pair, of any length: where versions come from, whether they are equal, whether ids can be matched and on which
assumption, and how the sets relate by their sizes.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staygrid import registry
from staygrid.plans.versions import LEVELS, RELATIONSHIPS, STATED, UNKNOWN
from staygrid.schemas import require_columns

_DIRECT, _CROSSWALK, _NONE = "direct_identifier_match", "crosswalk", "side_by_side_only"
#: What `assess` needs to know of each pair.
PAIR = (
    "candidate_dataset", "candidate_stay_source", "candidate_version", "candidate_version_source", "reference_source", "reference_version", "reference_version_source",
    "has_crosswalk", "n_candidate", "n_reference", "n_shared",
)


def version_key(version: Column) -> Column:
    """Equal for equal versions: without a leading v, leading zeros of numbers and zeros at the end."""
    bare = F.regexp_replace(F.lower(F.regexp_replace(version, r"^\s+|\s+$", "")), "^v", "")
    parts = F.transform(F.split(bare, r"\."), lambda p: F.when(p.rlike("^[0-9]+$"), F.regexp_replace(p, "^0+(?=.)", "")).otherwise(p))
    return F.regexp_replace(F.array_join(parts, "."), r"(\.0)+$", "")


def first_stated(evidence: Sequence[tuple[Column, str]]) -> tuple[Column, Column]:
    """Version and its source from pieces of evidence, strongest first: the first that states a version counts."""
    stated = [F.nullif(v.cast("string"), F.lit("")) for v, _ in evidence]
    source = reduce(lambda out, piece: out.when(piece[0].isNotNull(), piece[1]), zip(stated, [how for _, how in evidence], strict=True), F.when(F.lit(False), UNKNOWN))
    return F.coalesce(*stated), source.otherwise(UNKNOWN)


def reference_evidence(explicit: Column, declared: Column, by_address: Column, source: Column) -> tuple[Column, Column]:
    """A reference export's version: given, declared beside it, of its address, supposed or unknown."""
    return first_stated([
        (explicit, "explicit"), (declared, "provenance_file"), (by_address, "reference_config"),
        (_looked_up(registry.CONFIG_VERSIONS, source), "reference_config"), (_looked_up(registry.MANUAL_VERSIONS, source), "manual_default"),
    ])


def _looked_up(table: Mapping[str, str | None], key: Column) -> Column:
    cells = [F.lit(x) for k, v in table.items() if v is not None for x in (k, v)]
    return F.try_element_at(F.create_map(*cells), key) if cells else F.lit(None).cast("string")


def candidate_space(dataset: Column, stay_source: Column) -> Column:
    """The identifier space of a wide table's stays."""
    key = F.lower(dataset)
    return F.when(stay_source == "raw_table", _looked_up(registry.RAW_STAY_SPACES, key)).otherwise(_looked_up(registry.EVENT_STAY_SPACES, key))


def stay_basis(mine: Column, theirs: Column, has_crosswalk: Column) -> Column:
    """How stays of both sides can be matched."""
    return F.when(has_crosswalk, _CROSSWALK).when(mine == theirs, _DIRECT).otherwise(_NONE)


def relationship(n_candidate: Column, n_reference: Column, n_shared: Column, comparable: Column) -> Column:
    """How two sets relate, by their sizes and that of their intersection."""
    out = F.when(~comparable | (F.coalesce(n_shared, F.lit(0)) == 0), "not_directly_comparable")
    for (mine, theirs), name in RELATIONSHIPS.items():
        out = out.when(((n_shared == n_candidate) == mine) & ((n_shared == n_reference) == theirs), name)
    return out


def validation_level(comparable: Column, verified: Column, same: Column) -> Column:
    out = None
    for (c, v, s), name in LEVELS.items():
        met = (comparable == c) & (verified == v) & (same == s)
        out = F.when(met, name) if out is None else out.when(met, name)
    return out


def assess(pairs: DataFrame) -> DataFrame:
    """`pairs` (with the columns of PAIR) and what each allows: same_version, versions_verified, spaces, basis, assumption, level, scope, confidence and relationship.

    A missing crosswalk flag counts as none, missing sizes as nothing shared.
    """
    require_columns(pairs, PAIR, "a table of comparisons")
    c = F.col
    stated = lambda side: F.coalesce(c(f"{side}_version_source").isin(*STATED), F.lit(False)) & c(f"{side}_version").isNotNull()
    out = pairs.withColumns({
        "same_version": version_key(c("candidate_version")) == version_key(c("reference_version")),
        "versions_verified": stated("candidate") & stated("reference"),
        "candidate_stay_id_space": candidate_space(c("candidate_dataset"), c("candidate_stay_source")),
        "reference_stay_id_space": _looked_up(registry.REFERENCE_STAY_SPACES, c("reference_source")),
    })
    out = out.withColumn("stay_comparison_basis", stay_basis(c("candidate_stay_id_space"), c("reference_stay_id_space"), F.coalesce(c("has_crosswalk"), F.lit(False))))
    basis, same = c("stay_comparison_basis"), F.coalesce(c("same_version"), F.lit(False))
    both, matchable = c("versions_verified") & same, basis != _NONE
    comparable = matchable & (F.coalesce(c("n_shared"), F.lit(0)) > 0)
    level = validation_level(comparable, c("versions_verified"), same)
    full = both & (basis == _DIRECT)
    assumption = F.when(basis == _NONE, "not_applicable").when(basis == _CROSSWALK, "crosswalk").when(both, "same_verified_version").otherwise("unverified_cross_version_stability")
    return out.withColumns({
        "stay_id_version_assumption": assumption,
        "validation_level": F.when(comparable & both & ~full, "shared_subset_stay_crosswalk").otherwise(level),
        "comparison_scope": F.when(full, "full").otherwise("shared_subset"),
        "stay_comparison_confidence": F.when(~matchable, "not_comparable").when(full, "high").otherwise("medium"),
        "stay_relationship": relationship(c("n_candidate"), c("n_reference"), c("n_shared"), matchable),
    })
