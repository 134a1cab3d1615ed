"""Item review: for each variable, which source items either side uses, for experts to judge."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from os import PathLike

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from staygrid import registry
from staygrid.operators import items
from staygrid.plans.versions import VersionPair, resolve_candidate, resolve_reference, scope_label
from staygrid.schemas import require_columns
from staygrid.sources import layout, sinks
from staygrid.sources.concept_dict import ConceptDict
from staygrid.sources.place import Place


@dataclass(frozen=True)
class Review:
    """One row for each item, and one for each variable."""

    items: DataFrame
    summary: DataFrame


def basis_of(dataset: str, source: str, crosswalk: DataFrame | None) -> str:
    """How items of the two sides can be matched."""
    if crosswalk is not None:
        return "crosswalk"
    mine = registry.ITEM_SPACES.get(dataset.lower())
    return "direct_identifier_match" if mine and mine == registry.REFERENCE_ITEM_SPACES.get(source) else "side_by_side_only"


def confidence_of(basis: str, versions: VersionPair) -> str:
    if basis == "side_by_side_only":
        return "not_comparable"
    return "high" if basis == "direct_identifier_match" and versions.full else "medium"


def build_review(
    spark: SparkSession, dataset: str, tables: Mapping[str, DataFrame], metadata: ConceptDict, versions: VersionPair, variables: Sequence[str], *,
    source: str | None = None, crosswalk: DataFrame | None = None, seen: DataFrame | None = None, folders: Mapping[str, str] = registry.DYNAMIC_CONCEPTS,
) -> Review:
    """The review of `variables` (variable -> concept table where there is one)."""
    source = source or registry.reference_source(dataset)
    basis = basis_of(dataset, source, crosswalk)
    pattern = registry.ITEM_PATTERN if dataset.lower() in registry.ITEM_SPACES else None
    for v, t in tables.items():
        require_columns(t, ("source_code",), f"the concept table of {v!r}")
    parts = [items.observed_items(t.withColumn("concept", F.lit(v)), versions.candidate.version, pattern) for v, t in tables.items()]
    empty = spark.createDataFrame([], "concept string, item_id string, id_parsed boolean, item_label string, item_table string, source_codes string, n_rows long")
    observed = reduce(DataFrame.unionByName, parts, empty)
    defined = items.defined_items(spark, metadata.concepts, variables, source)
    if seen is not None:
        require_columns(seen, ("concept", "item_id"), "the list of observed reference items")
        seen = seen if "n_rows" in seen.columns else seen.withColumn("n_rows", F.lit(None).cast("long"))
    matched = items.match_items(observed, defined, basis, crosswalk, seen)
    context = {
        **{k: v for k, v in versions.fields().items() if k not in ("candidate_dataset", "reference_dataset", "versions_verified")}, "dataset": dataset.lower(), "reference_source": f"reference:{source}",
        "comparison_basis": basis, "comparison_confidence": confidence_of(basis, versions), "item_set_basis": "candidate_observed_vs_reference_configured", "reference_observation_available": seen is not None,
    }
    fixed = {k: F.lit(v).cast("boolean" if isinstance(v, bool) or k == "same_version" else "string") for k, v in context.items()}
    blank = {c: F.lit("") for c in items.REVIEW_COLUMNS}
    names = spark.createDataFrame([(v, folders.get(v), v in tables) for v in variables], "concept string, concept_folder string, candidate_concept_found boolean")
    rows = matched.join(names, "concept").withColumns({**fixed, **blank})
    sizes = items.item_summary(matched)
    known = [c for c in sizes.columns if c.startswith("n_") and c not in ("n_candidate_configured_items", *([] if seen is not None else ["n_reference_observed_items", "n_reference_configured_not_observed"]))]
    counts = names.join(sizes, "concept", "left").fillna(0, known)
    n, a, b = F.col("_shared_ids"), F.col("_candidate_ids"), F.col("_reference_ids")
    ids = _id_counts(observed, defined, crosswalk if basis == "crosswalk" else None)
    counts = counts.join(ids, "concept", "left").fillna(0, ["_candidate_ids", "_reference_ids", "_shared_ids"])
    kind = F.when(n == 0, "not_directly_comparable").when((n == a) & (n == b), "equal").when(n == b, "candidate_superset").when(n == a, "reference_superset").otherwise("partial_overlap")
    counts = counts.withColumn("relationship", F.lit("not_directly_comparable") if basis == "side_by_side_only" else kind)
    counts = counts.withColumn("reference_concept_defined", F.col("n_reference_configured_items") > 0).drop("_candidate_ids", "_reference_ids", "_shared_ids")
    return Review(rows, counts.withColumns({**fixed, **blank}))


def _id_counts(observed: DataFrame, defined: DataFrame, crosswalk: DataFrame | None) -> DataFrame:
    """Distinct matchable ids of each concept: candidate, reference (in the candidate's space), shared."""
    a = observed.where("id_parsed").select("concept", "item_id").distinct().withColumn("_a", F.lit(True))
    b = defined.select("concept", "item_id").distinct()
    if crosswalk is not None:
        pairs = crosswalk.select(F.col("reference_item_id").cast("string").alias("item_id"), F.col("candidate_item_id").cast("string").alias("_c"))
        b = b.join(pairs, "item_id").select("concept", F.col("_c").alias("item_id")).distinct()
    joined = a.join(b.withColumn("_b", F.lit(True)), ["concept", "item_id"], "full")
    return joined.groupBy("concept").agg(F.count("_a").alias("_candidate_ids"), F.count("_b").alias("_reference_ids"), F.count_if(F.col("_a") & F.col("_b")).alias("_shared_ids"))


def write_review(spark: SparkSession, review: Review, folder: str | PathLike) -> tuple[Place, Place]:
    """Items as a folder of CSV files, written by the executors, and one CSV file of a row for each variable.

    Codes without an identifier are items of their own, so there may be as many as codes: they never pass
    the driver. Both keep the reviewer's entries of what they replace, one file or a folder of them.
    """
    entries = {"item_review": (review.items, ["concept", "side", "item_id"]), "item_review_summary": (review.summary, ["concept"])}
    out = []
    for name, (df, keys) in entries.items():
        path = sinks.restored_rows(folder, name)
        if path.exists():
            old = spark.read.csv(str(path), header=True, multiLine=True, escape='"')  # a file is one task's
            df = items.carry_over(df, old.withColumn("_line", F.struct("_metadata.file_name", F.monotonically_increasing_id())), keys, "_line")
        out.append(sinks.replace_rows(df, folder, name) if name == "item_review" else sinks.write_report(df, folder, name))
    return out[0], out[1]


def review_dataset(
    spark: SparkSession, dataset: str, concept_root: str | PathLike, concept_dict: str | PathLike, output_root: str | PathLike, *, variables: Sequence[str] | None = None, concept_version: str | None = "1.0.0",
    dataset_version: str | None = None, reference_version: str | None = None, reference_path: str | PathLike | None = None, crosswalk: DataFrame | None = None, seen: DataFrame | None = None,
) -> tuple[Review, Place, Place]:
    """Settle versions, build the review of a dataset's concept tables, and write it."""
    chosen, source = list(variables or registry.DYNAMIC_CONCEPTS), registry.reference_source(dataset)
    paths = layout.mapped_concepts(concept_root, dataset, concept_version, chosen, registry.DYNAMIC_CONCEPTS)
    tables = {v: spark.read.parquet(str(p)) for v, p in paths.items()}
    mine = resolve_candidate(dataset, list(tables.values()), Place(concept_root).parent, dataset_version)
    versions = VersionPair(mine, resolve_reference(source, reference_path, reference_version))
    review = build_review(spark, dataset, tables, ConceptDict.read(concept_dict), versions, chosen, source=source, crosswalk=crosswalk, seen=seen)
    files = write_review(spark, review, Place(output_root) / "item_review" / scope_label(versions, source))
    return review, *files
