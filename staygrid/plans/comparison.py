"""Comparing a candidate wide table with a reference: versions, scope, windows and all reports.

Unless versions are verified equal and ids share a space, metrics cover only what both sides
have, and what one side has alone is listed instead of scored. Ids that can't be matched yield
no report that joins on them.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from os import PathLike

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from staygrid import registry
from staygrid.operators import compare
from staygrid.operators.paired import Paired
from staygrid.plans import scope
from staygrid.plans.identifiers import StayIds, load_stay_crosswalk
from staygrid.plans.versions import UNKNOWN_PAIR, DatasetVersion, VersionPair, resolve_reference, scope_label, versions_equal
from staygrid.schemas import KEYS
from staygrid.session import use_clusters, use_utc
from staygrid.sources import commits, sinks
from staygrid.sources import reference as ref
from staygrid.sources.place import Place


#: Reports of up to a row for each stay.
PER_STAY = frozenset({"per_stay_reproduction", "window_differences", "scope_differences"})


@dataclass(frozen=True)
class Comparison:
    """Claims of a comparison, and its reports by name (those without meaning are absent)."""

    claims: dict[str, object]
    reports: dict[str, DataFrame] = field(default_factory=dict)
    reference: DataFrame | None = None
    windows: DataFrame | None = None
    held: tuple[DataFrame, ...] = ()

    def release(self) -> None:
        """Let go of what the reports share; they can still be read, from the tables again."""
        for df in self.held:
            df.unpersist()


def _row(spark: SparkSession, values: dict[str, object]) -> DataFrame:
    kinds = {bool: "boolean", int: "long"}
    schema = ", ".join(f"`{k}` {kinds.get(type(v), 'string')}" for k, v in values.items())
    return spark.createDataFrame([tuple(values.values())], schema)


def compare_tables(
    candidate: DataFrame, reference: DataFrame, windows: DataFrame, concepts: Sequence[str], *, max_hours: int | None = 168, versions: VersionPair = UNKNOWN_PAIR,
    stay_ids: StayIds | None = None, unit: str | None = None, paths: tuple[str, str] = ("", ""),
) -> Comparison:
    """All reports for a candidate and a reference as they were read."""
    spark, stay_ids = use_utc(candidate.sparkSession), stay_ids or StayIds(None, None)
    mine = ref.comparable_types(candidate, concepts)
    if max_hours is not None:
        mine = mine.where(F.col("time") <= max_hours)
    spans = ref.reference_windows(windows, max_hours, unit)
    theirs = ref.reference_wide(reference, spans, [c for c in concepts if c in reference.columns], unit)
    spans, unmapped = stay_ids.translate(spans)
    theirs, _ = stay_ids.translate(theirs)
    theirs = ref.comparable_types(theirs, concepts)
    # a dozen reports read these: they are worked out once, spill to disk and go with the session or `release`
    mine, theirs, spans = (df.persist(StorageLevel.MEMORY_AND_DISK) for df in (mine, theirs, spans))
    kept: list[DataFrame] = [mine, theirs, spans]
    ended = spans.where("reference_end is not null").select("stay_id").distinct()

    # the two tables are joined once for everything below
    pairs = Paired.of(mine, theirs, concepts).held()
    kept.append(pairs.rows)
    # stays are compared by windows that end, keys and concepts by rows
    overlap = scope._dimension("stays", mine.select("stay_id"), ended, stay_ids.matchable).unionByName(scope.named_concepts(mine, theirs, concepts))
    overlap = overlap.unionByName(scope.sized("stay_time_keys", pairs.overlap(KEYS), stay_ids.matchable))
    named = ended.select("stay_id", *[F.lit(None).cast("float").alias(c) for c in concepts if c in theirs.columns])
    differences = scope.scope_differences(mine, named, concepts, stay_ids.matchable, unmapped)
    claims = scope.claims(versions, stay_ids, overlap, unmapped.count())
    facts = {**versions.fields(), **claims, "max_hours": max_hours, "candidate_path": paths[0], "reference_path": paths[1]}
    reports = {"provenance": _row(spark, facts), "scope_overlap": overlap, "scope_differences": differences}
    if stay_ids.matchable:
        joined = compare.joined_windows(compare.stay_windows(mine, "candidate"), spans)
        reports |= {"window_differences": compare.window_differences(joined), "window_summary": compare.window_summary(joined)}
    header = {k: facts[k] for k in ("candidate_dataset_version", "reference_dataset_version", "same_version", "versions_verified", *claims)}
    if claims["validation_level"] == "not_comparable":
        return Comparison(claims, reports | {"reproduction_accuracy": _row(spark, header)}, theirs, spans, tuple(kept))
    full = claims["comparison_scope"] == "full"
    chosen = ended if full else ended.join(mine.select("stay_id").distinct(), "stay_id", "left_semi")
    scored = [c for c in concepts if full or c in mine.columns and c in theirs.columns]
    a, b = (df.join(chosen, "stay_id", "left_semi").select(*KEYS, *[c for c in scored if c in df.columns]) for df in (mine, theirs))
    pairs = pairs.within(chosen)
    per_stay = pairs.per_stay().persist(StorageLevel.MEMORY_AND_DISK)
    kept.append(per_stay)
    scores = compare.reproduction_accuracy(per_stay)
    kinds = dict(_row(spark, header).dtypes)
    accuracy = scores.select(*[F.lit(v).cast(kinds[k]).alias(k) for k, v in header.items()], *scores.columns)
    reports |= {
        "per_stay_reproduction": per_stay, "reproduction_accuracy": accuracy, "key_overlap": pairs.key_overlap(), "stay_overlap": pairs.stay_overlap(),
        "table_summary": compare.table_summary(a, "candidate").unionByName(compare.table_summary(b, "reference")), "coverage": compare.coverage(a, b),
        "missingness": pairs.missingness(), "value_diff": pairs.value_differences(),
    }
    return Comparison(claims, reports, theirs, spans, tuple(kept))


def reports_folder(root: str | PathLike, max_hours: int | None, label: str | None = None) -> Place:
    out = Place(root) / "reports" / ("all_hours" if max_hours is None else f"{max_hours}h")
    return out / label if label else out


def stay_ids_of(spark: SparkSession, candidate_path: str | PathLike, reference_path: str | PathLike, source: str | None = None, crosswalk: DataFrame | None = None) -> StayIds:
    """Spaces by the provenance of both sides; an unknown space equals nothing."""
    mine = sinks.read_provenance(spark, candidate_path) or {}
    theirs = sinks.read_provenance(spark, reference_path, verified=False) or {}
    space = registry.REFERENCE_STAY_SPACES.get(str(source or theirs.get("reference_source")))
    return StayIds(mine.get("stay_id_space"), space, load_stay_crosswalk(crosswalk) if crosswalk is not None else None)


def versions_of(spark: SparkSession, dataset: str, candidate_path: str | PathLike, reference_path: str | PathLike, candidate_version: str | None = None, reference_version: str | None = None) -> VersionPair:
    """Versions by provenance and arguments; ValueError where these contradict each other."""
    notes, source = sinks.read_provenance(spark, candidate_path), registry.reference_source(dataset)
    if notes is None:
        mine = DatasetVersion(dataset, candidate_version, "explicit" if candidate_version else "unknown")
    else:
        if registry.canonical(notes["dataset"]) != registry.canonical(dataset):
            raise ValueError(f"{candidate_path} is of {notes['dataset']!r}, not {dataset!r}")
        if versions_equal(notes["version"], candidate_version) is False:
            raise ValueError(f"{candidate_path} is of version {notes['version']!r}, not {candidate_version!r}")
        mine = DatasetVersion(*(notes.get(k) for k in ("dataset", "version", "source", "representation")))
    theirs = sinks.read_provenance(spark, reference_path, verified=False) or {}
    stated = theirs.get("reference_source")
    if stated and stated != source:
        raise ValueError(f"{reference_path} is of source {stated!r}, not {source!r}")
    declared = theirs.get("source_version_declared")
    if versions_equal(declared, reference_version) is False:
        raise ValueError(f"{reference_path} declares version {declared!r}, not {reference_version!r}")
    return VersionPair(mine, resolve_reference(source, reference_path, reference_version))


def compare_files(
    spark: SparkSession, dataset: str, candidate_path: str | PathLike, reference_path: str | PathLike, windows_path: str | PathLike, *, output_root: str | PathLike | None = None, max_hours: int | None = 168,
    concepts: Sequence[str] | None = None, candidate_version: str | None = None, reference_version: str | None = None, crosswalk: DataFrame | None = None, unit: str | None = None,
) -> tuple[Comparison, Place | None]:
    """Compare tables on disk; with `output_root` write a CSV of each report (of PER_STAY a folder) and the normalised reference."""
    versions = versions_of(spark, dataset, candidate_path, reference_path, candidate_version, reference_version)
    source = registry.reference_source(dataset)
    ids = stay_ids_of(spark, candidate_path, reference_path, source, crosswalk)
    read = lambda p: commits.read_table(use_clusters(spark), p)
    names = list(concepts or registry.DYNAMIC_CONCEPTS)
    result = compare_tables(read(candidate_path), read(reference_path), read(windows_path), names, max_hours=max_hours, versions=versions, stay_ids=ids, unit=unit, paths=(str(candidate_path), str(reference_path)))
    if output_root is None:
        return result, None
    folder = reports_folder(output_root, max_hours, scope_label(versions, source))
    for name, df in result.reports.items():
        (sinks.write_rows if name in PER_STAY else sinks.write_report)(df, folder, name)
    sinks.write_table(result.reference, folder / "reference_normalized.parquet", None)
    sinks.write_table(result.windows, folder / "windows_normalized.parquet", None)
    result.release()
    return result, folder


def overview(result: Comparison, n: int = 20) -> dict[str, DataFrame]:
    """The heads of the reports, the worst first and ties by name or stay."""
    worst = {"value_diff": [F.desc_nulls_first("mean_abs_diff"), "concept"], "per_stay_reproduction": [F.desc_nulls_first("row_count_absolute_relative_error"), "stay_id"], "coverage": [F.desc_nulls_first(F.abs("diff_non_null")), "concept"]}
    return {name: (df.orderBy(*worst[name]) if name in worst else df).limit(n) for name, df in result.reports.items()}


def write_plain_reports(candidate: DataFrame, reference: DataFrame, folder: str | PathLike) -> list[Place]:
    """Six reports of two wide tables as CSV, without versions, windows or scope."""
    pairs = Paired.of(candidate, reference).held()
    reports = {
        "table_summary": compare.table_summary(candidate, "candidate").unionByName(compare.table_summary(reference, "reference")),
        "key_overlap": pairs.key_overlap(), "stay_overlap": pairs.stay_overlap(), "coverage": compare.coverage(candidate, reference),
        "missingness": pairs.missingness(), "value_diff": pairs.value_differences(),
    }
    written = [sinks.write_report(df, folder, name) for name, df in reports.items()]
    pairs.rows.unpersist()
    return written
