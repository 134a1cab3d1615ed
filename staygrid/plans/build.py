"""Building wide tables from concept tables on disk: chosen variables, or every concept there is.

All concept tables are narrowed and put on top of each other first, then joined with the stays
once and aggregated in one grouping, whatever their number; paths, versions and policies are
settled on the driver before.
"""

from __future__ import annotations

import warnings
from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce
from os import PathLike

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from staygrid import registry
from staygrid.functions.aggregates import in_range
from staygrid.operators import grid as grids
from staygrid.operators import mapping, wide
from staygrid.operators.validate import trace_concept
from staygrid.plans.identifiers import candidate_space
from staygrid.plans.versions import DatasetVersion, provenance_fields, resolve_candidate
from staygrid.schemas import DATETIME_STAYS, link_column
from staygrid.session import use_utc
from staygrid.sources import events as ev
from staygrid.sources import commits, layout, sinks
from staygrid.sources import stays as st
from staygrid.sources.concept_dict import ConceptDict
from staygrid.sources.config import BuildConfig, load_config
from staygrid.sources.place import Place

CASE_HINT = "Events need the case to find their stay; keep case_id as an extension column of the concept step."


@dataclass(frozen=True)
class Stays:
    """Stays in hours or with timestamps, where they come from, and their dataset's spec."""

    table: DataFrame | None
    source: str = "unknown"
    spec: registry.StaySpec | None = None
    notes: Mapping[str, object] | None = None

    @property
    def in_hours(self) -> bool:
        return self.table is not None and "intime_hours" in self.table.columns


@dataclass(frozen=True)
class Export:
    """A written wide table."""

    path: Place
    version: DatasetVersion
    summary: DataFrame
    manifest: Place | None = None


def event_stays(spark: SparkSession, dataset: str, workspace: str | PathLike, version: str | None = None) -> DataFrame:
    """Stays rebuilt from a dataset's extraction events."""
    key = dataset.lower()
    read = lambda name: spark.read.parquet(str(layout.find_step_file(workspace, "sic" if key.startswith("sic") else key, name, version=version)))
    if key == "aumc":
        return st.stays_from_visits(read("VISIT_START.parquet"), read("VISIT_END.parquet"))
    if key not in registry.EVENT_STAYS:
        raise ValueError(f"no stays can be built from events of {dataset!r}")
    return st.stays_from_observations(read("ICU_ADMISSION.parquet"), read("OBSERVATION.parquet"), "case_id" if key.startswith("sic") else "subject_id")


def resolve_stays(
    spark: SparkSession, dataset: str, workspace: str | PathLike, explicit: str | PathLike | None, version: str | None, tables: list[DataFrame], timestamps: bool = False,
) -> Stays:
    """A dataset's stays: from events where that is its rule and no table is given, else from a raw table.

    `timestamps`: a given table that has the columns for it keeps its times of admission and
    discharge, so that hours are counted in whole seconds and stays without an end have hour 0 alone.
    """
    spec = registry.stay_spec(dataset)
    if explicit is None and dataset.lower() in registry.EVENT_STAYS:
        if dataset.lower().startswith("sic") and any("case_id" not in t.columns for t in tables):
            raise ValueError(CASE_HINT)
        return Stays(event_stays(spark, dataset, workspace, version), "events", spec)
    found = layout.resolve_stay_table(dataset, explicit, version)
    if found is None:
        return Stays(None, "unknown", spec)
    layout.require_raw_table(dataset)
    table = st.read_table(spark, str(found.path))
    timed = timestamps and explicit is not None and set(DATETIME_STAYS) <= set(table.columns)
    return Stays(st.datetime_stays(table) if timed else st.normalized_stays(table, spec), "raw_table", spec, found.fields())


def mapped_events(concepts: Mapping[str, DataFrame], stays: Stays, dataset: str, version: str | None = None, window: bool = True) -> DataFrame:
    """Events of all concepts (concept, stay_id, time, at, numeric_value) in stays, by whichever way the stays and the dataset allow.

    Tables that are mapped in one way go through one join with the stays: those with no link
    column, and those with each kind of one.
    """
    scale = stays.spec.hours_per_unit if stays.spec else 1.0
    if stays.table is None:
        layout.require_event_stays(dataset)
    narrow: dict[str | None, list[DataFrame]] = {}
    for name, table in concepts.items():
        rows = table.withColumn("concept", F.lit(name))
        if stays.table is None and stays.spec is not None and stays.spec.subject_is_stay and "stay_id" not in table.columns:
            narrow.setdefault("identity", []).append(ev.subject_events_in_hours(rows, scale, version).select("concept", "subject_id", "time_hours", "numeric_value"))
        elif stays.table is None:
            narrow.setdefault("stay", []).append(ev.stay_events(rows, version))
        elif stays.in_hours:
            link = link_column(table.columns)
            narrow.setdefault(link, []).append(ev.subject_events_in_hours(rows, scale, version).select("concept", "subject_id", "time_hours", "numeric_value", *([link] if link else [])))
        else:
            narrow.setdefault("time", []).append(ev.subject_events(rows, version))
    raw = window and stays.source == "raw_table" and {"time", None} & set(narrow)  # a table as it lies: cheap to ask
    bins = mapping.BIN_HOURS if raw and mapping.crowded(stays.table) else None
    ways = {"identity": mapping.map_identity, "stay": lambda rows: rows, "time": lambda rows: mapping.map_by_time(rows, stays.table, window=window, bins=bins)}
    by_hours = lambda rows: mapping.map_by_hours(rows, stays.table, window=window, bins=bins)
    parts = [ways.get(way, by_hours)(reduce(DataFrame.unionByName, tables)) for way, tables in narrow.items()]
    at = lambda df: F.unix_micros(F.col("at").cast("timestamp")) if dict(df.dtypes)["at"] == "timestamp_ntz" else F.col("at")
    return reduce(DataFrame.unionByName, [p.select("concept", "stay_id", "time", at(p).cast("double").alias("at"), "numeric_value") for p in parts])


def _gridded(table: DataFrame, stays: Stays, include: bool, max_hours: int | None, rounding: str) -> DataFrame:
    if include:
        if stays.table is None:
            raise ValueError("a grid needs stays")
        lines = grids.grid_from_hours(stays.table, max_hours) if stays.in_hours else grids.grid_from_times(stays.table, max_hours, rounding)
        return wide.on_grid(table, lines)
    return table if max_hours is None else table.where(F.col("time") <= max_hours)


def build_variables(
    concepts: Mapping[str, DataFrame], stays: Stays, dataset: str, metadata: ConceptDict | None = None, *, aggregation: str = "dictionary", version: str | None = None,
    window: bool = True, grid: bool = False, max_hours: int | None = 168, rounding: str = "floor", sort: bool = True,
) -> DataFrame:
    """Wide table of chosen variables (variable -> concept table), range-filtered.

    aggregation 'mean' takes means; 'dictionary' what the dictionary says, else medians.
    """
    if aggregation not in ("mean", "dictionary"):
        raise ValueError("aggregation is 'mean' or 'dictionary'")
    if not concepts:
        raise ValueError("none of the variables has a concept table")
    metadata = metadata or ConceptDict()
    bounds = {v: dict(zip(("low", "high"), metadata.bounds(v), strict=True)) for v in concepts}
    names = {v: "mean" if aggregation == "mean" else metadata.aggregate(v, "median") for v in concepts}
    rows = mapped_events({v: t.where(in_range(**bounds[v])) for v, t in concepts.items()}, stays, dataset, version, window)
    return wide.ordered(_gridded(wide.wide_table(rows, names), stays, grid, max_hours, rounding), list(concepts), sort)


def build_all(concepts: Mapping[str, DataFrame], stays: Stays, dataset: str, metadata: ConceptDict | None = None, *, version: str | None = None, grid: bool = True, max_hours: int | None = None, grid_without_end: bool = False, sort: bool = True) -> DataFrame:
    """Wide table of every concept (name -> table), without a range filter; concepts without values keep a column.

    Means, or what the dictionary says for datasets that use it. A dataset whose stay table has
    no end gets a grid only with `max_hours`, or with `grid_without_end`.
    """
    if not concepts:
        raise FileNotFoundError(f"no concept tables of {dataset!r}")
    variables = {folder: v for v, folder in (registry.DYNAMIC_CONCEPTS | registry.DURATION_CONCEPTS).items()}
    use = metadata is not None and registry.uses_metadata(dataset)
    names = {c: metadata.aggregate(variables[c], "mean") if use and c in variables else "mean" for c in concepts}
    rows = mapped_events(concepts, stays, dataset, version)
    out = wide.wide_table(rows if max_hours is None else rows.where(F.col("time") <= max_hours), names)
    known_end = stays.spec is None or stays.spec.end is not None or max_hours is not None or grid_without_end
    return wide.ordered(_gridded(out, stays, grid and stays.table is not None and known_end, max_hours, "floor"), list(concepts), sort)


def _tables(spark: SparkSession, paths: Mapping[str, Place]) -> dict[str, DataFrame]:
    return {name: spark.read.parquet(str(path)) for name, path in paths.items()}


def wide_path(root: str | PathLike, max_hours: int | None) -> Place:
    return Place(root) / ("wide_dyn_all.parquet" if max_hours is None else f"wide_dyn_{max_hours}h.parquet")


def _written(table: DataFrame, target: str | PathLike, notes: dict[str, object], buckets: int | None) -> tuple[Place, DataFrame]:
    """Write a table, and tell of it what was seen meanwhile: its rows and hours; only its stays are read again, for their number."""
    seen = Observation("written")
    rows = table.observe(seen, F.count(F.lit(1)).alias("n_rows"), F.min("time").alias("min_time"), F.max("time").alias("max_time"))
    path = sinks.write_table(rows, target, notes, buckets)
    told = seen.get
    stays = commits.read_table(table.sparkSession, path).agg(F.lit("candidate").alias("table"), F.lit(told["n_rows"]).cast("long").alias("n_rows"), F.countDistinct("stay_id").alias("n_stays"))
    return path, stays.withColumns({c: F.lit(told[c]).cast("long") for c in ("min_time", "max_time")})


def write_variables(spark: SparkSession, config: BuildConfig, output: str | PathLike | None = None, stays: Stays | None = None) -> Export:
    """Build the configured variables and write them with provenance."""
    use_utc(spark)
    target = output or config.output
    if target is None:
        raise ValueError("no output path is given")
    variables, names = config.variables or list(registry.DYNAMIC_CONCEPTS), config.mapping or registry.DYNAMIC_CONCEPTS
    paths = layout.mapped_concepts(config.concept_root, config.dataset, config.version, variables, names)
    lacking = [v for v in variables if v not in paths]
    if lacking and config.missing == "fail":
        raise FileNotFoundError(f"no concept tables for {lacking}")
    if lacking and config.missing == "warn":
        warnings.warn(f"no concept tables for {lacking}", stacklevel=2)
    tables = _tables(spark, paths)
    workspace = config.concept_root.parent
    version = resolve_candidate(config.dataset, list(tables.values()), workspace, config.dataset_version)
    stays = stays or resolve_stays(spark, config.dataset, workspace, config.stay_table, version.version, list(tables.values()), timestamps=True)
    table = build_variables(
        tables, stays, config.dataset, ConceptDict.read(config.concept_dict), aggregation=config.aggregation, version=version.version, window=config.window,
        grid=config.grid, max_hours=config.max_hours, rounding=config.rounding, sort=config.sort and not config.buckets,
    )
    notes = provenance_fields(version, max_hours=config.max_hours, stay_source=stays.source, stay_id_space=candidate_space(config.dataset, stays.source), **(stays.notes or {}))
    path, summary = _written(table, target, notes, config.buckets)
    return Export(path, version, summary)


def run_config(spark: SparkSession, path: str | PathLike, output: str | PathLike | None = None) -> Export:
    return write_variables(spark, load_config(path), output)


def write_all(
    spark: SparkSession, dataset: str, workspace: str | PathLike, *, concept_root: str | PathLike | None = None, stay_table: str | PathLike | None = None, max_hours: int | None = None,
    grid: bool = True, name: str | None = None, output_root: str | PathLike | None = None, concept_dict: str | PathLike | None = None, dataset_version: str | None = None,
    buckets: int | None = None,
) -> Export:
    """Build every concept there is and write it with provenance and a manifest of its sources.

    `buckets`: stays lie in so many files, sorted inside, instead of rows sorted over all files.
    """
    use_utc(spark)
    home = layout.workspace_of(workspace)
    root = Place(concept_root) if concept_root else layout.concept_root_of(workspace)
    found = layout.discover_concepts(root, dataset)
    tables = _tables(spark, {c.name: c.path for c in found})
    version = resolve_candidate(dataset, list(tables.values()), root.parent, dataset_version)
    stays = resolve_stays(spark, dataset, home, stay_table, version.version, list(tables.values()))
    metadata = ConceptDict.read(concept_dict) if concept_dict else None
    table = build_all(tables, stays, dataset, metadata, version=version.version, grid=grid, max_hours=max_hours, sort=not buckets)
    folder = Place(output_root) if output_root else layout.output_root_of(workspace) / dataset
    path = folder / (name or ("all_concepts_wide.parquet" if max_hours is None else f"all_concepts_wide_{max_hours}h.parquet"))
    notes = provenance_fields(version, max_hours=max_hours, stay_source=stays.source, stay_id_space=candidate_space(dataset, stays.source), **(stays.notes or {}))
    _, summary = _written(table, path, notes, buckets)
    rows = [(c.name, c.version, version.version, version.source, str(c.path)) for c in found]
    manifest = spark.createDataFrame(rows, "concept string, concept_version string, dataset_version string, dataset_version_source string, source_parquet string")
    listed = sinks.write_report(manifest, folder, f"{path.stem}_concepts")
    return Export(path, version, summary, listed)


def debug_concept(
    spark: SparkSession, concept: str, output: str | PathLike, concept_root: str | PathLike, stay_table: str | PathLike, metadata: ConceptDict | None = None, *, dataset: str = "mimic-iv",
    version: str | None = "1.0.0", mapping: Mapping[str, str] = registry.DYNAMIC_CONCEPTS, aggregation: str = "mean", window: bool = True,
) -> dict[str, object]:
    """Trace one variable from its concept table to a written wide table, as `validate.trace_concept` does."""
    use_utc(spark)
    if concept not in mapping:
        raise KeyError(f"no concept folder is known for {concept!r}")
    path = layout.find_concept(concept_root, mapping[concept], dataset, version)
    if path is None:
        raise FileNotFoundError(f"no concept table of {concept!r} ({mapping[concept]})")
    raw, stays = ev.subject_events(ev.read_concept(spark, str(path))), st.datetime_stays(st.read_table(spark, str(Place(stay_table))))
    wide_ = commits.read_table(spark, output)
    traced = trace_concept(raw, stays, wide_, concept, aggregation, (metadata or ConceptDict()).bounds(concept), window)
    return {"concept": concept, "concept_folder": mapping[concept], "concept_table": str(path), **traced}
