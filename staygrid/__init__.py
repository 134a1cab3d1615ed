"""Hourly wide tables from clinical event tables, and what they agree on with a reference."""

from staygrid.functions.aggregates import aggregate, in_range
from staygrid.functions.timeunits import floored_hours, hours_of, reference_hours, whole_hours_between
from staygrid.operators.compare import (
    coverage, joined_windows, key_overlap, missingness, normalize_reference, on_common_keys, per_stay_reproduction, reproduction_accuracy, schema_report, stay_overlap, stay_windows,
    table_summary, to_long, value_differences, values_only_in, window_differences, window_summary, worst_examples,
)
from staygrid.operators.grid import grid_from_hours, grid_from_times
from staygrid.operators.items import carry_over, defined_items, item_summary, match_items, observed_items
from staygrid.operators.mapping import map_by_hours, map_by_time, map_identity
from staygrid.operators.selection import column_medians, medians
from staygrid.operators.validate import against_stays, column_report, concept_coverage, range_report, recompute_concept, trace_concept
from staygrid.operators.wide import hourly, on_grid, ordered, wide_table
from staygrid.plans.build import build_all, build_variables, debug_concept, event_stays, mapped_events, resolve_stays, run_config, write_all, write_variables
from staygrid.plans.comparison import compare_files, compare_tables, overview, write_plain_reports
from staygrid.plans.identifiers import StayIds, load_stay_crosswalk
from staygrid.plans.paths import default_paths
from staygrid.plans.review import build_review, review_dataset, write_review
from staygrid.plans.versions import DatasetVersion, VersionPair, resolve_candidate, resolve_reference, scope_label, versions_equal
from staygrid.registry import canonical, known_dataset, reference_source, uses_metadata
from staygrid.session import build_session, use_utc
from staygrid.sources.concept_dict import ConceptDict
from staygrid.sources.config import BuildConfig, load_config
from staygrid.sources.events import of_version, read_concept, stay_events, subject_events, subject_events_in_hours
from staygrid.sources.layout import discover_concepts, find_concept, path_version, resolve_stay_table
from staygrid.sources.place import Place
from staygrid.sources.reference import comparable_types, reference_wide, reference_windows
from staygrid.sources.sinks import StaleProvenanceError, attach_provenance, read_provenance, write_report, write_table
from staygrid.sources.stays import datetime_stays, normalized_stays, stays_from_observations, stays_from_visits
from staygrid.streaming.hourly import hourly_stream

__all__ = [name for name in dir() if not name.startswith("_") and name not in ("functions", "operators", "plans", "session", "sources", "streaming", "registry", "schemas")]
