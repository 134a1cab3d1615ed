"""Default places of a dataset's files: arguments first, then the environment, then defaults."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass
from os import PathLike

from staygrid import registry
from staygrid.sources.place import Place


@dataclass(frozen=True)
class DatasetPaths:
    """Where a dataset's inputs and outputs are."""

    dataset: str
    output_root: Place
    concept_root: Place
    stay_table: Place | None
    concept_dict: Place | None
    reference: Place
    windows: Place


def default_paths(
    dataset: str, *, concept_root: str | PathLike | None = None, output_root: str | PathLike | None = None, stay_table: str | PathLike | None = None, concept_dict: str | PathLike | None = None,
    environment: Mapping[str, str] | None = None,
) -> DatasetPaths:
    """STAYGRID_OUTPUT_ROOT, STAYGRID_STAY_TABLE or STAYGRID_<DATASET>_STAYS, STAYGRID_CONCEPT_DICT; the concept root must be given."""
    env = os.environ if environment is None else environment
    if concept_root is None:
        raise ValueError("the concept root must be given")
    key = dataset.lower()
    source = registry.reference_source(key)

    def place(given: str | PathLike | None, *names: str) -> Place | None:
        value = given or next((env[n] for n in names if env.get(n)), None)
        return Place(value) if value else None

    out = place(output_root, "STAYGRID_OUTPUT_ROOT") or Place("~/output/staygrid")
    return DatasetPaths(
        key, out, Place(concept_root), place(stay_table, f"STAYGRID_{key.upper().replace('-', '_')}_STAYS", "STAYGRID_STAY_TABLE"),
        place(concept_dict, "STAYGRID_CONCEPT_DICT"), out / f"reference_dynamic_vars_{source}.parquet", out / f"reference_stay_windows_{source}.parquet",
    )
