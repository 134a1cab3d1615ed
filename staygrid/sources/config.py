"""YAML configuration of a build; relative paths are relative to the file."""

from __future__ import annotations

from dataclasses import dataclass
from os import PathLike

from staygrid.sources.place import Place


@dataclass(frozen=True)
class BuildConfig:
    """What a wide build needs; `max_hours` None: no limit; `sort`: the table's rows by key over all its files.

    `buckets`: instead, stays lie in so many files, sorted inside, so that comparisons join without an exchange.
    """

    concept_root: Place
    dataset: str = "mimic-iv"
    version: str | None = "1.0.0"
    dataset_version: str | None = None
    stay_table: Place | None = None
    concept_dict: Place | None = None
    variables: list[str] | None = None
    mapping: dict[str, str] | None = None
    units: dict | None = None
    aggregation: str = "dictionary"
    grid: bool = False
    max_hours: int | None = 168
    rounding: str = "floor"
    window: bool = True
    missing: str = "warn"
    output: Place | None = None
    sort: bool = True
    buckets: int | None = None


def _yaml(path: Place) -> dict:
    import yaml

    data = yaml.safe_load(path.read_text()) or {}
    if not isinstance(data, dict):
        raise ValueError(f"{path} isn't a mapping")
    return data


def _text(value: object) -> str | None:
    return None if value in (None, "", "null") else str(value)


def load_config(path: str | PathLike) -> BuildConfig:
    """Read a configuration; ValueError names what is wrong."""
    path = Place(path)
    data = _yaml(path)
    part = {k: data.get(k) or {} for k in ("concepts", "wide", "aggregation", "grid", "time", "output")}
    for name, value in part.items():
        if not isinstance(value, dict):
            raise ValueError(f"{name!r} isn't a mapping")

    def file(value: object) -> Place | None:
        text = _text(value)
        if text is None:
            return None
        return Place(text) if ":/" in text or text.startswith(("/", "~")) else Place(f"{path.parent}/{text}")

    root = file(part["concepts"].get("path"))
    if root is None:
        raise ValueError("concepts.path is missing")

    def listed(key: str) -> dict | list | None:
        source = file(part["wide"].get(key))
        return None if source is None else (found := _yaml(source)).get(key, found)

    variables, mapping, units = listed("dynamic_vars"), listed("concept_mapping"), listed("unit_mapping")
    if variables is not None and not (isinstance(variables, list) and all(isinstance(v, str) for v in variables)):
        raise ValueError("dynamic_vars isn't a list of names")
    if mapping is not None and not all(isinstance(v, str) for kv in mapping.items() for v in kv):
        raise ValueError("concept_mapping doesn't map names to names")
    buckets = part["output"].get("buckets")
    if buckets is not None and not (isinstance(buckets, int) and buckets > 0):
        raise ValueError("output.buckets isn't a number of files")
    hours = part["grid"].get("max_hours", 168)
    return BuildConfig(
        concept_root=root, dataset=str(part["concepts"].get("dataset", "mimic-iv")), version=_text(part["concepts"].get("version", "1.0.0")),
        dataset_version=_text(part["concepts"].get("dataset_version")), stay_table=file(data.get("stay_table")), concept_dict=file(data.get("concept_dict")),
        variables=variables, mapping=dict(mapping) if mapping is not None else None, units=units, aggregation=str(part["aggregation"].get("mode", "dictionary")),
        grid=bool(part["grid"].get("include", False)), max_hours=None if hours == -1 else hours, rounding=str(part["grid"].get("end_rounding", "floor")),
        window=bool(part["time"].get("filter_to_stay_window", True)), missing=str(data.get("missing_concepts", "warn")), output=file(part["output"].get("path")),
        sort=bool(part["output"].get("sort", True)), buckets=buckets,
    )
