"""Contracts of the tables that pass between operators, checked by column name."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame

SUBJECT_EVENTS = ("subject_id", "time", "numeric_value")
STAY_EVENTS = ("stay_id", "time", "numeric_value")
DATETIME_STAYS = ("subject_id", "hadm_id", "stay_id", "intime", "outtime")
HOUR_STAYS = ("subject_id", "stay_id", "intime_hours", "outtime_hours")
KEYS = ["stay_id", "time"]
VERSION_COLUMN = "dataset_version"
SOURCE_CODE_COLUMN = "source_code"
#: Columns that link an event to one stay, in order of preference.
LINK_COLUMNS = ("visit_occurrence_id", "case_id")


def require_columns(df: DataFrame, needed: Iterable[str], what: str, hint: str = "") -> DataFrame:
    """Raise ValueError that names what `df` lacks."""
    missing = sorted(set(needed) - set(df.columns))
    if missing:
        raise ValueError(f"{what} lacks columns {missing}. {hint}".strip())
    return df


def link_column(names: Iterable[str]) -> str | None:
    """The column that links events to stays, if there is one."""
    names = set(names)
    return next((c for c in LINK_COLUMNS if c in names), None)


def find_column(df: DataFrame, *names: str) -> str | None:
    """The first of `names` that `df` has, whatever its case; ValueError if two columns match one."""
    for name in names:
        found = [c for c in df.columns if c.lower() == name.lower()]
        if len(found) > 1:
            raise ValueError(f"columns {found} differ only in case")
        if found:
            return found[0]
    return None
