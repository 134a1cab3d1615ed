"""Writing tables with provenance that is bound to the data.

A table is written as a commit (`commits`): what is told of it is part of the manifest that names its
files, so both change in one step, and a crash leaves the old table with its provenance or the new one with its own.
A sidecar beside the table repeats it for other readers, with an id that is also in the metadata of the first
column, which Parquet keeps. It is removed before a commit and written after, so none describes older data.
"""

from __future__ import annotations

import json
from os import PathLike
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from staygrid.sources import commits
from staygrid.sources.place import Place

ID_KEY = "provenance_id"


class StaleProvenanceError(ValueError):
    """A table's provenance was told of other data than what is there."""


def provenance_path(data_path: str | PathLike) -> Place:
    return Place(data_path).with_suffix(".provenance.json")


def write_table(df: DataFrame, data_path: str | PathLike, provenance: dict[str, object] | None, buckets: int | None = None) -> Place:
    """Make `df` the content of a Parquet table, with its provenance if given.

    `buckets`: stays are dealt to so many files, sorted inside, for joins and groupings by stay without an exchange.
    """
    path, notes = Place(data_path), None
    if provenance is not None:
        notes, first = {**provenance, ID_KEY: uuid4().hex}, df.columns[0]
        df = df.withColumn(first, F.col(f"`{first}`").alias(first, metadata={ID_KEY: notes[ID_KEY]}))
    provenance_path(path).delete()
    commits.publish(df, path, notes, buckets)
    _tell(path, notes)
    return path


def _tell(path: Place, notes: dict[str, object] | None) -> None:
    if notes is not None:
        provenance_path(path).replace_text(json.dumps(notes, indent=2, default=str))


def attach_provenance(spark: SparkSession, data_path: str | PathLike, provenance: dict[str, object]) -> Place:
    """Provenance for a table as it lies, whoever wrote it: a commit over the same files, whose rows aren't read."""
    path, notes = Place(data_path), {**provenance, ID_KEY: uuid4().hex}
    provenance_path(path).delete()
    commits.annotate(spark, path, notes)
    _tell(path, notes)
    return provenance_path(path)


def read_provenance(spark: SparkSession, data_path: str | PathLike, verified: bool = True) -> dict | None:
    """A table's provenance: its manifest's, else that of a sidecar; None without either.

    `verified`: StaleProvenanceError unless the files are those that the manifest names, or a sidecar's id is the
    data's. References come from elsewhere and have no id.
    """
    sidecar, manifest = provenance_path(data_path), commits.manifest_of(data_path)
    if manifest is not None and manifest.notes is not None:
        if verified:
            try:
                commits.check(data_path, manifest)
            except commits.StaleTableError as e:
                raise StaleProvenanceError(f"{e}; build it again or attach its provenance anew") from e
        return dict(manifest.notes)
    if not sidecar.is_file():
        return None
    notes = json.loads(sidecar.read_text())
    if verified:
        fields = spark.read.parquet(str(data_path)).schema.fields if Place(data_path).exists() else []
        if not notes.get(ID_KEY) or not any((f.metadata or {}).get(ID_KEY) == notes[ID_KEY] for f in fields):
            raise StaleProvenanceError(f"{sidecar} doesn't belong to {data_path}; build it again or remove the sidecar")
    return notes


def write_rows(df: DataFrame, folder: str | PathLike, name: str) -> Place:
    """A report of any number of rows as a folder of CSV files with headers, written by the executors."""
    path = Place(folder) / f"{name}.csv"
    df.write.mode("overwrite").csv(str(path), header=True, escape='"')
    return path


def _kept(path: Place) -> Place:
    return path.with_name(f"_{path.name}.kept")


def restored_rows(folder: str | PathLike, name: str) -> Place:
    """Where the rows of a report are; those that a `replace_rows` which didn't end had put aside are put back."""
    path = Place(folder) / f"{name}.csv"
    if not path.exists() and _kept(path).exists():
        _kept(path).rename(path)
    return path


def replace_rows(df: DataFrame, folder: str | PathLike, name: str) -> Place:
    """As `write_rows`, where `df` may read what it replaces: that is put aside only once the new rows are written."""
    path = restored_rows(folder, name)
    fresh = path.with_name(f"_{path.name}.{uuid4().hex}")
    df.write.csv(str(fresh), header=True, escape='"')
    _kept(path).delete()
    if path.exists():
        path.rename(_kept(path))
    fresh.rename(path)
    _kept(path).delete()
    return path


def write_report(df: DataFrame, folder: str | PathLike, name: str) -> Place:
    """A report of few rows, which go through the driver, as one CSV file with a header."""
    path = Place(folder) / f"{name}.csv"
    text = df.toPandas().to_csv(index=False)  # before the file goes: the report may have been made from it
    path.delete()
    path.write_text(text)
    return path
