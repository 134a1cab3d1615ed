"""Tables whose content changes in one step: staged files, a manifest, and one pointer that is swapped.

A table is a folder of Parquet files, which any reader takes. Beside them lies `_manifest.json`, hidden from
readers as its name says: the files that are the table, with their sizes and rows, what is told of them
(provenance), and how rows are laid out. Publishing

1. stages new files in a hidden folder inside the table's, where a failed job leaves nothing that counts;
2. moves them beside the table's files, under names that begin with the commit's id;
3. swaps the manifest: a new file takes its name in one step of the store. Until then the table is what
   it was, from then on what is new;
4. removes the files of the commit before.

Nothing that a manifest names is ever moved or changed, so a run that dies between any two steps leaves
one whole table: `read_table` reads just what the manifest names, and the next commit (or `recover`) removes
what was left over. A manifest with other notes over the same files is a commit too (`annotate`): attaching
provenance moves no data. Two commits at once: the one that finds another manifest than it began with fails.

On stores without a rename in one step (object stores), the manifest is put in one request instead, and
moving files is the store's copying.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from os import PathLike
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from staygrid.schemas import KEYS
from staygrid.sources.place import Place

MANIFEST = "_manifest.json"
#: Files that are moved or removed one after another.
FEW = 32


class StaleTableError(ValueError):
    """A table's files aren't those that its manifest names."""


class ConcurrentCommitError(RuntimeError):
    """Another commit came first."""


@dataclass(frozen=True)
class Manifest:
    """The files of a table by name, each with its size and rows (-1: not counted), and what is told of them.

    replaced: files without a commit's id in their names, which others wrote and this commit replaces.
    """

    id: str
    files: Mapping[str, tuple[int, int]]
    notes: Mapping[str, object] | None = None
    buckets: int | None = None
    keys: tuple[str, ...] = ()
    replaced: tuple[str, ...] = ()

    @property
    def rows(self) -> int:
        return sum(rows for _, rows in self.files.values())

    def text(self) -> str:
        return json.dumps({"id": self.id, "notes": self.notes, "buckets": self.buckets, "keys": self.keys, "replaced": self.replaced, "files": self.files}, indent=1, default=str)


def manifest_of(path: str | PathLike) -> Manifest | None:
    """The manifest of the last commit; None for tables that others wrote."""
    file = Place(path) / MANIFEST
    if not file.is_file():
        return None
    told = json.loads(file.read_text())
    return Manifest(told["id"], {name: tuple(facts) for name, facts in told["files"].items()}, told["notes"], told["buckets"], tuple(told["keys"]), tuple(told["replaced"]))


def _data_files(path: Place) -> dict[str, int]:
    """Names and sizes of the files that a reader of the folder would take."""
    return {p.name: size for p, size in path.files() if not p.name.startswith(("_", "."))}


def _of_a_commit(name: str) -> bool:
    return len(name) > 33 and name[32] == "-" and set(name[:32]) <= set("0123456789abcdef")


def _left_over(name: str, manifest: Manifest) -> bool:
    """True for a file of another commit than the last one: either unfinished, or replaced and not removed yet."""
    return name not in manifest.files and (_of_a_commit(name) or name in manifest.replaced)


def check(path: str | PathLike, manifest: Manifest) -> bool:
    """StaleTableError unless the folder holds the manifest's files, of these sizes, and no others but left-over ones; true without such."""
    found = _data_files(Place(path))
    wrong = [n for n, (size, _) in manifest.files.items() if found.get(n) != size] + [n for n in found if n not in manifest.files and not _left_over(n, manifest)]
    if wrong:
        raise StaleTableError(f"{path} was changed since its last commit: {sorted(wrong)[:5]}")
    return len(found) == len(manifest.files)


def read_table(spark: SparkSession, path: str | PathLike) -> DataFrame:
    """The table's last commit; a table without a manifest as it lies. StaleTableError if others changed it since.

    A table in buckets is read as such, by an external table of the session's catalog under the commit's id:
    joins and groupings by its first key then need no exchange (see `session.use_clusters`).
    """
    manifest, path = manifest_of(path), Place(path)
    if manifest is None:
        return spark.read.parquet(str(path))
    clean = check(path, manifest)
    if not manifest.buckets:
        return spark.read.parquet(str(path)) if clean else spark.read.parquet(*[str(path / n) for n in manifest.files])
    if not clean:
        recover(path)
    name = f"staygrid_{manifest.id}"
    quoted = lambda c: "`" + c.replace("`", "``") + "`"
    columns = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in spark.read.parquet(str(path)).schema)
    keys = ", ".join(map(quoted, manifest.keys))
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet CLUSTERED BY ({quoted(manifest.keys[0])}) SORTED BY ({keys}) INTO {manifest.buckets} BUCKETS LOCATION '{path}'")
    return spark.table(name)


def verify(spark: SparkSession, path: str | PathLike) -> DataFrame:
    """file, size, rows, found_size, found_rows and intact for each file of the table; executors read the footers."""
    manifest = manifest_of(path)
    if manifest is None:
        raise StaleTableError(f"{path} has no manifest")
    named = spark.createDataFrame([(n, *facts) for n, facts in manifest.files.items()], "file string, size long, rows long")
    found = _facts(spark, Place(path), _data_files(Place(path)))
    seen = spark.createDataFrame([(n, *facts) for n, facts in found.items() if not _left_over(n, manifest)], "file string, found_size long, found_rows long")
    return named.join(seen, "file", "full").withColumn("intact", F.col("size").eqNullSafe(F.col("found_size")) & F.col("rows").eqNullSafe(F.col("found_rows")))


def _facts(spark: SparkSession, folder: Place, sizes: Mapping[str, int]) -> dict[str, tuple[int, int]]:
    """Sizes and rows of files: counting rows without a column reads footers alone, a task for some files each."""
    if not sizes:
        return {}
    at = F.col("_metadata.file_name")
    counted = spark.read.parquet(*[str(folder / n) for n in sizes]).groupBy(at.alias("name")).agg(F.count("*").alias("n")).collect()
    rows = {r["name"]: r["n"] for r in counted}
    return {n: (size, rows.get(n, 0)) for n, size in sizes.items()}


def _each(act: Callable[[str], None], names: Iterable[str]) -> None:
    """One change of the store for each name; many go side by side, as each waits for the store."""
    names = list(names)
    if len(names) <= FEW:
        for name in names:
            act(name)
        return
    with ThreadPoolExecutor(16) as pool:
        list(pool.map(act, names))


class Commit:
    """One commit to a table, step by step; `publish` takes all of them."""

    def __init__(self, spark: SparkSession, path: str | PathLike):
        self.spark, self.path, self.id = spark, Place(path), uuid4().hex
        self.before = manifest_of(path)
        self.staged = self.path / f"_staged-{self.id}"
        self.files: dict[str, tuple[int, int]] = {}
        self.buckets: int | None = None
        self.keys: tuple[str, ...] = ()

    def adopt(self) -> None:
        """A table that others wrote gets a manifest, so that it stays what it is until the swap."""
        if self.before is None and (old := _data_files(self.path) if self.path.is_dir() else {}):
            self.before = Manifest(uuid4().hex, {n: (size, -1) for n, size in old.items()})
            (self.path / MANIFEST).replace_text(self.before.text())

    def stage(self, df: DataFrame, buckets: int | None = None, keys: tuple[str, ...] = ()) -> None:
        """Write the new files. `buckets`: rows of equal `keys[0]` lie in one file, sorted by `keys`."""
        self.buckets, self.keys = buckets, tuple(keys) if buckets else ()
        if not buckets:
            df.write.parquet(str(self.staged))
            return
        name = f"staygrid_staged_{self.id}"
        dealt = df.repartition(buckets, keys[0])
        dealt.write.bucketBy(buckets, keys[0]).sortBy(*keys).option("path", str(self.staged)).format("parquet").saveAsTable(name)
        self.spark.sql(f"DROP TABLE {name}")  # its files stay

    def move(self) -> None:
        """Put the staged files beside those of the table."""
        facts = _facts(self.spark, self.staged, _data_files(self.staged))
        _each(lambda name: (self.staged / name).rename(self.path / f"{self.id}-{name}"), facts)
        self.files = {f"{self.id}-{name}": fact for name, fact in facts.items()}

    def swap(self, notes: Mapping[str, object] | None) -> Manifest:
        """From here on the table is the new one."""
        now = manifest_of(self.path)
        if (now.id if now else None) != (self.before.id if self.before else None):
            raise ConcurrentCommitError(f"{self.path} was committed to meanwhile")
        old = {*self.before.files, *self.before.replaced} if self.before else set()
        replaced = tuple(n for n in _data_files(self.path) if n in old and n not in self.files and not _of_a_commit(n))
        new = Manifest(self.id, self.files, notes, self.buckets, self.keys, replaced)
        (self.path / MANIFEST).replace_text(new.text())
        return new

    def clean(self) -> None:
        recover(self.path)


def publish(df: DataFrame, path: str | PathLike, notes: Mapping[str, object] | None = None, buckets: int | None = None, keys: tuple[str, ...] = tuple(KEYS)) -> Manifest:
    """Make `df` the content of the table, with these notes; `df` may read the table itself."""
    commit = Commit(df.sparkSession, path)
    commit.path.make_folder()
    commit.adopt()
    commit.stage(df, buckets, keys)
    commit.move()
    new = commit.swap(notes)
    commit.clean()
    return new


def annotate(spark: SparkSession, path: str | PathLike, notes: Mapping[str, object] | None) -> Manifest:
    """Other notes for the table as it lies: a new manifest over its files, of which only footers are read that no manifest knows."""
    commit = Commit(spark, path)
    old, found = commit.before, _data_files(commit.path)
    sizes = {n: size for n, size in found.items() if old is None or not _left_over(n, old)}
    known = {n: fact for n, fact in old.files.items() if fact[0] == sizes.get(n) and fact[1] >= 0} if old else {}
    if old and set(sizes) == set(old.files):
        commit.buckets, commit.keys = old.buckets, old.keys
    commit.files = {**known, **_facts(spark, commit.path, {n: size for n, size in sizes.items() if n not in known})}
    return commit.swap(notes)


def recover(path: str | PathLike) -> list[str]:
    """Remove what unfinished or replaced commits have left in the folder; their names."""
    path, manifest = Place(path), manifest_of(path)
    if manifest is None:
        return []
    gone = [p for p, _ in path.files() if _left_over(p.name, manifest) or p.name.startswith(f"{MANIFEST}.")]
    gone += [p for p in path.folders() if p.name.startswith("_staged-")]
    _each(lambda name: (path / name).delete(), (p.name for p in gone))
    return sorted(p.name for p in gone)
