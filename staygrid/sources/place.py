"""Places of files and folders in any store that Spark can reach, local or remote.

Everything goes through Hadoop's file systems, as Spark's own readers and writers do, so a place is
what `spark.read` would take: with a scheme (hdfs://, s3a://, file:) or a path of the default store.
"""

from __future__ import annotations

import os
import posixpath
import re
from collections.abc import Iterator
from functools import total_ordering
from pathlib import PurePosixPath
from uuid import uuid4

from pyspark.sql import SparkSession

_SCHEME = re.compile(r"(?P<root>[A-Za-z][A-Za-z0-9+.-]+:(?://[^/]*)?)(?P<path>.*)", re.S)


@total_ordering
class Place:
    """A path with its store; relative local paths start at the working directory, `~` is the home folder."""

    def __init__(self, value: str | os.PathLike):
        text = os.fspath(value)
        found = _SCHEME.fullmatch(text)
        self.root = found["root"] if found else ""
        self.path = PurePosixPath(posixpath.normpath(found["path"] or "/") if found else os.path.abspath(os.path.expanduser(text)))

    def _at(self, path: PurePosixPath) -> Place:
        out = object.__new__(Place)
        out.root, out.path = self.root, path
        return out

    def __truediv__(self, name: str) -> Place:
        return self._at(self.path / name)

    def __str__(self) -> str:
        return f"{self.root}{self.path}"

    __fspath__ = __str__

    def __repr__(self) -> str:
        return f"Place({str(self)!r})"

    def __eq__(self, other: object) -> bool:
        return isinstance(other, (str, os.PathLike)) and str(self) == os.fspath(other)

    def __lt__(self, other: Place) -> bool:
        return str(self) < str(other)

    def __hash__(self) -> int:
        return hash(str(self))

    @property
    def name(self) -> str:
        return self.path.name

    @property
    def stem(self) -> str:
        return self.path.stem

    @property
    def parent(self) -> Place:
        return self._at(self.path.parent)

    @property
    def parts(self) -> tuple[str, ...]:
        return self.path.parts

    def with_suffix(self, suffix: str) -> Place:
        return self._at(self.path.with_suffix(suffix))

    def with_name(self, name: str) -> Place:
        return self._at(self.path.with_name(name))

    def below(self, root: Place) -> tuple[str, ...]:
        """The parts of this place's path from `root` on."""
        return self.path.relative_to(root.path).parts

    # --- what is there ---

    def _store(self):
        spark = SparkSession.getActiveSession() or SparkSession.builder.getOrCreate()
        path = spark._jvm.org.apache.hadoop.fs.Path(str(self))
        store = path.getFileSystem(spark._jsc.hadoopConfiguration())
        if store.getClass().getSimpleName() == "LocalFileSystem":
            store = store.getRawFileSystem()  # without checksum files beside
        return spark, store, path

    def _status(self):
        _, store, path = self._store()
        return store.getFileStatus(path) if store.exists(path) else None

    def exists(self) -> bool:
        return self._status() is not None

    def is_dir(self) -> bool:
        status = self._status()
        return status is not None and status.isDirectory()

    def is_file(self) -> bool:
        status = self._status()
        return status is not None and status.isFile()

    def _entries(self) -> list[tuple[Place, bool]]:
        _, store, path = self._store()
        return sorted((self / s.getPath().getName(), s.isDirectory()) for s in store.listStatus(path))

    def files(self) -> list[tuple[Place, int]]:
        """Files right in this folder with their sizes."""
        _, store, path = self._store()
        return sorted((self / s.getPath().getName(), s.getLen()) for s in store.listStatus(path) if s.isFile()) if self.is_dir() else []

    def folders(self) -> list[Place]:
        return [place for place, folder in self._entries() if folder] if self.is_dir() else []

    def find(self, name: str) -> list[Place]:
        """All places below that have this name (`*` for any part of it), in order; tables are not searched."""
        wanted = re.compile(".*".join(map(re.escape, name.split("*"))))

        def search(folder: Place) -> Iterator[Place]:
            for place, is_folder in folder._entries():
                if wanted.fullmatch(place.name):
                    yield place
                if is_folder and not place.name.endswith(".parquet"):
                    yield from search(place)

        return sorted(search(self)) if self.is_dir() else []

    # --- reading and changing it ---

    def read_text(self) -> str:
        spark, store, path = self._store()
        stream = store.open(path)
        try:
            return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write_text(self, text: str) -> None:
        """Replace the file's content; folders above it are made if need be."""
        _, store, path = self._store()
        stream = store.create(path, True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()

    def replace_text(self, text: str) -> None:
        """Put a file in the place of another in one step: readers see either the old content or the new one."""
        spark, _, path = self._store()
        jvm = spark._jvm
        if self.root.split(":")[0] in ("s3a", "s3", "gs", "abfs", "abfss", "wasbs"):  # one request makes the file, or doesn't
            self.write_text(text)
            return
        fresh = self.with_name(f"{self.name}.{uuid4().hex}")
        fresh.write_text(text)
        kinds = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
        how = spark._sc._gateway.new_array(kinds, 1)
        how[0] = kinds.OVERWRITE
        files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(path.toUri(), spark._jsc.hadoopConfiguration()) if path.toUri().getScheme() else jvm.org.apache.hadoop.fs.FileContext.getFileContext(spark._jsc.hadoopConfiguration())
        files.rename(jvm.org.apache.hadoop.fs.Path(str(fresh)), path, how)

    def make_folder(self) -> Place:
        _, store, path = self._store()
        store.mkdirs(path)
        return self

    def delete(self) -> None:
        """Remove the file or folder, if there is one."""
        _, store, path = self._store()
        store.delete(path, True)

    def rename(self, to: Place) -> None:
        spark, store, path = self._store()
        if not store.rename(path, spark._jvm.org.apache.hadoop.fs.Path(str(to))):
            raise OSError(f"{self} can't be renamed to {to}")


def place(value: str | os.PathLike | None) -> Place | None:
    return None if value is None else Place(value)
