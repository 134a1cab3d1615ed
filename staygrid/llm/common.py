"""Helpers shared by the training-data operators: shared storage, held-out rule, columns."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows an Arrow batch carries into Python; texts may be long, so it is small.
BATCH_ROWS = 512
_MADE: dict[str, list[str]] = {}
_OWN: dict[str, str] = {}
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def tune(spark: SparkSession) -> None:
    """Keep Arrow batches small enough for workers of a few hundred MB.

    A plan takes this setting when it runs, after the operator has returned it, so it stays set;
    `restored` puts it back once results are written.
    """
    spark.conf.set(_BATCH, str(BATCH_ROWS))


@contextmanager
def restored(spark: SparkSession, keep: Callable[[], DataFrame | None] = lambda: None) -> Iterator[None]:
    """Put back what `tune` set, and delete tables written meanwhile but those that `keep()` reads."""
    before, made = spark.conf.get(_BATCH, None), _made(spark)
    mark = len(made)
    try:
        yield
    finally:
        spark.conf.unset(_BATCH) if before is None else spark.conf.set(_BATCH, before)
        kept = keep()
        inside = [f.rsplit("/", 1)[0] for f in kept.inputFiles()] if kept is not None else []
        for path in made[mark:]:
            if not any(i.split(":")[-1].lstrip("/") == path.split(":")[-1].lstrip("/") for i in inside):
                delete(spark, path)
                made.remove(path)


def _made(spark: SparkSession) -> list[str]:
    """Folders that operators of this application wrote."""
    return _MADE.setdefault(spark.sparkContext.applicationId, [])


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, spark.checkpoint.dir; one of our own only in local mode."""
    where = spark.conf.get("spark.checkpoint.dir", None)
    if not where:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        name = spark.sparkContext.applicationId
        where = _OWN.get(name) or "file://" + tempfile.mkdtemp(prefix="staygrid-")
        _OWN[name] = where
    return where.rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    _made(spark).append(path)
    return path


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write `df` as a Parquet table in the shared folder and read it back: lineage ends there."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def delete(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def drop_table(df: DataFrame) -> None:
    """Delete the files of a materialized table that nothing reads any more."""
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        delete(df.sparkSession, folder)


def held_out(doc_id: str | Column = "doc_id") -> Column:
    """True for the quarter of documents that no model may learn from (null id: learnable)."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(column.cast("string")) % 4 == 2, F.lit(False))


def about(key: str, wanted: int, total: Column | int) -> Column:
    """True for about four times `wanted` of `total` rows, or all if there are fewer, by a hash of `key`.

    What is then sorted for an exact choice of `wanted` rows doesn't grow with the input.
    """
    share = F.lit(4.0 * wanted) / (F.lit(total) if isinstance(total, int) else total)
    return F.pmod(F.xxhash64(F.lit("sample"), key), F.lit(1 << 20)) < share * (1 << 20)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def parallelism(df: DataFrame) -> int:
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")), 1)


def utf8(text: str | None) -> bytes:
    """UTF-8 of a text; lone surrogates, which UTF-8 can't hold, become '?'."""
    return (text or "").encode("utf-8", "replace")


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of unsigned 64-bit integers (splitmix64 finaliser)."""
    with np.errstate(over="ignore"):
        x = x.astype(np.uint64)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def word_numbers(words: list[bytes]) -> np.ndarray:
    """Each word's number: equal words, equal numbers."""
    seen: dict[bytes, int] = {}
    return np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, len(words))


def word_spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words [^\\x20\\x09-\\x0D]+ in an array of UTF-8 bytes."""
    space = (data == 32) | ((data >= 9) & (data <= 13))
    edge = np.flatnonzero(np.diff(np.concatenate(([True], space, [True])).astype(np.int8)))
    return edge[0::2], edge[1::2]


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """One unsigned 64-bit hash for each word: a polynomial of its bytes, scrambled."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        lengths = ends - starts
        longest = int(lengths.max())
        powers = np.cumprod(np.concatenate((np.ones(1, np.uint64), np.full(longest, 0x9E3779B97F4A7C15 | 1, np.uint64))))
        first = np.cumsum(lengths) - lengths
        place = np.arange(int(lengths.sum())) - np.repeat(first, lengths)
        values = (data[place + np.repeat(starts, lengths)].astype(np.uint64) + np.uint64(1)) * powers[place]
        return mix64(np.add.reduceat(values, first) + powers[lengths])
