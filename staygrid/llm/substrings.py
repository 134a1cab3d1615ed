"""Operator 3: removing repeated 50-word passages by super-k-mer partitioning.

Consecutive windows that share a minimiser (the smallest hash of GRAM words in each) form a
super-k-mer and travel as one packed string to the minimiser's bucket, where sorting the windows
finds each one's smallest document exactly. A stretch that repeats itself is one super-k-mer.

1. Only (minimiser, document, windows) goes round first; minimisers of one document can't repeat.
2. Super-k-mers of the others travel to buckets. A minimiser of over HOT windows would fill one
   task: its equal strings are merged first, and their windows are then dealt out one by one (by
   128-bit digest), so no group ever holds more than one window's rows.
3. Runs of flagged windows return to their documents.

Defined cases: null, empty and short texts lose nothing; a document never flags itself nor rows
of the same doc_id; a null doc_id neither flags nor loses anything; repeated rows are judged
each; other columns are kept, but one with the output's name is replaced; no rows give no rows. Hash collisions only merge buckets.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pandas as pd
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staygrid.llm.common import materialize, mix64, parallelism, tune, utf8, word_hashes

WINDOW, GRAM, HOT = 50, 8, 40_000
#: Windows of a string held at a time.
CHUNK = 4096
#: A run of windows is start * RUN + length.
RUN = 1 << 31
_SUPER = "anchor long, doc_id long, key long, pos long, n_windows int, packed binary, hot boolean"


class SuperKmers:
    """A text's super-k-mers: first window, number of windows and minimiser of each."""

    def __init__(self, text: str | None):
        words = utf8(text).split()
        self.n_words = len(words)
        self.first = self.size = np.zeros(0, np.int64)
        self.anchor = np.zeros(0, np.int64)
        if len(words) < WINDOW:
            return
        self.data = b" ".join(words)
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        self.ends = np.cumsum(lengths + 1) - 1
        self.begins = self.ends - lengths
        hashes = word_hashes(np.frombuffer(self.data, np.uint8), self.begins, self.ends)
        with np.errstate(over="ignore"):
            grams = np.zeros(len(words) - GRAM + 1, np.uint64)
            for k in range(GRAM):
                grams = grams * np.uint64(0x100000001B3) + hashes[k : k + len(grams)]
        grams = mix64(grams)
        reach = WINDOW - GRAM + 1
        views = sliding_window_view(grams, reach)
        lowest = np.concatenate([part.min(1) for part in np.array_split(views, -(-len(views) // 65536))])
        self.first = np.flatnonzero(np.concatenate(([True], lowest[1:] != lowest[:-1])))
        self.size = np.diff(self.first, append=len(lowest))
        self.anchor = lowest[self.first].view(np.int64)

    def packed(self, k: int) -> bytes:
        begin = self.first[k]
        return self.data[self.begins[begin] : self.ends[begin + self.size[k] + WINDOW - 2]]


def _with_key(docs: DataFrame) -> DataFrame:
    """doc_id, text and a key that tells rows of one doc_id apart."""
    narrow = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return narrow.where("doc_id is not null and text is not null").withColumn("key", F.xxhash64("doc_id", "text"))


def _anchors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        found, windows, n = [], [], []
        for text in batch["text"]:
            supers = SuperKmers(text)
            anchor, at = np.unique(supers.anchor, return_inverse=True)
            found.append(anchor)
            windows.append(np.bincount(at, supers.size, len(anchor)).astype(np.int64))
            n.append(len(anchor))
        yield pd.DataFrame({
            "anchor": np.concatenate(found) if found else np.zeros(0, np.int64),
            "doc_id": np.repeat(batch["doc_id"].to_numpy(), n),
            "key": np.repeat(batch["key"].to_numpy(), n),
            "windows": np.concatenate(windows) if found else np.zeros(0, np.int64),
        })


def _supers(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The super-k-mers of the wanted minimisers."""
    for batch in batches:
        rows = []
        for doc_id, key, text, cold, hot in zip(batch["doc_id"], batch["key"], batch["text"], batch["cold"], batch["hot"], strict=True):
            s = SuperKmers(text)
            is_hot = np.isin(s.anchor, hot)
            for k in np.flatnonzero(is_hot | np.isin(s.anchor, cold)).tolist():
                rows.append((s.anchor[k], doc_id, key, s.first[k], s.size[k], s.packed(k), is_hot[k]))
        yield pd.DataFrame(rows, columns=["anchor", "doc_id", "key", "pos", "n_windows", "packed", "hot"])


def windows(packed: bytes) -> Iterator[bytes]:
    """The windows of a packed string, one after another."""
    blanks = np.flatnonzero(np.frombuffer(packed, np.uint8) == 32)
    n = len(blanks) + 1 - (WINDOW - 1)
    for at in range(0, n, CHUNK):
        upto = min(at + CHUNK, n)
        begins = [0, *(blanks[: upto - 1] + 1).tolist()] if at == 0 else (blanks[at - 1 : upto - 1] + 1).tolist()
        ends = blanks[at + WINDOW - 1 : upto + WINDOW - 1].tolist()
        if upto == n:
            ends.append(len(packed))
        for b, e in zip(begins, ends, strict=True):
            yield packed[b:e]


def _runs(flags: list[int]) -> Iterator[tuple[int, int]]:
    """Start and length of each run of consecutive numbers in a sorted list."""
    begin = last = None
    for f in flags:
        if last is not None and f == last + 1:
            last = f
            continue
        if begin is not None:
            yield begin, last - begin + 1
        begin = last = f
    if begin is not None:
        yield begin, last - begin + 1


def _judge(rows: list[tuple]) -> list[tuple]:
    """Of a minimiser's rows (doc_id, key, pos, packed): runs of windows that a smaller document has too."""
    seen = [(w, row[0], r, i) for r, row in enumerate(rows) for i, w in enumerate(windows(row[3]))]
    seen.sort()
    flagged: dict[int, list[int]] = {}
    window, smallest = None, None
    for w, doc_id, r, i in seen:
        if w != window:
            window, smallest = w, doc_id
        if doc_id > smallest:
            flagged.setdefault(r, []).append(i)
    return [(rows[r][0], rows[r][1], [(rows[r][2] + at) * RUN + n for at, n in _runs(sorted(found))]) for r, found in flagged.items()]


def _bucket(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """A minimiser's rows come whole and one after another; one minimiser's are held at a time."""
    anchor, held = None, []
    columns = ["doc_id", "key", "runs"]
    for batch in batches:
        out = []
        for a, *row in zip(batch["anchor"], batch["doc_id"], batch["key"], batch["pos"], batch["packed"], strict=True):
            if a != anchor:
                out += _judge(held)
                anchor, held = a, []
            held.append(row)
        yield pd.DataFrame(out, columns=columns)
    yield pd.DataFrame(_judge(held), columns=columns)


def _digests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Each different window of a stretch of CHUNK windows of a string, and where it is in there."""
    for batch in batches:
        for content, first, packed in zip(batch["content"], batch["first"], batch["packed"], strict=True):
            every, begin = windows(packed), 0
            while some := list(islice(every, CHUNK)):
                places: dict[bytes, list[int]] = {}
                for i, window in enumerate(some, begin):
                    places.setdefault(hashlib.blake2b(window, digest_size=16).digest(), []).append(i)
                yield pd.DataFrame({"content": content, "first": first, "window": list(places), "at": list(places.values())})
                begin += len(some)


def _flag_hot(supers: DataFrame) -> DataFrame:
    """Flags of the windows of minimisers that have very many, window by window."""
    supers = supers.withColumn("content", F.md5("packed"))
    contents = supers.groupBy("content").agg(F.first("packed").alias("packed"), F.min("doc_id").alias("first"))
    each = contents.mapInPandas(_digests, "content string, first long, window binary, at array<int>")
    lowest = each.groupBy("window").agg(F.min("first").alias("lowest"))
    early = each.join(lowest, "window").where("lowest < first").groupBy("content", "first").agg(F.flatten(F.collect_list("at")).alias("at"))
    places = supers.select("content", "doc_id", "key", "pos", "n_windows")
    later = places.join(contents.select("content", "first"), "content").where("doc_id > first")
    first = places.join(early, "content").where("doc_id = first")
    one = F.transform("at", lambda i: (F.col("pos") + i) * F.lit(RUN) + 1)
    return later.select("doc_id", "key", F.array(F.col("pos") * F.lit(RUN) + F.col("n_windows")).alias("runs")).unionByName(first.select("doc_id", "key", one.alias("runs")))


def repeated_windows(docs: DataFrame, hot: int = HOT) -> DataFrame:
    """doc_id, key, runs: for each document, runs of flagged windows as start * RUN + length."""
    tune(docs.sparkSession)
    keyed = _with_key(docs)
    anchors = materialize(keyed.mapInPandas(_anchors, "anchor long, doc_id long, key long, windows long"), "minimisers")
    counts = anchors.groupBy("anchor").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b"), F.sum("windows").alias("n")).where("a < b")
    shared = anchors.join(counts.select("anchor", "n"), "anchor")
    wanted = shared.groupBy("doc_id", "key").agg(
        F.collect_list(F.when(F.col("n") <= hot, F.col("anchor"))).alias("cold"),
        F.collect_list(F.when(F.col("n") > hot, F.col("anchor"))).alias("hot"),
    )
    supers = materialize(keyed.join(wanted, ["doc_id", "key"]).select("doc_id", "key", "text", "cold", "hot").mapInPandas(_supers, _SUPER), "superkmers")
    cold = supers.where("not hot").select("anchor", "doc_id", "key", "pos", "packed")
    cold = cold.repartition(parallelism(docs), "anchor").sortWithinPartitions("anchor")
    flags = cold.mapInPandas(_bucket, "doc_id long, key long, runs array<long>").unionByName(_flag_hot(supers.where("hot")))
    return flags.groupBy("doc_id", "key").agg(F.flatten(F.collect_list("runs")).alias("runs"))


def _cut_out(texts: pd.Series, runs: pd.Series) -> pd.DataFrame:
    rows = []
    for text, codes in zip(texts, runs, strict=True):
        words = utf8(text).split()
        if codes is None or not len(codes):
            rows.append((len(words), 0, b" ".join(words).decode()))
            continue
        edges = np.zeros(len(words) + 1, np.int64)
        starts, n = np.divmod(np.asarray(codes, np.int64), RUN)
        np.add.at(edges, starts, 1)
        np.add.at(edges, starts + n + WINDOW - 1, -1)
        covered = np.cumsum(edges[:-1]) > 0
        kept = [w for w, c in zip(words, covered.tolist(), strict=True) if not c]
        rows.append((len(words), len(words) - len(kept), b" ".join(kept).decode()))
    return pd.DataFrame(rows, columns=["n_words", "n_removed", "kept"])


def remove_repeats(docs: DataFrame, hot: int = HOT, output: str = "cut") -> DataFrame:
    """`docs` with a struct `output`: n_words, n_removed and kept (words joined by one space)."""
    runs = repeated_windows(docs, hot).withColumnsRenamed({"doc_id": "_cut_doc", "key": "_cut_key", "runs": "_cut_runs"})
    doc_id, text = F.col("doc_id").cast("long"), F.col("text").cast("string")
    keyed = docs.withColumns({"_cut_id": doc_id, "_cut_own": F.xxhash64(doc_id, text)})
    joined = keyed.join(runs, (F.col("_cut_id") == F.col("_cut_doc")) & (F.col("_cut_own") == F.col("_cut_key")), "left")
    cut_out = F.pandas_udf(_cut_out, "n_words long, n_removed long, kept string")
    return joined.select(*[F.col(f"`{c}`") for c in docs.columns if c != output], cut_out(text, "_cut_runs").alias(output))
