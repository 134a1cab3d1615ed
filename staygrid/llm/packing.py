"""Operator 6: packing token pieces into sequences by exact complements, then best fit.

Only the histogram of piece lengths decides the packing, and it has at most `capacity` rows
whatever the input, so it is solved on the driver with multiplicities; pieces are then placed
where they are, by their rank among the pieces of equal length.

Lengths are placed from the longest to the shortest, so that short pieces, which fit into more
gaps, are left for the end. The longest piece that is left fills a gap exactly if it can: alone, as
one of a pair or as one of three, whose other lengths an index of available lengths and sums of
pairs finds. If no gap can be filled exactly, it goes where least is left (best fit).

Defined cases: a null or empty text is the end id alone; repeated rows are packed each; a
null doc_id stays null; extra columns are ignored; no rows give no rows.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from staygrid.llm.common import materialize, tune
from staygrid.llm.tokens import encoder

CAPACITY = 1024
_PIECES = "part int, doc_id long, missing boolean, piece int, start long, length int, rank long, ids binary"


class Complements:
    """Available lengths, and for each sum how many pairs of them have it."""

    def __init__(self, histogram: dict[int, int], capacity: int):
        self.counts, self.pairs = np.zeros(capacity + 1, np.int64), np.zeros(2 * capacity + 1, np.int64)
        for length, n in histogram.items():
            self.change(length, n)

    def change(self, length: int, by: int) -> None:
        """More or fewer pieces of a length."""
        before = int(self.counts[length])
        self.counts[length] = now = before + by
        if (before > 0) != (now > 0):
            others = np.flatnonzero(self.counts)
            self.pairs[others[others != length] + length] += 1 if now else -1
        self.pairs[2 * length] += (now > 1) - (before > 1)

    def pair(self, total: int) -> tuple[int, int] | None:
        """The most even of the pairs with this sum, of which there is one: short pieces fit elsewhere too."""
        low = np.arange(1, total // 2 + 1)
        fits = np.flatnonzero((self.counts[low] > 0) & (self.counts[total - low] > (low == total - low)))
        return (int(total - low[fits[-1]]), int(low[fits[-1]])) if len(fits) else None

    def exact(self, gaps: np.ndarray, length: int) -> tuple[int, tuple[int, ...]] | None:
        """One of `gaps` (ascending) that a piece of `length` fills with no, one or two others, and these."""
        self.change(length, -1)
        rest = gaps - length
        found = None
        for some, complement in (
            (np.flatnonzero(rest == 0), lambda gap: ()),
            (np.flatnonzero((rest > 0) & (self.counts[rest] > 0)), lambda gap: (gap,)),
            (np.flatnonzero(self.pairs[rest] > 0), self.pair),
        ):
            if found is None and len(some):
                found = int(gaps[some[0]]), complement(int(rest[some[0]]))
        self.change(length, 1)
        return found


def solve(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[tuple[int, ...], int]]:
    """Patterns (lengths in one sequence) and how often each is used.

    Every step uses up the pieces of a length or the open sequences of a kind, so there are about
    as many steps as lengths, however many pieces there are.
    """
    left = Complements(histogram, capacity)
    opened: dict[int, list[tuple[tuple[int, ...], int]]] = defaultdict(list)  # by gap
    for length in range(capacity, 0, -1):
        while n := int(left.counts[length]):
            gaps = np.array(sorted(g for g, kinds in opened.items() if g >= length and kinds), np.int64)
            if not len(gaps):  # sequences of their own, with as many pieces of this length as fit
                gap, pattern, times, parts = capacity, (), n, (length,) * min(capacity // length, n)
            else:
                gap, others = left.exact(gaps, length) or (int(gaps[0]), ())
                (pattern, times), parts = opened[gap].pop(), (length, *others)
            need = Counter(parts)
            take = min(times, *(int(left.counts[x]) // k for x, k in need.items()))
            if take < times and len(gaps):
                opened[gap].append((pattern, times - take))
            for x, k in need.items():
                left.change(x, -k * take)
            opened[gap - sum(parts)].append((pattern + parts, take))
    return [kind for _, kinds in sorted(opened.items()) for kind in kinds]


def _slots(patterns: list[tuple[tuple[int, ...], int]]) -> dict[int, np.ndarray]:
    """For each length: first rank, first sequence and offset of each run of pieces."""
    ranks: Counter = Counter()
    slots: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
    sequence = 0
    for pattern, times in patterns:
        offset = 0
        for length in pattern:
            slots[length].append((ranks[length], sequence, offset))
            ranks[length] += times
            offset += length
        sequence += times
    return {length: np.array(rows, np.int64) for length, rows in slots.items()}


def _cut(path: str, end_id: int, capacity: int) -> Callable:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode, end = encoder(path, 4, False).encode, end_id.to_bytes(4, "little")
        part, seen = TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for batch in batches:
            rows = []
            for doc_id, missing, data in zip(batch["doc_id"].tolist(), batch["missing"].tolist(), encode(batch["text"]), strict=True):
                data, begin, piece = data + end, 0, 0
                n = len(data) // 4
                while begin < n:
                    length = (n - begin) % capacity or capacity  # only the first can be shorter
                    rows.append((part, doc_id, missing, piece, begin, length, seen[length], data[4 * begin : 4 * (begin + length)]))
                    seen[length] += 1
                    begin, piece = begin + length, piece + 1
            yield pd.DataFrame(rows, columns=["part", "doc_id", "missing", "piece", "start", "length", "rank", "ids"])

    return run


def cut_pieces(docs: DataFrame, path: str, end_id: int = 2, capacity: int = CAPACITY) -> DataFrame:
    """Token pieces of all documents (ids little-endian unsigned 32-bit), in the shared folder."""
    tune(docs.sparkSession)
    doc_id = F.col("doc_id").cast("long")
    # without nulls pandas keeps ids whole
    narrow = docs.select(F.coalesce(doc_id, F.lit(0)).alias("doc_id"), doc_id.isNull().alias("missing"), F.col("text").cast("string"))
    return materialize(narrow.mapInPandas(_cut(path, end_id, capacity), _PIECES), "pieces")


def pack_pieces(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Places for pieces as `cut_pieces` makes them (ids may be left out): adds sequence_id and offset."""
    per_part = pieces.groupBy("part", "length").agg(F.count("*").alias("n"))
    histogram = {r["length"]: r["n"] for r in per_part.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    slots = _slots(solve(histogram, capacity))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = per_part.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rank = (batch["base"] + batch["rank"]).to_numpy(np.int64)
            lengths = batch["length"].to_numpy()
            sequence, offset = np.zeros(len(batch), np.int64), np.zeros(len(batch), np.int64)
            for length in np.unique(lengths):
                mine, runs = lengths == length, slots[int(length)]
                k = np.searchsorted(runs[:, 0], rank[mine], "right") - 1
                sequence[mine] = runs[k, 1] + rank[mine] - runs[k, 0]
                offset[mine] = runs[k, 2]
            yield batch.drop(columns=["base", "rank", "part"]).assign(sequence_id=sequence, offset=offset)

    kept = [f for f in pieces.schema.fields if f.name not in ("part", "rank")]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept) + ", sequence_id long, offset long"
    placed = pieces.join(bases, ["part", "length"]).select(*[f.name for f in kept], "part", "rank", "base").mapInPandas(place, schema)
    return placed.withColumn("doc_id", F.when(~F.col("missing"), F.col("doc_id"))).drop("missing")


def pack_documents(docs: DataFrame, path: str, end_id: int = 2, capacity: int = CAPACITY) -> DataFrame:
    """Pieces of all documents with their ids and places: doc_id, piece, start, length, ids, sequence_id, offset."""
    return pack_pieces(cut_pieces(docs, path, end_id, capacity), capacity)
