"""Operator 4: token ids as canonical length-limited Huffman files.

Ids are counted over all documents, one canonical code is made from the counts, and documents
in ascending `doc_id` order are coded in independent blocks. A block holds whole documents and
a bit offset for every STRIDE ids, so a reader decodes many places of it at once by table.

A file is a folder: `code`, one row with the code (b"SGC1", ids of the vocabulary u32, zlib of a
code length u8 for each), and `blocks`. Whoever has the folder can decode it; nothing else is needed.

Block format (little-endian): b"SGH1", documents u32, ids u32, CRC-32 of the code lengths u32,
then zlib of doc_id i64[], null flags u8[] and sizes u32[] preceded by its length u32, bit
lengths of the strides u16[] and the coded bits (big-endian, most significant bit first).

Defined cases: a null or empty text is the end id alone; a null doc_id sorts first; repeated
rows are kept, ordered by doc_id, then by how texts begin; extra columns are ignored; no rows give no rows. A
document of any length stays in one block.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Callable, Iterator
from itertools import accumulate

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from staygrid.llm.common import materialize, parallelism, scratch, tune
from staygrid.llm.tokens import encoder

MAGIC, CODE_MAGIC, STRIDE, BLOCK_IDS, MAX_BITS = b"SGH1", b"SGC1", 64, 1 << 16, 16
_TOKENS = "part int, first long, n_ids long, n_docs int, head binary, ids binary, counts array<long>"


def code_lengths(counts: np.ndarray, limit: int = MAX_BITS) -> np.ndarray:
    """Optimal code lengths of at most `limit` bits (0 for a count of 0), by package-merge."""
    used = np.flatnonzero(counts)
    out = np.zeros(len(counts), np.uint8)
    if len(used) < 2:
        out[used] = 1
        return out
    limit = max(limit, int(np.ceil(np.log2(len(used)))))
    order = used[np.argsort(counts[used], kind="stable")]
    leaves = counts[order].astype(np.float64)
    merged, is_leaf = leaves, [np.ones(len(leaves), bool)]
    for _ in range(limit - 1):
        pairs = merged[: len(merged) // 2 * 2].reshape(-1, 2).sum(1)
        both = np.concatenate((leaves, pairs))
        at = np.argsort(both, kind="stable")
        merged = both[at]
        is_leaf.append(at < len(leaves))
    take = 2 * len(leaves) - 2
    lengths = np.zeros(len(leaves), np.int64)
    for flags in reversed(is_leaf):
        n = int(flags[:take].sum())
        lengths[:n] += 1
        take = 2 * (take - n)
    out[order] = lengths
    return out


class Code:
    """A canonical code: ids in order of (length, id) get consecutive code words."""

    def __init__(self, lengths: np.ndarray):
        self.lengths = lengths.astype(np.int64)
        self.bits = max(int(self.lengths.max(initial=0)), 1)
        self.check = zlib.crc32(lengths.astype(np.uint8).tobytes())
        ids = np.flatnonzero(lengths)
        ids = ids[np.lexsort((ids, self.lengths[ids]))]
        sizes = np.int64(1) << (self.bits - self.lengths[ids])
        ends = np.cumsum(sizes)
        self.words = np.zeros(len(lengths), np.uint64)
        self.words[ids] = ((ends - sizes) >> (self.bits - self.lengths[ids])).astype(np.uint64)
        table = np.repeat(ids, sizes)
        self.table = np.concatenate((table, np.zeros((1 << self.bits) - len(table), np.int64)))
        self.steps = self.lengths[self.table]

    def pack(self, ids: np.ndarray) -> tuple[np.ndarray, bytes]:
        """The bit length of each stride, and the bits."""
        n = self.lengths[ids]
        ends = np.cumsum(n)
        starts = ends - n
        total = int(ends[-1])
        shift = (64 - (starts & 31) - n).astype(np.uint64)
        value = self.words[ids] << shift
        word, size = starts >> 5, (total >> 5) + 2
        # code words don't overlap, so these sums of 32-bit parts are exact in doubles
        sums = np.bincount(word, (value >> np.uint64(32)).astype(np.float64), size)
        sums[1:] += np.bincount(word, (value & np.uint64(0xFFFFFFFF)).astype(np.float64), size)[:-1]
        data = sums.astype(np.uint64).astype(">u4").tobytes()[: (total + 7) // 8]
        return np.diff(np.append(starts[::STRIDE], total)).astype("<u2"), data

    def unpack(self, strides: np.ndarray, data: bytes, n: int) -> np.ndarray:
        """The ids: each stride is decoded beside all the others, by table."""
        raw = np.frombuffer(data + bytes(8), np.uint8).astype(np.uint32)
        windows = (raw[:-3] << 24) | (raw[1:-2] << 16) | (raw[2:-1] << 8) | raw[3:]
        at = np.cumsum(strides.astype(np.int64)) - strides
        out = np.zeros((STRIDE, len(strides)), np.int64)
        mask = np.int64((1 << self.bits) - 1)
        limit = len(windows) - 1
        for k in range(STRIDE):
            # a last stride that is short runs on into padding; what it reads there is cut off
            where = np.minimum(at >> 3, limit)
            code = (windows[where].astype(np.int64) >> (32 - self.bits - (at & 7))) & mask
            out[k] = self.table[code]
            at = at + self.steps[code]
        return out.T.reshape(-1)[:n]


def pack_code(lengths: np.ndarray) -> bytes:
    return CODE_MAGIC + struct.pack("<I", len(lengths)) + zlib.compress(lengths.astype(np.uint8).tobytes(), 9)


def unpack_code(data: bytes) -> np.ndarray:
    lengths = np.frombuffer(zlib.decompress(data[8:]), np.uint8)
    if data[:4] != CODE_MAGIC or struct.unpack_from("<I", data, 4)[0] != len(lengths):
        raise ValueError("not a code")
    return lengths


def pack_head(doc_ids: list[int | None], sizes: list[int]) -> bytes:
    known = np.array([d if d is not None else 0 for d in doc_ids], "<i8")
    return zlib.compress(known.tobytes() + bytes(d is None for d in doc_ids) + np.array(sizes, "<u4").tobytes(), 6)


def pack_block(code: Code, n_docs: int, head: bytes, ids: np.ndarray) -> bytes:
    strides, data = code.pack(ids)
    return MAGIC + struct.pack("<IIII", n_docs, len(ids), code.check, len(head)) + head + strides.tobytes() + data


def unpack_block(code: Code, block: bytes) -> tuple[list[int | None], list[int], np.ndarray]:
    docs, n, check, size = struct.unpack_from("<IIII", block, 4)
    if block[:4] != MAGIC or check != code.check:
        raise ValueError("not a block of this code")
    head = zlib.decompress(block[20 : 20 + size])
    doc_ids = np.frombuffer(head, "<i8", docs).tolist()
    doc_ids = [None if missing else d for d, missing in zip(doc_ids, head[8 * docs : 9 * docs], strict=True)]
    sizes = np.frombuffer(head, "<u4", docs, 9 * docs).tolist()
    lanes = -(-n // STRIDE)
    strides = np.frombuffer(block, "<u2", lanes, 20 + size)
    return doc_ids, sizes, code.unpack(strides, block[20 + size + 2 * lanes :], n)


def _tokenize(path: str, words: bool, end_id: int) -> Callable:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoder(path, 2, words).encode
        end, part = end_id.to_bytes(2, "little"), TaskContext.get().partitionId()
        first, size, ids, doc_ids, sizes = 0, 0, [], [], []
        total = np.zeros(1 << 16, np.int64)

        def row() -> pd.DataFrame:
            nonlocal total
            data = b"".join(ids)
            total += np.bincount(np.frombuffer(data, "<u2"), minlength=1 << 16)
            return pd.DataFrame([[part, first, size, len(doc_ids), pack_head(doc_ids, sizes), data, None]], columns=columns)

        for batch in batches:
            for doc_id, missing, data in zip(batch["doc_id"].tolist(), batch["missing"], encode(batch["text"]), strict=True):
                ids.append(data + end)
                doc_ids.append(None if missing else doc_id)
                sizes.append(len(data) // 2 + 1)
                size += sizes[-1]
                if size >= BLOCK_IDS:
                    yield row()
                    first, size, ids, doc_ids, sizes = first + size, 0, [], [], []
        if doc_ids:
            yield row()
        if total.any():  # the partition's last row holds its counts alone
            yield pd.DataFrame([[part, first + size, 0, 0, None, None, total]], columns=columns)

    columns = ["part", "first", "n_ids", "n_docs", "head", "ids", "counts"]
    return run


def tokenize_blocks(docs: DataFrame, path: str, words: bool, end_id: int) -> DataFrame:
    """Blocks of ids in ascending doc_id order, as a table in the shared folder.

    Rows of one doc_id (or of none) are dealt to as many partitions as their number takes, by how their texts begin and
    by their place in the input.

    Ids are kept as unsigned 16-bit integers: the vocabulary must be smaller than 65,536.
    """
    tune(docs.sparkSession)
    ranged = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    ranged = ranged.withColumns({"_head": F.substring("text", 1, 32), "_place": F.monotonically_increasing_id()})
    ranged = ranged.repartitionByRange(parallelism(docs), F.col("doc_id").asc_nulls_first(), F.col("_head").asc_nulls_first(), "_place").drop("_head", "_place")
    ranged = ranged.sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text")
    # without nulls pandas keeps ids whole
    plain = ranged.select(F.coalesce("doc_id", F.lit(0)).alias("doc_id"), F.col("doc_id").isNull().alias("missing"), "text")
    return materialize(plain.mapInPandas(_tokenize(path, words, end_id), _TOKENS), "ids")


def _merge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The sums of a task's counts, a row for each id that occurs."""
    total = np.zeros(1 << 16, np.int64)
    for batch in batches:
        for counts in batch["counts"]:
            total += counts
    used = np.flatnonzero(total)
    yield pd.DataFrame({"id": used, "n": total[used]})


def global_code(blocks: DataFrame) -> np.ndarray:
    """Code lengths from counts over all ids; a row for each id of the vocabulary comes back."""
    counted = blocks.where("counts is not null").select("counts").mapInPandas(_merge, "id int, n long")
    rows = counted.groupBy("id").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(max((r["id"] for r in rows), default=0) + 1, np.int64)
    for r in rows:
        counts[r["id"]] = r["n"]
    return code_lengths(counts)


def write_files(blocks: DataFrame, lengths: np.ndarray, path: str) -> str:
    """Write the code and the coded blocks, with `start` (ids of all blocks before), below `path`."""
    # one number for each partition of tokenize_blocks, of which there are as many as it chose
    totals = sorted(blocks.groupBy("part").agg(F.sum("n_ids").alias("n")).collect())
    bases = dict(zip([r["part"] for r in totals], accumulate((r["n"] for r in totals), initial=0), strict=False))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        code = Code(lengths)
        for batch in batches:
            content = [pack_block(code, d, h, np.frombuffer(i, "<u2")) for d, h, i in zip(batch["n_docs"], batch["head"], batch["ids"], strict=True)]
            yield pd.DataFrame({"start": batch["part"].map(bases) + batch["first"], "content": content})

    coded = blocks.where("ids is not null").select("part", "first", "n_docs", "head", "ids").mapInPandas(run, "start long, content binary")
    coded.write.parquet(f"{path}/blocks", compression="none")
    blocks.sparkSession.createDataFrame([(bytearray(pack_code(lengths)),)], "code binary").coalesce(1).write.parquet(f"{path}/code")
    return path


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start and ids (little-endian unsigned 32-bit) of each document in the files below `path`."""
    lengths = unpack_code(bytes(spark.read.parquet(f"{path}/code").first()["code"]))  # as large as the vocabulary
    files = spark.read.schema("start long, content binary").parquet(f"{path}/blocks")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        code = Code(lengths)
        for batch in batches:
            for start, content in zip(batch["start"], batch["content"], strict=True):
                doc_ids, sizes, ids = unpack_block(code, content)
                data, ends = ids.astype("<u4").tobytes(), np.cumsum(sizes)
                begins = ends - sizes
                yield pd.DataFrame({
                    "doc_id": pd.array(doc_ids, "Int64"),
                    "start": start + begins,
                    "ids": [data[4 * a : 4 * b] for a, b in zip(begins.tolist(), ends.tolist(), strict=True)],
                })

    return files.select("start", "content").mapInPandas(run, "doc_id long, start long, ids binary")


def huffman_round_trip(docs: DataFrame, path: str, words: bool = True, end_id: int = 1) -> DataFrame:
    """Write the ids of `docs` as files and read them back: doc_id, start, ids."""
    blocks = tokenize_blocks(docs, path, words, end_id)
    where = write_files(blocks, global_code(blocks), scratch(docs.sparkSession, "huffman"))
    return read_files(docs.sparkSession, where)
