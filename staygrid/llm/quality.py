"""Operator 2: document quality by attention-based multiple-instance learning.

A document is a bag of passages of PASSAGE words. Each passage is described by counts of its
bytes and words, encoded by a small network, and weighted by gated attention that is learned
from document labels alone; the weighted sum of the encodings gives the score.

Learning takes a bounded sample of labelled rows, chosen by a hash of doc_id among those that
aren't held out: at most TRAIN_DOCS documents, whatever their length. All passages of a sampled
document count. Where the sample has over TRAIN_PASSAGES passages, the longest documents are learned
from more coarsely: a bag of more passages than `allowance` gives has that many descriptions, each the
mean of a stretch of its passages. Scoring reads every passage of every text, a bounded number of
bytes at a time.

Defined cases: a text without words is one passage without words and is scored like any other;
repeated rows get equal scores; without labels of both kinds every score is the labels' mean
(0.5 without labels); extra columns are kept; no rows give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staygrid.llm.common import about, held_out, materialize, tune, utf8, word_hashes, word_spans

PASSAGE, TRAIN_DOCS, TRAIN_PASSAGES, HIDDEN, GATE = 64, 6000, 200_000, 32, 16
EPOCHS, STEPS, BAGS, RATE, DECAY, THRESHOLD = 16, 600, 128, 3e-3, 1e-4, 0.7
#: Bytes of text described at once.
CHUNK = 1 << 18
BUCKETS = 32


def _byte_classes() -> np.ndarray:
    """Lower case, upper case, digits, blank, other white space, beyond ASCII, control, each mark."""
    classes = np.full(256, 5, np.int64)
    for b in range(128):
        c = chr(b)
        classes[b] = 0 if c.islower() else 1 if c.isupper() else 2 if c.isdigit() else 3 if c == " " else 4 if c.isspace() else 6
    marks = [b for b in range(33, 127) if not chr(b).isalnum()]
    classes[marks] = 7 + np.arange(len(marks))
    return classes


_CLASS = _byte_classes()
_CLASSES = int(_CLASS.max()) + 1
FEATURES = _CLASSES + 9 + BUCKETS


def _most(key: np.ndarray, passage: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """For each passage: how many different keys it has, and how often the most frequent comes."""
    order = np.lexsort((key, passage))
    k, p = key[order], passage[order]
    first = np.flatnonzero(np.concatenate(([True], (k[1:] != k[:-1]) | (p[1:] != p[:-1]))))
    sizes = np.diff(first, append=len(k))
    most = np.zeros(n, np.int64)
    np.maximum.at(most, p[first], sizes)
    return np.bincount(p[first], minlength=n), most


def _describe(blobs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Features of all passages, and how many passages each text has."""
    data = np.frombuffer(b" ".join(blobs), np.uint8)
    sizes = np.array([len(b) for b in blobs])
    origin = np.cumsum(sizes + 1) - sizes - 1
    starts, ends = word_spans(data)
    doc = np.searchsorted(origin, starts, "right") - 1
    words = np.bincount(doc, minlength=len(blobs))
    passages = np.maximum(-(-words // PASSAGE), 1)
    base = np.cumsum(passages) - passages
    rank = np.arange(len(starts)) - (np.cumsum(words) - words)[doc]
    passage = base[doc] + rank // PASSAGE
    n = int(passages.sum())
    out = np.zeros((n, FEATURES), np.float32)
    if len(data):
        # a byte belongs to its own text's passage of the last word begun, or the first one before any
        lead = np.flatnonzero(np.diff(passage, prepend=-1))
        owner = np.zeros(len(data) + 1, np.int64)
        owner[starts[lead]] = rank[lead] > 0
        owner[origin[1:]] = 1
        owner = np.cumsum(owner[:-1])
        own = np.ones(len(data), bool)
        own[origin[1:] - 1] = False  # blanks that join texts
        bytes_of = np.bincount(owner[own] * _CLASSES + _CLASS[data[own]], minlength=n * _CLASSES).reshape(n, _CLASSES)
        out[:, :_CLASSES] = bytes_of / np.maximum(bytes_of.sum(1, keepdims=True), 1)
    if len(starts):
        held = np.bincount(passage, minlength=n)
        count = np.maximum(held, 1)
        hashes = word_hashes(data, starts, ends)
        pair = hashes[:-1] * np.uint64(31) + hashes[1:]
        joined = passage[1:] == passage[:-1]
        upper = np.add.reduceat((_CLASS[data] == 1).astype(np.int64), starts)
        capital = _CLASS[data[starts]] == 1
        distinct, most = _most(hashes, passage, n)
        pairs, _ = _most(pair[joined], passage[1:][joined], n) if joined.any() else (np.zeros(n), None)
        sums = lambda x: np.bincount(passage, x, n) / count
        extra = (
            np.log1p(held), sums(ends - starts) / 10, distinct / count, most / count, pairs / count,
            np.bincount(passage[1:][joined & (hashes[1:] == hashes[:-1])], minlength=n) / count,
            sums(capital), sums((upper >= 2) & (upper * 2 >= ends - starts)), sums(_CLASS[data[ends - 1]] > 4),
        )
        out[:, _CLASSES : _CLASSES + 9] = np.stack(extra, axis=1)
        out[:, _CLASSES + 9 :] = np.bincount(passage * BUCKETS + (hashes % np.uint64(BUCKETS)).astype(np.int64), minlength=n * BUCKETS).reshape(n, BUCKETS) / count[:, None]
    return out, passages


def _parts(blob: bytes, size: int) -> Iterator[bytes]:
    """A text in parts of about `size` bytes, each but the last of whole passages.

    A part begins with its first passage's first word (the text's first part may begin with white
    space), so that the parts' features are the text's.
    """
    begin, reach = 0, size
    while begin + reach < len(blob):
        starts, _ = word_spans(np.frombuffer(blob, np.uint8, reach, begin))
        whole = (len(starts) - 1) // PASSAGE * PASSAGE
        if whole > 0:
            yield blob[begin : begin + int(starts[whole])]
            begin, reach = begin + int(starts[whole]), size
        else:  # fewer words than a passage has
            reach *= 2
    yield blob[begin:]


def describe(texts: list[str | None], chunk: int = CHUNK) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """`_describe` of all texts, at most about `chunk` bytes at a time; long texts are described in parts."""
    held, size = [], 0
    for text in texts:
        blob = utf8(text)
        if held and size + len(blob) >= chunk:
            yield _describe(held)
            held, size = [], 0
        if len(blob) >= chunk:
            parts = [_describe([part])[0] for part in _parts(blob, chunk)]
            yield np.concatenate(parts), np.array([sum(map(len, parts))])
            continue
        held.append(blob)
        size += len(blob)
    if held:
        yield _describe(held)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


class Model:
    """Gated-attention pooling of encoded passages; `weights` None: a constant score."""

    def __init__(self, weights: dict[str, np.ndarray] | None, constant: float = 0.5):
        self.weights, self.constant = weights, constant

    def forward(self, x: np.ndarray, sizes: np.ndarray) -> dict[str, np.ndarray]:
        w, first = self.weights, np.cumsum(sizes) - sizes
        h = np.tanh(((x - w["mean"]) / w["scale"]) @ w["enc"] + w["enc0"])
        t, g = np.tanh(h @ w["v"]), _sigmoid(h @ w["u"])
        a = (t * g) @ w["w"]
        a = np.exp(a - np.repeat(np.maximum.reduceat(a, first), sizes))
        a = a / np.repeat(np.add.reduceat(a, first), sizes)
        z = np.add.reduceat(h * a[:, None], first)
        return {"h": h, "t": t, "g": g, "a": a, "z": z, "p": _sigmoid(z @ w["out"] + w["out0"])}

    def score(self, x: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(sizes), self.constant)
        return self.forward(x, sizes)["p"]


def gradient(model: Model, x: np.ndarray, sizes: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
    """Of the mean log loss of labels `y` over bags of `sizes` passages."""
    w, f = model.weights, model.forward(x, sizes)
    e = (f["p"] - y) / len(y)
    dz = np.repeat(np.outer(e, w["out"]), sizes, axis=0)
    da = (dz * f["h"]).sum(1)
    da = f["a"] * (da - np.repeat(np.add.reduceat(f["a"] * da, np.cumsum(sizes) - sizes), sizes))
    dt, dg = np.outer(da, w["w"]) * f["g"] * (1 - f["t"] ** 2), np.outer(da, w["w"]) * f["t"] * f["g"] * (1 - f["g"])
    dh = (dz * f["a"][:, None] + dt @ w["v"].T + dg @ w["u"].T) * (1 - f["h"] ** 2)
    xs = (x - w["mean"]) / w["scale"]
    return {"enc": xs.T @ dh, "enc0": dh.sum(0), "v": f["h"].T @ dt, "u": f["h"].T @ dg, "w": (f["t"] * f["g"]).T @ da, "out": f["z"].T @ e, "out0": np.array([e.sum()])}


def fit(bags: list[np.ndarray], labels: np.ndarray, seed: int = 7) -> Model:
    """Train by Adam on the log loss of document labels."""
    if not len(labels) or labels.min() == labels.max():
        return Model(None, float(labels.mean()) if len(labels) else 0.5)
    rng = np.random.default_rng(seed)
    every = np.concatenate(bags)
    d = every.shape[1]
    w = {
        "enc": rng.normal(0, d**-0.5, (d, HIDDEN)), "enc0": np.zeros(HIDDEN), "v": rng.normal(0, 0.2, (HIDDEN, GATE)), "u": rng.normal(0, 0.2, (HIDDEN, GATE)),
        "w": rng.normal(0, 0.2, GATE), "out": rng.normal(0, 0.2, HIDDEN), "out0": np.zeros(1), "mean": every.mean(0), "scale": every.std(0) + 1e-2,
    }
    model, learned = Model(w), ["enc", "enc0", "v", "u", "w", "out", "out0"]
    m1, m2, step = {k: np.zeros_like(w[k]) for k in learned}, {k: np.zeros_like(w[k]) for k in learned}, 0
    for _ in range(max(EPOCHS, STEPS * BAGS // len(bags))):  # few bags: at least so many steps
        order = rng.permutation(len(bags))
        for i in range(0, len(order), BAGS):
            pick = order[i : i + BAGS]
            x, sizes, y = np.concatenate([bags[k] for k in pick]), np.array([len(bags[k]) for k in pick]), labels[pick]
            grad = gradient(model, x, sizes, y)
            step += 1
            for k in learned:
                m1[k] = 0.9 * m1[k] + 0.1 * grad[k]
                m2[k] = 0.999 * m2[k] + 0.001 * grad[k] ** 2
                w[k] -= RATE * (m1[k] / (1 - 0.9**step) / (np.sqrt(m2[k] / (1 - 0.999**step)) + 1e-8) + DECAY * w[k])
    return model


def _bags(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        parts = [part for x, sizes in describe(list(batch["text"])) for part in np.split(x, np.cumsum(sizes)[:-1])]
        yield pd.DataFrame({"doc_id": batch["doc_id"], "quality": batch["quality"], "passages": [len(p) for p in parts], "bag": [p.tobytes() for p in parts]})


def allowance(sizes: np.ndarray, passages: int) -> int:
    """The most descriptions a bag may have, so that all bags together have at most `passages` (or one each)."""
    left, n = passages, len(sizes)
    for k, size in enumerate(np.sort(sizes).tolist()):
        if size * (n - k) > left:
            return max(left // (n - k), 1)
        left -= size
    return int(max(sizes, default=1))


def pooled(bag: np.ndarray, most: int) -> np.ndarray:
    """A bag of at most `most` descriptions: means of stretches of passages, of nearly equal length."""
    if len(bag) <= most:
        return bag
    edges = np.arange(most + 1) * len(bag) // most
    return (np.add.reduceat(bag.astype(np.float64), edges[:-1], axis=0) / np.diff(edges)[:, None]).astype(np.float32)


def _pool(most: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.assign(bag=[pooled(np.frombuffer(b, np.float32).reshape(-1, FEATURES), most).tobytes() for b in batch["bag"]])

    return run


def train(docs: DataFrame, labels: DataFrame, sample: int = TRAIN_DOCS, passages: int = TRAIN_PASSAGES) -> Model:
    """Fit on at most `sample` labelled documents (doc_id, quality) that aren't held out, with about `passages` descriptions."""
    tune(docs.sparkSession)
    known = labels.select(F.col("doc_id").cast("long"), F.col("quality").cast("int")).where("quality in (0, 1) and doc_id is not null").where(~held_out())
    known = known.where(about("doc_id", sample, max(known.count(), 1)))
    # labelled twice: the lower label; the sample's size is bounded by the parameter
    known = known.groupBy("doc_id").agg(F.min("quality").alias("quality")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    rows = texts.join(F.broadcast(known), "doc_id").mapInPandas(_bags, "doc_id long, quality int, passages long, bag binary")
    # of rows that share a doc_id one counts, before any goes to the driver
    rows = materialize(rows.groupBy("doc_id", "quality").agg(F.min(F.struct("passages", "bag")).alias("_row")).select("doc_id", "quality", "_row.*"), "bags")
    sizes = np.array([r["passages"] for r in rows.select("passages").collect()], np.int64)  # of `sample` rows
    most = allowance(sizes, passages)
    if len(sizes) and sizes.max() > most:
        rows = rows.mapInPandas(_pool(most), rows.schema)
    chosen = rows.toPandas().sort_values("doc_id")
    bags = [np.frombuffer(b, np.float32).reshape(-1, FEATURES) for b in chosen["bag"]]
    return fit(bags, chosen["quality"].to_numpy(np.float64))


def score(docs: DataFrame, model: Model, output: str = "score") -> DataFrame:
    """`docs` with a column `output` (in place of any such): the probability of label 1."""

    def run(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            parts = [model.score(x, sizes) for x, sizes in describe(list(batch))]
            yield pd.Series(np.concatenate(parts) if parts else np.zeros(0))

    tune(docs.sparkSession)
    return docs.withColumn(output, F.pandas_udf(run, "double")(F.col("text").cast("string")))
