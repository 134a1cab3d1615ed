"""Operator 5: language identification by segmentation-marginalised unigrams.

Each language has a probability for every piece of a fixed public vocabulary. A word's
probability is the sum over all its segmentations into pieces, by the forward algorithm; a
text's is the product over its words. Piece probabilities are learned by expectation-
maximisation from the words of a bounded sample, DOCS_PER_LANG documents of each language. A language
learns from its own words alone, so each is a task of its own; a model holds a number for each
language and piece.

Words are whole runs of letters, and pieces all of the vocabulary that such words can hold. Words
of over LONG letters (rare, but for scripts without blanks and junk) are scored letter by letter with
rescaling, and learned from by logarithms, instead of beside others of their length.

Defined cases: a text that is null or has no letter is `und` with score 0; ties go to the
language that sorts first; repeated rows get equal answers; without any language to learn every
text is `und`; extra columns are kept, but one with the output's name is replaced.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from math import exp, inf, log

import numpy as np
import pandas as pd
import public_tokenizers
import regex
import sentencepiece
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from staygrid.llm.common import about, held_out, tune

DOCS_PER_LANG, ROUNDS, LONG, FLOOR, CACHE = 400, 4, 40, 1e-7, 200_000
_WORD = regex.compile(r"[\p{L}\p{M}]+")
_LETTER = regex.compile(r"\p{L}")
_PIECE = regex.compile(r"\u2581?[\p{L}\p{M}]*")
#: Letters of a long word that are looked up at a time, and sums below which they are rescaled.
STRETCH, SMALL = 4096, 1e-100
#: Words of one length that go together for one language, and sampled documents whose ids are broadcast at most.
TOGETHER, BROADCAST = 32_768, 2_000_000
_MULTIPLIER = 0x9E3779B97F4A7C15


def words_of(text: str) -> list[str]:
    """Lower-case runs of letters."""
    return _WORD.findall(text.lower())


def _hash_steps(n: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.cumprod(np.full(n, _MULTIPLIER, np.uint64))


class Pieces:
    """The vocabulary's pieces of letters (and a word's beginning), found by the hash of their characters."""

    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        every = {model.id_to_piece(i).lower() for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))}
        self.texts = sorted(p for p in every if p and _PIECE.fullmatch(p))
        self.size, self.longest = len(self.texts), max(map(len, self.texts))
        steps = _hash_steps(self.longest)
        with np.errstate(over="ignore"):
            hashes = np.array([int((np.array([*map(ord, p)], np.uint64) * steps[: len(p)]).sum()) for p in self.texts], np.uint64)
        order = np.argsort(hashes)
        self.hashes, self.ids = hashes[order], order
        # a bit for the low bits of each piece's hash: most places hold no piece, which this tells at once
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[(hashes & np.uint64((1 << 20) - 1)).astype(np.int64)] = True

    def _find(self, hashes: np.ndarray) -> np.ndarray:
        out = np.full(hashes.shape, -1, np.int64)
        likely = np.nonzero(self.maybe[(hashes & np.uint64((1 << 20) - 1)).astype(np.int64)])
        some = hashes[likely]
        at = np.minimum(np.searchsorted(self.hashes, some), self.size - 1)
        out[likely] = np.where(self.hashes[at] == some, self.ids[at], -1)
        return out

    def of(self, codes: np.ndarray) -> list[np.ndarray]:
        """For rows of characters: for each piece length, the piece at each place (-1: none)."""
        n, steps, out = codes.shape[1], _hash_steps(self.longest), []
        hashes = np.zeros_like(codes)
        with np.errstate(over="ignore"):
            for size in range(1, min(self.longest, n) + 1):
                hashes = hashes[:, : n - size + 1] + codes[:, size - 1 :] * steps[size - 1]
                out.append(self._find(hashes))
        return out


    def places(self, word: str) -> Iterator[list[tuple[int, int]]]:
        """For each character of a word (and the mark of its beginning): size and number of the pieces that begin there, the shortest first."""
        codes = characters([word])
        for begin in range(0, codes.shape[1], STRETCH):
            hits: list[list[tuple[int, int]]] = [[] for _ in range(min(STRETCH, codes.shape[1] - begin))]
            for size, ids in enumerate(self.of(codes[:, begin : begin + STRETCH + self.longest - 1]), 1):
                for place in np.flatnonzero(ids[0, : len(hits)] >= 0).tolist():
                    hits[place].append((size, int(ids[0, place])))
            yield from hits


def characters(words: list[str]) -> np.ndarray:
    """A row of code points for each of some words of one length, the mark of a word's beginning first."""
    text = "".join("▁" + w for w in words)
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64).reshape(len(words), -1)


def _forward(found: list[np.ndarray], probability: np.ndarray) -> np.ndarray:
    """alpha[place, word, language]: the sum over segmentations of the characters before place."""
    words, n = found[0].shape
    alpha = np.zeros((n + 1, words, probability.shape[1]))
    alpha[0] = 1
    held = [(ids >= 0).any(0) for ids in found]
    for end in range(1, n + 1):
        for size in range(1, min(len(found), end) + 1):
            if held[size - 1][end - size]:
                alpha[end] += alpha[end - size] * probability[found[size - 1][:, end - size]]
        alpha[end] += alpha[end - 1] * (FLOOR * (found[0][:, end - 1] < 0))[:, None]
    return alpha


def _by_length(words: list[str], langs: int = 1) -> Iterator[np.ndarray]:
    lengths, most = np.fromiter(map(len, words), np.int64, len(words)), max(TOGETHER // max(langs, 1), 16)
    for n in np.unique(lengths):
        yield from np.array_split(np.flatnonzero(lengths == n), -(-int((lengths == n).sum()) // most))


class Model:
    """Piece probabilities (a column for each language; the last row, for no piece, is 0)."""

    def __init__(self, path: str, langs: list[str], probability: np.ndarray):
        self.path, self.langs, self.probability = path, langs, probability
        self.pieces: Pieces | None = None

    def __getstate__(self) -> dict:
        return {**self.__dict__, "pieces": None}

    def word_scores(self, words: list[str]) -> np.ndarray:
        """Log probability of each word in each language."""
        self.pieces = self.pieces or Pieces(self.path)
        out = np.zeros((len(words), len(self.langs)))
        short = np.array([i for i, w in enumerate(words) if len(w) <= LONG], np.int64)
        for at in _by_length([words[i] for i in short], len(self.langs)):
            at = short[at]
            out[at] = np.log(_forward(self.pieces.of(characters([words[i] for i in at])), self.probability)[-1])
        for i in np.setdiff1d(np.arange(len(words)), short):
            out[i] = self._long(words[i])
        return out

    def _long(self, word: str) -> np.ndarray:
        """`word_scores` of one word: sums of the places ahead alone, rescaled for each language as they get small."""
        ring = self.pieces.longest + 1
        ahead, total, place = np.zeros((ring, len(self.langs))), np.zeros(len(self.langs)), -1
        ahead[0] = 1
        for place, pieces in enumerate(self.pieces.places(word)):
            here = ahead[place % ring].copy()
            ahead[place % ring] = 0
            if here.min() < SMALL:
                factor = np.where(here < SMALL, 1 / SMALL, 1.0)
                here, ahead, total = here * factor, ahead * factor, total - np.log(factor)
            if not pieces or pieces[0][0] > 1:
                ahead[(place + 1) % ring] += here * FLOOR
            for size, piece in pieces:
                ahead[(place + size) % ring] += here * self.probability[piece]
        return total + np.log(ahead[(place + 1) % ring])


def _log_sum(terms: list[float]) -> float:
    top = max(terms)
    return top + log(sum(exp(t - top) for t in terms))


def _long_shares(pieces: Pieces, word: str, probability: np.ndarray, expected: np.ndarray, weight: float) -> None:
    """Add to `expected` how often each piece is in a word, over all its segmentations: forward and backward sums as logarithms."""
    hits = list(pieces.places(word))
    n = len(hits)
    steps = [[(size, log(probability[piece]), piece) for size, piece in some] for some in hits]
    for some in steps:
        if not some or some[0][0] > 1:
            some.append((1, log(FLOOR), -1))
    ahead, behind = [[] for _ in range(n + 1)], [0.0] * (n + 1)
    ahead[0].append(0.0)
    alpha = [0.0] * (n + 1)
    for place in range(n + 1):
        alpha[place] = _log_sum(ahead[place]) if ahead[place] else -inf
        ahead[place] = []
        for size, p, _ in steps[place] if place < n else ():
            ahead[place + size].append(alpha[place] + p)
    for place in range(n - 1, -1, -1):
        behind[place] = _log_sum([p + behind[place + size] for size, p, _ in steps[place]])
        for size, p, piece in steps[place]:
            if piece >= 0:
                expected[piece] += weight * exp(alpha[place] + p + behind[place + size] - alpha[n])


def learn(pieces: Pieces, counts: dict[str, int], rounds: int = ROUNDS) -> np.ndarray:
    """One language's piece probabilities (the last, for no piece, is 0), by expectation-maximisation from its words' counts."""
    words = sorted(w for w in counts if len(w) <= LONG)
    weight = np.array([counts[w] for w in words], np.float64)[:, None]
    groups = [(at, pieces.of(characters([words[i] for i in at]))) for at in _by_length(words)]
    long = {w: n for w, n in sorted(counts.items()) if len(w) > LONG}

    def normal(expected: np.ndarray) -> np.ndarray:
        smooth = expected[:-1] + 0.05
        return np.vstack((smooth / smooth.sum(0), np.zeros(1)))

    expected = np.zeros((pieces.size + 1, 1))
    for at, found in groups:
        for ids in found:
            np.add.at(expected, ids.T, weight[at])
    for word, n in long.items():
        for some in pieces.places(word):
            for _, piece in some:
                expected[piece] += n
    probability = normal(expected)
    for _ in range(rounds):
        expected = np.zeros_like(probability)
        for at, found in groups:
            alpha = _forward(found, probability)
            n = len(alpha) - 1
            beta = np.zeros_like(alpha)
            beta[n] = weight[at] / alpha[n]
            for begin in range(n - 1, -1, -1):
                for size in range(1, min(len(found), n - begin) + 1):
                    ids = found[size - 1][:, begin]
                    if ids.max() < 0:
                        continue
                    share = probability[ids] * beta[begin + size]
                    beta[begin] += share
                    np.add.at(expected, ids, alpha[begin] * share)
                beta[begin] += beta[begin + 1] * (FLOOR * (found[0][:, begin] < 0))[:, None]
        for word, n in long.items():
            _long_shares(pieces, word, probability[:, 0], expected[:, 0], n)
        probability = normal(expected)
    return probability[:, 0]


def fit(path: str, counts: dict[str, dict[str, int]], rounds: int = ROUNDS) -> Model:
    """A model from word counts of each language."""
    pieces = Pieces(path)
    return Model(path, sorted(counts), np.stack([learn(pieces, counts[g], rounds) for g in sorted(counts)], axis=1))


def _count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        seen = Counter((g, w) for g, t in zip(batch["lang"], batch["text"], strict=True) for w in words_of(t))
        yield pd.DataFrame([(*k, n) for k, n in seen.items()], columns=["lang", "word", "n"])


def train(docs: DataFrame, path: str | None = None, per_lang: int = DOCS_PER_LANG) -> Model | None:
    """Fit on at most `per_lang` documents of each language that aren't held out; None: no language."""
    tune(docs.sparkSession)
    path = path or public_tokenizers.path("piece_bpe_32k.model")
    learnable = docs.select(F.col("doc_id").cast("long"), F.col("lang").cast("string"), F.col("text").cast("string"))
    learnable = learnable.where("lang is not null and text is not null").where(~held_out())
    first = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    counts = learnable.groupBy("lang").agg(F.count("*").alias("n"))
    small = F.broadcast if counts.count() * per_lang <= BROADCAST else (lambda df: df)
    few = learnable.select("doc_id", "lang").join(small(counts), "lang").where(about("doc_id", per_lang, F.col("n"))).select("doc_id", "lang")
    chosen = few.withColumn("k", F.row_number().over(first)).where(F.col("k") <= per_lang).select("doc_id", "lang").distinct()
    rows = learnable.join(small(chosen), ["doc_id", "lang"]).mapInPandas(_count, "lang string, word string, n long")

    def one(batch: pd.DataFrame) -> pd.DataFrame:
        summed = batch.groupby("word")["n"].sum()
        return pd.DataFrame({"lang": [batch["lang"].iloc[0]], "probability": [learn(Pieces(path), summed.to_dict()).tobytes()]})

    learned = rows.groupBy("lang", "word").agg(F.sum("n").alias("n")).groupBy("lang").applyInPandas(one, "lang string, probability binary")
    found = {r["lang"]: np.frombuffer(r["probability"]) for r in learned.toLocalIterator()}
    return Model(path, sorted(found), np.stack([found[g] for g in sorted(found)], axis=1)) if found else None


def identify(docs: DataFrame, model: Model | None, output: str = "language") -> DataFrame:
    """`docs` with a struct column `output`: lang_pred and score, its posterior probability."""

    def run(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        known: dict[str, int] = {}
        table = np.zeros((0, len(model.langs) if model else 0))
        for batch in texts:
            if len(known) > CACHE:
                known, table = {}, table[:0]
            lists = [words_of(t) if model and t and _LETTER.search(t) else [] for t in batch]
            new = list({w for ws in lists for w in ws if len(w) <= LONG and w not in known})
            if new:
                known.update(zip(new, range(len(table), len(table) + len(new)), strict=True))
                table = np.concatenate((table, model.word_scores(new)))
            langs, scores = [], []
            for ws in lists:
                if not ws:
                    langs.append("und")
                    scores.append(0.0)
                    continue
                total = table[[known[w] for w in ws if len(w) <= LONG]].sum(0)
                if long := [w for w in ws if len(w) > LONG]:
                    total = total + model.word_scores(long).sum(0)
                best = int(total.argmax())
                langs.append(model.langs[best])
                scores.append(float(1 / np.exp(total - total[best]).sum()))
            yield pd.DataFrame({"lang_pred": langs, "score": scores})

    tune(docs.sparkSession)
    predict = F.pandas_udf(run, "lang_pred string, score double")
    return docs.withColumn(output, predict(F.col("text").cast("string")))
