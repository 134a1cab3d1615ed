"""Operator 12: runs (maximal periodic stretches) of a text's words, after Kolpakov and Kucherov.

A run is a stretch whose smallest period q fits at least three times, of at least SHORTEST words, that
no neighbouring word extends. For each text:

1. Stretches in which a run may lie: inside a run every window of GRAM words occurs again, as a run is
   at least GRAM words longer than two periods. Stretches of such windows with at least SHORTEST words
   are joined, with a number of its own between each two; all else holds no run. (`stretches`)
2. The suffix automaton of the joined words, with each state's first end (`SuffixAutomaton`).
3. LZ factors: the longest prefix of the rest that also begins earlier, by walking the automaton for as
   long as a state's first end lies before the word at hand. (`factorise`)
4. Runs that cross or touch a factor's beginning, by Main's algorithm: common prefixes and suffixes around
   it give each period's reach. Such a run has a period below half of both factors' words, or the
   earlier factor would be longer, so this takes time in proportion to them. (`crossing_runs`)
5. Runs strictly inside a factor are copied from its earlier occurrence, left to right. (`find_runs`)

All is linear in the words of a text, in the task that has it; nothing is shuffled. Only a state's
first transition is in arrays of 32-bit integers, others in a dictionary.

Defined cases: null, empty and short texts have no runs, and collapse to their words; equal texts get equal
values; repeated rows, ties and null ids are judged each; other columns are kept, but one with the output's
name is replaced; no rows give no rows.
"""

from __future__ import annotations

from array import array
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staygrid.llm.common import tune, utf8, word_numbers

#: Fewest words of a run, fewest periods in it, and words of the windows that must repeat inside (a third of SHORTEST).
SHORTEST, TIMES, GRAM = 24, 3, 8
_RUN = "array<struct<start: bigint, length: bigint, period: bigint>>"


def stretches(words: np.ndarray) -> list[tuple[int, int]]:
    """Begins and ends of the stretches in which a run may lie. Equal hashes of unlike windows only add some."""
    n = len(words) - GRAM + 1
    if len(words) < SHORTEST:
        return []
    with np.errstate(over="ignore"):
        grams = np.zeros(n, np.uint64)
        for k in range(GRAM):
            grams *= np.uint64(0x9E3779B97F4A7C15)
            grams += words[k : k + n].astype(np.uint64)
    order = np.argsort(grams)
    same = np.diff(grams[order]) == 0
    again = np.zeros(n, np.int8)
    again[order[1:][same]] = again[order[:-1][same]] = 1
    edges = np.flatnonzero(np.diff(again, prepend=0, append=0))
    begins, ends = edges[0::2], edges[1::2] + GRAM - 1
    return [(b, e) for b, e in zip(begins.tolist(), ends.tolist(), strict=True) if e - b >= SHORTEST]


class SuffixAutomaton:
    """The smallest automaton of all substrings; `ends` has the last place of each state's first occurrence."""

    def __init__(self, words: list[int]):
        self.word, self.to, self.link, self.size, self.ends = array("i", [-1]), array("i", [-1]), array("i", [-1]), array("i", [0]), array("i", [-1])
        self.more: dict[int, dict[int, int]] = {}  # all but a state's first transition
        last = 0
        for place, c in enumerate(words):
            last = self._extend(last, place, c)

    def step(self, state: int, c: int) -> int:
        """Where the word leads, or -1."""
        if self.word[state] == c:
            return self.to[state]
        others = self.more.get(state)
        return others.get(c, -1) if others else -1

    def _lead(self, state: int, c: int, to: int) -> None:
        if self.word[state] in (-1, c):
            self.word[state], self.to[state] = c, to
        else:
            self.more.setdefault(state, {})[c] = to

    def _state(self, size: int, end: int) -> int:
        self.word.append(-1)
        self.to.append(-1)
        self.link.append(0)
        self.size.append(size)
        self.ends.append(end)
        return len(self.size) - 1

    def _extend(self, last: int, place: int, c: int) -> int:
        new, state = self._state(self.size[last] + 1, place), last
        while state >= 0 and (to := self.step(state, c)) < 0:
            self._lead(state, c, new)
            state = self.link[state]
        if state < 0:
            return new
        if self.size[to] == self.size[state] + 1:
            self.link[new] = to
            return new
        copy = self._state(self.size[state] + 1, self.ends[to])
        self.word[copy], self.to[copy], self.link[copy] = self.word[to], self.to[to], self.link[to]
        if to in self.more:
            self.more[copy] = dict(self.more[to])
        while state >= 0 and self.step(state, c) == to:
            self._lead(state, c, copy)
            state = self.link[state]
        self.link[to] = self.link[new] = copy
        return new


def factorise(words: list[int], automaton: SuffixAutomaton) -> Iterator[tuple[int, int, int]]:
    """Begin, end and earlier occurrence (-1: a new word) of each LZ factor."""
    begin = 0
    while begin < len(words):
        state, end = 0, begin
        while end < len(words):
            to = automaton.step(state, words[end])
            if to < 0 or automaton.ends[to] >= end:
                break
            state, end = to, end + 1
        if end == begin:
            yield begin, begin + 1, -1
            begin += 1
        else:
            yield begin, end, automaton.ends[state] - (end - begin) + 1
            begin = end


def own_prefixes(words: list[int]) -> np.ndarray:
    """Words that each suffix shares with the whole (the Z function)."""
    n = len(words)
    shared = [0] * n
    left = right = 0
    for i in range(1, n):
        k = min(shared[i - left], right - i) if i < right else 0
        while i + k < n and words[k] == words[i + k]:
            k += 1
        shared[i] = k
        if i + k > right:
            left, right = i, i + k
    return np.array(shared, np.int64)


def crossing_runs(words: list[int], before: int, begin: int, end: int) -> Iterator[tuple[int, int, int]]:
    """(start, end, period) of runs that cross or touch `begin` and end in the factor from there to `end`, or where the one from `before` does."""
    a, c = begin - before, end - begin
    reach = (a + c - 1) // 2
    if 3 * (a + c) <= 2 * SHORTEST or not begin:
        return
    low = max(begin - a - reach, 0)
    left, right = words[low:begin], words[begin : end + 1]
    q, r = min(reach, len(right)), min(reach, len(left))
    back = own_prefixes(left[::-1] + [-1] + right[:q][::-1] + left[::-1])
    ahead = own_prefixes(right + [-2] + left[len(left) - r :] + right)
    p = np.arange(1, min(q, len(right) - 1) + 1)  # at least a period lies behind `begin`
    found = [(begin - back[len(left) + 1 + q - p], begin + p + ahead[p], p)]
    p = np.arange(1, r + 1)  # at least a period lies before it
    found.append((begin - p - np.where(p < len(left), back[np.minimum(p, len(left) - 1)], 0), begin + ahead[len(right) + 1 + r - p], p))
    for start, stop, p in found:
        good = (stop - start >= np.maximum(SHORTEST, TIMES * p)) & (stop <= end) & ((start > low) | (low == 0))
        yield from zip(start[good].tolist(), stop[good].tolist(), p[good].tolist(), strict=True)


def joined_runs(words: list[int]) -> dict[tuple[int, int], int]:
    """The period of each run, by (start, end)."""
    runs: dict[tuple[int, int], int] = {}
    starting: dict[int, set[int]] = {}

    def add(start: int, stop: int, period: int) -> None:
        runs[start, stop] = min(period, runs.get((start, stop), period))
        starting.setdefault(start, set()).add(stop)

    before = end = 0
    for begin, end, source in factorise(words, SuffixAutomaton(words)):
        for run in crossing_runs(words, before, begin, end):
            add(*run)
        if source >= 0 and end - begin > SHORTEST:
            shift = begin - source
            for start in range(source + 1, end - shift - SHORTEST):
                for stop in sorted(starting.get(start, ())):
                    if stop < end - shift:
                        add(start + shift, stop + shift, runs[start, stop])
        before = begin
    for run in crossing_runs(words, before, end, end):
        add(*run)
    return runs


def find_runs(numbers: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs, in order."""
    parts = stretches(numbers)
    joined, firsts, places = [], [], []
    for k, (begin, end) in enumerate(parts):
        firsts.append(len(joined))
        places.append(begin)
        joined += numbers[begin:end].tolist()
        joined.append(len(numbers) + k)
    out = []
    for (start, stop), period in joined_runs(joined).items():
        k = bisect_right(firsts, start) - 1
        out.append((start - firsts[k] + places[k], stop - start, period))
    return sorted(out, key=lambda run: (run[0], run[2]))


def _report(texts: pd.Series) -> pd.DataFrame:
    rows = []
    for text in texts:
        words = utf8(text).split()
        runs = find_runs(word_numbers(words))
        edges = np.zeros(len(words) + 1, np.int64)
        best = None
        for start, length, period in runs:
            edges[start + period] += 1
            edges[start + length] -= 1
            if best is None or length * best[2] > best[1] * period:
                best = start, length, period
        kept = words
        if runs:
            kept = [w for w, gone in zip(words, (np.cumsum(edges[:-1]) > 0).tolist(), strict=True) if not gone]
        rows.append((len(words), [dict(zip(("start", "length", "period"), run, strict=True)) for run in runs], *(best or (None,) * 3), b" ".join(kept).decode()))
    out = pd.DataFrame(rows, columns=["n_words", "runs", "start", "length", "period", "collapsed"])
    return out.astype({c: "Int64" for c in ("start", "length", "period")})


def collapse_runs(docs: DataFrame, output: str = "periodic") -> DataFrame:
    """`docs` with a struct `output`: n_words, runs (by start, then period), the run of greatest exponent, and the text without what repeats in runs.

    Of a run the first period's words stay, unless another run takes them; words are joined by one blank.
    """
    tune(docs.sparkSession)
    report = F.pandas_udf(_report, f"n_words long, runs {_RUN}, start long, length long, period long, collapsed string")
    return docs.withColumn(output, report(F.col("text").cast("string")))


def _plant(texts: pd.Series, numbers: pd.Series) -> pd.Series:
    out = []
    for text, h in zip(texts, numbers, strict=True):
        words = utf8(text).split()
        if words and not pd.isna(h) and int(h) % 10 == 0:
            g, n = int(h) // 10, len(words)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
        out.append(b" ".join(words).decode())
    return pd.Series(out, dtype=object)


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """`docs`, of which about a tenth, by crc32 of doc_id (h % 10 = 0), become periodic from some word on; words are joined by one blank.

    With g = floor(h / 10), word i from a = g % n on becomes word a + (i - a) % (1 + floor((n - a) / (3 + g % 8))). A null doc_id: as it is.
    """
    plant = F.pandas_udf(_plant, "string")
    return docs.withColumn("text", plant(F.col("text").cast("string"), F.crc32(F.col("doc_id").cast("string"))))
