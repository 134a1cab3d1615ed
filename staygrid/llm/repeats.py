"""Operator 11: quality rules on repetition within a text, from a suffix array over its words.

The suffixes of a text's words are sorted by prefix doubling (the first round packs as many words
into a key as fit), and neighbours' common prefixes follow from the ranks of its rounds. Each
place of the prefix array names an LCP interval: the suffixes around it that share so many words. An
interval whose suffixes aren't all preceded by the same word is a maximal repeat: neither end can be
extended. Spans of maximal repeats of at least LEAST words are united; a text is rejected if they cover
more than COVERED percent of its words or if the longest repeat has more than LONGEST words.
A suffix contributes the span of its deepest interval only: shallower ones lie inside of it, and
where the deepest isn't maximal, a maximal one that begins further left covers it.

Words that repeat in windows of GRAM words (`n_repeat_words`) come from the same array. A text costs
n log(longest repeat) time for its n words, and 4 bytes a word for each round, in the task that has
it; nothing is shuffled.

Defined cases: null, empty and blank texts have no words and no repeats, and fail the base rules (under
FEWEST words); equal texts get equal values; repeated rows, ties and null ids are judged each; other
columns are kept, but one with the output's name is replaced; no rows give no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staygrid.llm.common import tune, utf8, word_numbers

#: Words of the shortest repeat that counts, percent of words that repeats may cover, words of the longest that may be.
LEAST, COVERED, LONGEST = 8, 45, 60
#: The base rules: fewest words, window of words, percent of words in repeated windows.
FEWEST, GRAM, REPEATED = 50, 3, 50
BLANKS, SYMBOLS = " \t\n\v\f\r", "#*$%&|<>"
_REPORT = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_covered long, longest_repeat long"


def suffix_array(words: np.ndarray) -> tuple[np.ndarray, list[tuple[int, np.ndarray]]]:
    """The suffixes in order, and of each round that left ties (h, ranks by the first h words, -1 past the end)."""
    n = len(words)
    bits = n.bit_length()
    h = 63 // max(bits, 1)
    padded = np.concatenate((words + 1, np.zeros(h, np.int64)))
    key = padded[:n].copy()
    for k in range(1, h):
        key <<= bits
        key |= padded[k : k + n]
    rounds = []
    while True:
        order = np.argsort(key)
        ranked = key[order]
        place = np.cumsum(ranked[1:] != ranked[:-1])
        if not n or (place[-1] if n > 1 else 0) == n - 1:
            return order, rounds
        rank = np.full(n + 1, -1, np.int32)
        rank[order[0]] = 0
        rank[order[1:]] = place
        rounds.append((h, rank))
        key = rank[:n] * np.int64(n + 1)
        key[: n - h] += rank[h:n] + 1
        h *= 2


def common_prefixes(words: np.ndarray, order: np.ndarray, rounds: list[tuple[int, np.ndarray]]) -> np.ndarray:
    """Words that each suffix shares with the next one in order."""
    a, b = order[:-1].copy(), order[1:].copy()
    ended = np.append(words, -1)
    for h, rank in reversed(rounds):
        same = rank[a] == rank[b]
        a[same] += h
        b[same] += h
    alive = np.flatnonzero(ended[a] == ended[b])
    while len(alive):
        a[alive] += 1
        b[alive] += 1
        alive = alive[ended[a[alive]] == ended[b[alive]]]
    return a - order[:-1]


def lcp_intervals(lcp: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of `lcp` that reach `least`, and the first and last suffix of the interval that each names."""
    places = np.flatnonzero(lcp >= least)
    first, last = [0] * len(places), [0] * len(places)
    stack: list[tuple[int, int, int]] = []  # number, place and length, lengths rising
    before = begin = -2
    for k, (j, length) in enumerate(zip(places.tolist(), lcp[places].tolist(), strict=True)):
        if j != before + 1:
            for top, _, _ in stack:
                last[top] = before + 1
            stack, begin = [], j
        while stack and stack[-1][2] > length:
            last[stack.pop()[0]] = j
        top = stack[-1] if stack else None
        first[k] = begin if top is None else first[top[0]] if top[2] == length else top[1] + 1
        stack.append((k, j, length))
        before = j
    for top, _, _ in stack:
        last[top] = before + 1
    return places, np.array(first, np.int64), np.array(last, np.int64)


def _covered(n: int, starts: np.ndarray, lengths: np.ndarray | int) -> int:
    """Places of n in at least one span."""
    edges = np.zeros(n + 1, np.int64)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + lengths, -1)
    return int(np.count_nonzero(np.cumsum(edges[:-1])))


def repetition(words: np.ndarray, least: int = LEAST) -> tuple[int, int, int]:
    """Words in repeated windows of GRAM, words in repeats of at least `least`, and words of the longest repeat."""
    n = len(words)
    if n < 2:
        return 0, 0, 0
    order, rounds = suffix_array(words)
    lcp = common_prefixes(words, order, rounds)
    left, right = np.append(-1, lcp), np.append(lcp, -1)
    depth = np.maximum(left, right)
    windows = _covered(n, order[depth >= GRAM], GRAM)
    places, first, last = lcp_intervals(lcp, least)
    if not len(places):
        return windows, 0, int(lcp.max())
    before = np.append(words, -1)[order - 1]
    unlike = np.append(0, np.cumsum(before[1:] != before[:-1]))
    maximal = np.zeros(n, bool)
    maximal[places] = unlike[last] > unlike[first]
    inside = np.flatnonzero(depth >= least)
    deepest = np.where(right[inside] >= left[inside], inside, inside - 1)
    spans = inside[maximal[deepest]]
    return windows, _covered(n, order[spans], depth[spans]), int(lcp.max())


def _lines(text: str) -> int:
    """Lines with a word that equal an earlier one."""
    lines = [line for line in text.split("\n") if line.strip(BLANKS)]
    return len(lines) - len(set(lines))


def _report(least: int):
    def run(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for text in texts:
            text = text or ""
            words = utf8(text).split()
            rows.append((len(words), len(text) - sum(map(text.count, BLANKS)), sum(map(text.count, SYMBOLS)), _lines(text), *repetition(word_numbers(words), least)))
        return pd.DataFrame(rows, columns=[c.split()[0] for c in _REPORT.split(", ")])

    return run


def judge_repetition(docs: DataFrame, least: int = LEAST, covered: int = COVERED, longest: int = LONGEST, output: str = "repetition") -> DataFrame:
    """`docs` with a struct `output`: counts, base_failed, and kept (false for texts that fail the base rules or repeat too much)."""
    tune(docs.sparkSession)
    report = F.pandas_udf(_report(least), _REPORT)
    reported = docs.withColumn(output, report(F.col("text").cast("string")))
    n, words = F.col(f"{output}.n_words"), F.col(f"{output}.n_repeat_words")
    base = (n < FEWEST) | (100 * words > REPEATED * n)
    kept = ~base & (100 * F.col(f"{output}.n_covered") <= covered * n) & (F.col(f"{output}.longest_repeat") <= longest)
    return reported.withColumn(output, F.col(output).withField("base_failed", base).withField("kept", kept))
