"""Repetition rules, runs and exponion search against brute force, on small and odd inputs."""

import hashlib
import random
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from staygrid.llm import exponion, oracles, periodic, queries, repeats
from staygrid.llm.common import word_numbers

DOCS = "doc_id long, text string, repetition int, periodic string, start long"


def _documents(spark):
    """Clean and repetitive texts, copies, nulls, ties, a long one, and columns whose names clash."""
    r = random.Random(5)
    words = ["w%d" % i for i in range(300)]
    texts = [" ".join(r.choice(words) for _ in range(r.randrange(0, 300))) for _ in range(60)]
    line = " ".join(r.choice(words) for _ in range(20))
    texts += [f"{line}\n{t}\n{line}\n {line}" for t in texts[:10]]
    texts += [t[:300] + " " + " ".join(r.choice(words) for _ in range(q)) * 5 + t[300:] for q, t in enumerate(texts[:12], 1)]
    texts += ["a " * 900, "x y\tz\n" * 60, "", " \n\t ", None, "# * $ % & | < > #a é日本", "a\x1cb\x85c d", texts[3], "one", " ".join(words) * 4]
    rows = [(d, t, d, "old", 1) for d, t in enumerate(texts)]
    return rows + [(None, texts[61], 1, None, None), rows[2], rows[62]], spark


def _windows(words, size):
    counts = Counter(tuple(words[i : i + size]) for i in range(len(words) - size + 1))
    covered = {k for i in range(len(words) - size + 1) if counts[tuple(words[i : i + size])] > 1 for k in range(i, i + size)}
    return len(covered)


def _longest(words):
    return max((n for n in range(1, min(len(words), 70)) if _windows(words, n)), default=0)


def _brute_runs(words, shortest=24, times=3):
    n, found = len(words), {}
    for q in range(1, n // times + 1):
        i = 0
        while i < n - q:
            j = i
            while j < n - q and words[j] == words[j + q]:
                j += 1
            if j > i and j - i + q >= max(shortest, times * q):
                found.setdefault((i, j - i + q), q)
            i = max(j, i + 1)
    return sorted(((s, length, q) for (s, length), q in found.items()), key=lambda run: (run[0], run[2]))


# --- op11 -----------------------------------------------------------------------------------


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=40), st.integers(1, 3), st.integers(2, 9))
def test_repetition_equals_counting_windows(words, times, least):
    words = words * times
    got = repeats.repetition(word_numbers([b"%d" % w for w in words]), least)
    longest = max((n for n in range(1, len(words)) if _windows(words, n)), default=0)
    assert got == (_windows(words, 3), _windows(words, least), longest)


def test_suffixes_are_sorted_and_intervals_are_maximal():
    words = word_numbers([w.encode() for w in "a b r a c a d a b r a".split()])
    order, rounds = repeats.suffix_array(words)
    suffixes = [words[i:].tolist() for i in order]
    assert suffixes == sorted(suffixes)
    lcp = repeats.common_prefixes(words, order, rounds)
    assert lcp.tolist() == [next(k for k in range(12) if a[k : k + 1] != b[k : k + 1]) for a, b in zip(suffixes, suffixes[1:], strict=False)]
    places, first, last = repeats.lcp_intervals(lcp, 1)
    for j, f, e in zip(places, first, last, strict=True):
        assert lcp[f:e].min() == lcp[j] and (f == 0 or lcp[f - 1] < lcp[j]) and (e == len(lcp) or lcp[e] < lcp[j])


def test_repetition_report(spark):
    rows, _ = _documents(spark)
    docs = spark.createDataFrame(rows, DOCS).repartition(3)
    out = repeats.judge_repetition(docs)
    assert set(out.columns) == set(docs.columns)
    want = []
    for doc_id, text, _, other, start in rows:
        text = text or ""
        words = text.encode().split()
        lines = [line for line in text.split("\n") if line.encode().split()]
        three, eight, longest = _windows(words, 3), _windows(words, repeats.LEAST), _longest(words)
        base = len(words) < 50 or 100 * three > 50 * len(words)
        kept = not base and 100 * eight <= repeats.COVERED * len(words) and longest <= repeats.LONGEST
        symbols = sum(c in repeats.SYMBOLS for c in text)
        want.append((str(doc_id), other, start, len(words), sum(len(w.decode()) for w in words), symbols, len(lines) - len(set(lines)), three, eight, base, kept))
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_covered", "base_failed", "kept")
    got = [(str(r.doc_id), r.periodic, r.start, *[r.repetition[c] for c in names]) for r in out.collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, want))
    assert any(w[-1] for w in want) and any(not w[-1] and not w[-2] for w in want)
    assert repeats.judge_repetition(docs.limit(0)).count() == 0


def test_long_repetitive_texts_take_linear_memory_and_time():
    for words in (np.zeros(200_000, np.int64), np.arange(200_000) % 997, np.random.default_rng(1).integers(0, 2, 200_000)):
        windows, covered, longest = repeats.repetition(words)
        assert windows >= covered > 0 and longest > 8


# --- op12 -----------------------------------------------------------------------------------


@settings(max_examples=400, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 9), st.integers(1, 40), st.integers(0, 3)), max_size=8), st.sampled_from([3, 6, 9, 24]))
def test_runs_equal_brute_force(parts, shortest):
    words = [0]
    for period, length, new in parts:
        words += (words[-period:] * length)[:length] + [new]
    before = periodic.SHORTEST, periodic.GRAM
    try:
        periodic.SHORTEST, periodic.GRAM = shortest, shortest // 3
        want = _brute_runs(words, shortest)
        assert periodic.find_runs(np.array(words, np.int64)) == want
        assert {(s, s + n): q for s, n, q in want} == periodic.joined_runs(words)
    finally:
        periodic.SHORTEST, periodic.GRAM = before


def test_factors_are_longest_earlier_prefixes():
    r = random.Random(2)
    for _ in range(200):
        words = [r.randrange(3) for _ in range(r.randrange(1, 40))]
        at = 0
        for begin, end, source in periodic.factorise(words, periodic.SuffixAutomaton(words)):
            assert begin == at
            longest = max((k for k in range(1, len(words) - begin + 1) if any(words[s : s + k] == words[begin : begin + k] for s in range(begin))), default=0)
            assert end - begin == max(longest, 1) and (source >= 0) == (longest > 0)
            assert source < 0 or words[source : source + end - begin] == words[begin:end]
            at = end
        assert at == len(words)


def test_collapsed_texts(spark):
    rows, _ = _documents(spark)
    docs = spark.createDataFrame(rows, DOCS).repartition(3)
    out = periodic.collapse_runs(docs)
    assert set(out.columns) == set(docs.columns)

    def want(text):
        words = (text or "").encode().split()
        runs = _brute_runs(words)
        gone = {i for s, n, q in runs for i in range(s + q, s + n)}
        best = max(runs, key=lambda run: (run[1] / run[2], -run[0], -run[2]), default=(None,) * 3)
        return len(words), runs, *best, " ".join(w.decode() for i, w in enumerate(words) if i not in gone)

    got = [(str(r.doc_id), r.start, r.repetition, len(r.periodic.runs) > 0, (p := r.periodic).n_words, [tuple(x) for x in p.runs], p.start, p.length, p.period, p.collapsed) for r in out.collect()]
    expected = [(str(d), s, n, len((w := want(t))[1]) > 0, *w) for d, t, n, _, s in rows]
    assert sorted(map(repr, got)) == sorted(map(repr, expected))
    assert sum(e[3] for e in expected) > 5
    assert periodic.collapse_runs(docs.limit(0)).count() == 0


def test_planted_runs(spark):
    rows, _ = _documents(spark)
    got = {(str(r.doc_id), r.text) for r in periodic.with_planted_runs(spark.createDataFrame(rows, DOCS)).collect()}
    want = set()
    for doc_id, text, *_ in rows:
        w = (text or "").encode().split()
        h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
        if w and h % 10 == 0:
            g, n = h // 10, len(w)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        want.add((str(doc_id), b" ".join(w).decode()))
    assert got == want


# --- op13 -----------------------------------------------------------------------------------

VECTORS = "vec_id long, embedding array<float>, label int, cluster int, distance string"


def _lloyd(rows, k=16, rounds=3):
    """Plain k-means of whole integers, every distance each time."""
    kept = [(v, [int(np.floor(64 * float(x))) for x in e]) for v, e in rows if e is not None and len(e) == 64 and all(x is not None and np.isfinite(x) for x in e)]
    starts = sorted((hashlib.sha256(b"1:%d" % v).hexdigest(), p) for v, p in kept if v is not None)[:k]
    centres = [p for _, p in starts]
    gap = lambda p, c: sum((a - b) ** 2 for a, b in zip(p, c, strict=True))
    for turn in range(rounds + 1):
        found = [min((gap(p, c), j) for j, c in enumerate(centres)) for _, p in kept]
        if turn < rounds:
            for j in range(len(centres)):
                if mine := [p for (_, p), (_, a) in zip(kept, found, strict=True) if a == j]:
                    centres[j] = [sum(x) // len(mine) for x in zip(*mine, strict=True)]
    inertia = Counter()
    for d, j in found:
        inertia[j] += d
    return sorted((repr(v), j, d, inertia[j], sum(inertia.values()), hashlib.sha256(",".join(map(str, centres[j])).encode()).hexdigest()) for (v, _), (d, j) in zip(kept, found, strict=True))


def _vectors(n, seed=1):
    r = np.random.default_rng(seed)
    centres = r.normal(size=(7, 64))
    rows = [(i, (centres[i % 7] / 8 + r.normal(size=64) / 20).astype(np.float32).tolist()) for i in range(n)]
    rows += [(n + i, [float(i % 2)] + [0.0] * 63) for i in range(40)]  # many ties
    rows += [rows[3], (None, rows[4][1]), (n + 50, rows[5][1]), (n + 51, None), (n + 52, []), (n + 53, [1.0] * 63), (n + 54, [1.0] * 65)]
    return rows + [(n + 55, [float("nan")] + [1.0] * 63), (n + 56, [float("inf")] * 64), (n + 57, [None] + [1.0] * 63), (n + 58, [1e5, -1e5] * 32), (n + 59, [-0.0001] * 64)]


@pytest.mark.parametrize("n", [0, 3, 300])
def test_clusters_equal_plain_rounds(spark, n):
    rows = _vectors(n)[: None if n else 40]
    out = exponion.cluster_vectors(spark.createDataFrame([(*r, 1, 2, "x") for r in rows], VECTORS).repartition(3))
    got = sorted((repr(r.vec_id), r.cluster, r.distance, r.cluster_inertia, r.inertia, hashlib.sha256(",".join(map(str, r.centroid)).encode()).hexdigest()) for r in out.collect())
    assert got == _lloyd(rows)
    assert [r.h for r in out.select(exponion.centroid_hash().alias("h")).limit(1).collect()] == [g[-1] for g in got if g[-1] == out.select(exponion.centroid_hash().alias("h")).first().h][:1]


def test_clusters_of_few_unnamed_and_large_vectors(spark):
    make = lambda rows: spark.createDataFrame([(*r, 1, 2, "x") for r in rows], VECTORS)
    assert exponion.cluster_vectors(make([])).count() == 0
    assert exponion.cluster_vectors(make([(1, None), (2, [1e30] * 64)])).count() == 0
    one = exponion.cluster_vectors(make([(1, [0.5] * 64), (2, [1.0] * 64)]), k=1, rounds=1).collect()
    assert sorted((r.vec_id, r.cluster, r.distance, r.inertia) for r in one) == [(1, 0, 64 * 256, 2 * 64 * 256), (2, 0, 64 * 256, 2 * 64 * 256)]
    unnamed = exponion.cluster_vectors(make([(None, [0.5] * 64)])).collect()
    assert [tuple(r) for r in unnamed] == [(None,) * 6]


def test_bounds_spare_most_distances():
    r = np.random.default_rng(3)
    centres = r.integers(-900, 900, (16, 64))
    points = np.repeat(centres, 200, 0) + r.integers(-40, 40, (3200, 64))
    first = exponion.Centroids(centres)
    state = first.scan_all(points)
    moved = exponion.Centroids(centres + 1, centres)
    seen = []
    again = exponion.squared
    try:
        exponion.squared = lambda p, c: seen.append(len(p)) or again(p, c)
        cluster, upper, lower = moved.reassign(points, *state)
    finally:
        exponion.squared = again
    assert sum(seen) < len(points)  # of 16 * len(points)
    gaps = np.stack([again(points, c) for c in centres + 1], 1)
    assert (cluster == gaps.argmin(1)).all()
    assert (np.sqrt(gaps.min(1)) <= upper).all() and (np.sqrt(np.sort(gaps, 1)[:, 1]) >= lower).all()


# --- the SQL, over odd rows -----------------------------------------------------------------


def test_queries_agree_with_their_sql_on_odd_rows(spark, tmp_path):
    rows, _ = _documents(spark)
    docs = [r for r in dict((r[0], r) for r in rows if r[0] is not None).values()]
    spark.createDataFrame(docs, DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    vectors = {v: (v, e, 1, 2, "x") for v, e in _vectors(100) if v is not None}
    spark.createDataFrame(list(vectors.values()), VECTORS).write.parquet(f"{tmp_path}/embeddings.parquet")
    con = duckdb.connect()
    for table in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{tmp_path}/{table}.parquet/*.parquet'")
    for name, sql in (("op11_suffix_repetition", oracles.REPEATS), ("op12_word_runs", oracles.RUNS), ("op13_exponion_clusters", oracles.CLUSTERS)):
        df = queries.QUERIES[name](spark, str(tmp_path))
        want = con.sql(sql)
        assert set(want.columns) == set(df.columns)
        assert sorted(map(repr, map(tuple, df.select(*want.columns).collect()))) == sorted(map(repr, want.fetchall())), name
