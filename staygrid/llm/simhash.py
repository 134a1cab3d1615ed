"""Operator 10: SimHash near-duplicates by a self-join of the binary trie of fingerprints.

Equal fingerprints are one leaf. Two fingerprints that differ in few bits differ in a `parts`-th of
the budget at most in one of `parts` equal parts of their bits. So there is a trie for each part,
which begins with that part's bits (fingerprints are turned), and only pairs within the part's share
of the budget are followed in its first bits, within the whole budget below. A cut through the trie,
as deep in each place as it takes for few leaves below, deals its subtrees out: a task gets two
subtrees whose prefixes are within the share and walks their nodes together, bit by bit, adding up
differing bits and leaving a pair of nodes as soon as the budget is exceeded. It returns a spanning
forest of what it linked, never the pairs. A leaf of a subtree d bits deep goes round 1 + d times for
each part if the share is one bit, and once as long as the trie isn't cut.

`similar_documents` links only what is also similar: the same walk with a wider budget, over the
tries of several fingerprints of each text, marks leaves with a partner; the sets of longer
shingles of these alone go to the tasks that found them, where pairs that share one of their rarest
shingles and aren't connected yet are checked by the Jaccard similarity of their sets: leaves that near
pairs connect in a task are a group. Groups of over BLOCK words are dealt to blocks, of which every two
meet by themselves. The fingerprints are of short shingles, which an edit changes
less than long ones; each further one scrambles the shingles' hashes anew.

Defined cases: null, empty and blank texts have fingerprint zero and link with one another;
repeated rows and equal texts share a component; rows of a null doc_id link as others do, and are
a component's smallest id only if all its ids are null; extra columns are ignored; no rows give
no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staygrid.llm.common import materialize, mix64, parallelism, tune, utf8
from staygrid.llm.components import connected_components, merge_labels

SHINGLE, SEED, BUDGET = 3, 42, 2
#: Parts of a fingerprint's bits for `near_duplicates`: one differing bit at most in one of them.
PARTS = 2
#: Of `similar_documents`: words in a shingle of the fingerprints and of the sets, fingerprints, differing bits, parts, and least Jaccard similarity.
SHORT, LONG, TABLES, WIDE, WIDE_PARTS, SIMILAR = 2, 5, 2, 7, 4, 0.8
#: Leaves in a subtree, above which it is cut.
SUBTREE = 1 << 18
#: Texts that may be asked for by a broadcast of their nodes, of some 60 bytes each.
BROADCAST = 200_000
#: Bits of a prefix whose leaves are counted, and bits by which prefixes of too many leaves are cut further.
COUNTED, FURTHER = 16, 8
#: Leaves of either node below which a pair of nodes is compared at once; node pairs held and compared at a time.
FEW, FRONTIER, AT_ONCE = 16, 1 << 17, 1 << 12
#: Words of a group whose texts are checked together, words after which small groups are, and pairs looked at together.
BLOCK, HELD, PAIRS = 1 << 20, 1 << 19, 1 << 18
_SPREAD = np.array([sum(((b >> (7 - i)) & 1) << (8 * i) for i in range(8)) for b in range(256)], "<u8")


def _shingles(text: str | None, shingle: int) -> bytes:
    """The XXH64 values of a text's word shingles, one after another."""
    words = utf8(text).lower().split()
    if not words:
        return b""
    grams = map(b" ".join, zip(*(words[i:] for i in range(shingle)), strict=False)) if len(words) >= shingle else [b" ".join(words)]
    digest = xxhash.xxh64_digest
    return b"".join([digest(g, SEED) for g in grams])


def _majority(shingles: bytes) -> int:
    if not shingles:
        return 0
    raw = np.frombuffer(shingles, np.uint8).reshape(-1, 8)
    votes = np.zeros(64, np.int64)
    for i in range(0, len(raw), 1 << 16):
        spread = _SPREAD[raw[i : i + (1 << 16)]]
        sums = np.add.reduceat(spread, np.arange(0, len(spread), 255), axis=0)  # bytes of up to 255
        votes += np.ascontiguousarray(sums).view(np.uint8).reshape(-1, 64).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * votes > len(raw)).tobytes(), "big")


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The 64-bit majority of the XXH64 values of a text's word shingles, unsigned."""
    return _majority(_shingles(text, shingle))


def several(text: str | None, shingle: int = SHORT, tables: int = TABLES) -> list[int]:
    """Fingerprints of a text by different hashes of its shingles, unsigned; the first is `fingerprint`."""
    raw = np.frombuffer(_shingles(text, shingle), "<u8")
    with np.errstate(over="ignore"):
        return [_majority((mix64(raw + np.uint64(k * 0x9E3779B97F4A7C15 % (1 << 64))) if k else raw).astype("<u8").tobytes()) for k in range(tables)]


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id and fp, the fingerprint as a signed long."""

    def run(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(t) for t in texts], np.uint64).view(np.int64))

    tune(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long"), F.pandas_udf(run, "long")(F.col("text").cast("string")).alias("fp"))


def _middle(leaves: np.ndarray, begin: np.ndarray, end: np.ndarray, depth: int) -> np.ndarray:
    """Where, in runs of sorted leaves with `depth` bits in common, the next bit becomes 1."""
    low = np.uint64(63 - depth)
    prefix = leaves[begin] >> low >> np.uint64(1) << low << np.uint64(1)
    return np.clip(np.searchsorted(leaves, prefix | (np.uint64(1) << low)), begin, end)


def _close(a: np.ndarray, b: np.ndarray, nodes: np.ndarray, budget: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of leaves within the budget below pairs of nodes of at most FEW leaves each (rows a0, a1, b0, b1)."""
    along = np.arange(FEW)
    i, j = nodes[0][:, None] + along, nodes[2][:, None] + along
    bits = np.bitwise_count(a[np.minimum(i, len(a) - 1)][:, :, None] ^ b[np.minimum(j, len(b) - 1)][:, None, :])
    near = (bits <= budget) & (i < nodes[1][:, None])[:, :, None] & (j < nodes[3][:, None])[:, None, :]
    which, x, y = np.nonzero(near)
    return i[which, x], j[which, y]


def walk(a: np.ndarray, b: np.ndarray, same: bool, depth: int, budget: int, share: int | None = None, width: int = 64) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions in sorted `a` and `b` (unsigned, `depth` bits in common each) within the budget.

    `same`: a is b, and each pair comes once. `share`: pairs that differ in more of the first `width`
    bits needn't be found. Nodes are runs of leaves; a row of the frontier is a pair of runs and the
    differing bits so far.
    """
    if not len(a) or not len(b):
        return
    allowed = lambda depth: budget if share is None or depth > width else share
    spent = int(np.bitwise_count((a[0] ^ b[0]) >> np.uint64(64 - depth))) if depth else 0
    stack = [(depth, np.array([[0], [len(a)], [0], [len(b)], [spent]], np.int64))] if spent <= allowed(depth) else []
    while stack:
        depth, nodes = stack.pop()
        if nodes.shape[1] > FRONTIER:
            stack += [(depth, part) for part in np.array_split(nodes, -(-nodes.shape[1] // FRONTIER), axis=1)]
            continue
        a0, a1, b0, b1, bits = nodes
        small = (a1 - a0 <= FEW) & (b1 - b0 <= FEW)
        few = nodes[:, small]
        for at in range(0, few.shape[1], AT_ONCE):
            i, j = _close(a, b, few[:, at : at + AT_ONCE], budget)
            if same:
                once = i < j
                i, j = i[once], j[once]
            if len(i):
                yield i, j
        if small.all():
            continue
        a0, a1, b0, b1, bits = nodes[:, ~small]
        am, bm = _middle(a, a0, a1, depth), _middle(b, b0, b1, depth)
        own = (a0 == b0) & (a1 == b1) & same
        children = [np.stack(x) for x in ((a0, am, b0, bm, bits), (am, a1, bm, b1, bits), (a0, am, bm, b1, bits + 1))]
        children.append(np.stack((am, a1, b0, bm, bits + 1))[:, ~own])  # of a node with itself, the mirror image
        nodes = np.concatenate(children, axis=1)
        alive = (nodes[1] > nodes[0]) & (nodes[3] > nodes[2]) & (nodes[4] <= allowed(depth + 1))
        if alive.any():
            stack.append((depth + 1, nodes[:, alive]))


class Subtrees:
    """A cut through the trie: the first fingerprint and the depth of each subtree, in order."""

    def __init__(self, starts: list[int], depths: list[int]):
        self.starts, self.depths = np.array(starts, np.uint64), np.array(depths, np.int64)

    def of(self, fps: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.starts, fps, "right") - 1

    def near(self, k: int, bits: int, width: int = 64) -> np.ndarray:
        """The subtrees whose prefix differs from that of subtree k in at most `bits` of the bits that both have (of the first `width`)."""
        depth = min(int(self.depths[k]), width)
        start = int(self.starts[k]) >> (64 - depth) << (64 - depth)
        flips = [sum(1 << (63 - i) for i in places) for n in range(bits + 1) for places in combinations(range(depth), n)]
        first = start ^ np.array(flips, np.uint64)
        last = first | np.uint64((1 << 64) - 1 >> depth if depth < 64 else 0)
        runs = zip(self.of(first).tolist(), self.of(last).tolist(), strict=True)
        return np.array(sorted({x for a, b in runs for x in range(a, b + 1)}), np.int64)


def split(counts: np.ndarray, limit: int) -> list[tuple[int, int]]:
    """First place and depth of the highest nodes over `counts` (a power of two of them) with at most `limit`."""
    sums, nodes, out = np.concatenate(([0], np.cumsum(counts))), [(0, 0)], []
    while nodes:
        first, depth = nodes.pop()
        width = len(counts) >> depth
        if width == 1 or sums[first + width] - sums[first] <= limit:
            out.append((first, depth))
        else:
            nodes += [(first, depth + 1), (first + width // 2, depth + 1)]
    return sorted(out)


def cut(leaves: DataFrame, subtree: int = SUBTREE) -> Subtrees:
    """Subtrees of at most `subtree` leaves (fp) or a 4096th of all, by counts of prefixes: of COUNTED bits, and of FURTHER more as often as a prefix holds too many."""

    def counted(rows: DataFrame, bits: int) -> dict[int, int]:
        return {r["p"]: r["n"] for r in rows.groupBy(F.shiftrightunsigned("fp", 64 - bits).alias("p")).agg(F.count("*").alias("n")).collect()}

    top = counted(leaves, COUNTED)  # at most 2 ** COUNTED rows
    counts = np.array([top.get(p, 0) for p in range(1 << COUNTED)])
    # prefixes that all hold too many are left, where subtrees grow with the input instead of their number
    limit, bits = max(subtree, int(counts.sum()) >> 12), COUNTED
    nodes = [(first << (64 - bits), depth) for first, depth in split(counts, subtree)]
    dense = np.flatnonzero(counts > limit).tolist()
    while dense and bits + FURTHER <= 64:  # fewer than 2 ** 12 prefixes
        below = counted(leaves.where(F.shiftrightunsigned("fp", 64 - bits).isin(dense)), bits + FURTHER)
        gone = {(p << (64 - bits), bits) for p in dense}
        nodes = [node for node in nodes if node not in gone]
        for p in dense:
            inside = split(np.array([below.get((p << FURTHER) + i, 0) for i in range(1 << FURTHER)]), subtree)
            nodes += [((p << (64 - bits)) + (first << (64 - bits - FURTHER)), bits + depth) for first, depth in inside]
        bits += FURTHER
        dense = [p for p, n in below.items() if n > limit]
    nodes.sort()
    return Subtrees([start for start, _ in nodes], [depth for _, depth in nodes])


def turned(fps: np.ndarray, bits: int) -> np.ndarray:
    """Fingerprints (signed) turned left by so many bits, or right if it is negative."""
    x, left = fps.view(np.uint64), np.uint64(bits % 64)
    return (x << left | x >> np.uint64(-bits % 64)).view(np.int64) if left else fps


_DEALT = "low long, high long, own long, fp long"


def deal(leaves: DataFrame, trees: Subtrees, share: int, width: int) -> DataFrame:
    """low, high, own, fp: each leaf of one trie once for each pair of subtrees within the share that it is in (own: its subtree)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        near: dict[int, np.ndarray] = {}
        for batch in batches:
            fps = batch["fp"].to_numpy()
            own = trees.of(fps.view(np.uint64))
            for k in np.unique(own).tolist():
                if k not in near:
                    near[k] = trees.near(k, share, width)
                mine, other = fps[own == k], near[k]
                yield pd.DataFrame({"low": np.repeat(np.minimum(other, k), len(mine)), "high": np.repeat(np.maximum(other, k), len(mine)), "own": k, "fp": np.tile(mine, len(other))})

    return leaves.select("fp").mapInPandas(run, _DEALT)


class Tries:
    """The tries of some fingerprints, one for each part of their bits."""

    def __init__(self, leaves: DataFrame, budget: int, parts: int, subtree: int | None):
        self.budget, self.share, self.width = budget, budget // parts, 64 // parts
        self.trees = [cut(self._turned(leaves, k), subtree or SUBTREE) for k in range(parts)]

    def _turned(self, leaves: DataFrame, part: int) -> DataFrame:
        bits = part * self.width
        return leaves.select(F.shiftleft("fp", bits).bitwiseOR(F.shiftrightunsigned("fp", 64 - bits)).alias("fp") if bits else "fp")

    def deal(self, leaves: DataFrame) -> DataFrame:
        """part, low, high, own, fp: see `deal`; fp is turned."""
        dealt = [deal(self._turned(leaves, k), trees, self.share, self.width).withColumn("part", F.lit(k)) for k, trees in enumerate(self.trees)]
        return reduce(DataFrame.unionByName, dealt)

    def meet(self, part: int, low: int, high: int, own: np.ndarray, fps: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Positions in `fps` (turned) of pairs of leaves of two subtrees of a part within the budget that no earlier part finds."""
        fps, depths = fps.view(np.uint64), self.trees[part].depths
        sides = [np.flatnonzero(own == k) for k in ((low,) if low == high else (low, high))]
        sides = [side[np.argsort(fps[side])] for side in sides]
        for i, j in walk(fps[sides[0]], fps[sides[-1]], low == high, int(min(depths[low], depths[high])), self.budget, self.share, self.width):
            i, j = sides[0][i], sides[-1][j]
            differ, fresh = fps[i] ^ fps[j], np.ones(len(i), bool)
            for earlier in range(part):  # its bits are the last ones but `part - earlier` parts
                bits = differ >> np.uint64((part - earlier - 1) * self.width) & np.uint64((1 << self.width) - 1)
                fresh &= np.bitwise_count(bits) > self.share
            if fresh.any():
                yield i[fresh], j[fresh]


def trie_links(leaves: DataFrame, budget: int = BUDGET, subtree: int | None = None, parts: int = PARTS) -> DataFrame:
    """A table (a, b) of fingerprints that connects what `leaves` (fp, each once) has within the budget."""
    tries = Tries(leaves, budget, parts, subtree)

    def forest(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        part, low, high = map(int, key)
        fps = group["fp"].to_numpy()
        ids, rank = np.unique(turned(fps, -part * tries.width), return_inverse=True)
        labels = np.arange(len(ids))
        for i, j in tries.meet(part, low, high, group["own"].to_numpy(), fps):
            labels = merge_labels(labels, rank[i], rank[j])
        linked = labels != np.arange(len(ids))
        return pd.DataFrame({"a": ids[linked], "b": ids[labels[linked]]})

    return tries.deal(leaves).groupBy("part", "low", "high").applyInPandas(forest, "a long, b long")


def _components(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """`nodes` (node, rep) with component_id: the smallest rep of those that `links` connect."""
    roots = connected_components(links).withColumnRenamed("node", "_node")
    rooted = nodes.join(roots, nodes["node"] == F.col("_node"), "left").withColumn("_root", F.coalesce("root", "node")).drop("_node", "root")
    smallest = rooted.groupBy("_root").agg(F.min("rep").alias("component_id"))
    return rooted.join(smallest, "_root").drop("_root")


def near_duplicates(docs: DataFrame, budget: int = BUDGET, subtree: int | None = None, parts: int = PARTS) -> DataFrame:
    """doc_id, fp (signed long) and component_id (the smallest doc_id reachable) for each row."""
    fps = materialize(fingerprints(docs), "fingerprints")
    leaves = materialize(fps.groupBy("fp").agg(F.min("doc_id").alias("rep")), "leaves")
    found = _components(leaves.select(F.col("fp").alias("node"), "rep"), trie_links(leaves, budget, subtree, parts))
    return fps.join(found.select(F.col("node").alias("fp"), "component_id"), "fp").select("doc_id", "fp", "component_id")


class Forest:
    """Which of some numbers are connected; the smallest of a component stands for it."""

    def __init__(self, n: int):
        self.above = list(range(n))

    def root(self, x: int) -> int:
        while self.above[x] != x:
            self.above[x] = x = self.above[self.above[x]]
        return x

    def link(self, x: int, y: int) -> None:
        x, y = self.root(x), self.root(y)
        self.above[max(x, y)] = min(x, y)

    def roots(self) -> np.ndarray:
        return np.array([self.root(x) for x in range(len(self.above))], np.int64)


def _runs(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers of all runs, one run after another."""
    before = np.cumsum(lengths) - lengths
    return np.arange(int(lengths.sum())) + np.repeat(starts - before, lengths)


def _by_frequency(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Each member's rank, rare ones first, in all sets one after another, and how many sets have the member of each rank."""
    members = np.concatenate(sets)
    order = np.argsort(members)
    members = members[order]
    edges = np.flatnonzero(np.concatenate(([True], members[1:] != members[:-1])))
    times = np.diff(edges, append=len(members))
    by_times = np.argsort(times, kind="stable")
    rank_of = np.empty(len(times), np.int32)
    rank_of[by_times] = np.arange(len(times), dtype=np.int32)
    rank = np.empty(len(members), np.int32)
    rank[order] = np.repeat(rank_of, times)
    return rank, times[by_times].astype(np.int32)


def similar_pairs(sets: list[np.ndarray], allowed: Callable[[np.ndarray, np.ndarray], np.ndarray], least: float = SIMILAR) -> Forest:
    """Connect sets (sorted, without repeats) that have at least this Jaccard similarity, of pairs that `allowed` lets pass.

    Members are ordered from rare to frequent. Two similar sets share one among the first few of both, so
    only such pairs are looked at, by an index of these members; of them, those that aren't connected yet and
    could still share enough, by where the shared member stands in both, are checked.
    """
    n, sizes = len(sets), np.array([len(x) for x in sets], np.int64)
    forest = Forest(n)
    if n < 2 or not sizes.sum():
        return forest
    by_size = np.argsort(sizes, kind="stable")
    place = np.argsort(by_size)  # sets in order of their sizes
    rank, times = _by_frequency(sets)
    owner = np.repeat(np.arange(n, dtype=np.int32), sizes)
    key = owner * np.int64(len(times))
    key += rank
    key.sort()  # each set's members from rare to frequent
    rank = (key - owner * np.int64(len(times))).astype(np.int32)
    del key
    shared = times[rank] > 1
    at = _runs(np.zeros(n, np.int64), sizes).astype(np.int32)
    ordered = [rank[a:b] for a, b in zip((np.cumsum(sizes) - sizes).tolist(), np.cumsum(sizes).tolist(), strict=True)]
    whole = lambda x: np.ceil(x - 1e-9).astype(np.int64)
    probing = np.flatnonzero(shared & (at < (sizes - whole(least * sizes) + 1).astype(np.int32)[owner]))
    indexed = np.flatnonzero(shared & (at < (sizes - whole(2 * least / (1 + least) * sizes) + 1).astype(np.int32)[owner]))
    # index: members, then sets by size
    key = rank[indexed].astype(np.int64) * n + place[owner[indexed]]
    sort = np.argsort(key)
    key, of, where = key[sort], owner[indexed][sort], at[indexed][sort]
    # the largest sets look first: they may meet all others, and what they connect needn't meet any more
    probing = probing[np.argsort(-place[owner[probing]], kind="stable")]
    p_rank, p_owner, p_at = rank[probing].astype(np.int64), owner[probing], at[probing]
    del owner, at, shared, indexed, probing
    large_enough = np.searchsorted(sizes[by_size], whole(least * sizes))  # the first set by size that is
    mark = np.zeros(len(times), bool)
    done, step = 0, 256
    while done < len(p_rank):
        roots = forest.roots()
        held = np.bincount(roots, minlength=n)
        large = [c for c in np.argsort(-held)[:4].tolist() if held[c] > max(n // 16, 64)]
        some = np.arange(done, min(done + step, len(p_rank)))
        done, step = done + step, min(2 * step, 1 << 16)
        mine = roots[p_owner[some]]
        parts = [(some[~np.isin(mine, large)], slice(None)), *[(some[mine == c], roots[of] != c) for c in large]]
        for probes, kept in parts:
            own_key, own_of, own_where = key[kept], of[kept], where[kept]
            first = np.searchsorted(own_key, p_rank[probes] * n + large_enough[p_owner[probes]])
            count = np.maximum(np.searchsorted(own_key, p_rank[probes] * n + place[p_owner[probes]]) - first, 0)
            for few in np.split(np.arange(len(probes)), np.flatnonzero(np.diff(np.cumsum(count) // PAIRS)) + 1):
                y, entries = np.repeat(p_owner[probes[few]], count[few]), _runs(first[few], count[few])
                x, i, j = own_of[entries], own_where[entries], np.repeat(p_at[probes[few]], count[few])
                enough = whole(least / (1 + least) * (sizes[x] + sizes[y]))
                roots = forest.roots()
                good = (np.minimum(i, j) + np.minimum(sizes[x] - i, sizes[y] - j) >= enough) & (roots[x] != roots[y])
                good[good] = allowed(x[good], y[good])
                _check(forest, ordered, sizes, mark, least, *_grouped(*np.divmod(np.unique(y[good].astype(np.int64) * n + x[good]), n)))
    return forest


def _check(forest: Forest, ordered: list[np.ndarray], sizes: np.ndarray, mark: np.ndarray, least: float, keys: list[int], values: list[np.ndarray]) -> None:
    """Link each set of `keys` with those of its `values` that are similar and not connected with it."""
    for b, others in zip(keys, values, strict=True):
        mark[ordered[b]] = True
        for a in others.tolist():
            if forest.root(a) != forest.root(b):
                common = int(np.count_nonzero(mark[ordered[a]]))
                if common >= least * (sizes[a] + sizes[b] - common):
                    forest.link(a, b)
        mark[ordered[b]] = False


def _grouped(keys: np.ndarray, values: np.ndarray) -> tuple[list[int], list[np.ndarray]]:
    """Sorted keys, each once, and the values of each."""
    edges = np.flatnonzero(np.diff(keys, prepend=-1))
    return keys[edges].tolist(), np.split(values, edges[1:]) if len(edges) else []


def _verified(least: float, rows: pd.DataFrame) -> pd.DataFrame:
    """Links between texts of one group (`gid`) whose fingerprints differ in at most `most` bits and whose sets are similar, as a forest of (a, b) with b the smallest id.

    `apart`: only between texts of different blocks.
    """
    rows = rows.sort_values(["node", "content"])
    ids, fps = rows["node"].to_numpy(), rows["fp"].to_numpy().view(np.uint64)
    gid, block, most, apart = (rows[c].to_numpy() for c in ("gid", "block", "most", "apart"))
    near = lambda x, y: (gid[x] == gid[y]) & (np.bitwise_count(fps[x] ^ fps[y]) <= most[x]) & (~apart[x] | (block[x] != block[y]))
    labels = similar_pairs([np.frombuffer(x, np.uint64) for x in rows["shingles"]], near, least).roots()
    linked = labels != np.arange(len(ids))
    return pd.DataFrame({"a": ids[linked], "b": ids[labels[linked]]})


def _check_sorted(least: float) -> Callable:
    """`_verified` over rows that come group by group: whole groups together, until they have HELD members."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        size = 0
        for batch in batches:
            if not len(batch):
                continue
            edges = np.flatnonzero(np.diff(batch["gid"].to_numpy())) + 1
            if size >= HELD and held[-1]["gid"].iloc[-1] != batch["gid"].iloc[0]:
                yield _verified(least, pd.concat(held))
                held, size = [], 0
            if size >= HELD and len(edges):  # the group at hand ends within this batch
                yield _verified(least, pd.concat([*held, batch.iloc[: edges[0]]]))
                held, size, batch = [], 0, batch.iloc[edges[0] :]
            if len(batch):
                held.append(batch)
                size += int(batch["shingles"].map(len).sum()) // 8
        if held:
            yield _verified(least, pd.concat(held))

    return run


def similar_documents(docs: DataFrame, budget: int = WIDE, shingle: int = SHORT, words: int = LONG, least: float = SIMILAR, subtree: int | None = None, tables: int = TABLES, parts: int = WIDE_PARTS, block: int = BLOCK) -> DataFrame:
    """doc_id and component_id for each row, as of `near_duplicates`, with links between texts alone that are
    within `budget` bits in one of `tables` fingerprints and whose sets of shingles of `words` words have a
    Jaccard similarity of at least `least`.

    Texts that are equal but for case and white space link without a check.
    """

    def describe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            fps = [np.array(several(t, shingle, tables), np.uint64).view(np.int64) for t in batch["text"]]
            yield batch[["doc_id", "node"]].assign(content=[_content(t) for t in batch["text"]], fps=fps, size=[len(utf8(t).split()) for t in batch["text"]])

    def sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            batch = batch[[_content(t) == c for t, c in zip(batch["text"], batch["content"], strict=True)]]
            yield batch[["content"]].assign(shingles=[np.unique(np.frombuffer(_shingles(t, words), np.uint64)).tobytes() for t in batch["text"]])

    tune(docs.sparkSession)
    text = F.col("text").cast("string")
    # a row without an id goes by a stand-in, which is a text's id only if all its rows lack one
    stand_in = F.shiftright(F.xxhash64(text), 2) - F.lit(1 << 62)
    narrow = docs.select(F.col("doc_id").cast("long"), text.alias("text")).withColumn("node", F.coalesce("doc_id", stand_in))
    fps = materialize(narrow.mapInPandas(describe, "doc_id long, node long, content binary, fps array<long>, size long"), "fingerprints")
    texts = fps.groupBy("content").agg(F.min("doc_id").alias("rep"), F.min("node").alias("_any"), F.first("fps").alias("fps"), F.first("size").alias("size"))
    texts = materialize(texts.select("content", "rep", F.coalesce("rep", "_any").alias("node"), "fps", "size"), "texts")
    each = texts.select("content", "node", "size", F.posexplode("fps").alias("table", "fp"))
    leaves = [each.where(F.col("table") == k).groupBy("fp").agg(F.count("*").alias("n")) for k in range(tables)]
    tries = [Tries(some, budget, parts, subtree) for some in leaves]

    def mark(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        table, part, low, high = map(int, key)
        of = group["fp"].to_numpy()
        near, labels, pairs, size = np.zeros(len(of), bool), np.arange(len(of)), [], 0
        for i, j in tries[table].meet(part, low, high, group["own"].to_numpy(), of):
            near[i] = near[j] = True
            pairs.append((i, j))
            size += len(i)
            if size > PAIRS:
                labels, pairs, size = merge_labels(labels, *map(np.concatenate, zip(*pairs, strict=True))), [], 0
        if pairs:
            labels = merge_labels(labels, *map(np.concatenate, zip(*pairs, strict=True)))
        turn = -part * tries[table].width
        return group.loc[near, dealt].assign(label=turned(of[labels[near]], turn), fp=turned(of[near], turn))

    dealt = ["table", "part", "low", "high"]
    every = lambda frames: reduce(DataFrame.unionByName, [df.withColumn("table", F.lit(k)) for k, df in enumerate(frames)])
    near = every(t.deal(some) for t, some in zip(tries, leaves, strict=True)).groupBy(*dealt).applyInPandas(mark, "table int, part int, low long, high long, label long, fp long")
    # leaves that near pairs connect are a group, and so are texts of one fingerprint
    shared = every(some.where("n > 1").select("fp") for some in leaves).select("table", F.lit(-1).alias("part"), F.lit(0).cast("long").alias("low"), F.lit(0).cast("long").alias("high"), F.col("fp").alias("label"), "fp")
    by = [*dealt, "label"]
    near = materialize(near.unionByName(shared), "near")
    wanted = materialize(each.join(near.select("table", "fp").distinct(), ["table", "fp"]), "wanted")
    asked = wanted.select("content", F.col("node").alias("_node")).distinct()
    if asked.count() <= BROADCAST:  # then texts needn't be shuffled to find those of few nodes
        asked = F.broadcast(asked)
    found = narrow.join(asked, narrow["node"] == asked["_node"]).select("content", "text").mapInPandas(sets, "content binary, shingles binary")
    found = wanted.join(found.dropDuplicates(["content"]), "content")
    # a group of many words is dealt to blocks, of which every two meet in a task
    words_of = wanted.groupBy("table", "fp").agg(F.sum("size").alias("size"))
    blocks = near.join(words_of, ["table", "fp"]).groupBy(*by).agg(F.ceil(F.sum("size") / block).cast("int").alias("blocks")).where("blocks > 1")
    few = blocks.count() <= BROADCAST
    met = near.join(found, ["table", "fp"]).join(F.broadcast(blocks) if few else blocks, by, "left")
    own = F.pmod(F.xxhash64("content"), F.coalesce("blocks", F.lit(1))).cast("int")
    met = met.withColumn("block", own).withColumn("_other", F.explode(F.sequence(F.lit(0), F.coalesce("blocks", F.lit(1)) - 1)))
    pair = F.least("block", "_other"), F.greatest("block", "_other")
    met = met.select(F.xxhash64(*by, *pair).alias("gid"), F.when(F.col("part") < 0, 0).otherwise(budget).alias("most"), (F.col("block") != F.col("_other")).alias("apart"), "node", "content", "fp", "block", "shingles")
    links = met.repartition(parallelism(docs), "gid").sortWithinPartitions("gid").mapInPandas(_check_sorted(least), "a long, b long")
    return fps.join(_components(texts.select("content", "node", "rep"), links).select("content", "component_id"), "content").select("doc_id", "component_id")


def _content(text: str | None) -> bytes:
    """A digest of a text's words in lower case."""
    return xxhash.xxh3_128_digest(b" ".join(utf8(text).lower().split()))


def fp_hex(column: str = "fp") -> Column:
    return F.lower(F.lpad(F.hex(column), 16, "0"))
