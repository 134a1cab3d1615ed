"""Operator 7: near-duplicate vectors by collision-counting projections.

Equal vectors are one point. Many one-dimensional projections of each point are taken; two points
collide in one when the second lies in the window around the first, which is a run of the sorted
projection. A linked pair collides in most projections: the least count is calibrated so that
pairs just at the threshold reach it with the recall asked for, and only pairs that reach it are
verified by their exact cosine.

Windows are wide, so points first go to buckets in which counting is affordable: points of one
label, by the signs of some further projections, in as many tables as the recall takes. Signs and
tables follow from each label's number of points. In a first pass buckets hold codes alone (a byte
for each projection) and tell which points have a partner that collides often enough; in a second
pass the vectors of those points alone travel to the buckets that found them, where pairs are
counted, verified, and counted as links in the first table that puts both in one bucket. Tasks
return link counts and a spanning forest, never pairs.

A bucket of over CELL points is cut into blocks, and every two blocks meet in a task of their own:
no bucket is capped and no partner dropped.

Defined cases: vectors that are null, empty, zero or hold null or non-finite values, and null
labels, link with nothing (kept is true); repeated rows link with each other; vectors of
different lengths don't link; a null vec_id is kept without links; extra columns are ignored; no
rows give no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import cache
from math import acos, ceil, comb, erf, log, log2, pi, sqrt

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staygrid.llm.common import materialize, mix64, parallelism, tune
from staygrid.llm.components import connected_components, merge_labels

COSINE, RECALL, CELL, POINTS_PER_BUCKET = 0.93, 0.999, 1024, 512
#: Projections that are counted, the reach of a window to either side, and steps of a code in a unit.
PROJECTIONS, WINDOW, STEPS = 32, 0.7, 32
#: Projections whose signs make buckets' names.
SIGNS = 512
SEED = 20_240_607
_UNITS = "vec_id long, label long, unit binary, dim int, digest binary, code binary, signs binary"


def plan(points: int, cosine: float = COSINE, recall: float = RECALL) -> tuple[int, int]:
    """Signs in a bucket's name and tables, for a label of so many points; half of the loss that `recall` allows is spent here."""
    signs = max(0, ceil(log2(max(points, 1) / POINTS_PER_BUCKET)))
    if not signs:
        return 0, 1
    shared = (1 - acos(cosine) / pi) ** signs
    return signs, ceil(log((1 - recall) / 2) / log(1 - shared))


def least_collisions(cosine: float = COSINE, recall: float = RECALL) -> int:
    """The count that a pair of this cosine reaches but for the other half of the loss."""
    p = erf((WINDOW - 1 / STEPS) / sqrt(2 - 2 * cosine) / sqrt(2))  # codes are rounded
    below = 0.0
    for k in range(PROJECTIONS + 1):
        below += comb(PROJECTIONS, k) * p**k * (1 - p) ** (PROJECTIONS - k)
        if below > (1 - recall) / 2:
            return k
    return PROJECTIONS


def _unit(values: np.ndarray | None) -> np.ndarray | None:
    """The vector over its length, in double precision; None if it can't link."""
    if values is None or len(values) == 0:
        return None
    v = np.array([np.nan if x is None else x for x in values], np.float64)
    top = np.abs(v).max() if np.isfinite(v).all() else 0
    if top == 0:
        return None
    v = v / top
    return v / np.sqrt((v * v).sum())


def project(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes (a byte for each counted projection) and packed signs of points."""
    axes = np.random.default_rng([SEED, points.shape[1]]).normal(size=(PROJECTIONS + SIGNS, points.shape[1]))
    at = points @ axes.T
    return np.clip(np.rint(at[:, :PROJECTIONS] * STEPS) + 128, 0, 255).astype(np.uint8), np.packbits(at[:, PROJECTIONS:] >= 0, axis=1)


def _normal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        units = [_unit(v) for v in batch["embedding"]]
        out = batch[["vec_id", "label"]].assign(unit=None, dim=0, digest=None, code=None, signs=None)
        dims = np.array([0 if u is None else len(u) for u in units])
        for dim in np.unique(dims[dims > 0]).tolist():
            rows = np.flatnonzero(dims == dim)
            points = np.stack([units[i] for i in rows])
            codes, signs = project(points)
            raw = [p.astype("<f8").tobytes() for p in points]
            some = pd.DataFrame({"unit": raw, "digest": [xxhash.xxh3_128_digest(r) for r in raw], "code": [c.tobytes() for c in codes], "signs": [s.tobytes() for s in signs]}, index=out.index[rows])
            out.loc[some.index, some.columns] = some
            out.loc[some.index, "dim"] = dim
        yield out


@cache
def _places(signs: int, tables: int) -> np.ndarray:
    """Which signs make the names of a label's buckets, table by table."""
    rng = np.random.default_rng([SEED, signs])
    return np.concatenate([rng.permutation(SIGNS) for _ in range(-(-signs * tables // SIGNS))])[: signs * tables]


def cells(packed: np.ndarray, points: int, cosine: float) -> np.ndarray:
    """Each point's cell in each table of a label with so many points, from its packed signs."""
    signs, tables = plan(points, cosine)
    if not signs:
        return np.zeros((len(packed), 1), np.int64)
    places = _places(signs, tables)
    bits = np.unpackbits(packed, axis=1)[:, places].reshape(len(packed), tables, signs)
    return bits @ (np.int64(1) << np.arange(signs, dtype=np.int64))


def _matrix(rows: pd.Series | np.ndarray, dtype: type = np.uint8) -> np.ndarray:
    return np.frombuffer(b"".join(rows), dtype).reshape(len(rows), -1)


def _deal(cosine: float, codes: bool) -> Callable:
    """A row for each point and table: its bucket there (and, if `codes`, the point and its code)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for n, rows in batch.groupby(batch["n"].map(lambda n: plan(n, cosine))):
                name = rows["label"].to_numpy().view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + rows["dim"].to_numpy().astype(np.uint64)
                for table, cell in enumerate(cells(_matrix(rows["signs"]), int(rows["n"].iloc[0]), cosine).T):
                    bucket = mix64(mix64(name + np.uint64(table << 32)) + cell.astype(np.uint64)).view(np.int64)
                    yield rows[["point", "code"]].assign(bucket=bucket, table=table) if codes else pd.DataFrame({"bucket": bucket})

    return run


def _tally(sets: Iterator[np.ndarray]) -> list[np.ndarray]:
    """How many of the packed sets hold each member, as sets too: the counts' first bits, second bits and so on."""
    levels: list[list[np.ndarray]] = [[]]

    def put(x: np.ndarray, k: int) -> None:
        while True:
            if k == len(levels):
                levels.append([])
            levels[k].append(x)
            if len(levels[k]) < 3:
                return
            a, b, c = levels[k]
            one = a ^ b
            levels[k], x, k = [one ^ c], (a & b) | (one & c), k + 1

    for x in sets:
        put(x, 0)
    k = 0
    while k < len(levels):
        if len(levels[k]) == 2:
            a, b = levels[k]
            levels[k] = [a ^ b]
            put(a & b, k + 1)
        k += 1
    return [level[0] for level in levels]


def _windows(a: np.ndarray, b: np.ndarray, reach: int) -> Iterator[np.ndarray]:
    """For each projection: of each row of `a`, the packed set of rows of `b` in the window around it.

    A window is a run of the sorted projection: what precedes its end without what precedes its begin.
    """
    single = np.packbits(np.eye(len(b), dtype=np.uint8), axis=1)
    upto = np.zeros((len(b) + 1, single.shape[1]), np.uint8)  # the set of the first so many of the sorted line
    for k in range(a.shape[1]):
        order = np.argsort(b[:, k], kind="stable")
        line, centre = b[order, k].astype(np.int16), a[:, k].astype(np.int16)
        np.bitwise_or.accumulate(single[order], axis=0, out=upto[1:])
        yield upto[np.searchsorted(line, centre - reach)] ^ upto[np.searchsorted(line, centre + reach, "right")]


def colliding(a: np.ndarray, b: np.ndarray, needed: int) -> np.ndarray:
    """Whether b[j] is in the window around a[i] in at least `needed` projections, for each i and j."""
    reach = round(WINDOW * STEPS)
    if a.size * len(b) <= 1 << 17:
        return (np.abs(a[:, None].astype(np.int16) - b[None]) <= reach).sum(2) >= needed
    more = np.zeros((len(a), (len(b) + 7) // 8), np.uint8)
    equal = ~more
    planes = _tally(_windows(a, b, reach))
    for k in range(max(len(planes), needed.bit_length()) - 1, -1, -1):
        plane = planes[k] if k < len(planes) else np.zeros_like(more)
        if needed >> k & 1:
            equal &= plane
        else:
            more |= equal & plane
            equal &= ~plane
    return np.unpackbits(more | equal, axis=1, count=len(b)).view(bool)


Rows = dict[str, np.ndarray]


def _groups(batches: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[list[Rows]]:
    """The columns of each group of rows with equal keys, which come one after another; those of a batch at a time."""
    held: pd.DataFrame | None = None
    for batch in batches:
        rows = batch if held is None else pd.concat([held, batch], ignore_index=True)
        columns = {c: rows[c].to_numpy() for c in rows.columns}
        change = np.any([columns[k][1:] != columns[k][:-1] for k in keys], axis=0)
        edges = np.concatenate(([0], np.flatnonzero(change) + 1))
        yield [{c: x[a:b] for c, x in columns.items()} for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)]
        held = rows.iloc[edges[-1] :]
    if held is not None and len(held):
        yield [{c: held[c].to_numpy() for c in held.columns}]


def _by_group(rows: DataFrame, keys: list[str], work: Callable[[Rows], pd.DataFrame], schema: str) -> DataFrame:
    """`work` on each group, as groupBy.applyInPandas does, without a batch of its own for each small group."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for groups in _groups(batches, keys):
            if groups:
                yield pd.concat([work(g) for g in groups], ignore_index=True)

    return rows.repartition(parallelism(rows), *keys).sortWithinPartitions(*keys).mapInPandas(run, schema)


def _sides(group: Rows) -> Iterator[tuple[np.ndarray, np.ndarray, bool]]:
    """Positions of the rows of both blocks of a group, in parts that fit together; whether both are the same."""
    low, high = int(group["low"][0]), int(group["high"][0])
    left, right = ([p for p in np.array_split(rows, max(1, ceil(len(rows) / CELL))) if len(p)] for rows in (np.flatnonzero(group["block"] == k) for k in (low, high)))
    for i, some in enumerate(left):
        for other in right[i:] if low == high else right:
            yield some, other, low == high and some[0] == other[0]


_MARKS = "bucket long, table int, low int, high int, block int, point long"


def _mark(needed: int, group: Rows) -> pd.DataFrame:
    """The rows of a group that have a partner in it which collides often enough."""
    near = np.zeros(len(group["point"]), bool)
    if len(near) > 1:
        codes = _matrix(group["code"])
        for some, other, own in _sides(group):
            often = colliding(codes[some], codes[other], needed)
            if own:
                np.fill_diagonal(often, False)
            near[some] |= often.any(1)
            near[other] |= often.any(0)
    return pd.DataFrame({c: group[c][near] for c in ("bucket", "table", "low", "high", "block", "point")})


def _cosines(points: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    return np.concatenate([np.einsum("ij,ij->i", points[i[at : at + 8192]], points[j[at : at + 8192]]) for at in range(0, max(len(i), 1), 8192)])


def _verify(cosine: float, needed: int, group: Rows) -> pd.DataFrame:
    """Of marked points of a group: links counted here, and a forest that connects them."""
    order = np.argsort(group["point"])
    group = {c: x[order] for c, x in group.items()}
    ids, copies, table = group["point"], group["copies"], int(group["table"][0])
    points, codes = _matrix(group["unit"], np.float64), _matrix(group["code"])
    before = cells(_matrix(group["signs"]), int(group["n"][0]), cosine)[:, :table]
    links, labels = np.zeros(len(ids), np.int64), np.arange(len(ids))
    for some, other, own in _sides(group):
        often = colliding(codes[some], codes[other], needed)
        if own:
            often = np.triu(often, 1)
        if 8 * np.count_nonzero(often) > often.size:
            i, j = np.nonzero(often & (points[some] @ points[other].T >= cosine))
            i, j = some[i], other[j]
        else:
            i, j = np.nonzero(often)
            i, j = some[i], other[j]
            linked = _cosines(points, i, j) >= cosine
            i, j = i[linked], j[linked]
        for at in range(0, len(i), 1 << 16):
            x, y = i[at : at + (1 << 16)], j[at : at + (1 << 16)]
            first = (before[x] != before[y]).all(1)
            np.add.at(links, x[first], copies[y[first]])
            np.add.at(links, y[first], copies[x[first]])
        labels = merge_labels(labels, i, j)
    some = (links > 0) | (labels != np.arange(len(ids)))
    return pd.DataFrame({"point": ids[some], "links": links[some], "root": ids[labels[some]]})


def near_duplicates(vectors: DataFrame, cosine: float = COSINE, cell: int = CELL) -> DataFrame:
    """vec_id, n_links, component_id and kept for each row of vectors (vec_id, embedding, label)."""
    tune(vectors.sparkSession)
    needed = least_collisions(cosine)
    rows = vectors.select(F.col("vec_id").cast("long"), F.col("label").cast("long"), F.col("embedding").cast("array<double>"))
    # without nulls pandas keeps ids whole; these rows link with nothing
    known = F.col("vec_id").isNotNull() & F.col("label").isNotNull()
    units = materialize(rows.where(known).mapInPandas(_normal, _UNITS), "units")
    usable, same = units.where("unit is not null"), ["label", "dim", "digest"]
    points = usable.groupBy(*same).agg(F.min("vec_id").alias("vec_id"), F.count("*").alias("copies"), F.first("code").alias("code"), F.first("signs").alias("signs"))
    points = materialize(points.withColumn("point", F.monotonically_increasing_id()), "points")
    sized = points.join(points.groupBy("label", "dim").agg(F.count("*").alias("n")), ["label", "dim"])

    codes = sized.mapInPandas(_deal(cosine, True), "point long, code binary, bucket long, table int")
    large = sized.mapInPandas(_deal(cosine, False), "bucket long").groupBy("bucket").agg(F.count("*").alias("held")).where(F.col("held") > cell)
    parts = F.coalesce(F.ceil(F.col("held") / cell), F.lit(1)).cast("int")
    blocks = codes.join(large, "bucket", "left").withColumn("parts", parts).withColumn("block", F.pmod(F.xxhash64("point"), "parts").cast("int"))
    met = blocks.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    met = met.withColumns({"low": F.least("block", "other"), "high": F.greatest("block", "other")}).drop("other", "held", "parts")
    where = ["bucket", "table", "low", "high"]
    marks = materialize(_by_group(met, where, lambda group: _mark(needed, group), _MARKS), "marks")

    wanted = sized.join(marks.select("point").distinct(), "point", "left_semi").select("point", *same, "copies", "code", "signs", "n")
    whole = wanted.join(usable.select(*same, "unit"), same).dropDuplicates(["point"])
    whole = marks.join(whole, "point").drop("digest")
    found = materialize(_by_group(whole, ["label", "dim", *where], lambda group: _verify(cosine, needed, group), "point long, links long, root long"), "found")
    links = found.groupBy("point").agg(F.sum("links").alias("links"))
    roots = connected_components(found.select(F.col("point").alias("a"), F.col("root").alias("b"))).withColumnRenamed("node", "point")
    rooted = points.select("point", *same, "vec_id", "copies").join(links, "point", "left").join(roots, "point", "left").withColumn("root", F.coalesce("root", "point"))
    rooted = rooted.join(rooted.groupBy("root").agg(F.min("vec_id").alias("component_id")), "root")
    rooted = rooted.select(*same, (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id")
    out = usable.select("vec_id", *same).join(rooted, same).select("vec_id", "n_links", "component_id")
    alone = lambda df: df.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    out = out.unionByName(alone(units.where("unit is null"))).unionByName(alone(rows.where(~known)))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
