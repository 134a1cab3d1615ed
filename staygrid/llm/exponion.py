"""Operator 13: k-means over integer vectors with exponion search, exact in every decision.

A vector carries its cluster, an upper bound on the distance to that centroid and a lower bound on the
distance to every other one. Between rounds the bounds move by as much as centroids moved. A vector
whose upper bound lies below the lower one keeps its cluster unseen. Else its distance is worked out anew,
and if that doesn't settle it, only centroids inside a ball around its own centroid are scanned: within
twice the distance plus the distance from that centroid to its nearest neighbour, the first of its sorted
list of distances to the others. The radius is inclusive and bounds are rounded outwards, so every
centroid that ties is compared, and squared distances are compared as integers (ties: smaller number).

Vectors are dealt as they lie; each round is one pass over them by executors, whose table (vector, cluster,
bounds) is written to the shared folder, so a lost executor repeats its part of a round alone. Sums of
clusters are Spark's own grouping of that table; the driver holds k centroids and their exact sums.

Defined cases: vectors of another length, null, or with null or non-finite components are left out, and so are
those with a component whose integer is 2**27 or more in size (their squared distances don't fit in a long;
sums of up to 2**36 such components do). A null vec_id has no hash, and so is never a first centroid;
of rows that share a vec_id the smaller vector goes first. Fewer kept vectors than k make fewer centroids;
none make no rows (vectors without any first centroid, as all ids are null, have cluster and distances
null). Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staygrid.llm.common import drop_table, materialize

DIM, CLUSTERS, ROUNDS, SCALE = 64, 16, 3, 64
#: Components at or beyond it are too large for squared distances in a long.
LARGEST = 1 << 27
#: The part of a bound that it is moved outwards by for rounding, and a squared distance above all.
SLACK, NOTHING = 1e-9, np.iinfo(np.int64).max
_STATE = "vec_id long, point array<int>, cluster int, upper double, lower double"


def integer_points(vectors: DataFrame, dim: int = DIM) -> DataFrame:
    """vec_id and point: floor(SCALE * x) of the vectors that can be clustered."""
    scaled = F.transform("embedding", lambda x: F.floor(x.cast("double") * SCALE))
    whole = (F.size("embedding") == dim) & F.forall("embedding", lambda x: x.isNotNull() & (F.abs(x.cast("double") * SCALE) < LARGEST))  # NaN is largest of all
    return vectors.where(whole).select(F.col("vec_id").cast("long").alias("vec_id"), scaled.cast("array<int>").alias("point"))


def first_centroids(points: DataFrame, k: int = CLUSTERS) -> np.ndarray:
    """The vectors of the k smallest hashes of their ids."""
    named = points.where("vec_id is not null").select(F.sha2(F.concat(F.lit("1:"), F.col("vec_id").cast("string")), 256).alias("hash"), "point")
    rows = named.orderBy("hash", "point").limit(k).collect()
    return np.array([r["point"] for r in rows], np.int64)


def squared(points: np.ndarray, centroid: np.ndarray) -> np.ndarray:
    gap = points - centroid
    return np.einsum("ij,ij->i", gap, gap)


def _up(squares: np.ndarray) -> np.ndarray:
    return np.sqrt(squares.astype(np.float64)) * (1 + SLACK)


def _down(squares: np.ndarray) -> np.ndarray:
    return np.sqrt(squares.astype(np.float64)) * (1 - SLACK)


class Centroids:
    """Centroids, each one's sorted distances to the others, and how far they moved in the round before."""

    def __init__(self, places: np.ndarray, earlier: np.ndarray | None = None):
        self.places, k = places, len(places)
        gaps = np.stack([squared(places, c) for c in places])
        near, far = _down(gaps), _up(gaps)
        self.order = [np.array(sorted(set(range(k)) - {a}, key=lambda j: (gaps[a, j], j)), np.int64) for a in range(k)]
        self.apart = [near[a, others] for a, others in enumerate(self.order)]
        self.nearest_down = np.array([near[a, others[0]] if len(others) else np.inf for a, others in enumerate(self.order)])
        self.nearest_up = np.array([far[a, others[0]] if len(others) else np.inf for a, others in enumerate(self.order)])
        self.moved = np.zeros(k) if earlier is None else _up(squared(places, earlier))
        self.others_moved = np.array([np.delete(self.moved, a).max(initial=0.0) for a in range(k)])

    def scan_all(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Cluster and bounds of vectors that have none yet."""
        best, second, cluster = squared(points, self.places[0]), np.full(len(points), NOTHING), np.zeros(len(points), np.int64)
        for j in range(1, len(self.places)):
            d = squared(points, self.places[j])
            second = np.minimum(second, np.maximum(best, d))
            cluster = np.where(d < best, j, cluster)
            best = np.minimum(best, d)
        return cluster, _up(best), _down(second)

    def scan_ball(self, points: np.ndarray, own: int, best: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Cluster and bounds of vectors at squared distance `best` from their centroid: others inside the ball alone are scanned."""
        inside = np.searchsorted(self.apart[own], 2 * _up(best) + self.nearest_up[own], side="right")
        rows = np.argsort(-inside, kind="stable")
        points, best, counts = points[rows], best[rows].copy(), -inside[rows]
        second, cluster = np.full(len(rows), NOTHING), np.full(len(rows), own)
        for t, j in enumerate(self.order[own]):
            n = np.searchsorted(counts, -t)  # vectors whose ball holds more than t others
            if not n:
                break
            d, was = squared(points[:n], self.places[j]), best[:n]
            second[:n] = np.minimum(second[:n], np.maximum(was, d))
            cluster[:n] = np.where((d < was) | ((d == was) & (j < cluster[:n])), j, cluster[:n])
            best[:n] = np.minimum(was, d)
        back = np.argsort(rows)
        return cluster[back], _up(best[back]), _down(second[back])

    def reassign(self, points: np.ndarray, cluster: np.ndarray, upper: np.ndarray, lower: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Cluster and bounds of vectors that have those of the round before."""
        cluster, upper, lower = cluster.copy(), upper + self.moved[cluster], lower - self.others_moved[cluster]
        safe = np.maximum(lower, self.nearest_down[cluster] / 2)
        stale = np.flatnonzero(upper >= safe)
        own = squared(points[stale], self.places[cluster[stale]])
        upper[stale] = _up(own)
        open_ = upper[stale] >= safe[stale]
        stale, own, was = stale[open_], own[open_], cluster[stale[open_]]
        for a in np.unique(was):
            mine = was == a
            rows = stale[mine]
            cluster[rows], upper[rows], lower[rows] = self.scan_ball(points[rows], int(a), own[mine])
        return cluster, upper, lower


def _points(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("point").flatten().to_numpy().astype(np.int64).reshape(batch.num_rows, -1)


def _round(centroids: Centroids) -> Callable:
    """One round over vectors: those without a cluster (the first round) or with that of the round before."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points = _points(batch)
            if "cluster" in batch.schema.names:
                state = centroids.reassign(points, *[batch.column(c).to_numpy() for c in ("cluster", "upper", "lower")])
            else:
                state = centroids.scan_all(points)
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("point"), *[pa.array(s, t) for s, t in zip(state, (pa.int32(), pa.float64(), pa.float64()), strict=True)]], ["vec_id", "point", "cluster", "upper", "lower"])

    return run


def _distances(centroids: Centroids) -> Callable:
    """Clusters and squared distances after the last round."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _round(centroids)(batches):
            cluster = batch.column("cluster").to_numpy()
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("cluster"), pa.array(squared(_points(batch), centroids.places[cluster]))], ["vec_id", "cluster", "distance"])

    return run


def _means(state: DataFrame, places: np.ndarray) -> np.ndarray:
    """Each centroid's exact floor(sum / count); those of empty clusters stay."""
    sums = [F.sum(F.get("point", F.lit(i)).cast("long")).alias(f"s{i}") for i in range(places.shape[1])]
    out = places.copy()
    for row in state.groupBy("cluster").agg(F.count("*").alias("n"), *sums).collect():
        out[row["cluster"]] = [row[f"s{i}"] // row["n"] for i in range(places.shape[1])]
    return out


def cluster_vectors(vectors: DataFrame, k: int = CLUSTERS, rounds: int = ROUNDS, dim: int = DIM) -> DataFrame:
    """vec_id, cluster, distance (squared), cluster_inertia, inertia and centroid (array) of each vector that is kept."""
    points = integer_points(vectors, dim)
    places = first_centroids(points, k)
    empty = "cast(null as int) cluster", "cast(null as long) distance", "cast(null as long) cluster_inertia", "cast(null as long) inertia", "cast(null as array<long>) centroid"
    if not len(places):
        return points.selectExpr("vec_id", *empty)
    spark, state, earlier = vectors.sparkSession, points, None
    for _ in range(rounds):
        assigned = materialize(state.mapInArrow(_round(Centroids(places, earlier)), _STATE), "clusters")
        if state is not points:
            drop_table(state)
        state, earlier, places = assigned, places, _means(assigned, places)
    found = materialize(state.mapInArrow(_distances(Centroids(places, earlier)), "vec_id long, cluster int, distance long"), "clustered")
    if state is not points:
        drop_table(state)
    sums = {r["cluster"]: int(r["s"]) for r in found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(20,0)")).alias("s")).collect()}
    fits = lambda n: n if n < 1 << 63 else None
    rows = [(a, fits(s), fits(sum(sums.values())), places[a].tolist()) for a, s in sums.items()]
    centres = spark.createDataFrame(rows, "centre int, cluster_inertia long, inertia long, centroid array<long>")  # k rows at most
    return found.join(F.broadcast(centres), F.col("cluster") == F.col("centre")).drop("centre")


def centroid_hash() -> Column:
    """Lowercase hex of the centroid's components as decimal integers with commas between."""
    return F.sha2(F.array_join(F.transform("centroid", lambda x: x.cast("string")), ","), 256)
