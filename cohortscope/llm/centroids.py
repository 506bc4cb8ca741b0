"""Centroid clustering in whole numbers, with distance bounds that spare most exact scans.

Every vector keeps a lower bound on its distance to all centroids but its own. When centroids move, the
vectors of a cluster lie in a sphere around the old centroid; in the plane of that centre and a centroid's
old and new place, the sphere is a disk, and on it the distance to the moving centroid falls by less than
it moved unless the disk reaches the line behind the new place. The bound is loosened by that much only.
A vector nearer to its own centroid than its bound stays; all others are compared with every centroid.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortscope.plans.scratch import written
from cohortscope.plans.ship import ship

SIZE = 64
SCALE = 64
CLUSTERS = 16
ROUNDS = 3
# Whole components below this give distances that fit into 64 bits, for up to 64 components.
LARGEST = 1 << 27
# Pieces that a quarter of a disk's edge is cut into, and what rounding of a bound may lose.
ARCS = 64
SAFE = 1e-9
_STATE = "vec_id long, vector array<int>, cluster int, distance long, bound double, scanned boolean"


def whole_vectors(embeddings: DataFrame, size: int = SIZE, scale: int = SCALE) -> DataFrame:
    """(vec_id, vector): floor(scale * x) of the components of all vectors with ``size`` finite ones."""
    values = F.col("embedding").cast("array<double>")
    fine = (F.size(values) == size) & F.forall(
        values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )
    whole = F.transform(values, lambda x: F.floor(x * scale))
    kept = embeddings.where(F.coalesce(fine, F.lit(False)))
    wide = F.exists(whole, lambda x: F.abs(x) >= LARGEST) | F.exists(values, lambda x: F.abs(x * scale) >= LARGEST)
    message = F.lit(f"a component beyond {LARGEST} has no distance in 64 bits")
    checked = F.when(wide, F.raise_error(message).cast("array<int>")).otherwise(whole.cast("array<int>"))
    return kept.select(F.col("vec_id").cast("long").alias("vec_id"), checked.alias("vector"))


def first_centroids(vectors: DataFrame, clusters: int = CLUSTERS) -> np.ndarray:
    """The vectors with the smallest SHA-256 of ``1:<vec_id>``, in that order (equal ids by their components)."""
    key = F.sha2(F.concat(F.lit("1:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("null"))), 256)
    rows = vectors.select(key.alias("key"), "vector").orderBy("key", "vector").limit(clusters).collect()
    return np.array([r["vector"] for r in rows], np.int64)


def drift_bounds(old: np.ndarray, new: np.ndarray, radius: np.ndarray, arcs: int = ARCS) -> np.ndarray:
    """By how much the distance to each moved centroid can fall for the vectors of each cluster.

    Row a, column j: at most max over |x - old[a]| <= radius[a] of |x - old[j]| - |x - new[j]|, and at least 0.

    With the line from old[j] to new[j] as axis, the difference depends on a vector's place t along it and
    its distance u from it. It grows with t, and falls with u where it is positive; so on the disk around the
    centre it is greatest on the quarter of the edge of larger t and smaller u. Each arc is
    bounded by its largest t and smallest u.
    """
    moved = new - old
    drift = np.sqrt((moved**2).sum(axis=1))
    axis = np.divide(moved, drift[:, None], out=np.zeros_like(moved), where=drift[:, None] > 0)
    from_old = old[:, None, :] - old[None, :, :]
    along = np.einsum("ajd,jd->aj", from_old, axis)
    off = np.sqrt(np.maximum(0, (from_old**2).sum(axis=2) - along**2))
    turns = np.linspace(0, np.pi / 2, arcs + 1)
    t = along[..., None] + radius[:, None, None] * np.cos(turns[:-1])
    u = np.maximum(0, off[..., None] - radius[:, None, None] * np.sin(turns[1:]))
    fall = np.hypot(t, u) - np.hypot(t - drift[None, :, None], u)
    fall = np.where(t > drift[None, :, None] / 2, fall, 0).max(axis=2)
    return np.clip(fall + SAFE * (1 + drift[None, :]), 0, drift[None, :] * (1 + SAFE))


def _distances(vectors: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distances (vector, centroid), in whole numbers."""
    out = np.empty((len(vectors), len(centroids)), np.int64)
    for j, centroid in enumerate(centroids):
        away = vectors - centroid
        out[:, j] = np.einsum("nd,nd->n", away, away)
    return out


def _assign(centroids: np.ndarray, loosened: np.ndarray | None):
    """Assign vectors; ``loosened`` has for each cluster how much lower its vectors' bounds have become."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            vectors = vectors.reshape(batch.num_rows, -1) if batch.num_rows else vectors.reshape(0, centroids.shape[1])
            if loosened is None:
                cluster = np.zeros(len(vectors), np.int64)
                distance = np.zeros(len(vectors), np.int64)
                bound = np.zeros(len(vectors))
                open_ = np.arange(len(vectors))
            else:
                cluster = batch.column(2).to_numpy().astype(np.int64)
                away = vectors - centroids[cluster]
                distance = np.einsum("nd,nd->n", away, away)
                bound = np.maximum(0, batch.column(4).to_numpy() - loosened[cluster])
                open_ = np.flatnonzero(np.sqrt(distance.astype(float)) * (1 + SAFE) >= bound)
            for at in range(0, len(open_), 4096):
                some = open_[at : at + 4096]
                all_ = _distances(vectors[some], centroids)
                # Of equal distances the first one is taken.
                cluster[some] = all_.argmin(axis=1)
                distance[some] = all_[np.arange(len(some)), cluster[some]]
                all_[np.arange(len(some)), cluster[some]] = np.iinfo(np.int64).max
                bound[some] = np.sqrt(all_.min(axis=1).astype(float)) * (1 - SAFE)
            scanned = np.zeros(len(vectors), bool)
            scanned[open_] = True
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), batch.column(1), pa.array(cluster.astype(np.int32)), pa.array(distance),
                    pa.array(bound), pa.array(scanned),
                ],
                ["vec_id", "vector", "cluster", "distance", "bound", "scanned"],
            )

    return run


def _sums(clusters: int, size: int):
    """Of each cluster in a task: vectors, sum of each component, largest distance, sum of distances, scans."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, scans = np.zeros(clusters, np.int64), np.zeros(clusters, np.int64)
        sums, far, total = np.zeros((clusters, size), object), np.zeros(clusters, np.int64), np.zeros(clusters, object)
        for batch in batches:
            if not batch.num_rows:
                continue
            vectors = batch.column(0).flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, size)
            cluster, distance = batch.column(1).to_numpy(), batch.column(2).to_numpy()
            count += np.bincount(cluster, minlength=clusters)
            scans += np.bincount(cluster[batch.column(3).to_numpy(zero_copy_only=False)], minlength=clusters)
            for c in np.unique(cluster):
                mine = cluster == c
                sums[c] += vectors[mine].sum(axis=0)
                far[c] = max(far[c], distance[mine].max())
                total[c] += sum(distance[mine].tolist())
        used = np.flatnonzero(count)
        decimal = pa.decimal128(38, 0)
        exact = lambda values: pa.array([Decimal(int(v)) for v in values], decimal)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(used.astype(np.int32)), pa.array(count[used]),
                pa.ListArray.from_arrays(
                    pa.array(np.arange(len(used) + 1, dtype=np.int32) * size), exact(sums[used].ravel())
                ),
                pa.array(far[used]), exact(total[used]), pa.array(scans[used]),
            ],
            ["cluster", "n", "sums", "far", "total", "scans"],
        )

    return run


@dataclass
class Clustering:
    """Vectors with their clusters, the centroids, each cluster's inertia, and how many vectors each round scanned."""

    vectors: DataFrame
    centroids: np.ndarray
    inertia: list[int]
    scanned: list[int] = field(default_factory=list)


def _state_of(assigned: DataFrame, clusters: int, size: int) -> dict[str, np.ndarray]:
    """Counts and sums of all clusters; a task gives one row for each."""
    partial = assigned.select("vector", "cluster", "distance", "scanned").mapInArrow(
        _sums(clusters, size),
        "cluster int, n long, sums array<decimal(38,0)>, far long, total decimal(38,0), scans long",
    )
    plain = partial.groupBy("cluster").agg(
        F.sum("n").alias("n"), F.max("far").alias("far"), F.sum("total").alias("total"), F.sum("scans").alias("scans")
    )
    parts = partial.select("cluster", F.posexplode("sums")).groupBy("cluster", "pos").agg(F.sum("col").alias("s"))
    out = {
        "n": np.zeros(clusters, np.int64), "far": np.zeros(clusters), "total": [0] * clusters,
        "sums": np.zeros((clusters, size), object), "scans": 0,
    }
    for r in plain.collect():
        out["n"][r["cluster"]], out["far"][r["cluster"]] = r["n"], r["far"]
        out["total"][r["cluster"]] = int(r["total"])
        out["scans"] += r["scans"]
    for r in parts.collect():
        out["sums"][r["cluster"], r["pos"]] = int(r["s"])
    return out


def cluster(vectors: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS) -> Clustering:
    """Cluster (vec_id, vector) in rounds of assigning vectors and moving centroids, then assign once more.

    A vector goes to the nearest centroid, of equally near ones to the first. A centroid moves to the floor
    of the mean of its vectors; one without vectors stays. Vectors of equal components are in one cluster,
    repeated rows and ids count as often as they stand, null ids are kept. Fewer vectors than ``clusters``
    give as many centroids as there are vectors, none gives an empty table. Only counts and sums of
    the centroids come to the driver. The vectors with their bounds are written each round; nothing is shuffled.
    """
    ship(vectors.sparkSession)
    vectors = written(vectors, "vectors")
    centroids = first_centroids(vectors, clusters)
    if not len(centroids):
        return Clustering(vectors.selectExpr("*", "0 as cluster", "0L as distance").where("false"), centroids, [])
    count, size = centroids.shape
    state, loosened, scanned = vectors, None, []
    for left in range(rounds, -1, -1):
        state = written(state.mapInArrow(_assign(centroids, loosened), _STATE), "assigned")
        sums = _state_of(state, count, size)
        scanned.append(sums["scans"])
        if not left:
            break
        moved = centroids.copy()
        for c in np.flatnonzero(sums["n"]):
            moved[c] = [int(s) // int(sums["n"][c]) for s in sums["sums"][c]]
        falls = drift_bounds(centroids.astype(float), moved.astype(float), np.sqrt(sums["far"]) * (1 + SAFE))
        np.fill_diagonal(falls, 0)
        loosened, centroids = falls.max(axis=1), moved
    return Clustering(state.select("vec_id", "vector", "cluster", "distance"), centroids, sums["total"], scanned)


def digest(done: Clustering) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every vector."""
    spark = done.vectors.sparkSession
    rows = [
        (c, total, sum(done.inertia), hashlib.sha256(",".join(map(str, centroid.tolist())).encode()).hexdigest())
        for c, (total, centroid) in enumerate(zip(done.inertia, done.centroids))
    ]
    known = spark.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    # One row for each cluster.
    return done.vectors.select("vec_id", "cluster", "distance").join(F.broadcast(known), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )


def oracle(clusters: int = CLUSTERS, rounds: int = ROUNDS, size: int = SIZE, scale: int = SCALE) -> str:
    """SQL for the digest of the table ``embeddings``: every round compares all vectors with all centroids."""
    steps = [
        f"""v as materialized (
  select row_number() over (order by vec_id) as r, vec_id, list_transform(embedding, lambda x: cast(floor({scale} * x::double) as bigint)) as x
  from embeddings
  where len(embedding) = {size} and len(list_filter(embedding, lambda x: x is not null and isfinite(x))) = {size}
), e as materialized (select r, unnest(x) as x, unnest(range({size})) as d from v)""",
        f"""c0 as materialized (
  select k, unnest(x) as x, unnest(range({size})) as d from (
    select x, row_number() over (order by sha256('1:' || vec_id)) - 1 as k from v order by k limit {clusters}))""",
    ]
    for i in range(rounds + 1):
        steps.append(
            f"""a{i} as materialized (
  select r, min(k) as k, any_value(s) as s from (
    select r, k, s, min(s) over (partition by r) as least from (
      select e.r, c.k, sum((e.x - c.x) * (e.x - c.x)) as s from e join c{i} c on e.d = c.d group by e.r, c.k))
  where s = least group by r)"""
        )
        if i < rounds:
            steps.append(
                f"""c{i + 1} as materialized (
  select c.k, c.d, coalesce(m.x, c.x) as x from c{i} c left join (
    select k, d, (t - ((t % n) + n) % n) // n as x from (
      select a.k, e.d, sum(e.x) as t, count(*) as n from e join a{i} a on e.r = a.r group by a.k, e.d)) m
  on c.k = m.k and c.d = m.d)"""
            )
    return f"""with {", ".join(steps)}
select v.vec_id, cast(a.k as integer) as cluster, cast(a.s as bigint) as distance,
  cast(sum(a.s) over (partition by a.k) as bigint) as cluster_inertia, cast(sum(a.s) over () as bigint) as inertia, h.centroid_sha256
from v join a{rounds} a on v.r = a.r
join (select k, sha256(string_agg(cast(x as varchar), ',' order by d)) as centroid_sha256 from c{rounds} group by k) h on h.k = a.k"""
