"""Connected components of a table of links, and links between near fingerprints."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortscope.plans.scratch import release, written

# A bucket with more fingerprints than this is compared tile by tile in different tasks.
TILE = 8192
# Rows of a round of components in one file, about.
ROWS_PER_FILE = 250_000
# Buckets up to SMALL give all their pairs; those up to MIDDLE are first searched for any pair.
SMALL = 12
MIDDLE = 256


def components(links: DataFrame) -> DataFrame:
    """Smallest node reachable from every linked node: (node, root), for links (a, b).

    Alternates between pointing larger neighbours and smaller neighbours of each node at its smallest
    neighbour until nothing changes. Every round is a grouped minimum and a join and is written to the
    shared scratch folder; no node's neighbours are ever gathered in one place. Null ends are dropped,
    an empty table has no components.
    """
    pairs = links.select("a", "b").where("a is not null and b is not null and a <> b")
    pairs = written(pairs.selectExpr("greatest(a, b) as hi", "least(a, b) as lo").distinct(), "links")

    def star(pairs: DataFrame, both: bool) -> DataFrame:
        """Of each node, the neighbours (all, or the smaller ones) get its least neighbour."""
        if both:
            seen = pairs.select(F.inline(F.expr("array(struct(hi as n, lo as m), struct(lo as n, hi as m))")))
        else:
            seen = pairs.selectExpr("hi as n", "lo as m")
        least = seen.groupBy("n").agg(F.min("m").alias("least")).selectExpr("n", "least(least, n) as least")
        joined = seen.join(least, "n")
        kept = "m > n" if both else "true"
        moved = joined.where(kept).selectExpr("m as hi", "least as lo")
        if not both:
            moved = moved.union(least.selectExpr("n as hi", "least as lo"))
        return moved.where("hi <> lo").distinct()

    state, count = None, pairs.count()
    while True:
        # A round gives at most about as many rows as it reads; few rows are written to few files.
        files = max(1, -(-count // ROWS_PER_FILE))
        before, pairs = pairs, written(star(star(pairs, True), False).coalesce(files), "stars")
        release(before)
        now = pairs.agg(
            F.count(F.lit(1)).alias("n"),
            F.bit_xor(F.xxhash64("hi", "lo")).alias("x"),
            F.sum(F.pmod(F.xxhash64("lo", "hi"), F.lit(1 << 30))).alias("s"),
        ).first()
        if now == state or not now["n"]:
            break
        state, count = now, now["n"]
    roots = pairs.select("lo").distinct().selectExpr("lo as node", "lo as root")
    return pairs.selectExpr("hi as node", "lo as root").union(roots)


def _links_of_group(fps: np.ndarray, own: np.ndarray, radius: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Links that join all of a bucket's fingerprints within the radius of one of its own."""
    mine = fps[own]
    labels = np.arange(len(mine))
    out_a: list[np.ndarray] = []
    out_b: list[np.ndarray] = []
    step = max(1, (1 << 20) // max(1, len(mine)))
    for at in range(0, len(fps), step):
        some = fps[at : at + step]
        near = np.bitwise_count(some[:, None] ^ mine[None, :]) <= radius
        hit = np.flatnonzero(near.any(axis=1))
        if not len(hit):
            continue
        near = near[hit]
        out_a.append(some[hit])
        out_b.append(mine[near.argmax(axis=1)])
        low = np.where(near, labels, len(mine)).min(axis=1)
        high = np.where(near, labels, -1).max(axis=1)
        for i in np.flatnonzero(low != high):
            columns = np.flatnonzero(near[i])
            found, first = np.unique(labels[columns], return_index=True)
            if len(found) > 1:
                out_a.append(np.full(len(found), some[hit[i]]))
                out_b.append(mine[columns[first]])
                labels[np.isin(labels, found)] = found[0]
    return [(a, b) for a, b in zip(out_a, out_b)]


def _bucket_links(radius: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Compare the fingerprints of each bucket; rows come sorted by bucket and tile."""

    def links(keys: np.ndarray, tiles: np.ndarray, fps: np.ndarray, own: np.ndarray) -> Iterator[pa.RecordBatch]:
        fresh = np.append(True, (keys[1:] != keys[:-1]) | (tiles[1:] != tiles[:-1]))
        starts = np.flatnonzero(fresh)
        sizes = np.diff(np.append(starts, len(keys)))
        group = np.cumsum(fresh) - 1
        size_of = sizes[group]
        parts = []
        paired = sizes > MIDDLE
        followers = starts[group] + size_of - 1 - np.arange(len(keys))
        rows = np.flatnonzero(size_of <= MIDDLE)
        for lag in range(1, int(sizes[sizes <= MIDDLE].max(initial=0))):
            rows = rows[followers[rows] >= lag]
            at = rows[np.bitwise_count(fps[rows] ^ fps[rows + lag]) <= radius]
            if len(at):
                paired[group[at]] = True
                at = at[size_of[at] <= SMALL]
                parts.append((fps[at], fps[at + lag]))
        for g in np.flatnonzero(paired & (sizes > SMALL)):
            bucket = slice(starts[g], starts[g] + sizes[g])
            if own[bucket].any():
                parts += _links_of_group(fps[bucket], own[bucket], radius)
        if parts:
            a = np.concatenate([p[0] for p in parts]).view(np.int64)
            b = np.concatenate([p[1] for p in parts]).view(np.int64)
            pairs = np.unique(np.stack([np.maximum(a, b), np.minimum(a, b)], axis=1)[a != b], axis=0)
            if len(pairs):
                yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []

        def joined() -> list[np.ndarray]:
            return [np.concatenate(column) for column in zip(*held)]

        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(4)]
            columns[2] = columns[2].view(np.uint64)
            ends = np.flatnonzero((np.diff(columns[0]) != 0) | (np.diff(columns[1]) != 0))
            if held and (held[-1][0][-1], held[-1][1][-1]) != (columns[0][0], columns[1][0]):
                yield from links(*joined())
                held = []
            if len(ends):
                last = int(ends[-1]) + 1
                held.append([c[:last] for c in columns])
                yield from links(*joined())
                held = [[c[last:] for c in columns]]
            else:
                held.append(columns)
        if held:
            yield from links(*joined())

    return run


def near_links(rows: DataFrame, radius: int, tile: int = TILE) -> DataFrame:
    """Links (a, b) between fingerprints that meet in a bucket and differ in at most ``radius`` bits.

    ``rows`` has key, fp and own: a bucket's own fingerprints are compared with all that probe it. The
    links kept join everything that is within the radius inside a bucket; a bucket of n fingerprints
    gives at most about 2 n of them (a small one, up to 12, all its pairs). Buckets with more than
    ``tile`` own fingerprints are compared in tiles, each probe once per tile, by different tasks.
    """
    # At most one key for every ``tile`` rows.
    hot = written(
        rows.where("own").groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > tile).coalesce(1), "hot"
    )
    if hot.isEmpty():
        dealt = rows.selectExpr("key", "0 as tile", "fp", "own")
    else:
        tiled = rows.join(hot, "key", "left").withColumn("tiles", F.expr(f"cast(ceil(coalesce(n, 1) / {tile}) as int)"))
        dealt = tiled.withColumn("tile", F.explode(F.expr("sequence(0, tiles - 1)"))).selectExpr(
            "key", "tile", "fp", "own and pmod(xxhash64(fp), tiles) = tile as own"
        )
    columns = ["key", "tile"]
    return (
        dealt.repartition(*columns)
        .sortWithinPartitions(*columns)
        .mapInArrow(_bucket_links(radius), "a long, b long")
        .distinct()
    )
