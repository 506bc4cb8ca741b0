"""Sums of many long vectors, one per key, as an ordinary grouped aggregation.

Python tasks add up their own rows first and emit one partial vector per key, in blocks of a fixed
width. Spark's hash aggregate adds the blocks, so a task holds sums, never the partial vectors.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WIDTH = 16
MANY_CORES = 64
BLOCK_FIELDS = "block int, " + ", ".join(f"v{i} double" for i in range(WIDTH))


def blocks(vectors: np.ndarray) -> tuple[np.ndarray, dict[str, pa.Array]]:
    """Cut the rows of a matrix into blocks: (row number of each block, block columns)."""
    count, length = vectors.shape
    per = -(-length // WIDTH)
    padded = np.zeros((count, per * WIDTH))
    padded[:, :length] = vectors
    flat = padded.reshape(count * per, WIDTH)
    columns = {"block": pa.array(np.tile(np.arange(per, dtype=np.int32), count))}
    columns |= {f"v{i}": pa.array(np.ascontiguousarray(flat[:, i])) for i in range(WIDTH)}
    return np.repeat(np.arange(count), per), columns


def sum_vectors(
    partial: DataFrame, keys: list[str], parts: dict[str, str] | None = None, salts: int | None = None
) -> DataFrame:
    """Add the blocks of every key and put them back together as arrays.

    ``parts`` names arrays by a condition on further columns of ``partial``. The blocks are shuffled
    once, by key: both aggregations use that partitioning, and the first one streams. On a cluster of many
    cores, vectors of the same key and ``salt`` (a part of the tasks) are added first, so that no task
    reads a block from every other one; by default there are as many salts as the root of the cores.
    """
    parts = parts or {"vector": "true"}
    further = [c for c in partial.columns if c not in keys and not c.startswith("v")]
    if salts is None:
        cores = partial.sparkSession.sparkContext.defaultParallelism
        salts = int(cores**0.5) if cores > MANY_CORES else 1
    if salts > 1:
        salted = partial.withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(salts)))
        added = salted.groupBy(*keys, *further, "salt").agg(*(F.expr(f"sum(v{i}) as v{i}") for i in range(WIDTH)))
        partial = added.drop("salt")
    sums = partial.repartition(*keys).groupBy(*keys, *further).agg(
        *(F.expr(f"sum(v{i}) as v{i}") for i in range(WIDTH))
    )
    values = ", ".join(f"v{i}" for i in range(WIDTH))
    entry = f"struct(block, array({values}) as x)"
    return sums.groupBy(*keys).agg(
        *(
            F.expr(
                f"flatten(transform(array_sort(collect_list({entry}) filter (where {where})), e -> e.x)) as {name}"
            )
            for name, where in parts.items()
        )
    )


def as_matrix(column: pa.Array, length: int) -> np.ndarray:
    """Equally long arrays of an Arrow list column as a matrix; a missing array is a zero row."""
    lengths = np.asarray(column.value_lengths().fill_null(0))
    out = np.zeros((len(column), length))
    filled = lengths > 0
    if filled.any():
        width = int(lengths[filled][0])
        flat = column.flatten().to_numpy(zero_copy_only=False)
        out[filled] = flat.reshape(-1, width)[:, :length]
    return out
