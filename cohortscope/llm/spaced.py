"""Benchmark decontamination by spaced-seed hashing, with SQL functions only.

A seed covers ``len(mask)`` consecutive words and ignores the positions where its mask has a 0, so a
replaced word there does not break it. Seeds of the benchmark's items are joined with those of all
documents; each hit gives an alignment, and a window around it must agree in most of its words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortscope.plans.scratch import written

MASKS = ("110110101", "101011011")
WINDOW = 16
AGREEMENT = 0.8
# Benchmark seeds are broadcast up to this number of rows (some 32 bytes each); more are shuffled.
BROADCAST_SEEDS = 500_000
# Fixed value: the id that stands for a missing doc_id.
_LAST = (1 << 63) - 1

# Words in lower case; all that is neither a letter nor a digit parts them.
_HASHES = r"transform(filter(split(lower(text), '[^\\p{L}\\p{N}]+'), w -> w <> ''), w -> xxhash64(w))"


def _seeds(masks: tuple[str, ...]) -> str:
    """Array of all seeds of ``words``, one mask after the other; empty for texts shorter than a mask."""
    parts = []
    for number, mask in enumerate(masks):
        chosen = ", ".join(f"words[i + {k}]" for k, bit in enumerate(mask) if bit == "1")
        parts.append(
            f"if(size(words) < {len(mask)}, cast(array() as array<bigint>), "
            f"transform(sequence(0, size(words) - {len(mask)}), i -> xxhash64({number}, {chosen})))"
        )
    return f"concat({', '.join(parts)})"


def _fixed(**column: str) -> Column:
    """A column that is computed once per row: later filters cannot put its expression inside their own."""
    [(name, expression)] = column.items()
    return F.inline_outer(F.expr(f"array(named_struct('{name}', {expression}))")).alias(name)


def contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """(doc_id, item_id, matched, overlap, doc_start): documents that hold a passage of the benchmark.

    Options are those of ``alignments``. An item is found when some window of ``window`` words of it (the whole item, if it is shorter) agrees
    with the aligned words of the document in at least ``agreement`` of the positions; a window with no
    common seed is not looked at. ``matched`` and ``overlap`` count equal and aligned words of the best
    alignment, ``doc_start`` is the word of the document where its overlap begins. Items of equal words
    are reported once, by the smallest item_id; one without an id is reported with a null one. Null and empty texts, and items with fewer words than a
    mask, match nothing. Rows that share a doc_id and a text are looked at once, of those that share a doc_id only
    the best alignment counts. Other columns of both tables are ignored, whatever their names.
    """
    aligned = alignments(docs, benchmark, **options)
    best = aligned.groupBy("doc_id", "key", "item_id").agg(
        F.max(F.struct(F.expr("element_at(sums, -1)").alias("matched"), F.size("same").alias("overlap"), (-F.expr("low + shift")).alias("back"))).alias("best")
    )
    return best.select(
        "doc_id", "item_id", F.col("best.matched").cast("long").alias("matched"), F.col("best.overlap").cast("long").alias("overlap"), F.expr("cast(-best.back as long)").alias("doc_start")
    )


def alignments(
    docs: DataFrame,
    benchmark: DataFrame,
    masks: tuple[str, ...] = MASKS,
    window: int = WINDOW,
    agreement: float = AGREEMENT,
    broadcast_seeds: int = BROADCAST_SEEDS,
) -> DataFrame:
    """Every alignment of an item with a row (doc_id, row: a hash of its text) in which a window agrees.

    Masks must be equally long.
    """
    if len({len(m) for m in masks}) != 1:
        raise ValueError("masks must be equally long")
    span = len(masks[0])
    items = benchmark.select("item_id", F.col("text").cast("string")).select("item_id", _fixed(words=_HASHES))
    items = items.where(f"size(words) >= {span}").groupBy("words").agg(F.min("item_id").alias("item_id"))
    # An item without an id is found as well, so items are joined by a key of their words.
    items = written(items.select(F.xxhash64("words").alias("key"), "item_id", "words"), "items")
    count = len(masks)
    place = f"i % (size(words) - {span - 1})"
    found = items.select("key", F.size("words").alias("size"), "words", F.posexplode_outer(F.expr(_seeds(masks))).alias("i", "seed"))
    seeds = written(found.select("seed", "key", F.expr(place).alias("at")), "seeds")
    # Neither side of the join carries a text or its words.
    keyed = docs.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("row"), F.col("text").cast("string"))
    hashed = keyed.select("doc_id", "row", _fixed(words=_HASHES))
    spread = hashed.select(
        "doc_id", "row", F.expr(f"size(words) - {span - 1}").alias("seeds"), F.posexplode_outer(F.expr(_seeds(masks))).alias("i", "seed")
    )
    if seeds.count() <= broadcast_seeds:
        seeds = F.broadcast(seeds)
    hits = spread.join(seeds, "seed").selectExpr("doc_id", "row", "key", "cast(i % seeds as int) - at as shift")
    shifts = hits.groupBy("doc_id", "row").agg(F.collect_set(F.struct("key", "shift")).alias("hits"))
    shifts = written(shifts, "hits")
    marked = keyed.join(shifts.withColumnRenamed("doc_id", "of"), F.col("doc_id").eqNullSafe(F.col("of")) & (keyed["row"] == shifts["row"]))
    marked = marked.dropDuplicates(["doc_id", "row"]).select("doc_id", keyed["row"], "hits", _fixed(words=_HASHES))
    # 1 for each aligned position with equal words; the overlap holds a seed, so it is not empty
    same = "transform(sequence(low, high - 1), k -> if(item[k] = words[k + shift], 1, 0))"
    sums = "aggregate(same, array(0), (sums, x) -> concat(sums, array(element_at(sums, -1) + x)))"
    return (
        marked.select("doc_id", "row", "words", F.inline("hits"))
        .join(items.withColumnRenamed("words", "item"), "key")
        .withColumn("low", F.expr("greatest(0, -shift)"))
        .withColumn("high", F.expr("least(size(item), size(words) - shift)"))
        .select("doc_id", "row", "key", "item_id", "item", "low", "shift", _fixed(same=same))
        .withColumn("wide", F.expr(f"least({window}, size(item))"))
        .select("doc_id", "row", "key", "item_id", "low", "shift", "same", "wide", _fixed(sums=sums))
        .where("size(same) >= wide")
        .where(F.expr(f"exists(sequence(wide, size(same)), k -> sums[k] - sums[k - wide] >= {agreement}D * wide)"))
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents without the rows that hold a benchmark passage.

    Rows that share a doc_id are told apart by their texts; a row without a doc_id is looked at like any other.
    Columns stay as they are, whatever their names.
    """
    found = alignments(docs, benchmark, **options)
    gone = found.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST)).alias("doc"), "row").distinct()
    doc = F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST)).alias("doc")
    row = F.xxhash64(F.coalesce("text", F.lit(""))).alias("row")
    packed = docs.select(doc, row, F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("it"))
    kept = packed.join(gone, ["doc", "row"], "left_anti")
    return kept.select(*(F.col(f"it.`{c}`").alias(c) for c in docs.columns))
