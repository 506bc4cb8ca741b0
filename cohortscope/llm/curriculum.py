"""Mixing sources to target weights with weights that change over the training run.

A source's schedule gives its weight at knots of the run (time 0 to 1), linear in between. The integral
of the schedule is the source's weight in the mix; its cumulative demand for words is the running
integral, scaled to the source's target. Inverting that demand gives every document, and every further
pass over it, a position in the run; documents are range-sorted by position. SQL functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from cohortscope.llm.text import WORD
from cohortscope.plans.scratch import written

MOST_REPEATS = 3
# Rows of a source that one task orders; larger sources are cut into more ranges of their order.
PER_RANGE = 20_000
# Running sums of the knots: (time, weight, integral so far).
_AREAS = """
    transform(sequence(1, size(knots)), k -> named_struct(
        't', knots[k - 1].t, 'w', knots[k - 1].w,
        'area', aggregate(sequence(1, k), 0D, (sum, j) -> if(j = 1, 0D,
            sum + (knots[j - 2].w + knots[j - 1].w) / 2 * (knots[j - 1].t - knots[j - 2].t)))))
"""


def words_in(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def length_of(text: Column) -> Column:
    """Code points of a text; 0 for a null."""
    return F.coalesce(F.length(text), F.lit(0)).cast("long")


def source_sizes(sized: DataFrame) -> DataFrame:
    return sized.groupBy("source").agg(
        F.sum("size").cast("long").alias("source_size"), F.count(F.lit(1)).alias("source_rows")
    )


def rising_and_falling(sources: DataFrame) -> DataFrame:
    """The default schedules: integrals 1, 2, 3, repeating by code point of the source (null last).

    Sources of odd rank rise from half to one and a half times their weight, the others fall.
    """
    # A row for each source, however many documents there are.
    ranked = sources.withColumn("rank", F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())))
    weight = F.expr("cast(1 + (rank - 1) % 3 as double)")
    knot = "named_struct('t', {}D, 'w', weight * if(rank % 2 = 1, {}D, {}D))"
    knots = f"array({knot.format('0.0', 0.5, 1.5)}, {knot.format('1.0', 1.5, 0.5)})"
    return ranked.withColumn("weight", weight).select("source", F.expr(knots).alias("knots"))


def targets(sources: DataFrame, schedules: DataFrame, most_repeats: int = MOST_REPEATS) -> DataFrame:
    """Words to take of each source: shares of all words by schedule integral, no more than the cap.

    A source stops at ``most_repeats`` times its size; what is over is shared by weight among the others
    until none is above. In the order of size by weight the stopped sources come first, so the level at
    which the others end follows from running sums over the (one row per source) table.
    """
    joined = sources.join(schedules.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of")))
    areas = joined.withColumn("areas", F.expr(_AREAS)).drop("knots", "of")
    weighed = areas.withColumn("weight", F.expr("areas[size(areas) - 1].area")).withColumn(
        "cap", F.col("source_size") * most_repeats
    )
    all_rows = W.partitionBy()
    order = W.orderBy(F.expr("cap / weight"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(W.unboundedPreceding, -1)
    running = (
        weighed.withColumn("total", F.sum("source_size").over(all_rows))
        .withColumn("cap_before", F.coalesce(F.sum("cap").over(before), F.lit(0)))
        .withColumn("weight_left", F.sum("weight").over(all_rows) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
        .withColumn("stopped", F.expr("cap * weight_left <= (total - cap_before) * weight"))
    )
    return running.withColumn("cap_stopped", F.sum(F.expr("if(stopped, cap, 0)")).over(all_rows)).withColumn(
        "weight_open", F.sum(F.expr("if(stopped, 0D, weight)")).over(all_rows)
    ).select(
        "source",
        "source_size",
        "source_rows",
        "areas",
        "total",
        F.expr("if(stopped, cast(cap as double), weight * (total - cap_stopped) / weight_open)").alias("target"),
    )


def plan(
    docs: DataFrame,
    schedules: DataFrame | None = None,
    most_repeats: int = MOST_REPEATS,
    per_range: int = PER_RANGE,
) -> DataFrame:
    """A row per document: doc_id, source, size, source_size, target, taken, copies, position.

    ``size`` counts the runs of characters that are no ASCII white space (null text: 0). Each source's
    documents stand in the order of md5(doc_id), so reruns agree; ``start`` is the words before one in
    that order. The source takes whole passes over them, then the start of one more, so that it takes its
    target to the word; the last document may be taken in part. ``row`` is a hash of the text, which orders rows
    that share a doc_id, and those without one. ``taken`` counts a document's words over
    all passes, never more than ``most_repeats`` times its size. ``position`` is the place in the run, in
    words, of its first pass (null if it is not taken). A null source is a source of its own, a null
    doc_id comes last in its source, rows that repeat are rows of their own. Empty tables give no rows.
    """
    sized = docs.select(
        F.col("doc_id").cast("long"), F.col("source").cast("string"), words_in(F.col("text")).alias("size"), row_of(F.col("text")).alias("row")
    )
    # Rows without an id come last, spread by their texts.
    place = "coalesce(md5(cast(doc_id as string)), concat('z', md5(cast(row as string))))"
    sized = written(sized.withColumn("place", F.expr(place)), "sized")
    sources = written(source_sizes(sized), "sources")
    schedules = rising_and_falling(sources) if schedules is None else schedules
    goal = written(targets(sources, schedules, most_repeats), "targets")
    largest = goal.agg(F.max("source_rows")).first()[0] or 0
    digits = 1
    while 16**digits * per_range < largest and digits < 8:
        digits += 1
    # Running sums in two steps, so that a source of any size is ordered by many tasks.
    ranged = sized.withColumn("range", F.expr(f"substring(place, 1, if(doc_id is null, {digits + 1}, {digits}))"))
    keys = ["source", "range"]
    whole = ranged.groupBy(*keys).agg(F.sum("size").alias("range_size"))
    ahead = W.partitionBy("source").orderBy("range").rowsBetween(W.unboundedPreceding, -1)
    offsets = whole.select(*keys, F.coalesce(F.sum("range_size").over(ahead), F.lit(0)).alias("offset"))
    offsets = offsets.join(goal.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of"))).drop("of")
    inside = W.partitionBy(*keys).orderBy("place", "doc_id", "size", "row").rowsBetween(W.unboundedPreceding, -1)
    started = ranged.withColumn("within", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    named = offsets.withColumnsRenamed({"source": "of", "range": "of_range"})
    met = started.join(named, F.col("source").eqNullSafe(F.col("of")) & (F.col("range") == F.col("of_range")))
    met = met.withColumn("start", F.col("within") + F.col("offset")).withColumn("budget", F.expr("cast(floor(target) as long)"))
    passes = F.expr("if(source_size = 0, 0L, budget div source_size)")
    met = met.withColumn("passes", passes).withColumn("rest", F.expr("budget - passes * source_size"))
    taken = F.expr("passes * size + greatest(0L, least(size, rest - start))")
    met = met.withColumn("taken", taken).withColumn(
        "copies", F.expr("if(size = 0, 0L, passes + if(rest > start, 1L, 0L))")
    )
    return met.select(
        "doc_id", "source", "size", "row", "source_size", "target", "taken", "copies", "start", "total", "areas",
        F.when(F.col("taken") > 0, place_of("start")).alias("position"),
    )


def row_of(text: Column) -> Column:
    """A hash that tells a text from others."""
    return F.xxhash64(F.coalesce(text.cast("string"), F.lit("")))


def place_of(start: str) -> Column:
    """Where in the run, in words, a source has asked for ``start`` words: its demand inverted."""
    asked = f"(areas[size(areas) - 1].area * {start} / target)"
    last = f"greatest(0, least(size(areas) - 2, size(filter(areas, a -> a.area <= {asked})) - 1))"
    # Within a piece, weight and slope give a quadratic; this form of its root has no cancellation.
    slope = "((areas[k + 1].w - areas[k].w) / (areas[k + 1].t - areas[k].t))"
    over = f"({asked} - areas[k].area)"
    root = f"areas[k].w + sqrt(greatest(0D, areas[k].w * areas[k].w + 2 * {slope} * {over}))"
    time = f"if({over} <= 0, areas[k].t, areas[k].t + 2 * {over} / ({root}))"
    return F.expr(f"cast(floor(total * element_at(transform(array({last}), k -> {time}), 1)) as long)")


def training_order(docs: DataFrame, schedules: DataFrame | None = None, most_repeats: int = MOST_REPEATS) -> DataFrame:
    """The documents in training order: a row per pass, sorted by position over all partitions.

    Columns of the documents, then copy (1 for the first pass), words (to read from the text's start)
    and position; columns of those names in the input are replaced. Every row has its own passes; rows alike in
    doc_id, source and text have those of as many places, dealt out among them in any order.
    """
    names = [c for c in docs.columns if c not in ("copy", "words", "position")]
    key = ["doc_id", "source", "size", "row"]
    mix = plan(docs, schedules, most_repeats).select(*key, F.struct("start", "taken", "copies", "source_size", "target", "total", "areas").alias("it"))
    mix = written(mix, "mix")
    alike = written(mix.groupBy(*key).count().where("count > 1").select(F.struct(*key).alias("key")), "alike")
    mix = mix.select(F.struct(*key).alias("key"), F.lit(1).alias("nth"), "it.*")
    keyed = F.struct(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
        words_in(F.col("text")).alias("size"), row_of(F.col("text")).alias("row"),
    )
    whole = docs.select(keyed.alias("key"), F.lit(1).alias("nth"), F.struct(*(F.col(f"`{c}`") for c in names)).alias("it"))
    if not alike.isEmpty():
        # Rows that are alike are numbered on both sides.
        mix, whole = (
            side.join(alike, "key", "left_anti").unionByName(
                side.join(alike, "key", "left_semi").withColumn("nth", F.row_number().over(W.partitionBy("key").orderBy(by)))
            )
            for side, by in ((mix, "start"), (whole, F.lit(0)))
        )
    passes = mix.where("taken > 0").withColumn("copy", F.explode(F.expr("sequence(1L, copies)")))
    passes = passes.withColumn("at", F.expr("start + (copy - 1) * source_size")).select(
        "key",
        "nth",
        "copy",
        F.expr("least(key.size, taken - (copy - 1) * key.size)").alias("words"),
        place_of("at").alias("position"),
    )
    return (
        whole.join(passes, ["key", "nth"])
        .select(*(F.col(f"it.`{c}`").alias(c) for c in names), "copy", "words", "position")
        .orderBy("position", "doc_id", "copy")
    )


ORACLE = r"""
with sized as (
    select doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) as size,
        coalesce(md5(cast(doc_id as varchar)), 'z') as place
    from documents),
sources as (select source, cast(sum(size) as bigint) as source_size from sized group by source),
ranked as (
    select *, row_number() over (order by source asc nulls last) as rank, sum(source_size) over () as total
    from sources),
weighed as (
    select *, cast(1 + (rank - 1) % 3 as double) as weight, 3 * source_size as cap,
        if(rank % 2 = 1, 0.5::double, 1.5::double) as early from ranked),
running as (
    select *, coalesce(sum(cap) over o, 0) as cap_before,
        sum(weight) over () - coalesce(sum(weight) over o, 0) as weight_left
    from weighed
    window o as (order by cap / weight, source asc nulls last rows between unbounded preceding and 1 preceding)),
marked as (select *, cap * weight_left <= (total - cap_before) * weight as stopped from running),
summed as (
    select *, sum(if(stopped, cap, 0)) over () as cap_stopped, sum(if(stopped, 0, weight)) over () as weight_open
    from marked),
goal as (
    select source, source_size, total, weight, early,
        if(stopped, cast(cap as double), weight * cast(total - cap_stopped as double) / weight_open) as target
    from summed),
met as (
    select d.doc_id, d.size, g.*,
        coalesce(sum(d.size) over (partition by d.source order by d.place, d.doc_id, d.size
            rows between unbounded preceding and 1 preceding), 0)::bigint as start,
        floor(target)::bigint as budget
    from sized d join goal g on d.source is not distinct from g.source),
parted as (
    select *, if(source_size = 0, 0, budget // source_size) as passes from met),
ended as (
    select *, budget - passes * source_size as rest,
        passes * size + greatest(0, least(size, budget - passes * source_size - start)) as taken,
        weight * start / target as asked, weight * early as w0,
        (weight * (2 - early) - weight * early) as slope
    from parted)
select doc_id, size, source_size, target, taken::bigint as taken,
    if(size = 0, 0, passes + if(rest > start, 1, 0))::bigint as copies,
    if(taken > 0, floor(total * if(asked <= 0, 0, 2 * asked / (w0 + sqrt(w0 * w0 + 2 * slope * asked)))), null)::bigint
        as position
from ended
"""
