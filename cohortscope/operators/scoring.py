"""Scores per person: dosages joined to weights, then a grouped sum."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortscope.plans.scratch import written

BROADCAST_ROWS = 500_000
SALTS = 16
# Share of all dosages above which those of a variant are spread over salts.
HOT = 0.001
# Scores of a block of weights, each with four sums of a person's row.
SLOTS = 16


def usable_weights(weights: DataFrame) -> DataFrame:
    """Normalised weights with numbers as numbers; a weight without a position matches nothing."""
    return weights.select(
        "pgs",
        F.col("hm_chr").alias("chr"),
        F.col("hm_pos").cast("long").alias("pos"),
        "effect_allele",
        "other_allele",
        F.col("effect_weight").cast("double").alias("effect_weight"),
    ).where("chr is not null and pos is not null")


def strand_ambiguous() -> Column:
    """A/T and C/G pairs read the same on both strands."""
    return F.concat("effect_allele", "other_allele").isin("AT", "TA", "CG", "GC")


def with_frequency(weights: DataFrame, frequencies: DataFrame | None) -> DataFrame:
    """Expected dosage of the effect allele per weight row, from (chr, pos, allele, freq).

    Frequencies meet the small weight table, not the dosages. Rows that repeat a frequency count once;
    two different ones for an allele are an error.
    """
    if frequencies is None:
        return weights.withColumn("expected", F.lit(None).cast("double"))
    frequencies = frequencies.groupBy("chr", "pos", "allele").agg(
        F.expr(
            "if(min(freq) = max(freq) or max(freq) is null, min(freq), "
            "cast(raise_error(concat('two frequencies of ', chr, ':', pos, ' ', allele)) as double))"
        ).alias("freq")
    )
    f = frequencies.select(
        "chr", "pos", F.col("allele").alias("effect_allele"), (2 * F.col("freq")).alias("direct")
    )
    g = frequencies.select(
        "chr", "pos", F.col("allele").alias("other_allele"), (2 - 2 * F.col("freq")).alias("swapped")
    )
    return (
        weights.join(f, ["chr", "pos", "effect_allele"], "left")
        .join(g, ["chr", "pos", "other_allele"], "left")
        .withColumn("expected", F.coalesce("direct", "swapped"))
        .drop("direct", "swapped")
    )


def _salted(dosages: DataFrame, salts: int, hot: float) -> tuple[DataFrame, DataFrame | None]:
    """Dosages with a ``salt``, and how many the variants that hold more than a share ``hot`` of the rows have.

    Those are counted; they are fewer than 1 / hot. The dosages of others have salt 0. If ``hot`` is 0, all variants
    are spread.
    """
    if hot <= 0:
        return dosages.withColumn("salt", F.pmod(F.xxhash64("IID", "dosage"), F.lit(salts)).cast("int")), None
    counts = written(dosages.groupBy("chr", "pos").agg(F.count(F.lit(1)).alias("n")), "dosage-counts")
    total = counts.agg(F.sum("n")).first()[0] or 0
    many = counts.where(F.col("n") > hot * total).select("chr", "pos", F.lit(salts).alias("salts"))
    salt = F.pmod(F.xxhash64("IID", "dosage"), F.coalesce("salts", F.lit(1))).cast("int")
    return dosages.join(F.broadcast(many), ["chr", "pos"], "left").withColumn("salt", salt).drop("salts"), many


def _effect_dosages(
    dosages: DataFrame, weights: DataFrame, broadcast_rows: int, salts: int, hot: float
) -> DataFrame:
    """Dosages met with the weights of their variant, with ``effect_dosage``, that of the weight's effect allele.

    The weights are broadcast only if they are counted to be few. Otherwise the join is shuffled, with the dosages
    of a variant that holds a large share of the rows spread over ``salts`` partitions, so that it does not
    stall one task; only the weights of such variants are repeated for each salt.
    """
    d = dosages.select("IID", "chr", F.col("pos").cast("long").alias("pos"), "alt", "ref", "dosage")
    few = weights.limit(broadcast_rows + 1).count() <= broadcast_rows
    if few:
        joined = d.join(F.broadcast(weights), ["chr", "pos"])
    else:
        salted, many = _salted(d, salts, hot)
        spread = weights.withColumn("salts", F.lit(salts)) if many is None else weights.join(F.broadcast(many), ["chr", "pos"], "left")
        repeated = spread.withColumn("salt", F.explode(F.expr("sequence(0, coalesce(salts, 1) - 1)")))
        joined = salted.join(repeated.drop("salts").hint("shuffle_merge"), ["chr", "pos", "salt"])
    same = (F.col("alt") == F.col("effect_allele")) & (F.col("ref") == F.col("other_allele"))
    swapped = (F.col("ref") == F.col("effect_allele")) & (F.col("alt") == F.col("other_allele"))
    return joined.where(same | swapped).withColumn(
        "effect_dosage",
        F.coalesce(F.when(same, F.col("dosage")).otherwise(2 - F.col("dosage")), F.col("expected")),
    )


def _wanted(weights: DataFrame, drop_ambiguous: bool, frequencies: DataFrame | None) -> DataFrame:
    w = usable_weights(weights)
    return with_frequency(w.where(~strand_ambiguous()) if drop_ambiguous else w, frequencies)


def _averaged(scores: DataFrame, average: bool) -> DataFrame:
    share = F.when(F.col("ALLELE_CT") > 0, F.col("SCORE") / F.col("ALLELE_CT"))
    return scores.withColumn("SCORE", share) if average else scores


def score_people(
    dosages: DataFrame,
    weights: DataFrame,
    drop_ambiguous: bool = False,
    frequencies: DataFrame | None = None,
    average: bool = False,
    broadcast_rows: int = BROADCAST_ROWS,
    salts: int = SALTS,
    hot: float = HOT,
) -> DataFrame:
    """Sum of dosage times weight per score and person.

    ``dosages`` has IID, chr, pos, alt, ref, dosage (of alt). Every dosage meets every weight of its variant; the
    sums are combined on the map side before the shuffle by person. For hundreds of scores and more see
    ``score_many``.
    """
    w = _wanted(weights, drop_ambiguous, frequencies)
    matched = _effect_dosages(dosages, w, broadcast_rows, salts, hot)
    total = F.sum(F.col("effect_dosage") * F.col("effect_weight"))
    scores = matched.groupBy("pgs", "IID").agg(
        (2 * F.count("effect_dosage")).alias("ALLELE_CT"),
        F.sum("effect_dosage").alias("NAMED_ALLELE_DOSAGE_SUM"),
        total.alias("SCORE"),
    )
    return _averaged(scores, average)


def weight_blocks(weights: DataFrame, slots: int) -> tuple[DataFrame, DataFrame]:
    """Weights as one row per variant and orientation, and the place of every score: (pgs, block, slot).

    A row lists the blocks that have a weight there: block, sums of the weights and numbers of weight rows by slot.
    The names of the scores come to the driver, their weights do not.
    """
    names = sorted(r.pgs for r in weights.select("pgs").distinct().collect())
    places = weights.sparkSession.createDataFrame(
        [(name, i // slots, i % slots) for i, name in enumerate(names)], "pgs string, block int, slot int"
    )
    variant = ["chr", "pos", "effect_allele", "other_allele"]
    in_blocks = weights.join(places, "pgs").groupBy(*variant, "block").agg(
        F.first("expected", ignorenulls=True).alias("expected"),
        F.array(*(F.expr(f"sum(if(slot = {k}, effect_weight, null))") for k in range(slots))).alias("weights"),
        F.array(*(F.expr(f"count_if(slot = {k})") for k in range(slots))).alias("rows"),
    )
    by_variant = in_blocks.groupBy(*variant).agg(
        F.first("expected", ignorenulls=True).alias("expected"), F.collect_list(F.struct("block", "weights", "rows")).alias("blocks")
    )
    return by_variant, places


def score_many(
    dosages: DataFrame,
    weights: DataFrame,
    drop_ambiguous: bool = False,
    frequencies: DataFrame | None = None,
    average: bool = False,
    broadcast_rows: int = BROADCAST_ROWS,
    salts: int = SALTS,
    slots: int = SLOTS,
    hot: float = HOT,
) -> DataFrame:
    """As ``score_people``, for any number of scores: sparse blocks of weights, multiplied with each dosage.

    A dosage meets one row, that of its variant, whatever the number of scores, so dosages are shuffled once or not
    at all. From there it goes to the blocks of ``slots`` scores that have a weight at the variant, and adds to
    the sums of a block's scores in one row per person and block, on the map side first.
    """
    w = written(_wanted(weights, drop_ambiguous, None), "weights")
    by_variant, places = weight_blocks(w, slots)
    # Frequencies meet a variant once, not once for each score.
    by_variant = with_frequency(by_variant.drop("expected"), frequencies)
    matched = _effect_dosages(dosages, written(by_variant, "weight-blocks"), broadcast_rows, salts, hot)
    each = matched.select("IID", F.col("effect_dosage").alias("d"), F.inline("blocks"))
    sums = []
    for k in range(slots):
        has = f"rows[{k}] > 0"
        sums += [
            F.expr(f"sum(rows[{k}]) as seen_{k}"),
            F.expr(f"2 * sum(if(d is not null, rows[{k}], 0L)) as count_{k}"),
            F.expr(f"sum(if({has}, d * rows[{k}], null)) as dosage_{k}"),
            F.expr(f"sum(d * weights[{k}]) as score_{k}"),
        ]
    added = each.groupBy("IID", "block").agg(*sums)
    entries = ", ".join(f"struct({k} as slot, seen_{k} as seen, count_{k} as a, dosage_{k} as b, score_{k} as c)" for k in range(slots))
    long = added.select("IID", "block", F.inline(F.expr(f"array({entries})"))).where("seen > 0")
    scores = long.join(places, ["block", "slot"]).select(
        "pgs", "IID", F.col("a").alias("ALLELE_CT"), F.col("b").alias("NAMED_ALLELE_DOSAGE_SUM"), F.col("c").alias("SCORE")
    )
    return _averaged(scores, average)
