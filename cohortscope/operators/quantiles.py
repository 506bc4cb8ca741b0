"""Exact interpolated quantiles of many groups, whatever the size of a group.

The built-in exact percentile keeps every distinct value of a group in one task. Here a group's
ranks are first located in bins: each round counts the rows per bin (summed on the map side), finds
the bin that holds each wanted rank, and narrows the search to it. Once every searched bin is small
enough to be ranked in one task, the values themselves are counted and picked. Groups that are small
to begin with skip the bins.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortscope.plans.scratch import written

BINS = 256
# Search intervals are sent to all tasks when they are counted to be at most this many.
BROADCAST_TARGETS = 500_000


def exact_quantiles(
    rows: DataFrame,
    keys: Sequence[str],
    value: str,
    probabilities: Sequence[float],
    masks: Mapping[str, Column] | None = None,
    max_ranked: int = 50_000,
    largest: int | None = None,
    bins: int = BINS,
) -> DataFrame:
    """Quantiles of ``value`` per group and mask: keys, ``mask``, ``q`` (array, as ``probabilities``).

    ``masks`` names subsets of a group's rows. Key columns and values must not be null. ``largest``
    is the size of the largest group if the caller knows it; otherwise it is counted.
    """
    keys = list(keys)
    masks = dict(masks or {"all": F.lit(True)})
    flags = {f"in_{i}": m for i, m in enumerate(masks.values())}
    any_mask = F.greatest(*flags.values(), F.lit(False))
    rows = rows.select(
        *keys, F.col(value).cast("double").alias("v"), *(m.alias(f) for f, m in flags.items())
    ).where(any_mask if len(flags) > 1 else flags["in_0"])
    rows = rows.select(*keys, "v", *flags)

    if largest is not None and largest <= max_ranked:
        return _builtin(rows, keys, list(masks), list(flags), probabilities)
    sizes = written(rows.groupBy(*keys).count().withColumnRenamed("count", "rows_of"), "quantile-sizes")
    large = sizes.where(F.col("rows_of") > max_ranked)
    about = large.agg(F.count(F.lit(1)).alias("n"), F.max("rows_of").alias("largest")).first()
    if not about["n"]:
        return _builtin(rows, keys, list(masks), list(flags), probabilities)
    # Each group goes the way of its own size.
    large = large.select(*keys)
    large = F.broadcast(large) if about["n"] <= BROADCAST_TARGETS else large
    small = _builtin(rows.join(large, keys, "left_anti"), keys, list(masks), list(flags), probabilities)
    binned = _binned(rows.join(large, keys, "left_semi"), keys, list(masks), list(flags), probabilities, max_ranked, about["largest"], bins)
    return small.unionByName(binned)


def _binned(
    rows: DataFrame,
    keys: list[str],
    masks: list[str],
    flags: list[str],
    probabilities: Sequence[float],
    max_ranked: int,
    largest: int,
    bins: int,
) -> DataFrame:
    """Large groups: ranks are searched in ever narrower bins."""
    targets = written(_first_targets(rows, keys, flags, probabilities), "quantile-targets")
    return searched(rows, targets, keys, masks, flags, max_ranked, largest, bins)


def searched(
    rows: DataFrame,
    targets: DataFrame,
    keys: list[str],
    masks: list[str],
    flags: list[str],
    max_ranked: int,
    largest: int,
    bins: int = BINS,
) -> DataFrame:
    """The values at the ranks of ``targets``: keys, lo and hi (where a rank is searched), width (rows between them),
    flag, p, side, rank (among the flagged rows from lo on), fraction.

    ``rows`` has the keys, ``v`` and the flags; rows of a group outside of its intervals may be missing. The largest
    interval has ``largest`` rows.
    """
    few = targets.count() <= BROADCAST_TARGETS
    even, logarithmic = _even_bin(bins), _logarithmic_bin(bins)
    part = even
    while largest > max_ranked:
        targets = written(_narrow(rows, targets, keys, flags, part, few), "quantile-targets")
        # A bin whose values are all equal is resolved, however many rows it has.
        largest = targets.where("lo < hi").agg(F.max("width")).first()[0] or 0
        part = logarithmic if part is even else even
    found = _narrow(rows, targets, keys, flags, F.col("v"), few)
    names = F.array(*(F.lit(name) for name in masks))
    low = F.max(F.when(F.col("side") == 0, F.col("lo")))
    high = F.max(F.when(F.col("side") == 1, F.col("lo")))
    per_probability = found.groupBy(*keys, "flag", "p").agg(
        (low + (high - low) * F.max("fraction")).alias("x")
    )
    ordered = F.array_sort(F.collect_list(F.struct("p", "x")))
    return (
        per_probability.groupBy(*keys, "flag")
        .agg(F.col("flag").alias("_flag"), ordered.getField("x").alias("q"))
        .select(*keys, F.element_at(names, F.col("flag") + 1).alias("mask"), "q")
    )


def _builtin(
    rows: DataFrame,
    keys: list[str],
    names: list[str],
    flags: list[str],
    probabilities: Sequence[float],
) -> DataFrame:
    """Groups proven small: the exact percentile aggregate."""
    wanted = "array(" + ", ".join(f"{float(p)!r}D" for p in probabilities) + ")"
    aggregates = [F.expr(f"percentile(if({f}, v, null), {wanted})").alias(f) for f in flags]
    long = ", ".join(f"'{name}', {f}" for name, f in zip(names, flags))
    return (
        rows.groupBy(*keys)
        .agg(*aggregates)
        .select(*keys, F.expr(f"stack({len(flags)}, {long})").alias("mask", "q"))
        .where("q is not null")
    )


def _first_targets(
    rows: DataFrame, keys: list[str], flags: list[str], probabilities: Sequence[float]
) -> DataFrame:
    """The ranks below and above each quantile, searched for in the whole group."""
    bounds = rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("width"),
        F.min("v").alias("lo"),
        F.max("v").alias("hi"),
        *(F.count_if(f).alias(f) for f in flags),
    )
    ranks = wanted_ranks({flag: flag for flag in flags}, probabilities)
    return bounds.select(*keys, "lo", "hi", "width", ranks).where("rank >= 0")


def wanted_ranks(sizes: Mapping[str, str], probabilities: Sequence[float]) -> Column:
    """Rows (flag, p, side, rank, fraction): the ranks below and above each quantile; ``sizes`` are SQL, by flag."""
    wanted = ", ".join(
        f"{f}, {p}, {side}, least(floor({float(probability)!r}D * ({size} - 1)) + {side}, {size} - 1), "
        f"{float(probability)!r}D * ({size} - 1) - floor({float(probability)!r}D * ({size} - 1))"
        for f, size in enumerate(sizes.values())
        for p, probability in enumerate(probabilities)
        for side in (0, 1)
    )
    count = len(sizes) * len(probabilities) * 2
    return F.expr(f"stack({count}, {wanted})").alias("flag", "p", "side", "rank", "fraction")


def _even_bin(bins: int) -> Column:
    """Equally wide parts. The ends are scaled first: their difference may exceed any double."""
    return F.expr(
        f"if(hi > lo, least(floor((v / {bins} - lo / {bins}) / (hi / {bins} - lo / {bins}) * {bins}), {bins - 1}), 0L)"
    )


def _logarithmic_bin(bins: int) -> Column:
    """Parts of equal ratio for an interval that spans many magnitudes, else equally wide ones.

    In turns with even bins this bounds the rounds for any values: once the ends are within a factor
    of 1024, every round takes log2(bins) binary digits off the interval.
    """

    def size(x: str) -> str:
        return f"if({x} = 0, 0D, signum({x}) * (log2(abs({x})) + 1080))"

    share = f"({size('v')} - {size('lo')}) / ({size('hi')} - {size('lo')})"
    spread = "signum(lo) <> signum(hi) or greatest(abs(lo), abs(hi)) / 1024 > least(abs(lo), abs(hi))"
    return F.when(
        F.expr(f"hi > lo and ({spread})"),
        F.expr(f"least(floor(if(hi > lo and ({spread}), {share}, 0D) * {bins}), {bins - 1})"),
    ).otherwise(_even_bin(bins))


def _narrow(
    rows: DataFrame,
    targets: DataFrame,
    keys: list[str],
    flags: list[str],
    part: Column,
    few: bool,
) -> DataFrame:
    """Replace the searched interval of every rank by the part of it that holds the rank.

    ``part`` orders the values of an interval into parts; ``rank`` counts from the interval's start.
    """
    bracket = [*keys, "lo"]
    brackets = targets.select(*bracket, "hi").distinct()
    # Every group keeps the same number of targets, so their count holds for all rounds.
    inside = rows.join(F.broadcast(brackets) if few else brackets, keys).where("v >= lo and v <= hi")
    counted = inside.groupBy(*bracket, part.alias("part")).agg(
        F.min("v").alias("part_lo"),
        F.max("v").alias("part_hi"),
        F.count(F.lit(1)).alias("part_width"),
        *(F.count_if(f).alias(f) for f in flags),
    )
    order = Window.partitionBy(*bracket).orderBy("part")
    running = counted.select(
        *bracket,
        "part_lo",
        "part_hi",
        "part_width",
        F.array(*flags).alias("size"),
        F.array(
            *(
                F.sum(f).over(order.rowsBetween(Window.unboundedPreceding, 0))
                for f in flags
            )
        ).alias("through"),
    )
    through = F.col("through")[F.col("flag")]
    before = through - F.col("size")[F.col("flag")]
    return (
        targets.join(running, bracket)
        .where((F.col("rank") >= before) & (F.col("rank") < through))
        .select(
            *keys,
            F.col("part_lo").alias("lo"),
            F.col("part_hi").alias("hi"),
            F.col("part_width").alias("width"),
            "flag",
            "p",
            "side",
            (F.col("rank") - before).alias("rank"),
            "fraction",
        )
    )
