"""Score distributions per group: the rows behind a violin plot, its box and its density."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortscope.config import LOGISTIC, EvalConfig
from cohortscope.operators.cohort import stratum_column
from cohortscope.operators.quantiles import exact_quantiles
from cohortscope.operators.summary import QUARTILES
from cohortscope.plans.scratch import written

GROUP = ["task_id", "stratum", "group"]
VIOLIN = [*GROUP, "hue"]
BROADCAST_GROUPS = 100_000
GRID = 100
# The density reaches this many bandwidths beyond the data.
CUT = 2.0
# Violins of more rows are binned, with so many nodes to a bandwidth, if their range has no more nodes than that.
EXACT_UP_TO = 10_000
NODES = 32
MOST_NODES = 1 << 20


def _long(rows: DataFrame, cfg: EvalConfig) -> DataFrame:
    return (
        rows.where("SCORE is not null and y is not null")
        .unpivot(
            ["task_id", "method", "SCORE", "y"],
            [F.col(stratum_column(s)).alias(s) for s in cfg.strata],
            "stratum",
            "group",
        )
        .where(F.col("group").isNotNull())
    )


def _ambiguous(group: Column, cfg: EvalConfig, match: str) -> Column:
    if match == "exact":
        return group.isin(*cfg.ambiguous)
    return reduce(lambda a, b: a | b, (group.contains(F.lit(a)) for a in cfg.ambiguous))


def plotted_groups(rows: DataFrame, cfg: EvalConfig, match: str = "substring") -> DataFrame:
    """Groups that are drawn, one small row each.

    A group counts as kept with more than ``min_cases`` cases (logistic) or rows (linear). With
    ``substring`` matching, a group is also drawn when its name contains the name of a kept one, and
    a name that contains an ambiguous answer is left out.
    """
    sizes = (
        _long(rows, cfg)
        .groupBy(*GROUP, "method")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("cases"))
        .where(~_ambiguous(F.col("group"), cfg, match))
    )
    size = F.when(F.col("method") == LOGISTIC, F.col("cases")).otherwise(F.col("n"))
    kept = sizes.where(size > cfg.min_cases).select(
        "task_id", "stratum", F.col("group").alias("kept_group")
    )
    if match == "exact":
        return sizes.join(kept.withColumnRenamed("kept_group", "group"), GROUP, "left_semi")
    # Parts of a name that are as long as some kept name are looked up, so names are not compared with each other.
    names = kept.groupBy("task_id", "stratum").agg(F.collect_set(F.length("kept_group")).alias("sizes"))
    every = "transform(sequence(1, length(group) - size + 1), i -> substring(group, i, size))"
    parts = sizes.join(names, ["task_id", "stratum"]).select(
        *GROUP, F.explode(F.expr(f"flatten(transform(filter(sizes, x -> x <= length(group)), size -> {every}))")).alias("kept_group")
    )
    drawn = parts.join(kept, ["task_id", "stratum", "kept_group"], "left_semi").select(*GROUP).distinct()
    return sizes.join(drawn, GROUP, "left_semi")


def _small(groups: DataFrame) -> DataFrame:
    """A written table of groups, to be broadcast if it is counted to be small."""
    return F.broadcast(groups) if groups.count() <= BROADCAST_GROUPS else groups


def distribution(rows: DataFrame, cfg: EvalConfig, match: str = "substring") -> DataFrame:
    """All strata in one pass: request, stratum, group, hue (the outcome if logistic), score."""
    groups = _small(written(plotted_groups(rows, cfg, match).select(*GROUP), "plotted-groups"))
    hue = F.when(F.col("method") == LOGISTIC, F.col("y").cast("int").cast("string")).otherwise("")
    return _long(rows, cfg).join(groups, GROUP, "left_semi").select(*GROUP, hue.alias("hue"), "SCORE")


def violin_box(plot: DataFrame, cfg: EvalConfig) -> DataFrame:
    """Quartiles and whiskers (furthest value within 1.5 interquartile ranges) per violin."""
    box = exact_quantiles(plot, VIOLIN, "SCORE", QUARTILES, None, cfg.max_ranked).select(
        *VIOLIN, F.col("q")[0].alias("q1"), F.col("q")[1].alias("median"), F.col("q")[2].alias("q3")
    )
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    score = F.col("SCORE")
    return (
        plot.join(box, VIOLIN)
        .groupBy(*VIOLIN)
        .agg(
            F.count(F.lit(1)).alias("n"),
            *(F.first(c).alias(c) for c in ("q1", "median", "q3")),
            F.min(F.when(score >= F.col("q1") - reach, score)).alias("whisker_low"),
            F.max(F.when(score <= F.col("q3") + reach, score)).alias("whisker_high"),
        )
    )


def binning_error(nodes: int = NODES) -> float:
    """Largest error of a binned density, in units of the kernel's height 1 / (h sqrt(2 pi)).

    A row between two nodes counts as their mixture, so the kernel over it is interpolated linearly; over a
    distance of h / nodes that is off by at most an eighth of its square times the largest curvature, 1 / h^2.
    """
    return 1 / (8 * nodes**2)


def violin_density(
    plot: DataFrame, grid: int = GRID, cut: float = CUT, exact_up_to: int | None = EXACT_UP_TO, nodes: int = NODES
) -> DataFrame:
    """Gaussian density of every violin on an even grid, with Scott's bandwidth.

    One aggregate gives size, spread and bounds. Rows of a violin with more than ``exact_up_to`` rows are dealt to the
    two nearest of ``nodes`` nodes per bandwidth, in proportion to their nearness; the kernels are summed over the
    nodes, of which there are as many as its range is long, whatever the rows. ``binning_error`` bounds what that
    changes. In smaller violins, and in all with ``exact_up_to=None``, every row adds to the sums itself. The
    sums are combined on the map side, so the shuffle is groups times grid points. A violin without spread has no
    density.
    """
    shape = written(
        plot.groupBy(*VIOLIN)
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.stddev_samp("SCORE").alias("spread"),
            F.min("SCORE").alias("lo"),
            F.max("SCORE").alias("hi"),
        )
        .where("spread > 0 and lo < hi")
        .withColumn("h", F.expr("spread * pow(n, -0.2D)"))
        .select(
            *VIOLIN,
            "n",
            "h",
            "lo",
            F.expr(f"lo - {cut}D * h").alias("start"),
            F.expr(f"(hi - lo + {2 * cut}D * h) / {grid - 1}").alias("pace"),
            F.expr("false" if exact_up_to is None else f"n > {exact_up_to} and (hi - lo) / h * {nodes} < {MOST_NODES}").alias("binned"),
        ),
        "violin-shapes",
    )
    met = plot.join(_small(shape), VIOLIN)
    kept = [*VIOLIN, "n", "h", "start", "pace"]
    single = met.where("not binned").select(*kept, F.col("SCORE").alias("s"), F.lit(1.0).alias("w"))
    place = met.where("binned").withColumn("node", F.expr(f"(SCORE - lo) / h * {nodes}"))
    ends = "array(struct(floor(node) as k, 1 - (node - floor(node)) as w), struct(floor(node) + 1 as k, node - floor(node) as w))"
    shared = place.select(*kept, "lo", F.inline(F.expr(ends))).groupBy(*kept, "lo", "k").agg(F.sum("w").alias("w"))
    rows = single.unionByName(shared.select(*kept, F.expr(f"lo + k * h / {nodes}").alias("s"), "w"))
    kernel = "sum(w * exp(-0.5D * pow((start + pace * {0} - s) / h, 2)))"
    sums = rows.groupBy(*kept).agg(*(F.expr(kernel.format(k)).alias(f"k{k}") for k in range(grid)))
    points = F.posexplode(F.expr("array(" + ", ".join(f"k{k}" for k in range(grid)) + ")"))
    return sums.select(*kept, points.alias("point", "kernels")).select(
        *VIOLIN,
        "point",
        F.expr("start + pace * point").alias("x"),
        F.expr("kernels / (n * h * sqrt(2 * pi()))").alias("density"),
    )
