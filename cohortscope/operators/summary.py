"""Counts and score summaries per cell, in the JVM.

Sums are taken first over the full combination of strata, which bounds the rows that are fanned out
by the number of combinations rather than by the number of persons.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortscope.config import BOTH, LOGISTIC, PRS_ONLY, EvalConfig
from cohortscope.functions.columns import formula_mask, test_size
from cohortscope.operators.cohort import stratum_column
from cohortscope.operators.quantiles import BINS, BROADCAST_TARGETS, exact_quantiles, searched, wanted_ranks
from cohortscope.operators.strata import (
    TASK_CELL,
    cell_codes,
    decoded_cell,
    fan_out,
    fan_out_coded,
    group_lists,
    named_cells,
    with_codes,
    with_completeness,
)
from cohortscope.plans.scratch import written

QUARTILES = (0.25, 0.5, 0.75)


def _combined(rows: DataFrame, cfg: EvalConfig, sums: dict[str, Column]) -> DataFrame:
    """Sums per request, combination of strata and completeness flags; rows without outcome drop."""
    keys = ["task_id", "method", *(stratum_column(s) for s in cfg.strata)]
    flagged = with_completeness(rows, cfg).where(F.col("y").isNotNull())
    return flagged.groupBy(
        *keys, "ok_with_sex", "ok_without_sex", F.col("SCORE").isNotNull().alias("score_ok")
    ).agg(*(F.sum(c).alias(name) for name, c in sums.items()))


def cell_sizes(rows: DataFrame, cfg: EvalConfig) -> DataFrame:
    """Complete cases, cases and controls per request, cell and formula."""
    sums = {
        "n": F.lit(1).cast("long"),
        "y_sum": F.col("y"),
        "cases": (F.col("y") == 1).cast("long"),
        "controls": (F.col("y") == 0).cast("long"),
    }
    fanned = fan_out(_combined(rows, cfg, sums), cfg, ["task_id", "method", "score_ok", *sums])
    masked = [
        F.sum(F.when(formula_mask(f, F.col("score_ok"), F.col("covariates_ok")), F.col(c))).alias(f"{c}{i}")
        for i, f in enumerate(cfg.formulas)
        for c in sums
    ]
    per_formula = ", ".join(
        f"'{f}', " + ", ".join(f"{c}{i}" for c in sums) for i, f in enumerate(cfg.formulas)
    )
    return (
        fanned.groupBy(*TASK_CELL, "method")
        .agg(*masked)
        .select(
            *TASK_CELL,
            "method",
            F.expr(f"stack({len(cfg.formulas)}, {per_formula})").alias("formula", *sums),
        )
        .where("n > 0")
    )


def passes_gate(cfg: EvalConfig) -> Column:
    """Size gate on columns method, n and y_sum."""
    n = F.col("n")
    linear = (n > cfg.linear_min_n) & (test_size(n, cfg.test_fraction) > cfg.linear_min_test)
    logistic = (n > cfg.logistic_min_n) & (F.col("y_sum") > cfg.min_cases)
    return F.when(F.col("method") == LOGISTIC, logistic).otherwise(linear)


def split_sizes(n: Column, cfg: EvalConfig) -> list[Column]:
    """Reported sizes of an 80:20 split (the models use all rows)."""
    held = test_size(n, cfg.test_fraction)
    return [(n - held).alias("TRAINING_SIZE"), held.alias("TESTING_SIZE")]


def score_quartiles(rows: DataFrame, cfg: EvalConfig, largest: int | None = None) -> DataFrame:
    """Exact quartiles of the score per request, cell and formula that uses the score.

    ``largest`` is the size of the largest cell, if the caller knows it. Cells that are known to be small use the
    built-in percentile; otherwise their histograms are put together from those of combinations of strata.
    """
    scored = with_completeness(rows, cfg).where("y is not null and SCORE is not null")
    masks = {PRS_ONLY: F.lit(True), BOTH: F.col("covariates_ok")}
    wanted = {f: m for f, m in masks.items() if f in cfg.formulas}
    if not wanted:
        empty = "task_id string, set_id int, group_one string, group_two string, formula string, q array<double>"
        return rows.sparkSession.createDataFrame([], empty)
    # Numbering the cells takes a pass of its own, which pays off only when the bins are needed.
    small = largest is not None and largest <= cfg.max_ranked
    lists = None if small else group_lists(rows, cfg)
    if lists is None:
        fanned = fan_out(scored, cfg, ["task_id", "SCORE"])
        found = exact_quantiles(fanned, TASK_CELL, "SCORE", QUARTILES, wanted, cfg.max_ranked, largest)
        return found.select(*TASK_CELL, F.col("mask").alias("formula"), "q")
    found = merged_quantiles(scored, cfg, lists, list(wanted), QUARTILES)
    return found.select("task_id", *decoded_cell(cfg, lists), F.col("mask").alias("formula"), "q")


def merged_quantiles(
    scored: DataFrame, cfg: EvalConfig, lists: dict[str, list[str]], formulas: list[str], probabilities: tuple[float, ...], bins: int = BINS
) -> DataFrame:
    """Quantiles of the score per request, cell (as its number) and formula, from histograms that add up.

    Scores are counted per combination of strata and bin; the counts, not the persons, are fanned out to the cells
    and added up there. That tells for each cell which bins hold its quantiles. A person then goes to those of
    its cells only that look into the bin its score is in.
    """
    flags = {f"in_{i}": ("true" if f == PRS_ONLY else "covariates_ok") for i, f in enumerate(formulas)}
    # An even grid of each request's own range; its ends are scaled first, as their difference may exceed any double.
    bounds = scored.groupBy("task_id").agg(F.min("SCORE").alias("from_"), F.max("SCORE").alias("to_"))
    share = f"(SCORE / {bins} - from_ / {bins}) / (to_ / {bins} - from_ / {bins})"
    bin_ = F.expr(f"cast(if(to_ > from_, least(floor({share} * {bins}), {bins - 1}), 0) as int)")
    strata = [stratum_column(s) for s in cfg.strata]
    # One row per request; shuffled by request, all rows of one would be counted and fanned out by a single task.
    flat = scored.select("task_id", "SCORE", "ok_with_sex", "ok_without_sex", *strata).join(F.broadcast(bounds), "task_id").withColumn("bin", bin_)
    combined = flat.groupBy("task_id", "bin", "ok_with_sex", "ok_without_sex", *strata).agg(
        F.count(F.lit(1)).alias("n"), F.min("SCORE").alias("lo"), F.max("SCORE").alias("hi")
    )
    fanned = fan_out_coded(combined, cfg, lists, ["task_id", "bin", "n", "lo", "hi"])
    counted = fanned.groupBy("task_id", "cell", "bin").agg(
        F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.sum("n").alias("width"),
        *(F.sum(F.expr(f"if({mask}, n, 0L)")).alias(flag) for flag, mask in flags.items()),
    )
    # At most as many rows per cell as there are bins.
    cell, running = Window.partitionBy("task_id", "cell"), Window.partitionBy("task_id", "cell").orderBy("bin")
    sums = counted.select(
        "*",
        *(F.sum(f).over(cell).alias(f"all_{f}") for f in flags),
        F.array(*(F.sum(f).over(running) for f in flags)).alias("through"),
        F.array(*flags).alias("size"),
    )
    ranked = sums.select("*", wanted_ranks({f: f"all_{f}" for f in flags}, probabilities)).where("rank >= 0")
    before = "through[flag] - size[flag]"
    targets = ranked.where(f"rank >= {before} and rank < through[flag]").selectExpr(
        "task_id", "cell", "bin", "lo", "hi", "width", "flag", "p", "side", f"rank - ({before}) as rank", "fraction"
    )
    targets = written(targets, "quantile-targets")
    # Which cells look into a bin; a person is in one cell of each set at most.
    asked = targets.groupBy("task_id", "bin").agg(F.collect_set("cell").alias("asked"))
    asked = F.broadcast(asked) if targets.count() <= BROADCAST_TARGETS else asked
    codes = ", ".join(cell_codes(cfg))
    sexes = ", ".join(str(s.use_sex).lower() for s in cfg.strata_sets())
    near = with_codes(flat.join(asked, ["task_id", "bin"]), cfg, lists).withColumn("own", F.expr(f"array({codes})"))
    mine = "filter(asked, c -> own[cast(shiftright(c, 40) as int)] = c)"
    near = near.select("task_id", "SCORE", "ok_with_sex", "ok_without_sex", F.explode(F.expr(mine)).alias("cell"))
    ok = F.expr(f"if(array({sexes})[cast(shiftright(cell, 40) as int)], ok_with_sex, ok_without_sex)")
    near = near.withColumn("covariates_ok", ok)
    pairs = written(
        near.select("task_id", "cell", F.col("SCORE").alias("v"), *(F.expr(mask).alias(f) for f, mask in flags.items())), "near-quantiles"
    )
    largest = targets.where("lo < hi").agg(F.max("width")).first()[0] or 0
    return searched(pairs, targets.drop("bin"), ["task_id", "cell"], formulas, list(flags), cfg.max_ranked, largest)


def score_summary(rows: DataFrame, cfg: EvalConfig) -> DataFrame:
    """Mean, variance and quartiles of the score per cell, for the formulas that use it."""
    scored = with_completeness(rows, cfg).where("y is not null and SCORE is not null")
    fanned = fan_out(scored, cfg, ["task_id", "SCORE"])
    both = F.when(F.col("covariates_ok"), F.col("SCORE"))
    formulas = [(f, m) for f, m in ((PRS_ONLY, "SCORE"), (BOTH, "if(covariates_ok, SCORE, null)")) if f in cfg.formulas]
    stats = fanned.groupBy(*TASK_CELL).agg(
        *(
            F.expr(f"{function}({m})").alias(f"{name}{i}")
            for i, (_, m) in enumerate(formulas)
            for name, function in (("n", "count"), ("mean", "avg"), ("var", "var_samp"))
        )
    )
    per_formula = ", ".join(f"'{f}', n{i}, mean{i}, var{i}" for i, (f, _) in enumerate(formulas))
    long = written(
        stats.select(
            *TASK_CELL,
            F.expr(f"stack({len(formulas)}, {per_formula})").alias("formula", "n", "MEAN_PRS", "VAR_PRS"),
        ).where("n > 0"),
        "score-summary",
    )
    largest = long.agg(F.max("n")).first()[0] or 0
    return long.join(score_quartiles(rows, cfg, largest), [*TASK_CELL, "formula"]).select(
        "task_id",
        *named_cells(cfg),
        F.col("formula").alias("COVARIATES"),
        "n",
        "MEAN_PRS",
        "VAR_PRS",
        *quartile_columns(),
    )


def quartile_columns() -> list[Column]:
    return [
        F.col("q")[1].alias("MEDIAN_PRS"),
        F.col("q")[0].alias("PRS_Q1"),
        F.col("q")[1].alias("PRS_Q2"),
        F.col("q")[2].alias("PRS_Q3"),
    ]


def single_regressor(rows: DataFrame, cfg: EvalConfig) -> DataFrame:
    """R2 and MSE of y ~ SCORE per cell in closed form, without leaving the JVM.

    Values are shifted by the request's means before they are squared, so the sums keep their digits.
    """
    used = rows.where("y is not null and SCORE is not null")
    centre = used.groupBy("task_id").agg(F.avg("SCORE").alias("s0"), F.avg("y").alias("y0"))
    shifted = used.join(centre, "task_id").withColumns(
        {"s": F.col("SCORE") - F.col("s0"), "e": F.col("y") - F.col("y0")}
    )
    s, e = F.col("s"), F.col("e")
    sums = {"n": F.lit(1).cast("long"), "s": s, "e": e, "ss": s * s, "ee": e * e, "se": s * e}
    total = (
        fan_out(_combined(shifted, cfg, sums), cfg, ["task_id", *sums])
        .groupBy(*TASK_CELL)
        .agg(*(F.sum(c).alias(c) for c in sums))
        .where(F.col("n") > cfg.linear_min_n)
        .where(test_size(F.col("n"), cfg.test_fraction) > cfg.linear_min_test)
    )
    n = F.col("n")
    moments = total.withColumns(
        {
            "sxx": F.col("ss") - F.col("s") * F.col("s") / n,
            "syy": F.col("ee") - F.col("e") * F.col("e") / n,
            "sxy": F.col("se") - F.col("s") * F.col("e") / n,
        }
    )
    sxx, syy, sxy = F.col("sxx"), F.col("syy"), F.col("sxy")
    # A constant outcome is fitted exactly; a constant score explains nothing.
    rsq = (
        F.when(syy <= 1e-12 * F.col("ee"), F.lit(1.0))
        .when(sxx <= 1e-12 * F.col("ss"), F.lit(0.0))
        .otherwise(sxy * sxy / (sxx * syy))
    )
    return moments.withColumn("RSQ", rsq).select(
        "task_id",
        *named_cells(cfg),
        F.lit(PRS_ONLY).alias("COVARIATES"),
        "RSQ",
        (F.greatest(syy, F.lit(0.0)) * (1 - F.col("RSQ")) / n).alias("MSE"),
        *split_sizes(n, cfg),
        n.alias("N"),
    )
