"""Every request, cell and formula evaluated in a fixed, small number of passes over the cohort."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortscope.config import LINEAR, LOGISTIC, EvalConfig
from cohortscope.functions.columns import (
    balanced_accuracy,
    holdout_bucket,
    suppressed,
    test_size,
)
from cohortscope.operators.bundles import Bundles, of_rows, request_rows
from cohortscope.operators.cohort import PERSON
from cohortscope.operators.design import Design, Scale, make_design, request_scales
from cohortscope.operators.linear import linear_gate, solve_cells
from cohortscope.operators.logistic import fit_logistic, logistic_gate
from cohortscope.operators.moments import cell_moments
from cohortscope.operators.strata import TASK_CELL, named_cells
from cohortscope.operators.summary import quartile_columns, score_quartiles
from cohortscope.plans.scratch import written


@dataclass
class Evaluation:
    """Reports per method, before the incremental column is added."""

    linear: DataFrame
    logistic: DataFrame


@dataclass
class Models:
    bundles: Bundles
    table: DataFrame
    design: Design
    scales: dict[str, Scale]


def fit_cells(cohort: Bundles | DataFrame, cfg: EvalConfig, holdout: bool = False) -> Models:
    """Moments of all cells and the models that follow from them, for bundles or for rows of single requests."""
    rows = cohort.rows if isinstance(cohort, Bundles) else cohort
    if holdout:
        share = int(round(cfg.test_fraction * 1000))
        rows = rows.withColumn("held", holdout_bucket(F.col(PERSON), cfg.holdout_seed) < share)
    if isinstance(cohort, Bundles):
        bundles = Bundles(rows, cohort.requests, cohort.outcomes).stored()
    else:
        bundles = of_rows(rows)
    design = make_design(bundles.rows, cfg)
    scales = request_scales(bundles, design)
    moments = cell_moments(bundles, design, scales, cfg, holdout)
    table = written(solve_cells(moments, bundles, design, scales, cfg), "models")
    return Models(bundles, table, design, scales)


def _with_quartiles(models: DataFrame, fitted: Models, cfg: EvalConfig, method: str) -> DataFrame:
    rows = request_rows(fitted.bundles, cfg, method)
    largest = models.agg(F.max("n")).first()[0] or 0
    quartiles = score_quartiles(rows, cfg, largest)
    return models.join(quartiles, [*TASK_CELL, "formula"], "left")


def _score_columns() -> list:
    """Score summaries; null for a formula without the score."""
    median, *quartiles = quartile_columns()
    return [
        F.col("mean_score").alias("MEAN_PRS"),
        median,
        F.col("var_score").alias("VAR_PRS"),
        *quartiles,
    ]


def linear_report(fitted: Models, cfg: EvalConfig, holdout: bool = False) -> DataFrame:
    """Rows of the linear report: fit metrics, split sizes and score summaries."""
    models = fitted.table.where(F.col("method") == LINEAR)
    if holdout:
        models = models.where(F.col("n") > cfg.linear_min_n).where(F.col("held") > cfg.linear_min_test)
        metrics = [F.col("held_rsq").alias("RSQ"), F.col("held_mse").alias("MSE")]
        sizes = [(F.col("n") - F.col("held")).alias("TRAINING_SIZE"), F.col("held").alias("TESTING_SIZE")]
    else:
        models = models.where(linear_gate(cfg))
        held = test_size(F.col("n"), cfg.test_fraction)
        metrics = [F.col("rsq").alias("RSQ"), F.col("mse").alias("MSE")]
        sizes = [(F.col("n") - held).alias("TRAINING_SIZE"), held.alias("TESTING_SIZE")]
    return _with_quartiles(models, fitted, cfg, LINEAR).select(
        "task_id",
        *named_cells(cfg),
        F.col("formula").alias("COVARIATES"),
        *metrics,
        *sizes,
        *_score_columns(),
        F.col("n").alias("N"),
    )


def logistic_report(fitted: Models, cfg: EvalConfig) -> DataFrame:
    """Rows of the logistic report: label counts, AUC of hard labels and score summaries.

    A model that has not converged within ``max_iter`` passes fails the run. With ``keep_unconverged`` its
    row stays, and the report has a further column CONVERGED (null for cells of one class, not fitted).
    """
    models = fitted.table.where(F.col("method") == LOGISTIC).where(logistic_gate(cfg))
    labels = fit_logistic(fitted.bundles, fitted.table, fitted.design, fitted.scales, cfg)
    if not cfg.keep_unconverged:
        open_models = labels.where("not converged")
        some = open_models.limit(5).collect()
        if some:
            names = "; ".join(f"{r.task_id} {r.group_one} {r.group_two} {r.formula}" for r in some)
            raise RuntimeError(
                f"{open_models.count()} logistic models did not converge in {cfg.max_iter} passes, such as {names}"
            )
    joined = _with_quartiles(models, fitted, cfg, LOGISTIC).join(
        labels.select(*TASK_CELL, "formula", "tp", "fp", "tn", "fn", "converged"), [*TASK_CELL, "formula"], "left"
    )
    tp, fp, tn, fn = (F.col(c) for c in ("tp", "fp", "tn", "fn"))
    cases = F.col("y_sum").cast("long")
    controls = F.col("n") - cases
    shown = [
        suppressed(c, cfg.suppress).alias(name)
        for c, name in (
            (tp, "TRUE_POSITIVE"),
            (fp, "FALSE_POSITIVE"),
            (tn, "TRUE_NEGATIVE"),
            (fn, "FALSE_NEGATIVE"),
        )
    ]
    prevalence = F.col("y_sum") / F.col("n")
    if cfg.suppress_all:
        hidden = (cases <= cfg.suppress) | (controls <= cfg.suppress)
        prevalence = F.when(~hidden, prevalence)
        cases, controls = suppressed(cases, cfg.suppress), suppressed(controls, cfg.suppress)
    return joined.select(
        "task_id",
        *named_cells(cfg),
        F.col("formula").alias("COVARIATES"),
        balanced_accuracy(tp, fp, tn, fn).alias("AUC"),
        *shown,
        prevalence.alias("DISEASE_PREV"),
        *_score_columns(),
        cases.alias("CASES"),
        controls.alias("CONTROLS"),
        *([F.col("converged").alias("CONVERGED")] if cfg.keep_unconverged else []),
    )


def evaluate(cohort: Bundles | DataFrame, cfg: EvalConfig, holdout: bool = False) -> Evaluation:
    """Both reports. ``holdout`` scores the linear models on rows left out of the fit."""
    fitted = fit_cells(cohort, cfg, holdout)
    return Evaluation(linear_report(fitted, cfg, holdout), logistic_report(fitted, cfg))

