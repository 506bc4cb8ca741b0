"""The whole run: weights, scores per person, evaluation of every request, reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cohortscope.config import LINEAR, LOGISTIC, EvalConfig
from cohortscope.operators.bundles import build_bundles
from cohortscope.operators.cohort import prepare_tasks
from cohortscope.operators.evaluate import Evaluation, evaluate
from cohortscope.operators.incremental import incremental
from cohortscope.operators.scoring import score_many
from cohortscope.sources.reports import METRIC, report_table, union_reports, write_report
from cohortscope.sources.weights import read_weights


def final_reports(result: Evaluation, tasks: DataFrame, legacy: bool = False) -> dict[str, DataFrame]:
    """Report per method, with the gain of the score over the covariates."""
    raw = {LINEAR: result.linear, LOGISTIC: result.logistic}
    return {
        method: report_table(incremental(raw[method], METRIC[method]), tasks, method, legacy)
        for method in raw
    }


def evaluate_requests(
    scores: DataFrame,
    demographics: DataFrame,
    requests: DataFrame,
    cfg: EvalConfig | None = None,
    holdout: bool = False,
    legacy: bool = False,
) -> DataFrame:
    """All requests in one run: one table of both methods.

    ``legacy`` leaves out the columns the older report does not have; ``EvalConfig.legacy()`` has its gates.
    """
    cfg = cfg or EvalConfig()
    tasks = prepare_tasks(requests, cfg)
    cohort = build_bundles(scores, demographics, tasks, cfg)
    reports = final_reports(evaluate(cohort, cfg, holdout), tasks, legacy)
    return union_reports(reports[LINEAR], reports[LOGISTIC])


def run(
    spark: SparkSession,
    requests: DataFrame,
    weight_paths: str | list[str],
    dosages: DataFrame,
    demographics: DataFrame,
    report_path: str,
    cfg: EvalConfig | None = None,
    holdout: bool = False,
    legacy: bool = False,
    **scoring,
) -> DataFrame:
    """From landed weight files and dosages to written reports."""
    cfg = cfg or EvalConfig()
    wanted = requests.select("pgs").distinct()
    weights = read_weights(spark, weight_paths).join(wanted, "pgs", "left_semi")
    scores = score_many(dosages, weights, **scoring)
    report = evaluate_requests(scores, demographics, requests, cfg, holdout, legacy)
    return write_report(report, report_path)

