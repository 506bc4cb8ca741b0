"""Scores joined to demographics, and the rows each request is evaluated on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from cohortscope.config import EvalConfig
from cohortscope.functions.columns import (
    all_present,
    known_group,
    method_of,
    missing_as_null,
    outcome_of,
)

PERSON = "IID"
SCORE = "SCORE"


def stratum_column(name: str) -> str:
    return f"stratum_{name}"


def join_scores(scores: DataFrame, demographics: DataFrame) -> DataFrame:
    """Inner join on the person. Duplicate persons multiply; a null person matches nobody.

    Only keys and the score are taken from the score table. The side is broadcast only when Spark's
    own size check allows it; otherwise the sort-merge join splits oversized keys at run time.
    """
    keys = [k for k in ("task_id", "pgs", PERSON) if k in scores.columns]
    clash = (set(keys + [SCORE]) - {PERSON}) & set(demographics.columns)
    if clash:
        raise ValueError(f"demographics also has the columns {sorted(clash)}")
    return scores.select(*keys, SCORE).join(demographics, PERSON, "inner")


def prepare_tasks(requests: DataFrame, cfg: EvalConfig) -> DataFrame:
    """Requests (pgs, phenotype, regression) with their id, outcome column and method.

    Different requests that would share an id (``A_b`` and ``c``, ``A`` and ``b_c``) are an error.
    """
    tasks = requests.select(
        F.concat_ws("_", "pgs", "phenotype", "regression").alias("task_id"),
        "pgs",
        "phenotype",
        "regression",
        outcome_of(F.col("phenotype"), cfg.outcome_alias).alias("outcome"),
        method_of(F.col("regression")).alias("method"),
    ).distinct()
    shared = tasks.groupBy("task_id").count().where("count > 1").select("task_id").limit(1).collect()
    if shared:
        raise ValueError(f"several requests have the id {shared[0][0]}")
    return tasks


def build_cohort(
    scores: DataFrame,
    demographics: DataFrame,
    tasks: DataFrame,
    cfg: EvalConfig,
    outcomes: list[str] | None = None,
) -> DataFrame:
    """One row per request and person: score, outcome ``y``, strata and covariates.

    Scores are keyed by ``pgs`` or by ``task_id``. ``outcomes`` names the outcome columns in use;
    by default they are read from the (small) request table.
    """
    if outcomes is None:
        outcomes = sorted(r.outcome for r in tasks.select("outcome").distinct().collect())
    return attach_tasks(join_scores(scores, demographics), tasks, cfg, outcomes)


def _check_present(people: DataFrame, cfg: EvalConfig, outcomes: list[str]) -> None:
    lacking = [c for c in (*cfg.strata, *cfg.covariates, *outcomes) if c not in people.columns]
    if lacking:
        raise ValueError(f"demographics lacks the columns {lacking}")


def check_columns(scores: DataFrame, demographics: DataFrame, cfg: EvalConfig, outcomes: list[str]) -> None:
    """Whether scores and demographics can be joined: all columns there, none twice."""
    keys = [k for k in ("task_id", "pgs", PERSON) if k in scores.columns]
    clash = (set(keys + [SCORE]) - {PERSON}) & set(demographics.columns)
    if clash:
        raise ValueError(f"demographics also has the columns {sorted(clash)}")
    _check_present(demographics, cfg, outcomes)


def person_columns(people: DataFrame, cfg: EvalConfig) -> list[Column]:
    """A person's groups and covariates."""
    text = {f.name for f in people.schema if isinstance(f.dataType, StringType)}
    return [
        *(known_group(s, cfg).alias(stratum_column(s)) for s in cfg.strata),
        *(F.col(c) if c in text else missing_as_null(c).alias(c) for c in cfg.covariates),
    ]


def attach_tasks(
    joined: DataFrame, tasks: DataFrame, cfg: EvalConfig, outcomes: list[str]
) -> DataFrame:
    _check_present(joined, cfg, outcomes)
    key = "task_id" if "task_id" in joined.columns else "pgs"
    picked = F.element_at(
        F.array(*(missing_as_null(c) for c in outcomes)),
        F.array_position(F.array(*(F.lit(c) for c in outcomes)), F.col("outcome")).cast("int"),
    )
    rows = joined.join(tasks.select(key, *({"task_id"} - {key}), "method", "outcome"), key)
    return rows.select(
        "task_id",
        "method",
        PERSON,
        missing_as_null(SCORE).alias(SCORE),
        picked.alias("y"),
        *person_columns(joined, cfg),
    )


def covariates_ok(cfg: EvalConfig, use_sex: bool):
    """Complete covariates, with or without the sex covariate."""
    names = [c for c in cfg.covariates if use_sex or c != cfg.sex_covariate]
    return all_present(names)
