"""Requests, task map, scores and demographics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortscope.config import EvalConfig
from cohortscope.functions.columns import null_tokens
from cohortscope.sources.weights import weight_file_name

REQUEST_SCHEMA = "pgs string, phenotype string, regression string"
MAP_SCHEMA = "id string, weight_file string, version string, phenotype string, regression string"
# Types of the score file and the texts that mean a missing value.
SCORE_TYPES = {
    "FID": "long",
    "IID": "long",
    "ALLELE_CT": "long",
    "NAMED_ALLELE_DOSAGE_SUM": "double",
    "SCORE": "double",
}
NULL_TOKENS = ("None", "NA")


def read_requests(spark: SparkSession, path: str) -> DataFrame:
    """Headerless, space-separated: score, phenotype, regression."""
    return spark.read.schema(REQUEST_SCHEMA).csv(path, sep=" ")


def build_task_map(requests: DataFrame, versions: DataFrame) -> DataFrame:
    """One row per request: id, normalised weight file, format version, phenotype, regression."""
    known = versions.groupBy("pgs").agg(F.max("version").alias("version"))
    return requests.join(known, "pgs", "left").select(
        F.concat_ws("_", "pgs", "phenotype", "regression").alias("id"),
        weight_file_name(F.col("pgs")).alias("weight_file"),
        "version",
        "phenotype",
        "regression",
    )


def write_task_map(task_map: DataFrame, path: str) -> None:
    task_map.write.mode("overwrite").csv(path, sep=" ")


def read_task_map(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(MAP_SCHEMA).csv(path, sep=" ")


def requests_of_map(task_map: DataFrame) -> DataFrame:
    """The requests a map was built from; the score is the id up to its first underscore."""
    return task_map.select(F.split_part("id", F.lit("_"), F.lit(1)).alias("pgs"), "phenotype", "regression")


def _by_name(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Tab-separated text with a column line; files whose columns differ are refused."""
    return spark.read.options(sep="\t", header=True, enforceSchema=False).csv(paths)


def _typed(name: str, kind: str, tokens: tuple[str, ...]) -> Column:
    return null_tokens(F.col(f"`{name}`"), tokens).cast(kind)


def read_scores(
    spark: SparkSession,
    paths: str | list[str],
    null_values: tuple[str, ...] = NULL_TOKENS,
) -> DataFrame:
    """Score files (or folders) ``<request id>_prs.sscore``, keyed by the request id in the name."""
    raw = _by_name(spark, paths)
    names = {c.lstrip("#"): c for c in raw.columns}
    task = F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)_prs\.sscore", 1)
    return raw.select(
        task.alias("task_id"),
        *(
            _typed(names[c], kind, null_values).alias(c)
            for c, kind in SCORE_TYPES.items()
            if c in names
        ),
    )


def read_demographics(
    spark: SparkSession,
    paths: str | list[str],
    cfg: EvalConfig,
    outcomes: list[str],
    text_covariates: tuple[str, ...] = ("sex_at_birth",),
    null_values: tuple[str, ...] | None = None,
) -> DataFrame:
    """Person, strata as text, covariates and outcomes as numbers; other columns are not read.

    ``null_values`` are the texts that mean a missing value, by default those of ``cfg``.
    """
    null_values = cfg.null_tokens if null_values is None else null_values
    text = set(cfg.strata) | set(text_covariates)
    wanted = dict.fromkeys((*cfg.strata, *cfg.covariates, *outcomes))
    return _by_name(spark, paths).select(
        _typed("IID", "long", null_values).alias("IID"),
        *(
            _typed(c, "string" if c in text else "double", null_values).alias(c)
            for c in wanted
        ),
    )
