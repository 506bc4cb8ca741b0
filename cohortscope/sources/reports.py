"""Report tables: final columns, sinks, and reading a stored report."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortscope.config import LINEAR, LOGISTIC
from cohortscope.operators.incremental import incremental

_CELL = ("STRATA_ONE", "GROUP_ONE", "STRATA_TWO", "GROUP_TWO")
_SCORE = ("MEAN_PRS", "MEDIAN_PRS", "VAR_PRS", "PRS_Q1", "PRS_Q2", "PRS_Q3")
# Report columns in their order.
REPORT_COLUMNS = {
    LOGISTIC: (
        "PGS", *_CELL, "COVARIATES", "AUC", "TRUE_POSITIVE", "FALSE_POSITIVE", "TRUE_NEGATIVE",
        "FALSE_NEGATIVE", "DISEASE_PREV", *_SCORE, "CASES", "CONTROLS",
    ),
    LINEAR: (
        "PGS", *_CELL, "COVARIATES", "RSQ", "MSE", "TRAINING_SIZE", "TESTING_SIZE", *_SCORE, "N",
    ),
}
METRIC = {LOGISTIC: "AUC", LINEAR: "RSQ"}
# Columns that the older report does not have.
LEGACY_ABSENT = ("CASES", "CONTROLS", "N")
_COUNTS = {
    "TRUE_POSITIVE", "FALSE_POSITIVE", "TRUE_NEGATIVE", "FALSE_NEGATIVE", "CASES", "CONTROLS",
    "TRAINING_SIZE", "TESTING_SIZE", "N",
}
_TEXT = {"PGS", *_CELL, "COVARIATES"}


def report_table(results: DataFrame, tasks: DataFrame, method: str, legacy: bool = False) -> DataFrame:
    """Results of one method with the score, phenotype, outcome and method they belong to."""
    columns = [c for c in REPORT_COLUMNS[method] if not (legacy and c in LEGACY_ABSENT)]
    extra = [c for c in results.columns if c.startswith("INCREMENTAL_") or c == "CONVERGED"]
    about = tasks.select("task_id", F.col("pgs").alias("PGS"), "phenotype", "outcome", "method")
    return results.join(about, "task_id").select(
        "task_id", "phenotype", "outcome", "method", *columns, *extra
    )


def union_reports(linear: DataFrame, logistic: DataFrame) -> DataFrame:
    """Both methods in one table; columns of the other method are null."""
    return linear.unionByName(logistic, allowMissingColumns=True)


# Versions of a report that stay readable besides the current one.
KEPT_VERSIONS = 1
_VERSION = "number long, folder string, format string, at timestamp"


def _publish(spark: SparkSession, path: str, kind: str, write: Callable[[str], None]) -> None:
    """Write a new version of a report, then name it as the current one.

    The data of each version stand in a folder of their own. The last step, a one-row append to the list of versions, makes
    the new one count; whatever fails before it leaves the report as it was.
    """
    known = _versions(spark, path)
    last = known.agg(F.max("number")).first()[0] if known is not None else None
    folder = uuid.uuid4().hex
    write(f"{path}/data/{folder}")
    number = (last or 0) + 1
    row = spark.range(1).select(
        F.lit(number).cast("long").alias("number"), F.lit(folder).alias("folder"), F.lit(kind).alias("format"), F.current_timestamp().alias("at")
    )
    row.coalesce(1).write.mode("append").parquet(f"{path}/versions")


def _exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def _versions(spark: SparkSession, path: str) -> DataFrame | None:
    return spark.read.schema(_VERSION).parquet(f"{path}/versions") if _exists(spark, f"{path}/versions") else None


def current_folder(spark: SparkSession, path: str) -> str:
    """Where the current version of a report stands."""
    known = _versions(spark, path)
    row = known.orderBy(F.desc("number"), F.desc("at"), "folder").first() if known is not None else None
    if row is None:
        raise FileNotFoundError(f"no report in {path}")
    return f"{path}/data/{row['folder']}"


def forget_versions(spark: SparkSession, path: str, kept: int = KEPT_VERSIONS) -> None:
    """Free the data of all versions but the current one and ``kept`` before it, which readers may still hold."""
    known = _versions(spark, path)
    if known is not None:
        for row in known.orderBy(F.desc("number"), F.desc("at"), "folder").collect()[kept + 1 :]:
            place = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/data/{row['folder']}")
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def write_report(report: DataFrame, path: str) -> DataFrame:
    """Parquet, one folder per outcome, method and request; returns what was written, read back.

    A report that is there stays readable until the new one is complete. It is read with the report's own schema and column
    order, so a report without rows comes back too.
    """
    spark = report.sparkSession
    _publish(spark, path, "parquet", lambda folder: report.write.partitionBy("outcome", "method", "task_id").parquet(folder))
    return spark.read.schema(report.schema).parquet(current_folder(spark, path)).select(*report.columns)


def publish_text(report: DataFrame, path: str, null_value: str = "") -> None:
    """As ``export_report``, as a new version of the report in ``path``."""
    _publish(report.sparkSession, path, "text", lambda folder: export_report(report, folder, null_value))


def rewrite_with_gain(spark: SparkSession, path: str, method: str, null_value: str = "") -> None:
    """The current version of a text report of one method anew, with the gain of the score."""
    folder = current_folder(spark, path)
    _publish(spark, path, "text", lambda out: add_gain(spark, folder, out, method, null_value))


def export_report(report: DataFrame, path: str, null_value: str = "") -> None:
    """Tab-separated text with a column line, one folder per outcome, method and request."""
    (
        report.write.mode("overwrite")
        .partitionBy("outcome", "method", "task_id")
        .options(sep="\t", header=True, nullValue=null_value)
        .csv(path)
    )


def add_gain(spark: SparkSession, path: str, out: str, method: str, null_value: str = "") -> None:
    """A stored report of one method written anew, in the same layout, with the gain of the score."""
    metric = METRIC[method]
    stored = read_report(spark, path, method, null_value)
    export_report(incremental(stored.drop(f"INCREMENTAL_{metric}_PRS"), metric), out, null_value)


def read_report(spark: SparkSession, path: str, method: str, null_value: str = "None") -> DataFrame:
    """A stored report of one method; counts and numbers keep their types whatever the first rows hold."""
    raw = spark.read.options(sep="\t", header=True, enforceSchema=False).csv(path)

    def typed(name: str):
        value = F.col(name)
        present = F.when((value != null_value) & (value != ""), value)
        if name in _COUNTS:
            return present.cast("long").alias(name)
        if name in REPORT_COLUMNS[method] and name not in _TEXT or name.startswith("INCREMENTAL_"):
            return present.cast("double").alias(name)
        return present.alias(name)

    return raw.select(*(typed(c) for c in raw.columns))
