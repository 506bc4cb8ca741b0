"""What the score adds over the covariates, per cell."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortscope.config import BOTH, COVARIATES_ONLY

CELL_NAMES = ("STRATA_ONE", "GROUP_ONE", "STRATA_TWO", "GROUP_TWO")


def incremental(results: DataFrame, metric: str) -> DataFrame:
    """Metric of the full model minus that of the covariates, on every row of the cell.

    Null when either model is absent. A cell has three rows at most, so its window is small.
    """
    owner = [c for c in ("task_id", "PGS") if c in results.columns][:1]
    cell = Window.partitionBy(*owner, *CELL_NAMES)

    def of(formula: str):
        return F.max(F.when(F.col("COVARIATES") == formula, F.col(metric))).over(cell)

    return results.withColumn(f"INCREMENTAL_{metric}_PRS", of(BOTH) - of(COVARIATES_ONLY))
