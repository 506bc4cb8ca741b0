"""Raw weight files written from the part table, for the queries that scan files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortscope.plans.scratch import scratch_path
from workload import fixtures

PER_FILE = 50_000
# Columns of the two layouts, in file order.
LAYOUTS = {
    "PGS900001": ("chr_name", "hm_inferOtherAllele", "effect_allele", "other_allele", "effect_weight", "hm_chr", "hm_pos"),
    "PGS900002": ("effect_weight", "chr_name", "effect_allele", "hm_chr", "hm_pos", "hm_inferOtherAllele"),
}


def raw_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.run(spark, sf_dir, fixtures.WEIGHTS)


def write_raw_files(spark: SparkSession, sf_dir: str) -> str:
    """Gzipped files of at most PER_FILE weights, each with its own header and column line."""
    raw = raw_weights(spark, sf_dir).withColumns(
        {
            # The first layout has both columns, and the inferred one is wrong there.
            "hm_inferOtherAllele": F.when(F.col("pgs") == "PGS900001", "N").otherwise(F.col("other_allele")),
            "chunk": F.floor(F.col("p_partkey") / PER_FILE).cast("int"),
        }
    )
    path = scratch_path(spark, "raw-weights")
    line = F.lit(None).cast("string")
    head = F.lit(None).cast("string")
    for pgs, columns in LAYOUTS.items():
        mine = F.col("pgs") == pgs
        fields = F.concat_ws("\t", *(F.coalesce(c, F.lit("")) for c in columns))
        line = F.when(mine, fields).otherwise(line)
        head = F.when(mine, F.lit("\t".join(columns))).otherwise(head)
    top = F.posexplode(
        F.array(
            F.lit("###PGS CATALOG SCORING FILE"),
            F.when(F.col("pgs") == "PGS900001", "#format_version=2.0").otherwise("#format_version=10.1"),
            F.concat(F.lit("#pgs_id="), "pgs"),
            F.lit("#note=a version\twith a tab"),
            F.lit("###SOURCE INFORMATION"),
            F.lit("##weight_type=beta = log(OR)"),
            head,
        )
    ).alias("place", "line")
    tops = raw.select("pgs", "chunk").distinct().select("pgs", "chunk", top)
    body = raw.select("pgs", "chunk", (F.col("p_partkey") + 10).alias("place"), line.alias("line"))
    (
        tops.unionByName(body)
        .repartition("pgs", "chunk")
        .sortWithinPartitions("pgs", "chunk", "place")
        .select("pgs", "chunk", "line")
        .write.partitionBy("pgs", "chunk")
        .option("compression", "gzip")
        .text(path)
    )
    return path
