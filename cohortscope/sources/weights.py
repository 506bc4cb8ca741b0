"""Published weight files: scan by column name, header metadata, normalised columns, sinks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cohortscope.plans.scratch import written

# Columns of a normalised weight row.
WEIGHT_COLUMNS = ("hm_chr", "hm_pos", "effect_allele", "other_allele", "effect_weight")
# The harmonised position is used, but the author's chromosome.
_SOURCE = {
    "hm_chr": "chr_name",
    "hm_pos": "hm_pos",
    "effect_allele": "effect_allele",
    "effect_weight": "effect_weight",
}
_OTHER, _INFERRED = "other_allele", "hm_inferOtherAllele"
# Column lines are broadcast for up to this many files.
BROADCAST_FILES = 100_000
PGS_PATTERN = r"(PGS\d+)"


def _lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Every line with its file and its place in the file. Gzip files are read one task per file."""
    return spark.read.text(paths).select(
        F.col("_metadata.file_path").alias("file"),
        F.struct(
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("row"),
        ).alias("place"),
        F.col("value").alias("line"),
    )


def _pgs(pattern: str) -> Column:
    """The score a file belongs to: from the file's own name, or from a partition folder of it."""
    name = F.regexp_extract(F.element_at(F.split("file", "/"), -1), pattern, 1)
    folder = F.regexp_extract("file", r"/(?:pgs=|weight_file=)" + pattern + r"[^/]*/", 1)
    nothing = F.raise_error(F.concat(F.lit("no score id in the file's name: "), "file"))
    return F.when(name != "", name).when(folder != "", folder).otherwise(nothing.cast("string")).alias("pgs")


def read_weight_headers(
    spark: SparkSession, paths: str | list[str], pgs_pattern: str = PGS_PATTERN
) -> DataFrame:
    """The lines that start with ``#``: file, pgs, line_no, key, value (both null for a line without ``=``), and the line itself."""
    pair = r"^#+([^=]+)=(.*)$"
    order = Window.partitionBy("file").orderBy("place")
    return (
        _lines(spark, paths)
        .where(F.col("line").startswith("#"))
        .select(
            "file",
            _pgs(pgs_pattern),
            F.row_number().over(order).alias("line_no"),
            F.when(F.col("line").rlike(pair), F.regexp_extract("line", pair, 1)).alias("key"),
            F.when(F.col("line").rlike(pair), F.regexp_extract("line", pair, 2)).alias("value"),
            "line",
        )
    )


def header_summary(headers: DataFrame) -> DataFrame:
    """Format version and number of header lines per file."""
    version = F.when(F.col("key") == "format_version", F.regexp_extract("value", r"^(\d+)", 1))
    return headers.groupBy("file", "pgs").agg(
        F.max(version).alias("version"), F.count(F.lit(1)).alias("header_lines")
    )


def read_weights(
    spark: SparkSession, paths: str | list[str], pgs_pattern: str = PGS_PATTERN
) -> DataFrame:
    """Normalised weights of many files, all text, in one scan.

    Files differ in columns and column order, so each file's own column line (the first that does not
    start with ``#``) says where a field is. ``other_allele`` is taken from the inferred column when
    the file, not the row, lacks it.
    """
    body = _lines(spark, paths).where(~F.col("line").startswith("#"))
    # Only lines that name the weight column are compared, so that no other line is shuffled.
    named = body.where(F.array_contains(F.split("line", "\t"), _SOURCE["effect_weight"]))
    layout = named.groupBy("file").agg(F.min_by("line", "place").alias("columns"))
    names = F.split("columns", "\t")
    lacking = F.array_except(F.array(*(F.lit(c) for c in _SOURCE.values())), names)
    neither = ~F.array_contains(names, _OTHER) & ~F.array_contains(names, _INFERRED)

    def place(name: str) -> Column:
        return (F.array_position(names, name) - 1).cast("int")

    layout = layout.select(
        "file",
        "columns",
        *(place(source).alias(f"at_{c}") for c, source in _SOURCE.items()),
        F.when(F.array_contains(names, _OTHER), place(_OTHER))
        .otherwise(place(_INFERRED))
        .alias(f"at_{_OTHER}"),
        F.when(
            (F.size(lacking) > 0) | neither,
            F.raise_error(F.concat(F.lit("weight file without the needed columns: "), "file")).cast("boolean"),
        )
        .otherwise(F.lit(True))
        .alias("complete"),
    )
    layout = written(layout, "layouts")
    layout = F.broadcast(layout) if layout.count() <= BROADCAST_FILES else layout
    # The column line has no fields, so that a later cast never meets a column name.
    fields = F.when(~F.col("line").eqNullSafe(F.col("columns")), F.split("line", "\t", -1))
    without = F.raise_error(F.concat(F.lit("weight file without the needed columns: "), "file")).cast("string")
    return (
        body.join(layout, "file", "left")
        .where(~F.col("line").eqNullSafe(F.col("columns")))
        .select(
            F.when(F.col("columns").isNull(), without).otherwise(_pgs(pgs_pattern)).alias("pgs"),
            *(F.nullif(F.get(fields, F.col(f"at_{c}")), F.lit("")).alias(c) for c in WEIGHT_COLUMNS),
        )
    )


def normalize_weights(raw: DataFrame) -> DataFrame:
    """The same normalisation for a raw table that is already a DataFrame of one layout."""
    other = _OTHER if _OTHER in raw.columns else _INFERRED
    keep = ["pgs"] if "pgs" in raw.columns else []
    return raw.select(
        *keep,
        *(
            F.col(other if c == _OTHER else _SOURCE[c]).cast("string").alias(c)
            for c in WEIGHT_COLUMNS
        ),
    )


def weight_file_name(pgs: Column) -> Column:
    """The name under which the task map looks for a score's normalised weights."""
    return F.concat(pgs, F.lit("_formatted_hmPOS_GRCh38.txt.gz"))


def export_weight_files(weights: DataFrame, headers: DataFrame, path: str) -> None:
    """Normalised weights as gzipped text: the header lines as they were, the column line, the rows.

    A folder per score bears the name of its file. Header lines come from the score's first raw file. A
    gzip file is one sequence, so each score is written by one task; its rows are sorted by place only.
    """
    first = headers.groupBy("pgs").agg(F.min("file").alias("file"))
    tops = headers.join(first, ["pgs", "file"]).select("pgs", F.col("line_no").cast("long").alias("place"), "line")
    column_line = weights.select("pgs").distinct().select(
        "pgs", F.lit(1 << 40).alias("place"), F.lit("\t".join(WEIGHT_COLUMNS)).alias("line")
    )
    fields = F.concat_ws("\t", *(F.coalesce(c, F.lit("None")) for c in WEIGHT_COLUMNS))
    body = weights.select("pgs", F.lit((1 << 40) + 1).alias("place"), fields.alias("line"))
    (
        tops.unionByName(column_line)
        .unionByName(body)
        .withColumn("weight_file", weight_file_name(F.col("pgs")))
        .repartition("weight_file")
        .sortWithinPartitions("weight_file", "place")
        .select("weight_file", "line")
        .write.mode("overwrite")
        .partitionBy("weight_file")
        .option("compression", "gzip")
        .text(path)
    )


def read_normalized(spark: SparkSession, path: str) -> DataFrame:
    """Normalised weight files as they were exported."""
    lines = spark.read.text(path).where(~F.col("value").startswith("#"))
    lines = lines.where(F.col("value") != "\t".join(WEIGHT_COLUMNS))
    fields = F.split("value", "\t", -1)
    return lines.select(
        F.regexp_extract("weight_file", PGS_PATTERN, 1).alias("pgs"),
        *(F.nullif(fields[i], F.lit("None")).alias(c) for i, c in enumerate(WEIGHT_COLUMNS)),
    )


def write_weights(weights: DataFrame, path: str) -> None:
    weights.write.mode("overwrite").partitionBy("pgs").parquet(path)


def export_weights(weights: DataFrame, path: str) -> None:
    """Tab-separated, gzipped, one folder per score; a missing value is written as ``None``."""
    (
        weights.write.mode("overwrite")
        .partitionBy("pgs")
        .options(sep="\t", header=True, compression="gzip", nullValue="None")
        .csv(path)
    )
