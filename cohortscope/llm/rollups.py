"""Token counts by source, language and tokenizer version, kept up to date by signed changes.

A store is a folder with two Parquet tables. ``deltas`` holds the additive change of each committed
batch per key; ``commits`` names, for each batch, the attempts that were written completely. A batch
counts once, by its first committed attempt, however often it is sent; files of attempts that broke off
are never read, because no commit names them.
"""

from __future__ import annotations

import base64
import uuid
from collections.abc import Iterator

import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortscope.llm.text import chunks
from cohortscope.plans.scratch import written
from cohortscope.plans.ship import ship

KEYS = ["source", "lang", "tokenizer"]
CHANGES = "op string, source string, lang string, tokenizer string, tokens long, old_tokens long"
_DELTAS = "source string, lang string, tokenizer string, docs long, tokens long, batch string, attempt string"
_COMMITS = "batch string, attempt string, at timestamp"

# Fixed value: how this byte-level vocabulary parts text before merging.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def create(spark: SparkSession, folder: str) -> None:
    """Make an empty store; one that is there stays as it is."""
    for name, schema in (("deltas", _DELTAS), ("commits", _COMMITS)):
        spark.createDataFrame([], schema).write.mode("ignore").parquet(f"{folder}/{name}")


def _commits(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(_COMMITS).parquet(f"{folder}/commits")


def signed(changes: DataFrame) -> DataFrame:
    """Additive change per key: inserts add, deletes take away, revisions add the difference.

    Null keys are keys of their own, null counts are 0. Any other op is an error.
    """
    new, old = (f"coalesce({c}, 0)" for c in ("tokens", "old_tokens"))
    known = "when 'insert' then {} when 'delete' then {} when 'revise' then {} "
    wrong = "else raise_error(concat('unknown op: ', coalesce(op, 'null'))) end"
    docs = "case op " + known.format("1L", "-1L", "0L") + wrong
    tokens = "case op " + known.format(new, f"-{new}", f"{new} - {old}") + wrong
    return changes.groupBy(*KEYS).agg(F.sum(F.expr(docs)).alias("docs"), F.sum(F.expr(tokens)).alias("tokens"))


def commit(spark: SparkSession, folder: str, batch: str, changes: DataFrame) -> bool:
    """Add a batch of changes; False, and nothing done, when the batch is committed already.

    ``changes`` has op (insert, delete, revise), the keys, tokens (of a delete: those taken away) and
    old_tokens (of a revision). The last step, a one-row append, makes the batch count; before it a
    failure leaves no trace in the totals and the batch can be sent again.
    """
    if not _commits(spark, folder).where(F.col("batch") == batch).isEmpty():
        return False
    attempt = uuid.uuid4().hex
    # One row for each key; written as columns, so that any text can name a batch.
    delta = signed(changes).withColumn("batch", F.lit(batch)).withColumn("attempt", F.lit(attempt))
    delta.coalesce(1).write.mode("append").parquet(f"{folder}/deltas")
    done = spark.range(1).select(F.lit(batch).alias("batch"), F.lit(attempt).alias("attempt"), F.current_timestamp().alias("at"))
    done.coalesce(1).write.mode("append").parquet(f"{folder}/commits")
    return True


def totals(spark: SparkSession, folder: str) -> DataFrame:
    """Totals of all committed batches: keys, docs, tokens; keys with neither are left out."""
    first = _commits(spark, folder).groupBy("batch").agg(F.expr("min(struct(at, attempt)).attempt as attempt"))
    deltas = spark.read.schema(_DELTAS).parquet(f"{folder}/deltas")
    summed = deltas.join(first, ["batch", "attempt"]).groupBy(*KEYS).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
    return summed.where("docs <> 0 or tokens <> 0")


def read_ranks(path: str) -> bytes:
    """A vocabulary file as it is (about a megabyte), to send to the tasks."""
    with open(path, "rb") as file:
        return file.read()


_encoders: dict[bytes, tiktoken.Encoding] = {}


def encoder(ranks: bytes) -> tiktoken.Encoding:
    if ranks not in _encoders:
        table = {base64.b64decode(a): int(b) for a, b in (line.split() for line in ranks.splitlines() if line)}
        _encoders[ranks] = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=table, special_tokens={})
    return _encoders[ranks]


def count_tokens(docs: DataFrame, ranks: bytes) -> DataFrame:
    """(doc_id, source, lang, n_bytes, tokens) of every row's whole text; a null text has 0 of both.

    Null sources and languages stay null, other columns are ignored, whatever their names.
    """
    ship(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(ranks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(sent.value).encode_ordinary
        for batch in chunks(batches):
            texts = [t or "" for t in batch.column(0).to_pylist()]
            columns = [
                *batch.columns[1:],
                pa.array([len(t.encode()) for t in texts], pa.int64()),
                pa.array([len(encode(t)) for t in texts], pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "source", "lang", "n_bytes", "tokens"])

    rows = docs.select(F.col("text").cast("string"), F.col("doc_id").cast("long"), F.col("source").cast("string"), F.col("lang").cast("string"))
    return rows.mapInArrow(run, "doc_id long, source string, lang string, n_bytes long, tokens long")


def digest(counted: DataFrame) -> str:
    """A name of a table's rows, whatever their order."""
    hashed = counted.select(F.xxhash64(*counted.columns).alias("h"), F.xxhash64(F.lit(7), *counted.columns).alias("g"))
    half = F.lit(1 << 31)
    parts = hashed.agg(
        F.count(F.lit(1)), F.bit_xor("h"), F.bit_xor("g"), F.sum(F.pmod("h", half)), F.sum(F.pmod("g", half))
    ).first()
    return "-".join(f"{(x or 0) & (1 << 64) - 1:x}" for x in parts)


def load(
    spark: SparkSession, folder: str, docs: DataFrame, ranks: bytes, version: str, name: str | None = None
) -> dict[str, bool]:
    """Bring documents into a store in three batches, as they become known; which of them were taken.

    They arrive with an estimate of a token for every four bytes, are revised to the exact counts, and
    those without any token are withdrawn. Batches are named by the version and ``name``; without one by the rows
    themselves (their ids, sources, languages and counts), so that further documents add to the totals, and the same ones, loaded
    again, do not. A batch whose name is in the store already is refused: its entry of the result is False. Null
    sources and languages are keys of their own, rows that repeat count as often as they stand, other columns
    of the documents are ignored, whatever their names, and an empty table gives batches without rows.
    """
    create(spark, folder)
    counted = written(count_tokens(docs, ranks).withColumn("tokenizer", F.lit(version)), "counted")
    name = digest(counted) if name is None else name
    guess = F.expr("cast(ceil(n_bytes / 4) as long)")
    none = F.lit(None).cast("long")

    def changes(rows: DataFrame, op: str, tokens, old) -> DataFrame:
        return rows.select(F.lit(op).alias("op"), *KEYS, tokens.alias("tokens"), old.alias("old_tokens"))

    batches = {
        "arrived": changes(counted, "insert", guess, none),
        "counted": changes(counted, "revise", F.col("tokens"), guess),
        "empty": changes(counted.where("tokens = 0"), "delete", F.col("tokens"), none),
    }
    return {step: commit(spark, folder, f"{version}/{name}/{step}", rows) for step, rows in batches.items()}
