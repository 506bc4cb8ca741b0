"""Context-triggered piecewise hashing: fingerprints that stay alike when part of a text changes.

A hash of the last seven bytes decides where a chunk ends, so chunk ends move with the text around
them. Each chunk gives one character; the mean chunk is as long as the block size, which follows from the
text's length. Signatures of equal or neighbouring block sizes are compared by edit distance.
"""

from __future__ import annotations

from collections.abc import Iterator

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortscope.llm.edit import distance
from cohortscope.llm.text import chunks, mix, range_hashes
from cohortscope.plans.ship import ship

WINDOW = 7
SMALLEST = 3
LENGTH = 64
COMMON = 5
# Text that one range of consecutive documents holds, about; more if there would be too many ranges.
RANGE_BYTES = 12 << 20
MOST_RANGES = 100_000
_LETTERS = np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", np.uint8)
_LAST = (1 << 63) - 1


def _rolling(data: np.ndarray) -> np.ndarray:
    """Hash of the last seven bytes at every byte."""
    out = np.zeros(len(data), np.uint64)
    factor = 1
    values = data.astype(np.uint64) + np.uint64(1)
    for k in range(min(WINDOW, len(data))):
        out[k:] += values[: len(data) - k] * np.uint64(factor)
        factor = factor * 0x100000001B3 % (1 << 64)
    return mix(out)


def _signature(data: np.ndarray, ends: np.ndarray) -> str:
    """One letter for each chunk; all that follows the last but one letter is one chunk."""
    ends = ends[: LENGTH - 1]
    if not len(ends) or ends[-1] != len(data):
        ends = np.append(ends, len(data))
    starts = np.append(0, ends[:-1])
    return _LETTERS[(range_hashes(data, starts, ends) & np.uint64(63)).astype(np.int64)].tobytes().decode()


def fingerprint(text: str | None) -> str:
    """``block:signature:signature of twice the block``; equal texts have equal fingerprints."""
    data = np.frombuffer((text or "").encode(), np.uint8)
    block = SMALLEST
    while block * LENGTH < len(data):
        block *= 2
    if not len(data):
        return f"{block}::"
    hashes = _rolling(data)
    at = np.flatnonzero(hashes % np.uint64(block) == block - 1)
    twice = at[hashes[at] % np.uint64(2 * block) == 2 * block - 1]
    return f"{block}:{_signature(data, at + 1)}:{_signature(data, twice + 1)}"


def _alike(a: str, b: str) -> float:
    """1 less the edit distance by length; 0 for longer signatures without a common run of letters."""
    if not a and not b:
        return 1.0
    if min(len(a), len(b)) >= 2 * COMMON:
        runs = {a[i : i + COMMON] for i in range(len(a) - COMMON + 1)}
        if not any(b[i : i + COMMON] in runs for i in range(len(b) - COMMON + 1)):
            return 0.0
    return 1.0 - distance(a, b) / max(len(a), len(b))


def likeness(one: str, other: str) -> float:
    """Likeness of two fingerprints, 0 to 1; 0 when their block sizes are further apart than twice."""
    if one == other:
        return 1.0
    (m, a, aa), (n, b, bb) = one.split(":"), other.split(":")
    m, n = int(m), int(n)
    if m == n:
        return max(_alike(a, b), _alike(aa, bb))
    if m == 2 * n:
        return _alike(a, bb)
    if n == 2 * m:
        return _alike(aa, b)
    return 0.0


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come range by range in order; the row after a range's last one is only looked at."""
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    held = None
    for batch in chunks(batches):
        out = []
        for doc, text, extra in zip(*(batch.column(i).to_pylist() for i in range(3))):
            text = text or ""
            own = fingerprint(text)
            if held is not None:
                last_doc, last, last_own = held
                part = len(last) // 4
                edited = last[: len(last) - part] + text[:part]
                changed = fingerprint(edited)
                digest = hashlib.sha256(edited.encode()).hexdigest()
                out.append((last_doc, len(last), digest, last_own, changed, likeness(last_own, changed), likeness(last_own, own)))
            held = None if extra else (doc, text, own)
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate(types)], names)


def compare_with_edited(docs: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Fingerprint of every document, of its edited text, and how alike they and the next one are.

    The edited text has its last quarter replaced by as much of the start of the next document in
    ascending doc_id (after the last comes the first; alone, a document is its own next). A null text
    counts as empty; null ids come last; rows that share an id follow each other by text. Documents are
    dealt into ranges of consecutive ids, and each range also gets the first document after it, so every
    task streams its rows once and holds two texts at a time.
    """
    spark = docs.sparkSession
    ship(spark)
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST))
    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), key.alias("key"))
    about = rows.agg(F.min("key").alias("first"), F.sum(F.octet_length("text")).alias("size"), F.count(F.lit(1)).alias("n")).first()
    if not about["n"]:
        return rows.select("doc_id", "text", F.lit(0).alias("extra")).mapInArrow(_compared, _SCHEMA)
    wanted = min(max(about["size"] // range_bytes, 2 * spark.sparkContext.defaultParallelism, 2), MOST_RANGES)
    shares = [i / wanted for i in range(1, wanted)]
    exact = max(10_000, 10 * wanted)
    cuts = rows.agg(F.percentile_approx("key", shares, exact).alias("cuts")).first()["cuts"]
    # Ranges begin at ids that are there, so a range's first document is known by its id.
    bounds = sorted({about["first"], *cuts})

    @F.pandas_udf("int")
    def number(keys: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(np.array(bounds), keys.to_numpy(), side="right") - 1)

    # A range's first documents are also sent to the range before it, the first one's to the last.
    before = F.pmod(number("key") - 1, F.lit(len(bounds)))
    dealt = rows.withColumn("range", number("key")).withColumn("extra", F.lit(0))
    # At most MOST_RANGES numbers.
    first = F.broadcast(spark.createDataFrame([(b,) for b in bounds], "key long"))
    heads = rows.join(first, "key", "left_semi").withColumn("range", before).withColumn("extra", F.lit(1))
    return (
        dealt.unionByName(heads)
        .repartitionById(len(bounds), F.col("range"))
        .sortWithinPartitions("range", "extra", "key", "text")
        .select("doc_id", "text", "extra")
        .mapInArrow(_compared, _SCHEMA)
    )


_SCHEMA = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)
