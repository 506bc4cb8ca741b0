"""Near-duplicate documents by SimHash, found with multi-index hashing.

The 64 bits are cut into segments. When two fingerprints differ in at most ``radius`` bits, some
segment differs in at most ``radius // segments`` bits, so every fingerprint is stored under each of
its segments and probes the small Hamming ball around each of them; full distances are then verified.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortscope.llm.graph import components, near_links
from cohortscope.llm.text import chunks, majority
from cohortscope.plans.scratch import written
from cohortscope.plans.ship import ship

RADIUS = 3
SHINGLE = 3
SEGMENTS = 2
SEED = 42
# Fixed value: the id that stands for a missing doc_id, so that it sorts last.
_LAST = (1 << 63) - 1
_BLOCK = 50_000


def shingle_hashes(text: str | None, width: int = SHINGLE) -> np.ndarray:
    """XXH64 of the shingles of a text's words, A-Z in lower case (repeats included)."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    line = b" ".join(words)
    if len(words) <= width:
        return np.array([xxhash.xxh64_intdigest(line, SEED)], np.uint64)
    starts = np.zeros(len(words), np.int64)
    np.cumsum(np.fromiter(map(len, words[:-1]), np.int64, len(words) - 1) + 1, out=starts[1:])
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    stops = (starts + lengths)[width - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    count = len(stops)
    return np.fromiter((digest(line[a:b], SEED) for a, b in zip(starts.tolist(), stops)), np.uint64, count)


def fingerprints_of(texts: list[str | None], width: int = SHINGLE) -> np.ndarray:
    """SimHash of each text; 0 for a text without words."""
    out = np.zeros(len(texts), np.uint64)
    hashes, numbers, held = [], [], 0

    def flush() -> None:
        if hashes:
            starts = np.cumsum([0, *map(len, hashes[:-1])])
            out[numbers] = majority(np.concatenate(hashes), starts)

    for i, text in enumerate(texts):
        h = shingle_hashes(text, width)
        if len(h):
            hashes.append(h)
            numbers.append(i)
            held += len(h)
        if held > _BLOCK:
            flush()
            hashes, numbers, held = [], [], 0
    flush()
    return out


def _fingerprint_batches(width: int):
    """Texts give way to their fingerprints; the columns before them stay."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            fps = fingerprints_of(batch.column("text").to_pylist(), width)
            columns = [c for name, c in zip(batch.schema.names, batch.columns) if name != "text"]
            names = [name for name in batch.schema.names if name != "text"]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(fps.view(np.int64))], [*names, "fp"])

    return run


def fingerprints(docs: DataFrame, width: int = SHINGLE) -> DataFrame:
    """(doc_id, fp): the 64-bit SimHash of every whole text, as a signed number."""
    ship(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        _fingerprint_batches(width), "doc_id long, fp long"
    )


def _flips(width: int, radius: int) -> list[int]:
    return [sum(1 << b for b in bits) for k in range(radius + 1) for bits in combinations(range(width), k)]


def index_rows(fps: DataFrame, radius: int = RADIUS, segments: int = SEGMENTS) -> DataFrame:
    """A row for every point of the Hamming ball around each segment; ``own`` marks the segment itself."""
    width = -(-64 // segments)
    entries = []
    for s in range(segments):
        bits = min(width, 64 - s * width)
        mask = (1 << bits) - 1
        value = f"(shiftrightunsigned(fp, {s * width}) & {mask}L)"
        balls = ", ".join(f"{flip}L" for flip in _flips(bits, radius // segments))
        # The segment's number stands above its value, so that no two segments share a key.
        entries.append(
            f"transform(array({balls}), x -> named_struct('key', (({value}) ^ x) * {segments} + {s}, 'own', x = 0))"
        )
    return fps.select("fp", F.inline(F.expr(f"concat({', '.join(entries)})"))).select("key", "fp", "own")


def near_groups(docs: DataFrame, width: int = SHINGLE, radius: int = RADIUS, segments: int = SEGMENTS) -> DataFrame:
    """(doc_id, fp, component_id): documents linked, directly or over others, by near fingerprints.

    ``component_id`` is the smallest doc_id reachable over links of at most ``radius`` differing bits.
    Null and empty texts and texts of white space have fingerprint 0 and are linked like any other.
    Rows that share a doc_id are each given a row; one with a null doc_id belongs to the group its
    fingerprint is in, and the group has a null id when all its doc_ids are null. Empty tables give
    empty results; further columns are ignored. Copies meet as one fingerprint, counted before they
    are shuffled, so the size of a group of copies costs nothing further on.
    """
    if not 2 <= segments <= 4:
        raise ValueError("segments must be 2 to 4")
    marked = written(fingerprints(docs, width), "fingerprints")
    distinct = written(
        marked.groupBy("fp").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n")), "distinct"
    )
    links = near_links(index_rows(distinct, radius, segments), radius)
    roots = components(links)
    named = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
    # Only fingerprints of several documents or with a link need a lookup.
    grouped = named.where("n > 1 or root is not null").withColumn("root", F.expr("coalesce(root, fp)"))
    smallest = grouped.groupBy("root").agg(F.min("first").alias("component_id"))
    ids = grouped.join(smallest, "root").select("fp", "component_id", F.lit(True).alias("found"))
    return marked.join(ids, "fp", "left").select(
        "doc_id", "fp", F.expr("if(found, component_id, doc_id) as component_id")
    )


def keep_one(docs: DataFrame, width: int = SHINGLE, radius: int = RADIUS, segments: int = SEGMENTS) -> DataFrame:
    """The documents less all rows but one of each near-duplicate group.

    Groups are those of ``near_groups``, of rows: the one with the smallest doc_id stays (a null one comes last),
    of equal doc_ids the one with the smaller hash of its text, of rows that are alike in both any one. So rows that
    share a doc_id but not their texts are told apart, and rows without a doc_id are kept once like others. Further
    columns stay as they are, whatever their names; an empty table stays empty.
    """
    spark = docs.sparkSession
    ship(spark)
    doc = F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST)).alias("doc")
    row = F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("row")
    keyed = docs.select(doc, row, F.col("text").cast("string").alias("text"))
    marked = written(keyed.mapInArrow(_fingerprint_batches(width), "doc long, row long, fp long"), "fingerprints")
    distinct = written(
        marked.groupBy("fp").agg(F.min(F.struct("doc", "row")).alias("first"), F.count(F.lit(1)).alias("n")), "distinct"
    )
    roots = components(near_links(index_rows(distinct, radius, segments), radius))
    named = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.expr("coalesce(root, fp)"))
    # Of each group's rows only the least one stays, so what goes is named by its fingerprint's group.
    least = written(named.groupBy("root").agg(F.min("first").alias("kept"), F.sum("n").alias("rows")), "least")
    several = named.where("n > 1 or root <> fp").join(least, "root").select("fp", "kept")
    heads = least.where("rows > 1").select("root", "kept")
    several = written(several.union(heads.selectExpr("root as fp", "kept")).distinct(), "several")
    met = marked.join(several, "fp")
    gone = met.where("doc <> kept.doc or row <> kept.row").select("doc", "row").distinct()
    # Rows alike in both are all kept so far, if they are the least.
    alike = written(met.where("doc = kept.doc and row = kept.row").groupBy("doc", "row").count().where("count > 1").select("doc", "row"), "alike")
    packed = docs.select(doc, row, F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("it"))
    kept = packed.join(gone, ["doc", "row"], "left_anti")
    if not alike.isEmpty():
        once = kept.join(alike, ["doc", "row"], "left_semi").dropDuplicates(["doc", "row"])
        kept = kept.join(alike, ["doc", "row"], "left_anti").unionByName(once)
    return kept.select(*(F.col(f"it.`{c}`").alias(c) for c in docs.columns))
