"""The stages of the corpus pipeline, each on its own input against a slow version."""

import collections

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
import corpus_pipeline as pipeline
from cohortscope.llm import curriculum, spaced, toxicity
from cohortscope.plans.scratch import written
from llm import edge
from llm.test_dedup import slow_lines, slow_simhash

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """Input and output of each stage."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = {}
    for name, stage in pipeline.STAGES:
        done = written(stage(spark, docs, SF), name)
        out[name] = docs, done
        docs = done
    return out


def ids(df):
    return sorted(r.doc_id for r in df.select("doc_id").collect())


def test_stages_are_in_order_and_keep_the_columns(stages):
    assert [n for n, _ in pipeline.STAGES] == ["toxicity", "line_dedup", "simhash_near_dedup", "benchmark_decontamination", "source_mixing"]
    first = stages["toxicity"][0].dtypes
    for name, _ in pipeline.STAGES[:-1]:
        assert stages[name][1].dtypes == first


def test_toxic_documents_go(spark, stages):
    docs, done = stages["toxicity"]
    model = toxicity.fit(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    scores, _ = model.scores([r.text for r in docs.orderBy("doc_id").collect()])
    assert ids(done) == [i for i, s in zip(ids(docs), scores) if s < 0.5]


def test_repeated_lines_go_and_every_document_stays(stages):
    docs, done = stages["line_dedup"]
    rows = {r.doc_id: r for r in docs.select("doc_id", "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("h")).collect()}
    kept = {r.doc_id: r for r in done.collect()}
    assert sorted(kept) == ids(docs)
    equal, every = slow_lines(docs)
    found = 0
    for doc, r in rows.items():
        lines = r.text.split("\n")
        must, may = ({k for d, h, k in gone if (d, h) == (doc, r.h)} for gone in (equal, every))
        left = kept[doc].text
        assert kept[doc].n_chars == len(left)
        # What is left lies between the text without equal lines and that without all similar ones.
        most = collections.Counter(s for k, s in enumerate(lines) if k not in must)
        least = collections.Counter(s for k, s in enumerate(lines) if k not in may)
        have = collections.Counter(left.split("\n") if left or len(may) < len(lines) else [])
        assert least <= have <= most
        found += sum(most.values()) - sum(have.values())
    assert found >= 0.9 * (len(every) - len(equal))


def test_one_document_of_each_near_group_stays(stages):
    docs, done = stages["simhash_near_dedup"]
    rows = docs.orderBy("doc_id").collect()
    roots = edge.groups(len(rows), edge.near_pairs([slow_simhash(r.text, 3) for r in rows], 3))
    assert ids(done) == [r.doc_id for i, r in enumerate(rows) if roots[i] == i]


def test_contaminated_documents_go(spark, stages):
    docs, done = stages["benchmark_decontamination"]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    found = edge.leaks([(r.doc_id, r.text) for r in docs.collect()], items, spaced.MASKS, spaced.WINDOW, spaced.AGREEMENT)
    assert ids(done) == [i for i in ids(docs) if i not in {d for d, _ in found}]


def test_sources_are_mixed(stages):
    docs, done = stages["source_mixing"]
    taken = collections.Counter()
    for r in done.collect():
        taken[r.doc_id] += r.words
    assert taken == {r.doc_id: r.taken for r in curriculum.plan(docs).where("taken > 0").collect()}


def test_all_queries_are_registered():
    names = set(contract.queries())
    assert "pipeline" in names and {n.split("_")[0] for n in names if n.startswith("op")} == {f"op{i}" for i in range(1, 14)}
    assert set(contract.oracle_sql()) <= names


def test_stages_without_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in pipeline.STAGES:
        docs = written(stage(spark, docs, SF), "none")
        assert docs.count() == 0
