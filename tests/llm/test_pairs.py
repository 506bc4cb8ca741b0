"""Edit distance, piecewise fingerprints and spaced seeds against slow versions, and on awkward tables."""

import hashlib
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cohortscope.llm import edit, piecewise, spaced
from llm import edge

SF = "/root/testdata/sf0.001"
TEXT = st.text(alphabet="ab c", max_size=40)


@settings(max_examples=200, deadline=None)
@given(TEXT, TEXT, st.integers(0, 20))
def test_edit_distance(a, b, most):
    want = edge.edits(a, b)
    assert edit.distance(a, b) == want
    assert edit.within(a, b, most) == (want <= most)


def test_edit_distance_of_near_texts():
    a = " ".join(f"word{i}" for i in range(200))
    assert edit.within(a, a.replace("word7", "other"), 60)
    assert not edit.within(a, a[::-1], 100)


def check_piecewise(docs, **options):
    def key(row):
        return (2**63 - 1 if row.doc_id is None else row.doc_id, row.text or "")

    rows = sorted(docs.collect(), key=key)
    want = []
    for i, row in enumerate(rows):
        text, after = row.text or "", rows[(i + 1) % len(rows)].text or ""
        part = len(text) // 4
        changed = text[: len(text) - part] + after[:part]
        prints = [piecewise.fingerprint(t) for t in (text, changed, after)]
        want.append(
            (row.doc_id or -1, len(text), hashlib.sha256(changed.encode()).hexdigest(), prints[0], prints[1],
             piecewise.likeness(prints[0], prints[1]), piecewise.likeness(prints[0], prints[2]))
        )
    got = [(r[0] or -1, *r[1:]) for r in piecewise.compare_with_edited(docs, **options).collect()]
    assert sorted(got) == sorted(want)
    return got


@pytest.mark.parametrize("size", [20_000, 1 << 30])
def test_piecewise_of_documents_in_any_number_of_ranges(spark, size):
    got = check_piecewise(spark.read.parquet(f"{SF}/documents.parquet"), range_bytes=size)
    assert sum(r[5] for r in got) / len(got) > 0.6
    assert sum(r[6] for r in got) / len(got) < 0.1


def test_piecewise_of_awkward_rows(spark):
    check_piecewise(edge.table(spark))
    check_piecewise(edge.table(spark, edge.rows()[:1]))
    assert piecewise.compare_with_edited(edge.empty(spark)).count() == 0


def test_likeness_bounds():
    long = edge.sentence(__import__("random").Random(2), 500)
    one = piecewise.fingerprint(long)
    assert piecewise.likeness(one, one) == 1.0 == piecewise.likeness(piecewise.fingerprint(None), piecewise.fingerprint(""))
    assert 0.5 < piecewise.likeness(one, piecewise.fingerprint("new start " + long)) <= 1
    assert piecewise.likeness(one, piecewise.fingerprint(long[:100])) == 0.0


def found(docs, items, **options):
    return {(r.doc_id, r.item_id) for r in spaced.contaminated(docs, items, **options).collect()}


@pytest.mark.parametrize("broadcast", [0, 500_000])
def test_leaks_of_documents(spark, broadcast):
    docs, items = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "benchmark"))
    want = edge.leaks(
        [(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()],
        spaced.MASKS, spaced.WINDOW, spaced.AGREEMENT,
    )
    assert found(docs, items, broadcast_seeds=broadcast) == want
    assert want


def test_leaks_of_awkward_rows(spark):
    data = edge.rows()
    docs = edge.table(spark)
    passage = data[0][1].split()
    changed = [w if i % 6 else "other" for i, w in enumerate(passage)]
    items = [(1, " ".join(passage[5:30])), (2, " ".join(passage[5:30])), (3, None), (4, ""), (5, "too short"), (None, data[7][1]),
             (6, " ".join(changed[:36])), (7, " ".join(data[3:4][0][1] or []))]
    bench = spark.createDataFrame([(i, t, 1, "x") for i, t in items], "item_id long, text string, row long, words string")
    got = {(r.doc_id, r.item_id): r for r in spaced.contaminated(docs, bench).collect()}
    assert {d for d, i in got if i == 1} == {1, 2, 3, 13} & {d for d, i in got if i == 1} | {1, 2, 3}
    assert not {i for _, i in got} & {2, 3, 4, 5, 7}
    assert {d for d, i in got if i == 6} >= {1, 2, 3}
    assert (got[1, 1].matched, got[1, 1].overlap, got[1, 1].doc_start) == (25, 25, 5)
    assert spaced.contaminated(edge.empty(spark), bench).count() == 0
    assert spaced.contaminated(docs, bench.limit(0)).count() == 0
    kept = spaced.decontaminate(docs, bench)
    assert kept.columns == docs.columns
    # A row without an id goes for its passage like others; one that shares an id with it stays.
    holds = {r.doc_id for r in spaced.contaminated(docs.where("doc_id is not null"), bench).collect()}
    alone = {r[1] for r in data if r[0] is None and spaced.contaminated(edge.table(spark, [(1, *r[1:])]), bench).count()}
    left = [(r[0], r[1]) for r in data if (r[0] not in holds if r[0] is not None else r[1] not in alone)]
    assert sorted(map(str, left)) == sorted(str((r.doc_id, r.text)) for r in kept.collect())


def test_rows_of_one_id_are_told_apart(spark):
    rng = random.Random(5)
    passage, clean = edge.sentence(rng, 40), edge.sentence(rng, 40)
    rows = [(4, passage), (4, clean), (None, "so " + passage), (None, clean)]
    docs = edge.table(spark, [(d, t, None, None, 0) for d, t in rows])
    bench = spark.createDataFrame([(1, passage)], "item_id long, text string")
    kept = spaced.decontaminate(docs, bench).collect()
    assert [(r.doc_id, r.text) for r in kept] == [(4, clean), (None, clean)] or [(r.doc_id, r.text) for r in kept] == [(None, clean), (4, clean)]


def test_masks_must_be_equally_long(spark):
    with pytest.raises(ValueError):
        spaced.contaminated(edge.empty(spark), edge.empty(spark), masks=("11", "101"))
