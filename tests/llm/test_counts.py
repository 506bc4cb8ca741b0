"""Curriculum, token rollups and licences against slow versions, and on awkward tables."""

import collections
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from cohortscope.llm import curriculum, licences, rollups
from cohortscope.llm.queries import TOKENIZER, VOCABULARY, op5_token_rollups
from llm import edge

SF = "/root/testdata/sf0.001"


def slow_targets(sizes, weights, most=3):
    """Shares by weight; what is above a cap is shared again until none is."""
    total = sum(sizes.values())
    targets = dict.fromkeys(sizes, 0.0)
    open_sources, left = set(sizes), float(total)
    while open_sources:
        share = left / sum(weights[s] for s in open_sources)
        over = {s for s in open_sources if share * weights[s] >= most * sizes[s]}
        if not over:
            for s in open_sources:
                targets[s] = share * weights[s]
            break
        for s in over:
            targets[s] = float(most * sizes[s])
            left -= targets[s]
        open_sources -= over
    return targets


def order_of(sources):
    return sorted(sources, key=lambda s: (s is None, (s or "").encode()))


def check_plan(docs, **options):
    rows = docs.select("doc_id", "text", "source").collect()
    size = [len(edge.WORD.findall(r.text or "")) for r in rows]
    sizes = collections.Counter()
    for r, n in zip(rows, size):
        sizes[r.source] += n
    weights = {s: 1 + i % 3 for i, s in enumerate(order_of(sizes))}
    targets = slow_targets(sizes, weights)
    want = collections.Counter()
    for source in sizes:
        mine = [(hashlib.md5(str(r.doc_id).encode()).hexdigest() if r.doc_id is not None else "z", r.doc_id or -1, n) for r, n in zip(rows, size) if r.source == source]
        budget, start = int(targets[source] + 1e-6), 0
        for _, doc, n in sorted(mine):
            times, rest = divmod(budget, sizes[source]) if sizes[source] else (0, 0)
            want[doc, n, source, times * n + max(0, min(n, rest - start))] += 1
            start += n
    got = curriculum.plan(docs, **options).collect()
    assert collections.Counter((r.doc_id or -1, r["size"], r.source, r.taken) for r in got) == want
    for r in got:
        assert r.target == pytest.approx(targets[r.source]) and r.taken <= 3 * r["size"] and r.source_size == sizes[r.source]
        assert (r.position is None) == (r.taken == 0) and (r.position is None or 0 <= r.position <= sum(size))


@pytest.mark.parametrize("per_range", [2, 20_000])
def test_plan_of_documents(spark, per_range):
    check_plan(spark.read.parquet(f"{SF}/documents.parquet"), per_range=per_range)


def test_plan_of_awkward_rows(spark):
    check_plan(edge.table(spark))
    assert curriculum.plan(edge.empty(spark)).count() == 0
    assert curriculum.training_order(edge.empty(spark)).count() == 0
    blank = edge.table(spark, [(1, None, None, None, 0), (2, "", None, "a", 0)])
    assert [(r.taken, r.target) for r in curriculum.plan(blank).collect()] == [(0, 0.0), (0, 0.0)]


def test_schedule_is_integrated_and_inverted(spark):
    """Positions of a piecewise linear schedule against small steps of its integral."""
    words = [(i, " ".join(["w"] * 20), None, s, 0) for i, s in enumerate("ab" * 40)]
    knots = {"a": [(0.0, 1.0), (0.25, 5.0), (0.5, 0.0), (1.0, 2.0)], "b": [(0.0, 3.0), (1.0, 3.0)]}
    schedules = spark.createDataFrame(list(knots.items()), "source string, knots array<struct<t: double, w: double>>")
    got = curriculum.plan(edge.table(spark, words), schedules).collect()
    areas = {s: sum((w + v) / 2 * (u - t) for (t, w), (u, v) in zip(k, k[1:])) for s, k in knots.items()}
    assert {r.source: r.target for r in got} == pytest.approx({s: 1600 * areas[s] / sum(areas.values()) for s in areas})
    steps = 20_000
    for r in got:
        if r.position is None:
            continue
        asked, total = areas[r.source] * r.start / r.target, 0.0
        for i in range(steps):
            t = (i + 0.5) / steps
            (t0, w0), (t1, w1) = next(p for p in zip(knots[r.source], knots[r.source][1:]) if p[0][0] <= t <= p[1][0])
            if total >= asked:
                break
            total += (w0 + (w1 - w0) * (t - t0) / (t1 - t0)) / steps
        assert r.position == pytest.approx(1600 * i / steps, abs=1.5)


def test_training_order(spark):
    docs = edge.table(spark)
    got = curriculum.training_order(docs)
    assert got.columns == [*(c for c in docs.columns if c != "words"), "copy", "words", "position"]
    rows = got.collect()
    assert [r.position for r in rows] == sorted(r.position for r in rows)
    plan, taken = curriculum.plan(docs).collect(), collections.Counter()
    size = lambda r: len(edge.WORD.findall(r.text or ""))
    for r in rows:
        taken[r.doc_id, r.source, size(r)] += r.words
    want = collections.Counter()
    for r in plan:
        want[r.doc_id, r.source, r["size"]] += r.taken
    assert taken == +want
    assert collections.Counter((r.doc_id, r.source, size(r), r.position) for r in rows if r.copy == 1) == collections.Counter(
        (r.doc_id, r.source, r["size"], r.position) for r in plan if r.taken
    )


def test_rows_without_an_id_and_rows_alike_have_their_own_passes(spark):
    texts = [f"one{i} two three" for i in range(30)]
    data = [(None, t, None, "a", 0) for t in texts] + [(7, t, None, "a", 0) for t in texts[:4]] + [(8, "x y", None, "a", 0)] * 5
    data += [(9, " ".join(["w"] * 40), None, "b", 0)]
    got = curriculum.training_order(edge.table(spark, data)).collect()
    plan = curriculum.plan(edge.table(spark, data), per_range=2).collect()
    taken, times = collections.Counter(), collections.Counter()
    for r in got:
        taken[r.doc_id, r.text] += r.words
        times[r.doc_id, r.text] += r.copy == 1
    for r in plan:
        assert r.taken <= 3 * r["size"]
    assert sum(taken.values()) == sum(r.taken for r in plan) == sum(int(t) for t in {r.source: r.target for r in plan}.values())
    # Rows of equal size and id have passes by their texts.
    assert all(taken[key] <= 9 for key in taken if key[0] in (None, 7)) and times[8, "x y"] == sum(r.taken > 0 for r in plan if r.doc_id == 8)


def changes(spark, rows):
    return spark.createDataFrame(rows, rollups.CHANGES)


def test_rollups_follow_signed_changes(spark, tmp_path):
    rng = random.Random(1)
    folder, want = str(tmp_path), collections.Counter()
    rollups.create(spark, folder)
    live = []
    for batch in range(3):
        rows = []
        for _ in range(20):
            op = rng.choice(["insert", "insert", "delete", "revise"]) if live else "insert"
            if op == "insert":
                row = (rng.choice(["a", None]), rng.choice(["en", "de"]), "v1", rng.randint(0, 9))
                live.append(row)
                rows.append((op, *row, None))
                want[row[:3], "docs"] += 1
                want[row[:3], "tokens"] += row[3]
            else:
                row = live.pop(rng.randrange(len(live)))
                if op == "delete":
                    rows.append((op, *row, None))
                    want[row[:3], "docs"] -= 1
                    want[row[:3], "tokens"] -= row[3]
                else:
                    new = rng.randint(0, 9)
                    live.append((*row[:3], new))
                    rows.append((op, *row[:3], new, row[3]))
                    want[row[:3], "tokens"] += new - row[3]
        assert rollups.commit(spark, folder, f"batch {batch}", changes(spark, rows))
        assert not rollups.commit(spark, folder, f"batch {batch}", changes(spark, rows))
    got = {}
    for r in rollups.totals(spark, folder).collect():
        got[(r.source, r.lang, r.tokenizer), "docs"] = r.docs
        got[(r.source, r.lang, r.tokenizer), "tokens"] = r.tokens
    assert {k: v for k, v in got.items() if v} == {k: v for k, v in want.items() if v}


def test_rollups_ignore_attempts_that_broke_off_and_second_commits(spark, tmp_path):
    folder = str(tmp_path)
    rollups.create(spark, folder)
    rollups.create(spark, folder)
    rollups.commit(spark, folder, "one", changes(spark, [("insert", "a", "en", "v", 5, None)]))
    lost = rollups.signed(changes(spark, [("insert", "a", "en", "v", 7, None)]))
    lost.withColumn("batch", F.lit("two")).withColumn("attempt", F.lit("x")).write.mode("append").parquet(f"{folder}/deltas")
    twice = lost.withColumn("batch", F.lit("one")).withColumn("attempt", F.lit("y"))
    twice.write.mode("append").parquet(f"{folder}/deltas")
    late = spark.range(1).select(F.lit("one").alias("batch"), F.lit("y").alias("attempt"), F.expr("current_timestamp() + interval 1 day").alias("at"))
    late.write.mode("append").parquet(f"{folder}/commits")
    assert [tuple(r) for r in rollups.totals(spark, folder).collect()] == [("a", "en", "v", 1, 5)]
    with pytest.raises(Exception, match="unknown op"):
        rollups.commit(spark, folder, "bad", changes(spark, [("upsert", "a", "en", "v", 5, None)]))


def test_token_totals_of_documents(spark):
    encode = rollups.encoder(rollups.read_ranks(VOCABULARY)).encode_ordinary
    want = collections.Counter()
    for r in spark.read.parquet(f"{SF}/documents.parquet").collect():
        want[r.source, r.lang, TOKENIZER] += len(encode(r.text or ""))
    got = op5_token_rollups(spark, SF).collect()
    assert {(r.source, r.lang, r.tokenizer): r.tokens for r in got} == {k: v for k, v in want.items() if v}


def test_token_totals_of_awkward_rows(spark, tmp_path):
    ranks = rollups.read_ranks(VOCABULARY)
    encode = rollups.encoder(ranks).encode_ordinary
    folder = str(tmp_path)
    rollups.load(spark, folder, edge.table(spark), ranks, "v")
    rollups.load(spark, folder, edge.table(spark), ranks, "v")
    tokens, docs = collections.Counter(), collections.Counter()
    for _, text, lang, source, _ in edge.rows():
        if n := len(encode(text or "")):
            tokens[source, lang] += n
            docs[source, lang] += 1
    got = rollups.totals(spark, folder).collect()
    assert {(r.source, r.lang): (r.docs, r.tokens) for r in got} == {k: (docs[k], tokens[k]) for k in tokens}
    assert all(rollups.load(spark, str(tmp_path / "none"), edge.empty(spark), ranks, "v").values())
    assert rollups.totals(spark, str(tmp_path / "none")).count() == 0


def test_tables_of_one_version_add_up_and_one_loaded_again_does_not(spark, tmp_path):
    ranks = rollups.read_ranks(VOCABULARY)
    folder, count = str(tmp_path), len(rollups.encoder(ranks).encode_ordinary("some words"))
    one = edge.table(spark, [(1, "some words", "en", "a", 0)])
    other = edge.table(spark, [(2, "some words", "en", "a", 0)])
    assert all(rollups.load(spark, folder, one, ranks, "v").values())
    assert all(rollups.load(spark, folder, other, ranks, "v").values())
    assert not any(rollups.load(spark, folder, one.repartition(2), ranks, "v").values())
    assert all(rollups.load(spark, folder, one, ranks, "v", "again on purpose").values())
    assert [(r.docs, r.tokens) for r in rollups.totals(spark, folder).collect()] == [(3, 3 * count)]


def test_licences_of_awkward_rows(spark):
    mit = ["mit-grant", "mit-keep", "as-is"]
    full = ". ".join(licences.SENTENCES[s][0].upper() for s in mit) + "."
    data = [
        (1, "Intro.\nReleased under the MIT License.\nMore.", None, None, 0),
        (1, "Intro.\nReleased under the MIT License.\nMore.", None, None, 0),
        (2, full, None, None, 0),
        (3, ". ".join(licences.SENTENCES[s][0] for s in mit[::-1]), None, None, 0),
        (4, (full + "\n") * 2 + "x. " * 40 + "Licensed under the Apache License, Version 2.0.", None, None, 0),
        (None, "This work is licensed under CC BY 4.0.", None, None, 0),
        (5, None, None, None, 0),
        (6, "", None, None, 0),
        (7, licences.SENTENCES["mit-grant"][0] + "\n" + "filler.\n" * 9 + "\n".join(licences.SENTENCES[s][0] for s in mit[1:]), None, None, 0),
    ]
    got = licences.licences(edge.table(spark, data)).collect()
    rows = collections.Counter((r.doc_id, r.rule, r.first_sentence, r.last_sentence) for r in got)
    assert rows == {
        (1, "mit-notice", 1, 1): 1, (2, "mit-text", 0, 2): 1, (4, "mit-text", 0, 2): 1, (4, "mit-text", 3, 5): 1,
        (4, "apache-2-notice", 46, 46): 1, (None, "cc-by-notice", 0, 0): 1,
    }
    assert licences.licences(edge.empty(spark)).count() == 0
