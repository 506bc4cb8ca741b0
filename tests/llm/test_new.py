"""Centroid clustering, phrase collocations and chat formatting against slow versions, and on awkward tables."""

import collections
import hashlib
import itertools
import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cohortscope.llm import centroids, chat, collocations
from cohortscope.llm.queries import HOSTILE
from cohortscope.llm.trie import build
from llm import edge

SF = "/root/testdata/sf0.001"
VECTORS = "vec_id long, embedding array<float>, label int, vector string, cluster int, distance string, bound int"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 0, "v", 1, "d", 2) for i, v in rows], VECTORS).repartition(3)


def slow_clusters(data, clusters=16, rounds=3):
    """data: (vec_id, whole components); cluster and squared distance of each, and the centroids."""
    key = lambda r: (hashlib.sha256(f"1:{'null' if r[0] is None else r[0]}".encode()).hexdigest(), r[1])
    centres = [list(r[1]) for r in sorted(data, key=key)[:clusters]]

    def assign():
        out = []
        for _, v in data:
            away = [sum((x - y) ** 2 for x, y in zip(v, c)) for c in centres]
            out.append((away.index(min(away)), min(away)))
        return out

    for _ in range(rounds):
        found = assign()
        for c in range(len(centres)):
            mine = [v for (_, v), (k, _) in zip(data, found) if k == c]
            if mine:
                centres[c] = [sum(x) // len(mine) for x in zip(*mine)]
    return assign(), centres


def check_clusters(table, size=64):
    data = [(r.vec_id, [math.floor(64 * float(x)) for x in r.embedding]) for r in table.collect()
            if r.embedding is not None and len(r.embedding) == size and all(x is not None and math.isfinite(x) for x in r.embedding)]
    found, centres = slow_clusters(data)
    done = centroids.cluster(centroids.whole_vectors(table, size))
    got = collections.Counter((r.vec_id, tuple(r.vector), r.cluster, r.distance) for r in done.vectors.collect())
    assert got == collections.Counter((i, tuple(v), c, d) for (i, v), (c, d) in zip(data, found))
    assert done.centroids.tolist() == centres
    sums = collections.Counter()
    for c, d in found:
        sums[c] += d
    shas = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    want = collections.Counter((i, c, d, sums[c], sum(sums.values()), shas[c]) for (i, _), (c, d) in zip(data, found))
    assert collections.Counter(map(tuple, centroids.digest(done).collect())) == want
    return done


def test_clusters_of_embeddings(spark):
    done = check_clusters(spark.read.parquet(f"{SF}/embeddings.parquet"))
    # The bounds spare exact scans of some vectors in later rounds.
    assert done.scanned[0] == 500 and sum(done.scanned[1:]) < 3 * 500


def test_clusters_of_awkward_vectors(spark):
    rng = random.Random(2)
    near = [[rng.gauss(c, 0.02) for _ in range(4)] for c in range(12) for _ in range(9)]
    rows = list(enumerate(near))
    rows += [(1, near[1]), (1, near[1]), (1, near[2]), (None, near[3]), (None, near[3])]
    rows += [(500 + i, [0.5, -0.25, 0.0, 1.0]) for i in range(40)]
    rows += [(900, None), (901, []), (902, [1.0] * 3), (903, [1.0] * 5), (904, [1.0, None, 1.0, 1.0])]
    rows += [(905, [1.0, float("nan"), 1.0, 1.0]), (906, [1.0, 1.0, float("inf"), 1.0]), (907, [-1e6, 1e6, 0.0, 0.0])]
    check_clusters(vectors(spark, rows), size=4)
    few = [(i, [float(i), 0.0, 0.0, 0.0]) for i in range(5)]
    check_clusters(vectors(spark, few), size=4)
    assert centroids.digest(centroids.cluster(centroids.whole_vectors(vectors(spark, few)))).count() == 0
    with pytest.raises(Exception, match="no distance in 64 bits"):
        centroids.whole_vectors(vectors(spark, [(1, [3e7, 0.0, 0.0, 0.0])]), 4).collect()


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 2**32), st.integers(2, 5))
def test_drift_bound_holds_and_is_below_the_full_drift(seed, size):
    rng = np.random.default_rng(seed)
    old = rng.normal(size=(5, size)) * 5
    new = old + rng.normal(size=old.shape) * rng.uniform(0, 3)
    new[3] = old[3]
    radius = rng.uniform(0, 3, 5)
    falls = centroids.drift_bounds(old, new, radius)
    drift = np.sqrt(((new - old) ** 2).sum(axis=1))
    assert (falls <= drift * (1 + 1e-6)).all()
    away = rng.normal(size=(5, 400, size))
    away /= np.sqrt((away**2).sum(axis=2, keepdims=True))
    points = old[:, None] + away * (radius[:, None] * rng.uniform(0, 1, (5, 400)) ** 0.2)[..., None]
    for j in range(5):
        fall = np.sqrt(((points - old[j]) ** 2).sum(axis=2)) - np.sqrt(((points - new[j]) ** 2).sum(axis=2))
        assert (fall.max(axis=1) <= falls[:, j] + 1e-7).all()


def test_drift_across_the_line_of_sight_loosens_less():
    """A centroid that moves sideways comes hardly nearer to vectors far to the side of its path."""
    old, new = np.array([[0.0, 0.0], [10.0, 0.0]]), np.array([[0.0, 0.0], [10.0, 1.0]])
    assert centroids.drift_bounds(old, new, np.array([1.0, 1.0]))[0, 1] < 0.2


def slow_collocations(data, least, top=2000, inside=80):
    """data: (lang, text)."""
    counts = collections.defaultdict(collections.Counter)
    for lang, text in data:
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", low):
            words = [w for w in re.split("[ \t]", piece) if w]
            for n in range(1, 5):
                counts["und" if lang is None else lang].update(tuple(words[i : i + n]) for i in range(len(words) - n + 1))
    out = []
    for lang, f in counts.items():
        n = sum(c for p, c in f.items() if len(p) == 1)
        phrases = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        rows = []
        for p, a in phrases.items():
            around = [b for q, b in phrases.items() if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q)))]
            if any(100 * b >= inside * a for b in around):
                continue
            score, _, left, right = min((2000000 * a // (f[p[:k]] + f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            rows.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(rows)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n, -score))
    return sorted(out)


def check_collocations(docs, least, **options):
    want = slow_collocations([(r.lang, r.text) for r in docs.collect()], least, options.get("top", 2000))
    got = collocations.collocations(docs, least, **options)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, got.collect())) == want
    return want


@pytest.mark.parametrize("options", [{}, {"dictionary": 500, "trie": 300, "top": 50}])
def test_collocations_of_documents(spark, options):
    assert check_collocations(spark.read.parquet(f"{SF}/documents.parquet"), 6, **options)


def test_counts_that_leave_a_task_in_parts_add_up(monkeypatch):
    rng = random.Random(7)
    texts = [" ".join(rng.choice("abcdefgh") * rng.randint(1, 3) for _ in range(rng.randint(0, 40))) for _ in range(50)]
    batch = pa.RecordBatch.from_arrays([pa.array(["en", "de"] * 25), pa.array(texts)], ["lang", "text"])
    ids = pa.RecordBatch.from_arrays([pa.array([[*map(ord, t), 0] for t in texts], pa.list_(pa.int32()))], ["ids"])

    def sums():
        words, pairs = collections.Counter(), collections.Counter()
        parts = [list(collocations._count_words(iter([batch]))), list(collocations._pairs(iter([ids])))]
        for out, counter, n in zip(parts, (words, pairs), ("n", "n")):
            for b in out:
                for row in b.to_pylist():
                    counter[tuple(v for k, v in row.items() if k != n)] += row[n]
        return words, pairs, len(parts[0]) + len(parts[1])

    whole = sums()
    for name, value in (("BYTES", 100), ("NUMBERS", 30), ("HELD", 10)):
        monkeypatch.setattr(collocations, name, value)
    pieces = sums()
    assert pieces[:2] == whole[:2] and pieces[2] > whole[2]
    assert whole[0] == collections.Counter((lang, w) for lang, t in zip(["en", "de"] * 25, texts) for w in t.split())


def test_collocations_of_awkward_rows(spark):
    rng = random.Random(3)
    words = ["a", "A", "b", "cé", "日本", "d e", "x" * 300, "b", "a"]
    rows = [(i, "".join(rng.choice(words) + rng.choice([" ", " ", " ", "\t", "  ", ".", "\n", "; ", ""]) for _ in range(80)), rng.choice(["en", None, "de", ""]), None, 0) for i in range(60)]
    rows += [(1, None, "en", None, 0), (None, "", None, None, 0), (3, " .,; \n", "fr", None, 0), (4, "lone", "fr", None, 0)]
    rows += [(5, "same words here " * 50, "hot", None, 0)] * 5
    assert check_collocations(edge.table(spark, rows), 5)
    assert check_collocations(edge.table(spark), 2)
    assert check_collocations(edge.table(spark, rows), 5, trie=7)
    assert collocations.collocations(edge.empty(spark)).count() == 0


@settings(max_examples=80, deadline=None)
@given(st.sets(st.lists(st.integers(1, 5000), min_size=1, max_size=4).map(tuple), max_size=60), st.data())
def test_trie_accepts_its_sequences_only(sequences, data):
    rows = sorted(s + (0,) * (4 - len(s)) for s in sequences)
    trie = build(np.array(rows, np.int64).reshape(-1, 4))
    known = {tuple(x for x in r if x): i + 1 for i, r in enumerate(rows)}
    pool = sorted({x for s in sequences for x in s} | {0, 7, 4097})
    text = data.draw(st.lists(st.sampled_from(pool), max_size=60))
    text += list(itertools.chain(*list(sequences)[:10])) + [0]
    got = {
        (int(p), length): int(n)
        for length, places, states in trie.walk(np.array(text, np.int32), 4)
        for p, n in zip(places, trie.number[states])
        if n
    }
    want = {
        (i, n): known[tuple(text[i : i + n])]
        for i in range(len(text)) for n in range(1, 5) if tuple(text[i : i + n]) in known
    }
    assert got == want


def slow_chat(rows):
    """rows: (conv_id, turn, role, text); digests from the rows themselves, and lengths of the blocks."""
    talks = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        talks[conv].append((turn is None, turn or 0, role or "", text or ""))
    out = {}
    for conv, turns in talks.items():
        turns.sort(key=lambda t: (t[0], t[1], t[2].encode(), t[3].encode()))
        sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
        loss = "".join(t for _, _, r, t in turns if r == "assistant")
        out[conv] = (len(turns), sha("".join(f"{r}\n{t}\n" for _, _, r, t in turns)), len(loss), sha(loss))
    return out


def awkward_conversations(spark):
    rng = random.Random(6)
    marks = ["<|im_end|>", "<|im_start|>", "<|im_sep|>", "<|nl|>", "<", "|", "\\", "<\\|", "<\\\\|x", "\n", "assistant ok", "日本", "é", " ", "|>", "<<|"]
    text = lambda: "".join(rng.choice(marks) for _ in range(rng.randint(0, 12)))
    rows = [(c, t, rng.choice(["user", "assistant", "assistant", "system", None, "", "a\n<|x", "<"]), text())
            for c in range(60) for t in range(rng.randint(1, 9))]
    rows += [(100, None, "assistant", "x"), (100, 1, "user", None), (100, 1, "user", "b"), (100, 1, "assistant", "b")]
    rows += [(None, 1, "assistant", "x"), (None, 1, "assistant", "x"), (101, 1, "assistant", "")]
    rows += [(102, t, "user" if t % 2 else "assistant", text()) for t in range(1500)] + [(103, 0, "user", "word " * 50_000)]
    rows += [(104, t, "assistant", text()) for t in range(700)]
    schema = "conv_id long, turn long, role string, text string, formatted string, blocks int, begins int, turns string, mask int"
    return rows, spark.createDataFrame([(*r, "f", 1, 2, "t", 3) for r in rows], schema).repartition(4)


def check_chat(rows, table):
    formatted = chat.format_conversations(table)
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in chat.digests(formatted).collect()}
    assert got == slow_chat(rows)
    return formatted


def test_conversations_give_back_their_turns(spark):
    table = spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text")
    hostile = spark.createDataFrame(HOSTILE, table.schema)
    rows = [tuple(r) for r in table.union(hostile).collect()]
    formatted = check_chat(rows, table.union(hostile)).where("conv_id = -1").first().formatted
    inside = "<\\|im_end|><\\|im_start|>assistant ok"
    assert formatted == f"<|im_start|>user\n{inside}<|im_end|>\n<|im_start|>assistant\n{inside}<|im_end|>\n"


def test_awkward_conversations_give_back_their_turns(spark):
    rows, table = awkward_conversations(spark)
    for r in check_chat(rows, table).collect():
        # Every mark in the text is one of the template, and the mask covers the assistant's texts.
        assert r.formatted.startswith("<|im_start|>") and r.formatted.endswith("<|im_end|>\n")
        blocks = r.formatted.split("<|im_start|>")[1:]
        assert all(b.count("<|im_end|>") == 1 for b in blocks)
        roles = [b.split("\n")[0] for b in blocks]
        assert all(a != b for a, b in zip(roles, roles[1:]))
        texts = [t for b in blocks for t in (b.split("\n", 1)[1][: -len("<|im_end|>\n")].split("<|im_sep|>") if b.split("\n")[0] == "assistant" else [])]
        assert [r.formatted[m.begin : m.end] for m in r.mask] == texts
    assert chat.digests(chat.format_conversations(table.limit(0))).count() == 0


def test_no_python_in_chat_formatting(spark):
    _, table = awkward_conversations(spark)
    spark.sql("select 1").collect()
    plan = chat.digests(chat.format_conversations(spark.read.parquet(f"{SF}/conversations.parquet")))._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


@pytest.mark.parametrize("size", [0, 1, 255, 256, 257, 1000])
def test_running_sums(spark, size):
    row = spark.range(1).select(F.transform(F.sequence(F.lit(1), F.lit(max(size, 1))), lambda x: x % 7 + 1).alias("v"))
    if size == 0:
        row = spark.sql("select cast(array() as array<long>) as v")
    values, sums = row.select("v", chat.before(F.col("v").cast("array<long>")).alias("s")).first()
    assert sums == [sum(values[:i]) for i in range(len(values))]
