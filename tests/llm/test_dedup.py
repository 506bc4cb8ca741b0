"""Line dedup, passage dedup and SimHash groups against slow versions, and on awkward tables."""

import collections
import math
import random
import sys

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark import cloudpickle

from cohortscope.llm import edit, graph, lines, passages, simhash
from cohortscope.llm.text import bit_counts
from llm import edge

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def slow_simhash(text, width):
    words = edge.WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    runs = [words[k : k + width] for k in range(len(words) - width + 1)] or ([words] if words else [])
    hashes = [xxhash.xxh64_intdigest(" ".join(r).encode(), 42) for r in runs]
    return sum((2 * sum(h >> b & 1 for h in hashes) > len(hashes)) << b for b in range(64))


def check_simhash(spark, docs):
    data = [(r.doc_id, r.text) for r in docs.collect()]
    fps = [slow_simhash(t, 3) for _, t in data]
    roots = edge.groups(len(data), edge.near_pairs(fps, 3))
    least = {}
    for root, (doc, _) in zip(roots, data):
        if doc is not None:
            least[root] = min(least.get(root, doc), doc)
    want = sorted((d or -1, fp, least.get(r, -1)) for (d, _), fp, r in zip(data, fps, roots))
    got = simhash.near_groups(docs).collect()
    assert want == sorted((r.doc_id or -1, r.fp % 2**64, -1 if r.component_id is None else r.component_id) for r in got)


def test_simhash_of_documents(spark, documents):
    check_simhash(spark, documents)


def test_simhash_of_awkward_rows(spark):
    check_simhash(spark, edge.table(spark))
    assert simhash.near_groups(edge.empty(spark)).count() == 0


def check_keep_one(spark, data):
    """data: (doc_id, text). Of each group of rows the least by id, then hash of the text, stays."""
    from pyspark.sql import functions as F

    docs = edge.table(spark, [(d, t, "en", "s", n) for n, (d, t) in enumerate(data)])
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    hashed = docs.select("doc_id", "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("h")).collect()
    rows = sorted((2**63 - 1 if r.doc_id is None else r.doc_id, r.h, r.text or "") for r in hashed)
    fps = [slow_simhash(t, 3) for _, _, t in rows]
    roots = edge.groups(len(rows), edge.near_pairs(fps, 3))
    want = [(d, t) for i, (d, _, t) in enumerate(rows) if roots[i] == i]
    assert sorted(want) == sorted((2**63 - 1 if r.doc_id is None else r.doc_id, r.text or "") for r in kept.collect())


def test_keep_one_keeps_the_smallest_row_of_each_group(spark):
    check_keep_one(spark, [(r[0], r[1]) for r in edge.rows()])
    assert simhash.keep_one(edge.empty(spark)).count() == 0


def test_keep_one_tells_rows_of_one_id_apart(spark):
    rng = random.Random(4)
    t, u, v, w = (edge.sentence(rng, 30) for _ in range(4))
    check_keep_one(spark, [(3, t), (7, t), (7, u), (9, u)])
    check_keep_one(spark, [(None, t), (None, t), (None, u), (5, u), (5, u), (5, v), (None, w), (None, w + " ")])


@pytest.mark.parametrize("tile", [3, 100_000])
def test_links_of_a_hot_bucket_join_the_same_groups_in_tiles(spark, tile):
    rng = random.Random(3)
    fps = sorted({0xABCDEF << 30 ^ sum(1 << rng.randrange(32) for _ in range(rng.randint(0, 4))) for _ in range(120)})
    rows = spark.createDataFrame([(f,) for f in fps], "fp long")
    links = graph.near_links(simhash.index_rows(rows), 3, tile)
    roots = {r.node: r.root for r in graph.components(links).collect()}
    want = edge.groups(len(fps), edge.near_pairs(fps, 3))
    assert [roots.get(f, f) for f in fps] == [fps[w] for w in want]


@pytest.mark.parametrize("segments", [3, 4])
def test_any_number_of_segments_finds_the_same_groups(spark, segments):
    rng = random.Random(4)
    fps = [rng.getrandbits(62) for _ in range(5)]
    fps += [f ^ (1 << rng.randrange(63)) ^ (1 << rng.randrange(63)) for f in fps]
    rows = spark.createDataFrame([(f,) for f in fps], "fp long")
    links = graph.near_links(simhash.index_rows(rows, 3, segments), 3)
    assert links.count() == len({frozenset(p) for p in edge.near_pairs(fps, 3)})


def test_components_of_a_chain_and_a_star(spark):
    chain = [(i, i + 1) for i in range(100, 140)]
    star = [(5, i) for i in range(1000, 1060)]
    odd = [(7, 7), (None, 3), (-4, 100)]
    links = spark.createDataFrame(chain + star + odd, "a long, b long")
    found = {r.node: r.root for r in graph.components(links).collect()}
    assert found == {**{i: -4 for i in [-4, *range(100, 141)]}, **{i: 5 for i in [5, *range(1000, 1060)]}}


@settings(max_examples=50, deadline=None)
@given(st.lists(st.integers(0, 2**64 - 1), min_size=1, max_size=700), st.integers(1, 699))
def test_bit_counts(hashes, at):
    starts = np.array([0, at] if at < len(hashes) else [0])
    counts = bit_counts(np.array(hashes, np.uint64), starts)
    parts = [hashes[a:b] for a, b in zip(starts, [*starts[1:], len(hashes)])]
    assert counts.tolist() == [[sum(h >> b & 1 for h in p) for b in range(64)] for p in parts]


def near_texts(texts, some=None, similarity=0.8):
    """Pairs of texts whose edit similarity is high enough, of all pairs (with one of ``some``): no fingerprints."""
    sizes = np.array([len(t) for t in texts])
    letters = {c: n for n, c in enumerate(sorted(set("".join(texts))))}
    counts = np.zeros((len(texts), len(letters)), np.int32)
    for n, t in enumerate(texts):
        np.add.at(counts[n], [letters[c] for c in t], 1)
    out = []
    for i in range(len(texts)) if some is None else some:
        most = (np.maximum(sizes, sizes[i]) * (1 - similarity) + 1e-9).astype(int)
        # Each edit changes one letter's count by one, up or down.
        off = counts - counts[i]
        bound = np.maximum(np.where(off > 0, off, 0).sum(axis=1), np.where(off < 0, -off, 0).sum(axis=1))
        for j in np.flatnonzero(bound <= most).tolist():
            if j != i and (some is not None or j > i) and edit.within(texts[i], texts[j], int(most[j])):
                out.append((i, j))
    return out


def slow_lines(docs):
    """Lines that fall to equal ones, and to any of high edit similarity: two sets of (doc, row, line), by brute force."""
    from pyspark.sql import functions as F

    rows = docs.select("doc_id", "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("h")).distinct().collect()
    keyed = sorted((2**63 - 1 if r.doc_id is None else r.doc_id, r.h, r.text or "") for r in rows)
    seen = [((d, h, k), edge.plain_line(s)) for d, h, t in keyed for k, s in enumerate(t.split("\n"))]
    seen = [x for x in seen if x[1]]
    texts = list(dict.fromkeys(s for _, s in seen))
    roots = dict(zip(texts, edge.groups(len(texts), near_texts(texts))))
    out = []
    for name in (lambda s: s, roots.get):
        first = {}
        for place, s in seen:
            first.setdefault(name(s), place)
        out.append({place for place, s in seen if first[name(s)] != place})
    return out


def keyed_docs(docs):
    from pyspark.sql import functions as F

    return docs.select(
        F.coalesce(F.col("doc_id"), F.lit(2**63 - 1)).alias("doc"),
        F.xxhash64(F.coalesce(F.col("text"), F.lit(""))).alias("row"),
        "text",
    )


def removed_lines(docs, **options):
    found = lines.repeated_lines(keyed_docs(docs), **options).collect()
    return {(r.doc, r.row, n) for r in found for n in r.removed}


def check_lines(docs, least=0.9, **options):
    """Nothing is removed without cause, all equal lines are, and nearly all similar ones."""
    equal, every = slow_lines(docs)
    got = removed_lines(docs, **options)
    assert equal <= got <= every
    assert len(got - equal) >= least * len(every - equal)
    return got


def check_cleaned(docs, gone):
    from pyspark.sql import functions as F

    cleaned = lines.dedup_lines(docs)
    assert cleaned.columns == [*(c for c in docs.columns if c not in ("n_lines", "n_removed")), "n_lines", "n_removed"]
    per = collections.defaultdict(set)
    for doc, row, line in gone:
        per[doc, row].add(line)
    want = []
    for r in docs.select("doc_id", "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("h")).collect():
        drop = per[2**63 - 1 if r.doc_id is None else r.doc_id, r.h]
        left = None if r.text is None else "\n".join(s for k, s in enumerate(r.text.split("\n")) if k not in drop)
        want.append((r.doc_id or -1, left or "", r.text is None, 0 if r.text is None else len(r.text.split("\n")), len(drop)))
    got = cleaned.select("doc_id", "text", "n_lines", "n_removed").collect()
    assert sorted(want) == sorted((r.doc_id or -1, r.text or "", r.text is None, r.n_lines, r.n_removed) for r in got)


def test_lines_of_documents(documents):
    check_cleaned(documents, check_lines(documents))


def test_lines_of_awkward_rows(spark):
    check_cleaned(edge.table(spark), check_lines(edge.table(spark), least=0))
    assert lines.dedup_lines(edge.empty(spark)).count() == 0


@pytest.mark.parametrize("options", [{"bucket": 100}, {"bucket": 4, "tile": 8, "most_lines": 3}])
def test_lines_in_small_buckets_and_tiles(documents, options):
    check_lines(documents, **options)


def test_nine_of_ten_similar_lines_are_found(spark):
    """Of a larger table: every eighth line with all others, by edit distance alone."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    places = {}
    for r in sorted(keyed_docs(docs).collect(), key=lambda r: (r.doc, r.row)):
        for k, s in enumerate(r.text.split("\n")):
            if s := edge.plain_line(s):
                places.setdefault(s, (r.doc, r.row, k))
    texts = list(places)
    # Tasks cannot import the tests.
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    asked = spark.sparkContext.parallelize(range(0, len(texts), 8), 32)
    pairs = asked.mapPartitions(lambda some: near_texts(texts, list(some))).collect()
    gone = removed_lines(docs)
    kept = [(a, b) for a, b in pairs if places[texts[a]] not in gone and places[texts[b]] not in gone]
    assert len(pairs) > 50 and len(kept) <= 0.1 * len(pairs)


def test_one_changed_word_is_found(spark):
    rng = random.Random(8)
    data = []
    for n in range(600):
        base = edge.sentence(rng, 12).split()
        data += [(2 * n, " ".join(base), None, None, 0)]
        base[rng.randrange(12)] = "changed"
        data += [(2 * n + 1, " ".join(base), None, None, 0)]
    gone = {doc for doc, _, _ in removed_lines(edge.table(spark, data))}
    assert gone <= set(range(1, 1200, 2)) and len(gone) >= 540


def test_same_words_in_another_order_stay_and_short_words_are_told_apart(spark):
    rng = random.Random(8)
    base = [edge.sentence(rng, 1) + str(i) for i in range(300)]
    pages = [f"page {n}" for n in range(10, 50)]
    data = [(1, " ".join(base), None, None, 0), (2, " ".join(base[::-1]), None, None, 0), (3, "\n".join(pages), None, None, 0)]
    docs = edge.table(spark, data)
    assert check_lines(docs, least=1) == check_lines(docs, least=1, most_lines=4)


@settings(max_examples=40, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 7), st.integers(0, 7)), min_size=1, max_size=40), st.integers(0, 3))
def test_fingerprints_of_a_bucket(prints, radius):
    table = np.array(prints, np.uint64)
    found = lines.near_in_bucket(table, radius, 1, 60).tolist()
    near = [(i, j) for i in range(len(table)) for j in range(i) if int(lines._apart(table[i], table[j])) <= radius]
    every = edge.groups(len(table), near)
    # Groups are as fine as those of all near pairs, or finer; with few fingerprints none is missed.
    assert all(every[i] == every[j] for i, j in enumerate(found))
    if len(table) <= 8:
        assert edge.groups(len(table), enumerate(found)) == every


def changed_prints(rng, count, most):
    """Fingerprints, and for each some that differ from it in up to ``most`` bits, of both halves or one."""
    out = []
    for _ in range(count):
        base = rng.getrandbits(128)
        out.append(base)
        for n in range(3):
            bits = rng.sample(range(64 * (n % 2), 128), rng.randrange(most - 4, most + 1))
            out.append(base ^ sum(1 << b for b in bits))
    return np.array([[p & (1 << 64) - 1, p >> 64] for p in out], np.uint64)


@pytest.mark.parametrize("bucket", [4, 1 << 30])
def test_no_near_fingerprint_is_left_out(spark, bucket):
    table = changed_prints(random.Random(4), 150, lines.RADIUS)
    near = [(i, j) for i in range(len(table)) for j in range(i) if int(lines._apart(table[i], table[j])) <= lines.RADIUS]
    every = edge.groups(len(table), near)
    all_ = np.arange(len(table))
    assert edge.groups(len(table), enumerate(lines.join_near(all_.copy(), table, all_, all_, lines.RADIUS, bucket).tolist())) == every
    # Bands of length as far apart as may be, in one task and in many.
    rows = [(int(a), int(b), n % 3, n % 3) for n, (a, b) in enumerate(table.view(np.int64))]
    prints = spark.createDataFrame(rows, "f1 long, f2 long, low int, high int")
    names = {r.node: n for n, r in enumerate(prints.selectExpr("xxhash64(f1, f2) as node").collect())}
    for tile in (50, 1 << 20):
        links = lines.near_links(prints, lines.RADIUS, bucket, tile).collect()
        assert edge.groups(len(table), [(names[r.a], names[r.b]) for r in links]) == every


def test_long_runs_of_blocks(monkeypatch):
    monkeypatch.setattr(lines, "MANY", 50)
    table = changed_prints(random.Random(6), 40, 14)
    near = [(i, j) for i in range(len(table)) for j in range(i) if int(lines._apart(table[i], table[j])) <= 14]
    all_ = np.arange(len(table))
    for left, right in ((all_, all_), (all_[::2], all_[1::2])):
        found = lines.join_near(all_.copy(), table, left, right, 14)
        asked = near if left is right else [(i, j) for i, j in near if (i + j) % 2]
        assert edge.groups(len(table), enumerate(found.tolist())) == edge.groups(len(table), asked)


@pytest.mark.parametrize("long", [2, 128])
@pytest.mark.parametrize("radius", [0, 3, 14, 26])
def test_a_ring_of_blocks_leaves_no_near_pair_out(monkeypatch, radius, long):
    # As if blocks were always sooner than all pairs; also with runs that are too long for rows.
    blocks_within = lines.blocks_within
    monkeypatch.setattr(lines, "blocks_within", lambda radius, *_: blocks_within(radius, 90_000, 180_000))
    monkeypatch.setattr(lines, "LONG", long)
    rng = random.Random(radius)
    table = changed_prints(rng, 60, max(4, radius))
    table = np.concatenate([table, table[:20], np.repeat(table[:1], 30, axis=0)])
    near = [(i, j) for i in range(len(table)) for j in range(i) if int(lines._apart(table[i], table[j])) <= radius]
    all_ = np.arange(len(table))
    for left, right in ((all_, all_), (all_[::2], all_[1::2])):
        found = lines.join_near(all_.copy(), table, left, right, radius, 1)
        asked = near if left is right else [(i, j) for i, j in near if (i + j) % 2]
        assert edge.groups(len(table), enumerate(found.tolist())) == edge.groups(len(table), asked)


@pytest.mark.parametrize("radius", [7, 14, 26])
def test_blocks_compare_few_pairs(radius):
    ring = lines.blocks_within(radius, 90_000, 180_000)
    # Radii of the blocks, each plus one, sum up to the radius plus one, so no near pair passes all of them.
    assert sum(near + 1 for _, _, near, *_ in ring) == radius + 1
    share = sum(sum(math.comb(width, k) for k in range(near + 1)) / 2**width for _, width, near, *_ in ring)
    assert share < 0.06


def test_blocks_of_large_cells_compare_fewer_pairs():
    ring = lines.blocks_within(26, 1_100_000, 2_300_000)
    share = sum(sum(math.comb(width, k) for k in range(near + 1)) / 2**width for _, width, near, *_ in ring)
    assert sum(near + 1 for _, _, near, *_ in ring) == 27 and share < 0.03


@pytest.mark.parametrize("sparse", [0, 1 << 40])
def test_rows_by_layers_and_by_runs_give_the_same_groups(monkeypatch, sparse):
    # No layer is compared as a whole, and every layer is; in slabs of few pairs.
    blocks_within = lines.blocks_within
    monkeypatch.setattr(lines, "blocks_within", lambda radius, *_: blocks_within(radius, 90_000, 180_000))
    monkeypatch.setattr(lines, "SPARSE", sparse)
    monkeypatch.setattr(lines, "SLAB", 1 << 9)
    table = changed_prints(random.Random(7), 50, 26)
    low = np.uint64((1 << 64) - 1 << 20 & (1 << 64) - 1)
    # Many of one block, so that its run has several rows.
    table = np.concatenate([table, np.stack([table[:90, 0] & low, table[:90, 1]], axis=1)])
    near = [(i, j) for i in range(len(table)) for j in range(i) if int(lines._apart(table[i], table[j])) <= 26]
    all_ = np.arange(len(table))
    for left, right in ((all_, all_), (all_[::2], all_[1::2])):
        found = lines.join_near(all_.copy(), table, left, right, 26, 1)
        asked = near if left is right else [(i, j) for i, j in near if (i + j) % 2]
        assert edge.groups(len(table), enumerate(found.tolist())) == edge.groups(len(table), asked)


@pytest.mark.parametrize("bucket", [4, 1 << 30])
def test_fingerprints_of_unlike_length_are_not_linked(spark, bucket):
    rng = random.Random(5)
    base = [rng.getrandbits(62) for _ in range(200)]
    # Pairs of fingerprints of one bit's difference: of lines of 80 and 100 letters, and of 79 and 100.
    rows = [(b ^ k, b, 79 + (n % 2) if k else 100, 79 + (n % 2) if k else 100, 10, 10) for n, b in enumerate(base) for k in (0, 1)]
    prints = spark.createDataFrame(rows, "f1 long, f2 long, short int, long int, low int, high int")
    links = lines.near_links(prints, lines.RADIUS, bucket, 1 << 20, 0.8).collect()
    names = {r.node: r.f2 for r in prints.selectExpr("xxhash64(f1, f2) as node", "f2").collect()}
    assert {names[r.a] for r in links} == set(base[1::2])


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("abc ", max_size=9), min_size=1, max_size=9), st.sampled_from([0.3, 0.5, 0.8]))
def test_groups_of_similar_lines(texts, similarity):
    found = lines.similar_lines(np.zeros((len(texts), 2), np.uint64), texts, 0, similarity)
    most = [[int(max(len(a), len(b)) * (1 - similarity) + 1e-9) for a in texts] for b in texts]
    near = [(i, j) for i in range(len(texts)) for j in range(i) if edge.edits(texts[i], texts[j]) <= most[i][j]]
    assert edge.groups(len(texts), enumerate(found.tolist())) == edge.groups(len(texts), near)


def test_edits_by_words_are_enough():
    rng = random.Random(2)
    for _ in range(3000):
        a, b = (" ".join(rng.choice(["a", "bb", "ccc", "dd", ""]) for _ in range(rng.randint(0, 9))) for _ in range(2))
        assert edit.by_words(a.split(" "), b.split(" ")) >= edit.distance(a, b)
    assert edit.by_words("one two four five".split(), "one three four five six".split()) == 10


def test_bands_of_similar_lines(spark):
    from pyspark.sql import functions as F

    sizes = spark.range(1, 400).withColumn("at", lines.band(F.col("id"), 0.8)).collect()
    at = {r.id: r["at"] for r in sizes}
    assert all(abs(at[m] - at[n]) <= lines.BANDS for n in at for m in range(n - int(n * 0.2 + 1e-9), n) if m)


@settings(max_examples=60, deadline=None)
@given(st.text("abc ", max_size=30), st.text("abc ", max_size=30), st.integers(0, 12))
def test_edit_distance(a, b, most):
    assert edit.distance(a, b) == edge.edits(a, b)
    assert edit.within(a, b, most) == (edge.edits(a, b) <= most)


def check_passages(docs, width, **options):
    from pyspark.sql import functions as F

    data = docs.select("doc_id", "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("h")).collect()
    keyed = {(2**63 - 1 if r.doc_id is None else r.doc_id, r.h): edge.WORD.findall(r.text or "") for r in data}
    masks = edge.removed_words(list(keyed.items()), width)
    want = sorted(
        (k[0], len(keyed[k]), sum(masks[k]), " ".join(w for w, m in zip(keyed[k], masks[k]) if not m))
        for k in ((2**63 - 1 if r.doc_id is None else r.doc_id, r.h) for r in data)
    )
    cleaned = passages.dedup_passages(docs, width, **options)
    assert cleaned.columns == [*(c for c in docs.columns), "n_words", "n_removed"]
    got = cleaned.select("doc_id", "n_words", "n_removed", "text").collect()
    assert want == sorted((2**63 - 1 if r[0] is None else r[0], r[1], r[2], r[3]) for r in got)


@pytest.mark.parametrize("options", [{}, {"hot_pieces": 1, "shard_words": 2000}])
def test_passages_of_documents(documents, options):
    check_passages(documents, 20, **options)


def test_passages_of_awkward_rows(spark):
    check_passages(edge.table(spark), 20)
    check_passages(edge.table(spark), 4)
    assert passages.dedup_passages(edge.empty(spark)).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.sampled_from("abc"), min_size=6, max_size=25), min_size=1, max_size=6))
def test_windows_of_a_shard(pieces):
    depth = 6
    found = passages.earlier_windows(
        pa.array([" ".join(p).encode() for p in pieces], pa.large_binary()),
        np.arange(len(pieces)), np.zeros(len(pieces), np.int64), depth,
    )
    seen, want = {}, set()
    for n, p in enumerate(pieces):
        for k in range(len(p) - depth + 1):
            if seen.setdefault(tuple(p[k : k + depth]), (n, k)) != (n, k):
                want.add((n, k))
    assert {tuple(f) for f in found.tolist()} == want


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 5), min_size=2, max_size=60))
def test_matching_statistics(symbols):
    text = np.array([0, *symbols, 0])
    depth = 5
    index = passages.FMIndex(text, depth)
    ends = np.array([i for i in range(depth, len(text)) if text[i]], np.int64)
    length, low, high = index.matching_statistics(text, ends, depth)
    whole = tuple(text.tolist())
    for e, found in zip(ends, length):
        runs = [n for n in range(1, depth + 1) if sum(whole[k : k + n] == whole[e + 1 - n : e + 1] for k in range(len(whole) - n + 1)) > 1]
        assert found == max(runs, default=0)
