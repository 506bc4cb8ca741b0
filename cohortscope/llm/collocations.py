"""Phrase collocations: frequent phrases of 2 to 4 words, counted by walking double-array tries.

Words are counted first; frequent ones get numbers, texts become number sequences in which rare words and
piece ends are 0. A phrase can only be frequent if all its parts are (Apriori), so candidates of two words
are adjacent frequent words, those of three and four are runs whose word pairs are all candidates; what
tasks propose is added up, and only proposals that reach the least count become candidates. Candidates
are cut into tries of a bounded size. Each trie is broadcast, all text positions walk it at once, level by
level, accepting states are counted per task, and the tasks' sums give the counts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.broadcast import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortscope.llm.text import chunks, cut, flat, table_of
from cohortscope.llm.trie import Trie, build
from cohortscope.plans.scratch import written
from cohortscope.plans.ship import ship

LEAST = 30
LONGEST = 4
TOP = 2000
# Of 100 occurrences of a phrase, so many in one longer candidate make it a part of that.
INSIDE = 80
# Words of one broadcast dictionary, phrases of one broadcast trie.
DICTIONARY = 2_000_000
TRIE = 1_000_000
# Phrases counted in one vector, and vectors that are added up together.
COUNTED = 256
PARTS = 64
# Bytes of text, and numbers, that a task looks at together, and counts that it holds before it passes them on.
BYTES = 1 << 19
NUMBERS = 200_000
HELD = 200_000
# Bytes that part words, and those that part pieces.
BLANKS, MARKS = b" \t", b".,;:!?\n\x0b\x0c\r"
_BLANK, _MARK = table_of(BLANKS + MARKS), table_of(MARKS)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_WORDS = [f"w{i}" for i in range(1, LONGEST + 1)]


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """All words of some texts, each word's text number, and whether a word is the last one of its piece."""
    data, offsets = flat(texts)
    space = _BLANK[data]
    starts, ends, text = cut(space, offsets)
    sizes = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(ends - starts, out=sizes[1:])
    # Words are all bytes that part nothing, so they stand one after the other.
    kept = np.ascontiguousarray(_LOWER[data[~space]])
    words = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(sizes), pa.py_buffer(kept))
    marks = np.zeros(len(data) + 1, np.int64)
    np.cumsum(_MARK[data], out=marks[1:])
    last = np.ones(len(starts), bool)
    last[:-1] = (marks[starts[1:]] != marks[ends[:-1]]) | (text[1:] != text[:-1])
    return words, text, last


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[pa.Table] = []
    for batch in chunks(batches, "text", BYTES):
        words, text, _ = words_of(batch.column(1))
        langs, coded = batch.column(0).dictionary_encode(), words.dictionary_encode()
        size = max(1, len(coded.dictionary))
        keys = langs.indices.to_numpy().astype(np.int64)[text] * size + coded.indices.to_numpy()
        found, n = np.unique(keys, return_counts=True)
        columns = [langs.dictionary.take(pa.array(found // size)), coded.dictionary.take(pa.array(found % size))]
        held.append(pa.table([columns[0], columns[1].cast(pa.string()), pa.array(n)], ["lang", "word", "n"]))
        if sum(h.num_rows for h in held) > HELD:
            held = [_added(held)]
            if held[0].num_rows > HELD // 2:
                yield from held[0].to_batches()
                held = []
    if held:
        yield from _added(held).to_batches()


def _added(tables: list[pa.Table]) -> pa.Table:
    sums = pa.concat_tables(tables).group_by(["lang", "word"]).aggregate([("n", "sum")])
    return pa.table([sums.column(c) for c in ("lang", "word", "n_sum")], ["lang", "word", "n"])


def numbered_words(frequent: DataFrame, dictionary: int = DICTIONARY) -> tuple[DataFrame, int]:
    """Give (lang, word) numbers from 1 on, in dictionaries of bounded size: (dictionary, lang, word, n, id)."""
    shards = max(1, -(-frequent.count() // dictionary))
    per = 16
    dealt = frequent.withColumn("part", F.pmod(F.xxhash64("lang", "word"), F.lit(shards * per)).cast("int"))
    dealt = written(dealt, "frequent-words")
    sizes = dict(dealt.groupBy("part").count().collect())
    base, rows = 0, []
    for part in range(shards * per):
        rows.append((part, base))
        base += sizes.get(part, 0)
    if base >= 1 << 31:
        raise ValueError("more than 2^31 frequent words")
    bases = dealt.sparkSession.createDataFrame(rows, "part int, base long")
    order = "row_number() over (partition by part order by lang, word)"
    named = dealt.withColumn("r", F.expr(order)).join(F.broadcast(bases), "part")
    return named.selectExpr(
        f"cast(part div {per} as int) as dictionary", "lang", "word", "n", "cast(base + r as int) as id"
    ), shards


def _encode(dictionary: Broadcast):
    """Add the numbers of one dictionary's words to (lang, text, ids), where ids has one for every word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, tuple[pa.Array, np.ndarray]] = dictionary.value
        for batch in chunks(batches, "text", BYTES):
            words, text, _ = words_of(batch.column(1))
            ids = np.zeros(len(words), np.int32)
            before = _entries(batch.column(2))
            if len(before):
                ids[:] = before
            langs = batch.column(0).dictionary_encode()
            code = langs.indices.to_numpy()[text]
            for k, lang in enumerate(langs.dictionary.to_pylist()):
                if lang in known:
                    values, numbers = known[lang]
                    mine = np.flatnonzero(code == k)
                    at = pc.fill_null(pc.index_in(words.take(pa.array(mine)), value_set=values), -1).to_numpy()
                    ids[mine[at >= 0]] = numbers[at[at >= 0]]
            ends = np.searchsorted(text, np.arange(len(batch) + 1)).astype(np.int32)
            listed = pa.ListArray.from_arrays(pa.array(ends), pa.array(ids))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), listed], ["lang", "text", "ids"])

    return run


def _sequences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each text the numbers of its words, a 0 at the end of runs of frequent words; lone words are left out."""
    for batch in chunks(batches, "text", BYTES):
        _, text, last = words_of(batch.column("text"))
        ids = _entries(batch.column("ids"))
        place = np.arange(len(ids)) + np.cumsum(last) - last
        size = len(ids) + int(last.sum())
        spread, owner = np.zeros(size, np.int32), np.zeros(size, np.int64)
        spread[place] = ids
        owner[place] = text
        owner[place[last] + 1] = text[last]
        there = np.append(spread > 0, False)
        used = there[:-1] & (there[1:] | np.append(False, there[:-2]))
        kept = np.flatnonzero(used | (np.append(False, used[:-1]) & ~used))
        ends = np.searchsorted(owner[kept], np.arange(len(batch) + 1)).astype(np.int32)
        yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array(ends), pa.array(spread[kept]))], ["ids"])


def encoded(docs: DataFrame, vocabulary: DataFrame, dictionaries: int) -> DataFrame:
    """(ids) of the texts of (lang, text): one dictionary after the other is broadcast."""
    spark = docs.sparkSession
    rows = docs.withColumn("ids", F.array().cast("array<int>"))
    for shard in range(dictionaries):
        known = {}
        words = vocabulary.where(F.col("dictionary") == shard).select("lang", "word", "id").toPandas()
        for lang, own in words.groupby("lang"):
            known[lang] = (pa.array(own["word"], pa.large_string()), own["id"].to_numpy(np.int32))
        encode = _encode(spark.sparkContext.broadcast(known))
        if shard + 1 < dictionaries:
            rows = written(rows.mapInArrow(encode, "lang string, text string, ids array<int>"), "encoded-part")
    # One Python worker does both steps.
    done = rows.mapInArrow(lambda batches: _sequences(encode(batches)), "ids array<int>")
    return written(done.where("size(ids) > 0"), "encoded")


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches cut into parts with lists of at most about NUMBERS entries, or one row."""
    for batch in batches:
        if batch.num_rows:
            sizes = pc.list_value_length(batch.column(0)).to_numpy(zero_copy_only=False)
            part = np.cumsum(sizes, dtype=np.int64) // NUMBERS
            edges = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
            for a, b in zip(edges, edges[1:]):
                yield batch.slice(a, b - a)


def _entries(lists: pa.Array) -> np.ndarray:
    return lists.flatten().to_numpy(zero_copy_only=False)


def _counted(parts: Iterator[tuple[int, np.ndarray]]) -> Iterator[pa.RecordBatch]:
    """How often a task has each key, for parts of (k, keys): (k, key, n)."""
    held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}

    def added(k: int) -> tuple[np.ndarray, np.ndarray]:
        keys, n = (np.concatenate(x) for x in zip(*held[k]))
        order = np.argsort(keys, kind="stable")
        begin = np.flatnonzero(np.append(True, np.diff(keys[order]) != 0)) if len(keys) else order
        return keys[order][begin], np.add.reduceat(n[order], begin) if len(keys) else n

    def row(k: int, keys: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), k, np.int32)), pa.array(keys), pa.array(n)], ["k", "key", "n"])

    for k, keys in parts:
        held.setdefault(k, []).append(np.unique(keys, return_counts=True))
        if sum(len(x) for x, _ in held[k]) > HELD:
            held[k] = [added(k)]
            if len(held[k][0][0]) > HELD // 2:
                yield row(k, *held.pop(k)[0])
    for k in held:
        yield row(k, *added(k))


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adjacent frequent words, with how often a part of a task has them."""

    def parts() -> Iterator[tuple[int, np.ndarray]]:
        for batch in _slices(batches):
            ids = _entries(batch.column(0))
            both = np.flatnonzero((ids[:-1] > 0) & (ids[1:] > 0))
            yield 2, ids[both].astype(np.int64) << 32 | ids[both + 1]

    yield from _counted(parts())


def _mark(trie: Broadcast, base: int):
    """Write the number of the candidate pair that begins at a word into (ids, pairs), for one trie's pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: Trie = trie.value
        for batch in _slices(batches):
            lists = batch.column(0)
            ids, before = (_entries(batch.column(i)) for i in range(2))
            pairs = before.copy() if len(before) else np.zeros(len(ids), np.int32)
            for length, places, states in known.walk(ids, 2):
                if length == 2:
                    pairs[places] = known.number[states] + base
            ends = np.zeros(len(lists) + 1, np.int32)
            np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False), out=ends[1:])
            yield pa.RecordBatch.from_arrays([lists, pa.ListArray.from_arrays(pa.array(ends), pa.array(pairs))], ["ids", "pairs"])

    return run


def _longer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of three and four words all of whose pairs are candidates, named by their first and last pair."""

    def parts() -> Iterator[tuple[int, np.ndarray]]:
        for batch in _slices(batches):
            some = _entries(batch.column(1)).astype(np.int64)
            for k in range(3, LONGEST + 1):
                whole = np.ones(max(0, len(some) - k + 2), bool)
                for step in range(k - 1):
                    whole &= some[step : step + len(whole)] > 0
                at = np.flatnonzero(whole)
                yield k, some[at] << 32 | some[at + k - 2]

    yield from _counted(parts())


def _accepted(trie: Broadcast, shard: int):
    """How often each phrase of a trie stands in a task's sequences: (shard, part, block, counts), by runs of numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: Trie = trie.value
        size = -(-(int(known.number.max(initial=0)) + 1) // COUNTED)
        total = np.zeros(size * COUNTED, np.int64)
        for batch in _slices(batches):
            for _, _, states in known.walk(_entries(batch.column(0)), LONGEST):
                total += np.bincount(known.number[states], minlength=len(total))
        total[0] = 0
        vectors = total.reshape(size, COUNTED)
        there = np.flatnonzero(vectors.any(axis=1))
        edges = pa.array(np.arange(len(there) + 1, dtype=np.int32) * COUNTED)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(len(there), shard, np.int32)), pa.array((there // PARTS).astype(np.int32)),
                pa.array(there.astype(np.int32)), pa.ListArray.from_arrays(edges, pa.array(vectors[there].ravel())),
            ],
            ["shard", "part", "block", "counts"],
        )

    return run


def _summed(table: pa.Table) -> pa.Table:
    """The vectors of all tasks added up: (shard, number, a) of the phrases of one part of a trie."""
    blocks_ = table.column("block").to_numpy()
    counts = table.column("counts").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(blocks_), COUNTED)
    found, back = np.unique(blocks_, return_inverse=True)
    total = np.zeros((len(found), COUNTED), np.int64)
    np.add.at(total, back, counts)
    number = (found.astype(np.int64)[:, None] * COUNTED + np.arange(COUNTED)).ravel()
    there = np.flatnonzero(total.ravel())
    shard = np.full(len(there), table.column("shard")[0].as_py(), np.int32)
    return pa.table([pa.array(shard), pa.array(number[there].astype(np.int32)), pa.array(total.ravel()[there])], ["shard", "number", "a"])


def _built(table: pa.Table) -> pa.Table:
    """The trie of a shard's phrases as one row."""
    table = table.sort_by("number")
    phrases = np.stack([table.column(w).to_numpy() for w in _WORDS], axis=1).astype(np.int64)
    trie = build(phrases)
    shard = pa.array(table.column("shard").to_numpy()[:1])
    parts = [pa.array([getattr(trie, name).tobytes()], pa.binary()) for name in ("base", "check", "number")]
    return pa.table([shard, *parts], ["shard", "base", "check", "number"])


def tries(phrases: DataFrame, size: int = TRIE) -> tuple[DataFrame, DataFrame, int]:
    """Deal phrases (w1 .. w4, 0 after the end) to tries by their first two words.

    Gives the phrases with (shard, number), a table of one built trie per shard, and how many there are.
    """
    shards = max(1, -(-phrases.count() // size))
    dealt = phrases.withColumn("shard", F.pmod(F.xxhash64("w1", "w2"), F.lit(shards)).cast("int"))
    order = f"row_number() over (partition by shard order by {', '.join(_WORDS)})"
    numbered = written(dealt.withColumn("number", F.expr(f"cast({order} as int)")), "phrases")
    built = numbered.select("shard", "number", *_WORDS).groupBy("shard").applyInArrow(
        _built, "shard int, base binary, check binary, number binary"
    )
    return numbered, written(built, "tries"), shards


def _broadcast(built: DataFrame, shard: int) -> Broadcast:
    row = built.where(F.col("shard") == shard).first()
    arrays = [np.frombuffer(row[name], np.int32) for name in ("base", "check", "number")] if row else None
    trie = Trie(*arrays) if arrays else build(np.zeros((0, LONGEST), np.int64))
    return built.sparkSession.sparkContext.broadcast(trie)


def _frequent(proposed: DataFrame, least: int) -> DataFrame:
    return proposed.groupBy("k", "key").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


def counted_phrases(rows: DataFrame, least: int = LEAST, trie: int = TRIE) -> DataFrame:
    """(w1 .. w4, a): all phrases of 2 to 4 numbers that stand at least ``least`` times in sequences (ids)."""
    schema = "k int, key long, n long"
    pairs = _frequent(rows.mapInArrow(_pairs, schema), least)
    pairs = pairs.selectExpr("cast(shiftright(key, 32) as int) as w1", "cast(key & 4294967295L as int) as w2", "0 as w3", "0 as w4")
    # Written, as it is counted before it is dealt to tries.
    pairs, built, shards = tries(written(pairs, "pairs"), trie)
    sizes = dict(pairs.groupBy("shard").count().collect())
    bases = np.cumsum([0, *(sizes.get(s, 0) for s in range(shards))])
    if bases[-1] >= 1 << 31:
        raise ValueError("more than 2^31 frequent word pairs")
    marked = rows.withColumn("pairs", F.array().cast("array<int>"))
    for shard in range(shards):
        mark = _mark(_broadcast(built, shard), int(bases[shard]))
        if shard + 1 < shards:
            marked = written(marked.mapInArrow(mark, "ids array<int>, pairs array<int>"), "marked-part")
    longer = _frequent(marked.mapInArrow(lambda batches: _longer(mark(batches)), schema), least)
    longer = written(longer, "longer")
    base_of = rows.sparkSession.createDataFrame([(s, int(b)) for s, b in enumerate(bases[:-1])], "shard int, base long")
    named = pairs.join(F.broadcast(base_of), "shard").selectExpr("cast(base + number as int) as pair", "w1", "w2")
    ends = longer.selectExpr("k", "cast(shiftright(key, 32) as int) as first", "cast(key & 4294967295L as int) as last")
    ends = ends.join(named.selectExpr("pair as first", "w1", "w2"), "first")
    ends = ends.join(named.selectExpr("pair as last", "w1 as v1", "w2 as v2"), "last")
    words = ends.selectExpr("w1", "w2", "if(k = 3, v2, v1) as w3", "if(k = 3, 0, v2) as w4")
    candidates, built, shards = tries(written(pairs.select(*_WORDS).unionByName(words), "candidates"), trie)
    total = None
    for shard in range(shards):
        found = rows.mapInArrow(_accepted(_broadcast(built, shard), shard), "shard int, part int, block int, counts array<long>")
        total = found if total is None else total.unionByName(found)
    sums = total.groupBy("shard", "part").applyInArrow(_summed, "shard int, number int, a long").where(F.col("a") >= least)
    return candidates.join(sums, ["shard", "number"]).select(*_WORDS, "a")


def scored(counts: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """(words, a, l, r, score, inside): each phrase's lowest-scoring cut, and the most frequent longer one around it."""
    phrases = written(counts.selectExpr("filter(array(w1, w2, w3, w4), w -> w > 0) as words", "a"), "counts")
    every = written(phrases.unionByName(vocabulary.selectExpr("array(id) as words", "n as a")), "parts")
    cuts = phrases.select("words", "a", F.explode(F.expr("sequence(1, size(words) - 1)")).alias("k"))
    cuts = cuts.selectExpr("words", "a", "k", "slice(words, 1, k) as left", "slice(words, k + 1, 4) as right")
    cuts = cuts.join(every.selectExpr("words as left", "a as l"), "left").join(every.selectExpr("words as right", "a as r"), "right")
    exact = "cast(cast(a as decimal(20,0)) * 2000000 div (cast(l as decimal(20,0)) + r) as long)"
    best = cuts.withColumn("score", F.expr(exact)).groupBy("words").agg(
        F.min(F.struct("score", "k", "a", "l", "r")).alias("best")
    )
    # Parts of two words and more of every longer phrase.
    parts = (
        "flatten(transform(sequence(2, size(words) - 1), n -> transform(sequence(1, size(words) - n + 1), s -> slice(words, s, n))))"
    )
    around = phrases.where("size(words) > 2").select(F.explode(F.expr(parts)).alias("words"), "a")
    around = around.groupBy("words").agg(F.max("a").alias("inside"))
    return best.join(around, "words", "left").select("words", "best.a", "best.l", "best.r", "best.score", "inside")


def named(phrases: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """Add lang and phrase (words joined by spaces) to phrases given as numbers."""
    each = phrases.select("words", F.posexplode("words").alias("pos", "id"))
    texts = each.join(vocabulary.select("id", "lang", "word"), "id").groupBy("words").agg(
        F.min("lang").alias("lang"),
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("pos", "word"))), lambda x: x["word"]), " ").alias("phrase"),
    )
    return phrases.join(texts, "words")


def collocations(
    docs: DataFrame,
    least: int = LEAST,
    top: int = TOP,
    inside: int = INSIDE,
    dictionary: int = DICTIONARY,
    trie: int = TRIE,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the strongest phrases of every language.

    A-Z count as a-z. Texts are cut at ``. , ; : ! ?`` and line ends into pieces, those at spaces and tabs into
    words. n counts a language's words, a a phrase's places within pieces, overlaps included; l and r are the places
    of the two parts of its lowest-scoring cut, score is floor(2000000 a / (l + r)); of equal cuts the
    first counts. Phrases that stand inside a longer candidate in ``inside`` of 100 places are left out. Of equal
    scores the more frequent phrase comes first, then the lesser one by its bytes. A null text is empty, a
    null lang is ``und``; rows are counted as often as they stand; other columns are ignored, whatever their
    names. An empty table, or one without frequent phrases, gives none.

    Broadcast are dictionaries of at most ``dictionary`` words and tries of at most about ``trie`` phrases, one after
    the other; the texts are read again for every dictionary, their numbers for every trie.
    """
    ship(docs.sparkSession)
    plain = docs.select(
        F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    counts = plain.mapInArrow(_count_words, "lang string, word string, n long")
    # Written, as both the totals and the frequent words are taken from it.
    counts = written(counts.groupBy("lang", "word").agg(F.sum("n").alias("n")), "words")
    totals = counts.groupBy("lang").agg(F.sum("n").alias("n"))
    vocabulary, dictionaries = numbered_words(counts.where(F.col("n") >= least), dictionary)
    vocabulary = written(vocabulary, "vocabulary")
    rows = encoded(plain, vocabulary, dictionaries)
    found = scored(counted_phrases(rows, least, trie), vocabulary)
    kept = found.where(F.expr(f"inside is null or cast(100 as decimal(20,0)) * inside < cast({inside} as decimal(20,0)) * a"))
    table = named(kept, vocabulary).select("lang", "phrase", "a", "l", "r", "score")

    def first(rows: DataFrame, *keys: Column) -> DataFrame:
        from pyspark.sql import Window

        order = Window.partitionBy("lang", *keys).orderBy(F.desc("score"), F.desc("a"), "phrase")
        return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)

    # A language may hold most phrases: the first of each of its parts are taken before they meet.
    part = F.pmod(F.xxhash64("phrase"), F.lit(64))
    best = first(first(table, part).drop("rank"))
    return best.join(F.broadcast(totals), "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )


def oracle(least: int = LEAST, top: int = TOP, inside: int = INSIDE) -> str:
    """SQL for the collocations of the table ``documents``."""
    return f"""
with p as (
  select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) as piece
  from documents
), s as (
  select lang, list_filter(regexp_split_to_array(piece, '[\\x20\\x09]+'), lambda w: w <> '') as w from p
), g as (
  select lang, len, w[i : i + len - 1] as words
  from (select lang, w, len, unnest(range(1, len(w) - len + 2)) as i from s, (select unnest(range(1, {LONGEST + 1})) as len))
), f as materialized (
  select lang, len, words, count(*) as a from g group by all
), t as (
  select lang, sum(a)::bigint as n from f where len = 1 group by lang
), c as materialized (
  select * from f where len > 1 and a >= {least}
), x as (
  select c.lang, c.words, c.a, c.k, l.a as l, r.a as r, (c.a::hugeint * 2000000 // (l.a + r.a))::bigint as score
  from (select *, unnest(range(1, len)) as k from c) c
  join f l on l.lang = c.lang and l.words = c.words[1 : c.k]
  join f r on r.lang = c.lang and r.words = c.words[c.k + 1 : c.len]
), b as (
  select * from x qualify row_number() over (partition by lang, words order by score, k) = 1
), h as (
  select lang, part, max(a) as a from (
    select lang, a, words[i : i + n - 1] as part
    from (select lang, a, words, len, n, unnest(range(1, len - n + 2)) as i from (
      select *, unnest(range(2, len)) as n from c where len > 2)))
  group by all
), o as (
  select b.lang, array_to_string(b.words, ' ') as phrase, b.a, b.l, b.r, b.score
  from b left join h on h.lang = b.lang and h.part = b.words
  where h.a is null or 100 * h.a::hugeint < {inside} * b.a::hugeint
), q as (
  select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from o
)
select lang, rank, phrase, a, l, r, n, score from q join t using (lang) where rank <= {top}"""
