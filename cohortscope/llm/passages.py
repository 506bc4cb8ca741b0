"""Substring dedup: words inside long passages that also start earlier are removed.

Every window of ``threshold`` words belongs to the least hash of its runs of a few words, its anchor;
neighbouring windows with one anchor form a piece. Equal windows have equal anchors, so pieces are dealt
to shards by anchor, and only pieces whose anchor is found twice are looked at. Copies of a piece meet as
their hash, counted before they travel; the words are read for one place of each content only, and stand in a shard
once. Pieces of an anchor that very many share are parted by the next least hashes of their windows, until few
share them. Each shard builds an FM-index over its pieces: the Burrows-Wheeler transform in a wavelet matrix of
packed bits. The pieces are streamed against it by backward search, which gives the length of the longest repeated
run that ends at each word (matching statistics, up to the threshold); where it reaches the threshold, the least
place among the matches tells whether the run starts earlier.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortscope.llm.marks import MARKS, PLACE, marked, marks_of, place_slots
from cohortscope.llm.text import SPACE_TABLE, chunks, cut, flat, mix, range_hashes
from cohortscope.plans.scratch import release, written
from cohortscope.plans.ship import ship

THRESHOLD = 20
ANCHOR_WORDS = 5
# Words of one shard's index, about; and pieces of one anchor above which they are dealt by further hashes.
SHARD_WORDS = 400_000
HOT_PIECES = 5_000
_LAST = (1 << 63) - 1
_STEP = np.uint64(0xD6E8FEB86659FD93)


def _runs(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, width: int) -> np.ndarray:
    """A hash of every run of ``width`` words."""
    words = range_hashes(data, starts, ends)
    runs = np.zeros(len(words) - width + 1, np.uint64)
    for k in range(width):
        runs = runs * _STEP + words[k : k + len(runs)]
    return mix(runs)


def _pieces(texts: pa.Array, threshold: int) -> dict[str, np.ndarray]:
    """All pieces of some texts: anchor, text number, first window's word in its text, number of windows.

    ``starts`` and ``ends`` are the byte ranges of all words in ``data``, ``first`` each text's first word.
    """
    data, offsets = flat(texts)
    starts, ends, text = cut(SPACE_TABLE[data], offsets)
    first = np.searchsorted(text, np.arange(len(texts) + 1))
    out = {"data": data, "starts": starts, "ends": ends, "first": first}
    width = min(ANCHOR_WORDS, threshold)
    count = len(starts) - threshold + 1
    if count < 1:
        empty = np.zeros(0, np.int64)
        return out | {"anchor": empty, "text": empty, "at": empty, "windows": empty}
    least = _runs(data, starts, ends, width)
    place = np.arange(len(least))
    span, total = 1, threshold - width + 1
    while span < total:
        step = min(span, total - span)
        left, right = least[:-step], least[step:]
        lower = right < left
        least = np.where(lower, right, left)
        place = np.where(lower, place[step:], place[:-step])
        span += step
    valid = np.flatnonzero(text[:count] == text[threshold - 1 :])
    owner, anchor = text[valid], place[valid]
    fresh = np.append(True, (anchor[1:] != anchor[:-1]) | (owner[1:] != owner[:-1]))[: len(valid)]
    begin = np.flatnonzero(fresh)
    return out | {
        "anchor": least[valid[begin]].view(np.int64),
        "text": owner[begin],
        "at": valid[begin] - first[owner[begin]],
        "windows": np.diff(np.append(begin, len(valid))),
    }


def _parts(texts: pa.Array, threshold: int, level: int) -> dict[str, np.ndarray]:
    """Pieces again, of windows next to each other that have the same ``level`` least hashes of runs."""
    data, offsets = flat(texts)
    starts, ends, text = cut(SPACE_TABLE[data], offsets)
    first = np.searchsorted(text, np.arange(len(texts) + 1))
    out = {"data": data, "starts": starts, "ends": ends, "first": first}
    width = min(ANCHOR_WORDS, threshold)
    runs = _runs(data, starts, ends, width)
    each = np.lib.stride_tricks.sliding_window_view(runs, threshold - width + 1)
    valid = np.flatnonzero(text[: len(each)] == text[threshold - 1 :])
    least = np.sort(each[valid], axis=1)[:, :level]
    keys = np.zeros(len(valid), np.uint64)
    for k in range(least.shape[1]):
        keys = mix(keys * _STEP + least[:, k])
    owner = text[valid]
    begin = np.flatnonzero(np.append(True, (keys[1:] != keys[:-1]) | (owner[1:] != owner[:-1]))[: len(valid)])
    return out | {
        "anchor": keys[begin].view(np.int64),
        "text": owner[begin],
        "at": valid[begin] - first[owner[begin]],
        "windows": np.diff(np.append(begin, len(valid))),
    }


def _words(found: dict[str, np.ndarray], chosen: np.ndarray, threshold: int) -> tuple[list[bytes], np.ndarray]:
    """The words of the chosen pieces, joined by single spaces, and both halves of their hashes."""
    low = found["first"][found["text"][chosen]] + found["at"][chosen]
    high = low + found["windows"][chosen] + threshold - 2
    raw = found["data"].tobytes()
    a, b = (found["starts"][low].tolist(), found["ends"][high].tolist()) if len(chosen) else ([], [])
    words = [b" ".join(raw[i:j].split()) for i, j in zip(a, b)]
    return words, np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, words)), np.int64).reshape(-1, 2)


def _anchor_batches(threshold: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            anchors, n = np.unique(_pieces(batch.column(0), threshold)["anchor"], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(anchors), pa.array(n)], ["anchor", "n"])

    return run


def _piece_batches(threshold: int, marks: Broadcast):
    """The pieces of marked anchors, without their words."""
    names = ["anchor", "h1", "h2", "doc", "row", "at", "windows"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            found = _pieces(batch.column(2), threshold)
            chosen = np.flatnonzero(marked(marks.value, found["anchor"] & (MARKS - 1)))
            _, halves = _words(found, chosen, threshold)
            take = pa.array(found["text"][chosen])
            columns = [
                pa.array(found["anchor"][chosen]), pa.array(halves[:, 0]), pa.array(halves[:, 1]),
                batch.column(0).take(take), batch.column(1).take(take),
                pa.array(found["at"][chosen].astype(np.int32)), pa.array(found["windows"][chosen].astype(np.int32)),
            ]
            yield pa.RecordBatch.from_arrays(columns, names)

    return run


def _word_batches(threshold: int, marks: Broadcast):
    """The words of the pieces at marked places: (h1, h2, doc, row, at, words)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            found = _pieces(batch.column(2), threshold)
            doc, row = (batch.column(i).to_numpy()[found["text"]] for i in range(2))
            # The anchor stands in for the content, as it is known before the words are cut out.
            chosen = np.flatnonzero(marked(marks.value, place_slots(found["anchor"], doc, row, found["at"])))
            words, halves = _words(found, chosen, threshold)
            columns = [halves[:, 0], halves[:, 1], doc[chosen], row[chosen], found["at"][chosen].astype(np.int32)]
            yield pa.RecordBatch.from_arrays(
                [*map(pa.array, columns), pa.array(words, pa.binary())], ["h1", "h2", "doc", "row", "at", "words"]
            )

    return run


def _part_batches(threshold: int, level: int):
    """Pieces parted by their windows' ``level`` least hashes; (h1, h2, offset) is the place in the piece."""
    names = ["anchor", "c1", "c2", "doc", "row", "at", "windows", "h1", "h2", "offset", "words"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "words"):
            found = _parts(batch.column("words").cast(pa.string()), threshold, level)
            chosen = np.arange(len(found["anchor"]))
            words, halves = _words(found, chosen, threshold)
            take, at = pa.array(found["text"]), found["at"].astype(np.int32)
            place = [batch.column(c).take(take) for c in ("doc", "row", "at")]
            columns = [
                pa.array(found["anchor"]), pa.array(halves[:, 0]), pa.array(halves[:, 1]),
                *place[:2], pa.array(place[2].to_numpy() + at), pa.array(found["windows"].astype(np.int32)),
                batch.column("h1").take(take), batch.column("h2").take(take),
                pa.array(batch.column("offset").take(take).to_numpy() + at), pa.array(words, pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names)

    return run


class Bits:
    """A packed row of bits that tells how many are set before a place."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros(-(-(len(bits) + 1) // 64) * 64, np.uint8)
        padded[: len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view(np.uint64)
        self.before = np.zeros(len(self.words), np.int64)
        np.cumsum(np.bitwise_count(self.words[:-1]), out=self.before[1:])

    def rank(self, at: np.ndarray) -> np.ndarray:
        block = at >> 6
        mask = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[block] + np.bitwise_count(self.words[block] & mask)


class FMIndex:
    """Backward search for patterns of up to ``depth`` symbols in a sequence of numbers (0 parts texts).

    Places are sorted by their next ``depth`` symbols, which is as far as patterns go; ``order`` holds
    them. The transform is kept as a wavelet matrix, one packed row of bits for each bit of a symbol.
    """

    def __init__(self, symbols: np.ndarray, depth: int):
        top = int(symbols.max(initial=0)) + 1
        # A symbol of its own at the end, so that no run goes on from there to the beginning.
        symbols = np.append(symbols, top)
        size = len(symbols)
        ranks, reach = symbols.astype(np.int64), 1
        while reach < depth:
            step = min(reach, depth - reach)
            later = np.zeros(size, np.int64)
            # Symbols step .. step + reach follow; past the end stands 0.
            later[: size - step] = ranks[step:]
            _, ranks = np.unique(ranks * (int(ranks.max(initial=0)) + 1) + later, return_inverse=True)
            ranks = ranks + 1
            reach += step
        order = np.argsort(ranks, kind="stable")
        # The place past the end is the last one.
        self.order = order[:-1]
        self.first = np.zeros(top + 2, np.int64)
        np.cumsum(np.bincount(symbols, minlength=top + 1), out=self.first[1:])
        row = symbols[order - 1]
        self.levels = []
        for level in range(max(1, top.bit_length()) - 1, -1, -1):
            bit = (row >> level) & 1
            zeros = int(len(row) - bit.sum())
            self.levels.append((level, Bits(bit), zeros))
            row = np.concatenate([row[bit == 0], row[bit == 1]])
        every = np.arange(top + 1)
        self.base = self._down(every, np.zeros(top + 1, np.int64))

    def _down(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        for level, bits, zeros in self.levels:
            ones = bits.rank(at)
            at = np.where((symbol >> level) & 1 == 1, zeros + ones, at - ones)
        return at

    def extend(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Interval of places of a symbol followed by what [low, high) stands for."""
        n = len(symbol)
        both = self._down(np.concatenate([symbol, symbol]), np.concatenate([low, high]))
        shift = self.first[symbol] - self.base[symbol]
        return both[:n] + shift, both[n:] + shift

    def matching_statistics(self, symbols: np.ndarray, ends: np.ndarray, most: int) -> tuple[np.ndarray, ...]:
        """For runs that end at ``ends``: length (up to ``most``) of the longest one found elsewhere too.

        Also gives the interval of those that reach ``most``.
        """
        last = symbols[ends]
        low, high = self.first[last], self.first[last + 1]
        length = np.zeros(len(ends), np.int64)
        active = np.flatnonzero(high - low > 1)
        length[active] = 1
        for k in range(1, most):
            a, b = self.extend(symbols[ends[active] - k], low[active], high[active])
            more = b - a > 1
            active = active[more]
            low[active], high[active] = a[more], b[more]
            length[active] = k + 1
        return length, low, high


def earlier_windows(words: pa.Array, rank: np.ndarray, base: np.ndarray, threshold: int) -> np.ndarray:
    """Of the pieces of a shard, the windows that start in an earlier piece: rows of (piece, offset).

    ``rank`` orders the pieces by where they first stand; ``base`` is the offset of a piece's first window
    in it. Windows of one document do not share pieces, so
    places are in the order of (rank, offset).
    """
    split = pc.ascii_split_whitespace(words.cast(pa.string()))
    sizes = pc.list_value_length(split).to_numpy(zero_copy_only=False).astype(np.int64)
    ids = split.flatten().dictionary_encode().indices.to_numpy().astype(np.int64) + 1
    piece = np.repeat(np.arange(len(sizes)), sizes)
    # A 0 before each piece and one at the end.
    place = np.arange(len(ids)) + piece + 1
    symbols = np.zeros(len(ids) + len(sizes) + 1, np.int64)
    symbols[place] = ids
    index = FMIndex(symbols, threshold)
    opens = np.cumsum(sizes + 1) - sizes
    offset = place - opens[piece]
    window = np.flatnonzero(offset + threshold <= sizes[piece])
    ends = place[window] + threshold - 1
    length, low, high = index.matching_statistics(symbols, ends, threshold)
    whole = np.flatnonzero(length == threshold)
    if not len(whole):
        return np.zeros((0, 2), np.int64)
    key = np.full(len(symbols), np.iinfo(np.int64).max)
    key[place] = rank[piece] * (1 << 32) + base[piece] + offset
    sorted_key = key[index.order]
    begin, back = np.unique(low[whole], return_inverse=True)
    end = np.zeros(len(begin), np.int64)
    end[back] = high[whole]
    edges = np.empty(2 * len(begin), np.int64)
    edges[0::2], edges[1::2] = begin, end
    # The last interval can end with the table; a further entry keeps its edge inside.
    least = np.minimum.reduceat(np.append(sorted_key, np.iinfo(np.int64).max), edges)[0::2]
    chosen = window[whole]
    late = least[back] < key[place[chosen]]
    return np.stack([piece[chosen[late]], (base[piece] + offset)[chosen[late]]], axis=1)


def _shard_batches(threshold: int):
    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        doc, row, at = (table.column(c).to_numpy() for c in ("doc", "row", "at"))
        order = np.lexsort((at, row, doc))
        rank = np.empty(len(order), np.int64)
        rank[order] = np.cumsum(
            np.append(0, (np.diff(doc[order]) != 0) | (np.diff(row[order]) != 0) | (np.diff(at[order]) != 0))
        )
        words = pc.cast(table.column("words"), pa.large_binary()).combine_chunks()
        base = table.column("offset").to_numpy().astype(np.int64)
        found = earlier_windows(pa.array(words) if isinstance(words, pa.ChunkedArray) else words, rank, base, threshold)
        take = pa.array(found[:, 0])
        columns = [table.column(c).combine_chunks().take(take) for c in ("h1", "h2")]
        return pa.table([*columns, pa.array(found[:, 1].astype(np.int32))], ["h1", "h2", "offset"])

    return run


def _hot(contents: DataFrame, most: int) -> DataFrame | None:
    """Anchors that more than ``most`` contents share, if there are any."""
    hot = written(contents.groupBy("anchor").count().where(F.col("count") > most).select("anchor"), "hot-anchors")
    return None if hot.isEmpty() else hot


def _late_windows(pieces: DataFrame, hot: DataFrame | None, threshold: int, shard_words: int, hot_pieces: int) -> DataFrame:
    """(h1, h2, offset) of the windows that also start in a piece of other content at an earlier place.

    ``pieces`` has a row for each content: anchor, h1, h2, doc, row, at, windows, offset (0) and words; ``hot``
    has the anchors whose pieces are parted.
    """
    names = ["anchor", "h1", "h2", "doc", "row", "at", "windows", "offset", "words"]
    schema = "anchor long, c1 long, c2 long, doc long, row long, at int, windows int, h1 long, h2 long, offset int, words binary"
    late = []
    level, last = 1, threshold - min(ANCHOR_WORDS, threshold) + 1
    while True:
        few = pieces if hot is None else pieces.join(hot, "anchor", "left_anti")
        total = few.agg(F.sum(F.col("windows") + threshold)).first()[0] or 0
        shards = max(1, -(-total // shard_words))
        sharded = few.select(*names).withColumn("shard", F.pmod(F.xxhash64("anchor"), F.lit(shards)))
        late.append(
            sharded.groupBy("shard").applyInArrow(_shard_batches(threshold), "h1 long, h2 long, offset int")
        )
        if hot is None:
            break
        level += 1
        many = pieces.join(hot, "anchor", "left_semi").select(*names)
        parts = written(many.mapInArrow(_part_batches(threshold, level), schema), "parts")
        # Copies of a part meet as one row; all but the earliest are late as a whole.
        content, place = ["anchor", "c1", "c2"], F.struct("doc", "row", "at", "h1", "h2", "offset")
        firsts = parts.groupBy(*content).agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n"))
        firsts = written(firsts, "first-parts")
        own = "h1 = first.h1 and h2 = first.h2 and offset = first.offset"
        copies = parts.drop("words").join(firsts.where("n > 1"), content).where(f"not ({own})")
        late.append(copies.select("h1", "h2", F.explode(F.expr("sequence(offset, offset + windows - 1)")).alias("offset")))
        # The words of a part are taken at its first place, where other parts share its hashes.
        shared = firsts.groupBy("anchor").count().where("count > 1").select("anchor")
        kept = firsts.join(shared, "anchor", "left_semi").selectExpr(*content, "first.h1", "first.h2", "first.offset")
        pieces = written(parts.join(kept, [*content, "h1", "h2", "offset"]).select(*names), "kept-parts")
        # Windows that have all hashes in common are alike, so there is no further cut.
        hot = _hot(pieces, hot_pieces) if level < last else None
    out = late[0]
    for more in late[1:]:
        out = out.unionByName(more)
    return out


def repeated_windows(
    docs: DataFrame, threshold: int = THRESHOLD, shard_words: int = SHARD_WORDS, hot_pieces: int = HOT_PIECES
) -> DataFrame:
    """Windows that start earlier: (doc, row, runs), runs of (at, windows, offsets).

    ``docs`` has doc, row and text. A run is a piece; offsets are its repeated windows, null for all.
    """
    spark = docs.sparkSession
    ship(spark)
    anchors = docs.select("text").mapInArrow(_anchor_batches(threshold), "anchor long, n long")
    twice = anchors.groupBy("anchor").agg(F.sum("n").alias("n")).where("n > 1")
    marks = spark.sparkContext.broadcast(marks_of(twice, f"anchor & {MARKS - 1}L"))
    schema = "anchor long, h1 long, h2 long, doc long, row long, at int, windows int"
    pieces = written(docs.mapInArrow(_piece_batches(threshold, marks), schema), "pieces")
    content = ["anchor", "h1", "h2"]
    distinct = pieces.groupBy(*content).agg(
        F.min(F.struct("doc", "row", "at")).alias("first"), F.max("windows").alias("windows"), F.count(F.lit(1)).alias("n")
    )
    distinct = written(distinct.select(*content, "first.*", "windows", "n"), "distinct-pieces")
    shared = written(distinct.groupBy("anchor").count().where("count > 1").select("anchor"), "shared")
    asked = written(distinct.join(shared, "anchor", "left_semi").select(*content, "doc", "row", "at", "windows"), "asked")
    hot = _hot(asked, hot_pieces)
    marks = spark.sparkContext.broadcast(marks_of(asked, PLACE.format("anchor", "at")))
    place = ["h1", "h2", "doc", "row", "at"]
    words = docs.mapInArrow(_word_batches(threshold, marks), "h1 long, h2 long, doc long, row long, at int, words binary")
    # Rows that repeat a document give a place several times.
    words = words.groupBy(*place).agg(F.any_value("words").alias("words"))
    words = written(asked.join(words, place).withColumn("offset", F.lit(0)), "words")
    release(shared, asked)
    late = _late_windows(words, hot, threshold, shard_words, hot_pieces)
    late = written(late.groupBy("h1", "h2").agg(F.collect_set("offset").alias("offsets")), "late")
    release(words)
    known = distinct.select("h1", "h2", "n", F.struct("doc", "row", "at").alias("first"))
    known = written(known.join(late, ["h1", "h2"], "left").where("n > 1 or offsets is not null").drop("n"), "known-pieces")
    release(distinct, late)
    runs = pieces.select("h1", "h2", "doc", "row", "at", "windows").join(known, ["h1", "h2"])
    own = "first.doc = doc and first.row = row and first.at = at"
    runs = runs.where(f"not ({own}) or offsets is not null").withColumn("offsets", F.expr(f"if({own}, offsets, null)"))
    runs = written(runs.groupBy("doc", "row").agg(F.collect_list(F.struct("at", "windows", "offsets")).alias("runs")), "runs")
    release(pieces, known)
    return runs


def covered(count: int, runs: list[dict], threshold: int) -> np.ndarray:
    """Which of a text's words lie in one of the windows."""
    change = np.zeros(count + 1, np.int64)
    for run in runs:
        if run["offsets"] is None:
            change[run["at"]] += 1
            change[run["at"] + run["windows"] + threshold - 1] -= 1
        else:
            begin = run["at"] + np.array(run["offsets"], np.int64)
            np.add.at(change, begin, 1)
            np.add.at(change, begin + threshold, -1)
    return np.cumsum(change[:-1]) > 0


def _without(threshold: int):
    def kept(text: pd.Series, runs: pd.Series) -> pd.DataFrame:
        rows = []
        for t, found in zip(text, runs):
            words = (t or "").encode().split()
            gone = 0
            if found is not None and len(found):
                mask = covered(len(words), list(found), threshold)
                gone = int(mask.sum())
                left = [w for w, drop in zip(words, mask.tolist()) if not drop]
            else:
                left = words
            rows.append((b" ".join(left).decode(), len(words), gone))
        return pd.DataFrame(rows, columns=["text", "n_words", "n_removed"])

    return kept


def dedup_passages(docs: DataFrame, threshold: int = THRESHOLD, **options) -> DataFrame:
    """The documents without the words of repeated windows, with two more columns: n_words, n_removed.

    Words are runs of characters that are no ASCII white space, unchanged. A word goes when a window of
    ``threshold`` consecutive words of its document covers it whose words also start earlier: in a
    document of smaller doc_id, or earlier in the same one. Windows are judged on the input. The text
    left is its words joined by single spaces; a null text has no words and becomes empty. A null doc_id
    comes last; rows that share a doc_id are ordered by a hash of their text, and rows that repeat both
    are treated alike. Columns named n_words or n_removed are replaced, others stay as they are.
    """
    wide = docs.drop("n_words", "n_removed")
    names = wide.columns
    doc = F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST)).alias("doc")
    row = F.xxhash64(F.coalesce(F.col("text"), F.lit(""))).alias("row")
    runs = repeated_windows(wide.select(doc, row, F.col("text").cast("string").alias("text")), threshold, **options)
    packed = wide.select(doc, row, F.struct(*(F.col(f"`{c}`") for c in names)).alias("it"))
    kept = F.pandas_udf(_without(threshold), "text string, n_words long, n_removed long")
    done = packed.join(runs, ["doc", "row"], "left").select("it", kept("it.text", "runs").alias("new"))
    return done.select(
        *((F.col("new.text").alias("text") if c == "text" else F.col(f"it.`{c}`").alias(c)) for c in names),
        "new.n_words",
        "new.n_removed",
    )
