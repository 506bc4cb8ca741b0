"""Language of texts, with spans of mixed-language texts.

Script ranges narrow the candidates of each word, characters of the word give each candidate a score,
and a Viterbi pass over the words with a penalty for every switch labels the spans.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortscope.llm.text import chunks, mix
from cohortscope.plans.scratch import written
from cohortscope.plans.ship import ship

# Documents that the character statistics are taken from at most (about; chosen by a hash of the id).
FIT_ROWS = 20_000
BUCKETS = 1 << 16
LONGEST = 3
SWITCH = 12.0
FOLDS = 3
HELD_OUT = 1
UNKNOWN = "und"
LETTERS = re.compile(r"[^\W\d_]+")

# First and last code point of scripts, in blocks of Unicode.
SCRIPTS = (
    ("latin", 0x0041, 0x024F),
    ("greek", 0x0370, 0x03FF),
    ("cyrillic", 0x0400, 0x052F),
    ("armenian", 0x0530, 0x058F),
    ("hebrew", 0x0590, 0x05FF),
    ("arabic", 0x0600, 0x077F),
    ("devanagari", 0x0900, 0x097F),
    ("thai", 0x0E00, 0x0E7F),
    ("hangul", 0x1100, 0x11FF),
    ("latin", 0x1E00, 0x1EFF),
    ("kana", 0x3040, 0x30FF),
    ("han", 0x3400, 0x9FFF),
    ("hangul", 0xAC00, 0xD7AF),
)
SCRIPT_NAMES = tuple(dict.fromkeys(name for name, _, _ in SCRIPTS))
_FIRST = np.array([a for _, a, _ in SCRIPTS])
_LAST = np.array([b for _, _, b in SCRIPTS])
_NUMBER = np.array([SCRIPT_NAMES.index(name) for name, _, _ in SCRIPTS])


def script_numbers(points: np.ndarray) -> np.ndarray:
    """Script of each code point; the number after the last one for all others."""
    at = np.maximum(np.searchsorted(_FIRST, points, side="right") - 1, 0)
    inside = (points >= _FIRST[at]) & (points <= _LAST[at])
    return np.where(inside, _NUMBER[at], len(SCRIPT_NAMES))


def grams(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket of every run of 1 to 3 characters of each word (its ends included), its word, the scripts."""
    flat = np.frombuffer((" " + " ".join(words) + "  ").encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    space = flat == 32
    # The space before a word opens it and the one after it closes it.
    word = np.cumsum(space)[:-2] - 1
    body = flat[:-2]
    keys, owners = [], []
    for n in range(1, LONGEST + 1):
        key = np.full(len(body), n, np.uint64)
        crosses = np.zeros(len(body), bool)
        for k in range(n):
            key = key * np.uint64(0x110000) + flat[k : k + len(body)]
            if k and k < n - 1:
                crosses |= space[k : k + len(body)]
        whole = ~crosses & ~(space[: len(body)] if n == 1 else np.zeros(len(body), bool)) & (word < len(words))
        keys.append((mix(key[whole]) % np.uint64(BUCKETS)).astype(np.int64))
        owners.append(word[whole])
    starts = np.flatnonzero(space[:-2])[: len(words)] + 1
    return np.concatenate(keys), np.concatenate(owners), script_numbers(flat[starts].astype(np.int64))


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    # Log probability of each bucket (rows) in each language.
    logs: np.ndarray
    # Which script (rows; the last one: none of the known) each language is written in.
    scripts: np.ndarray
    switch: float = SWITCH

    def word_scores(self, words: list[str]) -> np.ndarray:
        """Log likelihood of each word in each language; candidates are narrowed by its script."""
        count = len(self.languages)
        out = np.zeros((len(words), count))
        if not words:
            return out
        bucket, word, script = grams(words)
        for k in range(count):
            out[:, k] = np.bincount(word, self.logs[bucket, k], len(words))
        allowed = self.scripts[script]
        none = ~allowed.any(axis=1)
        out[none] = 0.0
        out[~(allowed | none[:, None])] = -1e6
        return out - out.max(axis=1, keepdims=True)


def spans(scores: np.ndarray, offsets: np.ndarray, switch: float) -> np.ndarray:
    """Viterbi labels of the words of several texts, word by word for all texts at once."""
    lengths = np.diff(offsets)
    order = np.argsort(-lengths, kind="stable")
    begin = offsets[:-1][order]
    sorted_lengths = lengths[order]
    steps = int(sorted_lengths[0]) if len(order) else 0
    active = np.searchsorted(-sorted_lengths, -np.arange(steps), side="left")
    labels = np.zeros(len(scores), np.int64)
    if not steps:
        return labels
    came = np.zeros(len(scores), np.min_scalar_type(scores.shape[1]))
    stays = np.zeros((len(scores), scores.shape[1]), bool)
    best = np.zeros((active[0], scores.shape[1]))
    for t in range(steps):
        n = active[t]
        rows = begin[:n] + t
        if t:
            value = best[:n]
            top = value.argmax(axis=1)
            change = value[np.arange(n), top] - switch
            keep = value >= change[:, None]
            came[rows] = top
            stays[rows] = keep
            best[:n] = np.where(keep, value, change[:, None])
        best[:n] += scores[rows]
    state = best.argmax(axis=1)
    for t in range(steps - 1, -1, -1):
        n = active[t]
        rows = begin[:n] + t
        labels[rows] = state[:n]
        if t:
            stay = stays[rows, state[:n]]
            state[:n] = np.where(stay, state[:n], came[rows])
    return labels


def predict(texts: list[str | None], model: Model) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Of each text: the language of most letters, its share of them, the number of spans."""
    found = [LETTERS.findall((t or "").lower()) for t in texts]
    offsets = np.cumsum([0, *map(len, found)])
    words = pa.array([w for f in found for w in f], pa.string()).dictionary_encode()
    ids = words.indices.to_numpy()
    known = words.dictionary.to_pylist()
    names, shares, counts = [UNKNOWN] * len(texts), np.zeros(len(texts)), np.zeros(len(texts), np.int64)
    if not model.languages or not len(ids):
        return names, shares, counts
    labels = spans(model.word_scores(known)[ids], offsets, model.switch)
    letters = np.fromiter(map(len, known), np.int64, len(known))[ids]
    width = len(model.languages)
    owner = np.repeat(np.arange(len(texts)), np.diff(offsets))
    per = np.bincount(owner * width + labels, letters, len(texts) * width).reshape(-1, width)
    breaks = np.append(True, (owner[1:] != owner[:-1]) | (labels[1:] != labels[:-1]))
    counts = np.bincount(owner[breaks], minlength=len(texts))
    total = per.sum(axis=1)
    for i in np.flatnonzero(total):
        names[i] = model.languages[int(per[i].argmax())]
        shares[i] = per[i].max() / total[i]
    return names, shares, counts


def fold(doc_id: Column, folds: int = FOLDS) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, kind, bucket, n): character runs (kind 0) and scripts of words (kind 1) of each batch."""
    for batch in chunks(batches):
        by_lang: dict[str, list[str]] = {}
        for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            by_lang.setdefault(lang, []).extend(LETTERS.findall((text or "").lower()))
        for lang, words in by_lang.items():
            if not words:
                continue
            bucket, _, script = grams(words)
            for kind, values, size in ((0, bucket, BUCKETS), (1, script, len(SCRIPT_NAMES) + 1)):
                n = np.bincount(values, minlength=size)
                seen = np.flatnonzero(n)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(seen)), pa.array(np.full(len(seen), kind, np.int32)), pa.array(seen.astype(np.int32)), pa.array(n[seen])],
                    ["lang", "kind", "bucket", "n"],
                )


def fit(docs: DataFrame, fit_rows: int = FIT_ROWS) -> Model:
    """Character statistics of each language, from documents with a lang that are not held out.

    At most about ``fit_rows`` documents are read for it, chosen by a hash of the id. What comes to the
    driver is at most 65,536 counts per language. A language is written in a script when one in a
    hundred of its words is. Without documents the model knows no language.
    """
    ship(docs.sparkSession)
    usable = docs.where("lang is not null").where(fold(F.col("doc_id")) != HELD_OUT)
    count = usable.select("doc_id").count()
    place = F.pmod(F.xxhash64(F.col("doc_id").cast("long")), F.lit(1 << 30))
    chosen = usable.where(place < int((1 << 30) * min(1.0, fit_rows / max(1, count))))
    rows = chosen.select(F.col("text").cast("string"), F.col("lang").cast("string"))
    counts = written(
        rows.mapInArrow(_counts, "lang string, kind int, bucket int, n long").groupBy("lang", "kind", "bucket").agg(F.sum("n").alias("n")),
        "grams",
    ).toPandas()
    names = tuple(sorted(counts["lang"].unique()))
    table = np.zeros((BUCKETS, len(names)))
    scripts = np.zeros((len(SCRIPT_NAMES) + 1, len(names)), bool)
    for k, name in enumerate(names):
        own = counts[counts["lang"] == name]
        runs, kinds = own[own["kind"] == 0], own[own["kind"] == 1]
        table[runs["bucket"], k] = runs["n"]
        scripts[kinds["bucket"], k] = kinds["n"] >= 0.01 * kinds["n"].sum()
    logs = np.log((table + 0.1) / (table.sum(axis=0) + 0.1 * BUCKETS)) if names else table
    return Model(names, logs.astype(np.float32), scripts)


def _label_batches(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            names, shares, counts = predict(batch.column(1).to_pylist(), model)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(names, pa.string()), pa.array(shares), pa.array(counts)],
                ["doc_id", "lang_pred", "score", "n_spans"],
            )

    return run


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, n_spans) of every row; only the text is read.

    ``score`` is the share of letters in spans of the predicted language. A text that is null or has no
    letter, and any text under a model without languages, is ``und`` with score 0. Rows that share a
    doc_id, or have a null one, are labelled each by its own text.
    """
    ship(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    labelled = rows.mapInArrow(_label_batches(model), "doc_id long, lang_pred string, score double, n_spans long")
    return labelled.select("doc_id", (fold(F.col("doc_id")) == HELD_OUT).alias("held_out"), "lang_pred", "score", "n_spans")
