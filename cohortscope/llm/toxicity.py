"""Toxicity by a weighted finite-state grammar over clauses.

Small transducers read the words of a clause side by side: negation, reported speech and target keep a
state, insult and threat give an output with a weight. Their composition labels every match by its path
(bare, aimed at someone, negated, reported). A text's score is a logistic function of the weights that
its clauses collect on each path. Insult words and their weights, and the weight of each path, are
learned from labels.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortscope.llm.text import chunks
from cohortscope.plans.scratch import written
from cohortscope.plans.ship import ship

# Labelled documents the classifier is fitted on at most (about; they are chosen by a hash of the id).
FIT_ROWS = 20_000
# Learned insult words at most, those of the highest evidence.
LEXICON = 5_000
FOLDS = 5

# Words of the grammar in the four languages of the corpora at hand.
INSULTS = frozenset("idiot moron imbecile scum loser stupid worthless pathetic disgusting trash clown bastard".split())
THREATS = frozenset("kill hurt destroy burn shoot stab tuer frapper töten schlagen matar golpear".split())
TARGETS = frozenset("you your they them he she tu vous toi ils du ihr sie tú usted ustedes ellos".split())
NEGATIONS = frozenset("not no never nobody without n't ne pas jamais sans nicht kein keine nie ohne nunca sin".split())
REPORTING = frozenset(
    "said says wrote claimed quoted called dit disait écrit sagte schrieb behauptete dijo escribió".split()
)
PRIOR_WEIGHT = 3.0
NEGATION_REACH = 3

WORDS = re.compile(r"[^\W\d_]+(?:'t\b)?")
CLAUSES = re.compile(r"[.!?;\n]+")
PATHS = [f"{kind} {how}" for kind in ("insult", "threat") for how in ("bare", "aimed", "negated", "reported")]


# Each transducer gives the next state for a state and the classes of a word.
def _negation(state: int, classes: int) -> int:
    return NEGATION_REACH if classes & 4 else max(0, state - 1)


def _reported(state: int, classes: int) -> int:
    return 1 if classes & 8 else state


def _target(state: int, classes: int) -> int:
    return 1 if classes & 2 else state


def read_clause(words: list[str], insults: dict[str, float]) -> list[tuple[int, float]]:
    """(path, weight) of every match in a clause."""
    negated = reported = aimed = 0
    found = []
    for word in words:
        weight = insults.get(word)
        threat = word in THREATS
        classes = 2 * (word in TARGETS) + 4 * (word in NEGATIONS) + 8 * (word in REPORTING)
        negated, reported, aimed = _negation(negated, classes), _reported(reported, classes), _target(aimed, classes)
        if weight is not None or threat:
            found.append((bool(threat and weight is None), weight or 1.0, negated > 0, reported > 0))
    # The target may follow the match, so it is known at the clause's end only. A threat needs one.
    out = []
    for threat, weight, neg, rep in found:
        if threat and not aimed:
            continue
        how = 2 if neg else 3 if rep else 1 if aimed else 0
        out.append((4 * threat + how, weight))
    return out


def features(text: str | None, insults: dict[str, float], alphabet: frozenset[str]) -> np.ndarray:
    """Of each path, the sum of weights of a text's matches; then the number of different matched words."""
    out = np.zeros(len(PATHS) + 1)
    lower = (text or "").lower()
    hits = alphabet.intersection(WORDS.findall(lower))
    if hits:
        out[-1] = len(hits & insults.keys())
        for clause in CLAUSES.split(lower):
            words = WORDS.findall(clause)
            if not hits.isdisjoint(words):
                for path, weight in read_clause(words, insults):
                    out[path] += weight
    return out


def _squashed(x: np.ndarray) -> np.ndarray:
    return np.log1p(x)


@dataclass(frozen=True)
class Model:
    insults: dict[str, float] = field(default_factory=lambda: dict.fromkeys(INSULTS, PRIOR_WEIGHT))
    # Weight of each path and of the number of different words; used as they are without labels.
    weights: tuple[float, ...] = (1.5, 2.0, 0.3, 0.3, 1.5, 2.0, 0.3, 0.3, 1.0)
    bias: float = -3.0

    def scores(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        alphabet = frozenset(self.insults) | THREATS
        rows = np.array([features(t, self.insults, alphabet) for t in texts]).reshape(len(texts), -1)
        z = _squashed(rows) @ np.array(self.weights) + self.bias
        return 1 / (1 + np.exp(-np.clip(z, -30, 30))), rows[:, -1].astype(np.int64)


def fold(doc_id: Column, folds: int = FOLDS) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Different (word, word before it, toxic, half) of each batch."""
    for batch in chunks(batches):
        seen = set()
        for text, toxic, half in zip(*(batch.column(i).to_pylist() for i in range(3))):
            words = WORDS.findall((text or "").lower())
            seen.update(zip(words, ["", *words], [toxic] * len(words), [half] * len(words)))
        rows = list(zip(*seen)) or [(), (), (), ()]
        types = [pa.string(), pa.string(), pa.int32(), pa.int64()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(r, t) for r, t in zip(rows, types)], ["word", "before", "toxic", "half"]
        )


def _learned(contexts: DataFrame, among: str, lexicon: int) -> dict[str, float]:
    """Insult words and weights from the contexts in ``among``, those of the highest evidence first.

    The evidence is the log likelihood ratio of a word's share of toxic contexts against that of all
    words; it must outweigh the number of words tried.
    """
    words = contexts.where(among).groupBy("word").agg(F.sum("toxic").alias("t"), F.sum(1 - F.col("toxic")).alias("c"))
    total = words.agg(F.sum("t").alias("t"), F.sum("c").alias("c"), F.count(F.lit(1)).alias("n")).first()
    if not total["t"] or not total["c"]:
        return {}
    share = total["t"] / (total["t"] + total["c"])
    gain = f"t * ln(t / (t + c) / {share}D) + if(c = 0, 0, c * ln(c / (t + c) / {1 - share}D))"
    weight = f"ln((t + 0.25D) / {total['t']}D) - ln((c + 0.25D) / {total['c']}D)"
    rated = words.where("t >= 3").withColumns({"gain": F.expr(gain), "weight": F.expr(weight)})
    rated = rated.where(f"weight >= 1.5 and gain >= ln({total['n']}) + 1").orderBy(F.col("gain").desc(), "word")
    rows = rated.limit(lexicon).select("word", "weight").collect()
    return {r["word"]: min(r["weight"], 6.0) for r in rows if r["word"] not in TARGETS | NEGATIONS | REPORTING}


def _feature_batches(insults: dict[str, float]):
    alphabet = frozenset(insults) | THREATS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            rows = [features(t, insults, alphabet).tolist() for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.list_(pa.float64())), batch.column(1)], ["x", "toxic"])

    return run


def _logistic(x: np.ndarray, y: np.ndarray, prior: Model) -> tuple[tuple[float, ...], float]:
    """Ridge-penalised logistic weights, drawn towards the prior model's; none is below zero."""
    centre = np.array([*prior.weights, prior.bias])
    penalty = np.append(np.full(x.shape[1], 1.0), 1e-3)
    design = np.column_stack([x, np.ones(len(x))])
    beta = centre.copy()
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        gradient = design.T @ (y - p) - penalty * (beta - centre)
        hessian = (design * np.maximum(p * (1 - p), 1e-6)[:, None]).T @ design + np.diag(penalty)
        step = np.linalg.solve(hessian, gradient)
        beta = beta + step * min(1.0, 2.0 / max(1e-12, np.abs(step).max()))
        if np.abs(step).max() < 1e-6:
            break
    return tuple(np.maximum(beta[:-1], 0).tolist()), float(beta[-1])


def fit(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS, lexicon: int = LEXICON) -> Model:
    """Learn from labels of documents that are not held out.

    At most about ``fit_rows`` labelled documents are used, chosen by a hash of the id. They give the
    insult words: a word counts once for each different word before it, so copies of a text count once,
    and its weight is the log of how much more often toxic documents have it. For the weights of the
    paths, each half of them is read with the words learned from the other half. Repeated labels of a document count as toxic if any does; null
    labels are left out. Without labels of both kinds the prior model is returned.
    """
    spark = docs.sparkSession
    ship(spark)
    usable = labels.where("toxic is not null and doc_id is not null").select(F.col("doc_id").cast("long"), "toxic")
    usable = usable.where(fold(F.col("doc_id")) != 0).groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    usable = written(usable, "labels")
    count = usable.count()
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30))
    chosen = usable.where(place < int((1 << 30) * min(1.0, fit_rows / max(1, count)))).withColumn("half", F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(2)))
    # Bounded by fit_rows, whatever the size of the corpus.
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).join(F.broadcast(chosen), "doc_id")
    rows = written(rows, "labelled")
    prior = Model()
    seen = rows.select("text", "toxic", "half").mapInArrow(_contexts, "word string, before string, toxic int, half long")
    contexts = written(
        seen.groupBy("word", "before", "toxic").agg(*(F.max(F.col("half") == h).alias(f"in{h}") for h in (0, 1))), "contexts"
    )
    insults = prior.insults | _learned(contexts, "true", lexicon)
    # Each half's matches are weighed by words learned from the other half.
    halves = [prior.insults | _learned(contexts, f"in{1 - h}", lexicon) for h in (0, 1)]
    tables = [
        rows.where(f"half = {h}").select("text", "toxic").mapInArrow(_feature_batches(halves[h]), "x array<double>, toxic int").toPandas()
        for h in (0, 1)
    ]
    x = [row for t in tables for row in t["x"]]
    y = np.concatenate([t["toxic"].to_numpy(float) for t in tables])
    if len(set(y)) < 2:
        return Model(insults)
    weights, bias = _logistic(_squashed(np.stack(x)), y, prior)
    return Model(insults, weights, bias)


def _score_batches(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            score, words = model.scores(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(score), pa.array(words)], ["doc_id", "score", "insult_words"]
            )

    return run


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, held_out, score, predicted, insult_words) of every row; only the text is read.

    Null and empty texts have the score of a text without matches. Rows that share a doc_id, or have a
    null one, are scored each by its own text.
    """
    ship(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    scored = rows.mapInArrow(_score_batches(model), "doc_id long, score double, insult_words long")
    return scored.select(
        "doc_id",
        (fold(F.col("doc_id")) == 0).alias("held_out"),
        "score",
        F.expr("if(score >= 0.5D, 1, 0)").alias("predicted"),
        "insult_words",
    )


def drop_toxic(docs: DataFrame, model: Model) -> DataFrame:
    """The documents that are not predicted toxic, with their columns; decided row by row, by the text."""
    ship(docs.sparkSession)

    def verdict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            scores, _ = model.scores(batch.column(batch.schema.get_field_index("text")).to_pylist())
            yield batch.filter(pa.array(scores < 0.5))

    return docs.mapInArrow(verdict, docs.schema)
