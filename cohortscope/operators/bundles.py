"""Many scores of one person in one row.

Scores of the same persons (the same set of persons, scored and unscored alike) form bundles of a bounded
number. A row of the cohort holds a person's covariates, strata and outcomes once for each bundle, and the
bundle's scores as an array, so the cohort grows with persons and bundles, not with persons and requests.
Whatever does not depend on the score is then worked out once for a bundle.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortscope.config import LOGISTIC, EvalConfig
from cohortscope.functions.columns import missing_as_null
from cohortscope.operators.cohort import PERSON, SCORE, check_columns, person_columns, stratum_column
from cohortscope.plans.scratch import written

SCORES = "scores"
# Scores of a bundle at most.
SIZE = 32
# Parts a bundle's rows are hashed to before Spark sizes the partitions.
SPREAD = 64


@dataclass(frozen=True)
class Request:
    """A request's place: its score in the bundle's array, and its outcome column."""

    task_id: str
    method: str
    slot: int
    outcome: int

    @property
    def target(self) -> tuple[int, bool]:
        """Requests of one target share the outcome and how it is scaled."""
        return self.outcome, self.method == LOGISTIC


@dataclass
class Bundles:
    """Rows (bundle, IID, scores, y0 .., strata, covariates) and the requests of each bundle.

    The list of requests is the request table itself, a few words for each.
    """

    rows: DataFrame
    requests: dict[str, list[Request]]
    outcomes: int

    def of_tasks(self, tasks) -> list[str]:
        wanted = set(tasks)
        return sorted(b for b, some in self.requests.items() if any(r.task_id in wanted for r in some))

    def stored(self) -> Bundles:
        """The rows written once, those of a bundle next to each other.

        Spark splits partitions that come out too large and merges small ones, so one bundle may hold
        most of the rows. The order lets a later pass over some bundles skip the pages of the others.
        """
        return Bundles(clustered(self.rows, "bundle"), self.requests, self.outcomes)


def outcome_column(number: int) -> str:
    return f"y{number}"


def clustered(rows: DataFrame, key: str = "task_id") -> DataFrame:
    """Write the rows once, those of a key next to each other."""
    spread = F.pmod(F.xxhash64(PERSON), F.lit(SPREAD))
    together = rows.withColumn("spread", spread).hint("rebalance", key, "spread").drop("spread")
    return written(together.sortWithinPartitions(key), "cohort")


def of_rows(rows: DataFrame) -> Bundles:
    """Rows of requests as bundles of one score each; they are written to learn which requests there are."""
    named = rows.withColumnsRenamed({"task_id": "bundle", "y": outcome_column(0)})
    stored = clustered(named.withColumn(SCORES, F.array(SCORE)).drop(SCORE), "bundle")
    tasks = stored.select("bundle", "method").distinct().collect()
    requests = {r.bundle: [Request(r.bundle, r.method, 0, 0)] for r in tasks}
    return Bundles(stored.drop("method"), requests, 1)


def build_bundles(
    scores: DataFrame,
    demographics: DataFrame,
    tasks: DataFrame,
    cfg: EvalConfig,
    outcomes: list[str] | None = None,
    size: int = SIZE,
) -> Bundles:
    """The cohort of all requests: each score is shuffled once to its person, the demographics once per bundle.

    Scores are keyed by ``pgs`` or by ``task_id``. The join is an inner one on the person: persons that stand
    several times in the demographics, or in a score, multiply; a null person matches nobody. A score that is
    null or NaN is missing; its person stays for the formula without the score.
    """
    listed = tasks.select("task_id", "pgs", "method", "outcome").collect()
    outcomes = sorted({r.outcome for r in listed}) if outcomes is None else outcomes
    check_columns(scores, demographics, cfg, outcomes)
    key = "task_id" if "task_id" in scores.columns else "pgs"
    used = scores.where(F.col(PERSON).isNotNull()).select(key, PERSON, missing_as_null(SCORE).alias(SCORE))
    # Written, as they are read twice and may be dear to work out.
    used = written(used.join(F.broadcast(tasks.select(key).distinct()), key, "left_semi"), "scores")
    # Which persons a score has, and which of them unscored, as a count and two sums of hashes.
    entry = [F.col(PERSON), F.col(SCORE).isNull()]
    half = F.lit(1 << 31)
    seen = used.groupBy(key).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.pmod(F.xxhash64(*entry), half)).alias("a"),
        F.sum(F.pmod(F.xxhash64(F.lit(7), *entry), half)).alias("b"),
    )
    alike: dict[tuple, list[str]] = {}
    for r in seen.collect():
        alike.setdefault((r["n"], r["a"], r["b"]), []).append(r[key])
    slots, requests = [], {}
    for keys in sorted(sorted(k) for k in alike.values()):
        for at in range(0, len(keys), size):
            name = f"bundle-{len(requests)}"
            some = keys[at : at + size]
            slots += [(k, name, slot, len(some)) for slot, k in enumerate(some)]
            place = {k: slot for slot, k in enumerate(some)}
            requests[name] = [
                Request(r.task_id, r.method, place[r[key]], outcomes.index(r.outcome)) for r in listed if r[key] in place
            ]
    places = scores.sparkSession.createDataFrame(slots, f"{key} string, bundle string, slot int, wide int")
    placed = used.join(F.broadcast(places), key)
    entries = placed.groupBy(PERSON, "bundle").agg(
        F.sort_array(F.collect_list(F.struct("slot", SCORE))).alias("entries"), F.max("wide").alias("wide")
    )
    # A person with several rows of a score has as many rows here.
    copies = entries.withColumn("copies", F.expr("cast(size(entries) div wide as int)"))
    each = copies.withColumn("nth", F.explode(F.expr("sequence(0, copies - 1)")))
    entry_at = "entries[k * copies + nth]"
    array = (
        f"transform(sequence(0, wide - 1), k -> if({entry_at}.slot = k, {entry_at}.{SCORE}, "
        "cast(raise_error('scores of a bundle differ in their persons') as double)))"
    )
    people = demographics.select(
        PERSON,
        *(missing_as_null(c).alias(outcome_column(i)) for i, c in enumerate(outcomes)),
        *person_columns(demographics, cfg),
    )
    return Bundles(each.select(PERSON, "bundle", F.expr(array).alias(SCORES)).join(people, PERSON), requests, len(outcomes))


def request_rows(bundles: Bundles, cfg: EvalConfig, method: str) -> DataFrame:
    """Score, outcome, strata and completeness of covariates for every request of a method; no covariates."""
    from cohortscope.operators.strata import with_completeness

    wanted = [
        (name, [(r.task_id, r.slot, r.outcome) for r in some if r.method == method])
        for name, some in bundles.requests.items()
        if any(r.method == method for r in some)
    ]
    spark = bundles.rows.sparkSession
    listed = spark.createDataFrame(wanted, "bundle string, wanted array<struct<task_id: string, slot: int, outcome: int>>")
    strata = [stratum_column(s) for s in cfg.strata]
    ys = ", ".join(outcome_column(i) for i in range(bundles.outcomes))
    flagged = with_completeness(bundles.rows, cfg).select(
        "bundle", SCORES, F.expr(f"array({ys})").alias("ys"), "ok_with_sex", "ok_without_sex", *strata
    )
    each = f"transform(wanted, w -> struct(w.task_id as task_id, {SCORES}[w.slot] as {SCORE}, ys[w.outcome] as y))"
    # Spark cannot tell that the list is small; shuffled by bundle, the rows of one would lie in one task.
    return flagged.join(F.broadcast(listed), "bundle").select(F.inline(F.expr(each)), "ok_with_sex", "ok_without_sex", *strata)
