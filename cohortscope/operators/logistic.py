"""Penalised logistic models of all cells at once.

Objective per model: log-loss plus half the squared raw-scale coefficients times 1/C, intercept free.
Each Newton step is one pass: tasks add up loss, gradient, Hessian and label counts per model, Spark
sums them, and the steps are solved in parallel. Only one short vector per model reaches the driver,
for at most ``models_per_round`` models of a round.
"""

from __future__ import annotations

from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortscope.config import BOTH, COVARIATES_ONLY, LOGISTIC, PRS_ONLY, EvalConfig
from cohortscope.operators.bundles import Bundles
from cohortscope.operators.design import (
    COMPLETE,
    NO_SCORE,
    SCORE_ONLY,
    Design,
    Scale,
    bundle_rows,
    input_columns,
)
from cohortscope.operators.moments import FLUSH_BYTES, triangle, unfold
from cohortscope.plans.scratch import scratch_path
from cohortscope.plans.ship import ship
from cohortscope.plans.vectors import BLOCK_FIELDS, as_matrix, blocks, sum_vectors

# Loss and label counts at the head of each emitted vector.
HEAD = ("loss", "tp", "fp", "tn", "fn")
COUNT_FIELDS = (
    "task_id string, set_id int, group_one string, group_two string, formula string, "
    "tp long, fp long, tn long, fn long, iterations int, converged boolean, coefficients array<double>"
)
USED = {
    PRS_ONLY: (COMPLETE, SCORE_ONLY),
    BOTH: (COMPLETE,),
    COVARIATES_ONLY: (COMPLETE, NO_SCORE),
}


def logistic_gate(cfg: EvalConfig):
    return (F.col("n") > cfg.logistic_min_n) & (F.col("y_sum") > cfg.min_cases)


def model_sums(x: np.ndarray, y: np.ndarray, beta: np.ndarray) -> np.ndarray:
    """Loss, label counts, gradient and upper triangle of the Hessian of one model's rows."""
    eta = x @ beta
    tail = np.exp(-np.abs(eta))
    share = 1.0 / (1.0 + tail)
    hit = eta > 0
    residual = y - np.where(hit, share, tail * share)
    scaled = x * (np.sqrt(tail) * share)[:, None]
    loss = np.maximum(eta, 0.0).sum() + np.log1p(tail).sum() - y @ eta
    tp, positives, cases = y[hit].sum(), hit.sum(), y.sum()
    fn = cases - tp
    head = (loss, tp, positives - tp, len(y) - positives - fn, fn)
    return np.concatenate([head, residual @ x, (scaled.T @ scaled)[triangle(len(beta))]])


def _passes(bundles: Bundles, design: Design, scales: dict[str, Scale], models: list, state: dict, cfg):
    """Loss, gradient, Hessian and label counts of the active models, solved for their next step."""
    ship(bundles.rows.sparkSession)
    sc = bundles.rows.sparkSession.sparkContext
    wanted: dict = {}
    for m in np.flatnonzero(state["active"]):
        task, set_id, one, two, formula = models[m][:5]
        cells = wanted.setdefault(task, {}).setdefault((set_id, formula), {})
        cells[(one, two)] = int(m)
    shared = sc.broadcast(
        {
            "wanted": wanted,
            "beta": state["beta"],
            "penalty": state["penalty"],
            "range": state["range"],
            "scales": {t: scales[t] for t in wanted},
            "requests": {
                name: some for name in bundles.of_tasks(wanted) if (some := [r for r in bundles.requests[name] if r.task_id in wanted])
            },
        }
    )
    sets, outcomes = cfg.strata_sets(), bundles.outcomes
    columns = {(f, sex): design.columns(f, sex) for f in cfg.formulas for sex in (True, False)}

    def partial(batches):
        mine = shared.value
        sums: dict = {}
        held = 0
        for part in bundle_rows(batches, design, mine["scales"], mine["requests"], outcomes, cfg):
            for request in sorted(mine["requests"][part.bundle], key=lambda r: r.target):
                active, scale = mine["wanted"][request.task_id], mine["scales"][request.task_id]
                rows = part.target(request, scale)
                part.z[:, 0] = part.score(request, scale)
                for s in sets:
                    if not any((s.set_id, f) in active for f in cfg.formulas):
                        continue
                    order, starts, labels = rows.cuts(s)
                    z = part.z.take(order, axis=0)
                    cls = rows.classes[s.use_sex][order]
                    mixed = cls.any()
                    for a, b, label in zip(starts, np.r_[starts[1:], len(order)], labels):
                        for formula in cfg.formulas:
                            model = active.get((s.set_id, formula), {}).get(label)
                            if model is None:
                                continue
                            cell = z[a:b]
                            if mixed:
                                cell = cell[np.isin(cls[a:b], USED[formula])]
                            first, last = columns[formula, s.use_sex]
                            value = model_sums(
                                cell[:, first:last], cell[:, -1], mine["beta"][model, : last - first]
                            )
                            if model in sums:
                                sums[model] += value
                            else:
                                sums[model] = value
                                held += value.nbytes
            if held > FLUSH_BYTES:
                yield from _emit(sums)
                sums, held = {}, 0
        if sums:
            yield from _emit(sums)

    def solve(batches):
        mine = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            model = batch.column("model").to_numpy()
            widths = mine["range"][model, 1] - mine["range"][model, 0]
            for width in np.unique(widths):
                at = np.flatnonzero(widths == width)
                ids = model[at]
                i, j = triangle(width)
                vectors = as_matrix(
                    batch.column("vector").take(pa.array(at)), len(HEAD) + width + len(i)
                )
                beta = mine["beta"][ids, :width]
                penalty = mine["penalty"][ids, :width]
                gradient = vectors[:, len(HEAD) : len(HEAD) + width] - penalty * beta
                hessian = unfold(vectors[:, len(HEAD) + width :], width)
                d = np.arange(width)
                hessian[:, d, d] += penalty + 1e-10
                step = np.linalg.solve(hessian, gradient[:, :, None])[:, :, 0]
                loss = vectors[:, 0] + 0.5 * np.einsum("mi,mi->m", penalty, beta * beta)
                out = {"model": pa.array(ids.astype(np.int32)), "loss": pa.array(loss)}
                for c, name in enumerate(HEAD[1:], 1):
                    out[name] = pa.array(np.rint(vectors[:, c]).astype(np.int64))
                out["step"] = pa.array(list(step))
                yield pa.RecordBatch.from_pydict(out)

    needed = bundles.rows.where(F.col("bundle").isin(*bundles.of_tasks(wanted)))
    needed = needed.select(*input_columns(bundles, design, cfg))
    vectors = sum_vectors(needed.mapInArrow(partial, "model int, " + BLOCK_FIELDS), ["model"])
    steps = vectors.mapInArrow(
        solve,
        "model int, loss double, tp long, fp long, tn long, fn long, step array<double>",
    ).toArrow()
    shared.destroy()
    return steps


def _emit(sums: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
    """Vectors of equal length go out together."""
    for length in {len(v) for v in sums.values()}:
        ids = np.array([m for m, v in sums.items() if len(v) == length], dtype=np.int32)
        row, columns = blocks(np.array([sums[m] for m in ids]))
        yield pa.RecordBatch.from_pydict({"model": pa.array(ids[row])} | columns)


def _fit(bundles: Bundles, design: Design, scales: dict[str, Scale], models: list, cfg: EvalConfig):
    """Newton iteration with step halving; returns the state after the last accepted step."""
    count, width = len(models), design.outcome
    use_sex = [s.use_sex for s in cfg.strata_sets()]
    state = {
        "beta": np.zeros((count, width)),
        "penalty": np.zeros((count, width)),
        "range": np.zeros((count, 2), dtype=int),
        "active": np.ones(count, bool),
    }
    for m, (task, set_id, _, _, formula, start) in enumerate(models):
        first, last = design.columns(formula, use_sex[set_id])
        state["range"][m] = first, last
        state["beta"][m, : last - first] = start
        raw = np.ones(width)
        raw[0] = scales[task].scale[0]
        raw[design.numeric_at] = scales[task].scale[1:-1]
        penalty = 1.0 / (cfg.inverse_penalty * raw[first:last] ** 2)
        penalty[design.intercept(formula)] = 0.0
        state["penalty"][m, : last - first] = penalty
    accepted = state["beta"].copy()
    best = np.full(count, np.inf)
    counts = np.zeros((count, 4), dtype=np.int64)
    iterations = np.zeros(count, dtype=int)
    converged = np.zeros(count, bool)
    for _ in range(cfg.max_iter):
        if not state["active"].any():
            break
        result = _passes(bundles, design, scales, models, state, cfg)
        ids = result["model"].to_numpy()
        loss = result["loss"].to_numpy()
        labels = np.column_stack([result[c].to_numpy() for c in HEAD[1:]])
        iterations[ids] += 1
        steps = result["step"].combine_chunks()
        lengths = steps.value_lengths().to_numpy()
        step = np.zeros((len(ids), width))
        for length in np.unique(lengths):
            at = np.flatnonzero(lengths == length)
            step[at, :length] = as_matrix(steps.take(pa.array(at)), length)
        better = loss <= best[ids] + 1e-10 * (1.0 + np.abs(loss))
        settled = better & (np.abs(step).max(axis=1) < cfg.tolerance)
        taken = ids[better]
        accepted[taken] = state["beta"][taken]
        best[taken] = loss[better]
        counts[taken] = labels[better]
        state["active"][ids[settled]] = False
        converged[ids[settled]] = True
        moved = better & ~settled
        state["beta"][ids[moved]] += step[moved]
        worse = ids[~better]
        state["beta"][worse] = (state["beta"][worse] + accepted[worse]) / 2.0
    return accepted, counts, iterations, converged


def fit_logistic(
    bundles: Bundles, models: DataFrame, design: Design, scales: dict[str, Scale], cfg: EvalConfig
) -> DataFrame:
    """Label counts of every gated logistic model; ``models`` is the table of ``solve_cells``.

    Requests are taken in rounds so that the coefficients on the driver stay within a fixed size, and some rounds
    (``rounds_in_flight``) run at the same time, each in a scheduler pool of its own. Models with one class only are
    not fitted.
    """
    spark = bundles.rows.sparkSession
    gated = models.where((F.col("method") == LOGISTIC) & logistic_gate(cfg) & (F.col("n") > F.col("y_sum")))
    path = scratch_path(spark, "label-counts")
    spark.createDataFrame([], COUNT_FIELDS).write.parquet(f"{path}/none")
    sizes = {
        r.task_id: r["count"]
        for r in gated.groupBy("task_id").count().collect()
    }
    rounds: list[list[str]] = []
    room = 0
    for task, size in sorted(sizes.items()):
        if not rounds or size > room:
            rounds.append([])
            room = cfg.models_per_round
        rounds[-1].append(task)
        room -= size
    def fit_round(number: int) -> None:
        # With fair scheduling, the short passes of one round do not wait for the long ones of another.
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"round-{number}")
        wanted = gated.where(F.col("task_id").isin(*rounds[number])).select(
            "task_id", "set_id", "group_one", "group_two", "formula", "start"
        )
        batch: list = []
        # Folders of their own, as the rounds write at the same time.
        folders = (f"{path}/round-{number}-{k}" for k in count())
        for row in wanted.toLocalIterator():
            batch.append(tuple(row))
            if len(batch) == cfg.models_per_round:
                _save(bundles, design, scales, batch, cfg, next(folders))
                batch = []
        if batch:
            _save(bundles, design, scales, batch, cfg, next(folders))

    # Each pass of a round waits for its slowest task and for the steps; passes of other rounds fill the gaps.
    if rounds:
        with ThreadPoolExecutor(min(cfg.rounds_in_flight, len(rounds))) as threads:
            for done in [threads.submit(inheritable_thread_target(spark)(fit_round), number) for number in range(len(rounds))]:
                done.result()
    return spark.read.schema(COUNT_FIELDS).option("recursiveFileLookup", "true").parquet(path)


def _save(bundles, design, scales, models, cfg, path) -> None:
    accepted, counts, iterations, converged = _fit(bundles, design, scales, models, cfg)
    use_sex = [s.use_sex for s in cfg.strata_sets()]
    out = []
    for m, (task, set_id, one, two, formula, _) in enumerate(models):
        first, last = design.columns(formula, use_sex[set_id])
        coefficients = accepted[m, : last - first].tolist()
        out.append(
            (task, set_id, one, two, formula, *counts[m].tolist(), int(iterations[m]), bool(converged[m]), coefficients)
        )
    bundles.rows.sparkSession.createDataFrame(out, COUNT_FIELDS).coalesce(1).write.parquet(path)

