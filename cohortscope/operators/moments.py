"""Second moments of every request and cell in one pass over the cohort.

Each task adds up small matrices per cell and row class, once for all requests of a bundle, and a border for
each request; these are then summed by Spark. The shuffle depends on cells and columns, not on persons, and a
cell of any size stays spread out.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortscope.config import EvalConfig
from cohortscope.operators.bundles import Bundles, Request
from cohortscope.operators.design import NO_SCORE, Design, Scale, bundle_rows, input_columns
from cohortscope.operators.strata import CELL
from cohortscope.plans.scratch import written
from cohortscope.plans.ship import ship
from cohortscope.plans.vectors import BLOCK_FIELDS, blocks, sum_vectors

# Partial sums a Python worker may hold before it hands them on.
FLUSH_BYTES = 64 << 20


@lru_cache(maxsize=64)
def triangle(width: int) -> tuple[np.ndarray, np.ndarray]:
    return np.triu_indices(width)


def unfold(vectors: np.ndarray, width: int) -> np.ndarray:
    """Symmetric matrices from rows of upper triangles."""
    i, j = triangle(width)
    out = np.zeros((len(vectors), width, width))
    out[:, i, j] = vectors
    out[:, j, i] = vectors
    return out


# Keys of a moment vector; ``request`` is a place in the target's list of requests, or SHARED.
KEYS = ["bundle", "outcome", "logistic", *CELL, "request"]
SHARED = -1


def targets_of(requests: list[Request]) -> dict[tuple[int, bool], list[Request]]:
    """A bundle's requests by outcome and scaling, in a fixed order."""
    out: dict[tuple[int, bool], list[Request]] = {}
    for r in sorted(requests, key=lambda r: (r.target, r.slot, r.task_id)):
        out.setdefault(r.target, []).append(r)
    return out


def _emit(sums: dict) -> Iterator[pa.RecordBatch]:
    """One row of vectors for what a cell's requests share, one for each request's border."""
    types = (pa.string(), pa.int32(), pa.bool_(), pa.int32(), pa.string(), pa.string(), pa.int32(), pa.bool_())
    names = ("bundle", "outcome", "logistic", *CELL, "class", "held")
    parts = {"shared": [], "border": []}
    for key, (shared, border) in sums.items():
        parts["shared"].append((key, SHARED, shared))
        if border is not None:
            parts["border"] += [(key, i, vector) for i, vector in enumerate(border)]
    for some in parts.values():
        # In slices, as the blocks of all borders together are as large as the sums themselves.
        for at in range(0, len(some), 4096):
            piece = some[at : at + 4096]
            row, columns = blocks(np.array([v for _, _, v in piece]))
            take = pa.array(row)
            data = {
                name: pa.array([k[i] for k, _, _ in piece], kind).take(take)
                for i, (name, kind) in enumerate(zip(names, types))
            }
            data["request"] = pa.array([r for _, r, _ in piece], pa.int32()).take(take)
            yield pa.RecordBatch.from_pydict(data | columns)


def cell_moments(
    bundles: Bundles, design: Design, scales: dict[str, Scale], cfg: EvalConfig, holdout: bool = False
) -> DataFrame:
    """Moments per bundle, target and cell: bordered Gram matrices.

    The moments of intercept, covariates and outcome are the same for all requests of a bundle with one target:
    ``c0``, ``c1``, ``c2`` by row class. A request adds the border of its score: the score's square and its
    products with all other columns, in ``borders`` (request, c0, c1). So a request's share of the shuffle is
    in proportion to the columns, not to their square. With ``holdout`` the rows flagged ``held`` are summed
    apart, as ``h0``, ``h1``, ``h2``.
    """
    ship(bundles.rows.sparkSession)
    shared = bundles.rows.sparkSession.sparkContext.broadcast((scales, bundles.requests))
    sets, outcomes = cfg.strata_sets(), bundles.outcomes
    i, j = triangle(design.width - 1)

    def partial(batches):
        known, requests = shared.value
        sums: dict = {}
        size = 0
        for part in bundle_rows(batches, design, known, requests, outcomes, cfg):
            for (outcome, logistic), some in targets_of(requests[part.bundle]).items():
                rows = part.target(some[0], known[some[0].task_id])
                scores = np.column_stack([part.score(r, known[r.task_id]) for r in some])
                for s in sets:
                    order, starts, labels = rows.cuts(s)
                    z, score = part.z[:, 1:].take(order, axis=0), scores.take(order, axis=0)
                    cls = rows.classes[s.use_sex][order]
                    if part.held is not None:
                        cls = cls + 3 * part.held[order]
                    mixed = cls.any()
                    ends = np.r_[starts[1:], len(order)]
                    for a, b, (one, two) in zip(starts, ends, labels):
                        for c in np.unique(cls[a:b]) if mixed else (0,):
                            here = slice(a, b) if not mixed else a + np.flatnonzero(cls[a:b] == c)
                            x, t = z[here], score[here]
                            key = (part.bundle, outcome, logistic, s.set_id, one, two, int(c) % 3, bool(c >= 3))
                            gram = (x.T @ x)[i, j]
                            border = None
                            if c % 3 != NO_SCORE:
                                border = np.column_stack([(t * t).sum(axis=0), t.T @ x])
                            if key in sums:
                                for total, more in zip(sums[key], (gram, border)):
                                    if more is not None:
                                        total += more
                            else:
                                sums[key] = (gram, border)
                                size += gram.nbytes + (0 if border is None else border.nbytes)
                    if size > FLUSH_BYTES:
                        yield from _emit(sums)
                        sums, size = {}, 0
        if sums:
            yield from _emit(sums)

    schema = (
        "bundle string, outcome int, logistic boolean, set_id int, group_one string, group_two string, class int, "
        "held boolean, request int, " + BLOCK_FIELDS
    )
    needed = bundles.rows.select(*input_columns(bundles, design, cfg, ["held"] if holdout else []))
    parts = {f"c{c}": f"class = {c} and not held" for c in range(3)}
    if holdout:
        parts |= {f"h{c}": f"class = {c} and held" for c in range(3)}
    summed = written(sum_vectors(needed.mapInArrow(partial, schema), KEYS, parts), "moments")
    scored = [name for name in parts if name[1] != str(NO_SCORE)]
    borders = summed.where(F.col("request") != SHARED).groupBy(*KEYS[:-1]).agg(
        F.sort_array(F.collect_list(F.struct("request", *scored))).alias("borders")
    )
    return summed.where(F.col("request") == SHARED).drop("request").join(borders, KEYS[:-1], "left")
