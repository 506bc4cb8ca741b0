"""Models of every cell from its moments: least squares, sizes and score moments."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortscope.config import BOTH, COVARIATES_ONLY, LINEAR, LOGISTIC, PRS_ONLY, EvalConfig
from cohortscope.operators.bundles import Bundles
from cohortscope.operators.design import NO_SCORE, Design, Scale
from cohortscope.operators.moments import targets_of, triangle, unfold
from cohortscope.operators.strata import CELL
from cohortscope.plans.ship import ship
from cohortscope.plans.vectors import as_matrix

# Directions of the correlation matrix below this share are taken as collinear.
RANK_TOLERANCE = 1e-10
CONSTANT_TOLERANCE = 1e-12
# Matrices that are solved together take so much memory.
SOLVED_BYTES = 32 << 20
CLASSES = {PRS_ONLY: (0, 1), BOTH: (0,), COVARIATES_ONLY: (0, 2)}

MODEL_FIELDS = (
    "task_id string, set_id int, group_one string, group_two string, method string, formula string, n long, "
    "y_sum double, mean_score double, var_score double, rsq double, mse double, "
    "held long, held_rsq double, held_mse double, start array<double>"
)


def least_squares(gram: np.ndarray, one: int) -> tuple[np.ndarray, ...]:
    """Solve many small systems at once.

    ``gram`` holds moments of [columns, outcome]; ``one`` is the position of the constant column.
    Returns slopes (zero for the constant column), R2, residual and total sum of squares, and the
    centred moments.
    """
    n = gram[:, one, one]
    mean = gram[:, one, :] / n[:, None]
    centred = gram - n[:, None, None] * mean[:, :, None] * mean[:, None, :]
    spread = np.einsum("mii->mi", centred).copy()
    raw = np.einsum("mii->mi", gram)
    flat = spread <= CONSTANT_TOLERANCE * raw
    spread[flat] = 0.0
    scale = np.where(flat, 1.0, np.sqrt(np.where(flat, 1.0, spread)))
    corr = centred / (scale[:, :, None] * scale[:, None, :])
    corr[flat] = 0.0
    corr.transpose(0, 2, 1)[flat] = 0.0
    x, r = corr[:, :-1, :-1], corr[:, :-1, -1]
    values, vectors = np.linalg.eigh(x)
    kept = values > RANK_TOLERANCE * x.shape[1]
    inverse = np.where(kept, 1.0 / np.where(kept, values, 1.0), 0.0)
    along = np.einsum("mij,mi->mj", vectors, r)
    total = spread[:, -1]
    constant = flat[:, -1]
    rsq = np.where(constant, 1.0, np.clip(np.einsum("mj,mj->m", along * along, inverse), 0.0, 1.0))
    slopes = np.einsum("mij,mj->mi", vectors, along * inverse) * (scale[:, -1:] / scale[:, :-1])
    return slopes, rsq, total * (1.0 - rsq), total, centred


def _held_out(gram: np.ndarray, held: np.ndarray, one: int, slopes: np.ndarray):
    """R2 and MSE on the held-out moments of the model fitted on the others."""
    mean = gram[:, one, :] / gram[:, one, one][:, None]
    full = np.concatenate([slopes, -np.ones((len(slopes), 1))], axis=1)
    full[:, one] = mean[:, -1] - np.einsum("mi,mi->m", mean[:, :-1], slopes)
    sse = np.einsum("mi,mij,mj->m", full, held, full)
    n = held[:, one, one]
    total = held[:, -1, -1] - held[:, one, -1] ** 2 / np.maximum(n, 1.0)
    with np.errstate(divide="ignore", invalid="ignore"):
        rsq = np.where(total > 0, 1.0 - sse / total, np.where(sse > 0, 0.0, 1.0))
        return n, np.where(n > 0, rsq, np.nan), np.where(n > 0, sse / n, np.nan)


def _start(slopes, sse, gram, one, n):
    """Start of the logistic iteration: the discriminant direction of the two class means."""
    cases = gram[:, one, -1]
    controls = n - cases
    two = (cases > 0) & (controls > 0)
    a, b = np.where(two, cases, 1.0), np.where(two, controls, 1.0)
    with_case = gram[:, :-1, -1] / a[:, None]
    without = (gram[:, :-1, one] - gram[:, :-1, -1]) / b[:, None]
    beta = slopes / np.maximum(sse / n, 0.02)[:, None]
    beta[:, one] = 0.0
    beta[:, one] = np.log(a / b) - 0.5 * np.einsum("mi,mi->m", with_case + without, beta)
    beta[~two] = 0.0
    return beta


def _bordered(shared: np.ndarray, borders: np.ndarray) -> np.ndarray:
    """Moments of [score, intercept, covariates, outcome] from those without the score and the score's own."""
    out = np.empty((len(borders), shared.shape[1] + 1, shared.shape[1] + 1))
    out[:, 1:, 1:] = shared
    out[:, 0, :] = borders
    out[:, :, 0] = borders
    return out


class _Cells:
    """Moments of the cells of a batch: what requests share, and each request's border with its owner."""

    def __init__(self, batch: pa.RecordBatch, width: int, requests: dict, holdout: bool):
        size = len(triangle(width - 1)[0])
        table = pa.Table.from_batches([batch])
        self.width = width
        names = ["c0", "c1", "c2", *(("h0", "h1", "h2") if holdout else ())]
        self.shared = {n: as_matrix(table[n].combine_chunks(), size) for n in names}
        lists = table["borders"].combine_chunks()
        counts = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        listed = lists.flatten()
        self.borders = {n: as_matrix(listed.field(n), width) for n in names if n[1] != str(NO_SCORE)}
        number = listed.field("request").to_numpy(zero_copy_only=False)
        borders = {(int(o), int(r)): i for i, (o, r) in enumerate(zip(np.repeat(np.arange(len(counts)), counts), number))}
        keys = zip(*(table[c].to_pylist() for c in ("bundle", "outcome", "logistic")))
        # Every request of a cell's target has a row, also where none of its persons has a score.
        owners, tasks, border = [], [], []
        for cell, (bundle, outcome, logistic) in enumerate(keys):
            for i, request in enumerate(requests[bundle][outcome, logistic]):
                owners.append(cell)
                tasks.append(request)
                border.append(borders.get((cell, i), -1))
        self.owners, self.tasks, self.border = np.array(owners, np.int64), tasks, np.array(border, np.int64)

    def parts(self, pairs: np.ndarray, classes: tuple[int, ...], name: str) -> np.ndarray:
        """Whole matrices of some requests, of rows of some classes."""
        shared = sum(self.shared[f"{name}{c}"][self.owners[pairs]] for c in classes)
        border = np.zeros((len(pairs), self.width))
        for c in classes:
            if c != NO_SCORE:
                there = self.border[pairs] >= 0
                border[there] += self.borders[f"{name}{c}"][self.border[pairs[there]]]
        return _bordered(unfold(shared, self.width - 1), border)

    def without_score(self, cells: np.ndarray, classes: tuple[int, ...], name: str) -> np.ndarray:
        """Matrices of cells; the score's row and column are empty."""
        shared = sum(self.shared[f"{name}{c}"][cells] for c in classes)
        return _bordered(unfold(shared, self.width - 1), np.zeros((len(cells), self.width)))


def _solved(whole: np.ndarray, apart: np.ndarray | None, pick: list[int], one: int) -> dict[str, np.ndarray]:
    """Fit of every matrix, in scaled units, and the counts of all rows."""
    gram = whole[:, pick][:, :, pick]
    slopes, rsq, sse, _, _ = least_squares(gram, one)
    n = gram[:, one, one]
    held, total = np.zeros((3, len(gram))), gram
    if apart is not None:
        apart = apart[:, pick][:, :, pick]
        held, total = np.array(_held_out(gram, apart, one, slopes)), gram + apart
    return {
        "rsq": rsq, "mse": sse / n, "held": held[0], "held_rsq": held[1], "held_mse": held[2],
        "count": total[:, one, one], "y_sum": total[:, one, -1], "s": total[:, 0, one], "ss": total[:, 0, 0],
        "start": _start(slopes, sse, gram, one, n),
    }


def solve_cells(
    moments: DataFrame, bundles: Bundles, design: Design, scales: dict[str, Scale], cfg: EvalConfig
) -> DataFrame:
    """One row per request, cell and formula: n, score moments, R2, MSE, start coefficients.

    The formula without the score is solved once for all requests of a bundle and target.
    """
    ship(moments.sparkSession)
    listed = {name: targets_of(some) for name, some in bundles.requests.items()}
    shared = moments.sparkSession.sparkContext.broadcast((scales, listed))
    use_sex = np.array([s.use_sex for s in cfg.strata_sets()])
    holdout = "h0" in moments.columns
    step = max(1, SOLVED_BYTES // (8 * design.width**2))

    def solve(batches):
        known, requests = shared.value
        for batch in batches:
            # A cell's requests are solved together, of so many cells that their matrices have room.
            most = max((len(some) for t in requests.values() for some in t.values()), default=1)
            cells_at_once = max(1, step // most)
            for at in range(0, batch.num_rows, cells_at_once):
                yield from solve_some(batch.slice(at, cells_at_once), known, requests)

    def solve_some(batch, known, requests):
        cells = _Cells(batch, design.width, requests, holdout)
        with_sex = use_sex[batch.column("set_id").to_numpy()]
        for formula in cfg.formulas:
            one, classes = design.intercept(formula), CLASSES[formula]
            for sex in (True, False):
                first, last = design.columns(formula, sex)
                pick = [*range(first, last), design.outcome]
                pairs = np.flatnonzero(with_sex[cells.owners] == sex)
                if formula == COVARIATES_ONLY:
                    alone, back = np.unique(cells.owners[pairs], return_inverse=True)
                    make, of = cells.without_score, alone
                else:
                    make, of, back = cells.parts, pairs, np.arange(len(pairs))
                whole = make(of, classes, "c")
                there = whole[:, 1, 1] > 0
                if not there.any():
                    continue
                place = np.cumsum(there) - 1
                apart = make(of[there], classes, "h") if holdout else None
                fit = _solved(whole[there], apart, pick, one)
                rows = np.flatnonzero(there[back])
                yield _model_rows(batch, cells, pairs[rows], {k: v[place[back[rows]]] for k, v in fit.items()}, formula, known)

    return moments.mapInArrow(solve, MODEL_FIELDS)


def _model_rows(
    batch: pa.RecordBatch, cells: _Cells, pairs: np.ndarray, fit: dict[str, np.ndarray], formula: str, known: dict[str, Scale]
) -> pa.RecordBatch:
    """Fits in the units of the data, a row for each request of ``pairs``."""
    scales = [known[cells.tasks[p].task_id] for p in pairs]
    y_shift, y_scale = (np.array([getattr(t, name)[-1] for t in scales]) for name in ("shift", "scale"))
    s_shift, s_scale = (np.array([getattr(t, name)[0] for t in scales]) for name in ("shift", "scale"))
    count = fit["count"]
    mean = var = pa.nulls(len(pairs), pa.float64())
    if formula != COVARIATES_ONLY:
        spread = (fit["ss"] - fit["s"] ** 2 / count) / np.where(count > 1, count - 1, np.nan)
        mean = pa.array(fit["s"] / count * s_scale + s_shift)
        var = pa.array(np.maximum(spread, 0.0) * s_scale**2, from_pandas=True)
    take = pa.array(cells.owners[pairs])
    return pa.RecordBatch.from_pydict(
        {
            "task_id": pa.array([cells.tasks[p].task_id for p in pairs], pa.string()),
            **{k: batch.column(k).take(take) for k in CELL},
            "method": pa.array([LOGISTIC if t.logistic else LINEAR for t in scales], pa.string()),
            "formula": pa.array([formula] * len(pairs), pa.string()),
            "n": pa.array(np.rint(count).astype(np.int64)),
            "y_sum": pa.array(fit["y_sum"] * y_scale + count * y_shift),
            "mean_score": mean,
            "var_score": var,
            "rsq": pa.array(fit["rsq"]),
            "mse": pa.array(fit["mse"] * y_scale**2),
            "held": pa.array(np.rint(fit["held"]).astype(np.int64)),
            "held_rsq": pa.array(fit["held_rsq"], from_pandas=True),
            "held_mse": pa.array(fit["held_mse"] * y_scale**2, from_pandas=True),
            "start": pa.array(list(fit["start"]), pa.list_(pa.float64())),
        }
    )


def linear_gate(cfg: EvalConfig):
    held = F.ceil(F.lit(float(cfg.test_fraction)) * F.col("n"))
    return (F.col("n") > cfg.linear_min_n) & (held > cfg.linear_min_test)
