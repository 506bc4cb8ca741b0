"""The design matrix of a bundle's rows, built from Arrow batches inside a Spark task."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from cohortscope.config import BOTH, COVARIATES_ONLY, LOGISTIC, PRS_ONLY, EvalConfig, StrataSet
from cohortscope.operators.bundles import SCORES, Bundles, Request, outcome_column
from cohortscope.operators.cohort import stratum_column

# Rows of a cell fall into three classes; a formula uses two of them at most.
COMPLETE, SCORE_ONLY, NO_SCORE = 0, 1, 2
MIN_CHUNK = 32_768


@dataclass(frozen=True)
class Design:
    """Columns SCORE, intercept, covariates, 0/1 columns of text covariates (sex last), outcome.

    Every formula then uses one contiguous range of columns.
    """

    numeric: tuple[str, ...]
    levels: tuple[tuple[str, tuple[str, ...]], ...]
    sex: str | None

    @property
    def sex_width(self) -> int:
        if self.sex is None:
            return 0
        return next((len(v) for name, v in self.levels if name == self.sex), 1)

    @property
    def outcome(self) -> int:
        return 2 + len(self.numeric) + sum(len(v) for _, v in self.levels)

    @property
    def width(self) -> int:
        return self.outcome + 1

    @property
    def numeric_at(self) -> list[int]:
        """Positions of the numeric covariates; a numeric sex covariate also comes last."""
        at = list(range(2, 2 + len(self.numeric)))
        if self.sex in self.numeric:
            at[self.numeric.index(self.sex)] = self.outcome - 1
        return at

    def columns(self, formula: str, use_sex: bool) -> tuple[int, int]:
        last = self.outcome - (0 if use_sex else self.sex_width)
        return {PRS_ONLY: (0, 2), BOTH: (0, last), COVARIATES_ONLY: (1, last)}[formula]

    @staticmethod
    def intercept(formula: str) -> int:
        """Position of the intercept within the formula's range."""
        return 0 if formula == COVARIATES_ONLY else 1


@dataclass(frozen=True)
class Scale:
    """Shift and scale of the score, the numeric covariates and the outcome, for one request."""

    shift: np.ndarray
    scale: np.ndarray
    logistic: bool


def make_design(rows: DataFrame, cfg: EvalConfig) -> Design:
    """Numeric covariates as they are, text covariates by all of their levels."""
    text = {f.name for f in rows.schema if isinstance(f.dataType, StringType)}
    sex = cfg.sex_covariate if cfg.uses_sex else None
    names = sorted((c for c in cfg.covariates), key=lambda c: c == sex)
    levels = []
    for name in (c for c in names if c in text):
        # Each level is a column of the model; their number is a setting and is checked.
        seen = rows.where(F.col(name).isNotNull()).select(name).distinct().limit(cfg.max_levels + 1)
        values = tuple(sorted(r[0] for r in seen.collect()))
        if len(values) > cfg.max_levels:
            raise ValueError(f"text covariate {name} has more than max_levels = {cfg.max_levels} levels")
        levels.append((name, values))
    return Design(tuple(c for c in names if c not in text), tuple(levels), sex)


def request_scales(bundles: Bundles, design: Design) -> dict[str, Scale]:
    """Mean and spread per request, taken per bundle and score. Any shift and scale gives the same models."""
    rows, ys = bundles.rows, [outcome_column(i) for i in range(bundles.outcomes)]
    columns = [*design.numeric, *ys]
    stats = rows.groupBy("bundle").agg(
        *(F.expr(f"avg(`{c}`) as m{i}") for i, c in enumerate(columns)),
        *(F.expr(f"avg(`{c}` * `{c}`) as q{i}") for i, c in enumerate(columns)),
        *(F.expr(f"count_if({y} not in (0, 1)) as other_{y}") for y in ys),
    )
    each = rows.select("bundle", F.posexplode(SCORES).alias("slot", "s")).groupBy("bundle", "slot")
    score_stats = {(r.bundle, r.slot): (r.m, r.q) for r in each.agg(F.expr("avg(s) as m"), F.expr("avg(s * s) as q")).collect()}
    scales = {}
    for row in stats.collect():
        for request in bundles.requests[row.bundle]:
            logistic = request.method == LOGISTIC
            outcome = outcome_column(request.outcome)
            if logistic and row[f"other_{outcome}"]:
                raise ValueError(f"{request.task_id}: the outcome of a logistic request must be 0 or 1")
            at = [*range(len(design.numeric)), columns.index(outcome)]
            mean, square = score_stats[row.bundle, request.slot]
            shift = np.array([mean or 0.0, *(row[f"m{i}"] or 0.0 for i in at)])
            square = np.array([square or 0.0, *(row[f"q{i}"] or 0.0 for i in at)])
            spread = square - shift * shift
            scale = np.sqrt(np.where(spread > 1e-12 * square, spread, 1.0))
            if logistic:
                shift[-1], scale[-1] = 0.0, 1.0
            scales[request.task_id] = Scale(shift, scale, logistic)
    return scales


def input_columns(bundles: Bundles, design: Design, cfg: EvalConfig, extra: Iterable[str] = ()) -> list[str]:
    return [
        "bundle",
        SCORES,
        *(outcome_column(i) for i in range(bundles.outcomes)),
        *design.numeric,
        *(name for name, _ in design.levels),
        *(stratum_column(s) for s in cfg.strata),
        *extra,
    ]


@dataclass
class TargetRows:
    """Rows of a bundle for one outcome: groups per stratum, row class with and without sex."""

    groups: dict[str, tuple[np.ndarray, list[str]]]
    classes: dict[bool, np.ndarray]
    known: dict[int, tuple] = field(default_factory=dict)

    def cuts(self, s: StrataSet) -> tuple[np.ndarray, np.ndarray, list[tuple[str, str]]]:
        """Rows sorted by cell: (row numbers, start of each cell, group names of each cell)."""
        if s.set_id not in self.known:
            self.known[s.set_id] = self._cuts(s)
        return self.known[s.set_id]

    def _cuts(self, s: StrataSet) -> tuple[np.ndarray, np.ndarray, list[tuple[str, str]]]:
        codes, names = self.groups[s.one]
        if s.two is None:
            cell, second = codes.copy(), [""]
        else:
            other, second = self.groups[s.two]
            cell = np.where((codes < 0) | (other < 0), -1, codes * len(second) + other)
        cell[self.classes[s.use_sex] < 0] = -1
        if len(names) * len(second) < 32_000:
            cell = cell.astype(np.int16)
        order = np.argsort(cell, kind="stable")
        order = order[np.searchsorted(cell[order], 0) :]
        sorted_cells = cell[order]
        starts = np.flatnonzero(np.r_[True, sorted_cells[1:] != sorted_cells[:-1]][: len(order)])
        labels = [
            (names[c // len(second)], second[c % len(second)]) for c in sorted_cells[starts].astype(int)
        ]
        return order, starts, labels


@dataclass
class BundleRows:
    """Rows of one bundle: matrix (its score and outcome columns stay open), scores and outcomes.

    What the requests of a target share, the cells of all rows, is worked out once.
    """

    bundle: str
    z: np.ndarray
    scores: np.ndarray
    score_ok: np.ndarray
    outcomes: np.ndarray
    complete: dict[bool, np.ndarray]
    groups: dict[str, tuple[np.ndarray, list[str]]]
    held: np.ndarray | None
    targets: dict[tuple[int, bool], TargetRows] = field(default_factory=dict)

    def target(self, request: Request, scale: Scale) -> TargetRows:
        """Put the request's outcome into the matrix; its rows' classes and cells."""
        y = (self.outcomes[:, request.outcome] - scale.shift[-1]) / scale.scale[-1]
        y_ok = ~np.isnan(y)
        self.z[:, -1] = np.where(y_ok, y, 0.0)
        if request.target not in self.targets:
            classes = {}
            for use_sex, ok in self.complete.items():
                cls = np.full(len(y), -1)
                cls[y_ok & self.score_ok & ok] = COMPLETE
                cls[y_ok & self.score_ok & ~ok] = SCORE_ONLY
                cls[y_ok & ~self.score_ok & ok] = NO_SCORE
                classes[use_sex] = cls
            self.targets[request.target] = TargetRows(self.groups, classes)
        return self.targets[request.target]

    def score(self, request: Request, scale: Scale) -> np.ndarray:
        """The request's scores, 0 for a missing one."""
        return np.where(self.score_ok, (self.scores[:, request.slot] - scale.shift[0]) / scale.scale[0], 0.0)


def _codes(column: pa.ChunkedArray) -> tuple[np.ndarray, list]:
    encoded = column.combine_chunks().dictionary_encode()
    if isinstance(encoded, pa.ChunkedArray):
        encoded = encoded.combine_chunks()
    codes = encoded.indices.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
    return codes, encoded.dictionary.to_pylist()


def _chunks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Arrow batches put together to a size at which numpy pays off."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) >= MIN_CHUNK:
            yield pa.Table.from_batches(held)
            held = []
    if held:
        yield pa.Table.from_batches(held)


def bundle_rows(
    batches: Iterable[pa.RecordBatch],
    design: Design,
    scales: dict[str, Scale],
    requests: dict[str, list[Request]],
    outcomes: int,
    cfg: EvalConfig,
) -> Iterator[BundleRows]:
    """Decode Arrow batches: the rows of every bundle that has requests."""
    for table in _chunks(batches):
        bundle_codes, names = _codes(table["bundle"])
        numbers = [table[c].to_numpy().astype(float) for c in design.numeric]
        numbers = np.column_stack(numbers) if numbers else np.zeros((table.num_rows, 0))
        ys = np.column_stack([table[outcome_column(i)].to_numpy().astype(float) for i in range(outcomes)])
        lists = pa.concat_arrays(table[SCORES].chunks)
        text = {name: _codes(table[name]) for name, _ in design.levels}
        strata = {s: _codes(table[stratum_column(s)]) for s in cfg.strata}
        held = table["held"].to_numpy() if "held" in table.column_names else None
        for code, name in enumerate(names):
            if not requests.get(name):
                continue
            # Covariates are scaled alike for all requests of a bundle.
            scale = scales[requests[name][0].task_id]
            pick = np.flatnonzero(bundle_codes == code)
            x = (numbers[pick] - scale.shift[1:-1]) / scale.scale[1:-1]
            missing = np.isnan(x)
            x[missing] = 0.0
            z = np.zeros((len(pick), design.width))
            z[:, 1] = 1.0
            z[:, design.numeric_at] = x
            at = 2 + len(design.numeric) - (design.sex in design.numeric)
            lacking = {name: missing[:, i] for i, name in enumerate(design.numeric)}
            for column, levels in design.levels:
                codes, seen = text[column]
                position = {level: i for i, level in enumerate(levels)}
                # One further slot for a missing value, which the code -1 picks.
                lookup = np.array([*(position.get(v, -1) for v in seen), -1])
                level = lookup[codes[pick]]
                z[:, at : at + len(levels)] = level[:, None] == np.arange(len(levels))
                lacking[column] = level < 0
                at += len(levels)
            complete = {}
            for use_sex in (True, False):
                complete[use_sex] = np.ones(len(pick), bool)
                for column, lacks in lacking.items():
                    if use_sex or column != design.sex:
                        complete[use_sex] &= ~lacks
            scores = lists.take(pa.array(pick)).flatten().to_numpy(zero_copy_only=False).reshape(len(pick), -1)
            empty = np.isnan(scores)
            if (empty != empty[:, :1]).any():
                raise ValueError(f"scores of {name} are missing for different persons")
            groups = {s: (codes[pick], values) for s, (codes, values) in strata.items()}
            yield BundleRows(
                name, z, scores, ~empty[:, 0], ys[pick], complete, groups, None if held is None else held[pick].astype(bool)
            )
