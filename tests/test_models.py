"""The grouped engine against a plain loop over cells with numpy."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from cohortscope.config import BOTH, COVARIATES_ONLY, PRS_ONLY, EvalConfig
from cohortscope.operators.cohort import build_cohort, prepare_tasks
from cohortscope.operators.evaluate import evaluate, fit_cells, linear_report, logistic_report
from cohortscope.operators.incremental import incremental
from workload import fixtures

SF = "/root/testdata/sf0.01"
CFG = EvalConfig()
PCS = [f"pca_{i}" for i in range(1, 17)]


@pytest.fixture(scope="module")
def people(spark):
    """The cohort with missing scores, covariates and sex, and a NaN."""
    d = fixtures.cohort(spark, SF)
    iid = F.col("IID")
    return d.withColumns(
        {
            "SCORE": F.when(iid % 17 != 0, F.col("SCORE")),
            "age": F.when(iid % 19 != 0, F.col("age")),
            "pca_3": F.when(iid % 29 == 0, F.lit(float("nan"))).otherwise(F.col("pca_3")),
            "sex_at_birth": F.when(iid % 13 != 0, F.col("sex_at_birth")),
        }
    ).cache()


@pytest.fixture(scope="module")
def rows(spark, people):
    tasks = prepare_tasks(fixtures.requests(spark, fixtures.REQUESTS[:2]), CFG)
    scores = people.select("pgs", "IID", "SCORE")
    return build_cohort(scores, people.drop("pgs", "SCORE"), tasks, CFG)


@pytest.fixture(scope="module")
def fitted(rows):
    return fit_cells(rows, CFG)


def cells_of(people):
    frame = people.toPandas()
    for s in CFG.strata:
        frame[f"cut_{s}"] = frame[s].where(~frame[s].isin(CFG.ambiguous))
    for cut in CFG.strata_sets():
        keys = [f"cut_{cut.one}"] + ([f"cut_{cut.two}"] if cut.two else [])
        for group, part in frame.groupby(keys):
            group = group if isinstance(group, tuple) else (group,)
            yield cut, (cut.one, group[0], cut.two, group[1] if cut.two else None), part


def design(part, formula, use_sex, outcome):
    columns = {PRS_ONLY: ["SCORE"], BOTH: ["SCORE", "age", "agesq", *PCS], COVARIATES_ONLY: ["age", "agesq", *PCS]}
    names = columns[formula]
    sex = use_sex and formula != PRS_ONLY
    used = part[names + (["sex_at_birth"] if sex else []) + [outcome]].dropna()
    x = used[names].astype(float)
    if sex:
        x = pd.concat([x, pd.get_dummies(used["sex_at_birth"]).astype(float)], axis=1)
    return x.to_numpy(float), used[outcome].to_numpy(float), used


def by_key(report):
    return {
        (r.STRATA_ONE, r.GROUP_ONE, r.STRATA_TWO, r.GROUP_TWO, r.COVARIATES): r for r in report.collect()
    }


def test_linear_models_match_a_loop(people, fitted):
    found = by_key(linear_report(fitted, CFG))
    seen = 0
    for cut, key, part in cells_of(people):
        for formula in CFG.formulas:
            x, y, used = design(part, formula, cut.use_sex, "waist_circumference")
            row = found.pop((*key, formula), None)
            if len(y) <= 20:
                assert row is None
                continue
            seen += 1
            a = np.column_stack([np.ones(len(y)), x])
            residual = y - a @ np.linalg.lstsq(a, y, rcond=None)[0]
            sse, sst = residual @ residual, ((y - y.mean()) ** 2).sum()
            assert row.RSQ == pytest.approx(1 - sse / sst, abs=1e-8)
            assert row.MSE == pytest.approx(sse / len(y), rel=1e-6, abs=1e-6)
            assert row.N == len(y)
            assert row.TESTING_SIZE == int(np.ceil(0.2 * len(y)))
            assert row.TRAINING_SIZE + row.TESTING_SIZE == row.N
            if formula == COVARIATES_ONLY:
                assert row.MEAN_PRS is None and row.PRS_Q1 is None
            else:
                s = used["SCORE"].to_numpy(float)
                assert row.MEAN_PRS == pytest.approx(s.mean(), abs=1e-9)
                assert row.VAR_PRS == pytest.approx(s.var(ddof=1), rel=1e-9)
                assert [row.PRS_Q1, row.PRS_Q2, row.PRS_Q3] == pytest.approx(
                    list(np.quantile(s, [0.25, 0.5, 0.75])), abs=1e-9
                )
                assert row.MEDIAN_PRS == row.PRS_Q2
    assert not found and seen > 500


def newton(x, y):
    """Minimum of the penalised log-loss on the raw scale, by damped Newton steps."""
    a = np.column_stack([np.ones(len(y)), x])
    centre, scale = x.mean(0), np.where(x.std(0) > 0, x.std(0), 1.0)
    a[:, 1:] = (x - centre) / scale
    penalty = np.r_[0.0, 1.0 / scale**2]

    def loss(b):
        eta = a @ b
        return np.logaddexp(0, eta).sum() - y @ eta + 0.5 * (penalty * b * b).sum()

    b = np.zeros(a.shape[1])
    for _ in range(200):
        p = 1 / (1 + np.exp(-np.clip(a @ b, -500, 500)))
        step = np.linalg.solve(
            (a * (p * (1 - p))[:, None]).T @ a + np.diag(penalty), a.T @ (y - p) - penalty * b
        )
        t = 1.0
        while loss(b + t * step) > loss(b) + 1e-12 and t > 1e-6:
            t /= 2
        b = b + t * step
        if np.abs(step).max() < 1e-10:
            break
    return a @ b


def test_logistic_models_match_a_loop(people, fitted):
    found = by_key(logistic_report(fitted, CFG))
    seen = 0
    for cut, key, part in cells_of(people):
        for formula in CFG.formulas:
            x, y, _ = design(part, formula, cut.use_sex, "obesity")
            row = found.pop((*key, formula), None)
            if len(y) <= 20 or y.sum() <= 20:
                assert row is None
                continue
            seen += 1
            eta = newton(x, y)
            if np.abs(eta).min() < 1e-6:
                continue
            hit = eta > 0
            tp, fp = int((hit & (y == 1)).sum()), int((hit & (y == 0)).sum())
            tn, fn = int((~hit & (y == 0)).sum()), int((~hit & (y == 1)).sum())
            shown = [c if c > 20 else None for c in (tp, fp, tn, fn)]
            assert [row.TRUE_POSITIVE, row.FALSE_POSITIVE, row.TRUE_NEGATIVE, row.FALSE_NEGATIVE] == shown
            assert row.CASES == y.sum() and row.CONTROLS == (y == 0).sum()
            assert row.DISEASE_PREV == pytest.approx(y.mean())
            if tn + fp:
                assert row.AUC == pytest.approx(0.5 * (tp / (tp + fn) + tn / (tn + fp)))
    assert not found and seen > 500


def test_partitioning_and_rounds_do_not_change_results(rows):
    few = rows.where("stratum_race is not null")
    cfg = CFG.with_(strata=("race", "age_quartiles", "sex_at_birth"), covariates=("age", "sex_at_birth"))
    one = evaluate(few, cfg)
    other = evaluate(few.repartition(7).orderBy("SCORE"), cfg.with_(models_per_round=11, max_ranked=40))
    for a, b, metric in ((one.linear, other.linear, "RSQ"), (one.logistic, other.logistic, "AUC")):
        left, right = by_key(a), by_key(b)
        assert left.keys() == right.keys() and left
        for key in left:
            assert left[key][metric] == pytest.approx(right[key][metric], abs=1e-9)
            assert left[key].PRS_Q1 == pytest.approx(right[key].PRS_Q1) if left[key].PRS_Q1 is not None else True


def test_rounds_of_models_run_at_the_same_time(rows, monkeypatch):
    import threading

    from cohortscope.operators import logistic

    few = rows.where("stratum_race is not null and method = 'logistic'")
    few = few.withColumn("task_id", F.explode(F.array(*(F.lit(t) for t in "abcd"))))
    cfg = CFG.with_(strata=("race",), families=(), covariates=("age",), models_per_round=10, rounds_in_flight=2)
    inside, most, passes = set(), [0], logistic._passes

    def counted(*args):
        inside.add(threading.get_ident())
        most[0] = max(most[0], len(inside))
        try:
            return passes(*args)
        finally:
            inside.discard(threading.get_ident())

    monkeypatch.setattr(logistic, "_passes", counted)
    found = by_key_of_task(logistic_report(fit_cells(few, cfg), cfg))
    assert most[0] == 2
    # The four requests are the same, so are their rows.
    for (task, *key), row in found.items():
        assert row.AUC == found["a", *key].AUC
    assert {k[0] for k in found} == set("abcd")


def by_key_of_task(report):
    return {(r.task_id, r.GROUP_ONE, r.COVARIATES): r for r in report.collect()}


def test_incremental_is_equal_on_all_rows_of_a_cell(fitted):
    report = incremental(linear_report(fitted, CFG), "RSQ")
    cells = {}
    for r in report.collect():
        cells.setdefault((r.STRATA_ONE, r.GROUP_ONE, r.STRATA_TWO, r.GROUP_TWO), []).append(r)
    for group in cells.values():
        assert len({r.INCREMENTAL_RSQ_PRS for r in group}) == 1
        metric = {r.COVARIATES: r.RSQ for r in group}
        if BOTH in metric and COVARIATES_ONLY in metric:
            assert group[0].INCREMENTAL_RSQ_PRS == pytest.approx(metric[BOTH] - metric[COVARIATES_ONLY])
        else:
            assert group[0].INCREMENTAL_RSQ_PRS is None


def test_holdout_matches_a_loop(people, rows):
    import hashlib

    cfg = CFG.with_(strata=("race", "gender"), linear_min_n=99, linear_min_test=20)
    found = by_key(linear_report(fit_cells(rows, cfg, holdout=True), cfg, holdout=True))
    checked = 0
    for cut, key, part in cells_of(people):
        if cut.one not in cfg.strata or (cut.two and cut.two not in cfg.strata):
            continue
        for formula in cfg.formulas:
            x, y, used = design(part, formula, cut.use_sex, "waist_circumference")
            ids = part.loc[used.index, "IID"]
            held = np.array([int(hashlib.md5(f"42:{i}".encode()).hexdigest()[:8], 16) % 1000 < 200 for i in ids])
            row = found.get((*key, formula))
            if len(y) < 100 or held.sum() <= 20:
                assert row is None
                continue
            checked += 1
            a = np.column_stack([np.ones(len(y)), x])
            b = np.linalg.lstsq(a[~held], y[~held], rcond=None)[0]
            residual = y[held] - a[held] @ b
            sst = ((y[held] - y[held].mean()) ** 2).sum()
            assert row.RSQ == pytest.approx(1 - residual @ residual / sst, abs=1e-6)
            assert row.MSE == pytest.approx(residual @ residual / held.sum(), rel=1e-6)
            assert (row.TRAINING_SIZE, row.TESTING_SIZE) == ((~held).sum(), held.sum())
    assert checked > 10
