import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortscope.operators.quantiles import exact_quantiles

P = (0.0, 0.1, 0.25, 0.5, 0.75, 1.0)


def groups():
    rng = np.random.default_rng(5)
    return {
        "normal": rng.normal(size=3000),
        "ties": np.repeat([1.0, 2.0, 2.5], [1000, 1500, 3]),
        "one": np.array([4.0]),
        "constant": np.full(500, -3.25),
        "outliers": np.r_[rng.normal(size=800), 1e300, -1e300, 1e-300],
        "steps": np.exp2(np.arange(-500.0, 500.0)),
        "whole": np.arange(777.0)[::-1],
        "largest": np.r_[np.full(300, -1.7e308), np.full(300, 1.7e308), rng.normal(size=100)],
    }


@pytest.mark.parametrize("max_ranked,bins", [(10_000, 1024), (50, 16), (2, 1024)])
def test_quantiles_of_any_group_size(spark, max_ranked, bins):
    data = [(name, float(v), i % 3 == 0) for name, values in groups().items() for i, v in enumerate(values)]
    df = spark.createDataFrame(data, "g string, v double, third boolean").repartition(5)
    got = exact_quantiles(
        df, ["g"], "v", P, {"all": F.lit(True), "third": F.col("third")}, max_ranked, bins=bins
    ).collect()
    assert len(got) == 2 * len(groups())
    for row in got:
        values = groups()[row.g]
        if row["mask"] == "third":
            values = values[::3]
        # The top of the range overflows when two ends are subtracted, in numpy too.
        if row.g == "largest":
            expected = np.sort(values)[[0, -1]]
            assert [row.q[0], row.q[-1]] == list(expected)
        else:
            np.testing.assert_allclose(row.q, np.quantile(values, P), rtol=1e-12, atol=1e-300)


def test_empty_input(spark):
    df = spark.createDataFrame([], "g string, v double")
    assert exact_quantiles(df, ["g"], "v", P).count() == 0


@pytest.mark.parametrize("max_ranked", [3, 40])
def test_quartiles_from_merged_histograms(spark, max_ranked):
    """Cells whose histograms are put together have the quartiles that the built-in percentile gives."""
    from cohortscope.config import EvalConfig
    from cohortscope.operators.strata import stratum_column
    from cohortscope.operators.summary import score_quartiles

    rng = np.random.default_rng(9)
    cfg = EvalConfig().with_(strata=("race", "sex_at_birth", "education"), families=(), covariates=("age",))
    data = []
    for task, values in (("wide", np.r_[rng.normal(size=600), 1e300, -1e300]), ("ties", rng.integers(0, 5, 400) / 2.0), ("flat", np.full(90, 7.0)), ("few", np.array([3.0]))):
        for v in values:
            groups = (rng.choice(["a", "b", None], p=[0.7, 0.2, 0.1]), rng.choice(["x", "y"]), rng.choice(["p", "q", "r", "s"]))
            data.append((task, float(v) if rng.random() > 0.05 else None, 1.0 if rng.random() > 0.05 else None, *map(lambda g: None if g is None else str(g), groups), 5.0 if rng.random() > 0.1 else None))
    names = ", ".join(f"{stratum_column(s)} string" for s in cfg.strata)
    rows = spark.createDataFrame(data, f"task_id string, SCORE double, y double, {names}, age double").withColumn("sex_at_birth", F.lit("z"))
    key = ["task_id", "set_id", "group_one", "group_two", "formula"]

    def table(config, largest):
        return {tuple(r[k] for k in key): r.q for r in score_quartiles(rows, config, largest).collect()}

    want, got = table(cfg, 10), table(cfg.with_(max_ranked=max_ranked), None)
    assert want.keys() == got.keys() and len(want) > 60
    for k, q in want.items():
        np.testing.assert_allclose(got[k], q, rtol=1e-12, atol=1e-300)
    assert table(cfg.with_(formulas=("covariates_only",)), None) == {}


def test_persons_go_only_to_cells_that_look_into_their_bin(spark):
    from cohortscope.config import EvalConfig
    from cohortscope.operators import summary
    from cohortscope.operators.strata import group_lists, stratum_column, with_completeness

    cfg = EvalConfig().with_(strata=("race", "gender", "education"), families=(), covariates=(), max_ranked=100)
    rows = spark.range(20_000).selectExpr(
        "'t' as task_id", "cast(hash(id) % 100000 as double) as SCORE", "1D as y",
        *(f"concat('g', (id div {7**i}) % 3) as {stratum_column(s)}" for i, s in enumerate(cfg.strata)),
    )
    sent = []
    saved = summary.searched

    def searched(pairs, *rest):
        sent.append(pairs.count())
        return saved(pairs, *rest)

    summary.searched = searched
    try:
        found = summary.merged_quantiles(with_completeness(rows, cfg), cfg, group_lists(rows, cfg), ["prs_only"], (0.25, 0.5, 0.75))
        assert found.count() == 3 * 3 + 3 * 9
    finally:
        summary.searched = saved
    # Each person is in six cells.
    assert sent[0] < 20_000


def test_histograms_of_one_request_are_spread_over_tasks(spark, monkeypatch):
    from cohortscope.config import EvalConfig
    from cohortscope.operators import summary
    from cohortscope.operators.strata import group_lists, stratum_column, with_completeness

    cfg = EvalConfig().with_(strata=("race", "gender"), families=(), covariates=(), max_ranked=100)
    rows = spark.range(2_000).selectExpr(
        "'t' as task_id", "cast(hash(id) % 1000 as double) as SCORE", "1D as y",
        *(f"concat('g', (id div {7**i}) % 3) as {stratum_column(s)}" for i, s in enumerate(cfg.strata)),
    )
    plans, saved = [], summary.written

    def planned(df, name):
        plans.append(df._jdf.queryExecution().sparkPlan().toString())
        return saved(df, name)

    monkeypatch.setattr(summary, "written", planned)
    size = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = summary.merged_quantiles(with_completeness(rows, cfg), cfg, group_lists(rows, cfg), ["prs_only"], (0.25, 0.5, 0.75))
        assert found.count() == 3 + 3 + 9
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", size)
    assert len(plans) == 2 and not any("SortMergeJoin" in p for p in plans)
