"""Bundles of scores against rows of single requests, which share nothing."""

import pytest
from pyspark.sql import functions as F

from cohortscope.config import EvalConfig
from cohortscope.operators.bundles import build_bundles, of_rows, request_rows
from cohortscope.operators.cohort import build_cohort, prepare_tasks
from cohortscope.operators.evaluate import evaluate, fit_cells
from workload import fixtures

SF = "/root/testdata/sf0.001"
CFG = EvalConfig().with_(strata=("race", "sex_at_birth"), families=(), linear_min_n=5, logistic_min_n=5, min_cases=2, covariates=("age", "pca_1", "sex_at_birth"))


@pytest.fixture(scope="module")
def people(spark):
    iid = F.col("IID")
    return fixtures.demographics(spark, SF).withColumn("age", F.when(iid % 19 != 0, F.col("age"))).cache()


@pytest.fixture(scope="module")
def scores(spark, people):
    """Nine scores: of all persons, of fewer, with nulls and NaN, with persons twice, and with strangers."""
    base = fixtures.scores(spark, SF).select("IID", "SCORE")
    iid, out = F.col("IID"), None
    for k in range(9):
        one = base.select(F.lit(f"S{k}").alias("pgs"), "IID", (F.col("SCORE") + (iid * (k + 2)) % 11).alias("SCORE"))
        if k in (3, 4):
            one = one.where(iid % 5 != 0)
        if k in (5, 6):
            one = one.withColumn("SCORE", F.when(iid % 7 == 0, None).when(iid % 11 == 0, float("nan")).otherwise(F.col("SCORE")))
        if k == 7:
            one = one.union(one.where(iid % 9 == 0))
        if k == 8:
            one = one.union(spark.sql("select 'S8', -5L, 1D")).union(spark.sql("select 'S8', cast(null as long), 1D"))
        out = one if out is None else out.unionByName(one)
    return out.cache()


@pytest.fixture(scope="module")
def tasks(spark):
    wanted = [(f"S{k}", "waist_circumference", "linear") for k in range(9)] + [(f"S{k}", "bmi", "logistic") for k in (1, 4, 6, 7)]
    wanted += [("S0", "bmi", "linear"), ("S99", "bmi", "linear")]
    return prepare_tasks(fixtures.requests(spark, wanted), CFG)


def table(report):
    keys = ["task_id", "STRATA_ONE", "GROUP_ONE", "STRATA_TWO", "GROUP_TWO", "COVARIATES"]
    return {tuple(r[k] for k in keys): r for r in report.collect()}


def same(a, b):
    left, right = table(a), table(b)
    assert left.keys() == right.keys() and left
    for key, row in left.items():
        for name, value in row.asDict().items():
            other = right[key][name]
            assert value == other or value == pytest.approx(other, rel=1e-6, abs=1e-7), (key, name, value, other)


@pytest.mark.parametrize("holdout", [False, True])
def test_reports_are_those_of_single_requests(people, scores, tasks, holdout):
    whole = evaluate(build_bundles(scores, people, tasks, CFG, size=3), CFG, holdout)
    single = evaluate(build_cohort(scores, people, tasks, CFG), CFG, holdout)
    same(whole.linear, single.linear)
    same(whole.logistic, single.logistic)


def test_a_person_has_a_row_per_bundle_not_per_request(people, scores, tasks):
    bundles = build_bundles(scores, people, tasks, CFG, size=3)
    groups = sorted(sorted({r.slot for r in some}) for some in bundles.requests.values())
    names = sorted({r.task_id.split("_")[0] for r in some} for some in map(lambda b: bundles.requests[b], bundles.requests))
    # Scores of the same persons are together, three at most; those with nulls, fewer persons, or a stranger apart.
    assert sorted(map(sorted, names)) == [["S0", "S1", "S2"], ["S3", "S4"], ["S5", "S6"], ["S7"], ["S8"]]
    assert groups == [[0], [0], [0, 1], [0, 1], [0, 1, 2]]
    rows = {r.bundle: r["count"] for r in bundles.rows.groupBy("bundle").count().collect()}
    joined = {r.pgs: r["count"] for r in scores.join(people.select("IID"), "IID").groupBy("pgs").count().collect()}
    for name, some in bundles.requests.items():
        assert {joined[r.task_id.split("_")[0]] for r in some} == {rows[name]}


def test_request_rows_carry_no_covariates(people, scores, tasks):
    bundles = build_bundles(scores, people, tasks, CFG)
    found = request_rows(bundles, CFG, "linear")
    assert not {"age", "pca_1"} & set(found.columns)
    want = build_cohort(scores, people, tasks, CFG).where("method = 'linear'").select("task_id", "SCORE", "y")
    assert sorted(map(str, found.select("task_id", "SCORE", "y").collect())) == sorted(map(str, want.collect()))


def test_borders_are_as_long_as_the_columns(people, scores, tasks):
    from cohortscope.operators.design import make_design, request_scales
    from cohortscope.operators.moments import cell_moments

    bundles = build_bundles(scores, people, tasks, CFG).stored()
    design = make_design(bundles.rows, CFG)
    moments = cell_moments(bundles, design, request_scales(bundles, design), CFG)
    shared, border = moments.select(F.size("c0"), F.size(F.col("borders")[0]["c0"])).where("size(c0) > 0").first()
    padded = -(-design.width // 16) * 16
    assert border == padded and shared >= design.width * (design.width - 1) // 2


def test_empty_tables(people, scores, tasks):
    for some, who in ((scores.limit(0), people), (scores, people.limit(0))):
        done = evaluate(build_bundles(some, who, tasks, CFG), CFG)
        assert done.linear.count() == 0 and done.logistic.count() == 0


def test_rows_of_single_requests_are_bundles_of_one(people, scores, tasks):
    rows = build_cohort(scores, people, tasks, CFG)
    bundles = of_rows(rows)
    assert all([r.slot for r in some] == [0] for some in bundles.requests.values())
    assert len(fit_cells(rows, CFG).bundles.requests) == rows.select("task_id").distinct().count()


def test_scores_are_worked_out_once(spark, people, tasks):
    counted = spark.sparkContext.accumulator(0)

    def counting(batches):
        for batch in batches:
            counted.add(batch.num_rows)
            yield batch

    rows = spark.range(300).selectExpr("'S0' as pgs", "id as IID", "id / 7D as SCORE")
    bundles = build_bundles(rows.mapInArrow(counting, rows.schema), people, tasks, CFG)
    assert bundles.rows.count()
    assert counted.value == 300


def test_rows_of_one_request_are_not_shuffled_to_one_task(spark, people, scores, tasks):
    bundles = build_bundles(scores, people, tasks, CFG)
    size = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = request_rows(bundles, CFG, "linear")._jdf.queryExecution().sparkPlan().toString()
        assert "BroadcastHashJoin [pgs" in plan and "BroadcastHashJoin [bundle" in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", size)
