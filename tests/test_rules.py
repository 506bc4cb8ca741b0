"""Gates, suppression and degenerate cells on small literal frames."""

import math

import pytest
from pyspark.sql import functions as F

from cohortscope.config import AMBIGUOUS, EvalConfig
from cohortscope.functions.columns import balanced_accuracy, known_group, method_of, outcome_of, suppressed
from cohortscope.operators.cohort import build_cohort, join_scores, prepare_tasks
from cohortscope.operators.distribution import distribution, plotted_groups
from cohortscope.operators.evaluate import evaluate
from cohortscope.operators.incremental import incremental
from cohortscope.operators.summary import cell_sizes, passes_gate, single_regressor

SMALL = EvalConfig().with_(strata=("race",), families=(), covariates=("age",))


def cohort(spark, groups, cfg=SMALL, method="linear"):
    """``groups``: name -> list of (score, outcome, age)."""
    data = []
    for group, people in groups.items():
        for score, y, age in people:
            data.append((len(data), group, score, y, age))
    people = spark.createDataFrame(data, "IID long, race string, SCORE double, y double, age double")
    tasks = prepare_tasks(
        spark.createDataFrame([("P1", "y", method)], "pgs string, phenotype string, regression string"), cfg
    )
    scores = people.select(F.lit("P1").alias("pgs"), "IID", "SCORE")
    return build_cohort(scores, people.drop("SCORE"), tasks, cfg)


def spread(n, cases=None):
    def outcome(i):
        return float(i % 7) + i / 10 if cases is None else float(i < cases)

    return [((i * 37 % 11) / 3.0, outcome(i), 20.0 + (i * 13 % 29)) for i in range(n)]


def test_strata_sets():
    sets = EvalConfig().strata_sets()
    pairs = {frozenset((s.one, s.two)) for s in sets if s.two}
    assert len(sets) == 32 and len(pairs) == 24
    for a, b in (("gender", "sex_at_birth"), ("race", "ethnicity"), ("race", "ancestry_pred"), ("ethnicity", "ancestry_pred")):
        assert frozenset((a, b)) not in pairs
    for s in sets:
        assert s.use_sex == (not {"gender", "sex_at_birth"} & {s.one, s.two})


def test_linear_gate_is_strict(spark):
    rows = cohort(spark, {"a20": spread(20), "b21": spread(21)})
    assert {r.GROUP_ONE for r in evaluate(rows, SMALL).linear.collect()} == {"b21"}
    assert {r.GROUP_ONE for r in single_regressor(rows, SMALL).collect()} == {"b21"}


def test_legacy_gates(spark):
    legacy = EvalConfig.legacy().with_(strata=("race",), families=(), covariates=("age",))
    rows = cohort(spark, {"a99": spread(99), "b100": spread(100), "c101": spread(101)}, legacy)
    sizes = cell_sizes(rows, legacy).where(passes_gate(legacy))
    assert {r.group_one for r in sizes.collect()} == {"c101"}
    rows = cohort(spark, {"a100": spread(100, 40), "b101": spread(101, 40)}, legacy, "logistic")
    sizes = cell_sizes(rows, legacy).where(passes_gate(legacy))
    assert {r.group_one for r in sizes.collect()} == {"b101"}


def test_logistic_gate_suppression_and_one_class(spark):
    rows = cohort(
        spark, {"few": spread(60, 20), "enough": spread(60, 21), "all": spread(30, 30)}, SMALL, "LOGISTIC"
    )
    report = evaluate(rows, SMALL).logistic.collect()
    assert {r.GROUP_ONE for r in report} == {"enough", "all"}
    for r in report:
        if r.GROUP_ONE == "all":
            assert r.AUC is None and r.TRUE_POSITIVE is None and (r.CASES, r.CONTROLS) == (30, 0)
        else:
            assert r.AUC is not None and (r.CASES, r.CONTROLS) == (21, 39)
            for c in (r.TRUE_POSITIVE, r.FALSE_POSITIVE, r.TRUE_NEGATIVE, r.FALSE_NEGATIVE):
                assert c is None or c > 20


def test_degenerate_cells(spark):
    constant_y = [(float(i), 3.0, 20.0 + i) for i in range(25)]
    constant_score = [(1.5, float(i % 5), 20.0 + i) for i in range(25)]
    no_age = [(float(i % 6), float(i % 5), None) for i in range(25)]
    nan_age = [(float(i % 6), float(i % 5), math.nan) for i in range(25)]
    rows = cohort(
        spark,
        {"constant_y": constant_y, "constant_score": constant_score, "no_age": no_age, "nan_age": nan_age},
    )
    report = {(r.GROUP_ONE, r.COVARIATES): r for r in incremental(evaluate(rows, SMALL).linear, "RSQ").collect()}
    assert report["constant_y", "prs_only"].RSQ == 1.0 and report["constant_y", "prs_only"].MSE == 0.0
    assert report["constant_score", "prs_only"].RSQ == pytest.approx(0.0, abs=1e-12)
    assert report["constant_score", "prs_only"].VAR_PRS == pytest.approx(0.0, abs=1e-12)
    for group in ("no_age", "nan_age"):
        assert {f for g, f in report if g == group} == {"prs_only"}
        assert report[group, "prs_only"].INCREMENTAL_RSQ_PRS is None
    closed = {r.GROUP_ONE: r.RSQ for r in single_regressor(rows, SMALL).collect()}
    assert closed["constant_y"] == 1.0 and closed["constant_score"] == pytest.approx(0.0, abs=1e-12)


def test_no_reported_cell_gives_an_empty_report(spark):
    result = evaluate(cohort(spark, {"a": spread(5)}), SMALL)
    assert result.linear.count() == 0 and result.logistic.count() == 0


def test_scaling_the_score_keeps_r2(spark):
    people = spread(40)
    plain = evaluate(cohort(spark, {"g": people}), SMALL).linear.collect()
    scaled = evaluate(cohort(spark, {"g": [(s * 1e-4, y, a) for s, y, a in people]}), SMALL).linear.collect()
    for a, b in zip(sorted(plain, key=lambda r: r.COVARIATES), sorted(scaled, key=lambda r: r.COVARIATES)):
        assert a.RSQ == pytest.approx(b.RSQ, abs=1e-9)


def test_logistic_outcome_must_be_binary(spark):
    rows = cohort(spark, {"g": [(1.0, 2.0, 30.0)] * 25}, SMALL, "logistic")
    with pytest.raises(ValueError, match="0 or 1"):
        evaluate(rows, SMALL)


def test_numeric_sex_covariate_and_other_text_covariate(spark):
    cfg = EvalConfig().with_(strata=("race", "gender"), families=(), covariates=("sex_at_birth", "site", "age"))
    data = [
        (i, "abc"[i % 3], "wm"[i % 2], i % 2, "xyz"[(i // 7) % 3], (i * 37 % 23) / 3, float(i * 31 % 19), 20.0 + i * 17 % 41)
        for i in range(150)
    ]
    people = spark.createDataFrame(
        data,
        "IID long, race string, gender string, sex_at_birth int, site string, SCORE double, y double, age double",
    )
    tasks = prepare_tasks(
        spark.createDataFrame([("P1", "y", "linear")], "pgs string, phenotype string, regression string"), cfg
    )
    rows = build_cohort(people.select(F.lit("P1").alias("pgs"), "IID", "SCORE"), people.drop("SCORE"), tasks, cfg)
    import numpy as np
    import pandas as pd

    frame = people.toPandas()
    report = evaluate(rows, cfg).linear.where("STRATA_TWO is null").collect()
    assert len(report) == 15
    for r in report:
        part = frame[frame[r.STRATA_ONE] == r.GROUP_ONE]
        use_sex = r.STRATA_ONE == "race"
        x = pd.DataFrame(index=part.index)
        if r.COVARIATES != "covariates_only":
            x["SCORE"] = part["SCORE"]
        if r.COVARIATES != "prs_only":
            x["age"] = part["age"]
            x = pd.concat([x, pd.get_dummies(part["site"]).astype(float)], axis=1)
            if use_sex:
                x["sex"] = part["sex_at_birth"]
        a = np.column_stack([np.ones(len(part)), x.to_numpy(float)])
        y = part["y"].to_numpy(float)
        residual = y - a @ np.linalg.lstsq(a, y, rcond=None)[0]
        assert r.RSQ == pytest.approx(1 - residual @ residual / ((y - y.mean()) ** 2).sum(), abs=1e-9)


def test_column_rules(spark):
    df = spark.createDataFrame(
        [("logistic", "bmi", "other"), ("LOGISTIC", "t2d", "Another"), ("lin", "bmi", None)],
        "reg string, phenotype string, answer string",
    )
    got = df.select(
        method_of(F.col("reg")).alias("m"),
        outcome_of(F.col("phenotype"), {"bmi": "obesity"}).alias("o"),
        known_group("answer", EvalConfig()).alias("g"),
    ).collect()
    assert [tuple(r) for r in got] == [("logistic", "obesity", None), ("logistic", "t2d", "Another"), ("linear", "obesity", None)]
    assert len(AMBIGUOUS) == 10
    counts = spark.createDataFrame([(20, 21, 0, 5)], "a long, b long, c long, d long")
    row = counts.select(
        suppressed(F.col("a"), 20).alias("a"),
        suppressed(F.col("b"), 20).alias("b"),
        balanced_accuracy(F.col("a"), F.col("c"), F.col("c"), F.col("d")).alias("none"),
        balanced_accuracy(F.col("a"), F.col("d"), F.col("b"), F.col("c")).alias("auc"),
    ).first()
    assert row.a is None and row.b == 21 and row.none is None
    assert row.auc == pytest.approx(0.5 * (1 + 21 / 26))


def test_join_rules(spark):
    scores = spark.createDataFrame([("P", 1, 0.5), ("P", 1, 0.6), ("P", None, 1.0)], "pgs string, IID long, SCORE double")
    people = spark.createDataFrame([(1, "x"), (1, "y"), (None, "z")], "IID long, race string")
    assert join_scores(scores, people).count() == 4
    with pytest.raises(ValueError, match="SCORE"):
        join_scores(scores, people.withColumn("SCORE", F.lit(1.0)))
    tasks = prepare_tasks(
        spark.createDataFrame([("P", "y", "linear")], "pgs string, phenotype string, regression string"), SMALL
    )
    with pytest.raises(ValueError, match="lacks"):
        build_cohort(scores, people, tasks, SMALL)


def test_plot_rules(spark):
    groups = {
        "male": spread(25), "female": spread(5), "Another": spread(30), "other": spread(30), "rare": spread(20),
    }
    rows = cohort(spark, groups)
    # "female" is drawn because it contains "male"; "Another" is not because it contains "other".
    assert {r.group for r in plotted_groups(rows, SMALL).collect()} == {"male", "female"}
    assert {r.group for r in plotted_groups(rows, SMALL, "exact").collect()} == {"male", "Another"}
    assert distribution(rows, SMALL).count() == 30
    binary = cohort(spark, {"male": spread(60, 21), "x": spread(60, 20)}, SMALL, "logistic")
    plot = distribution(binary, SMALL)
    assert {(r.group, r.hue) for r in plot.select("group", "hue").distinct().collect()} == {("male", "0"), ("male", "1")}


def test_only_variants_with_many_dosages_are_spread(spark):
    from cohortscope.operators import scoring

    data = [(i, "1", 100, "A", "C", float(i % 3)) for i in range(300)] + [(i, "1", 200 + i, "A", "C", 1.0) for i in range(300)]
    dosages = spark.createDataFrame(data, "IID long, chr string, pos long, alt string, ref string, dosage double")
    salted, many = scoring._salted(dosages, 4, 0.1)
    assert [tuple(r) for r in many.collect()] == [("1", 100, 4)]
    assert {(r.pos == 100, r.salt) for r in salted.collect()} == {(False, 0), *((True, k) for k in range(4))}
    listed = [("P", "1", str(p), "A", "C", "2") for p in range(100, 500)] * 2
    w = spark.createDataFrame(listed, "pgs string, hm_chr string, hm_pos string, effect_allele string, other_allele string, effect_weight string")
    want = {tuple(r) for r in scoring.score_people(dosages, w).collect()}
    for hot in (0.0, 0.1, 1.0):
        for score in (scoring.score_people, scoring.score_many):
            assert {tuple(r) for r in score(dosages, w, broadcast_rows=0, salts=4, hot=hot).collect()} == want


def test_scores_of_several_files_are_worked_out_once(spark, monkeypatch):
    from workload import fixtures, queries

    counted, scores = spark.sparkContext.accumulator(0), fixtures.scores

    def counting(batches):
        for batch in batches:
            counted.add(batch.num_rows)
            yield batch

    def slow(spark, sf):
        found = scores(spark, sf)
        return found.mapInArrow(counting, found.schema)

    monkeypatch.setattr(fixtures, "scores", slow)
    people = scores(spark, "/root/testdata/sf0.001").count()
    queries.cohort_from_files(spark, "/root/testdata/sf0.001")
    assert counted.value == people
