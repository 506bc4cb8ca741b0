"""Limits that must not hide work, and inputs that must be refused."""

import gzip

import pytest
from pyspark.sql import functions as F

from cohortscope.config import EvalConfig
from cohortscope.operators.cohort import prepare_tasks
from cohortscope.operators.design import make_design
from cohortscope.operators.evaluate import evaluate, fit_cells, logistic_report
from cohortscope.operators.incremental import incremental
from cohortscope.operators.scoring import score_people
from cohortscope.sources import reports, weights
from workload import fixtures, queries

SF = "/root/testdata/sf0.001"
CFG = EvalConfig(strata=("gender",), covariates=("age",), families=())


def test_a_model_that_did_not_converge_fails_the_run_or_is_marked(spark):
    rows = queries.rows(spark, SF, CFG, queries.LOG)
    one = CFG.with_(max_iter=1)
    with pytest.raises(RuntimeError, match="did not converge in 1 passes"):
        logistic_report(fit_cells(rows, one), one)
    marked = one.with_(keep_unconverged=True)
    flags = logistic_report(fit_cells(rows, marked), marked).select("CONVERGED").collect()
    assert flags and not any(r.CONVERGED for r in flags)
    assert all(r.CONVERGED for r in logistic_report(fit_cells(rows, CFG), CFG.with_(keep_unconverged=True)).collect())


def test_levels_of_a_text_covariate_are_bounded_by_a_setting(spark):
    rows = spark.range(40).select(F.concat(F.lit("v"), "id").alias("kind"), F.lit(1.0).alias("SCORE"))
    cfg = EvalConfig(covariates=("kind",), max_levels=40)
    assert len(dict(make_design(rows, cfg).levels)["kind"]) == 40
    with pytest.raises(ValueError, match="max_levels = 39"):
        make_design(rows, cfg.with_(max_levels=39))


def test_score_id_is_that_of_the_file_not_of_a_folder(spark, tmp_path):
    folder = tmp_path / "PGS2024"
    folder.mkdir()
    line = "chr_name\thm_pos\teffect_allele\tother_allele\teffect_weight\n1\t5\tA\tG\t0.5\n"
    for name in ("PGS000827_x.txt.gz", "PGS000828_x.txt.gz"):
        (folder / name).write_bytes(gzip.compress(line.encode()))
    assert {r.pgs for r in weights.read_weights(spark, str(folder)).collect()} == {"PGS000827", "PGS000828"}
    (folder / "unnamed.txt").write_text(line)
    with pytest.raises(Exception, match="no score id"):
        weights.read_weights(spark, str(folder)).collect()


def test_repeated_frequencies_count_once_and_different_ones_are_refused(spark):
    d = spark.createDataFrame([(1, "1", 10, "A", "G", 1.0)], "IID long, chr string, pos long, alt string, ref string, dosage double")
    w = spark.createDataFrame([("p", "1", "10", "A", "G", "0.5")], "pgs string, hm_chr string, hm_pos string, effect_allele string, other_allele string, effect_weight string")
    schema = "chr string, pos long, allele string, freq double"
    twice = spark.createDataFrame([("1", 10, "A", 0.25)] * 2, schema)
    [row] = score_people(d, w, frequencies=twice).collect()
    assert (row.SCORE, row.ALLELE_CT) == (0.5, 2)
    with pytest.raises(Exception, match="two frequencies of 1:10 A"):
        score_people(d, w, frequencies=twice.union(spark.createDataFrame([("1", 10, "A", 0.5)], schema))).collect()


def test_requests_that_would_share_an_id_are_refused(spark):
    requests = spark.createDataFrame([("A_b", "c", "linear"), ("A", "b_c", "linear")], "pgs string, phenotype string, regression string")
    with pytest.raises(ValueError, match="A_b_c_linear"):
        prepare_tasks(requests, EvalConfig())


def test_a_report_without_rows_is_written_and_read_back(spark, tmp_path):
    rows = queries.rows(spark, SF, CFG.with_(linear_min_n=10**6), queries.LIN)
    cfg = CFG.with_(linear_min_n=10**6)
    tasks = prepare_tasks(fixtures.requests(spark, queries.LIN), cfg)
    report = reports.report_table(incremental(evaluate(rows, cfg).linear, "RSQ"), tasks, "linear")
    back = reports.write_report(report, str(tmp_path / "none"))
    assert back.columns == report.columns and back.count() == 0


@pytest.mark.parametrize("targets", [0, 500_000])
def test_quantiles_of_small_and_large_groups_together(spark, monkeypatch, targets):
    from cohortscope.operators import quantiles

    monkeypatch.setattr(quantiles, "BROADCAST_TARGETS", targets)
    rows = spark.range(3000).selectExpr("if(id < 40, 'small', 'large') as g", "cast((id * 7919) % 1009 as double) as v")
    got = {r.g: r.q for r in quantiles.exact_quantiles(rows, ["g"], "v", (0.25, 0.5, 0.9), None, 100).collect()}
    want = rows.groupBy("g").agg(F.expr("percentile(v, array(0.25D, 0.5D, 0.9D))").alias("q")).collect()
    assert got == {r.g: pytest.approx(r.q) for r in want}


def test_results_do_not_depend_on_what_is_broadcast(spark, monkeypatch):
    from cohortscope.operators import distribution
    from workload.raw_files import write_raw_files

    raw = write_raw_files(spark, SF)

    def results():
        density = queries.distribution_density(spark, SF).collect()
        return sorted(map(tuple, weights.read_weights(spark, raw).collect()), key=str), sorted(map(tuple, density))

    usual = results()
    monkeypatch.setattr(distribution, "BROADCAST_GROUPS", 0)
    monkeypatch.setattr(weights, "BROADCAST_FILES", 0)
    assert results() == usual


def test_the_weight_scan_does_not_shuffle_its_lines(spark):
    from workload.raw_files import write_raw_files

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = weights.read_weights(spark, write_raw_files(spark, SF))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "hashpartitioning" not in plan


def test_vectors_are_added_in_one_step_or_two(spark):
    import numpy as np
    import pyarrow as pa

    from cohortscope.plans import vectors

    def partial(batches):
        for batch in batches:
            ids = batch.column("id").to_numpy()
            row, columns = vectors.blocks(np.outer(ids, np.arange(1.0, 21.0)))
            yield pa.RecordBatch.from_pydict({"k": pa.array((ids % 3)[row])} | columns)

    rows = spark.range(60).repartition(7).mapInArrow(partial, "k long, " + vectors.BLOCK_FIELDS)
    for salts in (1, 3):
        got = {r.k: r.vector[:20] for r in vectors.sum_vectors(rows, ["k"], salts=salts).collect()}
        assert got == {k: [float(sum(range(k, 60, 3)) * c) for c in range(1, 21)] for k in range(3)}
