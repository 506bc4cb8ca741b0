import gzip

import pytest
from pyspark.sql import functions as F

from cohortscope.config import EvalConfig
from cohortscope.operators.scoring import score_many, score_people
from cohortscope.pipeline import evaluate_requests, final_reports, run
from cohortscope.operators.cohort import build_cohort, prepare_tasks
from cohortscope.operators.evaluate import evaluate
from cohortscope.operators.incremental import incremental
from cohortscope.sources import reports, tables, weights
from workload import fixtures
from workload.raw_files import raw_weights, write_raw_files

SF = "/root/testdata/sf0.001"
CFG = EvalConfig()


def put(path, text, packed=False):
    data = text.encode()
    path.write_bytes(gzip.compress(data) if packed else data)


@pytest.fixture
def weight_files(tmp_path):
    put(
        tmp_path / "PGS000001_hmPOS_GRCh38.txt.gz",
        "###PGS CATALOG SCORING FILE\n#format_version=2.0\n#pgs_id=PGS000001\n#note=version 1\tafter a tab\n"
        "rsID\tchr_name\teffect_allele\tother_allele\teffect_weight\thm_chr\thm_pos\n"
        "rs1\t1\tA\tG\t0.5\t7\t100\nrs2\t2\tC\t\t-0.25\t2\t\n",
        packed=True,
    )
    put(
        tmp_path / "PGS000002_hmPOS_GRCh38.txt",
        "#format_version=10.0\nhm_pos\thm_chr\teffect_weight\tchr_name\thm_inferOtherAllele\teffect_allele\n"
        "300\t3\t1e-3\tX\tT\tA\n",
    )
    return str(tmp_path)


def test_mixed_layouts_in_one_scan(spark, weight_files):
    got = {tuple(r) for r in weights.read_weights(spark, weight_files).collect()}
    assert got == {
        ("PGS000001", "1", "100", "A", "G", "0.5"),
        ("PGS000001", "2", None, "C", None, "-0.25"),
        ("PGS000002", "X", "300", "A", "T", "1e-3"),
    }


def test_headers(spark, weight_files):
    lines = weights.read_weight_headers(spark, weight_files)
    first = lines.where("pgs = 'PGS000001'").orderBy("line_no").collect()
    assert [(r.line_no, r.key, r["value"]) for r in first] == [
        (1, None, None), (2, "format_version", "2.0"), (3, "pgs_id", "PGS000001"), (4, "note", "version 1\tafter a tab"),
    ]
    summary = {r.pgs: (r.version, r.header_lines) for r in weights.header_summary(lines).collect()}
    assert summary == {"PGS000001": ("2", 4), "PGS000002": ("10", 1)}


def test_a_broken_rewrite_leaves_the_report_readable(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "report")
    table = lambda n: spark.createDataFrame([("y", "linear", f"t{n}", float(n))], "outcome string, method string, task_id string, RSQ double")
    read = lambda: [tuple(r) for r in spark.read.parquet(reports.current_folder(spark, path)).select("task_id", "RSQ").collect()]
    with pytest.raises(FileNotFoundError):
        reports.current_folder(spark, path)
    assert reports.write_report(table(1), path).count() == 1 and read() == [("t1", 1.0)]
    # The run stops after the data are written, before the version is named.
    monkeypatch.setattr(reports, "_versions", lambda *_: (_ for _ in ()).throw(RuntimeError("stopped")))
    with pytest.raises(RuntimeError):
        reports.write_report(table(2), path)
    monkeypatch.undo()
    broken = table(2).withColumn("RSQ", F.raise_error(F.lit("stopped")).cast("double"))
    with pytest.raises(Exception, match="stopped"):
        reports.write_report(broken, path)
    appended = spark.range(0).write.__class__.parquet

    def stop(self, target, *rest, **options):
        if target.endswith("/versions"):
            raise RuntimeError("stopped between the steps")
        return appended(self, target, *rest, **options)

    monkeypatch.setattr(spark.range(0).write.__class__, "parquet", stop)
    with pytest.raises(RuntimeError, match="between"):
        reports.write_report(table(3), path)
    monkeypatch.undo()
    assert read() == [("t1", 1.0)]
    reports.write_report(table(4), path)
    reports.write_report(table(5), path)
    assert read() == [("t5", 5.0)]
    reports.forget_versions(spark, path, kept=0)
    assert read() == [("t5", 5.0)]


def test_many_scores_are_those_of_each(spark):
    """Repeated weights, missing weights and dosages, swapped alleles, other alleles at one place."""
    import random

    rng = random.Random(3)
    alleles = [("A", "C"), ("C", "A"), ("G", "T"), ("A", "T")]
    w = [(f"P{rng.randrange(37)}", str(rng.randrange(1, 4)), str(rng.randrange(12)), *rng.choice(alleles), rng.choice(["1.5", "-2", "0", None])) for _ in range(700)]
    d = [(i, str(rng.randrange(1, 4)), rng.randrange(12), *rng.choice(alleles), rng.choice([0.0, 1.0, 2.0, 0.5, None])) for i in range(40) for _ in range(15)]
    weights_ = spark.createDataFrame(w, "pgs string, hm_chr string, hm_pos string, effect_allele string, other_allele string, effect_weight string")
    dosages = spark.createDataFrame(d, "IID long, chr string, pos long, alt string, ref string, dosage double")
    frequencies = spark.createDataFrame([("1", p, "A", 0.25) for p in range(6)], "chr string, pos long, allele string, freq double")
    plain = lambda df: {(r.pgs, r.IID): tuple(None if x is None else round(x, 9) for x in r[2:]) for r in df.collect()}
    for options in ({}, {"broadcast_rows": 0, "salts": 3}, {"frequencies": frequencies, "average": True, "drop_ambiguous": True}):
        want = plain(score_people(dosages, weights_, **options))
        assert want and plain(score_many(dosages, weights_, slots=5, **options)) == want
    assert score_many(dosages.limit(0), weights_).count() == 0 and score_many(dosages, weights_.limit(0)).count() == 0


def test_header_lines_are_written_as_they_were(spark, tmp_path):
    head = ["###PGS CATALOG SCORING FILE - see https://example.org", "#format_version=2.0", "##GENOME BUILD", "##weight=a=b", "#", "# a remark\twith a tab"]
    columns = "chr_name\thm_pos\teffect_allele\tother_allele\teffect_weight"
    (tmp_path / "raw").mkdir()
    put(tmp_path / "raw" / "PGS000009.txt", "\n".join([*head, columns, "1\t5\tA\tC\t0.25"]) + "\n")
    raw, out = str(tmp_path / "raw"), str(tmp_path / "out")
    headers = weights.read_weight_headers(spark, raw)
    assert [r.key for r in headers.orderBy("line_no").collect()] == [None, "format_version", None, "weight", None, None]
    weights.export_weight_files(weights.read_weights(spark, raw), headers, out)
    again = weights.read_weight_headers(spark, out).orderBy("line_no").collect()
    assert [r.line for r in again] == head
    assert weights.read_normalized(spark, out).count() == 1


def test_older_inputs_have_no_texts_for_missing_values(spark, tmp_path):
    put(tmp_path / "people.tsv", "IID\trace\tage\ty\n1\tNA\t30\t1\n2\tother\t40\t0\n3\t\t50\t1\n")
    cfg = EvalConfig().with_(strata=("race",), covariates=("age",))
    old = EvalConfig.legacy().with_(strata=("race",), covariates=("age",))
    assert old.max_iter == 100
    groups = lambda c: {r.IID: r.race for r in tables.read_demographics(spark, str(tmp_path), c, ["y"]).collect()}
    assert groups(cfg) == {1: None, 2: "other", 3: None} and groups(old) == {1: "NA", 2: "other", 3: None}


def test_unusable_file_is_refused(spark, tmp_path):
    put(tmp_path / "PGS000003.txt", "#x=1\nrsID\teffect_allele\nrs1\tA\n")
    with pytest.raises(Exception, match="needed columns"):
        weights.read_weights(spark, str(tmp_path)).collect()


def test_weight_sinks(spark, weight_files, tmp_path):
    w = weights.read_weights(spark, weight_files)
    weights.write_weights(w, str(tmp_path / "parquet"))
    back = spark.read.parquet(str(tmp_path / "parquet"))
    assert back.count() == 3 and set(back.columns) == {"pgs", *weights.WEIGHT_COLUMNS}
    weights.export_weights(w, str(tmp_path / "text"))
    lines = [r[0] for r in spark.read.text(str(tmp_path / "text")).select("value").collect()]
    assert "2\tNone\tC\tNone\t-0.25" in lines


def test_requests_and_map(spark, tmp_path):
    put(tmp_path / "requests.tsv", "PGS000001 bmi logistic\nPGS000009 waist linear\n")
    requests = tables.read_requests(spark, str(tmp_path / "requests.tsv"))
    versions = spark.createDataFrame([("PGS000001", "2")], "pgs string, version string")
    task_map = tables.build_task_map(requests, versions)
    assert {tuple(r) for r in task_map.collect()} == {
        ("PGS000001_bmi_logistic", "PGS000001_formatted_hmPOS_GRCh38.txt.gz", "2", "bmi", "logistic"),
        ("PGS000009_waist_linear", "PGS000009_formatted_hmPOS_GRCh38.txt.gz", None, "waist", "linear"),
    }
    tables.write_task_map(task_map, str(tmp_path / "map"))
    stored = tables.read_task_map(spark, str(tmp_path / "map"))
    assert {tuple(r) for r in stored.collect()} == {tuple(r) for r in task_map.collect()}
    assert {tuple(r) for r in tables.requests_of_map(stored).collect()} == {tuple(r) for r in requests.collect()}


def test_scores_and_demographics(spark, tmp_path):
    put(
        tmp_path / "PGS1_bmi_logistic_prs.sscore",
        "#FID\tIID\tALLELE_CT\tNAMED_ALLELE_DOSAGE_SUM\tSCORE\n0\t1\t4\t2.5\t0.75\n0\t2\tNA\tNone\tNA\n",
    )
    got = tables.read_scores(spark, str(tmp_path / "PGS1_bmi_logistic_prs.sscore")).orderBy("IID").collect()
    assert tuple(got[0]) == ("PGS1_bmi_logistic", 0, 1, 4, 2.5, 0.75)
    assert tuple(got[1]) == ("PGS1_bmi_logistic", 0, 2, None, None, None)
    cfg = CFG.with_(strata=("race", "income_quartiles"), covariates=("age", "sex_at_birth"))
    put(
        tmp_path / "people.tsv",
        "IID\tunused\tincome_quartiles\trace\tage\tsex_at_birth\tobesity\n1\tq\t3\tNone\tNA\tMale\t1\n2\tq\tNA\tother\t40\tNA\tNone\n",
    )
    people = tables.read_demographics(spark, str(tmp_path / "people.tsv"), cfg, ["obesity"])
    assert people.columns == ["IID", "race", "income_quartiles", "age", "sex_at_birth", "obesity"]
    assert [tuple(r) for r in people.orderBy("IID").collect()] == [
        (1, None, "3", None, "Male", 1.0), (2, "other", None, 40.0, None, None),
    ]


def test_score_files_keyed_by_request_join_their_own_outcome(spark, tmp_path):
    tasks = prepare_tasks(
        spark.createDataFrame(
            [("P", "bmi", "logistic"), ("P", "waist", "linear")], "pgs string, phenotype string, regression string"
        ),
        CFG,
    )
    cfg = CFG.with_(strata=("race",), covariates=("age",))
    scores = spark.createDataFrame(
        [("P_bmi_logistic", 1, 0.5), ("P_waist_linear", 1, 0.7)], "task_id string, IID long, SCORE double"
    )
    people = spark.createDataFrame([(1, "x", 30.0, 1, 88.5)], "IID long, race string, age double, obesity int, waist double")
    rows = build_cohort(scores, people, tasks, cfg)
    assert {(r.task_id, r.SCORE, r.y) for r in rows.collect()} == {("P_bmi_logistic", 0.5, 1.0), ("P_waist_linear", 0.7, 88.5)}


def test_scoring_paths_agree(spark):
    dosages = fixtures.run(spark, SF, fixtures.GENOTYPES)
    w = weights.normalize_weights(raw_weights(spark, SF))
    few = {tuple(r) for r in score_people(dosages, w).collect()}
    salted = {tuple(r) for r in score_people(dosages, w, broadcast_rows=0, salts=5).collect()}
    assert few and {(a, b, c, round(d, 9), round(e, 9)) for a, b, c, d, e in few} == {
        (a, b, c, round(d, 9), round(e, 9)) for a, b, c, d, e in salted
    }


def test_scoring_rules(spark):
    w = spark.createDataFrame(
        [("P", "1", "10", "A", "G", "2.0"), ("P", "1", "20", "A", "T", "1.0"), ("P", "1", None, "A", "C", "9.0")],
        "pgs string, hm_chr string, hm_pos string, effect_allele string, other_allele string, effect_weight string",
    )
    d = spark.createDataFrame(
        [
            (1, "1", 10, "A", "G", 1.0), (1, "1", 20, "T", "A", 0.5),
            (2, "1", 10, "G", "A", 0.25), (2, "1", 20, "C", "A", 2.0),
            (3, "1", 10, "A", "G", None),
        ],
        "IID long, chr string, pos long, alt string, ref string, dosage double",
    )
    plain = {r.IID: (r.ALLELE_CT, r.NAMED_ALLELE_DOSAGE_SUM, r.SCORE) for r in score_people(d, w).collect()}
    assert plain == {1: (4, 2.5, 3.5), 2: (2, 1.75, 3.5), 3: (0, None, None)}
    strict = {r.IID: r.SCORE for r in score_people(d, w, drop_ambiguous=True).collect()}
    assert strict == {1: 2.0, 2: 3.5, 3: None}
    f = spark.createDataFrame([("1", 10, "G", 0.25)], "chr string, pos long, allele string, freq double")
    filled = {r.IID: r.SCORE for r in score_people(d, w, frequencies=f).collect()}
    assert filled[3] == 3.0
    assert {r.IID: r.SCORE for r in score_people(d, w, average=True).collect()}[1] == 3.5 / 4


def test_reports_and_whole_run(spark, tmp_path):
    cfg = CFG.with_(strata=("race", "gender"), covariates=("age", "sex_at_birth"))
    people = fixtures.demographics(spark, SF).where("IID is not null")
    dosages = fixtures.run(spark, SF, fixtures.GENOTYPES)
    requests = fixtures.requests(spark)
    report = run(
        spark, requests, write_raw_files(spark, SF), dosages, people, str(tmp_path / "report"), cfg
    )
    got = report.groupBy("method").count().collect()
    assert {r.method for r in got} == {"linear", "logistic"}

    tasks = prepare_tasks(requests, cfg)
    rows = build_cohort(fixtures.scores(spark, SF), people, tasks, cfg)
    both = final_reports(evaluate(rows, cfg), tasks)
    for method, metric in reports.METRIC.items():
        final = both[method]
        columns = [c for c in final.columns if c not in ("task_id", "phenotype", "outcome", "method")]
        assert columns == [*reports.REPORT_COLUMNS[method], f"INCREMENTAL_{metric}_PRS"]
        path = str(tmp_path / method)
        reports.export_report(final, path, null_value="None")
        back = reports.read_report(spark, path, method)
        again = incremental(back.drop(f"INCREMENTAL_{metric}_PRS"), metric)
        key = ["task_id", "STRATA_ONE", "GROUP_ONE", "STRATA_TWO", "GROUP_TWO", "COVARIATES"]
        name = f"INCREMENTAL_{metric}_PRS"
        a = {tuple(r[k] for k in key): r[name] for r in final.collect()}
        b = {tuple(r[k] for k in key): r[name] for r in again.collect()}
        assert a.keys() == b.keys() and a
        for k in a:
            assert (a[k] is None and b[k] is None) or a[k] == pytest.approx(b[k], abs=1e-12)
    legacy = reports.report_table(incremental(evaluate(rows, cfg).linear, "RSQ"), tasks, "linear", legacy=True)
    assert "N" not in legacy.columns


def test_all_requests_in_one_table(spark):
    cfg = CFG.with_(strata=("gender",), covariates=("age",))
    report = evaluate_requests(
        fixtures.scores(spark, SF), fixtures.demographics(spark, SF), fixtures.requests(spark), cfg
    )
    linear = report.where(F.col("method") == "linear")
    assert report.count() and linear.where("AUC is not null").count() == 0
    same = linear.groupBy("GROUP_ONE", "COVARIATES").agg(F.count_distinct(F.round("RSQ", 9)).alias("n"))
    assert same.where("n > 1").count() == 0
