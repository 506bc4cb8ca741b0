"""One query per operator, on inputs derived from the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortscope.config import EvalConfig
from cohortscope.operators import distribution as dist
from cohortscope.operators import strata, summary
from cohortscope.operators.cohort import attach_tasks, build_cohort, prepare_tasks
from cohortscope.operators.design import make_design
from cohortscope.operators.bundles import build_bundles, clustered
from cohortscope.operators.evaluate import fit_cells, linear_report, logistic_report
from cohortscope.operators.incremental import incremental
from cohortscope.operators.scoring import score_many, score_people
from cohortscope.pipeline import evaluate_requests, run
from cohortscope.plans.scratch import scratch_path, written
from cohortscope.sources import reports, tables, weights
from workload import fixtures, raw_files

CFG = EvalConfig()
AGE = CFG.with_(covariates=("age",))
OUTCOMES = ["obesity", "waist_circumference"]
LIN = [fixtures.REQUESTS[0]]
LOG = [fixtures.REQUESTS[1]]
KEY = ["task_id", "STRATA_ONE", "GROUP_ONE", "STRATA_TWO", "GROUP_TWO", "COVARIATES"]


def _round(df: DataFrame) -> DataFrame:
    """Six digits; ten for moments of the two-digit scores, which can lie halfway between six."""
    doubles = {f.name for f in df.schema if f.dataType.typeName() == "double"}
    digits = {"MEAN_PRS": 10, "VAR_PRS": 10}
    return df.select(
        *(
            F.expr(f"round(`{c}`, {digits.get(c, 6)}) + 0D as `{c}`") if c in doubles else F.col(c)
            for c in df.columns
        )
    )


def rows(spark: SparkSession, sf: str, cfg: EvalConfig = CFG, wanted=fixtures.REQUESTS) -> DataFrame:
    """Rows of the requests, from the cohort that already holds score and demographics."""
    tasks = prepare_tasks(fixtures.requests(spark, wanted), cfg)
    return attach_tasks(fixtures.cohort(spark, sf), tasks, cfg, OUTCOMES)


def gap_rows(spark: SparkSession, sf: str, wanted=LIN) -> DataFrame:
    """Rows of the requests from the cohort with missing values and small groups."""
    tasks = prepare_tasks(fixtures.requests(spark, wanted), CFG)
    return attach_tasks(fixtures.cohort_gaps(spark, sf), tasks, CFG, OUTCOMES)


def stored_rows(spark: SparkSession, sf: str, cfg: EvalConfig = CFG, wanted=fixtures.REQUESTS) -> DataFrame:
    """The same, written once, for operators that read them several times."""
    return clustered(rows(spark, sf, cfg, wanted))


def _named(df: DataFrame, *columns) -> DataFrame:
    return df.select(
        "task_id", *strata.named_cells(CFG), F.col("formula").alias("COVARIATES"), *columns
    )


# --- weights and requests ---------------------------------------------------------------------


def request_map(spark, sf):
    """Request file, task map file, and the tasks read back from it."""
    path = scratch_path(spark, "requests")
    fixtures.run(spark, sf, fixtures.PART_REQUESTS).write.csv(path, sep=" ")
    versions = fixtures.run(spark, sf, fixtures.PART_VERSIONS)
    path_of_map = scratch_path(spark, "task-map")
    tables.write_task_map(
        tables.build_task_map(tables.read_requests(spark, path), versions), path_of_map
    )
    task_map = tables.read_task_map(spark, path_of_map)
    wanted = prepare_tasks(tables.requests_of_map(task_map), CFG)
    return task_map.join(
        wanted.select(F.col("task_id").alias("id"), "pgs", "outcome", "method"), "id"
    )


def weights_scan(spark, sf):
    return weights.read_weights(spark, raw_files.write_raw_files(spark, sf))


def weights_header(spark, sf):
    path = raw_files.write_raw_files(spark, sf)
    lines = weights.read_weight_headers(spark, path)
    versions = weights.header_summary(lines).select("file", "version")
    return lines.join(versions, "file").groupBy("pgs", "version", "line_no", "key", "value", "line").agg(
        F.count(F.lit(1)).alias("files")
    )


def weights_normalize(spark, sf):
    return weights.normalize_weights(raw_files.raw_weights(spark, sf))


def weights_allele_fallback(spark, sf):
    raw = raw_files.raw_weights(spark, sf).withColumnRenamed("other_allele", "hm_inferOtherAllele")
    return weights.normalize_weights(raw)


# --- scoring ----------------------------------------------------------------------------------


def _scoring(spark, sf, **options):
    dosages = fixtures.run(spark, sf, fixtures.GENOTYPES)
    w = weights.normalize_weights(raw_files.raw_weights(spark, sf))
    return _round(score_people(dosages, w, **options))


def person_score(spark, sf):
    return _scoring(spark, sf)


def person_score_salted(spark, sf):
    return _scoring(spark, sf, broadcast_rows=0, hot=0.0)


def person_score_no_ambiguous(spark, sf):
    return _scoring(spark, sf, drop_ambiguous=True)


def person_score_average(spark, sf):
    return _scoring(spark, sf, average=True)


def person_score_imputed(spark, sf):
    dosages = fixtures.run(spark, sf, fixtures.GENOTYPES)
    frequencies = dosages.groupBy("chr", "pos", F.col("alt").alias("allele")).agg(
        (F.avg("dosage") / 2).alias("freq")
    )
    return _scoring(spark, sf, frequencies=frequencies)


def _many(spark, sf, **options):
    dosages = fixtures.run(spark, sf, fixtures.GENOTYPES)
    w = weights.normalize_weights(fixtures.run(spark, sf, fixtures.WEIGHTS_MANY))
    return _round(score_many(dosages, w, **options))


def person_scores_many(spark, sf):
    """Fifty scores of everybody; dosages are shuffled once."""
    return _many(spark, sf, broadcast_rows=0)


def person_scores_many_imputed(spark, sf):
    dosages = fixtures.run(spark, sf, fixtures.GENOTYPES)
    frequencies = dosages.groupBy("chr", "pos", F.col("alt").alias("allele")).agg((F.avg("dosage") / 2).alias("freq"))
    return _many(spark, sf, frequencies=frequencies, drop_ambiguous=True, average=True)


# --- cohort and cells -------------------------------------------------------------------------


def cohort_join(spark, sf):
    tasks = prepare_tasks(fixtures.requests(spark), CFG)
    return _cohort(
        build_cohort(fixtures.scores(spark, sf), fixtures.demographics(spark, sf), tasks, CFG, OUTCOMES)
    )


def cohort_from_files(spark, sf):
    """The same from score files, one per request, and a demographics file."""
    text = {"sep": "\t", "header": True, "nullValue": "NA"}
    tasks = prepare_tasks(fixtures.requests(spark), CFG)
    folder = scratch_path(spark, "scores")
    # Worked out once for all files.
    scores = written(fixtures.scores(spark, sf).drop("pgs").withColumn("FID", F.lit(0)), "score-rows")
    paths = [f"{folder}/{'_'.join(request)}_prs.sscore" for request in fixtures.REQUESTS]
    # Each file has scores of its own, so that one read for the wrong request shows.
    for i, path in enumerate(paths):
        scores.withColumn("SCORE", F.col("SCORE") + i).write.options(**text).csv(path)
    people = scratch_path(spark, "demographics")
    fixtures.demographics(spark, sf).write.options(**text).csv(people)
    return _cohort(
        build_cohort(
            tables.read_scores(spark, paths),
            tables.read_demographics(spark, people, CFG, OUTCOMES),
            tasks,
            CFG,
            OUTCOMES,
        )
    )


def _cohort(joined: DataFrame) -> DataFrame:
    return _round(
        joined.select(
            "task_id",
            "method",
            "IID",
            "SCORE",
            "y",
            *(F.col(strata.stratum_column(s)).alias(f"stratum_{s}") for s in CFG.strata),
            F.col("sex_at_birth").alias("sex"),
            "age",
            "agesq",
            *(f"pca_{i}" for i in range(1, 17)),
        )
    )


def cohort_gaps(spark, sf):
    return _cohort(gap_rows(spark, sf, fixtures.REQUESTS))


def strata_groups(spark, sf):
    return strata.strata_groups(rows(spark, sf), CFG)


def strata_cells(spark, sf):
    return (
        strata.cells(rows(spark, sf), CFG)
        .groupBy(*KEY[:-1])
        .agg(F.count(F.lit(1)).alias("people"), F.count("y").alias("with_outcome"))
    )


def cell_complete_cases(spark, sf):
    return _named(summary.cell_sizes(rows(spark, sf), CFG), "n")


def cell_complete_cases_gaps(spark, sf):
    return _named(summary.cell_sizes(gap_rows(spark, sf, fixtures.REQUESTS), CFG), "n")


def cell_gates_gaps(spark, sf):
    sizes = summary.cell_sizes(gap_rows(spark, sf, fixtures.REQUESTS), CFG)
    return _named(sizes.where(summary.passes_gate(CFG)), "n")


def _gates(spark, sf, wanted, cfg=CFG):
    sizes = summary.cell_sizes(rows(spark, sf, cfg, wanted), cfg)
    return _named(sizes.where(summary.passes_gate(cfg)), "n")


def cell_gates_linear(spark, sf):
    return _gates(spark, sf, LIN)


def cell_gates_logistic(spark, sf):
    return _gates(spark, sf, LOG)


def cell_gates_legacy(spark, sf):
    legacy = EvalConfig.legacy().with_(outcome_alias={"bmi": "obesity"})
    return _gates(spark, sf, fixtures.REQUESTS, legacy)


def prs_summary(spark, sf):
    return _round(summary.score_summary(stored_rows(spark, sf, CFG, LIN), CFG))


def prs_summary_gaps(spark, sf):
    return _round(summary.score_summary(clustered(gap_rows(spark, sf)), CFG))


def prs_summary_binned(spark, sf):
    """The same quartiles found by narrowing bins, as for groups too large to rank in one task."""
    return _round(summary.score_summary(stored_rows(spark, sf, CFG, LIN), CFG.with_(max_ranked=100)))


def case_counts(spark, sf):
    sizes = summary.cell_sizes(rows(spark, sf, CFG, LOG), CFG).where(summary.passes_gate(CFG))
    prevalence = (F.col("y_sum") / F.col("n")).alias("DISEASE_PREV")
    return _round(_named(sizes, F.col("cases").alias("CASES"), F.col("controls").alias("CONTROLS"), prevalence))


def split_sizes(spark, sf):
    sizes = summary.cell_sizes(rows(spark, sf, CFG, LIN), CFG).where(summary.passes_gate(CFG))
    return _named(sizes, *summary.split_sizes(F.col("n"), CFG), F.col("n").alias("N"))


def onehot_sex(spark, sf):
    data = rows(spark, sf, CFG, LIN).where("y is not null and SCORE is not null and sex_at_birth is not null")
    levels = dict(make_design(data, CFG).levels)["sex_at_birth"]
    return data.select(
        "IID",
        F.inline(
            F.array(
                *(
                    F.struct(
                        F.lit(v).alias("level"),
                        (F.col("sex_at_birth") == v).cast("double").alias("value"),
                    )
                    for v in levels
                )
            )
        ),
    )


# --- models -----------------------------------------------------------------------------------


def linear_prs_only(spark, sf):
    """Closed form, all in the JVM."""
    return _round(summary.single_regressor(stored_rows(spark, sf, CFG, LIN), CFG))


def _linear(spark, sf, cfg, wanted=LIN, holdout=False):
    fitted = fit_cells(rows(spark, sf, cfg, wanted), cfg, holdout)
    return linear_report(fitted, cfg, holdout)


def linear_two_covariates(spark, sf):
    report = _linear(spark, sf, AGE)
    return _round(report.select(*KEY, "RSQ", "MSE", "N"))


def linear_full(spark, sf):
    report = _linear(spark, sf, CFG)
    return _round(incremental(report, "RSQ"))


def linear_full_gaps(spark, sf):
    """The same with missing values: each formula has its own complete cases, small cells are not reported."""
    report = linear_report(fit_cells(gap_rows(spark, sf), CFG), CFG)
    return _round(incremental(report, "RSQ"))


def incremental_rsq(spark, sf):
    report = incremental(_linear(spark, sf, AGE), "RSQ")
    return _round(report.select(*KEY, "INCREMENTAL_RSQ_PRS"))


def incremental_stored_report(spark, sf):
    """The report written as text, read back, and the gain taken from the stored rows."""
    path = scratch_path(spark, "report")
    about = prepare_tasks(fixtures.requests(spark, LIN), CFG)
    reports.export_report(reports.report_table(_linear(spark, sf, CFG), about, "linear"), path, "None")
    report = incremental(reports.read_report(spark, path, "linear"), "RSQ")
    return _round(report.select(*KEY, "INCREMENTAL_RSQ_PRS"))


def report_with_gain(spark, sf):
    """A stored report rewritten in its place with its further column, and read again."""
    path = scratch_path(spark, "report")
    about = prepare_tasks(fixtures.requests(spark, LIN), CFG)
    reports.publish_text(reports.report_table(_linear(spark, sf, CFG), about, "linear"), path, "None")
    reports.rewrite_with_gain(spark, path, "linear", "None")
    stored = reports.read_report(spark, reports.current_folder(spark, path), "linear")
    return _round(stored.select(*KEY, "RSQ", "INCREMENTAL_RSQ_PRS"))


def report_parquet(spark, sf):
    """The Parquet report, one folder per outcome, method and request, as it is read back."""
    about = prepare_tasks(fixtures.requests(spark, LIN), CFG)
    report = reports.report_table(_linear(spark, sf, CFG), about, "linear")
    back = reports.write_report(report, scratch_path(spark, "parquet-report"))
    return _round(back.select(*KEY, "RSQ", "MSE", "N"))


def weights_files(spark, sf):
    """Normalised weight files with their header lines, under the names the task map gives, read again."""
    raw, out = raw_files.write_raw_files(spark, sf), scratch_path(spark, "weight-files")
    weights.export_weight_files(weights.read_weights(spark, raw), weights.read_weight_headers(spark, raw), out)
    return weights.read_normalized(spark, out)


def weights_files_headers(spark, sf):
    raw, out = raw_files.write_raw_files(spark, sf), scratch_path(spark, "weight-files")
    weights.export_weight_files(weights.read_weights(spark, raw), weights.read_weight_headers(spark, raw), out)
    lines = weights.read_weight_headers(spark, out)
    return lines.select("pgs", F.regexp_extract("file", "weight_file=([^/]+)/", 1).alias("weight_file"), "line_no", "key", "value", "line")


def linear_holdout(spark, sf):
    cfg = CFG.with_(covariates=(), formulas=("prs_only",), linear_min_n=100, linear_min_test=20)
    report = _linear(spark, sf, cfg, holdout=True)
    return _round(report.select(*KEY, "RSQ", "MSE", "TRAINING_SIZE", "TESTING_SIZE"))


def linear_holdout_age(spark, sf):
    """All three formulas, fitted on four fifths of people with missing values in score and age."""
    cfg = AGE.with_(linear_min_n=99, linear_min_test=20)
    report = linear_report(fit_cells(attach_tasks(fixtures.cohort_gaps(spark, sf), prepare_tasks(fixtures.requests(spark, LIN), cfg), cfg, OUTCOMES), cfg, True), cfg, True)
    return _round(report.select(*KEY, "RSQ", "MSE", "TRAINING_SIZE", "TESTING_SIZE"))


def _logistic(spark, sf, cfg, wanted=LOG):
    return logistic_report(fit_cells(rows(spark, sf, cfg, wanted), cfg), cfg)


def logistic_prs_only(spark, sf):
    return _round(_logistic(spark, sf, CFG.with_(covariates=(), formulas=("prs_only",))))


def logistic_age(spark, sf):
    return _round(_logistic(spark, sf, AGE).drop("MEAN_PRS", "VAR_PRS", "MEDIAN_PRS", "PRS_Q1", "PRS_Q2", "PRS_Q3"))


def incremental_auc(spark, sf):
    report = incremental(_logistic(spark, sf, AGE), "AUC")
    return _round(report.select(*KEY, "INCREMENTAL_AUC_PRS"))


def legacy_report(spark, sf):
    """The older report of a logistic request: its gates, groups and columns."""
    cfg = EvalConfig.legacy().with_(covariates=("age",), outcome_alias={"bmi": "obesity"})
    report = evaluate_requests(
        fixtures.scores(spark, sf), fixtures.demographics(spark, sf), fixtures.requests(spark, LOG), cfg, legacy=True
    )
    absent = {*reports.LEGACY_ABSENT} & {*report.columns}
    if absent:
        raise ValueError(f"the older report has no {absent}")
    shown = ["AUC", "TRUE_POSITIVE", "FALSE_POSITIVE", "TRUE_NEGATIVE", "FALSE_NEGATIVE", "DISEASE_PREV"]
    return _round(report.select(*KEY, *shown, "INCREMENTAL_AUC_PRS"))


def whole_run(spark, sf):
    """From raw weight files and dosages to the written reports of all requests, with all covariates."""
    dosages = fixtures.run(spark, sf, fixtures.GENOTYPES)
    frequencies = dosages.groupBy("chr", "pos", F.col("alt").alias("allele")).agg((F.avg("dosage") / 2).alias("freq"))
    report = run(
        spark, fixtures.requests(spark), raw_files.write_raw_files(spark, sf), dosages,
        fixtures.demographics(spark, sf), scratch_path(spark, "whole-run"), CFG, frequencies=frequencies,
    )
    # Computed scores have more digits than those of the tables.
    moments = {c: F.round(c, 6) + F.lit(0.0) for c in ("MEAN_PRS", "VAR_PRS")}
    return _round(report).withColumns(moments)


def legacy_inputs(spark, sf):
    """People per group, read from a file by the older rules."""
    cfg, path = EvalConfig.legacy(), scratch_path(spark, "older-demographics")
    people = fixtures.demographics(spark, sf).withColumns(
        {"education": F.coalesce("education", F.lit("NA")), "race": F.when(F.col("IID") % 29 == 0, "other").otherwise(F.col("race"))}
    )
    people.write.options(sep="\t", header=True).csv(path)
    read = tables.read_demographics(spark, path, cfg, OUTCOMES).select(F.lit("PGS900001").alias("pgs"), F.lit(0.0).alias("SCORE"), "*")
    found = attach_tasks(read, prepare_tasks(fixtures.requests(spark, LIN), cfg), cfg, OUTCOMES)
    alone = strata.cells(found, cfg).where("STRATA_TWO is null")
    return alone.groupBy("STRATA_ONE", "GROUP_ONE").agg(F.count(F.lit(1)).alias("people"))


def logistic_full(spark, sf):
    return _round(incremental(_logistic(spark, sf, CFG), "AUC"))


def all_tasks_age(spark, sf):
    """Every column of both reports for all requests, with age as the only covariate."""
    return _round(
        evaluate_requests(
            fixtures.scores(spark, sf), fixtures.demographics(spark, sf), fixtures.requests(spark), AGE
        )
    )


def all_tasks_report(spark, sf):
    """Both reports of all requests with all covariates."""
    return _round(
        evaluate_requests(
            fixtures.scores(spark, sf), fixtures.demographics(spark, sf), fixtures.requests(spark), CFG
        )
    )


def many_scores(spark, sf):
    """Linear models of two dozen scores with age; the people's rows are shared by bundles of scores."""
    wanted = [(pgs, "waist_circumference", "linear") for pgs in fixtures.MANY]
    tasks = prepare_tasks(fixtures.requests(spark, wanted), AGE)
    cohort = build_bundles(fixtures.many_scores(spark, sf), fixtures.demographics(spark, sf), tasks, AGE, size=5)
    report = linear_report(fit_cells(cohort, AGE), AGE)
    return _round(report.select(*KEY, "RSQ", "MSE", "N"))


# --- distributions ----------------------------------------------------------------------------


def distribution_input(spark, sf):
    plot = dist.distribution(stored_rows(spark, sf), CFG)
    return _round(plot.groupBy(*dist.VIOLIN, "SCORE").agg(F.count(F.lit(1)).alias("people")))


def distribution_groups_exact(spark, sf):
    return dist.plotted_groups(rows(spark, sf), CFG, "exact").select(*dist.GROUP, "n")


def distribution_quartiles(spark, sf):
    return _round(dist.violin_box(dist.distribution(stored_rows(spark, sf), CFG), CFG))


def distribution_density(spark, sf):
    """Every row in the sums, at any scale."""
    return _round(dist.violin_density(dist.distribution(stored_rows(spark, sf), CFG), exact_up_to=None))


def distribution_density_binned(spark, sf):
    """Rows shared out to nodes first."""
    return _round(dist.violin_density(dist.distribution(stored_rows(spark, sf), CFG), exact_up_to=0))


QUERIES = {
    f.__name__: f
    for f in (
        request_map,
        weights_scan,
        weights_header,
        weights_normalize,
        weights_allele_fallback,
        weights_files,
        weights_files_headers,
        person_score,
        person_score_salted,
        person_score_no_ambiguous,
        person_score_average,
        person_score_imputed,
        person_scores_many,
        person_scores_many_imputed,
        cohort_join,
        cohort_from_files,
        cohort_gaps,
        strata_groups,
        strata_cells,
        cell_complete_cases,
        cell_complete_cases_gaps,
        cell_gates_gaps,
        cell_gates_linear,
        cell_gates_logistic,
        cell_gates_legacy,
        prs_summary,
        prs_summary_binned,
        prs_summary_gaps,
        case_counts,
        split_sizes,
        onehot_sex,
        linear_prs_only,
        linear_two_covariates,
        linear_full,
        linear_full_gaps,
        incremental_rsq,
        incremental_stored_report,
        report_with_gain,
        report_parquet,
        linear_holdout,
        linear_holdout_age,
        logistic_prs_only,
        logistic_age,
        incremental_auc,
        logistic_full,
        legacy_report,
        whole_run,
        all_tasks_age,
        all_tasks_report,
        many_scores,
        legacy_inputs,
        distribution_input,
        distribution_groups_exact,
        distribution_quartiles,
        distribution_density,
        distribution_density_binned,
    )
}
