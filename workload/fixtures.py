"""Score-evaluation inputs derived from the driver's tables.

The text is SQL that Spark and DuckDB both run (``varchar(20)`` becomes ``string`` in Spark), so the
checks can build the same inputs on both sides.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession

# Multipliers of the sixteen principal-component columns.
PC_MULTIPLIERS = (17, 29, 41, 53, 67, 79, 97, 103, 127, 139, 151, 163, 181, 193, 211, 227)
_PCS = ", ".join(
    f"cast((c.c_custkey * {k}) % 1009 as double) / 1009 as pca_{i}"
    for i, k in enumerate(PC_MULTIPLIERS, 1)
)

SCORES = """
select 'PGS900001' as pgs, o.o_custkey as IID, count(*) * 2 as ALLELE_CT,
 sum(cast(l.l_linenumber % 3 as double)) as NAMED_ALLELE_DOSAGE_SUM,
 cast(sum((l.l_linenumber % 3) * (p.p_size - 25)) as double) / 100 as SCORE
from {lineitem} l join {orders} o on l.l_orderkey = o.o_orderkey join {part} p on l.l_partkey = p.p_partkey
group by o.o_custkey"""

DEMOGRAPHICS = f"""
select c.c_custkey as IID, r.r_name as ancestry_pred,
 case when c.c_custkey % 23 = 0 then 'None of these' else c.c_mktsegment end as race,
 case when c.c_custkey % 31 = 0 then 'PMI: Skip' when c.c_custkey % 5 < 2 then 'Hispanic or Latino' else 'Not Hispanic or Latino' end as ethnicity,
 case when c.c_custkey % 37 = 0 then 'Intersex' when c.c_custkey % 2 = 0 then 'Female' else 'Male' end as sex_at_birth,
 case when c.c_custkey % 41 = 0 then 'I prefer not to answer' when c.c_custkey % 2 = 0 then 'Woman' else 'Man' end as gender,
 case when c.c_acctbal < 1500 then 'Q1' when c.c_acctbal < 4500 then 'Q2' when c.c_acctbal < 7500 then 'Q3' else 'Q4' end as income_quartiles,
 case when c.c_custkey % 7 = 0 then null when c.c_custkey % 3 = 0 then 'College' else 'No College' end as education,
 case when 18 + c.c_custkey % 60 < 33 then 'Q1' when 18 + c.c_custkey % 60 < 48 then 'Q2' when 18 + c.c_custkey % 60 < 63 then 'Q3' else 'Q4' end as age_quartiles,
 cast(18 + c.c_custkey % 60 as double) as age, cast((18 + c.c_custkey % 60) * (18 + c.c_custkey % 60) as double) as agesq,
 c.c_acctbal as acctbal, {_PCS}
from {{customer}} c join {{nation}} n on c.c_nationkey = n.n_nationkey join {{region}} r on n.n_regionkey = r.r_regionkey"""

# The outcomes carry a signal of the score, so they are added to the demographics after a join.
COHORT = f"""
select q.*,
 case when IID % 53 = 0 then null else acctbal / 200 + age / 5 + 6 * SCORE end as waist_circumference,
 case when IID % 59 = 0 then null when acctbal / 100 + age + 30 * SCORE > 95 then 1 else 0 end as obesity
from (select s.pgs, s.SCORE, d.* from ({SCORES}) s join ({DEMOGRAPHICS}) d on s.IID = d.IID) q"""

# Two dozen scores of the same people; every fourth one lacks a fifth of them.
MANY = tuple(f"PGS8{k:05d}" for k in range(24))
_PEOPLE = ", ".join(
    ("ancestry_pred", "race", "ethnicity", "sex_at_birth", "gender", "income_quartiles", "education", "age_quartiles", "age", "agesq",
     *(f"pca_{i}" for i in range(1, 17)))
)
COHORT_MANY = f"""
select concat('PGS8', substr(cast(100000 + k as varchar(20)), 2, 5)) as pgs,
 SCORE * (k % 7 + 1) + cast((IID * (k + 3)) % 97 as double) / 7 as SCORE, IID, {_PEOPLE}, waist_circumference, obesity
from ({COHORT}) q, (select cast(t.k as bigint) as k from (values {', '.join(f'({k})' for k in range(24))}) t(k)) n
where not (k % 4 = 3 and IID % 5 = 0)"""

# The same people with missing scores, ages, components and sex, and groups of 20 to 25 people.
COHORT_GAPS = f"""
select g.pgs, case when IID % 17 = 0 then null else SCORE end as SCORE, IID, ancestry_pred, race, ethnicity,
 case when IID % 13 = 0 then null else sex_at_birth end as sex_at_birth, gender, income_quartiles,
 case when place <= 20 then 'Level 20' when place <= 41 then 'Level 21' when place <= 63 then 'Level 22'
  when place <= 88 then 'Level 25' else education end as education, age_quartiles,
 case when IID % 19 = 0 then null else age end as age, agesq, acctbal,
 {', '.join(f'case when IID % 29 = 0 then null else pca_{i} end as pca_{i}' if i == 3 else f'pca_{i}' for i in range(1, 17))},
 waist_circumference, obesity
from (select c.*, row_number() over (order by IID) as place from ({COHORT}) c) g"""

_ALLELES = """substr('ACGT', cast(p_size % 4 as int) + 1, 1) as effect_allele,
 substr('ACGT', cast((p_size + 1 + p_partkey % 3) % 4 as int) + 1, 1) as other_allele"""

# Raw weight rows. Two files: the second has no other_allele column, only the inferred one.
WEIGHTS = f"""
select case when p_partkey % 2 = 0 then 'PGS900001' else 'PGS900002' end as pgs,
 cast(p_partkey % 22 + 1 as varchar(20)) as chr_name, cast(p_partkey % 21 + 2 as varchar(20)) as hm_chr,
 case when p_partkey % 97 = 0 then null else cast(p_partkey * 100 as varchar(20)) end as hm_pos,
 {_ALLELES}, cast(p_size - 25 as varchar(20)) as effect_weight, p_partkey
from {{part}}"""

# Fifty scores; each has a third of the variants, some of their weights are 0.
WEIGHTS_MANY = f"""
select concat('PGS7', substr(cast(100000 + k as varchar(20)), 2, 5)) as pgs, chr_name, hm_chr, hm_pos, effect_allele, other_allele,
 cast((p_partkey * (k + 1)) % 7 - 3 as varchar(20)) as effect_weight, p_partkey
from ({WEIGHTS}) w, (select cast(t.k as bigint) as k from (values {', '.join(f'({k})' for k in range(50))}) t(k)) n
where (p_partkey + k) % 3 = 0"""

GENOTYPES = f"""
select o.o_custkey as IID, cast(l.l_partkey % 22 + 1 as varchar(20)) as chr, l.l_partkey * 100 as pos,
 case when l.l_partkey % 11 = 0 then w.other_allele else w.effect_allele end as alt,
 case when l.l_partkey % 11 = 0 then w.effect_allele else w.other_allele end as ref,
 case when l.l_orderkey % 101 = 0 then null else cast(l.l_linenumber % 3 as double) end as dosage
from {{lineitem}} l join {{orders}} o on l.l_orderkey = o.o_orderkey
 join (select p_partkey, {_ALLELES} from {{part}}) w on l.l_partkey = w.p_partkey"""

# The request rows (score, phenotype, regression).
REQUESTS = (
    ("PGS900001", "waist_circumference", "linear"),
    ("PGS900001", "bmi", "logistic"),
    ("PGS900001", "bmi", "LOGISTIC"),
    ("PGS900001", "waist_circumference", "other"),
)
# Request and version tables that grow with the part table; some scores have no version.
PART_REQUESTS = """
select concat('PGS', cast(p_partkey as varchar(20))) as pgs,
 case when p_size % 2 = 0 then 'bmi' else 'waist_circumference' end as phenotype,
 case when p_size % 4 = 0 then 'logistic' when p_size % 4 = 1 then 'linear' when p_size % 4 = 2 then 'LOGISTIC' else 'other' end as regression
from {part}"""
PART_VERSIONS = """
select concat('PGS', cast(p_partkey as varchar(20))) as pgs, cast(p_size % 3 + 1 as varchar(20)) as version
from {part} where p_partkey % 10 <> 0"""
TABLES = ("lineitem", "orders", "part", "customer", "nation", "region")


def duck(sql: str) -> str:
    """The text for DuckDB, where the tables are views."""
    return sql.format(**{t: t for t in TABLES})


@lru_cache(maxsize=256)
def _table(spark: SparkSession, application: str, path: str) -> DataFrame:
    """The schema of a file is looked up once per application."""
    return spark.read.parquet(path)


def run(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    application = spark.sparkContext.applicationId
    tables = {
        t: _table(spark, application, f"{sf_dir}/{t}.parquet") for t in TABLES if f"{{{t}}}" in sql
    }
    return spark.sql(sql.replace("varchar(20)", "string"), **tables)


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run(spark, sf_dir, SCORES)


def demographics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Demographics with the two outcome columns; every person of the score table is in it once."""
    cohort = run(spark, sf_dir, COHORT)
    return cohort.drop("pgs", "SCORE")


def cohort(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run(spark, sf_dir, COHORT)


def cohort_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run(spark, sf_dir, COHORT_GAPS)


def many_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run(spark, sf_dir, COHORT_MANY).select("pgs", "IID", "SCORE")


def requests(spark: SparkSession, wanted=REQUESTS) -> DataFrame:
    values = ", ".join(str(r) for r in wanted)
    return spark.sql(f"select * from values {values} as t(pgs, phenotype, regression)")
