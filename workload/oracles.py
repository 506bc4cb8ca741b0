"""The same results in plain SQL for DuckDB, written independently of the operators."""

from __future__ import annotations

from workload import fixtures as fx
from workload.raw_files import PER_FILE

STRATA = (
    "race", "ethnicity", "sex_at_birth", "ancestry_pred",
    "income_quartiles", "education", "gender", "age_quartiles",
)
BAD = (
    "PMI: Prefer Not To Answer", "PMI: Skip", "I prefer not to answer", "None", "Intersex",
    "No matching concept", "None of these", "More than one population", "None Indicated", "other",
)
LEGACY_BAD = ", ".join(f"'{b}'" for b in BAD if b != "other")
_BAD = ", ".join(f"'{b}'" for b in BAD)
_NEVER = (
    {"gender", "sex_at_birth"}, {"ancestry_pred", "race"}, {"ancestry_pred", "ethnicity"}, {"race", "ethnicity"},
)
SETS = [(s, None) for s in STRATA] + [
    (a, b)
    for i, a in enumerate(STRATA)
    for b in STRATA[i + 1 :]
    if {a, b} not in _NEVER
]
PCS = [f"pca_{i}" for i in range(1, 17)]
COVARIATES = ["age", "agesq", *PCS]
CELL = "task_id, STRATA_ONE, GROUP_ONE, STRATA_TWO, GROUP_TWO"
KEY = f"{CELL}, COVARIATES"
TASKS = (
    ("PGS900001_waist_circumference_linear", "linear", "waist_circumference"),
    ("PGS900001_bmi_logistic", "logistic", "obesity"),
    ("PGS900001_bmi_LOGISTIC", "logistic", "obesity"),
    ("PGS900001_waist_circumference_other", "linear", "waist_circumference"),
)
LIN, LOG = TASKS[:1], TASKS[1:2]


def r(expr: str, name: str) -> str:
    """Rounded as in the queries; moments of two-digit scores can lie halfway between six digits."""
    return f"round({expr}, {10 if name in ('MEAN_PRS', 'VAR_PRS') else 6}) + 0.0 as {name}"


def rows(tasks=TASKS, bad: str = _BAD) -> str:
    """CTEs cohort and rows_ (one row per request and person)."""
    clean = ", ".join(f"case when {s} not in ({bad}) then {s} end as stratum_{s}" for s in STRATA)
    parts = " union all ".join(
        f"select '{t}' as task_id, '{m}' as method, IID, SCORE, cast({y} as double) as y, sex_at_birth as sex, {clean}, {', '.join(COVARIATES)} from cohort"
        for t, m, y in tasks
    )
    return f"cohort as ({fx.duck(fx.COHORT)}), rows_ as materialized ({parts})"


def fan(tasks=TASKS, bad: str = _BAD, columns: str = "") -> str:
    """rows() and fan: every row once per cell."""
    parts = []
    for a, b in SETS:
        use_sex = not any(m in n for n in (a, b or "") for m in ("sex", "gender"))
        two = f"'{b}' as STRATA_TWO, stratum_{b} as GROUP_TWO" if b else "cast(null as varchar) as STRATA_TWO, cast(null as varchar) as GROUP_TWO"
        where = f"stratum_{a} is not null" + (f" and stratum_{b} is not null" if b else "")
        complete = " and ".join(f"{c} is not null" for c in COVARIATES + (["sex"] if use_sex else []))
        parts.append(
            f"select task_id, method, IID, '{a}' as STRATA_ONE, stratum_{a} as GROUP_ONE, {two}, SCORE, y, "
            f"{use_sex} as use_sex, ({complete}) as ok {columns} from rows_ where {where}"
        )
    return rows(tasks, bad) + ", fan as materialized (" + " union all ".join(parts) + ")"


def formulas(names=("prs_only", "prs_and_covariates", "covariates_only")) -> str:
    """long_: fan once per formula, complete cases only."""
    mask = {
        "prs_only": "SCORE is not null",
        "prs_and_covariates": "SCORE is not null and ok",
        "covariates_only": "ok",
    }
    return "long_ as (" + " union all ".join(
        f"select *, '{n}' as COVARIATES from fan where y is not null and {mask[n]}" for n in names
    ) + ")"


_SIZES = f"""sizes as (select {KEY}, method, count(*) as n, sum(y) as y_sum,
 count(*) filter (where y = 1) as cases, count(*) filter (where y = 0) as controls from long_ group by {KEY}, method)"""
_GATE = "(case when method = 'logistic' then n > 20 and y_sum > 20 else n > 20 end)"


def _sizes(tasks, select: str, where: str = "true") -> str:
    return f"with {fan(tasks)}, {formulas()}, {_SIZES} select {KEY}, {select} from sizes where {where}"


_SUMMARY = f"""select {KEY}, count(*) as n, {r('avg(SCORE)', 'MEAN_PRS')}, {r('var_samp(SCORE)', 'VAR_PRS')},
 {r('quantile_cont(SCORE, 0.5)', 'MEDIAN_PRS')}, {r('quantile_cont(SCORE, 0.25)', 'PRS_Q1')},
 {r('quantile_cont(SCORE, 0.5)', 'PRS_Q2')}, {r('quantile_cont(SCORE, 0.75)', 'PRS_Q3')} from long_ group by {KEY}"""
PRS_SUMMARY = f"with {fan(LIN)}, {formulas(('prs_only', 'prs_and_covariates'))} {_SUMMARY}"

LINEAR_PRS_ONLY = f"""with {fan(LIN)}, m as (select {CELL}, count(*) as n, regr_sxx(y, SCORE) as sxx, regr_syy(y, SCORE) as syy,
 regr_sxy(y, SCORE) as sxy from fan where y is not null and SCORE is not null group by {CELL})
select {CELL}, 'prs_only' as COVARIATES, {r('sxy * sxy / (sxx * syy)', 'RSQ')},
 {r('syy * (1 - sxy * sxy / (sxx * syy)) / n', 'MSE')},
 n - cast(ceil(0.2::double * n) as bigint) as TRAINING_SIZE, cast(ceil(0.2::double * n) as bigint) as TESTING_SIZE, n as N
from m where n > 20"""

# R2 on SCORE, on age and on both, from pairwise correlations.
_AGE_RSQ = f"""c as (select {CELL}, count(*) as n, var_pop(y) as vy, corr(y, SCORE) as r1, corr(y, age) as r2, corr(SCORE, age) as r12
 from fan where method = 'linear' and y is not null and SCORE is not null group by {CELL}),
m as (select *, 'prs_only' as COVARIATES, r1 * r1 as q from c
 union all select *, 'covariates_only' as COVARIATES, r2 * r2 as q from c
 union all select *, 'prs_and_covariates' as COVARIATES, (r1 * r1 + r2 * r2 - 2 * r1 * r2 * r12) / (1 - r12 * r12) as q from c)"""
LINEAR_AGE = f"""with {fan(LIN, columns=', age')}, {_AGE_RSQ}
select {KEY}, {r('q', 'RSQ')}, {r('vy * (1 - q)', 'MSE')}, n as N from m where n > 20"""
INCREMENTAL_RSQ = f"""with {fan(LIN, columns=', age')}, {_AGE_RSQ}, g as (select * from m where n > 20)
select {KEY}, round(max(case when COVARIATES = 'prs_and_covariates' then q end) over w - max(case when COVARIATES = 'covariates_only' then q end) over w, 6) + 0.0 as INCREMENTAL_RSQ_PRS
from g window w as (partition by {CELL})"""

LINEAR_HOLDOUT = f"""with {fan(LIN)}, b as (select *, cast('0x' || substr(md5(concat('42:', IID)), 1, 8) as bigint) % 1000 < 200 as held
 from fan where y is not null and SCORE is not null),
fit as (select {CELL}, regr_slope(y, SCORE) as slope, regr_intercept(y, SCORE) as icept, count(*) as train from b where not held group by {CELL}),
test as (select {CELL}, any_value(train) as train, count(*) as test, sum((y - icept - slope * SCORE) * (y - icept - slope * SCORE)) as sse,
 regr_syy(y, SCORE) as sst from b join fit on {' and '.join(f'b.{c} is not distinct from fit.{c}' for c in CELL.split(', '))}
 where held group by {', '.join('b.' + c for c in CELL.split(', '))})
select {CELL}, 'prs_only' as COVARIATES, {r('1 - sse / sst', 'RSQ')}, {r('sse / test', 'MSE')}, train as TRAINING_SIZE, test as TESTING_SIZE
from test where train + test > 100 and test > 20"""
LINEAR_HOLDOUT = LINEAR_HOLDOUT.replace(
    "test as (select " + CELL, "test as (select " + ", ".join(f"b.{c}" for c in CELL.split(", "))
)


LEVELS = ("Female", "Intersex", "Male")
DESIGN = ["SCORE", *COVARIATES, *(f"sex_{v}" for v in LEVELS)]
DESIGN_COLUMNS = ", " + ", ".join(COVARIATES) + ", " + ", ".join(
    f"cast(coalesce(sex = '{v}', false) as double) as sex_{v}" for v in LEVELS
)


def linear_ctes() -> str:
    """CTE gain. All covariates: covariances per cell, then elimination column by column.

    What is left of the outcome's variance after all columns are eliminated is 1 - R2.
    """
    names = [*DESIGN, "y"]
    last = len(names)
    pairs = [(i, j) for i in range(1, last + 1) for j in range(i, last + 1)]
    sums = ", ".join(f"covar_pop({names[i - 1]}, {names[j - 1]}) as c_{i}_{j}" for i, j in pairs)
    values = ", ".join(
        f"c_{min(i, j)}_{max(i, j)}" for i in range(1, last + 1) for j in range(1, last + 1)
    )
    entries = (
        f"select *, (pos - 1) // {last} + 1 as i, (pos - 1) % {last} + 1 as j from "
        f"(select {KEY}, use_sex, unnest([{values}]) as v, unnest(range(1, {last * last + 1})) as pos from g)"
    )
    first_sex = 2 + len(COVARIATES)
    used = (
        f"(i = {last} or ((COVARIATES <> 'covariates_only' or i <> 1) and (use_sex or i < {first_sex}) and (COVARIATES <> 'prs_only' or i = 1)))"
    )
    used_j = used.replace("i =", "j =").replace("i <", "j <")
    return f"""g as materialized (select {KEY}, use_sex, {sums} from long_ where method = 'linear' group by {KEY}, use_sex),
n as (select {KEY}, count(*) as n, var_pop(y) as vy from long_ where method = 'linear' group by {KEY}),
e as materialized (select * from ({entries}) where {used} and {used_j}),
d as materialized (select {KEY}, i, v from e where i = j),
scaled as materialized (select e.*, e.v / sqrt(a.v * b.v) as s from e join d a on {' and '.join(f'e.{c} is not distinct from a.{c}' for c in KEY.split(', '))} and e.i = a.i
 join d b on {' and '.join(f'e.{c} is not distinct from b.{c}' for c in KEY.split(', '))} and e.j = b.i where a.v > 1e-14 and b.v > 1e-14),
step as (select 0 as k, {KEY}, i, j, s from scaled
 union all
 select k, {KEY}, i, j, case when piv > 1e-9 then s - down * across / piv else s end as s from (
  select k + 1 as k, {KEY}, i, j, s, max(case when i = k + 1 and j = k + 1 then s end) over (partition by {KEY}) as piv,
   max(case when j = k + 1 then s end) over (partition by {KEY}, i) as down,
   max(case when i = k + 1 then s end) over (partition by {KEY}, j) as across from step where k < {last - 1}) where i > k and j > k),
q as (select {KEY}, 1 - s as q from step where k = {last - 1} and i = {last} and j = {last}),
m as (select n.*, case when q.q > 1 then 1 else q.q end as q from n join q on {' and '.join(f'n.{c} is not distinct from q.{c}' for c in KEY.split(', '))} where n.n > 20),
gain as (select *, max(case when COVARIATES = 'prs_and_covariates' then q end) over w - max(case when COVARIATES = 'covariates_only' then q end) over w as gain
 from m window w as (partition by {CELL}))"""


_SAME = " and ".join(f"{{0}}.{c} is not distinct from summary.{c}" for c in KEY.split(", "))
_SHOWN_SCORES = ", ".join(
    f"case when {{0}}.COVARIATES <> 'covariates_only' then summary.{c} end as {c}"
    for c in ("MEAN_PRS", "MEDIAN_PRS", "VAR_PRS", "PRS_Q1", "PRS_Q2", "PRS_Q3")
)
_LINEAR_COLUMNS = f"""{r('q', 'RSQ')}, {r('vy * (1 - q)', 'MSE')}, gain.n - cast(ceil(0.2::double * gain.n) as bigint) as TRAINING_SIZE,
 cast(ceil(0.2::double * gain.n) as bigint) as TESTING_SIZE, gain.n as N, {r('gain.gain', 'INCREMENTAL_RSQ_PRS')}"""


def linear_full() -> str:
    keys = ", ".join("gain." + c for c in KEY.split(", "))
    return f"""with recursive {fan(LIN, columns=DESIGN_COLUMNS)}, {formulas()}, {linear_ctes()}, summary as ({_SUMMARY})
select {keys}, {_LINEAR_COLUMNS}, {_SHOWN_SCORES.format('gain')} from gain join summary on {_SAME.format('gain')}"""


def linear_gain(columns: str) -> str:
    """Some columns of the linear report with all covariates."""
    return f"with recursive {fan(LIN, columns=DESIGN_COLUMNS)}, {formulas()}, {linear_ctes()} select {KEY}, {columns} from gain"


_GAIN = r("gain.gain", "INCREMENTAL_RSQ_PRS")


def linear_holdout_age() -> str:
    """Fitted on score and age of four fifths, measured on the others; every formula has its own complete cases."""
    same = lambda a, b: " and ".join(f"{a}.{c} is not distinct from {b}.{c}" for c in KEY.split(", "))
    key = ", ".join("l." + c for c in KEY.split(", "))
    return f"""with {fan(LIN, columns=', age')}, {formulas()},
b as materialized (select *, case when COVARIATES <> 'covariates_only' then SCORE else 0 end as x1, case when COVARIATES <> 'prs_only' then age else 0 end as x2,
 cast('0x' || substr(md5(concat('42:', IID)), 1, 8) as bigint) % 1000 < 200 as held from long_),
t as (select {KEY}, count(*) as train, avg(x1) as m1, avg(x2) as m2, avg(y) as my, var_pop(x1) as v1, var_pop(x2) as v2, covar_pop(x1, x2) as c,
 covar_pop(x1, y) as c1, covar_pop(x2, y) as c2 from b where not held group by {KEY}),
fit as (select *, case when COVARIATES = 'prs_only' then c1 / v1 when COVARIATES = 'covariates_only' then 0 else (c1 * v2 - c2 * c) / (v1 * v2 - c * c) end as b1,
 case when COVARIATES = 'prs_only' then 0 when COVARIATES = 'covariates_only' then c2 / v2 else (c2 * v1 - c1 * c) / (v1 * v2 - c * c) end as b2 from t),
e as (select {key}, any_value(train) as train, count(*) as test, var_pop(y) * count(*) as sst,
 sum(pow(y - my - b1 * (x1 - m1) - b2 * (x2 - m2), 2)) as sse from b l join fit f on {same('l', 'f')} where held group by {key})
select {KEY}, {r('1 - sse / sst', 'RSQ')}, {r('sse / test', 'MSE')}, train as TRAINING_SIZE, test as TESTING_SIZE from e where train + test > 99 and test > 20"""


def logistic_ctes(steps: int = 12) -> str:
    """CTE lgain: penalised logistic models of all covariates, by a fixed chain of Newton steps.

    Columns that a formula does not use are 0, so the penalty alone sets their coefficient, to 0. Each
    step's equations are solved by Gauss-Jordan elimination, a row of numbers per unknown.
    """
    used = ["(COVARIATES <> 'covariates_only')"] + ["(COVARIATES <> 'prs_only')"] * len(COVARIATES)
    used += ["(COVARIATES <> 'prs_only' and use_sex)"] * len(LEVELS)
    x = ", ".join(["1.0::double", *(f"case when {u} then {c} else 0 end" for c, u in zip(DESIGN, used))])
    width = len(DESIGN) + 1
    pairs = [(i, j) for i in range(1, width + 1) for j in range(i, width + 1)]
    sums = ", ".join(f"sum(w * x[{i}] * x[{j}]) as h_{i}_{j}" for i, j in pairs)
    slopes = ", ".join(f"sum((y - p) * x[{i}]) - {0 if i == 1 else f'any_value(b[{i}])'} as g_{i}" for i in range(1, width + 1))

    def line(i: int) -> str:
        entries = [f"h_{min(i, j)}_{max(i, j)}" + (" + 1" if i == j and i > 1 else "") for j in range(1, width + 1)]
        return "[" + ", ".join([*entries, f"g_{i}"]) + "]"

    lines = "[" + ", ".join(line(i) for i in range(1, width + 1)) + "]"
    parts = [
        f"""big as materialized (select *, row_number() over () as id from (select {KEY}, count(*) as n, sum(y) as cases
 from long_ where method = 'logistic' group by {KEY} having count(*) > 20 and sum(y) > 20))""",
        f"""x as materialized (select big.id, l.y, [{x}] as x from long_ l
 join big on {' and '.join(f'l.{c} is not distinct from big.{c}' for c in KEY.split(', '))})""".replace(
            "(COVARIATES", "(l.COVARIATES"
        ),
        f"beta_0 as (select id, [{', '.join(['0.0::double'] * width)}] as b from big)",
    ]
    for k in range(steps):
        parts += [
            f"""sum_{k} as materialized (select id, {sums}, {slopes} from (select *, p * (1 - p) as w from (
 select x.*, b, 1 / (1 + exp(-list_dot_product(x.x, b))) as p from x join beta_{k} using (id))) group by id)""",
            f"""aug_{k} as (select id, unnest(range(1, {width + 1})) as i, unnest({lines}) as line from sum_{k})""",
            f"""elim_{k} as (select 0 as k, id, i, line from aug_{k} union all
 select k, id, i, case when i = k then [v / line[k] for v in line]
  else [z[1] - line[k] * z[2] / top[k] for z in list_zip(line, top)] end as line
 from (select k + 1 as k, id, i, line, any_value(line) filter (where i = k + 1) over (partition by id) as top from elim_{k} where k < {width}))""",
            f"""beta_{k + 1} as materialized (select b.id, [z[1] + z[2] for z in list_zip(any_value(b.b), list(e.line[{width + 1}] order by e.i))] as b
 from beta_{k} b join elim_{k} e on b.id = e.id and e.k = {width} group by b.id)""",
        ]
    parts += [
        f"""labels as (select id, count(*) filter (where y = 1 and hit) as tp, count(*) filter (where y = 0 and hit) as fp,
 count(*) filter (where y = 0 and not hit) as tn, count(*) filter (where y = 1 and not hit) as fn
 from (select x.id, y, list_dot_product(x.x, b) > 0 as hit from x join beta_{steps} using (id)) group by id)""",
        """fitted as (select big.*, tp, fp, tn, fn, case when tp + fn > 0 and tn + fp > 0 then 0.5::double * (tp::double / (tp + fn) + tn::double / (tn + fp)) end as auc
 from big join labels using (id))""",
        f"""lgain as (select *, max(case when COVARIATES = 'prs_and_covariates' then auc end) over w - max(case when COVARIATES = 'covariates_only' then auc end) over w as gain
 from fitted window w as (partition by {CELL}))""",
    ]
    return ", ".join(parts)


def newton(names, more_than: int = 20) -> str:
    """CTE labels: penalised logistic models with up to two columns, by Newton steps from zero."""
    columns = {
        "prs_only": ("SCORE", "cast(0 as double)"),
        "prs_and_covariates": ("SCORE", "age"),
        "covariates_only": ("age", "cast(0 as double)"),
    }
    data = " union all ".join(
        f"select {CELL}, '{n}' as COVARIATES, SCORE, y, {columns[n][0]} as a, {columns[n][1]} as b from fan where method = 'logistic' and y is not null and SCORE is not null"
        for n in names
    )
    same = " and ".join(f"x.{c} is not distinct from s.{c}" for c in KEY.split(", "))
    keys = ", ".join(f"s.{c}" for c in KEY.split(", "))
    return f"""raw as ({data}),
big as (select {KEY}, row_number() over () as id, n, cases from (select {KEY}, count(*) as n, sum(y) as cases from raw group by {KEY} having count(*) > {more_than} and sum(y) > 20)),
x as materialized (select s.id, x.SCORE, x.y, x.a, x.b from raw x join big s on {same}),
step as (select 0 as k, id, cast(0 as double) as b0, cast(0 as double) as b1, cast(0 as double) as b2 from big
 union all
 select k + 1, id, b0 + (g0 * (h11 * h22 - h12 * h12) - h01 * (g1 * h22 - h12 * g2) + h02 * (g1 * h12 - h11 * g2)) / det,
  b1 + (h00 * (g1 * h22 - h12 * g2) - g0 * (h01 * h22 - h12 * h02) + h02 * (h01 * g2 - g1 * h02)) / det,
  b2 + (h00 * (h11 * g2 - g1 * h12) - h01 * (h01 * g2 - g1 * h02) + g0 * (h01 * h12 - h11 * h02)) / det
 from (select *, h00 * (h11 * h22 - h12 * h12) - h01 * (h01 * h22 - h12 * h02) + h02 * (h01 * h12 - h11 * h02) as det from (
  select k, id, b0, b1, b2, sum(y - p) as g0, sum((y - p) * a) - b1 as g1, sum((y - p) * b) - b2 as g2,
   sum(w) as h00, sum(w * a) as h01, sum(w * b) as h02, sum(w * a * a) + 1 as h11, sum(w * a * b) as h12, sum(w * b * b) + 1 as h22
  from (select *, p * (1 - p) as w from (
   select s.*, x.y, x.a, x.b, 1 / (1 + exp(-(b0 + b1 * x.a + b2 * x.b))) as p from step s join x on s.id = x.id where s.k < 15))
  group by k, id, b0, b1, b2))),
labels as (select big.id, count(*) filter (where y = 1 and hit) as tp, count(*) filter (where y = 0 and hit) as fp,
 count(*) filter (where y = 0 and not hit) as tn, count(*) filter (where y = 1 and not hit) as fn
 from (select x.id, x.y, b0 + b1 * a + b2 * b > 0 as hit from x join step s on x.id = s.id and s.k = 15) l join big on l.id = big.id group by big.id),
fitted as (select big.*, tp, fp, tn, fn, case when tp + fn > 0 and tn + fp > 0 then 0.5::double * (tp::double / (tp + fn) + tn::double / (tn + fp)) end as auc
 from big join labels on big.id = labels.id)"""


_SHOWN = (
    "case when tp > 20 then tp end as TRUE_POSITIVE, case when fp > 20 then fp end as FALSE_POSITIVE, "
    "case when tn > 20 then tn end as TRUE_NEGATIVE, case when fn > 20 then fn end as FALSE_NEGATIVE, "
    + r("cases / n", "DISEASE_PREV")
)
_CASES = "cast(cases as bigint) as CASES, cast(n - cases as bigint) as CONTROLS"
LOGISTIC_PRS_ONLY = f"""with recursive {fan(LOG)}, {formulas(('prs_only',))}, {newton(('prs_only',))}, summary as ({_SUMMARY})
select {', '.join('fitted.' + c for c in KEY.split(', '))}, {r('auc', 'AUC')}, {_SHOWN.replace('/ n', '/ fitted.n')}, MEAN_PRS, MEDIAN_PRS, VAR_PRS, PRS_Q1, PRS_Q2, PRS_Q3, {_CASES.replace('n - cases', 'fitted.n - cases')}
from fitted join summary on {' and '.join(f'fitted.{c} is not distinct from summary.{c}' for c in KEY.split(', '))}"""
_ALL = ("prs_only", "prs_and_covariates", "covariates_only")
LOGISTIC_AGE = f"""with recursive {fan(LOG, columns=', age')}, {newton(_ALL)}
select {KEY}, {r('auc', 'AUC')}, {_SHOWN}, {_CASES} from fitted"""
INCREMENTAL_AUC = f"""with recursive {fan(LOG, columns=', age')}, {newton(_ALL)}
select {KEY}, round(max(case when COVARIATES = 'prs_and_covariates' then auc end) over w - max(case when COVARIATES = 'covariates_only' then auc end) over w, 6) + 0.0 as INCREMENTAL_AUC_PRS
from fitted window w as (partition by {CELL})"""


_LOGISTIC_COLUMNS = f"""{r('auc', 'AUC')}, {_SHOWN.replace('/ n', '/ lgain.n')}, cast(cases as bigint) as CASES,
 cast(lgain.n - cases as bigint) as CONTROLS, {r('lgain.gain', 'INCREMENTAL_AUC_PRS')}"""


def logistic_full() -> str:
    keys = ", ".join("lgain." + c for c in KEY.split(", "))
    return f"""with recursive {fan(LOG, columns=DESIGN_COLUMNS)}, {formulas()}, {logistic_ctes()}, summary as ({_SUMMARY})
select {keys}, {_LOGISTIC_COLUMNS}, {_SHOWN_SCORES.format('lgain')} from lgain join summary on {_SAME.format('lgain')}"""


def all_tasks_report() -> str:
    """Both reports of all requests with all covariates."""
    phenotype = "case when method = 'logistic' then 'bmi' else 'waist_circumference' end"
    outcome = "case when method = 'logistic' then 'obesity' else 'waist_circumference' end"
    keys = {t: ", ".join(f"{t}." + c for c in KEY.split(", ")) for t in ("gain", "lgain")}
    return f"""with recursive {fan(columns=DESIGN_COLUMNS)}, {formulas()}, {linear_ctes()}, {logistic_ctes()}, summary as ({_SUMMARY}),
both_ as (select 'linear' as method, {keys['gain']}, {_LINEAR_COLUMNS}, {_SHOWN_SCORES.format('gain')} from gain join summary on {_SAME.format('gain')}
 union all by name
 select 'logistic' as method, {keys['lgain']}, {_LOGISTIC_COLUMNS}, {_SHOWN_SCORES.format('lgain')} from lgain join summary on {_SAME.format('lgain')})
select 'PGS900001' as PGS, {phenotype} as phenotype, {outcome} as outcome, * from both_"""


_SCORES = ("MEAN_PRS", "MEDIAN_PRS", "VAR_PRS", "PRS_Q1", "PRS_Q2", "PRS_Q3")


def all_tasks_age() -> str:
    """Both reports of all requests; the columns of the other method are null."""
    shown = ", ".join(
        f"case when COVARIATES <> 'covariates_only' then {c} end as {c}" for c in _SCORES
    )

    def gain(metric: str) -> str:
        return (
            f"round(max(case when COVARIATES = 'prs_and_covariates' then {metric} end) over w - "
            f"max(case when COVARIATES = 'covariates_only' then {metric} end) over w, 6) + 0.0"
        )

    phenotype = "case when method = 'logistic' then 'bmi' else 'waist_circumference' end"
    outcome = "case when method = 'logistic' then 'obesity' else 'waist_circumference' end"
    about = f"'PGS900001' as PGS, {phenotype} as phenotype, {outcome} as outcome, method"
    same = " and ".join(f"l.{c} is not distinct from s.{c}" for c in KEY.split(", "))
    key = ", ".join(f"l.{c}" for c in KEY.split(", "))
    return f"""with recursive {fan(columns=', age')}, {formulas()}, {newton(_ALL)}, {_AGE_RSQ}, summary as ({_SUMMARY}),
lin as (select {KEY}, 'linear' as method, {r('q', 'RSQ')}, {r('vy * (1 - q)', 'MSE')}, n - cast(ceil(0.2::double * n) as bigint) as TRAINING_SIZE,
 cast(ceil(0.2::double * n) as bigint) as TESTING_SIZE, n as N, {gain('q')} as INCREMENTAL_RSQ_PRS from m where n > 20 window w as (partition by {CELL})),
log as (select {KEY}, 'logistic' as method, {r('auc', 'AUC')}, {_SHOWN}, {_CASES}, {gain('auc')} as INCREMENTAL_AUC_PRS from fitted window w as (partition by {CELL})),
l as (select * from lin union all by name select * from log)
select {about}, {key}, AUC, TRUE_POSITIVE, FALSE_POSITIVE, TRUE_NEGATIVE, FALSE_NEGATIVE, DISEASE_PREV, {shown.replace('COVARIATES <>', 'l.COVARIATES <>')}, CASES, CONTROLS,
 RSQ, MSE, TRAINING_SIZE, TESTING_SIZE, l.N as N, INCREMENTAL_AUC_PRS, INCREMENTAL_RSQ_PRS
from l join summary s on {same}"""


def plot(exact: bool = False) -> str:
    """CTEs long_ (rows per stratum), groups (drawn groups) and plot."""
    parts = " union all ".join(
        f"select task_id, method, '{s}' as stratum, stratum_{s} as grp, SCORE, y from rows_ where SCORE is not null and y is not null and stratum_{s} is not null"
        for s in STRATA
    )
    bad = f"grp in ({_BAD})" if exact else " or ".join(f"contains(grp, '{b}')" for b in BAD)
    hit = "s.grp = k.grp" if exact else "contains(s.grp, k.grp)"
    return f"""{rows()}, long_ as materialized ({parts}),
sizes as (select task_id, method, stratum, grp, count(*) as n, sum(y) as cases from long_ where not ({bad}) group by task_id, method, stratum, grp),
kept as (select * from sizes where case when method = 'logistic' then cases > 20 else n > 20 end),
drawn as (select * from sizes s where exists (select 1 from kept k where k.task_id = s.task_id and k.stratum = s.stratum and {hit})),
plot as (select l.task_id, l.stratum, l.grp, case when l.method = 'logistic' then cast(cast(l.y as int) as varchar) else '' end as hue, l.SCORE
 from long_ l join drawn d on l.task_id = d.task_id and l.stratum = d.stratum and l.grp = d.grp)"""


_VIOLIN = "task_id, stratum, grp, hue"
_VIOLIN_OUT = 'task_id, stratum, grp as "group", hue'
DISTRIBUTION_INPUT = f"with {plot()} select {_VIOLIN_OUT}, {r('SCORE', 'SCORE')}, count(*) as people from plot group by {_VIOLIN}, SCORE"
DISTRIBUTION_GROUPS = f"""with {plot(True)} select task_id, stratum, grp as "group", n from drawn"""
DISTRIBUTION_QUARTILES = f"""with {plot()}, box as (select {_VIOLIN}, quantile_cont(SCORE, 0.25) as q1, quantile_cont(SCORE, 0.5) as q2, quantile_cont(SCORE, 0.75) as q3 from plot group by {_VIOLIN})
select {', '.join('p.' + c for c in ('task_id', 'stratum'))}, p.grp as "group", p.hue, count(*) as n, {r('any_value(q1)', 'q1')}, {r('any_value(q2)', 'median')}, {r('any_value(q3)', 'q3')},
 {r('min(case when SCORE >= q1 - 1.5::double * (q3 - q1) then SCORE end)', 'whisker_low')}, {r('max(case when SCORE <= q3 + 1.5::double * (q3 - q1) then SCORE end)', 'whisker_high')}
from plot p join box b using (task_id, stratum, grp, hue) group by p.task_id, p.stratum, p.grp, p.hue"""
DISTRIBUTION_DENSITY = f"""with {plot()}, shape as (select {_VIOLIN}, count(*) as n, min(SCORE) as lo, max(SCORE) as hi, stddev_samp(SCORE) * pow(count(*), -0.2::double) as h from plot group by {_VIOLIN}),
grid as (select *, lo - 2 * h + point * ((hi - lo + 4 * h) / 99) as x from shape, (select cast(unnest(range(100)) as integer) as point) where h > 0)
select task_id, stratum, grp as "group", hue, point, {r('x', 'x')}, {r('avg(exp(-0.5::double * ((x - SCORE) / h) * ((x - SCORE) / h))) / (any_value(h) * sqrt(2 * pi()))', 'density')}
from grid join (select {_VIOLIN}, SCORE from plot) using (task_id, stratum, grp, hue) group by {_VIOLIN}, point, x"""

# Rows count as mixtures of the two nearest of 32 nodes per bandwidth.
DISTRIBUTION_DENSITY_BINNED = f"""with {plot()}, shape as (select {_VIOLIN}, count(*) as n, min(SCORE) as lo, max(SCORE) as hi, stddev_samp(SCORE) * pow(count(*), -0.2::double) as h from plot group by {_VIOLIN}),
b as (select {_VIOLIN}, floor((SCORE - lo) / h * 32) as k, (SCORE - lo) / h * 32 - floor((SCORE - lo) / h * 32) as f from plot join shape using (task_id, stratum, grp, hue) where h > 0),
w as (select {_VIOLIN}, k, sum(w) as w from (select {_VIOLIN}, k, 1 - f as w from b union all select {_VIOLIN}, k + 1, f from b) group by {_VIOLIN}, k),
grid as (select *, lo - 2 * h + point * ((hi - lo + 4 * h) / 99) as x from shape, (select cast(unnest(range(100)) as integer) as point) where h > 0)
select task_id, stratum, grp as "group", hue, point, {r('x', 'x')}, {r('sum(w * exp(-0.5::double * ((x - lo - k * h / 32) / h) * ((x - lo - k * h / 32) / h))) / (any_value(n) * any_value(h) * sqrt(2 * pi()))', 'density')}
from grid join w using (task_id, stratum, grp, hue) group by {_VIOLIN}, point, x"""

_NORMAL = "pgs, chr_name as hm_chr, hm_pos, effect_allele, other_allele, effect_weight"


def scoring(select: str, where: str = "true") -> str:
    return f"""with weights as ({fx.duck(fx.WEIGHTS)}), genotypes as ({fx.duck(fx.GENOTYPES)}),
freq as (select chr, pos, alt, avg(dosage) as twice from genotypes group by chr, pos, alt),
matched as (select w.pgs, g.IID, cast(w.effect_weight as double) as weight, case when g.alt = w.effect_allele then g.dosage else 2 - g.dosage end as d,
 case when f.alt = w.effect_allele then f.twice else 2 - f.twice end as expected
 from genotypes g join weights w on g.chr = w.chr_name and g.pos = cast(w.hm_pos as bigint)
 and ((g.alt = w.effect_allele and g.ref = w.other_allele) or (g.ref = w.effect_allele and g.alt = w.other_allele))
 join freq f on g.chr = f.chr and g.pos = f.pos and g.alt = f.alt where {where})
select pgs, IID, {select} from matched group by pgs, IID"""


def _total(d: str, score: str | None = None) -> str:
    return f"2 * count({d}) as ALLELE_CT, {r(f'sum({d})', 'NAMED_ALLELE_DOSAGE_SUM')}, {r(score or f'sum({d} * weight)', 'SCORE')}"


_LEGACY_GATE = "(case when method = 'logistic' then n > 100 and y_sum > 20 else n >= 101 end)"

COHORT_JOIN = f"""with {rows()} select task_id, method, IID, {r('SCORE', 'SCORE')}, {r('y', 'y')}, {', '.join('stratum_' + s for s in STRATA)},
 sex, {r('age', 'age')}, {r('agesq', 'agesq')}, {', '.join(r(c, c) for c in PCS)} from rows_"""


def with_gaps(sql: str) -> str:
    """The same results of the cohort with missing values and small groups."""
    return sql.replace(fx.duck(fx.COHORT), fx.duck(fx.COHORT_GAPS))


def many_scores() -> str:
    """The linear report with age of two dozen scores, which do not all have the same people."""
    parts = [(f"{pgs}_waist_circumference_linear", "linear", "waist_circumference") for pgs in fx.MANY]
    sql = f"with {fan(parts, columns=', age')}, {_AGE_RSQ} select {KEY}, {r('q', 'RSQ')}, {r('vy * (1 - q)', 'MSE')}, n as N from m where n > 20"
    for pgs in fx.MANY:
        task = f"'{pgs}_waist_circumference_linear'"
        begin = sql.index(f"select {task} as task_id")
        end = sql.index("from cohort", begin) + len("from cohort")
        sql = sql[:end] + f" where pgs = '{pgs}'" + sql[end:]
    return sql.replace(fx.duck(fx.COHORT), fx.duck(fx.COHORT_MANY))


def legacy_inputs() -> str:
    """Groups of the older inputs: NA and other are ordinary answers."""
    people = fx.duck(fx.DEMOGRAPHICS)
    answer = {"race": "case when IID % 29 = 0 then 'other' else race end", "education": "coalesce(education, 'NA')"}
    parts = " union all ".join(
        f"""select '{s}' as STRATA_ONE, {answer.get(s, s)} as GROUP_ONE, count(*) as people from ({people}) where {answer.get(s, s)} not in ({LEGACY_BAD}) group by 2"""
        for s in STRATA
    )
    return f"select * from ({parts})"


# Each request's file has scores of its own.
COHORT_FROM_FILES = COHORT_JOIN.replace(
    r("SCORE", "SCORE"), r("SCORE + case task_id " + " ".join(f"when '{t}' then {i}" for i, (t, _, _) in enumerate(TASKS)) + " end", "SCORE")
)
LEGACY_REPORT = f"""with recursive {fan(LOG, LEGACY_BAD, ', age')}, {newton(_ALL, 100)}
select {KEY}, {r('auc', 'AUC')}, {_SHOWN}, round(max(case when COVARIATES = 'prs_and_covariates' then auc end) over w - max(case when COVARIATES = 'covariates_only' then auc end) over w, 6) + 0.0 as INCREMENTAL_AUC_PRS
from fitted window w as (partition by {CELL})"""
# The cohort with the scores that the raw weights and dosages give.
COMPUTED = f"""select s.pgs, s.SCORE, d.* from ({scoring("sum(coalesce(d, expected) * weight) as SCORE")}) s
 join (select * exclude (pgs, SCORE) from ({fx.duck(fx.COHORT)})) d on s.IID = d.IID where s.pgs = 'PGS900001'"""
WHOLE_RUN = f"""select * replace (round(MEAN_PRS, 6) + 0.0 as MEAN_PRS, round(VAR_PRS, 6) + 0.0 as VAR_PRS)
from ({all_tasks_report().replace(fx.duck(fx.COHORT), COMPUTED)})"""
_FILES = f"(select pgs, p_partkey // {PER_FILE} as chunk from ({fx.duck(fx.WEIGHTS)}) group by pgs, chunk)"
# The six header lines of the first kind of file; the second kind has another version.
_HEADERS = """(values (1, null, null, '###PGS CATALOG SCORING FILE'), (2, 'format_version', null, null), (3, 'pgs_id', null, null),
 (4, 'note', 'a version' || chr(9) || 'with a tab', null), (5, null, null, '###SOURCE INFORMATION'),
 (6, 'weight_type', 'beta = log(OR)', '##weight_type=beta = log(OR)')) as h(line_no, key, v, whole)"""
_HEADER_VALUE = """case when key = 'pgs_id' then pgs when key = 'format_version' then
 case when pgs = 'PGS900001' then '2.0' else '10.1' end else v end as value"""
_HEADER_LINE = f"coalesce(whole, '#' || key || '=' || {_HEADER_VALUE.replace(' as value', '')}) as line"
_VERSION = "case when pgs = 'PGS900001' then '2' else '10' end"
ORACLES = {
    "request_map": f"""with q as ({fx.duck(fx.PART_REQUESTS)}), v as ({fx.duck(fx.PART_VERSIONS)})
select concat(q.pgs, '_', phenotype, '_', regression) as id, concat(q.pgs, '_formatted_hmPOS_GRCh38.txt.gz') as weight_file, version, phenotype, regression, q.pgs,
 case when phenotype = 'bmi' then 'obesity' else phenotype end as outcome, case when lower(regression) = 'logistic' then 'logistic' else 'linear' end as method
from q left join v on q.pgs = v.pgs""",
    "weights_scan": f"select {_NORMAL} from ({fx.duck(fx.WEIGHTS)})",
    "weights_header": f"""select pgs, {_VERSION} as version, cast(line_no as int) as line_no, key, {_HEADER_VALUE}, {_HEADER_LINE}, count(*) as files
from {_FILES} f, {_HEADERS} group by all""",
    "weights_files": f"select {_NORMAL} from ({fx.duck(fx.WEIGHTS)})",
    "weights_files_headers": f"""select pgs, concat(pgs, '_formatted_hmPOS_GRCh38.txt.gz') as weight_file, cast(line_no as int) as line_no, key, {_HEADER_VALUE}, {_HEADER_LINE}
from (select distinct pgs from ({fx.duck(fx.WEIGHTS)})) f, {_HEADERS}""",
    "weights_normalize": f"select {_NORMAL} from ({fx.duck(fx.WEIGHTS)})",
    "weights_allele_fallback": f"select {_NORMAL} from ({fx.duck(fx.WEIGHTS)})",
    "person_score": scoring(_total("d")),
    "person_score_salted": scoring(_total("d")),
    "person_scores_many": scoring(_total("d")).replace(fx.duck(fx.WEIGHTS), fx.duck(fx.WEIGHTS_MANY)),
    "person_scores_many_imputed": scoring(
        _total("coalesce(d, expected)", "case when count(coalesce(d, expected)) > 0 then sum(coalesce(d, expected) * weight) / (2 * count(coalesce(d, expected))) end"),
        "concat(w.effect_allele, w.other_allele) not in ('AT', 'TA', 'CG', 'GC')",
    ).replace(fx.duck(fx.WEIGHTS), fx.duck(fx.WEIGHTS_MANY)),
    "person_score_no_ambiguous": scoring(
        _total("d"), "concat(w.effect_allele, w.other_allele) not in ('AT', 'TA', 'CG', 'GC')"
    ),
    "person_score_average": scoring(
        _total("d", "case when count(d) > 0 then sum(d * weight) / (2 * count(d)) else sum(d * weight) end")
    ),
    "person_score_imputed": scoring(_total("coalesce(d, expected)")),
    "cohort_join": COHORT_JOIN,
    "cohort_from_files": COHORT_FROM_FILES,
    "legacy_report": LEGACY_REPORT,
    "whole_run": WHOLE_RUN,
    "cohort_gaps": with_gaps(COHORT_JOIN),
    "cell_complete_cases_gaps": with_gaps(_sizes(TASKS, "n")),
    "cell_gates_gaps": with_gaps(_sizes(TASKS, "n", _GATE)),
    "prs_summary_gaps": with_gaps(PRS_SUMMARY),
    "linear_full_gaps": with_gaps(linear_full()),
    "report_with_gain": linear_gain(f"{r('q', 'RSQ')}, {_GAIN}"),
    "report_parquet": linear_gain(f"{r('q', 'RSQ')}, {r('vy * (1 - q)', 'MSE')}, n as N"),
    "strata_groups": f"with {rows()} "
    + " union ".join(
        f"""select '{s}' as stratum, stratum_{s} as "group" from rows_ where stratum_{s} is not null""" for s in STRATA
    ),
    "strata_cells": f"with {fan()} select {CELL}, count(*) as people, count(y) as with_outcome from fan group by {CELL}",
    "cell_complete_cases": _sizes(TASKS, "n"),
    "cell_gates_linear": _sizes(LIN, "n", _GATE),
    "cell_gates_logistic": _sizes(LOG, "n", _GATE),
    "cell_gates_legacy": f"with {fan(TASKS, LEGACY_BAD)}, {formulas()}, {_SIZES} select {KEY}, n from sizes where {_LEGACY_GATE}",
    "prs_summary": PRS_SUMMARY,
    "prs_summary_binned": PRS_SUMMARY,
    "case_counts": _sizes(LOG, f"cases as CASES, controls as CONTROLS, {r('y_sum / n', 'DISEASE_PREV')}", _GATE),
    "split_sizes": _sizes(
        LIN,
        "n - cast(ceil(0.2::double * n) as bigint) as TRAINING_SIZE, cast(ceil(0.2::double * n) as bigint) as TESTING_SIZE, n as N",
        _GATE,
    ),
    "onehot_sex": f"""with {rows(LIN)} select a.IID, b.level, cast(a.sex = b.level as double) as value from rows_ a,
 (select distinct sex as level from rows_ where y is not null and SCORE is not null and sex is not null) b where a.y is not null and a.SCORE is not null and a.sex is not null""",
    "linear_prs_only": LINEAR_PRS_ONLY,
    "linear_two_covariates": LINEAR_AGE,
    "linear_full": linear_full(),
    "incremental_rsq": INCREMENTAL_RSQ,
    "incremental_stored_report": linear_gain(_GAIN),
    "all_tasks_age": all_tasks_age(),
    "linear_holdout": LINEAR_HOLDOUT,
    "linear_holdout_age": with_gaps(linear_holdout_age()).replace(" and pca_3 is not null", "").replace(" and sex is not null", ""),
    "logistic_prs_only": LOGISTIC_PRS_ONLY,
    "logistic_age": LOGISTIC_AGE,
    "logistic_full": logistic_full(),
    "all_tasks_report": all_tasks_report(),
    "many_scores": many_scores(),
    "legacy_inputs": legacy_inputs(),
    "incremental_auc": INCREMENTAL_AUC,
    "distribution_input": DISTRIBUTION_INPUT,
    "distribution_groups_exact": DISTRIBUTION_GROUPS,
    "distribution_quartiles": DISTRIBUTION_QUARTILES,
    "distribution_density": DISTRIBUTION_DENSITY,
    "distribution_density_binned": DISTRIBUTION_DENSITY_BINNED,
}
