"""Column expressions shared by the operators. All of them stay inside the JVM."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from cohortscope.config import BOTH, COVARIATES_ONLY, LINEAR, LOGISTIC, PRS_ONLY, EvalConfig


def method_of(regression: Column) -> Column:
    """`logistic` in any letter case is logistic; anything else is linear."""
    return F.when(F.lower(regression) == LOGISTIC, F.lit(LOGISTIC)).otherwise(F.lit(LINEAR))


def outcome_of(phenotype: Column, alias: dict[str, str]) -> Column:
    """The demographics column that holds a phenotype."""
    return reduce(
        lambda rest, pair: F.when(phenotype == pair[0], F.lit(pair[1])).otherwise(rest),
        alias.items(),
        phenotype,
    )


def null_tokens(value: Column, tokens: tuple[str, ...]) -> Column:
    return F.when(~value.isin(*tokens), value) if tokens else value


def quoted(texts: tuple[str, ...]) -> str:
    """SQL literals."""
    return ", ".join("'" + t.replace("\\", "\\\\").replace("'", "\\'") + "'" for t in texts)


def known_group(name: str, cfg: EvalConfig) -> Column:
    """The answer as text, null when it is one of the ambiguous ones (exact match)."""
    text = f"cast(`{name}` as string)"
    return F.expr(f"if({text} in ({quoted(cfg.ambiguous)}), null, {text})")


def missing_as_null(name: str) -> Column:
    """A number with NaN read as missing."""
    return F.expr(f"nullif(cast(`{name}` as double), double('NaN'))")


def all_present(names: list[str]) -> Column:
    return F.expr(" and ".join(f"`{n}` is not null" for n in names) or "true")


def formula_mask(formula: str, score_ok: Column, covariates_ok: Column) -> Column:
    """Complete cases of a formula among the rows that have an outcome."""
    return {
        PRS_ONLY: score_ok,
        BOTH: score_ok & covariates_ok,
        COVARIATES_ONLY: covariates_ok,
    }[formula]


def has_score(formula: Column) -> Column:
    return formula.isin(PRS_ONLY, BOTH)


def test_size(n: Column, fraction: float) -> Column:
    return F.ceil(F.lit(float(fraction)) * n).cast("long")


def suppressed(count: Column, threshold: int) -> Column:
    """A count that is shown only when it is above the threshold."""
    return F.when(count > threshold, count)


def balanced_accuracy(tp: Column, fp: Column, tn: Column, fn: Column) -> Column:
    """Area under the two-point curve of hard labels; null unless both classes are present."""
    return F.when(
        ((tp + fn) > 0) & ((tn + fp) > 0),
        0.5 * (tp.cast("double") / (tp + fn) + tn.cast("double") / (tn + fp)),
    )


def holdout_bucket(key: Column, seed: str) -> Column:
    """A number in 0..999 fixed by the seed and the key alone."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % 1000
