"""Cohort cuts: every group of every stratum, and every pair of groups of an allowed pair of strata.

A cell is named by (set_id, group_one, group_two) while it is worked on; ``group_two`` is empty for a
single stratum. ``named_cells`` turns that into the four reported columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortscope.config import EvalConfig
from cohortscope.functions.columns import quoted
from cohortscope.operators.cohort import covariates_ok, stratum_column

CELL = ["set_id", "group_one", "group_two"]
TASK_CELL = ["task_id", *CELL]
# Groups of a stratum that are looked up by their position in a list.
MAX_CODED = 256


def strata_groups(rows: DataFrame, cfg: EvalConfig) -> DataFrame:
    """Distinct groups of every stratum, without nulls and ambiguous answers. One pass."""
    return (
        rows.unpivot(
            [],
            [F.col(stratum_column(s)).alias(s) for s in cfg.strata],
            "stratum",
            "group",
        )
        .where(F.col("group").isNotNull())
        .distinct()
    )


def fan_out(rows: DataFrame, cfg: EvalConfig, keep: list[str | Column]) -> DataFrame:
    """One row per input row and cell it belongs to; ``keep`` travels along.

    ``covariates_ok`` says whether the row's covariates are complete for that cell's formulas: pass
    ``ok_with_sex`` and ``ok_without_sex`` in the input to get it.
    """
    # One SQL expression: a column call per value would cost the driver more than the query.
    values = ", ".join(
        f"{s.set_id}, `{stratum_column(s.one)}`, "
        + (f"`{stratum_column(s.two)}`" if s.two else "''")
        + (", ok_with_sex" if s.use_sex else ", ok_without_sex")
        for s in cfg.strata_sets()
    )
    cells = F.expr(f"stack({len(cfg.strata_sets())}, {values})")
    return rows.select(*keep, cells.alias("set_id", "group_one", "group_two", "covariates_ok")).where(
        "group_one is not null and group_two is not null"
    )


def group_lists(rows: DataFrame, cfg: EvalConfig) -> dict[str, list[str]] | None:
    """The groups of every stratum; None when a stratum has too many to look up by position."""
    found = strata_groups(rows, cfg).limit(len(cfg.strata) * MAX_CODED + 1).collect()
    lists = {s: sorted(r.group for r in found if r.stratum == s) for s in cfg.strata}
    return lists if all(len(v) <= MAX_CODED for v in lists.values()) else None


def fan_out_coded(
    rows: DataFrame, cfg: EvalConfig, lists: dict[str, list[str]], keep: list[str | Column]
) -> DataFrame:
    """As ``fan_out``, with the cell as one number, which is much cheaper to group by than names."""
    coded = with_codes(rows, cfg, lists)
    values = ", ".join(
        f"{code}, {'ok_with_sex' if s.use_sex else 'ok_without_sex'}" for s, code in zip(cfg.strata_sets(), cell_codes(cfg))
    )
    cells = F.expr(f"stack({len(cfg.strata_sets())}, {values})")
    return coded.select(*keep, cells.alias("cell", "covariates_ok")).where("cell is not null")


def with_codes(rows: DataFrame, cfg: EvalConfig, lists: dict[str, list[str]]) -> DataFrame:
    """Add the place of each stratum's group in its list, as ``code_0`` and so on."""
    return rows.withColumns(
        {
            f"code_{i}": F.expr(
                f"array_position(array({quoted(tuple(lists[s]))}), `{stratum_column(s)}`)"
                if lists[s]
                else "cast(null as bigint)"
            )
            for i, s in enumerate(cfg.strata)
        }
    )


def cell_codes(cfg: EvalConfig) -> list[str]:
    """For every set, the number of the cell that a row with codes is in, null if it is in none."""
    return [
        f"{s.set_id << 40}L + shiftleft(code_{cfg.strata.index(s.one)}, 20)" + (f" + code_{cfg.strata.index(s.two)}" if s.two else "")
        for s in cfg.strata_sets()
    ]


def decoded_cell(cfg: EvalConfig, lists: dict[str, list[str]]) -> list[Column]:
    """The cell columns of a number made by ``fan_out_coded``."""
    groups = ", ".join(
        f"array({quoted(tuple(lists[s]))})" if lists[s] else "array('')" for s in cfg.strata
    )
    sets = cfg.strata_sets()
    one = ", ".join(str(cfg.strata.index(s.one)) for s in sets)
    two = ", ".join(str(cfg.strata.index(s.two)) if s.two else "-1" for s in sets)
    set_id = "cast(shiftright(cell, 40) as int)"
    first = "cast(shiftright(cell, 20) & 1048575 as int) - 1"
    second = "cast(cell & 1048575 as int) - 1"
    return [
        F.expr(f"{set_id} as set_id"),
        F.expr(f"array({groups})[array({one})[{set_id}]][{first}] as group_one"),
        F.expr(
            f"if(array({two})[{set_id}] < 0, '', get(get(array({groups}), array({two})[{set_id}]), {second})) as group_two"
        ),
    ]


def with_completeness(rows: DataFrame, cfg: EvalConfig) -> DataFrame:
    """Whether a row's covariates are complete, with and without sex; rows that say so already stay."""
    if {"ok_with_sex", "ok_without_sex"} <= set(rows.columns):
        return rows
    return rows.withColumns(
        {
            "ok_with_sex": covariates_ok(cfg, True),
            "ok_without_sex": covariates_ok(cfg, False),
        }
    )


def named_cells(cfg: EvalConfig) -> list[Column]:
    """The four reported cell columns."""
    sets = cfg.strata_sets()
    one = "array(" + ", ".join(f"'{s.one}'" for s in sets) + ")"
    two = "array(" + ", ".join(f"'{s.two}'" if s.two else "null" for s in sets) + ")"
    single = "array(" + ", ".join("false" if s.two else "true" for s in sets) + ")"
    return [
        F.expr(f"{one}[set_id]").alias("STRATA_ONE"),
        F.col("group_one").alias("GROUP_ONE"),
        F.expr(f"{two}[set_id]").alias("STRATA_TWO"),
        F.expr(f"if({single}[set_id], null, group_two)").alias("GROUP_TWO"),
    ]


def cells(rows: DataFrame, cfg: EvalConfig) -> DataFrame:
    """The cohort cut into cells: request, cell, score, outcome and completeness of covariates."""
    return fan_out(
        with_completeness(rows, cfg), cfg, ["task_id", "method", "SCORE", "y"]
    ).select(
        "task_id", "method", *named_cells(cfg), "SCORE", "y", "covariates_ok"
    )
