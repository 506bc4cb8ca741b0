"""A table of marks of a fixed size, to find wanted rows again in a second pass without a shuffle of texts.

A row's slot is a number below MARKS that SQL and tasks compute alike. Rows that share a slot with a wanted one
are found as well and fall out in an exact join afterwards, so the table's size bounds what is broadcast, not
what is found.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARKS = 1 << 26
# Slot of a place: a number of the content, and a document's id, row and place in it.
PLACE = f"({{}} ^ doc ^ row ^ shiftleft(cast({{}} as long), 13)) & {MARKS - 1}L"


def place_slots(content: np.ndarray, doc: np.ndarray, row: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The slots that ``PLACE`` gives."""
    return (content ^ doc ^ row ^ (at.astype(np.int64) << 13)) & (MARKS - 1)


def marks_of(rows: DataFrame, slot: str) -> np.ndarray:
    """The table with the slots of all rows set: at most MARKS / 64 words of 64 bits come to the driver."""
    words = rows.selectExpr(f"{slot} as slot").groupBy(F.expr("slot div 64").alias("word")).agg(
        F.expr("bit_or(shiftleft(1L, cast(slot % 64 as int))) as bits")
    )
    table, found = np.zeros(MARKS // 64, np.uint64), words.toArrow()
    table[found.column("word").to_numpy()] = found.column("bits").to_numpy().view(np.uint64)
    return table


def marked(table: np.ndarray, slots: np.ndarray) -> np.ndarray:
    """Which slots are set."""
    return (table[slots >> 6] >> (slots & 63).astype(np.uint64) & np.uint64(1)).astype(bool)
