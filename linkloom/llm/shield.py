"""Columns that an operator does not use, kept apart so that their names cannot clash."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_REST = "_rest_"


def shielded(table: DataFrame, used: tuple[str, ...]) -> DataFrame:
    """The ``used`` columns, and all others in one struct."""
    others = [F.col(f"`{c}`") for c in table.columns if c not in used]
    return table.select(*used, F.struct(*(others or [F.lit(True).alias("none")])).alias(_REST))


def unshielded(table: DataFrame, columns: list[str], used: tuple[str, ...]) -> DataFrame:
    """The columns as they were before ``shielded``, in their order."""
    return table.select(*(F.col(f"`{c}`") if c in used else F.col(_REST)[c].alias(c) for c in columns))
