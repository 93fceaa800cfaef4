"""Small helpers on columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_computed_once(df: DataFrame, name: str, column: Column) -> DataFrame:
    """Add a costly column that later filters and columns refer to often.

    Catalyst moves a filter below a projection by writing the projected expression into
    the filter, once per reference.  It does not move filters below a generator, so one
    that yields a single row keeps the column from being computed again.
    """
    return df.select("*", F.explode(F.array(column)).alias(name))
