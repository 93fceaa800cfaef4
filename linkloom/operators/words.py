"""Word counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def words(df: DataFrame, text: str = "text") -> DataFrame:
    """One row per token.  Only white space separates tokens; case and punctuation stay."""
    valid = F.make_valid_utf8(F.col(text).cast("string"))
    tokens = F.split(valid, "[ \\t\\n\\r\\f]+")
    return df.select(F.explode(tokens).alias("word")).where(F.col("word") != "")


def word_count(df: DataFrame, text: str = "text") -> DataFrame:
    """``word``, ``n``.  Counts are summed per task first, so frequent words stay cheap."""
    return words(df, text).groupBy("word").agg(F.count("*").alias("n"))
