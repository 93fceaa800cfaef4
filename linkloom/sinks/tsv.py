"""Tab-separated text and other sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


_NUMBER = "_number"


def tsv_line(columns: Sequence[str]) -> Column:
    """The fields joined by tabs: no quoting, booleans as true/false, NULL as ``null``."""
    fields = (F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in columns)
    return F.concat_ws("\t", *fields)


def keyed(df: DataFrame, key: str, partitions: int | None = None) -> DataFrame:
    """Rows brought together by ``key`` and sorted by it inside each partition.

    By default the number and size of partitions follow the data at run time: small ones
    are merged, and one that is swollen by a frequent key is divided.  With ``partitions``
    there are so many ranges of keys of about the same size; a frequent key takes several.
    """
    if partitions is None:
        return df.hint("rebalance", key).sortWithinPartitions(key)
    numbered = df.withColumn(_NUMBER, F.monotonically_increasing_id())
    spread = numbered.repartitionByRange(partitions, key, _NUMBER)
    return spread.sortWithinPartitions(key).drop(_NUMBER)


def write_tsv(
    df: DataFrame,
    path: str,
    key: str | None = None,
    partitions: int | None = None,
    mode: str = "error",
    compression: str = "none",
) -> None:
    """Write ``df`` as tab-separated lines without a header, laid out by ``key`` if given."""
    laid_out = df if key is None else keyed(df, key, partitions)
    lines = laid_out.select(tsv_line(df.columns).alias("value"))
    lines.write.mode(mode).option("compression", compression).text(path)


def write_parquet(
    df: DataFrame,
    path: str,
    key: str | None = None,
    partitions: int | None = None,
    mode: str = "error",
) -> None:
    """The same layout as :func:`write_tsv`, as Parquet."""
    (df if key is None else keyed(df, key, partitions)).write.mode(mode).parquet(path)


def full_scan(df: DataFrame) -> None:
    """Compute every column of every row and keep nothing: the cost of reading alone."""
    df.write.format("noop").mode("overwrite").save()
