"""The link graph: a vertex table and an edge table that share URL ids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkloom.operators.pages import OK


def vertices(pages: DataFrame) -> DataFrame:
    """``id``, ``url``: one row per page id.

    Pages that share an id are merged before the shuffle, so an address that was
    crawled very often reaches the final aggregation as one row per task.  Should two
    addresses share an id, the smaller one is kept.
    """
    good = pages.where(F.col("outcome") == OK)
    return good.groupBy("id").agg(F.min("url").alias("url"))


def edges(links: DataFrame) -> DataFrame:
    """``src``, ``dst``: one row per good link.  A bag: repeats and self-links stay."""
    return links.where(F.col("outcome") == OK).select("src", "dst")
