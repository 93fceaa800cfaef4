"""Pages: crawled records with a checked, normalised source URL and an outcome."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkloom.functions.urls import url_id, url_text, with_url_parts

# The size limit that a job may set for pages, and the names of the counters.
MAX_PAGE_BYTES = 4 * 1024 * 1024
PAGES = "PAGES"
READ_ERROR = "ERROR_RECORD_READ"
MISSING_TARGET = "ERROR_MISSING_TARGET"
TOO_LARGE = "ERROR_PAGE_TOO_LARGE"
BAD_SOURCE_URL = "ERROR_BAD_SOURCE_URL"
OK = "OK"

TARGET_HEADER = "WARC-Target-URI"


def target_uri(metadata: Column) -> Column:
    """The page address among a record's headers; NULL if it has none."""
    return F.try_element_at(metadata, F.lit(TARGET_HEADER))


def pages_from_table(
    df: DataFrame,
    url: str = "url",
    html: str = "html",
    keep: Sequence[str] = (),
    max_bytes: int | None = None,
    length: str | None = None,
) -> DataFrame:
    """Pages from any table that has a URL and a text or binary HTML column.

    With ``max_bytes`` larger pages are set aside; ``length`` names a column that has the
    size in bytes, so that the HTML need not be read to measure it.
    """
    size = F.octet_length(html) if length is None else F.col(length)
    return _pages(
        df.select(
            *keep,
            F.col(url).alias("source_url"),
            F.col(html).alias("content"),
            size.alias("content_length"),
            F.lit(None).cast("string").alias("read_error"),
        ),
        keep,
        max_bytes,
    )


def pages_from_warc(
    records: DataFrame, keep: Sequence[str] = (), max_bytes: int | None = None
) -> DataFrame:
    """Pages from WARC records.  Records of every type count, as long as they have a target."""
    return _pages(
        records.select(
            *keep,
            target_uri(F.col("metadata")).alias("source_url"),
            "content",
            "content_length",
            "read_error",
        ),
        keep,
        max_bytes,
    )


def _pages(df: DataFrame, keep: Sequence[str], max_bytes: int | None) -> DataFrame:
    df = with_url_parts(df, "source_url", "base")
    df = df.withColumn("url", url_text(F.col("base")))
    large = F.lit(False) if max_bytes is None else F.col("content_length") > max_bytes
    outcome = (
        F.when(F.col("read_error").isNotNull(), READ_ERROR)
        .when(F.col("source_url").isNull(), MISSING_TARGET)
        .when(large, TOO_LARGE)
        .when(F.col("url").isNull(), BAD_SOURCE_URL)
        .otherwise(OK)
    )
    return df.select(
        *keep,
        "source_url",
        "base",
        "url",
        url_id(F.col("url")).alias("id"),
        "content",
        outcome.alias("outcome"),
    )


def page_outcomes(pages: DataFrame) -> DataFrame:
    """The page counters (``outcome``, ``n``); counters that stay at zero are left out.

    ``PAGES`` counts every page that is looked at, so it includes those whose own URL
    turns out to be bad.
    """
    outcome = F.col("outcome")
    errors = (READ_ERROR, MISSING_TARGET, TOO_LARGE, BAD_SOURCE_URL)
    return unpivot_counters(
        pages.agg(
            F.count_if(outcome.isin(OK, BAD_SOURCE_URL)).alias(PAGES),
            *(F.count_if(outcome == name).alias(name) for name in errors),
        )
    )


def unpivot_counters(counters: DataFrame) -> DataFrame:
    """A row of counters as rows of (``outcome``, ``n``), without those at zero."""
    return counters.unpivot([], counters.columns, "outcome", "n").where("n > 0")
