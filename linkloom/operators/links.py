"""Links: every ``href`` found on a page, resolved and checked."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkloom.functions.html import decode_entities, href_attributes, href_value
from linkloom.functions.urls import url_id, url_text, with_url_parts
from linkloom.operators.pages import OK, unpivot_counters

# The names of the counters.
LINKS = "LINKS"
BAD_DEST_URL = "ERROR_BAD_DEST_URL"
NO_PAYLOAD = "ERROR_PAYLOAD_PARSE"


def links(pages: DataFrame) -> DataFrame:
    """One row per link of every good page, in page order, repeats and self-links kept.

    ``src`` is the id of the page and ``dst`` that of the target; links whose target is
    malformed have no ``url`` and ``dst``.  A good page whose content is absent gives one row
    with the outcome ``ERROR_PAYLOAD_PARSE`` and nothing but ``src``.  Every step is per row: nothing is shuffled,
    and only the page's id and URL parts travel with each link.
    """
    absent = F.array(F.lit(None).cast("string"))
    found = pages.where(F.col("outcome") == OK).select(
        F.col("id").alias("src"),
        "base",
        F.posexplode(
            F.coalesce(href_attributes(F.col("content").cast("string")), absent)
        ).alias("position", "attribute"),
    )
    found = found.select("src", "base", "position", href_value("attribute").alias("raw"))
    found = found.selectExpr("*", f"{decode_entities('raw')} AS href")
    found = with_url_parts(found, "href", "parts", base="base")
    found = found.withColumn("url", url_text(F.col("parts")))
    return found.select(
        "src",
        F.when(F.col("href").isNotNull(), F.col("position")).alias("position"),
        "href",
        "url",
        url_id(F.col("url")).alias("dst"),
        F.when(F.col("href").isNull(), NO_PAYLOAD)
        .when(F.col("url").isNull(), BAD_DEST_URL)
        .otherwise(OK)
        .alias("outcome"),
    )


def link_outcomes(links: DataFrame) -> DataFrame:
    """The link counters (``outcome``, ``n``); counters that stay at zero are left out."""
    return unpivot_counters(
        links.agg(
            F.count_if(F.col("outcome") == OK).alias(LINKS),
            *(F.count_if(F.col("outcome") == name).alias(name) for name in (BAD_DEST_URL, NO_PAYLOAD)),
        )
    )


def corpus_totals(df: DataFrame, target: str = "url", content: str = "html") -> DataFrame:
    """Records with a target address and the links in them, whatever their size or URL.

    ``target`` and ``content`` are SQL expressions over a table or over WARC records.
    """
    targeted = df.where(F.expr(target).isNotNull())
    n_links = F.size(href_attributes(F.expr(content).cast("string")))
    return targeted.agg(
        F.count("*").alias("records"),
        F.coalesce(F.sum(F.greatest(n_links, F.lit(0))), F.lit(0)).alias("links"),
    )
