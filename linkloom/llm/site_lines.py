"""Lines that stand on too large a share of a site's pages are dropped.

Pages are grouped by host.  A line's frequency is the number of the host's different pages
that contain it, divided by the number of its different pages; exact copies of a page
count once.  Lines without a word are never counted nor dropped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkloom.llm.shield import shielded, unshielded
from linkloom.scratch import written

#: A line goes if it is on more than this share of the pages, and on so many at least.  In
#: the given documents boilerplate is on 8.6 to 13.2% of a source's pages, other lines on
#: 4.7% at most.
RATIO = 0.06
MIN_PAGES = 5
_WORD = r"[^\x20\x09-\x0D]"


def _line_hashes(text: Column) -> Column:
    """The hash of each different line that has a word."""
    lines = F.filter(F.split(text, "\n"), lambda line: F.rlike(line, F.lit(_WORD)))
    return F.array_distinct(F.transform(lines, lambda line: F.xxhash64(line)))


def boilerplate(
    documents: DataFrame, host: str = "source", ratio: float = RATIO, min_pages: int = MIN_PAGES
) -> DataFrame:
    """``host`` and ``lines``: the hashes of its boilerplate, one row for each host with any.

    A host has at most (lines of a page on average) / ``ratio`` of them, however many
    pages it has.  A hash stands for its line: two lines of one host share 64 bits with a
    probability of less than 1e-8 for 1e5 boilerplate lines and 1e6 others.
    """
    pages = documents.where(F.col("text").isNotNull()).select(
        F.col(f"`{host}`").alias("host"),
        F.xxhash64("text", F.length("text")).alias("page"),
        _line_hashes(F.col("text")).alias("lines"),
    )
    pages = pages.groupBy("host", "page").agg(F.first("lines").alias("lines"))
    totals = pages.groupBy("host").agg(F.count("*").alias("pages"))
    lines = pages.select("host", F.explode("lines").alias("line"))
    lines = lines.groupBy("host", "line").agg(F.count("*").alias("n")).where(F.col("n") >= min_pages)
    totals = totals.select(F.col("host").alias("of"), "pages")
    often = lines.join(totals, F.col("host").eqNullSafe(F.col("of")))
    often = often.where(F.col("n") > F.lit(ratio) * F.col("pages"))
    return often.groupBy("host").agg(F.sort_array(F.collect_list("line")).alias("lines"))


def drop_site_lines(
    documents: DataFrame, host: str = "source", ratio: float = RATIO, min_pages: int = MIN_PAGES
) -> DataFrame:
    """The documents with all columns; ``text`` goes without its site's boilerplate lines.

    A NULL text stays NULL, a text of boilerplate alone becomes empty.  A NULL host is a
    host like any other.  Repeated rows are all treated alike, and an empty table stays
    empty.
    """
    used = ("text", host)
    found = _with_boilerplate(shielded(documents, used), host, ratio, min_pages)
    return unshielded(found.withColumn("text", _kept_text()), documents.columns, used)


def line_report(
    documents: DataFrame, host: str = "source", ratio: float = RATIO, min_pages: int = MIN_PAGES
) -> DataFrame:
    """``doc_id``, ``n_lines``, ``n_dropped`` and the ``text`` that is left of every document."""
    kept = documents.select("doc_id", "text", F.col(f"`{host}`").alias("source"))
    found = _with_boilerplate(kept, "source", ratio, min_pages)
    before, after = F.size(F.split("text", "\n")), F.size(_kept_lines())
    return found.select(
        "doc_id",
        F.when(F.col("text").isNull(), F.lit(0)).otherwise(before).cast("long").alias("n_lines"),
        F.when(F.col("text").isNull(), F.lit(0)).otherwise(before - after).cast("long").alias("n_dropped"),
        _kept_text().alias("text"),
    )


def _with_boilerplate(documents: DataFrame, host: str, ratio: float, min_pages: int) -> DataFrame:
    # From files, so that Spark knows the size before it decides on the kind of join.
    lines = written(boilerplate(documents, host, ratio, min_pages), "boilerplate")
    lines = lines.select(F.col("host").alias("_host_"), F.col("lines").alias("_lines_"))
    return documents.join(lines, F.col(f"`{host}`").eqNullSafe(F.col("_host_")), "left")


def _kept_lines() -> Column:
    return F.filter(
        F.split("text", "\n"),
        lambda line: ~(
            F.coalesce(F.array_contains("_lines_", F.xxhash64(line)), F.lit(False)) & F.rlike(line, F.lit(_WORD))
        ),
    )


def _kept_text() -> Column:
    return F.when(F.col("_lines_").isNull(), F.col("text")).otherwise(F.array_join(_kept_lines(), "\n"))
