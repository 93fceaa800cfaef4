"""Views of single WARC records: their headers, and their text without HTTP headers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkloom.operators.pages import target_uri

# A header name, and the names that stand around header values when a
# record header is written out.
DOC_ID_HEADER = "WARC-TREC-ID"
_VERSION = "WARC/1.0"
_FIELD_HEADERS = {
    "record_type": "WARC-Type",
    "warc_date": "WARC-Date",
    "record_id": "WARC-Record-ID",
    "content_type": "Content-Type",
    "content_length": "Content-Length",
}
_HTTP_LENGTH = "Content-Length:"


def warc_headers(records: DataFrame) -> DataFrame:
    """The headers of each record, and the length of the record with its header.

    Only ``content_length`` is needed, so the records may be read without content.
    """
    good = records.where(F.col("read_error").isNull())
    return good.select(
        "warc_file",
        "record_no",
        "record_type",
        "warc_date",
        "record_id",
        "content_type",
        "content_length",
        target_uri(F.col("metadata")).alias("target_uri"),
        F.try_element_at("metadata", F.lit(DOC_ID_HEADER)).alias("doc_id"),
        "metadata",
        _total_length().alias("total_length"),
    )


def _total_length() -> Column:
    """Characters of the header, one "name: value" line each, plus bytes of content."""
    total = F.lit(len(_VERSION) + 1) + F.col("content_length")
    for column, header in _FIELD_HEADERS.items():
        value = F.coalesce(F.col(column).cast("string"), F.lit(""))
        total = total + F.length(value) + len(header) + 3
    others = F.transform_values("metadata", lambda k, v: F.length(k) + F.length(v) + 3)
    return F.aggregate(F.map_values(others), total.cast("bigint"), lambda n, x: n + x)


def warc_body(records: DataFrame) -> DataFrame:
    """``body``: the text after the line with the first HTTP ``Content-Length:``.

    Without such a line it is the text after the first line.
    """
    good = records.where(F.col("read_error").isNull())
    text = F.make_valid_utf8(F.col("content").cast("string"))
    good = good.select("warc_file", "record_no", "metadata", text.alias("text"))
    marked = F.greatest(F.instr("text", _HTTP_LENGTH), F.lit(1))
    line_end = F.call_function("locate", F.lit("\n"), F.col("text"), marked)
    rest = F.substring(F.col("text"), line_end + 1, F.lit((1 << 31) - 1))
    return good.select(
        "warc_file",
        "record_no",
        target_uri(F.col("metadata")).alias("target_uri"),
        rest.alias("body"),
    )
