"""Crawl metadata: a vertex table with crawl details, and an edge table.

Each page comes as its address and a JSON object that says how the crawl went and, if
it went well, which links the page has.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkloom.functions.columns import with_computed_once
from linkloom.functions.urls import url_id, url_text, with_url_parts
from linkloom.operators.pages import BAD_SOURCE_URL, OK

JSON_ERROR = "ERROR_JSON"

# Member names, and the values that are looked for.
_FAILURE_MEMBERS = ("failure_reason", "failure_detail")
_SUCCESS_MEMBERS = ("http_result", "mime_type", "content_len")
_FAILURE = "FAILURE"
_ANCHOR = "a"
VERTEX_FILE = "vertexes.out"
EDGE_FILE = "edges.out"

_MEMBERS = ("disposition", *_FAILURE_MEMBERS, *_SUCCESS_MEMBERS)
_JSON_SCHEMA = (
    ", ".join(f"{name} STRING" for name in _MEMBERS)
    + ", content STRUCT<type: STRING, links: ARRAY<STRUCT<type: STRING, href: STRING>>>"
    + ", _corrupt STRING"
)
_JSON_OPTIONS = {
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": "_corrupt",
    "allowUnquotedFieldNames": "true",
    "allowComments": "true",
}
_MAP = "map<string,string>"


def crawl_pages(metadata: DataFrame) -> DataFrame:
    """One row per page of crawl metadata (``url``, ``json``), parsed and checked.

    ``outcome`` is ``OK``, or says that the address or the JSON is bad.  Only the row
    itself is set aside; the others of its file are not affected.
    """
    df = metadata.select(F.col("url").alias("source_url"), "json")
    df = with_url_parts(df, "source_url", "base")
    df = df.withColumn("url", url_text(F.col("base")))
    df = with_computed_once(df, "page", F.from_json("json", _JSON_SCHEMA, _JSON_OPTIONS))
    page = F.col("page")
    success = F.coalesce(page["disposition"] != _FAILURE, F.lit(False))
    df = df.withColumns({"success": success, "unclear": _is_unclear()})
    members = F.when(F.col("unclear"), F.from_json("json", _MAP, _JSON_OPTIONS))
    df = with_computed_once(df, "members", members)
    content = F.from_json(_member("members", "content"), _MAP, _JSON_OPTIONS)
    df = with_computed_once(df, "content", content)
    outcome = (
        F.when(F.col("url").isNull(), BAD_SOURCE_URL)
        .when(_json_is_bad(), JSON_ERROR)
        .otherwise(OK)
    )
    df = with_computed_once(df, "outcome", outcome)

    def if_success(column: Column) -> Column:
        return F.when(F.col("success"), column)

    anchors = F.filter(page["content"]["links"], lambda link: link["type"] == _ANCHOR)
    hrefs = if_success(F.transform(anchors, lambda link: link["href"]))
    df = df.withColumn("hrefs", hrefs)  # a plain column, so that a query without links prunes it
    return df.select(
        "source_url",
        "base",
        "url",
        url_id(F.col("url")).alias("id"),
        "success",
        if_success(page["content"]["type"]).alias("cc_content_type"),
        if_success(page["http_result"]).alias("http_result"),
        if_success(page["content_len"]).alias("http_content_length"),
        if_success(page["mime_type"]).alias("http_mime_type"),
        *(F.when(~F.col("success"), page[name]).alias(name) for name in _FAILURE_MEMBERS),
        "hrefs",
        "outcome",
    )


def _member(members: str, name: str) -> Column:
    return F.try_element_at(F.col(members), F.lit(name))


def _is_unclear() -> Column:
    """Whether the first parse leaves open if a row's JSON is good.

    It cannot tell a null member from a missing one, or an object from text that looks
    like one.  The few rows this may concern are parsed again, as maps.
    """
    page = F.col("page")
    has_null = F.contains("json", F.lit("null")) & F.rlike("json", F.lit(r":\s*null"))
    unclear = page["_corrupt"].isNotNull() | has_null
    for text in (*(page[name] for name in _MEMBERS), page["content"]["type"]):
        unclear = unclear | F.coalesce(_looks_nested(text), F.lit(False))
    return unclear


def _looks_nested(text: Column) -> Column:
    return text.startswith("{") | text.startswith("[")


def _json_is_bad() -> Column:
    """Broken JSON, or a member that is used but is null or of the wrong type."""
    page, success = F.col("page"), F.col("success")
    bad_link = F.exists(
        page["content"]["links"],
        lambda link: link.isNull()
        | link["type"].isNull()
        | ((link["type"] == _ANCHOR) & link["href"].isNull()),
    )
    return (
        page.isNull()
        | (success & F.coalesce(bad_link, F.lit(False)))
        | F.when(F.col("unclear"), _json_is_bad_after_all()).otherwise(False)
    )


def _json_is_bad_after_all() -> Column:
    page, success = F.col("page"), F.col("success")

    def is_null(members: str, name: str) -> Column:
        present = F.map_contains_key(F.col(members), name)
        return F.coalesce(present & _member(members, name).isNull(), F.lit(False))

    def is_nested(text: Column, path: str) -> Column:
        value = F.try_variant_get(F.try_parse_json("json"), f"$.{path}", "variant")
        nested = F.schema_of_variant(value).rlike(r"\A(OBJECT|ARRAY)")
        return F.coalesce(F.when(_looks_nested(text), nested), F.lit(False))

    def is_bad(name: str) -> Column:
        return is_null("members", name) | is_nested(page[name], name)

    def any_of(conditions: list[Column]) -> Column:
        return reduce(or_, conditions)

    on_success = [
        *map(is_bad, _SUCCESS_MEMBERS),
        page["_corrupt"].isNotNull(),
        is_null("members", "content"),
        is_null("content", "type"),
        is_nested(page["content"]["type"], "content.type"),
        is_null("content", "links"),
    ]
    on_failure = list(map(is_bad, _FAILURE_MEMBERS))
    return (
        F.col("members").isNull()
        | is_bad("disposition")
        | F.when(success, any_of(on_success)).otherwise(any_of(on_failure))
    )


def crawl_vertices(pages: DataFrame) -> DataFrame:
    """One row per good page, in the column order of the text output; no row is merged."""
    return pages.where(F.col("outcome") == OK).select(
        "url",
        "id",
        "success",
        "cc_content_type",
        "http_result",
        "http_content_length",
        "http_mime_type",
        "failure_reason",
        "failure_detail",
    )


def crawl_edges(pages: DataFrame) -> DataFrame:
    """``src``, ``dst``: one row per anchor with a good target on a good page."""
    good = pages.where(F.col("outcome") == OK)
    found = good.select(F.col("id").alias("src"), "base", F.explode("hrefs").alias("href"))
    found = with_url_parts(found, "href", "parts", base="base")
    url = url_text(F.col("parts"))
    return found.where(url.isNotNull()).select("src", url_id(url).alias("dst"))
