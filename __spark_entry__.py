"""Queries on the given tables, and the same results as SQL.

``queries()`` runs each operator over whole tables; ``oracle_sql()`` states what it must
return.  Where the tables lack a case, such as bad addresses or pages that share an id,
both sides derive it by the same column rules.
"""

from __future__ import annotations

import importlib
import os
import sys
import warnings
from collections.abc import Callable

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import derived_inputs as derive
from linkloom.functions.html import decode_entities, href_attributes, href_value
from linkloom.functions.urls import url_id, url_text, with_url_parts
from linkloom.operators.crawl import crawl_edges, crawl_pages, crawl_vertices
from linkloom.operators.graph import edges, vertices
from linkloom.operators.headers import warc_body, warc_headers
from linkloom.operators.inventory import corpus_inventory, scan_totals
from linkloom.operators.links import corpus_totals, link_outcomes, links
from linkloom.operators.pages import (
    page_outcomes,
    pages_from_table,
    pages_from_warc,
)
from linkloom.operators.words import word_count
from linkloom.plans import jobs
from linkloom.sinks.crawl_graph import write_crawl_graph
from linkloom.sinks.tsv import write_tsv
from linkloom.sources.crawl_metadata import read_crawl_metadata
from linkloom.sources.files import file_chunks, text_lines, whole_files
from linkloom.sources.warc import read_warc

# A size limit that some of the given pages exceed; the real one is above all of them.
PAGE_LIMIT = 4000


def _pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/pages.parquet")


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def q_vertices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page, and once more under the other protocol and with a fragment."""
    pages = _pages(spark, sf_dir)
    other = F.when(
        F.startswith("url", F.lit("https:")), F.regexp_replace("url", "^https:", "http:")
    ).otherwise(F.regexp_replace("url", "^http:", "HTTPS:"))
    mirrored = pages.withColumn(
        "url", F.explode(F.array(F.col("url"), F.concat(other, F.lit("#mirror"))))
    )
    return vertices(pages_from_table(mirrored))


def q_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edges(links(pages_from_table(_pages(spark, sf_dir))))


def _with_script_links(pages: DataFrame) -> DataFrame:
    html = F.regexp_replace("html", '<a href="/([a-m])', '<a class=x href=\'javascript:$1')
    return pages.withColumn("html", F.regexp_replace(html, 'javascript:([^"]*)"', "javascript:$1'"))


def q_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return links(pages_from_table(_with_script_links(_pages(spark, sf_dir))))


def q_link_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With some pages that have no content."""
    pages = _with_script_links(_pages(spark, sf_dir))
    pages = pages.withColumn("html", F.when(F.col("page_id") % 5 != 2, F.col("html")))
    return link_outcomes(links(pages_from_table(pages)))


def _with_bad_pages(pages: DataFrame) -> DataFrame:
    url = (
        F.when(F.contains("url", F.lit("#")), F.lit(None).cast("string"))
        .when(F.startswith("url", F.lit("https://www.")), F.concat(F.lit("no-"), F.col("url")))
        .otherwise(F.col("url"))
    )
    return pages.withColumn("url", url)


def q_page_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _with_bad_pages(_pages(spark, sf_dir))
    return page_outcomes(pages_from_table(pages, max_bytes=PAGE_LIMIT))


def q_corpus_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_totals(_with_bad_pages(_pages(spark, sf_dir)))


def q_url_identity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every link of every page, written in eight ways."""
    found = pages_from_table(_pages(spark, sf_dir))
    hrefs = found.select(
        F.col("url").alias("source"),
        "base",
        F.explode(href_attributes(F.col("content"))).alias("attribute"),
    )
    hrefs = hrefs.select("source", "base", href_value("attribute").alias("raw"))
    hrefs = hrefs.selectExpr("source", "base", f"{decode_entities('raw')} AS href")
    name = F.substring("href", 2, 1 << 30)
    forms = {
        "root": F.col("href"),
        "host": F.concat(F.lit("HTTP://U:p@WWW.Other.COM:0080"), F.col("href"), F.lit("#f")),
        "query": F.concat(F.lit("?k="), name),
        "fragment": F.concat(F.lit("#"), name),
        "folder": F.concat(F.lit("  ./"), name),
        "parent": F.concat(F.lit("../"), name),
        "script": F.concat(F.lit("javascript:"), name),
        "mail": F.concat(F.lit("mailto:"), name),
    }
    specs = F.array(*(F.struct(F.lit(k).alias("form"), v.alias("spec")) for k, v in forms.items()))
    rows = hrefs.select("source", "base", F.inline(specs))
    rows = with_url_parts(rows, "spec", "parts", base="base")
    rows = rows.withColumn("url", url_text(F.col("parts")))
    return rows.select("source", "form", "spec", "url", url_id(F.col("url")).alias("id"))


def q_word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return word_count(_documents(spark, sf_dir))


def q_file_word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = derive.scratch_path(spark, "text")
    return word_count(text_lines(spark, derive.write_text(_documents(spark, sf_dir), path)))


def q_full_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_totals(_pages(spark, sf_dir), "html")


def q_file_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bytes of all documents in text files, read whole and in pieces."""
    path = derive.scratch_path(spark, "text")
    paths = derive.write_text(_documents(spark, sf_dir), path)
    pieces = scan_totals(file_chunks(spark, paths, 1 << 16), "content")
    whole = scan_totals(whole_files(spark, paths), "content")
    return pieces.select(F.col("n_bytes").alias("piece_bytes")).crossJoin(
        whole.select(F.col("n_bytes").alias("file_bytes"))
    )


def q_custom_page_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    def bytes_by_host(pages: DataFrame) -> DataFrame:
        size = F.octet_length("content").cast("bigint")
        return pages.groupBy(F.col("base")["host"].alias("host")).agg(
            F.count("*").alias("n_pages"), F.sum(size).alias("n_bytes")
        )

    good = pages_from_table(_with_bad_pages(_pages(spark, sf_dir))).where("outcome = 'OK'")
    return good.transform(bytes_by_host)


def q_edges_tsv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = derive.scratch_path(spark, "edges")
    write_tsv(q_edges(spark, sf_dir), path, key="src")
    return spark.read.text(path)


def q_edges_tsv_16(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = derive.scratch_path(spark, "edges")
    write_tsv(q_edges(spark, sf_dir), path, key="src", partitions=16)
    return spark.read.text(path)


def q_vertices_tsv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = derive.scratch_path(spark, "vertices")
    write_tsv(q_vertices(spark, sf_dir).sortWithinPartitions("id"), path)
    return spark.read.text(path)


_written: dict[tuple[str, ...], str] = {}


def _once(spark: SparkSession, sf_dir: str, name: str, write: Callable[[str], str]) -> str:
    """The files that ``write`` makes from the tables, made once per application."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _written:
        _written[key] = write(derive.scratch_path(spark, name))
    return _written[key]


def _warc(spark: SparkSession, sf_dir: str) -> str:
    return _once(spark, sf_dir, "warc", lambda p: derive.write_warc(_pages(spark, sf_dir), p))


def q_warc_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = read_warc(spark, _warc(spark, sf_dir))
    return records.select(
        "record_type",
        "warc_date",
        "record_id",
        "content_type",
        "content_length",
        F.try_element_at("metadata", F.lit("WARC-Target-URI")).alias("target_uri"),
        F.col("content").cast("string").alias("content"),
        "read_error",
    )


def q_warc_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = read_warc(spark, _warc(spark, sf_dir), content=False)
    return warc_headers(records).drop("warc_file", "record_no", "metadata")


def q_warc_body(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc_body(read_warc(spark, _warc(spark, sf_dir))).select("target_uri", "body")


def q_warc_vertices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.warc_vertices(spark, _warc(spark, sf_dir))


def q_warc_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.warc_edges(spark, _warc(spark, sf_dir))


def q_warc_page_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _with_bad_pages(_pages(spark, sf_dir))
    paths = derive.write_warc(pages, derive.scratch_path(spark, "warc"))
    records = read_warc(spark, paths, max_content_bytes=PAGE_LIMIT)
    return page_outcomes(pages_from_warc(records, max_bytes=PAGE_LIMIT))


def q_warc_read_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One record in each file; some of them have no length."""
    damaged = F.col("page_id") % 7 == 3
    path = derive.scratch_path(spark, "warc")
    paths = derive.write_warc(_pages(spark, sf_dir), path, 1, damaged=damaged)
    return page_outcomes(pages_from_warc(read_warc(spark, paths, content=False)))


def q_warc_corpus_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = read_warc(spark, _warc(spark, sf_dir))
    return corpus_totals(records, target="metadata['WARC-Target-URI']", content="content")


def q_corpus_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files in four folders; the number of files in each is Spark's choice."""

    def write(path: str) -> str:
        pages = _with_bad_pages(_pages(spark, sf_dir))
        return derive.write_warc(pages, path, folder=F.col("page_id") % 4)

    paths = _once(spark, sf_dir, "folders", write)
    found = corpus_inventory(spark, paths, read_warc(spark, paths, content=False))
    folder = F.regexp_extract("warc_file", "/folder=([0-9]+)/", 1).cast("long")
    counts = ("records", "pages", "errors")
    return found.groupBy(folder.alias("folder")).agg(*(F.sum(c).alias(c) for c in counts))


def _metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Crawl metadata of the pages: https pages with a query have failed, for instance."""
    pages = pages_from_table(_pages(spark, sf_dir))
    raw = F.transform(href_attributes(F.col("content")), href_value).alias("raw")
    pages = pages.select("source_url", "content", raw)
    failed = F.rlike("source_url", F.lit(r"^https.*\?"))
    undecided = F.contains("source_url", F.lit("//m."))
    content = F.struct(
        F.lit("html-doc").alias("type"),
        F.expr(
            "transform(raw, r -> named_struct('type', if(length(r) < 7, 'img', 'a'),"
            " 'href', if(startswith(r, '/th'), 'javascript:', '') ||"
            f" {decode_entities('r')}))"
        ).alias("links"),
    )
    document = F.struct(
        F.when(failed, "FAILURE").when(~undecided, "SUCCESS").alias("disposition"),
        F.when(failed, "timeout").alias("failure_reason"),
        F.lit(200).alias("http_result"),
        F.octet_length("content").alias("content_len"),
        F.when(F.contains("source_url", F.lit("#")), "text/html").alias("mime_type"),
        F.when(~F.contains("source_url", F.lit("ref=")), content).alias("content"),
    )
    text = F.to_json(document)
    broken = F.endswith("source_url", F.lit("/"))
    return pages.select(
        F.when(F.contains("source_url", F.lit("//blog.")), F.concat(F.lit("no-"), "source_url"))
        .otherwise(F.col("source_url"))
        .alias("url"),
        F.when(broken, F.concat(F.lit("{\"disposition\": "), text)).otherwise(text).alias("json"),
    )


def _crawl(spark: SparkSession, sf_dir: str) -> DataFrame:
    def write(path: str) -> str:
        return derive.write_sequence_file(_metadata(spark, sf_dir), path)

    return read_crawl_metadata(spark, _once(spark, sf_dir, "metadata", write))


def q_cc_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ("disposition", "failure_reason", "http_result", "content_len", "mime_type")
    return _crawl(spark, sf_dir).select(
        "url", *(F.get_json_object("json", f"$.{n}").alias(n) for n in names)
    )


def q_cc_vertices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return crawl_vertices(crawl_pages(_crawl(spark, sf_dir)))


def q_cc_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return crawl_edges(crawl_pages(_crawl(spark, sf_dir)))


def q_cc_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = crawl_pages(_crawl(spark, sf_dir))
    return pages.groupBy("outcome", "success").agg(F.count("*").alias("n"))


def q_cc_graph_tsv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = derive.scratch_path(spark, "graph")
    write_crawl_graph(crawl_pages(_crawl(spark, sf_dir)), path)
    return spark.read.text(path).select(F.col("table").alias("file"), "value")


def entry(spark: SparkSession) -> DataFrame:
    return q_edges(spark, "/root/testdata/sf0.001")


_WARNED: set[str] = set()


def _added() -> list:
    """The modules with further queries that can be imported; any other is named once in a warning."""
    found = []
    for name in ("linkloom.llm.queries", "corpus_pipeline"):
        try:
            found.append(importlib.import_module(name))
        except ImportError as error:
            if name not in _WARNED:
                _WARNED.add(name)
                warnings.warn(f"queries of {name} left out: {error}", stacklevel=2)
    return found


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = {name[2:]: query for name, query in globals().items() if name.startswith("q_")}
    for module in _added():
        found |= module.queries()
    return found


# --- The same in SQL -----------------------------------------------------------------

_ID = "substr(to_base64(unhex(sha1({0}))), 1, 12)".format
_HOST = "lower(regexp_extract({0}, '^[a-zA-Z]+://([^/?#]*)', 1))".format
_FILE = "regexp_extract({0}, '^[a-zA-Z]+://[^/?#]*([^#]*)', 1)".format
_HREFS = "regexp_extract_all({0}, '(?is)<a\\s[^>]*?href\\s*=\\s*\"([^\"]*)\"', 1)".format
_BAD_URL = """CASE WHEN contains(url, '#') THEN NULL
    WHEN starts_with(url, 'https://www.') THEN 'no-' || url ELSE url END"""
_TOKENS = """SELECT word, count(*) AS n FROM (
  SELECT unnest(regexp_split_to_array(text, '[ \\t\\n\\r\\f]+')) AS word FROM documents)
WHERE word <> '' GROUP BY word"""

_PARTS = f"""p AS (SELECT url AS source_url, html, {_HOST("url")} AS host, {_FILE("url")} AS file
  FROM pages)"""
_PAGE_LINKS = f"""{_PARTS},
l AS (SELECT *, {_ID("host || file")} AS src, unnest({_HREFS("html")}) AS href,
    generate_subscripts({_HREFS("html")}, 1) - 1 AS position FROM p)"""
_EDGES = f"WITH {_PAGE_LINKS} SELECT src, {_ID('host || href')} AS dst FROM l"
_VERTICES = f"""SELECT id, min(url) AS url FROM (
  SELECT {_ID("url")} AS id, url FROM (SELECT {_HOST("url")} || {_FILE("url")} AS url FROM pages))
GROUP BY id"""
_LINKS = f"""WITH {_PAGE_LINKS}, s AS (SELECT *, regexp_matches(href, '^/[a-m]') AS script FROM l)
SELECT src, CAST(position AS INTEGER) AS position,
  CASE WHEN script THEN 'javascript:' || substr(href, 2) ELSE href END AS href,
  CASE WHEN NOT script THEN host || href END AS url,
  CASE WHEN NOT script THEN {_ID("host || href")} END AS dst,
  CASE WHEN script THEN 'ERROR_BAD_DEST_URL' ELSE 'OK' END AS outcome
FROM s"""
_OUTCOMES = f"""WITH b AS (SELECT {{size}} AS size, {_BAD_URL} AS url FROM pages),
o AS (SELECT CASE WHEN url IS NULL THEN 'ERROR_MISSING_TARGET'
    WHEN size > {PAGE_LIMIT} THEN 'ERROR_PAGE_TOO_LARGE'
    WHEN starts_with(url, 'no-') THEN 'ERROR_BAD_SOURCE_URL' ELSE 'OK' END AS outcome FROM b)
SELECT outcome, count(*) AS n FROM (
  SELECT CASE outcome WHEN 'OK' THEN 'PAGES' ELSE outcome END AS outcome FROM o
  UNION ALL SELECT 'PAGES' FROM o WHERE outcome = 'ERROR_BAD_SOURCE_URL')
GROUP BY outcome"""
_HTTP = """'HTTP/1.1 200 OK' || chr(13) || chr(10) || 'Content-Type: text/html' || chr(13) || chr(10)
  || 'Content-Length: ' || strlen(html) || chr(13) || chr(10) || chr(13) || chr(10) || html"""
_RECORDS = f"""SELECT 'response' AS record_type, '{derive.WARC_DATE}' AS warc_date,
  '<urn:page:' || page_id || '>' AS record_id,
  'application/http; msgtype=response' AS content_type,
  CAST(strlen(content) AS BIGINT) AS content_length, url AS target_uri, content, page_id
FROM (SELECT *, {_HTTP} AS content FROM pages)"""

_META = f"""m AS (SELECT *,
    regexp_matches(source_url, '^https.*[?]') AS failed,
    contains(source_url, '//m.') AS undecided,
    contains(source_url, '#') AS typed,
    NOT contains(source_url, 'ref=') AS filled,
    ends_with(source_url, '/') AS broken,
    contains(source_url, '//blog.') AS bad,
    strlen(html) AS size, {_ID("host || file")} AS id FROM p)"""
_CC_PAGES = f"""{_PARTS}, {_META},
v AS (SELECT *, NOT failed AND NOT undecided AS success FROM m WHERE NOT broken AND NOT bad)"""
_CC_VERTICES = f"""WITH {_CC_PAGES}
SELECT host || file AS url, id, success,
  CASE WHEN success AND filled THEN 'html-doc' END AS cc_content_type,
  CASE WHEN success THEN '200' END AS http_result,
  CASE WHEN success THEN CAST(size AS VARCHAR) END AS http_content_length,
  CASE WHEN success AND typed THEN 'text/html' END AS http_mime_type,
  CASE WHEN failed THEN 'timeout' END AS failure_reason,
  CAST(NULL AS VARCHAR) AS failure_detail
FROM v"""
_CC_EDGES = f"""WITH {_CC_PAGES},
l AS (SELECT *, unnest({_HREFS("html")}) AS href FROM v WHERE success AND filled)
SELECT id AS src, {_ID("host || href")} AS dst FROM l WHERE length(href) >= 7
  AND NOT starts_with(href, '/th')"""


def oracle_sql() -> dict[str, str]:
    found = dict(_SQL)
    for module in _added():
        found |= module.oracle_sql()
    return found


_SQL = {
    "vertices": _VERTICES,
    "edges": _EDGES,
    "links": _LINKS,
    "link_outcomes": f"""SELECT CASE outcome WHEN 'OK' THEN 'LINKS' ELSE outcome END AS outcome,
  count(*) AS n FROM ({_LINKS.replace("FROM pages", "FROM pages WHERE page_id % 5 <> 2")}) GROUP BY 1
UNION ALL SELECT 'ERROR_PAYLOAD_PARSE', count(*) FROM pages WHERE page_id % 5 = 2""",
    "page_outcomes": _OUTCOMES.format(size="strlen(html)"),
    "corpus_totals": f"""SELECT count(*) AS records,
  CAST(coalesce(sum(len({_HREFS("html")})), 0) AS BIGINT) AS links
FROM pages WHERE ({_BAD_URL}) IS NOT NULL""",
    "url_identity": f"""WITH {_PAGE_LINKS},
n AS (SELECT host || file AS source, host, file, href, substr(href, 2) AS name,
    regexp_extract(file, '^([^?]*/)', 1) AS folder FROM l),
u AS (
  SELECT source, 'root' AS form, href AS spec, host || href AS url FROM n
  UNION ALL SELECT source, 'host', 'HTTP://U:p@WWW.Other.COM:0080' || href || '#f',
    'www.other.com:80' || href FROM n
  UNION ALL SELECT source, 'query', '?k=' || name, host || folder || '?k=' || name FROM n
  UNION ALL SELECT source, 'fragment', '#' || name, source FROM n
  UNION ALL SELECT source, 'folder', '  ./' || name, host || folder || name FROM n
  UNION ALL SELECT source, 'parent', '../' || name,
    host || regexp_replace(folder, '[^/]+/$', '') || name FROM n
  UNION ALL SELECT source, 'script', 'javascript:' || name, NULL FROM n
  UNION ALL SELECT source, 'mail', 'mailto:' || name, name FROM n)
SELECT source, form, spec, url, {_ID("url")} AS id FROM u""",
    "word_count": _TOKENS,
    "file_word_count": _TOKENS,
    "full_scan": """SELECT count(*) AS n_rows, CAST(sum(strlen(html)) AS BIGINT) AS n_bytes,
  CAST(sum(CAST('0x' || substr(md5(html), 1, 8) AS BIGINT)) AS BIGINT) AS checksum FROM pages""",
    "custom_page_job": f"""SELECT {_HOST("url")} AS host, count(*) AS n_pages,
  CAST(sum(strlen(html)) AS BIGINT) AS n_bytes
FROM (SELECT html, {_BAD_URL} AS url FROM pages)
WHERE url IS NOT NULL AND NOT starts_with(url, 'no-') GROUP BY 1""",
    "file_scan": """SELECT CAST(sum(strlen(text) + 1) AS BIGINT) AS piece_bytes,
  CAST(sum(strlen(text) + 1) AS BIGINT) AS file_bytes FROM documents""",
    "corpus_inventory": f"""SELECT page_id % 4 AS folder, count(*) AS records,
  CAST(count(*) FILTER (WHERE url IS NOT NULL AND NOT starts_with(url, 'no-')) AS BIGINT) AS pages,
  CAST(count(*) FILTER (WHERE url IS NULL OR starts_with(url, 'no-')) AS BIGINT) AS errors
FROM (SELECT page_id, {_BAD_URL} AS url FROM pages) GROUP BY 1""",
    "warc_read_errors": """SELECT CASE WHEN page_id % 7 = 3 THEN 'ERROR_RECORD_READ' ELSE 'PAGES' END
  AS outcome, count(*) AS n FROM pages GROUP BY 1""",
    "warc_corpus_totals": f"""SELECT count(*) AS records,
  CAST(coalesce(sum(len({_HREFS("html")})), 0) AS BIGINT) AS links FROM pages""",
    "edges_tsv_16": f"SELECT src || chr(9) || dst AS value FROM ({_EDGES})",
    "edges_tsv": f"SELECT src || chr(9) || dst AS value FROM ({_EDGES})",
    "vertices_tsv": f"SELECT id || chr(9) || url AS value FROM ({_VERTICES})",
    "warc_scan": f"""SELECT record_type, warc_date, record_id, content_type, content_length,
  target_uri, content, CAST(NULL AS VARCHAR) AS read_error FROM ({_RECORDS})""",
    "warc_headers": f"""SELECT record_type, warc_date, record_id, content_type, content_length,
  target_uri, 'page-' || page_id AS doc_id,
  CAST(length('WARC/1.0' || record_type || warc_date || record_id || content_type || content_length
    || target_uri || 'page-' || page_id)
    + length('WARC-TypeWARC-DateWARC-Record-IDContent-TypeContent-LengthWARC-Target-URIWARC-TREC-ID')
    + 1 + 7 * 3 + content_length AS BIGINT) AS total_length
FROM ({_RECORDS})""",
    "warc_body": "SELECT url AS target_uri, chr(13) || chr(10) || html AS body FROM pages",
    "warc_vertices": _VERTICES,
    "warc_edges": _EDGES,
    "warc_page_outcomes": _OUTCOMES.format(size=f"strlen({_HTTP})"),
    "cc_scan": f"""WITH {_PARTS}, {_META}
SELECT CASE WHEN bad THEN 'no-' || source_url ELSE source_url END AS url,
  CASE WHEN broken THEN NULL WHEN failed THEN 'FAILURE' WHEN NOT undecided THEN 'SUCCESS' END
    AS disposition,
  CASE WHEN failed AND NOT broken THEN 'timeout' END AS failure_reason,
  CASE WHEN NOT broken THEN '200' END AS http_result,
  CASE WHEN NOT broken THEN CAST(size AS VARCHAR) END AS content_len,
  CASE WHEN typed AND NOT broken THEN 'text/html' END AS mime_type
FROM m""",
    "cc_vertices": _CC_VERTICES,
    "cc_edges": _CC_EDGES,
    "cc_outcomes": f"""WITH {_PARTS}, {_META}
SELECT CASE WHEN bad THEN 'ERROR_BAD_SOURCE_URL' WHEN broken THEN 'ERROR_JSON' ELSE 'OK' END AS outcome,
  NOT broken AND NOT failed AND NOT undecided AS success, count(*) AS n FROM m GROUP BY 1, 2""",
    "cc_graph_tsv": f"""SELECT 'edges.out' AS file, src || chr(9) || dst AS value FROM ({_CC_EDGES})
UNION ALL SELECT 'vertexes.out', concat_ws(chr(9), url, id, success, coalesce(cc_content_type, 'null'),
  coalesce(http_result, 'null'), coalesce(http_content_length, 'null'),
  coalesce(http_mime_type, 'null'), coalesce(failure_reason, 'null'),
  coalesce(failure_detail, 'null')) FROM ({_CC_VERTICES})""",
}
