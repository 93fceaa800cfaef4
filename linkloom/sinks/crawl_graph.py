"""Both tables of a crawl's graph, as text, from one pass over the metadata."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkloom.functions.urls import url_id, url_text, with_url_parts
from linkloom.operators.crawl import EDGE_FILE, VERTEX_FILE, crawl_vertices
from linkloom.operators.pages import OK
from linkloom.sinks.tsv import tsv_line


def crawl_graph_lines(pages: DataFrame) -> DataFrame:
    """``table``, ``value``: the vertex line of every page and an edge line per link.

    Entry 0 of a page stands for its vertex and the others for its links, so the two
    tables need neither a second read of the input nor a cached copy of it.
    """
    vertex_columns = crawl_vertices(pages).columns
    good = pages.where(F.col("outcome") == OK)
    hrefs = F.coalesce("hrefs", F.array().cast("array<string>"))
    entries = F.concat(F.array(F.lit(None).cast("string")), hrefs)
    rows = good.select(
        "id",
        "base",
        tsv_line(vertex_columns).alias("line"),
        F.posexplode(entries).alias("entry", "href"),
    )
    is_vertex = F.col("entry") == 0
    rows = rows.withColumn("line", F.when(is_vertex, F.col("line")))
    rows = with_url_parts(rows, "href", "parts", base="base")
    url = url_text(F.col("parts"))
    edge = F.concat_ws("\t", "id", url_id(url))
    return rows.where(is_vertex | url.isNotNull()).select(
        F.when(is_vertex, VERTEX_FILE).otherwise(EDGE_FILE).alias("table"),
        F.when(is_vertex, F.col("line")).otherwise(edge).alias("value"),
    )


def write_crawl_graph(pages: DataFrame, path: str, mode: str = "error") -> None:
    """Write ``table=vertexes.out`` and ``table=edges.out`` below ``path``."""
    crawl_graph_lines(pages).write.mode(mode).partitionBy("table").text(path)
