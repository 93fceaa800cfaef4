"""The jobs from input paths to written tables.

    spark-submit --py-files linkloom.zip linkloom/plans/jobs.py edges 'in/*.warc.gz' out
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from linkloom.operators.crawl import crawl_pages
from linkloom.operators.graph import edges, vertices
from linkloom.operators.inventory import corpus_inventory
from linkloom.operators.links import links
from linkloom.operators.pages import pages_from_warc
from linkloom.operators.words import word_count
from linkloom.session import build_session
from linkloom.sinks.crawl_graph import write_crawl_graph
from linkloom.sinks.tsv import full_scan, write_tsv
from linkloom.sources.crawl_metadata import read_crawl_metadata
from linkloom.sources.files import file_chunks, text_lines
from linkloom.sources.warc import read_warc


def warc_vertices(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """The vertex table of WARC files.  No content is needed, so none is read."""
    return vertices(pages_from_warc(read_warc(spark, paths, content=False)))


def warc_edges(
    spark: SparkSession, paths: str | list[str], max_bytes: int | None = None
) -> DataFrame:
    """The edge table of WARC files.  Pages over ``max_bytes``, if given, are passed over."""
    records = read_warc(spark, paths, max_content_bytes=max_bytes)
    return edges(links(pages_from_warc(records, max_bytes=max_bytes)))


def write_warc_vertices(
    spark: SparkSession, paths: str | list[str], out: str, partitions: int | None = None
) -> None:
    found = warc_vertices(spark, paths)
    if partitions is None:
        # The aggregation has brought ids together already.
        write_tsv(found.sortWithinPartitions("id"), out)
    else:
        write_tsv(found, out, key="id", partitions=partitions)


def write_warc_edges(
    spark: SparkSession, paths: str | list[str], out: str, partitions: int | None = None
) -> None:
    write_tsv(warc_edges(spark, paths), out, key="src", partitions=partitions)


def write_crawl(spark: SparkSession, paths: str, out: str) -> None:
    write_crawl_graph(crawl_pages(read_crawl_metadata(spark, paths)), out)


def write_word_count(spark: SparkSession, paths: str | list[str], out: str) -> None:
    write_tsv(word_count(text_lines(spark, paths)).sortWithinPartitions("word"), out)


def scan_files(spark: SparkSession, paths: str | list[str]) -> None:
    full_scan(file_chunks(spark, paths).select("content"))


def write_inventory(spark: SparkSession, paths: str | list[str], out: str) -> None:
    write_tsv(corpus_inventory(spark, paths, read_warc(spark, paths, content=False)), out)


_WRITERS = {
    "vertices": write_warc_vertices,
    "edges": write_warc_edges,
    "crawl": write_crawl,
    "words": write_word_count,
    "inventory": write_inventory,
}


def main() -> None:
    parser = argparse.ArgumentParser()
    parser.add_argument("job", choices=[*_WRITERS, "scan"])
    parser.add_argument("input")
    parser.add_argument("output", nargs="?")
    args = parser.parse_args()
    spark = build_session(f"linkloom-{args.job}")
    if args.job == "scan":
        scan_files(spark, args.input)
    elif args.output is None:
        parser.error(f"{args.job} needs an output path")
    else:
        _WRITERS[args.job](spark, args.input, args.output)


if __name__ == "__main__":
    main()
