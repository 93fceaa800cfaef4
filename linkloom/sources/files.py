"""Plain files: whole files as rows, and text files by line."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from linkloom.sources.warc import _open as open_file

CHUNK_BYTES = 4 << 20


def whole_files(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """``path``, ``length``, ``content``: one row per file.

    Files are opened only if ``content`` is used; a row holds at most 2 GiB, so larger files
    need ``file_chunks``.
    """
    return spark.read.format("binaryFile").load(paths).select("path", "length", "content")


def file_chunks(
    spark: SparkSession, paths: str | list[str], chunk_bytes: int = CHUNK_BYTES
) -> DataFrame:
    """``path``, ``number``, ``content``: the bytes of files of any size, piece by piece."""
    files = spark.read.format("binaryFile").load(paths).select("path")
    names = ["path", "number", "content"]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                number = 0
                with open_file(path, unpack=False) as stream:
                    while piece := stream.read(chunk_bytes):
                        columns = [pa.array([path]), pa.array([number]), pa.array([piece], pa.binary())]
                        yield pa.RecordBatch.from_arrays(columns, names)
                        number += 1

    return files.mapInArrow(read, "path string, number long, content binary")


def text_lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """``text``: the lines of text files, plain or compressed.

    For jobs that do not care which file a line is from.  Unlike whole files, large
    plain files are split over many tasks and a row stays small.
    """
    return spark.read.text(paths).withColumnRenamed("value", "text")
