"""What a corpus consists of: its files, and what a full read of it touches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom.operators.pages import OK, READ_ERROR, pages_from_warc


def corpus_inventory(spark: SparkSession, paths: str | list[str], records: DataFrame) -> DataFrame:
    """One row per file that matches ``paths``, with what ``records`` holds of it.

    Files without a single record are listed with zeros, and so are files of no bytes,
    which Spark's file sources pass over.  The join has one row per file on either side,
    so its size does not follow the records.
    """
    files = spark.read.format("binaryFile").load(paths)
    files = files.select(F.col("path").alias("warc_file"), F.col("length").alias("n_bytes"))
    empty = [(path, 0) for path in _empty_files(spark, paths)]
    files = files.unionByName(spark.createDataFrame(empty, "warc_file string, n_bytes long"))
    pages = pages_from_warc(records, keep=["warc_file"])
    found = pages.groupBy("warc_file").agg(
        F.count_if(F.col("outcome") != READ_ERROR).alias("records"),
        F.count_if(F.col("outcome") == OK).alias("pages"),
        F.count_if(F.col("outcome") != OK).alias("errors"),
    )
    counts = ("records", "pages", "errors")
    return files.join(found, "warc_file", "left").na.fill(0, list(counts))


def _empty_files(spark: SparkSession, paths: str | list[str]) -> list[str]:
    """Files of no bytes among the paths, and in folders that the paths name."""
    context = spark.sparkContext
    found = []
    for pattern in [paths] if isinstance(paths, str) else paths:
        path = context._jvm.org.apache.hadoop.fs.Path(pattern)
        files = path.getFileSystem(context._jsc.hadoopConfiguration())
        for entry in files.globStatus(path) or []:
            inside = files.listStatus(entry.getPath()) if entry.isDirectory() else [entry]
            found += [
                status.getPath().toString()
                for status in inside
                if status.isFile()
                and status.getLen() == 0
                and not status.getPath().getName().startswith(("_", "."))
            ]
    return found


def scan_totals(df: DataFrame, column: str) -> DataFrame:
    """``n_rows``, ``n_bytes`` and a checksum that needs every byte of ``column``."""
    checksum = F.conv(F.left(F.md5(F.col(column).cast("binary")), F.lit(8)), 16, 10)
    return df.agg(
        F.count("*").alias("n_rows"),
        F.sum(F.octet_length(column).cast("bigint")).alias("n_bytes"),
        F.sum(checksum.cast("bigint")).alias("checksum"),
    )
