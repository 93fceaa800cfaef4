"""Archive files made by Spark from the given tables.

The tables come as Parquet.  Queries on WARC files, SequenceFiles and text files first
write the whole table in that form below the shared scratch folder.
"""

from __future__ import annotations

import gzip
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkloom.scratch import scratch_path as scratch_path
from linkloom.sources.warc import create_file

RECORDS_PER_WARC = 40_000
WARC_DATE = "2012-02-10T21:51:20Z"
_RECORD_END = "\r\n\r\n"
_TEXT = "org.apache.hadoop.io.Text"


def http_payload(html: Column) -> Column:
    return F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html\r\nContent-Length: "),
        F.octet_length(html).cast("string"),
        F.lit("\r\n\r\n"),
        html,
    )


def write_warc(
    pages: DataFrame,
    path: str,
    records_per_file: int = RECORDS_PER_WARC,
    folder: Column | None = None,
    damaged: Column | None = None,
) -> str:
    """Write ``page_id``, ``url``, ``html`` as gzipped WARC files; returns their glob or folder.

    A NULL url gives a record without a target, and a ``damaged`` record has no length.
    With ``folder`` the files lie in folders ``folder=...``.
    """
    records = pages.withColumn("payload", http_payload(F.col("html")))
    number = F.col("page_id").cast("string")
    record = F.concat_ws(
        "\r\n",
        F.lit("WARC/1.0"),
        F.lit("WARC-Type: response"),
        F.lit(f"WARC-Date: {WARC_DATE}"),
        F.concat(F.lit("WARC-TREC-ID: page-"), number),
        F.concat(F.lit("WARC-Target-URI: "), F.col("url")),
        F.concat(F.lit("WARC-Record-ID: <urn:page:"), number, F.lit(">")),
        F.lit("Content-Type: application/http; msgtype=response"),
        F.when(
            ~(F.lit(False) if damaged is None else damaged),
            F.concat(F.lit("Content-Length: "), F.octet_length("payload").cast("string")),
        ),
        F.lit(""),
        F.col("payload"),
    )
    if records_per_file == 1 and folder is None:
        return _write_each(records.select(F.concat(record, F.lit(_RECORD_END)).alias("value")), path)
    columns = [record.alias("value")] + ([] if folder is None else [folder.alias("folder")])
    writer = (
        records.select(columns)
        .write.option("compression", "gzip")
        .option("lineSep", _RECORD_END)
        .option("maxRecordsPerFile", records_per_file)
    )
    if folder is None:
        writer.text(path)
        return path + "/*.gz"
    writer.partitionBy("folder").text(path)
    return path + "/folder=*/*.gz"


def _write_each(records: DataFrame, path: str) -> str:
    """Write each ``value`` as a gzipped file of its own; returns their folder.

    Tasks give the files their last names.  Spark's writer has the driver rename each one,
    and a local disk starts a process for each, which takes longer than all else.  Names
    follow from partition and row, so a task that runs again replaces its files.
    """
    context = records.sparkSession.sparkContext
    folder = context._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(context._jsc.hadoopConfiguration())
    files.mkdirs(folder)
    target = files.makeQualified(folder).toString()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, number = TaskContext.get().partitionId(), 0
        for batch in batches:
            for value in batch.column("value"):
                packed = gzip.compress(value.as_py().encode(), 6, mtime=0)
                create_file(f"{target}/part-{part:05d}-{number:09d}.warc.gz", packed)
                number += 1
        yield pa.RecordBatch.from_pydict({"n": [number]})

    records.mapInArrow(write, "n long").agg(F.sum("n")).collect()
    return path


def write_sequence_file(metadata: DataFrame, path: str) -> str:
    """Write ``url``, ``json`` as SequenceFiles of Text pairs; returns their glob."""
    pairs = metadata.select("url", "json").rdd.map(tuple)
    pairs.saveAsNewAPIHadoopFile(
        path,
        "org.apache.hadoop.mapreduce.lib.output.SequenceFileOutputFormat",
        keyClass=_TEXT,
        valueClass=_TEXT,
    )
    return path + "/part-*"


def write_text(documents: DataFrame, path: str) -> str:
    """Write the ``text`` of every document as text files; returns their glob."""
    documents.select("text").write.text(path)
    return path + "/part-*"
