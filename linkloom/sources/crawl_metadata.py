"""Crawl metadata: SequenceFiles of (page address, JSON text)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType

_TEXT = "org.apache.hadoop.io.Text"
_SCHEMA = StructType([StructField("url", StringType()), StructField("json", StringType())])


def read_crawl_metadata(spark: SparkSession, paths: str) -> DataFrame:
    """``url``, ``json``.  ``paths`` is a path, a glob, or several joined by commas.

    SequenceFiles have no DataFrame source.  They are split at their sync marks, so a
    large file is read by many tasks.  The pairs stay in the JVM: no Python worker runs.
    """
    context = spark.sparkContext
    pairs = context.sequenceFile(paths, keyClass=_TEXT, valueClass=_TEXT)
    arrays = context._jvm.SerDeUtil.toJavaArray(pairs._to_java_object_rdd())
    frame = spark._jsparkSession.applySchemaToPythonRDD(arrays.rdd(), _SCHEMA.json())
    return DataFrame(frame, spark)
