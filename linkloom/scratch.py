"""Intermediate tables and files in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_folders: dict[str, str] = {}


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below ``spark.checkpoint.dir``; it goes when the application ends.

    A local session that names no folder gets a temporary one, a cluster an error.
    """
    context = spark.sparkContext
    if context.applicationId not in _folders:
        shared = spark.conf.get("spark.checkpoint.dir", None)
        if not shared:
            if not context.master.startswith("local") or context.master.startswith("local-"):
                raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
            shared = tempfile.mkdtemp(prefix="linkloom-")
        folder = f"{shared.rstrip('/')}/linkloom-{context.applicationId}-{uuid.uuid4().hex}"
        path = context._jvm.org.apache.hadoop.fs.Path(folder)
        files = path.getFileSystem(context._jsc.hadoopConfiguration())
        files.mkdirs(path)
        files.deleteOnExit(path)
        _folders[context.applicationId] = folder
    return f"{_folders[context.applicationId]}/{name}-{uuid.uuid4().hex}"


#: Spark removes the shuffle files of a query when it ends, not when the driver collects garbage.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(table: DataFrame, name: str) -> DataFrame:
    """The table from Parquet files: its lineage is cut, and no executor holds the only copy.

    The shuffle files that made it are gone as soon as it is written.
    """
    spark = table.sparkSession
    path = scratch_path(spark, name)
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        table.write.parquet(path)
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)
    return spark.read.schema(table.schema).parquet(path)
