"""Where intermediate tables are kept.

Intermediate results that are read more than once, or that cut a growing lineage,
are written as Parquet to the folder all executors share. They survive the loss of
an executor, and their file sizes tell the planner whether a broadcast is safe.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def qualified(spark: SparkSession, path: str) -> str:
    """The path with the scheme and host that Spark reads it from."""
    return _hadoop_path(spark, path)[0].toString()


def _hadoop_path(spark: SparkSession, path: str):
    """The path with the scheme and host that Spark would use, and its file system."""
    plain = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = plain.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return files.makeQualified(plain), files


def scratch_root(spark: SparkSession) -> str:
    """The folder of this application in the shared scratch folder."""
    context = spark.sparkContext
    base = spark.conf.get(CHECKPOINT_DIR, None) or context.getCheckpointDir()
    if not base:
        if not context.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_DIR} to a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="stoplines-"))
        base = context.getCheckpointDir()
    # Python tasks must see the same file system as Spark, whatever the default one is.
    return _hadoop_path(spark, f"{base.rstrip('/')}/stoplines-{context.applicationId}")[0].toString()


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A path for a new table in the shared scratch folder; nothing is created yet."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def exists(spark: SparkSession, path: str) -> bool:
    folder, files = _hadoop_path(spark, path)
    return files.exists(folder)


def remove(spark: SparkSession, path: str) -> None:
    """Remove a folder with all that is in it; one that does not exist is no error."""
    folder, files = _hadoop_path(spark, path)
    files.delete(folder, True)


def version(spark: SparkSession, path: str) -> tuple[int, int, int]:
    """Number of files under a path, their bytes, and the latest change."""
    folder, files = _hadoop_path(spark, path)
    count = size = latest = 0
    found = files.listFiles(folder, True)
    while found.hasNext():
        status = found.next()
        count, size, latest = count + 1, size + status.getLen(), max(latest, status.getModificationTime())
    return count, size, latest


def drop_scratch(spark: SparkSession) -> None:
    """Remove all scratch tables of this application; results that still read them become invalid."""
    remove(spark, scratch_root(spark))


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write `df` to the scratch folder once and return the stored table."""
    spark = df.sparkSession
    path = scratch_dir(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
