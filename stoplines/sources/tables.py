"""Parquet tables."""

from __future__ import annotations

import threading
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stoplines.storage import materialize, qualified, remove

# Rows of one day that one task writes to one file.
ROWS_PER_FILE = 500_000
# Rows that one task sorts and writes, and files that it opens.
ROWS_PER_TASK, FILES_PER_TASK = 500_000, 64
# Values of the first cluster column that the Bloom filter of a row group has room for.
CLUSTERS_PER_FILE = 10_000


# Folders above which Spark lists a table by a job.
LISTING_JOB = "spark.sql.sources.parallelPartitionDiscovery.threshold"
_LISTING = threading.Lock()


@contextmanager
def _listed(spark: SparkSession, path: str) -> Iterator[None]:
    """List a table on a local file system without a job: a job sends the status of every file, and for that Hadoop
    asks for its owner by a process per file, which takes ten times as long as the listing."""
    if not qualified(spark, path).startswith("file:"):
        yield
        return
    with _LISTING:
        before = spark.conf.get(LISTING_JOB)
        spark.conf.set(LISTING_JOB, str(1 << 30))
        try:
            yield
        finally:
            spark.conf.set(LISTING_JOB, before)


def read_table(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """A stored table. With a schema also a layer without any row can be read, and no file is opened before the query runs."""
    with _listed(spark, path):
        return (spark.read.schema(schema) if schema else spark.read).parquet(path)


def tasks_for(spark: SparkSession, rows: int) -> int:
    """Tasks among which rows are dealt to be sorted or aggregated: the memory of one doesn't grow with the rows."""
    return max(spark.sparkContext.defaultParallelism, -(-rows // ROWS_PER_TASK))


def write_table(df: DataFrame, path: str) -> None:
    """Write to a new folder; an existing one is an error, since tables are never changed in place."""
    df.write.mode("errorifexists").parquet(path)


def write_by_day(
    df: DataFrame,
    day: str,
    path: str,
    append: bool = False,
    rows_per_file: int = ROWS_PER_FILE,
    cluster: tuple[str, ...] = (),
    only_days: bool = False,
    staged: bool = False,
    **options: str,
) -> None:
    """Replace `path` by the rows of `df`, or add them, in one folder per value of `day`.

    With `only_days` only the folders of the days in `df` are replaced; `df` may read the same table.

    The rows are evaluated once and stored, unless they come from a stored table as they are (`staged`); how many there are of a day is
    then read from that one column. A
    day goes to one file, or to as many as its rows need, in tasks of their own. There is a task for about ROWS_PER_TASK
    rows, where a file counts as some more of them, and AQE doesn't merge them: opening a file takes longer than filling
    it, so that many small days must be written side by side. Files are dealt round, the largest first, so that no
    task has more rows to sort than the mean and one file, however unevenly they lie on the days.

    Within a file rows are in the order of the `cluster` columns, and the first of them has a Bloom filter, so that a reader
    of one of its values skips the row groups without it.
    """
    spark = df.sparkSession
    stored = df if staged else materialize(df, "by-day")
    rows = stored.groupBy(F.col(day).alias("_day")).agg(F.count("*").alias("_rows"))
    sized = rows.withColumn("_files", F.ceil(F.col("_rows") / rows_per_file).cast("int"))
    # One row per day of the calendar, however many rows a day has.
    largest = W.orderBy((F.col("_rows") / F.col("_files")).desc(), "_day").rowsBetween(W.unboundedPreceding, -1)
    files = materialize(sized.withColumn("_before", F.coalesce(F.sum("_files").over(largest), F.lit(0))), "days")
    weight = F.col("_rows") + F.col("_files") * (ROWS_PER_TASK // FILES_PER_TASK)
    total = files.agg(F.coalesce(F.sum(weight), F.lit(0)).alias("n")).first()["n"]
    tasks = tasks_for(spark, total)
    share = F.when(F.col("_files") > 1, F.pmod(F.xxhash64(*df.columns), F.col("_files"))).otherwise(F.lit(0))
    dealt = stored.join(files.drop("_rows"), F.col(day).eqNullSafe(F.col("_day")), "left").withColumn("_file", share)
    dealt = dealt.repartitionById(tasks, F.pmod(F.col("_before") + F.col("_file"), F.lit(tasks)).cast("int"))
    dealt = dealt.sortWithinPartitions(day, *cluster).select(*df.columns)
    writer = dealt.write.mode("append" if append else "overwrite").partitionBy(day).options(**options)
    if only_days:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    if cluster:
        writer = writer.option(f"parquet.bloom.filter.enabled#{cluster[0]}", "true")
        writer = writer.option(f"parquet.bloom.filter.expected.ndv#{cluster[0]}", str(CLUSTERS_PER_FILE))
    writer.parquet(path)


def write_by_date(df: DataFrame, time: str, path: str, append: bool = False, cluster: tuple[str, ...] = ()) -> None:
    """As `write_by_day`, with the day of the column `time` as `date`."""
    write_by_day(df.withColumn("date", F.to_date(time)), "date", path, append, cluster=cluster)


def drop_days(spark: SparkSession, path: str, day: str, days: list) -> None:
    """Remove the folders of some days of a table."""
    for value in days:
        remove(spark, f"{path}/{day}={'__HIVE_DEFAULT_PARTITION__' if value is None else value}")
