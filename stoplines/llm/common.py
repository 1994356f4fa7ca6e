"""What the operators share: row identity, sizes, connected components, Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stoplines.storage import materialize

BYTES_PER_PARTITION = 16 << 20
# Texts are worked on in pieces of about this size, so that a Python worker stays small.
SLICE_BYTES = 4 << 20


def fold(modulus: int, doc_id: str = "doc_id") -> Column:
    """crc32 of the id's text, modulo `modulus`; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % modulus


def partitions_for(df: DataFrame, bytes_per_partition: int = BYTES_PER_PARTITION) -> int:
    """Shuffle partitions for rows of the size of `df`: the session's number, more for more bytes."""
    planned = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    # A plan without statistics reports a size near 2^63: then the session's number stands.
    return max(planned, size // bytes_per_partition) if size < 1 << 60 else planned


def text_key(text: str = "text") -> Column:
    """128 hash bits of a text, as 16 bytes; null has a key of its own.

    Rows with the same id and text are the same document and get the same results. A table may
    hold ids more than once, or null; the key tells its rows apart where their texts differ.
    """
    return F.coalesce(F.unhex(F.md5(F.col(text).cast("binary"))), F.lit(bytes(16)))


def keys_of(column: pa.Array) -> np.ndarray:
    """[n, 2]: the 16 bytes of each key as two integers."""
    return np.ascontiguousarray(string_buffer(column)[0]).view("<i8").reshape(-1, 2)


def key_array(keys: np.ndarray) -> pa.Array:
    """The keys as 16 bytes each again."""
    return binary_array(np.ascontiguousarray(keys, "<i8").view(np.uint8).reshape(-1), np.arange(len(keys) + 1) * 16)


def slices(batch: pa.RecordBatch, column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows of about `limit` bytes in one column; a longer row comes alone."""
    values = batch.column(column)
    sizes = pc.fill_null(pc.binary_length(values), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes)
    at = 0
    while at < batch.num_rows:
        base = ends[at] - sizes[at]
        n = max(1, int(np.searchsorted(ends, base + limit, "right")) - at)
        yield batch.slice(at, n)
        at += n


def arrow_map(
    df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str | T.StructType,
    column: str | None = "text", limit: int = SLICE_BYTES,
) -> DataFrame:
    """Apply `fn` to Arrow batches of about `limit` bytes in `column`; None stands for no rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, column, limit) if column else [batch]:
                out = fn(part) if part.num_rows else None
                if out is not None and out.num_rows:
                    yield out

    return df.mapInArrow(run, schema)


def string_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string or binary column in one array, and the n + 1 offsets; null is empty."""
    kind = pa.large_binary()
    column = column.cast(kind) if column.type in (pa.binary(), pa.large_binary()) else column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("" if pa.types.is_large_string(column.type) else b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def binary_array(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.Array.from_buffers(
        pa.large_binary(), len(offsets) - 1,
        [None, pa.py_buffer(np.ascontiguousarray(offsets, np.int64)), pa.py_buffer(np.ascontiguousarray(data))],
    ).cast(pa.binary())


def components(links: DataFrame, label: str = "links") -> DataFrame:
    """node, component: the smallest node reachable over the pairs (a, b); only nodes in pairs.

    Every round hangs each component's label on its smallest neighbour, follows such pointers
    twice, and keeps the pairs whose ends still differ. Each label that has a smaller neighbour
    vanishes, so rounds grow with the logarithm of the longest chain. Rounds are stored tables;
    only row counts reach the driver.
    """
    pairs = materialize(links.select("a", "b").where("a <> b").distinct(), f"{label}-pairs")
    labels = materialize(
        pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct().withColumn("component", F.col("node")),
        f"{label}-labels",
    )
    while pairs.count():
        both = pairs.union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parent = materialize(
            both.groupBy("a").agg(F.min("b").alias("least"))
            .select(F.col("a").alias("label"), F.least("a", "least").alias("parent")),
            f"{label}-parents",
        )
        for _ in range(2):
            up = parent.select(F.col("label").alias("parent"), F.col("parent").alias("upper"))
            parent = parent.join(up, "parent", "left").select("label", F.coalesce("upper", "parent").alias("parent"))
        parent = materialize(parent, f"{label}-parents")
        labels = materialize(
            labels.join(parent.withColumnRenamed("label", "component"), "component", "left")
            .select("node", F.coalesce("parent", "component").alias("component")),
            f"{label}-labels",
        )
        at_a = parent.select(F.col("label").alias("a"), F.col("parent").alias("pa"))
        at_b = parent.select(F.col("label").alias("b"), F.col("parent").alias("pb"))
        pairs = materialize(
            pairs.join(at_a, "a").join(at_b, "b").where("pa <> pb")
            .select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b")).distinct(),
            f"{label}-pairs",
        )
    return labels


def labelled_sample(
    docs: DataFrame, labels: DataFrame, usable: Column, label: str, sample: int, most_bytes: int = 1 << 16
) -> tuple[list, float]:
    """At most `sample` documents of each label 0 and 1, by a hash of the id, and the share of label 1 among all.

    Rows have doc_id, label, text (bytes) and turn, a number from the hash. Only labels that are
    `usable` count; texts of more than `most_bytes` are not sampled; a document labelled twice counts
    as 1 if either says so.
    """
    known = (
        labels.where(F.col(label).isin(0, 1)).where(usable).where(F.col("doc_id").isNotNull())
        .groupBy("doc_id").agg(F.max(label).cast("int").alias("label"))
        .withColumn("turn", F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)))
    )
    counts = {row["label"]: row["count"] for row in known.groupBy("label").count().collect()}
    chosen = [known.where(F.col("label") == value).orderBy("turn", "doc_id").limit(sample) for value in (0, 1)]
    # At most 2 * sample ids: small enough to send to every task.
    rows = (
        docs.select("doc_id", F.coalesce("text", F.lit("")).cast("binary").alias("text"))
        .where(F.octet_length("text") <= most_bytes)
        .join(F.broadcast(chosen[0].union(chosen[1])), "doc_id").dropDuplicates(["doc_id"]).orderBy("doc_id").collect()
    )
    return rows, counts.get(1, 0) / max(1, sum(counts.values()))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
