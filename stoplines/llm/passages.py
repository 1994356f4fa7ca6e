"""Removal of byte strings that occur more than once, by external induced suffix sorting.

A window is 400 consecutive bytes of a document. Only windows that may occur twice are sorted: each
has a minimiser, the smallest hash of its 32-byte stretches, and a window whose minimiser occurs
once in all documents is unique. Consecutive windows with one shared minimiser form a string, which
goes to the shard of that minimiser; equal windows thus meet in one shard. Equal strings are
counted as one. The others of a shard become one text, whose suffixes are sorted; a window is
repeated if it has 400 bytes in common with the suffix before or after it.

A stretch that is the minimiser of very many strings (a phrase that a third of all documents share)
is ranked after all others, so that windows around it are dealt by their other bytes. The number of
such stretches is bounded by the share of strings that makes one hot.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stoplines.llm import hashing as H
from stoplines.llm.blobs import pack, unpack
from stoplines.llm.common import arrow_map, key_array, keys_of, partitions_for, string_buffer, text_key
from stoplines.llm.suffix_sort import common_prefixes, suffixes
from stoplines.storage import materialize

WINDOW = 400
STRETCH = 32
HOT_SHARE = 1000  # a minimiser is hot with more than this part of all strings
BUCKETS_PER_PARTITION = 4
SHARD_BYTES = 8 << 20  # strings of a bucket sorted as one text, more only if one minimiser has more
LAST = np.iinfo(np.int64).max
TOP = np.uint64(1 << 63)


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """The smallest of every `width` consecutive values: least of a block's rest and of the next one's start."""
    n = len(values) - width + 1
    if n <= 0:
        return values[:0]
    padded = np.full(-(-len(values) // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(values)] = values
    blocks = padded.reshape(-1, width)
    start = np.minimum.accumulate(blocks, axis=1).reshape(-1)
    rest = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(rest[:n], start[width - 1 : width - 1 + n])


def _strings(batch: pa.RecordBatch, window: int, stretch: int, hot: np.ndarray) -> pa.RecordBatch:
    """Stretches of windows with one minimiser: the minimiser, where they start, how many, and how often it occurs (1 or 2)."""
    raw, offsets = string_buffer(batch.column("text"))
    width = window - stretch + 1
    columns: list[list[np.ndarray]] = [[], [], [], [], []]
    for doc in np.flatnonzero(np.diff(offsets) >= window):
        data = raw[offsets[doc] : offsets[doc + 1]]
        # Long documents piece by piece; pieces overlap by all but one byte of a window.
        for begin in range(0, len(data) - window + 1, H.BLOCK):
            grams = H.window_hashes(data[begin : begin + H.BLOCK + window - 1], stretch)
            grams &= ~TOP
            if len(hot):
                at = np.minimum(np.searchsorted(hot, grams), len(hot) - 1)
                grams[hot[at] == grams] |= TOP
            least = _least(grams, width)
            low = np.concatenate(([0], np.flatnonzero(least[1:] != least[:-1]) + 1))
            count = np.diff(np.append(low, len(least)))
            value = least[low]
            times = [min(2, np.count_nonzero(grams[a : a + n + width - 1] == v)) for a, n, v in zip(low.tolist(), count.tolist(), value, strict=True)]
            for column, x in zip(columns, (np.full(len(low), doc), (value & ~TOP).view(np.int64), low + begin, count, np.array(times)), strict=True):
                column.append(x)
    if not columns[0]:
        return None
    doc, value, low, count, times = (np.concatenate(x) for x in columns)
    return pa.RecordBatch.from_arrays(
        [
            batch.column("id").take(pa.array(doc)), batch.column("k").take(pa.array(doc)), pa.array(value),
            pa.array(low, pa.int32()), pa.array(count, pa.int32()), pa.array(times, pa.int32()),
        ],
        names=["id", "k", "value", "start", "count", "times"],
    )


MOVED = "bucket int, blob binary, id long, k binary, start int, end int"
FOUND = ["id", "k", "start", "end"]


def _groups(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The number of the first equal string for each string."""
    one = H.stretch_hashes(raw, offsets[:-1], offsets[1:])
    two = H.stretch_hashes(raw, offsets[:-1], offsets[1:], H.SECOND)
    both = np.stack((one, two), 1)
    _, first, inverse = np.unique(both, axis=0, return_index=True, return_inverse=True)
    return first[inverse.reshape(-1)]


def _moved(batch: pa.RecordBatch, window: int, buckets: int) -> pa.RecordBatch | None:
    """Strings of a slice of documents for the shards; equal ones are settled here but for the first."""
    raw, offsets = string_buffer(batch.column("text"))
    strings = batch.column("strings").flatten()
    owner = np.repeat(np.arange(batch.num_rows), batch.column("strings").value_lengths().to_numpy())
    start, count, value = (strings.field(name).to_numpy() for name in ("start", "count", "value"))
    ids, keys = batch.column("id").to_numpy()[owner], keys_of(batch.column("k"))[owner]
    low = offsets[owner] + start
    size = count.astype(np.int64) + window - 1
    text = raw.tobytes()
    parts = [text[a : a + n] for a, n in zip(low.tolist(), size.tolist(), strict=True)]
    flat = np.frombuffer(b"".join(parts), np.uint8)
    head = _groups(flat, np.concatenate(([0], np.cumsum(size))))
    times = np.bincount(head, minlength=len(head))
    lone = head == np.arange(len(head))
    settled = times[head] > 1
    sent = np.flatnonzero(lone)
    bucket = (H.mix(value[sent].view(np.uint64)) % np.uint64(buckets)).astype(np.int64)
    order = np.lexsort((value[sent], bucket))
    sent, bucket = sent[order], bucket[order]
    edges = np.append(np.flatnonzero(np.diff(bucket, prepend=-1)), len(bucket))
    names, blobs = [], []
    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
        some = sent[a:b]
        arrays = [np.diff(ids[some], prepend=0), *keys[some].T, start[some], size[some], settled[some], np.diff(value[some], prepend=0)]
        names.append(int(bucket[a]))
        blobs.append(pack(arrays, b"".join([parts[i] for i in some.tolist()])))
    done = np.flatnonzero(settled)
    nothing = [None] * len(blobs)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(names + (keys[done, 0] % buckets).tolist(), pa.int32()),
            pa.array(blobs + [None] * len(done), pa.binary()),
            pa.array(nothing + ids[done].tolist(), pa.int64()), pa.concat_arrays([pa.nulls(len(blobs), pa.binary()), key_array(keys[done])]),
            pa.array(nothing + start[done].tolist(), pa.int32()), pa.array(nothing + (start[done] + size[done]).tolist(), pa.int32()),
        ],
        names=["bucket", "blob", "id", "k", "start", "end"],
    )


def repeated_windows(parts: list[bytes], window: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each window of the strings, in order, whether it occurs again in them; and its string's number."""
    size = np.array([len(x) for x in parts])
    n = int(size.sum()) + len(parts)
    data = np.frombuffer(b"\0".join(parts) + bytes(1 + 8), np.uint8)
    text = data[:n].astype(np.int16) + 1
    ends = np.cumsum(size + 1) - 1
    text[ends] = 0
    begins = ends - size
    valid = H.covered(begins, ends - window + 1, n)
    again = np.zeros(n, bool)
    before = np.empty(0, np.int64)
    for places in suffixes(text, window):
        places = np.concatenate((before, places[valid[places]]))
        if len(places) > 1:
            equal = common_prefixes(data, places[:-1], places[1:], window) >= window
            again[places[:-1][equal]] = True
            again[places[1:][equal]] = True
        before = places[-1:]
    at = np.flatnonzero(valid)
    return again[at], np.searchsorted(ends, at)


def _shard(blobs: list, window: int) -> Iterator[pa.RecordBatch]:
    """Repeated stretches among the strings of one bucket."""
    columns, parts = [], []
    for blob in blobs:
        arrays, payload = unpack(blob, 7)
        arrays[0], arrays[6] = np.cumsum(arrays[0]), np.cumsum(arrays[6])
        columns.append(arrays)
        ends = np.cumsum(arrays[4])
        parts += [payload[a:b] for a, b in zip((ends - arrays[4]).tolist(), ends.tolist(), strict=True)]
    ids, k1, k2, start, size, settled, value = (np.concatenate(x) for x in zip(*columns, strict=True))
    keys = np.stack((k1, k2), 1)
    flat = np.frombuffer(b"".join(parts), np.uint8)
    head = _groups(flat, np.concatenate(([0], np.cumsum(size))))
    whole = (np.bincount(head, minlength=len(head))[head] > 1) & (settled == 0)
    out = [(ids[whole], keys[whole], start[whole], start[whole] + size[whole])]
    # One of each, minimiser by minimiser, so many that the shard's text has about SHARD_BYTES.
    lone = np.flatnonzero(head == np.arange(len(head)))
    lone = lone[np.argsort(value[lone], kind="stable")]
    fresh = np.flatnonzero(np.diff(value[lone], prepend=value[lone[0]] - 1))
    total = np.cumsum(size[lone])
    at = 0
    while at < len(lone):
        stops = np.append(fresh[fresh > at], len(lone))
        fitting = stops[total[stops - 1] <= (total[at - 1] if at else 0) + SHARD_BYTES]
        stop = int(fitting[-1] if len(fitting) else stops[0])
        some = lone[at:stop]
        at = stop
        again, owner = repeated_windows([parts[i] for i in some.tolist()], window)
        cut = np.concatenate(([True], owner[1:] != owner[:-1]))
        first = np.flatnonzero(cut)
        rises = again & (cut | ~np.concatenate(([False], again[:-1])))
        falls = again & np.append(cut[1:] | ~again[1:], True)
        low, high = np.flatnonzero(rises), np.flatnonzero(falls)
        string = some[owner[low]]
        base = first[owner[low]]
        open_ = (settled[string] == 0) & ~whole[string]
        string, low, high, base = string[open_], low[open_], high[open_], base[open_]
        out.append((ids[string], keys[string], start[string] + low - base, start[string] + high - base + window))
    ids, keys, low, high = (np.concatenate(x) for x in zip(*out, strict=True))
    yield pa.RecordBatch.from_arrays(
        [pa.array(ids, pa.int64()), key_array(keys), pa.array(low, pa.int32()), pa.array(high, pa.int32())], names=FOUND
    )


def _shards(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    now, blobs = None, []
    for batch in batches:
        own = batch.filter(batch.column("blob").is_null()).select(FOUND)
        if own.num_rows:
            yield own
        rows = batch.filter(batch.column("blob").is_valid())
        for bucket, blob in zip(rows.column("bucket").to_pylist(), rows.column("blob"), strict=True):
            if bucket != now and blobs:
                yield from _shard(blobs, window)
                blobs = []
            now = bucket
            blobs.append(blob.as_buffer())
    if blobs:
        yield from _shard(blobs, window)


def _identified(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("id"), text_key().alias("k"), "text")


def repeated_stretches(docs: DataFrame, window: int = WINDOW, stretch: int = STRETCH, hot_share: int = HOT_SHARE) -> DataFrame:
    """id, k, start, end: byte stretches whose windows occur elsewhere; id is the greatest number for null, k a hash of 128 bits of the text."""
    rows = _identified(docs)

    def strings(hot: np.ndarray) -> DataFrame:
        found = arrow_map(
            rows, lambda batch: _strings(batch, window, stretch, hot),
            "id long, k binary, value long, start int, count int, times int",
        )
        return materialize(found, "strings")

    found = strings(np.empty(0, np.uint64))
    counts = materialize(found.groupBy("value").agg(F.sum("times").alias("n"), F.count("*").alias("rows")).where("n > 1"), "minimisers")
    total = found.count()
    # At most 2 * hot_share values exceed that part of all.
    hot = counts.where(F.col("n") > F.lit(max(total / hot_share, 64))).select("value").collect()
    if hot:
        found = strings(np.sort(np.array([row.value for row in hot]).view(np.uint64)))
        counts = found.groupBy("value").agg(F.sum("times").alias("n")).where("n > 1")
    shared = found.join(counts.select("value"), "value", "left_semi")
    wanted = shared.groupBy("id", "k").agg(F.collect_set(F.struct("start", "count", "value")).alias("strings"))
    parts = partitions_for(docs)
    buckets = parts * BUCKETS_PER_PARTITION
    moved = arrow_map(
        rows.join(wanted, ["id", "k"]).select("id", "k", "text", "strings"), lambda batch: _moved(batch, window, buckets), MOVED
    )
    dealt = moved.repartition(parts, "bucket").sortWithinPartitions("bucket")
    return dealt.mapInArrow(lambda batches: _shards(batches, window), "id long, k binary, start int, end int")


def remove_repeats(docs: DataFrame, window: int = WINDOW, stretch: int = STRETCH, hot_share: int = HOT_SHARE) -> DataFrame:
    """`docs` with n_bytes, n_removed, n_spans and kept, the UTF-8 bytes that stay.

    A byte goes if a string of `window` bytes that covers it also starts elsewhere, in the same or
    another row; rows with the same id and text are two places. Null texts are empty; ids may be null.
    Other columns stay; those named like the results are replaced.
    """
    results = ["n_bytes", "n_removed", "n_spans", "kept"]
    docs = docs.drop(*results)
    found = repeated_stretches(docs, window, stretch, hot_share).groupBy("id", "k").agg(F.collect_set(F.struct("start", "end")).alias("spans"))
    rows = docs.select(
        F.struct(*[F.col(f"`{name}`") for name in docs.columns if name != "text"]).alias("row"), "text",
        F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("id"), text_key().alias("k"),
    )
    joined = rows.join(found, ["id", "k"], "left").select(
        "row", "text", F.transform("spans", lambda s: s["start"]).alias("starts"), F.transform("spans", lambda s: s["end"]).alias("ends")
    )
    schema = f"row {joined.schema['row'].dataType.simpleString()}, text string, n_bytes long, n_removed long, n_spans long, kept binary"
    return arrow_map(joined, _kept, schema).select("row.*", "text", *results)


def _kept(batch: pa.RecordBatch) -> pa.RecordBatch:
    sizes, removed, spans, kept = [], [], [], []
    for text, starts, ends in zip(batch.column("text"), batch.column("starts"), batch.column("ends"), strict=True):
        data = text.as_buffer().to_pybytes() if text.is_valid else b""
        sizes.append(len(data))
        low = np.empty(0)
        if starts.is_valid and len(starts):
            gone = H.covered(starts.values.to_numpy(), ends.values.to_numpy(), len(data))
            low, _ = H.runs(gone)
            data = np.frombuffer(data, np.uint8)[~gone].tobytes()
        removed.append(sizes[-1] - len(data))
        spans.append(len(low))
        kept.append(data)
    return pa.RecordBatch.from_arrays(
        [
            batch.column("row"), batch.column("text"), *(pa.array(x, pa.int64()) for x in (sizes, removed, spans)), pa.array(kept, pa.binary()),
        ],
        names=["row", "text", "n_bytes", "n_removed", "n_spans", "kept"],
    )
