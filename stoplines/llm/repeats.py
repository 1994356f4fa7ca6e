"""Removal of passages that other documents hold, found by super-k-mer partitioning.

A window is 13 consecutive words. Its minimiser is the smallest hash of its three-word stretches.
Consecutive windows of a document with one minimiser travel as one packed string to the bucket of
that minimiser. Equal windows have equal minimisers, so that a bucket sees all copies of its windows
and finds them by sorting.

Two levels keep hot passages small: a task first compares the windows of its own slice of documents,
and of equal windows sends only those of the smallest document. A passage that a third of all
documents share thus reaches its bucket once per slice.

A string doesn't carry the key of its document but its number in the slice; the slices' lists of documents
go once, apart from the strings, and what a bucket finds meets them by slice and number.

Words are compared by 128 hash bits.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import md5

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stoplines.llm import hashing as H
from stoplines.llm.blobs import pack, unpack
from stoplines.llm.common import arrow_map, key_array, keys_of, partitions_for, string_buffer, text_key

WINDOW = 13
NAME = 16  # bytes of a slice's name
STRETCH = 3  # words that a minimiser hashes
BUCKETS_PER_PARTITION = 4
LAST = np.iinfo(np.int64).max  # stands for a null id: after all others
ROUND = 1 << 22  # windows of a bucket sorted at a time

# A string, a decision (slice, number, start, end), or a document of a slice (slice, number, doc_id, k).
FOUND = "slice binary, number int, doc_id long, k binary, start int, end int"
MOVED = f"bucket int, blob binary, {FOUND}"
NAMES = ["slice", "number", "doc_id", "k", "start", "end"]


def _windows(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, places: np.ndarray, window: int):
    """Places (word numbers) of all windows, and two hashes of each."""
    first = H.stretch_hashes(raw, starts, ends)
    second = H.stretch_hashes(raw, starts, ends, H.SECOND)
    lengths = np.diff(places)
    valid = np.repeat(places[1:], lengths) - np.arange(len(starts)) >= window
    at = np.flatnonzero(valid)
    if not len(at):
        return at, np.empty(0, np.uint64), np.empty(0, np.uint64), first
    return at, H.window_hashes(first, window)[at], H.window_hashes(second, window, H.SECOND)[at], first


def _smallest(one: np.ndarray, two: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """For each window the smallest id among equal windows."""
    if not len(one):
        return ids
    order = np.argsort(one, kind="stable")
    a, b = one[order], two[order]
    new = a[1:] != a[:-1]
    if (~new & (b[1:] != b[:-1])).any():
        order = np.lexsort((two, one))
        a, b = one[order], two[order]
        new = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    begin = np.concatenate(([0], np.flatnonzero(new) + 1))
    least = np.minimum.reduceat(ids[order], begin)
    out = np.empty_like(ids)
    out[order] = np.repeat(least, np.diff(np.concatenate((begin, [len(order)]))))
    return out


def _moved(batch: pa.RecordBatch, window: int, buckets: int) -> pa.RecordBatch:
    """Decisions within the slice, and packed strings for the buckets."""
    raw, offsets = string_buffer(batch.column("text"))
    ids = batch.column("doc_id").fill_null(LAST).to_numpy()
    keys = keys_of(batch.column("k"))
    # Slices with the same documents in the same order have one name, and the same results.
    name = md5(ids.tobytes() + keys.tobytes()).digest()
    starts, ends, places = H.words(raw, offsets, H.NOT_SPACE)
    at, one, two, first = _windows(raw, starts, ends, places, window)
    doc = np.searchsorted(places, at, "right") - 1
    gone = _smallest(one, two, ids[doc]) < ids[doc]

    grams = H.window_hashes(first, STRETCH)
    least = grams[at] if len(at) else np.empty(0, np.uint64)
    for k in range(1, window - STRETCH + 1):
        least = np.minimum(least, grams[at + k])
    # A run is a stretch of windows of one document, one decision and, if they stay, one minimiser.
    cut = np.ones(len(at), bool)
    cut[1:] = (at[1:] != at[:-1] + 1) | (doc[1:] != doc[:-1]) | (gone[1:] != gone[:-1]) | (~gone[1:] & (least[1:] != least[:-1]))
    begin = np.flatnonzero(cut)
    count = np.diff(np.append(begin, len(at)))
    home = doc[begin]
    start = at[begin] - places[home]
    sent = np.flatnonzero(~gone[begin])
    bucket = (least[begin[sent]] % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    sent, bucket = sent[order], bucket[order]
    low, high = starts[at[begin[sent]]], ends[at[begin[sent]] + count[sent] + window - 2]
    text = raw.tobytes()
    buckets_of, blobs = [], []
    edges = np.append(np.flatnonzero(np.diff(bucket, prepend=-1)), len(bucket))
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        some = sent[a:b]
        parts = [text[x:y] for x, y in zip(low[a:b].tolist(), high[a:b].tolist(), strict=True)]
        arrays = [np.diff(ids[home[some]], prepend=0), np.diff(home[some], prepend=0), start[some], count[some], high[a:b] - low[a:b]]
        buckets_of.append(int(bucket[a]))
        blobs.append(pack(arrays, name + b"".join(parts)))
    done = np.flatnonzero(gone[begin])
    # Decisions and documents ride along to any bucket, so that one pass over the texts is enough.
    own = np.arange(batch.num_rows)
    spread = np.concatenate((home[done], own)) % buckets
    numbers = np.concatenate((home[done], own))
    strings, decisions = len(blobs), len(done)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(buckets_of + spread.tolist(), pa.int32()), pa.array(blobs + [None] * len(numbers), pa.binary()),
            pa.array([None] * strings + [name] * len(numbers), pa.binary()), pa.array([None] * strings + numbers.tolist(), pa.int32()),
            pa.array([None] * (strings + decisions) + ids.tolist(), pa.int64()),
            pa.concat_arrays([pa.nulls(strings + decisions, pa.binary()), key_array(keys)]),
            pa.array([None] * strings + start[done].tolist() + [None] * len(own), pa.int32()),
            pa.array([None] * strings + (start[done] + count[done] + window - 1).tolist() + [None] * len(own), pa.int32()),
        ],
        names=["bucket", "blob", *NAMES],
    )


def _found(blobs: list[bytes], window: int) -> Iterator[pa.RecordBatch]:
    """Windows of one bucket that are also in a smaller document."""
    columns, texts, names = [], [], []
    for blob in blobs:
        arrays, payload = unpack(blob, 5)
        arrays[0], arrays[1] = np.cumsum(arrays[0]), np.cumsum(arrays[1])
        columns.append([*arrays, np.full(len(arrays[0]), len(names))])
        names.append(payload[:NAME])
        texts.append(payload[NAME:])
    ids, number, start, count, size, slice_ = (np.concatenate(x) for x in zip(*columns, strict=True))
    raw = np.frombuffer(b"".join(texts), np.uint8)
    offsets = np.concatenate(([0], np.cumsum(size)))
    at, one, two, _ = _windows(raw, *H.words(raw, offsets, H.NOT_SPACE), window)
    run = np.repeat(np.arange(len(ids)), count)
    gone = np.zeros(len(at), bool)
    rounds = -(-len(at) // ROUND)
    for part in range(rounds):
        chosen = np.flatnonzero(one % np.uint64(rounds) == part) if rounds > 1 else np.arange(len(at))
        own = ids[run[chosen]]
        gone[chosen] = _smallest(one[chosen], two[chosen], own) < own
    low, high = H.runs(gone)
    # Stretches end with their run.
    edges = np.cumsum(count)[:-1]
    inner = edges[(edges < len(gone))]
    inner = inner[gone[inner] & gone[inner - 1]] if len(inner) else inner
    low, high = np.sort(np.concatenate((low, inner))), np.sort(np.concatenate((high, inner)))
    owner = run[low]
    base = np.concatenate(([0], np.cumsum(count)))[owner]
    n = len(owner)
    yield pa.RecordBatch.from_arrays(
        [
            pa.array(names, pa.binary()).take(pa.array(slice_[owner])), pa.array(number[owner], pa.int32()),
            pa.nulls(n, pa.int64()), pa.nulls(n, pa.binary()),
            pa.array(start[owner] + low - base, pa.int32()), pa.array(start[owner] + high - base + window - 1, pa.int32()),
        ],
        names=NAMES,
    )


def _buckets(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by bucket; one bucket is held at a time."""
    now, blobs = None, []
    for batch in batches:
        own = batch.filter(batch.column("blob").is_null()).select(NAMES)
        if own.num_rows:
            yield own
        rows = batch.filter(batch.column("blob").is_valid())
        for bucket, blob in zip(rows.column("bucket").to_pylist(), rows.column("blob"), strict=True):
            if bucket != now and blobs:
                yield from _found(blobs, window)
                blobs = []
            now = bucket
            blobs.append(blob.as_buffer())
    if blobs:
        yield from _found(blobs, window)


def repeated_stretches(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, k, spans: word stretches (start, end) covered by windows that also start in a smaller document.

    One row per id and text, spans may be empty. k is a hash of 128 bits of the text that tells rows of one id apart; a null
    id is given as the greatest number. Stretches may overlap. Equal ids are not smaller than each other, so
    that a document listed twice doesn't remove itself.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", text_key().alias("k"))
    parts = partitions_for(docs)
    buckets = parts * BUCKETS_PER_PARTITION
    moved = arrow_map(rows, lambda batch: _moved(batch, window, buckets), MOVED)
    dealt = moved.repartition(parts, "bucket").sortWithinPartitions("bucket")
    found = dealt.mapInArrow(lambda batches: _buckets(batches, window), FOUND)
    span = F.when(F.col("start").isNotNull(), F.struct("start", "end"))
    documents = found.groupBy("slice", "number").agg(
        F.max("doc_id").alias("doc_id"), F.max("k").alias("k"), F.collect_list(span).alias("spans")
    )
    # Copies under one id mostly have equal lists.
    return documents.groupBy("doc_id", "k").agg(F.flatten(F.collect_set("spans")).alias("spans"))


def remove_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """`docs` with n_words, n_removed and kept: the words that stay, joined by one space.

    Words are runs of anything but space and the controls 09-0D, as they are. Null and empty texts
    have no words; a null id counts as greater than all others, rows with one id and one text get
    the same result. Other columns stay; those named like the results are replaced.
    """
    results = ["n_words", "n_removed", "kept"]
    docs = docs.drop(*results)
    found = repeated_stretches(docs, window).withColumnRenamed("doc_id", "id")
    names = [name for name in docs.columns if name != "text"]
    rows = docs.select(
        F.struct(*[F.col(f"`{name}`") for name in names]).alias("row"), "text",
        F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("id"), text_key().alias("k"),
    )
    joined = rows.join(found, ["id", "k"], "left").select(
        "row", "text", F.transform("spans", lambda s: s["start"]).alias("starts"), F.transform("spans", lambda s: s["end"]).alias("ends")
    )
    schema = f"row {joined.schema['row'].dataType.simpleString()}, text string, n_words long, n_removed long, kept string"
    return arrow_map(joined, _kept, schema).select("row.*", "text", *results)


def _kept(batch: pa.RecordBatch) -> pa.RecordBatch:
    total, removed, kept = [], [], []
    for text, starts, ends in zip(batch.column("text"), batch.column("starts"), batch.column("ends"), strict=True):
        words = text.as_buffer().to_pybytes().split() if text.is_valid else []
        total.append(len(words))
        if starts.is_valid and len(starts):
            gone = H.covered(starts.values.to_numpy(), ends.values.to_numpy(), len(words))
            words = [words[i] for i in np.flatnonzero(~gone)]
        removed.append(total[-1] - len(words))
        kept.append(b" ".join(words))
    return pa.RecordBatch.from_arrays(
        [
            batch.column("row"), batch.column("text"), pa.array(total, pa.int64()), pa.array(removed, pa.int64()),
            pa.array(kept, pa.binary()).cast(pa.string()),
        ],
        names=["row", "text", "n_words", "n_removed", "kept"],
    )
