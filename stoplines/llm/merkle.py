"""A Merkle manifest of a dataset: trees per group, proofs, and versions by path copying.

Rows of a group, in key order, are the leaves of its tree; every two neighbours (or the last one
alone) become one node, until one remains. The roots of the groups, in group order, are the leaves
of one more tree. A tree is built in rounds: 2^HEIGHT neighbours are an aligned block, which one task
reduces to its top node; the tops are the leaves of the next round.

A changed leaf doesn't change its tree. It makes a version: new nodes for the leaf and its ancestors,
all other nodes shared with the first version. A block copies the ancestors inside it; the nodes
above, up to the root of all groups, are copied where the version's row is, from the siblings that
all leaves of the block share.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stoplines.llm.common import partitions_for
from stoplines.storage import materialize

HEIGHT = 10
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

_STEP = "struct<left:boolean,digest:binary>"
_BUILT = f"doc_id long, grp string, place long, total long, nodes array<binary>, steps array<{_STEP}>, copied array<binary>"


@dataclass
class Manifest:
    """`members`: one row per leaf. doc_id; grp, the group's text after "=", or "" if it is null;
    place, from 0, in the group; leaf, its digest; proof, one (left, digest) per level up to the root, where
    digest is the sibling, left if it stands left of the path, NULL if there is none; copied, the new nodes of the
    version that the changed leaf made, from the leaf to its root, or NULL; subroot, the root of the group.

    `rounds`: the stored rows of each round, whose `nodes` are the digests of all nodes of a block that have the row as their
    first leaf, from the leaf up. `root` is NULL for an empty dataset.
    """

    members: DataFrame
    root: bytes | None
    rounds: list[DataFrame]
    height: int

    def nodes(self) -> DataFrame:
        """grp, level, place, digest: all nodes of the groups' trees."""
        parts = []
        for i, rows in enumerate(self.rounds):
            each = rows.select("grp", F.col("place").alias("first"), F.posexplode("nodes").alias("up", "digest"))
            # The leaves of a later round are the tops of the one before.
            parts.append(each.where(F.col("up") >= min(i, 1)).select(
                "grp", (F.col("up") + i * self.height).alias("level"), F.expr("shiftright(first, up)").alias("place"), "digest"
            ))
        return reduce(DataFrame.unionAll, parts)

    def versions(self) -> DataFrame:
        """doc_id, grp, first, level, digest: the nodes that each version has of its own, `first` being its leaf's place.

        Levels go on above the group's tree, to the root of all groups. All other nodes are those of `nodes`.
        """
        return self.members.select("doc_id", "grp", F.col("place").alias("first"), F.posexplode("copied").alias("level", "digest"))


def leaf(fields: dict[str, Column]) -> Column:
    """SHA-256, as 32 bytes, of the values: each "-" if null, else its UTF-8 length, ":" and itself."""
    parts = []
    for value in fields.values():
        text = value.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.unhex(F.sha2(F.concat(*parts), 256))


def text_of(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def _above(node: Column, step: Column) -> Column:
    """The parent of a node by one step of a proof."""
    own, other = text_of(node), text_of(step["digest"])
    pair = F.when(other.isNull(), own).when(step["left"], F.concat(other, own)).otherwise(F.concat(own, other))
    return F.unhex(F.sha2(pair, 256))


def folded(node: Column, proof: Column) -> Column:
    """The root that a leaf and a proof give."""
    return F.aggregate(proof, node, _above)


def _continued(copied: Column, steps: Column) -> Column:
    """The copied nodes of a version, and the copies of the ancestors above them."""
    return F.aggregate(steps, copied, lambda path, step: F.concat(path, F.array(_above(F.element_at(path, -1), step))))


def _parent(run: list[bytes]) -> bytes:
    return sha256("".join(node.hex() for node in run).encode()).digest()


def base_tree(leaves: list[bytes], levels: int) -> list[list[bytes]]:
    """The nodes of each level, from the leaves up."""
    tree = [leaves]
    for _ in range(levels):
        tree.append([_parent(tree[-1][i : i + 2]) for i in range(0, len(tree[-1]), 2)])
    return tree


def copied_path(tree: list[list[bytes]], place: int, leaf: bytes) -> list[bytes]:
    """The nodes of a version with another leaf: the leaf and its ancestors; every sibling is the tree's own."""
    path = [leaf]
    for nodes in tree[:-1]:
        run = nodes[place & ~1 : (place & ~1) + 2]
        run[place & 1] = path[-1]
        path.append(_parent(run))
        place >>= 1
    return path


def _lists(values: pa.Array, sizes: np.ndarray) -> pa.Array:
    """Consecutive values as lists; a negative size stands for a null."""
    offsets = np.concatenate([[0], np.cumsum(np.maximum(sizes, 0))])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values, mask=pa.array(sizes < 0))


def _block(rows: pa.Table, height: int) -> pa.RecordBatch:
    """One block's members with their nodes, steps and copied ancestors."""
    n, total = rows.num_rows, rows.column("total")[0].as_py()
    levels = height if total > 1 << height else (total - 1).bit_length()
    tree = base_tree(rows.column("digest").to_pylist(), levels)
    flat = pa.array([node for nodes in tree for node in nodes], pa.binary())
    start = np.concatenate([[0], np.cumsum([len(nodes) for nodes in tree])])
    place, level = np.arange(n), np.arange(levels)
    other = (place[:, None] >> level) ^ 1
    alone = other >= np.array([len(nodes) for nodes in tree[:-1]], np.int64)
    digests = flat.take(pa.array((other + start[:levels]).ravel(), mask=alone.ravel()))
    steps = pa.StructArray.from_arrays([pa.array((other < place[:, None] >> level).ravel()), digests], ["left", "digest"])
    # A node of a level belongs to its first leaf.
    up = np.arange(levels + 1)
    first = place[:, None] % (1 << up) == 0
    nodes = flat.take(pa.array(((place[:, None] >> up) + start[: levels + 1])[first]))
    changed = rows.column("changed").to_pylist()
    copies = [copied_path(tree, i, digest) for i, digest in enumerate(changed) if digest is not None]
    copied = pa.array([node for path in copies for node in path], pa.binary())
    return pa.RecordBatch.from_arrays(
        [
            *(rows.column(name).combine_chunks() for name in ("doc_id", "grp", "place", "total")),
            _lists(nodes, first.sum(1)), _lists(steps, np.full(n, levels)),
            _lists(copied, np.array([-1 if digest is None else levels + 1 for digest in changed])),
        ],
        names=["doc_id", "grp", "place", "total", "nodes", "steps", "copied"],
    )


def _round(rows: DataFrame, height: int) -> DataFrame:
    """Build the blocks of rows of doc_id, grp, place, total, digest, changed, and store their members."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Rows of a block are neighbours, but may go on in the next batch.
        held: pa.Table | None = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            held = table if held is None else pa.concat_tables([held, table])
            if not held.num_rows:
                continue
            block = pc.shift_right(held.column("place"), height).to_numpy()
            group = held.column("grp").combine_chunks().dictionary_encode()
            group = (group.combine_chunks() if isinstance(group, pa.ChunkedArray) else group).indices.to_numpy()
            edges = np.flatnonzero((block[1:] != block[:-1]) | (group[1:] != group[:-1])) + 1
            for low, high in zip([0, *edges[:-1]], edges, strict=False):
                yield _block(held.slice(low, high - low), height)
            if len(edges):
                held = held.slice(edges[-1])
        if held is not None and held.num_rows:
            yield _block(held, height)

    block = F.expr(f"shiftright(place, {height})")
    dealt = rows.withColumn("_block", block).repartition(partitions_for(rows), "grp", "_block")
    dealt = dealt.sortWithinPartitions("grp", "place").drop("_block")
    return materialize(dealt.mapInArrow(run, _BUILT), "merkle")


def _numbered(rows: DataFrame, order: list[str | Column]) -> DataFrame:
    """The rows with their place in their group, from 0, and the group's size; no group is one task's.

    Rows are cut into ranges and stored in order; a range's rows of a group follow those of the ranges before.
    """
    rows = rows.withColumn("_tie", F.monotonically_increasing_id())  # deals equal rows, too, over ranges
    keys = ["grp", *order, "_tie"]
    cut = rows.repartitionByRange(partitions_for(rows), *keys).sortWithinPartitions(*keys).drop("_tie")
    cut = materialize(cut.withColumn("_at", F.monotonically_increasing_id()), "merkle-order")
    cut = cut.withColumn("_part", F.expr("shiftright(_at, 33)"))
    parts = cut.groupBy("grp", "_part").agg(F.count("*").alias("_rows"), F.min("_at").alias("_first"))
    group = W.partitionBy("grp")
    before = F.sum("_rows").over(group.orderBy("_part")) - F.col("_rows")
    parts = parts.withColumns({"_before": before, "total": F.sum("_rows").over(group)})
    place = F.col("_before") + F.col("_at") - F.col("_first")
    return cut.join(parts, ["grp", "_part"]).withColumn("place", place).drop("_part", "_at", "_rows", "_first", "_before")


def _paths(rows: DataFrame, height: int) -> tuple[list[DataFrame], DataFrame]:
    """The rounds over `rows`, and for each grp and block of the first the steps above it and the group's root."""
    size = 1 << height
    built = _round(rows, height)
    tops = built.where(F.col("place") % size == 0).select(
        F.lit(None).cast("long").alias("doc_id"), "grp", F.expr(f"shiftright(place, {height})").alias("place"),
        F.ceil(F.col("total") / size).alias("total"), F.element_at("nodes", -1).alias("digest"),
        F.lit(None).cast("binary").alias("changed"),
    )
    if (built.agg(F.max("total").alias("most")).first()["most"] or 0) <= size:
        none = F.array().cast(f"array<{_STEP}>")
        return [built], tops.select("grp", F.col("place").alias("block"), none.alias("above"), F.col("digest").alias("subroot"))
    later, lift = _paths(tops, height)
    upper = later[0].withColumn("block", F.expr(f"shiftright(place, {height})")).join(lift, ["grp", "block"])
    return [built, *later], upper.select("grp", F.col("place").alias("block"), F.concat("steps", "above").alias("above"), "subroot")


def manifest(
    docs: DataFrame, tampered: Column | None = None, changes: dict[str, Column] | None = None,
    fields: tuple[str, ...] = FIELDS, group: str = "lang", key: str = "doc_id", height: int = HEIGHT,
) -> Manifest:
    """The trees of a table, and a version for each `tampered` row with the `changes` of its fields.

    A leaf is the digest of the row's `fields`. Leaves of a group ascend by `key`, a whole number, null keys
    after all others, equal keys by digest; repeated rows are leaves of their own. A null group comes first. An empty text is a
    value, unlike a null. Rows of an unknown (null) `tampered` aren't. An empty table has no root and no members.
    """
    values = {name: F.col(name) for name in fields}
    changed = leaf(values | (changes or {}))
    rows = docs.select(
        F.col(key).cast("long").alias("doc_id"),
        F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit("")).alias("grp"),
        leaf(values).alias("digest"),
        F.when(F.lit(False) if tampered is None else tampered, changed).alias("changed"),
    )
    rows = materialize(rows, "merkle-leaves")
    rounds, lift = _paths(_numbered(rows, [F.col("doc_id").asc_nulls_last(), "digest"]), height)
    lift = materialize(lift, "merkle-lift")
    # The groups' roots are the leaves of one more tree; order and grp change their parts.
    roots = lift.where("block = 0").select(F.lit("").alias("grp"), F.col("grp").alias("name"), F.col("subroot").alias("digest"))
    places = materialize(_numbered(roots, ["name"]), "merkle-groups")
    nothing = {"doc_id": F.col("place"), "changed": F.lit(None).cast("binary")}
    above, top = _paths(places.withColumns(nothing).select("doc_id", "grp", "place", "total", "digest", "changed"), height)
    upper = above[0].withColumn("block", F.expr(f"shiftright(place, {height})")).join(top, ["grp", "block"])
    upper = upper.select("place", F.concat("steps", "above").alias("last"), F.col("subroot").alias("root"))
    upper = materialize(places.select("name", "place").join(upper, "place"), "merkle-top")
    root = upper.select("root").first()
    steps = lift.join(upper.select(F.col("name").alias("grp"), "last"), "grp").select(
        "grp", "block", F.concat("above", "last").alias("above"), "subroot"
    )
    members = (
        rounds[0].withColumn("block", F.expr(f"shiftright(place, {height})")).join(materialize(steps, "merkle-steps"), ["grp", "block"])
        .select(
            "doc_id", "grp", "place", F.element_at("nodes", 1).alias("leaf"), F.concat("steps", "above").alias("proof"),
            F.when(F.col("copied").isNotNull(), _continued(F.col("copied"), F.col("above"))).alias("copied"), "subroot",
        )
    )
    return Manifest(members, bytes(root["root"]) if root else None, rounds, height)


def verified(found: Manifest) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified: each row proved against the root.

    A tampered row is proved with its changed leaf, that is by the root of its version. Digests are hex texts.
    """
    proof, root = F.col("proof"), F.lit(found.root)
    siblings = F.transform(F.filter(proof, lambda step: step["digest"].isNotNull()), lambda step: text_of(step["digest"]))
    own = F.coalesce(F.element_at("copied", -1), folded(F.col("leaf"), proof))
    return found.members.select(
        "doc_id", text_of(F.col("leaf")).alias("leaf"), text_of(F.col("subroot")).alias("subroot"),
        text_of(root).alias("root"), F.sha2(F.array_join(siblings, ""), 256).alias("proof_sha256"), text_of(own).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
