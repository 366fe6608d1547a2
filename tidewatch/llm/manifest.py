"""Merkle manifest of a dataset: a digest per row, per group and for all, and a proof for each row.

Rows of a group, in order, are the leaves of a tree in which every ``FAN`` consecutive nodes become the digest of their
digests (hex text, concatenated); what is left over at the end of a level is a run of its own, down to one node. The tops
of the groups are the leaves of one more tree, whose top is the root.

Every node carries the interval ``[lo, hi)`` of leaf ranks it covers. Trees are climbed in bands of ``BAND`` levels: the
nodes of a band that share an ancestor at its upper edge meet in one task, at most ``FAN ** BAND`` of them however large
the group, and pass on that ancestor alone. On the way down each ancestor meets the nodes of the band below whose interval
its own contains. The bucket of that join is the ancestor's level and its place there, which the lower node's ``lo`` tells.
Within the band, the siblings of a node are what is left of its parent's interval without its own.

Group null comes first, the others by their bytes; within a group rows are in order of their key, null first, equal keys
in order of their digests. Equal rows are leaves of their own with the same digest. A group of one row has that row's
digest; a table of one group has that group's; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidewatch.llm.storage import stored

FAN = 2
# Levels that one task climbs: 1024 leaves of a tree of two.
BAND = 10
PATH = "array<struct<left:string,right:string>>"


def leaf(*fields: Column) -> Column:
    """Digest of a row: ``-`` for a null, else the number of UTF-8 bytes, a colon and the value, one after another."""
    texts = [field.cast("string") for field in fields]
    return F.sha2(F.concat(*(F.when(x.isNull(), "-").otherwise(F.concat(F.octet_length(x).cast("string"), F.lit(":"), x))
                             for x in texts)), 256)


def levels_of(lo: np.ndarray, hi: np.ndarray, digests: list[str], climbs: int, fan: int) -> list[tuple[np.ndarray, np.ndarray, list[str]]]:
    """The nodes of each level, as (lo, hi, digests), from those given up to their common ancestor ``climbs`` above."""
    found = [(lo, hi, digests)]
    for _ in range(climbs):
        lo, hi, below = found[-1]
        ends = np.minimum(np.arange(fan, len(lo) + fan, fan), len(lo))
        found.append((lo[::fan], hi[ends - 1], [
            hashlib.sha256("".join(below[i:i + fan]).encode()).hexdigest() for i in range(0, len(below), fan)]))
    return found


def siblings(nodes: tuple, parents: tuple) -> tuple[list[str], list[str]]:
    """Digests left and right of each node within its parent: the parent's interval less the node's own."""
    lo, hi, digests = nodes
    parent = np.searchsorted(parents[0], lo, side="right") - 1
    first = np.searchsorted(lo, parents[0][parent])
    last = np.searchsorted(lo, parents[1][parent])
    own = np.arange(len(lo))
    return (["".join(digests[i:j]) for i, j in zip(first.tolist(), own.tolist())],
            ["".join(digests[i:j]) for i, j in zip((own + 1).tolist(), last.tolist())])


def _height(rows: int, fan: int) -> int:
    height = 0
    while fan ** height < rows:
        height += 1
    return height


def _ranked(rows: DataFrame) -> DataFrame:
    """``tree, lo, hi, size, digest, row``: the rank of each leaf among those of its tree, and how many these are.

    A range partitioning spreads even one tree over all tasks; ranks within a partition become ranks within the tree by
    the number of leaves in partitions before.
    """
    ordered = stored(rows.repartitionByRange("tree", "key", "digest").sortWithinPartitions("tree", "key", "digest")
                     .withColumn("at", F.monotonically_increasing_id()), "leaves")
    block = F.shiftright("at", 33).alias("block")
    before = Window.partitionBy("tree").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = (ordered.groupBy("tree", block).agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("leaves"))
              .select("tree", "block", "first", F.coalesce(F.sum("leaves").over(before), F.lit(0)).alias("before"),
                      F.sum("leaves").over(Window.partitionBy("tree")).alias("size")))
    rank = F.col("before") + F.col("at") - F.col("first")
    return stored(ordered.withColumn("block", block).join(starts, ["tree", "block"])
                  .select("tree", rank.alias("lo"), (rank + 1).alias("hi"), "size", "digest", "row"), "ranked")


def _climbs(table: pa.Table, level: int, band: int, fan: int) -> int:
    return max(0, min(band, _height(table.column("size")[0].as_py(), fan) - level))


def _nodes(table: pa.Table) -> tuple[pa.Table, np.ndarray, np.ndarray, list[str]]:
    table = table.take(pc.sort_indices(table.column("lo")))
    return table, table.column("lo").to_numpy(), table.column("hi").to_numpy(), table.column("digest").to_pylist()


def _ancestors(nodes: DataFrame, level: int, band: int, fan: int) -> DataFrame:
    """For each node ``band`` levels above, or at the top: its interval and digest."""
    def climb(table: pa.Table) -> pa.Table:
        climbs = _climbs(table, level, band, fan)
        table, lo, hi, digests = _nodes(table)
        lo, hi, digests = levels_of(lo, hi, digests, climbs, fan)[-1]
        return pa.table({"tree": table.column("tree").slice(0, 1), "lo": pa.array(lo), "hi": pa.array(hi),
                         "size": table.column("size").slice(0, 1), "digest": pa.array(digests, pa.string())})

    bucket = F.floor(F.col("lo") / F.lit(fan ** (level + band))).cast("long").alias("bucket")
    return (nodes.select("tree", "lo", "hi", "size", "digest").groupBy("tree", bucket)
            .applyInArrow(climb, "tree string, lo long, hi long, size long, digest string"))


def _descended(nodes: DataFrame, above: DataFrame, level: int, band: int, fan: int) -> DataFrame:
    """The nodes with ``path, top, root``, from their ancestors ``band`` levels above, which have these."""
    carried = [c for c in nodes.columns if c != "digest"]
    schema = StructType([nodes.schema[c] for c in (*carried, "digest")] + [above.schema[c] for c in ("top", "root", "path")])
    form = pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))

    def attach(table: pa.Table, ancestors: pa.Table) -> pa.Table:
        climbs = _climbs(table, level, band, fan)
        table, lo, hi, digests = _nodes(table)
        ladder = levels_of(lo, hi, digests, climbs, fan)
        sides = []
        for nodes_, parents in zip(ladder, ladder[1:]):
            mine = np.searchsorted(nodes_[0], lo, side="right") - 1  # the node of this level that contains the leaf
            sides.append([[side[i] for i in mine.tolist()] for side in siblings(nodes_, parents)])
        upper = ancestors.column("path")[0].as_py()
        for step in upper:
            sides.append([[step["left"]] * len(lo), [step["right"]] * len(lo)])
        # Levels side by side, then one leaf after another.
        left, right = ([x for row in zip(*(s[k] for s in sides)) for x in row] for k in (0, 1))
        offsets = np.arange(len(lo) + 1, dtype=np.int32) * len(sides)
        path = pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays(
            [pa.array(left, pa.string()), pa.array(right, pa.string())], names=["left", "right"]))
        out = {c: table.column(c) for c in (*carried, "digest")}
        for name in ("top", "root"):
            out[name] = pa.array([ancestors.column(name)[0].as_py()] * len(lo), pa.string())
        return pa.table(out | {"path": path.cast(form)})

    wide = F.lit(fan ** (level + band))
    lower = nodes.withColumn("_bucket", F.floor(F.col("lo") / wide).cast("long"))
    upper = above.withColumn("_bucket", F.floor(F.col("lo") / wide).cast("long"))
    return (lower.groupBy("tree", "_bucket").cogroup(upper.groupBy("tree", "_bucket"))
            .applyInArrow(lambda a, b: attach(a.drop_columns(["_bucket"]), b), schema))


def _trees(rows: DataFrame, band: int, fan: int, crown) -> DataFrame:
    """Trees over ``tree, key, digest, row``; ``crown`` turns the top nodes into ``tree, lo, top, root, path``."""
    bands = [_ranked(rows)]
    largest = bands[0].agg(F.max("size")).first()[0]
    level = 0
    while largest is not None and fan ** level < largest:
        bands.append(stored(_ancestors(bands[-1], level, band, fan), "nodes"))
        level += band
    found = crown(bands[-1])
    for nodes in reversed(bands[:-1]):
        level -= band
        found = _descended(nodes, found, level, band, fan)
    return found


def manifest(rows: DataFrame, *, group: str, key: str, digest: str, fan: int = FAN, band: int = BAND) -> DataFrame:
    """All columns of ``rows`` in ``row``, with ``rank, digest, subroot, root`` and ``path``.

    ``path`` holds, level by level from the leaf to the root, the digests of the siblings left and right of the node that
    covers the row, concatenated; a node without siblings has empty ones.
    """
    tree = F.when(F.col(group).isNull(), "").otherwise(F.concat(F.lit("="), F.col(group).cast("string")))
    leaves = stored(rows.select(tree.alias("tree"), F.col(key).alias("key"), F.col(digest).alias("digest"),
                                F.struct("*").alias("row")), "digests")

    def rooted(tops: DataFrame) -> DataFrame:
        return tops.select("tree", "lo", "hi", "size", "digest", *([F.col("row")] if "row" in tops.columns else []),
                           F.col("digest").alias("top"), F.col("digest").alias("root"), F.expr(f"cast(array() as {PATH})").alias("path"))

    def joined(tops: DataFrame) -> DataFrame:
        above = _trees(tops.select(F.lit("").alias("tree"), F.col("tree").alias("key"), "digest", F.struct("tree").alias("row")),
                       band, fan, rooted)
        return tops.join(above.select(F.col("row.tree").alias("tree"), F.col("digest").alias("top"), "root", "path"), "tree")

    return _trees(leaves, band, fan, joined).select(
        "row", F.col("lo").alias("rank"), "digest", F.col("top").alias("subroot"), "root", "path")


def folded(digest: Column, path: Column) -> Column:
    """The root that a row's digest and the siblings on its path lead to."""
    return F.aggregate(path, digest, lambda done, step: F.sha2(F.concat(step["left"], done, step["right"]), 256))


def siblings_of(path: Column) -> Column:
    """All digests on a path as one text, from the leaf to the root, left to right."""
    return F.array_join(F.transform(path, lambda step: F.concat(step["left"], step["right"])), "")
