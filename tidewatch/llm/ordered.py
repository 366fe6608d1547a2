"""Near-duplicate documents by order MinHash, verified by banded alignment.

A document is its sequence of shingles of five words (all its words where it has fewer). Each shingle carries the
number of its occurrence, so that repeats count. A sketch takes the ``MINIMA`` labelled shingles with the smallest
hashes under its seed and keeps them in text order; documents meet where a sketch agrees. The similarity of two
documents is |alignment| / (n + m - |alignment|) over their labelled shingles, where the alignment is their longest
common subsequence, so it falls with edits and with changes of order. Only matches within the band that the threshold
leaves room for can be part of an alignment that reaches it, and within it the result is exact.

No pair of a bucket that has a link is lost, and still not all are aligned: every member is aligned with the bucket's
first, another one in each bucket, which connects most of what belongs together. In buckets whose members are not all
connected then, those outside the largest connected part are compared with all members of other parts, block by block:
shared shingles bound the similarity, and pairs whose bound reaches the threshold are aligned until the parts are one.
Documents of equal words are one from the start. Links make components.

Texts without words are near-duplicates of equal texts only; null counts as empty. Each group keeps its smallest id.
Rows without an id are alone and stay. Of rows that share an id but not the text one stays if they are near-duplicates.
An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.components import components
from tidewatch.llm.storage import stored
from tidewatch.llm.text import BYTE_CODES, PrefixHash, joined, mixed, slices, spans, whole_rows

SHINGLE, THRESHOLD, SKETCHES, MINIMA = 5, 0.8, 16, 3
# Members of a bucket that a task compares with as many others.
BLOCK = 1024
FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
SEEDS = mixed(np.arange(1, SKETCHES + 1, dtype=np.uint64)) | np.uint64(1)


def labelled(shingles: np.ndarray) -> np.ndarray:
    """Hashes in which the second and later occurrences of a shingle differ from the first."""
    order = np.argsort(shingles, kind="stable")
    ranked = shingles[order]
    first = np.concatenate(([True], ranked[1:] != ranked[:-1]))
    if first.all():
        return shingles
    at = np.arange(len(ranked))
    number = np.zeros(len(ranked), dtype=np.uint64)
    number[order] = at - np.maximum.accumulate(np.where(first, at, 0))
    return np.where(number > 0, mixed(shingles + number * np.uint64(PrefixHash.BASE)), shingles)


def sequences(parts: list[bytes]) -> list[np.ndarray]:
    """Labelled shingles of each text, in text order."""
    data, begins = joined([x.translate(FOLD) for x in parts])
    first, last = spans(data != 32)
    words = PrefixHash(BYTE_CODES[data]).of(first, last)
    runs = PrefixHash(words)
    edges = np.searchsorted(first, begins)
    out = []
    for a, b in zip(edges[:-1], edges[1:]):
        size = min(SHINGLE, b - a)
        starts = np.arange(a, b - size + 1) if size else np.zeros(0, dtype=np.int64)
        out.append(labelled(runs.of(starts, starts + size)))
    return out


def sketches(shingles: np.ndarray) -> np.ndarray:
    """One key per seed: the smallest shingles, in text order."""
    values = shingles[None, :] * SEEDS[:, None]
    take = min(MINIMA, len(shingles))
    at = np.argpartition(values, take - 1, axis=1)[:, :take]
    at.sort(axis=1)
    key = SEEDS.copy()
    for column in at.T:
        key = mixed(key * np.uint64(PrefixHash.BASE) + shingles[column])
    return key


def alignment(a: np.ndarray, b: np.ndarray, threshold: float = THRESHOLD) -> float:
    """The similarity, or 0 where it is below the threshold."""
    total = len(a) + len(b)
    _, at_a, at_b = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    bound = len(at_a) / (total - len(at_a)) if total else 0.0
    if bound < threshold:
        return 0.0
    band = total * (1 - threshold) / (1 + threshold) + 1
    near = np.abs(at_a - at_b) <= band
    order = np.argsort(at_a[near])
    path = at_b[near][order]
    if (path[1:] > path[:-1]).all():
        length = len(path)
    else:
        tails: list[int] = []
        for x in path.tolist():
            at = bisect_left(tails, x)
            tails[at:at + 1] = [x]
        length = len(tails)
    similarity = length / (total - length)
    return similarity if similarity >= threshold else 0.0


def _sketched(docs: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, parts in slices(batches):
            found = sequences(parts)
            keys = [sketches(x).view(np.int64) if len(x) else np.zeros(0, dtype=np.int64) for x in found]
            # Copies: equal words, or equal texts where there are none.
            same = [hashlib.blake2b(b" ".join(t.translate(FOLD).split()) or b"\0" + t, digest_size=16).digest()
                    for t in parts]
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id"), rows.column("tag"), pa.array(same, pa.binary()),
                 pa.array([len(x) for x in found], pa.int32()), pa.array(keys, pa.list_(pa.int64()))],
                names=["doc_id", "tag", "id", "size", "keys"])

    return stored(tagged(docs).mapInArrow(run, "doc_id long, tag long, id binary, size int, keys array<long>"), "sketches")


def tagged(docs: DataFrame) -> DataFrame:
    """doc_id and tag together name a text even where ids are repeated."""
    text = F.coalesce("text", F.lit(""))
    return docs.select("doc_id", F.xxhash64(text).alias("tag"), text.alias("text"))


def _aligned(pairs: DataFrame, candidates: DataFrame, threshold: float) -> DataFrame:
    """(a, b, similarity) of pairs (a, b) of candidates."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, left in slices(batches, "text_a"):
            right = [x.encode() for x in rows.column("text_b").to_pylist()]
            # A first member stands in many rows.
            known = {x: y for x, y in zip(dict.fromkeys(right), sequences(list(dict.fromkeys(right))))}
            found = [alignment(a, known[b], threshold) for a, b in zip(sequences(left), right)]
            yield pa.RecordBatch.from_arrays(
                [rows.column("a"), rows.column("b"), pa.array(found, pa.float64())], names=["a", "b", "similarity"])

    with_a = pairs.join(candidates.select(F.col("id").alias("a"), F.col("text").alias("text_a")), "a")
    both = with_a.join(candidates.select(F.col("id").alias("b"), F.col("text").alias("text_b")), "b")
    return both.select("a", "b", "text_a", "text_b").mapInArrow(run, "a binary, b binary, similarity double")


def _apart(open_: DataFrame, joined: DataFrame) -> DataFrame:
    """(bucket, a, b, id, component, asks): buckets whose members are not all connected, in blocks.

    Members outside the bucket's largest component ask all others; pairs within that component need no look. Askers
    are cut into blocks ``a``, all members into blocks ``b``, and every pair of blocks is a task of its own.
    """
    named = open_.join(joined, "id", "left").select("bucket", "id", F.coalesce("component", "id").alias("component"))
    sizes = named.groupBy("bucket", "component").agg(F.count("*").alias("n"))
    largest = sizes.groupBy("bucket").agg(F.max(F.struct("n", "component")).alias("top"), F.sum("n").alias("n"),
                                          F.count("*").alias("parts")).filter("parts > 1")
    blocks = largest.select("bucket", F.col("top.component").alias("main"), F.ceil(F.col("n") / BLOCK).alias("nb"),
                            F.ceil((F.col("n") - F.col("top.n")) / BLOCK).alias("na"))
    rows = named.join(blocks, "bucket").withColumn("spread", F.xxhash64("id"))
    each = ["bucket", "a", "b", "id", "component", "asks"]
    asking = rows.filter("component <> main").withColumns(
        {"a": F.pmod("spread", "na"), "b": F.explode(F.sequence(F.lit(0), F.col("nb") - 1)), "asks": F.lit(True)})
    asked = rows.withColumns(
        {"b": F.pmod("spread", "nb"), "a": F.explode(F.sequence(F.lit(0), F.col("na") - 1)), "asks": F.lit(False)})
    return asking.select(*each).union(asked.select(*each))


def _compared(apart: DataFrame, candidates: DataFrame, threshold: float) -> DataFrame:
    """Links (a, b) between members that were not connected yet: at least one for each pair of components that has one."""
    def compare(table: pa.Table) -> pa.Table:
        asks = np.array(table["asks"].to_pylist(), dtype=bool)
        ids, found = table["id"].to_pylist(), sequences([t.encode() for t in table["text"].to_pylist()])
        names = {c: i for i, c in enumerate(dict.fromkeys(table["component"].to_pylist()))}
        parent = list(range(len(names)))
        part = [names[c] for c in table["component"].to_pylist()]

        def root(i: int) -> int:
            while parent[i] != i:
                parent[i] = i = parent[parent[i]]
            return i

        members = np.flatnonzero(~asks)
        sizes = np.array([len(found[i]) for i in members], dtype=np.int64)
        values = np.concatenate([found[i] for i in members]) if len(members) else np.zeros(0, dtype=np.uint64)
        order = np.argsort(values, kind="stable")
        values, owner = values[order], np.repeat(np.arange(len(members)), sizes)[order]
        links = []
        for i in np.flatnonzero(asks):
            low, high = np.searchsorted(values, found[i], side="left"), np.searchsorted(values, found[i], side="right")
            counts = high - low
            at = np.repeat(low - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
            common = np.bincount(owner[at], minlength=len(members))
            bound = common / np.maximum(len(found[i]) + sizes - common, 1)
            near = np.flatnonzero(bound >= threshold)
            for j in near[np.argsort(-bound[near], kind="stable")]:
                one, two = root(part[i]), root(part[members[j]])
                if one != two and alignment(found[i], found[members[j]], threshold):
                    parent[one] = two
                    links.append((ids[i], ids[members[j]]))
        a, b = zip(*links) if links else ((), ())
        return pa.table({"a": pa.array(a, pa.binary()), "b": pa.array(b, pa.binary())})

    return apart.join(candidates, "id").select("bucket", "a", "b", "id", "component", "asks", "text").groupBy(
        "bucket", "a", "b").applyInArrow(compare, "a binary, b binary")


def classes(docs: DataFrame, *, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: doc_id, tag, class_id (smallest id of its group), kept."""
    sketched = _sketched(docs)
    named = sketched.filter(F.col("doc_id").isNotNull())
    # From here on an id stands for all documents of equal words.
    copies = stored(named.groupBy("id").agg(F.min(F.struct("doc_id", "tag", "size", "keys")).alias("first")).select(
        "id", "first.*"), "copies")
    keyed = copies.select("id", "size", F.explode("keys").alias("bucket")).distinct()
    shared = keyed.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1").select("bucket")
    open_ = stored(keyed.join(shared, "bucket"), "buckets")
    wanted = copies.join(open_.select("id").distinct(), "id", "left_semi").select("id", "doc_id", "tag")
    candidates = stored(tagged(docs).join(wanted, ["doc_id", "tag"]).groupBy("id").agg(F.min("text").alias("text")),
                        "candidates")
    # Any member may be first, another one in each bucket, so that a family is tied together from many sides.
    first = open_.groupBy("bucket").agg(F.min(F.struct(F.xxhash64("id", "bucket"), "id", "size")).alias("first")).select(
        "bucket", F.col("first.id").alias("b"), F.col("first.size").alias("size_b"))
    pairs = open_.join(first, "bucket").filter((F.col("id") != F.col("b")) & (
        F.least("size", "size_b") >= threshold * F.greatest("size", "size_b"))).select(F.col("id").alias("a"), "b").distinct()
    links = stored(_aligned(pairs, candidates, threshold), "aligned").filter(F.col("similarity") >= threshold).select("a", "b")
    apart = stored(_apart(open_, components(links)), "apart")
    links = links.union(stored(_compared(apart, candidates, threshold), "compared"))
    grouped = copies.select("id", "doc_id").join(components(links), "id", "left").withColumn(
        "component", F.coalesce("component", "id"))
    heads = grouped.groupBy("component").agg(F.min(F.struct("doc_id", "id")).alias("head"))
    grouped = grouped.join(heads, "component").select("id", "head")
    own = F.struct("doc_id", "id")
    return sketched.select("doc_id", "tag", "id").join(grouped, "id", "left").select(
        "doc_id", "tag", F.when(F.col("doc_id").isNotNull(), F.col("head.doc_id")).alias("class_id"),
        F.when(F.col("doc_id").isNotNull(), own == F.col("head")).otherwise(True).alias("kept"))


def near_duplicates(docs: DataFrame, *, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: doc_id, class_id, kept."""
    return classes(docs, threshold=threshold).drop("tag")


def deduplicate(docs: DataFrame, *, threshold: float = THRESHOLD) -> DataFrame:
    """The documents, all columns, one of each group; rows that are repeated with their id count once."""
    found = stored(classes(docs, threshold=threshold), "classes")
    gone = found.filter("not kept").select("doc_id", "tag").distinct()
    rows = whole_rows(docs, doc_id=F.col("doc_id"), tag=F.xxhash64(F.coalesce("text", F.lit(""))))
    left = rows.join(gone, ["doc_id", "tag"], "left_anti")
    kept = found.filter("kept and doc_id is not null").select("doc_id", "tag")
    if kept.groupBy("doc_id", "tag").count().filter("count > 1").isEmpty():
        return left.select("row.*")
    return left.filter("doc_id is null").unionByName(
        left.filter("doc_id is not null").dropDuplicates(["doc_id", "tag"])).select("row.*")
