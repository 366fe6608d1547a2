"""Passages of words that an earlier document has, by fixed-block anchors.

A window is ``WINDOW`` words in a row of one document. Every document is indexed by its non-overlapping blocks of
(WINDOW + 1) / 2 words, so that any window of it holds exactly one of them whole. Every document probes that index with
each of its rolling stretches of that many words. A stretch that equals a block of a document with a smaller id is a
hit. Hits are then extended: the windows around a hit, and those around the blocks that were hit, are compared as wholes,
and runs of windows that an earlier document has make the maximal repeats that go.

Blocks and probes travel packed: for each bucket of hashes, a task sends one array of 32-bit values and the number of
them per document, and gets back which of a document's values were hit. Chance hits cost an extension that fails.
Windows are compared by 128 bits. A document whose whole text an earlier one has is left out of the extension.

No bucket holds much of one stretch or window: those that alone would fill a sixteenth of a bucket are found first, by
counts of bounded size that miss none beyond twice that. For these, at most ``FREQUENT`` of either kind, the smallest id
that has them (and for blocks the largest that probes them) is gathered by partial aggregates and goes to the rows, which
answer on the spot what a bucket would have answered.

Null and empty texts have no words. Fewer words than a window keep all. Equal ids are neither earlier nor later; rows
without an id are neither and keep all. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.storage import stored, with_keys
from tidewatch.llm.text import BYTE_CODES, PrefixHash, SecondHash, joined, mixed, slices, spans

WINDOW = 13
# Text whose probes one task is meant to take in.
BUCKET_BYTES = 24 << 20
# A stretch or window is frequent from this part of a bucket on; there are at most FREQUENT of either.
SHARE, FREQUENT = 16, 1 << 16
WHITE = np.isin(np.arange(256), list(b" \t\n\v\f\r"))
HIT = np.dtype([("bucket", "<i4"), ("place", "<i4"), ("probe", "?")])
MANY, NONE = np.iinfo(np.int64).max, np.iinfo(np.int64).min
PACKED = "bucket int, probe boolean, docs binary, tags binary, counts binary, keys binary, more binary"


def word_hashes(parts: list[bytes], second: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word of the texts, and where each text's words begin (one more entry: the end)."""
    data, begins = joined(parts)
    first, last = spans(~WHITE[data])
    kind = SecondHash if second else PrefixHash
    return kind(BYTE_CODES[data]).of(first, last), np.searchsorted(first, begins)


def stretches(edges: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(begin, text) of every ``size`` words in a row within one text."""
    counts = np.maximum(np.diff(edges) - size + 1, 0)
    owner = np.repeat(np.arange(len(counts)), counts)
    return edges[owner] + np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts), owner


def bucket_of(hashes: np.ndarray, buckets: int) -> np.ndarray:
    return (((hashes >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)).astype(np.int32)


class Counts:
    """The frequent values of a stream, in bounded memory.

    Beyond ``size`` values all counts fall by the largest one that has to go, so each is too low by at most the stream's
    length divided by ``size``.
    """

    def __init__(self, size: int) -> None:
        self.size, self.total, self.waiting = size, 0, []
        self.keys, self.counts = np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)

    def add(self, values: np.ndarray) -> None:
        self.waiting.append(values)
        self.total += len(values)
        if sum(map(len, self.waiting)) >= max(1 << 18, 4 * self.size):
            self.settle()

    def settle(self) -> None:
        new, counts = np.unique(np.concatenate([self.keys[:0], *self.waiting]), return_counts=True)
        self.keys, place = np.unique(np.concatenate((self.keys, new)), return_inverse=True)
        self.counts = np.bincount(place, np.concatenate((self.counts, counts)), len(self.keys)).astype(np.int64)
        self.waiting = []
        if len(self.keys) > self.size:
            least = len(self.keys) - self.size - 1
            self.counts -= np.partition(self.counts, least)[least]
            keep = self.counts > 0
            self.keys, self.counts = self.keys[keep], self.counts[keep]


def _tallies(batches: Iterator[pa.RecordBatch], window: int, block: int, size: int) -> Iterator[pa.RecordBatch]:
    """How often the frequent stretches and windows of a task occur, and (without a hash) how many there are in all."""
    tallies = {False: Counts(size), True: Counts(size)}
    for _, parts in slices(batches):
        words, edges = word_hashes(parts)
        one = PrefixHash(words)
        for wide, tally in tallies.items():
            length = window if wide else block
            begin, _ = stretches(edges, length)
            tally.add(one.of(begin, begin + length))
    for wide, tally in tallies.items():
        tally.settle()
        some = tally.counts * size >= tally.total
        keys, counts = tally.keys[some].view(np.int64), tally.counts[some]
        yield pa.RecordBatch.from_arrays(
            [pa.array([wide] * (len(keys) + 1)), pa.array([None, *keys.tolist()], pa.int64()),
             pa.array([tally.total, *counts.tolist()], pa.int64())], names=["wide", "one", "n"])


def _place(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which values are among the sorted keys, and where."""
    if not len(keys):
        return np.zeros(len(values), dtype=bool), np.zeros(len(values), dtype=np.int64)
    at = np.minimum(np.searchsorted(keys, values), len(keys) - 1)
    return keys[at] == values, at


def _extremes(batches: Iterator[pa.RecordBatch], window: int, block: int,
              keys: dict[bool, np.ndarray]) -> Iterator[pa.RecordBatch]:
    """Smallest id that has each frequent window or block, and largest id that probes the block, slice by slice."""
    for rows, parts in slices(batches):
        words, edges = word_hashes(parts)
        others, _ = word_hashes(parts, second=True)
        one, two = PrefixHash(words), SecondHash(others)
        docs = rows.column("doc_id").to_numpy(zero_copy_only=False).astype(np.int64)
        for wide, length in ((False, block), (True, window)):
            begin, owner = stretches(edges, length)
            some, at = _place(keys[wide], one.of(begin, begin + length))
            begin, owner, at = begin[some], owner[some], at[some]
            if not len(begin):
                continue
            rest = two.of(begin, begin + length) if wide else np.zeros(len(begin), dtype=np.uint64)
            doc = docs[owner]
            has = doc if wide else np.where((begin - edges[owner]) % block == 0, doc, MANY)
            order = np.lexsort((rest, at))
            at, rest, doc, has = at[order], rest[order], doc[order], has[order]
            new = np.flatnonzero(np.concatenate(([True], (at[1:] != at[:-1]) | (rest[1:] != rest[:-1]))))
            yield pa.RecordBatch.from_arrays(
                [pa.array([wide] * len(new)), pa.array(keys[wide][at[new]].view(np.int64)), pa.array(rest[new].view(np.int64)),
                 pa.array(np.minimum.reduceat(has, new)), pa.array(np.maximum.reduceat(doc, new))],
                names=["wide", "one", "two", "first", "last"])


@dataclass
class Frequent:
    """Frequent stretches and windows in the order of their hashes, and the ids that have them."""

    blocks: np.ndarray
    first: np.ndarray
    last: np.ndarray
    windows: np.ndarray
    rests: np.ndarray
    earliest: np.ndarray


def frequent(known: DataFrame, window: int, block: int, buckets: int) -> Frequent:
    """What a task looks up instead of asking a bucket: at most ``FREQUENT`` hashes of either kind."""
    most = min(FREQUENT, SHARE * buckets)
    tallies = stored(known.select("text").mapInArrow(
        lambda b: _tallies(b, window, block, 2 * most), "wide boolean, one long, n long")
        .groupBy("wide", "one").agg(F.sum("n").alias("n")), "tallies")
    totals = tallies.filter("one is null").select("wide", F.col("n").alias("total"))  # two rows
    rows = tallies.filter("one is not null").join(F.broadcast(totals), "wide").filter(
        F.col("n") * most >= F.greatest("total", F.lit(2 * most))).select("wide", "one").collect()
    keys = {wide: np.sort(np.array([r.one for r in rows if r.wide == wide], dtype=np.int64).view(np.uint64))
            for wide in (False, True)}
    found = []
    if rows:
        found = (known.select("doc_id", "text").mapInArrow(
            lambda b: _extremes(b, window, block, keys), "wide boolean, one long, two long, first long, last long")
            .groupBy("wide", "one", "two").agg(F.min("first").alias("first"), F.max("last").alias("last")).collect())
    sides = []
    for wide in (False, True):
        one, two, first, last = np.array([r[1:] for r in found if r.wide == wide], dtype=np.int64).reshape(-1, 4).T
        order = np.lexsort((two.view(np.uint64), one.view(np.uint64)))
        sides.append((one.view(np.uint64)[order], two.view(np.uint64)[order], first[order], last[order]))
    (blocks, _, first, last), (windows, rests, earliest, _) = sides
    return Frequent(blocks, first, last, windows, rests, earliest)


def _packed(hashes: np.ndarray, owner: np.ndarray, docs: np.ndarray, tags: np.ndarray | None, buckets: int, probe: bool,
            more: np.ndarray | None = None, width: str = "<u4") -> Iterator[tuple]:
    """A row per bucket: documents, how many values each has in it, and the values in text order."""
    target = bucket_of(hashes, buckets)
    order = np.argsort(target, kind="stable")
    cuts = np.searchsorted(target[order], np.arange(buckets + 1))
    for b in np.flatnonzero(np.diff(cuts)):
        mine = order[cuts[b]:cuts[b + 1]]
        counts = np.bincount(owner[mine], minlength=len(docs))
        some = np.flatnonzero(counts)
        yield (int(b), probe, docs[some].tobytes(), b"" if tags is None else tags[some].tobytes(),
               counts[some].astype("<u4").tobytes(), hashes[mine].astype(width).tobytes(),
               b"" if more is None else more[mine].tobytes())


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [[]] * 7
    types = [pa.int32(), pa.bool_()] + [pa.binary()] * 5
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)],
                                      names=[x.split()[0] for x in PACKED.split(", ")])


def _send(batches: Iterator[pa.RecordBatch], block: int, buckets: int, common: Frequent) -> Iterator[pa.RecordBatch]:
    for rows, parts in slices(batches):
        words, edges = word_hashes(parts)
        begin, owner = stretches(edges, block)
        hashes = PrefixHash(words).of(begin, begin + block)
        rare = ~_place(common.blocks, hashes)[0]
        begin, owner, hashes = begin[rare], owner[rare], hashes[rare]
        docs = rows.column("doc_id").to_numpy(zero_copy_only=False).astype(np.int64)
        whole = (begin - edges[owner]) % block == 0
        yield _batch([*_packed(hashes[whole], owner[whole], docs, None, buckets, False),
                      *_packed(hashes, owner, docs, None, buckets, True)])


def _gathered(table: pa.Table, probe: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(value, document, place among the document's values in this bucket) of one kind."""
    rows = table.filter(pc.equal(table["probe"], probe))

    def read(name: str, kind: str) -> np.ndarray:
        return np.frombuffer(b"".join(rows[name].to_pylist()), dtype=kind)

    counts = read("counts", "<u4").astype(np.int64)
    ends = np.cumsum(counts)
    place = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - counts, counts)
    return read("keys", "<u4"), np.repeat(read("docs", "<i8"), counts), place.astype(np.int32)


def _hits(key: tuple, table: pa.Table, groups: int) -> pa.Table:
    """Which probes meet a block of an earlier document, and which blocks a later document meets."""
    value, doc, place = _gathered(table, False)
    probe, by, at = _gathered(table, True)
    order = np.lexsort((doc, value))
    value, doc, place = value[order], doc[order], place[order]
    new = np.flatnonzero(np.diff(value.astype(np.int64), prepend=-1))
    known, earliest = value[new], doc[new]
    where = np.minimum(np.searchsorted(known, probe), max(len(known) - 1, 0))
    found = known[where] == probe if len(known) else np.zeros(len(probe), dtype=bool)
    latest = np.full(len(known), np.iinfo(np.int64).min)
    np.maximum.at(latest, where[found], by[found])
    found[found] = earliest[where[found]] < by[found]
    met = np.repeat(latest, np.diff(np.append(new, len(value)))) > doc
    owner = np.concatenate((by[found], doc[met]))
    hits = np.empty(len(owner), dtype=HIT)
    hits["bucket"], hits["place"] = key[0].as_py(), np.concatenate((at[found], place[met]))
    hits["probe"] = np.arange(len(owner)) < int(found.sum())
    return _routed(owner, np.zeros(len(owner), dtype=np.int64), hits, groups)


def _routed(doc: np.ndarray, tag: np.ndarray, values: np.ndarray, groups: int) -> pa.Table:
    """What a task found out about documents, packed into a row for each group of them."""
    group = (mixed(doc.view(np.uint64)) % np.uint64(groups)).astype(np.int32)
    order = np.lexsort((tag, doc, group))
    doc, tag, values, group = doc[order], tag[order], values[order], group[order]
    begins = np.flatnonzero(np.diff(group, prepend=-1))
    ends = np.append(begins[1:], len(group))[:len(begins)]
    packed = [[x[i:j].tobytes() for i, j in zip(begins, ends)] for x in (doc, tag, values)]
    return pa.table({"group": pa.array(group[begins], pa.int32()),
                     **{n: pa.array(x, pa.binary()) for n, x in zip(("docs", "tags", "found"), packed)}})


def _assembled(table: pa.Table, kind: np.dtype) -> pa.Table:
    """One row per document of a group with all that was found out about it."""
    doc, tag, values = (np.frombuffer(b"".join(table[n].to_pylist()), dtype=k)
                        for n, k in (("docs", "<i8"), ("tags", "<i8"), ("found", kind)))
    order = np.lexsort((tag, doc))
    doc, tag, values = doc[order], tag[order], values[order]
    begins = np.flatnonzero(np.concatenate(([True], (doc[1:] != doc[:-1]) | (tag[1:] != tag[:-1])))[:len(doc)])
    return pa.table({"doc_id": pa.array(doc[begins], pa.int64()), "tag": pa.array(tag[begins], pa.int64()),
                     "found": pa.array([values[i:j].tobytes() for i, j in zip(begins, [*begins[1:], len(doc)])], pa.binary())})


def _extend(batches: Iterator[pa.RecordBatch], window: int, block: int, buckets: int,
            common: Frequent) -> Iterator[pa.RecordBatch]:
    """Windows around the hits (as probes) and around the blocks that were hit, with all their bits."""
    for rows, parts in slices(batches):
        words, edges = word_hashes(parts)
        others, _ = word_hashes(parts, second=True)
        begin, owner = stretches(edges, block)
        hashes = PrefixHash(words).of(begin, begin + block)
        whole = (begin - edges[owner]) % block == 0
        wanted = {True: np.zeros(len(words) + 1, dtype=np.int64), False: np.zeros(len(words) + 1, dtype=np.int64)}
        docs, tags = (rows.column(n).to_numpy(zero_copy_only=False).astype(np.int64) for n in ("doc_id", "tag"))
        some, place = _place(common.blocks, hashes)
        if some.any():
            at, place, whose = begin[some], place[some], owner[some]
            for probe, hit in ((True, common.first[place] < docs[whose]),
                               (False, whole[some] & (common.last[place] > docs[whose]))):
                np.add.at(wanted[probe], np.maximum(at[hit] + block - window, edges[whose[hit]]), 1)
                np.add.at(wanted[probe], at[hit] + 1, -1)
            begin, owner, hashes, whole = (x[~some] for x in (begin, owner, hashes, whole))
        target = bucket_of(hashes, buckets)
        per_text = np.searchsorted(owner, np.arange(len(parts) + 1))
        for i, found in enumerate(rows.column("found").to_pylist()):
            hits, mine = np.frombuffer(found or b"", dtype=HIT), np.arange(per_text[i], per_text[i + 1])
            for probe in (True, False):
                those = mine if probe else mine[whole[mine]]
                order = those[np.argsort(target[those], kind="stable")]
                cuts = np.searchsorted(target[order], np.arange(buckets + 1))
                bucket, place = (hits[n][hits["probe"] == probe] for n in ("bucket", "place"))
                # Where ids are repeated, hits of another text may lie beyond this one.
                inside = place < cuts[bucket + 1] - cuts[bucket]
                at = begin[order[cuts[bucket[inside]] + place[inside]]]
                np.add.at(wanted[probe], np.maximum(at + block - window, edges[i]), 1)
                np.add.at(wanted[probe], at + 1, -1)
        starts, owner = stretches(edges, window)
        one, two = PrefixHash(words), SecondHash(others)
        more = np.dtype([("two", "<u8"), ("at", "<u4")])
        out = []
        for probe in (False, True):
            keep = np.cumsum(wanted[probe])[starts] > 0
            at, whose = starts[keep], owner[keep]
            rare = ~_place(common.windows, one.of(at, at + window))[0]
            at, whose = at[rare], whose[rare]
            rest = np.empty(len(at), dtype=more)
            rest["two"], rest["at"] = two.of(at, at + window), at - edges[whose]
            out += _packed(one.of(at, at + window), whose, docs, tags, buckets, probe, rest, "<u8")
        yield _batch(out)


def _earliest(one: np.ndarray, two: np.ndarray, doc: np.ndarray, key: np.ndarray, other: np.ndarray) -> np.ndarray:
    """The id that windows known by both hashes, in their order, have; ``MANY`` for unknown ones."""
    out = np.full(len(key), MANY)
    # Equal first halves with different second ones are next to each other; look at each of them.
    at = np.searchsorted(one, key)
    open_ = np.flatnonzero(at < len(one))
    while len(open_):
        open_ = open_[one[at[open_]] == key[open_]]
        same = two[at[open_]] == other[open_]
        out[open_[same]] = doc[at[open_[same]]]
        open_ = open_[~same]
        at[open_] += 1
        open_ = open_[at[open_] < len(one)]
    return out


def _earlier(table: pa.Table, groups: int) -> pa.Table:
    """Windows (as begins per document) that a document with a smaller id has."""
    more = np.dtype([("two", "<u8"), ("at", "<u4")])

    def read(rows: pa.Table, name: str, kind) -> np.ndarray:
        return np.frombuffer(b"".join(rows[name].to_pylist()), dtype=kind)

    sides = []
    for probe in (False, True):
        rows = table.filter(pc.equal(table["probe"], probe))
        counts = read(rows, "counts", "<u4").astype(np.int64)
        sides.append((read(rows, "keys", "<u8"), read(rows, "more", more), np.repeat(read(rows, "docs", "<i8"), counts),
                      np.repeat(read(rows, "tags", "<i8"), counts)))
    (one, rest, doc, _), (key, extra, by, tag) = sides
    order = np.lexsort((doc, rest["two"], one))
    one, two, doc = one[order], rest["two"][order], doc[order]
    new = np.concatenate(([True], (one[1:] != one[:-1]) | (two[1:] != two[:-1])))[:len(one)]
    one, two, doc = one[new], two[new], doc[new]
    hit = _earliest(one, two, doc, key, extra["two"]) < by
    return _routed(by[hit], tag[hit], extra["at"][hit], groups)


def _frequent_repeats(docs: pa.Array, parts: list[bytes], window: int, common: Frequent) -> list[np.ndarray]:
    """Where in each text frequent windows begin that a document with a smaller id has."""
    words, edges = word_hashes(parts)
    others, _ = word_hashes(parts, second=True)
    begin, owner = stretches(edges, window)
    key = PrefixHash(words).of(begin, begin + window)
    some = _place(common.windows, key)[0]
    begin, owner, key = begin[some], owner[some], key[some]
    first = _earliest(common.windows, common.rests, common.earliest, key, SecondHash(others).of(begin, begin + window))
    # Without an id, none is smaller.
    hit = first < docs.fill_null(NONE).to_numpy(zero_copy_only=False)[owner]
    begin, owner = begin[hit], owner[hit]
    cuts = np.searchsorted(owner, np.arange(len(parts) + 1))
    return [begin[a:b] - edge for a, b, edge in zip(cuts, cuts[1:], edges)]


def remove_repeats(docs: DataFrame, *, window: int = WINDOW, bucket_bytes: int = BUCKET_BYTES,
                   keep_text: bool = False) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept_sha256; ``keep_text`` adds ``clean_text``."""
    block = (window + 1) // 2
    text = F.coalesce("text", F.lit(""))
    texts = docs.select("doc_id", F.xxhash64(text).alias("tag"), text.alias("text"))
    known = texts.filter(F.col("doc_id").isNotNull())
    narrow = stored(known.select("doc_id", "tag", F.sha2("text", 256).alias("whole"),
                                 F.octet_length("text").cast("long").alias("bytes")), "texts")
    total = narrow.agg(F.sum("bytes")).first()[0] or 0
    buckets = max(1, -(-total // bucket_bytes))
    first = stored(narrow.groupBy("whole").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")).filter("n > 1"), "first")
    later = stored(with_keys(narrow, first, ["whole"], "n").filter("doc_id > first").select("doc_id", "tag").distinct(), "copies")

    common = frequent(known, window, block, buckets)
    spread = narrow.sparkSession.sparkContext.broadcast(common)

    # What comes back is packed by groups of documents, so rows do not multiply with the number of buckets.
    routed, assembled = "group int, docs binary, tags binary, found binary", "doc_id long, tag long, found binary"
    hits = stored(
        known.select("doc_id", "text").mapInArrow(lambda b: _send(b, block, buckets, spread.value), PACKED)
        .groupBy("bucket").applyInArrow(lambda key, t: _hits(key, t, buckets), routed)
        .groupBy("group").applyInArrow(lambda t: _assembled(t, HIT), assembled), "hits").drop("tag")
    # Of a document that is a copy as a whole nothing is left to find, and its original stands for it.
    around = (known.join(hits, "doc_id", "left" if len(common.blocks) else "inner").join(later, ["doc_id", "tag"], "left_anti")
              .mapInArrow(lambda b: _extend(b, window, block, buckets, spread.value), PACKED))
    gone = stored(around.groupBy("bucket").applyInArrow(lambda t: _earlier(t, buckets), routed)
                  .groupBy("group").applyInArrow(lambda t: _assembled(t, np.dtype("<u4")), assembled), "gone")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, parts in slices(batches):
            out, common = [], spread.value
            often = (_frequent_repeats(rows.column("doc_id"), parts, window, common) if len(common.windows)
                     else [np.zeros(0, dtype=np.int64)] * len(parts))
            for text, begins, copy, more in zip(
                    parts, rows.column("found").to_pylist(), rows.column("copy").to_pylist(), often):
                words = text.split()
                edge = np.zeros(len(words) + 1, dtype=np.int64)
                for begin in (np.frombuffer(begins or b"", dtype="<u4").astype(np.int64), more,
                              np.arange(max(0, len(words) - window + 1) if copy else 0)):
                    np.add.at(edge, begin, 1)
                    np.add.at(edge, begin + window, -1)
                removed = np.cumsum(edge[:-1]) > 0
                kept = b" ".join(w for w, r in zip(words, removed.tolist()) if not r)
                out.append((len(words), int(removed.sum()), hashlib.sha256(kept).hexdigest(), kept))
            n, m, digests, kept = zip(*out)
            columns = [rows.column("doc_id"), pa.array(n, pa.int64()), pa.array(m, pa.int64()), pa.array(digests)]
            names = ["doc_id", "n_words", "n_removed", "kept_sha256"]
            if keep_text:
                columns.append(pa.array([k.decode() for k in kept], pa.string()))
                names.append("clean_text")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string"
    return (texts.join(gone, ["doc_id", "tag"], "left")
            .join(later.withColumn("copy", F.lit(True)), ["doc_id", "tag"], "left")
            .select("doc_id", "text", "found", F.coalesce("copy", F.lit(False)).alias("copy"))
            .mapInArrow(run, schema + (", clean_text string" if keep_text else "")))
