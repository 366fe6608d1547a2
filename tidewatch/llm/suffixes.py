"""Byte passages that occur more than once, by a distributed merge sort of suffixes that knows common prefixes.

A window is ``LENGTH`` bytes. The position with the smallest hash of ``PREFIX`` bytes within a window is its anchor, so
equal windows have equal anchors at equal places, and the suffixes at anchors stand for all others. An anchor whose
prefix occurs nowhere else settles its windows: they are unique. Where the whole context that windows of an anchor can
reach occurs again, its windows all repeat. What is left are anchors near the ends of repeats. Their suffixes are
sorted: every task sorts its own into a run, codes each suffix as the length of the prefix it shares with the one
before plus the rest, and sends the run's stretches to the tasks of their ranges. Ranges are cut at quantiles of the
first eight bytes; where many suffixes begin with the same eight bytes, their whole prefix chooses among them. There a
tree of losers merges the runs; a comparison starts behind the prefix that both sides are known to share with the last
output, and is decided without looking at bytes where these lengths differ. The merged order comes with the common
prefixes of neighbours.

Members of a group (equal ``PREFIX`` bytes) share with each other what lies between them in that order, and to the left
of the anchor what lies between them in the order of their reversed left contexts. A window repeats where some other
member shares its part on either side; going down the lengths of common prefixes finds that for all members at once.
Groups beyond ``GROUP`` different contexts, which one task should not hold, are settled by counting their windows.

Windows of a second, shorter length can be asked for in the same pass. Anchors are then those of the shorter windows: a
longer window has that of the shorter one it starts with, and contexts reach as far as the longer windows do. The merged
order settles either length.

Null texts are empty. Texts shorter than a window keep all. Repeated rows are documents like any other, so a repeated
long text is removed in both. Rows without an id are documents too. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.storage import stored, with_keys
from tidewatch.llm.text import BYTE_CODES, PrefixHash, SecondHash, joined, mixed, slices, spans, unpacked, whole_rows

LENGTH, PREFIX = 400, 64
GROUP = 1 << 16
# Members that one merging task is meant to hold.
RANGE_MEMBERS = 16384
CHUNK = 1 << 18
PLACE = np.uint64((1 << 20) - 1)
META = np.dtype([("doc", "<i8"), ("tag", "<i8"), ("at", "<i4"), ("low", "<i4"), ("high", "<i4"), ("alone", "<i4")])


def documents(docs: DataFrame) -> DataFrame:
    """doc and tag together name a document, even where ids are repeated or missing."""
    text = F.coalesce("text", F.lit(""))
    return docs.select(F.coalesce("doc_id", F.lit(-(1 << 63))).alias("doc"), F.xxhash64(text).alias("tag"),
                       "doc_id", text.alias("text"))


def anchors(hashes: np.ndarray, n_windows: int, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, first window, last window): runs of window starts whose smallest hash is the same one, leftmost of equals."""
    found = []
    for begin in range(0, n_windows, CHUNK):
        size = min(CHUNK, n_windows - begin)
        part = hashes[begin:begin + size + width - 1]
        least = (part & ~PLACE) | np.arange(len(part), dtype=np.uint64)
        reach = 1
        while 2 * reach <= width:
            least = np.minimum(least[:-reach], least[reach:])
            reach *= 2
        if reach < width:
            least = np.minimum(least[:size], least[width - reach:width - reach + size])
        found.append(begin + (least[:size] & PLACE).astype(np.int64))
    at = np.concatenate(found) if found else np.zeros(0, dtype=np.int64)
    new = np.flatnonzero(np.diff(at, prepend=-1))
    return at[new], new, np.append(new[1:], len(at)) - 1


def packed(spot: tuple[np.ndarray, ...], reach: int) -> np.ndarray:
    """Place of an anchor, least and most bytes before it at which its windows begin, and bytes of context from it on, as
    one number that sorts as they do; the last three are at most ``reach``."""
    bits = reach.bit_length()
    out, *rest = (x.astype(np.int64) for x in spot)
    if (out >> (63 - 3 * bits)).any():
        raise ValueError("text too long for windows of this length")
    for x in rest:
        out = (out << bits) | x
    return out


def spot(name: str, reach: int) -> Column:
    """One of the numbers that ``packed`` joined."""
    bits = reach.bit_length()
    shift = (3 - ("at", "low", "high", "room").index(name)) * bits
    value = F.shiftright("spot", shift)
    return (value if name == "at" else value.bitwiseAND(F.lit((1 << bits) - 1).cast("long"))).cast("int")


def _anchor_batches(batches: Iterator[pa.RecordBatch], length: int, prefix: int, reach: int) -> Iterator[pa.RecordBatch]:
    """Anchors of windows of ``length`` bytes, with their contexts up to ``reach`` bytes from the anchor on."""
    width = length - prefix + 1
    for rows, parts in slices(batches):
        data, begins = joined(parts)
        if len(data) <= length:
            continue
        codes = BYTE_CODES[data]
        one, two = PrefixHash(codes), SecondHash(codes)
        starts = np.arange(len(data) - prefix + 1)
        hashes = one.of(starts, starts + prefix)
        at, first, last = anchors(hashes, len(data) - length + 1, width)
        # A run may reach over the end of a text; its windows end with the text.
        owner = np.searchsorted(begins, at, side="right") - 1
        low, high = begins[owner], begins[owner + 1] - 1
        first, last = np.maximum(first, low), np.minimum(last, high - length)
        keep = (first <= last) & (last - low >= 0)
        at, first, last, owner, low, high = (x[keep] for x in (at, first, last, owner, low, high))
        left, right = np.maximum(low, at + prefix - length), np.minimum(high, at + reach)
        shape = ((at - left) * 1024 + (right - at)).astype(np.uint64)
        head = np.zeros(len(at), dtype=np.uint64)
        for i in range(8):
            head = (head << np.uint64(8)) | data[at + i]
        pick = pa.array(owner)
        yield pa.RecordBatch.from_arrays(
            [rows.column("doc").take(pick), rows.column("tag").take(pick),
             pa.array(packed((at - low, at - last, at - first, right - at), reach)), pa.array(hashes[at].view(np.int64)),
             pa.array((head ^ np.uint64(1 << 63)).view(np.int64)),
             pa.array(mixed(one.of(left, right) + shape).view(np.int64)),
             pa.array(mixed(two.of(left, right) + shape).view(np.int64))],
            names=["doc", "tag", "spot", "prefix", "head", "c1", "c2"])


def shared_length(a: bytes, b: bytes, known: int = 0) -> int:
    """Length of the common prefix, of which ``known`` bytes need no look."""
    n = min(len(a), len(b))
    if a[known:n] == b[known:n]:
        return n
    differing = int.from_bytes(a[known:n], "big") ^ int.from_bytes(b[known:n], "big")
    return n - (differing.bit_length() + 7) // 8


class Run:
    """A sorted run of suffixes, front-coded: shared lengths, lengths of the rests, and the rests."""

    def __init__(self, shared: np.ndarray, sizes: np.ndarray, rests: bytes) -> None:
        self.shared, self.sizes, self.rests = shared.tolist(), sizes.tolist(), rests
        self.row = self.at = 0
        self.suffix, self.known = b"", 0

    @staticmethod
    def code(suffixes: list[bytes]) -> tuple[np.ndarray, np.ndarray, bytes]:
        shared = [0][:len(suffixes)] + [shared_length(a, b) for a, b in zip(suffixes, suffixes[1:])]
        rests = [s[k:] for s, k in zip(suffixes, shared)]
        return np.array(shared, dtype="<u2"), np.array([len(r) for r in rests], dtype="<u2"), b"".join(rests)

    def advance(self) -> bool:
        if self.row == len(self.shared):
            return False
        self.known, size = self.shared[self.row], self.sizes[self.row]
        self.suffix = self.suffix[:self.known] + self.rests[self.at:self.at + size]
        self.at += size
        self.row += 1
        return True


def merged(runs: list[Run]) -> Iterator[tuple[int, int, bytes, int]]:
    """(run, row in it, suffix, length shared with the suffix before) in sorted order.

    Every loser in the tree knows how much it shares with the winner that passed it, and the new head of a run how much
    it shares with the last output. Where both lengths differ, the larger wins unseen.
    """
    k = 1
    while k < len(runs):
        k *= 2
    live = [i < len(runs) and runs[i].advance() for i in range(k)]
    known = [0] * k

    def play(a: int, b: int) -> tuple[int, int]:
        """(winner, loser); the loser then knows what it shares with the winner."""
        if not live[a] or not live[b]:
            return (a, b) if live[a] else (b, a)
        if known[a] != known[b]:
            return (a, b) if known[a] > known[b] else (b, a)
        one, two = runs[a].suffix, runs[b].suffix
        same = shared_length(one, two, known[a])
        first = same == len(one) or (same < len(two) and one[same] < two[same])
        known[b if first else a] = same
        return (a, b) if first else (b, a)

    losers = [0] * k
    level = list(range(k))
    while len(level) > 1:
        width = len(level) // 2
        for i in range(width):
            level[i], losers[width + i] = play(level[2 * i], level[2 * i + 1])
        level = level[:width]
    winner = level[0]
    while live[winner]:
        run = runs[winner]
        yield winner, run.row - 1, run.suffix, known[winner]
        live[winner] = run.advance()
        known[winner] = run.known
        node = (k + winner) // 2
        while node:
            winner, losers[node] = play(winner, losers[node])
            node //= 2


def _matrix(strings: list[bytes], width: int) -> np.ndarray:
    """Rows of bytes as 16-bit numbers; behind the end each row has numbers of its own."""
    out = np.empty((len(strings), width + 1), dtype=np.int32)
    out[:] = -1 - np.arange(len(strings))[:, None]
    for i, s in enumerate(strings):
        out[i, :len(s)] = np.frombuffer(s, dtype=np.uint8)
    return out


def repeats(meta: np.ndarray, shared: list[int], lefts: list[bytes], length: int) -> list[tuple[int, int, int]]:
    """(member, low, high): members alone with their context have repeating windows ``low`` to ``high`` bytes before
    their anchor. ``shared`` has what neighbours share to the right; ``lefts`` are left contexts, last byte first."""
    n = len(meta)
    found: list[tuple[int, int, int]] = []
    if n == 2:
        low, high = length - shared[0], shared_length(*lefts)
        found = [(i, max(low, m["low"]), min(high, m["high"])) for i, m in enumerate(meta) if m["alone"]]
        return [f for f in found if f[1] <= f[2]]
    right = np.minimum(np.array([0, *shared]), length)
    left = _matrix(lefts, max(map(len, lefts)))
    rank = np.empty(n, dtype=np.int64)
    rank[sorted(range(n), key=lefts.__getitem__)] = np.arange(n)
    low, high = np.zeros(n, dtype=np.int64), np.full(n, -1)
    for reach in np.unique(right[1:])[::-1]:
        begin = length - reach
        if begin >= left.shape[1]:  # no left context reaches so far
            break
        group = np.cumsum(right < reach)
        order = np.lexsort((rank, group))
        same = group[order[1:]] == group[order[:-1]]
        a, b = order[:-1][same], order[1:][same]
        common = (left[a] != left[b]).argmax(axis=1)
        best = np.full(n, -1)
        np.maximum.at(best, a, common)
        np.maximum.at(best, b, common)
        some = best >= begin
        apart = some & (begin > high + 1)
        found += [(int(i), int(low[i]), int(high[i])) for i in np.flatnonzero(apart & (high >= low))]
        low[apart] = begin
        high[some] = np.maximum(high[some], best[some])
    found += [(int(i), int(low[i]), int(high[i])) for i in np.flatnonzero(high >= low)]
    found = [(i, max(a, int(meta["low"][i])), min(b, int(meta["high"][i]))) for i, a, b in found if meta["alone"][i]]
    return [f for f in found if f[1] <= f[2]]


def ranges(edges: np.ndarray, heads: np.ndarray, prefixes: np.ndarray) -> np.ndarray:
    """The range of each suffix: by its first eight bytes, and where these fill several ranges, by its whole prefix.

    Suffixes of one prefix, which are compared with each other, always meet in one range.
    """
    least, most = (np.searchsorted(edges, heads, side=side) for side in ("left", "right"))
    return least + (mixed(prefixes.view(np.uint64)) % (most - least + 1).astype(np.uint64)).astype(np.int64)


def _runs(batches: Iterator[pa.RecordBatch], splitters: list[int], length: int, prefix: int,
          reach: int) -> Iterator[pa.RecordBatch]:
    """Contexts of the members of each batch as front-coded runs, one for each range."""
    edges = np.array(splitters, dtype=np.int64)
    for rows, parts in slices(batches):
        meta, heads, prefixes, rights, lefts = [], [], [], [], []
        docs, tags = rows.column("doc").to_pylist(), rows.column("tag").to_pylist()
        for doc, tag, text, members in zip(docs, tags, parts, rows.column("members").to_pylist()):
            for m in members:
                at = m["at"]
                meta.append((doc, tag, at, m["low"], m["high"], m["alone"]))
                heads.append(m["head"])
                prefixes.append(m["prefix"])
                rights.append(text[at:at + reach])
                lefts.append(text[max(0, at + prefix - length):at][::-1])
        meta = np.array(meta, dtype=META)
        target = ranges(edges, np.array(heads, dtype=np.int64), np.array(prefixes, dtype=np.int64))
        order = np.array(sorted(range(len(rights)), key=rights.__getitem__), dtype=np.int64)
        order = order[np.argsort(target[order], kind="stable")]
        target = target[order]
        out = []
        for begin, end in zip(*_stretches(target)):
            mine = order[begin:end]
            shared, sizes, rests = Run.code([rights[i] for i in mine])
            out.append((int(target[begin]), shared.tobytes(), sizes.tobytes(), rests, meta[mine].tobytes(),
                        np.array([len(lefts[i]) for i in mine], dtype="<u2").tobytes(), b"".join(lefts[i] for i in mine)))
        columns = list(zip(*out)) or [[]] * 7
        yield pa.RecordBatch.from_arrays(
            [pa.array(columns[0], pa.int32()), *(pa.array(c, pa.binary()) for c in columns[1:])],
            names=["range", "shared", "sizes", "rests", "meta", "left_sizes", "lefts"])


def _stretches(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    begins = np.flatnonzero(np.diff(values, prepend=-1)) if len(values) else np.zeros(0, dtype=np.int64)
    return begins, np.append(begins[1:], len(values))[:len(begins)]


def _merge(table: pa.Table, ends: dict[str, int], prefix: int) -> pa.Table:
    """Merge the runs of a range and settle its groups for the windows of each length in ``ends``."""
    runs, metas, lefts = [], [], []
    for row in table.to_pylist():
        runs.append(Run(np.frombuffer(row["shared"], "<u2"), np.frombuffer(row["sizes"], "<u2"), row["rests"]))
        metas.append(np.frombuffer(row["meta"], META))
        stops = np.cumsum(np.frombuffer(row["left_sizes"], "<u2").astype(np.int64))
        lefts.append([row["lefts"][a:b] for a, b in zip(np.concatenate(([0], stops[:-1])).tolist(), stops.tolist())])
    out: list[tuple[int, ...]] = []
    group: list[tuple[int, int]] = []
    shared: list[int] = []

    def settle() -> None:
        if len(group) > 1:
            meta = np.array([metas[r][i] for r, i in group], dtype=META)
            left = [lefts[r][j] for r, j in group]
            for name, size in ends.items():
                for i, low, high in repeats(meta, shared, left, size):
                    at = int(meta["at"][i])
                    out.append((int(meta["doc"][i]), int(meta["tag"][i]), at - high,
                                *(at - low + size if n == name else at - high for n in ends)))

    for run, row, _, same in merged(runs):
        if same < prefix:
            settle()
            group, shared = [], []
        else:
            shared.append(same)
        group.append((run, row))
    settle()
    columns = list(zip(*out)) or [[]] * (3 + len(ends))
    return pa.table({k: pa.array(c, t) for k, c, t in zip(
        ("doc", "tag", "begin", *ends), columns, (pa.int64(), pa.int64(), pa.int32(), *(pa.int32() for _ in ends)))})


def _windows(batches: Iterator[pa.RecordBatch], sizes: list[int]) -> Iterator[pa.RecordBatch]:
    """128-bit hashes of all windows of the given anchors, of each size."""
    for rows, parts in slices(batches):
        for i, text in enumerate(parts):
            codes = BYTE_CODES[np.frombuffer(text, dtype=np.uint8)]
            members = rows.column("members")[i].as_py()
            for size in sizes:
                starts = np.concatenate([np.arange(m["at"] - m["high"], min(m["at"] - m["low"], len(text) - size) + 1)
                                         for m in members])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([rows.column("doc")[i].as_py()] * len(starts), pa.int64()),
                     pa.array([rows.column("tag")[i].as_py()] * len(starts), pa.int64()), pa.array(starts.astype(np.int32)),
                     pa.array([size] * len(starts), pa.int32()),
                     pa.array(PrefixHash(codes).of(starts, starts + size).view(np.int64)),
                     pa.array(SecondHash(codes).of(starts, starts + size).view(np.int64))],
                    names=["doc", "tag", "begin", "size", "w1", "w2"])


def repeated_spans(texts: DataFrame, *, length: int = LENGTH, prefix: int = PREFIX, group: int = GROUP,
                   shorter: int | None = None) -> DataFrame:
    """(doc, tag, spans): stretches of bytes, ``begin`` to ``end``, covered by strings of ``length`` bytes that also start
    elsewhere. With ``shorter``, also those that strings of so many bytes cover, ``begin`` to ``short_end``; a stretch of
    one kind only is empty in the other."""
    ends = {"end": length} | ({"short_end": shorter} if shorter else {})
    least = min(ends.values())
    if not prefix <= least <= length:
        raise ValueError("the shorter length lies between the prefix and the length")
    found = stored(texts.filter(F.octet_length("text") >= least).select("doc", "tag", "text").mapInArrow(
        lambda batches: _anchor_batches(batches, least, prefix, length),
        "doc long, tag long, spot long, prefix long, head long, c1 long, c2 long"), "anchors")
    again = stored(found.groupBy("prefix").agg(F.count("*").alias("n")).filter("n > 1"), "again")
    shared = stored(with_keys(found, again, ["prefix"], "n").drop("n"), "shared", replaces=found)
    context = ["prefix", "c1", "c2"]
    classes = stored(shared.groupBy(*context).agg(
        F.count("*").alias("n"), F.min(F.struct("doc", "tag", "spot", "head")).alias("m")), "contexts")
    at, low, high, room = (spot(name, length) for name in ("at", "low", "high", "room"))
    begin = at - high

    def end(size: int) -> Column:
        """Where the windows of an anchor end, those that the text has room for."""
        lowest = F.greatest(low, F.lit(size) - room)
        return F.when(high >= lowest, at - lowest + size).otherwise(begin)

    whole = with_keys(shared, classes.filter("n > 1").select(*context, "n"), context, "n").select(
        "doc", "tag", begin.alias("begin"), *(end(size).alias(name) for name, size in ends.items()))
    groups = stored(classes.groupBy("prefix").agg(F.count("*").alias("contexts"), F.min("n").alias("least")).filter(
        "contexts > 1 and least = 1").select("prefix", "contexts"), "groups")
    members = stored(with_keys(classes, groups, ["prefix"], "contexts").select(
        "prefix", "m.*", "n", "contexts").select(
        "prefix", "doc", "tag", "head", at.alias("at"), low.alias("low"), high.alias("high"),
        F.when(F.col("n") == 1, 1).otherwise(0).alias("alone"), (F.col("contexts") > group).alias("large")), "members")
    total, large = members.agg(F.count("*"), F.count_if("large")).first()
    covered = whole

    def with_texts(rows: DataFrame) -> DataFrame:
        by_doc = rows.groupBy("doc", "tag").agg(F.collect_list(F.struct("at", "low", "high", "head", "prefix", "alone")).alias("members"))
        # A repeated row brings its contexts twice, which changes nothing: they are not alone.
        return by_doc.join(texts.select("doc", "tag", "text"), ["doc", "tag"])

    if total > large:
        n = -(-(total - large) // RANGE_MEMBERS)
        splitters = members.filter("not large").agg(
            F.percentile_approx("head", [i / n for i in range(1, n)], 100 * n)).first()[0] if n > 1 else []
        runs = with_texts(members.filter("not large")).mapInArrow(
            lambda batches: _runs(batches, splitters, least, prefix, length),
            "range int, shared binary, sizes binary, rests binary, meta binary, left_sizes binary, lefts binary")
        covered = covered.union(runs.groupBy("range").applyInArrow(
            lambda table: _merge(table, ends, prefix),
            "doc long, tag long, begin int, " + ", ".join(f"{name} int" for name in ends)))
    if large:
        windows = stored(with_texts(members.filter("large")).mapInArrow(
            lambda batches: _windows(batches, sorted(set(ends.values()))),
            "doc long, tag long, begin int, size int, w1 long, w2 long"), "windows")
        twice = windows.groupBy("size", "w1", "w2").agg(F.count("*").alias("n")).filter("n > 1")
        covered = covered.union(windows.join(twice, ["size", "w1", "w2"]).select("doc", "tag", "begin", *(
            F.when(F.col("size") == size, F.col("begin") + size).otherwise(F.col("begin")).alias(name)
            for name, size in ends.items())))
    return covered.groupBy("doc", "tag").agg(F.collect_set(F.struct("begin", *ends)).alias("spans"))


def inside(size: int, found: list[dict], end: str = "end") -> np.ndarray:
    """Which of ``size`` bytes lie in a stretch."""
    edge = np.zeros(size + 1, dtype=np.int64)
    np.add.at(edge, [s["begin"] for s in found], 1)
    np.add.at(edge, [s[end] for s in found], -1)
    return np.cumsum(edge[:-1]) > 0


def without(text: bytes, found: list[dict] | None) -> tuple[bytes, int]:
    """What is left of a text, and the number of maximal stretches removed."""
    if not found:
        return text, 0
    gone = inside(len(text), found)
    return np.frombuffer(text, dtype=np.uint8)[~gone].tobytes(), len(spans(gone)[0])


def remove_repeats(docs: DataFrame, *, length: int = LENGTH, prefix: int = PREFIX, group: int = GROUP,
                   keep_text: bool = False, shorter: int | None = None) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256.

    ``keep_text`` adds ``clean_text``, in which a character that lost some of its bytes is gone as a whole. ``shorter``
    adds ``n_repeated``, the bytes covered by strings of so many bytes that also start elsewhere; these are not removed.
    """
    texts = documents(docs)
    found = repeated_spans(texts, length=length, prefix=prefix, group=group, shorter=shorter)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, parts in slices(batches):
            found = rows.column("spans").to_pylist()
            left = [without(t, s) for t, s in zip(parts, found)]
            columns = [rows.column("doc_id"), pa.array([len(t) for t in parts], pa.int64()),
                       pa.array([len(t) - len(k) for t, (k, _) in zip(parts, left)], pa.int64()),
                       pa.array([n for _, n in left], pa.int64()),
                       pa.array([hashlib.sha256(k).hexdigest() for k, _ in left], pa.string())]
            names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
            if keep_text:
                columns.append(pa.array([k.decode(errors="ignore") for k, _ in left], pa.string()))
                names.append("clean_text")
            if shorter:
                columns.append(pa.array([int(inside(len(t), s, "short_end").sum()) if s else 0
                                         for t, s in zip(parts, found)], pa.int64()))
                names.append("n_repeated")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    return texts.join(found, ["doc", "tag"], "left").select("doc_id", "text", "spans").mapInArrow(
        run, schema + (", clean_text string" if keep_text else "") + (", n_repeated long" if shorter else ""))


def clean(docs: DataFrame, *, length: int = LENGTH, prefix: int = PREFIX, group: int = GROUP) -> DataFrame:
    """The documents, all columns, without passages of ``length`` bytes or more that repeat; a text may come out empty."""
    found = repeated_spans(documents(docs), length=length, prefix=prefix, group=group)
    schema = docs.schema
    text = F.coalesce("text", F.lit(""))
    rows = whole_rows(docs, doc=F.coalesce("doc_id", F.lit(-(1 << 63))), tag=F.xxhash64(text))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, parts in slices(batches):
            left = [without(t, s)[0].decode(errors="ignore") if s else t.decode()
                    for t, s in zip(parts, rows.column("spans").to_pylist())]
            yield unpacked(rows.column("row"), schema, pa.array(left, pa.string()))

    return rows.join(found, ["doc", "tag"], "left").select("row", "text", "spans").mapInArrow(run, schema)
