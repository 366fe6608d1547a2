"""Best-two-fit packing of tokenised documents into sequences of a fixed length.

A sequence is filled greedily, each time with the longest piece that still fits. If a gap remains, the shortest piece
in it gives way to the two unpacked pieces that fill the widened gap best, where these hold more than it did. Pieces of
one length are alike here, so the plan is made on the number of pieces of each length: a sequence of the same make-up is
used as often as the counts allow, before the next is looked for. The counts are at most ``length`` numbers and the plan
a few entries for each, however many documents there are. What grows with the documents stays on the executors:
tokens, ranks and places.

Every piece has a number among those of its length: its task's count of that length, plus the pieces of that length in
tasks before. The plan gives each stretch of these numbers a row of sequences, so a piece finds its place by a look-up.

Null texts are empty and hold the end token alone; texts of more than ``length`` tokens are cut into pieces of that
length, of which the first may be shorter; repeated rows, repeated and null ids are packed as often as they occur; an
empty table gives no pieces. Columns other than ``doc_id`` and ``text`` are not looked at.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.llm.bpe import gathered
from tidewatch.llm.records import LibraryPieces
from tidewatch.llm.storage import stored
from tidewatch.llm.text import BYTE_CODES, by_two_hashes, slices, texts

LENGTH = 2048
END_TOKEN = 0
PIECES = "doc_id long, piece int, start long, length long, ids binary, block long, place long"

# What may precede white space at a cut: printable ASCII, or the second byte of a letter from U+00C0 to U+07FF.
_SOLID = np.array([33 <= c <= 126 for c in range(256)])
_LEADS = np.array([0xC3 <= c <= 0xDF for c in range(256)])
_SPACES = np.array([c in b" \t\n\v\f\r" for c in range(256)])
# ASCII letters 1, digits 2, signs 4 without those that begin contractions or special tokens, all else 0.
_KINDS = np.array([0 if not 33 <= c <= 126 or c in b"'<|>" else 1 if chr(c).isalpha() else 2 if chr(c).isdigit() else 4
                   for c in range(256)], dtype=np.uint8)
# One word of letters up to U+00FF, or of digits, with a space before it or without.
_WORD = re.compile(rb" ?(?:(?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+|[0-9]+)")
# Distinct pieces a worker remembers: some 100 MB.
CACHE_PIECES = 1_000_000


class BytePieces(LibraryPieces):
    """Byte-level pair encoding by the library, which is asked once for each distinct piece that the cache holds.

    Texts are cut before white space that follows something else, and between ASCII letters, digits and signs. The
    tokenizer's own pattern never crosses such a place, and what it does on either side does not depend on the other.
    A piece that is one word goes to the library's model directly, in the characters that stand for its bytes.
    """

    def __init__(self, path: str) -> None:
        super().__init__(path)
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = iter(range(256, 512))
        self.letters = {b: b if b in plain else next(rest) for b in range(256)}

    def encode_pieces(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        single = [_WORD.fullmatch(x) is not None for x in pieces]
        tokenize = self.library.model.tokenize
        found = [[token.id for token in tokenize(x.decode("latin-1").translate(self.letters))] if alone else None
                 for x, alone in zip(pieces, single)]
        others = iter(self.library.encode_batch_fast([x.decode() for x, alone in zip(pieces, single) if not alone],
                                                     add_special_tokens=False))
        found = [ids if alone else next(others).ids for ids, alone in zip(found, single)]
        sizes = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
        return np.fromiter(chain.from_iterable(found), dtype=np.int32, count=int(sizes.sum())), sizes

    def encode(self, parts: list[bytes]) -> list[np.ndarray]:
        if self.known.size > CACHE_PIECES:
            self._forget()
        ends = np.cumsum([len(x) for x in parts], dtype=np.int64)
        whole = b"".join(parts)
        if not whole:
            return [np.zeros(0, dtype=np.int32)] * len(parts)
        data = np.frombuffer(whole, dtype=np.uint8)
        cut = np.zeros(len(data) + 1, dtype=bool)
        solid = _SOLID[data]
        solid[1:] |= _LEADS[data[:-1]]
        kind = _KINDS[data]
        cut[1:-1] = (_SPACES[data[1:]] & solid[:-1]) | ((kind[1:] != kind[:-1]) & (kind[1:] > 0) & (kind[:-1] > 0))
        cut[0] = True
        cut[ends] = True
        edges = np.flatnonzero(cut)
        first, last = edges[:-1], edges[1:]
        one, two = by_two_hashes(BYTE_CODES[data], first, last)
        rows = self.known.find(one, two)
        while len(new := np.flatnonzero(rows < 0)):
            _, at = np.unique(one[new], return_index=True)
            at = new[at]
            self._learn([whole[i:j] for i, j in zip(first[at].tolist(), last[at].tolist())])
            self.known.add(one[at], two[at])
            rows[new] = self.known.find(one[new], two[new])
        found, stops = gathered(self.ids, self.begins[rows], self.sizes[rows])
        stops = np.concatenate(([0], stops))
        return np.split(found, stops[np.searchsorted(first, ends[:-1])])


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> BytePieces:
    return BytePieces(path)


def pieces(docs: DataFrame, vocabulary: str, *, length: int = LENGTH, end_token: int = END_TOKEN) -> DataFrame:
    """Token ids (little-endian, 32 bits) of all documents in pieces of at most ``length``, written once and read again.

    ``block`` is the task that made a piece and ``place`` counts the pieces of its length in that task. Both are read
    from what the committed attempt of a task wrote, so a repeated task cannot give them twice.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, block = encoder(vocabulary), TaskContext.get().partitionId()
        seen = np.zeros(length + 1, dtype=np.int64)
        for rows, parts in slices(batches):
            ids = [np.append(x, end_token).astype("<u4") for x in tokens.encode(parts)]
            sizes = np.array([len(x) for x in ids], dtype=np.int64)
            number = -(-sizes // length)
            of = np.repeat(np.arange(len(ids)), number)
            piece = np.arange(len(of)) - np.repeat(np.cumsum(number) - number, number)
            # The first piece takes what is left over, the others are full.
            lead = sizes - (number - 1) * length
            start = np.where(piece == 0, 0, lead[of] + (piece - 1) * length)
            size = np.where(piece == 0, lead[of], length)
            order = np.argsort(size, kind="stable")
            sorted_sizes = size[order]
            begins = np.searchsorted(sorted_sizes, sorted_sizes, side="left")
            place = np.empty(len(size), dtype=np.int64)
            place[order] = seen[sorted_sizes] + np.arange(len(size)) - begins
            np.add.at(seen, size, 1)
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id").take(pa.array(of)), pa.array(piece, pa.int32()), pa.array(start), pa.array(size),
                 pa.array([ids[d][s:s + n].tobytes() for d, s, n in zip(of.tolist(), start.tolist(), size.tolist())], pa.binary()),
                 pa.array(np.full(len(of), block, dtype=np.int64)), pa.array(place)],
                names=["doc_id", "piece", "start", "length", "ids", "block", "place"])

    return stored(texts(docs).select(F.col("doc_id").cast("long"), "text").mapInArrow(run, PIECES), "pieces")


def fillings(counts: np.ndarray, length: int) -> Iterator[tuple[int, list[tuple[int, int]]]]:
    """(number of sequences, [(piece length, pieces of it in each)]) until no piece is left of ``counts[length of piece]``."""
    left = counts.astype(np.int64).copy()
    left[0] = 0
    numbers = np.arange(length + 1)
    while left.any():
        fitting = np.maximum.accumulate(np.where(left > 0, numbers, 0))  # longest piece left of at most so many tokens
        used: dict[int, int] = {}
        gap, size = length, int(fitting[length])
        while size:
            taken = min(int(left[size]), gap // size)
            used[size] = taken
            gap -= taken * size
            size = int(fitting[min(gap, size - 1)])
        if gap:
            _two_for_one(left, used, gap)
        times = min(int(left[size]) // taken for size, taken in used.items())
        for size, taken in used.items():
            left[size] -= times * taken
        yield times, sorted(used.items(), reverse=True)


def _two_for_one(left: np.ndarray, used: dict[int, int], gap: int) -> None:
    """The shortest piece of a sequence gives way to the two unpacked pieces that fill its room best, if any fill more."""
    rest = left.copy()
    for size, taken in used.items():
        rest[size] -= taken
    shortest = min(used)
    room = gap + shortest
    sizes = np.flatnonzero(rest[:room] > 0)
    if not len(sizes):
        return
    fitting = np.maximum.accumulate(np.where(rest[:room] > 0, np.arange(room), 0))
    other = fitting[room - sizes]
    lone = (other == sizes) & (rest[sizes] < 2)
    other = np.where(lone, fitting[sizes - 1], other)
    total = np.where(other > 0, sizes + other, 0)
    best = int(total.argmax())
    if total[best] > shortest:
        used[shortest] -= 1
        if not used[shortest]:
            del used[shortest]
        for size in (int(sizes[best]), int(other[best])):
            used[size] = used.get(size, 0) + 1


@dataclass
class Plan:
    """Stretches of piece numbers (ordered by length, then number) and the sequences that take them."""

    first_of: np.ndarray
    number: np.ndarray
    each: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray
    sequences: int


def planned(counts: np.ndarray, length: int) -> Plan:
    """The places of all pieces, given how many there are of each length (``counts[0]`` is not used)."""
    first_of = np.cumsum(counts) - counts
    given = np.zeros(length + 1, dtype=np.int64)
    rows, sequence = [], 0
    for times, make_up in fillings(counts, length):
        offset = 0
        for size, taken in make_up:
            rows.append((first_of[size] + given[size], taken, sequence, offset))
            given[size] += times * taken
            offset += size * taken
        sequence += times
    table = np.array(sorted(rows), dtype=np.int64).reshape(-1, 4)
    return Plan(first_of, table[:, 0], table[:, 1], table[:, 2], table[:, 3], sequence)


def assign(cut: DataFrame, *, length: int = LENGTH) -> DataFrame:
    """The pieces with ``sequence_id`` and ``offset``; needs their ``block, place, length``, carries all else along.

    The driver sees how many pieces there are of each length, at most ``length`` numbers. Pieces meet the counts of their
    own task and length, so no key holds more rows than one task made.
    """
    own = cut.groupBy("block", "length").agg(F.count(F.lit(1)).alias("pieces"))
    before = Window.partitionBy("length").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = stored(own.withColumn("before", F.coalesce(F.sum("pieces").over(before), F.lit(0))), "starts")
    counts = np.zeros(length + 1, dtype=np.int64)
    for size, number in starts.groupBy("length").agg(F.sum("pieces")).collect():
        counts[size] = number
    plan = planned(counts, length)

    @F.pandas_udf("sequence_id long, offset long")
    def places(size: pd.Series, rank: pd.Series) -> pd.DataFrame:
        number = plan.first_of[size.to_numpy()] + rank.to_numpy()
        row = np.searchsorted(plan.number, number, side="right") - 1
        within = number - plan.number[row]
        return pd.DataFrame({"sequence_id": plan.sequence[row] + within // plan.each[row],
                             "offset": plan.offset[row] + within % plan.each[row] * size.to_numpy()})

    rest = [c for c in cut.columns if c not in ("block", "place")]
    ranked = cut.join(starts.select("block", "length", "before"), ["block", "length"])
    return (ranked.withColumn("found", places("length", F.col("before") + F.col("place")))
            .select(*rest, "found.sequence_id", "found.offset"))


def pack(docs: DataFrame, vocabulary: str, *, length: int = LENGTH, end_token: int = END_TOKEN) -> DataFrame:
    """``doc_id, piece, start, length, ids, sequence_id, offset`` for all pieces of all documents."""
    return assign(pieces(docs, vocabulary, length=length, end_token=end_token), length=length)


def sequences(packed: DataFrame) -> DataFrame:
    """One row per sequence: its token ids in order (little-endian, 32 bits) and where its pieces come from."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "length", "doc_id", "piece", "ids")))
    ids = F.aggregate("parts", F.lit(b""), lambda done, part: F.concat(done, part["ids"]))
    spans = F.transform("parts", lambda part: part.dropFields("ids"))
    return packed.groupBy("sequence_id").agg(parts.alias("parts")).select("sequence_id", ids.alias("ids"), spans.alias("spans"))
