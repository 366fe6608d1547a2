"""Benchmark decontamination: a generalised suffix automaton of the test items, streamed over by training tokens.

Words are runs of digits, lower-cased ASCII letters and characters beyond ASCII. The automaton takes one word per
step and keeps the length of the longest match that ends there. A window is ``window`` consecutive words of an item,
or all words of a shorter item. Words inside any occurrence of a window are hit.

Null and empty texts have no words; a very long text is streamed like any other, its words in memory at once; items
without words, without text or without an id are ignored; repeated items count each by its own id; an empty benchmark
hits nothing. Ties do not arise: every rule is a set of positions. The benchmark goes to every worker, which builds its
automata once; one of more than ``BENCHMARK_BYTES`` is refused before anything is sent.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.text import slices, spans, texts, unpacked, whole_rows

WINDOW = 13
# Item text that one automaton may hold; a larger benchmark is split into several, and every text passes all of them.
BLOCK_BYTES = 8 << 20
# All of it is held by the driver and, several times over, by each worker.
BENCHMARK_BYTES = 64 << 20

FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def words(text: bytes) -> list[bytes]:
    return text.translate(FOLD).split()


class SuffixAutomaton:
    """All word sequences of the items, with the items that hold a window at the states where a window is read."""

    def __init__(self, items: list[tuple[str, bytes]], window: int = WINDOW) -> None:
        self.window = window
        self.vocabulary: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        read = [(item, [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words(text)])
                for item, text in items]
        read = [(item, ids) for item, ids in read if ids]
        self.shortest = min((min(len(ids), window) for _, ids in read), default=0)
        for _, ids in read:
            last = 0
            for word in ids:
                last = self._extend(last, word)
        # Items by the state in which one of their windows ends; a state stands for several lengths,
        # of which only one can be a window of a given size.
        self.items: dict[tuple[int, int], set[str]] = {}
        for item, ids in read:
            size = min(window, len(ids))
            for end, state, length in self._stream(ids):
                if length >= size:
                    at = self._ending(state, size)
                    self.items.setdefault((at, size), set()).add(item)
        self.short = sorted({size for _, size in self.items if size < window})
        self._found: dict[tuple[int, int], tuple[int, frozenset[str]]] = {}

    def _new(self, length: int) -> int:
        self.next.append({})
        self.link.append(0)
        self.length.append(length)
        return len(self.length) - 1

    def _split(self, state: int, word: int, target: int) -> int:
        """A copy of ``target`` for the shorter strings that reach it over ``state``."""
        copy = self._new(self.length[state] + 1)
        self.next[copy] = dict(self.next[target])
        self.link[copy] = self.link[target]
        self.link[target] = copy
        while state != -1 and self.next[state].get(word) == target:
            self.next[state][word] = copy
            state = self.link[state]
        return copy

    def _extend(self, last: int, word: int) -> int:
        known = self.next[last].get(word)
        if known is not None:
            exact = self.length[known] == self.length[last] + 1
            return known if exact else self._split(last, word, known)
        new, state = self._new(self.length[last] + 1), last
        while state != -1 and word not in self.next[state]:
            self.next[state][word] = new
            state = self.link[state]
        if state != -1:
            known = self.next[state][word]
            exact = self.length[known] == self.length[state] + 1
            self.link[new] = known if exact else self._split(state, word, known)
        return new

    def _ending(self, state: int, size: int) -> int:
        """The state of the last ``size`` words read."""
        while self.length[self.link[state]] >= size:
            state = self.link[state]
        return state

    def _stream(self, ids: list[int]) -> Iterator[tuple[int, int, int]]:
        """(end, state, longest matching length) after each word."""
        state = length = 0
        for end, word in enumerate(ids, 1):
            while state and word not in self.next[state]:
                state = self.link[state]
                length = self.length[state]
            if word in self.next[state]:
                state, length = self.next[state][word], length + 1
            yield end, state, length

    def _at(self, state: int, length: int) -> tuple[int, frozenset[str]]:
        """The longest window that ends here and the items of all windows that end here."""
        key = (state, min(length, self.window))
        if key not in self._found:
            longest, items = 0, set()
            for size in (*self.short, self.window):
                if size <= length and (got := self.items.get((self._ending(state, size), size))):
                    longest, items = size, items | got
            self._found[key] = (longest, frozenset(items))
        return self._found[key]

    def match(self, found: list[bytes]) -> tuple[np.ndarray, set[str]]:
        """Which of the words are hit, and the items whose windows occur."""
        hit, items = np.zeros(len(found), dtype=bool), set()
        if not self.shortest or len(found) < self.shortest:
            return hit, items
        get = self.vocabulary.get
        ids = np.fromiter((get(w, -1) for w in found), dtype=np.int64, count=len(found))
        for begin, end in zip(*spans(ids >= 0)):
            if end - begin >= self.shortest:
                for at, state, length in self._stream(ids[begin:end].tolist()):
                    if length >= self.shortest:
                        longest, got = self._at(state, length)
                        hit[begin + at - longest:begin + at] = True
                        items |= got
        return hit, items


def item_blocks(benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> list[list[tuple[str, bytes]]]:
    """The stated query set, in blocks of bounded size."""
    blocks: list[list[tuple[str, bytes]]] = [[]]
    size = 0
    rows = benchmark.select(F.col("item_id").cast("string"), "text").dropna().distinct()
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    if total > BENCHMARK_BYTES:
        raise ValueError(f"benchmark of {total} bytes, more than {BENCHMARK_BYTES}")
    rows = rows.orderBy("item_id", "text")
    for item, text in rows.toLocalIterator():
        data = text.encode()
        if blocks[-1] and size + len(data) > block_bytes:
            blocks.append([])
            size = 0
        blocks[-1].append((item, data))
        size += len(data)
    return blocks


_ready: dict[bytes, list[SuffixAutomaton]] = {}


def _built(blocks: list[list[tuple[str, bytes]]], window: int) -> list[SuffixAutomaton]:
    """The automata of these blocks; a worker that runs many tasks builds them in its first."""
    mark = hashlib.sha256(repr((window, blocks)).encode()).digest()
    if mark not in _ready:
        _ready.clear()
        _ready[mark] = [SuffixAutomaton(block, window) for block in blocks]
    return _ready[mark]


def contamination(docs: DataFrame, benchmark: DataFrame, *, window: int = WINDOW, percent: int = 5,
                  keep_text: bool = False) -> DataFrame:
    """One row per document: words, hit words, items, and whether at least ``percent`` of the words are hit.

    ``keep_text`` adds ``clean_text``: the text without the hit words and what separates them from the next one.
    A document that is contaminated may instead be dropped as a whole; that is the caller's choice.
    """
    blocks = item_blocks(benchmark)
    schema = ("doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, "
              "items array<string>" + (", clean_text string" if keep_text else ""))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automata = _built(blocks, window)
        for rows, parts in slices(batches):
            out = []
            for text in parts:
                found = words(text)
                hit, items = np.zeros(len(found), dtype=bool), set()
                for automaton in automata:
                    more, names = automaton.match(found)
                    hit |= more
                    items |= names
                n, names = int(hit.sum()), sorted(items)
                row = [len(found), n, len(names), hashlib.sha256(",".join(names).encode()).hexdigest(),
                       n > 0 and 100 * n >= percent * len(found), names]
                out.append(row + ([without(text, hit)] if keep_text else []))
            columns = list(zip(*out))
            types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.bool_(), pa.list_(pa.string()), pa.string()]
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id")] + [pa.array(c, t) for c, t in zip(columns, types)],
                names=[x.split()[0] for x in schema.split(", ")])

    return texts(docs).mapInArrow(run, schema)


def without(text: bytes, hit: np.ndarray) -> str:
    if not hit.any():
        return text.decode()
    begins, _ = spans(np.frombuffer(text.translate(FOLD), dtype=np.uint8) != 32)
    bounds = np.append(begins, len(text))
    keep = np.ones(len(text), dtype=bool)
    for first, last in zip(*spans(hit)):
        keep[bounds[first]:bounds[last]] = False
    return np.frombuffer(text, dtype=np.uint8)[keep].tobytes().decode()


def reject(docs: DataFrame, benchmark: DataFrame, *, window: int = WINDOW, percent: int = 5) -> DataFrame:
    """The documents, all columns, of which less than ``percent`` of the words are hit."""
    blocks, schema = item_blocks(benchmark), docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automata = _built(blocks, window)
        for rows, parts in slices(batches):
            keep = []
            for text in parts:
                found = words(text)
                hit = np.zeros(len(found), dtype=bool)
                for automaton in automata:
                    hit |= automaton.match(found)[0]
                keep.append(not hit.any() or 100 * int(hit.sum()) < percent * len(found))
            yield unpacked(rows.column("row").filter(pa.array(keep, pa.bool_())), schema)

    return whole_rows(docs).mapInArrow(run, schema)
