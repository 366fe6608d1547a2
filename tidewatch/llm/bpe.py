"""Byte-pair encoding and decoding with a public vocabulary file whose words end in a suffix.

Every short word holds its parts and the ranks of adjacent parts in contiguous arrays: look for the smallest rank,
delete that boundary, refresh the two ranks beside it, until no rank is left. Words of one length go through these
steps together, each losing one boundary a step, so the arrays stay dense. Longer words keep their boundaries in a
linked list and their ranks in a heap, which gives the same merges (smallest rank first, leftmost of equals).

Texts are taken apart first where no step of the tokenizer crosses, and each distinct piece is
encoded once per worker as long as the bounded cache holds it. Null texts are empty; empty texts have no tokens and
decode to the empty string. Special tokens within a text become their own ids, as in the library.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import json
import unicodedata
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from tidewatch.llm.text import BYTE_CODES, by_two_hashes, joined, slices, texts

CACHE_PIECES = 600_000
SHORT = 48
# White space 0, ASCII letters 1, ASCII signs 2, all else 4.
KINDS = np.array([0 if c in b" \t\n\v\f\r" else 1 if chr(c).isascii() and chr(c).isalpha()
                  else 2 if 33 <= c <= 126 and not chr(c).isdigit() and c != ord("'") else 4 for c in range(256)], dtype=np.uint8)
NONE = np.iinfo(np.int32).max


def gathered(values: np.ndarray, begins: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The stretches of ``values``, one after another, and where each ends in the result."""
    ends = np.cumsum(sizes)
    at = np.repeat(begins - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)
    return values[at], ends


def pieces_of(data: np.ndarray, whole: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Begins and ends of the pieces: cut at white space, and between an ASCII letter and an ASCII sign.

    The tokenizer cuts there too, and no character composes over such a place. The apostrophe is no sign here, as it
    may begin a contraction, and texts that may hold special tokens (stretches ``whole``) are cut at white space only.
    """
    kind = KINDS[data]
    for begin, end in whole:
        kind[begin:end][kind[begin:end] > 0] = 4
    inside = kind > 0
    cut = np.zeros(len(data) + 1, dtype=bool)
    cut[1:-1] = kind[1:] + kind[:-1] == 3
    before, after = np.append(False, inside), np.append(inside, False)
    return np.flatnonzero(after & (~before | cut)), np.flatnonzero(before & (~after | cut))


class PieceTable:
    """Rows of the pieces known so far, by the 128-bit hashes of their bytes: open addressing, many pieces at a time."""

    def __init__(self, bits: int = 16) -> None:
        self.mask = np.int64((1 << bits) - 1)
        self.one, self.two = np.zeros(1 << bits, dtype=np.uint64), np.zeros(1 << bits, dtype=np.uint64)
        self.row = np.full(1 << bits, -1, dtype=np.int32)
        self.size = 0

    def find(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """Row of each piece, -1 where it is not known."""
        out = np.full(len(one), -1, dtype=np.int32)
        place, open_ = one.astype(np.int64) & self.mask, np.arange(len(one))
        while len(open_):
            row = self.row[place]
            same = (self.one[place] == one[open_]) & (self.two[place] == two[open_]) & (row >= 0)
            out[open_[same]] = row[same]
            on = ~same & (row >= 0)
            place, open_ = (place[on] + 1) & self.mask, open_[on]
        return out

    def add(self, one: np.ndarray, two: np.ndarray) -> None:
        """New pieces, all different, get the next rows."""
        rows = np.arange(self.size, self.size + len(one), dtype=np.int32)
        if 2 * (self.size + len(one)) > len(self.row):
            used = self.row >= 0
            before = self.one[used], self.two[used], self.row[used]
            self.__init__(int(2 * (self.size + len(one))).bit_length())
            self._put(*before)
        self._put(one, two, rows)

    def _put(self, one: np.ndarray, two: np.ndarray, rows: np.ndarray) -> None:
        self.size += len(rows)
        place = one.astype(np.int64) & self.mask
        while len(rows):
            free = np.flatnonzero(self.row[place] < 0)
            _, first = np.unique(place[free], return_index=True)
            chosen = free[first]
            at = place[chosen]
            self.one[at], self.two[at], self.row[at] = one[chosen], two[chosen], rows[chosen]
            left = np.ones(len(rows), dtype=bool)
            left[chosen] = False
            one, two, rows, place = one[left], two[left], rows[left], (place[left] + 1) & self.mask


class CachedPieces:
    """Ids of texts from ids of their pieces; a subclass encodes the pieces not yet known."""

    def __init__(self) -> None:
        self._forget()

    def _forget(self) -> None:
        self.known = PieceTable()
        self.begins, self.sizes = np.zeros(1 << 16, dtype=np.int64), np.zeros(1 << 16, dtype=np.int64)
        self.ids, self.used = np.zeros(1 << 18, dtype=np.int32), 0

    def encode_pieces(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the pieces, one after another, and how many each has."""
        raise NotImplementedError

    def _learn(self, pieces: list[bytes]) -> None:
        found, sizes = self.encode_pieces(pieces)
        first, total = self.known.size, int(sizes.sum())
        while first + len(pieces) > len(self.begins):
            self.begins, self.sizes = np.resize(self.begins, 2 * len(self.begins)), np.resize(self.sizes, 2 * len(self.sizes))
        while self.used + total > len(self.ids):
            self.ids = np.resize(self.ids, 2 * len(self.ids))
        self.sizes[first:first + len(pieces)] = sizes
        self.begins[first:first + len(pieces)] = self.used + np.cumsum(sizes) - sizes
        self.ids[self.used:self.used + total] = found
        self.used += total

    def encode(self, parts: list[bytes]) -> list[np.ndarray]:
        """Token ids of each text."""
        if self.known.size > CACHE_PIECES:
            self._forget()
        data, begins = joined([x.lower() if x.isascii() and b"<|" not in x else x for x in parts])
        first, last = pieces_of(data, [begins[i:i + 2] for i, x in enumerate(parts) if b"<|" in x])
        one, two = by_two_hashes(BYTE_CODES[data], first, last)
        rows = self.known.find(one, two)
        while len(new := np.flatnonzero(rows < 0)):
            _, at = np.unique(one[new], return_index=True)
            at = new[at]
            whole = data.tobytes()
            self._learn([whole[i:j] for i, j in zip(first[at].tolist(), last[at].tolist())])
            self.known.add(one[at], two[at])
            rows[new] = self.known.find(one[new], two[new])
        found, ends = gathered(self.ids, self.begins[rows], self.sizes[rows])
        ends = np.concatenate(([0], ends))
        return np.split(found, ends[np.searchsorted(first, begins[1:-1])])


class WordBpe(CachedPieces):
    """The tokenizer of a vocabulary file of the kind "BPE with word ends, lower case, white space dropped"."""

    def __init__(self, path: str) -> None:
        super().__init__()
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        self.suffix = model["end_of_word_suffix"]
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        vocab = model["vocab"] | special
        self.tokens = [""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            self.tokens[i] = token
        self.special = special
        self.special_pattern = regex.compile("|".join(map(regex.escape, sorted(special, key=len, reverse=True))))
        split = next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.words = regex.compile(split.replace(r"\s", r"\p{White_Space}") + r"|\n")
        # The printable characters that stand for bytes: themselves where printable, else those from 256 on.
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = iter(range(256, 512))
        letters = [chr(b) if b in plain else chr(next(rest)) for b in range(256)]
        self.inner = np.array([vocab.get(c, -1) for c in letters], dtype=np.int32)
        self.final = np.array([vocab.get(c + self.suffix, -1) for c in letters], dtype=np.int32)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        keys = np.array([(vocab[a] << 32) | vocab[b] for a, b in pairs], dtype=np.int64)
        self.merged = np.array([vocab[a + b] for a, b in pairs] or [0], dtype=np.int32)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order], order.astype(np.int32)
        self.rank_of = dict(zip(keys.tolist(), range(len(keys))))

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = (left.astype(np.int64) << 32) | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], NONE)

    def _short(self, words: list[bytes], size: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """Encode words of ``size`` bytes together: (which words, their ids as rows), by number of ids."""
        data = np.frombuffer(b"".join(words), dtype=np.uint8).reshape(len(words), size)
        parts = self.inner[data]
        parts[:, -1] = self.final[data[:, -1]]
        ranks = self.rank(parts[:, :-1], parts[:, 1:])
        which, done = np.arange(len(words)), []
        while len(which):
            width = parts.shape[1]
            if width == 1:
                return [*done, (which, parts)]
            at = ranks.argmin(axis=1)
            least = ranks[np.arange(len(which)), at]
            go = least != NONE
            done.append((which[~go], parts[~go]))
            which, at, least = which[go], at[go], least[go]
            rows, columns = np.arange(len(which)), np.arange(width - 1)[None, :]
            parts = np.take_along_axis(parts[go], columns + (columns > at[:, None]), axis=1)
            parts[rows, at] = self.merged[least]
            columns = columns[:, :-1]
            ranks = np.take_along_axis(ranks[go], columns + (columns >= at[:, None]), axis=1)
            for left in (at - 1, at):
                near = (left >= 0) & (left < width - 2)
                row, left = rows[near], left[near]
                ranks[row, left] = self.rank(parts[row, left], parts[row, left + 1])
        return done

    def _long(self, word: bytes) -> np.ndarray:
        data = np.frombuffer(word, dtype=np.uint8)
        parts = self.inner[data].tolist()
        parts[-1] = int(self.final[data[-1]])
        n, get = len(parts), self.rank_of.get
        following, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i) for i in range(n - 1) if (r := get((parts[i] << 32) | parts[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            rank, i = heapq.heappop(heap)
            j = following[i]
            if parts[i] < 0 or j >= n or get((parts[i] << 32) | parts[j]) != rank:
                continue
            parts[i], parts[j] = int(self.merged[rank]), -1
            following[i] = k = following[j]
            if k < n:
                before[k] = i
                if (r := get((parts[i] << 32) | parts[k])) is not None:
                    heapq.heappush(heap, (r, i))
            if (h := before[i]) >= 0 and (r := get((parts[h] << 32) | parts[i])) is not None:
                heapq.heappush(heap, (r, h))
        return np.array([p for p in parts if p >= 0], dtype=np.int32)

    def _words(self, text: str) -> list[str]:
        """Words of a text and the line ends between its pieces."""
        text = unicodedata.normalize("NFC", text)
        # Each character by itself: no rule for the end of a word.
        return self.words.findall(text.lower() if "Σ" not in text else "".join(c.lower() for c in text))

    def _special_words(self, piece: str) -> list[str | int]:
        """Words of a piece, with the ids of the special tokens in it."""
        out, at = [], 0
        for found in self.special_pattern.finditer(piece):
            out += [*self._words(piece[at:found.start()]), self.special[found.group()]]
            at = found.end()
        return out + self._words(piece[at:])

    def encode_pieces(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        plain = [p for p in pieces if b"<|" not in p]
        found = self._words("\n".join(map(bytes.decode, plain))) if plain else []
        marked = {p: self._special_words(p.decode()) for p in pieces if b"<|" in p}
        ids, begins, sizes, place = self._encode_words(list({*found, *chain.from_iterable(marked.values())} - {"\n"}))
        rows = np.fromiter((-1 if w == "\n" else place[w] for w in found), dtype=np.int64, count=len(found))
        breaks = np.flatnonzero(rows < 0)
        counts = np.diff(np.concatenate(([-1], breaks, [len(rows)]))) - 1 if plain else np.zeros(0, dtype=np.int64)
        rows = rows[rows >= 0]
        if marked:
            # Back to the order of the pieces.
            split = iter(np.split(rows, np.cumsum(counts)[:-1]) if plain else [])
            each = [np.array([place[w] for w in marked[p]], dtype=np.int64) if p in marked else next(split)
                    for p in pieces]
            rows, counts = np.concatenate(each), np.array([len(x) for x in each])
        encoded, ends = gathered(ids, begins[rows], sizes[rows])
        ends = np.concatenate(([0], ends))[np.cumsum(counts)]
        return encoded, np.diff(ends, prepend=0)

    def _encode_words(self, words: list[str | int]) -> tuple[np.ndarray, np.ndarray, np.ndarray, dict[str | int, int]]:
        """All ids, where each word's begin, how many it has, and the row of each word."""
        data = [w.encode() if isinstance(w, str) else b"" for w in words]
        lengths = np.array([len(x) for x in data], dtype=np.int64)
        blocks = [(np.flatnonzero(lengths == 0), np.array([[w] for w in words if isinstance(w, int)], dtype=np.int32))]
        for size in np.unique(lengths[(lengths > 0) & (lengths <= SHORT)]):
            which = np.flatnonzero(lengths == size)
            blocks += [(which[rows], parts) for rows, parts in self._short([data[i] for i in which], size)]
        blocks += [(np.array([i]), self._long(data[i])[None, :]) for i in np.flatnonzero(lengths > SHORT)]
        sizes = np.zeros(len(words), dtype=np.int64)
        for which, parts in blocks:
            sizes[which] = parts.shape[1] if parts.ndim == 2 else 0
        begins = np.cumsum(sizes) - sizes
        ids = np.zeros(int(sizes.sum()), dtype=np.int32)
        for which, parts in blocks:
            if len(which):
                ids[begins[which][:, None] + np.arange(parts.shape[1])] = parts
        return ids, begins, sizes, dict(zip(words, range(len(words))))

    def decode(self, ids: np.ndarray) -> str:
        return " ".join(map(self.tokens.__getitem__, ids.tolist()))


@functools.lru_cache(maxsize=2)
def word_bpe(path: str) -> WordBpe:
    """One encoder per worker process and file, with its cache."""
    return WordBpe(path)


def encode_decode(docs: DataFrame, path: str, *, keep: bool = False) -> DataFrame:
    """doc_id, n_tokens and digests of the ids and of the text decoded from them; ``keep`` adds ids and that text."""
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = word_bpe(path)
        for rows, parts in slices(batches):
            found = bpe.encode(parts)
            decoded = [bpe.decode(x) for x in found]
            columns = [rows.column("doc_id"), pa.array([len(x) for x in found], pa.int64()),
                       pa.array([hashlib.sha256(x.astype("<u4").tobytes()).hexdigest() for x in found], pa.string()),
                       pa.array([hashlib.sha256(x.encode()).hexdigest() for x in decoded], pa.string())]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if keep:
                columns += [pa.array(found, pa.list_(pa.int32())), pa.array(decoded, pa.string())]
                names += ["ids", "decoded"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return texts(docs).mapInArrow(run, schema + (", ids array<int>, decoded string" if keep else ""))
