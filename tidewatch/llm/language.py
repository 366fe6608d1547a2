"""Language identification: each text is a mixture of languages, and expectation-maximisation finds its proportions.

A language is a table of counts of three bytes in a row within a word (its beginning and end marked by a space), over
all learning documents. The likelihood of a word under a language is the product of its grams' smoothed shares. For a
text, expectation-maximisation over its words gives the proportions of all languages; then languages are taken in the
order of their proportions as long as the likelihood, less half the logarithm of the number of words for each further
language, rises. The prediction is the largest proportion within that set, the score its value.

A null, empty or letterless text is ``und`` with score 0; a text with letters but no learned language is ``und`` too.
Ties go to the language that sorts first.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.text import FOLD, held_out, joined, slices, spans, texts

BITS = 16
GRAM = 3
UNKNOWN = "und"
# Values of the gram tables that the driver and each task may hold.
MODEL_CELLS = 1 << 25


def grams(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Gram of each byte before and in a word, begins and ends of the words among them, and the text of each word."""
    data, begins = joined([b" " + x.translate(FOLD) for x in parts])
    first, last = spans(data != 32)
    wide = np.concatenate((data, np.full(2, 32, dtype=np.uint8))).astype(np.uint32)
    packed = wide[:-2] | (wide[1:-1] << np.uint32(8)) | (wide[2:] << np.uint32(16))
    codes = (packed * np.uint32(0x9E3779B1)) >> np.uint32(32 - BITS)
    return codes, first - 1, last, np.searchsorted(begins, first, side="right") - 1


@dataclass
class Model:
    languages: list[str]
    shares: np.ndarray


def fit(docs: DataFrame) -> Model:
    """Gram counts of every learning document, added up by language."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for rows, parts in slices(batches):
            names = np.array(rows.column("lang").to_pylist(), dtype=object)
            for name in set(names):
                codes, first, last, _ = grams([x for x, y in zip(parts, names) if y == name])
                steps = np.zeros(len(codes) + 1, dtype=np.int8)
                np.add.at(steps, first, 1)
                np.add.at(steps, last, -1)
                counts = np.bincount(codes[np.cumsum(steps[:-1], dtype=np.int8) > 0], minlength=1 << BITS)
                totals[name] = totals.get(name, 0) + counts
        for name, counts in totals.items():
            seen = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(seen), pa.string()), pa.array(seen.astype(np.int32)), pa.array(counts[seen])],
                names=["lang", "gram", "n"])

    learn = texts(docs, "lang").filter(~held_out() & F.col("lang").isNotNull())
    counts = learn.mapInArrow(run, "lang string, gram int, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    languages = [row.lang for row in learn.select("lang").distinct().orderBy("lang").toLocalIterator()]
    if len(languages) << BITS > MODEL_CELLS:
        raise ValueError(f"{len(languages)} languages need more than {MODEL_CELLS} table cells")
    table = np.zeros((len(languages), 1 << BITS), dtype=np.float64)
    place = {name: i for i, name in enumerate(languages)}
    packed = counts.groupBy("lang").agg(F.array_agg("gram").alias("gram"), F.array_agg("n").alias("n"))
    for row in packed.toLocalIterator():
        table[place[row.lang], row.gram] = row.n
    shares = np.log((table + 0.5) / (table.sum(axis=1, keepdims=True) + 0.5 * (1 << BITS))) if languages else table
    return Model(languages, np.ascontiguousarray(shares.T, dtype=np.float32))


def _sums(values: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    return np.add.reduceat(values, cuts, axis=0)


def proportions(likelihood: np.ndarray, owner: np.ndarray, cuts: np.ndarray, start: np.ndarray,
                rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """Expectation-maximisation from ``start``: proportions and log-likelihood, a row per text.

    ``likelihood`` holds each word's likelihoods relative to its best language; languages at 0 stay out.
    """
    share = start
    size = np.diff(np.append(cuts, len(owner)))[:, None]
    for _ in range(rounds):
        joint = likelihood * share[owner]
        joint /= joint.sum(axis=1, keepdims=True) + 1e-30
        share = _sums(joint, cuts) / size
    return share, _sums(np.log((likelihood * share[owner]).sum(axis=1) + 1e-30), cuts)


def mixtures(parts: list[bytes], model: Model, rounds: int = 8) -> tuple[np.ndarray, np.ndarray]:
    """Proportions of the chosen set of languages per text, and which texts have words at all."""
    n, width = len(parts), len(model.languages)
    result, known = np.zeros((n, width)), np.zeros(n, dtype=bool)
    codes, first, last, owner = grams(parts)
    if not len(first) or not width:
        return result, known
    sums = np.zeros((len(codes) + 1, width), dtype=np.float64)
    np.cumsum(model.shares[codes], axis=0, out=sums[1:], dtype=np.float64)
    words = sums[last] - sums[first]
    words -= words.max(axis=1, keepdims=True)
    likelihood = np.exp(words).astype(np.float32)
    present, cuts = np.unique(owner, return_index=True)
    known[present] = True
    place = np.zeros(n, dtype=np.int64)
    place[present] = np.arange(len(present))
    owner = place[owner]
    share, _ = proportions(likelihood, owner, cuts, np.full((len(present), width), 1 / width, dtype=np.float32), rounds)
    order = np.argsort(-share, axis=1, kind="stable")
    penalty = 0.5 * np.log(np.diff(np.append(cuts, len(owner))))
    best = np.zeros_like(share)
    gain = np.full(len(present), -np.inf)
    open_ = np.arange(len(present))
    for size in range(1, width + 1):
        member = np.zeros((len(open_), width), dtype=np.float32)
        np.put_along_axis(member, order[open_, :size], 1, axis=1)
        start = share[open_] * member + member * 1e-3
        start /= start.sum(axis=1, keepdims=True)
        inside = np.isin(owner, open_)
        where = np.searchsorted(open_, owner[inside])
        begin = np.searchsorted(where, np.arange(len(open_)))
        got, total = proportions(likelihood[inside], where, begin, start, rounds if size > 1 else 1)
        value = total - penalty[open_] * (size - 1)
        better = value > gain[open_]
        best[open_[better]], gain[open_[better]] = got[better], value[better]
        open_ = open_[better]
        if not len(open_):
            break
    result[present] = best
    return result, known


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, lang_pred, score, and the languages found with their proportions."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = np.array([*model.languages, UNKNOWN], dtype=object)
        for rows, parts in slices(batches):
            share, known = mixtures(parts, model)
            top = share.argmax(axis=1) if share.shape[1] else np.zeros(len(parts), dtype=np.int64)
            letters = np.array([any(c.isalpha() for c in x.decode()) for x in parts])
            known &= letters
            score = np.where(known, np.minimum(share.max(axis=1, initial=0), 1), 0.0)
            found = [[names[i] for i in np.flatnonzero(s)] if k else [] for s, k in zip(share, known)]
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id"), rows.column("held_out"),
                 pa.array(names[np.where(known, top, len(model.languages))], pa.string()), pa.array(score),
                 pa.array(found, pa.list_(pa.string())),
                 pa.array([s[s > 0].tolist() if k else [] for s, k in zip(share, known)], pa.list_(pa.float64()))],
                names=["doc_id", "held_out", "lang_pred", "score", "languages", "proportions"])

    return texts(docs, held_out().alias("held_out")).mapInArrow(
        run, "doc_id long, held_out boolean, lang_pred string, score double, languages array<string>, "
             "proportions array<double>")
