"""Toxicity: non-negative positive-unlabelled learning of a linear classifier.

Confirmed toxic documents are the positives, all documents the unlabelled mixture. A bounded sample of each is enough:
``POSITIVES`` and ``UNLABELLED`` rows, those with the smallest hash of their id. Features are whether a word, or the
first four, five or six bytes of a longer word, occur in a text, and whether they occur again. The features that set the positives most clearly
apart are kept, and their weights minimise the positive-unlabelled risk, whose negative part is held above zero so that
the classifier cannot gain by fitting the positives that hide in the mixture. The class prior is the share of toxic
rows among the labelled ones, with half a row added to either side, so that it is neither 0 nor 1.

Null and empty texts and texts without words get the score of the intercept alone. Without any confirmed row all
scores are 0. Labels that are null count as no label; repeated label rows are toxic if one of them is.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.text import BYTE_CODES, FOLD, PrefixHash, held_out, joined, mixed, slices, spans, texts, unpacked, whole_rows

POSITIVES, UNLABELLED, FEATURES, CANDIDATES = 4096, 12288, 1024, 16384
BITS = 22
STEMS = (4, 5, 6)
THRESHOLD = 0.7
# Standard errors above zero from which a feature counts as telling.
CLEAR = 3.5


def features(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(text number, feature) of every word and of its first bytes."""
    data, begins = joined([x.translate(FOLD) for x in parts])
    first, last = spans(data != 32)
    hashes = PrefixHash(BYTE_CODES[data])
    owner = np.searchsorted(begins, first, side="right") - 1
    found, owners = [hashes.of(first, last)], [owner]
    for size in STEMS:
        longer = last - first > size
        # The size goes into the hash, so that a stem is not the word of the same letters.
        found.append(mixed(hashes.of(first[longer], first[longer] + size) + np.uint64(size)))
        owners.append(owner[longer])
    return np.concatenate(owners), (np.concatenate(found) >> np.uint64(65 - BITS)).astype(np.int64)


def distinct(owner: np.ndarray, feature: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each feature once per text, and once more under another number where the text has it again."""
    pairs, counts = np.unique((owner << BITS) | feature, return_counts=True)
    pairs = np.concatenate((pairs, pairs[counts > 1] | (1 << (BITS - 1))))
    return pairs >> BITS, pairs & ((1 << BITS) - 1)


@dataclass
class Model:
    features: np.ndarray
    weights: np.ndarray
    intercept: float

    def scorer(self):
        place = np.zeros(1 << BITS, dtype=np.int32)
        place[self.features] = np.arange(1, len(self.features) + 1)
        wanted = (place[:1 << (BITS - 1)] > 0) | (place[1 << (BITS - 1):] > 0)

        def score(parts: list[bytes]) -> np.ndarray:
            owner, feature = features(parts)
            known = wanted[feature]
            owner, feature = distinct(owner[known], feature[known])
            known = place[feature] > 0
            owner, feature = owner[known], feature[known]
            total = np.bincount(owner, weights=self.weights[place[feature] - 1], minlength=len(parts))
            return 1 / (1 + np.exp(-np.clip(total + self.intercept, -30, 30)))

        return score


def _feature_rows(docs: DataFrame, wanted: np.ndarray | None = None) -> list[np.ndarray]:
    """Features of each document of a bounded sample, only those wanted."""
    chosen = None if wanted is None else np.isin(np.arange(1 << BITS), wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, parts in slices(batches):
            owner, feature = features(parts)
            owner, feature = distinct(owner, feature)
            if chosen is not None:
                keep = chosen[feature]
                owner, feature = owner[keep], feature[keep]
            cuts = np.searchsorted(owner, np.arange(1, len(parts)))
            yield pa.RecordBatch.from_arrays(
                [pa.array([x.astype("<i4").tobytes() for x in np.split(feature, cuts)], pa.binary())], names=["found"])

    return [np.frombuffer(row.found, dtype="<i4") for row in docs.mapInArrow(run, "found binary").toLocalIterator()]


def _matrix(rows: list[np.ndarray], names: np.ndarray) -> np.ndarray:
    out = np.zeros((len(rows), len(names)), dtype=np.float32)
    for i, row in enumerate(rows):
        out[i, np.searchsorted(names, row[np.isin(row, names)])] = 1
    return out


def _sample(docs: DataFrame, n: int) -> DataFrame:
    """The rows with the smallest hash of their id: found on the ids alone, then fetched."""
    order = F.xxhash64("doc_id")
    edge = docs.select(order.alias("h"), "doc_id").orderBy("h", "doc_id").limit(n).agg(F.max("h")).first()[0]
    return docs.filter(order <= F.lit(edge)) if edge is not None else docs.limit(0)


def fit(docs: DataFrame, labels: DataFrame, *, positives: int = POSITIVES, unlabelled: int = UNLABELLED,
        steps: int = 800) -> Model:
    """Learn from rows outside the held-out fold."""
    marks = labels.groupBy("doc_id").agg(F.max("toxic").alias("toxic")).dropna()
    learn = texts(docs).filter(~held_out())
    marks = marks.filter(~held_out())
    known, toxic = marks.agg(F.count("*"), F.count_if(F.col("toxic") == 1)).first()
    if not toxic:
        return Model(np.zeros(0, dtype=np.int64), np.zeros(0), -30.0)
    prior = (toxic + 0.5) / (known + 1)
    confirmed = F.broadcast(_sample(marks.filter("toxic = 1"), positives).select("doc_id").distinct())
    toxic_rows = _feature_rows(learn.join(confirmed, "doc_id", "left_semi"))
    if not toxic_rows:
        return Model(np.zeros(0, dtype=np.int64), np.zeros(0), -30.0)
    names, seen = np.unique(np.concatenate(toxic_rows), return_counts=True)
    often = seen >= min(len(toxic_rows), max(3, len(toxic_rows) // 200))
    names = names[often][np.argsort(-seen[often], kind="stable")[:CANDIDATES]]
    names.sort()
    mixed_rows = _feature_rows(_sample(learn, unlabelled), names)
    chosen = select(toxic_rows, mixed_rows, names)
    return nn_pu(_matrix(toxic_rows, chosen), _matrix(mixed_rows, chosen), chosen, prior, steps)


def select(toxic_rows: list[np.ndarray], mixed_rows: list[np.ndarray], names: np.ndarray) -> np.ndarray:
    """The features whose log odds between positives and mixture lie furthest above zero, in standard errors."""
    def counts(rows: list[np.ndarray]) -> np.ndarray:
        return np.bincount(np.concatenate([*rows, np.zeros(0, dtype=np.int64)]).astype(np.int64),
                           minlength=1 << BITS)[names]

    p, u = counts(toxic_rows) + 0.5, counts(mixed_rows) + 0.5
    n, m = len(toxic_rows) + 1.0, len(mixed_rows) + 1.0
    odds = np.log(p / n) - np.log(u / m)
    clear = odds / np.sqrt(1 / p + 1 / u)
    best = np.lexsort((names, -clear))[:FEATURES]
    return np.sort(names[best[clear[best] > CLEAR]])


def nn_pu(positive: np.ndarray, mixture: np.ndarray, names: np.ndarray, prior: float, steps: int,
          rate: float = 0.05, decay: float = 1e-6) -> Model:
    """Weights by Adam on prior * R_p(+) + max(0, R_u(-) - prior * R_p(-)) with the logistic loss."""
    width = positive.shape[1] + 1
    theta = np.zeros(width)
    theta[-1] = np.log(prior / (1 - prior))
    mean, square = np.zeros(width), np.zeros(width)

    def gradient(rows: np.ndarray, slope: np.ndarray) -> np.ndarray:
        return np.append(slope.astype(np.float32) @ rows, slope.sum()) / max(1, len(rows))

    for step in range(1, steps + 1):
        margin_p = positive @ theta[:-1].astype(np.float32) + theta[-1]
        margin_u = mixture @ theta[:-1].astype(np.float32) + theta[-1]
        p, u = 1 / (1 + np.exp(-margin_p)), 1 / (1 + np.exp(-margin_u))
        negative = np.logaddexp(0, margin_u).mean() - prior * np.logaddexp(0, margin_p).mean() if len(mixture) else 0
        pull = gradient(mixture, u) - prior * gradient(positive, p)
        # Where the negative risk falls below zero, step back up along it instead of following the whole risk.
        slope = prior * gradient(positive, p - 1) + pull if negative >= 0 else -pull
        slope[:-1] += decay * theta[:-1]
        mean, square = 0.9 * mean + 0.1 * slope, 0.999 * square + 0.001 * slope ** 2
        theta -= rate * (mean / (1 - 0.9 ** step)) / (np.sqrt(square / (1 - 0.999 ** step)) + 1e-8)
    return Model(names.astype(np.int64), theta[:-1], float(theta[-1]))


def score(docs: DataFrame, model: Model, *, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = model.scorer()
        for rows, parts in slices(batches):
            values = judge(parts)
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id"), rows.column("held_out"), pa.array(values),
                 pa.array((values >= threshold).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"])

    return texts(docs, held_out().alias("held_out")).mapInArrow(
        run, "doc_id long, held_out boolean, score double, predicted int")


def reject(docs: DataFrame, model: Model, *, threshold: float = THRESHOLD) -> DataFrame:
    """The documents, all columns, whose score stays below the threshold."""
    schema = docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = model.scorer()
        for rows, parts in slices(batches):
            yield unpacked(rows.column("row").filter(pa.array(judge(parts) < threshold)), schema)

    return whole_rows(docs).mapInArrow(run, schema)
