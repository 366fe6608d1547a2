"""Near-duplicate vectors by product quantisation.

A bounded sample trains coarse centroids and, for the residuals from them, a codebook per subspace. Every vector is put
into the inverted list of its nearest centroid with its codes. Every vector also probes the lists of its nearest
centroids: a table of inner products per subspace gives approximate cosines of all members by look-ups. A member stays
a candidate while its approximate cosine plus the length of its own quantisation error, which bounds the difference,
reaches the threshold; so within the probed lists no pair is lost. Candidates get their exact cosine in double precision.

A pair counts for both vectors whichever of them probes the other's list. Equal vectors are one member with a number of
copies. Lists and the vectors that probe them are cut into blocks, so no task holds more than two blocks, however
large a list is; tasks give one row per vector: its links, and the smallest id of its connected vectors there.

Vectors that are null, zero, or hold null or non-finite components link with nothing. Vectors of different lengths do not
link; those of each length are searched on their own, with an index of their own. Components may be as large or as small
as a double can be. Repeated ids are one vector per row. An empty table gives no rows. Rows without an id have no component.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.components import components
from tidewatch.llm.storage import stored

THRESHOLD = 0.9
SAMPLE, LISTS, SUBSPACES, CODES, PROBES = 16384, 4096, 8, 256, 12
BLOCK = 2048


@dataclass
class Index:
    centroids: np.ndarray
    codebooks: list[np.ndarray]

    def lists(self, vectors: np.ndarray, n: int) -> np.ndarray:
        """The nearest ``n`` centroids of each vector, nearest first."""
        near = 2 * vectors @ self.centroids.T - (self.centroids ** 2).sum(axis=1)
        n = min(n, near.shape[1])
        top = np.argpartition(-near, n - 1, axis=1)[:, :n]
        return np.take_along_axis(top, np.argsort(-np.take_along_axis(near, top, axis=1), axis=1, kind="stable"), axis=1)

    def encode(self, residuals: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes, and the length of what they leave out."""
        codes, left, at = [], residuals.copy(), 0
        for book in self.codebooks:
            part = residuals[:, at:at + book.shape[1]]
            code = (2 * part @ book.T - (book ** 2).sum(axis=1)).argmax(axis=1)
            left[:, at:at + book.shape[1]] -= book[code]
            codes.append(code)
            at += book.shape[1]
        return np.stack(codes, axis=1).astype(np.uint8), np.sqrt((left ** 2).sum(axis=1))

    def approximate(self, queries: np.ndarray, centroid: int, codes: np.ndarray) -> np.ndarray:
        """Inner products of every query with every coded member of a list, from tables per subspace."""
        total = np.repeat((queries @ self.centroids[centroid])[:, None], len(codes), axis=1)
        at = 0
        for i, book in enumerate(self.codebooks):
            table = queries[:, at:at + book.shape[1]] @ book.T
            total += table[:, codes[:, i]]
            at += book.shape[1]
        return total


def k_means(points: np.ndarray, k: int, rounds: int = 8, seed: int = 0) -> np.ndarray:
    rng = np.random.default_rng(seed)
    centers = points[rng.choice(len(points), min(k, len(points)), replace=False)].copy()
    for _ in range(rounds):
        nearest = np.concatenate([(2 * p @ centers.T - (centers ** 2).sum(axis=1)).argmax(axis=1)
                                  for p in np.array_split(points, -(-len(points) // 4096))])
        sums = np.zeros_like(centers)
        np.add.at(sums, nearest, points)
        counts = np.bincount(nearest, minlength=len(centers))
        centers[counts > 0] = sums[counts > 0] / counts[counts > 0, None]
    return centers


def train(sample: np.ndarray, n_lists: int, subspaces: int = SUBSPACES) -> Index:
    centroids = k_means(sample, n_lists)
    index = Index(centroids, [])
    residuals = sample - centroids[index.lists(sample, 1)[:, 0]]
    books = [k_means(part, CODES) for part in np.array_split(residuals, min(subspaces, sample.shape[1]), axis=1)]
    return Index(centroids, books)


def unit(rows: np.ndarray) -> np.ndarray:
    """Each row divided by its length, after a power of two that keeps the squares of its components in range."""
    _, power = np.frexp(np.abs(rows).max(axis=1, keepdims=True, initial=0))
    rows = np.ldexp(rows, -power)
    return rows / np.sqrt((rows ** 2).sum(axis=1, keepdims=True))


def link_block(members: dict[str, np.ndarray], queries: dict[str, np.ndarray], index: Index, centroid: int,
               threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ids, links, smallest connected id) of the vectors of two blocks that have links between them."""
    ids = np.unique(np.concatenate((members["id"], queries["id"])))
    links, root = np.zeros(len(ids), dtype=np.int64), np.arange(len(ids))
    at_m, at_q = np.searchsorted(ids, members["id"]), np.searchsorted(ids, queries["id"])
    found_q, found_m = [], []
    for begin in range(0, len(at_q), 256):
        stretch = slice(begin, begin + 256)
        near = index.approximate(queries["vector"][stretch], centroid, members["codes"])
        q, m = np.nonzero(near + members["error"] + 1e-9 >= threshold)
        q += begin
        exact = np.zeros(len(q))
        for i in range(0, len(q), 1 << 15):
            part = slice(i, i + (1 << 15))
            exact[part] = np.einsum("ij,ij->i", queries["vector"][q[part]], members["vector"][m[part]])
        keep = (exact >= threshold) & (at_q[q] != at_m[m])
        found_q.append(q[keep])
        found_m.append(m[keep])
    q, m = np.concatenate([np.zeros(0, dtype=np.int64), *found_q]), np.concatenate([np.zeros(0, dtype=np.int64), *found_m])
    np.add.at(links, at_q[q], members["copies"][m])
    # Where the member does not probe the query's list, this is the only task that sees the pair.
    alone = ~(members["probes"][m] == queries["home"][q][:, None]).any(axis=1)
    np.add.at(links, at_m[m[alone]], queries["copies"][q[alone]])
    a, b = at_q[q], at_m[m]
    while True:
        least = np.minimum(root[a], root[b])
        before = root.copy()
        np.minimum.at(root, a, least)
        np.minimum.at(root, b, least)
        root = root[root]
        if (root == before).all():
            break
    some = np.zeros(len(ids), dtype=bool)
    some[a] = some[b] = True
    return ids[some], links[some], ids[root[some]]


def near_duplicates(vectors: DataFrame, *, threshold: float = THRESHOLD, probes: int = PROBES,
                    sample: int = SAMPLE) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept."""
    base = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("v"))
    usable = (F.col("vec_id").isNotNull() & F.coalesce(F.exists("v", lambda x: x != 0), F.lit(False))
              & ~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))))
    classes = base.filter(usable).groupBy("v").agg(F.min("vec_id").alias("id"), F.count("*").alias("copies"))
    member = base.filter(usable).join(classes, "v").select("vec_id", "id", "copies")
    classes = stored(classes, "vectors")
    totals = classes.groupBy(F.size("v").alias("n")).count().orderBy("n").collect()  # a row per length of vector
    if not totals:
        return base.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"),
                           F.lit(True).alias("kept"))
    found = reduce(DataFrame.union, [
        _links(classes.filter(F.size("v") == n) if len(totals) > 1 else classes, total, threshold, probes, sample)
        for n, total in totals])
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    joined = components(found.select(F.col("id").alias("a"), F.col("root").alias("b")))
    result = (member.join(links, "id", "left").join(joined, "id", "left").select(
        F.col("vec_id").alias("m"), (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
        F.coalesce("component", "id").alias("component_id")).distinct())
    out = base.select("vec_id").join(result, F.col("vec_id") == F.col("m"), "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      component.alias("component_id"),
                      F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"))


def _links(classes: DataFrame, total: int, threshold: float, probes: int, sample: int) -> DataFrame:
    """(id, links, root) of the distinct vectors, all of one length, that link with another."""
    spark = classes.sparkSession
    chosen = classes.orderBy(F.xxhash64("id"), "id").limit(sample).select("v")
    trained = np.array([row.v for row in chosen.toLocalIterator()], dtype=np.float64)
    index = train(unit(trained), max(1, min(LISTS, len(trained) // 16, total // 64)))
    shared = spark.sparkContext.broadcast(index)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                batch = whole.slice(at, 1024)
                v = unit(np.array(batch.column("v").flatten(), dtype=np.float64).reshape(batch.num_rows, -1))
                lists = index.lists(v, probes)
                codes, error = index.encode(v - index.centroids[lists[:, 0]])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id"), batch.column("copies"), pa.array(lists[:, 0].astype(np.int32)),
                     pa.array(list(lists.astype(np.int32)), pa.list_(pa.int32())),
                     pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(error),
                     pa.array([x.tobytes() for x in v], pa.binary())],
                    names=["id", "copies", "home", "probes", "codes", "error", "vector"])

    coded = stored(classes.mapInArrow(assign, "id long, copies long, home int, probes array<int>, codes binary, "
                                              "error double, vector binary"), "codes")
    inside = coded.groupBy(F.col("home").alias("list")).agg(F.count("*").alias("n"))
    asking = coded.select(F.explode("probes").alias("list")).groupBy("list").agg(F.count("*").alias("asked"))
    blocks = inside.join(asking, "list").select(
        "list", F.ceil(F.col("n") / BLOCK).alias("nx"), F.ceil(F.col("asked") / BLOCK).alias("nq"))
    # At most LISTS rows.
    blocks = F.broadcast(blocks)
    spread = F.xxhash64("id")
    members = (coded.withColumn("list", F.col("home")).join(blocks, "list")
               .withColumns({"x": F.pmod(spread, "nx"), "q": F.explode(F.sequence(F.lit(0), F.col("nq") - 1))}))
    queries = (coded.withColumn("list", F.explode("probes")).join(blocks, "list")
               .withColumns({"q": F.pmod(spread, "nq"), "x": F.explode(F.sequence(F.lit(0), F.col("nx") - 1))}))
    names = ["list", "x", "q", "id", "copies", "home", "probes", "codes", "error", "vector"]
    sides = members.select(*names, F.lit(True).alias("member")).union(queries.select(*names, F.lit(False).alias("member")))

    def link(key: tuple, table: pa.Table) -> pa.Table:
        def side(rows: pa.Table) -> dict[str, np.ndarray]:
            n = rows.num_rows
            return {"id": rows["id"].to_numpy(), "copies": rows["copies"].to_numpy(), "home": rows["home"].to_numpy(),
                    "probes": np.array(rows["probes"].to_pylist(), dtype=np.int64).reshape(n, -1),
                    "codes": np.frombuffer(b"".join(rows["codes"].to_pylist()), dtype=np.uint8).reshape(n, -1),
                    "error": rows["error"].to_numpy(),
                    "vector": np.frombuffer(b"".join(rows["vector"].to_pylist())).reshape(n, -1)}

        mine = pc.field("member")
        x, q = table.filter(mine), table.filter(~mine)
        if x.num_rows and q.num_rows:
            ids, links, root = link_block(side(x), side(q), shared.value, key[0].as_py(), threshold)
        else:
            ids = links = root = np.zeros(0, dtype=np.int64)
        return pa.table({"id": pa.array(ids, pa.int64()), "links": pa.array(links, pa.int64()),
                         "root": pa.array(root, pa.int64())})

    return stored(sides.groupBy("list", "x", "q").applyInArrow(link, "id long, links long, root long"), "links")
