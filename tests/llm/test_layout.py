"""Packing, manifest and filter audit: brute force on small documents with odd cases."""

import hashlib
import itertools
import random
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from compare import connect, differences
from corpus import SCHEMA, frame, texts
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidewatch.llm import interaction, manifest, packing
from tidewatch.llm.queries import ORACLE, QUERIES

BYTES = public_tokenizers.path("byte_bpe_50k.json")
FOLDER = "/root/testdata/sf0.001"
ODD = ["", " ", "  two  spaces ", "a\nb\n\nc\t d", "it's we'll DON'T x'y", "end.Next,word;(a)\"q\"!?", "<|endoftext|> a<|endoftext|>b",
       "nb sp  em 　id \x85x", "été à ß σ日本 語 😀 .", "x" * 5000, " . . . , ,", "é é.é 1 2. 3,4", "\r\n\r\n a", "a \n b"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(BYTES)


def test_byte_pieces_equal_the_library(library):
    every = [t or "" for _, t in texts()] + ODD
    pick = random.Random(5)
    every += ["".join(pick.choice([" ", "  ", "\n", "\t", "a", "Bc", "é", "ж", "'s", "'", ".", "?", "<|endoftext|>", "|", "9", " ", " ", "日"])
                      for _ in range(60)) for _ in range(300)]
    found = packing.BytePieces(BYTES).encode([t.encode() for t in every])
    for text, ids in zip(every, found):
        assert ids.tolist() == library.encode(text, add_special_tokens=False).ids, text


def checked_packing(rows, length):
    """Sequences without overlap or gap; pieces of a document in order, only the first shorter than ``length``."""
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r.sequence_id, []).append(r)
    for parts in by_sequence.values():
        at = 0
        for r in sorted(parts, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= length
    return len(by_sequence)


@pytest.mark.parametrize("length", [16, 64, 2048])
def test_packing_holds_every_token_once(spark, library, length):
    docs = frame(spark).repartition(5)
    packed = packing.pack(docs, BYTES, length=length).cache()
    rows = packed.collect()
    total = 0
    want = Counter()
    for i, t in texts():
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 0]
        total += len(ids)
        first = len(ids) % length or length
        cuts = [0, *range(first, len(ids) + 1, length)]
        want.update((i, k, a, b - a, np.array(ids[a:b], "<u4").tobytes()) for k, (a, b) in enumerate(zip(cuts, cuts[1:])))
    assert Counter((r.doc_id, r.piece, r.start, r.length, bytes(r.ids)) for r in rows) == want
    used = checked_packing(rows, length)
    assert used <= np.ceil(total / length) * 1.02 + 1
    for r in packing.sequences(packed).collect():
        parts = sorted((p for p in rows if p.sequence_id == r.sequence_id), key=lambda p: p.offset)
        assert bytes(r.ids) == b"".join(bytes(p.ids) for p in parts)
        assert [(s.offset, s.length, s.doc_id, s.piece) for s in r.spans] == [(p.offset, p.length, p.doc_id, p.piece) for p in parts]


def first_fit_decreasing(sizes, length):
    room = []
    for size in sorted(sizes, reverse=True):
        for i, left in enumerate(room):
            if left >= size:
                room[i] -= size
                break
        else:
            room.append(length - size)
    return len(room)


@pytest.mark.parametrize("seed", range(12))
def test_plan_packs_as_well_as_first_fit_decreasing(seed):
    pick, length = random.Random(seed), 100
    low, high = pick.choice([(1, 100), (20, 60), (30, 35), (1, 8), (40, 100)])
    sizes = [pick.randint(low, high) for _ in range(pick.choice([1, 30, 700]))]
    counts = np.bincount(sizes, minlength=length + 1)
    plan = packing.planned(counts, length)
    given = Counter()
    for times, make_up in packing.fillings(counts, length):
        assert sum(s * n for s, n in make_up) <= length
        given.update({s: n * times for s, n in make_up})
    assert given == Counter(sizes)
    assert plan.sequences <= first_fit_decreasing(sizes, length)


def test_two_replace_the_shortest():
    # Greedy: 60 + 30 leaves 10 of 100 unused; 30 gives way to 20 + 20 (better than 25 + 10).
    counts = np.zeros(101, dtype=np.int64)
    counts[[60, 30, 25]] = 1
    counts[20] = 2
    assert next(packing.fillings(counts, 100)) == (1, [(60, 1), (20, 2)])


def test_plan_stays_small_for_many_pieces():
    counts = np.full(2049, 10 ** 9, dtype=np.int64)
    plan = packing.planned(counts, 2048)
    assert len(plan.number) < 40_000
    assert plan.sequences <= 1.001 * (np.arange(2049) * counts).sum() / 2048


def test_empty_tables(spark):
    docs = spark.createDataFrame([], SCHEMA)
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert packing.pack(docs, BYTES).collect() == []
    assert manifest.manifest(docs, group="lang", key="doc_id", digest="text").collect() == []
    assert interaction.audit(interaction.cells(docs, labels)).collect() == []


def test_packing_query_covers_the_table(spark, library):
    rows = QUERIES["op11_packing"](spark, FOLDER).collect()
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    sizes = {i: len(library.encode(t or "", add_special_tokens=False).ids) + 1 for i, t in docs.items()}
    found = Counter()
    for r in rows:
        found[r.doc_id] += r.length
    assert found == sizes
    assert checked_packing(rows, 2048) <= -(-sum(sizes.values()) // 2048) + 1


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute_tree(digests, fan):
    """Top, and for each leaf the siblings left and right of it, level by level."""
    paths, at = [[] for _ in digests], list(range(len(digests)))
    while len(digests) > 1:
        for path, i in zip(paths, at):
            low = i // fan * fan
            path.append(("".join(digests[low:i]), "".join(digests[i + 1:low + fan])))
        digests = [sha("".join(digests[i:i + fan])) for i in range(0, len(digests), fan)]
        at = [i // fan for i in at]
    return digests[0], paths


@pytest.mark.parametrize("fan, band", [(2, 10), (2, 2), (2, 1), (3, 2), (5, 1)])
def test_manifest_equals_brute_force(spark, fan, band):
    rows = [(i, t, None if i is None or i % 11 == 0 else ("ä", "b", "", "=")[(i // 3) % 4]) for i, t in texts()]
    rows += [(i, f"text {i}", "many") for i in range(1000, 1075)] + [(1000, "text 1000", "many")]
    docs = spark.createDataFrame([(i, t, g, 7) for i, t, g in rows], "doc_id long, text string, lang string, tree int").repartition(6)
    with_leaf = docs.withColumn("digest", manifest.leaf(F.col("doc_id"), F.col("lang"), F.col("text")))
    made = manifest.manifest(with_leaf, group="lang", key="doc_id", digest="digest", fan=fan, band=band)
    found = made.select("row.doc_id", "row.text", "row.lang", "rank", "digest", "subroot", "root", "path",
                        manifest.folded(F.col("digest"), F.col("path")).alias("again"),
                        manifest.folded(F.lit(sha("other")), F.col("path")).alias("wrong")).collect()

    def field(x):
        return "-" if x is None else f"{len(str(x).encode())}:{x}"

    groups = {}
    for i, t, g in rows:
        groups.setdefault(g, []).append((i is not None, i or 0, sha(field(i) + field(g) + field(t)), t))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: brute_tree([leaf for *_, leaf, _ in sorted(groups[g], key=lambda x: x[:3])], fan) for g in order}
    root, upper = brute_tree([trees[g][0] for g in order], fan)
    want = Counter()
    for g, above in zip(order, upper):
        for rank, ((numbered, i, leaf, t), path) in enumerate(zip(sorted(groups[g], key=lambda x: x[:3]), trees[g][1])):
            want[(i if numbered else None, t, g, rank, leaf, trees[g][0], root, tuple(path + above))] += 1
    assert Counter((r.doc_id, r.text, r.lang, r.rank, r.digest, r.subroot, r.root, tuple((s.left, s.right) for s in r.path))
                   for r in found) == want
    assert all(r.again == r.root and r.wrong != r.root for r in found)


def test_manifest_of_one_row(spark):
    row = manifest.manifest(spark.createDataFrame([(1, "x", sha("x"))], "doc_id long, lang string, leaf string"),
                            group="lang", key="doc_id", digest="leaf").first()
    assert (row.digest, row.subroot, row.root, row.path) == (sha("x"), sha("x"), sha("x"), [])


def test_tampering_is_found(spark):
    rows = QUERIES["op12_manifest"](spark, FOLDER).collect()
    docs = {r.doc_id: r for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    import zlib

    assert len(rows) == len(docs)
    for r in rows:
        assert r.verified == (zlib.crc32(str(r.doc_id).encode()) % 7 != 0 or docs[r.doc_id].n_chars is None)


def test_audit_equals_brute_force(spark):
    rows = [(i, t, None if i is None else ("", "aa", "bb")[i % 3]) for i, t in texts()]
    rows += [(200 + i, "Word $ " * 300 if i % 2 else " ".join(f"w{j}" for j in range(250)), "aa") for i in range(6)]
    rows += [(-1, "SHOUT " * 210, None), (300, "SHOUT " * 210, "cc"), (301, "SHOUT " * 210, "cc")]
    labels = [(200, 1, 1), (201, 1, 0), (203, 0, 1), (203, None, None), (301, 1, 1), (None, 1, 1), (9999, 1, 1), (20, 1, 0), (21, 1, 1)]
    docs = spark.createDataFrame([(i, t, g, 1, 2) for i, t, g in rows], "doc_id long, text string, lang string, mask int, good int").repartition(5)
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    found = {(r.part, r.filter_order, r.step): tuple(r)[3:] for r in interaction.audit(interaction.cells(docs, known)).collect()}

    smallest = {}
    for i, t, _ in rows:
        if i is not None:
            smallest[t or ""] = min(i, smallest.get(t or "", i))
    judged = []
    for i, t, g in rows:
        t = t or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {x for x, bad in zip("ABCDE", (
            len(words) < 200, 100 * len(set(words)) < 50 * len(words), 100 * sum("A" <= c <= "Z" for c in t) > 3 * len(t),
            any(c in "#$%&*|" for c in t), i is not None and i > smallest[t])) if bad}
        mine = [x for x in labels if i is not None and x[0] == i]
        judged.append((g or "", fails, any(x[1] == 1 for x in mine), any(x[2] == 1 for x in mine)))
    parts = {g for g, *_ in judged}
    want, shapley = {}, Counter()
    for part in parts:
        for order in itertools.permutations("ABCDE"):
            left = [d for d in judged if d[0] == part]
            gone = []
            for step, letter in enumerate(order, 1):
                removed = [d for d in left if letter in d[1]]
                redundant = sum(letter in d[1] for d in gone)
                left = [d for d in left if letter not in d[1]]
                gone += removed
                shapley[part, letter] += len(removed)
                want[part, "".join(order), step] = (
                    len(left), len(removed), redundant, sum(d[0] == part and d[1] == {letter} for d in judged),
                    sum(d[2] for d in removed), sum(d[3] for d in removed))
    assert found == {k: (*v, shapley[k[0], k[1][k[2] - 1]]) for k, v in want.items()}
    assert len(found) == 600 * len(parts)


def test_null_ids_may_be_many(spark):
    docs = spark.range(4000).select(F.lit(None).cast("long").alias("doc_id"), F.lit("same text").alias("text"), F.lit("aa").alias("lang"))
    cell = interaction.cells(docs, spark.createDataFrame([(None, 1, 1)], "doc_id long, quality int, toxic int")).collect()
    assert [tuple(r) for r in cell] == [("aa", 1, 4000, 0, 0)]


@pytest.mark.parametrize("name", ["op12_manifest", "op13_filter_interactions"])
def test_queries_equal_sql(spark, name):
    assert differences(QUERIES[name](spark, FOLDER), connect(FOLDER), ORACLE[name]) == []
