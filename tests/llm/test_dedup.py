"""Deduplication operators against brute force."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from corpus import collected, frame, prose, texts

from tidewatch.llm import blocks, ordered, storage, suffixes, vectors
from tidewatch.llm.components import components


def byte_repeats(rows, length):
    data = [(i, (t or "").encode()) for i, t in rows]
    starts = Counter(t[k:k + length] for _, t in data for k in range(len(t) - length + 1))
    out = []
    for i, t in data:
        gone = np.zeros(len(t), dtype=bool)
        for k in range(len(t) - length + 1):
            if starts[t[k:k + length]] > 1:
                gone[k:k + length] = True
        spans = int((np.diff(gone.astype(int), prepend=0) == 1).sum())
        kept = bytes(b for b, g in zip(t, gone) if not g)
        out.append((i, len(t), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("group", [1 << 16, 2])
def test_suffix_dedup(spark, group):
    rows = [r for r in texts() if r[0] != 52]
    found = suffixes.remove_repeats(frame(spark, rows), length=40, prefix=8, group=group)
    assert collected(found, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == byte_repeats(rows, 40)


def test_suffix_dedup_where_matches_lie_crosswise(spark):
    """One document shares its left part with one, its right part with another, and its middle with a third."""
    pick = random.Random(5)
    letters = "".join(pick.choice("abcdefgh") for _ in range(400))
    other = lambda: "".join(pick.choice("ijklmnop") for _ in range(60))
    rows = [(i, other() + letters[a:b] + other()) for i, (a, b) in enumerate(
        [(0, 400), (0, 150), (100, 180), (140, 260), (155, 235), (150, 400), (160, 230), (120, 240), (90, 210)])]
    found = suffixes.remove_repeats(frame(spark, rows), length=70, prefix=12)
    assert collected(found, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == byte_repeats(rows, 70)


def test_suffix_runs_merge_in_order_with_common_prefixes():
    pick = random.Random(3)
    runs = [sorted("".join(pick.choice("ab") for _ in range(pick.randrange(12))).encode() for _ in range(n))
            for n in (0, 1, 17, 40, 5)]
    merged = list(suffixes.merged([suffixes.Run(*suffixes.Run.code(r)) for r in runs]))
    assert [s for _, _, s, _ in merged] == sorted(sum(runs, []))
    assert all(runs[i][j] == s for i, j, s, _ in merged)
    for (_, _, a, _), (_, _, b, same) in zip(merged, merged[1:]):
        assert same == suffixes.shared_length(a, b)


def word_repeats(rows, window):
    data = [(i, (t or "").encode().split()) for i, t in rows]
    first = {}
    for i, w in data:
        for k in range(len(w) - window + 1):
            if i is not None:
                key = tuple(w[k:k + window])
                first[key] = min(first.get(key, i), i)
    out = []
    for i, w in data:
        gone = [False] * len(w)
        for k in range(len(w) - window + 1):
            if i is not None and first[tuple(w[k:k + window])] < i:
                gone[k:k + window] = [True] * window
        kept = b" ".join(x for x, g in zip(w, gone) if not g)
        out.append((i, len(w), sum(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize(("window", "bucket_bytes", "share"), [
    (13, 1 << 20, 16), (6, 5000, 16), (13, 5000, 16), (13, 20000, 1 << 20), (1, 20000, 64)])
def test_block_dedup(spark, monkeypatch, window, bucket_bytes, share):
    """Buckets alone, buckets next to frequent stretches and windows, and these alone give the same."""
    monkeypatch.setattr(blocks, "SHARE", share)
    found = blocks.remove_repeats(frame(spark), window=window, bucket_bytes=bucket_bytes)
    assert collected(found, "doc_id", "n_words", "n_removed", "kept_sha256") == word_repeats(texts(), window)


def test_no_bucket_gets_a_passage_of_a_third_of_the_documents(spark, monkeypatch):
    passage = " ".join(prose(5, 60))
    rows = [(i, " ".join(prose(1000 + i, 30)) + (f" {passage} " if i % 3 == 0 else " ") + " ".join(prose(5000 + i, 30)))
            for i in range(240)]
    sent = []
    plain = blocks.frequent
    monkeypatch.setattr(blocks, "frequent", lambda *a: sent.append(plain(*a)) or sent[-1])
    found = blocks.remove_repeats(frame(spark, rows), bucket_bytes=4000)
    assert collected(found, "doc_id", "n_words", "n_removed", "kept_sha256") == word_repeats(rows, 13)
    assert len(sent[0].windows) == 60 - 13 + 1 and len(sent[0].blocks) == 60 - 7 + 1
    assert (sent[0].earliest == 0).all()


def test_counts_in_bounded_memory_miss_nothing_frequent():
    pick = np.random.default_rng(0)
    values = np.concatenate((np.repeat(np.arange(20), 5000), pick.integers(100, 1 << 40, 400000))).astype(np.uint64)
    pick.shuffle(values)
    tally = blocks.Counts(200)
    for part in np.array_split(values, 300):
        tally.add(part)
        if len(tally.waiting) > 7:
            tally.settle()
    tally.settle()
    kept = dict(zip(tally.keys.tolist(), tally.counts.tolist()))
    assert len(kept) <= 200 and tally.total == len(values)
    assert all(5000 - len(values) / 200 <= kept[i] <= 5000 for i in range(20))


def similarity(a, b):
    """Longest common subsequence of labelled shingles by the quadratic table."""
    line = [0] * (len(b) + 1)
    for x in a:
        before = line[:]
        for j, y in enumerate(b):
            line[j + 1] = before[j] + 1 if x == y else max(before[j + 1], line[j])
    return line[-1] / (len(a) + len(b) - line[-1])


def test_alignment_is_exact_within_its_band():
    pick = random.Random(8)
    for _ in range(60):
        a = np.array(pick.sample(range(1000), 40), dtype=np.uint64)
        b = a.copy()
        for _ in range(pick.randrange(6)):
            i, j = pick.randrange(40), pick.randrange(40)
            b[i], b[j] = b[j], b[i]
        b = b[:pick.randrange(34, 41)]
        true = similarity(a.tolist(), b.tolist())
        assert ordered.alignment(a, b) == pytest.approx(true if true >= 0.8 else 0)


def test_order_minhash(spark):
    rows = [r for r in texts() if r[0] != 52]
    found = ordered.near_duplicates(frame(spark, rows)).collect()
    named = [(i, t or "") for i, t in rows if i is not None]
    sequences = ordered.sequences([t.encode() for _, t in named])
    parent = list(range(len(named)))

    def root(i):
        return i if parent[i] == i else root(parent[i])

    for i, a in enumerate(sequences):
        for j in range(i):
            b = sequences[j]
            alike = named[i][1] == named[j][1] or (len(a) and len(b) and min(len(a), len(b)) >= 0.8 * max(len(a), len(b))
                                                   and similarity(a.tolist(), b.tolist()) >= 0.8)
            if alike:
                parent[root(i)] = root(j)
    ids = {k: min(named[i][0] for i in range(len(named)) if root(i) == k) for k in {root(i) for i in range(len(named))}}
    want = sorted((named[i][0], ids[root(i)]) for i in range(len(named)))
    assert sorted((r.doc_id, r.class_id) for r in found if r.doc_id is not None) == want
    assert [(r.class_id, r.kept) for r in found if r.doc_id is None] == [(None, True)] * 2
    kept = ordered.deduplicate(frame(spark, rows))
    assert kept.columns == frame(spark, []).columns
    # Of the rows 60, 60 one stays; both texts of 61 stay.
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == sorted(
        [*{i for i in ids.values()}, 61])


def test_order_minhash_compares_what_the_first_member_did_not_connect(spark):
    from corpus import changed, prose

    base = prose(400, 300)
    rows = [(i, " ".join(changed(base, 500 + i, 8))) for i in range(40)] + [(99, " ".join(base))]
    rows = [(i, t) for i, t in rows]
    found = {r.doc_id: r.class_id for r in ordered.near_duplicates(frame(spark, rows)).collect()}
    sequences = dict(zip([i for i, _ in rows], ordered.sequences([t.encode() for _, t in rows])))
    linked = {(i, j) for i in sequences for j in sequences if i < j and ordered.alignment(sequences[i], sequences[j])}
    assert linked and all(found[i] == found[j] for i, j in linked)


def test_vectors(spark):
    rng = np.random.default_rng(4)
    base = rng.normal(size=(40, 16))
    rows = [(i, v.tolist()) for i, v in enumerate(base)]
    rows += [(100 + i, (base[i % 5] + 0.2 * rng.normal(size=16)).tolist()) for i in range(40)]
    rows += [(200 + i, base[0].tolist()) for i in range(6)] + [(210, (2 * base[0]).tolist())]
    odd = [(300, None), (301, [0.0] * 16), (302, [float("nan")] + [1.0] * 15), (303, [None] + [1.0] * 15),
           (304, [float("inf")] + [1.0] * 15), (305, [1.0, 2.0]), (306, []), (None, base[0].tolist())]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>").selectExpr(
        "vec_id", "embedding", "1 as id", "'x' as v")
    found = {r.vec_id: r for r in vectors.near_duplicates(df, probes=64).collect()}
    v = np.array([x for _, x in rows])
    v /= np.linalg.norm(v, axis=1)[:, None]
    near = v @ v.T >= 0.9
    reach = near.copy()
    for _ in range(8):
        reach = reach @ reach
    ids = np.array([i for i, _ in rows])
    for k, (i, _) in enumerate(rows):
        assert (found[i].n_links, found[i].component_id) == (near[k].sum() - 1, ids[reach[k]].min()), i
        assert found[i].kept == (found[i].component_id == i)
    for i, _ in odd:
        assert (found[i].n_links, found[i].component_id, found[i].kept) == (0, i, True)
    assert len(found) == len(rows) + len(odd)


def test_components(spark):
    edges = [(i, i + 1) for i in range(30)] + [(100, 90), (90, 101), (5, 5), (200, 201), (200, 201), (None, 4)]
    found = components(spark.createDataFrame(edges, "a long, b long"))
    assert collected(found, "id", "component") == sorted(
        [(i, 0) for i in range(31)] + [(90, 90), (100, 90), (101, 90), (200, 200), (201, 200)], key=repr)


def test_empty_tables(spark):
    docs = frame(spark, [])
    assert suffixes.remove_repeats(docs).count() == suffixes.clean(docs).count() == 0
    assert blocks.remove_repeats(docs).count() == 0
    assert ordered.near_duplicates(docs).count() == ordered.deduplicate(docs).count() == 0
    assert vectors.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_cleaned_documents_keep_their_columns(spark):
    rows = [r for r in texts() if r[0] != 52]
    docs = frame(spark, rows)
    cleaned = suffixes.clean(docs, length=40, prefix=8)
    assert cleaned.schema.names == docs.schema.names
    sizes = {r.doc_id: (r.text, r.n_chars, r.tag, r.row, r.spans) for r in cleaned.collect()}
    assert sizes[20] == ("", 0, "t", 1, 2) and sizes[44] == ("one two three", 13, "t", 1, 2)


def test_suffix_dedup_of_a_very_long_text_at_full_length(spark):
    """400 bytes with the prefix that production uses, in texts of which one has two megabytes."""
    from corpus import prose

    shared = " ".join(prose(900, 200)).encode()
    rows = [(i, f"own {i} " + " ".join(prose(910 + i, 30)) + shared[a:b].decode() + " ".join(prose(950 + i, 30)))
            for i, (a, b) in enumerate([(0, 399), (100, 501), (100, 500), (0, 700), (300, 699), (0, 10)])]
    long_words = prose(990, 5000)
    rows += [(52, " ".join(long_words)), (53, " ".join(f"{w}{k}" for k in range(60) for w in long_words[:900])), (54, "z" * 3000)]
    found = suffixes.remove_repeats(frame(spark, rows))
    assert collected(found, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == byte_repeats(rows, 400)


def test_passages_of_51_to_60_words_go(spark):
    """What the pipeline cuts: passages of over 50 words that occur in two documents, and nothing else."""
    from corpus import prose

    import corpus_pipeline

    rows, passages = [], []
    for k, n in enumerate(range(51, 61)):
        passage = " ".join(f"{w}{k}" for w in prose(700 + k, n))
        passages.append(passage)
        rows += [(2 * k + j, " ".join(f"{w}{k}{j}" for w in prose(720 + 2 * k + j, 40)) + f" {passage} "
                  + " ".join(f"{w}{j}{k}" for w in prose(760 + 2 * k + j, 40))) for j in range(2)]
    clean = [(100 + i, " ".join(f"{w}x{i}" for w in prose(800 + i, 150))) for i in range(5)]
    left = {r.doc_id: r.text for r in corpus_pipeline.cut_repeats(spark, frame(spark, rows + clean), "").collect()}
    for i, text in rows:
        assert passages[i // 2] in text and passages[i // 2][8:-8] not in left[i]
        assert len(left[i]) > 300
    assert all(left[i] == text for i, text in clean)


def test_order_minhash_of_a_very_long_text(spark):
    from corpus import changed, prose

    words = prose(9, 20000)
    rows = [(1, " ".join(words)), (2, " ".join(changed(words, 4, 100))), (3, " ".join(changed(words, 5, 9000))), (4, "x" * 200000)]
    assert {r.doc_id: r.class_id for r in ordered.near_duplicates(frame(spark, rows)).collect()} == {1: 1, 2: 1, 3: 3, 4: 4}


def test_vectors_of_extreme_size_and_of_any_length_link(spark):
    rows = [(1, [1e200, 1e200]), (2, [1e200, 1e200]), (3, [1e-200, 1e-200]), (4, [3e-200, 3e-200]), (5, [5e-324, 0.0]),
            (6, [1.0, 0.0]), (7, [1.0, 2.0, 3.0]), (8, [1.0, 2.0, 3.1]), (9, [1.0]), (10, [2.0]), (11, [-1.0]), (12, [0.0, 1.0])]
    found = {r.vec_id: (r.n_links, r.component_id) for r in vectors.near_duplicates(
        spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    assert found == {1: (3, 1), 2: (3, 1), 3: (3, 1), 4: (3, 1), 5: (1, 5), 6: (1, 5), 7: (1, 7), 8: (1, 7), 9: (1, 9),
                     10: (1, 9), 11: (0, 11), 12: (0, 12)}


def test_recall_at_the_default_probes_with_many_lists(spark):
    """Pairs at cosines just above the threshold among vectors that fill over a hundred lists."""
    rng = np.random.default_rng(11)
    base = rng.normal(size=(9000, 32))
    base /= np.linalg.norm(base, axis=1)[:, None]
    noise = rng.normal(size=(1000, 32))
    noise -= (noise * base[:1000]).sum(axis=1)[:, None] * base[:1000]
    noise /= np.linalg.norm(noise, axis=1)[:, None]
    cosine = rng.uniform(0.9, 0.93, size=(1000, 1))
    twins = cosine * base[:1000] + np.sqrt(1 - cosine ** 2) * noise
    every = np.concatenate((base, twins))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(every)], "vec_id long, embedding array<double>")
    links = {r.vec_id: r.n_links for r in vectors.near_duplicates(df).collect()}
    near = every @ every.T >= 0.9
    want = near.sum(axis=1) - 1
    found = np.array([links[i] for i in range(len(every))])
    assert (found <= want).all()
    assert found.sum() >= 0.9 * want.sum() and want.sum() >= 1990


def test_suffix_dedup_where_most_keys_are_frequent_or_none(spark, monkeypatch):
    """Whether a prefix goes to the rows or is met by a shuffle changes nothing."""
    rows = [r for r in texts() if r[0] != 52]
    for frequent in (1, 3):
        monkeypatch.setattr(storage, "FREQUENT", frequent)
        found = suffixes.remove_repeats(frame(spark, rows), length=40, prefix=8)
        assert collected(found, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == byte_repeats(rows, 40)


def test_a_frequent_passage_stays_where_it_is_read(spark, monkeypatch):
    """A third of the documents hold one passage; no task of the join on prefixes gets them."""
    from corpus import prose

    passage = " ".join(prose(5, 60))
    rows = [(i, " ".join(prose(1000 + i, 30)) + (f" {passage} " if i % 3 == 0 else " ") + " ".join(prose(5000 + i, 30))) for i in range(120)]
    found = suffixes.repeated_spans(suffixes.documents(frame(spark, rows)), length=100, prefix=16).collect()
    assert sorted(r.doc for r in found) == list(range(0, 120, 3))


def test_suffixes_of_one_beginning_go_to_several_ranges_by_their_prefix(spark, monkeypatch):
    heads, prefixes = np.array([1, 5, 5, 5, 5, 5, 5, 9]), np.array([7, 1, 1, 2, 3, 4, 5, 8])
    found = suffixes.ranges(np.array([5, 5, 5, 8]), heads, prefixes)
    assert found[0] == 0 and found[-1] == 4 and found[1] == found[2] and len(set(found[1:7].tolist())) > 1
    assert (found[1:7] <= 3).all()
    monkeypatch.setattr(suffixes, "RANGE_MEMBERS", 2)
    rows = [r for r in texts() if r[0] != 52]
    rows += [(400 + i, f"the same beginning {'abcd'[i % 4] * 30} of {' '.join(prose(700 + i // 4, 20))}") for i in range(24)]
    result = suffixes.remove_repeats(frame(spark, rows), length=40, prefix=16)
    assert collected(result, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == byte_repeats(rows, 40)


@pytest.mark.parametrize("group", [1 << 16, 2])
def test_suffix_dedup_counts_shorter_repeats_in_the_same_pass(spark, group):
    """Bytes in shorter repeats equal brute force at that length, and what is removed is that of the longer one alone."""
    pick = random.Random(5)
    letters = "".join(pick.choice("abcdefgh") for _ in range(400))
    other = lambda: "".join(pick.choice("ijklmnop") for _ in range(60))
    rows = [r for r in texts() if r[0] != 52]
    rows += [(500 + i, other() + letters[a:b] + other()) for i, (a, b) in enumerate(
        [(0, 400), (0, 150), (100, 180), (140, 260), (155, 235), (150, 400), (160, 230), (120, 240), (90, 210), (370, 400)])]
    # Repeats that begin or end with their texts leave no room for longer windows.
    rows += [(520, letters[:45]), (521, letters[:75]), (522, letters[330:]), (523, letters[350:])]
    for length, shorter in ((70, 40), (100, 24), (40, 40)):
        found = suffixes.remove_repeats(frame(spark, rows), length=length, shorter=shorter, prefix=8, group=group, keep_text=True)
        assert found.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "clean_text", "n_repeated"]
        assert collected(found, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == byte_repeats(rows, length)
        assert collected(found, "doc_id", "n_bytes", "n_repeated") == sorted(
            (r[:3] for r in byte_repeats(rows, shorter)), key=repr)


def test_op3_marks_passages_of_51_to_60_words_and_removes_400_bytes(spark, tmp_path):
    """Passages of over 50 words that two documents share are marked though most are too short to be removed."""
    from tidewatch.llm.queries import PASSAGE, QUERIES

    rows = []
    for k, n in enumerate(range(51, 61)):
        passage = " ".join(f"{w}{k}" for w in prose(700 + k, n))
        rows += [(2 * k + j, " ".join(f"{w}{k}{j}" for w in prose(720 + 2 * k + j, 40)) + f" {passage} "
                  + " ".join(f"{w}{j}{k}" for w in prose(760 + 2 * k + j, 40))) for j in range(2)]
    rows += [(100 + i, " ".join(f"{w}x{i}" for w in prose(800 + i, 150))) for i in range(5)]
    rows += [(200 + i, " ".join(prose(820, 90)) + f" {i} " + " ".join(f"{w}y{i}" for w in prose(830 + i, 50))) for i in range(2)]
    frame(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    found = QUERIES["op3_suffix_dedup"](spark, str(tmp_path))
    assert collected(found, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == byte_repeats(rows, 400)
    assert collected(found, "doc_id", "n_bytes", "n_repeated") == sorted((r[:3] for r in byte_repeats(rows, PASSAGE)), key=repr)
    marked = {r.doc_id for r in found.collect() if r.n_repeated}
    assert marked == {i for i, _ in rows if i < 100 or i >= 200}
    assert {r.doc_id for r in found.collect() if r.n_removed} < marked
