"""Decontamination, language identification, toxicity and the pipeline."""

import hashlib
import re

import numpy as np
import pytest
from corpus import collected, frame, prose, texts
from pyspark.sql import functions as F

import corpus_pipeline
from tidewatch.llm import decontaminate, language, ordered, suffixes, toxicity
from tidewatch.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
ITEMS = [("b", " ".join(prose(2, 60)[10:40])), ("a", " ".join(prose(2, 60)[5:25])), ("c", "two THREE"), ("d", None),
         ("e", "?!"), ("f", " ".join(prose(100, 200)[:13])), ("g", " ".join(prose(100, 200)[:13])), (None, "one two")]


def words(text):
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute_contamination(rows, items, window=13):
    windows = {}
    for name, text in items:
        w = words(text)
        size = min(window, len(w))
        for k in range(len(w) - size + 1 if w and name is not None else 0):
            windows.setdefault(tuple(w[k:k + size]), set()).add(name)
    out = []
    for i, text in rows:
        w, hit, found = words(text), set(), set()
        for size in {len(k) for k in windows}:
            for k in range(len(w) - size + 1):
                if tuple(w[k:k + size]) in windows:
                    hit |= set(range(k, k + size))
                    found |= windows[tuple(w[k:k + size])]
        out.append((i, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(),
                    len(hit) > 0 and 20 * len(hit) >= len(w)))
    return sorted(out, key=repr)


KEYS = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


@pytest.mark.parametrize("block_bytes", [decontaminate.BLOCK_BYTES, 100])
def test_contamination(spark, monkeypatch, block_bytes):
    items = spark.createDataFrame(ITEMS, "item_id string, text string")
    blocks = decontaminate.item_blocks(items, block_bytes)
    assert (len(blocks) > 1) == (block_bytes == 100)
    monkeypatch.setattr(decontaminate, "item_blocks", lambda _: blocks)
    docs = frame(spark)
    assert collected(decontaminate.contamination(docs, items), *KEYS) == brute_contamination(texts(), ITEMS)
    kept = decontaminate.reject(docs, items)
    assert kept.schema.names == docs.schema.names
    clean = [i for i, *_, dirty in brute_contamination(texts(), ITEMS) if not dirty]
    assert sorted(map(repr, (r.doc_id for r in kept.collect()))) == sorted(map(repr, clean))


def test_hit_words_can_be_cut_out(spark):
    items = spark.createDataFrame([("c", "two three")], "item_id string, text string")
    docs = frame(spark, [(1, "One, two; THREE - four"), (2, "two three"), (3, "twothree")])
    found = decontaminate.contamination(docs, items, keep_text=True)
    assert collected(found, "doc_id", "clean_text") == [(1, "One, four"), (2, ""), (3, "twothree")]


def test_contamination_query_and_empty_inputs(spark):
    def rows(name, *columns):
        return [tuple(r) for r in spark.read.parquet(f"{FOLDER}/{name}.parquet").select(*columns).collect()]

    found = QUERIES["op5_decontamination"](spark, FOLDER)
    items = [(str(i), t) for i, t in rows("benchmark", "item_id", "text")]
    assert collected(found, *KEYS) == brute_contamination(rows("documents", "doc_id", "text"), items)
    none = spark.createDataFrame([], "item_id string, text string")
    assert decontaminate.contamination(frame(spark, []), none).count() == 0
    assert decontaminate.contamination(frame(spark), none).filter("contaminated or n_hit > 0").count() == 0


def test_language_on_the_held_out_fold(spark):
    found = QUERIES["op9_language"](spark, "/root/testdata/sf0.01")
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    right, n, low, high = found.join(docs, "doc_id").filter("held_out").agg(
        F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*"), F.min("score"), F.max("score")).first()
    assert n > 300 and right > 0.98 and 0 <= low <= high <= 1


def test_language_mixtures_and_odd_texts(spark):
    one, two = [f"wab{x}ke" for x in "aeiou"], [f"zut{x}mo" for x in "aeiou"]
    pick = np.random.default_rng(1)

    def text(words, n):
        return " ".join(pick.choice(words) for _ in range(n))

    learn = [(i, text((one, two)[i % 2], 40)) for i in range(60)]
    docs = frame(spark, learn + [(None, None)])
    model = language.fit(docs)
    assert model.languages == ["aa", "bb"]
    asked = frame(spark, [(1, text(one, 30)), (2, text(one, 30) + " " + text(two, 15)), (3, "12 34 !"), (4, None),
                          (5, ""), (6, text(two, 3000)), (7, "日本")])
    found = {r.doc_id: r for r in language.identify(asked, model).collect()}
    assert (found[1].lang_pred, found[1].languages) == ("aa", ["aa"])
    assert found[2].languages == ["aa", "bb"] and found[2].score == pytest.approx(2 / 3, abs=0.05)
    assert found[6].lang_pred == "bb" and found[7].lang_pred in ("aa", "bb")
    assert [(found[i].lang_pred, found[i].score) for i in (3, 4, 5)] == [("und", 0.0)] * 3
    nothing = language.fit(frame(spark, []))
    assert {r.lang_pred for r in language.identify(asked, nothing).collect()} == {"und"}
    assert language.identify(frame(spark, []), model).count() == 0


def test_toxicity_on_the_held_out_fold(spark):
    folder = "/root/testdata/sf0.1"
    found = QUERIES["op10_toxicity"](spark, folder)
    labels = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "toxic")
    rows = found.join(labels, "doc_id").filter("held_out").select("toxic", "score", "predicted").collect()
    score, toxic = np.array([r.score for r in rows]), np.array([r.toxic for r in rows])
    order = np.argsort(score)
    rank = np.empty(len(rows))
    rank[order] = np.arange(len(rows))
    area = (rank[toxic == 1].mean() - (toxic.sum() - 1) / 2) / (toxic == 0).sum()
    assert area > 0.9 and 0 <= score.min() <= score.max() <= 1
    assert all(r.predicted == (r.score >= 0.7) for r in rows)


def test_toxicity_risk_and_odd_inputs(spark):
    rng = np.random.default_rng(0)
    hidden = rng.random(2000) < 0.2
    mixture = np.column_stack((hidden & (rng.random(2000) < 0.9), rng.random(2000) < 0.5)).astype(np.float32)
    positive = np.column_stack((rng.random(300) < 0.9, rng.random(300) < 0.5)).astype(np.float32)
    model = toxicity.nn_pu(positive, mixture, np.array([3, 7]), 0.2, 500)
    score = 1 / (1 + np.exp(-(mixture @ model.weights + model.intercept)))
    marked = mixture[:, 0] == 1
    # Of the unmarked rows of the mixture about 2 % are positive, of the marked ones all.
    assert score[marked].mean() > 0.85 and score[~marked].mean() < 0.1 and model.weights[0] > 2 * abs(model.weights[1])
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    nothing = toxicity.fit(frame(spark), labels)
    assert {r.predicted for r in toxicity.score(frame(spark), nothing).collect()} == {0}
    assert toxicity.reject(frame(spark), nothing).count() == len(texts())
    assert toxicity.score(frame(spark, []), nothing).count() == 0


def test_pipeline_stages_against_their_rules(spark, tmp_path):
    """Each stage drops or cuts exactly what its operator's own (separately tested) decisions say."""
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels, items = (spark.read.parquet(f"{folder}/{n}.parquet") for n in ("labels", "benchmark"))
    after = {}
    now = docs
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, now, folder).write.parquet(f"{tmp_path}/{name}")
        after[name] = spark.read.parquet(f"{tmp_path}/{name}")
        now = after[name]
    assert [after[n].columns for n, _ in corpus_pipeline.STAGES[:-1]] == [docs.columns] * 4

    def ids(df):
        return {r.doc_id for r in df.select("doc_id").collect()}

    toxic = ids(toxicity.score(docs, toxicity.fit(docs, labels)).filter("predicted = 1"))
    assert ids(after["toxicity"]) == ids(docs) - toxic
    kept = ids(ordered.near_duplicates(after["toxicity"]).filter("kept"))
    assert ids(after["near_duplicates"]) == kept
    repeat = {"length": corpus_pipeline.REPEAT_BYTES}  # the stage has a length of its own
    digests = collected(suffixes.remove_repeats(after["near_duplicates"], **repeat), "doc_id", "kept_sha256")
    cut = suffixes.remove_repeats(after["near_duplicates"], keep_text=True, **repeat)
    assert collected(after["suffix_dedup"], "doc_id", "text") == collected(cut, "doc_id", "clean_text")
    assert len(digests) == len(kept)
    rows = [tuple(r) for r in after["suffix_dedup"].select("doc_id", "text").collect()]
    benchmark = [(str(r.item_id), r.text) for r in items.collect()]
    clean = {i for i, *_, dirty in brute_contamination(rows, benchmark) if not dirty}
    assert ids(after["decontamination"]) == clean
    assert ids(after["bpe"]) == clean
    assert collected(corpus_pipeline.run(spark, folder), "doc_id", "ids_sha256") == collected(after["bpe"], "doc_id", "ids_sha256")


def test_pipeline_stages_take_odd_and_empty_documents(spark):
    for rows in (texts(), []):
        now = frame(spark, rows)
        names = now.columns
        for name, stage in corpus_pipeline.STAGES:
            now = stage(spark, now, FOLDER)
            assert name == "bpe" or now.columns == names
        assert now.count() <= len(rows)
