"""Token records, byte-pair encoding and WARC archives: round trips and comparisons with their libraries."""

import gzip
import hashlib
import zlib

import numpy as np
import public_tokenizers
import pytest
from compare import connect, differences
from corpus import collected, frame, texts
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidewatch.llm import bpe, records, warc
from tidewatch.llm.queries import ORACLE, QUERIES
from tidewatch.llm.storage import files

PATH = public_tokenizers.path("word_bpe_49k.json")
FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def test_bpe_equals_the_library(spark, library):
    found = bpe.encode_decode(frame(spark), PATH, keep=True).collect()
    assert len(found) == len(texts())
    want = {}
    for i, t in texts():
        ids = library.encode(t or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        want.setdefault(i, []).append((len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                                       hashlib.sha256(text.encode()).hexdigest()))
    for r in found:
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) in want[r.doc_id]


def test_short_and_long_words_merge_alike(library):
    encoder = bpe.WordBpe(PATH)
    for word in ("a", "the", "tokenization", "ab" * 20, "é" * 30, "x" * 47, "straße"):
        rows = encoder._short([word.encode()], len(word.encode()))
        short = next(parts[0] for which, parts in rows if len(which))
        assert short.tolist() == encoder._long(word.encode()).tolist() == library.encode(word, add_special_tokens=False).ids


def test_a_full_cache_starts_anew(library, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_PIECES", 3)
    encoder = bpe.WordBpe(PATH)
    for text in ("one two three four five", "six one", "", "seven two one"):
        assert encoder.encode([text.encode()])[0].tolist() == library.encode(text, add_special_tokens=False).ids


def test_records_round_trip(spark, library, tmp_path):
    target = f"file://{tmp_path}/records"
    records.write_documents(frame(spark), PATH, target)
    found = sorted(records.read(spark, target).collect(), key=lambda r: r.start)
    rows = sorted(texts(), key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    start = 0
    for (i, t), r in zip(rows, found, strict=True):
        ids = [*library.encode(t or "", add_special_tokens=False).ids, records.END_TOKEN]
        assert (r.doc_id, r.start, r.n_tokens) == (i, start, len(ids))
        assert np.frombuffer(r.ids, "<u4").tolist() == ids
        start += len(ids)


def test_records_can_be_split_and_damage_is_seen(spark, tmp_path):
    target = f"file://{tmp_path}/records"
    docs = frame(spark).coalesce(1)
    records.write_documents(docs, PATH, target)
    whole = collected(records.read(spark, target), "start", "n_tokens", "ids")
    split = spark.read.format("token_records").option("path", target).option("split_bytes", 512).load()
    assert split.rdd.getNumPartitions() > 3
    assert collected(split, "start", "n_tokens", "ids") == whole
    frame_ = records.framed(b"payload")
    for at in (0, 9, 13, len(frame_) - 1):
        broken = bytearray(frame_)
        broken[at] ^= 1
        with pytest.raises(ValueError):
            list(records.unframed(memoryview(bytes(broken))))
    with pytest.raises(ValueError):
        list(records.unframed(memoryview(frame_[:-6])))


def test_no_documents_make_a_readable_folder(spark, tmp_path):
    records.write_documents(frame(spark, []), PATH, f"file://{tmp_path}/records")
    assert records.read(spark, f"file://{tmp_path}/records").count() == 0
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    warc.write_pages(pages, f"file://{tmp_path}/warc")
    assert warc.read(spark, f"file://{tmp_path}/warc").count() == 0


def test_token_records_query(spark, library):
    found = {r.doc_id: r for r in QUERIES["op1_token_records"](spark, FOLDER).collect()}
    start = 0
    for row in spark.read.parquet(f"{FOLDER}/documents.parquet").orderBy("doc_id").collect():
        ids = np.array([*library.encode(row.text or "", add_special_tokens=False).ids, 2], "<u4")
        r = found.pop(row.doc_id)
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    assert not found


def test_warc_query(spark):
    assert differences(QUERIES["op7_warc"](spark, FOLDER), connect(FOLDER), ORACLE["op7_warc"]) == []


PAGES = [(1, "http://a/1\r\nx", "<p>" + "long " * 400), (2, None, "<p>" + "long " * 400), (3, "http://a/3", None),
         (4, "http://a/4", ""), (5, "http://a/5", "kürz"), (6, "http://a/6", "kürz"), (None, "http://a/7", "\r\n\r\nbody"),
         (8, "http://a/8", "<p>" + "long " * 400), (8, "http://a/8", "<p>" + "long " * 400)]


def test_warc_round_trip_pushdown_and_plain_archives(spark, tmp_path):
    target = f"file://{tmp_path}/warc"
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string").selectExpr("*", "1 as holder", "2 as payload")
    warc.write_pages(pages, target)
    found = collected(warc.read(spark, target), "page_id", "target_uri", "record_type", "refers_to", "payload")
    want = []
    for i, url, html in PAGES:
        revisit = i in (1, 2)
        uri = url and url.replace("\r", "%0D").replace("\n", "%0A")
        want.append((i, uri, "revisit" if revisit else "response", 8 if revisit else None,
                     None if revisit else bytearray((html or "").encode())))
    assert found == sorted(want, key=repr)
    narrow = warc.read(spark, target, "page_id long, record_type string, payload_bytes long")
    some = narrow.filter("record_type = 'revisit' and page_id in (1, 3)")
    assert collected(some, "page_id", "payload_bytes") == [(1, 2003)]
    assert "Filter (" not in some._jdf.queryExecution().executedPlan().toString()
    # The same records without compression, and packed by a writer that notes no sizes.
    store, folder = files(target)
    names = sorted(p.name for p in (tmp_path / "warc").glob("*.warc.gz"))
    data = b"".join(gzip.decompress((tmp_path / "warc" / n).read_bytes()) for n in names)
    (tmp_path / "other").mkdir()
    (tmp_path / "other" / "plain.warc").write_bytes(data)
    cuts = [i for i in range(len(data)) if data.startswith(b"WARC/1.1\r\n", i)] + [len(data)]
    packed = b"".join(gzip.compress(data[a:b]) for a, b in zip(cuts, cuts[1:]))
    (tmp_path / "other" / "packed.warc.gz").write_bytes(packed)
    twice = warc.read(spark, f"file://{tmp_path}/other")
    assert collected(twice, "page_id", "target_uri", "record_type", "refers_to", "payload") == sorted(found * 2, key=repr)
    assert twice.select("page_id").filter("page_id = 5").count() == 2


def test_shuffled_reading_covers_every_record_once(spark, tmp_path):
    target = f"file://{tmp_path}/records"
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.concat(F.lit("word "), F.col("id").cast("string")).alias("text"))
    records.write_documents(docs.repartition(4), PATH, target)
    plain = collected(records.read(spark, target), "doc_id", "start", "n_tokens", "ids")
    split = spark.read.format("token_records").option("path", target).option("split_bytes", 4096)
    orders = {}
    for seed in (1, 1, 2, -7):
        frame_ = split.option("seed", seed).load()
        assert frame_.rdd.getNumPartitions() > 4
        rows = frame_.collect()
        assert sorted((tuple(r) for r in rows), key=repr) == plain
        order = [r.doc_id for r in rows]
        assert orders.setdefault(seed, order) == order != sorted(order)
    assert len({tuple(o) for o in orders.values()}) == 3
    # Neighbours of the stored order do not stay neighbours.
    assert sum(abs(a - b) == 1 for a, b in zip(orders[1], orders[1][1:])) < 30
    assert records.read(spark, target, seed=5).count() == 3000


@pytest.mark.parametrize("total", [1, 2, 3, 64, 1000, 4097])
def test_the_shuffled_order_is_a_permutation(total):
    for seed in (0, 9, -1):
        assert sorted(records.permuted(np.arange(total), total, seed).tolist()) == list(range(total))


def test_many_null_ids_go_to_several_tasks(spark, tmp_path):
    target = f"file://{tmp_path}/records"
    docs = spark.range(10000).select(F.lit(None).cast("long").alias("doc_id"), F.col("id").cast("string").alias("text"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # this little would be merged into one
    try:
        records.write_documents(docs.repartition(8), PATH, target)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len([p for p in (tmp_path / "records").glob("*.records")]) > 4
    assert records.read(spark, target).count() == 10000


def warc_record(kind, block, content_type, *more):
    head = [f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:uuid:{kind}-1>", "WARC-Date: 2020-01-02T03:04:05Z",
            f"Content-Type: {content_type}", f"Content-Length: {len(block)}", *more]
    return ("WARC/1.0\r\n" + "\r\n".join(head) + "\r\n\r\n").encode() + block + b"\r\n\r\n"


def test_archives_of_other_writers(spark, tmp_path):
    """Blocks that hold no HTTP message are payloads as a whole, and ids of any form are kept."""
    body = b"first\r\n\r\nsecond \xff\x00 paragraph"
    wanted = {"warcinfo": (b"software: x\r\nformat: y\r\n", "application/warc-fields"), "resource": (b"plain bytes", "text/plain"),
              "conversion": (body, "text/plain"), "metadata": (b"", "application/warc-fields")}
    parts = [warc_record(kind, block, kind_of) for kind, (block, kind_of) in wanted.items()]
    parts += [warc_record("response", b"HTTP/1.1 200 OK\r\nA: b\r\n\r\n" + body, "application/http; msgtype=response"),
              warc_record("request", b"GET / HTTP/1.0\r\nHost: x\r\n\r\n", "application/http;msgtype=request"),
              warc_record("revisit", b"HTTP/1.1 200 OK\r\n\r\n", "application/http", "WARC-Refers-To: <urn:uuid:response-1>")]
    (tmp_path / "plain.warc").write_bytes(b"".join(parts))
    (tmp_path / "packed.warc.gz").write_bytes(b"".join(gzip.compress(p) for p in parts))
    found = warc.read(spark, f"file://{tmp_path}").collect()
    payloads = {k: block for k, (block, _) in wanted.items()} | {"response": body, "request": b"", "revisit": None}
    assert len(found) == 2 * len(payloads)
    for r in found:
        want = payloads[r.record_type]
        assert (r.payload if r.payload is None else bytes(r.payload)) == want, r.record_type
        assert r.payload_bytes == (None if want is None else len(want))
        assert (r.record_id, r.date, r.page_id) == (f"<urn:uuid:{r.record_type}-1>", "2020-01-02T03:04:05Z", None)
        assert r.refers_to_id == ("<urn:uuid:response-1>" if r.record_type == "revisit" else None)
    sizes = warc.read(spark, f"file://{tmp_path}", "record_type string, payload_bytes long")
    assert sizes.filter(F.col("payload_bytes") == len(body)).count() == 4
    assert warc.read(spark, f"file://{tmp_path}").filter("content_type = 'text/plain'").count() == 4


def test_a_cut_off_archive_is_named(spark, tmp_path):
    whole = warc_record("resource", b"x" * 500, "text/plain")
    (tmp_path / "short.warc").write_bytes(whole + whole[:-200])
    with pytest.raises(Exception, match="short.warc: record 1"):
        warc.read(spark, f"file://{tmp_path}").collect()
