"""Envelopes cut into hits: any cut of a file gives what parsing it whole gives."""

import json
import random
import resource

import pytest
from raw import write_hits

from tidewatch.operators.normalize import normalize
from tidewatch.sources import envelopes, posts

ODD = ['plain', 'br{ack[et}s]', 'quo"te', 'back\\slash', 'both\\"', '\\\\', 'ends\\', '"hits": [{', "newline\n", "ünï 日本 😀", "", "}]}}"]


def cut(text, size, split):
    """All rows of a text read in chunks of ``size`` bytes by tasks of ``split`` bytes."""
    hits, rest = [], None
    for begin in range(0, max(len(text), 1), split):
        cutter = envelopes.Cutter(begin, begin + split)
        for i in range(0, len(text), size):
            hits += list(cutter.feed(text[i:i + size]))
        if cutter.hit is not None:
            rest = bytes(cutter.hit)
    return [json.loads(h) for h in hits], rest, cutter.done, cutter.announced


@pytest.mark.parametrize("seed", range(8))
@pytest.mark.parametrize("indent", [None, 2])
def test_any_chunks_and_splits_give_the_hits_once_and_in_order(seed, indent):
    pick = random.Random(seed)
    want = [{"_id": str(i), "_source": {pick.choice(ODD): pick.choice([pick.choice(ODD), [1, {"a": pick.choice(ODD)}], None, {"hits": [{"hits": []}]}])}}
            for i in range(pick.randrange(12))]
    whole = {"took": 3, "shards": {"hits": [{"no": 1}], "x": [[{}]]}, "hits": {"total": {"value": 77}, "max_score": None, "hits": want}, "z": {"y": [1]}}
    text = json.dumps(whole, indent=indent, ensure_ascii=bool(seed % 2)).encode()
    for size in (1, 3, 17, 1 << 20):
        for split in (1 << 20, len(text) // 3 + 1, 29):
            assert cut(text, size, split) == (want, None, True, 77), (size, split)


def test_a_text_that_breaks_off_gives_what_lies_before():
    want = [{"_source": {"id": str(i), "text": "x\\\"{"}} for i in range(4)]
    text = json.dumps({"hits": {"hits": want}}).encode()
    ends = [i + 1 for i in range(len(text)) if text[:i + 1].count(b"}}") and text[i - 1:i + 1] == b"}}"][:4]
    for end in range(len(text)):
        for split in (1 << 20, 40):
            hits, rest, done, _ = cut(text[:end], 7, split)
            assert hits == want[:sum(e <= end for e in ends)] and not done
            assert rest is None or not rest.endswith(b"}}")


def test_files_are_read_as_the_whole_parse_reads_them(spark, tmp_path):
    pick = random.Random(1)
    for n in range(3):
        write_hits(tmp_path / f"vk_{n}.json", *[{"id": f"{n}-{i}", "text": pick.choice(ODD) * 5, "date": 1704067200 + i, "from_id": "a",
                                                 "likes": {"count": i}} for i in range(40 * n)])
    write_hits(tmp_path / "tiktok_video_1.json", {"id": "t"}, total=9)
    path = str(tmp_path / "*.json")
    rows = envelopes.read_rows(spark, path, "VK", split_bytes=700)
    assert rows.rdd.getNumPartitions() > 12
    found = normalize(envelopes.sources_of(rows, "vk"), "vk").drop("ProcessedDate")
    want = normalize(posts.unnest_hits(posts.read_envelopes(spark, path, "vk")), "vk").drop("ProcessedDate")
    assert found.columns == want.columns
    assert sorted(map(repr, found.collect())) == sorted(map(repr, want.collect())) and found.count() == 120
    counts = {r.file_name: (r.total_hits, r.held_hits, r.truncated) for r in envelopes.hit_counts(rows).collect()}
    assert counts == {"vk_0.json": (None, 0, False), "vk_1.json": (None, 40, False), "vk_2.json": (None, 80, False)}
    other = envelopes.hit_counts(envelopes.read_rows(spark, path, "tiktok_video")).collect()
    assert [(r.total_hits, r.held_hits, r.truncated) for r in other] == [(9, 1, True)]


def test_broken_and_empty_files(spark, tmp_path):
    write_hits(tmp_path / "vk_1.json", *[{"id": str(i)} for i in range(30)])
    whole = (tmp_path / "vk_1.json").read_bytes()
    (tmp_path / "vk_1.json").write_bytes(whole[:len(whole) // 2])
    (tmp_path / "vk_2.json").write_bytes(b"")
    (tmp_path / "vk_3.json").write_bytes(b"no json at all")
    for split in (1 << 20, 100):
        rows = envelopes.read_rows(spark, str(tmp_path), "vk", split_bytes=split)
        ids = sorted(int(r["id"]) for r in envelopes.sources_of(rows, "vk").collect())
        assert ids == list(range(len(ids))) and 10 < len(ids) < 20
        assert {r.file_name: r.truncated for r in envelopes.hit_counts(rows).collect()} == {
            "vk_1.json": True, "vk_2.json": True, "vk_3.json": True}
        rests = {r.file_name: r.hit for r in rows.where("kind = 'reject'").collect()}
        assert set(rests) == {"vk_1.json", "vk_2.json", "vk_3.json"} and whole.decode().count(rests["vk_1.json"]) >= 1
    assert envelopes.read_rows(spark, str(tmp_path / "none*"), "vk").count() == 0


def test_a_large_envelope_takes_little_memory_and_several_tasks(spark, tmp_path):
    path = tmp_path / "vk_big.json"
    hit = json.dumps({"_source": {"id": "7", "text": "word { \\\" } " * 800}})
    with path.open("w") as out:
        out.write('{"hits": {"hits": [')
        out.write(", ".join([hit] * 12000))
        out.write("]}}")
    size = path.stat().st_size
    assert size > 100 << 20
    rows = envelopes.read_rows(spark, str(path), "vk", split_bytes=16 << 20)
    assert rows.rdd.getNumPartitions() >= 7 and rows.where("kind = 'hit'").count() == 12000
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    cutter, seen = envelopes.Cutter(0, size), 0
    with path.open("rb") as file:
        while data := file.read(envelopes.CHUNK_BYTES):
            seen += sum(1 for _ in cutter.feed(data))
    assert seen == 12000
    assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 100 << 10  # kilobytes
