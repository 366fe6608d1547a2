import random
import re
from urllib.parse import unquote, urlparse

import pytest
from pyspark.sql import functions as F

from tidewatch.functions import urls, words
from tidewatch.operators import keywords

STOPS = ["the", "and", "of", "in"]
EDGE_URLS = [
    "https://a.org/one/two", "http://a.org", "", "/", "a.org/plain/text", "//host/only/path?q=1#f",
    "https://a.org/x%2Fy/z+w", "https://a.org/100%-sure/%zz%41%", "https://a.org/caf%C3%A9/na%C3%AFve-café",
    "https://a.org/a;p=1/b;q=2;r=3?x", "https://[::1]:80/ip/six", "mailto:someone", "https://a.org//double//slash/",
    "https://a.org/%FF%FEbad", "ftp://f.org/file.txt;type=a", "https://a.org/sp ace/tab\tx", "https://a.org/%0Aline",
    "HTTP://A.org/Upper", "https://a.org/?only=query", "https://a.org/#frag", "1http://a/b", "https://a.org/%25%32%35",
]


def python_segments(url):
    return [s for s in unquote(urlparse(url).path).strip("/").split("/") if s]


def test_segments_follow_python_url_rules(spark):
    random.seed(7)
    pieces = ["a", "B-c", "%20", "%2F", "%", "+", ";k=v", "/", "//", "?q", "#f", "é", "%C3%A9", ".html", "api", "1"]
    drawn = ["https://h.org/" + "".join(random.choices(pieces, k=random.randint(0, 9))) for _ in range(400)]
    frame = spark.createDataFrame([(u,) for u in EDGE_URLS + drawn], "url string")
    for row in frame.select("url", urls.path_segments(F.col("url")).alias("got")).collect():
        # urlparse drops tabs and line feeds before it parses; the scan keeps them.
        if not set("\t\n\r") & set(row["url"]):
            assert row["got"] == python_segments(row["url"]), row["url"]


@pytest.mark.parametrize("segment, technical", [
    ("0123abcd-0123-abcd-0123-0123456789ab", True), ("0123abcd-0123-abcd-0123-0123456789ab-tail", True),
    ("0123ABCD-0123-abcd-0123-0123456789ab", False), ("d41d8cd98f00b204e9800998ecf8427e.html", True),
    ("20240105", True), ("20240105-news", False), ("api", True), ("apicultura", True), ("v1", True), ("v3", False),
    ("API", False), ("2024", True),
])
def test_technical_segments(spark, segment, technical):
    frame = spark.createDataFrame([(segment,)], "s string")
    assert frame.select(urls.is_technical(F.col("s"))).first()[0] is technical


def test_cleaning_matches_python(spark):
    samples = ["big_news--today.html", "-lead-", "a.b.c", "café.été", "x.y z", "no_ext", "..html", " wide "]
    frame = spark.createDataFrame([(s,) for s in samples], "s string")
    for row in frame.select("s", urls.clean_segment(F.col("s")).alias("got")).collect():
        want = re.sub(r"\.\w+$", "", re.sub(r"[-_]+", " ", row["s"])).strip(" \t\n\r\x0b\x0c")
        assert row["got"] == want


def extract(spark, url, **options):
    frame = spark.createDataFrame([(url,)], "SOURCEURL string")
    return keywords.extract_keywords(frame, stop_words=STOPS, **options).first()["Keywords"]


@pytest.mark.parametrize("url, expected", [
    (None, []), ("", []), ("https://a.org", []), ("https://a.org/en/825", []), ("https://a.org/abcd", []),
    ("https://a.org/the-fall-of-the-house", ["fall", "house"]),
    ("https://a.org/2024/NATO-and-EU-talk-in-the-UK.html", ["nato", "eu", "talk", "uk"]),
    ("https://a.org/THE-two-100-3rd-rivers", ["the", "rivers"]),
    ("https://a.org/storm-storm-Storm-hits", ["storm", "hits"]),
    ("https://a.org/world-news/markets-rise-again-today", ["markets", "rise", "again", "today"]),
    ("https://a.org/first-title/other-title", ["other", "title"]),
    ("https://a.org/equal-score/other-title", ["equal", "score"]),
    ("https://a.org/the-and-of-in", []),
    ("https://a.org/" + "-".join(f"word{chr(97 + i)}" for i in range(14)), [f"word{chr(97 + i)}" for i in range(10)]),
])
def test_keywords_without_lexicon(spark, url, expected):
    assert extract(spark, url) == expected


def test_numbers_alone_are_acronym_free(spark):
    assert extract(spark, "https://a.org/100-2000-alpha-beta") == ["alpha", "beta"]


LEXICON = [("storms", "NOUN", "storm"), ("hit", "VERB", "hit"), ("quickly", "ADV", "quickly"), ("red", "ADJ", "red"),
           ("have", "VERB", "have")]


@pytest.fixture(scope="module")
def lexicon(spark):
    return spark.createDataFrame(LEXICON, "token string, pos string, lemma string")


def test_lexicon_gives_lemmas_tags_and_the_sentence_bonus(spark, lexicon):
    # Without the bonus the three nouns of the first segment would win.
    url = "https://a.org/alpha-beta-gamma/Storms-hit-quickly-coast"
    assert extract(spark, url, lexicon=lexicon) == ["storm", "hit", "coast"]
    assert extract(spark, "https://a.org/red-quickly-coast", lexicon=lexicon) == ["red", "coast"]


def test_lexicon_rows_keep_their_number_and_their_empty_urls(spark, lexicon):
    urls_ = ["https://a.org/storms-hit-coast"] * 50 + [None, "", "https://a.org/1"]
    frame = spark.createDataFrame(list(enumerate(urls_)), "id int, SOURCEURL string")
    doubled = lexicon.unionByName(lexicon)
    rows = keywords.extract_keywords(frame, lexicon=doubled, stop_words=STOPS).orderBy("id").collect()
    assert [r["Keywords"] for r in rows] == [["storm", "hit", "coast"]] * 50 + [[], [], []]


def test_an_empty_lexicon_equals_none(spark):
    sample = ["https://a.org/the-fall-of-the-house", "https://a.org/NATO-talks/10-2nd", "https://a.org/a,b!c-deluge",
              "https://a.org/first-title/other-title", "https://a.org/don't-stop-now", "https://a.org/caf%C3%A9-culture"]
    frame = spark.createDataFrame([(u,) for u in sample], "SOURCEURL string")
    empty = spark.createDataFrame([], "token string, pos string, lemma string")
    plain = {tuple(r) for r in keywords.extract_keywords(frame, stop_words=STOPS)
             .select("SOURCEURL", F.array_join("Keywords", "|")).collect()}
    joined = {tuple(r) for r in keywords.extract_keywords(frame, stop_words=STOPS, lexicon=empty)
              .select("SOURCEURL", F.array_join("Keywords", "|")).collect()}
    assert plain == joined


ODD_LEXICON = [*LEXICON, ("the", "PROPN", "the"), ("seven", "NOUN", "seven"), ("River", "NOUN", None), ("river", "VERB", "flow"),
               ("café", "ADJ", "Café"), ("nato", "ADV", "nato"), ("42nd", "NOUN", "42nd"), (",", "NOUN", ","), ("talk", "X", "talk"),
               ("ok", "VERB", "okay"), ("lost", None, "lose"), (None, "NOUN", "none")]


@pytest.mark.parametrize("entries", [ODD_LEXICON, LEXICON, []])
def test_dictionary_and_join_agree(spark, entries):
    lexicon = spark.createDataFrame(entries, "token string, pos string, lemma string")
    random.seed(11)
    pieces = ["Storms", "hit", "the", "of", "seven", "River", "café", "NATO", "42nd", "2024", "talk", "OK", "ok", "lost", "a,b", "don't",
              "quickly", "red", "HAVE", "İa", "x", "%20", "/", "/api", ".html", "storm", "coast!", "Σας"]
    drawn = ["https://h.org/" + "-".join(random.choices(pieces, k=random.randint(0, 12))) for _ in range(300)]
    frame = spark.createDataFrame([(u, u) for u in [None, *EDGE_URLS, *drawn]], "SOURCEURL string, table string").repartition(4)

    def found(limit):
        got = keywords.extract_keywords(frame, lexicon=lexicon, stop_words=STOPS, max_keywords=5, dictionary_bytes=limit)
        assert got.columns == ["SOURCEURL", "table", "Keywords"]
        return sorted((r["SOURCEURL"] or "", r["table"] or "", tuple(r["Keywords"])) for r in got.collect())

    looked_up = found(keywords.DICTIONARY_BYTES)
    assert looked_up == found(0) and any(words for _, _, words in looked_up)


def test_a_lexicon_is_measured_before_it_goes_to_every_task(spark, lexicon):
    entries = keywords.lexicon_entries(lexicon)
    size = sum(len(t) + len(p) + len(m) + keywords.ENTRY_BYTES for t, p, m in LEXICON)
    assert keywords.dictionary_slots(entries, size) == len(LEXICON)
    assert keywords.dictionary_slots(entries, size - 1) is None
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert keywords.dictionary_slots(entries, size) is None
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_rows_stay_where_they_are_beside_a_dictionary(spark, lexicon, tmp_path):
    spark.range(10).selectExpr("id", "'https://a.org/storms-hit-coast' as SOURCEURL").write.parquet(str(tmp_path / "r"))
    found = keywords.extract_keywords(spark.read.parquet(str(tmp_path / "r")), lexicon=lexicon, stop_words=STOPS,
                                      dictionary_bytes=keywords.DICTIONARY_BYTES)
    assert [tuple(r["Keywords"]) for r in found.collect()] == [("storm", "hit", "coast")] * 10
    # One projection right over the scan: a projection of its own would copy the dictionary into every row.
    plan = found._jdf.queryExecution().optimizedPlan()
    assert plan.nodeName() == "Project" and plan.children().head().nodeName().startswith("LogicalRelation")


def test_default_stop_words_come_from_spark(spark):
    assert {"the", "and", "of"} <= set(words.default_stop_words())
    frame = spark.createDataFrame([("https://a.org/what-the-river-says",)], "SOURCEURL string")
    assert keywords.extract_keywords(frame).first()["Keywords"] == ["river", "says"]


def ranking(spark, rows):
    return spark.createDataFrame(rows, "keyword string, n long")


def test_search_term_quotes_the_top_three(spark):
    term = keywords.search_term(ranking(spark, [("b", 2), ("a", 2), ("c", 9), ("d", 1)])).first()
    assert term["term"] == '"c" OR "a" OR "b"'
    empty = keywords.search_term(ranking(spark, [])).first()
    assert (empty["term"], empty["pattern"]) == ("*", None)
