"""Keyword extraction from article URLs and the keyword ranking.

Part of speech comes from an optional lexicon ``(token, pos, lemma)`` instead of a
language model; without one every word that is no stop word counts as a noun.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.functions import bind, urls, words

# What a lexicon may take as one value that travels with every task; a larger one is joined.
DICTIONARY_BYTES = 32 << 20
# Room of an entry in that value besides its text: offsets, lengths and padding.
ENTRY_BYTES = 96


def _no_words() -> Column:
    return F.array().cast("array<string>")


def title_keywords(url: Column, stop_words: list[str], max_keywords: int = 10) -> Column:
    """Keywords of a URL without a lexicon: one expression, no shuffle."""
    stops = [w.lower() for w in stop_words]
    found = bind(_best_noun_title(url, stops), lambda title: words.noun_keywords(title, stops, max_keywords))
    return F.coalesce(found, _no_words())


def title_segment(url: Column, stop_words: list[str]) -> Column:
    """The cleaned path segment that reads most like a title, '' when there is none."""
    return F.coalesce(_best_noun_title(url, [w.lower() for w in stop_words]), F.lit(""))


def _best_noun_title(url: Column, stop_words: list[str]) -> Column:
    return words.best_title(urls.title_candidates(url), lambda tokens: words.noun_measure(tokens, stop_words))


def lexicon_entries(lexicon: DataFrame) -> DataFrame:
    """``(low, entry)``, one row per token in lower case, with the least of its entries."""
    return (
        # An entry without a part of speech says nothing that could outdo one that has it.
        lexicon.where(F.col("token").isNotNull() & F.col("pos").isNotNull())
        .select(F.lower("token").alias("low"), F.struct("pos", "lemma").alias("entry"))
        .groupBy(F.xxhash64("low").alias("_hash"), "low")
        .agg(F.min("entry").alias("entry"))
        .drop("_hash")
    )


def _slot(low: Column, slots: int) -> Column:
    return F.pmod(F.xxhash64(low), F.lit(slots)).cast("int")


def dictionary_slots(entries: DataFrame, limit: int = DICTIONARY_BYTES) -> int | None:
    """About one slot per entry, None if the entries, which this measures, take more than ``limit`` bytes.

    A session that switches broadcasts off (``spark.sql.autoBroadcastJoinThreshold`` below 0) gets None as well, because
    a dictionary goes to every task just like a broadcast.
    """
    threshold = entries.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold").lower()
    if limit <= 0 or threshold.startswith("-"):
        return None
    text = sum((F.coalesce(F.octet_length(c), F.lit(0)) for c in ("low", "entry.pos", "entry.lemma")), F.lit(ENTRY_BYTES))
    n, size = entries.agg(F.count(F.lit(1)), F.coalesce(F.sum(text.cast("long")), F.lit(0))).first()
    return max(1, n) if size <= limit else None


def dictionary(entries: DataFrame, slots: int, stop_words: list[str]) -> DataFrame:
    """One row: an array of ``slots`` maps from tokens to items, each token in the slot that its hash names.

    Stop words and number words are in it beside the lexicon's, so that one look-up tells all about a token.
    """
    spark = entries.sparkSession
    named = spark.range(1).select(F.explode(F.array(*map(F.lit, [*stop_words, *words.NUMBER_WORDS]))).alias("low"))
    listed = entries.unionByName(named, allowMissingColumns=True).groupBy("low").agg(F.min("entry").alias("entry"))
    placed = listed.select(_slot(F.col("low"), slots).alias("slot"), F.struct("low", words.dictionary_item(
        F.col("low"), F.col("entry.pos"), F.col("entry.lemma"), stop_words).alias("item")).alias("item"))
    empty = spark.range(slots).select(F.col("id").cast("int").alias("slot"))
    filled = placed.unionByName(empty, allowMissingColumns=True).groupBy("slot").agg(
        F.map_from_entries(F.collect_list("item")).alias("items"))
    # Maps cannot be compared, so they are sorted as values behind their slots.
    return filled.select("slot", F.map_entries("items").alias("items")).agg(
        F.sort_array(F.collect_list(F.struct("slot", "items"))).alias("table")).select(
        F.transform("table.items", F.map_from_entries).alias("table"))


def dictionary_keywords(url: Column, table: Column, slots: int, max_keywords: int = 10) -> Column:
    """Keywords of a URL with tags and lemmas from a dictionary: one expression, no shuffle."""
    def found(table: Column) -> Column:
        def look_up(low: Column) -> Column:
            return F.try_element_at(F.get(table, _slot(low, slots)), low)

        best = words.best_title(urls.title_candidates(url), lambda tokens: words.item_measure(tokens, look_up))
        return bind(best, lambda title: words.item_keywords(title, look_up, max_keywords))

    return F.coalesce(bind(table, found), _no_words())


def lexicon_keywords(df: DataFrame, url_col: str, entries: DataFrame, stop_words: list[str],
                     max_keywords: int = 10, out: str = "Keywords") -> DataFrame:
    """One row ``(url, keywords)`` per distinct URL that has a title, by a join of its tokens with a lexicon of any size.

    Working on distinct URLs keeps a URL that many rows share to a single unit of
    work. The lexicon join carries no hint: Catalyst broadcasts it when its measured
    size allows and otherwise sort-merges. For that case either side of a join here is
    grouped by more than the join key, so that it is shuffled once more for the join:
    AQE splits a hot token or URL only between two such shuffles.
    """
    found = (
        df.where(F.col(url_col).isNotNull())
        .select(F.xxhash64(url_col).alias("_h"), F.col(url_col).alias("_url"))
        .distinct()
        .select("_h", "_url", F.posexplode(urls.title_candidates(F.col("_url"))).alias("_seg", "_title"))
        .select("_h", "_url", "_seg", F.posexplode(words.tokens(F.col("_title"))).alias("_pos", "_token"))
        .withColumn("low", F.lower("_token"))
        .join(entries, "low", "left")
        .select(
            "_h", "_url", "_seg", "_pos",
            words.describe(F.col("_token"), F.col("low"), stop_words, F.col("entry.pos"), F.col("entry.lemma")).alias("_d"),
        )
    )
    # A group holds the tokens of one URL, so its size is bounded by the URL's length.
    grouped = found.groupBy("_h", "_url").agg(
        F.array_sort(F.collect_list(F.struct("_seg", "_pos", "_d"))).alias("all"))
    segments = F.array_distinct(F.transform("all", lambda t: t["_seg"]))
    titles = F.transform(segments, lambda seg: F.transform(
        F.filter("all", lambda t: t["_seg"] == seg), lambda t: t["_d"]))
    best = grouped.select("_url", words.best_described(titles).alias("best"))
    return best.select(
        F.col("_url").alias(url_col),
        F.coalesce(words.pick_keywords(F.col("best"), max_keywords), _no_words()).alias(out),
    )


def extract_keywords(df: DataFrame, url_col: str = "SOURCEURL", max_keywords: int = 10,
                     lexicon: DataFrame | None = None, stop_words: list[str] | None = None,
                     out: str = "Keywords", dictionary_bytes: int = 0) -> DataFrame:
    """``df`` with an array of at most ``max_keywords`` keywords; empty when a URL yields none.

    A lexicon is joined with the tokens of the distinct URLs. With ``dictionary_bytes``, say ``DICTIONARY_BYTES``, it is
    measured first, and one of at most that size becomes a dictionary in which each row looks its tokens up. Both give
    the same; the dictionary shuffles none of ``df`` but takes more processor time a row.
    """
    stops = words.default_stop_words() if stop_words is None else [w.lower() for w in stop_words]
    if lexicon is None:
        return df.withColumn(out, title_keywords(F.col(url_col), stops, max_keywords))
    entries = lexicon_entries(lexicon)
    slots = dictionary_slots(entries, dictionary_bytes)
    if slots is not None:
        # Named by a single expression, so Catalyst puts the subquery in its place and no row carries the dictionary.
        name = "_dictionary" + "_" * max(len(c) for c in [*df.columns, ""])
        keyed = df.withColumn(name, dictionary(entries, slots, stops).scalar())
        return keyed.withColumn(out, dictionary_keywords(F.col(url_col), F.col(name), slots, max_keywords)).drop(name)
    keyed = lexicon_keywords(df, url_col, entries, stops, max_keywords, out)
    # Rows without a URL go around the join, where they would all meet in one task.
    without = df.where(F.col(url_col).isNull()).withColumn(out, _no_words())
    found = df.where(F.col(url_col).isNotNull()).join(keyed, url_col, "left").withColumn(out, F.coalesce(out, _no_words()))
    return found.unionByName(without)


def rank_url_keywords(df: DataFrame, url_col: str = "SOURCEURL", **options) -> DataFrame:
    """``(keyword, n)`` over all rows, with the keywords of each distinct URL extracted once."""
    counted = df.where(F.col(url_col).isNotNull()).groupBy(F.col(url_col).alias("_url")).agg(F.count(F.lit(1)).alias("_rows"))
    listed = extract_keywords(counted, "_url", **options).select("_rows", F.explode("Keywords").alias("keyword"))
    return listed.groupBy("keyword").agg(F.sum("_rows").alias("n")).orderBy(F.desc("n"), "keyword")


def rank_keywords(df: DataFrame, keywords_col: str = "Keywords", order: Column | None = None) -> DataFrame:
    """``(keyword, n)`` by falling count, then by word.

    With ``order``, ties go by first appearance under it instead, kept as ``first_seen``.
    Counting combines before the shuffle: a keyword on every row costs one row per task.
    """
    # The inner generator would have Catalyst filter by, and so compute, the keywords twice.
    listed = df.select((F.lit(0) if order is None else order).alias("rank"),
                       F.posexplode_outer(keywords_col).alias("pos", "keyword")).where("keyword is not null")
    if order is None:
        return listed.groupBy("keyword").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "keyword")
    return (
        listed.groupBy("keyword")
        .agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("rank", "pos")).alias("first_seen"))
        .orderBy(F.desc("n"), "first_seen")
    )


def search_term(ranked: DataFrame, n: int = 3) -> DataFrame:
    """One row ``(term, pattern, plain, odd)`` from the top ``n`` of a keyword ranking.

    ``term`` is the quoted OR expression, ``*`` when there is no keyword. ``pattern``
    selects the same posts as a regular expression on whole words, null for ``*``.
    """
    order = [F.desc("n")] + [c for c in ("first_seen", "keyword") if c in ranked.columns]
    place = F.struct(F.row_number().over(Window.orderBy(*order)).alias("place"), "keyword")
    top = ranked.orderBy(*order).limit(n).select(place.alias("entry"))
    listed = top.agg(F.array_sort(F.collect_list("entry")).alias("entries"))
    words = F.col("entries.keyword")
    return listed.select(*term_columns(words), *match_columns(words))


def match_columns(words: Column) -> tuple[Column, Column]:
    """``plain``, the words of letters and digits in lower case, and ``odd``, the pattern of the others if there are any."""
    edge = F.lit(r"[^\p{L}\p{N}_]")
    plain = F.transform(F.filter(words, lambda w: ~F.rlike(w, edge)), F.lower)
    return plain.alias("plain"), term_columns(F.filter(words, lambda w: F.rlike(w, edge)))[1].alias("odd")


def term_columns(keywords: Column) -> tuple[Column, Column]:
    """``term`` and ``pattern`` of an array of search words."""
    some = F.size(keywords) > 0
    # A backslash-E within a word would end the quotation.
    quote = lambda w: F.concat(F.lit(r"\Q"), F.replace(w, F.lit(r"\E"), F.lit(r"\E\\E\Q")), F.lit(r"\E"))
    quoted = F.concat_ws(" OR ", F.transform(keywords, lambda w: F.concat(F.lit('"'), w, F.lit('"'))))
    literal = F.concat_ws("|", F.transform(keywords, quote))
    edge = r"[^\p{L}\p{N}_]"
    pattern = F.concat(F.lit(rf"(?iu)(?:^|{edge})(?:"), literal, F.lit(rf")(?:$|{edge})"))
    return (
        F.when(some, quoted).otherwise(F.lit("*")).alias("term"),
        F.when(some, pattern).alias("pattern"),
    )
