"""Tokens of a title segment and the rules that score and pick them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidewatch.functions import bind

TOKEN_PATTERN = r"[\p{L}\p{M}\p{N}]+(?:['’][\p{L}\p{M}]+)*|[^\s\p{L}\p{M}\p{N}]"
WORD_PATTERN = r"[\p{L}\p{M}\p{N}]"
NUMERAL_PATTERN = r"^\p{N}+(?:st|nd|rd|th)?$"
NO_WORD_PATTERN = rf"{NUMERAL_PATTERN}|^[^\p{{L}}\p{{M}}\p{{N}}]$"
BLANK_SEPARATED_PATTERN = r"^[A-Za-z0-9 ]*$"

# English number words.
NUMBER_WORDS = (
    "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen "
    "fifteen sixteen seventeen eighteen nineteen twenty thirty forty fifty sixty seventy "
    "eighty ninety hundred thousand million billion trillion quadrillion "
    "first second third fourth fifth sixth seventh eighth ninth tenth eleventh twelfth "
    "hundredth thousandth millionth billionth"
).split()

TITLE_TAGS = ("NOUN", "PROPN", "VERB")
NOUN_TAGS = ("NOUN", "PROPN")
KEYWORD_TAGS = ("NOUN", "PROPN", "ADJ", "VERB")


def default_stop_words() -> list[str]:
    """Spark's own English stop-word list."""
    from pyspark.ml.feature import StopWordsRemover

    return StopWordsRemover.loadDefaultStopWords("english")


def tokens(text: Column) -> Column:
    """Words and single punctuation marks, in order. Where only blanks separate words, a split gives the same faster."""
    split = F.filter(F.split(text, " "), lambda t: t != "")
    return F.when(text.rlike(BLANK_SEPARATED_PATTERN), split).otherwise(
        F.regexp_extract_all(text, F.lit(TOKEN_PATTERN), F.lit(0)))


def _lettered(low: Column) -> Column:
    """Begins with a letter a to z, as neither a numeral nor a punctuation mark does; spares most tokens the patterns."""
    return (low >= "a") & (low < "{")


def is_plain(low: Column) -> Column:
    """Neither a numeral in digits nor punctuation."""
    return _lettered(low) | ~low.rlike(NO_WORD_PATTERN)


def is_acronym(token: Column) -> Column:
    return (F.length(token) >= 2) & (F.upper(token) == token) & (F.lower(token) != token)


def is_noun(low: Column, stop_words: list[str]) -> Column:
    """Without a lexicon every real word but a stop word is a noun."""
    return ~low.isin([*stop_words, *NUMBER_WORDS]) & is_plain(low)


def noun_measure(tokens: Column, stop_words: list[str]) -> Column:
    """``{m, both}`` of a title: its number of meaningful tokens, and that no noun stands with a verb."""
    long = F.transform(F.filter(tokens, lambda t: F.length(t) > 2), F.lower)
    return F.struct(F.size(F.filter(long, lambda low: is_noun(low, stop_words))).alias("m"), F.lit(False).alias("both"))


def best_title(titles: Column, measure: Callable[[Column], Column]) -> Column:
    """The title with the highest score, the first of equals; null when no title has a meaningful token.

    The score is ten times the share of meaningful tokens plus twice their number, and 5 for a noun with a verb.
    ``measure`` gives ``{m, both}`` of a title's tokens. Only numbers and titles pass from step to step, because every
    step of a higher-order function copies what it returns.
    """
    measured = F.transform(titles, lambda title, i: bind(tokens(title), lambda t: F.struct(
        measure(t).alias("is"), F.size(t).alias("n"), (-i).alias("order"), title.alias("title"))))
    scored = F.transform(F.filter(measured, lambda s: s["is"]["m"] > 0), lambda s: F.struct(
        (s["is"]["m"] / s["n"] * 10 + s["is"]["m"] * 2 + F.when(s["is"]["both"], 5).otherwise(0)).alias("score"),
        s["order"].alias("order"), s["title"].alias("title")))
    return F.array_max(scored)["title"]


def _texts_in_lower_case(title: Column) -> Column:
    return F.transform(tokens(title), lambda t: F.struct(t.alias("text"), F.lower(t).alias("low")))


def noun_keywords(title: Column, stop_words: list[str], max_keywords: int) -> Column:
    """Distinct acronyms and nouns of two letters or more in order of first occurrence."""
    kept = F.filter(_texts_in_lower_case(title), lambda t: (
        (F.length(t["text"]) >= 2) & is_noun(t["low"], stop_words)) | is_acronym(t["text"]))
    return F.slice(F.array_distinct(kept["low"]), 1, max_keywords)


def dictionary_item(low: Column, tag: Column, lemma: Column, stop_words: list[str]) -> Column:
    """``{kind, keep, word}`` of a token that the lexicon, the stop words or the number words name.

    ``kind`` is 1 for a noun, 2 for another word that counts toward the title score and 0 else; ``keep`` and ``word``
    tell whether it is a keyword, and which.
    """
    plain = is_plain(low) & ~low.isin(NUMBER_WORDS)
    kind = F.when(plain & tag.isin(*NOUN_TAGS), 1).when(plain & tag.isin(*TITLE_TAGS), 2).otherwise(0)
    stop = low.isin(stop_words) if stop_words else F.lit(False)
    return F.struct(kind.alias("kind"), F.coalesce(plain & ~stop & tag.isin(*KEYWORD_TAGS), F.lit(False)).alias("keep"),
                    F.coalesce(F.lower(lemma), low).alias("word"))


def item_measure(tokens: Column, look_up: Callable[[Column], Column]) -> Column:
    """``{m, both}`` of a title by the dictionary; a word that it does not name is a noun."""
    long = F.transform(F.filter(tokens, lambda t: F.length(t) > 2), F.lower)
    kinds = F.transform(long, lambda low: F.coalesce(look_up(low)["kind"], is_plain(low).cast("int")))
    return bind(F.filter(kinds, lambda kind: kind > 0), lambda kinds: F.struct(
        F.size(kinds).alias("m"), (F.array_contains(kinds, 1) & F.array_contains(kinds, 2)).alias("both")))


def item_keywords(title: Column, look_up: Callable[[Column], Column], max_keywords: int) -> Column:
    """Distinct keywords of a title by the dictionary in order of first occurrence, at most ``max_keywords``."""
    found = F.transform(_texts_in_lower_case(title), lambda t: F.struct(
        is_acronym(t["text"]).alias("acronym"), F.length(t["text"]).alias("size"), t["low"].alias("low"),
        look_up(t["low"]).alias("item")))
    kept = F.filter(found, lambda t: t["acronym"] | (
        (t["size"] >= 2) & F.coalesce(t["item"]["keep"], is_plain(t["low"]))))
    named = F.transform(kept, lambda t: F.when(t["acronym"], t["low"]).otherwise(F.coalesce(t["item"]["word"], t["low"])))
    return F.slice(F.array_distinct(named), 1, max_keywords)


def describe(token: Column, low: Column, stop_words: list[str], tag: Column, lemma: Column) -> Column:
    """Token, as it is and in lower case, with its lexicon entry, if any, as ``{word, tag, keep}``.

    ``word`` is the keyword it gives and ``keep`` tells whether it is one. ``tag`` is the
    part of speech that counts toward the title score, null for short tokens, numbers and
    punctuation. A word without an entry is a noun unless it is a stop word.
    """
    stop = low.isin(stop_words) if stop_words else F.lit(False)
    plain = is_plain(low) & ~low.isin(NUMBER_WORDS)
    tag = F.coalesce(tag, F.when((_lettered(low) | token.rlike(WORD_PATTERN)) & ~stop, F.lit("NOUN")))
    acronym = is_acronym(token)
    tagged = F.coalesce(tag.isin(*KEYWORD_TAGS), F.lit(False))
    return F.struct(
        F.when(acronym, low).otherwise(F.lower(F.coalesce(lemma, token))).alias("word"),
        F.when((F.length(token) > 2) & plain, tag).alias("tag"),
        (acronym | ((F.length(token) >= 2) & plain & ~stop & tagged)).alias("keep"),
    )


def title_score(described: Column) -> Column:
    """Share of meaningful tokens x 10 + their number x 2 + 5 for a noun with a verb; 0 for none."""
    meaningful = F.size(F.filter(described, lambda t: t["tag"].isin(*TITLE_TAGS)))
    noun = F.exists(described, lambda t: F.coalesce(t["tag"].isin(*NOUN_TAGS), F.lit(False)))
    verb = F.exists(described, lambda t: F.coalesce(t["tag"] == "VERB", F.lit(False)))
    score = meaningful / F.size(described) * 10 + meaningful * 2 + F.when(noun & verb, 5).otherwise(0)
    return F.when(meaningful > 0, score).otherwise(F.lit(0.0))


def best_described(titles: Column) -> Column:
    """Described tokens of the title with the highest score, the first of equals; null when no title scores."""
    scored = F.transform(titles, lambda tokens, i: F.struct(
        title_score(tokens).alias("score"), (-i).alias("order"), tokens.alias("tokens")))
    return F.array_max(F.filter(scored, lambda s: s["score"] > 0))["tokens"]


def pick_keywords(described: Column, max_keywords: int) -> Column:
    """Distinct keywords in order of first occurrence, at most ``max_keywords``."""
    kept = F.transform(F.filter(described, lambda t: t["keep"]), lambda t: t["word"])
    return F.slice(F.array_distinct(kept), 1, max_keywords)
