"""From raw documents to token digests: five operators, each on all that the one before kept.

Null texts count as empty in every stage and stay null only where no stage rewrites them; empty and very long texts,
repeated rows, null and repeated ids are documents like any other; columns that the operators do not know are carried
along under whatever name they have; an empty table gives an empty result.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidewatch.llm import bpe, decontaminate, ordered, suffixes, toxicity
from tidewatch.llm.storage import stored
from tidewatch.llm.text import settings, table

TOKENIZER = "word_bpe_49k.json"
# Repeats of 50 words are to go, and words have four letters at least on average.
REPEAT_BYTES = 200


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that a classifier learned from the labels scores as toxic; without labels all stay."""
    settings(spark)
    return toxicity.reject(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, that with the smallest id; texts without words are no duplicates."""
    settings(spark)
    return ordered.deduplicate(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without passages of ``REPEAT_BYTES`` or more that occur more than once, in one document or several.

    Every occurrence goes, so a text may come out empty; a character that loses some of its bytes goes as a whole.
    """
    settings(spark)
    return suffixes.clean(docs, length=REPEAT_BYTES)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents of which a twentieth of the words or more lies in passages of the benchmark."""
    return decontaminate.reject(docs, table(spark, sf_dir, "benchmark"))


def to_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Number and digest of each document's tokens, and of what they decode to."""
    settings(spark)
    return bpe.encode_decode(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("suffix_dedup", cut_repeats),
    ("decontamination", drop_contaminated),
    ("bpe", to_tokens),
]

# Classifier, sketches and tokenizer have no counterpart in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the whole documents table, each result written before the next reads it."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        docs = before = stored(stage(spark, docs, sf_dir), name, replaces=before)
    return docs
