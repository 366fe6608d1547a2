"""One query per operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.llm import (
    blocks, bpe, decontaminate, interaction, language, manifest, ordered, packing, records, suffixes, toxicity, vectors, warc,
)
from tidewatch.llm.storage import shared_folder
from tidewatch.llm.text import table

# A passage of over 50 words has at least so many bytes: with four letters a word and the spaces between, 254.
PASSAGE = 240

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
ORACLE["op7_warc"] = """
    select page_id, payload_bytes, payload_digest,
           case when holder is not null and page_id <> holder then 'revisit' else 'response' end as record_type,
           case when page_id <> holder then holder end as refers_to
    from (
        select page_id, strlen(payload) as payload_bytes, sha1(payload) as payload_digest,
               case when strlen(payload) >= 1000 then max(page_id) over (partition by payload) end as holder
        from (select page_id, coalesce(html, '') as payload from pages)
    )
"""

ORACLE["op12_manifest"] = """
    with recursive
    fields as (
        select doc_id, lang, n_chars, crc,
               case when doc_id is null then '-' else strlen(doc_id::varchar)::varchar || ':' || doc_id::varchar end ||
               case when source is null then '-' else strlen(source)::varchar || ':' || source end ||
               case when lang is null then '-' else strlen(lang)::varchar || ':' || lang end as head,
               case when text is null then '-' else strlen(text)::varchar || ':' || text end as tail
        from (
            select *, xor(list_reduce(
                list_prepend(4294967295::bigint, list_transform(string_split(doc_id::varchar, ''), lambda x: ascii(x)::bigint)),
                lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0],
                                         lambda r, z: xor(r >> 1, 3988292384 * (r & 1)))), 4294967295) as crc
            from documents
        )
    ),
    leaves as (
        select doc_id, lang, leaf, coalesce(changed, leaf) as now,
               row_number() over (partition by lang order by doc_id nulls first, leaf) - 1 as pos, count(*) over (partition by lang) as n
        from (
            select doc_id, lang,
                   sha256(head || case when n_chars is null then '-' else strlen(n_chars::varchar)::varchar || ':' || n_chars::varchar end || tail) as leaf,
                   case when crc % 7 = 0 and n_chars is not null then
                       sha256(head || strlen((n_chars + 1)::varchar)::varchar || ':' || (n_chars + 1)::varchar || tail) end as changed
            from fields
        )
    ),
    tree as (
        select lang, 0 as level, pos, leaf as digest, n from leaves
        union all
        select lang, level + 1, pos // 2, sha256(string_agg(digest, '' order by pos)), max((n + 1) // 2)
        from tree where n > 1 group by lang, level, pos // 2
    ),
    subroots as (
        select lang, digest, row_number() over (order by lang nulls first) - 1 as pos, count(*) over () as n
        from (select distinct lang, digest from tree where n = 1)
    ),
    crown as (
        select 0 as level, pos, digest, n from subroots
        union all
        select level + 1, pos // 2, sha256(string_agg(digest, '' order by pos)), max((n + 1) // 2)
        from crown where n > 1 group by level, pos // 2
    ),
    climb as (
        select l.doc_id, l.lang, l.leaf, l.now as acc, '' as seen, l.pos as own, l.pos, l.n, 0 as level from leaves l
        union all
        select c.doc_id, c.lang, c.leaf,
               sha256(case when t.digest is null then acc when c.pos % 2 = 0 then acc || t.digest else t.digest || acc end),
               seen || coalesce(t.digest, ''), own, c.pos // 2, (c.n + 1) // 2, c.level + 1
        from climb c left join tree t
          on t.lang is not distinct from c.lang and t.level = c.level and t.pos = xor(c.pos, 1)
        where c.n > 1
    ),
    rise as (
        select c.doc_id, c.lang, c.leaf, s.digest as subroot, c.acc, c.seen, c.own, s.pos, s.n, 0 as level
        from climb c join subroots s on s.lang is not distinct from c.lang where c.n = 1
        union all
        select r.doc_id, r.lang, r.leaf, r.subroot,
               sha256(case when t.digest is null then acc when r.pos % 2 = 0 then acc || t.digest else t.digest || acc end),
               seen || coalesce(t.digest, ''), own, r.pos // 2, (r.n + 1) // 2, r.level + 1
        from rise r left join crown t on t.level = r.level and t.pos = xor(r.pos, 1)
        where r.n > 1
    )
    select r.doc_id, r.leaf, r.subroot, c.digest as root, sha256(r.seen) as proof_sha256, r.acc as folded_root, r.acc = c.digest as verified
    from rise r cross join (select digest from crown where n = 1) c where r.n = 1
"""
ORACLE["op13_filter_interactions"] = """
    with known as (
        select doc_id, max((quality = 1)::int) as good, max((toxic = 1)::int) as toxic from labels group by doc_id
    ),
    judged as (
        select coalesce(lang, '') as part, coalesce(good, 0) as good, coalesce(toxic, 0) as toxic,
               [len(words) < 200, 100 * len(list_distinct(words)) < 50 * len(words),
                100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 3 * length(text),
                regexp_matches(text, '[#$%&*|]'), coalesce(doc_id > first_id, false)] as fails
        from (
            select d.doc_id, lang, coalesce(text, '') as text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as words,
                   min(d.doc_id) over (partition by coalesce(text, '')) as first_id, good, toxic
            from documents d left join known using (doc_id)
        )
    ),
    masks as (
        select part, fails, count(*) as docs, sum(good) as good, sum(toxic) as toxic from judged group by part, fails
    ),
    letters as (select unnest(range(1, 6)) as i),
    orders as (
        select [a.i, b.i, c.i, d.i, e.i] as o from letters a, letters b, letters c, letters d, letters e
        where a.i not in (b.i, c.i, d.i, e.i) and b.i not in (c.i, d.i, e.i) and c.i not in (d.i, e.i) and d.i <> e.i
    ),
    told as (
        select part, array_to_string(list_transform(o, lambda x: substr('ABCDE', x, 1)), '') as filter_order, k.i as step, o[k.i] as letter,
               sum(case when before = 0 and not own then docs else 0 end) as kept,
               sum(case when before = 0 and own then docs else 0 end) as removed,
               sum(case when before > 0 and own then docs else 0 end) as redundant,
               sum(case when own and every = 1 then docs else 0 end) as unique_fails,
               sum(case when before = 0 and own then good else 0 end) as good_lost,
               sum(case when before = 0 and own then toxic else 0 end) as toxic_lost
        from (
            select *, fails[o[k.i]] as own, len(list_filter(o[1:k.i - 1], lambda x: fails[x])) as before,
                   len(list_filter(fails, lambda x: x)) as every
            from masks cross join orders cross join letters k
        ) as k
        group by part, o, k.i
    )
    select part, filter_order, step::int as step, kept::bigint as kept, removed::bigint as removed, redundant::bigint as redundant,
           unique_fails::bigint as unique_fails, good_lost::bigint as good_lost, toxic_lost::bigint as toxic_lost,
           (sum(removed) over (partition by part, letter))::bigint as shapley
    from told
"""


def query(function):
    QUERIES[function.__name__] = function
    return function


@query
def op1_token_records(spark: SparkSession, folder: str) -> DataFrame:
    target = shared_folder(spark, "records")
    records.write_documents(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"), target)
    return records.read(spark, target).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query
def op2_vectors(spark: SparkSession, folder: str) -> DataFrame:
    return vectors.near_duplicates(table(spark, folder, "embeddings"))


@query
def op3_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return suffixes.remove_repeats(table(spark, folder, "documents"), keep_text=True, shorter=PASSAGE)


@query
def op4_block_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return blocks.remove_repeats(table(spark, folder, "documents"))


@query
def op5_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query
def op6_ordered_minhash(spark: SparkSession, folder: str) -> DataFrame:
    return ordered.near_duplicates(table(spark, folder, "documents"))


@query
def op7_warc(spark: SparkSession, folder: str) -> DataFrame:
    target = shared_folder(spark, "warc")
    warc.write_pages(table(spark, folder, "pages"), target)
    # A revisit has its digest and size in its headers; those of a response are taken from what was read.
    return warc.read(spark, target).select(
        "page_id", F.coalesce(F.octet_length("payload").cast("long"), "payload_bytes").alias("payload_bytes"),
        F.coalesce(F.sha1("payload"), "payload_digest").alias("payload_digest"), "record_type", "refers_to")


@query
def op8_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.encode_decode(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query
def op9_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return language.identify(docs, language.fit(docs))


@query
def op10_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, folder, "labels")))


@query
def op11_packing(spark: SparkSession, folder: str) -> DataFrame:
    cut = packing.pieces(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return packing.assign(cut.withColumn("ids_crc32", F.crc32("ids")).drop("ids")).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


@query
def op12_manifest(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "source", "lang", F.col("n_chars").cast("long").alias("n_chars"), "text")
    tampered = (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0) & F.col("n_chars").isNotNull()
    rows = docs.select(
        "doc_id", "lang", manifest.leaf(*(F.col(c) for c in docs.columns)).alias("leaf"),
        F.when(tampered, manifest.leaf(F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars") + 1, F.col("text"))).alias("changed"))
    made = manifest.manifest(rows, group="lang", key="doc_id", digest="leaf")
    now = F.coalesce("row.changed", "digest")
    return made.select(
        "row.doc_id", F.col("digest").alias("leaf"), "subroot", "root",
        F.sha2(manifest.siblings_of(F.col("path")), 256).alias("proof_sha256"),
        manifest.folded(now, F.col("path")).alias("folded_root")).withColumn("verified", F.col("folded_root") == F.col("root"))


@query
def op13_filter_interactions(spark: SparkSession, folder: str) -> DataFrame:
    return interaction.audit(interaction.cells(table(spark, folder, "documents"), table(spark, folder, "labels")))
