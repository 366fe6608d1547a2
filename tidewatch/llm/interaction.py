"""Audit of how filters interact: what each removes, at each place in each order of them.

Each document becomes a mask, a bit for each filter that it fails, and the documents of a part become at most 32 cells, one
for each mask, with their numbers. A recursive query extends prefixes of filters by each letter not yet used, for every
mask; it carries the bits applied so far, so each level tells what its step does to a cell: kept, removed, or removed
earlier. The recursion sees masks, not documents or parts: 32 times 326 rows, whatever the data. Cells of all parts then
meet these rows by their mask.

A text is a copy if a smaller id has the same text, by SHA-256 of its bytes. Null texts are empty; a null id is neither
smaller nor larger than another; of rows that repeat the smallest id of a text none is a copy. Labels of one id are taken
together: quality 1 or toxic 1 if any of its rows says so, and those of a null id belong to no document. Null languages are
the part of the empty text. An empty table gives no rows. Other columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.llm.storage import stored

LETTERS = "ABCDE"
WORD = r"[^\x20\x09-\x0D]+"

RECURSION = """
    with recursive steps(prefix, step, letter, bits, mask, kept, removed, redundant, unique_fails) as (
        select '', 0, '', 0, mask, true, false, false, false from (select explode(sequence(0, {masks} - 1)) as mask)
        union all
        select concat(s.prefix, f.letter), s.step + 1, f.letter, s.bits | f.bit, s.mask,
               s.mask & (s.bits | f.bit) = 0,
               s.mask & s.bits = 0 and s.mask & f.bit <> 0,
               s.mask & s.bits <> 0 and s.mask & f.bit <> 0,
               s.mask = f.bit
        from steps s join (values {unused}) f(applied, letter, bit) on s.bits = f.applied
    )
    select * from steps where step > 0
"""


def failures(text: Column) -> dict[str, Column]:
    """What fails each filter that looks at a text alone."""
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    capitals = F.length(text) - F.length(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    return {
        "A": F.size(words) < 200,
        "B": 100 * F.size(F.array_distinct(words)).cast("long") < 50 * F.size(words).cast("long"),
        "C": 100 * capitals.cast("long") > 3 * F.length(text).cast("long"),
        "D": F.rlike(text, F.lit(r"[#$%&*|]")),
    }


def masks(docs: DataFrame, letters: str = LETTERS) -> DataFrame:
    """``doc_id, part, mask`` for every document; the last letter stands for copies of a text with a smaller id."""
    text = F.coalesce("text", F.lit(""))
    fails = failures(text)
    mask = sum((F.when(fails[x], 1 << i).otherwise(0) for i, x in enumerate(letters[:-1])), F.lit(0))
    own = stored(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("lang", F.lit("")).alias("part"),
                             F.unhex(F.sha2(text, 256)).alias("digest"), mask.alias("own")), "masks")
    # Ids are as even a key as there is; only null ones meet nobody and are spread by where they are read.
    spread = F.when(F.col("doc_id").isNull(), F.spark_partition_id() + 1).otherwise(0)
    first = own.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).select("digest", "doc_id", F.lit(0).alias("spread"), F.lit(True).alias("first"))
    return (own.withColumn("spread", spread).join(first, ["doc_id", "digest", "spread"], "left")
            .select("doc_id", "part", "spread", (F.col("own") + F.when(
                F.col("doc_id").isNotNull() & F.col("first").isNull(), 1 << len(letters) - 1).otherwise(0)).alias("mask")))


def cells(docs: DataFrame, labels: DataFrame, letters: str = LETTERS) -> DataFrame:
    """``part, mask, docs, good, toxic``: how many documents fail exactly the filters of each mask."""
    known = (labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("doc_id"))
             .agg(F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
             .withColumn("spread", F.lit(0)))
    rows = masks(docs, letters).join(known, ["doc_id", "spread"], "left")
    return rows.groupBy("part", "mask").agg(
        F.count(F.lit(1)).alias("docs"), F.coalesce(F.sum("good"), F.lit(0)).alias("good"),
        F.coalesce(F.sum("toxic"), F.lit(0)).alias("toxic"))


def steps(spark: SparkSession, letters: str = LETTERS) -> DataFrame:
    """What every prefix of filters does, in its last step, to the documents of every mask."""
    unused = ", ".join(f"({applied}, '{x}', {1 << i})" for applied in range(1 << len(letters))
                       for i, x in enumerate(letters) if not applied >> i & 1)
    return spark.sql(RECURSION.format(masks=1 << len(letters), unused=unused))


def audit(cells: DataFrame, letters: str = LETTERS) -> DataFrame:
    """One row per part, order of all filters and step, with what that step keeps, removes and finds removed.

    The rows of ``steps`` are bounded by the number of filters alone, so they go to every task.
    """
    spark = cells.sparkSession
    table = stored(steps(spark, letters), "steps")
    told = {name: F.sum(F.when(F.col(flag), F.col(number)).otherwise(0)).alias(name) for name, flag, number in (
        ("kept", "kept", "docs"), ("removed", "removed", "docs"), ("redundant", "redundant", "docs"),
        ("unique_fails", "unique_fails", "docs"), ("good_lost", "removed", "good"), ("toxic_lost", "removed", "toxic"))}
    by_prefix = stored(cells.join(F.broadcast(table), "mask").groupBy("part", "prefix", "step", "letter").agg(*told.values()), "prefixes")
    # So many orders begin with a prefix.
    orders = F.factorial(F.lit(len(letters)) - F.col("step"))
    shapley = by_prefix.groupBy("part", "letter").agg(F.sum(F.col("removed") * orders).alias("shapley"))
    complete = (table.where((F.col("step") == len(letters)) & (F.col("mask") == 0))
                .select(F.col("prefix").alias("filter_order"), F.explode(F.sequence(F.lit(1), F.lit(len(letters)))).alias("length"))
                .withColumn("prefix", F.expr("substring(filter_order, 1, length)")))
    return (by_prefix.join(shapley, ["part", "letter"]).join(F.broadcast(complete.drop("length")), "prefix")
            .select("part", "filter_order", "step", *told, "shapley"))
