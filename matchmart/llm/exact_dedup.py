"""Exact dedup by content-defined chunk recipes (operator 8).

Two texts are equal when they are identical without the characters 0x20 and
0x09-0x0D. The normalised text is cut into chunks where its own characters say
so, so equal passages of different texts mostly give equal chunks:

1. each distinct chunk moves once, to the task of its 64-bit identifier, which
   verifies that the identifier names one chunk text; the texts of an
   identifier that names several are kept apart by ordinals;
2. a document becomes its recipe, the ordered list of verified identifiers,
   and from then on only recipes move: documents are equal when their lists are.

Built-in column functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from matchmart.llm.common import SPACE, dropped, staged, table

#: A chunk has MIN characters, then those up to the next sentence end, MAX at most.
MIN_CHUNK, MAX_CHUNK = 512, 4096
ENDS = ".!?;:。！？"


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), f"{SPACE}+", "")


def chunks(norm: Column) -> Column:
    """The chunks of a normalised text, in order; joined they are the text."""
    pattern = f"(?s).{{{MIN_CHUNK}}}[^{ENDS}]{{0,{MAX_CHUNK - MIN_CHUNK - 1}}}+[{ENDS}]?|.{{1,{MIN_CHUNK}}}"
    return F.regexp_extract_all(norm, F.lit(pattern), F.lit(0))


def identifier(chunk: Column) -> Column:
    return F.xxhash64(chunk)


def clashes(docs: DataFrame, ident=identifier) -> DataFrame:
    """(chunk_id, chunk, ordinal) of the identifiers that name several chunk
    texts. Distinct chunks are grouped by their whole text, pre-aggregated in
    each map task, so that a chunk of a third of all documents moves once a task."""
    parts = docs.select(F.explode(chunks(normalised(F.col("text")))).alias("chunk"))
    distinct = parts.select(ident(F.col("chunk")).alias("chunk_id"), "chunk").groupBy("chunk_id", "chunk").agg(
        F.count(F.lit(1)).alias("n")
    )
    several = F.expr("row_number() OVER (PARTITION BY chunk_id ORDER BY chunk)")
    many = F.expr("count(*) OVER (PARTITION BY chunk_id)")
    return (
        distinct.select("chunk_id", "chunk", several.alias("ordinal"), many.alias("k"))
        .where("k > 1")
        .select("chunk_id", "chunk", "ordinal")
    )


def recipes(docs: DataFrame, ident=identifier) -> DataFrame:
    """(doc_id, n_chars, text_sha256, recipe): one row per input row.

    Recipes hold identifiers; those that the check above found ambiguous are
    followed by the ordinal of their text.
    """
    ambiguous = staged(clashes(docs, ident), "chunk-clashes")
    norm = normalised(F.col("text"))
    base = docs.select(
        "doc_id",
        F.char_length(F.coalesce(F.col("text"), F.lit(""))).cast("long").alias("n_chars"),
        F.sha2(norm, 256).alias("text_sha256"),
        chunks(norm).alias("chunks"),
    )
    if ambiguous.isEmpty():
        dropped(ambiguous)
        return base.select(
            "doc_id", "n_chars", "text_sha256", F.transform("chunks", ident).alias("recipe")
        )
    # Per chunk text the ordinal, by a join of the ambiguous identifiers' rows alone.
    rows = base.withColumn("__row", F.monotonically_increasing_id())
    rows = staged(rows.withColumn("ids", F.transform("chunks", ident)), "recipe-rows")
    parts = rows.select("__row", F.posexplode("chunks").alias("pos", "chunk"))
    parts = parts.withColumn("chunk_id", ident(F.col("chunk"))).join(ambiguous, ["chunk_id", "chunk"])
    fixes = parts.groupBy("__row").agg(F.sort_array(F.collect_list(F.struct("pos", "ordinal"))).alias("fix"))
    return rows.join(fixes, "__row", "left").select(
        "doc_id",
        "n_chars",
        "text_sha256",
        F.when(F.col("fix").isNull(), F.col("ids"))
        .otherwise(
            F.concat(F.col("ids"), F.lit([-1]).cast("array<bigint>"), F.flatten(
                F.transform("fix", lambda f: F.array(f["pos"].cast("long"), f["ordinal"].cast("long")))
            ))
        )
        .alias("recipe"),
    )


def exact_dedup(docs: DataFrame, ident=identifier) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Of equal texts the row with the most code points in its own text, then the
    smallest doc_id, stays. Reads ``doc_id`` and ``text`` only. Null and empty
    texts, and texts of white space alone, are equal to each other; a null id
    comes after all others and is kept if its group has no other (``kept``
    compares ids null-safely); repeated rows are rows of their own, so rows
    that repeat the id that stays are all kept; an empty table gives no rows.
    """
    rows = staged(recipes(docs, ident), "recipes")
    key = F.xxhash64("recipe")
    rows = rows.withColumn("__key", key)
    groups = rows.groupBy("__key", "recipe").agg(
        F.count(F.lit(1)).alias("group_size"),
        F.max("n_chars").alias("__most"),
    )
    # The smallest id among the longest: long values only, so that both passes
    # aggregate by hash and pre-aggregate hot groups before they move.
    longest = rows.groupBy("__key", "recipe", "n_chars").agg(F.min("doc_id").alias("keep_id"))
    groups = groups.join(
        longest.withColumnRenamed("n_chars", "__most"), ["__key", "recipe", "__most"]
    ).drop("__most")
    return rows.join(groups, ["__key", "recipe"]).select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256"
    )


def keep_rows(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, with all their columns, that stay: one of each
    group of equal texts (of rows that repeat the id that stays, any one)."""
    stays = exact_dedup(docs).where("kept").select(F.col("doc_id").alias("__id"), F.col("text_sha256").alias("__sha"))
    rows = docs.withColumn("__text", F.sha2(normalised(F.col("text")), 256))
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__text") == F.col("__sha"))
    rows = rows.join(stays.distinct(), same, "left_semi")
    one = F.expr("row_number() OVER (PARTITION BY doc_id, __text ORDER BY length(text) DESC)")
    return rows.withColumn("__one", one).where("__one = 1").drop("__one", "__text")


def op8_chunk_recipe_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


ORACLE = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS cps,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm
  FROM documents),
k AS (SELECT *, first_value(doc_id) OVER (PARTITION BY norm ORDER BY cps DESC, doc_id NULLS LAST) AS keep_id,
             count(*) OVER (PARTITION BY norm) AS group_size FROM d)
SELECT doc_id, keep_id, group_size::BIGINT AS group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, text_sha256 FROM k
"""
