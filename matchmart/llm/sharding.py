"""Sharding by a hierarchical weighted hash tree (operator 9).

Shards are the leaves of regions and racks. A row descends level by level: at
each node every child gets a draw ``-ln(u) / weight``, ``u`` a hash of the
row's key and the child's name, and the smallest draw wins. A child's weight is
the sum of its shards' weights, so shards fill in proportion to weight. A
change of weight moves rows only into or out of the subtrees whose weight
changed: draws of the other children don't depend on it. A shard count that
fills its regions grows by a new region, so one more shard takes rows only
into itself.

The law is ``key``: the row's id and the tree decide alone, with no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from matchmart.llm.common import ORDER_BITS, ranked, staged, table

SHARDS = 40
RACKS, SHARDS_PER_RACK = 4, 5  # of a region
_HEX = ORDER_BITS // 4

#: regions -> racks -> (shard number, weight)
Tree = list[list[list[tuple[int, float]]]]


def tree(shards: int, weights: dict[int, float] | None = None) -> Tree:
    """The tree of ``shards`` shards: they fill racks of 5, and racks regions
    of 4, in order. ``weights`` (1 where not given) must be positive."""
    if shards < 1:
        raise ValueError("at least one shard")
    weights = weights or {}
    if any(w <= 0 for w in weights.values()):
        raise ValueError("weights must be positive")
    leaves = [(s, float(weights.get(s, 1.0))) for s in range(shards)]
    racks = [leaves[i : i + SHARDS_PER_RACK] for i in range(0, shards, SHARDS_PER_RACK)]
    return [racks[i : i + RACKS] for i in range(0, len(racks), RACKS)]


def _winner(key: Column, parent: Column, weights: Column) -> Column:
    """The number of the child with the smallest draw; ``weights`` is an array."""

    def draw(weight: Column, j: Column) -> Column:
        name = F.concat(key, F.lit("/"), parent, F.lit("."), j.cast("string"))
        bits = F.conv(F.substring(F.md5(name), 1, _HEX), 16, 10).cast("double")
        return F.struct((-F.log((bits + 0.5) / float(1 << ORDER_BITS)) / weight).alias("d"), j.alias("j"))

    return F.array_min(F.transform(weights, draw))["j"]


def _weight(rack: list[tuple[int, float]]) -> float:
    return sum(w for _, w in rack)


def place(rows: DataFrame, key: str, shards: Tree, out: str) -> DataFrame:
    """Add ``out``: the shard of the string column ``key`` in the tree."""
    k = F.col(key)
    region, rack = F.col("__region"), F.col("__rack")
    racks = [[_weight(rack) for rack in region] for region in shards]
    leaves = [[[w for _, w in rack] for rack in region] for region in shards]
    names = [[[s for s, _ in rack] for rack in region] for region in shards]
    rows = rows.withColumn("__region", _winner(k, F.lit("root"), F.lit([sum(r) for r in racks])))
    rows = rows.withColumn("__rack", _winner(k, region.cast("string"), F.get(F.lit(racks), region)))
    shelf = F.get(F.get(F.lit(leaves), region), rack)
    leaf = _winner(k, F.concat_ws(".", region.cast("string"), rack.cast("string")), shelf)
    rows = rows.withColumn(out, F.get(F.get(F.get(F.lit(names), region), rack), leaf).cast("int"))
    return rows.drop("__region", "__rack")


def shard_documents(docs: DataFrame, shards: int = SHARDS, weights: dict[int, float] | None = None) -> DataFrame:
    """One row per input row: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    Reads ``doc_id`` and ``text`` only (other columns of any name are ignored).
    A null text counts as empty (size 16, checksum 0); null ids share the key
    "null" and so one shard; repeated rows go to one shard in slots of their
    own; an empty table gives none. ``slot`` numbers a shard's rows from 0 in
    hash order, computed over ranges so that no task holds a shard.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        "doc_id",
        (F.octet_length(text) + 16).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.coalesce(F.col("doc_id").cast("string"), F.lit("null")).alias("__key"),
    )
    rows = place(rows, "__key", tree(shards, weights), "shard")
    rows = place(rows, "__key", tree(shards + 1, weights), "grown_shard")
    by = F.conv(F.substring(F.md5(F.concat(F.col("__key"), F.lit("/slot"))), 1, _HEX), 16, 10).cast("long")
    # Written once: counting and numbering both read the rows.
    rows = staged(rows.select("doc_id", "size", "text_crc32", "shard", "grown_shard", by.alias("__by")), "shards")
    rows = ranked(rows, "shard", "__by", ["doc_id", "size", "text_crc32"], "slot")
    return rows.select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard"
    )


def op9_hash_tree_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(table(spark, sf_dir, "documents"))


def _sql_place(shards: Tree, name: str) -> str:
    """DuckDB: a chain of subqueries that descend the tree for ``rows(key, ...)``."""

    def draw(child: str, weight: float) -> str:
        bits = f"('0x' || substr(md5(key || '/' || {child}), 1, {_HEX}))::BIGINT"
        return f"-ln(({bits} + 0.5) / {1 << ORDER_BITS}.0) / {weight!r}"

    def pick(parent: str, weights: list[float]) -> str:
        return "list_min([" + ", ".join(
            f"{{'d': {draw(f"'{parent}.{j}'", w)}, 'j': {j}}}" for j, w in enumerate(weights)
        ) + "]).j"

    racks = [[_weight(rack) for rack in region] for region in shards]
    root = pick("root", [sum(r) for r in racks])
    rack = " ".join(f"WHEN {r} THEN {pick(str(r), ws)}" for r, ws in enumerate(racks))
    leaf = " ".join(
        f"WHEN {r * 1000 + k} THEN {[s for s, _ in shelf]}[1 + {pick(f'{r}.{k}', [w for _, w in shelf])}]"
        for r, region in enumerate(shards)
        for k, shelf in enumerate(region)
    )
    return (
        f"SELECT * EXCLUDE (region, rack), CASE region * 1000 + rack {leaf} END::INT AS {name} FROM ("
        f"SELECT *, CASE region {rack} END AS rack FROM (SELECT *, {root} AS region FROM prior))"
    )


def oracle() -> str:
    return f"""
WITH base AS (
  SELECT doc_id, coalesce(strlen(text), 0) + 16 AS size, coalesce(text, '') AS t,
         coalesce(doc_id::VARCHAR, 'null') AS key
  FROM documents),
steps AS (
  SELECT list_transform(range(256), lambda x: list_reduce([x] || range(8), lambda c, _:
    CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS crc),
crc AS (
  SELECT t, xor(4294967295, list_reduce([4294967295] || list_transform(
      regexp_extract_all(hex(encode(t)), '..'), lambda x: ('0x' || x)::BIGINT),
    lambda c, b: xor(c >> 8, crc[1 + (xor(c, b) & 255)]))) AS text_crc32
  FROM (SELECT DISTINCT t FROM base), steps),
one AS (WITH prior AS (SELECT * FROM base) {_sql_place(tree(SHARDS), 'shard')}),
two AS (WITH prior AS (SELECT * FROM one) {_sql_place(tree(SHARDS + 1), 'grown_shard')})
SELECT doc_id, size::BIGINT AS size, 'key' AS law, shard, grown_shard,
       row_number() OVER (PARTITION BY shard ORDER BY substr(md5(key || '/slot'), 1, {_HEX}), doc_id) - 1 AS slot,
       text_crc32
FROM two JOIN crc USING (t)
"""
