"""Adapter: driver tables -> match documents (test and benchmark input).

One order is one match, one line item is one participant; ``part`` supplies
the champion. The field expressions are the fixture mapping (FIXTURES.md §2).
Only the columns a mapping needs are read, so the parquet scans prune.

``tables_to_documents`` nests the participants of each match; the documents are
landed as files, and everything downstream reads those.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from matchmart.schema import (
    INFO_FIELDS,
    PARTICIPANT_FIELDS,
)
from matchmart.session import delete_path, file_states, scratch_dir

# Fixed values of the fixture mapping.
INGEST_DATE_EVEN = "2026-08-16"
INGEST_DATE_ODD = "2026-08-17"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# --- match header -----------------------------------------------------------


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    cols = ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority"]
    return read_table(spark, sf_dir, "orders").select(*cols)


def _header_exprs() -> dict[str, Column]:
    key = F.col("o_orderkey")
    start_ms = F.unix_millis(F.col("o_orderdate").cast("timestamp")) + (key % 86400) * 1000
    duration = (F.lit(120) + key % 2400).cast("int")
    version = (
        F.when(key % 97 == 0, F.lit(None).cast("string"))
        .when(key % 89 == 0, F.lit("dev"))
        .otherwise(
            F.concat_ws(
                ".",
                (F.year("o_orderdate") - 1980).cast("string"),
                F.month("o_orderdate").cast("string"),
                (key % 900).cast("string"),
            )
        )
    )
    return {
        "match_id": F.concat(F.lit("M"), key.cast("string")),
        "ingest_date": F.when(key % 2 == 0, F.lit(INGEST_DATE_EVEN)).otherwise(
            F.lit(INGEST_DATE_ODD)
        ),
        "gameId": key,
        "platformId": F.concat(F.lit("P"), (F.col("o_custkey") % 4).cast("string")),
        "gameCreation": start_ms,
        "gameStartTimestamp": start_ms,
        "gameEndTimestamp": start_ms + duration.cast("bigint") * 1000,
        "gameDuration": duration,
        "gameMode": F.col("o_orderpriority"),
        "gameType": F.col("o_orderstatus"),
        "gameVersion": version,
        "mapId": F.when(key % 5 != 0, F.lit(11)).otherwise(F.lit(12)),
        "queueId": F.when(F.col("o_orderpriority") < "3", F.lit(420)).otherwise(F.lit(450)),
    }


def _teams() -> Column:
    key = F.col("o_orderkey")
    return F.array(
        F.struct(F.lit(100).alias("teamId"), (key % 2 == 0).alias("win")),
        F.struct(F.lit(200).alias("teamId"), (key % 2 == 1).alias("win")),
    )


# --- participants -----------------------------------------------------------


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_partkey",
        "l_suppkey",
        "l_linenumber",
        "l_quantity",
        "l_extendedprice",
        "l_discount",
        "l_tax",
        "l_returnflag",
        "l_linestatus",
    )


def _parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_size")


# What a participant is made of: columns of its line item and part.
PARTICIPANT_SOURCE = [
    "l_partkey",
    "l_suppkey",
    "l_linenumber",
    "l_quantity",
    "l_extendedprice",
    "l_discount",
    "l_tax",
    "l_returnflag",
    "l_linestatus",
    "p_brand",
    "p_size",
]


def _participant_exprs(row: Column) -> dict[str, Column]:
    """Fields of the participant of ``row``, a struct of ``PARTICIPANT_SOURCE``."""
    line = row["l_linenumber"]
    part = row["l_partkey"]
    supp = row["l_suppkey"]
    price = row["l_extendedprice"]
    exprs: dict[str, Column] = {
        "participantId": line.cast("int"),
        "puuid": F.when(supp % 50 == 0, F.lit("BOT")).otherwise(
            F.concat(F.lit("S"), supp.cast("string"))
        ),
        "riotIdGameName": F.concat(F.lit("player"), supp.cast("string")),
        "riotIdTagline": F.lit("EUW"),
        "teamId": F.when(line % 2 == 1, F.lit(100)).otherwise(F.lit(200)),
        "championId": (row["p_size"] % 6).cast("int"),
        "championName": row["p_brand"],
        "champLevel": (line + 1).cast("int"),
        "teamPosition": row["l_returnflag"],
        "individualPosition": row["l_linestatus"],
        "kills": row["l_quantity"].cast("int"),
        "deaths": F.round(row["l_discount"] * 100).cast("int"),
        "assists": F.round(row["l_tax"] * 100).cast("int"),
        "goldEarned": F.floor(price).cast("bigint"),
        "totalDamageDealtToChampions": F.floor(price * (1 - row["l_discount"])).cast("bigint"),
        "totalDamageTaken": (row["p_size"] * 100).cast("bigint"),
        "totalMinionsKilled": (part % 300).cast("int"),
        "neutralMinionsKilled": (part % 60).cast("int"),
        "visionScore": (supp % 80).cast("int"),
        "wardsPlaced": line.cast("int"),
        "wardsKilled": (line % 3).cast("int"),
    }
    for i in range(7):
        exprs[f"item{i}"] = (part % 7000 + i).cast("int")
    exprs["win"] = F.when(
        (row["l_returnflag"] == "R") & (line == 7), F.lit(None).cast("boolean")
    ).otherwise(row["l_returnflag"] == "A")
    exprs["gameEndedInEarlySurrender"] = (F.col("o_orderstatus") == "P") & (line == 1)
    exprs["gameEndedInSurrender"] = (F.col("o_orderstatus") == "F") & (
        row["l_linestatus"] == "F"
    )
    return exprs


# --- public -----------------------------------------------------------------


def tables_to_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested documents: ``metadata``, ``info``, ``ingest_date``.

    Participants of a match are gathered into its array (a match holds a
    handful of players; the array is the document's own content). Matches
    without line items get no participants array (missing, as in W9).
    """
    return _nested(_orders(spark, sf_dir), _lines_with_parts(spark, sf_dir))


SORTED_BYTES = 16 << 20  # of a table's file, read by one task of a bucketed copy
PART_SALTS = 8  # pieces of a part's rows, so that a popular part is no single task's


@contextmanager
def bucketed_documents(spark: SparkSession, sf_dir: str) -> Iterator[DataFrame]:
    """``tables_to_documents`` for a landing: both sides are first written as tables
    bucketed by the order's key, which are there until the context ends.

    If parts are too large to be broadcast, a bucket is a slice of the orders (or some,
    if buckets are few) and gets a copy of the parts that its lines name. To find those,
    the lines' part and slice are brought to the parts, and nothing else of a line.

    Columns of a bucket's file take a quarter of what the same rows take in a
    shuffle, and the joins and the grouping find them where they need them.
    """
    name, root = f"t_{uuid.uuid4().hex}", scratch_dir(spark, f"buckets-{uuid.uuid4().hex}")
    size = sum(size for _, size, _ in file_states(spark, f"{sf_dir.rstrip('/')}/lineitem.parquet"))
    n, sides = buckets(spark, size), []
    subset = "spark.sql.requireAllClusterKeysForCoPartition"  # a join by slice and key finds slices
    before = spark.conf.get(subset)

    def stored(rows: DataFrame, side: str, keys: list[str], order: list[str] | None = None) -> DataFrame:
        # A task sorts what it reads by bucket: small reads, that none spills.
        previous = spark.conf.get("spark.sql.files.maxPartitionBytes")
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(SORTED_BYTES))
        sides.append(side)
        try:
            (
                rows.write.format("parquet")
                .bucketBy(n, *keys)
                .sortBy(*(order or keys))  # lines of an order side by side take less space
                .option("path", f"{root}/{side}")
                .options(**packed(rows))
                .saveAsTable(f"{name}_{side}")
            )
        finally:
            spark.conf.set("spark.sql.files.maxPartitionBytes", previous)
        return spark.table(f"{name}_{side}")

    try:
        orders = _orders(spark, sf_dir)
        # Lines without a key belong to no order.
        lines = _lines(spark, sf_dir).where(F.col("l_orderkey").isNotNull())
        parts = _parts(spark, sf_dir)
        if _broadcast(parts):
            orders = stored(orders, "orders", ["o_orderkey"])
            lines = stored(_with_parts(lines, parts), "lines", ["l_orderkey"])
        else:
            spark.conf.set(subset, "false")
            numbers = slices(spark, n, -(-PART_SALTS // n))
            nth = lambda key: F.pmod(F.xxhash64(key), F.lit(len(numbers))).cast("int")
            values = F.array(*map(F.lit, numbers)).cast("array<bigint>")
            number = lambda key: F.element_at(values, nth(key) + 1)
            orders = orders.withColumn("o_slice", number("o_orderkey"))
            orders = stored(orders, "orders", ["o_slice"], ["o_slice", "o_orderkey"])
            lines = lines.withColumn("l_slice", number("l_orderkey"))
            salt = (nth("l_orderkey") % PART_SALTS).alias("l_salt")
            named = lines.where(F.col("l_partkey").isNotNull()).select("l_partkey", salt, "l_slice")
            lines = stored(lines, "lines", ["l_slice"], ["l_slice", "l_orderkey"])
            named = stored(named, "lines_by_part", ["l_partkey", "l_salt"], named.columns).distinct()
            salts = F.explode(F.sequence(F.lit(0), F.lit(PART_SALTS - 1)))
            parts = stored(parts.withColumn("p_salt", salts), "parts", ["p_partkey", "p_salt"]).hint("merge")
            on = (F.col("l_partkey") == F.col("p_partkey")) & (F.col("l_salt") == F.col("p_salt"))
            copies = named.join(parts, on).select(F.col("l_slice").alias("p_slice"), "p_partkey", "p_brand", "p_size")
            # A bucket for a task would make files of the square of their number.
            tasks = max(-(-size // SORTED_BYTES), spark.sparkContext.defaultParallelism)
            copies = stored(copies.coalesce(tasks), "parts_by_slice", ["p_slice"], ["p_slice", "p_partkey"])
            lines = _with_parts(lines, copies.hint("merge"), F.col("l_slice") == F.col("p_slice"))
        yield _nested(orders, lines.hint("merge"))
    finally:
        spark.conf.set(subset, before)
        for side in sides:
            spark.sql(f"DROP TABLE IF EXISTS {name}_{side}")
        delete_path(spark, root)


def slices(spark: SparkSession, n: int, each: int) -> list[int]:
    """Numbers (bigint) of slices: ``each`` that ``bucketBy`` puts into every one of ``n``
    buckets, so that buckets are even. (Were they dealt otherwise, only that would be lost.)"""
    dealt = spark.range(64 * n * each).select("id", F.pmod(F.hash("id"), F.lit(n)).alias("bucket"))
    firsts = dealt.groupBy("bucket").agg(F.slice(F.array_sort(F.collect_list("id")), 1, each).alias("ids"))
    return sorted(i for row in firsts.collect() for i in row["ids"])


def packed(rows: DataFrame) -> dict[str, str]:
    """Options of a Parquet write for little space: long numbers, mostly keys, as
    differences, as dictionaries of them are no smaller than they are."""
    plain = {f"parquet.enable.dictionary#{name}": "false" for name, kind in rows.dtypes if kind == "bigint"}
    return {"compression": "zstd", "parquet.writer.version": "v2", **plain}


def buckets(spark: SparkSession, size: int) -> int:
    """Buckets for line items of ``size`` bytes: 1 MB each up to the session's shuffle
    partitions, no more of them until they would hold over 8 MB."""
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(1, min(-(-size >> 20), width), -(-size >> 23))


def _broadcast(rows: DataFrame) -> bool:
    """Whether the planner broadcasts ``rows``, by its estimate and the session's threshold."""
    limit = rows.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold")
    if limit.startswith("-"):
        return False
    estimate = int(str(rows._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return estimate <= rows.sparkSession._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(limit)


def _lines_with_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _with_parts(_lines(spark, sf_dir), _parts(spark, sf_dir))


def _with_parts(lines: DataFrame, parts: DataFrame, also: Column | None = None) -> DataFrame:
    on = F.col("l_partkey") == F.col("p_partkey")
    rows = lines.join(parts, on if also is None else on & also, "left")
    return rows.select(*[c for c in ("l_slice",) if c in lines.columns], "l_orderkey", *PARTICIPANT_SOURCE)


def _nested(orders: DataFrame, lines: DataFrame) -> DataFrame:
    header = _header_exprs()
    # One left join: every order keeps its row; the group key is the order's
    # own columns, so the header needs no second join. collect_list skips the
    # NULL struct of an order without lines, which then gets no array. What is
    # gathered are the few source columns; the fields are made of them after.
    # Slices, if there are any, follow from the order's key.
    order_cols = ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority"]
    on = F.col("o_orderkey") == F.col("l_orderkey")
    if "o_slice" in orders.columns:
        order_cols, on = ["o_slice", *order_cols], (F.col("o_slice") == F.col("l_slice")) & on
    rows = orders.join(lines, on, "left")
    element = F.when(F.col("l_orderkey").isNotNull(), F.struct(*PARTICIPANT_SOURCE))
    grouped = rows.groupBy(*order_cols).agg(F.collect_list(element).alias("_l"))

    def participant(row: Column) -> Column:
        fields = _participant_exprs(row)
        return F.struct(*[fields[n].alias(n) for n, _ in PARTICIPANT_FIELDS])

    grouped = grouped.withColumn("_p", F.array_sort(F.transform("_l", participant)))
    documents = grouped.withColumn("participants", F.when(F.size("_p") > 0, F.col("_p"))).drop("_p", "_l")
    info = F.struct(
        *[header[n].alias(n) for n, _ in INFO_FIELDS],
        F.col("participants").alias("participants"),
        _teams().alias("teams"),
    )
    metadata = F.struct(
        header["match_id"].alias("matchId"),
        F.transform(F.col("participants"), lambda p: p["puuid"]).alias("participants"),
    )
    return documents.select(
        metadata.alias("metadata"),
        info.alias("info"),
        header["ingest_date"].alias("ingest_date"),
    )
