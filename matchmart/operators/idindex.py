"""Stored index of landed ids: which of a batch's ids are landed, without
reading what is landed (R1, R7, J4).

Two Parquet tables under one root, both partitioned by ``bucket`` (a hash of the
id) and ``batch``:

* ``ids``: the ids themselves;
* ``bloom``: Bloom filters as bitmaps of 4 KB, each for one of the ``blocks`` a
  bucket is divided into; a batch adds bitmaps of its own, reads take the OR.

``landed`` first asks the Bloom filters of the buckets that the given ids fall
into; only ids that may be there are looked up, in the ids of their buckets
alone. A block is sized for some 3,000 ids (one in a hundred absent ids then
passes the filter); beyond that more ids are looked up, the answer is as exact.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from matchmart.session import discard, materialize, path_exists

_BITS = 15  # a bitmap has 2**15 bits
_HASHES = 4  # bits an id sets


@dataclass(frozen=True)
class IdIndex:
    """``buckets`` and ``blocks`` are fixed when the index is begun; buckets x
    blocks x 3,000 is the number of ids that it expects."""

    root: str
    buckets: int = 64
    blocks: int = 64
    key: str = "match_id"

    def exists(self, spark: SparkSession) -> bool:
        return path_exists(spark, f"{self.root}/ids")

    # --- hashing -------------------------------------------------------------

    def _keyed(self, ids: DataFrame) -> DataFrame:
        """Distinct non-empty ids with their bucket, block and bit positions."""
        k = F.col(self.key)
        place, bits = F.xxhash64(k), F.xxhash64(k, F.lit("bits"))
        mask = (1 << _BITS) - 1
        positions = [F.shiftrightunsigned(bits, i * _BITS).bitwiseAND(F.lit(mask)) for i in range(_HASHES)]
        return (
            ids.where(k.isNotNull() & (k != ""))
            .select(self.key)
            .distinct()
            .select(
                self.key,
                F.pmod(place, F.lit(self.buckets)).cast("int").alias("bucket"),
                F.pmod(F.shiftrightunsigned(place, 32), F.lit(self.blocks)).cast("int").alias("block"),
                F.array(*positions).alias("positions"),
            )
        )

    @staticmethod
    def _all_set(bits: str, positions: str) -> Column:
        byte = f"CAST(conv(hex(substring({bits}, CAST(p div 8 AS INT) + 1, 1)), 16, 10) AS INT)"
        return F.expr(f"forall({positions}, p -> (shiftright({byte}, CAST(p % 8 AS INT)) & 1) = 1)")

    # --- writing -------------------------------------------------------------

    def add(self, ids: DataFrame, batch: str) -> None:
        """Add the ids of a batch. Adding a batch again replaces its own ids, so a
        run that is repeated leaves the same index."""
        keyed = materialize(self._keyed(ids), "index-ids")
        try:
            bloom = (
                keyed.select("bucket", "block", F.explode("positions").alias("p"))
                .groupBy("bucket", "block")
                .agg(F.bitmap_construct_agg("p").alias("bits"))
            )
            # Filters first: an id that is stored but not in its filter would
            # not be found.
            self._write(bloom, "bloom", batch)
            self._write(keyed.select("bucket", self.key), "ids", batch)
        finally:
            discard(keyed)

    def _write(self, rows: DataFrame, table: str, batch: str) -> None:
        # One file a bucket and batch.
        rows = rows.withColumn("batch", F.lit(batch)).repartition("bucket")
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket", "batch").parquet(
            f"{self.root}/{table}"
        )

    # --- reading -------------------------------------------------------------

    def _table(self, spark: SparkSession, table: str, schema: str, buckets: list[int]) -> DataFrame:
        rows = spark.read.schema(f"{schema}, bucket int, batch string").parquet(f"{self.root}/{table}")
        return rows.where(F.col("bucket").isin(buckets))

    def maybe_landed(self, ids: DataFrame) -> DataFrame:
        """(id, bucket) of the distinct ids that their Bloom filters hold: all that
        are landed, and some that aren't. Reads the filters of their buckets."""
        spark = ids.sparkSession
        keyed = self._keyed(ids)
        touched = sorted(r["bucket"] for r in keyed.select("bucket").distinct().collect())  # self.buckets at most
        filters = (
            self._table(spark, "bloom", "block int, bits binary", touched)
            .groupBy("bucket", "block")
            .agg(F.bitmap_or_agg("bits").alias("bits"))
        )
        found = keyed.join(filters, ["bucket", "block"]).where(self._all_set("bits", "positions"))
        return found.select(self.key, "bucket")

    def landed(self, ids: DataFrame) -> DataFrame:
        """The distinct ids of ``ids`` that are in the index. The result is staged
        under the shared folder (``materialized_at``; see ``discard``)."""
        spark = ids.sparkSession
        if not self.exists(spark):
            return materialize(ids.select(self.key).limit(0), "index-landed")
        own = materialize(ids.select(self.key).distinct(), "index-asked")
        maybe = materialize(self.maybe_landed(own), "index-maybe")
        try:
            touched = sorted(r["bucket"] for r in maybe.select("bucket").distinct().collect())
            stored = self._table(spark, "ids", f"`{self.key}` string", touched).select("bucket", self.key)
            return materialize(maybe.join(stored, ["bucket", self.key], "left_semi").select(self.key), "index-landed")
        finally:
            discard(own, maybe)
