"""Shared helpers: staged tables and reading the driver tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchmart.session import scratch_dir

#: A character between words, for Spark's and DuckDB's regular expressions.
SPACE = r"[\x20\x09-\x0D]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: one computation,
    no lineage, and a copy that outlives the executors that made it."""
    path = scratch_dir(df.sparkSession, f"llm-{name}-{uuid.uuid4().hex}")
    df.write.options(**options).parquet(path)
    back = df.sparkSession.read.schema(df.schema).parquet(path)
    back.staged_path = path  # for dropped()
    return back


def dropped(*frames: DataFrame) -> None:
    """Delete staged tables that nothing reads any more."""
    for df in frames:
        jvm = df.sparkSession._jvm
        path = jvm.org.apache.hadoop.fs.Path(df.staged_path)
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def shuffle_width(spark: SparkSession) -> int:
    """The session's shuffle partitions: what the cluster was sized with."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


#: Order values of ``ranked`` lie in [0, 2**52).
ORDER_BITS = 52


def hash_order(*names: str) -> str:
    """An order value for ``ranked``: 52 bits of a hash of the columns."""
    return f"shiftrightunsigned(xxhash64({', '.join(names)}), {64 - ORDER_BITS})"


def ranked(rows: DataFrame, key: str, by: str, ties: list[str], out: str) -> DataFrame:
    """Number the rows of each ``key`` from 0 without gaps, as ``out``, in the
    order of the spread-out value ``by`` (52 bits), then of ``ties``.

    A key may hold most of the rows, so no task sees a whole key: its rows are
    dealt to as many ranges of ``by`` as the session has shuffle partitions,
    numbered there, and moved up by the counts of the ranges before. The counts
    are one row per key and range. The numbers don't depend on how many ranges
    there are; rows equal in ``by`` and ``ties`` may swap theirs.
    """
    width = -(-(1 << ORDER_BITS) // shuffle_width(rows.sparkSession))
    order = ", ".join(f"`{c}`" for c in [by, *ties])
    dealt = rows.withColumn("__range", F.expr(f"`{by}` div {width}"))
    counts = dealt.groupBy(key, "__range").agg(F.count(F.lit(1)).alias("__n"))
    before = counts.selectExpr(
        f"`{key}`", "__range", f"sum(__n) OVER (PARTITION BY `{key}` ORDER BY __range) - __n AS __before"
    )
    numbered = dealt.selectExpr("*", f"row_number() OVER (PARTITION BY `{key}`, __range ORDER BY {order}) - 1 AS __i")
    return (
        numbered.join(before, [key, "__range"])
        .withColumn(out, (F.col("__before") + F.col("__i")).cast("long"))
        .drop("__range", "__before", "__i")
    )
