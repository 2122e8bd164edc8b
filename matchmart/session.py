"""Session construction and shared scratch location."""

from __future__ import annotations


import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on (W1, W2 in the design notes):
#  * ANSI mode stays on; bad text goes through try_cast, never a silent NULL.
#  * All epoch -> date/time conversions are pinned to UTC.
#  * Partition overwrite is dynamic, so a rebuild replaces only the dates it
#    produced (the reference's INSERT OVERWRITE ... PARTITION (dt)).
#  * AQE re-plans joins from runtime sizes, coalesces small shuffle partitions
#    and splits skewed join partitions.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(
    master: str | None = None,
    app_name: str = "matchmart",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Build (or reuse) a session with the warehouse defaults applied.

    ``master``/``shuffle_partitions`` are only set when given, so on a cluster
    the submit-time values win.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
        builder = builder.config("spark.ui.enabled", "false")
        builder = builder.config("spark.ui.showConsoleProgress", "false")
        if master.startswith("local"):
            # Local mode: the driver JVM is the only executor.
            builder = builder.config("spark.driver.memory", "8g")
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in {**SESSION_DEFAULTS, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    apply_defaults(spark)
    return spark


def apply_defaults(spark: SparkSession) -> None:
    """Apply the defaults, all settable at run time, to an existing session. A
    session that refuses one (ANSI, UTC) would give other results, so it raises."""
    for k, v in SESSION_DEFAULTS.items():
        spark.conf.set(k, v)


def scratch_dir(spark: SparkSession, name: str | None = None) -> str:
    """A fresh folder under the cluster's shared checkpoint location.

    The location is ``spark.checkpoint.dir`` from the session. Only when it is
    unset (local tests) is one created and registered for this session.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            # Executors cannot share a machine-local folder.
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        base = tempfile.mkdtemp(prefix="matchmart-ckpt-")
        spark.conf.set("spark.checkpoint.dir", base)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(base)
    sub = name or uuid.uuid4().hex
    return base.rstrip("/") + "/matchmart/" + sub


def shared_path(spark: SparkSession, *parts: str) -> str:
    """A stable (not per-run) path under the shared checkpoint location."""
    root = scratch_dir(spark, "shared")
    return "/".join([root, *parts])


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence test through the Hadoop FileSystem of ``path``."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(hpath))


def materialize(df, name: str = "stage"):
    """Cut lineage: write ``df`` as Parquet under the shared checkpoint folder
    and return the read-back DataFrame.

    One computation (an eager ``checkpoint()`` of an unpersisted plan runs it
    twice), and the copy lives on shared storage, so losing an executor later
    does not force recomputing the upstream plan.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, f"{name}-{uuid.uuid4().hex}")
    df.write.mode("overwrite").parquet(path)
    back = spark.read.parquet(path)
    back.materialized_at = path
    return back


def materialized(df, name: str = "stage"):
    """``df`` itself if ``materialize`` returned it, else a copy."""
    return df if hasattr(df, "materialized_at") else materialize(df, name)


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a folder of our own, if it is there."""
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hpath, True)


def discard(*frames) -> None:
    """Delete what ``materialize`` wrote, once nothing reads it any more."""
    for df in frames:
        delete_path(df.sparkSession, df.materialized_at)


def publish_folder(spark: SparkSession, staged: str, path: str) -> None:
    """Give the finished folder ``staged`` the name ``path`` in one rename. If
    ``path`` is there by now, another writer of the same was first: theirs stays."""
    jvm = spark.sparkContext._jvm
    src, dst = jvm.org.apache.hadoop.fs.Path(staged), jvm.org.apache.hadoop.fs.Path(path)
    fs = dst.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(dst) or not fs.rename(src, dst):
        if not fs.exists(dst):
            raise RuntimeError(f"could not publish {staged} as {path}")
        fs.delete(src, True)


def file_states(spark: SparkSession, path: str) -> list[tuple[str, int, int]]:
    """(name, bytes, modification time) of every file under ``path``, by the
    Hadoop FileSystem of the path, so remote tables are seen as they are."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(hpath):
        return []
    found, files = [], fs.listFiles(hpath, True)
    while files.hasNext():
        f = files.next()
        found.append((f.getPath().toString(), int(f.getLen()), int(f.getModificationTime())))
    return sorted(found)


__all__ = [
    "SESSION_DEFAULTS",
    "apply_defaults",
    "get_session",
    "path_exists",
    "scratch_dir",
    "shared_path",
]

