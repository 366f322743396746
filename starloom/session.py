"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def build_session(
    master: str = "local[8]",
    app_name: str = "starloom",
    shuffle_partitions: int = 8,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """A session tuned for the warehouse jobs.

    AQE stays on (runtime coalescing, skew-join splitting, broadcast conversion from
    real shuffle sizes); ANSI stays on and the dirty edges use ``try_*`` functions.
    """
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("STARLOOM_DRIVER_MEMORY", "16g"))
    )
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, making sure the context uses it.

    On a cluster the folder comes from ``spark.checkpoint.dir`` (a shared file system).
    Only when nothing is configured and the master is local (tests, a laptop) is a
    private scratch folder created.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None
    )
    if not configured:
        if sc.master != "local" and not sc.master.startswith("local["):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; point it at a shared folder "
                "(HDFS, S3, ABFS, ...) before running warehouse jobs on a cluster"
            )
        configured = tempfile.mkdtemp(prefix="starloom-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


#: Compression of staged, landed and growing Parquet folders.
CODEC = "zstd"

#: Staging folders made inside the innermost ``staging`` block.
_STAGED: ContextVar[list[str] | None] = ContextVar("staged", default=None)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for written tables."""
    base = checkpoint_dir(spark).rstrip("/")
    # one folder per call; the checkpoint dir of the context is already unique per app
    path = f"{base}/tables/{name}-{uuid.uuid4().hex[:12]}"
    staged = _STAGED.get()
    if staged is not None:
        staged.append(path)
    return path


def write_staged(df: DataFrame, path: str) -> DataFrame:
    """Write rows that later steps read again, replacing what is there, and read them back. What is
    written for one job and by it alone is packed tightly: zstandard takes about two thirds of the
    default codec's bytes."""
    df.write.mode("overwrite").option("compression", CODEC).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Of rows in buckets: the value by which they lie there.
SPREAD = "_spread"


def spread_values(spark: SparkSession, buckets: int) -> list[int]:
    """For each of 0, 1, ... ``buckets - 1`` an integer whose hash puts it in a bucket of its own:
    the numbers themselves would share some buckets and leave others empty."""
    found: dict[int, int] = {}
    first, tried = 0, 32 * buckets
    while len(found) < buckets:
        values = spark.range(first, first + tried).select(F.col("id").cast("int").alias("v"))
        for r in values.select("v", F.pmod(F.hash("v"), F.lit(buckets)).alias("b")).collect():
            found.setdefault(r.b, r.v)
        first += tried
    return [found[b] for b in range(buckets)]


def write_bucketed(df: DataFrame, key: str, buckets: int, path: str) -> DataFrame:
    """``write_staged`` in a bucket for each value 0 to ``buckets - 1`` of the column ``key``: what
    groups the rows by the column ``SPREAD``, one value for each of ``key``, reads them as they lie.
    Spark keeps buckets for tables alone, so there is one until it is read."""
    spark, table = df.sparkSession, f"staged_{uuid.uuid4().hex}"
    values = F.lit(",".join(map(str, spread_values(spark, buckets))))
    df = df.withColumn(SPREAD, F.element_at(F.split(values, ",").cast("array<int>"), F.col(key).cast("int") + 1))
    empty = spark.createDataFrame([], df.schema).write.option("path", path).option("compression", CODEC)
    empty.bucketBy(buckets, SPREAD).saveAsTable(table)
    try:
        df.write.insertInto(table)
        rows = spark.table(table)
        rows.schema  # noqa: B018 - resolve now: the files stay when the table is dropped
        return rows
    finally:
        spark.sql(f"DROP TABLE {table}")


def buckets_stay(spark: SparkSession) -> bool:
    """Whether rows grouped by ``SPREAD`` and more are read by bucket, too: settings that move them
    first are not the default."""
    settings = {"spark.sql.sources.bucketing.enabled": "true", "spark.sql.requireAllClusterKeysForDistribution": "false"}
    return all(str(spark.conf.get(k, v)).lower() == v for k, v in settings.items())


@contextmanager
def staging(spark: SparkSession) -> Iterator[None]:
    """Remove, at the end of the block, the folders that ``scratch_path`` named inside it. What the
    block returns must not read them."""
    staged: list[str] = []
    token = _STAGED.set(staged)
    try:
        yield
    finally:
        _STAGED.reset(token)
        for path in staged:
            remove_folder(spark, path)


def _file_system(spark: SparkSession, path: str):
    """Hadoop's path object and file system of ``path``."""
    there = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return there, there.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder that this library wrote, if it is there."""
    there, files = _file_system(spark, path)
    files.delete(there, True)


def create_exclusively(spark: SparkSession, path: str) -> bool:
    """Create an empty file; False where it exists already."""
    there, files = _file_system(spark, path)
    files.mkdirs(there.getParent())
    return files.createNewFile(there)
