"""Session construction and the shared scratch area."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "folioscore", master: str | None = None,
                  shuffle_partitions: int | None = None) -> SparkSession:
    """A session with adaptive execution; memory and partition counts come from the cluster."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.execution.arrow.maxBytesPerBatch", str(64 << 20))
    )
    if master:
        builder = builder.master(master).config("spark.ui.enabled", "false")
        # scanline work is heavy for its bytes: do not merge small shuffles into one local task
        builder = builder.config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
        if master.startswith("local"):  # one JVM does everything: size it, executors size themselves
            builder = builder.config("spark.driver.memory", os.environ.get("FOLIOSCORE_MEMORY", "12g"))
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a folder of its own: on a cluster a
    machine-local path would lose data with the executor that wrote it.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    fallback = spark.conf.get("spark.folioscore.scratch", None)
    if not fallback:
        fallback = tempfile.mkdtemp(prefix="run-folioscore-", dir=os.environ.get("TMPDIR", "/tmp"))
        spark.conf.set("spark.folioscore.scratch", fallback)
    return fallback


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """Cut the lineage by writing a Parquet table to the shared folder and reading it back.

    Used where a relation feeds several jobs or an iteration; the table outlives executors.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application.

    Workers then import it wherever the driver was started and whatever is installed on the nodes.
    """
    app = spark.sparkContext.applicationId
    if spark.conf.get("spark.folioscore.shipped", "") == app:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    base = os.path.dirname(root)
    archive = os.path.join(tempfile.mkdtemp(prefix="run-ship-"), "folioscore_workers.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(root):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, base))
    spark.sparkContext.addPyFile(archive)
    spark.conf.set("spark.folioscore.shipped", app)
