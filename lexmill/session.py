"""Session settings and the shared stage folder."""

from __future__ import annotations

import atexit
import importlib.util
import os
import shutil
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "lexmill", cores: str = "*", shuffle_partitions: int | None = None,
                  driver_memory: str = "16g") -> SparkSession:
    """Local session for tests and the bench. A cluster brings its own session."""
    builder = (
        SparkSession.builder.appName(app).master(f"local[{cores}]")
        .config("spark.driver.memory", driver_memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session, where driver and executors are one process, may go without:
    it gets a private folder, removed when the process ends. On a cluster an unnamed
    folder is an error, since executors would write to their own disks.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    context = spark.sparkContext
    if not context.master.startswith("local") or context.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    if context.getCheckpointDir() is None:
        folder = tempfile.mkdtemp(prefix="lexmill-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def run_dir(spark: SparkSession) -> str:
    """The folder of this run's tables below the shared folder."""
    return os.path.join(shared_dir(spark), "lexmill", spark.sparkContext.applicationId)


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path for this run."""
    return os.path.join(run_dir(spark), f"{name}-{uuid.uuid4().hex}")


def remove_staged(spark: SparkSession) -> None:
    """Delete all tables this run has staged. Call it when no result of the run is read any more."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(run_dir(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def stage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage in a way that survives lost executors, computes an expensive
    input once when several branches read it, and lets Catalyst see the true size,
    so that it broadcasts a derived table only below ``autoBroadcastJoinThreshold``.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def stage_bucketed(df: DataFrame, name: str, keys: list[str], buckets: int | None = None) -> DataFrame:
    """Write ``df`` to the shared folder, dealt and sorted by ``keys``, and read it back with that layout.

    Joins and aggregates on the keys then need no exchange, however often the table is read. Both sides of a join
    need the same number of buckets, by default the session's shuffle partitions.
    """
    spark = df.sparkSession
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    table = f"lexmill_{name}_{uuid.uuid4().hex}"
    (df.repartition(n, *keys).write.bucketBy(n, *keys).sortBy(*keys).option("path", new_path(spark, name))
     .format("parquet").saveAsTable(table))
    return spark.table(table)


def ship(spark: SparkSession) -> None:
    """Send this package to the executors once, so their Python workers can import it."""
    context = spark.sparkContext
    if getattr(context, "_lexmill_shipped", False):
        return
    top = __name__.partition(".")[0]
    root = os.path.dirname(os.path.abspath(importlib.util.find_spec(top).origin))
    path = os.path.join(tempfile.mkdtemp(prefix="lexmill-"), f"{top}.zip")
    with zipfile.ZipFile(path, "w") as out:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    out.write(full, os.path.join(top, os.path.relpath(full, root)))
    context.addPyFile(path)
    context._lexmill_shipped = True
