"""Session defaults and the shared working folder."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession, functions as F


def get_spark(app: str = "rtml", master: str | None = None, **conf: str) -> SparkSession:
    """Session with UTC, adaptive execution and skew-join handling; extra settings win."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.sessionWindow.merge.sessions.in.local.partition": "true",
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        "spark.ui.enabled": "false",
    }
    settings.update({k.replace("__", "."): v for k, v in conf.items()})
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    ship_package(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Folder for reliable checkpoints and written intermediates.

    The cluster names it in ``spark.checkpoint.dir``. Where that is unset, a temporary folder is made
    and remembered on the session if the master is local; on a cluster every executor would write to
    its own disk, so there it is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or \
        spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not folder:
        folder = spark.conf.get("rtml.scratch.dir", None)
    if not folder:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="rtml-")
        spark.conf.set("rtml.scratch.dir", folder)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def ship_package(spark: SparkSession) -> None:
    """Send this package to the workers, once per session, through Spark's own file service.

    Functions that run in Python workers refer to the package, which need not be installed there.
    """
    context = spark.sparkContext
    if getattr(context, "_rtml_shipped", False):
        return
    top = os.path.dirname(os.path.abspath(__file__))
    target = os.path.join(tempfile.mkdtemp(prefix="rtml-package-"), "rtml.zip")
    with zipfile.ZipFile(target, "w") as packed:
        for folder, _, names in os.walk(top):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    packed.write(path, os.path.join("rtml", os.path.relpath(path, top)))
    context.addPyFile(target)
    context._rtml_shipped = True


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, never reused path under the shared working folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def bounded(df: DataFrame, rows: int = 1_000_000) -> DataFrame:
    """Broadcast a small derived table, such as one row per class, after counting its rows.

    With more rows it is returned without a hint and Spark chooses the join.
    """
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def plan_bytes(df: DataFrame) -> int:
    """Spark's own size estimate of the optimized plan, from file sizes."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def spread(df: DataFrame) -> DataFrame:
    """Deal a small input of few files over all cores before heavy per-row work.

    Only inputs with fewer files than cores and at most one scan split per core are moved; a large
    table is already read in many splits and is returned unchanged, without a shuffle.
    """
    spark = df.sparkSession
    cores = spark.sparkContext.defaultParallelism
    plan = df._jdf.queryExecution()
    if plan.executedPlan().outputPartitioning().numPartitions() >= cores:
        return df
    split = spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    if plan_bytes(df) > cores * split or not 0 < len(df.inputFiles()) < cores:
        return df
    return df.repartition(cores)
