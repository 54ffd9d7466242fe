"""Session and shared-folder helpers.

Everything that must survive a lost executor (response waves, ranged frames,
refinement rounds) is written under ``spark.checkpoint.dir``.  On a cluster
that setting names a shared folder; we only invent one for local runs.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

#: Folder, below the checkpoint folder, of the run at hand.
_SCOPE: ContextVar[str] = ContextVar("seedwright_scope", default="")


def build_session(master: str | None = None, app: str = "seedwright",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # Prompts and chunks are long strings; keep Arrow batches moderate so
        # a completer task never holds more than a few MB of prompts.
        "spark.sql.execution.arrow.maxRecordsPerBatch": "1024",
    }
    if master and master.startswith("local"):
        # local mode: the driver JVM is the only executor
        conf["spark.driver.memory"] = os.environ.get("SEEDWRIGHT_DRIVER_MEMORY", "16g")
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and written waves.

    Uses the cluster's ``spark.checkpoint.dir``.  Only in local mode (tests,
    bench) and only when it is unset do we create one under the system temp
    folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        try:
            configured = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # noqa: BLE001 - unset key
            configured = None
    if not configured:
        if not _is_local(spark):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; point it at a shared folder")
        configured = tempfile.mkdtemp(prefix="seedwright-ckpt-")
    sc.setCheckpointDir(configured)
    return (sc.getCheckpointDir() or configured).rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder for intermediate tables, inside the current scope."""
    return f"{checkpoint_dir(spark)}{_SCOPE.get()}/{name}-{uuid.uuid4().hex[:12]}"


@contextmanager
def scratch_scope(spark: SparkSession, name: str) -> Iterator[str]:
    """Intermediate tables written inside go to one folder, which is removed
    when the block ends well; after a failure it stays, to be looked at.
    Nothing lazy that reads them may leave the block."""
    path = scratch_path(spark, name)
    token = _SCOPE.set(path[len(checkpoint_dir(spark)):])
    try:
        yield path
        remove(spark, path)
    finally:
        _SCOPE.reset(token)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder wherever Spark's file systems reach."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as parquet under the shared checkpoint folder and read it
    back: later steps prune columns, push filters and never replay it."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
