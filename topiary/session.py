"""Session construction and the shared scratch location.

On a cluster the caller owns the session; ``get_session`` only fills in
settings that are unset. Intermediate tables go under the checkpoint
directory the cluster names (``spark.checkpoint.dir``), never under a
machine-local temporary folder: without that setting a cluster session is
refused, and only a ``local`` master (tests, a laptop), whose driver is its one
executor, gets a private directory.
"""

from __future__ import annotations

import gc
import os
import tempfile
import uuid

from pyspark.sql import SparkSession

_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app: str = "topiary", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in _DEFAULTS.items():
        builder = builder.config(k, v)
    if master and master.startswith("local"):
        # local mode: the driver JVM is the executor too
        builder = builder.config("spark.driver.memory", "12g")
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The cluster's checkpoint directory; raises if a cluster names none."""
    sc = spark.sparkContext
    current = sc._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="topiary-ckpt-")
    sc.setCheckpointDir(configured)
    return sc._jsc.sc().getCheckpointDir().get()


def frozen(df):
    """The rows as written once to the checkpoint directory (reliable: it
    survives lost executors, and later reads do not recompute)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh path below the checkpoint directory for a written table."""
    base = checkpoint_dir(spark)
    return os.path.join(base, "topiary", f"{name}-{uuid.uuid4().hex[:12]}")


def stored(df, name: str, schema=None):
    """The rows as written once to a parquet table below the checkpoint directory: for
    wide rows, whose checkpoint (uncompressed) would be larger than the input. zstd, as
    such a table stays for the rest of the job. ``schema``: types to read it back with."""
    path = work_dir(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(schema or df.schema).parquet(path)


#: Bytes of rows that an Arrow batch takes to a Python task, and so what such a task holds besides its own work.
BATCH_BYTES = 2 << 20
_BATCH_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of the session end at BATCH_BYTES, unless the caller set a size.

    Spark's own bounds are 10 000 rows and 64 MB, so a batch of whole texts is as
    large as a task's input, and JVM and Python hold several copies of it. No
    operator's rows depend on where batches end. The setting stays: the last job of
    an operator is the caller's."""
    if _BATCH_CONF not in spark.conf.getAll:
        spark.conf.set(_BATCH_CONF, str(BATCH_BYTES))


def collect_garbage(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of finished jobs: it does so once the driver's
    garbage collector finds them unused, which a long loop of jobs should not wait for."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()
