"""Session construction and cluster-level helpers.

Everything here is plain SparkSession configuration: UTC session time,
adaptive execution (runtime coalescing, skew-join splitting, broadcast
conversion from measured sizes), Arrow for the few pandas boundaries, and
a reliable checkpoint directory taken from the cluster configuration.
"""

from __future__ import annotations

import atexit
import os
import sys
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "recsmith") -> SparkSession:
    """Create (or reuse) a session with the settings every operator assumes.

    On a cluster ``master`` is left to spark-submit; locally it defaults to
    ``local[N]`` with shuffle partitions matched to the cores.
    """
    builder = SparkSession.builder.appName(app_name)
    if master is None and not os.environ.get("SPARK_MASTER"):
        cpus = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 8))
        master = f"local[{cpus}]"
        shuffle_partitions = shuffle_partitions or cpus
    if master:
        builder = builder.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # reliable checkpoints live on the shared file system: delete them
        # once the DataFrame that owns them is no longer referenced
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        "spark.driver.memory": os.environ.get("RECSMITH_DRIVER_MEMORY", "16g"),
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint directory, setting one only if unset.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used
    as is. Only a ``local`` master (unit tests on a laptop) may go without: it
    gets a fresh scratch folder. Elsewhere a folder of one machine would lose
    data, so a missing setting is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        configured = tempfile.mkdtemp(prefix="recsmith-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


_folders: list[tuple[SparkSession, str]] = []


def scratch_folder(spark: SparkSession) -> str:
    """New folder name under the shared checkpoint folder; removed when the
    driver ends."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/recsmith-{uuid.uuid4().hex}"
    if not _folders:
        atexit.register(_remove_folders)
    _folders.append((spark, path))
    return path


def _remove_folders() -> None:
    """Best effort: the session may already be stopped."""
    for spark, path in _folders:
        try:
            p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
        except Exception:  # noqa: BLE001  the context is gone
            return


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint (survives executor loss); never a local one."""
    ensure_checkpoint_dir(df.sparkSession)
    if os.environ.get("RECSMITH_TRACE"):
        import time
        import traceback
        t0 = time.time()
        out = df.checkpoint(eager=True)
        caller = traceback.extract_stack(limit=2)[0]
        print(f"[checkpoint] {caller.name}:{caller.lineno} {time.time() - t0:.2f}s", file=sys.stderr)
        return out
    return df.checkpoint(eager=True)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


_TIDY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def as_table(df: DataFrame, tidy: bool = False) -> DataFrame:
    """Written as Parquet in the shared folder and read back. Beside the
    lineage this ends what the optimizer knows about the plan: a checkpoint keeps
    the plan's constraints, which in a loop of long expressions grow with every
    turn until a filter takes minutes to plan. ``tidy``: the job's shuffle files
    go when it ends, not when the driver next collects garbage."""
    spark = df.sparkSession
    path = scratch_folder(spark)
    before = spark.conf.get(_TIDY, None)
    if tidy:
        spark.conf.set(_TIDY, "true")
    try:
        df.write.parquet(path)
    finally:
        if tidy:
            spark.conf.unset(_TIDY) if before is None else spark.conf.set(_TIDY, before)
    return spark.read.schema(df.schema).parquet(path)
