"""SparkSession factory and cluster-facing settings.

The engine relies on Catalyst / AQE for physical choices; this module only sets
the knobs that differ between a laptop and a large cluster:

* AQE with partition coalescing and skew-join splitting (hot keys are expected:
  one municipality / party / person may hold a large share of rows).
* session time zone UTC, so timestamps compare equal with external engines.
* ANSI mode stays on (Spark default); helpers use ``try_*`` functions.
* ``spark.checkpoint.dir`` is read from the session; a scratch folder is set
  only when the cluster did not name one (tests, local runs).
"""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "civic_spark", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the engine defaults.

    ``master`` defaults to ``local[$SPARK_CPUS or *]`` only when no master is
    configured by the launcher (spark-submit sets it on a cluster).
    """
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    elif not os.environ.get("SPARK_MASTER") and "spark.master" not in os.environ.get("PYSPARK_SUBMIT_ARGS", ""):
        builder = builder.master(f"local[{os.environ.get('SPARK_CPUS', '*')}]")
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "16g"))
    if extra:
        conf.update(extra)
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    try:
        spark.sparkContext.setLogLevel("ERROR")
    except Exception:  # noqa: BLE001 - remote (Connect) sessions have no SparkContext
        pass
    ensure_checkpoint_dir(spark)
    return spark


def size_shuffle_partitions(spark: SparkSession, input_bytes: int, target_bytes: int = 256 * 1024 ** 2,
                            minimum: int | None = None) -> int:
    """Set the initial shuffle partition count for a job reading ``input_bytes``.

    Each post-shuffle partition should hold about ``target_bytes`` (it must
    fit in an executor's execution memory); AQE then coalesces small ones.
    At 100 TB and 256 MB per partition this gives about 400,000 partitions,
    and never fewer than the cluster's cores (``minimum``)."""
    try:
        cores = spark.sparkContext.defaultParallelism
    except Exception:  # noqa: BLE001 - remote (Connect) session
        cores = 1
    n = max(minimum or cores, -(-int(input_bytes) // int(target_bytes)))
    spark.conf.set("spark.sql.shuffle.partitions", str(n))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(n))
    return n


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder.

    On a cluster ``spark.checkpoint.dir`` names a shared (HDFS / object store)
    folder and is used as is.  Only a ``local`` master may go without it
    (tests): it gets a scratch folder that is removed at exit.  Any other
    master without the setting is an error, because a folder of the driver's
    machine would be written by each executor on its own disk.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - remote (Connect) session
        sc = None
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current and sc is not None:
        current = sc.getCheckpointDir()
    if current:
        if sc is not None and not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current
    if sc is None or not is_local_master(sc.master):
        raise ValueError("spark.checkpoint.dir is unset: name a folder that all executors share")
    path = tempfile.mkdtemp(prefix="civic-ckpt-")
    atexit.register(shutil.rmtree, path, ignore_errors=True)
    spark.conf.set("spark.checkpoint.dir", path)
    sc.setCheckpointDir(path)
    return path


def is_local_master(master: str) -> bool:
    """``local`` and ``local[n]`` run in one process; ``local-cluster[...]`` does not."""
    return master == "local" or master.startswith("local[")


def cut_lineage(df: DataFrame, eager: bool = True) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder.

    Used where a long derived plan feeds several consumers (e.g. the election
    table feeding chamber, marginal-seat and turnout datasets): the checkpoint
    survives executor loss, unlike a local checkpoint or a cache.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)


def read_table(spark: SparkSession, base: str, name: str) -> DataFrame:
    """Read one parquet table ``{base}/{name}.parquet``."""
    return spark.read.parquet(f"{base.rstrip('/')}/{name}.parquet")
