"""Session helpers.

The library never invents a cluster location: lineage is cut with
``DataFrame.checkpoint()`` into the folder named by ``spark.checkpoint.dir``.
Only when that setting is absent (local runs, tests) do we create one.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark import SparkConf
from pyspark.sql import SparkSession

_LOCAL_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "lakesmith", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session.

    What spark-submit or a running session has set stays: a master is chosen
    only where none is configured (``local[$BENCH_CPUS]``, with room for its
    driver), and shuffle partitions only where the caller asks.
    """
    given = SparkConf()  # reads the properties that spark-submit passes on
    builder = SparkSession.builder.appName(app_name)
    conf = {k: v for k, v in _LOCAL_DEFAULTS.items() if not given.contains(k)}
    if master or not given.contains("spark.master"):
        builder = builder.master(master or f"local[{os.environ.get('BENCH_CPUS', '8')}]")
        if not given.contains("spark.driver.memory"):
            conf["spark.driver.memory"] = os.environ.get("LAKESMITH_DRIVER_MEMORY", "16g")
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    for k, v in (conf | (extra or {})).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    if is_local(spark):
        ensure_checkpoint_dir(spark)
    return spark


def is_local(spark: SparkSession) -> bool:
    """One process runs everything, so its own folders are seen by all tasks."""
    return spark.sparkContext.master.split("[")[0] == "local"


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The folder for intermediate data that all executors share.

    It is the one named by ``spark.checkpoint.dir``.  Where that is not set, a
    temporary folder serves a local session; on a cluster it would be another
    folder on every machine, so there the setting is required.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not configured:
        if not is_local(spark):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="lakesmith-ckpt-")
        if _settable(spark):
            spark.conf.set("spark.checkpoint.dir", configured)
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, kind: str) -> str:
    """A fresh folder for intermediate rows under the shared checkpoint folder."""
    return os.path.join(ensure_checkpoint_dir(spark), f"lakesmith-{kind}", uuid.uuid4().hex)


def discard_at_exit(spark: SparkSession, path: str) -> None:
    """Have the file system delete a written scratch folder when the application
    ends; until then plans that read it stay valid."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(target)


def _settable(spark: SparkSession) -> bool:
    try:
        return spark.conf.isModifiable("spark.checkpoint.dir")
    except Exception:  # pragma: no cover - older APIs
        return False
