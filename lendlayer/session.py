"""Session helpers: a local session for tests and benches, and the shared scratch folder.

On a cluster the session comes from the platform; nothing here overrides its settings.
Scratch data (round trips, staged overwrites, checkpoints) always lives below the
folder the cluster names in ``spark.checkpoint.dir``; only when that is unset (a bare
local session, as in tests) is it a folder in the warehouse. No machine-local temporary
folder is ever used: on a cluster whose warehouse is one, the missing setting is an error.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import SparkSession

# Settings that matter at scale: AQE re-plans joins from runtime sizes (broadcast
# only below the threshold, skewed partitions split), coalesces small partitions.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}

# Whole texts cross to Python: a batch is held outside the heap by the JVM, and again by the worker. Spark's own
# bound (64 MB), times the tasks and Python steps of an executor, is more than their work needs.
ARROW_BYTES, ARROW_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch", "4m"

_PACKAGE_ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "lendlayer") -> SparkSession:
    """A local session for tests and benches (UI off, AQE on)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("LENDLAYER_DRIVER_MEMORY", "16g"))
    )
    for key, value in SCALE_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ready(spark: SparkSession) -> SparkSession:
    """Let this session's Python workers import the package where it lies at the same path.

    They also get their rows in batches of :data:`ARROW_BATCH` bytes, unless the platform says how many.
    """
    if spark.conf.get(ARROW_BYTES, None) is None:
        spark.conf.set(ARROW_BYTES, ARROW_BATCH)
    env = spark.sparkContext.environment
    if _PACKAGE_ROOT not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (_PACKAGE_ROOT, env.get("PYTHONPATH")) if x)
    return spark


def on_one_machine(master: str) -> bool:
    return master == "local" or master.startswith(("local[", "local-cluster["))


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the session; set one only if none is set."""
    sc = spark.sparkContext
    root = sc.getCheckpointDir()
    if not root:
        root = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not root:
        # the warehouse is the one other folder that all machines of a cluster share, if it is not on a machine's disk
        warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
        if not on_one_machine(sc.master) and (":" not in warehouse or warehouse.startswith("file:")):
            raise RuntimeError(f"set spark.checkpoint.dir to a folder that all machines share; the warehouse {warehouse} is local")
        sc.setCheckpointDir(f"{warehouse}/_checkpoints")
        root = sc.getCheckpointDir()
    return root.rstrip("/")


def scratch_path(spark: SparkSession, tag: str) -> str:
    """A fresh, unique folder path under the shared checkpoint root (not created)."""
    return f"{checkpoint_root(spark)}/lendlayer/{tag}-{uuid.uuid4().hex[:12]}"
