"""Session construction and shared-folder lookup."""

from __future__ import annotations

import contextlib
import contextvars
import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on: UTC wall clock, timestamp literals without zone
# (the inputs are TIMESTAMP_NTZ), and adaptive execution for runtime
# re-planning (partition coalescing, skew-join splitting, runtime broadcast of
# small shuffle outputs).
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.timestampType": "TIMESTAMP_NTZ",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the operators depend on to an existing session."""
    for k, v in REQUIRED_CONF.items():
        spark.conf.set(k, v)
    return spark


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "tallyhour", extra: dict | None = None) -> SparkSession:
    """Local session for tests and benchmarks; on a cluster use the cluster's builder
    and call :func:`configure`."""
    b = (SparkSession.builder.master(master).appName(app_name)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.driver.memory", "8g"))
    for k, v in {**REQUIRED_CONF, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    ensure_checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by the cluster for checkpoints and job-written tables.

    Read from the session. Where nothing is configured a fresh scratch folder is made in
    local mode (tests); on a cluster that is an error, as a folder of the driver's machine
    is not seen by the executors.
    """
    return ensure_checkpoint_dir(spark)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if d:
        return d
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if sc.master.split("[")[0] != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="tallyhour-ckpt-")
    sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A unique path under the shared checkpoint folder (inside :func:`run_scratch`, the run's
    folder there) for a job-written table."""
    base = _RUN_FOLDER.get() or os.path.join(checkpoint_dir(spark), "tables")
    return os.path.join(base, f"{name}-{uuid.uuid4().hex[:12]}")


_RUN_FOLDER: contextvars.ContextVar[str | None] = contextvars.ContextVar("run_folder", default=None)


@contextlib.contextmanager
def run_scratch(spark: SparkSession):
    """Scratch tables written inside the block go to one folder, which is removed at its end."""
    folder = os.path.join(checkpoint_dir(spark), "tables", f"run-{uuid.uuid4().hex[:12]}")
    token = _RUN_FOLDER.set(folder)
    try:
        yield folder
    finally:
        _RUN_FOLDER.reset(token)
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
