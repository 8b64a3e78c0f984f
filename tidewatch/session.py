"""SparkSession construction and the two session settings that results depend on.

Sizing (executors, broadcast threshold, shuffle partitions, split sizes) belongs to the
submitter and is never overwritten.  Adaptive execution is on by default in Spark.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# UTC day buckets and "the last duplicate key wins" in key/value logs.
ENGINE_CONF: dict[str, str] = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
}


def apply_engine_conf(spark: SparkSession) -> SparkSession:
    """Set what results depend on; a session that refuses it is an error."""
    for k, v in ENGINE_CONF.items():
        spark.conf.set(k, v)
    return spark


def get_session(master: str | None = None, app: str = "tidewatch",
                shuffle_partitions: int | None = None) -> SparkSession:
    """Build (or reuse) a session with the engine settings applied."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in ENGINE_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if master and master.startswith("local"):
        # single-JVM test runs: room for the driver-side plans, no console progress bar
        b = b.config("spark.driver.memory", os.environ.get("TIDEWATCH_DRIVER_MEMORY", "8g"))
        b = b.config("spark.ui.showConsoleProgress", "false")
    spark = b.getOrCreate()
    apply_engine_conf(spark)
    ensure_checkpoint_dir(spark)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session that names none gets a folder below the system's temporary one; on a
    cluster that is an error, as its machines share no temporary folder.
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not d:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        d = os.path.join(tempfile.gettempdir(), "tidewatch-checkpoints")
    return d.rstrip("/")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    d = checkpoint_root(spark)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(d)
    return d
