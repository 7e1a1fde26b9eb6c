"""Session construction and cluster-wide settings.

The library never hard-codes storage locations: a cluster names its shared
checkpoint folder in ``spark.checkpoint.dir`` and every lineage cut reads it
from the session.  Only tests (where the setting is unset) create their own.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every session gets.  AQE re-plans joins and coalesces partitions at
# runtime, and splits skewed shuffle partitions of sort-merge joins.
_DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # checkpoint files go once nothing refers to them any more
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # A side is broadcast only when its measured size is below this bound.
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
}


def get_spark(
    app: str = "potluck",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra_conf: dict | None = None,
) -> SparkSession:
    """Return (or create) a session with the library defaults applied."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(_DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster.

    Reads ``spark.checkpoint.dir``; when it is unset (local tests) a folder is
    created and registered so ``DataFrame.checkpoint`` works.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d:
        master = spark.sparkContext.master or ""
        if not master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
        # local mode only (tests): a folder on this machine is the shared folder
        d = tempfile.mkdtemp(prefix="potluck-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(d)
    return d


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared folder (survives executor loss)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path under the shared checkpoint folder for a written table."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/potluck-tables/{name}-{uuid.uuid4().hex}"
