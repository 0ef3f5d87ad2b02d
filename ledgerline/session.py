"""Session helpers: one place for the settings every job relies on.

Nothing here reads the wall clock or a machine-local path on a cluster:
the checkpoint folder comes from ``spark.checkpoint.dir`` and is only
invented (under the system temp dir) when the master is local and the
setting is missing, which is the test situation.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings the library expects.  AQE re-plans joins (broadcast a side only
# when its *measured* shuffle output is small), coalesces tiny partitions
# and splits skewed join partitions at run time.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, app: str = "ledgerline",
              shuffle_partitions: int | None = None,
              extra: dict | None = None) -> SparkSession:
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, setting one only if unset.

    On a cluster the folder must be shared storage named by the cluster
    in ``spark.checkpoint.dir``; we refuse to guess one there.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = sc.getConf().get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at a shared folder")
    path = tempfile.mkdtemp(prefix="ledgerline-ckpt-")
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A path under the shared checkpoint folder for written intermediate
    tables (used to cut lineage between stateful runs)."""
    base = ensure_checkpoint_dir(spark)
    return "/".join([base.rstrip("/"), "ledgerline", *parts])


def new_run_id() -> str:
    return os.urandom(6).hex()
