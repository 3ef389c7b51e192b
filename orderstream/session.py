"""Session helpers: a tuned local session for tests/bench and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# What the package's results depend on: event time is epoch-ms UTC.
REQUIRED_CONF = {"spark.sql.session.timeZone": "UTC"}

# What it runs best with; values that the session already has are left alone.
# AQE re-plans shuffle sizes and skewed joins at runtime, RocksDB keeps streaming
# state off the heap and commits change logs instead of snapshots.
PREFERRED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}
CORE_CONF = REQUIRED_CONF | PREFERRED_CONF


def local_session(cpus: int | str = 8, app: str = "orderstream", extra: dict | None = None) -> SparkSession:
    """A ``local[N]`` session for tests and the bench (UI off, small shuffle width)."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in {**CORE_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def apply_core_conf(spark: SparkSession) -> SparkSession:
    """Set what results depend on, and what the session hasn't set itself of the
    rest.  A streaming query reads its state store settings when it starts, so this
    has to come before."""
    for k, v in REQUIRED_CONF.items():
        spark.conf.set(k, v)
    for k, v in PREFERRED_CONF.items():
        if not spark._jsparkSession.conf().contains(k):
            spark.conf.set(k, v)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and written intermediate tables.

    On a cluster this is ``spark.checkpoint.dir`` as configured by the operator.
    Only when it is unset in local mode (tests, the bench) a private folder is
    created and registered. On a cluster a folder of the driver's own disk would
    be invisible to the executors, so there an unset folder is an error.
    """
    conf = spark.sparkContext.getConf()
    root = conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="orderstream-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
        spark.sparkContext.setCheckpointDir(root)
    elif not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique sub-folder of the shared checkpoint root."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/{name}-{uuid.uuid4().hex[:12]}"


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")
