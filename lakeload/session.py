"""Session construction and the shared scratch folder.

Scratch data (materialised numbering stages, query fixtures written by the catalogue) goes under the
folder the cluster names in ``spark.checkpoint.dir``. It is read from the session; only a ``local``
master may leave it unset (tests), and then gets a folder of its own.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Silver loads, gold tables and scratch frames: row hashes are hex text, which snappy leaves as it is and zstd halves.
TABLE_CODEC = "zstd"

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.compression.codec": "snappy",
    "spark.ui.enabled": "false",
    "spark.driver.host": "127.0.0.1",
    "spark.driver.bindAddress": "127.0.0.1",
}


_LOCAL_DIRS: dict[str, str] = {}


def get_session(master: str | None = None, app: str = "lakeload", **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in {**DEFAULT_CONF, **conf}.items():
        builder = builder.config(k, v)
    return builder.getOrCreate()


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of the session; a local master may do without one, a cluster may not."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    try:
        current = spark.sparkContext.getCheckpointDir()
    except Exception:  # no SparkContext access (e.g. a remote session)
        current = None
    if current:
        return current
    master = spark.conf.get("spark.master", "")
    if not master.startswith("local[") and master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_DIRS:
        _LOCAL_DIRS[app] = tempfile.mkdtemp(prefix="lakeload-ckpt-")
        spark.sparkContext.setCheckpointDir(_LOCAL_DIRS[app])
    return _LOCAL_DIRS[app]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, never reused folder under the shared checkpoint folder."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/lakeload/{label}-{uuid.uuid4().hex}"


__all__ = ["get_session", "checkpoint_dir", "scratch_path", "DEFAULT_CONF", "TABLE_CODEC"]
