"""Session settings and the shared storage root.

All times in this library are UTC: readings carry wall-clock strings and the
driver tables carry ``TIMESTAMP_NTZ``, so the session zone decides what an
instant is.  ``ensure_utc`` is called by every public query entry point.

Storage that must survive an executor loss (stream checkpoints, keyed-table
logs, lineage cuts) lives under the cluster's shared ``spark.checkpoint.dir``.
A private fallback is only created when the session has none (local tests).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

_FALLBACK_ROOT: str | None = None

# Settings a cluster job should carry; local tests use the same ones with a
# small shuffle-partition count.
SCALE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Aggregations below are all partial + final; keep the partial side on.
    "spark.sql.execution.useObjectHashAggregateExec": "true",
    # Stateful stream operators: RocksDB keeps per-key window state off-heap.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # Each micro-batch uploads only the state changes, not a full snapshot.
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # Not set: rocksdb.boundedMemoryUsage (one capped budget per executor);
    # with its default cap the windowed stream ran ~3x slower (21 s vs 7.7 s).
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "sensorstream", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the library's settings."""
    b = SparkSession.builder.master(master).appName(app_name)
    conf = dict(SCALE_CONF)
    conf.update({
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.ui.enabled": "false",
        "spark.driver.memory": "8g",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    })
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_storage_root(spark)
    return spark


def ensure_utc(spark: SparkSession) -> None:
    """Pin the session zone to UTC (reading times are UTC by contract)."""
    if spark.conf.get("spark.sql.session.timeZone", None) != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def ensure_storage_root(spark: SparkSession) -> str:
    """Return the shared checkpoint root, creating a private one only if unset.

    On a cluster ``spark.checkpoint.dir`` names a shared (distributed) folder;
    it is read from the session and never overridden.  In local tests, where
    it is unset, a fresh directory is created and registered.
    """
    global _FALLBACK_ROOT
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        try:
            root = spark.sparkContext.getCheckpointDir()
        except Exception:  # noqa: BLE001  (no SparkContext, e.g. Spark Connect)
            root = None
    if not root and _FALLBACK_ROOT is not None:
        root = _FALLBACK_ROOT
    if root:
        return root.rstrip("/")
    if _FALLBACK_ROOT is None:
        if spark.conf.get("spark.master", "").split("[")[0] != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        _FALLBACK_ROOT = tempfile.mkdtemp(prefix="sensorstream-ckpt-")
    try:
        spark.conf.set("spark.checkpoint.dir", _FALLBACK_ROOT)
    except Exception:  # noqa: BLE001  (a core conf may be read-only at runtime)
        pass
    try:
        spark.sparkContext.setCheckpointDir(_FALLBACK_ROOT)
    except Exception:  # noqa: BLE001
        pass
    return _FALLBACK_ROOT


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A fresh, unique path under the shared storage root."""
    root = ensure_storage_root(spark)
    leaf = "-".join(parts + (uuid.uuid4().hex[:12],)) if parts else uuid.uuid4().hex
    return os.path.join(root, "sensorstream", leaf) if "://" not in root else f"{root}/sensorstream/{leaf}"
