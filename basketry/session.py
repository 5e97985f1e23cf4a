"""SparkSession construction and the shared work folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on.  Timestamps are pinned to UTC so that
# window alignment, hour keys and day boundaries do not depend on the JVM zone.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Session windows: merge sessions inside each map partition before the
    # shuffle, the session-window equivalent of a partial aggregate.
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
    "spark.ui.enabled": "false",
}


def get_session(master: str | None = None, app: str = "basketry",
                shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    """Build (or fetch) a session with the settings above.

    On a cluster leave ``master`` unset so spark-submit decides; tests pass
    ``local[N]`` and a small shuffle-partition count.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    apply_runtime_conf(spark)
    return spark


def apply_runtime_conf(spark: SparkSession) -> None:
    """Settings that can be changed on a running session."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set(
        "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition", "true")


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for lineage cuts, stream checkpoints and results.

    Read from ``spark.checkpoint.dir`` (the cluster names a shared folder
    there).  Only when it is unset on a local master (tests) a fresh folder
    is made and registered on the session; on a cluster a folder of one
    machine would hold incomplete data, so the setting is required there.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="basketry-")
        spark.conf.set("spark.checkpoint.dir", root)
    try:
        sc = spark.sparkContext
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(root)
    except Exception:  # Spark Connect has no SparkContext
        pass
    return root.rstrip("/")


def work_path(spark: SparkSession, name: str) -> str:
    """A new, unique path under the shared checkpoint folder."""
    return os.path.join(checkpoint_root(spark), "basketry", f"{name}-{uuid.uuid4().hex[:12]}")
