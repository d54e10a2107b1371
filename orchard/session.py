"""Session construction and the shared work folder.

Jobs that must cut lineage or persist intermediate tables write into the
folder the cluster names in ``spark.checkpoint.dir`` (a shared file system on a
real cluster).  We only fall back to a folder of our own when that setting is
absent, which is the case in unit tests.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on.  Time zone is pinned so calendar features do
# not depend on the machine; AQE re-plans joins and coalesces partitions at
# run time; skew-join splitting handles hot keys in shuffled joins.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(
    app_name: str = "orchard",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra_conf: dict | None = None,
) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra_conf or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's checkpoint folder, setting one only if unset."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None
    )
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        # A single-process session (tests): one machine, one disk.
        configured = tempfile.mkdtemp(prefix="orchard-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def work_root(spark: SparkSession) -> str:
    """Shared folder for tables this library writes (next to checkpoints)."""
    ckpt = ensure_checkpoint_dir(spark)
    # getCheckpointDir() returns <dir>/<app-uuid>; keep our tables beside it.
    return ckpt.rstrip("/") + "/orchard"


def fresh_path(spark: SparkSession, name: str) -> str:
    """A unique path under the shared work root, for one job's output."""
    return f"{work_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))

