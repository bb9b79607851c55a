"""Session settings and the shared scratch area."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"

# Runtime settings every job of this package relies on. Partition counts and
# memory stay with the cluster: AQE coalesces or splits from the actual sizes.
REQUIRED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # HotSpot does not compile methods beyond 8000 bytes of bytecode, so one huge
    # generated method runs interpreted. Below the limit Spark splits it instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


# Settings that only a new session can take: call sites of every column expression
# are not recorded, which halves the time to build a wide plan.
AT_START = {"spark.python.sql.dataFrameDebugging.enabled": "false"}


def build_session(app: str = "ticketmill", master: str | None = None,
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**REQUIRED, **AT_START}.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def prepare(spark: SparkSession) -> SparkSession:
    """Pin the required runtime settings on a session someone else created."""
    for key, value in REQUIRED.items():
        spark.conf.set(key, value)
    return spark


def scratch_root(spark: SparkSession) -> str:
    """Shared folder named by the cluster; a private one only in local mode."""
    root = spark.conf.get(CHECKPOINT_KEY, None)
    if root:
        return root.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise RuntimeError(f"{CHECKPOINT_KEY} must name a folder every executor can reach")
    root = os.environ.get("TICKETMILL_SCRATCH") or tempfile.mkdtemp(prefix="ticketmill-")
    spark.conf.set(CHECKPOINT_KEY, root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"
