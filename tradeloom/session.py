"""Session settings the jobs are written for.

On a cluster the session usually exists already; ``settings`` is what the jobs
expect of it. All of them are run-time SQL settings except the checkpoint
folder, which the cluster names itself.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

MIB = 1024 * 1024
SHUFFLE_BYTES = 128 * MIB


def settings(shuffled_bytes: int | None = None) -> dict[str, str]:
    """SQL settings; ``shuffled_bytes`` sizes the initial shuffle width.

    AQE merges small partitions down but never raises the width of a shuffle,
    so for a large run the start value has to come from the data volume.
    """
    conf = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(SHUFFLE_BYTES),
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    if shuffled_bytes is not None:
        width = max(8, -(-shuffled_bytes // SHUFFLE_BYTES))
        conf["spark.sql.shuffle.partitions"] = str(width)
    return conf


def get_session(
    app: str = "tradeloom",
    master: str | None = None,
    shuffled_bytes: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**settings(shuffled_bytes), **(extra or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
