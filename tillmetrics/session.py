"""Session set-up and the shared working folder."""

from __future__ import annotations

import functools
import tempfile
import uuid

from pyspark.sql import SparkSession

#: Settings every job of this package relies on or profits from.
RECOMMENDED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    # Runtime re-planning: coalesces small shuffle partitions, switches a join to
    # broadcast once the measured size allows it, splits skewed join partitions.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Streaming state on local disk with incremental uploads, not on the JVM heap.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def build_session(
    app_name: str = "tillmetrics",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Session with the recommended settings; ``extra`` wins over them.

    ``shuffle_partitions`` is the upper bound AQE coalesces from, and the fixed
    number of state partitions of a new streaming query. Size it for the largest
    shuffle of the job (about 200 MB each), not for the smallest.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(RECOMMENDED)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(extra or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@functools.cache
def _local_dir() -> str:
    return tempfile.mkdtemp(prefix="tillmetrics-")


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors can reach, as named by ``spark.checkpoint.dir``.

    Only a local-mode session may do without that setting: driver and executors
    are then one process, so a temporary folder is shared by definition.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if spark.sparkContext.master.startswith("local"):
        return _local_dir()
    raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")


def new_work_dir(spark: SparkSession, label: str) -> str:
    """A path nobody has used yet below the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
