"""Running aggregates with checkpointed state (T3) and a duplicate-free sink (T5).

A running aggregate emits, per micro-batch, the keys whose totals changed. Each
micro-batch writes them to its own ``epoch`` folder and overwrites that folder when
it is repeated after a failure, so the output is exactly-once. Every so many epochs
the totals so far are written as a snapshot, and a marker that appears at once says that it is complete: reading
the current totals takes the last marked snapshot and the changes after it. Snapshots and changes
that later ones cover are removed, but for a few generations that readers may still be
using, so neither reading nor disk grows with the age of the stream.
Ranking then is a batch query over the totals (T8), because streams cannot be ranked.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tillmetrics.sources.shared_files import SharedFiles

EPOCH = "epoch"
SNAPSHOT_EVERY = 100
#: Generations (a snapshot and the changes it was made from) that stay beside the last one, for readers that have begun.
KEPT_SNAPSHOTS = 3


def write_epoch(rows: DataFrame, path: str, epoch: int) -> None:
    """T5: output of one micro-batch, replaced as a whole if the micro-batch runs again."""
    rows.write.mode("overwrite").parquet(f"{path}/{EPOCH}={epoch}")


def _start(
    rows: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str, mode: str
) -> StreamingQuery:
    return (
        rows.writeStream.outputMode(mode)
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def start_append(rows: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Start a stateless stream over everything available; rows are appended by epoch."""
    return _start(rows, lambda batch, epoch: write_epoch(batch, path, epoch), checkpoint, "append")


def start_totals(
    totals: DataFrame,
    keys: Sequence[str],
    path: str,
    checkpoint: str,
    snapshot_every: int = SNAPSHOT_EVERY,
    kept_snapshots: int = KEPT_SNAPSHOTS,
) -> StreamingQuery:
    """Start a streaming aggregation over everything available.

    ``totals`` is any aggregation of a stream, grouped by ``keys``. Its state lives in
    the checkpoint (RocksDB with the recommended session settings); after a restart it
    continues from the last finished micro-batch. The number of state partitions is
    ``spark.sql.shuffle.partitions`` of the first start.
    """
    spark, schema = totals.sparkSession, totals.schema

    def write(changed: DataFrame, epoch: int) -> None:
        write_epoch(changed, _changes(path), epoch)
        if (epoch + 1) % snapshot_every == 0:
            take_snapshot(spark, schema, keys, path, epoch)
            forget_covered(spark, path, kept_snapshots)

    return _start(totals, write, checkpoint, "update")


def current_totals(
    spark: SparkSession, schema: T.StructType, keys: Sequence[str], path: str
) -> DataFrame:
    """What :func:`start_totals` has written so far, one row per key."""
    return latest_totals(_recent(spark, schema, path), keys)


def _changes(path: str) -> str:
    return f"{path}/changes"


def _snapshots(path: str) -> str:
    return f"{path}/snapshots"


def _markers(path: str) -> str:
    return f"{path}/_complete"


def snapshot_epochs(spark: SparkSession, path: str) -> list[int]:
    """Epochs with a complete snapshot, oldest first."""
    return [int(name) for name in SharedFiles(spark).names(_markers(path)) if name.isdigit()]


def take_snapshot(spark: SparkSession, schema: T.StructType, keys: Sequence[str], path: str, epoch: int) -> None:
    """Write the totals up to an epoch, then mark them as complete; nothing is done for a marked epoch.

    A crash before the mark leaves a folder that nobody reads and that the repeated epoch overwrites.
    """
    if epoch not in snapshot_epochs(spark, path):
        write_epoch(latest_totals(_recent(spark, schema, path), keys), _snapshots(path), epoch)
        SharedFiles(spark).publish(f"{_markers(path)}/{epoch:012d}", "")


def forget_covered(spark: SparkSession, path: str, kept: int = KEPT_SNAPSHOTS) -> None:
    """Remove all generations but the last one and ``kept`` before it."""
    files, complete = SharedFiles(spark), snapshot_epochs(spark, path)
    covered = complete[: -kept - 1]
    if not covered:
        return
    for epoch in covered:  # unmarked first, so that no reader turns to what is being removed
        files.delete(f"{_markers(path)}/{epoch:012d}")
    for folder in (_changes(path), _snapshots(path)):
        for name in files.names(folder):
            if name.startswith(f"{EPOCH}=") and name[len(EPOCH) + 1 :].isdigit() and int(name[len(EPOCH) + 1 :]) <= covered[-1]:
                files.delete(f"{folder}/{name}")


def _recent(spark: SparkSession, schema: T.StructType, path: str) -> DataFrame:
    """The last complete snapshot and all changes after it."""
    complete = snapshot_epochs(spark, path)
    changes = read_epochs(spark, schema, _changes(path))
    if not complete:
        return changes
    full = T.StructType([*schema.fields, T.StructField(EPOCH, T.LongType())])
    last = spark.read.schema(full).option("basePath", _snapshots(path)).parquet(f"{_snapshots(path)}/{EPOCH}={complete[-1]}")
    return last.unionByName(changes.filter(F.col(EPOCH) > complete[-1]))


def finish(*queries: StreamingQuery) -> None:
    """T4: wait until the input of all queries is exhausted; stop the rest when one fails."""
    try:
        for query in queries:
            query.awaitTermination()
    finally:
        for query in queries:
            query.stop()


def read_epochs(spark: SparkSession, schema: T.StructType, path: str) -> DataFrame:
    """All written epochs with their ``epoch`` number; no rows before the first one."""
    full = T.StructType([*schema.fields, T.StructField(EPOCH, T.LongType())])
    # The folder must exist even when the stream never had input.
    spark.createDataFrame([], full).write.mode("ignore").partitionBy(EPOCH).parquet(path)
    return spark.read.schema(full).parquet(path)


def latest_totals(changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Current totals from the changes of all epochs, one hash aggregation."""
    measures = [name for name in changes.columns if name not in (*keys, EPOCH)]
    return changes.groupBy(*keys).agg(*[F.max_by(name, EPOCH).alias(name) for name in measures])


def observed(rows: DataFrame, name: str, **counters: Column) -> DataFrame:
    """D5 in a stream: counters per micro-batch, reported in the query progress under ``name``."""
    metrics = [F.count(F.lit(1)).alias("rows_in")]
    metrics += [F.count_if(predicate).alias(label) for label, predicate in counters.items()]
    return rows.observe(name, *metrics)
