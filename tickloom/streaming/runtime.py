"""Starting, watching and stopping streaming queries."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from tickloom.session import ROCKSDB, settings
from tickloom.streaming.progress import PROGRESS, progress_row


def _writer(
    rows: DataFrame, name: str, checkpoint: str, mode: str, every: str | None
) -> DataStreamWriter:
    """A named writer; ``every`` is a trigger interval, None means all there is, then stop."""
    writer = rows.writeStream.queryName(name).outputMode(mode)
    writer = writer.option("checkpointLocation", checkpoint)
    return writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)


def _start(
    spark: SparkSession, writer: DataStreamWriter, state_partitions: int | None
) -> StreamingQuery:
    """Start with state on RocksDB, outside the heap.

    The number of state partitions is fixed when a checkpoint is first used and cannot grow
    later, so a long-lived query should be given it with room to spare.
    """
    values = {
        "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    }
    if state_partitions:
        values["spark.sql.shuffle.partitions"] = str(state_partitions)
    with settings(spark, values):
        return writer.start()


def start_table(
    rows: DataFrame,
    name: str,
    path: str,
    checkpoint: str,
    partition_by: Sequence[str] = (),
    every: str | None = None,
    state_partitions: int | None = None,
) -> StreamingQuery:
    """Append to a Parquet folder, each row once for readers that use the sink's log."""
    writer = _writer(rows, name, checkpoint, "append", every).format("parquet").option("path", path)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return _start(rows.sparkSession, writer, state_partitions)


def start_console(
    rows: DataFrame,
    name: str,
    checkpoint: str,
    mode: str = "append",
    every: str | None = None,
    n_rows: int = 20,
    truncate: bool = False,
) -> StreamingQuery:
    """Print the first rows of every batch."""
    writer = _writer(rows, name, checkpoint, mode, every).format("console")
    writer = writer.option("numRows", n_rows).option("truncate", truncate)
    return _start(rows.sparkSession, writer, None)


def start_batches(
    rows: DataFrame,
    name: str,
    checkpoint: str,
    mode: str,
    handle: Callable[[DataFrame, int], None],
    every: str | None = None,
    state_partitions: int | None = None,
) -> StreamingQuery:
    """Hand every micro-batch to ``handle(rows, batch_id)``, which must be safe to repeat."""
    writer = _writer(rows, name, checkpoint, mode, every).foreachBatch(handle)
    return _start(rows.sparkSession, writer, state_partitions)


def start_changes(
    rows: DataFrame, name: str, path: str, checkpoint: str, **options
) -> StreamingQuery:
    """Update mode: write the rows that changed in a batch to a folder of their own.

    A batch that runs again overwrites its own folder, so nothing is written twice.
    """

    def keep(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return start_batches(rows, name, checkpoint, "update", keep, **options)


def latest_changes(changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The last version of every key in a folder written by :func:`start_changes`."""
    values = [name for name in changes.columns if name not in {*keys, "batch_id"}]
    return changes.groupBy(*keys).agg(
        *(F.max_by(name, "batch_id").alias(name) for name in values)
    )


def start_snapshots(
    rows: DataFrame, name: str, path: str, checkpoint: str, **options
) -> StreamingQuery:
    """Complete mode: write the whole result of every batch.

    Two slots are used in turn, so a reader finds the previous snapshot while the next one
    is written, and old ones do not pile up.
    """

    def keep(batch: DataFrame, batch_id: int) -> None:
        tagged = batch.withColumn("batch_id", F.lit(batch_id))
        tagged.write.mode("overwrite").parquet(f"{path}/slot={batch_id % 2}")

    return start_batches(rows, name, checkpoint, "complete", keep, **options)


def latest_snapshot(spark: SparkSession, path: str) -> DataFrame:
    """The newest whole result in a folder written by :func:`start_snapshots`."""
    slots = spark.read.parquet(path)
    newest = slots.agg(F.max("batch_id")).scalar()
    return slots.filter(F.col("batch_id") == newest).drop("batch_id", "slot")


def run_to_end(*queries: StreamingQuery) -> None:
    """Wait for queries without a trigger interval; a failed one raises its error."""
    for query in queries:
        query.awaitTermination()


def stop_all(queries: Iterable[StreamingQuery]) -> None:
    """Stop every query, also when stopping one of them fails."""
    problems = []
    for query in queries:
        try:
            query.stop()
        except Exception as problem:  # noqa: BLE001 - collected and raised below
            problems.append(problem)
    if problems:
        raise problems[0]


def progress_table(spark: SparkSession, queries: Iterable[StreamingQuery]) -> DataFrame:
    """The newest batches of running queries, as many as the session remembers.

    :mod:`tickloom.streaming.progress` keeps all of them.
    """
    return spark.createDataFrame(
        [progress_row(json.loads(report.json)) for query in queries for report in query.recentProgress],
        PROGRESS,
    )
