"""Progress of streaming queries as a table that outlives them."""

from __future__ import annotations

import json
import time
import uuid
from collections import deque
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from tickloom.sources import versions
from tickloom.sources.tables import NOT_READY

# Columns of the progress table.
PROGRESS = (
    "query STRING, query_id STRING, run_id STRING, batch_id BIGINT, started STRING, input_rows BIGINT,"
    " input_rows_per_second DOUBLE, processed_rows_per_second DOUBLE, trigger_ms BIGINT,"
    " rows_dropped_by_watermark BIGINT, watermark STRING, sources STRING"
)
KEY = ("run_id", "batch_id")
#: Files of reports that are merged into one.
MERGE_FILES = 1_000


class ProgressLog(StreamingQueryListener):
    """Writes every report of every query of the session to a table, and holds none of them.

    A report is appended as it comes; if that fails it waits in memory and goes with the next one. The
    table is keyed by run and batch, so a report that is written twice counts once. Once ``merge_files``
    reports have been appended they are merged, with those merged before, into one file a query.
    """

    def __init__(self, spark: SparkSession, path: str, merge_files: int = MERGE_FILES):
        self.spark, self.path, self.merge_files = spark, path, merge_files
        self.waiting: deque[tuple] = deque()
        self.written, self.ended = 0, set()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        self.add([progress_row(json.loads(event.progress.json))])

    def onQueryTerminated(self, event) -> None:
        self._flush()
        self.ended.add(str(event.runId))

    def add(self, rows: Iterable[tuple]) -> None:
        """Append rows; if the table cannot be written now, they go with the next ones."""
        self.waiting.extend(rows)
        self._flush()

    def _flush(self) -> None:
        if not self.waiting:
            return
        rows = list(self.waiting)
        try:
            self.spark.createDataFrame(rows, PROGRESS).coalesce(1).write.parquet(f"{self.path}/reports/{uuid.uuid4().hex}")
        except Exception as problem:  # noqa: BLE001 - a listener must not fail; the rows stay
            print(f"progress waits to be written: {problem}")
            return
        for _ in rows:
            self.waiting.popleft()
        self.written += 1
        if self.written >= self.merge_files:
            self.merge()
            self.written = 0

    def merge(self) -> None:
        """Put all reports so far into one file a query, then remove the files that held one each.

        If this dies in between, reports are found in both places, which their key makes harmless.
        """
        appended = self.spark.read.schema(PROGRESS).parquet(f"{self.path}/reports/*")
        files = [row[0] for row in appended.select(F.input_file_name()).distinct().collect()]
        known = self.spark.read.schema(PROGRESS).parquet(*files)
        versions.overwrite(_with_merged(self.spark, self.path, known), f"{self.path}/merged", "query", sort_by=["started"])
        for file in files:
            folder = self.spark._jvm.org.apache.hadoop.fs.Path(file).getParent()
            folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(folder, True)
        versions.vacuum(self.spark, f"{self.path}/merged")

    def complete(self, queries: Iterable[StreamingQuery], seconds: float = 60) -> None:
        """Wait until the reports of ended queries have come, and add what a busy session has dropped."""
        queries = list(queries)
        runs = {str(query.runId) for query in queries if not query.isActive}
        until = time.monotonic() + seconds
        while not runs <= self.ended and time.monotonic() < until:
            time.sleep(0.05)
        recent = [progress_row(json.loads(report.json)) for query in queries for report in query.recentProgress]
        recent = [row for row in recent if row[2] in runs]
        if recent:
            mine = F.col("run_id").isin(sorted(runs)) & (F.col("batch_id") >= min(row[3] for row in recent))
            known = read_progress(self.spark, self.path).filter(mine).select(*KEY).collect()
            self.add([row for row in recent if row[2:4] not in set(map(tuple, known))])


@contextmanager
def progress_log(spark: SparkSession, path: str, merge_files: int = MERGE_FILES) -> Iterator[ProgressLog]:
    """Keep the progress of all queries that run in a block."""
    log = ProgressLog(spark, path, merge_files)
    spark.streams.addListener(log)
    try:
        yield log
    finally:
        spark.streams.removeListener(log)


def read_progress(spark: SparkSession, path: str) -> DataFrame:
    """One row per run and batch of all queries that were ever logged at ``path``."""
    try:
        appended = spark.read.schema(PROGRESS).parquet(f"{path}/reports/*")
    except AnalysisException as problem:
        if problem.getCondition() not in NOT_READY:
            raise
        appended = spark.createDataFrame([], PROGRESS)
    return _with_merged(spark, path, appended)


def _with_merged(spark: SparkSession, path: str, rows: DataFrame) -> DataFrame:
    if versions.has_versions(spark, f"{path}/merged"):
        rows = rows.unionByName(versions.read_version(spark, f"{path}/merged"))
    return rows.dropDuplicates(list(KEY))


def query_totals(progress: DataFrame) -> DataFrame:
    """``(query, runs, batches, input_rows, rows_dropped_by_watermark)`` over all runs of each query.

    A batch that a restarted query ran again counts once, as it last ran.
    """
    order = F.struct("started", "run_id")
    last = progress.groupBy("query", "query_id", "batch_id").agg(
        F.max_by("input_rows", order).alias("input_rows"),
        F.max_by("rows_dropped_by_watermark", order).alias("dropped"),
        F.max_by("run_id", order).alias("run_id"),
    )
    return last.groupBy("query").agg(
        F.count_distinct("run_id").alias("runs"),
        F.count(F.lit(1)).alias("batches"),
        F.sum("input_rows").alias("input_rows"),
        F.sum("dropped").alias("rows_dropped_by_watermark"),
    )


def progress_row(report: dict) -> tuple:
    """A report as a row of the table."""
    dropped = [state.get("numRowsDroppedByWatermark", 0) for state in report["stateOperators"]]
    return (
        report["name"],
        report["id"],
        report["runId"],
        report["batchId"],
        report["timestamp"],
        report["numInputRows"],
        _rate(report, "inputRowsPerSecond"),
        _rate(report, "processedRowsPerSecond"),
        report.get("durationMs", {}).get("triggerExecution"),
        sum(dropped),
        report.get("eventTime", {}).get("watermark"),
        json.dumps(report["sources"]),
    )


def _rate(report: dict, name: str) -> float | None:
    """A rate as a number; reports leave it out or give text when no time has passed."""
    value = report.get(name)
    return float(value) if isinstance(value, (int, float)) else None
