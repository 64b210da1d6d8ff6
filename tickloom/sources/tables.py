"""Parquet tables: reading layers, batch writes, temp views."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

# The error conditions Spark raises for a table that has no files yet. The last
# one stands for a streaming sink that has started but not written a file.
NOT_READY = {"PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA", "_LEGACY_ERROR_TEMP_1134"}


def read_table(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """A Parquet folder with its partition columns.

    Give the schema where a partition value could be taken for another type, such as a
    symbol made of digits.
    """
    return (spark.read if schema is None else spark.read.schema(schema)).parquet(path)


def read_if_ready(spark: SparkSession, path: str) -> DataFrame | None:
    """The table, or None while nothing has been written; other errors still surface."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as problem:
        if problem.getCondition() in NOT_READY:
            return None
        raise


def has_sink_log(spark: SparkSession, path: str) -> bool:
    """True when a streaming file sink owns the folder.

    Readers of such a folder trust the sink's own log, so a batch job must not rewrite it.
    """
    try:
        spark.read.text(f"{path}/_spark_metadata")
    except AnalysisException as problem:
        if problem.getCondition() in NOT_READY:
            return False
        raise
    return True


def write_table(
    rows: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    gather: bool = True,
    sort_by: Sequence[str] = (),
) -> DataFrame:
    """Overwrite a batch-owned table and read it back.

    A partitioned write is rebalanced on the partition columns first: each folder gets few
    files, yet a day or symbol that holds most of the rows is still split over many tasks.
    Turn ``gather`` off, and save that shuffle, where the rows come in partition order, as
    ticks that were written day by day do. ``sort_by`` orders the rows inside each file, so
    that a filter on those columns can skip most row groups.
    """
    spark = rows.sparkSession
    if has_sink_log(spark, path):
        raise ValueError(f"{path} belongs to a streaming sink; write to another folder")
    out = rows.hint("rebalance", *partition_by) if partition_by and gather else rows
    overwrite_folder(out, path, partition_by, sort_by)
    # Declaring the schema keeps partition values typed and covers a table without rows.
    in_files = [name for name in rows.columns if name not in partition_by]
    return read_table(spark, path, rows.select(*in_files, *partition_by).schema)


def overwrite_folder(
    rows: DataFrame, path: str, partition_by: Sequence[str], sort_by: Sequence[str]
) -> None:
    """Replace all files below ``path``, rows sorted within each file.

    A partitioned write sorts by the partition columns anyway; this only extends the key.
    """
    out = rows.sortWithinPartitions(*partition_by, *sort_by) if sort_by else rows
    writer = out.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def name_view(rows: DataFrame, name: str) -> DataFrame:
    """Make a DataFrame known to SQL and return the view."""
    rows.createOrReplaceTempView(name)
    return rows.sparkSession.table(name)
