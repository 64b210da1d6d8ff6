"""Compacting a layer and computing a day again."""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tickloom.functions.bands import PriceBands
from tickloom.operators.cleaning import clean_ticks, clean_with_anchor_table, drop_repeats
from tickloom.operators.windows import (
    LATENESS_SECONDS,
    SLIDE_SECONDS,
    WINDOW_SECONDS,
    closed_windows,
    sliding_average,
)
from tickloom.session import settings
from tickloom.streaming.observe import committed_watermark
from tickloom.sources import versions
from tickloom.sources.tables import read_table, write_table

TARGET_FILE_BYTES = 128 * 1024 * 1024


def compact(
    spark: SparkSession,
    source: str,
    target: str,
    partition_by: Sequence[str],
    finished: Column | None = None,
    file_bytes: int = TARGET_FILE_BYTES,
    schema: StructType | None = None,
    sort_by: Sequence[str] = (),
) -> DataFrame:
    """Copy a layer, or its ``finished`` partitions, into fewer and larger files.

    The copy goes to another folder: readers of a streaming layer follow the sink's log and
    would miss files swapped in place. Partitions are merged and split by size, so a symbol
    that holds a third of the rows becomes several files written by several tasks.
    ``sort_by`` puts the rows of a file back in order, which small files had for free.
    """
    if source.rstrip("/") == target.rstrip("/"):
        raise ValueError("compact into another folder, not in place")
    rows = read_table(spark, source, schema)
    if finished is not None:
        rows = rows.filter(finished)
    with settings(spark, {"spark.sql.adaptive.advisoryPartitionSizeInBytes": str(file_bytes)}):
        return write_table(rows, target, partition_by, sort_by=sort_by)


def finished_days(spark: SparkSession, checkpoint: str) -> Column | None:
    """Which days a query with a watermark is done with; None before its watermark has moved.

    The argument is the query's checkpoint; the column is a function of the partition column, by its name
    ``day``. Nothing that the query would still take belongs to such a day.
    """
    moment = committed_watermark(spark, checkpoint)
    return None if moment is None else F.col("day") < F.to_date(F.lit(moment))


def source_files(spark: SparkSession, path: str, column: str) -> DataFrame:
    """``(day, files, bytes)`` per partition of a layer, from the names of its files alone.

    Of a streaming sink only the files that its log knows count.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path)
    by_day = files.groupBy(F.col(column).alias("day"))
    return by_day.agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"))


def compact_finished(
    spark: SparkSession,
    source: str,
    target: str,
    checkpoint: str,
    column: str,
    inner: Sequence[str] = (),
    sort_by: Sequence[str] = (),
    file_bytes: int = TARGET_FILE_BYTES,
    schema: StructType | None = None,
) -> list[dt.date]:
    """Copy the days of a layer that are finished and not copied yet into larger files; returns them.

    ``checkpoint`` is that of a query whose watermark tells which days are finished, gold's for instance.
    ``target`` is a table in versions, and the ledger is part of its manifest: for each day it tells how
    many files and bytes of the source were copied. A day is due if these differ, so one that got more
    files after all is copied again. All days that are due become visible in one step. Rows without a
    day are never finished.
    """
    due = _due(spark, source, target, checkpoint, column)
    if due:
        rows = read_table(spark, source, schema).filter(F.col(column).isin([F.lit(day) for day in due]))
        notes = {str(day): note for day, note in due.items()}
        with settings(spark, {"spark.sql.adaptive.advisoryPartitionSizeInBytes": str(file_bytes)}):
            versions.replace_parts(rows, target, column, list(due), inner, sort_by, notes)
    return sorted(due)


def _due(spark: SparkSession, source: str, target: str, checkpoint: str, column: str) -> dict[dt.date, str]:
    finished = finished_days(spark, checkpoint)
    if finished is None:
        return {}
    known = versions.newest_notes(spark, target)
    now = {row.day: _note(row) for row in source_files(spark, source, column).filter(finished).collect()}
    return {day: note for day, note in now.items() if known.get(str(day)) != note}


def _note(row) -> str:
    return json.dumps({"files": row.files, "bytes": row.bytes})


def read_compacted(
    spark: SparkSession, source: str, target: str, column: str, schema: StructType | None = None
) -> DataFrame:
    """All rows of a layer: compacted days from ``target``, every other one from the layer itself.

    A day that has got files since it was compacted is read from the layer.
    """
    rows = read_table(spark, source, schema)
    known = versions.newest_notes(spark, target)
    now = {str(row.day): (row.day, _note(row)) for row in source_files(spark, source, column).filter("day IS NOT NULL").collect()}
    same = [now[day][0] for day, note in known.items() if day in now and now[day][1] == note]
    if not same:
        return rows
    copied = F.coalesce(F.col(column).isin([F.lit(day) for day in same]), F.lit(False))
    return versions.read_version(spark, target).filter(copied).unionByName(rows.filter(~copied))


def _clean(ticks: DataFrame, bands: PriceBands, once: bool, anchors: DataFrame | None = None) -> DataFrame:
    clean = clean_ticks(ticks, bands) if anchors is None else clean_with_anchor_table(ticks, anchors, bands.lower, bands.upper)
    return drop_repeats(clean) if once else clean


def replay_silver_day(
    spark: SparkSession,
    bronze: str,
    table: str,
    day: dt.date,
    bands: PriceBands = PriceBands(),
    once: bool = False,
    anchors: DataFrame | None = None,
) -> None:
    """Filter one day of bronze again, after a change of rule.

    Give ``once`` and ``anchors`` as the layer was written with: bronze keeps repeats. Only that day's bronze folder
    is read. ``table`` is one of :mod:`tickloom.sources.versions`: its readers see the day as it was until
    the new one is whole, also if the job dies half way.
    """
    ticks = spark.read.parquet(bronze).filter(F.col("ingest_date") == F.lit(day))
    rows = _clean(ticks, bands, once, anchors)
    versions.replace_parts(rows, table, "ingest_date", [day], ["symbol"], ["event_time"])


def replay_gold_day(
    spark: SparkSession,
    bronze: str,
    table: str,
    day: dt.date,
    bands: PriceBands = PriceBands(),
    size: int = WINDOW_SECONDS,
    slide: int = SLIDE_SECONDS,
    once: bool = False,
    final: bool = True,
    anchors: DataFrame | None = None,
) -> None:
    """Compute the windows that start on one day again.

    The last of them reach into the next day, so two bronze folders are read. Windows that the newest
    clean tick of all bronze leaves open are not final and stay out, as they do in the layer; with
    ``final=False`` they are written too, for a table that has them.
    """
    clean = _clean(spark.read.parquet(bronze), bands, False, anchors)
    reach = day + dt.timedelta(days=1 + size // 86400)
    ticks = spark.read.parquet(bronze).filter(
        F.col("ingest_date").between(F.lit(day), F.lit(reach))
    )
    windows = sliding_average(_clean(ticks, bands, once, anchors), size, slide)
    if final:
        # a layer without repeats writes a window one window length later
        windows = closed_windows(windows, clean, LATENESS_SECONDS + (size if once else 0))
    rows = windows.filter(F.col("window_date") == F.lit(day))
    versions.replace_parts(rows, table, "window_date", [day], sort_by=["window_start"])
