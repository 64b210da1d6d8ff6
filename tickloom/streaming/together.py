"""Bronze, silver, late ticks and moments from one parse of the messages, batch by batch."""

from __future__ import annotations

import datetime as dt

from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tickloom.functions.bands import PriceBands, inside_band, near_anchor, tradable
from tickloom.operators.lookup import lookup_join
from tickloom.operators.moments import tick_moments
from tickloom.operators.ticks import decode_messages
from tickloom.operators.windows import LATENESS_SECONDS
from tickloom.sources.tables import NOT_READY, overwrite_folder
from tickloom.streaming.observe import batch_watermark
from tickloom.streaming.runtime import start_batches

#: The tables, and the columns that partition a batch of each.
TABLES = {"bronze": ("ingest_date",), "silver": ("ingest_date", "symbol"), "late": ("ingest_date",), "moments": ()}
BATCHES = "batch_id BIGINT, watermark TIMESTAMP, committed TIMESTAMP"
#: Declared, so that a symbol of digits stays text.
TICKS = "price DOUBLE, volume DOUBLE, timestamp BIGINT, event_time TIMESTAMP, batch_id BIGINT, ingest_date DATE, symbol STRING"
SCHEMAS = {
    "bronze": TICKS,
    "silver": TICKS,
    "late": f"{TICKS}, watermark TIMESTAMP",
    "moments": "symbol STRING, window_start TIMESTAMP, n_ticks BIGINT, n_prices BIGINT, price_sum DOUBLE, m2 DOUBLE,"
    " min_price DOUBLE, max_price DOUBLE, volume DOUBLE, batch_id BIGINT",
}


def start_together(
    messages: DataFrame,
    root: str,
    bands: PriceBands = PriceBands(),
    anchors: DataFrame | None = None,
    lateness: int = LATENESS_SECONDS,
    every: str | None = None,
    name: str = "together",
) -> StreamingQuery:
    """Start one query that parses every message once and writes all tables of a batch.

    ``bronze`` holds every message, ``silver`` the clean ticks, ``moments`` those of silver per symbol and
    minute. ``late`` holds the clean ticks that came after the watermark of their batch, ``lateness``
    seconds behind the latest event before it, with that watermark: what a window over this stream may
    have missed. A tick without event time is not late. ``anchors (symbol, anchor_price)`` replaces the
    anchors of ``bands``.

    A batch is written to folders of its own and counts from the moment its row is in ``batches``, which
    comes last. A batch that runs again after a failure overwrites what it had written, or leaves it if
    it was whole; readers see a batch in all tables or in none.
    """
    rows = decode_messages(messages).drop("kafka_ts").withWatermark("event_time", f"{lateness} seconds")
    checkpoint = f"{root}/checkpoints/{name}"

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        done = committed_batches(spark, root).filter(F.col("batch_id") == batch_id)
        if done.isEmpty():
            write_batch(batch, batch_id, root, batch_watermark(spark, checkpoint, batch_id), bands, anchors)

    return start_batches(rows, name, checkpoint, "append", write, every)


def write_batch(
    batch: DataFrame, batch_id: int, root: str, watermark: dt.datetime | None, bands: PriceBands, anchors: DataFrame | None = None
) -> None:
    """Write all tables of a batch, then the row that makes it count.

    The parsed batch is kept on disk and in memory while it is written; what a lost executor kept is
    parsed again from the source.
    """
    spark, columns = batch.sparkSession, batch.columns
    judged = _judged(batch, bands, anchors).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        silver = judged.filter("_clean").select(*columns)
        tables = {"bronze": judged.select(*columns), "silver": silver, "moments": tick_moments(silver)}
        if watermark is not None:
            late = silver.filter(F.col("event_time") < F.lit(watermark)).withColumn("watermark", F.lit(watermark))
            tables["late"] = late
        for name, rows in tables.items():
            parts = TABLES[name]
            dealt = rows.hint("rebalance", *parts) if parts else rows
            overwrite_folder(dealt, f"{root}/{name}/batch_id={batch_id}", parts, ["event_time"] if parts else [])
    finally:
        judged.unpersist()
    row = spark.createDataFrame([(batch_id, watermark)], "batch_id BIGINT, watermark TIMESTAMP")
    row.withColumn("committed", F.current_timestamp()).coalesce(1).write.mode("append").parquet(f"{root}/batches")


def _judged(batch: DataFrame, bands: PriceBands, anchors: DataFrame | None) -> DataFrame:
    sane = tradable(F.col("price"), F.col("volume"))
    if anchors is None:
        return batch.withColumn("_clean", _true(sane & inside_band(F.col("symbol"), F.col("price"), bands)))
    known = lookup_join(batch, anchors, ["symbol"], "left")
    inside = near_anchor(F.col("price"), F.col("anchor_price"), bands.lower, bands.upper)
    return known.withColumn("_clean", _true(sane & inside)).drop("anchor_price")


def _true(verdict: Column) -> Column:
    return F.coalesce(verdict, F.lit(False))


def committed_batches(spark: SparkSession, root: str) -> DataFrame:
    """``(batch_id, watermark, committed)`` of the batches that count; a batch committed twice is one."""
    try:
        rows = spark.read.schema(BATCHES).parquet(f"{root}/batches")
    except AnalysisException as problem:
        if problem.getCondition() not in NOT_READY:
            raise
        return spark.createDataFrame([], BATCHES)
    return rows.groupBy("batch_id").agg(F.min("watermark").alias("watermark"), F.min("committed").alias("committed"))


def read_together(spark: SparkSession, root: str, table: str) -> DataFrame:
    """A table without the batch that is being written; without rows before the first one counts.

    Batches are committed in order, so what counts is a range of their numbers and prunes folders.
    """
    last = committed_batches(spark, root).agg(F.max("batch_id")).first()[0]
    try:
        rows = spark.read.schema(SCHEMAS[table]).parquet(f"{root}/{table}")
    except AnalysisException as problem:
        if problem.getCondition() not in NOT_READY:
            raise
        rows = spark.createDataFrame([], SCHEMAS[table])
    return rows.filter(F.col("batch_id") <= (-1 if last is None else last))


def in_time(spark: SparkSession, root: str) -> DataFrame:
    """Silver without the late ticks: what windows over the stream may have taken in."""
    silver = read_together(spark, root, "silver")
    marks = committed_batches(spark, root).select("batch_id", "watermark")
    taken = F.col("watermark").isNull() | F.col("event_time").isNull() | (F.col("event_time") >= F.col("watermark"))
    return lookup_join(silver, marks, ["batch_id"]).filter(taken).drop("watermark")
