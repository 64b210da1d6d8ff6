"""The ``events`` table as ticks, messages and API payloads.

The event type becomes the symbol, ``value`` the price and the number in ``props`` the
volume, so every job can run on that table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.functions.bands import PriceBands
from tickloom.operators.ticks import add_event_time, encode_messages
from tickloom.sources.messages import TOPIC

EVENT_BANDS = PriceBands({"CLICKUSDT": 50.0, "VIEWUSDT": 40.0, "PURCHASEUSDT": 60.0})
BROKER_DELAY_SECONDS = 3


def read_events(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/events.parquet")


def stream_events(spark: SparkSession, folder: str, files_per_batch: int | None = None) -> DataFrame:
    """The same table as a stream, be it one file or a folder of files.

    A plain path to a single file is refused by the file source; a pattern is not.
    ``files_per_batch`` bounds a micro-batch, so that a long replay commits as it goes. Leave
    it unset below a watermark: files may come out of time order, and what is late is lost.
    """
    reader = spark.readStream.schema(read_events(spark, folder).schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(f"{folder}/[e]vents.parquet")


def _raw_ticks(events: DataFrame) -> DataFrame:
    """Tick columns next to the event's own; the JSON is read once per row."""
    moment = F.col("ts").cast("timestamp")
    return events.select(
        "event_id",
        moment.alias("moment"),
        F.concat(F.upper("event_type"), F.lit("USDT")).alias("symbol"),
        F.col("value").alias("price"),
        F.json_tuple("props", "k").alias("k"),
        F.unix_millis(moment).alias("timestamp"),
    ).withColumn("volume", F.col("k").try_cast("double"))


def event_ticks(events: DataFrame) -> DataFrame:
    """Ticks with ``event_time`` and ``ingest_date``."""
    return add_event_time(_raw_ticks(events).select("symbol", "price", "volume", "timestamp"))


def event_messages(events: DataFrame) -> DataFrame:
    """Messages in the broker's shape; a symbol always lands in the same partition."""
    return encode_messages(
        _raw_ticks(events),
        F.lit(TOPIC).alias("topic"),
        (F.length("symbol") % 3).alias("partition"),
        F.col("event_id").alias("offset"),
        (F.col("moment") + F.make_dt_interval(secs=F.lit(BROKER_DELAY_SECONDS))).alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )


def event_payloads(events: DataFrame) -> DataFrame:
    """API answers as JSON text, with prices and volumes as text."""

    def text(name: str) -> Column:
        return F.col(name).cast("string")

    answer = F.struct(
        "symbol", text("price").alias("lastPrice"), text("volume").alias("volume"),
        F.col("timestamp").alias("closeTime"),
    )
    return _raw_ticks(events).select(F.to_json(answer).alias("payload"))
