"""Small hand-made rows and how to turn them into files a stream can pick up."""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import functions as F

from tickloom.operators.ticks import add_event_time
from tickloom.sources.schemas import MESSAGE

# A published sample of five messages.
PUBLISHED = [
    ("ETHUSDT", 2313.57, 372630.82, 1776940116013),
    ("ADAUSDT", 0.2455, 114054000.0, 1776940117003),
    ("BTCUSDT", 77379.31, 18422.16, 1776940115002),
    ("BNBUSDT", 631.52, 127307.82, 1776940117008),
    ("SOLUSDT", 85.38, 2595530.01, 1776940116625),
]
TICK_DDL = "symbol STRING, price DOUBLE, volume DOUBLE, timestamp BIGINT"
START = 1_704_067_200_000  # 2024-01-01T00:00:00Z


def at(seconds: float) -> int:
    return START + int(seconds * 1000)


def clock(seconds: int) -> dt.datetime:
    return dt.datetime(2024, 1, 1) + dt.timedelta(seconds=seconds)


def ticks(spark, rows):
    return add_event_time(spark.createDataFrame(rows, TICK_DDL))


def body(row) -> str:
    return json.dumps(dict(zip(("symbol", "price", "volume", "timestamp"), row)))


def messages(spark, values, topic="financial_data", broker_time="2024-01-01 01:00:00"):
    """Message rows from texts, None or tick tuples."""
    texts = [body(value) if isinstance(value, tuple) else value for value in values]
    rows = spark.createDataFrame(list(enumerate(texts)), "offset BIGINT, text STRING")
    return rows.select(
        F.lit(None).cast("binary").alias("key"),
        F.col("text").cast("binary").alias("value"),
        F.lit(topic).alias("topic"),
        F.lit(0).alias("partition"),
        "offset",
        F.lit(broker_time).cast("timestamp").alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )


def arrive(spark, values, inbox: str) -> None:
    """Add one file of messages to a folder that a stream reads."""
    messages(spark, values).coalesce(1).write.mode("append").parquet(inbox)


def stream(spark, inbox: str, **options):
    return spark.readStream.schema(MESSAGE).options(**options).parquet(inbox)


def values(rows, *order):
    """All rows as tuples, in the given order."""
    return [tuple(row) for row in (rows.orderBy(*order) if order else rows).collect()]
