"""Messages and API payloads to typed ticks, and back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.functions.clock import event_time
from tickloom.sources.schemas import API_PAYLOAD, TICK


def encode_messages(ticks: DataFrame, *extra: str | Column) -> DataFrame:
    """One ``(key, value)`` row per tick, plus any ``extra`` columns.

    The symbol is the key, so the ticks of a symbol stay in order.
    """
    body = F.to_json(F.struct(*TICK.fieldNames()))
    return ticks.select(
        F.col("symbol").cast("binary").alias("key"), body.cast("binary").alias("value"), *extra
    )


def decode_messages(messages: DataFrame, precision: str = "second") -> DataFrame:
    """Parse message values into ticks with ``kafka_ts``, ``event_time`` and ``ingest_date``.

    No row is lost: a value that is not JSON gives a row of NULLs, a bad field gives a NULL.

    The JSON is unpacked with a generator. Filters on the fields stay above it, so every
    value is parsed once; with a plain projection the optimizer copies the parse into the
    filter, once per field it tests.
    """
    record = F.from_json(F.col("value").cast("string"), TICK)
    fields = messages.select(F.inline(F.array(record)), F.col("timestamp").alias("kafka_ts"))
    return add_event_time(fields, precision)


def add_event_time(ticks: DataFrame, precision: str = "second") -> DataFrame:
    """Add ``event_time`` and ``ingest_date``, both from the tick's own timestamp."""
    moment = event_time(F.col("timestamp"), precision)
    return ticks.withColumn("event_time", moment).withColumn("ingest_date", F.to_date("event_time"))


def normalise_payloads(payloads: DataFrame, column: str = "payload") -> DataFrame:
    """API answers (JSON text) to ticks: renamed fields, text turned into numbers.

    A field that is not a number gives NULL.
    """
    answer = payloads.select(F.inline(F.array(F.from_json(F.col(column), API_PAYLOAD))))
    return answer.select(
        "symbol",
        F.col("lastPrice").try_cast("double").alias("price"),
        F.col("volume").try_cast("double").alias("volume"),
        F.col("closeTime").try_cast("bigint").alias("timestamp"),
    )
