"""The record shapes shared by every batch and streaming job."""

from __future__ import annotations

from pyspark.sql.types import StructType

# Column names and types of the public record formats.
TICK = (
    StructType()
    .add("symbol", "string", nullable=False)
    .add("price", "double", nullable=False)
    .add("volume", "double", nullable=False)
    .add("timestamp", "long", nullable=False)
)
MESSAGE = (
    StructType()
    .add("key", "binary")
    .add("value", "binary")
    .add("topic", "string")
    .add("partition", "integer")
    .add("offset", "long")
    .add("timestamp", "timestamp")
    .add("timestampType", "integer")
)
# Every field is read as text first, so that one bad number does not spoil its row.
API_PAYLOAD = (
    StructType()
    .add("symbol", "string")
    .add("lastPrice", "string")
    .add("volume", "string")
    .add("closeTime", "string")
)
DIM_MARKET = (
    StructType()
    .add("market_key", "string")
    .add("exchange", "string")
    .add("venue_type", "string")
    .add("settlement_currency", "string")
)
MARKET_ROWS = [("BINANCE_SPOT", "Binance", "SPOT", "USD")]
