"""Outlier filter and removal of repeated ticks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.functions.bands import (
    LOWER_RATIO,
    UPPER_RATIO,
    PriceBands,
    inside_band,
    near_anchor,
    tradable,
)
from tickloom.operators.lookup import BROADCAST_BYTES, lookup_join
from tickloom.operators.ticks import add_event_time

REPEAT_KEY = ("symbol", "timestamp")


def clean_ticks(ticks: DataFrame, bands: PriceBands = PriceBands()) -> DataFrame:
    """Keep ticks with a sane price and volume whose price fits the symbol's band."""
    price = F.col("price")
    sane = ticks.filter(tradable(price, F.col("volume")))
    return sane.filter(inside_band(F.col("symbol"), price, bands))


def clean_with_anchor_table(
    ticks: DataFrame,
    anchors: DataFrame,
    lower: float = LOWER_RATIO,
    upper: float = UPPER_RATIO,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """The same filter with ``(symbol, anchor_price)`` rows, for many symbols.

    ``anchors`` must hold one row per symbol.
    """
    sane = ticks.filter(tradable(F.col("price"), F.col("volume")))
    judged = lookup_join(sane, anchors, ["symbol"], "left", broadcast_bytes)
    kept = judged.filter(near_anchor(F.col("price"), F.col("anchor_price"), lower, upper))
    return kept.select(*ticks.columns)


def has_whole_key() -> Column:
    """A tick with a NULL in its key cannot be told to repeat another one."""
    symbol, timestamp = (F.col(name).isNotNull() for name in REPEAT_KEY)
    return symbol & timestamp


def drop_repeats(ticks: DataFrame) -> DataFrame:
    """One tick per ``(symbol, timestamp)``, for messages a producer sent more than once.

    Where repeats disagree the lowest price, then the lowest volume is kept, so a task that
    runs again cannot change the result. Repeats are merged before the shuffle, and only the
    four raw columns travel. Ticks with a NULL in the key are all kept.
    """
    # a tick that cannot repeat another one is a group of its own, so the input is read once
    alone = F.when(~has_whole_key(), F.monotonically_increasing_id())
    keyed = ticks.select("symbol", "price", "volume", "timestamp", alone.alias("_alone")).groupBy(*REPEAT_KEY, "_alone")
    kept = keyed.agg(F.min(F.struct("price", "volume")).alias("kept"))
    return add_event_time(kept.select("symbol", "kept.price", "kept.volume", "timestamp"))
