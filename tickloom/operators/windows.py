"""Event-time windows and running totals per symbol."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WINDOW_SECONDS = 60
SLIDE_SECONDS = 10
LATENESS_SECONDS = 120


def _seconds(count: int) -> str:
    return f"{count} seconds"


def _day_of_window(rows: DataFrame) -> DataFrame:
    return rows.withColumn("window_date", F.to_date("window_start"))


def sliding_average_stream(
    ticks: DataFrame,
    size: int = WINDOW_SECONDS,
    slide: int = SLIDE_SECONDS,
    lateness: int | None = LATENESS_SECONDS,
) -> DataFrame:
    """Average price and tick count per symbol and sliding window, for streams.

    With ``lateness`` set, a window closes once event time is that many seconds past its end.
    """
    timed = ticks if lateness is None else ticks.withWatermark("event_time", _seconds(lateness))
    span = F.window("event_time", _seconds(size), _seconds(slide))
    grouped = timed.groupBy(span, "symbol").agg(
        F.avg("price").alias("avg_price"), F.count(F.lit(1)).alias("n_ticks")
    )
    return _day_of_window(
        grouped.selectExpr(
            "symbol", "window.start AS window_start", "window.end AS window_end", "avg_price", "n_ticks"
        )
    )


def sliding_average(
    ticks: DataFrame, size: int = WINDOW_SECONDS, slide: int = SLIDE_SECONDS
) -> DataFrame:
    """The same windows over a batch table.

    Ticks are first summed per pane, the longest span that divides size and slide, then the few
    panes are spread over the windows that contain them, instead of copying every tick
    ``size / slide`` times. As on a stream, the slide may not be longer than the window.
    """
    if not 0 < slide <= size:
        raise ValueError("the slide must be positive and not longer than the window")
    length = math.gcd(size, slide)
    second = F.unix_seconds("event_time")
    panes = (
        ticks.filter(F.col("event_time").isNotNull())
        .groupBy("symbol", (second - F.pmod(second, F.lit(length))).alias("pane"))
        .agg(
            F.sum("price").alias("price_sum"),
            F.count("price").alias("n_prices"),
            F.count(F.lit(1)).alias("pane_ticks"),
        )
    )
    back = F.explode(F.array(*(F.lit(step) for step in range(0, size, slide))))
    start = F.col("pane") - F.pmod("pane", F.lit(slide)) - F.col("back")
    spread = panes.withColumn("back", back)
    if size % slide:  # the earliest of these windows may end before the pane
        spread = spread.filter(start + size > F.col("pane"))
    # grouped by the column that is returned, so that later groupings by it need no shuffle
    windows = spread.groupBy("symbol", F.timestamp_seconds(start).alias("window_start")).agg(
        F.try_divide(F.sum("price_sum"), F.sum("n_prices")).alias("avg_price"),
        F.sum("pane_ticks").alias("n_ticks"),
    )
    end = F.timestamp_seconds(F.unix_seconds("window_start") + size)
    return _day_of_window(
        windows.select("symbol", "window_start", end.alias("window_end"), "avg_price", "n_ticks")
    )


def closed_windows(
    windows: DataFrame, ticks: DataFrame, lateness: int = LATENESS_SECONDS
) -> DataFrame:
    """The windows a stream over ``ticks`` has emitted: those that end by the watermark."""
    latest = ticks.agg(F.max("event_time").alias("latest")).scalar()
    return windows.filter(
        F.col("window_end") <= latest - F.make_dt_interval(secs=F.lit(lateness))
    )


def running_stats(ticks: DataFrame) -> DataFrame:
    """Lowest, highest and average price, volume and tick count per symbol since the start.

    On a stream the state holds one row per symbol and is never dropped. ``volume`` is a
    rolling 24-hour figure on every tick, so its sum counts the same trades many times.
    """
    return ticks.groupBy("symbol").agg(
        F.min("price").alias("min_price"),
        F.max("price").alias("max_price"),
        F.avg("price").alias("avg_price"),
        F.sum("volume").alias("total_volume"),
        F.count(F.lit(1)).alias("n_ticks"),
    )


def _per_interval(ticks: DataFrame, seconds: int, measure: Column) -> DataFrame:
    grouped = ticks.groupBy(F.window("event_time", _seconds(seconds)), "symbol").agg(measure)
    return grouped.selectExpr("window.start AS window_start", "* EXCEPT (window)")


def price_series(ticks: DataFrame, seconds: int = 60) -> DataFrame:
    """Average price per symbol and interval, for a line chart."""
    return _per_interval(ticks, seconds, F.avg("price").alias("avg_price"))


def volume_series(ticks: DataFrame, seconds: int = 300) -> DataFrame:
    """Summed volume per symbol and interval, for a bar chart."""
    return _per_interval(ticks, seconds, F.sum("volume").alias("total_volume"))


def average_series(gold: DataFrame) -> DataFrame:
    """Average of the window averages per window start and symbol, for a line chart."""
    return gold.groupBy("window_start", "symbol").agg(F.avg("avg_price").alias("avg_price"))
