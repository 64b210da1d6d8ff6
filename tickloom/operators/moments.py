"""Mergeable moments of ticks per symbol and minute, and the questions that need no more than them.

Moments are a few numbers for any number of ticks, and moments of parts merge into those of the whole. A
layer that grows writes them per batch; questions then read them instead of all ticks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MINUTE = 60
#: ``n_ticks`` counts all ticks, ``n_prices`` those with a price; ``m2`` sums squared distances from their mean.
MEASURES = ("n_ticks", "n_prices", "price_sum", "m2", "min_price", "max_price", "volume")


def tick_moments(ticks: DataFrame, seconds: int = MINUTE) -> DataFrame:
    """``(symbol, window_start)`` with the moments of its ticks; a tick without event time counts under NULL.

    All of them are aggregates with a map-side part, so a hot symbol is summed before it moves.
    """
    second = F.unix_seconds("event_time")
    start = F.timestamp_seconds(second - F.pmod(second, F.lit(seconds)))
    return ticks.groupBy("symbol", start.alias("window_start")).agg(
        F.count(F.lit(1)).alias("n_ticks"),
        F.count("price").alias("n_prices"),
        F.sum("price").alias("price_sum"),
        (F.var_pop("price") * F.count("price")).alias("m2"),
        F.min("price").alias("min_price"),
        F.max("price").alias("max_price"),
        F.sum("volume").alias("volume"),
    )


def merge_moments(moments: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The moments of groups of moments, by ``keys``.

    Squared distances from the common mean are those from the own means and, weighted, those of the own
    means from the common one. The latter are summed about the smallest mean of the group, so that large
    prices with small differences keep their digits; the table of moments is read twice for that.
    """
    near = moments.groupBy(*keys).agg(F.min(average()).alias("_near"))
    if keys:
        near = near.withColumnsRenamed({key: f"_{key}" for key in keys})
        same = [F.col(key).eqNullSafe(F.col(f"_{key}")) for key in keys]
        shifted = moments.join(near, same).drop(*(f"_{key}" for key in keys))
    else:
        shifted = moments.withColumn("_near", near.scalar())
    off, n = average() - F.col("_near"), F.col("n_prices")
    sums = shifted.groupBy(*keys).agg(
        F.sum("n_ticks").alias("n_ticks"),
        F.sum(n).alias("n_prices"),
        F.sum("price_sum").alias("price_sum"),
        F.try_divide(F.sum(n * off), F.sum(n)).alias("_off"),
        F.sum(n * off * off).alias("_apart"),
        F.sum("m2").alias("m2"),
        F.min("min_price").alias("min_price"),
        F.max("max_price").alias("max_price"),
        F.sum("volume").alias("volume"),
    )
    between = F.greatest(F.col("_apart") - F.col("n_prices") * F.col("_off") * F.col("_off"), F.lit(0.0))
    return sums.withColumn("m2", F.col("m2") + between).select(*keys, *MEASURES)


def average() -> Column:
    """The mean price of a row of moments; NULL where there is no price."""
    return F.try_divide("price_sum", "n_prices")


# --- questions, as of :mod:`tickloom.operators.olap` and :mod:`tickloom.operators.windows` ---


def daily_average(moments: DataFrame) -> DataFrame:
    """Average price per day and symbol."""
    daily = merge_moments(_by_day(moments), ["ingest_date", "symbol"])
    rows = daily.select("ingest_date", "symbol", F.round(average(), 6).alias("avg_price"), "n_ticks")
    return rows.orderBy("ingest_date", "symbol")


def volatility(moments: DataFrame) -> DataFrame:
    """Mean, sample standard deviation and coefficient of variation per symbol, wildest first."""
    spread = F.when(F.col("n_prices") > 1, F.sqrt(F.col("m2") / (F.col("n_prices") - 1)))
    rows = merge_moments(moments, ["symbol"]).select(
        "symbol",
        F.round(average(), 6).alias("mean_price"),
        F.round(spread, 6).alias("stddev_price"),
        F.round(F.try_divide(spread, average()) * 100, 4).alias("cv_pct"),
        "n_ticks",
    )
    return rows.orderBy(F.col("cv_pct").desc_nulls_last(), "symbol")


def peak_hours(moments: DataFrame) -> DataFrame:
    """Ticks and volume per hour of day in UTC, busiest first."""
    hours = moments.groupBy(F.hour("window_start").alias("hour_utc"))
    rows = hours.agg(F.sum("n_ticks").alias("n_ticks"), F.round(F.sum("volume"), 2).alias("total_volume"))
    return rows.orderBy(F.col("total_volume").desc_nulls_last(), "hour_utc")


def rollup_volume(moments: DataFrame) -> DataFrame:
    """Volume per day and symbol, per day, and in total."""
    return _subtotals(moments, "rollup")


def cube_volume(moments: DataFrame) -> DataFrame:
    """As :func:`rollup_volume`, and per symbol over all days."""
    return _subtotals(moments, "cube")


def _subtotals(moments: DataFrame, kind: str) -> DataFrame:
    sums = _by_day(moments).groupBy("ingest_date", "symbol").agg(F.sum("volume").alias("volume"), F.sum("n_ticks").alias("ticks"))
    levels = getattr(sums, kind)("ingest_date", "symbol").agg(
        F.round(F.sum("volume"), 2).alias("total_volume"),
        F.coalesce(F.sum("ticks"), F.lit(0)).alias("n_ticks"),
        F.grouping_id().alias("level"),
    )
    return levels.orderBy(F.col("ingest_date").asc_nulls_last(), F.col("symbol").asc_nulls_last(), "level")


def price_series(moments: DataFrame, seconds: int = MINUTE) -> DataFrame:
    """Average price per symbol and interval of whole minutes."""
    rows = merge_moments(_by_interval(moments, seconds), ["window_start", "symbol"])
    return rows.select("window_start", "symbol", average().alias("avg_price"))


def volume_series(moments: DataFrame, seconds: int = 300) -> DataFrame:
    """Summed volume per symbol and interval of whole minutes."""
    rows = _by_interval(moments, seconds).groupBy("window_start", "symbol")
    return rows.agg(F.sum("volume").alias("total_volume"))


def running_stats(moments: DataFrame) -> DataFrame:
    """Lowest, highest and average price, volume and tick count per symbol."""
    rows = merge_moments(moments, ["symbol"])
    return rows.select(
        "symbol", "min_price", "max_price", average().alias("avg_price"), F.col("volume").alias("total_volume"), "n_ticks"
    )


def _by_day(moments: DataFrame) -> DataFrame:
    return moments.withColumn("ingest_date", F.to_date("window_start"))


def _by_interval(moments: DataFrame, seconds: int) -> DataFrame:
    if seconds % MINUTE:
        raise ValueError("moments are kept by the minute")
    second = F.unix_seconds("window_start")
    start = F.timestamp_seconds(second - F.pmod(second, F.lit(seconds)))
    return moments.filter("window_start IS NOT NULL").withColumn("window_start", start)
