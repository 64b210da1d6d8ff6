"""Business questions on cleaned ticks.

Every function returns rows in report order. Sums of ``volume`` add a rolling 24-hour
figure per tick, so they compare symbols and hours but are not traded amounts.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _n_ticks() -> Column:
    return F.count(F.lit(1)).alias("n_ticks")


def daily_average(ticks: DataFrame) -> DataFrame:
    """Average price per day and symbol."""
    return (
        ticks.groupBy("ingest_date", "symbol")
        .agg(F.round(F.avg("price"), 6).alias("avg_price"), _n_ticks())
        .orderBy("ingest_date", "symbol")
    )


def volatility(ticks: DataFrame) -> DataFrame:
    """Mean, sample standard deviation and coefficient of variation per symbol, wildest first.

    A symbol with one tick has no deviation, a mean of zero has no coefficient: both NULL,
    and listed last.
    """
    mean, spread = F.avg("price"), F.stddev_samp("price")
    return (
        ticks.groupBy("symbol")
        .agg(
            F.round(mean, 6).alias("mean_price"),
            F.round(spread, 6).alias("stddev_price"),
            F.round(F.try_divide(spread, mean) * 100, 4).alias("cv_pct"),
            _n_ticks(),
        )
        .orderBy(F.col("cv_pct").desc_nulls_last(), "symbol")
    )


def most_volatile(ticks: DataFrame, top: int = 1) -> DataFrame:
    """The ``top`` symbols by coefficient of variation."""
    return volatility(ticks).limit(top)


def peak_hours(ticks: DataFrame) -> DataFrame:
    """Ticks and volume per hour of day in UTC, busiest first."""
    return (
        ticks.groupBy(F.hour("event_time").alias("hour_utc"))
        .agg(_n_ticks(), F.round(F.sum("volume"), 2).alias("total_volume"))
        .orderBy(F.col("total_volume").desc_nulls_last(), "hour_utc")
    )


def _subtotals(ticks: DataFrame, kind: str) -> DataFrame:
    """ROLLUP or CUBE over (ingest_date, symbol).

    Both copy each input row once per grouping set, so the ticks are reduced to one row per
    day and symbol before that. ``level`` tells a subtotal from a real NULL key.
    """
    daily = ticks.groupBy("ingest_date", "symbol").agg(
        F.sum("volume").alias("volume"), F.count(F.lit(1)).alias("ticks")
    )
    return (
        getattr(daily, kind)("ingest_date", "symbol")
        .agg(
            F.round(F.sum("volume"), 2).alias("total_volume"),
            F.coalesce(F.sum("ticks"), F.lit(0)).alias("n_ticks"),
            F.grouping_id().alias("level"),
        )
        .orderBy(
            F.col("ingest_date").asc_nulls_last(), F.col("symbol").asc_nulls_last(), "level"
        )
    )


def rollup_volume(ticks: DataFrame) -> DataFrame:
    """Volume per day and symbol, per day, and in total."""
    return _subtotals(ticks, "rollup")


def cube_volume(ticks: DataFrame) -> DataFrame:
    """As :func:`rollup_volume`, and per symbol over all days."""
    return _subtotals(ticks, "cube")


def symbol_check(ticks: DataFrame) -> DataFrame:
    """Average price and tick count per symbol."""
    return ticks.groupBy("symbol").agg(F.avg("price").alias("avg_price"), _n_ticks()).orderBy("symbol")


def layer_counts(layers: Mapping[str, DataFrame | None]) -> DataFrame:
    """One row ``(layer, n_rows)`` per layer; a layer that is not ready yet is left out."""
    counts = [
        rows.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("layer"), "n_rows")
        for name, rows in layers.items()
        if rows is not None
    ]
    if not counts:
        raise ValueError("no layer is ready")
    return reduce(DataFrame.unionByName, counts)


def first_rows(rows: DataFrame, n: int, *order: str | Column) -> DataFrame:
    """The first ``n`` rows in the given order, for a preview of a table."""
    return rows.orderBy(*order).limit(n)
