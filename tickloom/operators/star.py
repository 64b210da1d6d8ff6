"""Star schema: three dimensions, one fact table, and the questions asked of it."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.functions.clock import calendar_parts
from tickloom.functions.pairs import split_pair
from tickloom.operators.lookup import BROADCAST_BYTES, lookup_join
from tickloom.session import settings
from tickloom.sources.schemas import DIM_MARKET, MARKET_ROWS
from tickloom.sources.tables import read_table, write_table

# What the day of a moment fixes, and what its minute of the day fixes.
DAY_PARTS = ("year", "month", "day", "weekday")
MINUTE_PARTS = ("hour", "minute")


def dim_time(ticks: DataFrame) -> DataFrame:
    """One row per distinct event second with its calendar parts."""
    moments = ticks.select(F.col("event_time").alias("time_key")).distinct()
    return moments.withColumns(calendar_parts(F.col("time_key")))


def dim_symbol(ticks: DataFrame, quotes: Iterable[str] = ()) -> DataFrame:
    """One row per symbol with its base and quote asset."""
    base, quote = split_pair(F.col("symbol_key"), quotes)
    symbols = ticks.select("symbol").distinct().withColumnRenamed("symbol", "symbol_key")
    return symbols.select("symbol_key", base.alias("base_asset"), quote.alias("quote_asset"))


def dim_market(spark: SparkSession) -> DataFrame:
    """The venues ticks can come from: one row."""
    return spark.createDataFrame(MARKET_ROWS, DIM_MARKET)


def fact_ticks(ticks: DataFrame) -> DataFrame:
    """The measures of every tick with its three keys."""
    (market, *_), *_ = MARKET_ROWS
    return ticks.withColumnsRenamed({"event_time": "time_key", "symbol": "symbol_key"}).select(
        "time_key", "symbol_key", F.lit(market).alias("market_key"), "price", "volume", "ingest_date"
    )


def write_star(ticks: DataFrame, root: str) -> dict[str, DataFrame]:
    """Write all four tables below ``root`` and read them back.

    ``ticks`` are computed once, for the facts, and are taken to come day by day; the
    dimensions then read one column each of the written facts. The days and minutes of ``dim_time`` are
    written too, see :func:`read_calendar`.
    """
    facts = write_table(fact_ticks(ticks), f"{root}/fact_ticks", ["ingest_date"], gather=False)
    keys = facts.withColumnsRenamed({"time_key": "event_time", "symbol_key": "symbol"})
    times = write_table(dim_time(keys), f"{root}/dim_time")
    for name, rows in calendar_of(times).tables().items():
        write_table(rows, f"{root}/{name}")
    return {
        "fact_ticks": facts,
        "dim_time": times,
        "dim_symbol": write_table(dim_symbol(keys), f"{root}/dim_symbol"),
        "dim_market": write_table(dim_market(ticks.sparkSession), f"{root}/dim_market"),
    }


def read_star(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The four tables below ``root``."""
    return {name: read_table(spark, f"{root}/{name}") for name in ("fact_ticks", "dim_time", "dim_symbol", "dim_market")}


def add_to_star(ticks: DataFrame, root: str) -> dict[str, DataFrame]:
    """Add the days of ``ticks`` to a written star and read it back.

    Facts of those days are replaced, so adding the same ticks again changes nothing. Of the dimensions only
    rows whose key is new are appended, as found in the written facts of those days.
    """
    spark, written = ticks.sparkSession, read_star(ticks.sparkSession, root)
    facts = fact_ticks(ticks)
    with settings(spark, {"spark.sql.sources.partitionOverwriteMode": "dynamic"}):
        facts.select(*written["fact_ticks"].columns).write.mode("overwrite").partitionBy("ingest_date").parquet(f"{root}/fact_ticks")
    days = [row[0] for row in ticks.select("ingest_date").distinct().collect()]
    same = F.coalesce(F.col("ingest_date").isin([F.lit(day) for day in days if day is not None]), F.lit(None in days))
    keys = read_table(spark, f"{root}/fact_ticks").filter(same)
    keys = keys.withColumnsRenamed({"time_key": "event_time", "symbol_key": "symbol"})
    times = dim_time(keys)
    append_new(times, f"{root}/dim_time", "time_key", ordered=True)
    append_new(dim_symbol(keys), f"{root}/dim_symbol", "symbol_key")
    for name, rows in calendar_of(times).tables().items():
        append_new(rows, f"{root}/{name}", f"{name.removeprefix('dim_')}_key")
    return read_star(spark, root)


def append_new(rows: DataFrame, path: str, key: str, ordered: bool = False) -> None:
    """Append the rows whose key a dimension does not know yet; NULL is a key like any other.

    With ``ordered`` the known keys are only read between the smallest and the largest new one, which
    Parquet's statistics prune. Running it again, also after it died half way, adds what is missing.
    """
    known = read_table(rows.sparkSession, path).select(F.col(key).alias("_known"))
    if ordered:
        low, high = rows.agg(F.min(key), F.max(key)).first()
        known = known.filter(F.col("_known").between(F.lit(low), F.lit(high)) | F.col("_known").isNull())
    new = rows.join(known, F.col(key).eqNullSafe(F.col("_known")), "left_anti")
    # the rows are found before the folder changes
    new.sortWithinPartitions(key).write.mode("append").parquet(path)


@dataclass(frozen=True)
class Calendar:
    """What ``dim_time`` says, by day and by minute of the day: two small tables however long it gets."""

    days: DataFrame
    minutes: DataFrame

    def tables(self) -> dict[str, DataFrame]:
        return {"dim_day": self.days, "dim_minute": self.minutes}


def calendar_of(times: DataFrame) -> Calendar:
    """The days and minutes of a time dimension."""
    return Calendar(
        times.select(F.to_date("time_key").alias("day_key"), *DAY_PARTS).distinct(),
        times.select(_minute().alias("minute_key"), *MINUTE_PARTS).distinct(),
    )


def read_calendar(spark: SparkSession, root: str) -> Calendar:
    """The calendar of a written star; no row of ``dim_time`` is read."""
    return Calendar(read_table(spark, f"{root}/dim_day"), read_table(spark, f"{root}/dim_minute"))


def _minute() -> Column:
    return F.hour("time_key") * 60 + F.minute("time_key")


def volume_by_asset(facts: DataFrame, symbols: DataFrame) -> DataFrame:
    """Volume and tick count per day and base asset, largest first within a day.

    The facts are summed per day and symbol before the join, so what is shuffled is a few
    rows per symbol and no symbol is hot any more.
    """
    daily = facts.groupBy("ingest_date", "symbol_key").agg(
        F.sum("volume").alias("volume"), F.count(F.lit(1)).alias("ticks")
    )
    return (
        daily.join(symbols, "symbol_key")
        .groupBy("ingest_date", "base_asset")
        .agg(
            F.round(F.sum("volume"), 2).alias("total_volume"), F.sum("ticks").alias("n_ticks")
        )
        .orderBy("ingest_date", F.col("total_volume").desc_nulls_last(), "base_asset")
    )


def join_calendar(
    facts: DataFrame,
    times: DataFrame | Calendar,
    parts: Sequence[str] = (*DAY_PARTS, *MINUTE_PARTS),
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Facts with calendar parts of ``dim_time``, which must know all their moments.

    That table has a row per second and outgrows any broadcast. What it says does not: its calendar has a
    row per day and one per minute of the day, so the facts do not move however long it gets. Give the
    calendar of :func:`read_calendar` where there is one; from ``dim_time`` itself it is derived first.
    """
    calendar = times if isinstance(times, Calendar) else calendar_of(times)
    for key, value, own, table in (
        ("day_key", F.to_date("time_key"), DAY_PARTS, calendar.days),
        ("minute_key", _minute(), MINUTE_PARTS, calendar.minutes),
    ):
        wanted = [name for name in own if name in parts]
        if wanted:
            joined = lookup_join(facts.withColumn(key, value), table.select(key, *wanted), [key], broadcast_bytes=broadcast_bytes)
            facts = joined.drop(key)
    return facts


def full_star(
    facts: DataFrame,
    times: DataFrame | Calendar,
    symbols: DataFrame,
    markets: DataFrame,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Every fact with the columns of all three dimensions.

    The dimensions are measured: small ones are broadcast, larger ones joined with salted
    keys. As for :func:`volume_by_calendar`, give the written facts.
    """
    joined = lookup_join(facts, symbols, ["symbol_key"], broadcast_bytes=broadcast_bytes)
    joined = lookup_join(joined, markets, ["market_key"], broadcast_bytes=broadcast_bytes)
    return join_calendar(joined, times, broadcast_bytes=broadcast_bytes)


def volume_by_calendar(
    facts: DataFrame,
    times: DataFrame | Calendar,
    symbols: DataFrame,
    markets: DataFrame,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Volume and tick count per venue, asset pair, weekday and hour, over the full star.

    The calendar is broadcast, and the facts are summed by the hour where they are.
    The other joins see a few sums per symbol. Give the written facts: in facts still being
    computed the market key is a literal, and a join on a literal is planned as a cross join.
    """
    measures = [F.sum("volume").alias("volume"), F.sum("ticks").alias("ticks")]
    keys = ["symbol_key", "market_key"]
    clock = ["weekday", "hour"]
    counted = facts.select("time_key", *keys, "volume", F.lit(1).alias("ticks"))
    timed = join_calendar(counted, times, clock, broadcast_bytes)
    by_hour = timed.groupBy(*clock, *keys).agg(*measures)
    labels = ["exchange", "venue_type", "settlement_currency", "base_asset", "quote_asset"]
    return (
        by_hour.join(symbols, "symbol_key")
        .join(markets, "market_key")
        .groupBy(*labels, *clock)
        .agg(
            F.round(F.sum("volume"), 2).alias("total_volume"), F.sum("ticks").alias("n_ticks")
        )
        .orderBy(*labels, *clock)
    )
