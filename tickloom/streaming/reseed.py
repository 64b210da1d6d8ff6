"""Going on with another number of state partitions: a new gold query seeded from an old one's state.

A checkpoint fixes how many partitions its state has. The state itself is a table that Spark can read: one
row per open window and symbol with the sums so far. A new query takes these rows in as its first input.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tickloom.functions.bands import PriceBands
from tickloom.operators.windows import LATENESS_SECONDS, SLIDE_SECONDS, WINDOW_SECONDS
from tickloom.streaming.medallion import GOLD, silver_rows
from tickloom.streaming.observe import committed_watermark
from tickloom.streaming.runtime import start_table

#: Sums of ticks at ``event_time``; those of one window alone if ``only`` is its start. A row without ``symbol``
#: and sums is the clock: it tells the watermark, and no window takes it in.
PARTS = (
    "symbol STRING, event_time TIMESTAMP, price_sum DOUBLE, n_prices BIGINT, n_ticks BIGINT, only TIMESTAMP, clock BOOLEAN"
)


def export_open_windows(spark: SparkSession, checkpoint: str, path: str, lateness: int = LATENESS_SECONDS) -> None:
    """Write the open windows of a stopped gold query and its watermark as seeds of another one.

    Both are as of its last committed batch, which is also where the new query's messages must begin.
    """
    state = spark.read.format("statestore").load(checkpoint)
    sums = F.col("value").cast("struct<price_sum: double, n_prices: bigint, n_ticks: bigint>")
    start = F.col("key.window.start")
    windows = state.select(
        F.col("key.symbol").alias("symbol"), start.alias("event_time"), sums.alias("sums"), start.alias("only")
    ).select("symbol", "event_time", "sums.*", "only", F.lit(False).alias("clock"))
    mark = committed_watermark(spark, checkpoint)
    moment = None if mark is None else F.lit(mark) + F.make_dt_interval(secs=F.lit(lateness))
    clock = spark.range(1).select(
        F.lit(None).cast("string").alias("symbol"),
        F.lit(moment).cast("timestamp").alias("event_time"),
        *(F.lit(None).cast(kind).alias(name) for name, kind in (("price_sum", "double"), ("n_prices", "bigint"), ("n_ticks", "bigint"))),
        F.lit(None).cast("timestamp").alias("only"),
        F.lit(True).alias("clock"),
    )
    windows.unionByName(clock).write.parquet(path)


def seeded_gold_rows(
    messages: DataFrame,
    seeds: str,
    bands: PriceBands = PriceBands(),
    size: int = WINDOW_SECONDS,
    slide: int = SLIDE_SECONDS,
    lateness: int = LATENESS_SECONDS,
) -> DataFrame:
    """Sliding averages over silver rows that go on from exported windows.

    The sums of ticks and seeds are added up alike. Windows that the old query had closed take nothing in,
    also in the first batch, before the clock has moved the watermark.
    """
    spark = messages.sparkSession
    one = F.lit(1).cast("long")
    ticks = silver_rows(messages, bands).select(
        "symbol",
        "event_time",
        F.col("price").alias("price_sum"),
        F.when(F.col("price").isNotNull(), one).otherwise(0).cast("long").alias("n_prices"),
        one.alias("n_ticks"),
        F.lit(None).cast("timestamp").alias("only"),
        F.lit(False).alias("clock"),
    )
    closed = spark.read.schema(PARTS).parquet(seeds).filter("clock").agg(F.max("event_time")).first()[0]
    timed = ticks.unionByName(spark.readStream.schema(PARTS).parquet(seeds)).withWatermark("event_time", f"{lateness} seconds")
    spread = timed.withColumn("window", F.window("event_time", f"{size} seconds", f"{slide} seconds"))
    taken = ~F.col("clock") & (F.col("only").isNull() | (F.col("only") == F.col("window.start")))
    if closed is not None:
        taken = taken & (F.col("window.end") > F.lit(closed) - F.make_dt_interval(secs=F.lit(lateness)))
    sums = spread.filter(taken).groupBy("window", "symbol").agg(
        F.sum("price_sum").alias("price_sum"), F.sum("n_prices").alias("n_prices"), F.sum("n_ticks").alias("n_ticks")
    )
    return sums.select(
        "symbol",
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        F.try_divide("price_sum", "n_prices").alias("avg_price"),
        "n_ticks",
        F.to_date("window.start").alias("window_date"),
    )


def start_seeded_gold(
    messages: DataFrame, seeds: str, path: str, checkpoint: str, bands: PriceBands = PriceBands(), every: str | None = None,
    state_partitions: int | None = None,
) -> StreamingQuery:
    """Start a gold query that goes on from exported windows, with its own table and checkpoint.

    The table is another one than the old query's, whose sink log counts the batches of its checkpoint;
    the two together are gold. The new query restarts from its own checkpoint, with the same seeds.
    """
    rows = seeded_gold_rows(messages, seeds, bands)
    return start_table(rows, "gold_seeded_parquet", path, checkpoint, GOLD.partition_by, every, state_partitions)


def resume_offsets(spark: SparkSession, checkpoint: str) -> list[dict]:
    """Where each source of a query stands after its last committed batch.

    Of a Kafka source this is ``{topic: {partition: offset}}``, as ``startingOffsets`` takes it.
    """
    commits = spark.read.text(f"{checkpoint}/commits").select(F.input_file_name().alias("file")).distinct()
    last = commits.agg(F.max(F.element_at(F.split("file", "/"), -1).cast("long"))).first()[0]
    lines = [row.value for row in spark.read.text(f"{checkpoint}/offsets/{last}", wholetext=True).collect()]
    # after the version and the settings, a line a source; a source that has not begun has a dash
    return [json.loads(line) for line in lines[0].splitlines()[2:] if line != "-"]
