"""Latency, offsets and the contents of a checkpoint."""

from __future__ import annotations

import datetime as dt
import re

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tickloom.functions.clock import instant, whole_seconds_between
from tickloom.sources.tables import NOT_READY


def with_lag(ticks: DataFrame, now: str | None = None) -> DataFrame:
    """Add ``lag_seconds``: how old a tick is when Spark sees it."""
    seen = ticks.withColumn("now", instant(now))
    return seen.withColumn("lag_seconds", whole_seconds_between(F.col("event_time"), F.col("now")))


def with_split_lag(ticks: DataFrame, now: str | None = None) -> DataFrame:
    """Split the lag in two: broker to Spark, which the pipeline controls, and how stale the
    tick was when the broker took it, which it does not."""
    seen = ticks.withColumn("now", instant(now))
    return seen.withColumns(
        {
            "kafka_to_spark_s": whole_seconds_between(F.col("kafka_ts"), F.col("now")),
            "api_freshness_s": whole_seconds_between(F.col("event_time"), F.col("kafka_ts")),
        }
    ).select("symbol", "price", "kafka_ts", "now", "kafka_to_spark_s", "api_freshness_s")


def offset_span(messages: DataFrame) -> DataFrame:
    """First offset, next offset and their distance per topic partition."""
    spans = messages.groupBy("topic", "partition").agg(
        F.min("offset").alias("first_offset"), (F.max("offset") + 1).alias("next_offset")
    )
    return spans.withColumn("span", F.col("next_offset") - F.col("first_offset")).orderBy(
        "topic", "partition"
    )


TOPIC_PARTITION = ("topic", "partition")
#: Offsets that one task puts in order at once.
OFFSET_RANGE = 1 << 20


def offset_report(messages: DataFrame, size: int = OFFSET_RANGE) -> DataFrame:
    """What a topic partition holds: its span as in :func:`offset_span`, and how whole that is.

    ``n_rows`` counts messages, ``n_offsets`` distinct offsets, ``n_repeats`` the messages whose offset was
    there already, ``n_missing`` the offsets inside the span that no message has, ``n_gaps`` the runs they
    form. A message without offset counts in ``n_rows`` alone.
    """
    runs = _runs(messages, size)
    counts = messages.groupBy(*TOPIC_PARTITION).agg(F.count(F.lit(1)).alias("n_rows"), F.count("offset").alias("_with"))
    spans = runs.groupBy(*TOPIC_PARTITION).agg(
        F.min("first").alias("first_offset"),
        (F.max("last") + 1).alias("next_offset"),
        F.sum("n_offsets").alias("n_offsets"),
        F.sum("n_gaps").alias("n_gaps"),
    )
    same = [F.col(f"counts.{name}").eqNullSafe(F.col(f"spans.{name}")) for name in TOPIC_PARTITION]
    joined = counts.alias("counts").join(spans.alias("spans"), same, "left")
    span = F.col("next_offset") - F.col("first_offset")
    none = F.lit(0).cast("long")
    return joined.select(
        "counts.topic",
        "counts.partition",
        "first_offset",
        "next_offset",
        span.alias("span"),
        "n_rows",
        F.coalesce("n_offsets", none).alias("n_offsets"),
        (F.col("_with") - F.coalesce("n_offsets", none)).alias("n_repeats"),
        F.coalesce(span - F.col("n_offsets"), none).alias("n_missing"),
        F.coalesce("n_gaps", none).alias("n_gaps"),
    ).orderBy("topic", "partition")


def offset_gaps(messages: DataFrame, size: int = OFFSET_RANGE) -> DataFrame:
    """``(topic, partition, first_missing, last_missing)``: every run of offsets that no message has.

    Offsets are put in order range by range, so no task sees a whole topic partition; what lies between
    ranges is found from one row a range.
    """
    ordered = _in_order(messages, size)
    before = F.lag("offset").over(Window.partitionBy(*TOPIC_PARTITION, "_range").orderBy("offset"))
    inside = ordered.withColumn("_before", before).select(*TOPIC_PARTITION, "_before", F.col("offset").alias("_after"))
    between = _runs(messages, size).select(*TOPIC_PARTITION, F.col("before").alias("_before"), F.col("first").alias("_after"))
    steps = inside.unionByName(between).filter(F.col("_after") - F.col("_before") > 1)
    return steps.select(*TOPIC_PARTITION, (F.col("_before") + 1).alias("first_missing"), (F.col("_after") - 1).alias("last_missing"))


def _in_order(messages: DataFrame, size: int) -> DataFrame:
    """Distinct offsets with the range they belong to; copies are merged before they move."""
    offsets = messages.filter("offset IS NOT NULL").select(*TOPIC_PARTITION, "offset").distinct()
    return offsets.withColumn("_range", F.floor(F.col("offset") / size))


def _runs(messages: DataFrame, size: int) -> DataFrame:
    """A row per range: its first and last offset, the last one before it, and the gaps up to its end."""
    within = Window.partitionBy(*TOPIC_PARTITION, "_range").orderBy("offset")
    stepped = _in_order(messages, size).withColumn("_step", F.col("offset") - F.lag("offset").over(within))
    ranges = stepped.groupBy(*TOPIC_PARTITION, "_range").agg(
        F.min("offset").alias("first"),
        F.max("offset").alias("last"),
        F.count(F.lit(1)).alias("n_offsets"),
        F.count(F.when(F.col("_step") > 1, 1)).alias("_gaps"),
    )
    before = F.lag("last").over(Window.partitionBy(*TOPIC_PARTITION).orderBy("_range"))
    joined = ranges.withColumn("before", before)
    gap = F.when(F.col("first") - F.col("before") > 1, 1).otherwise(0)
    return joined.select(*TOPIC_PARTITION, "first", "last", "before", "n_offsets", (F.col("_gaps") + gap).alias("n_gaps"))


def checkpoint_files(spark: SparkSession, checkpoint: str) -> DataFrame:
    """Every file of a checkpoint with its folder and size; contents are not read."""
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(checkpoint)
    )
    # Listed paths carry scheme and host, whether or not the given one does.
    bare = re.sub(r"^[A-Za-z0-9]+:(//[^/]*)?", "", checkpoint.rstrip("/")) + "/"
    inside = F.substring(F.col("path"), F.instr("path", bare) + len(bare), F.length("path"))
    return files.select(
        F.element_at(F.split(inside, "/"), 1).alias("folder"),
        inside.alias("file"),
        F.col("length").alias("bytes"),
    )


def batch_watermark(spark: SparkSession, checkpoint: str, batch_id: int) -> dt.datetime | None:
    """The watermark that a micro-batch runs with, from the plan that is logged before it runs.

    None as long as no event time has moved it, and for a query without one.
    """
    lines = spark.read.text(f"{checkpoint}/offsets/{batch_id}")
    return _moment(lines.filter("value LIKE '%batchWatermarkMs%'"), "$.batchWatermarkMs")


def committed_watermark(spark: SparkSession, checkpoint: str) -> dt.datetime | None:
    """The watermark that a query will go on with, from the last batch it has committed; None if there is none."""
    try:
        commits = spark.read.text(f"{checkpoint}/commits")
    except AnalysisException as problem:
        if problem.getCondition() in NOT_READY:
            return None
        raise
    return _moment(commits.filter("value LIKE '%nextBatchWatermarkMs%'"), "$.nextBatchWatermarkMs")


def _moment(lines: DataFrame, field: str) -> dt.datetime | None:
    """The largest value of a field of JSON lines, in UTC; the watermark never goes back."""
    ms = lines.agg(F.max(F.get_json_object("value", field).cast("bigint"))).first()[0]
    return dt.datetime.fromtimestamp(ms / 1000, dt.timezone.utc) if ms else None


def state_operators(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The stateful operators of a checkpoint and their number of partitions."""
    return spark.read.format("state-metadata").load(checkpoint)


def open_windows(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The windows a sliding-average query still holds in its state."""
    state = spark.read.format("statestore").load(checkpoint)
    return state.selectExpr("key.symbol", "key.window.start AS window_start", "key.window.end AS window_end")
