"""Message transport: one reader and writer for the broker and for files of the same shape."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from tickloom.sources.schemas import MESSAGE

TOPIC = "financial_data"


def broker_options(
    servers: str,
    topic: str = TOPIC,
    starting: str = "latest",
    min_partitions: int | None = None,
    max_per_trigger: int | None = None,
) -> dict[str, str]:
    """Options of a Kafka read.

    ``min_partitions`` splits large offset ranges when a topic has fewer partitions than the
    cluster has cores; ``max_per_trigger`` bounds a micro-batch after a long pause.
    """
    if starting not in ("latest", "earliest") and not starting.lstrip().startswith("{"):
        raise ValueError(f"starting must be latest, earliest or offset JSON, not {starting!r}")
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting,
    }
    if min_partitions:
        options["minPartitions"] = str(min_partitions)
    if max_per_trigger:
        options["maxOffsetsPerTrigger"] = str(max_per_trigger)
    return options


def read_messages(
    spark: SparkSession,
    fmt: str,
    options: Mapping[str, str],
    path: str | None = None,
    streaming: bool = True,
) -> DataFrame:
    """Messages from ``kafka``, or from a folder of files that hold the same columns."""
    reader = (spark.readStream if streaming else spark.read).format(fmt).options(**options)
    if fmt == "kafka":
        return reader.load()
    return reader.schema(MESSAGE).load(path)


def write_messages(messages: DataFrame, servers: str, topic: str = TOPIC) -> None:
    """Publish ``key`` and ``value`` rows as one batch."""
    (
        messages.select("key", "value")
        .write.format("kafka")
        .options(**{"kafka.bootstrap.servers": servers, "topic": topic})
        .save()
    )
