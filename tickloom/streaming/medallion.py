"""Bronze, silver and gold layers fed by one message stream."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tickloom.functions.bands import PriceBands
from tickloom.operators.cleaning import clean_ticks, clean_with_anchor_table
from tickloom.operators.ticks import decode_messages
from tickloom.operators.windows import LATENESS_SECONDS, WINDOW_SECONDS, sliding_average_stream
from tickloom.streaming.runtime import start_table
from tickloom.streaming.settle import MEMORY_SECONDS, settle_repeats_stream


#: Silver remembers ticks for a day, so that a late one is only dropped when later than that.
SILVER_MEMORY_SECONDS = MEMORY_SECONDS
#: Gold must let every tick pass that an open window could still take in.
GOLD_MEMORY_SECONDS = LATENESS_SECONDS + WINDOW_SECONDS


@dataclass(frozen=True)
class Layer:
    """Where a layer lives below the lake root, and how it is written."""

    name: str
    folder: str
    checkpoint: str
    partition_by: tuple[str, ...]
    every: str
    time_column: str

    def path(self, root: str) -> str:
        return f"{root}/{self.folder}"

    def checkpoint_path(self, root: str) -> str:
        return f"{root}/checkpoints/{self.checkpoint}"

    def start(
        self,
        rows: DataFrame,
        root: str,
        live: bool = True,
        state_partitions: int | None = None,
    ) -> StreamingQuery:
        """Write ``rows`` on the layer's trigger, or what is there now if not ``live``."""
        return start_table(
            rows,
            f"{self.name}_parquet",
            self.path(root),
            self.checkpoint_path(root),
            self.partition_by,
            self.every if live else None,
            state_partitions,
        )


# Folders, partition columns and triggers of the three layers.
BRONZE = Layer("bronze", "bronze/ticks", "bronze", ("ingest_date",), "20 seconds", "event_time")
SILVER = Layer(
    "silver", "silver/ticks", "silver", ("ingest_date", "symbol"), "20 seconds", "event_time"
)
GOLD = Layer(
    "gold", "gold/moving_avg", "gold_moving_avg", ("window_date",), "30 seconds", "window_start"
)
LAYERS = (BRONZE, SILVER, GOLD)


def bronze_rows(messages: DataFrame) -> DataFrame:
    """Every message as a tick, nothing removed; junk lands in the NULL date partition."""
    return decode_messages(messages).drop("kafka_ts")


def silver_rows(
    messages: DataFrame,
    bands: PriceBands = PriceBands(),
    once: bool = False,
    anchors: DataFrame | None = None,
    memory: int = SILVER_MEMORY_SECONDS,
) -> DataFrame:
    """Bronze rows that pass the outlier filter; with ``once``, without repeated ticks.

    ``anchors (symbol, anchor_price)`` replaces the anchors of ``bands`` and may have any size. With
    ``once``, a tick comes when event time is two minutes past it, as the lowest of its copies, and ticks
    later than ``memory`` seconds are dropped.
    """
    bronze = bronze_rows(messages)
    if anchors is None:
        clean = clean_ticks(bronze, bands)
    else:
        clean = clean_with_anchor_table(bronze, anchors, bands.lower, bands.upper)
    return settle_repeats_stream(clean, memory=memory) if once else clean


def gold_rows(
    messages: DataFrame,
    bands: PriceBands = PriceBands(),
    once: bool = False,
    anchors: DataFrame | None = None,
) -> DataFrame:
    """Sliding averages over silver rows, each window once when it is final.

    With ``once`` the watermark is that of removing repeats: windows are final one window length later,
    and no tick is lost that would have been in a window without it.
    """
    lateness = None if once else LATENESS_SECONDS
    silver = silver_rows(messages, bands, once, anchors, GOLD_MEMORY_SECONDS)
    return sliding_average_stream(silver, lateness=lateness)


def start_medallion(
    messages: DataFrame,
    root: str,
    bands: PriceBands = PriceBands(),
    live: bool = True,
    state_partitions: int | None = None,
    layers: Sequence[Layer] = LAYERS,
    once: bool = False,
    anchors: DataFrame | None = None,
) -> dict[str, StreamingQuery]:
    """Start one query per layer; each reads the messages at its own pace and can be
    stopped, restarted and resumed alone. ``once`` drops repeated ticks before silver and
    gold; bronze always keeps them."""
    rows = {
        BRONZE: lambda: bronze_rows(messages),
        SILVER: lambda: silver_rows(messages, bands, once, anchors),
        GOLD: lambda: gold_rows(messages, bands, once, anchors),
    }
    return {
        layer.name: layer.start(rows[layer](), root, live, state_partitions) for layer in layers
    }
