"""Repeated ticks on a stream by the rule that batch uses: the lowest of the copies is kept."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

from tickloom.operators.cleaning import REPEAT_KEY, has_whole_key
from tickloom.operators.windows import LATENESS_SECONDS

#: How long a tick that has been passed on is remembered, to drop its later copies.
MEMORY_SECONDS = 86_400
#: Ticks of a symbol and as many seconds are settled together, dealt over so many tasks.
SLOT_SECONDS, SALTS = 10, 8
#: So many slots of a symbol share a row of state, as a key costs more than its ticks do.
SLOTS_PER_KEY = 24

SETTLED = "symbol string, price double, volume double, timestamp long, event_time timestamp, no_price boolean, no_volume boolean"
RAW_COLUMNS = ("symbol", "price", "volume", "timestamp")


def settle_repeats_stream(
    ticks: DataFrame,
    hold: int = LATENESS_SECONDS,
    memory: int = MEMORY_SECONDS,
    slot: int = SLOT_SECONDS,
    salts: int = SALTS,
) -> DataFrame:
    """One tick per ``(symbol, timestamp)``: as :func:`~tickloom.operators.cleaning.drop_repeats` in batch.

    A tick is held until event time is ``hold`` seconds past the end of its slot of ``slot`` seconds; of the
    copies that have come by then the lowest price, then the lowest volume is passed on (NULL below any
    number, NaN above). It is remembered until event time is ``memory`` seconds past the slot. Copies that
    come in that time are dropped, whatever they say; a tick that is no copy passes at once. Ticks later
    than ``memory`` are dropped, as a watermark does. So the result is that of batch where copies come
    within ``hold`` and nothing comes later than ``memory``. A tick with a NULL in its key repeats nothing
    and passes, one with no event time too.

    State is keyed by symbol, a block of ``SLOTS_PER_KEY`` slots and a salt from the timestamp, so that a
    symbol with a third of all ticks is spread and copies still meet; each key has one row of state and a
    timer for the slot that is due next. Copies inside an Arrow batch are merged before the shuffle.
    """
    if memory < hold + slot:
        raise ValueError("ticks must be remembered for longer than they are held")
    keyed = has_whole_key() & F.col("event_time").isNotNull()
    columns = ticks.select(*RAW_COLUMNS, "event_time", "ingest_date")
    merged = columns.filter(keyed).mapInArrow(lowest_copies(REPEAT_KEY), columns.schema)
    milliseconds = F.lit(1000 * slot * SLOTS_PER_KEY).cast("long")
    block = F.call_function("div", F.col("timestamp") - F.pmod("timestamp", milliseconds), milliseconds)
    salt = F.pmod(F.xxhash64("timestamp"), F.lit(salts))
    dealt = (
        merged.withWatermark("event_time", f"{memory} seconds")
        .withColumns({"block": block, "salt": salt, "no_price": F.isnull("price"), "no_volume": F.isnull("volume")})
        .drop("ingest_date")
        .groupBy("symbol", "block", "salt")
    )
    processor = _settler(1000 * hold, 1000 * memory, 1000 * slot)
    settled = dealt.transformWithStateInPandas(processor, SETTLED, "Append", "EventTime", eventTimeColumnName="event_time")
    # on the way from pandas NaN becomes NULL
    numbers = {name: F.when(~F.col(f"no_{name}"), F.coalesce(name, F.lit(float("nan")))) for name in ("price", "volume")}
    once = settled.withColumns({**numbers, "ingest_date": F.to_date("event_time")})
    return once.select(*columns.columns).unionByName(columns.filter(~keyed))


def lowest_copies(key: tuple[str, ...]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A function that keeps the lowest row per key of every batch, by price and then volume."""

    def lowest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            order, starts = [], np.zeros(batch.num_rows, bool)
            for name in ("volume", "price"):
                column = batch.column(name)
                order += [pc.fill_null(column, 0.0).to_numpy(zero_copy_only=False), ~column.is_null().to_numpy(zero_copy_only=False)]
            keys = [batch.column(name).dictionary_encode().indices.to_numpy(zero_copy_only=False) for name in key]
            rows = np.lexsort([*order, *keys])
            starts[:1] = True
            for codes in keys:
                starts[1:] |= np.diff(codes[rows]) != 0
            yield batch if starts.all() else batch.take(pa.array(np.sort(rows[starts])))

    return lowest


def _settler(hold: int, memory: int, slot: int) -> StatefulProcessor:
    """The state of a key: the ticks of its slots, and whether they have been passed on.

    The class is built here, so that it travels to the executors whole. The watermark lags the latest
    event by ``memory``, so event time is ``hold`` past a moment when the watermark is ``hold - memory``
    past it.
    """
    kind = np.dtype([("timestamp", "<i8"), ("price", "<f8"), ("volume", "<f8"), ("no_price", "?"), ("no_volume", "?"), ("passed", "?")])

    def slots(rows: np.ndarray) -> np.ndarray:
        return rows["timestamp"] // slot

    def ends(rows: np.ndarray) -> np.ndarray:
        return (slots(rows) + 1) * slot

    def due(rows: np.ndarray) -> int:
        """When a slot is next passed on or forgotten."""
        return int(np.min(ends(rows) + np.where(rows["passed"], 0, hold - memory)))

    def lowest(rows: np.ndarray) -> np.ndarray:
        """The first copy of each timestamp, in the order of price and volume."""
        order = np.lexsort((rows["volume"], ~rows["no_volume"], rows["price"], ~rows["no_price"], rows["timestamp"]))
        rows = rows[order]
        return rows[np.diff(rows["timestamp"], prepend=rows["timestamp"][:1] - 1) != 0]

    def packed(frames) -> np.ndarray:
        frame = pd.concat(list(frames))
        rows = np.zeros(len(frame), kind)
        rows["timestamp"] = frame["timestamp"].to_numpy(np.int64)
        for name in ("price", "volume"):
            rows[name] = frame[name].to_numpy(np.float64, na_value=np.nan)
            rows[f"no_{name}"] = frame[f"no_{name}"].to_numpy(bool)
            rows[name][rows[f"no_{name}"]] = 0.0
        return lowest(rows)

    def unpacked(symbol: str, rows: np.ndarray) -> pd.DataFrame:
        columns = {"symbol": [symbol] * len(rows)} | {name: rows[name] for name in kind.names if name != "passed"}
        return pd.DataFrame(columns | {"event_time": pd.to_datetime(rows["timestamp"] // 1000, unit="s")})

    class Settler(StatefulProcessor):
        def init(self, handle) -> None:
            self.handle = handle
            self.state = handle.getValueState("ticks", "ticks binary")

        def _ticks(self) -> np.ndarray:
            found = self.state.get()
            return np.frombuffer(found[0], kind) if found else np.zeros(0, kind)

        def handleInputRows(self, key, rows, timerValues):
            known, new = self._ticks(), packed(rows)
            over = ends(new) + hold - memory <= timerValues.getCurrentWatermarkInMs()
            opened = np.isin(slots(new), slots(known))
            new["passed"] = np.where(opened, np.isin(slots(new), slots(known[known["passed"]])), over)
            new = new[~new["passed"] | ~np.isin(new["timestamp"], known["timestamp"])]
            if len(new):
                ticks = lowest(np.concatenate([known, new]))
                self.state.update((ticks.tobytes(),))
                if not len(known) or due(ticks) < due(known):
                    self.handle.registerTimer(due(ticks))
                if new["passed"].any():
                    yield unpacked(key[0], new[new["passed"]])

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
            now, ticks = timerValues.getCurrentWatermarkInMs(), self._ticks().copy()
            passing = ~ticks["passed"] & (ends(ticks) + hold - memory <= now)
            settled = ticks[passing]
            ticks["passed"] |= passing
            left = ticks[ends(ticks) > now]
            if len(left):
                self.state.update((left.tobytes(),))
                self.handle.registerTimer(due(left))
            else:
                self.state.clear()
            if len(settled):
                yield unpacked(key[0], settled)

        def close(self) -> None:
            pass

    return Settler()
