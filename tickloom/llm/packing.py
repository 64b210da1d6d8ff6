"""Packing token sequences: best-fit decreasing, with lower bounds that certify the result."""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.llm.tables import text_slices, written
from tickloom.llm.tokens import encoder

CAPACITY, END = 2048, 0
#: Pieces of a partition, and how often partitions with gaps may exchange theirs.
PART_PIECES, ROUNDS = 50_000, 4

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end: int = END) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32)`` of every row of ``docs (doc_id, text)``.

    A document is its ids and ``end``; only if longer than ``capacity`` it is cut into pieces of that
    length, the last of which may be shorter. A null or empty text is the end mark alone.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            ids, sizes = encoder(tokenizer).encode(batch.column("text"))
            before = np.cumsum(sizes) - sizes
            ids = np.insert(ids, before + sizes, end).astype("<u4")
            before, sizes = before + np.arange(len(sizes)), sizes + 1
            count = -(-sizes // capacity)
            row = np.repeat(np.arange(len(sizes)), count)
            piece = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
            start = piece * capacity
            length = np.minimum(sizes[row] - start, capacity)
            place = before[row] + start
            crc = [zlib.crc32(ids[a : a + n]) for a, n in zip(place, length)]
            doc_id = batch.column("doc_id").cast(pa.int64()).take(pa.array(row))
            columns = [doc_id, piece.astype(np.int32), start, length, np.array(crc, np.int64)]
            yield pa.record_batch(columns, ["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select("doc_id", "text").mapInArrow(cut, PIECES)


def pack(pieces: DataFrame, capacity: int = CAPACITY, part_pieces: int = PART_PIECES, rounds: int = ROUNDS) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``; ``length`` must be from 1 to ``capacity``.

    Pieces are dealt evenly over partitions of about ``part_pieces`` (by their place in the table, so
    repeated ids do no harm) and each partition is packed by best-fit decreasing. Where the number of
    sequences equals the partition's lower bound it is certified to be the least there is. The other
    partitions keep their full sequences and exchange the pieces of the rest, which are dealt and
    packed anew; a round that saves nothing ends this and is dropped. An empty table stays empty.
    """
    table = written(pieces.withColumn("__row", F.monotonically_increasing_id()), "pieces")
    whole = table.filter(F.col("length") == capacity)
    done = [whole.withColumn("sequence_id", -1 - F.col("__row")).withColumn("offset", F.lit(0).cast("long"))]
    pool, used = table.filter(F.col("length") < capacity), None
    for turn in range(rounds):
        parts = max(1, math.ceil(pool.count() / part_pieces))
        dealt = pool.withColumn("__part", F.pmod(F.xxhash64("__row", F.lit(turn)), F.lit(parts)))
        schema = _schema(dealt)
        now = written(dealt.groupBy("__part").applyInArrow(_packed(capacity, schema), schema), "packed")
        ids = (F.lit(turn).cast("long") * (1 << 56)) + F.col("__part") * (1 << 28) + F.col("__bin")
        now = now.withColumn("sequence_id", ids)
        bins = now.filter("offset = 0").agg(F.count(F.lit(1))).first()[0]
        if used is not None and bins >= used:
            break
        if turn:
            done.pop()
        certified = (F.col("__bins") == F.col("__bound")) | (F.col("__fill") == capacity)
        done += [now.filter(certified), now.filter(~certified)]
        pool = done[-1].select(*table.columns)
        used = done[-1].filter("offset = 0").count()
        if not used:
            break
    columns = [*pieces.columns, "sequence_id", "offset"]
    result = done[0].select(*columns)
    for part in done[1:]:
        result = result.unionByName(part.select(*columns))
    return result


def _schema(dealt: DataFrame) -> T.StructType:
    extra = ("__bin", "offset", "__fill", "__bins", "__bound")
    return T.StructType([*dealt.schema.fields, *(T.StructField(name, T.LongType()) for name in extra)])


def _packed(capacity: int, schema: T.StructType):
    names = schema.names

    def packed(rows: pa.Table) -> pa.Table:
        sizes = rows.column("length").to_numpy()
        bins, offsets, fill = best_fit_decreasing(sizes, capacity)
        more = {
            "__bin": bins,
            "offset": offsets,
            "__fill": fill[bins],
            "__bins": np.full(len(sizes), len(fill)),
            "__bound": np.full(len(sizes), lower_bound(sizes, capacity)),
        }
        return pa.table([rows.column(n) if n in rows.column_names else pa.array(more[n], pa.int64()) for n in names], names=names)

    return packed


def best_fit_decreasing(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin and offset of each size, and how full each bin is.

    Open bins are listed by the room they have left; a bit for each room that some bin has finds the
    smallest one that fits.
    """
    bins, offsets = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms, opened, fill = 0, 0, []
    for item in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[item])
        fitting = rooms >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            chosen = by_room[room].pop()
            if not by_room[room]:
                rooms ^= 1 << room
        else:
            chosen, room = opened, capacity
            opened += 1
            fill.append(0)
        bins[item], offsets[item] = chosen, capacity - room
        fill[chosen] += size
        if room > size:
            by_room[room - size].append(chosen)
            rooms |= 1 << (room - size)
    return bins, offsets, np.array(fill, np.int64)


def lower_bound(sizes: np.ndarray, capacity: int) -> int:
    """No packing has fewer bins: the best of several dual feasible functions.

    Such a function keeps any sizes that fit one bin within one bin, so the sum of its values is a
    bound. Used are the sizes themselves, those that drop small sizes and round up the large ones they
    would have been put with, and those that round to multiples of capacity / k.
    """
    if not len(sizes):
        return 0
    count = np.bincount(sizes, minlength=capacity + 1)
    x = np.arange(capacity + 1)
    best = -(-int((count * x).sum()) // capacity)
    mass = np.cumsum(count * x)
    number = np.cumsum(count)
    small = np.arange(1, capacity // 2 + 1)
    large = number[-1] - number[capacity - small]
    middle = mass[capacity - small] - mass[small - 1]
    best = max(best, int((large + -(-middle // capacity)).max()))
    for k in range(1, 21):
        exact = (k + 1) * x % capacity == 0
        # in units of capacity / (k * capacity): x if (k + 1) x is a multiple, else the multiple below
        value = np.where(exact, k * x, (k + 1) * x // capacity * capacity)
        best = max(best, -(-int((count * value).sum()) // (k * capacity)))
    return best
