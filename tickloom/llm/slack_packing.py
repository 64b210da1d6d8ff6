"""Packing by minimum bin slack: subset sums over the lengths that wait choose what fills each sequence."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from tickloom.llm.byte_tokens import byte_encoder
from tickloom.llm.tables import text_slices

CAPACITY, END = 2048, 1
#: Ids that wait in a task before sequences are filled from them, and bytes of texts encoded at once.
POOL_IDS, TEXT_BYTES = 1 << 21, 8 << 20

PACKED = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


def pack_tokens(
    docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end: int = END, pool_ids: int = POOL_IDS
) -> DataFrame:
    """The pieces of every row of ``docs (doc_id, text)``, each with its ids and its place in a sequence.

    A document is its ids by the tokenizer file and ``end``; a null or empty text is ``end`` alone. Rows
    that share a ``doc_id``, or have none, are documents of their own. ``ids`` are little-endian unsigned
    32-bit numbers, ``start`` counts the document's ids before the piece, ``doc_tokens`` all of them.
    Other columns are ignored, an empty table gives no rows.

    A sequence holds ``capacity`` ids, or a smaller power of two of them, so none is padded. What of a
    document fills sequences by itself does so; the rest waits with the rests of other documents of its
    partition. For each sequence, the longest that waits and the multiset of lengths that comes closest
    to filling it are taken, as often as they last. Rests are cut only where no multiset fills a
    sequence, once the partition has no more documents; what is left then, less than a sequence, fills
    powers of two. Documents do not move between partitions, and a task holds ``pool_ids`` ids and a
    slice of texts.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = SlackPacker(capacity, pool_ids)
        first = TaskContext.get().partitionId() << 33
        for batch in text_slices(batches, limit=TEXT_BYTES):
            ids, sizes = byte_encoder(tokenizer).encode(batch.column("text"))
            ids = np.insert(ids, np.cumsum(sizes), end).astype("<u4")
            for doc_id, own in zip(batch.column("doc_id").to_pylist(), np.split(ids, np.cumsum(sizes + 1)[:-1])):
                packer.add(doc_id, own)
            packer.fill_sequences()
            yield packer.taken(first)
        packer.finish()
        yield packer.taken(first)

    return docs.select("doc_id", "text").mapInArrow(pack, PACKED)


class SlackPacker:
    """Pieces that wait, by length, and the sequences made of them so far."""

    def __init__(self, capacity: int, pool_ids: int = POOL_IDS):
        self.capacity, self.pool_ids = capacity, pool_ids
        self.waiting: dict[int, list[tuple]] = {}
        self.total, self.sequences = 0, 0
        self.rows: list[tuple] = []

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        """Whole sequences of the document at once; its rest waits."""
        full = len(ids) // self.capacity * self.capacity
        for start in range(0, full, self.capacity):
            self._put([(doc_id, start, ids[start : start + self.capacity], len(ids))])
        if full < len(ids):
            # a copy, or the slice it is part of would stay in memory
            self._wait((doc_id, full, ids[full:].copy(), len(ids)))

    def fill_sequences(self) -> None:
        """Fill sequences while many pieces wait and a multiset fills one without slack."""
        if self.total < self.pool_ids:
            return
        while self.total >= self.pool_ids // 2 and not (slack := self._fill(self.capacity, exactly=True)):
            pass
        if self.total >= self.pool_ids:  # hardly any sums: cut, so that the pool stays bounded
            while self.total >= max(self.pool_ids // 2, self.capacity):
                self._fill(self.capacity)

    def finish(self) -> None:
        """Fill sequences until nothing waits."""
        while self.total >= self.capacity:
            self._fill(self.capacity)
        while self.total:
            self._fill(1 << self.total.bit_length() - 1)

    def _fill(self, size: int, exactly: bool = False) -> int:
        """Sequences of ``size`` ids from the best multiset; returns its slack, which is cut from a piece.

        ``exactly`` takes nothing if there is slack.
        """
        counts = {length: len(pieces) for length, pieces in self.waiting.items()}
        chosen = least_slack(counts, size)
        slack = size - sum(length * n for length, n in chosen.items())
        if slack and exactly:
            return slack
        times = 1 if slack else min(counts[length] // n for length, n in chosen.items())
        for _ in range(times):
            pieces = [self._take(length) for length, n in chosen.items() for _ in range(n)]
            if slack:
                # whatever still waits is longer than the slack, or it would have been chosen
                doc_id, start, ids, tokens = self._take(min(self.waiting))
                pieces.append((doc_id, start, ids[:slack], tokens))
                self._wait((doc_id, start + slack, ids[slack:], tokens))
            self._put(pieces)
        return slack

    def _wait(self, piece: tuple) -> None:
        self.waiting.setdefault(len(piece[2]), []).append(piece)
        self.total += len(piece[2])

    def _take(self, length: int) -> tuple:
        pieces = self.waiting[length]
        piece = pieces.pop()
        if not pieces:
            del self.waiting[length]
        self.total -= length
        return piece

    def _put(self, pieces: list[tuple]) -> None:
        offset = 0
        for doc_id, start, ids, tokens in pieces:
            self.rows.append((doc_id, start, len(ids), ids.tobytes(), tokens, self.sequences, offset))
            offset += len(ids)
        self.sequences += 1

    def taken(self, first: int) -> pa.RecordBatch:
        """The rows of finished sequences, numbered from ``first`` on; they are forgotten here."""
        rows, self.rows = self.rows, []
        columns = list(zip(*rows)) or [()] * 7
        kinds = [pa.int64()] * 3 + [pa.binary()] + [pa.int64()] * 3
        arrays = [pa.array(column, kind) for column, kind in zip(columns, kinds)]
        arrays[5] = pa.array(np.array(columns[5], np.int64) + first)
        return pa.record_batch(arrays, ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])


def least_slack(counts: dict[int, int], size: int) -> dict[int, int]:
    """How many of each length to take so that their sum is as close to ``size`` as can be, not above.

    The longest that fits is always taken. A bit of ``reach`` stands for each sum that can be made; the
    lengths are added from the longest on, ``n`` copies as 1, 2, 4 ... of them, until the size itself is
    reached. The sums before each step then tell, backwards, which steps made the best one.
    """
    lengths = sorted((length for length in counts if length <= size), reverse=True)
    if not lengths:
        return {}
    chosen = Counter({lengths[0]: 1})
    room = size - lengths[0]
    every = (1 << room + 1) - 1
    reach, steps = 1, []
    for length in lengths:
        left = min(counts[length] - chosen[length] * (length == lengths[0]), room // length)
        some = 1
        while left > 0 and not reach >> room:
            some = min(some, left)
            more = reach | reach << some * length & every
            if more != reach:
                steps.append((length, some, reach))
                reach = more
            left -= some
            some *= 2
        if reach >> room:
            break
    rest = reach.bit_length() - 1
    for length, some, before in reversed(steps):
        if not before >> rest & 1:
            chosen[length] += some
            rest -= some * length
    return dict(chosen)
