"""Ranked lexical search the other way round: documents stream through an index of the queries."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tickloom.llm.tables import text_slices, written
from tickloom.llm.units import gathered

BEST = 20
#: Bytes of item texts whose index is sent to the executors at once.
ITEM_BYTES = 8 << 20
#: Scores that a task adds up at once, bytes of texts whose terms it counts at once, heaps that are merged in one step.
CELLS, TEXT_BYTES, MERGED = 1 << 21, 8 << 20, 64

COUNTED = "doc_id long, n long, terms binary, counts binary"
FOUND = "item long, doc_id long, score long, heap long"

#: Each byte of a text as part of a term (upper-case ASCII as lower case) or as a space between terms.
_BYTES = np.arange(256, dtype=np.uint8)
_UPPER = (_BYTES >= ord("A")) & (_BYTES <= ord("Z"))
_PART = _UPPER | (_BYTES >= 0x80) | ((_BYTES >= ord("a")) & (_BYTES <= ord("z"))) | ((_BYTES >= ord("0")) & (_BYTES <= ord("9")))
TERM_BYTES = np.where(_PART, _BYTES + 32 * _UPPER, ord(" ")).astype(np.uint8)


def ranked_search(docs: DataFrame, items: DataFrame, best: int = BEST, item_bytes: int = ITEM_BYTES) -> DataFrame:
    """``(item_id, rank, doc_id, score)``: the ``best`` documents for each row of ``items (item_id, text)``.

    ``docs`` has ``(doc_id, text)``; other columns of both are ignored. Terms are runs of ASCII letters
    and digits and of all characters beyond ASCII, A-Z as a-z. With N documents that have a term, L terms
    in all of them, n in one and df documents that hold a term, a term weighs ``w = floor(1000 * ln((2N +
    2) / (2df + 1)))`` and a document has ``m = 75 + 25nN div L``; its score sums ``w * (10^9 tf div (1000
    tf + 12m))`` over the item's terms, repeats included. Only scores above 0 are returned, the highest
    first, equal ones by ``doc_id`` (null last).

    A null text has no terms. Every row of ``docs`` is a document, also where ids repeat; every row of
    ``items`` is an item and has its own ranks, equal rows one time only. Either table may be empty.

    Items are dealt to blocks by the bytes of their texts. For each block the documents' counts of its
    terms are written once; its index, which is no larger than its texts, goes to every task, and the
    written counts stream through it into one bounded heap an item. A document costs the postings of its
    own terms and a cell an item. Heaps are merged ``MERGED`` at a time, then all of them.
    """
    rows = written(items.select(F.col("item_id").cast("long"), "text").distinct(), "items")
    size = F.coalesce(F.octet_length("text"), F.lit(0)) + 16
    blocks = max(1, -(-(rows.agg(F.sum(size)).first()[0] or 0) // item_bytes))
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)))
    ranked = [_search_block(docs, dealt.filter(F.col("block") == block), best) for block in range(blocks)]
    found = ranked[0]
    for more in ranked[1:]:
        found = found.unionByName(more)
    return found


def _search_block(docs: DataFrame, items: DataFrame, best: int) -> DataFrame:
    own = items.select("item_id", "text").orderBy("item_id", "text").toArrow()
    index = ItemIndex.of(own.column("text").combine_chunks())
    counted = written(docs.select("doc_id", "text").mapInArrow(_counts(index.terms), COUNTED), "term-counts")
    with_terms = counted.filter("n > 0").agg(F.count(F.lit(1)), F.sum("n")).first()
    n_docs, n_terms = with_terms[0], with_terms[1] or 0
    held = counted.select("terms").mapInArrow(_holders, "term int, df long").groupBy("term").agg(F.sum("df").alias("df"))
    weight = F.floor(1000 * F.log((2.0 * n_docs + 2) / (2 * F.col("df") + 1))).cast("long")
    weights = np.zeros(len(index.terms), np.int64)
    weighed = held.select("term", weight.alias("w")).toArrow()  # a row for each of the block's terms
    weights[weighed.column("term").to_numpy()] = weighed.column("w").to_numpy()
    scored = counted.filter("n > 0").mapInArrow(_heaps(index, weights, n_docs, n_terms, best), FOUND)
    order = (F.desc("score"), F.col("doc_id").asc_nulls_last())
    some = Window.partitionBy("item", F.floor(F.col("heap") / MERGED)).orderBy(*order)
    merged = scored.withColumn("place", F.row_number().over(some)).filter(F.col("place") <= best)
    every = Window.partitionBy("item").orderBy(*order)
    ranked = merged.withColumn("rank", F.row_number().over(every)).filter(F.col("rank") <= best)
    ids = own.select(["item_id"]).append_column("item", pa.array(np.arange(len(own))))
    named = docs.sparkSession.createDataFrame(ids.to_pandas(integer_object_nulls=True), "item_id long, item long")
    return ranked.join(F.broadcast(named), "item").select("item_id", "rank", "doc_id", "score")


# --- terms ------------------------------------------------------------------------------


def term_lists(texts: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray]:
    """The terms of all texts one after another, and how many each has; null has none."""
    texts = pc.fill_null(texts, "").cast(pa.large_binary())
    _, offsets, data = texts.buffers()
    cuts = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    plain = TERM_BYTES[np.frombuffer(data or b"", np.uint8)[cuts[0] : cuts[-1]]]
    texts = pa.Array.from_buffers(pa.large_string(), len(texts), [None, pa.py_buffer(cuts - cuts[0]), pa.py_buffer(plain)])
    parts = pc.split_pattern(texts, " ")
    terms = parts.flatten()
    is_term = pc.binary_length(terms).to_numpy(zero_copy_only=False) > 0
    owner = np.repeat(np.arange(len(texts)), pc.list_value_length(parts).to_numpy(zero_copy_only=False))
    return terms.filter(pa.array(is_term)).dictionary_encode(), np.bincount(owner[is_term], minlength=len(texts))


def _counts(terms: pa.Array):
    """A row per document: how many terms it has, and which of ``terms`` it holds how often."""

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, limit=TEXT_BYTES):
            coded, n = term_lists(batch.column("text"))
            known = pc.fill_null(pc.index_in(coded.dictionary, value_set=terms), -1).to_numpy(zero_copy_only=False)
            code = known[coded.indices.to_numpy(zero_copy_only=False)]
            owner = np.repeat(np.arange(len(n)), n)
            key = np.sort(owner[code >= 0] * len(terms) + code[code >= 0])
            first = np.flatnonzero(np.diff(key, prepend=-1))
            owner, term = np.divmod(key[first], max(1, len(terms)))
            times = np.diff(np.append(first, len(key)))
            cuts = 4 * np.searchsorted(owner, np.arange(len(n) + 1))
            columns = [
                batch.column("doc_id").cast(pa.int64()),
                pa.array(n, pa.int64()),
                *(
                    pa.Array.from_buffers(
                        pa.binary(), len(n), [None, pa.py_buffer(cuts.astype(np.int32)), pa.py_buffer(part.astype("<u4"))]
                    )
                    for part in (term, times)
                ),
            ]
            yield pa.record_batch(columns, ["doc_id", "n", "terms", "counts"])

    return counts


def _numbers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The numbers in all rows of a binary column, and how many each row has."""
    sizes = pc.binary_length(column).to_numpy(zero_copy_only=False) // 4
    return np.frombuffer(b"".join(column.to_pylist()), "<u4").astype(np.int64), sizes.astype(np.int64)


def _holders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many documents of a batch hold each term."""
    for batch in batches:
        term, df = np.unique(_numbers(batch.column("terms"))[0], return_counts=True)
        yield pa.record_batch([term.astype(np.int32), df.astype(np.int64)], ["term", "df"])


# --- the index and the heaps --------------------------------------------------------------


@dataclass
class ItemIndex:
    """For each term the items that hold it and how often: runs of ``item`` and ``times``, ``sizes`` long."""

    terms: pa.Array
    sizes: np.ndarray
    item: np.ndarray
    times: np.ndarray
    items: int

    @classmethod
    def of(cls, texts: pa.Array) -> ItemIndex:
        coded, n = term_lists(texts)
        owner = np.repeat(np.arange(len(n)), n)
        key = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64) * len(n) + owner
        key, times = np.unique(key, return_counts=True)
        term, item = np.divmod(key, max(1, len(n)))
        terms = coded.dictionary.cast(pa.large_string())
        return cls(terms, np.bincount(term, minlength=len(terms)), item, times.astype(np.int64), len(n))


def _heaps(index: ItemIndex, weights: np.ndarray, n_docs: int, n_terms: int, best: int):
    def heaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heap = Heaps(index.items, best)
        for batch in batches:
            if not batch.num_rows:
                continue
            term, sizes = _numbers(batch.column("terms"))
            tf, _ = _numbers(batch.column("counts"))
            n = batch.column("n").to_numpy()
            doc_id = batch.column("doc_id")
            ids = pc.fill_null(doc_id, 0).to_numpy(zero_copy_only=False)
            null = doc_id.is_null().to_numpy(zero_copy_only=False)
            m = 75 + 25 * n * n_docs // n_terms
            part = weights[term] * (1_000_000_000 * tf // (1000 * tf + 12 * np.repeat(m, sizes)))
            # documents at once: as many as have room for their scores and their postings
            ends = np.cumsum(sizes)
            postings = np.cumsum(index.sizes[term])
            until = np.concatenate([[0], postings])[ends] + index.items * np.arange(1, len(n) + 1)
            cuts = np.flatnonzero(np.diff((until - until[0]) // CELLS, prepend=0))
            for a, b in zip([0, *cuts], [*cuts, len(n)]):
                own = slice(ends[a] - sizes[a], ends[b - 1])
                size = index.sizes[term[own]]
                doc = np.repeat(np.repeat(np.arange(b - a), sizes[a:b]), size)
                item, times = gathered(index.item, index.sizes, term[own]), gathered(index.times, index.sizes, term[own])
                scores = np.zeros((b - a) * index.items, np.int64)
                np.add.at(scores, doc * index.items + item, np.repeat(part[own], size) * times)
                heap.offer(scores.reshape(b - a, index.items), null[a:b], ids[a:b])
        yield heap.rows(TaskContext.get().partitionId())

    return heaps


class Heaps:
    """The ``best`` documents of each item so far, and what was offered since they were last put in order."""

    def __init__(self, items: int, best: int):
        self.items, self.best = items, best
        self.least = np.ones(items, np.int64)
        self.kept = np.zeros((4, 0), np.int64)  # item, score, whether the id is null, id
        self.more: list[np.ndarray] = []
        self.size = 0

    def offer(self, scores: np.ndarray, null: np.ndarray, ids: np.ndarray) -> None:
        """Scores of documents, a row each, for all items."""
        doc, item = np.nonzero(scores >= self.least)
        if len(doc):
            self.more.append(np.stack([item, scores[doc, item], null[doc], ids[doc]]).astype(np.int64))
            self.size += len(doc)
            if self.size > max(CELLS // 8, 2 * self.items * self.best):
                self._order()

    def _order(self) -> None:
        rows = np.concatenate([self.kept, *self.more], axis=1)
        rows = rows[:, np.lexsort((rows[3], rows[2], -rows[1], rows[0]))]
        first = np.searchsorted(rows[0], np.arange(self.items))
        place = np.arange(rows.shape[1]) - first[rows[0]]
        self.kept, self.more, self.size = rows[:, place < self.best], [], 0
        last = place == self.best - 1
        self.least[rows[0, last]] = rows[1, last]

    def rows(self, heap: int) -> pa.RecordBatch:
        self._order()
        item, score, null, ids = self.kept
        doc_id = pa.array(ids, pa.int64(), mask=null.astype(bool))
        return pa.record_batch([item, doc_id, score, np.full(len(item), heap)], ["item", "doc_id", "score", "heap"])
