"""Aligning the tokens of two tokenizers by coalescing their byte ranges."""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.byte_tokens import byte_encoder
from tickloom.llm.tables import text_slices, written
from tickloom.llm.units import Units, gathered, joined_runs, units_of
from tickloom.operators.lookup import lookup_join

SPACE = "▁"
TEXT_BYTES = 2 << 20

ALIGNED = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string, links array<struct<a:int,b:int,n:int>>"


def align_tokens(docs: DataFrame, byte_tokenizer: str, piece_model: str) -> DataFrame:
    """Tokens of every row of ``docs (doc_id, text)`` by a byte-level tokenizer (A) and a piece model (B).

    A encodes the text with a space in front, which B adds by itself; names of special tokens are plain
    text. ``groups`` are the shortest runs of A and B tokens that cover the same bytes, as
    ``a1,a2|b1;a3|b2,b3`` in order. ``links`` are the pairs of an A and a B token that overlap and end
    together, as distinct pairs of ids with how often each occurs; ``n_links`` counts the occurrences.

    A text that is null or empty, or that B's pieces do not give back byte by byte (one with a visible
    space mark in it), has no tokens: zeros, no links and an empty string. Rows that share a ``doc_id``,
    or have none, are documents of their own; other columns are ignored. An empty table gives no rows.

    No token reaches across the cuts of ``units_of``, so each distinct unit of a slice of texts is
    encoded and aligned once.
    """

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, limit=TEXT_BYTES):
            texts = pc.fill_null(batch.column("text"), "")
            units = units_of(texts)
            a, a_sizes = byte_encoder(byte_tokenizer, plain=True).encode_units(units)
            b, b_sizes = piece_encoder(piece_model).encode_units(units)
            same = piece_encoder(piece_model).gives_back(units, b, b_sizes)
            found = Aligned.of(
                a[np.repeat(same, a_sizes)],
                np.where(same, a_sizes, 0),
                byte_encoder(byte_tokenizer, plain=True).size_of,
                b[np.repeat(same, b_sizes)],
                np.where(same, b_sizes, 0),
                piece_encoder(piece_model).size_of,
            )
            owner = np.repeat(np.arange(len(units.counts)), units.counts)
            whole = np.bincount(owner, ~same[units.code], minlength=len(units.counts)) == 0
            whole &= pc.binary_length(texts).to_numpy(zero_copy_only=False) > 0
            yield _rows(batch.column("doc_id").cast(pa.int64()), units, whole, found)

    return docs.select("doc_id", "text").mapInArrow(align, ALIGNED)


def with_link_counts(aligned: DataFrame) -> DataFrame:
    """``aligned`` without ``links``, with ``n_best`` and ``count_sum``.

    The count of a pair of ids is the number of links that hold it in all of ``aligned``. ``count_sum``
    adds up the counts of a document's links; ``n_best`` is how many of them have the highest count of
    their B id, ties included.

    Pairs are counted with a map-side part. The table of pairs is broadcast while it is small and
    joined by salted shuffles when it is not.
    """
    table = written(aligned.withColumn("__row", F.monotonically_increasing_id()), "aligned")
    counts = written(table.select(F.inline("links")).groupBy("a", "b").agg(F.sum("n").alias("count")), "pair-counts")
    most = counts.groupBy("b").agg(F.max("count").alias("most"))
    pairs = counts.join(most, "b").select("a", "b", "count", (F.col("count") == F.col("most")).alias("best"))
    looked = lookup_join(table.select("__row", F.inline("links")), written(pairs, "pairs"), ["a", "b"])
    sums = looked.groupBy("__row").agg(
        F.sum(F.when(F.col("best"), F.col("n")).otherwise(0)).alias("n_best"),
        F.sum(F.col("n") * F.col("count")).alias("count_sum"),
    )
    none = F.lit(0).cast("long")
    joined = table.drop("links").join(sums, "__row", "left").drop("__row")
    return joined.withColumns({name: F.coalesce(name, none) for name in ("n_best", "count_sum")})


class PieceEncoder:
    """Ids by a piece model, and the bytes that each id stands for."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.model = model = SentencePieceProcessor(model_file=path)
        pieces = [model.id_to_piece(i) for i in range(model.get_piece_size())]
        if any(SPACE in piece.lstrip(SPACE) for piece in pieces):
            raise ValueError("a piece with a space inside would be cut")
        bytes_of = [
            bytes([int(piece[3:5], 16)]) if model.is_byte(i) else piece.replace(SPACE, " ").encode()
            for i, piece in enumerate(pieces)
        ]
        self.bytes_of = pa.array(bytes_of, pa.large_binary())
        self.size_of = np.fromiter(map(len, bytes_of), np.int64, len(bytes_of))

    def encode_units(self, units: Units) -> tuple[np.ndarray, np.ndarray]:
        """Ids of every distinct unit, one after another, and how many each has."""
        found = self.model.encode(units.distinct.to_pylist(), num_threads=1)
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter(chain.from_iterable(found), np.int64, sizes.sum()), sizes

    def gives_back(self, units: Units, ids: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Which distinct units, with a space in front, are what the bytes of their ids join to."""
        length = pc.binary_length(units.distinct).to_numpy(zero_copy_only=False).astype(np.int64) + 1
        ends = np.concatenate([[0], np.cumsum(self.size_of[ids])])[np.cumsum(sizes)]
        same = np.diff(ends, prepend=0) == length
        if not same.any():
            return same
        kept = ids[np.repeat(same, sizes)]
        got = np.frombuffer(self.bytes_of.take(pa.array(kept)).buffers()[2], np.uint8)[: length[same].sum()]
        words = units.distinct.filter(pa.array(same))
        given = np.frombuffer((" " + joined_runs(words, [0, len(words)], " ")[0].as_py()).encode(), np.uint8)
        wrong = np.searchsorted(np.cumsum(length[same]), np.flatnonzero(got != given), side="right")
        same[np.flatnonzero(same)[np.unique(wrong)]] = False
        return same


@cache
def piece_encoder(path: str) -> PieceEncoder:
    """One per worker process; it holds the vocabulary and no texts."""
    return PieceEncoder(path)


class Aligned:
    """Groups and links of runs of tokens; run ``k`` of A covers the same bytes as run ``k`` of B."""

    def __init__(self, a, a_group, b, b_group, groups, link_a, link_b, links):
        self.a, self.a_group, self.b, self.b_group = a, a_group, b, b_group
        #: number of groups and of links in each run, and the ids that links join
        self.groups, self.link_a, self.link_b, self.links = groups, link_a, link_b, links

    @classmethod
    def of(cls, a, a_sizes, a_bytes, b, b_sizes, b_bytes) -> Aligned:
        a_end, b_end = np.cumsum(a_bytes[a]), np.cumsum(b_bytes[b])
        a_start, b_start = a_end - a_bytes[a], b_end - b_bytes[b]
        group = coalesced(np.concatenate([a_start, b_start]), np.concatenate([a_end, b_end]))
        a_group, b_group = group[: len(a)], group[len(a) :]
        n_groups = int(group.max()) + 1 if len(group) else 0
        run_of_group = np.zeros(n_groups, np.int64)
        a_run = np.repeat(np.arange(len(a_sizes)), a_sizes)
        run_of_group[a_group] = a_run
        # the B tokens that overlap each A token follow one another
        low = np.searchsorted(b_end, a_start, side="right")
        over = np.searchsorted(b_start, a_end, side="left") - low
        of_a = np.repeat(np.arange(len(a)), over)
        of_b = np.arange(len(of_a)) + np.repeat(low - np.cumsum(over) + over, over)
        together = a_end[of_a] == b_end[of_b]
        of_a, of_b = of_a[together], of_b[together]
        return cls(
            a, a_group, b, b_group,
            np.bincount(run_of_group, minlength=len(a_sizes)),
            a[of_a].astype(np.int64), b[of_b].astype(np.int64),
            np.bincount(a_run[of_a], minlength=len(a_sizes)),
        )

    def strings(self) -> pa.Array:
        """The groups of each run, written out."""
        sides = []
        for ids, group in ((self.a, self.a_group), (self.b, self.b_group)):
            sizes = np.bincount(group, minlength=self.groups.sum())
            numbers = pa.array(ids.astype(np.int64)).cast(pa.large_string())
            sides.append(joined_runs(numbers, np.concatenate([[0], np.cumsum(sizes)]), ","))
        groups = pc.binary_join_element_wise(*sides, pa.scalar("|", pa.large_string()))
        return joined_runs(groups, np.concatenate([[0], np.cumsum(self.groups)]), ";")


def coalesced(start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The group of each range: ranges that overlap, directly or through others, share one.

    In order of their starts, a group ends where a start reaches the largest end so far.
    """
    order = np.lexsort((end, start))
    reached = np.maximum.accumulate(end[order])
    new = np.zeros(len(order), np.int64)
    new[1:] = start[order][1:] >= reached[:-1]
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(new)
    return group


def _rows(doc_id: pa.Array, units: Units, whole: np.ndarray, found: Aligned) -> pa.RecordBatch:
    n = len(whole)
    owner = np.repeat(np.arange(n), units.counts)
    used = whole[owner]
    code, owner = units.code[used], owner[used]

    def summed(per_unit: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(per_unit[code])])
        return np.diff(total[np.searchsorted(owner, np.arange(n + 1))])

    runs = len(units.distinct)
    a_run = np.repeat(np.arange(runs), found.groups)[found.a_group]
    b_run = np.repeat(np.arange(runs), found.groups)[found.b_group]
    n_a, n_b = (summed(np.bincount(run, minlength=runs)) for run in (a_run, b_run))
    texts = joined_runs(found.strings().take(pa.array(code)), np.searchsorted(owner, np.arange(n + 1)), ";")
    # the links of a document as distinct pairs
    pair, kind = np.unique(found.link_a << 32 | found.link_b, return_inverse=True)
    links = summed(found.links)
    key = np.repeat(np.arange(n), links) * len(pair) + gathered(kind, found.links, code)
    key, times = np.unique(key, return_counts=True)
    doc, kind = np.divmod(key, max(1, len(pair)))
    fields = [pair[kind] >> 32, pair[kind] & 0xFFFFFFFF, times]
    struct = pa.StructArray.from_arrays([f.astype(np.int32) for f in fields], ["a", "b", "n"])
    lists = pa.ListArray.from_arrays(pa.array(np.searchsorted(doc, np.arange(n + 1)), pa.int32()), struct)
    columns = [doc_id, n_a, n_b, summed(found.groups), links, texts.cast(pa.string()), lists]
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups", "links"]
    return pa.record_batch([c if isinstance(c, pa.Array) else pa.array(c, pa.int64()) for c in columns], names)
