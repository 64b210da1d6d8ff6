"""Approximate nearest neighbours by cross-polytope hashing with several probes per table."""

from __future__ import annotations

import math
from collections.abc import Iterator
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tickloom.llm.tables import mixed, written
from tickloom.llm.vectors import dimension, matrix, unit_rows, usable

TABLES, PROBES, ROTATIONS = 12, 24, 3
#: Rows of a cell: the vectors that are compared in one task hold at most about so many.
CELL_VECTORS, CELL_QUERIES = 16_384, 4_096
#: What the tables together find of the pairs that are left to them, and the ratio of lengths of a band.
LEAST_FOUND, BAND = 0.94, 1.25
SLACK = 1e-9


def nearest(
    index: DataFrame, queries: DataFrame, k: int, tables: int = TABLES, probes: int = PROBES, seed: int = 7
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` rows of ``index`` of largest inner product.

    Both inputs are ``(vec_id, embedding)``; a query does not find its own ``vec_id``. Each table
    assigns a vector to the nearest signed axis after a pseudo-random rotation of sign flips and
    Hadamard transforms. A query visits the buckets of its ``probes`` nearest axes in each table; all
    vectors there are scored in double precision on the original components. Zeros up to a power of
    two of at least twice the dimension make buckets finer than the dimension alone would.

    The tables see directions only, and find a pair of a small angle more often than one of a large
    angle. A vector so long that it can be among the ``k`` at an angle where the tables would find less
    than ``LEAST_FOUND`` is scored anyway: one more table has bands of length as its buckets, of which a
    query visits all that its ``k``-th find in the first table does not rule out.

    Neighbouring buckets share a cell, a full bucket has several; a cell meets one block of queries
    at a time, so a very common vector spreads over cells. What the first table finds bounds the rest:
    the other tables pass on only what is at least as near as a query's ``k``-th find there. Every vector
    is in every table. Vectors that are null, zero, or not finite take no part; ties go to the smaller
    ``vec_id``; rows that repeat a ``vec_id`` and its vector count once; an empty side gives no rows.
    """
    index = index.filter(usable("embedding") & F.col("vec_id").isNotNull()).select("vec_id", "embedding")
    queries = queries.filter(usable("embedding") & F.col("vec_id").isNotNull()).select("vec_id", "embedding")
    n, longest = index.agg(F.count(F.lit(1)), F.max(_norm("embedding"))).first()
    n_queries = queries.count()
    if not n or not n_queries:
        return index.sparkSession.createDataFrame([], RESULT)
    size = dimension(index.select("embedding").unionByName(queries.select("embedding")), "embedding")
    rotation = Rotations(size, tables, seed, longest)
    # one row per table and bucket, whatever the size of the index
    counted = index.mapInArrow(_counted(rotation), "table int, bucket int, n long")
    counts = counted.groupBy("table", "bucket").agg(F.sum("n")).collect()
    layout = Layout(rotation, counts, math.ceil(n_queries / CELL_QUERIES))
    unbounded = queries.withColumn("bound", F.lit(float("-inf")))
    first = written(_ranked(_found(index, unbounded, rotation, layout, probes, k, range(1), 0.0), k), "first-table")
    bounds = first.filter(F.col("rank") == k).groupBy(F.col("query_id").alias("vec_id")).agg(F.min("score").alias("bound"))
    bounded = queries.join(bounds, "vec_id", "left").withColumn("bound", F.coalesce("bound", F.lit(float("-inf"))))
    bounded = written(bounded, "bounded-queries")
    least = bounded.agg(F.min(F.col("bound") / _norm("embedding"))).first()[0] / rotation.surest_cosine(probes)
    found = _found(index, bounded, rotation, layout, probes, k, range(1, tables + 1), least)
    return _ranked(first.drop("rank").unionByName(found), k)


def _found(
    index: DataFrame, queries: DataFrame, rotation: Rotations, layout: Layout, probes: int, k: int, tables: range, least: float
) -> DataFrame:
    stored = index.mapInArrow(_stored(rotation, layout, tables, least), CELL)
    asked = queries.mapInArrow(_asked(rotation, layout, probes, tables), f"{CELL}, bound double")
    key = ["cell", "block"]
    return stored.groupBy(*key).cogroup(asked.groupBy(*key)).applyInArrow(_best_of_cell(k), FOUND)


def _ranked(found: DataFrame, k: int) -> DataFrame:
    once = found.dropDuplicates(["query_id", "vec_id"])
    best_first = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = once.withColumn("rank", F.row_number().over(best_first)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


RESULT = "query_id long, rank int, vec_id long, score double"
FOUND = "query_id long, vec_id long, score double"
CELL = "cell long, block long, vec_id long, embedding array<double>, bits binary"


def _norm(column: str) -> Column:
    squares = F.transform(column, lambda x: x.cast("double") * x.cast("double"))
    return F.sqrt(F.aggregate(squares, F.lit(0.0), lambda a, b: a + b))


class Rotations:
    """The sign flips of every table; ``axes`` are the signed axes of rotated rows.

    The table after the last, ``by_length``, has bands of length as its buckets, the longest first.
    """

    def __init__(self, size: int, tables: int, seed: int, longest: float):
        self.width = 1 << max(1, math.ceil(math.log2(2 * size)))
        self.buckets = 2 * self.width
        self.signs = np.random.default_rng(seed).choice([-1.0, 1.0], (tables, ROTATIONS, self.width))
        self.by_length, self.longest = tables, longest
        self.band_ends = longest * BAND ** -np.arange(self.buckets, dtype=float)

    def padded(self, rows: np.ndarray) -> np.ndarray:
        out = np.zeros((len(rows), self.width))
        out[:, : rows.shape[1]] = rows
        return out

    def band(self, lengths: np.ndarray) -> np.ndarray:
        """Each length's band; the last one holds all that is shorter, too."""
        return np.clip(np.log(self.longest / lengths) / math.log(BAND), 0, self.buckets - 1).astype(np.int64)

    def surest_cosine(self, probes: int) -> float:
        """The cosine from which the tables find ``LEAST_FOUND`` of pairs.

        A rotated component is about normal; the axis of a vector is the largest of all, and a query
        with the cosine ``c`` to it has there ``c`` times as much and a normal rest.
        """
        if probes >= self.buckets:
            return SLACK
        normal = NormalDist()
        largest, probed = normal.inv_cdf(1 - 1 / self.buckets), normal.inv_cdf(1 - probes / self.buckets)
        for cosine in np.arange(0.01, 1, 0.01):
            missed = normal.cdf((probed - largest * cosine) / math.sqrt(1 - cosine * cosine))
            if 1 - missed**self.by_length >= LEAST_FOUND:
                return float(cosine)
        return 1.0

    def axes(self, rows: np.ndarray, table: int) -> np.ndarray:
        for signs in self.signs[table]:
            rows = hadamard(rows * signs)
        return np.concatenate([rows, -rows], axis=1)


def hadamard(rows: np.ndarray) -> np.ndarray:
    """The Hadamard transform of each row, whose length is a power of two."""
    n, width = rows.shape
    half = 1
    while half < width:
        pairs = rows.reshape(n, -1, 2, half)
        rows = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(n, width)
        half *= 2
    return rows / math.sqrt(width)


class Layout:
    """Cells of about ``CELL_VECTORS`` vectors: a run of neighbouring buckets, or a part of a full one."""

    def __init__(self, rotation: Rotations, counts: list, blocks: int):
        self.blocks = blocks
        per_bucket = np.zeros((rotation.by_length + 1, rotation.buckets), np.int64)
        for table, bucket, n in counts:
            per_bucket[table, bucket] = n
        self.run_of, self.starts, self.parts, self.first = [], [], [], []
        next_cell = 0
        for sizes in per_bucket:
            run_of, filled = np.zeros(len(sizes), np.int64), [0]
            for bucket, n in enumerate(sizes):
                if filled[-1] and filled[-1] + n > CELL_VECTORS:
                    filled.append(0)
                run_of[bucket] = len(filled) - 1
                filled[-1] += n
            parts = np.maximum(1, -(-np.array(filled) // CELL_VECTORS))
            self.run_of.append(run_of)
            self.starts.append(np.searchsorted(run_of, np.arange(len(filled))))
            self.parts.append(parts)
            self.first.append(next_cell + np.cumsum(parts) - parts)
            next_cell += parts.sum()


def _hashed(rotation: Rotations, batches: Iterator[pa.RecordBatch]):
    """Slices of the index with the bucket of each vector in every table."""
    for whole in batches:
        for start in range(0, whole.num_rows, 1024):
            batch = whole.slice(start, 1024)
            rows = matrix(batch.column("embedding"))
            lengths, padded = np.linalg.norm(rows, axis=1), rotation.padded(unit_rows(rows))
            buckets = [rotation.axes(padded, t).argmax(axis=1) for t in range(rotation.by_length)]
            yield batch, [*buckets, rotation.band(lengths)]


def _counted(rotation: Rotations):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros((rotation.by_length + 1, rotation.buckets), np.int64)
        for _, buckets in _hashed(rotation, batches):
            for table, bucket in enumerate(buckets):
                totals[table] += np.bincount(bucket, minlength=rotation.buckets)
        table, bucket = (c.astype(np.int32) for c in np.nonzero(totals))
        yield pa.record_batch([table, bucket, totals[table, bucket]], ["table", "bucket", "n"])

    return count


def _stored(rotation: Rotations, layout: Layout, tables: range, least: float):
    """A row per table and block of queries for each vector, with its bucket.

    In the table of lengths only vectors of the band of ``least``, which no query goes below, and longer ones.
    """

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole, buckets in _hashed(rotation, batches):
            for table in tables:
                batch, bucket = whole, buckets[table]
                if table == rotation.by_length:
                    asked = np.flatnonzero(rotation.band_ends[bucket] >= least * (1 - SLACK))
                    batch, bucket = whole.take(pa.array(asked)), bucket[asked]
                ids = batch.column("vec_id").to_numpy()
                run = layout.run_of[table][bucket]
                part = (mixed(ids) % layout.parts[table][run].astype(np.uint64)).astype(np.int64)
                bits = [b.tobytes() for b in np.packbits(np.eye(rotation.buckets, dtype=bool)[bucket], axis=1)]
                for block in range(layout.blocks):
                    yield _cell_rows(batch, layout.first[table][run] + part, np.full(len(ids), block), bits)

    return place


def _asked(rotation: Rotations, layout: Layout, probes: int, tables: range):
    """A row per visited cell for each query, with one bit for each bucket that it probes."""
    surest = rotation.surest_cosine(probes)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 1024):
                batch = whole.slice(start, 1024)
                rows = matrix(batch.column("embedding"))
                reach, bound = np.linalg.norm(rows, axis=1) * surest, batch.column("bound").to_numpy()
                block = (mixed(batch.column("vec_id").to_numpy()) % np.uint64(layout.blocks)).astype(np.int64)
                padded = rotation.padded(unit_rows(rows))
                for table in tables:
                    if table == rotation.by_length:
                        hit = reach[:, None] * rotation.band_ends >= bound[:, None] * (1 - SLACK)
                    else:
                        best = np.argpartition(-rotation.axes(padded, table), probes - 1, axis=1)[:, :probes]
                        hit = np.zeros((len(rows), rotation.buckets), bool)
                        hit[np.arange(len(rows))[:, None], best] = True
                    at, run = np.nonzero(np.logical_or.reduceat(hit, layout.starts[table], axis=1))
                    parts = layout.parts[table][run]
                    at, run = np.repeat(at, parts), np.repeat(run, parts)
                    part = np.arange(len(at)) - np.repeat(np.cumsum(parts) - parts, parts)
                    bits = [b.tobytes() for b in np.packbits(hit, axis=1)[at]]
                    rows_of_cells = batch.take(pa.array(at))
                    placed = _cell_rows(rows_of_cells, layout.first[table][run] + part, block[at], bits)
                    yield placed.append_column("bound", rows_of_cells.column("bound"))

    return place


def _cell_rows(batch: pa.RecordBatch, cell: np.ndarray, block: np.ndarray, bits: list[bytes]) -> pa.RecordBatch:
    vector = batch.column("embedding").cast(pa.list_(pa.float64()))
    columns = [cell.astype(np.int64), block.astype(np.int64), batch.column("vec_id").cast(pa.int64()), vector]
    return pa.record_batch([*columns, pa.array(bits, pa.binary())], ["cell", "block", "vec_id", "embedding", "bits"])


def _best_of_cell(k: int):
    """For each query of a cell, the ``k`` best of the vectors in the buckets it probes."""

    def best(stored: pa.Table, asked: pa.Table) -> pa.Table:
        out = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
        if stored.num_rows and asked.num_rows:
            ids, rows = stored.column("vec_id").to_numpy(), matrix(stored.column("embedding"))
            bucket = _bits(stored).argmax(axis=1)
            query_ids, query_rows, probed = asked.column("vec_id").to_numpy(), matrix(asked.column("embedding")), _bits(asked)
            bound = asked.column("bound").to_numpy()
            for start in range(0, len(query_ids), 256):
                some = slice(start, start + 256)
                scores = query_rows[some] @ rows.T
                scores[~probed[some][:, bucket] | (query_ids[some, None] == ids)] = -np.inf
                if len(ids) > k:
                    least = np.partition(scores, len(ids) - k, axis=1)[:, len(ids) - k, None]
                else:
                    least = np.full((len(scores), 1), -np.inf)
                least = np.maximum(least, bound[some, None])
                slack = np.where(np.isfinite(least), SLACK * (1 + np.abs(least)), 0)
                near, at = np.nonzero((scores >= least - slack) & (scores > -np.inf))
                exact = np.sum(query_rows[some][near] * rows[at], axis=1)
                order = np.lexsort((ids[at], -exact, near))
                near, at, exact = near[order], at[order], exact[order]
                place = np.arange(len(near)) - np.searchsorted(near, near)
                top = place < k
                out.append((query_ids[some][near[top]], ids[at[top]], exact[top]))
        return pa.table([np.concatenate(c) for c in zip(*out)], names=["query_id", "vec_id", "score"])

    return best


def _bits(table: pa.Table) -> np.ndarray:
    rows = np.frombuffer(b"".join(table.column("bits").to_pylist()), np.uint8).reshape(table.num_rows, -1)
    return np.unpackbits(rows, axis=1).astype(bool)
