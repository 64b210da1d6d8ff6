"""Near-duplicate vectors of one label: integer codes meet in chunks, vectors settle what codes leave open."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.code_search import Codes, Search
from tickloom.llm.components import connected_components
from tickloom.llm.tables import release_memory, written
from tickloom.llm.vectors import matrix, one_size, unit_rows, usable

COSINE = 0.98
BLOCKS = 4
#: Vectors of a label that one side of a task holds; labels with an eighth of it are cut in two.
CHUNK = 1 << 19
#: Groups, at least, that share out the labels with fewer vectors.
GROUPS = 64


def near_vectors(vectors: DataFrame, cosine: float = COSINE, blocks: int = BLOCKS) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` for every row of ``vectors (vec_id, embedding, label)``.

    Two vectors link when their labels are equal and not null and their cosine is ``cosine`` or more.
    Unit vectors are rotated and rounded to 16 bits a component. Only these codes move: those of a
    label meet in one task, in chunks that meet pairwise if they are many. A task searches them in
    memory by ``blocks`` (see ``code_search``) and passes on counts, a spanning forest of its links and
    the pairs too close to ``cosine`` for codes to tell, which are verified on the original vectors.

    Rows with the same vector (exactly, up to the sign of zero) and label are one before the join.
    Vectors that are null, zero or not finite and rows with a null label link with nothing; a null
    ``vec_id`` gets no links and a null component.
    """
    part = vectors.select("vec_id", "embedding", "label").withColumn(
        "takes_part", usable("embedding") & F.col("label").isNotNull() & F.col("vec_id").isNotNull()
    )
    value = F.when(F.col("takes_part"), F.col("embedding").cast("array<double>"))
    rows = part.select("vec_id", "takes_part", value.alias("embedding"), F.xxhash64("label").alias("label"), F.to_json(F.array("label")).alias("name"))
    keyed = written(rows.mapInArrow(_keys, KEYED), "vectors")
    taking = keyed.filter("takes_part")
    copies = written(
        taking.groupBy("copy", "mark").agg(F.min("vec_id").alias("node"), F.count_distinct("vec_id").alias("copies"), F.min("label").alias("label")),
        "copies",
    )
    size = one_size(taking.select("size"))
    found = written(_joined(rows.filter("takes_part"), copies, size, cosine, blocks), "found")
    classes = connected_components(found.filter("b IS NOT NULL").select("a", "b"))
    counts = found.filter("links IS NOT NULL").groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links"))
    named = copies.drop("label").join(counts, "node", "left").join(classes, "node", "left")
    result = keyed.join(named, ["copy", "mark"], "left")
    component = F.coalesce("component", "node", "vec_id")
    return result.select(
        "vec_id",
        F.when(F.col("takes_part"), F.col("copies") - 1 + F.coalesce("links", F.lit(0))).otherwise(0).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"),
    )


KEYED = "vec_id long, takes_part boolean, label long, size int, copy long, mark long"
CODED = "node long, copy long, mark long, code binary"
FOUND = "a long, b long, links long"
OPEN = "mark_a long, mark_b long, copies_a long, copies_b long"


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each row with the size of its vector and 128 bits that tell its vector and label from others."""
    for batch in batches:
        size, digests = _digests(batch)
        none = ~batch.column("takes_part").to_numpy(zero_copy_only=False).astype(bool)
        columns = [pa.array(size, mask=none), *(pa.array(digests[:, k], mask=none) for k in range(2))]
        yield pa.record_batch([*(batch.column(c) for c in ("vec_id", "takes_part", "label")), *columns], ["vec_id", "takes_part", "label", "size", "copy", "mark"])


def _digests(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    vectors = batch.column("embedding")
    size = np.nan_to_num(vectors.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int32)
    flat = (vectors.flatten().to_numpy(zero_copy_only=False) + 0.0).tobytes()
    ends = np.cumsum(size, dtype=np.int64) * 8
    names = batch.column("name").to_pylist()
    digests = [
        hashlib.md5(f"{name}".encode() + flat[start:end], usedforsecurity=False).digest()
        for name, start, end in zip(names, (ends - size * 8).tolist(), ends.tolist())
    ]
    return size, np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)


def _joined(rows: DataFrame, copies: DataFrame, size: int, cosine: float, blocks: int) -> DataFrame:
    """Rows ``(a, b, null)`` of a spanning forest, and ``(a, null, links)`` to be summed."""
    if not size:
        return rows.sparkSession.createDataFrame([], FOUND)
    codes = Codes(size, cosine, blocks)
    keys = ["copy", "mark", "node"]
    coded = rows.withColumnRenamed("vec_id", "node").mapInArrow(_coded(codes), CODED)
    nodes = coded.join(copies, keys).dropDuplicates(keys).drop("copy")
    sizes = copies.groupBy("label").agg(F.count(F.lit(1)).alias("n"))
    cut = F.greatest(F.ceil(F.col("n") / CHUNK), F.lit(2)).cast("int")
    large = written(sizes.filter(F.col("n") > CHUNK // 8).select("label", cut.alias("parts")), "large-labels")
    parted = nodes.join(large, "label", "left").withColumn("own", F.pmod(F.xxhash64("node"), "parts").cast("int"))
    # a chunk meets itself and every other one; small labels are dealt to groups
    other = F.explode(F.when(F.col("parts").isNull(), F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.col("parts") - 1)))
    groups = max(GROUPS, 8 * copies.count() // CHUNK)
    group = F.when(F.col("parts").isNull(), F.pmod("label", F.lit(groups))).otherwise(F.col("label"))
    dealt = parted.withColumn("other", other).select(
        group.alias("group"),
        F.least("own", "other").alias("part_a"),
        F.greatest("own", "other").alias("part_b"),
        F.coalesce(F.col("own") > F.col("other"), F.lit(False)).alias("right"),
        "label", "node", "mark", "copies", "code",
    )
    told = written(dealt.groupBy("group", "part_a", "part_b").applyInArrow(_links(codes), f"{FOUND}, {OPEN}"), "told")
    settled = _settled(rows, told.filter("mark_a IS NOT NULL"), cosine)
    return told.filter("mark_a IS NULL").select("a", "b", "links").unionByName(settled)


def _coded(codes: Codes):
    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            _, digests = _digests(batch)
            values = pa.py_buffer(codes.of(matrix(batch.column("embedding"))).tobytes())
            ends = pa.py_buffer(np.arange(0, 2 * codes.size * batch.num_rows + 1, 2 * codes.size, dtype=np.int32).tobytes())
            value = pa.Array.from_buffers(pa.binary(), batch.num_rows, [None, ends, values])
            yield pa.record_batch([batch.column("node"), pa.array(digests[:, 0]), pa.array(digests[:, 1]), value], ["node", "copy", "mark", "code"])

    return code


def _links(codes: Codes):
    """Links among the codes of a group, label by label."""

    def links(key: tuple, rows: pa.Table) -> pa.Table:
        release_memory()
        label, node, mark, copies = (rows.column(c).to_numpy() for c in ("label", "node", "mark", "copies"))
        right = rows.column("right").to_numpy(zero_copy_only=False).astype(bool)
        code = rows.column("code").combine_chunks()
        start = code.offset * 2 * codes.size
        code = np.frombuffer(code.buffers()[2], np.int16)[start // 2 :][: len(node) * codes.size].reshape(-1, codes.size)
        search = Search(codes, code, node, copies)
        order = np.argsort(label, kind="stable")
        for some in np.split(order, np.flatnonzero(np.diff(label[order])) + 1):
            if len(some) > 1:
                search.run(some[~right[some]], None if key[1] == key[2] else some[right[some]])
        linked = np.flatnonzero(search.links)
        tree, unsure = (np.concatenate([np.zeros((0, 2), np.int64), *pairs]) for pairs in (search.edges, search.unsure))
        a, b = np.concatenate([tree, unsure]).T
        sure, none = np.arange(len(a)) < len(tree), pa.nulls(len(linked), pa.int64())

        def of_open(values: np.ndarray) -> pa.ChunkedArray:
            return pa.chunked_array([pa.array(values, mask=sure), none])

        return pa.table(
            {
                "a": np.concatenate([node[a], node[linked]]),
                "b": pa.chunked_array([pa.array(node[b]), none]),
                "links": pa.chunked_array([pa.nulls(len(a), pa.int64()), pa.array(search.links[linked])]),
                "mark_a": of_open(mark[a]),
                "mark_b": of_open(mark[b]),
                "copies_a": of_open(copies[a]),
                "copies_b": of_open(copies[b]),
            }
        )

    return links


def _settled(rows: DataFrame, unsure: DataFrame, cosine: float) -> DataFrame:
    """The links among pairs that codes leave open, told by their vectors."""
    if unsure.isEmpty():
        return rows.sparkSession.createDataFrame([], FOUND)
    ends = unsure.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    wanted = rows.withColumnRenamed("vec_id", "node").join(ends, "node", "left_semi")
    vectors = written(wanted.mapInArrow(_marked, "node long, mark long, embedding array<double>").dropDuplicates(["node", "mark"]), "open-vectors")
    left, right = (vectors.select(F.col("node").alias(end), F.col("mark").alias(f"mark_{end}"), F.col("embedding").alias(f"vector_{end}")) for end in "ab")
    pairs = unsure.drop("links").join(left, ["a", "mark_a"]).join(right, ["b", "mark_b"])
    return written(pairs.mapInArrow(_linked(cosine), FOUND), "settled")


def _marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        mark = pa.array(_digests(batch)[1][:, 1])
        yield pa.record_batch([batch.column("node"), mark, batch.column("embedding")], ["node", "mark", "embedding"])


def _linked(cosine: float):
    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            one, two = (unit_rows(matrix(batch.column(f"vector_{end}"))) for end in "ab")
            some = pa.array(np.sum(one * two, axis=1) >= cosine)
            a, b, more, links = (batch.column(c).filter(some) for c in ("a", "b", "copies_a", "copies_b"))
            none = pa.nulls(len(a), pa.int64())
            yield pa.record_batch([pa.concat_arrays(c) for c in ((a, a, b), (b, none, none), (none, links, more))], ["a", "b", "links"])

    return linked
