"""Near-duplicate documents by ProbMinHash signatures, banding and exact verification."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tickloom.llm.components import connected_components
from tickloom.llm.shingles import sequence_keys, shingle_counts, word_hashes
from tickloom.llm.tables import mixed, text_slices, uniform, written
from tickloom.operators.lookup import lookup_join

BANDS, ROWS = 24, 5
SIMILARITY = 0.8
#: Pairs whose signatures agree less than this are not verified: at a similarity of 0.8 the share of
#: equal registers of 120 is below it in about one of 58 million pairs. 0 verifies all of them.
LEAST_AGREEMENT = 0.58
#: A bucket of at most so many documents and bytes is searched by one task, and so are buckets of that
#: many bytes together.
BUCKET_NODES, BUCKET_BYTES = 4_096, 8 << 20
#: Documents of a larger bucket that are compared with the rest of it in a round: first a few of its largest
#: class, which take in most of the rest, and from the round ``LARGE_ROUNDS`` on those of small classes.
LARGE_PIVOTS, LARGE_ROUNDS, PIVOTS = 3, 2, 256
#: Bytes of shingles and pairs that a block of pairs is dealt for, and elements that are compared at once.
BLOCK_BYTES, BLOCK_PAIRS, COMPARED = 4 << 20, 16_384, 1 << 20
#: Bytes of a document beside its shingles: bands, fingerprint, keys.
DOCUMENT_BYTES = 480
ROUNDING = 1e-9


def near_duplicates(docs: DataFrame, similarity: float = SIMILARITY, least_agreement: float = LEAST_AGREEMENT) -> DataFrame:
    """``(doc_id, class_id, kept)`` for every row of ``docs (doc_id, text)``; other columns are ignored.

    Two documents are linked when the probability Jaccard similarity of their five-word shingles,
    weighted by how often each occurs, is ``similarity`` or more. A class is a connected component of
    links, named by its smallest ``doc_id``, whose document is the one that is kept.

    Documents with the same words in the same order (case and punctuation aside) are one node before
    anything is compared. Candidates share a band of their signatures, that is a bucket. Buckets are dealt
    to blocks by their smallest node, so that those of the same near copies meet and shingles travel once
    per block. A block compares the nodes of a bucket that no link connects yet, each pair in the first band
    it shares, and returns links that connect what it found. A bucket too large for a block is searched
    in rounds, from a few nodes of its largest class and then those of its smaller ones, until the rest
    is in one class. So no bucket is capped, no pairs are shuffled but those of such buckets.

    At a similarity of exactly 0.8 no band finds 7.3e-5 of the pairs and too few equal registers leave
    out 1.8e-8 (by the binomial distribution; none with ``least_agreement`` 0), together 7.3e-5, and less
    above 0.8. Such a pair is lost where no other document links the two.

    A text that is null or has no word is alone in its class. A row whose ``doc_id`` is null gets a
    null class and is kept. Rows with the same ``doc_id`` and text share a class; different texts under one
    ``doc_id`` have each its own, though these may bear the same name.
    """
    return _classed(docs, similarity, least_agreement).select("doc_id", "class_id", "kept")


def drop_near_duplicates(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """One row of ``docs`` for each class, with all its columns, and all rows whose ``doc_id`` is null.

    It is that of the smallest ``doc_id``; of its different texts, the one with the smallest hash. Of rows
    with the same ``doc_id`` and text one stays. Only the keys of rows that go are joined to the documents.
    """
    classed = written(_classed(docs, similarity, LEAST_AGREEMENT).filter("doc_id IS NOT NULL"), "classed")
    place = F.struct("doc_id", "text_key")
    stays = classed.filter("node IS NOT NULL").groupBy("component").agg(F.min(place).alias("stays"))
    per_key = classed.groupBy("doc_id", "text_key").agg(F.count(F.lit(1)).alias("rows"), F.min("component").alias("component"))
    judged = per_key.join(stays, "component", "left").select(
        F.col("doc_id").alias("_id"),
        F.col("text_key").alias("_key"),
        "rows",
        F.coalesce((F.col("stays.doc_id") == F.col("doc_id")) & (F.col("stays.text_key") == F.col("text_key")), F.lit(True)).alias("stays"),
    )
    marks = written(judged.filter("NOT stays OR rows > 1").select("_id", "_key", "stays"), "marks")
    keyed = docs.withColumns({"_id": F.col("doc_id").cast("long"), "_key": _text_key()})
    marked = lookup_join(keyed, marks, ["_id", "_key"], "left")
    whole = marked.filter("stays IS NULL").select(*docs.columns)
    once = marked.filter("stays").dropDuplicates(["_id", "_key"]).select(*docs.columns)
    return whole.unionByName(once)


def _classed(docs: DataFrame, similarity: float, least_agreement: float) -> DataFrame:
    """``(doc_id, text_key, node, component, class_id, kept)`` for every row."""
    keyed = docs.select("doc_id", "text", _text_key().alias("text_key"))
    signed = written(keyed.mapInArrow(_sign, SIGNED), "signatures")
    worded = signed.filter("doc_id IS NOT NULL AND key_a IS NOT NULL")
    same = worded.groupBy("key_a", "key_b").agg(
        F.min("doc_id").alias("first_doc"), F.first("bands").alias("bands"), F.first("fingerprint").alias("fingerprint")
    )
    nodes = written(same.withColumn("node", F.monotonically_increasing_id()), "nodes")
    classes = connected_components(_links(docs, nodes, similarity, least_agreement))
    linked = written(classes.join(nodes.select("node", "first_doc"), "node"), "linked")
    names = linked.groupBy("component").agg(F.min("first_doc").alias("class"))
    found = linked.select("node", "component").join(names, "component")
    of_key = nodes.select("key_a", "key_b", "node", "first_doc").join(found, "node", "left")
    rows = signed.select("doc_id", "text_key", "key_a", "key_b").join(of_key, ["key_a", "key_b"], "left")
    class_id = F.when(F.col("doc_id").isNotNull(), F.coalesce("class", "first_doc", "doc_id"))
    return rows.select(
        "doc_id",
        "text_key",
        "node",
        F.coalesce("component", "node").alias("component"),
        class_id.alias("class_id"),
        F.coalesce(F.col("doc_id") == class_id, F.lit(True)).alias("kept"),
    )


def _text_key() -> Column:
    return F.xxhash64("text")


# --- signatures -------------------------------------------------------------------------

SIGNED = "doc_id long, text_key long, key_a long, key_b long, bands array<long>, fingerprint binary"


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in text_slices(batches):
        n = batch.num_rows
        hashes, owner = word_hashes(batch.column("text"))
        key_a, key_b = sequence_keys(hashes, owner, n)
        empty = np.bincount(owner, minlength=n) == 0
        signatures = prob_min_hash(*shingle_counts(hashes, owner), n)
        bands = np.zeros((n, BANDS), np.uint64)
        for k in range(ROWS):
            bands = mixed(bands ^ signatures[:, k::ROWS], k)
        prints = (signatures & np.uint64(0xFFFF)).astype(np.uint16)
        lists = pa.FixedSizeListArray.from_arrays(pa.array(bands.view(np.int64).ravel()), BANDS)
        yield pa.record_batch(
            [
                batch.column("doc_id").cast(pa.int64()),
                batch.column("text_key"),
                pa.array(key_a, mask=empty),
                pa.array(key_b, mask=empty),
                lists.cast(pa.list_(pa.int64())),
                pa.array([row.tobytes() for row in prints], pa.binary()),
            ],
            ["doc_id", "text_key", "key_a", "key_b", "bands", "fingerprint"],
        )


def prob_min_hash(
    owner: np.ndarray, elements: np.ndarray, weights: np.ndarray, n: int, registers: int = BANDS * ROWS
) -> np.ndarray:
    """Signatures, ``n`` rows of ``registers`` element hashes; equal registers estimate the similarity.

    Every element is a Poisson process whose rate is its weight; each arrival falls into a random
    register, which remembers the element that arrived first. Arrivals are drawn one per element and
    round; an element is done when it is later than the last register of its text to fill.
    """
    best = np.full(n * registers, np.inf)
    signature = np.zeros(n * registers, np.uint64)
    time = np.zeros(len(elements))
    step = 0
    while len(elements):
        time = time - np.log(uniform(elements, 2 * step + 100)) / weights
        register = mixed(elements, 2 * step + 101) % np.uint64(registers)
        slot = owner * registers + register.astype(np.int64)
        np.minimum.at(best, slot, time)
        first = best[slot] == time
        signature[slot[first]] = elements[first]
        live = np.unique(owner)
        limit = np.zeros(n)
        limit[live] = best.reshape(n, registers)[live].max(axis=1)
        going = time < limit[owner]
        owner, elements, weights, time = owner[going], elements[going], weights[going], time[going]
        step += 1
    return signature.reshape(n, registers)


# --- candidates -------------------------------------------------------------------------


def _links(docs: DataFrame, nodes: DataFrame, similarity: float, least_agreement: float) -> DataFrame:
    """Verified links ``(a, b)`` that connect whatever any pair of a bucket connects."""
    banded = nodes.select("node", F.posexplode("bands").alias("band", "hash"))
    banded = banded.select("node", "band", F.xxhash64("band", "hash").alias("bucket"))
    shared = banded.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.min("node").alias("least")).filter("n > 1")
    members = written(lookup_join(banded, written(shared, "shared"), ["bucket"]), "members")
    sets = _sets(docs, nodes, members)
    bytes_of = sets.select("node", (F.length("elements") + F.length("counts") + DOCUMENT_BYTES).alias("bytes"))
    weighed = lookup_join(members, written(bytes_of, "bytes"), ["node"]).groupBy("bucket").agg(F.sum("bytes").alias("bytes"))
    members = written(members.join(weighed, "bucket"), "weighed")
    fits = (F.col("n") <= BUCKET_NODES) & (F.col("bytes") <= BUCKET_BYTES)
    total = members.filter(fits).agg(F.sum(F.col("bytes") / F.col("n"))).first()[0] or 0
    block = F.pmod(F.xxhash64("least"), F.lit(max(1, int(total / BUCKET_BYTES))))
    dealt = members.filter(fits).select(block.alias("block"), "bucket", "band", F.col("node").alias("member"))
    sent = dealt.select("block", "member").distinct().toDF("to_block", "node").join(sets, "node").groupBy("to_block")
    within = dealt.groupBy("block").cogroup(sent).applyInArrow(_within(similarity, least_agreement), "a long, b long")
    links = written(within, "links")
    large = members.filter(~fits).select("bucket", "node")
    return links if large.isEmpty() else _large_links(large, sets, links, similarity, least_agreement)


def _sets(docs: DataFrame, nodes: DataFrame, members: DataFrame) -> DataFrame:
    """Shingles, bands and fingerprint of the nodes that share a bucket, from the text of their first document."""
    wanted = written(lookup_join(nodes, written(members.select("node").distinct(), "sharing"), ["node"]), "wanted")
    ids = written(wanted.select(F.col("first_doc").alias("doc_id")).distinct(), "sharing-ids")
    texts = lookup_join(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), ids, ["doc_id"])
    keys = ["first_doc", "key_a", "key_b"]
    shingled = texts.mapInArrow(_shingle, "first_doc long, key_a long, key_b long, elements binary, counts binary")
    return written(wanted.join(shingled.dropDuplicates(keys), keys).drop(*keys), "shingles")


def _within(similarity: float, least_agreement: float):
    """Links between the nodes of each bucket of a block that connect what is similar enough."""

    def within(dealt: pa.Table, sent: pa.Table) -> pa.Table:
        node = sent.column("node").to_numpy()
        prints = np.frombuffer(b"".join(sent.column("fingerprint").to_pylist()), np.uint16).reshape(len(node), -1)
        bands = sent.column("bands").combine_chunks().flatten().to_numpy().reshape(len(node), -1)
        sets = _Sets(sent.column("elements").to_pylist(), sent.column("counts").to_pylist())
        order = np.argsort(node)
        at = order[np.searchsorted(node, dealt.column("member").to_numpy(), sorter=order)]
        bucket, band = dealt.column("bucket").to_numpy(), dealt.column("band").to_numpy()
        by_bucket = np.lexsort((node[at], bucket))
        cuts = np.flatnonzero(np.diff(bucket[by_bucket])) + 1
        label, links = np.arange(len(node)), []
        for rows in np.split(by_bucket, cuts) if len(bucket) else []:
            own, earlier = at[rows], band[rows[0]]
            for k in range(len(own) - 1):
                one, others = own[k], own[k + 1 :]
                others = others[label[others] != label[one]]
                if not len(others):
                    continue
                likely = (prints[others] == prints[one]).mean(axis=1) >= least_agreement
                others = others[likely & ~(bands[others, :earlier] == bands[one, :earlier]).any(axis=1)]
                if not len(others):
                    continue
                linked = others[sets.similarities(one, others) >= similarity - ROUNDING]
                _, first = np.unique(label[linked], return_index=True)
                links += [(node[one], node[other]) for other in linked[first]]
                label[np.isin(label, label[linked])] = label[one]
        a, b = np.array(links, np.int64).reshape(-1, 2).T
        return pa.table([pa.array(a), pa.array(b)], ["a", "b"])

    return within


def _large_links(
    members: DataFrame, sets: DataFrame, links: DataFrame, similarity: float, least_agreement: float
) -> DataFrame:
    """``links`` and those that large buckets add, round by round."""
    for turn in count():
        classes = written(connected_components(links), "classes")
        links = classes.select(F.col("component").alias("a"), F.col("node").alias("b"))
        classed = members.join(classes, "node", "left").select(
            "bucket", "node", F.coalesce("component", "node").alias("class")
        )
        sizes = classed.groupBy("bucket", "class").agg(F.count(F.lit(1)).alias("size"))
        split = sizes.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
        parted = written(sizes.join(split, "bucket"), "parted")
        if parted.isEmpty():
            return links
        order, pivots_each = ("size", PIVOTS) if turn >= LARGE_ROUNDS else (F.desc("size"), LARGE_PIVOTS)
        in_order = Window.partitionBy("bucket").orderBy(order, "class", "node")
        ranked = classed.join(parted, ["bucket", "class"])
        ranked = written(ranked.withColumn("k", F.row_number().over(in_order)), "ranked")
        pivots = ranked.filter(F.col("k") <= pivots_each)
        pivots = pivots.select("bucket", F.col("node").alias("pivot"), F.col("class").alias("of"), F.col("k").alias("j"))
        # two pivots meet once
        met = ranked.join(pivots, "bucket").filter("class <> of AND (k > j)")
        pairs = met.select(F.least("pivot", "node").alias("a"), F.greatest("pivot", "node").alias("b")).distinct()
        members = ranked.filter(F.col("k") > pivots_each).select("bucket", "node")
        links = links.unionByName(_verified(sets, pairs, similarity, least_agreement))


def _verified(sets: DataFrame, pairs: DataFrame, similarity: float, least_agreement: float) -> DataFrame:
    """The pairs that are similar enough, by their own shingles."""
    prints = sets.select("node", "fingerprint")
    likely = (
        pairs.join(prints.toDF("a", "print_a"), "a")
        .join(prints.toDF("b", "print_b"), "b")
        .mapInArrow(_agreeing(least_agreement), "a long, b long")
    )
    return _compared(written(likely, "likely"), sets.select("node", "elements", "counts"), similarity)


def _compared(likely: DataFrame, shingled: DataFrame, similarity: float) -> DataFrame:
    """Pairs are dealt in blocks, so that shingles travel once per block and not once per pair.

    A block is some of the first documents of pairs; where these have many pairs, as a very common
    text does, it is split by the second ones.
    """
    n, size = shingled.agg(F.count(F.lit(1)), F.sum(F.length("elements") + F.length("counts"))).first()
    per_block = max(1, BLOCK_BYTES * n // max(1, size or 0))
    block = F.pmod(F.xxhash64("a", F.lit(31)), F.lit(max(1, -(-n // per_block))))
    dealt = likely.withColumn("block", block)
    parts = dealt.groupBy("block").agg(F.ceil(F.count(F.lit(1)) / BLOCK_PAIRS).alias("parts"))
    dealt = dealt.join(parts, "block").withColumn("part", F.pmod(F.xxhash64("b", F.lit(37)), "parts"))
    dealt = dealt.select("block", "part", "a", "b")
    ends = dealt.select("block", "part", F.explode(F.array("a", "b"))).toDF("to_block", "to_part", "node").distinct()
    sent = ends.join(shingled, "node").groupBy("to_block", "to_part")
    return dealt.groupBy("block", "part").cogroup(sent).applyInArrow(_similar(similarity), "a long, b long")


def _agreeing(least_agreement: float):
    def agreeing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                a, b = (
                    np.frombuffer(b"".join(batch.column(name).to_pylist()), np.uint16).reshape(batch.num_rows, -1)
                    for name in ("print_a", "print_b")
                )
                chosen = batch.filter(pa.array((a == b).mean(axis=1) >= least_agreement))
                yield chosen.select(["a", "b"])

    return agreeing


def _shingle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in text_slices(batches):
        n = batch.num_rows
        hashes, owner = word_hashes(batch.column("text"))
        key_a, key_b = sequence_keys(hashes, owner, n)
        texts, elements, counts = shingle_counts(hashes, owner)
        cuts = np.searchsorted(texts, np.arange(n + 1))
        spans = list(zip(cuts[:-1], cuts[1:]))
        # 32 bits of the hashes, sorted; counts are left out where all are 1
        order = np.lexsort((elements.astype(np.uint32), texts))
        elements, counts = elements[order].astype(np.uint32), counts[order].astype(np.uint32)
        yield pa.record_batch(
            [
                batch.column("doc_id").cast(pa.int64()),
                pa.array(key_a),
                pa.array(key_b),
                pa.array([elements[i:j].tobytes() for i, j in spans], pa.binary()),
                pa.array([b"" if (counts[i:j] == 1).all() else counts[i:j].tobytes() for i, j in spans], pa.binary()),
            ],
            ["first_doc", "key_a", "key_b", "elements", "counts"],
        )


def _similar(least: float):
    def similar(pairs: pa.Table, sent: pa.Table) -> pa.Table:
        node = sent.column("node").to_numpy()
        order = np.argsort(node)
        a, b = (order[np.searchsorted(node, pairs.column(end).to_numpy(), sorter=order)] for end in ("a", "b"))
        sets = _Sets(sent.column("elements").to_pylist(), sent.column("counts").to_pylist())
        by_a = np.argsort(a, kind="stable")
        keep = np.zeros(len(a), bool)
        for rows in np.split(by_a, np.flatnonzero(np.diff(a[by_a])) + 1) if len(a) else []:
            keep[rows] = sets.similarities(a[rows[0]], b[rows]) >= least - ROUNDING
        return pairs.select(["a", "b"]).filter(pa.array(keep))

    return similar


class _Sets:
    """Weighted sets one after another, elements coded by their place among all of them."""

    def __init__(self, elements: list[bytes], counts: list[bytes]):
        flat = np.frombuffer(b"".join(elements), np.uint32)
        known, self.codes = np.unique(flat, return_inverse=True)
        self.size = np.fromiter((len(e) // 4 for e in elements), np.int64, len(elements))
        self.first = np.cumsum(self.size) - self.size
        self.weights = np.ones(len(flat))
        for k, own in enumerate(counts):
            if own:
                self.weights[self.first[k] : self.first[k] + self.size[k]] = np.frombuffer(own, np.uint32)
        self.total = np.add.reduceat(self.weights, self.first) if len(flat) else self.weights
        self.mark = np.zeros(len(known))

    def similarities(self, one: int, others: np.ndarray) -> np.ndarray:
        """Similarity of a set to each of ``others``, ``COMPARED`` elements at a time."""
        own = slice(self.first[one], self.first[one] + self.size[one])
        self.mark[self.codes[own]] = self.weights[own]
        before = np.cumsum(self.size[others]) - self.size[others]
        cuts = np.flatnonzero(np.diff(before // COMPARED)) + 1
        found = np.concatenate([self._to_marked(self.total[one], some) for some in np.split(others, cuts)])
        self.mark[self.codes[own]] = 0
        return found

    def _to_marked(self, total: float, others: np.ndarray) -> np.ndarray:
        n, size = len(others), self.size[others]
        owner = np.repeat(np.arange(n), size)
        at = np.repeat(self.first[others] - np.cumsum(size) + size, size) + np.arange(len(owner))
        x, y = self.mark[self.codes[at]], self.weights[at]
        common = x > 0
        x, y, owner = x[common], y[common], owner[common]
        both_x, both_y = np.bincount(owner, x, n), np.bincount(owner, y, n)
        only_x, only_y = total - both_x, self.total[others] - both_y
        if (x == y).all():  # then each term is the weight over that of the union
            return both_x / (only_x + only_y + both_x)
        order = np.lexsort((x / y, owner))
        x, y, owner = x[order], y[order], owner[order]
        later = np.cumsum(both_x)[owner] - np.cumsum(x) + x
        earlier = np.cumsum(y) - y - (np.cumsum(both_y) - both_y)[owner]
        return np.bincount(owner, 1.0 / ((only_x[owner] + later) / x + (only_y[owner] + earlier) / y), n)


def probability_jaccard(a: np.ndarray, weight_a: np.ndarray, b: np.ndarray, weight_b: np.ndarray) -> float:
    """Similarity of two weighted sets, given as sorted elements and their weights."""
    _, at_a, at_b = np.intersect1d(a, b, return_indices=True)
    x, y = weight_a[at_a], weight_b[at_b]
    only_a, only_b = weight_a.sum() - x.sum(), weight_b.sum() - y.sum()
    order = np.argsort(x / y, kind="stable")
    x, y = x[order], y[order]
    later = np.cumsum(x[::-1])[::-1]
    earlier = np.cumsum(y) - y
    return float(np.sum(1.0 / ((only_a + later) / x + (only_b + earlier) / y)))
