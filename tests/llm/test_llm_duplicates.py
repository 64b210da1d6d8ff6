import random
from math import comb

import numpy as np
import pyarrow as pa
import pytest

from tickloom.llm import minhash
from tickloom.llm.components import connected_components
from tickloom.llm.shingles import shingle_counts, word_hashes

DOCS = "doc_id long, text string, class_id string, kept string, node string"


def brute_shingles(text):
    words = "".join(c if c.isalnum() or c.isspace() else "" for c in (text or "").lower()).split()
    parts = [tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))] if words else []
    return {p: parts.count(p) for p in parts}


def brute_similarity(a, b):
    total = 0.0
    for d in set(a) & set(b):
        total += 1 / sum(max(a.get(e, 0) / a[d], b.get(e, 0) / b[d]) for e in set(a) | set(b))
    return total


def brute_classes(rows):
    sets = [(i, brute_shingles(t)) for i, t in rows]
    parent = {i: i for i, _ in rows}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for x in range(len(sets)):
        for y in range(x):
            (i, a), (j, b) = sets[x], sets[y]
            if a and b and i != j and brute_similarity(a, b) >= 0.8:
                p, q = sorted((root(i), root(j)))
                parent[q] = p
    return {i: root(i) for i, _ in rows}


def corpus():
    rng = random.Random(4)
    vocabulary = [f"w{k}" for k in range(3000)]
    rows, n = [], 0
    for group in range(12):
        base = rng.choices(vocabulary, k=rng.choice([60, 150, 400]))
        for _ in range(rng.choice([1, 2, 5, 25])):
            words = list(base)
            for _ in range(rng.choice([0, 0, 1, 2])):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            text = " ".join(words)
            rows.append((n, text.upper() + "!" if rng.random() < 0.2 else text))
            n += 1
    line = " ".join(rng.choices(vocabulary, k=12))
    rows += [(n, "\n".join([line] * 30)), (n + 1, "\n".join([line] * 31)), (n + 2, "few words"), (n + 3, "Few, words."), (n + 4, "few")]
    rng.shuffle(rows)
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*row, "clash", "clash", "clash") for row in rows], DOCS)


@pytest.mark.parametrize("largest, pivots, large_rounds", [(4096, 64, 2), (6, 64, 2), (1, 2, 1)])
def test_classes_equal_all_pairs(spark, monkeypatch, largest, pivots, large_rounds):
    monkeypatch.setattr(minhash, "BUCKET_NODES", largest)
    monkeypatch.setattr(minhash, "BUCKET_BYTES", 100_000)
    monkeypatch.setattr(minhash, "PIVOTS", pivots)
    monkeypatch.setattr(minhash, "LARGE_ROUNDS", large_rounds)
    rows = corpus()
    got = {r.doc_id: (r.class_id, r.kept) for r in minhash.near_duplicates(frame(spark, rows)).collect()}
    expected = brute_classes(rows)
    assert {i: c for i, (c, _) in got.items()} == expected
    assert all(kept == (i == c) for i, (c, kept) in got.items())


def test_a_bucket_without_links_at_its_first_document(spark):
    """Documents chained through each other, none linked with the smallest one."""
    words = [f"c{k}" for k in range(400)]
    far = words[:330] + [f"z{k}" for k in range(70)]
    chain = [words[:k] + [f"y{k}"] + words[k + 1 :] for k in (20, 90, 160, 230, 300)]
    rows = [(0, " ".join(far))] + [(k + 1, " ".join(c)) for k, c in enumerate(chain)]
    got = {r.doc_id: r.class_id for r in minhash.near_duplicates(frame(spark, rows)).collect()}
    assert got == brute_classes(rows)


def test_different_texts_under_one_id(spark):
    words = [f"c{k}" for k in range(100)]
    a, b = " ".join(words), " ".join(f"d{k}" for k in range(100))
    rows = [(1, a), (1, b), (5, b + " more"), (9, a + " more"), (9, a + " more"), (2, b + " other"), (3, None), (3, None), (3, "")]
    got = sorted(((r.doc_id, r.class_id, r.kept) for r in minhash.near_duplicates(frame(spark, rows)).collect()))
    assert got == [(1, 1, True), (1, 1, True), (2, 1, False), (3, 3, True), (3, 3, True), (3, 3, True), (5, 1, False), (9, 1, False), (9, 1, False)]
    kept = minhash.drop_near_duplicates(frame(spark, rows)).select("doc_id", "text")
    assert sorted(map(tuple, kept.collect()), key=str) == sorted([(1, a), (1, b), (3, None), (3, "")], key=str)


def test_copies_of_one_id(spark):
    base = " ".join(f"c{k}" for k in range(100))
    rows = [(4, base + " end"), (4, base), (4, base), (7, base + " more")]
    kept = minhash.drop_near_duplicates(frame(spark, rows)).collect()
    assert [r.doc_id for r in kept] == [4]


@pytest.mark.parametrize("least_agreement", [0.0, minhash.LEAST_AGREEMENT])
def test_recall_on_documents_against_all_pairs(spark, least_agreement):
    """Near copies of the given documents are linked as comparing all pairs links them."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").filter("length(text) < 6000")
    rows = sorted(map(tuple, docs.select("doc_id", "text").orderBy("doc_id").limit(160).collect()))
    got = {r.doc_id: r.class_id for r in minhash.near_duplicates(frame(spark, rows), least_agreement=least_agreement).collect()}
    assert got == brute_classes(rows)


def test_odd_rows(spark):
    long = " ".join(f"v{k}" for k in range(30_000))
    rows = [(1, None), (2, ""), (3, "... !!"), (4, long), (5, long + " end"), (6, "same text here for all of us"), (6, "same text here for all of us"), (None, "same text here for all of us"), (7, "Same text, here for all of us")]
    docs = frame(spark, rows)
    got = sorted(((r.doc_id or 0, r.class_id, r.kept) for r in minhash.near_duplicates(docs).collect()), key=str)
    assert got == sorted([(1, 1, True), (2, 2, True), (3, 3, True), (4, 4, True), (5, 4, False), (6, 6, True), (6, 6, True), (0, None, True), (7, 6, False)], key=str)
    kept = minhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns and sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 2, 3, 4, 6]
    assert minhash.near_duplicates(frame(spark, [])).count() == 0
    assert minhash.drop_near_duplicates(frame(spark, [])).count() == 0


def test_registers_estimate_the_similarity():
    rng = random.Random(2)
    words = [f"w{k}" for k in range(300)]
    a = rng.choices(words, k=600)
    texts = [" ".join(a), " ".join(a[:450] + rng.choices(words, k=150)), " ".join(a[:40] * 12)]
    owner, elements, counts = shingle_counts(*word_hashes(pa.array(texts)))
    signature = minhash.prob_min_hash(owner, elements, counts, 3, 4000)
    for x, y in ((0, 1), (0, 2), (1, 2)):
        exact = brute_similarity(brute_shingles(texts[x]), brute_shingles(texts[y]))
        mine = minhash.probability_jaccard(elements[owner == x], counts[owner == x] * 1.0, elements[owner == y], counts[owner == y] * 1.0)
        assert abs(exact - mine) < 1e-9
        assert abs((signature[x] == signature[y]).mean() - exact) < 0.04


def test_pairs_left_unverified_are_few_beside_those_without_a_band():
    registers, p = minhash.BANDS * minhash.ROWS, minhash.SIMILARITY
    prints = np.zeros((registers + 1, registers), np.uint16)
    for equal in range(registers + 1):
        prints[equal, equal:] = 1
    rows = pa.record_batch(
        [pa.array(np.zeros(registers + 1, np.int64)), pa.array(np.arange(registers + 1))]
        + [pa.array([r.tobytes() for r in x], pa.binary()) for x in (np.zeros_like(prints), prints)],
        ["a", "b", "print_a", "print_b"],
    )
    passed = {k for batch in minhash._agreeing(minhash.LEAST_AGREEMENT)(iter([rows])) for k in batch.column("b").to_pylist()}
    lost = sum(comb(registers, k) * p**k * (1 - p) ** (registers - k) for k in range(registers + 1) if k not in passed)
    assert lost < 0.001 * (1 - p**minhash.ROWS) ** minhash.BANDS


def test_components(spark):
    rng = random.Random(1)
    links = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)] + [(0, k) for k in range(500, 600)] + [(k, k + 1) for k in range(700, 760)] + [(None, 3), (4, 4)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    near = {}
    for a, b in links:
        if a is not None and a != b:
            near.setdefault(a, set()).add(b)
            near.setdefault(b, set()).add(a)
    expected = {}
    for node in sorted(near):
        todo = [] if node in expected else [node]
        while todo:
            if (at := todo.pop()) not in expected:
                expected[at] = node
                todo += near[at]
    assert got == expected
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0
