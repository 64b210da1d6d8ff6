import math
import re
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from tickloom.llm import queries, ranked_search
from tickloom.llm.ranked_search import Heaps, term_lists

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, best):
    counts = [(doc_id, Counter(terms(text))) for doc_id, text in docs]
    counts = [(doc_id, tf) for doc_id, tf in counts if tf]
    n_docs, n_terms = len(counts), sum(tf.total() for _, tf in counts)
    df = Counter(term for _, tf in counts for term in tf)
    out = []
    for item_id, text in dict.fromkeys(items):
        scores = []
        for doc_id, tf in counts:
            m = 75 + (25 * tf.total() * n_docs) // n_terms
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * tf[t] // (1000 * tf[t] + 12 * m))
                for t in terms(text)
                if tf[t]
            )
            if score > 0:
                scores.append((-score, doc_id is None, doc_id or 0))
        for rank, (score, null, doc_id) in enumerate(sorted(scores)[:best], 1):
            out.append((item_id, rank, None if null else doc_id, -score))
    return sorted(out, key=str)


def found(docs, items, best, **options):
    return sorted(map(tuple, ranked_search.ranked_search(docs, items, best, **options).collect()), key=str)


ODD_DOCS = [
    (None, None), (9001, None), (9002, ""), (9003, "... --"), (9004, "The the THE"), (9004, "the end"), (None, "the end"), (9005, "the end"),
    (9006, "the end"), (9007, "naïve İstanbul é ñ 漢字"), (9008, "word " * 30_000 + "the rare"), (9009, "a_b a-b a.b 12ab"),
]
ODD_ITEMS = [
    (None, "the end"), (901, None), (902, ""), (903, "!?"), (904, "the the end"), (904, "rare word"), (905, "no such terms here"),
    (906, "NAÏVE naïve İstanbul"), (907, "the end"), (907, "the end"), (908, "A B 12AB a"),
]


@pytest.fixture
def odd(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").withColumnsRenamed({"lang": "score", "source": "item_id"})
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    docs = docs.unionByName(spark.createDataFrame(ODD_DOCS, "doc_id long, text string"), allowMissingColumns=True)
    return docs, items.unionByName(spark.createDataFrame(ODD_ITEMS, items.schema))


def test_search_against_all_pairs(spark, odd, monkeypatch):
    docs, items = odd
    rows, asked = ([tuple(r) for r in t.collect()] for t in (docs.select("doc_id", "text"), items.select("item_id", "text")))
    assert found(docs, items, 20) == brute(rows, asked, 20)
    # small heaps, few documents at once, items in many blocks
    monkeypatch.setattr(ranked_search, "CELLS", 64)
    monkeypatch.setattr(ranked_search, "MERGED", 2)
    assert found(docs.repartition(7), items, 3, item_bytes=2000) == brute(rows, asked, 3)


def test_empty_tables(odd):
    docs, items = odd
    assert found(docs, items.limit(0), 5) == found(docs.limit(0), items, 5) == []
    assert found(docs.filter("text IS NULL"), items, 5) == []


def test_query_against_sql(spark):
    folder = "/root/testdata/sf0.001"
    connection = duckdb.connect()
    for name in ("documents", "benchmark"):
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    expected = connection.sql(queries.ORACLE["op13_ranked_search"]).fetchall()
    assert sorted(map(tuple, queries.op13_ranked_search(spark, folder).collect())) == sorted(expected)


def test_terms():
    texts = ["It's A-1", None, "", "ÉÀ é_x", "z" * 70_000, "  "]
    coded, n = term_lists(pa.array(["skipped", *texts]).slice(1))
    assert n.tolist() == [len(terms(t)) for t in texts]
    assert coded.to_pylist() == [t for text in texts for t in terms(text)]


def test_heaps_keep_the_best_with_ties():
    rng = np.random.default_rng(3)
    scores, ids = rng.integers(0, 6, (500, 4)), rng.permutation(500)
    heaps, null = Heaps(4, 10), np.zeros(500, bool)
    for k in range(0, 500, 7):
        heaps.offer(scores[k : k + 7], null[k : k + 7], ids[k : k + 7])
        heaps._order()
    rows = heaps.rows(0).to_pylist()
    for item in range(4):
        best = sorted((-s, i) for s, i in zip(scores[:, item].tolist(), ids.tolist()) if s > 0)[:10]
        assert [(-r["score"], r["doc_id"]) for r in rows if r["item"] == item] == best
