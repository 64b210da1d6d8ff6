import numpy as np
import pytest

from tickloom.llm import toxicity

FOLDER = "/root/testdata/sf0.01"
DOCS = "doc_id long, text string, toxic string, severity string"


@pytest.fixture(scope="module")
def fitted(spark):
    docs, labels = (spark.read.parquet(f"{FOLDER}/{name}.parquet") for name in ("documents", "labels"))
    fold = "crc32(cast(doc_id as string)) % 4 <> 2"
    return toxicity.fit_toxicity(docs, labels.filter(fold)), docs, labels


def test_held_out(spark, fitted):
    model, docs, labels = fitted
    held = labels.filter("crc32(cast(doc_id as string)) % 4 = 2").select("doc_id", "toxic")
    rows = toxicity.predict_toxicity(docs, model).withColumnRenamed("toxic", "found").join(held, "doc_id").toPandas()
    assert (rows.found == (rows.toxic == 1)).mean() > 0.93
    assert rows.severity[rows.toxic == 1].mean() > 4 * rows.severity[rows.toxic == 0].mean()


def test_ordinal_fit_orders_grades():
    rng = np.random.default_rng(0)
    present = [np.flatnonzero(rng.random(6) < 0.4).astype(np.int32) for _ in range(3000)]
    true = np.array([3.0, 2.0, 1.0, 0.0, 0.0, -1.0])
    score = np.array([true[p].sum() for p in present]) + rng.logistic(size=3000)
    grades = np.digitize(score, [1.0, 3.0, 5.0])
    model = toxicity._fit(np.arange(6), present, grades)
    assert (np.diff(model.thresholds) > 0).all()
    assert np.allclose(model.weights, true, atol=0.4) and np.allclose(model.thresholds, [1, 3, 5], atol=0.4)


def test_odd_rows(spark, fitted):
    model = fitted[0]
    rows = [(1, None), (2, ""), (None, "moron idiot loser scum"), (4, "the " * 50_000), (4, "the " * 50_000), (5, "x" * 200_000)]
    docs = spark.createDataFrame([(*row, "clash", "clash") for row in rows], DOCS)
    got = [(r.doc_id, r.toxic) for r in toxicity.predict_toxicity(docs, model).collect()]
    assert sorted(got, key=str) == sorted([(1, False), (2, False), (None, True), (4, False), (4, False), (5, False)], key=str)
    kept = toxicity.drop_toxic(docs, model)
    assert kept.columns == docs.columns and kept.count() == 5


def test_without_labels(spark, fitted):
    _, docs, labels = fitted
    assert toxicity.fit_toxicity(docs, labels.limit(0)) is None
    assert toxicity.fit_toxicity(docs, labels.filter("toxic = 1")) is None
    assert toxicity.predict_toxicity(docs, None).filter("severity > 0").count() == 0
    assert toxicity.predict_toxicity(docs.limit(0), None).count() == 0


def plain_severity(text, model, hashes):
    """A document by itself, word by word; ``hashes`` gives the features of a word."""
    words = {"".join(c for c in piece if c.isalnum()) for piece in (text or "").lower().split()}
    present = {h for word in words if word for h in hashes(word)}
    weight = dict(zip(model.features.tolist(), model.weights.tolist()))
    score = sum(weight[h] for h in present if h in weight)
    at_most = [1 / (1 + np.exp(score - t)) for t in model.thresholds]
    chances = np.diff([0.0, *at_most, 1.0])
    return sum(1 - p for p in at_most), 1 - at_most[0], int(chances.argmax())


def test_predictions_equal_those_of_each_document_alone(spark, fitted):
    model, docs, _ = fitted
    known = {}

    def hashes(word):
        if word not in known:
            known[word] = toxicity._word_features([word])[0].tolist()
        return known[word]

    some = docs.filter("doc_id % 4 = 0 AND length(text) < 8000")
    got = {r.doc_id: (r.severity, r.p_toxic, r.grade) for r in toxicity.predict_toxicity(some, model).collect()}
    rows = some.select("doc_id", "text").collect()
    assert len(got) == len(rows) > 150
    for doc_id, text in rows:
        severity, p_toxic, grade = plain_severity(text, model, hashes)
        assert np.isclose(got[doc_id][0], severity) and np.isclose(got[doc_id][1], p_toxic) and got[doc_id][2] == grade
