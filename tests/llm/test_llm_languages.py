import numpy as np
import pytest
from pyspark.sql import functions as F

from tickloom.llm import languages

FOLDER = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, score string, n long"


def brute_labels(scores, allowed, switch=languages.SWITCH):
    """The best labels of one text by trying every step in plain Python."""
    best, back = list(scores[0]), []
    for row in scores[1:]:
        jump = max(best) - switch
        came = [k if best[k] >= jump else int(np.argmax(best)) for k in range(len(row))]
        best = [max(best[k], jump) + row[k] for k in range(len(row))]
        back.append(came)
    at = int(np.argmax(best))
    path = [at]
    for came in reversed(back):
        at = came[at]
        path.append(at)
    return path[::-1]


@pytest.fixture(scope="module")
def model(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    return languages.fit_languages(docs.filter("crc32(cast(doc_id as string)) % 4 <> 2"))


def test_held_out_accuracy(spark, model):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").filter("crc32(cast(doc_id as string)) % 4 = 2")
    found = languages.predict_languages(docs, model).join(docs.select("doc_id", "lang"), "doc_id")
    right, n = found.agg(F.sum((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert right >= 0.97 * n > 0


def test_odd_rows(spark, model):
    rows = [(1, None), (2, ""), (3, "1234 $$ --"), (None, "the and of"), (5, "привет мир"), (6, "the " * 40_000), (6, "the " * 40_000), (7, "x" * 200_000), (8, "\u0301\u0302 \u0e31"), (9, "e\u0301t\u0302 the of")]
    docs = spark.createDataFrame([(i, t, None, "clash", 1) for i, t in rows], DOCS)
    found = {(r.doc_id, r.lang_pred, round(r.score, 3)) for r in languages.predict_languages(docs, model).collect()}
    assert {(1, "und", 0.0), (2, "und", 0.0), (3, "und", 0.0), (None, "en", 1.0), (6, "en", 1.0), (8, "und", 0.0)} <= found  # marks alone are no letters
    assert [f[1] for f in found if f[0] == 9] != ["und"]
    assert [f for f in found if f[0] == 5][0][2] == 0.0
    assert languages.predict_languages(docs, model).count() == len(rows)
    kept = languages.keep_languages(docs, model, 0.3)
    assert kept.columns == docs.columns and sorted(r.doc_id or 0 for r in kept.collect()) == [0, 6, 6, 7, 9]


def test_empty_tables(spark, model):
    none = spark.createDataFrame([], DOCS)
    assert languages.fit_languages(none) is None
    assert languages.predict_languages(none, model).count() == 0
    some = spark.createDataFrame([(1, "words", None, None, None)], DOCS)
    assert languages.predict_languages(some, None).first()["lang_pred"] == "und"


def test_spans_of_mixed_text(spark, model):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    parts = [docs.filter(F.col("lang") == lang).first()["text"][:600] for lang in ("en", "es")]
    text = parts[0] + " " + parts[1]
    mixed = spark.createDataFrame([(1, text)], "doc_id long, text string")
    spans = languages.language_spans(mixed, model).orderBy("start").collect()
    assert [s.lang for s in spans] == ["en", "es"]
    assert abs(spans[1].start - len(parts[0])) < 30 and spans[-1].end <= len(text)


def test_viterbi_equals_plain_version(model):
    texts = ["the and of das und der", "", "einer tion que los the", "a", "le la les und the of que del"]
    words = languages._Words(texts)
    grams, first = words.trigrams(model.letters)
    scores = np.add.reduceat(model.scores[grams], first, axis=0).astype(float)
    got = languages.label_words(words, model, len(texts))
    for k in range(len(texts)):
        own = words.text == k
        if own.any():
            assert got[own].tolist() == brute_labels(scores[own].tolist(), None)
