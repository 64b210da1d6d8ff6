import numpy as np
import public_tokenizers
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from sentencepiece import SentencePieceProcessor

from tickloom.llm import pieces

PATH = public_tokenizers.path("piece_bpe_32k.model")
MODEL = SentencePieceProcessor(model_file=PATH)
ENGINE = pieces.PieceTransducer(PATH)
ODD = ["", " ", "  two  spaces ", "a\tb\nc", "漢字かな\u0007ﬁ", "internationalization of tokenization", "▁ mark", "</s> <s>", "x" * 3000, "é" * 50, "1234567890 " * 20, "a" + " " * 40 + "b"]


def test_odd_texts():
    for text in ODD:
        ids = ENGINE.encode(text)
        assert ids == MODEL.encode(text), text
        assert ENGINE.decode(ids) == text.replace("▁", " ")


def test_units_are_forgotten_by_generations(monkeypatch):
    monkeypatch.setattr(pieces, "MOST_UNITS", 3)
    engine = pieces.PieceTransducer(PATH)
    text = "one two, three. four five, six one two seven eight one nine. ten one"
    for _ in range(2):
        assert engine.encode(text) == MODEL.encode(text)
    assert len(engine.known) <= 3 and len(engine.older) <= 3 and "▁one" in {**engine.known, **engine.older}


def test_units_are_composed_together(monkeypatch):
    engine = pieces.PieceTransducer(PATH)
    by_itself = []
    monkeypatch.setattr(engine, "shortest_path", lambda unit, path=engine.shortest_path: by_itself.append(unit) or path(unit))
    monkeypatch.setattr(pieces, "TOGETHER", 3)
    texts = [*ODD, "one two, three. four \u0007\u0e01x, b.,", "né\U0001f600 a,", "two, 漢, three"]
    for _ in range(2):
        ids, sizes, _, _ = engine.encode_all(pa.array(texts))
        assert [part.tolist() for part in np.split(ids, np.cumsum(sizes)[:-1])] == [MODEL.encode(text) for text in texts]
    assert by_itself and all(len(unit) > pieces.LONGEST_TOGETHER for unit in by_itself)


def test_stems_met_again_are_remembered(monkeypatch):
    monkeypatch.setattr(pieces, "MOST_UNITS", 8)
    engine = pieces.PieceTransducer(PATH)
    for number in range(20):
        text = f"often, seen and x{number} y{number} z{number}."
        assert engine.encode_all(pa.array([text]))[0].tolist() == MODEL.encode(text)
        assert len(engine.stems) <= 8 and (number < 2 or "often" in engine.stems.to_pylist())


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.sampled_from("ab.,É  \n\t漢▁") | st.characters(codec="utf-8"), max_size=40), max_size=5))
def test_many_texts_at_once(texts):
    ids, sizes, n_bytes, same = ENGINE.encode_all(pa.array([*texts, None], pa.string()))
    parts = [part.tolist() for part in np.split(ids, np.cumsum(sizes)[:-1])]
    assert parts == [MODEL.encode(text) for text in [*texts, ""]]
    assert n_bytes.tolist() == [sum(MODEL.is_byte(i) for i in part) for part in parts]
    assert same.all()


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=80))
def test_any_text(text):
    ids = ENGINE.encode(text)
    assert ids == MODEL.encode(text)
    assert ENGINE.decode(ids) == text.replace("▁", " ")


def test_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    extra = [(None, "x y"), (9001, None), (9002, ""), (9003, "again"), (9003, "again")]
    docs = docs.unionByName(spark.createDataFrame(extra, docs.schema))
    encoded = pieces.encode_pieces(docs, PATH)
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    assert {r.doc_id: r.ids for r in encoded.collect()} == {i: MODEL.encode(t) for i, t in texts.items()}
    assert {r.doc_id: r.text for r in pieces.decode_pieces(encoded, PATH).collect()} == texts
    digest = pieces.piece_digest(docs, PATH).collect()
    assert len(digest) == docs.count() and all(r.round_trip for r in digest)
    assert pieces.piece_digest(docs.limit(0), PATH).count() == 0
