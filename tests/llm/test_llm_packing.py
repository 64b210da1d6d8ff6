import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tickloom.llm import packing
from tickloom.llm.lengths import encoded_lengths, length_histogram, length_quantile, truncated_total, with_suffix_sums
from tickloom.llm.tokens import PieceEncoder

PATH = public_tokenizers.path("word_bpe_49k.json")
TOKENIZER = Tokenizer.from_file(PATH)
ENCODER = PieceEncoder(PATH)
ODD = ["", " ", "It's  THE\n\nend", "é é ﬁ x y", "<|endoftext|> a<|startoftext|>b", "漢字 仮名", "a\tb\x0b\x1cc \x85d", "ǅ İ ß", "12 345", "́ x ́"]


def whole(text):
    return TOKENIZER.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(max_size=60), min_size=1, max_size=4))
def test_pieces_give_the_ids_of_whole_texts(texts):
    ids, sizes = ENCODER.encode(pa.array(texts, pa.string()))
    cuts = np.cumsum(sizes)[:-1]
    assert [part.tolist() for part in np.split(ids, cuts)] == [whole(t) for t in texts]


def test_odd_texts_give_the_ids_of_whole_texts():
    ids, sizes = ENCODER.encode(pa.array([*ODD, None]))
    assert [p.tolist() for p in np.split(ids, np.cumsum(sizes)[:-1])] == [whole(t) for t in [*ODD, None]]


def test_marks_after_any_letter_give_the_ids_of_whole_texts():
    letters = [chr(c) for c in range(0x110000) if chr(c).isalpha() and not 0x3400 <= c < 0xD800 and c < 0x20000]
    texts = ["BELEDİYESİ, İ.", "क़. फ़ल फ़, फ़.", "\ufb2e, \ufb2e.", *(f"{x}, a{x}. {x}A," for x in letters)]
    ids, sizes = ENCODER.encode(pa.array(texts))
    assert [p.tolist() for p in np.split(ids, np.cumsum(sizes)[:-1])] == [whole(t) for t in texts]


def test_pieces_and_packing(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    extra = spark.createDataFrame([(9001, None), (9002, ""), (None, "the end"), (9003, "long " * 70_000), (0, "again")], "doc_id long, text string")
    docs = docs.select("doc_id", "text").unionByName(extra)
    packed = packing.pack(packing.token_pieces(docs, PATH)).toPandas()
    expected = []
    for doc_id, text in docs.collect():
        ids = np.array([*whole(text), 0], "<u4")
        for k, start in enumerate(range(0, len(ids), 2048)):
            part = ids[start : start + 2048]
            expected.append((-1 if doc_id is None else doc_id, k, start, len(part), zlib.crc32(part.tobytes())))
    got = packed.fillna({"doc_id": -1})[["doc_id", "piece", "start", "length", "ids_crc32"]]
    assert sorted(got.astype(int).itertuples(index=False, name=None)) == sorted(expected)
    check_layout(packed)
    used, bound = packed.sequence_id.nunique(), packing.lower_bound(packed.length.to_numpy(), 2048)
    assert bound <= used <= bound + 1


def check_layout(packed):
    for _, rows in packed.sort_values("offset").groupby("sequence_id"):
        assert rows.offset.iloc[0] == 0
        assert (rows.offset.iloc[1:].to_numpy() == (rows.offset + rows.length).iloc[:-1].to_numpy()).all()
        assert rows.length.sum() <= 2048


def test_partitions_with_gaps_exchange_pieces(spark):
    sizes = np.random.default_rng(5).integers(500, 1400, 3000).tolist()
    rows = spark.createDataFrame([(s, "x") for s in sizes], "length long, offset_note string")
    packed = packing.pack(rows, part_pieces=200).toPandas()
    assert sorted(packed.length) == sorted(sizes)
    check_layout(packed)
    together = packing.best_fit_decreasing(np.array(sizes), 2048)[2]
    assert packed.sequence_id.nunique() <= 1.03 * len(together)


def test_empty_table(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert packing.pack(packing.token_pieces(none, PATH)).count() == 0
    assert with_suffix_sums(length_histogram(none, PATH)).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 12), min_size=1, max_size=7))
def test_bounds_and_best_fit_against_the_optimum(sizes):
    def fits(rest, bins):
        if not rest:
            return True
        tried = set()
        for k, room in enumerate(bins):
            if room >= rest[0] and room not in tried:
                tried.add(room)
                if fits(rest[1:], [*bins[:k], room - rest[0], *bins[k + 1 :]]):
                    return True
        return False

    ordered = sorted(sizes, reverse=True)
    least = next(n for n in range(1, len(sizes) + 1) if fits(ordered, [12] * n))
    bins, offsets, fill = packing.best_fit_decreasing(np.array(sizes), 12)
    assert packing.lower_bound(np.array(sizes), 12) <= least <= len(fill)
    for b in range(len(fill)):
        own = np.array(sizes)[bins == b][np.argsort(offsets[bins == b])]
        assert own.sum() == fill[b] <= 12 and sorted(offsets[bins == b]) == [0, *np.cumsum(own)[:-1]]


def test_lengths(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    docs = docs.unionByName(spark.createDataFrame([(None, None), (5, ""), (5, "")], docs.schema))
    sizes = np.array([len(whole(t)) for _, t in docs.collect()])
    assert sorted(r.n_tokens for r in encoded_lengths(docs, PATH).collect()) == sorted(sizes)
    sums = with_suffix_sums(length_histogram(docs, PATH))
    for r in sums.collect():
        n = r.n_tokens
        assert (r.n_docs, r.docs_at_least, r.tokens_at_least) == ((sizes == n).sum(), (sizes >= n).sum(), sizes[sizes >= n].sum())
        assert (r.docs_below, r.truncated_tokens) == ((sizes < n).sum(), np.minimum(sizes, n).sum())
    for limit in (0, 1, 100, 2048, 10**6):
        assert truncated_total(sums, limit) == np.minimum(sizes, limit).sum()
    assert length_quantile(sums, 0.5) == np.sort(sizes)[int(np.ceil(0.5 * len(sizes))) - 1]
