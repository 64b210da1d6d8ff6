import hashlib
import itertools
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from tickloom.llm import alignment, byte_tokens, queries, slack_packing
from tickloom.llm.alignment import align_tokens, coalesced, with_link_counts
from tickloom.llm.slack_packing import SlackPacker, least_slack, pack_tokens

PATH = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
MARKED, PLAIN = Tokenizer.from_file(PATH), Tokenizer.from_file(PATH)
PLAIN.encode_special_tokens = True
MODEL = SentencePieceProcessor(model_file=PIECES)
ODD = [
    "", " ", "  ", "a  b", "a \n b", "a\n\n  b ", " a", "a b  ", "It's <|endoftext|> x<|endoftext|>y", "é ñ 漢字 仮名",
    "x \x1c y", "tab\t tab", "don't we'll I'm 'tis ' s", "12 345 a1b2", "ＡＢ 𝔘𝔫 ⅷ Ⅷ ²", "a  b  c", "zero​ ​width",
    "a visible ▁ mark", "<s> </s> <0x41> <unk>", "x" * 3000, "ab " * 500, "🙂🙂 🙃", "﻿mark ﻿", None,
]


def split_ids(found):
    ids, sizes = found
    return [part.tolist() for part in np.split(ids, np.cumsum(sizes)[:-1])]


def test_byte_ids_of_odd_texts():
    for plain, whole in ((False, MARKED), (True, PLAIN)):
        encoder = byte_tokens.ByteEncoder(PATH, plain)
        assert encoder.ranked is not None
        got = split_ids(encoder.encode(pa.array(ODD, pa.string())))
        assert got == [whole.encode(t or "", add_special_tokens=False).ids for t in ODD]
        encoder.ranked = None  # the library alone
        assert split_ids(encoder.encode(pa.array(ODD, pa.string()))) == got


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.sampled_from("ab'sé 1  \n\t 漢.") | st.characters(codec="utf-8"), max_size=40), min_size=1, max_size=4))
def test_byte_ids_of_any_texts(texts):
    got = split_ids(byte_tokens.byte_encoder(PATH).encode(pa.array(texts, pa.string())))
    assert got == [MARKED.encode(t, add_special_tokens=False).ids for t in texts]


# --- packing ----------------------------------------------------------------------------


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(1, 20), max_size=8), st.integers(1, 26))
def test_least_slack_against_all_subsets(sizes, size):
    chosen, counts = least_slack(Counter(sizes), size), Counter(sizes)
    fitting = sorted(x for x in sizes if x <= size)
    if not fitting:
        assert chosen == {}
        return
    assert all(n <= counts[length] for length, n in chosen.items()) and fitting[-1] in chosen
    rest = fitting[:-1]
    sums = (fitting[-1] + sum(some) for k in range(len(rest) + 1) for some in itertools.combinations(rest, k))
    assert sum(length * n for length, n in chosen.items()) == max(s for s in sums if s <= size)


def check_packed(rows, expected, capacity):
    """Every id of every document in one piece, sequences without gaps, padding or excess."""
    documents, sequences = {}, {}
    for r in rows:
        ids = np.frombuffer(bytes(r["ids"]), "<u4")
        assert len(ids) == r["length"] > 0
        documents.setdefault((r["doc_id"], r["doc_tokens"]), []).append((r["start"], ids.tolist()))
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    got = Counter()
    for (doc_id, tokens), pieces in documents.items():
        joined = [i for _, ids in sorted(pieces) for i in ids]
        times = len(joined) // tokens  # rows with the same id and length
        if times == 1:
            assert [start for start, _ in sorted(pieces)] == np.cumsum([0, *(len(i) for _, i in sorted(pieces))])[:-1].tolist()
            got[doc_id, tuple(joined)] += 1
        else:
            got[doc_id, tokens] += times
    want = Counter()
    for doc_id, ids in expected:
        alone = sum(1 for d, other in expected if d == doc_id and len(other) == len(ids)) == 1
        want[(doc_id, tuple(ids)) if alone else (doc_id, len(ids))] += 1
    assert got == want
    for pieces in sequences.values():
        ends = np.cumsum([length for _, length in sorted(pieces)])
        assert [offset for offset, _ in sorted(pieces)] == [0, *ends[:-1]]
        assert ends[-1] == capacity or ends[-1] < capacity and ends[-1].bit_count() == 1


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 90), max_size=40), st.sampled_from([16, 20, 32]), st.sampled_from([0, 100, 10_000]))
def test_any_lengths_are_packed_without_padding(lengths, capacity, pool):
    packer, rows, names = SlackPacker(capacity, pool), [], ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
    expected = [(k, list(range(k, k + n))) for k, n in enumerate(lengths)]
    for k, ids in expected:
        packer.add(k, np.array(ids, "<u4"))
        packer.fill_sequences()
        assert packer.total <= max(pool, 2 * capacity) + capacity
    packer.finish()
    rows = packer.taken(7 << 33).to_pylist()
    assert all(r["sequence_id"] >> 33 == 7 for r in rows)
    check_packed(rows, expected, capacity)
    assert [] == packer.taken(0).to_pylist() and names == list(rows[0]) if rows else True


def test_documents_are_cut_only_at_the_end_of_a_partition():
    random.seed(4)
    packer = SlackPacker(2048, 1 << 17)
    for k in range(4000):
        packer.add(k, np.zeros(1 + int(random.lognormvariate(5.5, 1)), "<u4"))
        packer.fill_sequences()
    packer.finish()
    pieces = Counter(r["doc_id"] for r in packer.taken(0).to_pylist() if r["doc_tokens"] <= 2048)
    assert sum(n > 1 for n in pieces.values()) < 20


def test_packing_of_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").withColumnsRenamed({"lang": "ids", "source": "offset"})
    extra = [(9001, None), (9002, ""), (None, "the end"), (9003, "long " * 70_000), (9004, "again"), (9004, "again"), (9004, "<|endoftext|>")]
    more = spark.createDataFrame(extra, "doc_id long, text string")
    docs = docs.unionByName(more, allowMissingColumns=True)
    packed = pack_tokens(docs, PATH)
    assert packed.columns == ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
    expected = [(r.doc_id, [*MARKED.encode(r.text or "", add_special_tokens=False).ids, 1]) for r in docs.collect()]
    check_packed([r.asDict() for r in packed.collect()], expected, 2048)
    assert pack_tokens(docs.limit(0), PATH).count() == 0


def test_packing_query_digests_the_ids(spark):
    folder = "/root/testdata/sf0.001"
    rows = queries.op11_slack_packing(spark, folder).collect()
    ids = {
        r.doc_id: np.array([*MARKED.encode(r.text or "", add_special_tokens=False).ids, 1], "<u4")
        for r in spark.read.parquet(f"{folder}/documents.parquet").collect()
    }
    assert sum(r.length for r in rows) == sum(map(len, ids.values()))
    for r in rows:
        part = ids[r.doc_id][r.start : r.start + r.length]
        assert (r.ids_crc32, r.doc_tokens) == (zlib.crc32(part.tobytes()), len(ids[r.doc_id]))


# --- alignment --------------------------------------------------------------------------


def plain_alignment(text):
    """Groups and links token by token; None where a text has none."""
    if not text:
        return None
    sides = []
    for ids, bytes_of in (
        (PLAIN.encode(" " + text, add_special_tokens=False).ids, byte_tokens.byte_encoder(PATH, True).bytes_of),
        (MODEL.encode(text), alignment.piece_encoder(PIECES).bytes_of.to_pylist()),
    ):
        if b"".join(bytes_of[i] for i in ids) != (" " + text).encode():
            return None
        sides.append(list(zip(ids, np.cumsum([len(bytes_of[i]) for i in ids]).tolist())))
    (a, b), groups, start = sides, [], 0
    for end in sorted({e for _, e in a} & {e for _, e in b}):
        groups.append([[i for i, e in side if start < e <= end] for side in sides])
        start = end
    return len(a), len(b), groups, [(i, j) for i, e in a for j, f in b if e == f]


def expected_alignment(rows):
    found = [(doc_id, plain_alignment(text)) for doc_id, text in rows]
    count = Counter(pair for _, one in found if one for pair in one[3])
    most = Counter()
    for (_, j), n in count.items():
        most[j] = max(most[j], n)
    out = []
    for doc_id, one in found:
        if one is None:
            out.append((doc_id, 0, 0, 0, 0, 0, 0, ""))
            continue
        n_a, n_b, groups, links = one
        text = ";".join("|".join(",".join(map(str, side)) for side in group) for group in groups)
        n_best = sum(count[pair] == most[pair[1]] for pair in links)
        out.append((doc_id, n_a, n_b, len(groups), len(links), n_best, sum(count[p] for p in links), text))
    return sorted(out, key=str)


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]


def test_alignment_against_token_by_token(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").filter("length(text) < 3000")
    docs = docs.withColumnsRenamed({"lang": "links", "source": "count"})
    odd = [(9000 + k if k else None, text) for k, text in enumerate([*ODD, "again and again", "again and again"])]
    odd.append((9001, "another text of the same number"))
    docs = docs.unionByName(spark.createDataFrame(odd, "doc_id long, text string"), allowMissingColumns=True)
    got = with_link_counts(align_tokens(docs, PATH, PIECES)).select(*COLUMNS, "groups")
    want = expected_alignment([(r.doc_id, r.text) for r in docs.collect()])
    assert sorted(map(tuple, got.collect()), key=str) == want
    assert with_link_counts(align_tokens(docs.limit(0), PATH, PIECES)).count() == 0


def test_alignment_query_digests_the_groups(spark):
    folder = "/root/testdata/sf0.001"
    rows = queries.op12_alignment(spark, folder).select(*COLUMNS, "groups_sha256").collect()
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").filter("length(text) < 800").collect()]
    assert len(rows) == 200 and len(docs) > 10
    by_id = {r.doc_id: r for r in rows}
    for doc_id, text in docs:
        n_a, n_b, groups, links = plain_alignment(text)
        written_out = ";".join("|".join(",".join(map(str, side)) for side in group) for group in groups)
        r = by_id[doc_id]
        assert (r.n_a, r.n_b, r.n_groups, r.n_links) == (n_a, n_b, len(groups), len(links))
        assert r.groups_sha256 == hashlib.sha256(written_out.encode()).hexdigest()


def test_large_pair_tables_are_joined_by_shuffles(spark, monkeypatch):
    rows = [(k, text) for k, text in enumerate(["one two three", "two three", "tokenization tokens", None, "three"])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(
        alignment, "lookup_join", lambda facts, pairs, on, join=alignment.lookup_join: join(facts, pairs, on, broadcast_bytes=0)
    )
    got = with_link_counts(align_tokens(docs, PATH, PIECES)).select(*COLUMNS, "groups")
    assert sorted(map(tuple, got.collect()), key=str) == expected_alignment(rows)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 30), st.integers(1, 6)), max_size=12))
def test_coalesced_ranges_against_all_pairs(ranges):
    start = np.array([a for a, _ in ranges], np.int64)
    end = start + np.array([n for _, n in ranges], np.int64)
    group = coalesced(start, end)
    same = start[:, None] < end[None, :]
    reach = (same & same.T) if len(ranges) else np.zeros((0, 0), bool)
    for _ in ranges:
        reach = reach | (reach.astype(int) @ reach.astype(int) > 0)
    assert (reach == (group[:, None] == group[None, :])).all()
