import re

from tickloom.llm import secret_scan
from tickloom.llm.secret_scan import RULES, Rule, trigram_query

DOCS = "doc_id long, text string, n_chars long, rules string"
TEXTS = [
    (1, None), (2, ""), (3, "password: token: abcdefghij"), (4, "API_KEY = 'abc.def/ghi' AKIA" + "A1" * 6), (5, "AKIAABC"),
    (6, "0" * 31 + " " + "f" * 32 + "é" + "a0" * 20), (7, "x" * 150_000 + " secret=12345678 " + "y" * 50_000),
    (None, "Token:longenough1 ghp_" + "a" * 36), (8, "passwd\n=abcdefgh"), (9, "toKen \x20 =\x20\"12345678\" paſſword=12345678"),
    (10, "-----BEGIN RSA PRIVATE KEY----- xoxb-1234567890ab eyJabcdefgh.eyJabcdefgh.abcdefgh"), (10, "secret:abcdefgh"),
]


def brute(text):
    """All spans by plain loops over the rules, without an index."""
    spans = []
    for k, rule in enumerate(RULES):
        for m in re.finditer(rule.pattern, text or ""):
            if len(m.group(rule.group)) >= rule.least:
                spans.append((m.start(), k, m.end()))
    return [(RULES[k].kind, s, e) for s, k, e in sorted(spans)]


def test_scan_equals_plain_scan(spark):
    docs = spark.createDataFrame([(i, t, 1, "clash") for i, t in TEXTS], DOCS)
    got = [(r.doc_id or 0, [(s.kind, s.start, s.end) for s in r.spans]) for r in secret_scan.scan(docs).collect()]
    assert sorted(got) == sorted((i or 0, brute(t)) for i, t in TEXTS)


def test_documents_equal_plain_scan(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = {r.doc_id: [(s.kind, s.start, s.end) for s in r.spans] for r in secret_scan.scan(docs).collect()}
    assert got == {r.doc_id: brute(r.text) for r in docs.select("doc_id", "text").collect()}
    assert sum(map(len, got.values())) > 10


def test_mask(spark):
    docs = spark.createDataFrame([(i, t, 1, "clash") for i, t in TEXTS], DOCS)
    masked = secret_scan.mask_secrets(docs)
    assert masked.columns == docs.columns and masked.count() == len(TEXTS)
    for row in masked.collect():
        assert brute(row.text) == [] or row.text is None
        assert row.n_chars == (len(row.text) if row.text and "[SECRET]" in row.text else 1)


def test_empty(spark):
    none = spark.createDataFrame([], DOCS)
    assert secret_scan.scan(none).count() == 0 and secret_scan.mask_secrets(none).count() == 0


def test_queries_of_patterns():
    assert trigram_query("[0-9a-f]+") is None
    assert trigram_query("AKIA[A-Z0-9]+") == ("and", ("aki", "kia"))
    assert trigram_query("ab|cde") is None
    assert trigram_query("abcd?e") == ("or", (("and", ("abc", "bcd", "cde")), ("and", ("abc", "bce"))))
    base = trigram_query(RULES[0].pattern)
    assert base[0] == "or" and ("and", ("api", "pik", "ike", "key")) in base[1] and ("and", ("tok", "oke", "ken")) in base[1]


def test_no_query_excludes_a_match():
    def holds(query, text):
        if query is None or isinstance(query, str):
            return query is None or query in text.lower()
        return (all if query[0] == "and" else any)(holds(q, text) for q in query[1])

    samples = [t for _, t in TEXTS if t]
    for rule in [*RULES, Rule("x", "(foo|ba[rz]){2}qux"), Rule("y", r"tok(?:en)?s?-\d+")]:
        for text in [*samples, "foobarqux bazbazqux", "tok-1 tokens-22 toks-3"]:
            if re.search(rule.pattern, text):
                assert holds(trigram_query(rule.pattern), text)
