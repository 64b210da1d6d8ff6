"""Secrets in texts: a trigram index narrows the texts, regular expressions decide."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from re import _constants as op
from re import _parser as parser

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.tables import text_slices, texts_of, written

#: A list of candidate documents up to this many rows is sent to every task, else it is joined by shuffle.
BROADCAST_ROWS = 1_000_000
MOST_STRINGS = 64
MASK = "[SECRET]"


@dataclass(frozen=True)
class Rule:
    """Matches of ``pattern`` whose ``group`` has ``least`` characters or more are spans of ``kind``."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0


#: The base rules, then public token formats.
BASE_RULES = (
    Rule(
        "assign",
        r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2,
        8,
    ),
    Rule("access", "AKIA[A-Z0-9]+", 0, 16),
    Rule("hex", "[0-9a-f]+", 0, 32),
)
MORE_RULES = (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("private_key", r"-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
)
RULES = BASE_RULES + MORE_RULES


# --- trigram queries --------------------------------------------------------------------
# A query is None (any text may match), a trigram, or ("and" | "or", (queries)).


def trigram_query(pattern: str) -> object:
    """What any match must contain, as a Boolean query over lower-case trigrams.

    Literal runs are followed through groups, alternatives, small character sets and optional parts;
    whatever else a pattern has ends a run and asks for nothing, so a query never excludes a match.
    """
    runs, query = _sequence(parser.parse(pattern), {""}, [])
    return _and([*query, _contains(runs)])


def _sequence(items, runs: set[str], query: list) -> tuple[set[str], list]:
    """``runs``: the strings the current run can be; ``query``: what earlier runs ask for."""
    for kind, value in items:
        if kind is op.LITERAL:
            options = {chr(value).lower()}
        elif kind is op.IN and all(k is op.LITERAL for k, _ in value) and len(value) <= 8:
            options = {chr(c).lower() for _, c in value}
        elif kind is op.SUBPATTERN:
            runs, query = _sequence(value[-1], runs, query)
            continue
        elif kind is op.BRANCH:
            parts = [_sequence(branch, {""}, []) for branch in value[1]]
            if any(asked for _, asked in parts):
                query = [*query, _contains(runs), _or([_and([*asked, _contains(r)]) for r, asked in parts])]
                runs = {""}
                continue
            options = set().union(*(r for r, _ in parts))
        elif kind is op.MAX_REPEAT and value[1] == 1 and value[0] == 0:
            inner, asked = _sequence(value[2], {""}, [])
            options = None if asked else {""} | inner
        elif kind in (op.AT, op.ASSERT, op.ASSERT_NOT):
            continue
        else:
            options = None
        joined = {a + b for a in runs for b in options} if options is not None else set()
        if not joined or len(joined) > MOST_STRINGS:
            query, runs = [*query, _contains(runs)], options if options and len(joined) > MOST_STRINGS else {""}
        else:
            runs = joined
    return runs, query


def _contains(runs: set[str]) -> object:
    return _or([_and([run[i : i + 3] for i in range(len(run) - 2)]) for run in sorted(runs)])


def _and(queries: Sequence) -> object:
    asked = tuple(dict.fromkeys(q for q in queries if q is not None))
    return None if not asked else asked[0] if len(asked) == 1 else ("and", asked)


def _or(queries: Sequence) -> object:
    if not queries or any(q is None for q in queries):
        return None
    options = tuple(dict.fromkeys(queries))
    return options[0] if len(options) == 1 else ("or", options)


def trigrams_of(query: object) -> set[str]:
    if query is None:
        return set()
    return {query} if isinstance(query, str) else set().union(*(trigrams_of(q) for q in query[1]))


def _holds(query: object, has: Callable[[str], Column]) -> Column:
    if isinstance(query, str):
        return has(query)
    parts = [_holds(q, has) for q in query[1]]
    total = parts[0]
    for part in parts[1:]:
        total = total & part if query[0] == "and" else total | part
    return total


# --- index and search -------------------------------------------------------------------


def trigram_postings(docs: DataFrame, trigrams: Sequence[str]) -> DataFrame:
    """The index: ``(trigram, doc_id)`` for each of ``trigrams`` that the lower-case text contains."""

    def postings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            texts = [text.lower() for text in texts_of(batch)]
            for trigram in trigrams:
                rows = [i for i, text in enumerate(texts) if trigram in text]
                if rows:
                    ids = batch.column("doc_id").cast(pa.int64()).take(pa.array(rows))
                    yield pa.record_batch([pa.array([trigram] * len(rows)), ids], ["trigram", "doc_id"])

    return docs.select("doc_id", "text").mapInArrow(postings, "trigram string, doc_id long")


def candidates(postings: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """``(doc_id, rules)``: positions of the rules whose query the postings of a document satisfy.

    Documents that satisfy none, and rules without a query, are not listed.
    """
    held = postings.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(F.collect_set("trigram").alias("held"))
    asked = [(k, query) for k, rule in enumerate(rules) if (query := trigram_query(rule.pattern)) is not None]
    chosen = [F.when(_holds(query, lambda t: F.array_contains("held", t)), F.lit(k)) for k, query in asked]
    hits = F.array_compact(F.array(*chosen)) if chosen else F.array().cast("array<int>")
    return held.select("doc_id", hits.alias("rules")).filter(F.size("rules") > 0)


def scan(docs: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """``(doc_id, spans, text)`` for every row: spans ``(kind, start, end)`` in code points, and the text masked.

    Each rule's matches are the leftmost ones that do not overlap, less those that are too short;
    spans are sorted by start, then by the order of ``rules``. A rule with a trigram query is only run
    on texts that satisfy it, the others on every text. Masking covers every span and leaves a null
    text null; a null or empty text has no spans. Rows without a ``doc_id`` are tried with all rules.
    """
    return _scanned(docs.select("doc_id", "text"), rules, _scan_rows(rules), SCANNED)


def mask_secrets(docs: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """``docs`` with secrets in ``text`` replaced and ``n_chars``, where there is one, counted again."""
    masked = _scanned(docs, rules, _mask_rows(rules, docs.columns), docs.schema)
    if "n_chars" not in docs.columns:
        return masked
    changed = F.col("text").contains(MASK)
    length = F.length("text").cast(docs.schema["n_chars"].dataType)
    return masked.withColumn("n_chars", F.when(changed, length).otherwise(F.col("n_chars")))


SCANNED = "doc_id long, spans array<struct<kind: string, start: long, end: long>>, text string"
TRIED = "__rules"


def _scanned(docs: DataFrame, rules: Sequence[Rule], rows, schema) -> DataFrame:
    vocabulary = sorted(set().union(*(trigrams_of(trigram_query(rule.pattern)) for rule in rules)))
    postings = trigram_postings(docs, vocabulary)
    found = written(candidates(postings, rules), "candidates").withColumnRenamed("rules", TRIED)
    if found.count() <= BROADCAST_ROWS:
        found = F.broadcast(found)
    return docs.join(found, "doc_id", "left").select(*docs.columns, TRIED).mapInArrow(rows, schema)


def _matchers(rules: Sequence[Rule]) -> list[tuple[Rule, re.Pattern, bool]]:
    return [(rule, re.compile(rule.pattern), trigram_query(rule.pattern) is None) for rule in rules]


def find_spans(text: str, matchers: list, tried: Sequence[int] | None) -> list[tuple[int, int, int]]:
    """``(start, rule, end)`` in order; ``tried``: the indexed rules to run, None for all."""
    spans = []
    for k, (rule, pattern, always) in enumerate(matchers):
        if always or tried is None or k in tried:
            for match in pattern.finditer(text):
                if len(match[rule.group]) >= rule.least:
                    spans.append((match.start(), k, match.end()))
    return sorted(spans)


def masked(text: str, spans: list[tuple[int, int, int]]) -> str:
    parts, done = [], 0
    for start, _, end in spans:
        if start >= done:
            parts += [text[done:start], MASK]
        done = max(done, end)
    return "".join([*parts, text[done:]])


def _found(batch: pa.RecordBatch, matchers: list) -> list[tuple[str, list]]:
    ids, tried = batch.column("doc_id").to_pylist(), batch.column(TRIED).to_pylist()
    return [
        (text, find_spans(text, matchers, None if doc_id is None else rules or ()))
        for text, doc_id, rules in zip(texts_of(batch), ids, tried)
    ]


def _masked_column(batch: pa.RecordBatch, found: list) -> pa.Array:
    null = batch.column("text").is_null().to_pylist()
    return pa.array([None if none else masked(*one) for none, one in zip(null, found)], pa.string())


def _scan_rows(rules: Sequence[Rule]):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matchers = _matchers(rules)
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        for batch in text_slices(batches):
            found = _found(batch, matchers)
            spans = [[{"kind": rules[k].kind, "start": s, "end": e} for s, k, e in one] for _, one in found]
            yield pa.record_batch(
                [batch.column("doc_id").cast(pa.int64()), pa.array(spans, kind), _masked_column(batch, found)],
                ["doc_id", "spans", "text"],
            )

    return rows


def _mask_rows(rules: Sequence[Rule], columns: list[str]):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matchers = _matchers(rules)
        for batch in text_slices(batches):
            text = _masked_column(batch, _found(batch, matchers))
            yield pa.record_batch([text if c == "text" else batch.column(c) for c in columns], columns)

    return rows


def span_text(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def sha256_of(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()
