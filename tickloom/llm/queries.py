"""The registered queries of the ten operators, with SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm import (
    alignment,
    languages,
    lengths,
    minhash,
    near_vectors,
    neighbours,
    packing,
    pieces,
    ranked_search,
    secret_scan,
    slack_packing,
    toxicity,
    warc,
)
from tickloom.llm.tables import read

Query = Callable[[SparkSession, str], DataFrame]
HELD_OUT, FOLDS = 2, 4
BPE, SENTENCEPIECE, BYTE_BPE = "word_bpe_49k.json", "piece_bpe_32k.model", "byte_bpe_50k.json"


def _held_out():
    return F.crc32(F.col("doc_id").cast("string")) % FOLDS == HELD_OUT


def op1_language_id(spark: SparkSession, folder: str) -> DataFrame:
    """The language of every text, learned from the labelled three quarters of the documents."""
    docs = read(spark, folder, "documents").select("doc_id", "text", "lang")
    model = languages.fit_languages(docs.filter(F.coalesce(~_held_out(), F.lit(True))))
    found = languages.predict_languages(docs, model)
    return found.select("doc_id", F.coalesce(_held_out(), F.lit(False)).alias("held_out"), "lang_pred", "score")


def op2_packing(spark: SparkSession, folder: str) -> DataFrame:
    """Every piece of every document, with its sequence and place."""
    docs = read(spark, folder, "documents")
    cut = packing.token_pieces(docs, public_tokenizers.path(BPE))
    return packing.pack(cut)


def op3_near_vectors(spark: SparkSession, folder: str) -> DataFrame:
    return near_vectors.near_vectors(read(spark, folder, "embeddings"))


def op4_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Counts and digests of the spans of every text."""
    found = secret_scan.scan(read(spark, folder, "documents"))
    return found.select("doc_id", "spans").mapInArrow(
        _span_digest, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"
    )


def _span_digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    base = [rule.kind for rule in secret_scan.BASE_RULES]
    for batch in batches:
        counts, digests, texts = [[] for _ in base], [], []
        for spans in batch.column("spans").to_pylist():
            rows = [(s["kind"], s["start"], s["end"]) for s in spans]
            own = [row for row in rows if row[0] in base]
            for kind, column in zip(base, counts):
                column.append(sum(row[0] == kind for row in own))
            digests.append(secret_scan.sha256_of(secret_scan.span_text(own)))
            texts.append(secret_scan.span_text(rows))
        columns = [*(pa.array(c, pa.int64()) for c in counts), pa.array(digests, pa.string()), pa.array(texts, pa.string())]
        names = ["doc_id", *(f"n_{kind}" for kind in base), "base_sha256", "spans"]
        yield pa.record_batch([batch.column("doc_id"), *columns], names)


def op5_warc(spark: SparkSession, folder: str) -> DataFrame:
    return warc.through_archives(read(spark, folder, "pages"))


def op6_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return minhash.near_duplicates(read(spark, folder, "documents"))


def op7_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    histogram = lengths.length_histogram(read(spark, folder, "documents"), public_tokenizers.path(BPE))
    return lengths.with_suffix_sums(histogram)


def op8_pieces(spark: SparkSession, folder: str) -> DataFrame:
    return pieces.piece_digest(read(spark, folder, "documents"), public_tokenizers.path(SENTENCEPIECE))


def op9_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents")
    model = toxicity.fit_toxicity(docs, read(spark, folder, "labels"))
    return toxicity.predict_toxicity(docs, model)


def op10_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    vectors = read(spark, folder, "embeddings")
    return neighbours.nearest(vectors, vectors.filter("vec_id % 20 = 0"), 20)


def op11_slack_packing(spark: SparkSession, folder: str) -> DataFrame:
    """Every piece of every document, with its sequence and place."""
    packed = slack_packing.pack_tokens(read(spark, folder, "documents"), public_tokenizers.path(BYTE_BPE))
    digest = F.crc32("ids").alias("ids_crc32")
    return packed.select("doc_id", "start", "length", digest, "doc_tokens", "sequence_id", "offset")


def op12_alignment(spark: SparkSession, folder: str) -> DataFrame:
    """Counts and a digest of the groups of every text, and how common its links are."""
    tokenizers = public_tokenizers.path(BYTE_BPE), public_tokenizers.path(SENTENCEPIECE)
    aligned = alignment.align_tokens(read(spark, folder, "documents"), *tokenizers)
    digest = F.when(F.col("n_groups") > 0, F.sha2("groups", 256)).otherwise("")
    return alignment.with_link_counts(aligned.withColumn("groups_sha256", digest).drop("groups"))


def op13_ranked_search(spark: SparkSession, folder: str) -> DataFrame:
    return ranked_search.ranked_search(read(spark, folder, "documents"), read(spark, folder, "benchmark"))


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        op1_language_id,
        op2_packing,
        op3_near_vectors,
        op4_secret_scan,
        op5_warc,
        op6_near_duplicates,
        op7_token_counts,
        op8_pieces,
        op9_toxicity,
        op10_neighbours,
        op11_slack_packing,
        op12_alignment,
        op13_ranked_search,
    )
}

# --- SQL --------------------------------------------------------------------------------

_BASE32 = " || ".join(
    f"lpad(to_base(CAST('0x' || substr(h, {i}, 5) AS BIGINT), 32), 4, '0')" for i in range(1, 41, 5)
)

ORACLE: dict[str, str] = {
    "op3_near_vectors": """
WITH RECURSIVE parts AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v,
    label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
      AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0
      AND len([x for x in embedding if x <> 0]) > 0 AS ok
  FROM embeddings),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM parts a JOIN parts b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE a.ok AND b.ok
    AND list_inner_product(a.v, b.v) / (sqrt(list_inner_product(a.v, a.v)) * sqrt(list_inner_product(b.v, b.v))) >= 0.98),
reach(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
least AS (SELECT a, min(b) AS m FROM reach GROUP BY a),
counts AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT p.vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, least(p.vec_id, coalesce(m, p.vec_id)) AS component_id,
  p.vec_id = least(p.vec_id, coalesce(m, p.vec_id)) AS kept
FROM parts p LEFT JOIN least ON least.a = p.vec_id LEFT JOIN counts ON counts.a = p.vec_id
""",
    "op5_warc": f"""
WITH rows AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
hashed AS (SELECT page_id, payload, sha1(payload) AS h, max(page_id) OVER (PARTITION BY payload) AS last FROM rows)
SELECT page_id, CAST(strlen(payload) AS BIGINT) AS payload_bytes,
  translate({_BASE32}, '{warc.DIGITS}', '{warc.BASE32}') AS payload_digest,
  CASE WHEN page_id < last THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id < last THEN last END AS refers_to
FROM hashed
""",
    "op13_ranked_search": r"""
WITH words AS (
  SELECT 0 AS of, item_id AS id, text FROM benchmark UNION ALL SELECT 1, doc_id, text FROM documents),
terms AS (
  SELECT of, id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM words),
counts AS (SELECT of, id, term, count(*) AS tf FROM terms GROUP BY ALL),
lengths AS (SELECT id, count(*) AS n FROM terms WHERE of = 1 GROUP BY id),
totals AS (SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_terms FROM lengths),
weights AS (
  SELECT term, CAST(floor(1000 * ln((2.0 * n_docs + 2) / (2 * count(*) + 1)::DOUBLE)) AS BIGINT) AS w
  FROM counts, totals WHERE of = 1 GROUP BY term, n_docs),
scores AS (
  SELECT q.id AS item_id, d.id AS doc_id, CAST(sum(q.tf * w *
    ((1000000000 * d.tf) // (1000 * d.tf + 12 * (75 + (25 * n * n_docs) // n_terms)))) AS BIGINT) AS score
  FROM counts q JOIN counts d ON q.of = 0 AND d.of = 1 AND q.term = d.term
    JOIN weights ON weights.term = d.term JOIN lengths ON lengths.id = d.id, totals
  GROUP BY q.id, d.id),
ranked AS (
  SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank, doc_id, score
  FROM scores WHERE score > 0)
SELECT item_id, CAST(rank AS INT) AS rank, doc_id, score FROM ranked WHERE rank <= 20
""",
}
