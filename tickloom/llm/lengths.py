"""Token counts: one exact histogram of encoded lengths answers every question about a context limit."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tickloom.llm.tables import text_slices, written
from tickloom.llm.tokens import encoder

BUCKET = 1_024


def encoded_lengths(docs: DataFrame, tokenizer: str) -> DataFrame:
    """``(doc_id, n_tokens)`` for every row of ``docs (doc_id, text)``; a null or empty text has 0."""

    def lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            sizes = encoder(tokenizer).encode(batch.column("text"))[1]
            yield pa.record_batch([batch.column("doc_id").cast(pa.int64()), sizes], ["doc_id", "n_tokens"])

    return docs.select("doc_id", "text").mapInArrow(lengths, "doc_id long, n_tokens long")


def length_histogram(docs: DataFrame, tokenizer: str) -> DataFrame:
    """``(n_tokens, n_docs)``: how many rows of ``docs`` have each length; no rows for an empty table."""

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            length, n = np.unique(encoder(tokenizer).encode(batch.column("text"))[1], return_counts=True)
            yield pa.record_batch([length, n], ["n_tokens", "n_docs"])

    found = docs.select("text").mapInArrow(counts, "n_tokens long, n_docs long")
    return found.groupBy("n_tokens").agg(F.sum("n_docs").alias("n_docs"))


def with_suffix_sums(histogram: DataFrame) -> DataFrame:
    """The histogram with what each length means as a context limit.

    ``docs_at_least`` and ``tokens_at_least`` count documents of that length or more and their tokens,
    ``truncated_tokens`` what is left of all documents cut at that length, ``docs_below`` the shorter
    documents. Sums run inside buckets of ``BUCKET`` lengths; the sums of later buckets, one row each,
    are added to them.
    """
    table = written(histogram.withColumn("bucket", F.floor(F.col("n_tokens") / BUCKET)), "histogram")
    tokens = F.col("n_tokens") * F.col("n_docs")
    sums = table.groupBy("bucket").agg(F.sum("n_docs").alias("docs"), F.sum(tokens).alias("tokens"))
    later = Window.orderBy(F.desc("bucket")).rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    none = F.lit(0).cast("long")
    sums = sums.select(
        "bucket",
        F.coalesce(F.sum("docs").over(later), none).alias("docs_later"),
        F.coalesce(F.sum("tokens").over(later), none).alias("tokens_later"),
        F.coalesce(F.sum("docs").over(earlier), none).alias("docs_earlier"),
        F.coalesce(F.sum("tokens").over(earlier), none).alias("tokens_earlier"),
    )
    down = Window.partitionBy("bucket").orderBy(F.desc("n_tokens"))
    up = Window.partitionBy("bucket").orderBy("n_tokens").rowsBetween(Window.unboundedPreceding, -1)
    rows = table.join(sums, "bucket").select(
        "n_tokens",
        "n_docs",
        (F.sum("n_docs").over(down) + F.col("docs_later")).alias("docs_at_least"),
        (F.sum(tokens).over(down) + F.col("tokens_later")).alias("tokens_at_least"),
        (F.coalesce(F.sum("n_docs").over(up), none) + F.col("docs_earlier")).alias("docs_below"),
        (F.coalesce(F.sum(tokens).over(up), none) + F.col("tokens_earlier")).alias("tokens_below"),
    )
    truncated = F.col("tokens_below") + F.col("n_tokens") * F.col("docs_at_least")
    return rows.withColumn("truncated_tokens", truncated).drop("tokens_below")


def truncated_total(sums: DataFrame, limit: int) -> int:
    """Tokens left when every document is cut to ``limit``, from rows of ``with_suffix_sums``."""
    fits, cut = F.col("n_tokens") <= limit, F.col("n_tokens") > limit
    total = F.sum(F.when(fits, F.col("n_tokens") * F.col("n_docs")).otherwise(0)) + limit * F.sum(F.when(cut, F.col("n_docs")).otherwise(0))
    return sums.agg(total).first()[0] or 0


def length_quantile(sums: DataFrame, share: float) -> int | None:
    """The smallest length such that at least ``share`` of the documents are not longer."""
    total = sums.agg(F.sum("n_docs")).first()[0]
    enough = F.col("docs_below") + F.col("n_docs") >= share * (total or 0)
    return sums.filter(enough).agg(F.min("n_tokens")).first()[0]
