"""The corpus pipeline: stages that each write their rows as Parquet for the next one."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm import languages, minhash, packing, secret_scan, toxicity
from tickloom.llm.queries import BPE
from tickloom.llm.tables import read, written
from tickloom.session import pin_utc

#: No language holds this share of the letters of a text that is rejected.
LEAST_SHARE = 0.3


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the labelled ones teach; texts that are null or without letters go."""
    model = languages.fit_languages(docs)
    return languages.keep_languages(docs, model, LEAST_SHARE)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model fitted on all labelled ones among them does not find toxic."""
    model = toxicity.fit_toxicity(docs, read(spark, sf_dir, "labels"))
    return toxicity.drop_toxic(docs, model)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates."""
    return minhash.drop_near_duplicates(docs)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets replaced by a mark."""
    return secret_scan.mask_secrets(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, with their sequences and places."""
    return packing.pack(packing.token_pieces(docs, public_tokenizers.path(BPE)))


STAGES = [
    ("language_id", keep_known_languages),
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("secrets", mask_secrets),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    pin_utc(spark)
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs


#: Learned models, signatures and tokenizers have no SQL.
ORACLE_SQL = None
