"""The corpus pipeline: stages over ``documents``, each written as Parquet and read again.

Toxic documents go, one document of each near-duplicate group stays, repeated sentence spans
go, found secrets are replaced, and what remains is packed into training sequences.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from flowlens.llm import credentials, neardup, packing, spans, toxicity
from flowlens.llm.common import read, staged
from flowlens.llm.queries import TOKENIZER


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.keep_clean(docs, read(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return neardup.keep_one(docs)


def drop_repeated_spans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return spans.keep_first(docs)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return credentials.redact(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, public_tokenizers.path(TOKENIZER), public_tokenizers.PATTERN)


STAGES = [("toxicity", drop_toxic), ("near_duplicates", drop_near_duplicates),
          ("repeated_spans", drop_repeated_spans), ("secrets", redact_secrets),
          ("packing", pack_sequences)]

#: Models, sketches and tokenizers are beyond SQL; tests hold the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
    return docs
