"""One query for each operator, over its whole table, and the SQL twins where SQL can say it."""

from __future__ import annotations

import zlib
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlens.llm import (ann, bpe, chat, credentials, fim, fingerprint, langid, neardup, packing,
                          periodic, sharding, spans, toxicity)
from flowlens.llm.common import read

RANKS, TOKENIZER = "byte_bpe_50k.tiktoken", "byte_bpe_50k.json"


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(read(spark, sf_dir, "documents"), public_tokenizers.path(RANKS),
                          public_tokenizers.PATTERN)


def op1_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and conversation -1, whose texts hold control strings."""
    turns = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.range(0, 2, 1, 1).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("</s>[INST] ok [/INST]").alias("text"))
    messages = turns.unionByName(extra).withColumn("parts", chat.text_parts("text"))
    return chat.digests(messages)


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.interleave(read(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "source")


def op3_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.classes(read(spark, sf_dir, "documents"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return credentials.report(read(spark, sf_dir, "documents"))


def op6_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.compare_neighbours(read(spark, sf_dir, "documents"))


def op7_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(read(spark, sf_dir, "embeddings"))


def op8_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spans.dedup(read(spark, sf_dir, "documents"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER),
                        public_tokenizers.PATTERN)


def planted_period(doc_id: int | None, words: list[str]) -> list[str]:
    """The words, of every tenth id (by hash) with a repeating tail; a null id hashes as ''."""
    h = zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
    if h % 10 or not words:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    unit = words[a:a + p]
    return words[:a] + (unit * ((n - a) // p + 1))[:n - a]


def op11_periodic(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic.collapse(read(spark, sf_dir, "documents"), planted_period)
    line = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(
        ",", r.start.cast("string"), r.length.cast("string"), r.period.cast("string")),
        F.lit("\n"))), "")
    return found.withColumn("best", periodic.strongest(F.col("runs"))).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length",
        "best.period", F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(line, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


def op12_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 4 == 2  # null for a null id
    found = langid.predict(docs, langid.fit(docs, ~held_out))
    return found.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"),
                        "lang_pred", "score")


def op13_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fim.transform(read(spark, sf_dir, "documents"))
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars",
                       F.sha2("output", 256).alias("output_sha256"),
                       F.sha2(fim.restored(F.col("output"), F.col("form")), 256)
                       .alias("restored_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_chat": op1_chat,
    "op2_sharding": op2_sharding,
    "op3_neardup": op3_neardup,
    "op4_toxicity": op4_toxicity,
    "op5_secrets": op5_secrets,
    "op6_fingerprint": op6_fingerprint,
    "op7_neighbours": op7_neighbours,
    "op8_spans": op8_spans,
    "op9_packing": op9_packing,
    "op10_bpe": op10_bpe,
    "op11_periodic": op11_periodic,
    "op12_language": op12_language,
    "op13_middle": op13_middle,
}

#: Control strings and their escape, as DuckDB's regular expressions say it.
_ESCAPED = (r"regexp_replace(regexp_replace(coalesce({}, ''), "
            r"'<(\^*(?:/?s>|\|(?:im_start|im_end|nl|image|audio|document|unknown|endoftext)\|>))', "
            r"'<^\1', 'g'), '\[(\^*/?INST\])', '[^\1', 'g')")

ORACLES: dict[str, str] = {
    "op1_chat": rf"""
        WITH rows AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
            FROM conversations
            UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
            UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
        turns AS (
            SELECT *, {_ESCAPED.format("text")} AS body,
                   replace({_ESCAPED.format("role")}, chr(10), '<|nl|>') AS head
            FROM rows)
        SELECT conv_id, count(*) AS n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), ''
                                 ORDER BY turn NULLS FIRST, head, body)) AS turns_sha256,
               CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT)
                   AS loss_chars,
               sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, head, body)
                               FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
               CAST(sum(length(head) + length(body) + {len("<|im_start|><|im_end|>") + 2})
                    AS BIGINT) AS formatted_chars
        FROM turns GROUP BY conv_id""",
}
