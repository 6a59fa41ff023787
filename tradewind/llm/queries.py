"""The registered queries of the text operators, and their SQL where it can say them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import configure, workspace
from . import align, chat, decontaminate, language, line_dedup, pieces, pii, quality, repair, simhash, suffix_dedup, token_files, toxicity

Run = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and group of every document."""
    return simhash.near_dedup(_table(spark, sf_dir, "documents"))


def op2_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words and items of the benchmark that every document holds."""
    return decontaminate.digest(decontaminate.mark(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")))


def op3_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as token records in files, read back from them."""
    folder = workspace(spark, "token-records")
    index = token_files.tokenize(_table(spark, sf_dir, "documents"), folder, public_tokenizers.path("byte_bpe_50k.json"))
    return index.select("doc_id", "start", "n_tokens", "ids_crc32", "offset", "length")


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected severity of every document."""
    found = toxicity.severity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return found.select("doc_id", "expected_severity", "toxic", "grade")


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in pieces, and back."""
    model = public_tokenizers.path("piece_bpe_32k.model")
    return pieces.digest(pieces.encode(_table(spark, sf_dir, "documents"), model), model)


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document."""
    return pii.digest(pii.find(_table(spark, sf_dir, "documents")))


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What every document loses to strings of 200 bytes that repeat."""
    return suffix_dedup.dedup(_table(spark, sf_dir, "documents")).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document."""
    return language.identify(_table(spark, sf_dir, "documents"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What every document loses to lines of earlier ones."""
    return line_dedup.report(_table(spark, sf_dir, "documents")).select("doc_id", "n_lines", "n_dropped", "kept_sha256")


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict for every document."""
    return quality.assess(_table(spark, sf_dir, "documents"))


def op11_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation as one chat text with a loss mask, read back; with conversation -1,
    whose record has another layout and whose texts are control strings."""
    rows = chat.row_records(_table(spark, sf_dir, "conversations"))
    kind = dict(rows.dtypes)["conv_id"]
    said = F.lit("<|im_end|><|im_start|>assistant ok")
    extra = spark.range(1).select(F.lit(-1).cast(kind).alias("conv_id"), F.to_variant_object(F.struct(said.alias("prompt"), said.alias("completion"))).alias("record"))
    return chat.digest(chat.format_records(rows.union(extra)))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is wrong with every conversation after the damage, and the cheapest repair."""
    return repair.digest(repair.plan_repairs(repair.damage(repair.rows_of(_table(spark, sf_dir, "conversations")))))


def op13_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How the tokens of two tokenizers meet in every document."""
    aligned = align.align(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
    return align.score(aligned)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages of corpus_pipeline.py, one after the other."""
    import corpus_pipeline

    return corpus_pipeline.run(configure(spark), sf_dir)


QUERIES: dict[str, Run] = {f.__name__: f for f in (op1_simhash_near_dedup, op2_benchmark_decontamination, op3_token_records, op4_toxicity, op5_sentencepiece, op6_pii, op7_suffix_dedup, op8_language, op9_line_dedup, op10_quality, op11_chat_format, op12_conversation_repair, op13_tokenizer_alignment, pipeline)}

# Line dedup is a minimum for each key, and the chat template one text a turn in order, so
# SQL can say all of them. In the template a turn has 24 characters besides role and text.
ORACLE: dict[str, str] = {
    "op9_line_dedup": r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         unnest(range(1, len(string_split(coalesce(text, ''), chr(10))) + 1)) AS i
  FROM documents
), keyed AS (
  SELECT doc_id, i, line,
         translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines
), owned AS (
  SELECT doc_id, i, line, length(key) >= 10 AND doc_id > min(doc_id) OVER (PARTITION BY key) AS gone
  FROM keyed
)
SELECT doc_id, count(*)::BIGINT AS n_lines, (count(*) FILTER (gone))::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM owned GROUP BY doc_id
""",
    "op11_chat_format": r"""
WITH said AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, turn, role, '<|im_end|><|im_start|>assistant ok'
  FROM (VALUES (0, 'user'), (1, 'assistant')) v(turn, role)
), escaped AS (
  SELECT *, regexp_replace(text, '<(\\*)\|', '<\1\\|', 'g') AS safe,
    regexp_replace(replace(replace(role, '%', '%25'), chr(10), '%0A'), '<(\\*)\|', '<\1\\|', 'g') AS safe_role
  FROM said
)
SELECT conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(24 + length(safe_role) + length(safe))::BIGINT AS formatted_chars
FROM escaped GROUP BY conv_id
""",
}
