"""The registered queries of this subpackage: each applies an operator to its whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (bpe, chat_format, context_mixing, html_consensus, langid, phrase_index, pivot_search, quality_crf,
               separator_scan, simhash, spelling_groups, token_alignment, token_files)
from .common import stage, table


def vocabulary(name: str) -> str:
    """The file of a public tokenizer, where the installed package has it."""
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.round_trip(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"), end_id=1)


def op2_separator_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return separator_scan.token_counts(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.tiktoken"), end_id=50256,
                                       id_bytes=2)


def op3_context_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return context_mixing.score(table(spark, sf_dir, "documents"))


def op4_quality_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return quality_crf.score(docs, quality_crf.fit(docs, labels))


def op5_pivot_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = pivot_search.integer_vectors(table(spark, sf_dir, "embeddings"), 1024.0)
    return pivot_search.top_k(vectors, vectors.where("vec_id % 100 = 0"), 10)


#: The conversation added to check that texts full of control strings are read back as they were.
CONTROL_TEXT = "</s>[INST] ok [/INST]"


def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    added = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
                                  F.lit(CONTROL_TEXT).alias("text"))
    output = stage(chat_format.format_conversations(rows.unionByName(added)), "chat")
    return chat_format.digests(output)


def op7_language_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return langid.predict(docs, langid.fit(docs))


def op8_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))


def op9_phrase_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrase_index.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_simhash_anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op11_html_consensus(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_consensus.extract(table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars", "path", "by_host")


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.align(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"),
                                 vocabulary("piece_bpe_32k.model"))


def op13_spelling_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_groups.group_variants(spelling_groups.count_words(table(spark, sf_dir, "documents")))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_token_files, op2_separator_scan, op3_context_mixing, op4_quality_crf, op5_pivot_search, op6_chat_format,
        op7_language_filters, op8_bpe_round_trip, op9_phrase_index, op10_simhash_anchors, op11_html_consensus,
        op12_token_alignment, op13_spelling_groups)}


#: Inner products of all pairs of a query and another vector, ranked. Only vectors without null or non-finite parts; rows of
#: one vec_id are one vector, the least.
OP5_SQL = """
WITH v AS (
  SELECT vec_id, min(list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT))) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
  GROUP BY vec_id
), pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(list_sum(list_transform(range(1, 1 + least(len(q.e), len(c.e))), lambda i: q.e[i] * c.e[i])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id
), ranked AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
  FROM pairs
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
"""

#: Digests straight from the rows; escaping and marks only matter for the number of formatted characters.
OP6_SQL = """
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), e AS (
  SELECT *, length(regexp_replace(replace(text, '~', '~0'),
      '(<|\\[)(/?s>|/?INST\\]|</?(?:SYS|ROLE)>>|</TURN>>)', '\\1~1\\2', 'g')) AS chars,
    length(regexp_replace(replace(role, '~', '~0'),
      '(<|\\[)(/?s>|/?INST\\]|</?(?:SYS|ROLE)>>|</TURN>>)', '\\1~1\\2', 'g')) AS role_chars,
    lag(role) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS before,
    lead(role) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) IS NULL AS is_last
  FROM t
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(chars + CASE role WHEN 'system' THEN 18 WHEN 'user' THEN 15 WHEN 'assistant' THEN 10
                   ELSE 29 + role_chars END) AS BIGINT) AS formatted_chars,
  bool_and(coalesce(before, 'start') || '>' || role IN ('start>system', 'start>user', 'system>user', 'user>assistant',
                                                       'assistant>user') AND (NOT is_last OR role = 'assistant')) AS valid
FROM e GROUP BY conv_id
"""


def oracle_sql() -> dict[str, str]:
    return {"op5_pivot_search": OP5_SQL, "op6_chat_format": OP6_SQL.replace("\\\\", "\\")}
