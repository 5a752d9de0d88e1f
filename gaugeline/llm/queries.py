"""The numbered queries over the test tables and, where SQL can express them, their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeline.llm import bpe, chat, extraction, hard_negatives, lm, packing, prefix_trie, quality
from gaugeline.llm import simhash, spans, spotsigs, stages, token_files, toxicity
from gaugeline.session import scratch_dir

WORD_BPE = "word_bpe_49k.json"
BYTE_BPE = "byte_bpe_50k.json"


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def op1_best_fit_packing(spark: SparkSession, sf: str) -> DataFrame:
    pieces = packing.pack(_table(spark, sf, "documents"), public_tokenizers.path(WORD_BPE))
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def op2_bpe_encode_decode(spark: SparkSession, sf: str) -> DataFrame:
    encoded = bpe.encode(_table(spark, sf, "documents"), public_tokenizers.path(BYTE_BPE))
    return encoded.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op3_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    docs = _table(spark, sf, "documents")
    chain = toxicity.train(docs, _table(spark, sf, "labels"), stages.CATEGORIES)
    return toxicity.judge(docs.select("doc_id", "text"), chain).drop("text")


def op4_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    return quality.judge(_table(spark, sf, "documents")).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "words_left",
        "kept",
    )


OP4_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(source, '') AS host,
         coalesce(text, '') AS t, coalesce('t' || text, 'null') AS content FROM documents
), w AS (
  SELECT r, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws FROM d
), triples AS (
  SELECT r, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS triple
  FROM (SELECT r, ws, unnest(range(1, len(ws) - 1)) AS i FROM w)
), again AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, triple) AS n FROM triples)
  WHERE n > 1
), repeats AS (
  SELECT r, count(DISTINCT pos) AS n_repeat_words
  FROM (SELECT r, i + unnest([0, 1, 2]) AS pos FROM again) GROUP BY r
), split AS (
  SELECT r, host, unnest(string_split(t, chr(10))) AS line FROM d
), lines AS (
  SELECT r, host, line, regexp_extract_all(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws
  FROM split WHERE regexp_matches(line, '[^\x20\x09-\x0D]')
), dups AS (
  SELECT r, count(*) - count(DISTINCT line) AS n_dup_lines FROM lines GROUP BY r
), once AS (
  SELECT r, host, array_to_string(ws, ' ') AS norm, sum(len(ws)) AS words
  FROM lines GROUP BY ALL
), frequent AS (
  SELECT host, norm
  FROM (SELECT o.host, norm, count(DISTINCT content) AS docs FROM once o JOIN d USING (r) GROUP BY ALL)
  JOIN (SELECT host, count(DISTINCT content) AS host_docs FROM d GROUP BY host) USING (host)
  WHERE docs > 10 AND docs > CAST(0.01 AS DOUBLE) * host_docs
), gone AS (
  SELECT r, sum(words) AS gone FROM once JOIN frequent USING (host, norm) GROUP BY r
), counted AS (
  SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words,
         CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
         CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
         CAST(len(ws) - coalesce(gone, 0) AS BIGINT) AS words_left
  FROM d JOIN w USING (r) LEFT JOIN dups USING (r) LEFT JOIN repeats USING (r)
  LEFT JOIN gone USING (r)
)
SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words)
         AND 100 * words_left >= 50 * n_words AS kept
FROM counted
"""

# Functions that the users of the conversations are taken to call.
FUNCTIONS = {
    "search": {
        "query": {"kind": "string", "required": True, "longest": 200},
        "limit": {"kind": "integer", "required": True, "least": 1.0, "most": 20.0},
    },
    "summarise": {
        "text": {"kind": "string", "required": True, "longest": 400},
        "max_words": {"kind": "integer", "required": True, "least": 1.0, "most": 60.0},
    },
}


def op5_chat_formatting(spark: SparkSession, sf: str) -> DataFrame:
    """Each user turn is a call that the turn before last must precede; each assistant turn
    is the result of the call one turn before it."""
    turns = _table(spark, sf, "conversations").withColumn("text", F.coalesce("text", F.lit("")))
    words = F.char_length("text") - F.char_length(F.replace("text", F.lit(" "), F.lit(""))) + 1
    call_id = lambda back: F.concat_ws("-", "conv_id", F.col("turn") - back)
    short = words <= 25
    calls = turns.where("role = 'user'").select(
        "conv_id",
        call_id(0).alias("call_id"),
        "turn",
        F.when(short, "search").otherwise("summarise").alias("name"),
        F.when(short, F.to_json(F.struct(F.col("text").alias("query"), words.alias("limit"))))
        .otherwise(F.to_json(F.struct("text", words.alias("max_words"))))
        .alias("arguments"),
        F.array(call_id(2)).alias("needs"),
    )
    results = turns.where("role = 'assistant'").select(
        "conv_id", call_id(1).alias("call_id"), "turn", F.col("text").alias("content")
    )
    linked = chat.link(calls, results, chat.schema_table(spark, FUNCTIONS))
    others = turns.where("coalesce(role, '') not in ('user', 'assistant')")
    return linked.union(chat.plain_messages(others))


OP5_SQL = """
WITH RECURSIVE t AS (
  SELECT conv_id, turn, role, coalesce(text, '') AS text,
         length(coalesce(text, '')) - length(replace(coalesce(text, ''), ' ', '')) + 1 AS words
  FROM conversations
), calls AS (
  SELECT conv_id, conv_id || '-' || turn AS call_id, turn, text, words,
         conv_id || '-' || (turn - 2) AS needs FROM t WHERE role = 'user'
), results AS (
  SELECT conv_id, conv_id || '-' || (turn - 1) AS call_id, turn, text AS content
  FROM t WHERE role = 'assistant'
), depth AS (
  SELECT c.conv_id, c.call_id, 0 AS level FROM calls c
  WHERE NOT EXISTS (SELECT 1 FROM calls d WHERE d.conv_id = c.conv_id AND d.call_id = c.needs)
  UNION ALL
  SELECT c.conv_id, c.call_id, level + 1 FROM depth d
  JOIN calls c ON c.conv_id = d.conv_id AND c.needs = d.call_id
), checked AS (
  SELECT *, CASE WHEN words <= 25 THEN concat_ws(',',
      CASE WHEN length(text) > 200 THEN NULL END,
      CASE WHEN length(text) > 200 AND words > 20 THEN 'length:query,range:limit'
           WHEN length(text) > 200 THEN 'length:query' WHEN words > 20 THEN 'range:limit' END)
    ELSE concat_ws(',', CASE WHEN length(text) > 400 THEN 'length:text' END,
                   CASE WHEN words > 60 THEN 'range:max_words' END) END AS found
  FROM calls
)
SELECT coalesce(c.conv_id, r.conv_id) AS conv_id, coalesce(c.call_id, r.call_id) AS call_id,
       coalesce(c.turn, r.turn) AS turn, level,
       CASE WHEN c.call_id IS NULL THEN 'orphan' WHEN r.call_id IS NULL THEN 'unanswered'
            ELSE 'linked' END AS status,
       c.call_id IS NOT NULL AND r.call_id IS NOT NULL AND found = '' AS valid,
       nullif(found, '') AS errors,
       CASE WHEN c.call_id IS NULL THEN
         '{"id":' || to_json(r.call_id) || ',"result":' || to_json(content) || ',"turn":' || r.turn || '}'
       ELSE '{"arguments":' || CASE WHEN words <= 25
           THEN '{"limit":' || words || ',"query":' || to_json(text) || '}'
           ELSE '{"max_words":' || words || ',"text":' || to_json(text) || '}' END
         || ',"id":' || to_json(c.call_id) || ',"name":"'
         || CASE WHEN words <= 25 THEN 'search' ELSE 'summarise' END || '","result":'
         || coalesce(CAST(to_json(content) AS VARCHAR), 'null') || ',"turn":' || c.turn || '}' END AS message
FROM checked c FULL JOIN results r ON c.conv_id = r.conv_id AND c.call_id = r.call_id
LEFT JOIN depth d ON d.conv_id = c.conv_id AND d.call_id = c.call_id
UNION ALL
SELECT conv_id, NULL, turn, 0, 'message', true, NULL,
       '{"role":' || coalesce(CAST(to_json(role) AS VARCHAR), 'null') || ',"text":' || to_json(text)
       || ',"turn":' || turn || '}'
FROM t WHERE coalesce(role, '') NOT IN ('user', 'assistant')
"""


def op6_simhash_near_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf, "documents"))


def op7_html_extraction(spark: SparkSession, sf: str) -> DataFrame:
    pages = _table(spark, sf, "pages")
    texts = extraction.extract(pages, extraction.train(pages))
    return texts.withColumn("n_chars", F.char_length("text").cast("bigint"))


def op8_document_fingerprints(spark: SparkSession, sf: str) -> DataFrame:
    return spotsigs.edited(_table(spark, sf, "documents")).select(
        "doc_id",
        "n_chars",
        F.sha2("edited_text", 256).alias("edited_sha256"),
        "fingerprint",
        "edited_fingerprint",
        "near_edited",
        "near_next",
    )


def op9_lm_scoring(spark: SparkSession, sf: str) -> DataFrame:
    return lm.score_corpus(_table(spark, sf, "documents"))


def op10_substring_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return spans.remove_repeats(_table(spark, sf, "documents").select("doc_id", "text"))


def op11_hard_negatives(spark: SparkSession, sf: str) -> DataFrame:
    """Every seventh label is wrong by one, so that some negatives are near their anchor."""
    moved = (F.col("label").cast("bigint") + 1) % 10
    rows = _table(spark, sf, "embeddings").withColumn(
        "label", F.when(F.col("vec_id") % 7 == 0, moved).otherwise(F.col("label"))
    )
    return hard_negatives.mine(rows, F.col("vec_id") % 100 == 0)


def op12_conversation_prefix_trie(spark: SparkSession, sf: str) -> DataFrame:
    return prefix_trie.conversation_trie(_table(spark, sf, "conversations"))


def op13_token_files(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_dir(spark, "token-files")
    token_files.write(_table(spark, sf, "documents"), path, public_tokenizers.path(BYTE_BPE))
    return token_files.checksums(token_files.read(spark, path))


QUERIES = [
    op1_best_fit_packing,
    op2_bpe_encode_decode,
    op3_toxicity,
    op4_quality_rules,
    op5_chat_formatting,
    op6_simhash_near_dedup,
    op7_html_extraction,
    op8_document_fingerprints,
    op9_lm_scoring,
    op10_substring_dedup,
    op11_hard_negatives,
    op12_conversation_prefix_trie,
    op13_token_files,
]
ORACLE_SQL: dict[str, str] = {"op4_quality_rules": OP4_SQL, "op5_chat_formatting": OP5_SQL}
