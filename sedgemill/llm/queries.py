"""The registered queries of the training-data operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from sedgemill.llm.boosting import quality_scores, train
from sedgemill.llm.conversations import damaged, repair
from sedgemill.llm.language import fit as fit_languages, identify
from sedgemill.llm.lines import common_blocks
from sedgemill.llm.packing import pack
from sedgemill.llm.repetition import repetition_rules
from sedgemill.llm.simhash import near_duplicates
from sedgemill.llm.spotsigs import compare_with_next
from sedgemill.llm.substrings import remove_repeats
from sedgemill.llm.templates import contaminated
from sedgemill.llm.transducer import token_counts
from sedgemill.llm.urls import judge
from sedgemill.llm.whitening import whiten

Plan = Callable[[SparkSession, str], DataFrame]
LLM_PLANS: dict[str, Plan] = {}
LLM_SQL: dict[str, str] = {}

# The rules that op5 judges by.
URL_RULES = [
    ("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/"),
]


def register(plan: Plan) -> Plan:
    LLM_PLANS[plan.__name__] = plan
    return plan


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


@register
def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(_table(spark, sf_dir, "documents"), width=3, radius=3)
    hexed = F.lpad(F.lower(F.hex("fp")), 16, "0")
    return found.select("doc_id", hexed.alias("fingerprint"), "component_id")


@register
def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = remove_repeats(_table(spark, sf_dir, "documents"), width=20, block=10)
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


LLM_SQL["op6_substring_dedup"] = r"""
WITH words AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), placed AS (
    SELECT doc_id, unnest(w) AS word, unnest(range(len(w))) AS pos FROM words
), windows AS (
    SELECT doc_id, pos, string_agg(word, ' ') OVER twenty AS phrase, count(*) OVER twenty AS n FROM placed
    WINDOW twenty AS (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND 19 FOLLOWING)
), later AS (
    SELECT doc_id, pos FROM windows WHERE n = 20
    QUALIFY row_number() OVER (PARTITION BY phrase ORDER BY doc_id, pos) > 1
), gone AS (
    SELECT DISTINCT doc_id, unnest(range(pos, pos + 20)) AS pos FROM later
), kept AS (
    SELECT doc_id, count(*) AS n_kept, string_agg(word, ' ' ORDER BY pos) AS kept_text
    FROM placed ANTI JOIN gone USING (doc_id, pos) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n_kept, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept_text, '')) AS kept_sha256
FROM words LEFT JOIN kept USING (doc_id)
"""


@register
def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition_rules(_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_covered_words")


# A text has a repeat of 101 words where a window of 101 words occurs twice in it, so the limits need no suffix array here.
LLM_SQL["op9_quality_rules"] = r"""
WITH docs AS (
    SELECT doc_id, coalesce(text, '') AS text, row_number() OVER () AS r FROM documents
), words AS (
    SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w FROM docs
), counted AS (
    SELECT r, doc_id, w, len(w) AS n, length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
           length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
           list_filter(string_split(text, chr(10)), lambda line: regexp_matches(line, '[^\x20\x09-\x0D]')) AS lines
    FROM words
), placed AS (
    SELECT r, unnest(w) AS word, unnest(range(len(w))) AS pos FROM words
), windows AS (
    SELECT r, pos, string_agg(word, ' ') OVER three AS phrase3, count(*) OVER three AS n3,
           string_agg(word, ' ') OVER four AS phrase4, count(*) OVER four AS n4 FROM placed
    WINDOW three AS (PARTITION BY r ORDER BY pos ROWS BETWEEN CURRENT ROW AND 2 FOLLOWING),
           four AS (PARTITION BY r ORDER BY pos ROWS BETWEEN CURRENT ROW AND 3 FOLLOWING)
), again3 AS (
    SELECT r, pos FROM windows WHERE n3 = 3 QUALIFY count(*) OVER (PARTITION BY r, phrase3) > 1
), again4 AS (
    SELECT r, pos FROM windows WHERE n4 = 4 QUALIFY count(*) OVER (PARTITION BY r, phrase4) > 1
), repeated AS (
    SELECT r, count(DISTINCT place) AS n FROM (SELECT r, unnest(range(pos, pos + 3)) AS place FROM again3) GROUP BY r
), covered AS (
    SELECT r, count(DISTINCT place) AS n FROM (SELECT r, unnest(range(pos, pos + 4)) AS place FROM again4) GROUP BY r
), spans AS (
    SELECT r, array_to_string(w[place:place + 100], ' ') AS span FROM (SELECT r, w, unnest(range(1, n - 99)) AS place FROM counted)
), long AS (
    SELECT r FROM spans GROUP BY r HAVING count(*) > count(DISTINCT span)
), judged AS (
    SELECT c.*, coalesce(p.n, 0) AS n_repeat, coalesce(v.n, 0) AS n_covered, c.r IN (SELECT r FROM long) AS is_long
    FROM counted c LEFT JOIN repeated p USING (r) LEFT JOIN covered v USING (r)
)
SELECT doc_id, n AS n_words, word_chars, n_symbols, len(lines) - len(list_distinct(lines)) AS n_dup_lines, n_repeat AS n_repeat_words,
       n < 50 OR 100 * n_repeat > 50 * n AS base_failed,
       NOT (n < 50 OR 100 * n_repeat > 50 * n) AND 100 * n_covered <= 30 * n AND NOT is_long AS kept, n_covered AS n_covered_words
FROM judged
"""


@register
def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return quality_scores(docs, train(docs, _table(spark, sf_dir, "labels")))


@register
def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return identify(docs, fit_languages(docs)).select(
        "doc_id", "held_out", "lang_pred", "score", F.size("spans").alias("n_spans"))


@register
def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_counts(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), limit=2048)


@register
def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), capacity=2048)


@register
def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


@register
def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return common_blocks(_table(spark, sf_dir, "documents")).drop("key")


@register
def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(_table(spark, sf_dir, "pages"), URL_RULES)


@register
def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = _table(spark, sf_dir, "conversations")
    return repair(damaged(conversations), conversations)


@register
def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(_table(spark, sf_dir, "embeddings"))


@register
def op12_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare_with_next(_table(spark, sf_dir, "documents"))
