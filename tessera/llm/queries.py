"""The registered query of each operator here, and DuckDB SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import chat, decontaminate, html_text, mixing, pii, quality, simhash, tokens, urls, warc
from .common import table

LETTERS = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.classes(table(spark, sf_dir, "documents"))


def op2_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.verdicts(table(spark, sf_dir, "pages"), urls.rule_table(spark))


def op3_warc_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return warc.audit(warc.archive(pages), warc.archive(pages, damage=warc.decay))


def op4_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data(table(spark, sf_dir, "documents"))


def op5_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.read_back(chat.format_turns(chat.with_trick(table(spark, sf_dir, "conversations"))))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.counts(table(spark, sf_dir, "documents"))


def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.main_texts(table(spark, sf_dir, "pages"))


def op8_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.verdicts(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def quality_base_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns of op9 that SQL can express."""
    return quality.base_counts(table(spark, sf_dir, "documents"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP10_SQL = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), {LETTERS}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, regexp_extract_all(translate(coalesce(text, ''), {LETTERS}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bl AS (SELECT item, w, least(10, len(w)) AS l FROM b WHERE len(w) > 0),
bw AS (SELECT DISTINCT item, l, array_to_string(w[i:i + l - 1], ' ') AS win FROM bl, LATERAL (SELECT unnest(range(1, len(w) - l + 2)) AS i)),
dw AS (SELECT doc_id, i, l, array_to_string(w[i:i + l - 1], ' ') AS win FROM d, (SELECT DISTINCT l FROM bl) AS ls, LATERAL (SELECT unnest(range(1, len(w) - l + 2)) AS i)),
m AS (SELECT dw.doc_id, dw.i, dw.l, bw.item FROM dw JOIN bw USING (l, win)),
h AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + l)) AS p FROM m) GROUP BY doc_id),
t AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM m) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(h.n_hit, 0) AS n_hit, coalesce(t.n_items, 0) AS n_items,
  sha256(coalesce(t.items, '')) AS items_sha256, coalesce(h.n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN t USING (doc_id)
"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_simhash": op1_simhash,
    "op2_url_filters": op2_url_filters,
    "op3_warc_fixity": op3_warc_fixity,
    "op4_personal_data": op4_personal_data,
    "op5_chat_formatting": op5_chat_formatting,
    "op6_token_counts": op6_token_counts,
    "op7_html_extraction": op7_html_extraction,
    "op8_source_mixing": op8_source_mixing,
    "op9_quality_rules": op9_quality_rules,
    "op10_decontamination": op10_decontamination,
    "quality_base_counts": quality_base_counts,
}
SQL: dict[str, str] = {
    "op2_url_filters": urls.SQL,
    "op3_warc_fixity": warc.SQL,
    "op5_chat_formatting": chat.SQL,
    "op7_html_extraction": html_text.SQL,
    "op10_decontamination": OP10_SQL,
    "quality_base_counts": quality.SQL,
}
