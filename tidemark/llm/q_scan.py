"""Queries on raw text: secret scans, HTML extraction, tokenisation."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import secret_scan, sentencepiece_scan
from tidemark.llm.registry import query, table
from tidemark.llm.tag_paths import extract
from tidemark.llm.token_files import token_files


def _sql_spans(pattern: str, options: str, kind: int) -> str:
    """Array of (start, kind, end, match) of all matches, in DuckDB."""
    pattern = pattern.replace("(?i)", "").replace("'", "''")
    all_ = f"regexp_extract_all(t, '{pattern}', 0, '{options}')" if options else f"regexp_extract_all(t, '{pattern}')"
    pieces = f"regexp_split_to_array(t, '{pattern}', '{options}')" if options else f"regexp_split_to_array(t, '{pattern}')"
    sums = "list_sum(list_transform(p[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0)"
    return (
        f"(SELECT coalesce(list_transform(range(1, len(m) + 1), lambda i: {{'start': {sums}, 'kind': {kind}, 'end': {sums} + length(m[i]), 'match': m[i]}}), []) "
        f"FROM (SELECT {all_} AS m, {pieces} AS p))"
    )


def _sql() -> str:
    s = secret_scan
    value = s.ASSIGN.replace("(?i)", "").replace("'", "''")
    allowed = " OR ".join(f"regexp_matches(x.match, '{p}')" for p in s.ALLOWED)
    entropy = (
        f"list_max(list_transform(range(1, length(x.match) - {s.WINDOW - 2}), "
        f"lambda i: list_entropy(string_split(substring(x.match, i, {s.WINDOW}), ''))))"
    )
    names_only = f"regexp_matches(x.match, '{s.MARKS}') AND len(list_filter(string_split_regex(x.match, '{s.MARKS}'), lambda y: NOT regexp_matches(y, '{s.NAME}'))) = 0"
    classes = " ".join(f"WHEN regexp_matches(x.match, '{p}') THEN {s.expected_entropy(n) - s.MARGIN!r}" for p, n in s.CLASSES)
    limit = f"CASE WHEN regexp_full_match(x.match, '[0-9a-fA-F]+') THEN {s.HEX_LIMIT} {classes} END"
    names = "[" + ", ".join(f"'{k}'" for k in s.KINDS) + "]"
    text = lambda spans: f"array_to_string(list_transform({spans}, lambda x: {names}[x.kind + 1] || ':' || x.start || ':' || x.end), ',')"
    plain = "lambda x: {'start': CAST(x.start AS BIGINT), 'kind': CAST(x.kind AS BIGINT), 'end': CAST(x.end AS BIGINT)}"
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
b AS (
  SELECT doc_id, t, list_filter({_sql_spans(s.ASSIGN, 'i', 0)}, lambda x: length(regexp_extract(x.match, '{value}', 2, 'i')) >= 8) AS b0,
         {_sql_spans(s.ACCESS, '', 1)} AS b1, {_sql_spans(s.HEX, '', 2)} AS b2,
         {_sql_spans(s.CANDIDATE, '', 3)} AS e FROM d
), c AS (
  SELECT doc_id, len(b0) AS n0, len(b1) AS n1, len(b2) AS n2,
         list_transform(list_concat(list_concat(b0, b1), b2), {plain}) AS base,
         list_transform(list_filter(e, lambda x: regexp_matches(x.match, '[0-9]') AND regexp_matches(x.match, '[A-Za-z]') AND NOT ({allowed}) AND NOT ({names_only})
           AND {entropy} >= {limit}), {plain}) AS e FROM b
), f AS (
  SELECT doc_id, n0, n1, n2, list_sort(base) AS base,
         list_sort(list_concat(base, list_filter(e, lambda x: len(list_filter(base, lambda y: y.start < x.end AND x.start < y.end)) = 0))) AS spans FROM c
)
SELECT doc_id, CAST(n0 AS BIGINT) AS n_assign, CAST(n1 AS BIGINT) AS n_access, CAST(n2 AS BIGINT) AS n_hex,
       sha256({text('base')}) AS base_sha256, {text('spans')} AS spans FROM f
"""


@query("op4_secret_scan", _sql())
def secret_scan_query(spark: SparkSession, folder: str) -> DataFrame:
    """Whole documents, base kinds and entropy."""
    return secret_scan.scan(table(spark, folder, "documents"))


@query("op6_token_files")
def token_files_query(spark: SparkSession, folder: str) -> DataFrame:
    """Whole documents as byte-level BPE ids, each ended by id 0, written and read back."""
    return token_files(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query("op8_html_extraction")
def html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    """Main text of every page."""
    return extract(table(spark, folder, "pages"))


@query("op5_sentencepiece")
def sentencepiece_query(spark: SparkSession, folder: str) -> DataFrame:
    """Whole documents, encoded and decoded again."""
    coded = sentencepiece_scan.round_trip(table(spark, folder, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
    return coded.select("doc_id", "n_tokens", "ids_crc32", "decoded_sha256")
