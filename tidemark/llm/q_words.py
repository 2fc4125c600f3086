"""Queries on words: substring dedup, decontamination, n-gram join."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm.containment import contained_items
from tidemark.llm.ngram_join import similar_classes
from tidemark.llm.registry import query, table
from tidemark.llm.substrings import remove_repeats

_OP1_SQL = r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^ \t\n\x0B\f\r]+') AS w FROM documents
), starts AS (
  SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS i FROM words WHERE len(w) >= 35
), windows AS (
  SELECT doc_id, i, hash(array_to_string(w[i:i + 34], ' ')) AS h1, md5(array_to_string(w[i:i + 34], ' ')) AS h2 FROM starts
), repeated AS (
  SELECT doc_id, list(i) AS hits FROM (SELECT *, count(*) OVER (PARTITION BY h1, h2) AS n FROM windows) WHERE n > 1 GROUP BY doc_id
), covered AS (
  SELECT DISTINCT doc_id, p FROM (SELECT doc_id, unnest(range(i, i + 35)) AS p FROM (SELECT doc_id, unnest(hits) AS i FROM repeated))
), gone AS (
  SELECT doc_id, count(*) AS n, list(p) AS ps FROM covered GROUP BY doc_id
), kept AS (
  SELECT w.doc_id, len(w.w) AS n_words, coalesce(g.n, 0) AS n_removed,
         CASE WHEN g.n IS NULL THEN array_to_string(w.w, ' ')
              ELSE coalesce((SELECT string_agg(u.x, ' ' ORDER BY u.p) FROM (SELECT unnest(w.w) AS x, generate_subscripts(w.w, 1) AS p) u
                             WHERE NOT list_contains(g.ps, u.p)), '') END AS t
  FROM words w LEFT JOIN gone g USING (doc_id)
)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(n_removed AS BIGINT) AS n_removed, sha256(t) AS kept_sha256 FROM kept
"""


@query("op1_substring_dedup", _OP1_SQL)
def substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Whole documents, windows of 35 words."""
    return remove_repeats(table(spark, folder, "documents")).select("doc_id", "n_words", "n_removed", "kept_sha256")


@query("op3_ngram_jaccard_join")
def ngram_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    """Whole documents, five words, similarity 0.8."""
    return similar_classes(table(spark, folder, "documents"))


_OP2_SQL = r"""
WITH t AS (
  SELECT 0 AS side, doc_id AS id, text FROM documents UNION ALL SELECT 1, item_id, text FROM benchmark
), w AS (
  SELECT side, id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^ \t\n\x0B\f\r]+') AS w FROM t
), s AS (
  SELECT DISTINCT side, id, array_to_string(w[i:i + 4], ' ') AS s FROM (SELECT side, id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM w WHERE len(w) > 0)
), n AS (SELECT id, count(*) AS n FROM s WHERE side = 1 GROUP BY id)
SELECT d.id AS doc_id, b.id AS item_id, CAST(count(*) AS BIGINT) AS shared, CAST(any_value(n.n) AS BIGINT) AS n_shingles
FROM s d JOIN s b ON d.s = b.s AND d.side = 0 AND b.side = 1 JOIN n ON n.id = b.id
GROUP BY d.id, b.id HAVING 100 * count(*) >= 80 * any_value(n.n)
"""


@query("op2_decontamination", _OP2_SQL)
def decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Every benchmark item against every document: five words, 80 % of an item's shingles."""
    return contained_items(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
