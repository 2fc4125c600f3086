"""Queries on codes, word forms and lines: vector code compression, spelling variants, line dedup."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import spelling
from tidemark.llm.lines import drop_repeated_lines
from tidemark.llm.registry import query, table
from tidemark.llm.vector_codes import codebook_digest, compress


def _op11_sql(parts: int = 16, entries: int = 64, rounds: int = 2) -> str:
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""
a{r} AS MATERIALIZED (
  SELECT r, p, min(CAST(d AS HUGEINT) * {entries} + e) AS best FROM (
    SELECT v.r, v.p, c.e, list_sum(list_transform(range(1, len(v.x) + 1), lambda i: (v.x[i] - c.x[i]) * (v.x[i] - c.x[i]))) AS d
    FROM v JOIN c{r} c ON v.p = c.p) GROUP BY r, p
)""")
        if r < rounds:
            steps.append(f"""
s{r} AS (
  SELECT p, e, list(m ORDER BY i) AS x FROM (
    SELECT v.p, best % {entries} AS e, i, CAST(floor(sum(x[i]) / count(*)) AS BIGINT) AS m
    FROM v JOIN a{r} USING (r, p), range(1, len(v.x) + 1) t(i) GROUP BY ALL) GROUP BY p, e
), c{r + 1} AS MATERIALIZED (
  SELECT c.p, c.e, coalesce(s.x, c.x) AS x FROM c{r} c LEFT JOIN s{r} s ON c.p = s.p AND c.e = s.e
)""")
    return f"""
WITH rows_ AS (
  SELECT row_number() OVER (ORDER BY vec_id, embedding) AS r, vec_id, label,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), v AS MATERIALIZED (
  SELECT r, p, x[p * len(x) // {parts} + 1:(p + 1) * len(x) // {parts}] AS x FROM rows_, range({parts}) t(p)
), c0 AS MATERIALIZED (SELECT p, r - 1 AS e, x FROM v WHERE r <= {entries}), {",".join(steps)},
coded AS (
  SELECT r, string_agg(printf('%02x', CAST(best % {entries} AS BIGINT)), '' ORDER BY p) AS code, CAST(sum(best // {entries}) AS BIGINT) AS error
  FROM a{rounds} GROUP BY r
), labels AS (SELECT label, CAST(sum(error) AS BIGINT) AS label_error FROM coded JOIN rows_ USING (r) GROUP BY label)
SELECT vec_id, code, error, label_error,
       (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY p, e)) FROM c{rounds}) AS codebooks_sha256
FROM rows_ JOIN coded USING (r) JOIN labels ON rows_.label IS NOT DISTINCT FROM labels.label
"""


@query("op11_vector_codes", _op11_sql())
def vector_codes(spark: SparkSession, folder: str) -> DataFrame:
    """All vectors: 16 parts, 64 entries each, 2 rounds."""
    coded, books = compress(table(spark, folder, "embeddings"))
    return coded.select("vec_id", "code", "error", "label_error", F.lit(codebook_digest(books)).alias("codebooks_sha256"))


# The 256 steps of the reflected checksum, polynomial 0xEDB88320.
_CRC_STEPS = "list_transform(range(256), lambda k: list_reduce([k, 1, 2, 3, 4, 5, 6, 7, 8], lambda c, _: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END))"

_OP12_SQL = f"""
WITH t AS MATERIALIZED (SELECT {_CRC_STEPS} AS steps),
runs AS (
  SELECT doc_id, w, count(*) AS n FROM (
    SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS w FROM documents)
  GROUP BY doc_id, w
), sums AS (
  SELECT w, n, xor(list_reduce(
      list_concat([4294967295], flatten(list_transform(string_split(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || w, ''),
        lambda c: CASE WHEN unicode(c) < 128 THEN [CAST(unicode(c) AS BIGINT)] ELSE [195, CAST(unicode(c) AS BIGINT) - 64] END))),
      lambda c, b: xor(c // 256, steps[xor(c % 256, b) + 1])), 4294967295) AS h FROM runs, t
), edited AS (
  SELECT CASE WHEN h % 199 = 0 THEN w[1:CAST(h % length(w) AS BIGINT)] || w[CAST(h % length(w) AS BIGINT) + 2:] ELSE w END AS w, n FROM sums
), words AS MATERIALIZED (
  SELECT w, CAST(sum(n) AS BIGINT) AS n FROM edited WHERE length(w) >= 6 GROUP BY w HAVING sum(n) >= 5
), less AS MATERIALIZED (
  SELECT DISTINCT w, n, i, w[1:i - 1] || w[i + 1:] AS rest FROM (SELECT w, n, unnest(range(1, length(w) + 1)) AS i FROM words)
), near AS MATERIALIZED (
  SELECT a.w AS a, a.n AS an, b.w AS b, b.n AS bn FROM less a JOIN less b ON a.rest = b.rest AND a.i = b.i AND a.w <> b.w
  UNION SELECT l.w, l.n, s.w, s.n FROM less l JOIN words s ON l.rest = s.w
  UNION SELECT s.w, s.n, l.w, l.n FROM less l JOIN words s ON l.rest = s.w
), best AS MATERIALIZED (
  SELECT a AS w, count(*) AS n_near, min({{'m': -bn, 'w': b}}) AS top, any_value(an) AS n FROM near GROUP BY a
), forms AS MATERIALIZED (
  SELECT words.w, words.n, coalesce(n_near, 0) AS n_near, CASE WHEN -top.m >= 5 * words.n THEN top.w END AS form,
         CASE WHEN -top.m >= 5 * words.n THEN -top.m END AS form_n FROM words LEFT JOIN best USING (w)
), chains AS (
  WITH RECURSIVE chain AS (
    SELECT w, w AS tip FROM forms UNION ALL SELECT chain.w, forms.form FROM chain JOIN forms ON chain.tip = forms.w WHERE forms.form IS NOT NULL)
  SELECT chain.w, tip FROM chain JOIN forms ON chain.tip = forms.w WHERE forms.form IS NULL
)
SELECT forms.w AS word, form, tip AS root, CAST(n AS BIGINT) AS n, CAST(n_near AS BIGINT) AS n_near, CAST(form_n AS BIGINT) AS form_n FROM forms JOIN chains USING (w)
"""


@query("op12_spelling_variants", _OP12_SQL)
def spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    """Words of whole documents: six letters, five occurrences, forms five times as frequent."""
    return spelling.variants(spelling.count_words(table(spark, folder, "documents"), every=199))


_OP13_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents
), l AS MATERIALIZED (
  SELECT r, doc_id, i, ls[i] AS line,
         translate(trim(ls[i], ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT r, doc_id, ls, unnest(range(1, len(ls) + 1)) AS i FROM d)
), repeated AS (
  SELECT key, max(doc_id) AS keeper FROM l WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3
), judged AS (
  SELECT r, l.doc_id, i, line, keeper IS NOT NULL AND keeper IS DISTINCT FROM l.doc_id AS gone FROM l LEFT JOIN repeated USING (key)
)
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM judged GROUP BY r
"""


@query("op13_line_dedup", _OP13_SQL)
def line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Whole documents: keys of 20 code points, three documents."""
    return drop_repeated_lines(table(spark, folder, "documents")).select("doc_id", "n_lines", "n_dropped", "kept_sha256")
