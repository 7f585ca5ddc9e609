"""Registered queries of this subpackage, and their DuckDB SQL where SQL expresses them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from dockwise.llm import (
    byte_bpe,
    conversation_repair,
    decontam,
    embed_dedup,
    fill_middle,
    line_dedup,
    mixing,
    near_dup,
    pii,
    suffix_dedup,
    tokens,
    toxicity,
    warc,
)
from dockwise.llm.common import ship_package

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


QUERIES: dict[str, Query] = {
    "op1_suffix_dedup": lambda spark, d: suffix_dedup.digest(_table(spark, d, "documents")),
    "op2_tokens": lambda spark, d: tokens.round_trip(spark, _table(spark, d, "documents"), TOKENIZER),
    "op3_pii": lambda spark, d: pii.digest(_table(spark, d, "documents")),
    "op4_toxicity": lambda spark, d: toxicity.digest(_table(spark, d, "documents"), _table(spark, d, "labels")),
    "op5_warc": lambda spark, d: warc.round_trip(spark, _table(spark, d, "pages")),
    "op6_near_dup": lambda spark, d: near_dup.digest(_table(spark, d, "documents")),
    "op7_line_dedup": lambda spark, d: line_dedup.digest(_table(spark, d, "documents")),
    "op8_decontam": lambda spark, d: decontam.digest(_table(spark, d, "documents"), _table(spark, d, "benchmark")),
    "op9_mixing": lambda spark, d: mixing.digest(_table(spark, d, "documents")),
    "op10_embed_dedup": lambda spark, d: embed_dedup.near_duplicates(_table(spark, d, "embeddings")),
    "op11_conversation_repair": lambda spark, d: conversation_repair.digest(_table(spark, d, "conversations")),
    "op12_byte_bpe": lambda spark, d: byte_bpe.digest(_table(spark, d, "documents"), RANKS, public_tokenizers.PATTERN),
    "op13_fill_middle": lambda spark, d: fill_middle.digest(_table(spark, d, "documents")),
}

_OP5 = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS n, sha1(coalesce(html, '')) AS h FROM pages),
g AS (SELECT *, max(page_id) OVER (PARTITION BY h) AS top FROM p)
SELECT page_id, n AS payload_bytes, h AS payload_digest,
       CASE WHEN n >= 1000 AND top <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 1000 AND top <> page_id THEN top END AS refers_to
FROM g"""

_OP7 = """
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents),
keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines),
common AS (SELECT key FROM keyed WHERE key <> '' GROUP BY key HAVING count(DISTINCT doc_id) >= 10),
marked AS (SELECT k.*, c.key IS NOT NULL AS gone FROM keyed k LEFT JOIN common c ON k.key = c.key)
SELECT doc_id, count(*) AS n_lines, CAST(sum(gone::INT) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id"""

_OP8 = r"""
WITH dw AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
iw AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS (
  SELECT item_id, n, array_to_string(w[p:p + n - 1], ' ') AS k
  FROM (SELECT *, unnest(generate_series(1, len(w) - n + 1)) AS p
        FROM (SELECT *, least(13, len(w)) AS n FROM iw WHERE len(w) > 0))),
lens AS (SELECT DISTINCT n FROM win),
grams AS (
  SELECT doc_id, p, n, array_to_string(w[p:p + n - 1], ' ') AS k
  FROM (SELECT doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS p FROM dw, lens WHERE len(w) >= n)),
occ AS (SELECT DISTINCT doc_id, p, n, item_id FROM grams JOIN win USING (n, k)),
hit AS (SELECT doc_id, count(DISTINCT q) AS n_hit
        FROM (SELECT doc_id, unnest(generate_series(p, p + n - 1)) AS q FROM occ) GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS s
        FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS i FROM occ) GROUP BY doc_id)
SELECT dw.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
       coalesce(n_items, 0) AS n_items, sha256(coalesce(s, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM dw LEFT JOIN hit USING (doc_id) LEFT JOIN its USING (doc_id)"""

_OP9 = r"""
WITH d AS (
  SELECT doc_id, source, text, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         md5('mix-1:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(source, '') || ':' || md5(coalesce(text, '')))[1:15] AS o
  FROM documents),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         CAST([3, 1, 2][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS DOUBLE) AS weight
  FROM d GROUP BY source),
sums AS (
  SELECT *, CAST(sum(source_size) OVER () AS DOUBLE) * CAST(1.5 AS DOUBLE) AS budget,
         CAST(coalesce(sum(source_size) OVER earlier, 0) AS DOUBLE) * 2 AS capped,
         sum(weight) OVER () - coalesce(sum(weight) OVER earlier, 0) AS open
  FROM s WINDOW earlier AS (ORDER BY source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
levels AS (SELECT *, (budget - capped) / open AS level FROM sums),
t AS (
  SELECT source, source_size,
         least(CAST(source_size AS DOUBLE) * 2,
               coalesce(max(CASE WHEN level * weight <= CAST(source_size AS DOUBLE) * 2 THEN level END) OVER (), CAST('inf' AS DOUBLE)) * weight) AS target
  FROM levels),
queue AS (
  SELECT d.*, source_size, target,
         CAST(sum(size) OVER (PARTITION BY d.source ORDER BY o, doc_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS ended
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
pieces AS (
  SELECT *, unnest(generate_series(0, size - 1, 256)) AS start FROM (SELECT *, unnest([0, 1]) AS epoch FROM queue WHERE size > 0)),
timed AS (
  SELECT doc_id, source, text, least(start + 256, size) - start AS w,
         CAST(epoch * source_size + ended - size + least(start + 256, size) AS DOUBLE) / target AS finish
  FROM pieces),
line AS (SELECT *, sum(w) OVER (ORDER BY finish, source NULLS FIRST, doc_id ROWS UNBOUNDED PRECEDING) AS total FROM timed),
taken AS (
  SELECT doc_id, source, text, sum(w) AS w FROM line
  WHERE CAST(total AS DOUBLE) <= (SELECT coalesce(sum(target), 0) FROM t) GROUP BY ALL)
SELECT q.doc_id, q.size, q.source_size, q.target,
       CAST(floor(coalesce(k.w, 0) / count(*) OVER (PARTITION BY q.doc_id, q.source, q.text)) AS BIGINT) AS taken
FROM queue q LEFT JOIN taken k
  ON q.doc_id IS NOT DISTINCT FROM k.doc_id AND q.source IS NOT DISTINCT FROM k.source AND q.text IS NOT DISTINCT FROM k.text"""

_OP10 = """
WITH RECURSIVE usable AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND list_count(embedding) = len(embedding)
    AND list_bool_and(list_transform(embedding, lambda x: isfinite(x)))
    AND list_bool_or(list_transform(embedding, lambda x: x <> 0))),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b
    ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v) AND list_cosine_similarity(a.v, b.v) >= 0.9),
reach AS (
  SELECT vec_id AS a, vec_id AS b FROM embeddings
  UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
comp AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a),
n AS (SELECT a AS vec_id, count(*) AS n_links FROM links GROUP BY a)
SELECT e.vec_id, coalesce(n_links, 0) AS n_links, component_id, e.vec_id = component_id AS kept
FROM embeddings e JOIN comp USING (vec_id) LEFT JOIN n USING (vec_id)"""

_OP11 = r"""
WITH RECURSIVE crc_table AS (
  SELECT list(c ORDER BY i) AS t FROM (
    SELECT i, list_reduce([i] || range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
    FROM range(256) r(i))),
convs AS (SELECT conv_id, row_number() OVER (ORDER BY conv_id) AS c FROM (SELECT DISTINCT conv_id FROM conversations)),
drawn AS (
  SELECT c, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         xor(list_reduce([4294967295] || list_transform(string_split(coalesce(CAST(x.conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''),
                                                        lambda s: CAST(unicode(s) AS BIGINT)),
                         lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])), 4294967295) % 20 AS draw
  FROM conversations x JOIN convs ON x.conv_id IS NOT DISTINCT FROM convs.conv_id, crc_table),
damaged AS (
  SELECT c, turn, CASE WHEN draw = 4 THEN 'user' ELSE role END AS role,
         CASE WHEN draw = 1 THEN '' WHEN draw = 2 THEN translate(text, '.!?', '') ELSE text END AS text
  FROM (SELECT *, unnest(CASE WHEN draw = 3 THEN [1, 2] ELSE [1] END) FROM drawn WHERE draw <> 0)),
placed AS (SELECT *, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, role, text) AS pos FROM damaged),
ends AS (
  SELECT *, right(rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 1) AS fin, left(role, 1) AS ini,
         row_number() OVER (PARTITION BY c, role, text ORDER BY pos) AS nth, lag(left(role, 1)) OVER (PARTITION BY c ORDER BY pos) AS prev
  FROM placed),
faults AS (
  SELECT *, CASE WHEN fin = '' THEN 'b' WHEN nth > 1 THEN 'd' WHEN fin NOT IN ('.', '!', '?') THEN 't' ELSE '' END AS fault FROM ends),
moves(f, i, t) AS (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)),
adds(f, t, k) AS (VALUES (0, 0, 0), (0, 2, 1), (0, 3, 2), (1, 1, 0), (1, 2, 1), (1, 3, 2), (2, 2, 0), (2, 3, 1), (3, 3, 0), (3, 2, 1)),
edits(f, t, ini, fault, cost, edit) AS (
  SELECT s, s, NULL, NULL, 2, 'D' FROM range(4) r(s)
  UNION ALL SELECT f, t, i, g, CASE WHEN g = 't' THEN 5 ELSE 0 END, 'K' FROM moves, (VALUES (''), ('t')) x(g)
  UNION ALL SELECT f, t, '~' || i, g, CASE WHEN g = 't' THEN 6 ELSE 1 END, 'R' FROM moves, (VALUES (''), ('t')) x(g) WHERE i <> 's'),
tops AS (
  SELECT c, CAST(0 AS BIGINT) AS pos, 0 AS state, lpad('0', 12, '0') AS best FROM (SELECT DISTINCT c FROM faults)
  UNION ALL
  SELECT tops.c, tops.pos + 1, e.t,
         min(lpad(CAST(CAST(best[1:12] AS BIGINT) + 5 * a.k + e.cost AS VARCHAR), 12, '0') || best[13:] || repeat('I', a.k) || e.edit)
  FROM tops JOIN adds a ON a.f = tops.state JOIN faults r ON r.c = tops.c AND r.pos = tops.pos + 1
  JOIN edits e ON e.f = a.t AND (e.edit = 'D' OR e.fault = r.fault AND (e.edit = 'K' AND e.ini = r.ini OR e.edit = 'R' AND e.ini <> '~' || r.ini))
  GROUP BY tops.c, tops.pos, e.t),
best AS (
  SELECT c, min(lpad(CAST(CAST(best[1:12] AS BIGINT) + 5 * a.k AS VARCHAR), 12, '0') || best[13:] || repeat('I', a.k)) AS best
  FROM tops JOIN adds a ON a.f = tops.state JOIN (SELECT c, max(pos) AS n FROM faults GROUP BY c) m USING (c)
  WHERE tops.pos = n AND a.t IN (0, 3) GROUP BY c),
letters AS (SELECT c, unnest(string_split(best[13:], '')) AS e, generate_subscripts(string_split(best[13:], ''), 1) AS i FROM best WHERE best[13:] <> ''),
marked AS (
  SELECT *, sum((e <> 'I')::INT) OVER (PARTITION BY c ORDER BY i) AS pos, sum((e <> 'D')::INT) OVER (PARTITION BY c ORDER BY i) - 1 AS o,
         sum((e <> 'D')::INT) OVER (PARTITION BY c) % 2 AS odd
  FROM letters),
fixed AS (
  SELECT m.c, string_agg(CASE WHEN e = 'K' THEN role WHEN (o - odd) % 2 = 0 THEN 'user' ELSE 'assistant' END || ':' ||
                         CASE WHEN e = 'I' THEN '' ELSE text END, chr(10) ORDER BY i) AS body
  FROM marked m LEFT JOIN faults r ON r.c = m.c AND r.pos = m.pos WHERE e <> 'D' GROUP BY m.c),
sums AS (
  SELECT c, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE fault = 'b') AS blank,
         count(*) FILTER (WHERE fault = 'd') AS duplicate, count(*) FILTER (WHERE fault = 't') AS truncated,
         count(*) FILTER (WHERE prev || ini NOT IN ('su', 'ua', 'au')) AS illegal
  FROM faults GROUP BY c)
SELECT conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
       CAST(coalesce(CAST(best[1:12] AS BIGINT), 0) AS BIGINT) AS cost, coalesce(best[13:], '') AS audit,
       sha256(coalesce(body, '')) AS repaired_sha256
FROM convs LEFT JOIN sums USING (c) LEFT JOIN best USING (c) LEFT JOIN fixed USING (c)"""

_OP13 = r"""
WITH h AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
w AS (
  SELECT doc_id, text, regexp_extract_all(text, '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS w,
         CAST('0x' || h[1:8] AS BIGINT) AS h1, CAST('0x' || h[9:16] AS BIGINT) AS h2,
         CAST('0x' || h[17:24] AS BIGINT) AS h3, CAST('0x' || h[25:32] AS BIGINT) AS h4 FROM h),
f AS (
  SELECT *, len(w) AS n, least(h1 % (len(w) + 1), h2 % (len(w) + 1)) AS a, greatest(h1 % (len(w) + 1), h2 % (len(w) + 1)) AS b,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 50 THEN 'plain'
              WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM w),
p AS (
  SELECT *, array_to_string(w[1:a], '') AS pre, array_to_string(w[a + 1:b], '') AS mid, array_to_string(w[b + 1:n], '') AS suf FROM f)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
       CASE WHEN form <> 'plain' THEN CAST(length(pre) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(mid) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
                        ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM p"""

ORACLE_SQL: dict[str, str] = {
    "op5_warc": _OP5,
    "op7_line_dedup": _OP7,
    "op8_decontam": _OP8,
    "op9_mixing": _OP9,
    "op10_embed_dedup": _OP10,
    "op11_conversation_repair": _OP11,
    "op13_fill_middle": _OP13,
}
