"""DuckDB SQL for the queries of this subpackage that SQL can express: numbers are written out here and not shared with the operators.

op12's CRC-32 is taken bit by bit. op3 needs XXH64 and CRC-32, op4 XXH64, op6 a vocabulary, op10 a page parser, op1, op2, op5, op8, op11 and op13 their automata, orders and models; these are
tested against brute force (tests/llm).
"""

from __future__ import annotations

OP9 = r"""
WITH sized AS (
  SELECT doc_id, source, CASE WHEN text IS NULL THEN 0 ELSE len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) END AS size,
         ('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15))::BIGINT AS k
  FROM documents
), per AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source
), weighed AS (
  SELECT source, source_size, (row_number() OVER (ORDER BY source NULLS LAST) - 1) AS place,
         CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 3.0::DOUBLE WHEN 1 THEN 1.0::DOUBLE ELSE 2.0::DOUBLE END AS w,
         2.0::DOUBLE * source_size AS cap
  FROM per
), leveled AS (
  SELECT *, cap / w AS filled_at,
         (1.5::DOUBLE * (SELECT sum(source_size) FROM per)
            - coalesce((SELECT sum(b.cap) FROM weighed b WHERE (b.cap / b.w, b.place) < (a.cap / a.w, a.place)), 0.0))
         / (SELECT sum(b.w) FROM weighed b WHERE (b.cap / b.w, b.place) >= (a.cap / a.w, a.place)) AS level
  FROM weighed a
), goal AS (
  SELECT source, source_size,
         least(cap, coalesce((SELECT max(level) FROM leveled WHERE level <= filled_at) * w, cap)) AS target
  FROM leveled
), plan AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(round(target) AS BIGINT) // source_size ELSE 0 END AS epochs FROM goal
), cut AS (
  SELECT *, CAST(round(target) AS BIGINT) - epochs * source_size AS rest FROM plan
), placed AS (
  SELECT s.doc_id, s.size, c.source_size, c.target, c.epochs, c.rest,
         coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.k, s.doc_id, s.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM sized s JOIN cut c ON s.source IS NOT DISTINCT FROM c.source
)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
       CAST(epochs * size + greatest(0, least(size, rest - before)) AS BIGINT) AS taken
FROM placed
"""

OP12 = r"""
WITH t AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) - 1 AS place, coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL
), ids AS (
  SELECT DISTINCT conv_id, conv_id - conv_id % 20 AS base, CAST(conv_id AS VARCHAR) AS s FROM t
), c AS (
  SELECT conv_id, base,
         xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, len(s) + 1), lambda i: ascii(substr(s, i::BIGINT, 1))::BIGINT)),
                         lambda crc, b: list_reduce(list_prepend(xor(crc, b), range(8)),
                                                    lambda y, z: CASE WHEN y & 1 = 1 THEN xor(y >> 1, 3988292384::BIGINT) ELSE y >> 1 END)),
             4294967295::BIGINT) % 4 AS h
  FROM ids
), r AS (
  SELECT c.conv_id, 0 AS part, t.place, t.role, t.text FROM c JOIN t ON t.conv_id = c.base AND t.place < c.h
  UNION ALL
  SELECT c.conv_id, 1, t.place, t.role, t.text FROM c JOIN t ON t.conv_id = c.conv_id AND t.place >= c.h
), p AS (
  SELECT conv_id, list(md5(role) || md5(text)) OVER (PARTITION BY conv_id ORDER BY part, place) AS k,
         len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS w
  FROM r
  UNION ALL
  SELECT conv_id, []::VARCHAR[], 0 FROM c
), n AS (
  SELECT k, len(k) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs, max(w) AS w FROM p GROUP BY k
), kids AS (
  SELECT k[1:depth - 1] AS k, count(*) AS n FROM n WHERE depth > 0 GROUP BY 1
), own AS (
  SELECT n.*, coalesce(kids.n, 0) AS n_children FROM n LEFT JOIN kids ON n.k = kids.k
), under AS (
  SELECT k[1:d] AS k, CAST(sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_leaves, CAST(sum((n_convs - 1) * w) AS BIGINT) AS saved_tokens
  FROM (SELECT *, unnest(range(0, depth + 1)) AS d FROM own) GROUP BY 1
), last AS (
  SELECT conv_id, max_by(k, len(k)) AS k FROM p GROUP BY conv_id
), ends AS (
  SELECT k, sha256(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id)) AS ends FROM last GROUP BY k
)
SELECT own.conv_id, CAST(own.depth AS BIGINT) AS depth, up.conv_id AS parent_conv_id, own.n_convs, CAST(own.n_children AS BIGINT) AS n_children,
       under.n_leaves, under.saved_tokens, coalesce(ends.ends, sha256('')) AS ends_sha256
FROM own JOIN under ON own.k = under.k LEFT JOIN n up ON own.depth > 0 AND up.k = own.k[1:own.depth - 1] LEFT JOIN ends ON own.k = ends.k
"""

ORACLES = {"op9_mixing": OP9, "op12_prefix_trie": OP12}
