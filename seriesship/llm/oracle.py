"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from seriesship.llm.queries import SHARDS, SLOTS

_SHARDS = ", ".join(f"({i}, '{s}')" for i, s in enumerate(SHARDS))

ORACLE: dict[str, str] = {
    "op4_place_documents": f"""
WITH RECURSIVE shards AS (
  SELECT k, shard, ('0x' || substr(md5('offset ' || shard), 1, 15))::BIGINT % {SLOTS} AS spot,
         ('0x' || substr(md5('skip ' || shard), 1, 15))::BIGINT % {SLOTS - 1} + 1 AS step
  FROM (VALUES {_SHARDS}) AS v(k, shard)),
fill AS (
  SELECT 0 AS turn, list_transform(range(0, {SLOTS}), lambda x: -1) AS owner
  UNION ALL
  SELECT turn + 1,
         list_transform(owner, lambda x, i: CASE WHEN i - 1 = slot THEN turn % {len(SHARDS)} ELSE x END)
  FROM (SELECT turn, owner,
               list_filter(list_transform(range(0, {SLOTS}), lambda j: (spot + j * step) % {SLOTS}),
                           lambda p: owner[p + 1] = -1)[1] AS slot
        FROM fill JOIN shards ON shards.k = turn % {len(SHARDS)}
        WHERE turn < {SLOTS})),
lookup AS (
  SELECT unnest(range(0, {SLOTS})) AS slot, unnest(owner) AS k FROM fill WHERE turn = {SLOTS}),
placed AS (
  SELECT doc_id, ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT % {SLOTS} AS slot FROM documents)
SELECT doc_id, slot, shard FROM placed JOIN lookup USING (slot) JOIN shards USING (k)
""",
}
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
ORACLE["op6_winnow_benchmark"] = rf"""
WITH doc_words AS (
  SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
item_words AS (
  SELECT item_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(len(w), 13) AS n,
         unnest(list_transform(range(1, len(w) - least(len(w), 13) + 2),
                               lambda i: array_to_string(w[i:i + least(len(w), 13) - 1], ' '))) AS gram
  FROM item_words WHERE len(w) > 0),
sizes AS (SELECT DISTINCT n FROM windows),
grams AS (
  SELECT doc_id, n, unnest(range(1, len(w) - n + 2)) AS i,
         unnest(list_transform(range(1, len(w) - n + 2), lambda i: array_to_string(w[i:i + n - 1], ' '))) AS gram
  FROM doc_words, sizes WHERE len(w) >= n),
hits AS (SELECT doc_id, item_id, i, n FROM grams JOIN windows USING (n, gram)),
covered AS (SELECT doc_id, count(DISTINCT p) AS n_hit
            FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id),
found AS (SELECT doc_id, count(DISTINCT item_id) AS n_items,
                 string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids
          FROM hits GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM doc_words LEFT JOIN covered USING (doc_id) LEFT JOIN found USING (doc_id)
"""
_MARK = "md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))"
#: CRC-32 of a decimal id, bit by bit (the polynomial and the start value are fixed).
_CRC = """xor(list_reduce(range(0, 8 * length(conv_id::VARCHAR)), lambda c, i:
    xor(xor(c, CASE WHEN i % 8 = 0 THEN ord((conv_id::VARCHAR)[i // 8 + 1])::BIGINT ELSE 0 END) >> 1,
        3988292384 * (xor(c, CASE WHEN i % 8 = 0 THEN ord((conv_id::VARCHAR)[i // 8 + 1])::BIGINT ELSE 0 END) & 1)),
    4294967295), 4294967295)"""
ORACLE["op12_prefix_trie"] = f"""
WITH own AS (
  SELECT conv_id, list(struct_pack(k := {_MARK}, b := strlen(coalesce(text, ''))::BIGINT)
                       ORDER BY turn NULLS FIRST, {_MARK}) AS turns
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
hashed AS (SELECT conv_id, turns, conv_id - conv_id % 5 AS base_id, {_CRC} % 9 AS h FROM own),
rebuilt AS (
  SELECT c.conv_id, list_concat(coalesce(b.turns, c.turns[1:0])[1:c.h], c.turns[c.h + 1:]) AS turns
  FROM hashed c LEFT JOIN own b ON b.conv_id = c.base_id),
steps AS (SELECT conv_id, turns, unnest(range(0, len(turns) + 1)) AS d FROM rebuilt),
pre AS (
  SELECT conv_id, d, len(turns) = d AS ended,
         md5(array_to_string(list_transform(turns[1:d], lambda x: x.k), '')) AS key,
         CASE WHEN d > 0 THEN md5(array_to_string(list_transform(turns[1:d - 1], lambda x: x.k), '')) END AS parent,
         CASE WHEN d > 0 THEN turns[d].b ELSE 0 END AS b
  FROM steps),
nodes AS (
  SELECT key, min(parent) AS parent, min(d) AS d, min(conv_id) AS conv_id, count(*) AS n, max(b) AS b,
         string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ended) AS ids
  FROM pre GROUP BY key),
kids AS (SELECT parent, count(*) AS k FROM nodes WHERE parent IS NOT NULL GROUP BY parent),
below AS (
  SELECT p.key, sum((x.n - 1) * x.b) AS saved, count(*) FILTER (k IS NULL) AS leaves
  FROM nodes x LEFT JOIN kids ON kids.parent = x.key JOIN pre p ON p.conv_id = x.conv_id AND p.d <= x.d
  GROUP BY p.key)
SELECT a.conv_id, a.d::BIGINT AS depth, u.conv_id AS parent_conv_id, a.n::BIGINT AS n_convs,
       coalesce(k, 0)::BIGINT AS n_children, leaves::BIGINT AS n_leaves, saved::BIGINT AS saved_tokens,
       sha256(coalesce(a.ids, '')) AS ends_sha256
FROM nodes a JOIN below ON below.key = a.key LEFT JOIN kids ON kids.parent = a.key LEFT JOIN nodes u ON u.key = a.parent
"""
