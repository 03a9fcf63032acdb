"""Registered queries of phrase mining, license scans and the conversation trie, with SQL where it can say them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from alignlake.llm import collocations, conversation_trie, license_scan
from alignlake.sources.readers import spread


def op11_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(spread(spark.read.parquet(f"{sf_dir}/documents.parquet").select("text", "lang")))


SQL_OP11 = r"""WITH t AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS x FROM documents),
  w AS (SELECT lang, regexp_extract_all(x, '[^\x20\x09]+') AS w FROM t),
  g AS (SELECT lang, w[i : i + k - 1] AS p FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM (
    SELECT lang, w, unnest([1, 2, 3, 4]) AS k FROM w) WHERE len(w) >= k)),
  f AS (SELECT lang, p, count(*) AS f FROM g GROUP BY lang, p),
  n AS (SELECT lang, sum(f) AS n FROM f WHERE len(p) = 1 GROUP BY lang),
  c AS (SELECT lang, p, f AS a FROM f WHERE len(p) > 1 AND f >= 30),
  s AS (SELECT lang, q AS p, max(a) AS around FROM (SELECT lang, a, p[i : i + k - 1] AS q FROM (
      SELECT lang, a, p, k, unnest(range(1, len(p) - k + 2)) AS i FROM (SELECT lang, a, p, unnest(range(2, len(p))) AS k FROM c WHERE len(p) > 2)))
    GROUP BY lang, q),
  d AS (SELECT c.* FROM c LEFT JOIN s ON s.lang = c.lang AND s.p = c.p WHERE s.around IS NULL OR 100 * s.around < 80 * c.a),
  k AS (SELECT lang, p, a, unnest(range(1, len(p))) AS k FROM d),
  o AS (SELECT k.*, x.f AS l, y.f AS r, CAST(k.a AS HUGEINT) * 2000000 // (x.f + y.f) AS score FROM k
    JOIN f x ON x.lang = k.lang AND x.p = k.p[1 : k.k] JOIN f y ON y.lang = k.lang AND y.p = k.p[k.k + 1 :]),
  b AS (SELECT lang, array_to_string(p, ' ') AS phrase, a, l, r, score FROM o QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, k) = 1)
SELECT b.lang, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r,
  CAST(n.n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM b JOIN n ON n.lang = b.lang QUALIFY rank <= 2000"""


def op12_license_diagonals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(spread(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")))


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie.prefix_trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


# the CRC-32 of a decimal id is folded byte by byte, then bit by bit
SQL_OP13 = r"""WITH t AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
      row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) - 1 AS pos
    FROM conversations WHERE conv_id IS NOT NULL),
  c AS (SELECT conv_id, conv_id - conv_id % 20 AS base, xor(list_reduce(
      list_concat([4294967295::BIGINT], list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
      lambda s, x: list_reduce(list_concat([xor(s, x)], [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
        lambda v, z: xor(v >> 1, (v & 1) * 3988292384::BIGINT))), 4294967295::BIGINT) % 4 AS h
    FROM (SELECT DISTINCT conv_id FROM t)),
  r AS (SELECT c.conv_id, 0 AS part, t.pos, t.role, t.text FROM c JOIN t ON t.conv_id = c.base AND t.pos < c.h
    UNION ALL SELECT c.conv_id, 1, t.pos, t.role, t.text FROM c JOIN t ON t.conv_id = c.conv_id AND t.pos >= c.h),
  s AS (SELECT conv_id, row_number() OVER w AS depth, md5(length(role) || ':' || role || text) AS m, text,
      string_agg(md5(length(role) || ':' || role || text), '') OVER w AS path FROM r
    WINDOW w AS (PARTITION BY conv_id ORDER BY part, pos ROWS UNBOUNDED PRECEDING)),
  p AS (SELECT conv_id, depth, md5(path) AS node, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS words FROM s
    UNION ALL SELECT conv_id, 0, '', 0 FROM c),
  e AS (SELECT conv_id, max_by(node, depth) AS node FROM p GROUP BY conv_id),
  n AS (SELECT node, depth, min(conv_id) AS first, count(*) AS n, max(words) AS words FROM p GROUP BY node, depth),
  l AS (SELECT n.*, u.node AS up FROM n LEFT JOIN p u ON u.conv_id = n.first AND u.depth = n.depth - 1),
  k AS (SELECT up AS node, count(*) AS n FROM l WHERE up IS NOT NULL GROUP BY up),
  b AS (SELECT p.node, sum((n.n - 1) * n.words) AS saved, count(*) FILTER (k.n IS NULL) AS leaves
    FROM n LEFT JOIN k ON k.node = n.node JOIN p ON p.conv_id = n.first AND p.depth <= n.depth GROUP BY p.node),
  d AS (SELECT node, sha256(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id)) AS h FROM e GROUP BY node)
SELECT l.first AS conv_id, l.depth, u.first AS parent_conv_id, l.n AS n_convs, coalesce(k.n, 0) AS n_children,
  b.leaves AS n_leaves, CAST(b.saved AS BIGINT) AS saved_tokens, coalesce(d.h, sha256('')) AS ends_sha256
FROM l LEFT JOIN n u ON u.node = l.up LEFT JOIN k ON k.node = l.node JOIN b ON b.node = l.node LEFT JOIN d ON d.node = l.node"""

QUERIES = {f.__name__: f for f in (op11_phrase_collocations, op12_license_diagonals, op13_conversation_trie)}
ORACLES = {"op11_phrase_collocations": SQL_OP11, "op13_conversation_trie": SQL_OP13}
