"""The registered queries: each operator over its whole table, with the SQL it must equal where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from alignlake.llm import corpus_queries, decontaminate, language_id, line_dedup, page_text, personal_data, piece_codec, quality_rules, secret_ledger, setsketch, token_files
from alignlake.sources.readers import spread


TOKENIZERS = "/opt/tokenizers"
END_OF_DOCUMENT = 1


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table; one that lies in fewer parts than there are cores is spread over them."""
    return spread(spark.read.parquet(f"{sf_dir}/{name}.parquet"))


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality_rules.apply_rules(docs).select(
        "doc_id", *quality_rules.BASE, "base_failed", "kept")


SQL_OP1 = r"""WITH d AS (SELECT doc_id, coalesce(text, '') AS t,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM documents),
  win AS (SELECT doc_id, i, concat_ws(' ', w[i], w[i + 1], w[i + 2]) AS g
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d WHERE len(w) >= 3)),
  twice AS (SELECT doc_id, i FROM win QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
  rep AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM twice) GROUP BY doc_id),
  m AS (SELECT d.doc_id, len(w) AS n_words, length(list_aggregate(w, 'string_agg', '')) AS chars,
      length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols, len(l) - len(list_distinct(l)) AS n_dup,
      len(l) AS n_lines, coalesce(rep.n, 0) AS n_rep, len(list_filter(w, lambda x: lower(x) IN (STOP))) AS n_stop,
      len(list_filter(l, lambda x: trim(x, SPACES)[1] IN ('-', '*', '•'))) AS n_bullet,
      len(list_filter(l, lambda x: trim(x, SPACES) LIKE '%...' OR trim(x, SPACES) LIKE '%…')) AS n_dots
    FROM d LEFT JOIN rep ON d.doc_id = rep.doc_id),
  v AS (SELECT *, n_words < 50 OR 100 * n_rep > 50 * n_words AS failed FROM m)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(coalesce(chars, 0) AS BIGINT) AS word_chars,
  CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup AS BIGINT) AS n_dup_lines, CAST(n_rep AS BIGINT) AS n_repeat_words,
  failed AS base_failed,
  NOT failed AND n_words BETWEEN 50 AND 1000000 AND chars / n_words BETWEEN 2 AND 12 AND n_symbols / n_words <= 0.1
    AND n_stop / n_words >= 0.06 AND n_dup / n_lines <= 0.5 AND n_bullet / n_lines <= 0.9 AND n_dots / n_lines <= 0.3 AS kept
FROM v""".replace("STOP", ", ".join(f"'{w}'" for w in quality_rules.STOP_WORDS)).replace(
    "SPACES", "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)")


def op2_skip_chain_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data.digest(personal_data.find(table(spark, sf_dir, "documents").select("doc_id", "text")))


def op3_byte_gru_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    names, model = language_id.fitted(docs, where=~language_id.held_out())
    return language_id.predict(docs.select("doc_id", "text"), names, model).select(
        "doc_id", language_id.held_out().alias("held_out"), "lang_pred", "score")


def op4_secret_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return secret_ledger.digest(secret_ledger.incremental_scan(docs))


def op5_token_files(spark: SparkSession, sf_dir: str, tokenizers: str = TOKENIZERS) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    manifest = token_files.write_tokens(docs, f"{tokenizers}/word_bpe_49k.json", END_OF_DOCUMENT)
    return token_files.read_tokens(manifest, token_files.ids_crc32, "ids_crc32 bigint")


def op6_line_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.without_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"), alone=line_dedup.ALONE)


SQL_OP6 = r"""WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS x, unnest(range(len(string_split(text, chr(10))))) AS pos FROM documents),
  w AS (SELECT doc_id, pos, x, lead(x) OVER o AS y, lead(pos) OVER o AS stop FROM l WHERE regexp_matches(x, '[^\x20\x09-\x0D]')
    WINDOW o AS (PARTITION BY doc_id ORDER BY pos)),
  r AS (SELECT doc_id, pos, stop FROM w WHERE stop IS NOT NULL QUALIFY row_number() OVER (PARTITION BY x, y ORDER BY doc_id, pos) > 1
    UNION ALL (SELECT doc_id, pos, pos AS stop FROM w WHERE len(regexp_extract_all(x, '[^\x20\x09-\x0D]+')) >= ALONE
      QUALIFY row_number() OVER (PARTITION BY x ORDER BY doc_id, pos) > 1)),
  g AS (SELECT DISTINCT doc_id, unnest(range(pos, stop + 1)) AS pos FROM r),
  k AS (SELECT l.doc_id, string_agg(l.x, chr(10) ORDER BY l.pos) FILTER (g.pos IS NULL) AS text, count(g.pos) AS n
    FROM l LEFT JOIN g ON l.doc_id = g.doc_id AND l.pos = g.pos GROUP BY l.doc_id)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(k.text, '') END AS text, coalesce(k.n, 0) AS n_deleted
FROM documents d LEFT JOIN k ON k.doc_id = d.doc_id""".replace("ALONE", str(line_dedup.ALONE))


def op7_piece_codec(spark: SparkSession, sf_dir: str, tokenizers: str = TOKENIZERS) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = piece_codec.with_pieces(docs, f"{tokenizers}/piece_bpe_32k.model")
    return coded.select(
        "doc_id", "piece_ids", F.size("piece_ids").cast("long").alias("n_pieces"),
        F.col("decoded").eqNullSafe(F.translate("text", "\u2581", " ")).alias("round_trip"))


def op8_setsketch_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return setsketch.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"), shingle=2)


SQL_OP8 = r"""WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
  s AS (SELECT DISTINCT doc_id, CASE WHEN len(w) = 1 THEN w[1] ELSE w[i] || ' ' || w[i + 1] END AS g
    FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w), 2))) AS i FROM w WHERE len(w) > 0)),
  n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
  k AS (SELECT doc_id, hash(g) AS g FROM s),
  p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM k x JOIN k y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY 1, 2),
  e AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
  r AS (SELECT doc_id, doc_id AS seen FROM documents UNION SELECT r.doc_id, e.b FROM r JOIN e ON e.a = r.seen),
  c AS (SELECT doc_id, min(seen) AS component_id FROM r GROUP BY doc_id)
SELECT c.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, component_id, c.doc_id = component_id AS kept
FROM c LEFT JOIN n ON n.doc_id = c.doc_id"""


def op9_spaced_seed_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.decontaminated(docs, table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", F.size("items").cast("long").alias("n_items"), F.array_join("items", ",").alias("items"), "kept")


SQL_OP9 = r"""WITH b AS (SELECT item_id, regexp_extract_all(lower(text), '[\p{L}\p{N}_]+') AS w FROM benchmark),
  d AS (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}_]+') AS w FROM documents),
  i AS (SELECT item_id, len(w) AS n, unnest(w) AS t, unnest(range(len(w))) AS q FROM b WHERE len(w) >= 8),
  x AS (SELECT doc_id, unnest(w) AS t, unnest(range(len(w))) AS p FROM d),
  m AS (SELECT doc_id, item_id, p - q AS diagonal, q, least(24, n) AS win, CASE WHEN n >= 12 THEN least(24, n) // 8 ELSE 0 END AS allowed
    FROM x JOIN i ON x.t = i.t),
  s AS (SELECT *, count(*) OVER (PARTITION BY doc_id, item_id, diagonal) AS c FROM m),
  k AS (SELECT doc_id, item_id, win, allowed,
      count(*) OVER (PARTITION BY doc_id, item_id, diagonal ORDER BY q RANGE BETWEEN win - 1 PRECEDING AND CURRENT ROW) AS same
    FROM s WHERE c >= win - allowed),
  f AS (SELECT DISTINCT doc_id, item_id FROM k WHERE same >= win - allowed),
  g AS (SELECT doc_id, count(*) AS n, string_agg(item_id, ',' ORDER BY item_id) AS items FROM f GROUP BY doc_id)
SELECT d.doc_id, coalesce(g.n, 0) AS n_items, coalesce(g.items, '') AS items, g.n IS NULL AS kept FROM documents d LEFT JOIN g ON d.doc_id = g.doc_id"""


def op10_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_text.extract(table(spark, sf_dir, "pages"))


QUERIES = {f.__name__: f for f in (op1_quality_rules, op2_skip_chain_pii, op3_byte_gru_language, op4_secret_ledger, op5_token_files, op6_line_winnowing, op7_piece_codec, op8_setsketch_near_dedup, op9_spaced_seed_decontamination, op10_page_text)} | corpus_queries.QUERIES
ORACLES = {"op1_quality_rules": SQL_OP1, "op6_line_winnowing": SQL_OP6, "op8_setsketch_near_dedup": SQL_OP8, "op9_spaced_seed_decontamination": SQL_OP9} | corpus_queries.ORACLES


def pipeline_queries() -> dict:
    import corpus_pipeline

    return {"pipeline": corpus_pipeline.run}


def pipeline_oracles() -> dict:
    import corpus_pipeline

    return {"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {}
