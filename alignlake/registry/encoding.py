"""Registered queries over tokens: vocabulary, encoding, loss masks, batches, processed checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from alignlake.operators import normalize, reports, sampling, tokens, validate
from alignlake.plans import jobs
from alignlake.registry import views as V
from alignlake.registry.preferences import pref_pairs
from alignlake.session import written

LENGTH, VOCABULARY_SIZE = 2048, 32_000
BATCH = 8
B = V.ROWS_PER_BUCKET


def _ids(column: str):
    return F.array_join(F.col(column).cast("array<string>"), " ")


def _matrix(column: str):
    rows = F.transform(column, lambda r: F.array_join(r.cast("array<string>"), " "))
    return F.array_join(rows, "|").alias(column)


def _chats(spark, sf):
    df = V.chats(spark, sf)
    return jobs.process_chats(df, jobs.vocabulary_of(df, "chat", VOCABULARY_SIZE), LENGTH)


def _preferences(spark, sf):
    df = V.pairs(spark, sf)
    return jobs.process_preferences(df, jobs.vocabulary_of(df, "preference", VOCABULARY_SIZE), LENGTH)


def _vocabulary(df):
    return written(tokens.vocabulary(df, size=VOCABULARY_SIZE), "vocabulary")


def vocab_topk(spark, sf):
    return tokens.vocabulary(V.documents(spark, sf), size=500)


def token_counts(spark, sf):
    return tokens.token_counts(V.documents(spark, sf)).groupBy("occurrences").agg(F.count("*").alias("tokens"))


def encode_docs(spark, sf):
    docs = V.documents(spark, sf).select("doc_id", "text")
    encoded = tokens.tokenized(docs, _vocabulary(docs))
    return encoded.select("doc_id", F.size("input_ids").alias("token_count"), _ids("input_ids").alias("ids"),
                          F.aggregate("attention_mask", F.lit(0), lambda a, m: a + m).alias("mask_sum"))


def encode_docs_joined(spark, sf):
    """Every token of the corpus has an id, met by a join; the most frequent ones are looked up."""
    docs = V.documents(spark, sf).select("doc_id", "text")
    vocab = written(tokens.numbered_vocabulary(docs, rows_per_bucket=B), "vocabulary")
    encoded = tokens.tokenized(docs, vocab, joined_on=["doc_id"])
    return encoded.select("doc_id", F.size("input_ids").alias("token_count"), _ids("input_ids").alias("ids"))


def chat_loss_mask(spark, sf):
    return _chats(spark, sf).select("conv_id", "token_count", _ids("input_ids").alias("ids"), _ids("labels").alias("labels"))


def heading_loss_mask(spark, sf):
    docs = V.documents(spark, sf).selectExpr(
        "doc_id", """CASE doc_id % 4 WHEN 0 THEN concat('Question? Answer: ', text)
          WHEN 1 THEN concat('Output: x. Response: ', text) WHEN 2 THEN concat('<|user|> ', text) ELSE text END AS text""")
    encoded = tokens.tokenized(docs, _vocabulary(docs))
    labels = tokens.with_labels(encoded)
    kept = F.filter("labels", lambda v: v != tokens.MASKED)
    return labels.select("doc_id", F.size("labels").alias("token_count"), F.size(kept).alias("kept"),
                         F.aggregate(kept, F.lit(0).cast("bigint"), lambda a, v: a + v).alias("kept_sum"))


def chat_reject_reasons(spark, sf):
    df = V.odd_chats(spark, sf)
    return V.rounded(reports.reason_counts(jobs.process_chats(df, jobs.vocabulary_of(df, "chat", VOCABULARY_SIZE), LENGTH)))


def processed_pairs(spark, sf):
    done = validate.successful(_preferences(spark, sf))
    return done.select("pair_id", "chosen_length", "rejected_length", "chosen_token_count", "rejected_token_count",
                       _ids("chosen_input_ids").alias("chosen_ids"), _ids("rejected_input_ids").alias("rejected_ids"))


def batch_numbers(spark, sf):
    return tokens.with_batch(V.table(spark, sf, "events").select("event_id"), "event_id", 100, rows_per_bucket=B)


def padded_batches(spark, sf):
    rows = tokens.with_batch(written(validate.successful(_chats(spark, sf)), "chats"), "conv_id", BATCH, rows_per_bucket=B)
    batches = tokens.collate(rows)
    return batches.select("batch_id", "batch_rows", _matrix("input_ids"), _matrix("attention_mask"), _matrix("labels"))


def pref_padded_batches(spark, sf):
    rows = tokens.with_batch(written(validate.successful(_preferences(spark, sf)), "pairs"), "pair_id", BATCH, rows_per_bucket=B)
    batches = tokens.collate(rows)
    return batches.select("batch_id", "batch_rows", _matrix("chosen_input_ids"), _matrix("rejected_attention_mask"))


def token_length_stats(spark, sf):
    docs = V.documents(spark, sf).select("text")
    counted = docs.withColumn("input_ids", tokens.text.tokens(F.col("text")))
    return V.rounded(reports.token_length_stats(counted))


def text_lengths(spark, sf):
    return V.rounded(reports.text_lengths(V.documents(spark, sf)))


def sampled_text_lengths(spark, sf):
    docs = V.documents(spark, sf).select("doc_id", "text")
    return V.rounded(reports.text_lengths(sampling.seeded_sample(docs, "doc_id", 1000)))


def text_quality_report(spark, sf):
    done = validate.successful(_preferences(spark, sf))
    return V.rounded(reports.text_quality_report(done, ["chosen_text", "rejected_text"]))


def _planted_chats(spark, sf):
    return _chats(spark, sf).withColumn(
        "input_ids", F.when(F.col("conv_id") % 7 == 2, F.transform("input_ids", lambda x: -x)).otherwise(F.col("input_ids"))
    ).withColumn(
        "attention_mask", F.when(F.col("conv_id") % 7 == 3, F.transform("attention_mask", lambda x: x + 1))
        .when(F.col("conv_id") % 7 == 4, F.slice("attention_mask", 1, 2)).otherwise(F.col("attention_mask"))
    ).withColumn("labels", F.when(F.col("conv_id") % 7 == 5, F.array().cast("array<int>"))
                 .when(F.col("conv_id") % 7 == 6, F.transform("labels", lambda x: F.lit(-100))).otherwise(F.col("labels")))


def processed_chat_checks(spark, sf):
    checked = validate.check_processed_chat(_planted_chats(spark, sf).drop("reason"), LENGTH)
    return checked.select("conv_id", F.array_join("errors", ",").alias("errors"),
                          F.array_join("warnings", ",").alias("warnings"))


def processed_pref_checks(spark, sf):
    checked = validate.check_processed_preference(_preferences(spark, sf), LENGTH)
    return checked.select("pair_id", F.array_join("errors", ",").alias("errors"),
                          F.array_join("warnings", ",").alias("warnings"))


def format_gate(spark, sf):
    done = validate.successful(_chats(spark, sf))
    return validate.format_gate(done, "chat", LENGTH, "conv_id", rows_per_bucket=B)


def failing_format_gate(spark, sf):
    return validate.format_gate(_planted_chats(spark, sf).drop("reason"), "chat", LENGTH, "conv_id", rows_per_bucket=B)


def _planted_arrays(spark, sf):
    """Documents with arrays of which some are missing, empty or too short."""
    at, size = F.col("doc_id") % 7, (F.col("doc_id") % 4 + 3).cast("int")
    ids = F.when(at == 2, F.array().cast("array<int>")).when(at != 1, F.sequence(F.lit(1), size))
    return V.documents(spark, sf).select(
        "doc_id", ids.alias("input_ids"), F.array_repeat(F.lit(1), size - F.when(at == 3, 1).otherwise(0)).alias("attention_mask"),
        ids.alias("labels"))


def required_fields(spark, sf):
    df = _planted_arrays(spark, sf)
    return df.select("doc_id", validate.processed_row_ok(df, "chat").alias("complete"),
                     validate.has_fields(df, ["input_ids", "absent"]).alias("has_absent"))


def stage_gates(spark, sf):
    """Every stage gate on tables whose first row is complete, has empty arrays, or that have no rows or columns."""
    df = _planted_arrays(spark, sf)
    pairs = df.select("doc_id", *[F.col(c).alias(f"{side}_{c}") for side in ("chosen", "rejected") for c in ("input_ids", "attention_mask")])
    tables = {"complete": (df.filter("doc_id % 7 = 0"), pairs.filter("doc_id % 7 = 0")), "empty_arrays": (df.filter("doc_id % 7 = 2"), pairs.filter("doc_id % 7 = 2")),
              "no_rows": (df.filter("doc_id < 0"), pairs.filter("doc_id < 0")), "no_columns": (df.select("doc_id"), pairs.select("doc_id"))}
    rows = [(name, stage, validate.stage_input_ok(both[stage == "preference"], stage, "doc_id"))
            for name, both in tables.items() for stage in ("chat", "preference", "prompts")]
    return spark.createDataFrame(rows, "input string, stage string, passed boolean")


def sampled_format_gate(spark, sf):
    done = written(validate.successful(_preferences(spark, sf)), "pairs")
    return validate.format_gate(done, "preference", LENGTH, "pair_id", sample=100, rows_per_bucket=B)


def prepared_chats(spark, sf):
    done = jobs.prepare_table(V.chats(spark, sf), "chat", "conv_id", LENGTH, VOCABULARY_SIZE)
    return done.select("conv_id", "original_length", "token_count")


def prepared_simple(spark, sf):
    kept, _ = jobs.prepare_simple(V.chats(spark, sf))
    return kept.select("conv_id", "length")


def preference_training_split(spark, sf):
    return jobs.preference_training_split(V.pairs(spark, sf), "pair_id", LENGTH, VOCABULARY_SIZE).select("pair_id", "split")


def prompt_set(spark, sf):
    chats = normalize.rendered(V.chats(spark, sf)).select("conv_id", "text")
    found = jobs.prompt_set(chats, ["conv_id"], _vocabulary(chats), LENGTH)
    return found.select("conv_id", "prompt", _ids("input_ids").alias("ids"))


def rejected_pair_texts(spark, sf):
    bad = pref_pairs(spark, sf).filter(validate.preference_text_reason().isNotNull())
    return bad.select("pair_id", F.length("prompt").alias("prompt_length"))


QUERIES = {f.__name__: f for f in (
    vocab_topk, token_counts, encode_docs, encode_docs_joined, chat_loss_mask, heading_loss_mask, chat_reject_reasons, processed_pairs,
    batch_numbers, padded_batches, pref_padded_batches, token_length_stats, text_lengths, sampled_text_lengths,
    text_quality_report, processed_chat_checks, processed_pref_checks, format_gate, failing_format_gate, required_fields, stage_gates, sampled_format_gate,
    prepared_chats, prepared_simple, preference_training_split, prompt_set, rejected_pair_texts)}

_MARKERS = "('<|system|>', '<|user|>', '<|assistant|>', '<|end|>')"


def _vocab(source: str, size: int, columns: tuple[str, ...] = ("text",)) -> str:
    lists = " UNION ALL ".join(f"SELECT unnest({V.sql_tokens(c)}) AS token FROM {source}" for c in columns)
    reserved = ", ".join(f"({V.q(t)}, {n})" for n, t in enumerate(tokens.RESERVED))
    return f"""words AS (SELECT token, count(*) AS c FROM ({lists}) WHERE token NOT IN {_MARKERS} GROUP BY token),
    vocab AS (
      SELECT token, CAST(row_number() OVER (ORDER BY c DESC, token) + {len(tokens.RESERVED) - 1} AS INT) AS token_id
      FROM words QUALIFY row_number() OVER (ORDER BY c DESC, token) <= {size}
      UNION ALL SELECT * FROM (VALUES {reserved}))"""


def _encoded(name: str, source: str, key: str, column: str, length: int | None = None) -> str:
    """One row per token, or per kept token: key, pos (from 0), token, token_id."""
    return f"""{name}_split AS (SELECT {key}, {V.sql_tokens(column)} AS toks FROM {source}),
    {name} AS (
      SELECT s.{key}, s.pos, s.token, coalesce(v.token_id, 1) AS token_id
      FROM (SELECT {key}, unnest(toks) AS token, unnest(range(len(toks))) AS pos FROM {name}_split) s
      LEFT JOIN vocab v ON s.token = v.token{f' WHERE s.pos < {length}' if length else ''})"""


_SPANS = """last_value(CASE WHEN token IN ('<|assistant|>', '<|end|>') THEN token END IGNORE NULLS)
  OVER (PARTITION BY {key} ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"""
_CHAT_TOKENS = f"""{V.SQL_CHATS}, {_vocab('chats', VOCABULARY_SIZE)},
  {_encoded('ct', 'chats', 'conv_id', 'text', LENGTH)},
  labelled AS (SELECT conv_id, pos, token_id, CASE WHEN marked THEN
        CASE WHEN token <> '<|end|>' AND before = '<|assistant|>' THEN token_id ELSE -100 END
        WHEN pos >= length_kept // 2 THEN token_id ELSE -100 END AS label
    FROM (SELECT ct.*, contains(chats.text, '<|assistant|>') AS marked, {_SPANS.format(key='conv_id')} AS before,
            count(*) OVER (PARTITION BY conv_id) AS length_kept FROM ct JOIN chats USING (conv_id))),
  chat_rows AS (SELECT conv_id, count(*) AS n, string_agg(token_id, ' ' ORDER BY pos) AS ids,
      string_agg(label, ' ' ORDER BY pos) AS labels, count(*) FILTER (label <> -100) AS kept
    FROM labelled GROUP BY conv_id)"""
_PAIR_TEXTS = f"""{V.SQL_PAIRS},
  texts AS (SELECT *, {V.sql_pair('prompt', 'chosen')} AS chosen_text, {V.sql_pair('prompt', 'rejected')} AS rejected_text
    FROM pairs)"""
_PAIR_TOKENS = f"""{_PAIR_TEXTS}, {_vocab('texts', VOCABULARY_SIZE, ('chosen_text', 'rejected_text'))},
  {_encoded('ch', 'texts', 'pair_id', 'chosen_text', LENGTH)}, {_encoded('rj', 'texts', 'pair_id', 'rejected_text', LENGTH)},
  chs AS (SELECT pair_id, count(*) AS n, string_agg(token_id, ' ' ORDER BY pos) AS ids FROM ch GROUP BY pair_id),
  rjs AS (SELECT pair_id, count(*) AS n, string_agg(token_id, ' ' ORDER BY pos) AS ids FROM rj GROUP BY pair_id),
  good AS (SELECT t.*, c.n AS cn, c.ids AS cids, r.n AS rn, r.ids AS rids
    FROM texts t JOIN chs c USING (pair_id) JOIN rjs r USING (pair_id)
    WHERE {V.SQL_PAIR_REASON} IS NULL AND c.n >= 3 AND r.n >= 3)"""


def _pad(ids: str, n: str, fill: str) -> str:
    return f"string_agg(concat({ids}, repeat(' {fill}', CAST(width - {n} AS INT))), '|' ORDER BY pos)"


_TEXT_NOTE = "CASE WHEN {0} = '' THEN 'blank_{1}' WHEN {2} THEN 'harmful_{1}' END"

ORACLES = {
    "vocab_topk": f"WITH {_vocab('documents', 500)} SELECT token, token_id FROM vocab",
    "token_counts": f"""WITH {_vocab('documents', 1)} SELECT c AS occurrences, count(*) AS tokens FROM words GROUP BY c""",
    "encode_docs": f"""WITH {_vocab('documents', VOCABULARY_SIZE)}, {_encoded('e', 'documents', 'doc_id', 'text')}
      SELECT d.doc_id, CAST(count(e.pos) AS INT) AS token_count, CAST(count(e.pos) AS INT) AS mask_sum,
        coalesce(string_agg(e.token_id, ' ' ORDER BY e.pos), '') AS ids
      FROM documents d LEFT JOIN e USING (doc_id) GROUP BY d.doc_id""",
    "encode_docs_joined": f"""WITH {_vocab('documents', 10 ** 12)}, {_encoded('e', 'documents', 'doc_id', 'text')}
      SELECT d.doc_id, CAST(count(e.pos) AS INT) AS token_count, coalesce(string_agg(e.token_id, ' ' ORDER BY e.pos), '') AS ids
      FROM documents d LEFT JOIN e USING (doc_id) GROUP BY d.doc_id""",
    "chat_loss_mask": f"WITH {_CHAT_TOKENS} SELECT conv_id, CAST(n AS INT) AS token_count, ids, labels FROM chat_rows",
    "heading_loss_mask": f"""WITH docs AS (SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN concat('Question? Answer: ', text)
          WHEN 1 THEN concat('Output: x. Response: ', text) WHEN 2 THEN concat('<|user|> ', text) ELSE text END AS text
        FROM documents), {_vocab('docs', VOCABULARY_SIZE)}, {_encoded('e', 'docs', 'doc_id', 'text')},
      nxt AS (SELECT *, lead(token) OVER (PARTITION BY doc_id ORDER BY pos) AS nt FROM e),
      starts AS (SELECT doc_id, count(*) AS n, coalesce(
          min(pos) FILTER (token = 'Response' AND nt = ':') + 2, min(pos) FILTER (token = 'Answer' AND nt = ':') + 2,
          min(pos) FILTER (token = 'Output' AND nt = ':') + 2, min(pos) FILTER (token = 'Assistant' AND nt = ':') + 2,
          count(*) // 2) AS start FROM nxt GROUP BY doc_id)
      SELECT d.doc_id, CAST(coalesce(max(s.n), 0) AS INT) AS token_count,
        CAST(count(*) FILTER (e.pos >= s.start) AS INT) AS kept,
        CAST(coalesce(sum(e.token_id) FILTER (e.pos >= s.start), 0) AS BIGINT) AS kept_sum
      FROM docs d LEFT JOIN e USING (doc_id) LEFT JOIN starts s USING (doc_id) GROUP BY d.doc_id""",
    "chat_reject_reasons": f"""WITH {V.SQL_ODD_TURNS},
      chats AS (SELECT conv_id, bool_or(role = 'tool') AS bad,
        string_agg({V.sql_render('role', 'text')}, chr(10) ORDER BY i) AS text FROM odd_turns GROUP BY conv_id),
      r AS (SELECT CASE WHEN bad THEN 'invalid_structure' WHEN len({V.sql_tokens('text')}) < 3 THEN 'invalid_tokenization'
        ELSE 'successful' END AS reason FROM chats)
      SELECT reason, count(*) AS rows, round(count(*) / (SELECT count(*) FROM r), 6) AS share,
        reason = 'successful' AS is_success FROM r GROUP BY reason""",
    "processed_pairs": f"""WITH {_PAIR_TOKENS} SELECT pair_id, length(chosen_text) AS chosen_length,
      length(rejected_text) AS rejected_length, CAST(cn AS INT) AS chosen_token_count,
      CAST(rn AS INT) AS rejected_token_count, cids AS chosen_ids, rids AS rejected_ids FROM good""",
    "batch_numbers": """SELECT event_id, (row_number() OVER (ORDER BY event_id) - 1) // 100 AS batch_id,
      CAST((row_number() OVER (ORDER BY event_id) - 1) % 100 AS INT) AS batch_pos FROM events""",
    "padded_batches": f"""WITH {_CHAT_TOKENS},
      b AS (SELECT *, (row_number() OVER (ORDER BY conv_id) - 1) // {BATCH} AS batch_id, conv_id AS pos FROM chat_rows
            WHERE n >= 3),
      w AS (SELECT *, max(n) OVER (PARTITION BY batch_id) AS width,
              concat('1', repeat(' 1', CAST(n - 1 AS INT))) AS mask FROM b)
      SELECT batch_id, CAST(count(*) AS INT) AS batch_rows, {_pad('ids', 'n', '0')} AS input_ids,
        {_pad('mask', 'n', '0')} AS attention_mask, {_pad('labels', 'n', '-100')} AS labels FROM w GROUP BY batch_id""",
    "pref_padded_batches": f"""WITH {_PAIR_TOKENS},
      b AS (SELECT *, (row_number() OVER (ORDER BY pair_id) - 1) // {BATCH} AS batch_id, pair_id AS pos FROM good),
      w AS (SELECT *, max(cn) OVER (PARTITION BY batch_id) AS width, max(rn) OVER (PARTITION BY batch_id) AS rwidth,
              concat('1', repeat(' 1', CAST(rn - 1 AS INT))) AS mask FROM b)
      SELECT batch_id, CAST(count(*) AS INT) AS batch_rows, {_pad('cids', 'cn', '0')} AS chosen_input_ids,
        {_pad('mask', 'rn', '0').replace('width', 'rwidth')} AS rejected_attention_mask FROM w GROUP BY batch_id""",
    "token_length_stats": f"""WITH l AS (
        SELECT 'tokens' AS measure, CAST(len({V.sql_tokens('text')}) AS INT) AS length FROM documents
        UNION ALL SELECT 'characters', CAST(length(text) AS INT) FROM documents),
      r AS (SELECT *, row_number() OVER (PARTITION BY measure ORDER BY length) - 1 AS i,
              count(*) OVER (PARTITION BY measure) AS n FROM l)
      SELECT measure, count(*) AS rows, min(length) AS min, max(length) AS max, round(avg(length), 6) AS mean,
        round(stddev_samp(length), 6) AS std, CAST(max(length) FILTER (i = n // 2) AS DOUBLE) AS median
      FROM r GROUP BY measure""",
    "text_lengths": f"""WITH l AS (SELECT length(text) AS c, CAST(len({V.sql_tokens('text')}) AS INT) AS t FROM documents)
      SELECT count(*) AS num_rows, round(avg(c), 6) AS avg_text_length, max(c) AS max_text_length,
        min(c) AS min_text_length, round(avg(t), 6) AS avg_token_length, max(t) AS max_token_length,
        min(t) AS min_token_length FROM l""",
    "sampled_text_lengths": f"""WITH s AS (SELECT text FROM documents
        ORDER BY CAST(concat('0x', substr(md5(concat('42|', doc_id)), 1, 15)) AS BIGINT), doc_id LIMIT 1000),
      l AS (SELECT length(text) AS c, CAST(len({V.sql_tokens('text')}) AS INT) AS t FROM s)
      SELECT count(*) AS num_rows, round(avg(c), 6) AS avg_text_length, max(c) AS max_text_length,
        min(c) AS min_text_length, round(avg(t), 6) AS avg_token_length, max(t) AS max_token_length,
        min(t) AS min_token_length FROM l""",
    "text_quality_report": f"""WITH {_PAIR_TOKENS},
      t AS (SELECT chosen_text AS text FROM good UNION ALL SELECT rejected_text FROM good),
      s AS (SELECT text, {V.sql_quality('text')} AS quality FROM t)
      SELECT count(*) AS texts, round(avg(length(text)), 6) AS avg_text_length, round(avg(quality), 6) AS avg_quality,
        round(min(quality), 6) AS min_quality, round(max(quality), 6) AS max_quality,
        count(*) FILTER (quality >= 0.8) AS excellent_rows,
        count(*) FILTER (quality >= 0.6 AND quality < 0.8) AS good_rows,
        count(*) FILTER (quality >= 0.4 AND quality < 0.6) AS fair_rows,
        count(*) FILTER (quality < 0.4) AS poor_rows FROM s""",
    "processed_chat_checks": f"""WITH {_CHAT_TOKENS},
      r AS (SELECT c.*, t.text FROM chat_rows c JOIN chats t USING (conv_id)),
      e AS (SELECT *, CASE conv_id % 7 WHEN 5 THEN 'empty_labels' ELSE concat_ws(',',
          CASE WHEN conv_id % 7 = 4 AND n <> 2 THEN 'unequal_lengths' END, CASE WHEN n < 3 THEN 'short_sequence' END,
          CASE WHEN conv_id % 7 = 2 THEN 'negative_input_ids' END,
          CASE WHEN conv_id % 7 = 3 THEN 'bad_attention_mask' END) END AS errors FROM r)
      SELECT conv_id, errors, CASE WHEN conv_id % 7 = 5 THEN '' ELSE concat_ws(',',
          CASE WHEN conv_id % 7 = 2 AND kept > 0 THEN 'foreign_labels' END,
          CASE WHEN conv_id % 7 = 6 OR kept = 0 THEN 'all_masked' WHEN kept = n THEN 'none_masked' END,
          CASE WHEN {V.sql_harmful('text')} THEN 'harmful_text' END) END AS warnings FROM e""",
    "processed_pref_checks": f"""WITH {_PAIR_TOKENS}
      SELECT t.pair_id, concat_ws(',', CASE WHEN c.n < 3 THEN 'short_chosen' END,
          CASE WHEN r.n < 3 THEN 'short_rejected' END) AS errors,
        concat_ws(',', {_TEXT_NOTE.format('chosen_text', 'chosen_text', V.sql_harmful('chosen_text'))},
          {_TEXT_NOTE.format('rejected_text', 'rejected_text', V.sql_harmful('rejected_text'))},
          {_TEXT_NOTE.format('prompt', 'prompt', V.sql_harmful('prompt'))},
          CASE WHEN chosen_text = rejected_text THEN 'identical' END) AS warnings
      FROM texts t JOIN chs c USING (pair_id) JOIN rjs r USING (pair_id)""",
    "format_gate": f"""WITH {_CHAT_TOKENS},
      w AS (SELECT c.kept = 0 OR c.kept = c.n OR {V.sql_harmful('t.text')} AS noted
            FROM chat_rows c JOIN chats t USING (conv_id) WHERE c.n >= 3)
      SELECT count(*) AS checked, 0 AS with_errors, count(*) FILTER (noted) AS with_warnings,
        count(*) > 0 AS passed FROM w""".replace("0 AS with_errors", "CAST(0 AS BIGINT) AS with_errors"),
    "sampled_format_gate": f"""WITH {_PAIR_TOKENS},
      i AS (SELECT *, row_number() OVER (ORDER BY pair_id) - 1 AS r, greatest(1, count(*) OVER () // 100) AS step FROM good),
      s AS (SELECT * FROM i WHERE r % step = 0 AND r < step * 100)
      SELECT count(*) AS checked, CAST(0 AS BIGINT) AS with_errors,
        count(*) FILTER ({V.sql_harmful('chosen_text')} OR {V.sql_harmful('rejected_text')}) AS with_warnings,
        count(*) > 0 AS passed FROM s""",
    "prepared_chats": f"""WITH {_CHAT_TOKENS}
      SELECT conv_id, length(text) AS original_length, CAST(n AS INT) AS token_count
      FROM chat_rows JOIN chats USING (conv_id) WHERE n >= 3 AND NOT {V.sql_harmful('text')}""",
    "prepared_simple": f"WITH {V.SQL_CHATS} SELECT conv_id, length(text) AS length FROM chats WHERE length(text) <= 2048",
    "preference_training_split": f"""WITH {_PAIR_TOKENS},
      i AS (SELECT pair_id FROM good)
      SELECT pair_id, CASE WHEN CAST(concat('0x', substr(md5(concat('42|', pair_id)), 1, 15)) AS BIGINT) % 100 < 80
        THEN 'train' ELSE 'eval' END AS split FROM i""",
    "prompt_set": f"""WITH {V.SQL_CHATS}, {_vocab('chats', VOCABULARY_SIZE)},
      p AS (SELECT conv_id, {V.sql_strip('text')} AS prompt FROM (
        SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS r FROM conversations WHERE role = 'user')
        WHERE r = 1 AND text <> ''),
      {_encoded('e', 'p', 'conv_id', 'prompt', LENGTH // 2)}
      SELECT p.conv_id, p.prompt, coalesce(string_agg(e.token_id, ' ' ORDER BY e.pos), '') AS ids
      FROM p LEFT JOIN e USING (conv_id) GROUP BY p.conv_id, p.prompt""",
    "rejected_pair_texts": f"""WITH {V.SQL_PAIRS} SELECT pair_id, length(prompt) AS prompt_length FROM pairs
      WHERE {V.SQL_PAIR_REASON} IS NOT NULL""",
}
ORACLES |= {
    "failing_format_gate": f"""WITH c AS ({ORACLES['processed_chat_checks']}) SELECT count(*) AS checked,
      count(*) FILTER (errors <> '') AS with_errors, count(*) FILTER (warnings <> '') AS with_warnings, false AS passed FROM c""",
    "required_fields": "SELECT doc_id, doc_id % 7 NOT IN (1, 2, 3) AS complete, false AS has_absent FROM documents",
    "stage_gates": """SELECT i.input, s.stage, CASE WHEN i.input = 'complete' THEN n > 0
        WHEN i.input = 'empty_arrays' THEN n > 0 AND s.stage = 'prompts' ELSE false END AS passed
      FROM (VALUES ('complete', 0), ('empty_arrays', 2), ('no_rows', -1), ('no_columns', -1)) i(input, r),
        (VALUES ('chat'), ('preference'), ('prompts')) s(stage),
        LATERAL (SELECT count(*) AS n FROM documents WHERE doc_id % 7 = i.r)""",
}
