"""Registered queries over documents and chats: quality, safety, structure, rendering, prompts."""

from __future__ import annotations

from pyspark.sql import functions as F

from alignlake.functions import chat, patterns
from alignlake.functions import text as T
from alignlake.operators import evaluation, normalize, ordering, quality, reports, sampling, validate
from alignlake.plans import jobs
from alignlake.registry import views as V

B = V.ROWS_PER_BUCKET


def chat_quality_bands(spark, sf):
    return V.rounded(jobs.quality_report(V.chats(spark, sf)))


def chat_render(spark, sf):
    return normalize.rendered(V.chats(spark, sf)).select("conv_id", "text", "length")


def chat_structure_warnings(spark, sf):
    checked = validate.check_messages(V.odd_chats(spark, sf))
    return checked.select("conv_id", "is_valid", F.array_join("warnings", ",").alias("warnings"))


def raw_chat_warnings(spark, sf):
    checked = validate.check_raw_chat(V.odd_chats(spark, sf))
    return checked.select("conv_id", "is_valid", F.array_join("warnings", ",").alias("warnings"))


def chat_validation_report(spark, sf):
    return V.rounded(reports.validation_report(V.odd_chats(spark, sf), "chat"))


def chat_content_filter(spark, sf):
    df = V.odd_chats(spark, sf)
    return V.rounded(validate.retention(df, validate.keep_chat(df)))


def kept_chats(spark, sf):
    return validate.filter_content(V.odd_chats(spark, sf), "chat").select("conv_id", F.size("messages").alias("turns"))


def flat_row_messages(spark, sf):
    flat = V.exchanges(spark, sf).selectExpr(
        "conv_id", "turn", "CASE WHEN conv_id % 2 = 0 THEN prompt END AS instruction",
        "CASE WHEN conv_id % 2 = 1 THEN prompt END AS question",
        "CASE WHEN conv_id % 5 = 0 THEN 'Be brief.' WHEN conv_id % 5 = 1 THEN '' END AS system",
        "CASE WHEN conv_id % 3 = 0 THEN response END AS output",
        "CASE WHEN conv_id % 3 = 1 THEN response END AS answer")
    return normalize.rendered(normalize.with_messages(flat)).select("conv_id", "turn", "text", "length")


def exchange_rows(spark, sf):
    return V.exchanges(spark, sf).select(
        "conv_id", "turn", chat.generation_prompt(F.col("prompt")).alias("generation_prompt"),
        F.length("prompt").alias("prompt_length"), F.length("response").alias("response_length"))


def text_preview(spark, sf):
    return V.documents(spark, sf).select("doc_id", T.preview(F.col("text")).alias("preview"))


def first_prompts(spark, sf):
    rendered = normalize.rendered(V.chats(spark, sf)).select("conv_id", "text")
    return normalize.first_prompts(rendered, ["conv_id"]).select("conv_id", "prompt")


def first_prompts_capped(spark, sf):
    rendered = normalize.rendered(V.chats(spark, sf)).select("conv_id", "text")
    return normalize.first_prompts(rendered, ["conv_id"], limit=50).select("conv_id", "prompt")


def first_prompts_from_messages(spark, sf):
    return normalize.first_prompts(V.chats(spark, sf), ["conv_id"]).select("conv_id", "prompt")


def all_prompts(spark, sf):
    found = normalize.all_prompts(V.chats(spark, sf), ["conv_id"])
    return found.select("conv_id", "position", "query")


def text_prompts(spark, sf):
    return normalize.all_prompts(V.documents(spark, sf).select("doc_id", "text"), ["doc_id"]).select("doc_id", "query")


def harmful_docs(spark, sf):
    return V.documents(spark, sf).filter(patterns.is_harmful(F.col("text"))).select("doc_id", "lang")


def safety_issues(spark, sf):
    issues = patterns.publishing_issues(F.col("response"))
    return V.responses(spark, sf).select(
        "doc_id", F.array_join(issues, ",").alias("issues"), (F.size(issues) == 0).alias("is_safe"))


def publishing_safety(spark, sf):
    return V.rounded(evaluation.publishing_safety(V.responses(spark, sf)))


def content_quality(spark, sf):
    scored = quality.with_quality(V.documents(spark, sf).select("doc_id", "text"), "text")
    return V.rounded(scored.select("doc_id", "quality", quality.band(F.col("quality")).alias("band")))


def quality_bands(spark, sf):
    return quality.band_counts(quality.with_quality(V.documents(spark, sf), "text"))


def quality_stats(spark, sf):
    return V.rounded(quality.quality_stats(quality.with_quality(V.documents(spark, sf), "text")))


def document_retention(spark, sf):
    return V.rounded(validate.retention(V.documents(spark, sf), ~patterns.is_harmful(F.col("text"))))


def length_filter_counts(spark, sf):
    df = V.documents(spark, sf).select(
        F.when(F.col("doc_id") % 23 == 0, F.lit(" ")).otherwise(F.col("text")).alias("text"),
        F.when(F.col("doc_id") % 19 != 0, F.array(chat.message("user", F.lit("x")))).alias("messages"))
    judged = validate.length_filter_reason(df.withColumn("length", F.length("text")), max_length=512)
    return V.rounded(reports.reason_counts(judged, good="valid_examples"))


def mixed_row_shapes(spark, sf):
    """Rows of four shapes in one table: two list columns, JSON text in a list's column, and flat fields."""
    chats = V.chats(spark, sf)
    kind = F.col("conv_id") % 4
    rows = chats.select(
        "conv_id", F.when(kind == 0, F.col("messages")).alias("conversations"),
        F.when(kind == 1, F.to_json("messages")).when(kind == 2, F.lit("plain words")).alias("conversation"),
        F.when(kind >= 2, F.lit("Say it")).alias("instruction"), F.when(kind == 3, F.lit("done")).alias("output"))
    return normalize.rendered(normalize.with_messages(rows, parse_json=True)).select("conv_id", "text")


def short_texts(spark, sf):
    return validate.short_text_warning(V.documents(spark, sf)).filter("short_text").select("doc_id")


def health_report(spark, sf):
    df = V.documents(spark, sf).selectExpr("doc_id", "concat(CASE WHEN doc_id % 5 = 0 THEN 'How to kill ' ELSE '' END, text) AS instruction", "text AS response")
    return reports.health_report(df)


def head_rows(spark, sf):
    return sampling.head(V.table(spark, sf, "documents"), ["doc_id"], 100).select("doc_id", "lang", "n_chars")


def stride_sample(spark, sf):
    return sampling.stride_sample(
        V.table(spark, sf, "events").select("event_id", "event_type"), "event_id", 700, rows_per_bucket=B)


def seeded_sample(spark, sf):
    return sampling.seeded_sample(V.table(spark, sf, "documents").select("doc_id", "lang"), "doc_id", 150)


def shuffle_positions(spark, sf):
    return sampling.with_shuffle_position(
        V.table(spark, sf, "events").select("event_id"), "event_id", rows_per_bucket=B)


def string_key_positions(spark, sf):
    """Row positions by a composite key with a text column."""
    docs = V.documents(spark, sf).select("doc_id", "lang", F.concat(F.lit("doc-"), "doc_id").alias("name"))
    placed = ordering.with_index(docs, ["lang", "name"], name="position", rows_per_bucket=B)
    return placed.select("doc_id", "position")


def first_findings(spark, sf):
    checked = validate.check_messages(V.odd_chats(spark, sf))
    return sampling.first_findings(checked, "warnings", ["conv_id"], rows=10)


QUERIES = {f.__name__: f for f in (
    chat_quality_bands, chat_render, chat_structure_warnings, raw_chat_warnings, chat_validation_report,
    chat_content_filter, kept_chats, flat_row_messages, exchange_rows, text_preview, first_prompts, first_prompts_capped,
    first_prompts_from_messages, all_prompts, text_prompts, harmful_docs, safety_issues, publishing_safety,
    content_quality, quality_bands, quality_stats, document_retention, length_filter_counts, short_texts,
    health_report, mixed_row_shapes, head_rows, stride_sample, seeded_sample, shuffle_positions, string_key_positions, first_findings)}

_SCORED_DOCS = f"scored AS (SELECT doc_id, {V.sql_quality('text')} AS quality FROM documents)"


def _warnings(raw: bool) -> str:
    """Warning codes of each odd chat, built message by message."""
    clean = V.sql_strip("text")
    short = f"WHEN length({clean}) < 3 THEN concat('short_content[', i, ']')" if raw else ""
    by_size = f"""CASE WHEN {clean} = '' THEN concat('empty_content[', i, ']') {short}
      WHEN length({clean}) > 10000 THEN concat('long_content[', i, ']') END"""
    unsafe = f"CASE WHEN {V.sql_harmful(clean)} THEN concat('harmful_content[', i, ']') END" if raw else "NULL"
    return f"""{V.SQL_ODD_TURNS},
    notes AS (SELECT conv_id, i, role, nullif(concat_ws(',', {by_size}, {unsafe}), '') AS note FROM odd_turns),
    judged AS (
      SELECT conv_id, min(CASE WHEN role NOT IN ('system', 'user', 'assistant') THEN i END) AS bad,
        string_agg(note, ',' ORDER BY i) AS listed, count(*) FILTER (role = 'assistant') AS answers
      FROM notes GROUP BY conv_id),
    checked AS (
      SELECT conv_id, bad IS NULL AS is_valid,
        CASE WHEN bad IS NOT NULL THEN concat('bad_role[', bad, ']')
          ELSE concat_ws(',', listed, CASE WHEN answers = 0 THEN 'no_assistant' END) END AS warnings
      FROM judged)"""


_HASH = "CAST(concat('0x', substr(md5(concat('42|', {0})), 1, 15)) AS BIGINT)"
_RETENTION = "count(*) AS total, count(*) FILTER ({0}) AS kept, round(avg(CASE WHEN {0} THEN 1.0 ELSE 0.0 END), 6) AS kept_ratio"
_PUB = [p.replace(r"\w", V.WORD).replace(r"\b", "") for p in patterns.PUBLISHING_PATTERNS]
_ISSUES = [
    f"CASE WHEN regexp_matches(response, '(^|{V.NON_WORD}){p}($|{V.NON_WORD})', 'i') THEN '{n}' END"
    for n, p in enumerate(_PUB, start=1)]
_PUBLISH = f"issues AS (SELECT doc_id, concat_ws(',', {', '.join(_ISSUES)}) AS issues FROM responses)"
_FIRST_PROMPTS = f"""SELECT conv_id, {V.sql_strip('text')} AS prompt FROM (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS r FROM conversations WHERE role = 'user')
  WHERE r = 1 AND text <> ''"""

ORACLES = {
    "chat_quality_bands": f"""WITH {V.SQL_CHATS},
      s AS (SELECT {V.sql_quality('combined')} AS quality, length(text) AS length FROM chats)
      SELECT {V.sql_band('quality')} AS band, count(*) AS chats, round(avg(quality), 6) AS avg_quality,
        round(avg(length), 6) AS avg_length FROM s GROUP BY 1""",
    "chat_render": f"WITH {V.SQL_CHATS} SELECT conv_id, text, length(text) AS length FROM chats",
    "chat_structure_warnings": f"WITH {_warnings(False)} SELECT * FROM checked",
    "raw_chat_warnings": f"WITH {_warnings(True)} SELECT * FROM checked",
    "chat_validation_report": f"""WITH {_warnings(True)},
      joined AS (SELECT conv_id, string_agg(text, ' ' ORDER BY i) AS combined FROM odd_turns GROUP BY conv_id),
      s AS (SELECT c.conv_id, c.is_valid,
              CASE WHEN c.warnings = '' THEN 0 ELSE length(c.warnings) - length(replace(c.warnings, ',', '')) + 1 END AS w,
              CASE WHEN c.is_valid THEN {V.sql_quality('j.combined')} END AS quality
            FROM checked c JOIN joined j USING (conv_id)),
      a AS (SELECT count(*) AS total, count(*) FILTER (is_valid) AS valid, count(*) FILTER (NOT is_valid) AS invalid,
              CAST(sum(w) AS BIGINT) AS content_warnings, avg(quality) AS avg_quality, min(quality) AS min_quality,
              max(quality) AS max_quality, stddev_samp(quality) AS std_quality,
              count(*) FILTER (quality >= 0.8) AS excellent_rows,
              count(*) FILTER (quality >= 0.6 AND quality < 0.8) AS good_rows,
              count(*) FILTER (quality >= 0.4 AND quality < 0.6) AS fair_rows,
              count(*) FILTER (quality < 0.4) AS poor_rows FROM s)
      SELECT total, valid, invalid, content_warnings, round(avg_quality, 6) AS avg_quality,
        round(min_quality, 6) AS min_quality, round(max_quality, 6) AS max_quality,
        round(std_quality, 6) AS std_quality, excellent_rows, good_rows, fair_rows, poor_rows,
        round(valid * 100 / total, 6) AS valid_percentage, round(invalid * 100 / total, 6) AS invalid_percentage,
        invalid <= total * 0.05 AS is_valid, content_warnings > total * 0.2 AS high_warning_rate FROM a""",
    "chat_content_filter": f"""WITH {V.SQL_ODD_TURNS},
      k AS (SELECT conv_id, NOT bool_or({V.sql_harmful('text')}) AS keep FROM odd_turns GROUP BY conv_id)
      SELECT {_RETENTION.format('keep')} FROM k""",
    "kept_chats": f"""WITH {V.SQL_ODD_TURNS}
      SELECT conv_id, count(*) AS turns FROM odd_turns GROUP BY conv_id HAVING NOT bool_or({V.sql_harmful('text')})""",
    "flat_row_messages": f"""WITH {V.SQL_EXCHANGES},
      r AS (SELECT conv_id, turn, concat_ws(chr(10),
          CASE WHEN conv_id % 5 = 0 THEN {V.sql_render(V.q('system'), V.q('Be brief.'))} END,
          {V.sql_render(V.q('user'), 'prompt')},
          CASE WHEN conv_id % 3 < 2 THEN {V.sql_render(V.q('assistant'), 'response')} END) AS text FROM exchanges)
      SELECT conv_id, turn, text, length(text) AS length FROM r""",
    "exchange_rows": f"""WITH {V.SQL_EXCHANGES}
      SELECT conv_id, turn, concat('<|user|>', chr(10), prompt, '<|end|>', chr(10), '<|assistant|>', chr(10))
        AS generation_prompt, length(prompt) AS prompt_length, length(response) AS response_length FROM exchanges""",
    "text_preview": """SELECT doc_id, CASE WHEN length(text) > 200 THEN concat(substr(text, 1, 200), '...') ELSE text END
      AS preview FROM documents""",
    "first_prompts": _FIRST_PROMPTS,
    "first_prompts_capped": f"{_FIRST_PROMPTS} ORDER BY conv_id LIMIT 50",
    "first_prompts_from_messages": """SELECT conv_id, text AS prompt FROM (
      SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS r FROM conversations WHERE role = 'user')
      WHERE r = 1""",
    "all_prompts": """SELECT conv_id, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS INT) AS position,
      text AS query FROM conversations WHERE role = 'user'""",
    "text_prompts": "SELECT doc_id, substr(text, 1, 100) AS query FROM documents WHERE length(text) > 100",
    "harmful_docs": f"SELECT doc_id, lang FROM documents WHERE {V.sql_harmful('text')}",
    "safety_issues": f"WITH {V.SQL_RESPONSES}, {_PUBLISH} SELECT doc_id, issues, issues = '' AS is_safe FROM issues",
    "publishing_safety": f"""WITH {V.SQL_RESPONSES}, {_PUBLISH}
      SELECT count(*) AS total, count(*) FILTER (issues = '') AS safe_responses,
        count(*) FILTER (issues <> '') AS unsafe_responses,
        round(count(*) FILTER (issues = '') / count(*), 6) AS safety_score FROM issues""",
    "content_quality": f"""WITH {_SCORED_DOCS}
      SELECT doc_id, round(quality, 6) AS quality, {V.sql_band('quality')} AS band FROM scored""",
    "quality_bands": f"""WITH {_SCORED_DOCS}, b AS (SELECT {V.sql_band('quality')} AS band FROM scored)
      SELECT n.band, count(b.band) AS rows
      FROM (VALUES ('excellent'), ('good'), ('fair'), ('poor')) n(band) LEFT JOIN b ON n.band = b.band GROUP BY 1""",
    "quality_stats": f"""WITH {_SCORED_DOCS} SELECT count(quality) AS rows, round(avg(quality), 6) AS avg_quality,
      round(min(quality), 6) AS min_quality, round(max(quality), 6) AS max_quality,
      round(stddev_samp(quality), 6) AS std_quality FROM scored""",
    "document_retention": f"""WITH k AS (SELECT NOT {V.sql_harmful('text')} AS keep FROM documents)
      SELECT {_RETENTION.format('keep')} FROM k""",
    "length_filter_counts": f"""WITH d AS (
        SELECT CASE WHEN doc_id % 23 = 0 THEN ' ' ELSE text END AS text, doc_id % 19 = 0 AS bare FROM documents),
      r AS (SELECT CASE WHEN {V.sql_strip('text')} = '' THEN 'empty_examples' WHEN bare THEN 'missing_fields'
        WHEN length(text) > 2048 THEN 'too_long_examples' ELSE 'valid_examples' END AS reason FROM d)
      SELECT reason, count(*) AS rows, round(count(*) / (SELECT count(*) FROM r), 6) AS share,
        reason = 'valid_examples' AS is_success FROM r GROUP BY reason""",
    "short_texts": f"SELECT doc_id FROM documents WHERE length({V.sql_strip('text')}) < 10",
    "health_report": f"""WITH f AS (SELECT doc_id % 5 = 0 OR {V.sql_harmful('text')} AS bad FROM documents)
      SELECT 'chat' AS detected_kind, count(*) AS checked, count(*) FILTER (bad) AS issues,
        concat('harmful_content:', count(*) FILTER (bad)) AS findings,
        concat('review_quality', CASE WHEN count(*) < 100 THEN ',small_table' ELSE '' END) AS recommendations FROM f""",
    "mixed_row_shapes": f"""WITH {V.SQL_CHATS} SELECT conv_id, CASE conv_id % 4 WHEN 2 THEN {V.sql_render(V.q('user'), V.q('Say it'))}
        WHEN 3 THEN concat({V.sql_render(V.q('user'), V.q('Say it'))}, chr(10), {V.sql_render(V.q('assistant'), V.q('done'))})
        ELSE text END AS text FROM chats""",
    "head_rows": "SELECT doc_id, lang, n_chars FROM documents ORDER BY doc_id LIMIT 100",
    "stride_sample": """WITH i AS (SELECT event_id, event_type, row_number() OVER (ORDER BY event_id) - 1 AS r,
        greatest(1, count(*) OVER () // 700) AS step FROM events)
      SELECT event_id, event_type FROM i WHERE r % step = 0 AND r < step * 700""",
    "seeded_sample": f"SELECT doc_id, lang FROM documents ORDER BY {_HASH.format('doc_id')}, doc_id LIMIT 150",
    "shuffle_positions": f"""SELECT event_id, row_number() OVER (ORDER BY {_HASH.format('event_id')}) - 1 AS position
      FROM events""",
    "string_key_positions": """SELECT doc_id, row_number() OVER (ORDER BY lang, concat('doc-', doc_id)) - 1 AS position
      FROM documents""",
    "first_findings": f"""WITH {_warnings(False)},
      l AS (SELECT conv_id, unnest(string_split(warnings, ',')) AS finding,
              unnest(range(len(string_split(warnings, ',')))) AS position FROM checked WHERE warnings <> '')
      SELECT conv_id, CAST(position AS INT) AS position, finding FROM l ORDER BY conv_id, position LIMIT 10""",
}
