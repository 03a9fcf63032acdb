"""Registered queries over preference pairs."""

from __future__ import annotations

from pyspark.sql import functions as F

from alignlake.operators import normalize, quality, reports, sampling, validate
from alignlake.registry import views as V


def pref_pairs(spark, sf):
    return normalize.with_preference(V.pairs(spark, sf))


def pref_aliases(spark, sf):
    df = V.pairs(spark, sf).selectExpr(
        "pair_id", "CASE WHEN pair_id % 3 = 0 THEN '' ELSE prompt END AS prompt", "prompt AS question",
        "CASE WHEN pair_id % 5 = 0 THEN NULL ELSE chosen END AS response_chosen", "chosen AS preferred",
        "rejected AS not_preferred")
    return normalize.with_preference(df).select("pair_id", "prompt", "chosen", "rejected")


def pref_render(spark, sf):
    rendered = normalize.rendered_pairs(pref_pairs(spark, sf))
    return rendered.select("pair_id", "chosen_text", "rejected_text", "chosen_length", "rejected_length")


def pref_reject_reasons(spark, sf):
    judged = pref_pairs(spark, sf).withColumn(
        "reason", F.coalesce(validate.preference_text_reason(), F.lit("successful")))
    return V.rounded(reports.reason_counts(judged))


def pref_warnings(spark, sf):
    checked = validate.check_raw_preference(V.pairs(spark, sf))
    return checked.select("pair_id", "is_valid", F.array_join("warnings", ",").alias("warnings"))


def pref_content_filter(spark, sf):
    df = V.pairs(spark, sf)
    return V.rounded(validate.retention(df, validate.keep_preference(df)))


def pref_quality(spark, sf):
    return V.rounded(quality.with_preference_quality(pref_pairs(spark, sf)).select("pair_id", "quality"))


def pref_validation_report(spark, sf):
    return V.rounded(reports.validation_report(V.pairs(spark, sf), "preference"))


def pref_split(spark, sf):
    return sampling.train_eval_split(pref_pairs(spark, sf), "pair_id", "pair_id").select("pair_id", "split")


def pref_position_split(spark, sf):
    return sampling.train_eval_split(
        pref_pairs(spark, sf), "pair_id", "pair_id", mode="position",
        rows_per_bucket=V.ROWS_PER_BUCKET).select("pair_id", "split")


def pref_exact_split(spark, sf):
    return sampling.train_eval_split(
        pref_pairs(spark, sf), "pair_id", "pair_id", mode="exact",
        rows_per_bucket=V.ROWS_PER_BUCKET).select("pair_id", "split")


QUERIES = {f.__name__: f for f in (
    pref_aliases, pref_render, pref_reject_reasons, pref_warnings, pref_content_filter, pref_quality,
    pref_validation_report, pref_split, pref_position_split, pref_exact_split)}

_NOTES = f"""checked AS (
  SELECT pair_id,
    CASE WHEN prompt = '' THEN 'empty_prompt' WHEN chosen = '' THEN 'empty_chosen'
      WHEN rejected = '' THEN 'empty_rejected' END AS fault,
    concat_ws(',', CASE WHEN chosen = rejected THEN 'identical' END,
      CASE WHEN length(prompt) < 10 THEN 'short_prompt' WHEN length(prompt) > 5000 THEN 'long_prompt' END,
      CASE WHEN length(chosen) < 10 THEN 'short_chosen' WHEN length(chosen) > 10000 THEN 'long_chosen' END,
      CASE WHEN length(rejected) < 10 THEN 'short_rejected' WHEN length(rejected) > 10000 THEN 'long_rejected' END,
      CASE WHEN {V.sql_harmful('prompt')} THEN 'harmful_prompt' END,
      CASE WHEN {V.sql_harmful('chosen')} THEN 'harmful_chosen' END,
      CASE WHEN {V.sql_harmful('rejected')} THEN 'harmful_rejected' END) AS notes
  FROM pairs),
warned AS (SELECT pair_id, fault IS NULL AS is_valid, coalesce(fault, notes) AS warnings FROM checked)"""
_QUALITY = f"""scored AS (SELECT pair_id, CASE WHEN prompt = '' OR chosen = '' OR rejected = '' THEN {V.num(0.0)} ELSE
  {V.sql_quality('prompt')} * {V.num(0.4)} + {V.sql_quality('chosen')} * {V.num(0.3)}
  + {V.sql_quality('rejected')} * {V.num(0.3)} END AS quality FROM pairs)"""
_HASH = "CAST(concat('0x', substr(md5(concat('42|', pair_id)), 1, 15)) AS BIGINT)"

ORACLES = {
    "pref_aliases": f"""WITH {V.SQL_PAIRS}
      SELECT pair_id, prompt, chosen, rejected FROM pairs""",
    "pref_render": f"""WITH {V.SQL_PAIRS},
      r AS (SELECT pair_id, {V.sql_pair('prompt', 'chosen')} AS chosen_text,
              {V.sql_pair('prompt', 'rejected')} AS rejected_text FROM pairs)
      SELECT *, length(chosen_text) AS chosen_length, length(rejected_text) AS rejected_length FROM r""",
    "pref_reject_reasons": f"""WITH {V.SQL_PAIRS},
      r AS (SELECT coalesce({V.SQL_PAIR_REASON}, 'successful') AS reason FROM pairs)
      SELECT reason, count(*) AS rows, round(count(*) / (SELECT count(*) FROM r), 6) AS share,
        reason = 'successful' AS is_success FROM r GROUP BY reason""",
    "pref_warnings": f"WITH {V.SQL_PAIRS}, {_NOTES} SELECT * FROM warned",
    "pref_content_filter": f"""WITH {V.SQL_PAIRS},
      k AS (SELECT NOT ({V.sql_harmful('prompt')} OR {V.sql_harmful('chosen')} OR {V.sql_harmful('rejected')}) AS keep
            FROM raw_pairs)
      SELECT count(*) AS total, count(*) FILTER (keep) AS kept,
        round(avg(CASE WHEN keep THEN 1.0 ELSE 0.0 END), 6) AS kept_ratio FROM k""",
    "pref_quality": f"WITH {V.SQL_PAIRS}, {_QUALITY} SELECT pair_id, round(quality, 6) AS quality FROM scored",
    "pref_validation_report": f"""WITH {V.SQL_PAIRS}, {_NOTES}, {_QUALITY},
      s AS (SELECT w.is_valid, CASE WHEN w.is_valid THEN c.quality END AS quality,
              CASE WHEN w.warnings = '' THEN 0
                ELSE length(w.warnings) - length(replace(w.warnings, ',', '')) + 1 END AS n
            FROM warned w JOIN scored c USING (pair_id)),
      a AS (SELECT count(*) AS total, count(*) FILTER (is_valid) AS valid, count(*) FILTER (NOT is_valid) AS invalid,
              CAST(sum(n) AS BIGINT) AS content_warnings, round(avg(quality), 6) AS avg_quality,
              round(min(quality), 6) AS min_quality, round(max(quality), 6) AS max_quality,
              round(stddev_samp(quality), 6) AS std_quality, count(*) FILTER (quality >= 0.8) AS excellent_rows,
              count(*) FILTER (quality >= 0.6 AND quality < 0.8) AS good_rows,
              count(*) FILTER (quality >= 0.4 AND quality < 0.6) AS fair_rows,
              count(*) FILTER (quality < 0.4) AS poor_rows FROM s)
      SELECT *, round(valid * 100 / total, 6) AS valid_percentage, round(invalid * 100 / total, 6) AS invalid_percentage,
        invalid <= total * 0.05 AS is_valid, content_warnings > total * 0.2 AS high_warning_rate FROM a""",
    "pref_split": f"""WITH {V.SQL_PAIRS},
      i AS (SELECT pair_id FROM pairs)
      SELECT pair_id, CASE WHEN {_HASH} % 100 < 80 THEN 'train' ELSE 'eval' END AS split FROM i""",
    "pref_position_split": f"""WITH {V.SQL_PAIRS},
      i AS (SELECT pair_id, row_number() OVER (ORDER BY pair_id) - 1 AS r, count(*) OVER () AS n FROM pairs)
      SELECT pair_id, CASE WHEN r < floor(n * {V.num(0.8)}) THEN 'train' ELSE 'eval' END AS split FROM i""",
    "pref_exact_split": f"""WITH {V.SQL_PAIRS},
      i AS (SELECT pair_id, row_number() OVER (ORDER BY pair_id) - 1 AS r,
              row_number() OVER (ORDER BY {_HASH}) - 1 AS h, count(*) OVER () AS n FROM pairs)
      SELECT pair_id, CASE WHEN h >= ceil(n * {V.num(0.2)}) THEN 'train' ELSE 'eval' END AS split FROM i""",
}
