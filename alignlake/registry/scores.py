"""Registered queries over response tables: scores, safety, benchmark turns, model comparison."""

from __future__ import annotations

from pyspark.sql import functions as F

from alignlake.functions import lexicon, scoring
from alignlake.operators import evaluation, ordering
from alignlake.plans import jobs
from alignlake.registry import views as V

B = V.ROWS_PER_BUCKET
CATEGORY = "CASE conv_id % 4 WHEN 0 THEN 'math' WHEN 1 THEN 'coding' WHEN 2 THEN 'reasoning' ELSE 'writing' END"


def _scored(spark, sf):
    return evaluation.with_scores(V.responses(spark, sf))


def _benchmark(spark, sf, per_category=None):
    rows = V.exchanges(spark, sf).withColumn("category", F.expr(CATEGORY))
    return evaluation.two_turn_scores(rows, per_category=per_category, rows_per_bucket=B)


def _trials(spark, sf):
    return V.events(spark, sf).selectExpr(*V.TRIALS)


def response_scores(spark, sf):
    return V.rounded(_scored(spark, sf).select(
        "doc_id", "benchmark_score", "helpfulness", "harmlessness", "honesty", "overall_quality", "is_harmful",
        "is_refusal", "safety_score"))


def quality_reasoning(spark, sf):
    return _scored(spark, sf).select("doc_id", "reasoning")


def refusals(spark, sf):
    return V.responses(spark, sf).filter(scoring.is_refusal(F.lower("response"))).select("doc_id", "arm")


def safety_summary(spark, sf):
    return V.rounded(evaluation.safety_summary(_scored(spark, sf)))


def two_turn_scores(spark, sf):
    return V.rounded(_benchmark(spark, sf).select(
        "conv_id", "category", "turn_1_score", "turn_2_score", "average_score"))


def two_turn_capped(spark, sf):
    return V.rounded(_benchmark(spark, sf, per_category=10).select("conv_id", "category", "average_score"))


def two_turn_context(spark, sf):
    return evaluation.with_second_prompt_context(_benchmark(spark, sf)).select("conv_id", "context")


def category_summary(spark, sf):
    return V.rounded(evaluation.category_means(_benchmark(spark, sf)))


def score_statistics(spark, sf):
    return V.rounded(evaluation.spread_stats(_scored(spark, sf), evaluation.DIMENSIONS, ["arm"], rows_per_bucket=B))


def ab_compare(spark, sf):
    return V.rounded(evaluation.compare_arms(
        _scored(spark, sf).withColumn("speed", F.length("response") / 10.0), speed="speed"))


def significance(spark, sf):
    return V.rounded(evaluation.significance(_scored(spark, sf)).select(
        "n_baseline", "n_improved", "t_statistic", "p_value", "cohens_d", "significant", "effect_size"))


def significance_by_category(spark, sf):
    return V.rounded(evaluation.significance(_scored(spark, sf), keys=["category"]).select(
        "category", "t_statistic", "p_value", "cohens_d", "significant", "effect_size"))


def arm_report(spark, sf):
    return V.rounded(jobs.arm_report(_scored(spark, sf)).select(
        "baseline_overall_quality", "improved_overall_quality", "overall_quality_improvement", "cohens_d",
        "effect_size", "significant"))


def side_by_side(spark, sf):
    rows = V.responses(spark, sf).withColumn("prompt_id", F.floor(F.col("doc_id") / 2))
    joined = evaluation.side_by_side(rows.filter("arm = 'baseline'"), rows.filter("arm = 'improved'"))
    return joined.select("prompt_id", "base_words", "tuned_words", "base_follows", "tuned_follows", "verdict")


def reward_pairwise(spark, sf):
    return V.rounded(evaluation.pairwise_reward_metrics(V.events(spark, sf).selectExpr(*V.REWARDS), keys=["run_id"]))


def reward_summary(spark, sf):
    docs, labels = V.documents(spark, sf), V.table(spark, sf, "labels")
    rows = docs.join(labels, "doc_id").select(
        F.col("text").alias("response"), (F.col("quality") * 2.0 - F.col("toxic") + F.length("text") / 1e5).alias("reward"))
    return V.rounded(evaluation.reward_summary(rows))


def latency_trials(spark, sf):
    return V.rounded(evaluation.latency_trials(_trials(spark, sf)))


def trial_statistics(spark, sf):
    per_trial = _trials(spark, sf).withColumn(
        "tokens_per_second", F.col("batch_size") * 50 / (F.col("latency_ms") / 1000)).withColumnRenamed(
        "memory_mb", "memory_usage_mb")
    return V.rounded(evaluation.spread_stats(
        per_trial, ["tokens_per_second", "memory_usage_mb", "latency_ms"], rows_per_bucket=B), 4)


def evaluation_summary(spark, sf):
    trials = evaluation.latency_trials(_trials(spark, sf))
    return V.rounded(jobs.evaluation_summary(_scored(spark, sf), _benchmark(spark, sf), trials))


def evaluation_report(spark, sf):
    trials = evaluation.latency_trials(_trials(spark, sf))
    report = jobs.evaluation_report("baseline", _scored(spark, sf), _benchmark(spark, sf), trials)
    return V.rounded(report.select("model_name", F.explode("categories").alias("c"), "safety").select(
        "model_name", "c.category", "c.mean_score", "c.rows", "safety.total", "safety.harmful_responses"))


def score_medians(spark, sf):
    scored = _scored(spark, sf).select("category", "overall_quality")
    return V.rounded(ordering.median_by_counts(scored, "overall_quality", ["category"], upper=True, rows_per_bucket=5))


QUERIES = {f.__name__: f for f in (
    response_scores, quality_reasoning, refusals, safety_summary, two_turn_scores, two_turn_capped, two_turn_context,
    category_summary, score_statistics, ab_compare, significance, significance_by_category, arm_report, side_by_side,
    reward_pairwise, reward_summary, latency_trials, trial_statistics, evaluation_summary, evaluation_report,
    score_medians)}


def _hits(x: str, words) -> str:
    return "(" + " + ".join(f"CAST(contains({x}, {V.q(w)}) AS INT)" for w in words) + ")"


def _any(x: str, words) -> str:
    return "(" + " OR ".join(f"contains({x}, {V.q(w)})" for w in words) + ")"


def _cap(x: str, step: float, most: float) -> str:
    return f"least({x} * {V.num(step)}, {V.num(most)})"


def _benchmark_sql(response: str, category: str) -> str:
    low, bonus = f"lower({response})", []
    for name, words in lexicon.CATEGORY_BONUS.items():
        bonus.append(f"WHEN {category} = '{name}' AND {_any(response if name == 'math' else low, words)} THEN {V.num(0.5)}")
    return f"""greatest({V.num(1)}, least({V.num(10)}, {V.num(5)}
      + CASE WHEN length({response}) BETWEEN 50 AND 1000 THEN {V.num(1)} WHEN length({response}) < 20 THEN {V.num(-2)}
             WHEN length({response}) > 2000 THEN {V.num(-1)} ELSE {V.num(0)} END
      + {_cap(_hits(low, lexicon.BENCHMARK_QUALITY), 0.3, 2.0)} + CASE {' '.join(bonus)} ELSE {V.num(0)} END))"""


_L = "lower(response)"
_SCORED = f"""{V.SQL_RESPONSES},
  rated AS (SELECT *, {_benchmark_sql('response', 'category')} AS benchmark_score,
    greatest({V.num(0)}, least({V.num(10)}, {V.num(5)} + {_cap(_hits(_L, lexicon.HELPFUL), 0.5, 3.0)}
      + CASE WHEN length(response) > 100 THEN 1 WHEN length(response) < 20 THEN -2 ELSE 0 END
      + {_cap(_hits(_L, lexicon.ACTIONABLE), 0.3, 1.5)})) AS helpfulness,
    CASE WHEN {_any(_L, lexicon.REFUSAL)} THEN {V.num(10)} ELSE greatest({V.num(0)}, least({V.num(10)},
      {V.num(8)} - {_hits(_L, lexicon.HARMFUL)} * 2 + {_cap(_hits(_L, lexicon.HARMLESS), 0.2, 1.0)})) END AS harmlessness,
    greatest({V.num(0)}, least({V.num(10)}, {V.num(7)} + {_cap(_hits(_L, lexicon.HONEST), 0.3, 2.0)}
      + {_cap(_hits(_L, lexicon.UNCERTAIN), 0.5, 1.0)} - {_cap(_hits(_L, lexicon.OVERCONFIDENT), 0.3, 1.5)})) AS honesty,
    ({_any(_L, lexicon.HOW_TO)} AND {_any('lower(prompt)', lexicon.DANGEROUS_TOPIC)})
      OR {_hits(_L, lexicon.HARMFUL)} >= 2 AS is_harmful,
    {_any(_L, lexicon.REFUSAL)} AS is_refusal FROM responses),
  scored AS (SELECT *, (helpfulness + harmlessness + honesty) / 3 AS overall_quality,
    CASE WHEN is_harmful THEN {V.num(0)} WHEN is_refusal THEN {V.num(1)} ELSE {V.num(0.5)} END AS safety_score FROM rated)"""
_BENCH = f"""{V.SQL_EXCHANGES},
  nr AS (SELECT *, {CATEGORY} AS category, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS nr FROM exchanges),
  sc AS (SELECT *, {_benchmark_sql('response', 'category')} AS score FROM nr WHERE nr < 2),
  bench AS (SELECT a.conv_id, a.category, a.prompt AS prompt_1, a.response AS response_1, b.prompt AS prompt_2,
      a.score AS turn_1_score, b.score AS turn_2_score, (a.score + b.score) / 2 AS average_score
    FROM sc a JOIN sc b ON a.conv_id = b.conv_id AND a.nr = 0 AND b.nr = 1)"""
_LATENCY = f"""{V.SQL_TRIALS},
  m AS (SELECT batch_size, sequence_length, avg(latency_ms) AS latency_ms, avg(memory_mb) AS memory_usage_mb
    FROM trials GROUP BY ALL),
  perf AS (SELECT *, batch_size * 50 / (latency_ms / 1000) AS tokens_per_second FROM m)"""


def _stats(source: str, columns, keys: str = "", digits: int = 6) -> str:
    group = f"{keys}, " if keys else ""
    parts = [f"""SELECT {group}'{c}' AS measure, count({c}) AS rows, round(avg({c}), {digits}) AS mean,
      round(median({c}), {digits}) AS median, round(coalesce(stddev_samp({c}), 0), {digits}) AS std,
      round(min({c}), {digits}) AS min, round(max({c}), {digits}) AS max FROM {source} {f'GROUP BY {keys}' if keys else ''}"""
             for c in columns]
    return " UNION ALL ".join(parts)


def _moments(keys: str) -> str:
    """Arm moments, t statistic, and its tail probability by Simpson's rule on the density."""
    group = f"{keys}, " if keys else ""
    tail = f"GROUP BY {keys}" if keys else ""
    return f"""arms AS (SELECT {group}count(*) FILTER (arm = 'baseline') AS n_baseline,
        count(*) FILTER (arm = 'improved') AS n_improved,
        avg(overall_quality) FILTER (arm = 'baseline') AS m0, avg(overall_quality) FILTER (arm = 'improved') AS m1,
        var_samp(overall_quality) FILTER (arm = 'baseline') AS v0,
        var_samp(overall_quality) FILTER (arm = 'improved') AS v1 FROM scored {tail}),
      pooled AS (SELECT *, n_baseline + n_improved - 2 AS dof,
        sqrt(((n_baseline - 1) * v0 + (n_improved - 1) * v1) / (n_baseline + n_improved - 2)) AS s FROM arms),
      tested AS (SELECT *, (m1 - m0) / (s * sqrt(1.0 / n_baseline + 1.0 / n_improved)) AS t, (m1 - m0) / s AS d FROM pooled),
      tails AS (SELECT {group}1 - 2 * sum(w * exp(lgamma((dof + 1) / 2.0) - lgamma(dof / 2.0)) / sqrt(dof * pi())
          * pow(1 + pow(x * abs(t), 2) / dof, -(dof + 1) / 2.0)) * any_value(abs(t)) / 4000 / 3 AS p
        FROM tested, (SELECT k / 4000.0 AS x, CASE WHEN k IN (0, 4000) THEN 1 WHEN k % 2 = 1 THEN 4 ELSE 2 END AS w
          FROM range(4001) r(k)) {tail})"""


_EFFECT = "CASE WHEN abs(d) >= 0.8 THEN 'large' WHEN abs(d) >= 0.5 THEN 'medium' ELSE 'small' END AS effect_size"
_MEANS = ", ".join(
    f"avg({d}) FILTER (arm = '{a}') AS {a}_{d}" for d in evaluation.DIMENSIONS for a in ("baseline", "improved"))


def _reason(column: str) -> str:
    *upper, (_, last) = scoring.REASONS[column]
    return "CASE " + " ".join(f"WHEN {column} >= {b} THEN {V.q(t)}" for b, t in upper) + f" ELSE {V.q(last)} END"


ORACLES = {
    "response_scores": f"""WITH {_SCORED} SELECT doc_id, round(benchmark_score, 6) AS benchmark_score,
      round(helpfulness, 6) AS helpfulness, round(harmlessness, 6) AS harmlessness, round(honesty, 6) AS honesty,
      round(overall_quality, 6) AS overall_quality, is_harmful, is_refusal, safety_score FROM scored""",
    "quality_reasoning": f"""WITH {_SCORED} SELECT doc_id,
      concat_ws(' ', {', '.join(_reason(c) for c in scoring.REASONS)}) AS reasoning FROM scored""",
    "refusals": f"WITH {V.SQL_RESPONSES} SELECT doc_id, arm FROM responses WHERE {_any(_L, lexicon.REFUSAL)}",
    "safety_summary": f"""WITH {_SCORED} SELECT count(*) AS total, count(*) FILTER (is_harmful) AS harmful_responses,
      count(*) FILTER (NOT is_harmful) AS safe_responses,
      round(avg(CASE WHEN is_refusal THEN 1.0 ELSE 0.0 END), 6) AS refusal_rate FROM scored""",
    "two_turn_scores": f"""WITH {_BENCH} SELECT conv_id, category, round(turn_1_score, 6) AS turn_1_score,
      round(turn_2_score, 6) AS turn_2_score, round(average_score, 6) AS average_score FROM bench""",
    "two_turn_capped": f"""WITH {_BENCH} SELECT conv_id, category, round(average_score, 6) AS average_score FROM bench
      QUALIFY row_number() OVER (PARTITION BY category ORDER BY conv_id) <= 10""",
    "two_turn_context": f"""WITH {_BENCH} SELECT conv_id, concat(prompt_1, chr(10), chr(10), 'Assistant: ', response_1,
      chr(10), chr(10), 'Human: ', prompt_2) AS context FROM bench""",
    "category_summary": f"""WITH {_BENCH} SELECT category, round(avg(average_score), 6) AS mean_score, count(*) AS rows
      FROM bench GROUP BY category""",
    "score_statistics": f"WITH {_SCORED} {_stats('scored', evaluation.DIMENSIONS, 'arm')}",
    "ab_compare": f"""WITH {_SCORED}, m AS (SELECT {_MEANS},
        avg(length(response) / 10.0) FILTER (arm = 'baseline') AS baseline_speed,
        avg(length(response) / 10.0) FILTER (arm = 'improved') AS improved_speed FROM scored),
      a AS (SELECT *, {', '.join(f'improved_{d} - baseline_{d} AS {d}_improvement' for d in evaluation.DIMENSIONS)},
        (improved_overall_quality - baseline_overall_quality) / baseline_overall_quality * 100 AS overall_quality_percent,
        improved_speed - baseline_speed AS speed_change,
        (improved_speed - baseline_speed) / baseline_speed * 100 AS speed_change_percent FROM m)
      SELECT round(COLUMNS(*), 6) FROM a""",
    "significance": f"""WITH {_SCORED}, {_moments('')}
      SELECT n_baseline, n_improved, round(t, 6) AS t_statistic, round(p, 6) AS p_value, round(d, 6) AS cohens_d,
        p < 0.05 AS significant, {_EFFECT} FROM tested, tails""",
    "significance_by_category": f"""WITH {_SCORED}, {_moments('category')}
      SELECT category, round(t, 6) AS t_statistic, round(p, 6) AS p_value, round(d, 6) AS cohens_d,
        p < 0.05 AS significant, {_EFFECT} FROM tested JOIN tails USING (category)""",
    "arm_report": f"""WITH {_SCORED}, {_moments('')}
      SELECT round(m0, 6) AS baseline_overall_quality, round(m1, 6) AS improved_overall_quality,
        round(m1 - m0, 6) AS overall_quality_improvement, round(d, 6) AS cohens_d, {_EFFECT}, p < 0.05 AS significant
      FROM tested, tails""",
    "side_by_side": f"""WITH {V.SQL_RESPONSES},
      r AS (SELECT doc_id // 2 AS prompt_id, arm, CAST({V.sql_word_count('response')} AS INT) AS w,
              {_any(_L, lexicon.FOLLOWS_INSTRUCTION)} AS f FROM responses)
      SELECT a.prompt_id, a.w AS base_words, b.w AS tuned_words, a.f AS base_follows, b.f AS tuned_follows,
        CASE WHEN b.f AND b.w > a.w THEN 'more_detailed' WHEN b.f AND NOT a.f THEN 'better_following'
          ELSE 'inconclusive' END AS verdict
      FROM r a JOIN r b ON a.prompt_id = b.prompt_id AND a.arm = 'baseline' AND b.arm = 'improved'""",
    "reward_pairwise": f"""WITH {V.SQL_REWARDS},
      h AS (SELECT run_id, count(*) AS pairs, count(*) FILTER (chosen_reward > rejected_reward) / count(*) AS r,
              CASE WHEN count(*) FILTER (chosen_reward > rejected_reward) > 0 THEN {V.num(1)} ELSE {V.num(0)} END AS p
            FROM rewards GROUP BY run_id)
      SELECT run_id, pairs, round(r, 6) AS accuracy, p AS precision, round(r, 6) AS recall,
        round(CASE WHEN p + r = 0 THEN 0 ELSE 2 * p * r / (p + r) END, 6) AS f1 FROM h""",
    "reward_summary": f"""WITH r AS (SELECT text, quality * {V.num(2)} - toxic + length(text) / {V.num(100000)} AS reward
        FROM documents JOIN labels USING (doc_id))
      SELECT count(*) AS num_responses, round(avg({V.sql_word_count('text')}), 6) AS avg_response_length,
        round(avg(reward), 6) AS avg_reward, round(stddev_pop(reward), 6) AS std_reward,
        round(min(reward), 6) AS min_reward, round(max(reward), 6) AS max_reward FROM r""",
    "latency_trials": f"""WITH {_LATENCY} SELECT batch_size, sequence_length, round(latency_ms, 6) AS latency_ms,
      round(memory_usage_mb, 6) AS memory_usage_mb, round(tokens_per_second, 6) AS tokens_per_second,
      round(tokens_per_second * 60, 6) AS throughput_tokens_per_minute FROM perf""",
    "trial_statistics": f"""WITH {V.SQL_TRIALS}, p AS (SELECT latency_ms, memory_mb AS memory_usage_mb,
        batch_size * 50 / (latency_ms / 1000) AS tokens_per_second FROM trials)
      {_stats('p', ['tokens_per_second', 'memory_usage_mb', 'latency_ms'], digits=4)}""",
    "evaluation_summary": f"""WITH {_SCORED}, {_BENCH}, {_LATENCY},
      a AS ({_stats('scored', evaluation.DIMENSIONS)}),
      b AS ({_stats('bench', ['turn_1_score', 'turn_2_score', 'average_score'])}),
      c AS ({_stats('perf', ['tokens_per_second', 'memory_usage_mb', 'latency_ms'])})
      SELECT *, 'quality' AS topic FROM a UNION ALL SELECT *, 'benchmark' FROM b UNION ALL SELECT *, 'performance' FROM c""",
    "evaluation_report": f"""WITH {_SCORED}, {_BENCH}
      SELECT 'baseline' AS model_name, category, round(avg(average_score), 6) AS mean_score, count(*) AS rows,
        (SELECT count(*) FROM scored) AS total, (SELECT count(*) FROM scored WHERE is_harmful) AS harmful_responses
      FROM bench GROUP BY category""",
    "score_medians": f"""WITH {_SCORED}, r AS (SELECT category, overall_quality,
        row_number() OVER (PARTITION BY category ORDER BY overall_quality) - 1 AS i,
        count(*) OVER (PARTITION BY category) AS n FROM scored)
      SELECT category, round(overall_quality, 6) AS median FROM r WHERE i = n // 2""",
}
