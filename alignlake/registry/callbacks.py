"""Registered queries that run a user's Python functions on batches of rows."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from alignlake.operators import tokens, user_functions
from alignlake.registry import views as V


def user_row_map(spark, sf):
    docs = V.documents(spark, sf).select("doc_id", "text")
    return user_functions.map_batches(
        docs, lambda p: p.assign(shout=p.text.str.len() + 1)[["doc_id", "shout"]], "doc_id bigint, shout bigint")


def user_row_filter(spark, sf):
    docs = V.documents(spark, sf).select("doc_id", "lang", "n_chars")
    return user_functions.keep_where(docs, lambda lang, n: (lang == "en") & (n > 500), ["lang", "n_chars"])


def user_metric(spark, sf):
    rewards = V.events(spark, sf).selectExpr(*V.REWARDS)
    sums = user_functions.additive_metric(
        rewards, lambda p: {"hits": (p.chosen_reward > p.rejected_reward).sum(), "pairs": len(p)}, ["hits", "pairs"], ["run_id"])
    return V.rounded(sums.select("run_id", (F.col("hits") / F.col("pairs")).alias("accuracy")))


def user_tokenizer(spark, sf):
    docs = V.documents(spark, sf).select("doc_id", "text")
    encoded = tokens.with_user_tokenizer(docs, lambda: (lambda texts: [t.encode("utf-8") for t in texts]))
    return encoded.select("doc_id", F.size("input_ids").alias("token_count"))


def user_collator(spark, sf):
    """A user's function over each batch of sixteen neighbours."""
    docs = V.documents(spark, sf).select("doc_id", "n_chars", F.floor(F.col("doc_id") / 16).cast("bigint").alias("batch_id"))

    def widest(p):
        return p.groupby("batch_id", as_index=False).agg(rows=("doc_id", "size"), width=("n_chars", "max"))

    return tokens.collate_with(docs, widest, "batch_id bigint, rows bigint, width bigint")


class Correlation:
    """Correlation of two columns from sums that add up."""

    def init(self):
        return np.zeros(6)

    def update(self, state, rows):
        x, y = rows.chosen_reward.to_numpy(float), rows.rejected_reward.to_numpy(float)
        return state + [len(x), x.sum(), y.sum(), (x * x).sum(), (y * y).sum(), (x * y).sum()]

    def merge(self, state, other):
        return state + other

    def finish(self, state):
        n, x, y, xx, yy, xy = state
        spread = ((n * xx - x * x) * (n * yy - y * y)) ** 0.5
        return {"pairs": int(n), "correlation": (n * xy - x * y) / spread if spread else None}


def user_state_metric(spark, sf):
    rewards = V.events(spark, sf).selectExpr(*V.REWARDS)
    return V.rounded(user_functions.merged_metric(rewards, Correlation(), "pairs bigint, correlation double", ["run_id"]))


def reward_roc_area(spark, sf):
    """How often a chosen reward is above a rejected one, over all pairs of rows of a run."""
    rewards = V.events(spark, sf).selectExpr(*V.REWARDS)
    scored = rewards.select("run_id", F.explode(F.array(
        F.struct(F.lit(True).alias("chosen"), F.round("chosen_reward", 1).alias("score")),
        F.struct(F.lit(False).alias("chosen"), F.round("rejected_reward", 1).alias("score")))).alias("s")).select("run_id", "s.*")
    return V.rounded(user_functions.roc_area(scored, "chosen", "score", ["run_id"], rows_per_bucket=V.ROWS_PER_BUCKET))


class Lines:
    """The lines of a text that are not empty, with their numbers."""

    def eval(self, text: str):
        for number, line in enumerate((text or "").split("\n")):
            if line:
                yield number, len(line)


def user_table_function(spark, sf):
    docs = V.documents(spark, sf).select("doc_id", "lang", "text")
    return user_functions.expand_rows(docs, Lines, "line int, chars int", ["text"]).select("doc_id", "lang", "line", "chars")


QUERIES = {f.__name__: f for f in (user_row_map, user_row_filter, user_metric, user_tokenizer, user_collator, user_state_metric, reward_roc_area, user_table_function)}
ORACLES = {
    "user_state_metric": f"""WITH {V.SQL_REWARDS} SELECT run_id, count(*) AS pairs, round(corr(chosen_reward, rejected_reward), 6) AS correlation
      FROM rewards GROUP BY run_id""",
    "reward_roc_area": f"""WITH {V.SQL_REWARDS},
      s AS (SELECT run_id, true AS c, round(chosen_reward, 1) AS v FROM rewards UNION ALL SELECT run_id, false, round(rejected_reward, 1) FROM rewards),
      r AS (SELECT run_id, c, rank() OVER (PARTITION BY run_id ORDER BY v) + (count(*) OVER (PARTITION BY run_id, v) - 1) / 2.0 AS r FROM s)
      SELECT run_id, count(*) FILTER (c) AS positives, count(*) FILTER (NOT c) AS negatives, round((sum(r) FILTER (c)
        - count(*) FILTER (c) * (count(*) FILTER (c) + 1) / 2.0) / (count(*) FILTER (c) * count(*) FILTER (NOT c)), 6) AS roc_area FROM r GROUP BY run_id""",
    "user_table_function": """SELECT doc_id, lang, CAST(i AS INT) AS line, CAST(length(x) AS INT) AS chars FROM (
        SELECT doc_id, lang, unnest(string_split(text, chr(10))) AS x, unnest(range(len(string_split(text, chr(10))))) AS i FROM documents)
      WHERE x <> ''""",
    "user_collator": "SELECT doc_id // 16 AS batch_id, count(*) AS rows, max(n_chars) AS width FROM documents GROUP BY 1",
    "user_row_map": "SELECT doc_id, length(text) + 1 AS shout FROM documents",
    "user_row_filter": "SELECT doc_id, lang, n_chars FROM documents WHERE lang = 'en' AND n_chars > 500",
    "user_metric": f"""WITH {V.SQL_REWARDS} SELECT run_id,
      round(count(*) FILTER (chosen_reward > rejected_reward) / count(*), 6) AS accuracy FROM rewards GROUP BY run_id""",
    "user_tokenizer": """SELECT doc_id, CAST(octet_length(encode(text)) AS INT) AS token_count
      FROM documents""",
}
