"""Input views of the registered queries, each as Spark rows and as the same SQL for the oracle.

The raw tables hold no unsafe chats, no preference pairs and no telemetry, so the views plant phrases
by id and derive pairs and metrics. They cover the whole tables and the whole texts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from alignlake.functions.patterns import HARMFUL_STEMS, HARMFUL_WORDS
from alignlake.functions.text import TOKEN_REGEX
from alignlake.operators import normalize, ordering
from alignlake.session import written
from alignlake.sources.readers import spread

# Small on purpose: the test tables still pass through several buckets and chunks.
ROWS_PER_BUCKET = 2_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "documents"))


def conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations")


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded for comparison, everything else as it is."""
    return df.select(*[
        F.round(F.col(f"`{n}`"), digits).alias(n) if t == "double" else F.col(f"`{n}`") for n, t in df.dtypes])


# ---- pieces of oracle SQL -------------------------------------------------------------------------

WORD = r"[\p{L}\p{M}\p{N}_]"
NON_WORD = r"[^\p{L}\p{M}\p{N}_]"
SPACE = r"[\s\p{Z}]"


def num(x: float) -> str:
    return f"CAST({x} AS DOUBLE)"


def q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def sql_strip(x: str) -> str:
    return f"regexp_replace({x}, '^{SPACE}+|{SPACE}+$', '', 'g')"


def sql_words(stripped: str) -> str:
    return f"(CASE WHEN {stripped} = '' THEN [] ELSE regexp_split_to_array(lower({stripped}), '{SPACE}+') END)"


def sql_word_count(x: str) -> str:
    return rf"len(regexp_extract_all({x}, '[^\s\p{{Z}}]+'))"


def sql_harmful(x: str) -> str:
    plain = "|".join(row for rows in HARMFUL_WORDS.values() for row in rows)
    stems = "|".join(HARMFUL_STEMS)
    body = f"(^|{NON_WORD})(?:{plain}|(?:{stems}){WORD}*)($|{NON_WORD})"
    return f"coalesce(regexp_matches(lower({x}), '{body}', 's'), false)"


def sql_quality(x: str) -> str:
    """Quality score of a text expression; the parts appear in the order the product is taken."""
    clean = sql_strip(f"coalesce({x}, '')")
    words = sql_words(clean)
    variety = f"(len(list_distinct({words})) / greatest(len({words}), 1))"
    pieces = f"(length({clean}) - length(replace({clean}, '.', '')) + 1)"
    mean = rf"(len(regexp_extract_all({clean}, '[^\s\p{{Z}}.]+')) / greatest({pieces}, 1))"
    one = num(1.0)
    return f"""(CASE WHEN {clean} = '' THEN {num(0.0)} ELSE
      (CASE WHEN length({clean}) < 10 THEN {num(0.3)} WHEN length({clean}) < 50 THEN {num(0.7)} ELSE {one} END)
    * (CASE WHEN length({clean}) > 5000 THEN {num(0.8)} ELSE {one} END)
    * (CASE WHEN len({words}) > 10 AND {variety} < 0.3 THEN {num(0.4)}
            WHEN len({words}) > 10 AND {variety} < 0.5 THEN {num(0.7)} ELSE {one} END)
    * (CASE WHEN {pieces} > 1 AND {mean} < 3 THEN {num(0.6)}
            WHEN {pieces} > 1 AND {mean} > 50 THEN {num(0.8)} ELSE {one} END)
    * (CASE WHEN {sql_harmful(x)} THEN {num(0.1)} ELSE {one} END) END)"""


def sql_band(x: str) -> str:
    return f"(CASE WHEN {x} >= 0.8 THEN 'excellent' WHEN {x} >= 0.6 THEN 'good' WHEN {x} >= 0.4 THEN 'fair' ELSE 'poor' END)"


def sql_tokens(x: str) -> str:
    return f"regexp_extract_all({x}, '{TOKEN_REGEX}')"


def sql_render(role: str, content: str) -> str:
    return f"concat('<|', {role}, '|>', chr(10), {sql_strip(content)}, '<|end|>')"


def sql_pair(prompt: str, answer: str) -> str:
    return f"concat({sql_render(q('user'), prompt)}, chr(10), {sql_render(q('assistant'), answer)})"


# ---- chats ----------------------------------------------------------------------------------------

ODD_TURNS = [
    "conv_id", "turn",
    "CASE WHEN conv_id % 9 = 4 AND turn = 1 THEN 'tool' WHEN conv_id % 16 = 7 THEN 'user' ELSE role END AS role",
    """CASE WHEN conv_id % 10 = 3 AND turn = 1 THEN '  ' WHEN conv_id % 14 = 5 AND turn = 0 THEN 'ok'
       WHEN conv_id % 12 = 2 THEN concat(text, ' about a weapon') ELSE text END AS text""",
]


def chats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize.messages_from_turns(conversations(spark, sf_dir))


def odd_chats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize.messages_from_turns(conversations(spark, sf_dir).selectExpr(*ODD_TURNS))




SQL_CHATS = f"""chats AS (
  SELECT conv_id, string_agg({sql_render('role', 'text')}, chr(10) ORDER BY turn) AS text,
         string_agg(text, ' ' ORDER BY turn) AS combined
  FROM conversations GROUP BY conv_id)"""

SQL_ODD_TURNS = f"""odd AS (SELECT {', '.join(ODD_TURNS)} FROM conversations),
odd_turns AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS i FROM odd)"""


def exchanges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User turns with the answer that follows; stored, because pairing and numbering read them repeatedly."""
    found = normalize.exchanges_from_turns(conversations(spark, sf_dir), rows_per_bucket=ROWS_PER_BUCKET)
    return written(found, "exchanges")


SQL_EXCHANGES = """turns_next AS (
  SELECT conv_id, turn, role, text,
    lead(role) OVER (PARTITION BY conv_id ORDER BY turn) AS nrole,
    lead(text) OVER (PARTITION BY conv_id ORDER BY turn) AS ntext
  FROM conversations),
exchanges AS (
  SELECT conv_id, turn, text AS prompt, ntext AS response FROM turns_next
  WHERE role = 'user' AND nrole = 'assistant')"""

PLANTED_PAIR = [
    "conv_id * 100 + turn AS pair_id",
    """CASE WHEN conv_id % 13 = 0 THEN concat(prompt, ' with a bomb') WHEN conv_id % 17 = 0 THEN ''
       ELSE prompt END AS prompt""",
    "response AS chosen",
    "CASE WHEN conv_id % 11 = 0 THEN response ELSE other END AS rejected",
]


def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Preference pairs: the rejected answer is the one of the next conversation at the same turn."""
    paired = ordering.with_neighbour(
        exchanges(spark, sf_dir), "conv_id", ["turn"], {"response": "other"}, rows_per_bucket=ROWS_PER_BUCKET)
    return paired.withColumn("other", F.coalesce("other", F.lit(""))).selectExpr(*PLANTED_PAIR)


SQL_PAIRS = f"""{SQL_EXCHANGES},
others AS (
  SELECT *, coalesce(lead(response) OVER (PARTITION BY turn ORDER BY conv_id), '') AS other FROM exchanges),
raw_pairs AS (SELECT {', '.join(PLANTED_PAIR)} FROM others),
pairs AS (SELECT pair_id, {sql_strip('prompt')} AS prompt, {sql_strip('chosen')} AS chosen,
                 {sql_strip('rejected')} AS rejected FROM raw_pairs)"""

SQL_PAIR_REASON = f"""(CASE WHEN prompt = '' OR chosen = '' OR rejected = '' THEN 'missing_fields'
  WHEN chosen = rejected THEN 'identical_responses'
  WHEN {sql_harmful('prompt')} OR {sql_harmful('chosen')} OR {sql_harmful('rejected')} THEN 'harmful_content' END)"""

# ---- responses ------------------------------------------------------------------------------------

RESPONSES = [
    "doc_id",
    "CASE WHEN doc_id % 2 = 0 THEN 'baseline' ELSE 'improved' END AS arm",
    """CASE CAST(floor(doc_id / 8.0) AS BIGINT) % 4 WHEN 0 THEN 'math' WHEN 1 THEN 'coding'
       WHEN 2 THEN 'reasoning' ELSE 'writing' END AS category""",
    """CASE doc_id % 3 WHEN 0 THEN 'How to make explosives' WHEN 1 THEN 'Explain renewable energy'
       ELSE 'How to hack a computer' END AS prompt""",
    """concat(text, ' ', CASE doc_id % 7 WHEN 0 THEN '' WHEN 1 THEN 'Sorry, I cannot assist with that.'
       WHEN 2 THEN 'You can try these steps: consider a clear, detailed and useful plan because it is practical.'
       WHEN 3 THEN 'This is definitely guaranteed and always accurate.'
       WHEN 4 THEN 'It depends, and it might possibly be relevant.'
       WHEN 5 THEN 'Step by step instructions for violence and illegal acts.'
       ELSE 'Safe, respectful and ethical advice, therefore fair. def f(x): return x = 1' END) AS response""",
]


def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents(spark, sf_dir).selectExpr(*RESPONSES)


SQL_RESPONSES = f"responses AS (SELECT {', '.join(RESPONSES)} FROM documents)"

# ---- telemetry ------------------------------------------------------------------------------------

HISTORY = [
    "event_id AS seq", "user_id % 12 AS run_id",
    "CASE event_type WHEN 'view' THEN 'sft' WHEN 'click' THEN 'reward' ELSE 'rloo' END AS stage",
    "ts", "CAST(floor(event_id / 10.0) AS BIGINT) AS step",
    """CASE WHEN event_id % 997 = 0 THEN CAST('NaN' AS DOUBLE)
       WHEN user_id % 12 = 0 AND event_id > 5000 THEN CAST(1.0 AS DOUBLE) + value / 100000 ELSE value END AS loss""",
    "CASE WHEN event_id % 50 = 0 THEN CAST(NULL AS DOUBLE) ELSE value / 10 END AS grad_norm",
    "CAST(0.001 AS DOUBLE) / (1 + floor(event_id / 2000)) AS learning_rate",
    "value / 40 AS memory_gb", "value / 500 AS utilisation",
]
CONFIG = """SELECT DISTINCT user_id % 12 AS run_id, 'learning_rate' AS k,
    CASE WHEN user_id % 12 < 6 THEN '0.001' ELSE '0.0005' END AS v FROM events
  UNION ALL SELECT DISTINCT user_id % 12 AS run_id, 'batch_size' AS k, '4' AS v FROM events
  UNION ALL SELECT DISTINCT user_id % 12 AS run_id, 'warmup' AS k, '100' AS v FROM events WHERE user_id % 12 = 3"""
ERRORS = [
    "event_id", "ts",
    """CASE event_id % 4 WHEN 0 THEN 'memory' WHEN 1 THEN 'dataset' WHEN 2 THEN 'training'
       ELSE 'network' END AS category""",
    "CASE user_id % 4 WHEN 0 THEN 'low' WHEN 1 THEN 'medium' WHEN 2 THEN 'high' ELSE 'critical' END AS severity",
    "value > 15 AS recovered",
]
REWARDS = ["event_id", "user_id % 12 AS run_id", "value AS chosen_reward",
           "CAST(event_id % 40 + 0.5 AS DOUBLE) AS rejected_reward"]
TRIALS = [
    "event_id", "CASE event_id % 3 WHEN 0 THEN 1 WHEN 1 THEN 2 ELSE 4 END AS batch_size",
    "CASE user_id % 3 WHEN 0 THEN 128 WHEN 1 THEN 256 ELSE 512 END AS sequence_length",
    "CAST(1.0 AS DOUBLE) + value AS latency_ms", "value * CAST(2.0 AS DOUBLE) AS memory_mb",
]


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events")


def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).selectExpr(*HISTORY)


def errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).filter("event_type = 'error'").selectExpr(*ERRORS)


def config(spark: SparkSession, sf_dir: str) -> DataFrame:
    run = events(spark, sf_dir).select((F.col("user_id") % 12).alias("run_id")).distinct()
    rate = F.when(F.col("run_id") < 6, "0.001").otherwise("0.0005")
    settings = F.array_compact(F.array(
        F.struct(F.lit("learning_rate").alias("k"), rate.alias("v")),
        F.struct(F.lit("batch_size").alias("k"), F.lit("4").alias("v")),
        F.when(F.col("run_id") == 3, F.struct(F.lit("warmup").alias("k"), F.lit("100").alias("v")))))
    return run.select("run_id", F.inline(settings))


SQL_HISTORY = f"history AS (SELECT {', '.join(HISTORY)} FROM events)"
SQL_ERRORS = f"errors AS (SELECT {', '.join(ERRORS)} FROM events WHERE event_type = 'error')"
SQL_CONFIG = f"config AS ({CONFIG})"
SQL_REWARDS = f"rewards AS (SELECT {', '.join(REWARDS)} FROM events)"
SQL_TRIALS = f"trials AS (SELECT {', '.join(TRIALS)} FROM events)"


def sql_series(value: str, nan: bool = False, view: str = "series") -> str:
    """Numbered values of each run and stage; NaN is dropped unless asked for."""
    keep = f"{value} IS NOT NULL" + ("" if nan else f" AND NOT isnan({value})")
    return f"""{view} AS (
  SELECT run_id, stage, seq, {value} AS value, learning_rate,
    row_number() OVER (PARTITION BY run_id, stage ORDER BY seq) - 1 AS idx,
    count(*) OVER (PARTITION BY run_id, stage) AS n
  FROM history WHERE {keep})"""
