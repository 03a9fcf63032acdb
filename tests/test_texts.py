"""Text expressions and quality scores against plain-Python row oracles."""

import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from alignlake.functions import chat, patterns, text
from alignlake.operators import normalize, quality

WORDS = [w for rows in patterns.HARMFUL_WORDS.values() for row in rows for w in row.split("|")]


def harmful(value):
    found = re.search(r"\b(?:" + "|".join(WORDS) + r")\b", value.lower(), re.S)
    return bool(found or re.search(r"\b(?:slur|derogatory|offensive|discriminat)\w*\b", value.lower()))


def score(value):
    """The score as the survey words it."""
    clean = value.strip()
    if not clean:
        return 0.0
    result = 0.3 if len(clean) < 10 else 0.7 if len(clean) < 50 else 1.0
    result *= 0.8 if len(clean) > 5000 else 1.0
    words = clean.lower().split()
    if len(words) > 10:
        ratio = len(set(words)) / len(words)
        result *= 0.4 if ratio < 0.3 else 0.7 if ratio < 0.5 else 1.0
    pieces = clean.split(".")
    if len(pieces) > 1:
        mean = sum(len(p.split()) for p in pieces) / len(pieces)
        result *= 0.6 if mean < 3 else 0.8 if mean > 50 else 1.0
    return result * (0.1 if harmful(value) else 1.0)


EDGES = ["", "  \n ", "ok", "yes " * 10, "yes " * 11, "a b. c. ", "x" * 5001, "x" * 10001, "word " * 60 + ".",
         "one two three. four five six. seven", "how to kill time without a plan for it, and then some more words",
         "\t tab and nbsp 　 ", "A sentence with several different words that goes on for a while. Fine."]


def scores(spark, values):
    df = spark.createDataFrame(list(enumerate(values)), "i int, t string")
    return [r.quality for r in quality.with_quality(df, "t").orderBy("i").collect()]


def test_quality_edges(spark):
    assert scores(spark, EDGES) == pytest.approx([score(v) for v in EDGES])


def test_quality_named_values(spark):
    assert scores(spark, ["ok", "yes " * 10, "yes " * 11]) == pytest.approx([0.3, 0.7, 0.28])


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="abé .\n\tkil", max_size=80), min_size=5, max_size=30))
def test_quality_of_random_text(spark, values):
    got = scores(spark, values)
    assert got == pytest.approx([score(v) for v in values])
    assert all(0 <= s <= 1 for s in got)


@pytest.mark.parametrize("value, hit", [
    ("édrug", False), ("drug.", True), ("explosives", False), ("explosive", True), ("want\nto\ndie", True),
    ("offensively", True), ("skill", False), ("KILL", True), ("self-harm", True), ("", False), (None, False)])
def test_harmful_words(spark, value, hit):
    df = spark.createDataFrame([(value,)], "t string")
    assert df.select(patterns.is_harmful(F.col("t"))).first()[0] is hit


def test_harm_survives_concatenation(spark):
    df = spark.createDataFrame([(f"{w} more",) for w in WORDS if "." not in w], "t string")
    assert df.filter(~patterns.is_harmful(F.concat(F.lit("before "), "t"))).count() == 0


def test_strip_words_and_pieces(spark):
    values = ["\t x \n", "a b. c. ", "   ", " wide\x1cgap\x85"]
    rows = spark.createDataFrame([(v,) for v in values], "t string").select(
        "t", text.strip(F.col("t")).alias("s"), text.words(text.strip(F.col("t"))).alias("w"),
        text.piece_count(F.col("t")).alias("p"), text.word_count(F.col("t")).alias("n")).collect()
    for r in rows:
        assert (r.s, r.w, r.p, r.n) == (r.t.strip(), r.t.split(), len(r.t.split(".")), len(r.t.split()))


def test_publishing_issues(spark):
    df = spark.createDataFrame([("Murder and fraud",), ("kind words",), ("my SSN, credit   card",)], "t string")
    assert [r[0] for r in df.select(patterns.publishing_issues(F.col("t"))).collect()] == [[1, 3], [], [5]]


def test_bands(spark):
    df = spark.createDataFrame([(s,) for s in (0.9, 0.8, 0.7, 0.5, 0.3, 0.1)], "quality double")
    counts = {r.band: r.rows for r in quality.band_counts(df).collect()}
    assert counts == {"excellent": 2, "good": 1, "fair": 1, "poor": 2}


def test_deviation_of_one_row_is_zero(spark):
    df = spark.createDataFrame([(0.5,)], "quality double")
    assert quality.quality_stats(df).first().std_quality == 0.0


def test_message_shapes(spark):
    schema = ("messages array<struct<role:string,content:string>>, conversation array<struct<role:string,content:string>>, "
              "instruction string, question string, system string, output string, answer string")
    rows = [
        ([("user", "a")], None, "x", None, None, None, None),
        (None, [("user", "b"), ("assistant", "c")], None, None, None, None, None),
        (None, None, None, "q", "sys", None, "ans"),
        (None, None, "i", "q", "", "o", "ans"),
        ([], None, "i", None, None, None, None),
        (None, None, None, None, None, None, None),
    ]
    got = normalize.with_messages(spark.createDataFrame(rows, schema)).collect()
    assert [[tuple(m) for m in r.messages] for r in got] == [
        [("user", "a")], [("user", "b"), ("assistant", "c")],
        [("system", "sys"), ("user", "q"), ("assistant", "ans")], [("user", "i"), ("assistant", "o")], [], []]


def test_render_and_faults(spark):
    rows = [([("user", " hi "), ("assistant", "yo")],), ([],), ([("tool", "x")],), ([("user", None)],)]
    df = normalize.rendered(spark.createDataFrame(rows, f"messages {chat.MESSAGES_TYPE}"))
    got = df.withColumn("fault", chat.chat_fault(F.col("messages"))).collect()
    assert got[0].text == "<|user|>\nhi<|end|>\n<|assistant|>\nyo<|end|>" and got[0].fault is None
    assert [(r.text, r.length, r.fault) for r in got[1:]] == [
        ("", 0, "empty_list"), ("", 0, "bad_role[0]"), ("", 0, "missing_key[0]")]


def test_first_user_text(spark):
    values = ["<|user|>\n hi <|end|>\n<|user|>\nno<|end|>", "plain", "<|user|><|end|>", "<|user|>\nopen"]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, text string")
    assert [(r.i, r.prompt) for r in normalize.first_prompts(df, ["i"]).collect()] == [(0, "hi")]


def test_long_conversation_becomes_segments(spark):
    turns = spark.range(25).select(F.lit(1).alias("conv_id"), F.col("id").alias("turn"), F.lit("user").alias("role"),
                                   F.col("id").cast("string").alias("text"))
    got = normalize.segments_from_turns(turns, 10).orderBy("segment").collect()
    assert [len(r.messages) for r in got] == [10, 10, 5]
    assert [m.content for r in got for m in r.messages] == [str(i) for i in range(25)]
    whole = normalize.messages_from_turns(turns).collect()
    assert len(whole) == 1 and [m.content for m in whole[0].messages] == [str(i) for i in range(25)]
