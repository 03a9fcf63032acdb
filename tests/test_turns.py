"""Turn tables against the row operators: hostile conversations, small ranges, one conversation with a third of all turns."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from alignlake.operators import normalize, ordering, quality, tokens, turns, validate
from alignlake.plans import jobs

SCHEMA = "conv_id long, turn long, role string, text string"
SAID = ["Hello there", "  ", "", "ok", "click", "here now", "want to", "die slowly. Or not", "end my", "life", "a. b. c", "Answer: yes", "Output", ": no",
        "x <|assistant|> y", "z <|end|> tail", "self", "harm", "overkill", "social security", "ÀÉ ß Σίσυφος Σ", "w " * 300, "no.no", None]


def conversations(seed, hot=400):
    rnd = random.Random(seed)
    rows = []
    for c in range(60):
        roles = rnd.choice([["user", "assistant"], ["user"], ["system", "user", "assistant"], ["user", "tool"], ["assistant", None]])
        for t in range(rnd.choice([1, 2, 3, 9])):
            rows.append((c, t, rnd.choice(roles), rnd.choice(SAID[:-1] if c % 5 else SAID)))
    rows += [(100, t, ["user", "assistant"][t % 2], rnd.choice(SAID[:-1])) for t in range(hot)]
    rows += [(101, None, "user", "first"), (101, 1, "assistant", "second"), (None, 0, "user", "nobody"), (None, 1, "assistant", "there")]
    return rows


@pytest.fixture(scope="module", params=[1, 2])
def both(spark, request):
    df = spark.createDataFrame(conversations(request.param), SCHEMA).repartition(4)
    return turns.numbered(df, rows_per_bucket=40), normalize.messages_from_turns(df).persist()


def test_verdicts_and_warnings_equal_those_of_rows(both):
    said, rows = both
    facts = turns.verdicts(said).persist()
    want = {r.conv_id: r for r in normalize.rendered(rows).select(
        "conv_id", F.size("messages").alias("n"), turns.chat.chat_fault(F.col("messages")).alias("fault"),
        turns.chat.has_assistant(F.col("messages")).alias("answers"), "length", validate.keep_chat(rows).alias("kept")).collect()}
    got = {r.conversation: r for r in facts.collect()}
    assert got.keys() == want.keys()
    for c, r in got.items():
        assert (r.turns, r.fault, r.is_valid, r.has_assistant, r.length, not r.harmful) == (
            want[c].n, want[c].fault, want[c].fault is None, want[c].answers, want[c].length, want[c].kept), c
    for raw, check in ((True, validate.check_raw_chat), (False, validate.check_messages)):
        listed = {r.conv_id: r.warnings for r in check(rows).collect()}
        found = {}
        for r in sorted(turns.warnings(said, facts, raw).collect(), key=lambda r: (r.pos is None, r.pos or 0)):
            found.setdefault(r.conversation, []).append(r.warning)
        assert found == {c: w for c, w in listed.items() if w}


def test_quality_equals_that_of_rows(both):
    said, rows = both
    want = {r.conv_id: r.quality for r in quality.with_chat_quality(rows).collect()}
    assert {r.conversation: r.quality for r in turns.chat_quality(said, rows_per_bucket=40).collect()} == want


@pytest.mark.parametrize("length, joined", [(2048, False), (37, False), (37, True)])
def test_processed_chats_equal_those_of_rows(both, length, joined):
    said, rows = both
    vocab = jobs.vocabulary_of(rows, "chat", 50)
    done = jobs.process_chats(rows, vocab, length).select("conv_id", "input_ids", "attention_mask", "labels", "token_count", "original_length", "reason")
    want = {r[0]: tuple(r)[1:] for r in done.collect()}
    got = {r[0]: tuple(r)[1:] for r in turns.processed(said, vocab, length, joined, rows_per_bucket=40).collect()}
    assert got == want
    assert {r.token: r.token_id for r in vocab.collect()} == {r.token: r.token_id for r in turns.vocabulary_of(said, turns.verdicts(said), 50).collect()}


def test_uncut_turns_join_to_the_whole_chat(both):
    said, rows = both
    vocab = jobs.vocabulary_of(rows, "chat", 50)
    want = {r.conv_id: (r.input_ids, r.labels) for r in jobs.process_chats(rows, vocab, 10**6).collect() if r.reason != "invalid_structure"}
    got = {}
    for r in sorted(turns.encoded(said, turns.verdicts(said), vocab, rows_per_bucket=40).collect(), key=lambda r: r.pos):
        ids, labels = got.setdefault(r.conversation, ([], []))
        assert r.start == len(ids)
        ids += r.input_ids
        labels += r.labels
    assert got == want


def test_prepared_turns_equal_prepared_chats(spark):
    rows = [(c, t, r, f"{x} {c}") for c in range(40) for t, (r, x) in enumerate([("user", "What is it"), ("assistant", "It is fine" if c % 9 else "a weapon")])]
    df = spark.createDataFrame(rows, SCHEMA)
    want = jobs.prepare_table(normalize.messages_from_turns(df), "chat", "conv_id", 64, 500).select("conv_id", "input_ids", "labels").collect()
    got = jobs.prepare_turns(df, 64, 500, rows_per_bucket=10).select("conv_id", "input_ids", "labels").collect()
    assert sorted(got) == sorted(want) and len(got) == 35
    with pytest.raises(ValueError, match="raw table"):
        jobs.prepare_turns(spark.createDataFrame([], SCHEMA), 64, 500)
    with pytest.raises(ValueError, match="raw table"):
        jobs.prepare_turns(spark.createDataFrame([(1, 0, "tool", "x")], SCHEMA), 64, 500)


def test_ranges_hold_few_rows_when_all_series_share_a_place(spark):
    df = spark.range(6000).selectExpr("id % 3000 AS conv", "id div 3000 AS turn")
    bucketed = ordering.with_bucket(df, ["turn", "conv"], rows_per_bucket=100)
    assert bucketed.groupBy("_bucket").count().agg(F.max("count")).first()[0] <= 200
    indexed = ordering.with_index(df, "turn", ["conv"], rows_per_bucket=100)
    assert indexed.filter("idx != turn").count() == 0


def test_joined_ids_equal_looked_up_ids(spark, monkeypatch):
    reserved = spark.createDataFrame(list(zip(tokens.RESERVED, range(6))), "token string, token_id bigint")
    vocab = spark.range(2_000_000).selectExpr("concat('w', id) AS token", "id + 6 AS token_id").unionByName(reserved)
    rows = [(1, ["w1", "w5", "odd", "w1999999", "w5", "<|user|>"]), (2, []), (3, None), (None, ["w70000", "odd"]), (4, ["w99999"] * 500 + ["odd"] * 300 + ["w3"])]
    df = spark.createDataFrame(rows, "k long, tokens array<string>")
    got = tokens.encode_joined(df, vocab, ["k"], near=4, hot=8)
    assert got.columns == ["k", "tokens", "input_ids"]
    found = {r.k: r.input_ids for r in got.collect()}
    monkeypatch.setattr(tokens, "LARGEST_LOOKUP", 4_000_000)
    assert found == {r.k: r.input_ids for r in tokens.encode(df, vocab).collect()}
    assert tokens.encode_joined(df.limit(0), vocab, ["k"], near=4).collect() == []


def test_vocabulary_of_any_size_is_ordered_by_frequency(spark):
    df = spark.createDataFrame([("b b b a a c d d <|user|>",), (None,), ("é d",)], "text string")
    got = sorted(((r.token_id, r.token) for r in tokens.numbered_vocabulary(df, rows_per_bucket=2).collect()))
    assert [t for _, t in got] == [*tokens.RESERVED, "b", "d", "a", "c", "é"] and [i for i, _ in got] == list(range(11))


def test_joined_encoding_makes_tokens_once(spark):
    made = spark.sparkContext.accumulator(0)

    @F.udf("array<string>")
    def cut(text):
        made.add(1)
        return text.split()

    df = spark.createDataFrame([(i, f"a b c{i}") for i in range(20)], "k int, text string").coalesce(1)
    vocab = spark.createDataFrame([("a", 6), ("b", 7), *[(f"c{i}", 8 + i) for i in range(20)]], "token string, token_id int")
    got = tokens.encode_joined(df.withColumn("tokens", cut("text")), vocab, ["k"], near=8).select("k", "input_ids").collect()
    assert {r.k: r.input_ids for r in got} == {i: [6, 7, 8 + i] for i in range(20)}
    assert made.value == 20
