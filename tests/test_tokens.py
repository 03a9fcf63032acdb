"""Vocabulary, encoding, loss masks, batches, samples and splits."""

import re

import pandas as pd
import pytest
from pyspark.sql import functions as F

from alignlake.functions.chat import MESSAGES_TYPE
from alignlake.operators import sampling, tokens

PATTERN = re.compile(r"<\|(?:system|user|assistant|end)\|>|\w+|[^\w\s]")


def mask(text, length):
    """Kept positions, by walking the tokens the way the survey describes."""
    toks = PATTERN.findall(text)[:length]
    keep, i = set(), 0
    if "<|assistant|>" in text:
        while i < len(toks):
            if toks[i] == "<|assistant|>":
                i += 1
                while i < len(toks) and toks[i] != "<|end|>":
                    keep.add(i)
                    i += 1
            i += 1
        return toks, keep
    for heading in ("Response", "Answer", "Output", "Assistant"):
        for i in range(len(toks) - 1):
            if toks[i] == heading and toks[i + 1] == ":":
                return toks, set(range(i + 2, len(toks)))
    return toks, set(range(len(toks) // 2, len(toks)))


TEXTS = [
    "<|user|>\nhi there<|end|>\n<|assistant|>\nyes, sure<|end|>\n<|user|>\nmore<|end|>\n<|assistant|>\nok<|end|>",
    "<|user|>\nhi<|end|>\n<|assistant|>\nno end here",
    "<|assistant|>\nnested <|assistant|> mark<|end|> tail",
    "<|user|>\none two three four five six seven eight nine ten eleven<|end|><|assistant|>late<|end|>",
    "Question: x Answer: y z", "Answer: a Response: b c", "just plain words without marks", "", "one",
]


def test_loss_mask_against_row_oracle(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "i int, text string")
    encoded = tokens.with_labels(tokens.tokenized(df, tokens.vocabulary(df, size=100), max_length=12))
    for row in encoded.orderBy("i").collect():
        toks, keep = mask(row.text, 12)
        assert row.tokens == toks
        assert row.labels == [t if p in keep else -100 for p, t in enumerate(row.input_ids)]
        assert row.attention_mask == [1] * len(toks)


def test_vocabulary_order_unknowns_and_reserved(spark):
    df = spark.createDataFrame([("b a b <|end|>",), ("a c b",)], "text string")
    vocab = {r.token: r.token_id for r in tokens.vocabulary(df, size=2).collect()}
    assert vocab == {**{t: i for i, t in enumerate(tokens.RESERVED)}, "b": 6, "a": 7}
    got = tokens.tokenized(df, tokens.vocabulary(df, size=2)).collect()
    assert [r.input_ids for r in got] == [[6, 7, 6, 5], [7, 1, 6]]
    null = spark.createDataFrame([(None,)], "text string")
    assert tokens.tokenized(null, tokens.vocabulary(df, size=9)).first().input_ids is None


def test_encoding_needs_no_shuffle_of_rows(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    plan = tokens.tokenized(docs, tokens.vocabulary(docs, size=1000))._jdf.queryExecution().optimizedPlan().toString()
    assert not any(line.startswith(("Join", "Aggregate", "Sort", "Window")) for line in plan.splitlines())


def test_user_tokenizer_and_collator(spark):
    df = spark.createDataFrame([(1, "abc"), (2, None), (3, "a")], "i int, text string")
    got = tokens.with_user_tokenizer(df, lambda: (lambda texts: [[ord(c) for c in t] for t in texts]), max_length=2).orderBy("i").collect()
    assert [r.input_ids for r in got] == [[97, 98], None, [97]]

    def longest(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"batch_id": [pdf.batch_id.iloc[0]], "rows": [len(pdf)]})

    batches = tokens.collate_with(tokens.with_batch(df, "i", 2), longest, "batch_id bigint, rows bigint")
    assert sorted((r.batch_id, r.rows) for r in batches.collect()) == [(0, 2), (1, 1)]


def test_chat_batches_are_padded_to_the_longest(spark):
    df = spark.createDataFrame([(i, [7] * n, [1] * n, [-100] * n) for i, n in enumerate([2, 4, 1])],
                               "i int, input_ids array<int>, attention_mask array<int>, labels array<int>")
    got = tokens.collate(tokens.with_batch(df, "i", 2, rows_per_bucket=1)).orderBy("batch_id").collect()
    assert got[0].input_ids == [[7, 7, 0, 0], [7] * 4] and got[0].attention_mask == [[1, 1, 0, 0], [1] * 4]
    assert got[0].labels == [[-100] * 4, [-100] * 4] and got[1].input_ids == [[7]] and got[1].batch_rows == 1


def test_preference_sides_are_padded_independently(spark):
    schema = ", ".join(f"{s}_{c} array<int>" for s in ("chosen", "rejected") for c in ("input_ids", "attention_mask"))
    df = spark.createDataFrame([(0, [1], [1], [2] * 3, [1] * 3), (1, [1, 1], [1, 1], [2], [1])], f"i int, {schema}")
    got = tokens.collate(tokens.with_batch(df, "i", 8)).first()
    assert got.chosen_input_ids == [[1, 0], [1, 1]] and got.rejected_input_ids == [[2, 2, 2], [2, 0, 0]]
    assert got.rejected_attention_mask == [[1, 1, 1], [1, 0, 0]]


@pytest.mark.parametrize("total, k", [(1000, 70), (50, 100), (99, 10)])
def test_stride_sample(spark, total, k):
    got = sampling.stride_sample(spark.range(total), "id", k, rows_per_bucket=37)
    assert sorted(r.id for r in got.collect()) == list(range(0, total, max(1, total // k)))[:k]


def test_splits(spark):
    small = sampling.train_eval_split(spark.range(7), "id", "id", mode="position")
    assert [r.id for r in small.filter("split = 'eval'").orderBy("id").collect()] == [5, 6]
    large = sampling.train_eval_split(spark.range(2001), "id", "id", mode="exact", rows_per_bucket=100)
    assert large.filter("split = 'eval'").count() == 401
    hashed = sampling.train_eval_split(spark.range(5000), "id", "id")
    assert 900 < hashed.filter("split = 'eval'").count() < 1100
    assert hashed.exceptAll(sampling.train_eval_split(spark.range(5000), "id", "id")).count() == 0


def test_seeded_sample_and_shuffle(spark):
    df = spark.range(500)
    sample = [r.id for r in sampling.seeded_sample(df, "id", 20).collect()]
    assert len(set(sample)) == 20 and sample == [r.id for r in sampling.shuffled(df, "id").limit(20).collect()]
    assert sample != [r.id for r in sampling.shuffled(df, "id", seed=1).limit(20).collect()]
    placed = sampling.with_shuffle_position(df, "id", rows_per_bucket=50).orderBy("position").limit(20)
    assert sample == [r.id for r in placed.collect()]


def test_head_and_findings(spark):
    df = spark.range(10).withColumn("notes", F.array(F.lit("a"), F.lit("b")))
    assert sampling.head(df, [F.desc("id")], 2).select("id").collect()[0].id == 9
    assert sampling.head(df, ["id"], 0).count() == 10
    assert [(r.id, r.finding) for r in sampling.first_findings(df, "notes", ["id"], 3).collect()] == [
        (0, "a"), (0, "b"), (1, "a")]


def test_messages_type_is_stable():
    assert MESSAGES_TYPE == "array<struct<role:string,content:string>>"


def test_user_tokenizer_gets_few_characters_at_once(spark):
    """The ids tell how many characters a call got; only a text that is longer by itself may exceed the bound."""
    df = spark.range(0, 60, 1, 1).select("id", F.when(F.col("id") % 10 != 3, F.repeat(F.lit("x"), F.when(F.col("id") == 7, 2_000_000).otherwise(100_000))).alias("text"))
    got = {r.id: r.input_ids for r in tokens.with_user_tokenizer(df, lambda: (lambda texts: [[sum(map(len, texts)), len(t)] for t in texts])).collect()}
    assert all(got[i] is None if i % 10 == 3 else got[i][1] == (2_000_000 if i == 7 else 100_000) for i in range(60))
    assert all(ids[0] <= tokens.USER_CHARACTERS for i, ids in got.items() if ids and i != 7) and got[7][0] == 2_000_000
