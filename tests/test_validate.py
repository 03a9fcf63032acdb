"""Row checks, reject reasons, reports and gates."""

import pytest
from pyspark.sql import functions as F

from alignlake.functions.chat import MESSAGES_TYPE
from alignlake.operators import reports, validate
from alignlake.plans import jobs


def test_raw_chat_batch_of_three(spark):
    df = spark.createDataFrame([
        ([("user", "Hello there"), ("assistant", "Hi, how can I help?")], None, None),
        (None, None, None), (None, "What is this thing?", "A short answer.")],
        f"messages {MESSAGES_TYPE}, instruction string, response string")
    report = reports.validation_report(df, "chat").first()
    assert (report.total, report.valid, report.invalid, report.is_valid) == (3, 2, 1, False)


def test_raw_chat_warnings(spark):
    rows = [([("user", "ok"), ("user", " "), ("user", "a" * 10001), ("user", "a gun")],), ([("user", "fine"), ("x", "y")],)]
    got = validate.check_raw_chat(spark.createDataFrame(rows, f"messages {MESSAGES_TYPE}")).collect()
    assert got[0].warnings == ["short_content[0]", "empty_content[1]", "long_content[2]", "harmful_content[3]", "no_assistant"]
    assert (got[1].is_valid, got[1].warnings) == (False, ["bad_role[1]"])


def test_flat_shapes_that_only_extraction_reads_are_invalid(spark):
    df = spark.createDataFrame([("q", "a")], "question string, answer string")
    assert validate.check_raw_chat(df).first().warnings == ["no_format"]


def test_empty_table_is_not_valid(spark):
    df = spark.createDataFrame([], "prompt string, chosen string, rejected string")
    assert reports.validation_report(df, "preference").first().is_valid is False


@pytest.mark.parametrize("row, valid, warnings", [
    (("What is a good book?", "A fine long answer", "Another long answer"), True, []),
    (("short", "same answer here", "same answer here"), True, ["identical", "short_prompt"]),
    (("", "x", "y"), False, ["empty_prompt"]), ((None, "x", "y"), False, ["missing_prompt"]),
    (("Tell me about a weapon", "no such answer", "b" * 10001), True, ["long_rejected", "harmful_prompt"])])
def test_raw_preference(spark, row, valid, warnings):
    df = spark.createDataFrame([row], "prompt string, chosen string, rejected string")
    got = validate.check_raw_preference(df).first()
    assert (got.is_valid, got.warnings) == (valid, warnings)
    assert got.asDict().keys() == {"prompt", "chosen", "rejected", "is_valid", "warnings"}


def test_content_filters(spark):
    chats = spark.createDataFrame(
        [(1, [("user", "a gun")]), (2, [("user", "tea")]), (3, None), (4, [("user", None)])], f"i int, messages {MESSAGES_TYPE}")
    assert sorted(r.i for r in validate.filter_content(chats, "chat").collect()) == [2, 3, 4]
    pairs = spark.createDataFrame([("p", "c", "kill"), ("p", None, "r")], "prompt string, chosen string, rejected string")
    assert validate.filter_content(pairs, "preference").count() == 1
    assert validate.filter_content(pairs, "other").count() == 2


PROCESSED = "input_ids array<int>, attention_mask array<int>, labels array<int>, text string"


@pytest.mark.parametrize("row, errors, warnings", [
    (([5, 6, 7], [1, 1, 1], [-100, 6, 7], "fine"), [], []),
    (([5, 6, 7], [1, 1, 1], [5, 6, 7], " "), [], ["none_masked", "blank_text"]),
    (([5, -6], [1, 2], [-100, -100], "a gun"), ["short_sequence", "negative_input_ids", "bad_attention_mask"],
     ["all_masked", "harmful_text"]),
    (([5, 6, 7], [1, 1], [-100, 9, 7], "x"), ["unequal_lengths"], ["foreign_labels"]),
    (([], [1], None, "x"), ["empty_input_ids", "missing_labels"], []),
    (([1] * 9, [1] * 9, [-100] * 8 + [1], "x"), ["long_sequence"], [])])
def test_processed_chat(spark, row, errors, warnings):
    got = validate.check_processed_chat(spark.createDataFrame([row], PROCESSED), max_length=8).first()
    assert (got.errors, got.warnings) == (errors, warnings)


def test_gates(spark):
    good = spark.createDataFrame([(1, [5, 6, 7], [1, 1, 1], [-100, 6, 7])],
                                 "i int, input_ids array<int>, attention_mask array<int>, labels array<int>")
    assert validate.format_gate(good, "chat", 8, "i").first().passed is True
    assert validate.format_gate(good, "chat", 2, "i").first().passed is False
    assert validate.format_gate(good.limit(0), "chat", 8, "i").first().passed is False
    assert validate.format_gate(good, "other", 8, "i").first().passed is False
    assert validate.stage_input_ok(good, "chat", "i") and validate.stage_input_ok(good, "prompts", "i")
    assert not validate.stage_input_ok(good, "preference", "i") and not validate.stage_input_ok(good.limit(0), "chat", "i")
    assert good.filter(validate.processed_row_ok(good, "chat")).count() == 1
    assert good.drop("labels").filter(validate.processed_row_ok(good.drop("labels"), "chat")).count() == 0


def test_stage_completion(spark):
    rows = [(1, 2.0, 3.0), (2, float("nan"), 3.0), (3, float("inf"), 3.0), (4, 101.0, 3.0), (5, 1.0, 0.0), (6, None, None)]
    got = validate.stage_completion(spark.createDataFrame(rows, "i int, final_loss double, steps_per_second double"))
    assert [r.passed for r in got.orderBy("i").collect()] == [True, False, False, True, False, True]
    assert [r.high_loss for r in got.orderBy("i").collect()] == [False, False, False, True, False, False]


def test_prepare_table(spark):
    rows = [(i, [("user", f"Question number {i} please"), ("assistant", "A calm answer" if i else "Use a gun")])
            for i in range(40)]
    df = spark.createDataFrame(rows, f"i int, messages {MESSAGES_TYPE}")
    done = jobs.prepare_table(df, "chat", "i", 64, 1000)
    assert done.count() == 39
    row = done.orderBy("i").first()
    assert len(row.input_ids) == len(row.labels) == row.token_count and row.original_length == len(row.text)
    with pytest.raises(ValueError):
        jobs.prepare_table(df.withColumn("messages", F.array().cast(MESSAGES_TYPE)), "chat", "i", 64, 1000)
    with pytest.raises(ValueError):
        jobs.prepare_table(df, "other", "i", 64, 1000)


def test_health_report(spark):
    tiny = spark.createDataFrame([(1, "p", "c", "c"), (2, "p", "", "r")], "i int, prompt string, chosen string, rejected string")
    got = reports.health_report(tiny).first()
    assert (got.detected_kind, got.findings) == ("preference", "identical_responses:1,missing_fields:1")
    assert got.recommendations == "review_quality,small_table"
    other = reports.health_report(tiny.select("i")).first()
    assert (other.detected_kind, other.recommendations) == ("unknown", "custom_preprocessing,small_table")
    assert reports.health_report(tiny.limit(0)).first().recommendations == "check_loading"


def test_health_report_sees_words_at_line_breaks_and_quotes(spark):
    flat = spark.createDataFrame([(1, "a\nkill\tb", "fine"), (2, "fine", "cut\nmyself"), (3, "skill", None)], "i int, instruction string, response string")
    assert reports.health_report(flat).first().findings == "harmful_content:2"
    told = spark.createDataFrame([(1, [("user", "x\r\nhack")], {"k": "fine"}), (2, [("user", "fine")], {"k": "x\nbomb"}), (3, [("user", "fine")], None)],
                                 "i int, messages array<struct<role:string,content:string>>, more map<string,string>")
    assert reports.health_report(told).first().findings == "harmful_content:2"
