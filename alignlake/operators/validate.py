"""Row checks: reject reasons, warning lists, filters and dataset-level gates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from alignlake.functions import chat, patterns, text
from alignlake.operators import normalize, ordering

MASKED = -100


def _list(*entries: Column) -> Column:
    return F.array_compact(F.array(*entries).cast("array<string>"))


def _at(code: str, index: Column) -> Column:
    return F.concat(F.lit(f"{code}["), index.cast("string"), F.lit("]"))


def _message_warnings(messages: Column, raw: bool) -> Column:
    """Warning codes with message positions. Raw checks also report short and unsafe contents."""

    def notes(content: Column, i: Column) -> Column:
        size = F.length(content)
        by_size = F.when(size == 0, _at("empty_content", i))
        if raw:
            by_size = by_size.when(size < 3, _at("short_content", i))
        by_size = by_size.when(size > 10000, _at("long_content", i))
        unsafe = F.when(patterns.is_harmful(content), _at("harmful_content", i)) if raw else F.lit(None).cast("string")
        return _list(by_size, unsafe)

    stripped = F.transform(messages, lambda m: text.strip(m["content"]))
    no_answer = F.when(~chat.has_assistant(messages), F.lit("no_assistant"))
    return F.concat(F.flatten(F.transform(stripped, notes)), _list(no_answer))


def check_messages(df: DataFrame, messages: str = "messages") -> DataFrame:
    """Add ``is_valid`` and ``warnings`` for a message list; an invalid row warns with its fault."""
    col = F.col(messages)
    return (
        df.withColumn("_fault", chat.chat_fault(col))
        .withColumn("is_valid", F.col("_fault").isNull())
        .withColumn("warnings", F.when(F.col("is_valid"), _message_warnings(col, raw=False))
                    .otherwise(F.array("_fault")))
        .drop("_fault")
    )


def check_raw_chat(df: DataFrame) -> DataFrame:
    """Add ``is_valid`` and ``warnings`` for an unprocessed chat row.

    Accepts ``messages``, ``conversations`` or an instruction with a response or output; other shapes
    are invalid here even where extraction can read them.
    """
    question = normalize.first_present(df, ["instruction"])
    answer = normalize.first_present(df, ["response", "output"])
    flat = F.when(question.isNotNull() & answer.isNotNull(),
                  F.array(chat.message("user", question), chat.message("assistant", answer)))
    source = F.coalesce(normalize.message_list(df, ["messages", "conversations"]), flat)
    fault = F.when(F.col("_source").isNull(), F.lit("no_format")).otherwise(chat.chat_fault(F.col("_source")))
    return (
        df.withColumn("_source", source)
        .withColumn("_fault", fault)
        .withColumn("is_valid", F.col("_fault").isNull())
        .withColumn("warnings", F.when(F.col("is_valid"), _message_warnings(F.col("_source"), raw=True))
                    .otherwise(F.array("_fault")))
        .drop("_source", "_fault")
    )


def check_raw_preference(df: DataFrame, flags: str | None = None) -> DataFrame:
    """Add ``is_valid`` and ``warnings`` for an unprocessed preference row.

    ``flags`` is a prefix under which the unsafe-word flag of each field stays available, so quality
    scoring need not search the texts again.
    """
    fields = {"prompt": 5000, "chosen": 10000, "rejected": 10000}
    staged = df.withColumns({
        f"_{f}": text.strip(F.col(f).cast("string")) if f in df.columns else F.lit(None).cast("string")
        for f in fields
    })
    fault = F.lit(None).cast("string")
    for f in reversed(fields):
        fault = F.when(F.col(f"_{f}") == "", F.lit(f"empty_{f}")).otherwise(fault)
    for f in reversed(fields):
        fault = F.when(F.col(f"_{f}").isNull(), F.lit(f"missing_{f}")).otherwise(fault)
    notes = [F.when(F.col("_chosen") == F.col("_rejected"), F.lit("identical"))]
    for f, most in fields.items():
        size = F.length(f"_{f}")
        notes.append(F.when(size < 10, F.lit(f"short_{f}")).when(size > most, F.lit(f"long_{f}")))
    unsafe = {f: f"{flags or '_unsafe_'}{f}" for f in fields}
    notes += [F.when(F.col(unsafe[f]), F.lit(f"harmful_{f}")) for f in fields]
    done = (
        staged.withColumns({unsafe[f]: patterns.is_harmful(F.col(f"_{f}")) for f in fields})
        .withColumn("_fault", fault)
        .withColumn("is_valid", F.col("_fault").isNull())
        .withColumn("warnings", F.when(F.col("is_valid"), _list(*notes)).otherwise(F.array("_fault")))
        .drop("_fault", *[f"_{f}" for f in fields])
    )
    return done if flags else done.drop(*unsafe.values())


def keep_chat(df: DataFrame) -> Column:
    """True unless a message of the row is unsafe. Rows without readable content are kept."""
    question = normalize.first_present(df, ["instruction"])
    answer = F.coalesce(normalize.first_present(df, ["response", "output"]), F.lit(""))
    flat = F.when(question.isNotNull(),
                  F.array(chat.message("user", question), chat.message("assistant", answer)))
    source = F.coalesce(normalize.message_list(df, ["messages", "conversations"]), flat)
    return ~F.coalesce(F.exists(source, lambda m: patterns.is_harmful(m["content"])), F.lit(False))


def keep_preference(df: DataFrame) -> Column:
    """True unless prompt, chosen or rejected is unsafe."""
    keep = F.lit(True)
    for f in ("prompt", "chosen", "rejected"):
        if f in df.columns:
            keep = keep & ~patterns.is_harmful(F.col(f).cast("string"))
    return keep


def filter_content(df: DataFrame, kind: str) -> DataFrame:
    """Drop unsafe rows of a ``chat`` or ``preference`` table; other kinds pass unchanged."""
    if kind == "chat":
        return df.filter(keep_chat(df))
    if kind == "preference":
        return df.filter(keep_preference(df))
    return df


def retention(df: DataFrame, keep: Column) -> DataFrame:
    """Rows before and after a filter and the share that stays."""
    return df.agg(F.count("*").alias("total"), F.count_if(keep).alias("kept"),
                  F.avg(keep.cast("double")).alias("kept_ratio"))


def token_array_ok(ids: Column, mask: Column, max_length: int, labels: Column | None = None) -> Column:
    """Arrays present, equally long, and 3 to ``max_length`` tokens."""
    size = F.coalesce(F.size(ids), F.lit(-1))
    ok = (size >= 3) & (size <= max_length) & (size == F.coalesce(F.size(mask), F.lit(-1)))
    return ok if labels is None else ok & (size == F.coalesce(F.size(labels), F.lit(-1)))


def chat_reason(df: DataFrame, max_length: int, validate: bool = True) -> DataFrame:
    """Add ``reason``: why a tokenized chat row is dropped, or ``successful``. The first match wins."""
    tokenized_ok = token_array_ok(F.col("input_ids"), F.col("attention_mask"), max_length, F.col("labels"))
    reason = F.when(F.coalesce(F.size("messages"), F.lit(0)) <= 0, F.lit("no_messages"))
    reason = reason.when(chat.chat_fault(F.col("messages")).isNotNull(), F.lit("invalid_structure"))
    reason = reason.when(F.col("input_ids").isNull(), F.lit("tokenization_errors"))
    if validate:
        reason = reason.when(~tokenized_ok, F.lit("invalid_tokenization"))
    return df.withColumn("reason", reason.otherwise(F.lit("successful")))


def preference_text_reason(validate: bool = True) -> Column:
    """Reject reason of a preference triple that needs no tokens; NULL when the row passes."""
    missing = (F.col("prompt") == "") | (F.col("chosen") == "") | (F.col("rejected") == "")
    reason = F.when(missing, F.lit("missing_fields"))
    if validate:
        unsafe = (patterns.is_harmful(F.col("prompt")) | patterns.is_harmful(F.col("chosen"))
                  | patterns.is_harmful(F.col("rejected")))
        reason = (reason.when(F.col("chosen") == F.col("rejected"), F.lit("identical_responses"))
                  .when(unsafe, F.lit("harmful_content")))
    return reason


def preference_reason(df: DataFrame, max_length: int, validate: bool = True) -> DataFrame:
    """Add ``reason`` for a tokenized preference row. The first match wins."""
    reason = F.coalesce(
        preference_text_reason(validate),
        F.when(F.col("chosen_input_ids").isNull() | F.col("rejected_input_ids").isNull(),
               F.lit("tokenization_errors")))
    if validate:
        ok = F.lit(True)
        for side in ("chosen", "rejected"):
            ok = ok & token_array_ok(F.col(f"{side}_input_ids"), F.col(f"{side}_attention_mask"), max_length)
        reason = F.coalesce(reason, F.when(~ok, F.lit("invalid_tokenization")))
    return df.withColumn("reason", F.coalesce(reason, F.lit("successful")))


def successful(df: DataFrame) -> DataFrame:
    """Keep the successful rows.

    They pass through a one-element explode: a plain filter would move below the projections and
    repeat rendering and tokenizing inside its condition.
    """
    kept = F.struct(*[F.col(c) for c in df.columns if c != "reason"])
    passed = F.when(F.col("reason") == "successful", F.array(kept))
    return df.select(F.explode(passed).alias("_row")).select("_row.*")


def length_filter_reason(df: DataFrame, max_length: int = 512) -> DataFrame:
    """Reason of the simple text filter: empty text, missing messages, too long, or valid."""
    missing = F.col("messages").isNull() if "messages" in df.columns else F.lit(True)
    return df.withColumn(
        "reason",
        F.when(text.is_blank(F.col("text")), F.lit("empty_examples"))
        .when(missing, F.lit("missing_fields"))
        .when(F.coalesce(F.col("length"), F.lit(0)) > max_length * 4, F.lit("too_long_examples"))
        .otherwise(F.lit("valid_examples")))


def has_fields(df: DataFrame, names: list[str]) -> Column:
    """True when every named array column exists and holds at least one entry in the row."""
    ok = F.lit(True)
    for n in names:
        ok = ok & ((F.coalesce(F.size(n), F.lit(0)) > 0) if n in df.columns else F.lit(False))
    return ok


CHAT_FIELDS = ["input_ids", "attention_mask", "labels"]
PREFERENCE_FIELDS = ["chosen_input_ids", "chosen_attention_mask", "rejected_input_ids", "rejected_attention_mask"]


def processed_row_ok(df: DataFrame, kind: str) -> Column:
    """Required arrays of a processed row are there, not empty and of equal length."""
    if kind == "chat":
        sizes = [F.size(n) for n in CHAT_FIELDS if n in df.columns]
        same = [(sizes[0] == s) for s in sizes[1:]]
        names = CHAT_FIELDS
    else:
        names = PREFERENCE_FIELDS
        same = [F.size(f"{side}_input_ids") == F.size(f"{side}_attention_mask")
                for side in ("chosen", "rejected") if f"{side}_input_ids" in df.columns]
    ok = has_fields(df, names)
    for s in same:
        ok = ok & F.coalesce(s, F.lit(False))
    return ok


def _field_faults(df: DataFrame, names: list[str]) -> list[Column]:
    """Missing or empty required fields. A column that is absent is missing in every row."""
    faults = []
    for n in names:
        if n not in df.columns:
            faults.append(F.lit(f"missing_{n}"))
        else:
            faults.append(F.when(F.col(n).isNull(), F.lit(f"missing_{n}"))
                          .when(F.size(n) == 0, F.lit(f"empty_{n}")))
    return faults


def _text_notes(df: DataFrame, names: list[str]) -> list[Column]:
    notes = []
    for n in names:
        if n in df.columns:
            notes.append(F.when(text.is_blank(F.col(n)), F.lit(f"blank_{n}"))
                         .when(patterns.is_harmful(F.col(n)), F.lit(f"harmful_{n}")))
    return notes


def _size_faults(ids: str, label: str, max_length: int) -> Column:
    size = F.size(ids)
    return F.when(size < 3, F.lit(f"short_{label}")).when(size > max_length, F.lit(f"long_{label}"))


def _value_faults(ids: str, mask: str) -> list[Column]:
    return [
        F.when(F.exists(ids, lambda t: t < 0), F.lit(f"negative_{ids}")),
        F.when(~F.forall(mask, lambda m: m.isin(0, 1)), F.lit(f"bad_{mask}")),
    ]


def check_processed_chat(df: DataFrame, max_length: int) -> DataFrame:
    """Add ``errors`` and ``warnings`` of a tokenized chat row."""
    basics = _list(*_field_faults(df, CHAT_FIELDS))
    if any(n not in df.columns for n in CHAT_FIELDS):
        return df.withColumn("errors", basics).withColumn("warnings", F.array().cast("array<string>"))
    sizes = [F.size(n) for n in CHAT_FIELDS]
    faults = _list(
        F.when((sizes[0] != sizes[1]) | (sizes[0] != sizes[2]), F.lit("unequal_lengths")),
        _size_faults("input_ids", "sequence", max_length), *_value_faults("input_ids", "attention_mask"))
    kept = F.size(F.filter("labels", lambda v: v != MASKED))
    foreign = F.size(F.array_except("labels", F.array_union("input_ids", F.array(F.lit(MASKED))))) > 0
    notes = _list(
        F.when(foreign, F.lit("foreign_labels")),
        F.when(kept == 0, F.lit("all_masked")).when(kept == F.size("labels"), F.lit("none_masked")),
        *_text_notes(df, ["text"]))
    return _with_findings(df, basics, faults, notes)


def check_processed_preference(df: DataFrame, max_length: int) -> DataFrame:
    """Add ``errors`` and ``warnings`` of a tokenized preference row."""
    basics = _list(*_field_faults(df, PREFERENCE_FIELDS))
    if any(n not in df.columns for n in PREFERENCE_FIELDS):
        return df.withColumn("errors", basics).withColumn("warnings", F.array().cast("array<string>"))
    sides = ("chosen", "rejected")
    faults = [F.when(F.size(f"{s}_input_ids") != F.size(f"{s}_attention_mask"), F.lit(f"unequal_{s}"))
              for s in sides]
    faults += [_size_faults(f"{s}_input_ids", s, max_length) for s in sides]
    for s in sides:
        faults += _value_faults(f"{s}_input_ids", f"{s}_attention_mask")
    notes = _text_notes(df, ["chosen_text", "rejected_text", "prompt"])
    if "chosen_text" in df.columns and "rejected_text" in df.columns:
        notes.append(F.when(text.strip(F.col("chosen_text")) == text.strip(F.col("rejected_text")),
                            F.lit("identical")))
    return _with_findings(df, basics, _list(*faults), _list(*notes))


def _with_findings(df: DataFrame, basics: Column, faults: Column, notes: Column) -> DataFrame:
    """Later checks only apply to rows whose required fields are all there."""
    complete = F.size("_basics") == 0
    return (
        df.withColumn("_basics", basics)
        .withColumn("errors", F.when(complete, faults).otherwise(F.col("_basics")))
        .withColumn("warnings", F.when(complete, notes).otherwise(F.array().cast("array<string>")))
        .drop("_basics")
    )


def format_gate(df: DataFrame, kind: str, max_length: int, order_by: str, sample: int | None = None,
                rows_per_bucket: int = ordering.ROWS_PER_BUCKET) -> DataFrame:
    """One row: rows checked, rows with errors, rows with warnings, and whether the table passes.

    Checks every row by default; ``sample`` checks that many rows at an even stride instead. An empty
    table and an unknown kind fail.
    """
    from alignlake.operators.sampling import stride_sample

    rows = df if sample is None else stride_sample(df, order_by, sample, rows_per_bucket=rows_per_bucket)
    if kind == "chat":
        checked = check_processed_chat(rows, max_length)
    elif kind == "preference":
        checked = check_processed_preference(rows, max_length)
    else:
        checked = rows.withColumn("errors", F.array(F.lit("unknown_kind"))).withColumn(
            "warnings", F.array().cast("array<string>"))
    found = checked.agg(
        F.count("*").alias("checked"), F.count_if(F.size("errors") > 0).alias("with_errors"),
        F.count_if(F.size("warnings") > 0).alias("with_warnings"))
    return found.withColumn("passed", (F.col("checked") > 0) & (F.col("with_errors") == 0))


def stage_input_ok(df: DataFrame, stage: str, order_by: str) -> bool:
    """Gate before a training stage: columns there, table not empty, first row's arrays filled."""
    names = {"chat": CHAT_FIELDS, "preference": PREFERENCE_FIELDS, "prompts": CHAT_FIELDS[:2]}[stage]
    if any(n not in df.columns for n in names):
        return False
    first = df.orderBy(order_by).select(*[F.size(n).alias(n) for n in names]).limit(1).collect()
    return bool(first) and (stage == "prompts" or all((first[0][n] or 0) > 0 for n in names))


def short_text_warning(df: DataFrame, source: str = "text", least: int = 10) -> DataFrame:
    """Add ``short_text``: the stripped text has fewer than ``least`` characters."""
    return df.withColumn("short_text", F.length(text.strip(F.coalesce(F.col(source), F.lit("")))) < least)


def stage_completion(df: DataFrame) -> DataFrame:
    """Judge finished stages from ``final_loss`` and ``steps_per_second``; missing values pass."""
    loss, speed = F.col("final_loss"), F.col("steps_per_second")
    finite = ~(F.isnan(loss) | (F.abs(loss) == float("inf")))
    fault = (F.when(~finite, F.lit("invalid_loss"))
             .when(speed <= 0, F.lit("invalid_speed")))
    return (
        df.withColumn("fault", fault)
        .withColumn("passed", F.col("fault").isNull())
        .withColumn("high_loss", F.coalesce(finite & (loss > 100.0), F.lit(False)))
    )
