"""Bring rows of different shapes to chat messages, preference triples and prompts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from alignlake.functions import chat, text
from alignlake.operators import ordering

# Accepted column names, most preferred first.
MESSAGE_LISTS = ["messages", "conversations", "conversation"]
USER_FIELDS = ["instruction", "input", "question"]
ANSWER_FIELDS = ["response", "output", "answer"]
PROMPT_FIELDS = ["prompt", "question", "input"]
CHOSEN_FIELDS = ["chosen", "response_chosen", "preferred"]
REJECTED_FIELDS = ["rejected", "response_rejected", "not_preferred"]


def present(df: DataFrame, names: Sequence[str]) -> list[Column]:
    return [F.col(n) for n in names if n in df.columns]


def first_present(df: DataFrame, names: Sequence[str], kind: str = "string") -> Column:
    """First of the columns that exists and is not NULL in the row."""
    found = present(df, names)
    return F.coalesce(*found).cast(kind) if found else F.lit(None).cast(kind)


def _as_messages(df: DataFrame, name: str) -> Column:
    """The list column as role/content structs, with missing fields as NULL."""
    element = df.schema[name].dataType.elementType
    fields = element.fieldNames() if isinstance(element, T.StructType) else []

    def convert(m: Column) -> Column:
        parts = [(m[f] if f in fields else F.lit(None)).cast("string").alias(f) for f in ("role", "content")]
        return F.when(m.isNotNull(), F.struct(*parts))

    return F.transform(F.col(name), convert)


def _parsed(df: DataFrame, name: str) -> Column:
    """A text column that holds messages as JSON; other text gives NULL."""
    read = F.from_json(F.col(name), f"{chat.MESSAGES_TYPE}")
    return F.when(F.size(read) > 0, read)


def message_list(df: DataFrame, names: Sequence[str], parse_json: bool = False) -> Column:
    """First list column that is filled in the row. Text columns of these names are no lists unless ``parse_json``."""
    found = []
    for n in [n for n in names if n in df.columns]:
        kind = df.schema[n].dataType
        if isinstance(kind, T.ArrayType):
            found.append(_as_messages(df, n))
        elif isinstance(kind, T.StringType) and parse_json:
            found.append(_parsed(df, n))
    return F.coalesce(*found) if found else F.lit(None).cast(chat.MESSAGES_TYPE)


def flat_messages(df: DataFrame) -> Column:
    """Messages of an instruction-style row: optional system text, question, answer."""
    user, answer = first_present(df, USER_FIELDS), first_present(df, ANSWER_FIELDS)
    system = first_present(df, ["system"])
    return F.array_compact(F.array(
        F.when(F.coalesce(system, F.lit("")) != "", chat.message("system", system)),
        F.when(user.isNotNull(), chat.message("user", user)),
        F.when(answer.isNotNull(), chat.message("assistant", answer)),
    ))


def with_messages(df: DataFrame, out: str = "messages", parse_json: bool = False) -> DataFrame:
    """Chat messages from any supported row shape. The plan only touches columns that exist."""
    return df.withColumn(out, F.coalesce(message_list(df, MESSAGE_LISTS, parse_json), flat_messages(df)))


def with_preference(df: DataFrame) -> DataFrame:
    """Stripped ``prompt``, ``chosen`` and ``rejected``; empty text falls through to the next alias."""
    triple = {"prompt": PROMPT_FIELDS, "chosen": CHOSEN_FIELDS, "rejected": REJECTED_FIELDS}
    return df.withColumns({
        out: text.strip(text.first_filled(*present(df, names))) for out, names in triple.items()
    })


def _gathered(df: DataFrame, keys: Sequence[str], turn: str, role: str, content: str) -> DataFrame:
    entry = F.struct(F.col(turn).alias("t"), F.col(role).alias("role"), F.col(content).alias("content"))
    gathered = df.groupBy(*keys).agg(F.sort_array(F.collect_list(entry)).alias("_turns"))
    return gathered.select(
        *keys,
        F.transform("_turns", lambda m: F.struct(m["role"].alias("role"), m["content"].alias("content")))
        .alias("messages"))


def messages_from_turns(df: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role",
                        content: str = "text") -> DataFrame:
    """One row per conversation with its messages in turn order, however long the conversation is.

    A row holds a whole conversation, so verdicts about it are never made on a fragment. Callers that want
    bounded rows ask for :func:`segments_from_turns`.
    """
    return _gathered(df, [conversation], turn, role, content)


def segments_from_turns(df: DataFrame, max_turns: int, conversation: str = "conv_id", turn: str = "turn",
                        role: str = "role", content: str = "text") -> DataFrame:
    """Consecutive pieces of at most ``max_turns`` turns per row, numbered by ``segment``; no turn is lost."""
    numbered = ordering.with_index(df, turn, [conversation], name="_turn_idx", rows_per_bucket=max_turns)
    placed = numbered.withColumn("segment", F.floor(F.col("_turn_idx") / max_turns).cast("bigint"))
    return _gathered(placed, [conversation, "segment"], turn, role, content)


def exchanges_from_turns(df: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role",
                         content: str = "text", rows_per_bucket: int = ordering.ROWS_PER_BUCKET) -> DataFrame:
    """(prompt, response) rows: every user turn that an assistant turn follows directly."""
    paired = ordering.with_neighbour(
        df.select(conversation, turn, role, content), turn, [conversation],
        {role: "_next_role", content: "_next_text"}, offset=1, rows_per_bucket=rows_per_bucket)
    return (
        paired.filter((F.col(role) == "user") & (F.col("_next_role") == "assistant"))
        .select(conversation, turn, F.col(content).alias("prompt"), F.col("_next_text").alias("response"))
    )


def rendered(df: DataFrame, messages: str = "messages") -> DataFrame:
    """Add the rendered chat and its length; an unusable chat gives an empty text of length 0."""
    return (
        df.withColumn("text", F.coalesce(chat.render(F.col(messages)), F.lit("")))
        .withColumn("length", F.length("text"))
    )


def rendered_pairs(df: DataFrame) -> DataFrame:
    """Add chosen and rejected chats of a preference row, with their lengths."""
    return (
        df.withColumn("chosen_text", chat.render_pair(F.col("prompt"), F.col("chosen")))
        .withColumn("rejected_text", chat.render_pair(F.col("prompt"), F.col("rejected")))
        .withColumn("chosen_length", F.length("chosen_text"))
        .withColumn("rejected_length", F.length("rejected_text"))
    )


def first_prompts(df: DataFrame, order_by: Sequence[str | Column], limit: int | None = None) -> DataFrame:
    """First user turn per row, from the rendered text when there is one, else from the messages.

    The result has one row per usable prompt, ordered and cut at ``limit`` when that is set.
    """
    if "text" in df.columns:
        prompt = chat.first_user_text(F.col("text"))
    else:
        prompt = F.get(chat.user_contents(F.col("messages")), F.lit(0))
    found = df.withColumn("prompt", prompt).filter(F.col("prompt").isNotNull())
    return found.orderBy(*order_by).limit(limit) if limit else found


def all_prompts(df: DataFrame, order_by: Sequence[str | Column], max_prompts: int | None = None) -> DataFrame:
    """Every user turn as its own row; without messages the prompt column, else the start of a long text."""
    if "messages" in df.columns:
        found = df.select("*", F.posexplode(chat.user_contents(F.col("messages"))).alias("position", "query"))
    elif "prompt" in df.columns:
        found = df.select("*", F.lit(0).alias("position"), F.col("prompt").alias("query"))
    else:
        found = df.filter(F.length("text") > 100).select(
            "*", F.lit(0).alias("position"), F.left(F.col("text"), F.lit(100)).alias("query"))
    return found.orderBy(*order_by, "position").limit(max_prompts) if max_prompts else found
