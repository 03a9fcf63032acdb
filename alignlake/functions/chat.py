"""Column expressions over ``ARRAY<STRUCT<role, content>>`` messages and the chat template."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from alignlake.functions.text import strip

# Allowed roles and the markers of the chat template.
ROLES = ["system", "user", "assistant"]
END = "<|end|>"
MARKERS = ["<|system|>", "<|user|>", "<|assistant|>", "<|end|>"]

MESSAGES_TYPE = "array<struct<role:string,content:string>>"


def message(role: str, content: Column) -> Column:
    return F.struct(F.lit(role).alias("role"), content.cast("string").alias("content"))


def render_message(role: Column, content: Column) -> Column:
    """``<|role|>``, a line break, the stripped content and the end marker."""
    return F.concat(F.lit("<|"), role, F.lit("|>\n"), strip(content), F.lit(END))


def render(messages: Column) -> Column:
    """Rendered chat, one message per block. NULL when the chat has no usable message list."""
    blocks = F.transform(messages, lambda m: render_message(m["role"], m["content"]))
    return F.when(chat_fault(messages).isNull(), F.array_join(blocks, "\n"))


def render_pair(prompt: Column, answer: Column) -> Column:
    """A user turn followed by an assistant turn."""
    return F.concat(render_message(F.lit("user"), prompt), F.lit("\n"),
                    render_message(F.lit("assistant"), answer))


def generation_prompt(prompt: Column) -> Column:
    """Prompt text that asks a model for the next assistant turn."""
    return F.concat(F.lit("<|user|>\n"), prompt, F.lit("<|end|>\n<|assistant|>\n"))


def two_turn_context(first: Column, answer: Column, second: Column) -> Column:
    """The first exchange followed by the second question."""
    return F.concat(first, F.lit("\n\nAssistant: "), answer, F.lit("\n\nHuman: "), second)


def chat_fault(messages: Column) -> Column:
    """Why a message list is unusable, or NULL. The first bad message decides."""

    def fault(m: Column, i: Column) -> Column:
        return (
            F.when(m.isNull(), F.concat(F.lit("not_a_message["), i, F.lit("]")))
            .when(m["role"].isNull() | m["content"].isNull(), F.concat(F.lit("missing_key["), i, F.lit("]")))
            .when(~m["role"].isin(ROLES), F.concat(F.lit("bad_role["), i, F.lit("]")))
        )

    faults = F.array_compact(F.transform(messages, fault))
    return F.when(F.coalesce(F.size(messages), F.lit(0)) <= 0, F.lit("empty_list")).otherwise(F.get(faults, F.lit(0)))


def has_assistant(messages: Column) -> Column:
    return F.coalesce(F.exists(messages, lambda m: m["role"] == "assistant"), F.lit(False))


def combined_text(messages: Column) -> Column:
    """All contents joined by single spaces; a missing content counts as empty."""
    return F.array_join(F.transform(messages, lambda m: F.coalesce(m["content"], F.lit(""))), " ")


def user_contents(messages: Column) -> Column:
    return F.transform(F.filter(messages, lambda m: m["role"] == "user"), lambda m: m["content"])


def first_user_text(rendered: Column) -> Column:
    """Stripped text between the first user marker and the end marker after it; NULL when there is none."""
    user = F.lit("<|user|>")
    start = F.instr(rendered, user)
    rest = F.substring(rendered, start + F.length(user), F.length(rendered))
    stop = F.instr(rest, F.lit(END))
    return F.when((start > 0) & (stop > 1), strip(F.substring(rest, F.lit(1), stop - 1)))
