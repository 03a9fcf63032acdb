"""Conversations that need not fit in a row: the chat operators over tables of turns.

A row is one message (conversation, turn, role, content). Verdicts, warnings, quality and lengths of a conversation are aggregates that
merge over its turns; places in its text and token stream are running totals over ranges of turns; an unsafe phrase that runs over the
end of a message is found by carrying the last characters of the text before it. A whole conversation is never gathered. Results equal those
of the row operators on :func:`alignlake.operators.normalize.messages_from_turns`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from alignlake.functions import chat, patterns, text
from alignlake.operators import ordering, quality, tokens
from alignlake.session import written

ROWS = ordering.ROWS_PER_BUCKET
# Longest unsafe phrase and the characters around it: no phrase that crosses the end of a message starts before this many characters.
CARRIED = max(len(w) for rows in patterns.HARMFUL_WORDS.values() for row in rows for w in row.split("|")) + 2


def numbered(df: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", content: str = "text",
             rows_per_bucket: int = ROWS) -> DataFrame:
    """(conversation, pos, turns, role, content): turns at their place in the conversation, stored."""
    rows = df.select(F.col(conversation).alias("conversation"), F.col(turn).alias("turn"), F.col(role).alias("role"), F.col(content).alias("content"))
    placed = ordering.with_index(rows, ["turn", "role", "content"], ["conversation"], name="pos", total="turns", rows_per_bucket=rows_per_bucket)
    return written(placed.drop("turn"), "turns")


def fault() -> Column:
    """Why a message is unusable, or NULL."""
    at = lambda code: F.concat(F.lit(f"{code}["), F.col("pos"), F.lit("]"))
    return (F.when(F.col("role").isNull() | F.col("content").isNull(), at("missing_key"))
            .when(~F.col("role").isin(chat.ROLES), at("bad_role")))


def block() -> Column:
    """The rendered message; messages of a chat are joined by line breaks."""
    return chat.render_message(F.col("role"), F.col("content"))


def verdicts(turns: DataFrame) -> DataFrame:
    """(conversation, turns, fault, is_valid, has_assistant, harmful, length): facts of each conversation, merged over its turns.

    ``fault`` is that of the first unusable message, ``length`` that of the rendered text (0 with a fault).
    """
    found = turns.select("conversation", "pos", "role", fault().alias("fault"), F.length(block()).alias("size"),
                         patterns.is_harmful(F.col("content")).alias("harmful"))
    merged = found.groupBy("conversation").agg(
        F.count("*").alias("turns"), F.min(F.when(F.col("fault").isNotNull(), F.struct("pos", "fault"))).alias("first"),
        F.coalesce(F.max(F.col("role") == "assistant"), F.lit(False)).alias("has_assistant"), F.max("harmful").alias("harmful"), F.sum("size").alias("size"))
    valid = F.col("first").isNull()
    return merged.select(
        "conversation", "turns", F.col("first.fault").alias("fault"), valid.alias("is_valid"), "has_assistant", "harmful",
        F.when(valid, F.col("size") + F.col("turns") - 1).otherwise(0).cast("bigint").alias("length"))


def warnings(turns: DataFrame, facts: DataFrame, raw: bool = True) -> DataFrame:
    """(conversation, pos, warning), one row per warning; the fault of an invalid conversation is its only one.

    A warning about the conversation as a whole has no position.
    """
    size = F.length(text.strip(F.col("content")))
    at = lambda code: F.concat(F.lit(f"{code}["), F.col("pos"), F.lit("]"))
    by_size = F.when(size == 0, at("empty_content"))
    if raw:
        by_size = by_size.when(size < 3, at("short_content"))
    notes = [by_size.when(size > 10000, at("long_content"))]
    if raw:
        notes.append(F.when(patterns.is_harmful(text.strip(F.col("content"))), at("harmful_content")))
    noted = turns.select("conversation", "pos", F.explode(F.array_compact(F.array(*notes))).alias("warning"))
    good = facts.filter("is_valid").select(F.col("conversation").alias("_c"))
    noted = noted.join(good, F.col("conversation").eqNullSafe(F.col("_c")), "left_semi")
    whole = facts.select("conversation", F.lit(None).cast(noted.schema["pos"].dataType).alias("pos"),
                         F.when(~F.col("is_valid"), F.col("fault")).when(~F.col("has_assistant"), F.lit("no_assistant")).alias("warning"))
    return noted.unionByName(whole.filter(F.col("warning").isNotNull()))


def _carried(turns: DataFrame, rows_per_bucket: int) -> DataFrame:
    """``_before``: the last characters of the contents before each turn, without a word that is cut."""
    chunks = ordering.Chunks(turns, ["conversation"], before=CARRIED, chunk_rows=rows_per_bucket, index="pos")
    # every message adds at least the space before the next one, so this many messages hold the characters wanted
    tails = F.collect_list(F.right(F.coalesce("content", F.lit("")), F.lit(CARRIED))).over(chunks.window.rowsBetween(-CARRIED, -1))
    joined = F.when(F.size(tails) > 0, F.concat(F.array_join(tails, " "), F.lit(" ")))
    done = chunks.finish(chunks.rows.withColumn("_joined", joined))
    cut = F.length("_joined") > CARRIED
    last = F.right(F.col("_joined"), F.lit(CARRIED))
    return done.withColumn("_before", F.when(cut, F.regexp_replace(last, r"(?U)^\w+", "")).otherwise(F.coalesce("_joined", F.lit("")))).drop("_joined")


def chat_quality(turns: DataFrame, rows_per_bucket: int = ROWS) -> DataFrame:
    """(conversation, quality): the quality of all contents joined by spaces."""
    content = F.coalesce("content", F.lit(""))
    sized = ordering.with_running_total(
        _carried(turns, rows_per_bucket), "pos", ["conversation"], weight=F.length(content).cast("bigint") + 1, name="start", rows_per_bucket=rows_per_bucket)
    shown = ~text.is_blank(content)
    space = F.lit(text.WHITESPACE)
    facts = sized.select(
        "conversation",
        F.when(shown, F.col("start") + F.length(content) - F.length(F.ltrim(content, space))).alias("first"),
        F.when(shown, F.col("start") + F.length(F.rtrim(content, space))).alias("stop"),
        text.word_count(content).alias("words"), (text.piece_count(content) - 1).alias("stops"),
        text.sentence_word_count(content).alias("sentence_words"),
        patterns.is_harmful(F.concat("_before", content)).alias("unsafe"))
    merged = facts.groupBy("conversation").agg(
        F.coalesce(F.max("stop") - F.min("first"), F.lit(0)).alias("_size"), F.sum("words").alias("_count"),
        (F.sum("stops") + 1).alias("_pieces"), F.sum("sentence_words").alias("_sentence_words"), F.max("unsafe").alias("_unsafe"))
    words = turns.select("conversation", F.explode(text.words(F.lower(text.strip(content)))).alias("word")).distinct()
    different = words.groupBy("conversation").agg(F.count("*").alias("_distinct")).withColumnRenamed("conversation", "_c")
    both = merged.join(different, F.col("conversation").eqNullSafe(F.col("_c")), "left").drop("_c").fillna(0, ["_distinct"])
    return quality.with_score(both, "quality")


def vocabulary_of(turns: DataFrame, facts: DataFrame, size: int) -> DataFrame:
    """The vocabulary of the rendered texts of all valid conversations, stored."""
    return written(tokens.vocabulary(_valid(turns, facts).select(block().alias("text")), size=size), "vocabulary")


def _valid(turns: DataFrame, facts: DataFrame) -> DataFrame:
    good = facts.filter("is_valid").select(F.col("conversation").alias("_c"))
    return turns.join(good, F.col("conversation").eqNullSafe(F.col("_c")), "left_semi")


def encoded(turns: DataFrame, facts: DataFrame, vocab: DataFrame, max_length: int | None = None, joined: bool = False,
            rows_per_bucket: int = ROWS) -> DataFrame:
    """(conversation, pos, start, input_ids, labels) of every turn of valid conversations, in the token stream of the whole chat.

    ``start`` is the turn's place in the stream. Turns from ``max_length`` on are left out and the last one is cut. Loss labels are the ids of
    answers; a chat without an answer marker has labels after its first answer heading, or in its second half. ``joined`` encodes by
    a join, for vocabularies of any size.
    """
    cut = _valid(turns, facts).select("conversation", "pos", block().alias("_block"))
    cut = cut.select("conversation", "pos", text.tokens(F.col("_block")).alias("tokens"), F.col("_block").contains("<|assistant|>").alias("_marked"))
    cut = ordering.with_running_total(cut, "pos", ["conversation"], weight=F.size("tokens").cast("bigint"), name="start", rows_per_bucket=rows_per_bucket)
    answered = cut.groupBy("conversation").agg(F.max("_marked").alias("_answered"))
    if max_length is not None:
        cut = cut.filter(F.col("start") < max_length).withColumn("tokens", F.slice("tokens", F.lit(1), (F.lit(max_length) - F.col("start")).cast("int")))
    cut = written(cut.drop("_marked"), "turn-tokens")

    # the first heading of a chat, in heading priority, else its middle
    def after(word: str) -> Column:
        places = F.transform("tokens", lambda t, i: F.when((t == word) & (F.get(F.col("tokens"), i + 1) == ":"), F.col("start") + i + 2))
        return F.min(F.array_min(places))

    firsts = [after(heading[:-1]).alias(f"_h{i}") for i, heading in enumerate(tokens.ANSWER_HEADINGS)]
    heads = cut.groupBy("conversation").agg(F.sum(F.size("tokens")).alias("_all"), *firsts)
    whole = heads.join(answered.withColumnRenamed("conversation", "_a"), F.col("conversation").eqNullSafe(F.col("_a"))).select(
        F.col("conversation").alias("_c"), "_answered",
        F.coalesce(*[F.col(f"_h{i}") for i in range(len(firsts))], F.floor(F.col("_all") / 2)).alias("_from"))
    coded = tokens.encode_joined(cut, vocab, ["conversation", "pos"]) if joined else tokens.encode(cut, vocab)
    facing = coded.join(whole, F.col("conversation").eqNullSafe(F.col("_c"))).drop("_c")
    # every rendered message ends with an end marker, so an answer never stays open after its turn
    spans = tokens.answer_spans(F.col("tokens"))
    later = F.array(F.struct(F.greatest(F.col("_from") - F.col("start"), F.lit(0)).cast("int").alias("start"), F.size("tokens").alias("stop")))
    staged = facing.withColumn("_spans", F.when(F.col("_answered"), spans).otherwise(later))
    labels = F.transform("input_ids", lambda t, i: F.when(F.exists("_spans", lambda s: (i >= s["start"]) & (i < s["stop"])), t).otherwise(tokens.MASKED))
    # spans are used twice on purpose, so that they are computed once and not inside the per-token lambda
    masked = F.array_repeat(F.lit(tokens.MASKED).cast("int"), F.size("input_ids"))
    return staged.select("conversation", "pos", "start", "input_ids", F.when(F.size("_spans") == 0, masked).otherwise(labels).alias("labels"))


def processed(turns: DataFrame, vocab: DataFrame | int, max_length: int, joined: bool = False, rows_per_bucket: int = ROWS) -> DataFrame:
    """One row per conversation with ids, mask and labels cut at ``max_length``, and the reason why it is dropped or ``successful``.

    ``turns`` comes from :func:`numbered`. Only turns that start before ``max_length`` are gathered, so rows are bounded.
    """
    facts = written(verdicts(turns), "verdicts")
    words = vocabulary_of(turns, facts, vocab) if isinstance(vocab, int) else vocab
    rows = encoded(turns, facts, words, max_length, joined, rows_per_bucket)
    flat = lambda c: F.flatten(F.transform("_rows", lambda r: r[c]))
    gathered = rows.groupBy("conversation").agg(F.sort_array(F.collect_list(F.struct("pos", "input_ids", "labels"))).alias("_rows")).select(
        F.col("conversation").alias("_c"), flat("input_ids").alias("input_ids"), flat("labels").alias("labels"))
    none = F.array().cast("array<int>")
    all_rows = facts.join(gathered, F.col("conversation").eqNullSafe(F.col("_c")), "left").select(
        "conversation", "fault", F.col("length").alias("original_length"),
        *[F.coalesce(F.col(c), none).alias(c) for c in ("input_ids", "labels")])
    return all_rows.select(
        "conversation", "input_ids", F.array_repeat(F.lit(1), F.size("input_ids")).alias("attention_mask"), "labels",
        F.size("input_ids").alias("token_count"), "original_length",
        F.when(F.col("fault").isNotNull(), F.lit("invalid_structure")).when(F.size("input_ids") < 3, F.lit("invalid_tokenization"))
        .otherwise(F.lit("successful")).alias("reason"))


def without_unsafe(turns: DataFrame) -> DataFrame:
    """The turns of conversations none of whose messages is unsafe."""
    bad = turns.filter(patterns.is_harmful(F.col("content"))).select(F.col("conversation").alias("_c")).distinct()
    return turns.join(bad, F.col("conversation").eqNullSafe(F.col("_c")), "left_anti")


def raw_checks(turns: DataFrame, rows_per_bucket: int = ROWS) -> DataFrame:
    """(conversation, is_valid, notes, quality): each conversation's verdict, number of warnings, and quality where it is valid."""
    facts = written(verdicts(turns), "verdicts")
    counts = warnings(turns, facts).groupBy(F.col("conversation").alias("_w")).agg(F.count("*").alias("notes"))
    scored = chat_quality(turns, rows_per_bucket).withColumnRenamed("conversation", "_q")
    return (
        facts.join(counts, F.col("conversation").eqNullSafe(F.col("_w")), "left").join(scored, F.col("conversation").eqNullSafe(F.col("_q")))
        .select("conversation", "is_valid", F.coalesce("notes", F.lit(0)).alias("notes"), F.when(F.col("is_valid"), F.col("quality")).alias("quality")))
