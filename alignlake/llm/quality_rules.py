"""Quality rules: a table of thresholds compiled into one Spark projection, without user functions.

``measured`` adds the counts of a text, ``compile_rules`` turns rows of the threshold table into
boolean columns over ratios of these counts, and ``apply_rules`` does both.

Words are runs of characters other than space and U+0009 to U+000D. Null or empty texts have no words
and no lines, every ratio over zero words or lines is 0, and the length rule drops them. Repeated rows
are judged one by one and alike. Columns of the input that are named like a result are replaced.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from alignlake.llm.names import unused

SPACES = r"[\x20\x09-\x0D]+"
SPACE_CHARS = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")

# Frequent function words of the languages that are kept.
STOP_WORDS = (
    "the be to of and that have with a in is it for on as are was this by from or an at "
    "der die das und ist nicht ein eine zu von mit den im sich auf dem für als auch des "
    "le la les de des et est un une que qui dans pour pas sur du au avec en "
    "el los las y por con para del se una su lo como no"
).split()


class Rule(NamedTuple):
    """One row of the threshold table: a ratio or count in SQL over the measured columns, and its bounds."""

    name: str
    measure: str
    low: float | None
    high: float | None


RULES = (
    Rule("words", "n_words", 50, 1_000_000),
    Rule("word_length", "word_chars / n_words", 2, 12),
    Rule("symbols", "n_symbols / n_words", None, 0.1),
    Rule("stop_words", "n_stop_words / n_words", 0.06, None),
    Rule("duplicate_lines", "n_dup_lines / n_lines", None, 0.5),
    Rule("bullet_lines", "n_bullet_lines / n_lines", None, 0.9),
    Rule("ellipsis_lines", "n_ellipsis_lines / n_lines", None, 0.3),
)


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once."""
    return F.transform(F.array(value), use)[0]


def repeated_words(words: Column, n_words: Column) -> Column:
    """Words inside windows of three words that occur at least twice in the text, the first included."""
    windows = F.transform(
        F.sequence(F.lit(0), n_words - 3),
        lambda i: F.struct(F.concat_ws(" ", words[i], words[i + 1], words[i + 2]).alias("w"), i.alias("at")))

    def starts(ordered: Column) -> Column:
        last = F.size(ordered) - 1
        twice = F.filter(ordered, lambda x, k: (
            F.when(k > 0, x["w"] == ordered[k - 1]["w"]).otherwise(False)
            | F.when(k < last, x["w"] == ordered[k + 1]["w"]).otherwise(False)))
        return F.sort_array(F.transform(twice, lambda x: x["at"]))

    def covered(at: Column) -> Column:
        spans = F.transform(at, lambda x, k: F.when(k < F.size(at) - 1, F.least(F.lit(3), at[k + 1] - x)).otherwise(3))
        return F.aggregate(spans, F.lit(0), lambda total, n: total + n)

    return F.when(n_words >= 3, bound(bound(F.sort_array(windows), starts), covered)).otherwise(0)


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """Rows with the counts that the rules use; ``docs`` columns stay but for those with a count's name."""
    names = (*BASE, "n_lines", "n_stop_words", "n_bullet_lines", "n_ellipsis_lines")
    kept = [c for c in docs.columns if c not in names]
    content = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    (parts,) = unused(docs.columns, "parts")
    split = docs.select(
        *[F.col(f"`{c}`") for c in kept],
        F.struct(
            F.array_remove(F.split(content, SPACES), "").alias("words"),
            F.filter(F.split(content, "\n"), lambda x: F.trim(x, F.lit(SPACE_CHARS)) != "").alias("lines"),
            (F.length(content) - F.length(F.translate(content, SYMBOLS, ""))).alias("symbols"),
        ).alias(parts))
    words, lines = F.col(f"{parts}.words"), F.col(f"{parts}.lines")
    trimmed = lambda x: F.trim(x, F.lit(SPACE_CHARS))
    counts = {
        "n_words": F.size(words),
        "word_chars": F.length(F.array_join(words, "")),
        "n_symbols": F.col(f"{parts}.symbols"),
        "n_dup_lines": F.size(lines) - F.size(F.array_distinct(lines)),
        "n_repeat_words": repeated_words(words, F.size(words)),
        "n_lines": F.size(lines),
        "n_stop_words": F.size(F.filter(words, lambda w: F.lower(w).isin(*STOP_WORDS))),
        "n_bullet_lines": F.size(F.filter(lines, lambda x: F.substring(trimmed(x), 1, 1).isin("-", "*", "•"))),
        "n_ellipsis_lines": F.size(F.filter(lines, lambda x: trimmed(x).endswith("...") | trimmed(x).endswith("…"))),
    }
    return split.select(*[F.col(f"`{c}`") for c in kept], *[v.cast("long").alias(k) for k, v in counts.items()])


def compile_rules(rules: Sequence[Rule] = RULES) -> dict[str, Column]:
    """A boolean per rule over the measured columns; a ratio over nothing counts as 0."""
    compiled = {}
    for rule in rules:
        value = F.coalesce(F.expr(f"try_divide({', '.join(rule.measure.split(' / '))})" if " / " in rule.measure else rule.measure),
                           F.lit(0))
        held = F.lit(True)
        if rule.low is not None:
            held = held & (value >= rule.low)
        if rule.high is not None:
            held = held & (value <= rule.high)
        compiled[rule.name] = held
    return compiled


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def apply_rules(docs: DataFrame, text: str = "text", rules: Sequence[Rule] = RULES) -> DataFrame:
    """``docs`` with counts, one ``ok_<rule>`` per rule, ``base_failed`` and ``kept``."""
    verdicts = compile_rules(rules)
    table = measured(docs, text).withColumns(
        {f"ok_{name}": held for name, held in verdicts.items()} | {"base_failed": base_failed()})
    passed = ~F.col("base_failed")
    for name in verdicts:
        passed = passed & F.col(f"ok_{name}")
    return table.withColumn("kept", passed)
