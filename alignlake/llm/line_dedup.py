"""Repeated runs of lines, found by winnowing over line hashes.

A text's lines (cut at line feeds) that hold a word form a sequence; blank lines take no part. A run of ``window`` lines that
occurred before, in an earlier row or further up in the same text, is a later repeat: every line of it
is deleted, with the blank lines between them. So any repeated run of at least ``window`` lines goes, at every place but its first, and shorter
repeats stay. With ``alone``, a single line of at least that many words that occurred before is such a repeat too, whatever stands around
it (the registered query and the pipeline use ``ALONE``); without it single lines stay. Rows are ordered by id, rows with equal ids by text; the first occurrence is never the copy.

1. Winnowing: of every ``window`` consecutive lines the one with the smallest hash (the rightmost of equals) is a
   fingerprint. Equal runs choose equal fingerprints, so each repeated run is guaranteed to hold a shared one, while
   only some of the lines are shuffled.
2. Fingerprints are counted (map-side first); those met once, the bulk of a clean corpus, are dropped.
3. Around each position that is left, the match is extended both ways over every run of ``window`` lines that chose this
   fingerprint; runs are joined on a hash of all their lines with their first position. No pairs of copies are
   made, and a hash value with very many positions is aggregated before it is shuffled.
   Lines that may go alone are runs of one line and need no fingerprint.
4. Deleted lines are gathered per row, and the row's text is rebuilt without them.

Everything is DataFrame functions. Null texts stay null, empty ones empty; texts whose lines all go become empty strings
and stay as rows. Rows with null ids come first. Equal rows (same id, same text) count as one and the same occurrence. Further columns stay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from alignlake.llm.names import unused
from alignlake.session import written

WINDOW = 2
ALONE = 8
SPACE_CHARS = " \t\n\x0b\f\r"


def bound(value: Column, use) -> Column:
    """``use`` of a value that is computed once."""
    return F.transform(F.array(value), use)[0]


def has_words(line: Column, count: int) -> Column:
    """Whether a line has at least ``count`` words; the search ends with the last of them."""
    return line.rlike(rf"^(?:[\x20\x09-\x0D]*+[^\x20\x09-\x0D]++){{{count}}}")


def numbered_lines(text: Column, alone: int | None = None) -> Column:
    """Lines that hold a word: their text hash and their number among all lines, and a second hash of those that may go alone."""
    return F.filter(
        F.transform(F.split(text, "\n"), lambda x, i: F.struct(
            F.xxhash64(x).alias("h"), F.when(F.trim(x, F.lit(SPACE_CHARS)) != "", i).alias("at"),
            *([] if alone is None else [F.when(has_words(x, alone), F.hash(x)).alias("check")]))),
        lambda x: x["at"].isNotNull())


def fingerprints(hashes: Column, window: int) -> Column:
    """Per window of lines: the index of its rightmost smallest hash."""
    def choose(i: Column) -> Column:
        return bound(F.slice(hashes, i + 1, window), lambda run: bound(
            F.array_min(run), lambda low: i + (window - F.array_position(F.reverse(run), low)).cast("int")))

    return F.when(F.size(hashes) >= window, F.transform(F.sequence(F.lit(0), F.size(hashes) - window), choose)).otherwise(
        F.array().cast("array<int>"))


def repeated_lines(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", window: int = WINDOW, alone: int | None = None) -> DataFrame:
    """(row, version, lines): numbers of the lines to delete, for the rows that have any."""
    lines = written(
        docs.select(F.col(f"`{id_column}`").alias("row"), F.xxhash64(F.col(f"`{text_column}`")).alias("version"),
                    numbered_lines(F.col(f"`{text_column}`"), alone).alias("lines"))
        .filter(F.size("lines") >= (window if alone is None else 1))
        .select("row", "version", *[F.col(f"lines.{c}").alias(c) for c in ("h", "at", *([] if alone is None else ["check"]))])
        .withColumn("chosen", fingerprints(F.col("h"), window)), "lines")

    # what was aggregated by a key is stored before it is joined on that key, so that a frequent key's rows can be split
    marks = written(
        lines.select(F.explode(F.transform(F.array_distinct("chosen"), lambda c: F.col("h")[c])).alias("mark"))
        .groupBy("mark").agg(F.count("*").alias("n")).filter("n > 1").select("mark"), "marks")
    # one row per run of lines, joined by the fingerprint that it chose
    runs = lines.select(
        "row", "version",
        F.explode(F.transform("chosen", lambda c, i: F.struct(
            F.col("h")[c].alias("mark"), F.col("at")[i].alias("first"), F.col("at")[i + window - 1].alias("last"),
            F.xxhash64(F.slice("h", i + 1, window)).alias("run"), F.hash(F.slice("h", i + 1, window)).alias("check")))).alias("r"),
    ).select("row", "version", "r.*")
    runs = runs.join(marks, "mark", "left_semi").drop("mark")
    if alone is not None:
        # single lines are counted by hash first, and only those met again go on
        single = lines.select("row", "version", F.explode(F.filter(F.transform("h", lambda h, i: F.struct(
            F.col("at")[i].alias("first"), F.col("at")[i].alias("last"), h.alias("run"), F.col("check")[i].alias("check"))),
            lambda x: x["check"].isNotNull())).alias("r")).select("row", "version", "r.*")
        again = written(single.select("run").groupBy("run").agg(F.count("*").alias("n")).filter("n > 1").select("run"), "single-lines")
        runs = runs.unionByName(single.join(again, "run", "left_semi").select(runs.columns).withColumn("run", F.xxhash64(F.array("run"))))
    runs = written(runs, "runs")

    place = F.struct("row", "version", "first")
    origins = runs.groupBy("run", "check").agg(F.min(place).alias("origin"), F.count("*").alias("n")).filter("n > 1")
    origins = written(origins.select("run", "check", "origin"), "origins")
    later = runs.join(origins, ["run", "check"]).filter(~place.eqNullSafe(F.col("origin")))
    return later.groupBy("row", "version").agg(
        F.array_distinct(F.flatten(F.collect_set(F.sequence("first", "last")))).alias("lines"))


def without_repeats(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", window: int = WINDOW, alone: int | None = None) -> DataFrame:
    """``docs`` with the repeated runs deleted from the text, and ``n_deleted`` lines per row."""
    row, version, lines, own = unused(docs.columns, "row", "version", "lines", "text_version")
    cut = repeated_lines(docs, id_column, text_column, window, alone).select(
        F.col("row").alias(row), F.col("version").alias(version), F.col("lines").alias(lines))
    marked = docs.withColumn(own, F.xxhash64(F.col(f"`{text_column}`")))
    joined = marked.join(
        cut.hint("shuffle_hash"), marked[f"`{id_column}`"].eqNullSafe(cut[row]) & (marked[own] == cut[version]), "left")
    text = F.col(f"`{text_column}`")
    left = bound(F.split(text, "\n"), lambda parts: F.array_join(
        F.transform(F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), F.col(lines)), lambda i: parts[i]), "\n"))
    return joined.select(
        *[F.when(F.col(lines).isNull(), text).otherwise(left).alias(c) if c == text_column else F.col(f"`{c}`")
          for c in docs.columns if c != "n_deleted"],
        F.coalesce(F.size(lines), F.lit(0)).cast("long").alias("n_deleted"))
