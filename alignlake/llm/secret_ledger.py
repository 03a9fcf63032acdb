"""Secret scans over an incremental ledger of content-addressed texts.

Every version of every text is addressed by the SHA-256 of its content. The ledger is a folder of Parquet
tables with one row per (blob, rule version) that was scanned, holding all findings of that blob, so a
later scan reads only blobs that this rule version has not seen, however many paths or versions hold them.
Findings are joined back to all paths at the end.

``scan`` picks one row per unseen blob (the smallest id; counted map-side, so a blob with very many copies is
one row per task), sends texts to the scanner by row id and appends one ledger part. A part is named
only after its job is complete; a lost executor repeats tasks, not the ledger.

Null texts are the empty text: they have an address of their own and no findings. Repeated rows get the findings
of their text. Other columns of the input are ignored. An empty table adds nothing.

Spans are ``kind:start:end`` in code points, end exclusive, sorted by start, then by kind in the order of ``KINDS``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from alignlake.session import work_path

BASE = ("assign", "access", "hex")
KINDS = (*BASE, "pem", "provider", "jwt", "login", "bearer")
VERSION = "3"

# The rules by kind. The first three are the base rules.
PATTERNS = {
    "assign": r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    "access": r"AKIA[A-Z0-9]+",
    "hex": r"[0-9a-f]{24,}",
    "pem": r"-----BEGIN(?: [A-Z]+)* PRIVATE KEY-----",
    "provider": r"(?:gh[pousr]_[A-Za-z0-9]{36,}|xox[abprs]-[A-Za-z0-9-]{10,}|AIza[A-Za-z0-9_-]{35}|sk_live_[A-Za-z0-9]{16,})",
    "jwt": r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}",
    "login": r"[a-z][a-z0-9+.-]{1,30}://[^\s:/@]{1,200}:[^\s:/@]{3,200}@",
    "bearer": r"[Bb]earer +[A-Za-z0-9._~+/-]{20,}",
}
LEDGER = "blob binary, rules string, findings array<struct<kind:string,start:int,stop:int>>"


def rules() -> list[tuple[str, object, object]]:
    """(kind, pattern, what a match must fulfil)."""
    flags = {"assign": re.IGNORECASE | re.ASCII}
    checks = {"assign": lambda m: len(m[1]) >= 6, "access": lambda m: len(m[0]) >= 20}
    return [(k, re.compile(p, flags.get(k, re.ASCII)), checks.get(k)) for k, p in PATTERNS.items()]


def findings(text: str, compiled: list) -> list[tuple[str, int, int]]:
    found = []
    for order, (kind, pattern, check) in enumerate(compiled):
        found.extend((m.start(), order, kind, m.end()) for m in pattern.finditer(text) if check is None or check(m))
    return [(kind, start, stop) for start, _, kind, stop in sorted(found)]


def addressed(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    text = F.coalesce(F.col(f"`{text_column}`"), F.lit(""))
    return docs.select(F.col(f"`{id_column}`").alias("path"), F.unhex(F.sha2(text.cast("binary"), 256)).alias("blob"), text.alias("text"))


def ledger_rows(spark, ledger: str, version: str) -> DataFrame:
    """What a rule version has scanned; empty where no scan has been completed yet."""
    from pyspark.errors import AnalysisException

    try:
        found = spark.read.schema(LEDGER + ", part string").parquet(ledger)
        return found.filter(F.col("rules") == version).select("blob", "rules", "findings")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LEDGER)


def scan(docs: DataFrame, ledger: str, id_column: str = "doc_id", text_column: str = "text", version: str = VERSION) -> DataFrame:
    """Scans what the ledger lacks, appends it there, and returns the scanned part of the ledger."""
    import uuid

    spark = docs.sparkSession
    paths = addressed(docs, id_column, text_column)
    seen = ledger_rows(spark, ledger, version).select("blob")
    unseen = (
        paths.groupBy("blob").agg(F.min("path").alias("path"))
        .join(seen, "blob", "left_anti"))
    # rows of a path may hold several versions, so a version is known by path and address
    texts = paths.join(unseen.hint("shuffle_hash"), (paths.path.eqNullSafe(unseen.path)) & (paths.blob == unseen.blob), "left_semi")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compiled = rules()
        struct = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("stop", pa.int32())]))
        for batch in batches:
            found = [[dict(zip(("kind", "start", "stop"), f, strict=True)) for f in findings(t, compiled)] for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), pa.array([version] * batch.num_rows, pa.string()), pa.array(found, struct)], ["blob", "rules", "findings"])

    part = f"{ledger}/part={uuid.uuid4().hex}"
    # several rows with the same path and text differ in nothing; one of them is kept
    texts.mapInArrow(run, LEDGER).dropDuplicates(["blob"]).write.parquet(part)
    return spark.read.schema(LEDGER).parquet(part)


def found_in_paths(docs: DataFrame, ledger: str, id_column: str = "doc_id", text_column: str = "text", version: str = VERSION) -> DataFrame:
    """(id, findings) of every row, from the ledger alone."""
    known = ledger_rows(docs.sparkSession, ledger, version).filter(F.size("findings") > 0).dropDuplicates(["blob"]).select("blob", "findings")
    paths = addressed(docs, id_column, text_column).select("path", "blob")
    return paths.join(known, "blob", "left").select(
        F.col("path").alias(id_column), F.coalesce("findings", F.array()).alias("findings"))


def incremental_scan(docs: DataFrame, ledger: str | None = None, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Brings the ledger up to date with ``docs`` and returns the findings of every row."""
    ledger = ledger or work_path(docs.sparkSession, "ledger")
    scan(docs, ledger, id_column, text_column)
    return found_in_paths(docs, ledger, id_column, text_column)


def span_text(found: Column) -> Column:
    return F.array_join(F.transform(found, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["stop"].cast("string"))), ",")


def digest(found: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """Counts per base kind, the hash of the base spans, and all spans."""
    def count(kind: str) -> Column:
        return F.size(F.filter("findings", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("findings", lambda x: x["kind"].isin(*BASE))
    return found.select(id_column, *map(count, BASE), F.sha2(span_text(base), 256).alias("base_sha256"),
                        span_text(F.col("findings")).alias("spans"))
