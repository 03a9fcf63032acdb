"""From the documents table to token ids: five stages, each over all that the stage before has kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame with the columns of ``documents``; the last one adds its ids. Rows with
null or empty texts leave at the first stage, since no language can be told. Repeated rows (equal id and text) are one
document: they stay or go together. Columns beyond those of ``documents`` are carried along, and empty tables pass through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from alignlake.llm import decontaminate, language_id, line_dedup, piece_codec, setsketch
from alignlake.session import written

LEAST_SCORE = 0.35
MODEL = "/opt/tokenizers/piece_bpe_32k.model"


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told: some letters, and a prediction of at least ``LEAST_SCORE``."""
    names, model = language_id.fitted(docs, where=~language_id.held_out())
    told = language_id.predict(docs, names, model)
    return told.filter((F.col("lang_pred") != "und") & (F.col("score") >= LEAST_SCORE)).select(docs.columns)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without later repeats of runs of lines and of longer single lines; documents of which nothing is left go."""
    cut = line_dedup.without_repeats(docs, alone=line_dedup.ALONE)
    left = cut.filter((F.col("n_deleted") == 0) | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    changed = F.when(F.col("n_deleted") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return left.withColumn("n_chars", changed).select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group of near-duplicates on shingles of five words."""
    kept = setsketch.near_duplicates(docs).filter("kept").select(F.col("doc_id").alias("kept_id")).distinct()
    return docs.join(kept.hint("shuffle_hash"), docs["doc_id"].eqNullSafe(kept["kept_id"]), "left_semi")


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.decontaminated(docs, items).filter("kept").select(docs.columns)


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their SentencePiece ids; the text is what the ids decode to."""
    coded = piece_codec.with_pieces(docs, MODEL)
    return coded.select(*[F.col("decoded").alias(c) if c == "text" else F.col(f"`{c}`") for c in docs.columns], "piece_ids")


STAGES = [("language", language), ("lines", lines), ("near_duplicates", near_duplicates), ("benchmark", benchmark), ("pieces", pieces)]
# SQL can express neither the network nor the encoding; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
