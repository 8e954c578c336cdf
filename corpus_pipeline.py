"""The corpus pipeline: five stages over ``documents``, each on all that the one before kept.

Every stage is written as Parquet in the shared folder and read again as the next one's
input, so a lost executor costs one stage at most. The first four return the columns of
``documents``; the last returns the ids of each text and whether they decode to it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quotelake.llm import decontamination, jaccard_join, quality, sentencepieces, substring_dedup
from quotelake.llm.store import folder, prepared


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the limits and are no outliers of their language and source."""
    return quality.kept_rows(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each class of near duplicates."""
    return jaccard_join.representatives(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages of 50 words and more that an earlier document holds."""
    return _counted(substring_dedup.without_repeats(docs))


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages of ten words and more that the benchmark holds."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return _counted(decontamination.without_hits(docs, benchmark))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of each text and whether they decode to it."""
    import public_tokenizers

    path = public_tokenizers.path("piece_bpe_32k.model")
    both = sentencepieces.with_ids_and_text(docs, path)
    return both.select(
        "doc_id", "lang", "source", F.coalesce(F.size("ids"), F.lit(0)).cast("long").alias("n_tokens"),
        "ids", F.col("text").eqNullSafe(F.col("decoded")).alias("round_trip"))


def _counted(docs: DataFrame) -> DataFrame:
    """n_chars of the texts as they are now."""
    return docs.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", near_duplicates),
    ("substring dedup", repeated_passages),
    ("benchmark decontamination", benchmark_passages),
    ("SentencePiece encoding and decoding", encoded),
]

# No stage can be said in SQL; tests hold each against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    prepared(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = folder(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
