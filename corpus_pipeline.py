"""The corpus pipeline: language, near-duplicates, repeated passages, secrets, packing.

Every stage but the last returns the columns of ``documents``.  Null and empty texts go
in the first stage, as texts without a language; an empty table gives an empty result.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retail_strata.llm.common import written
from retail_strata.llm.language import UNKNOWN, held_out, predict_languages, train_languages
from retail_strata.llm.ngram_join import without_near_duplicates
from retail_strata.llm.packing import pack
from retail_strata.llm.queries import BYTE_BPE, PIECES
from retail_strata.llm.secrets import redact, train_secrets
from retail_strata.llm.suffix_dedup import deduplicated

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]

#: No SQL: the stages hold trained models, a tokenizer and a packing order.
ORACLE_SQL = None


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects texts in no language; fills in a missing one."""
    model = train_languages(docs.filter(~held_out(F.col("doc_id"))), PIECES)
    predicted = predict_languages(docs, model, docs.columns).filter(F.col("lang_pred") != UNKNOWN)
    return predicted.withColumn("lang", F.coalesce("lang", "lang_pred")).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of five-word shingle similarity 0.8 or more stays."""
    return without_near_duplicates(docs, words=5, percent=80)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts passages that an earlier document holds; a text of nothing else goes."""
    cut = deduplicated(docs)
    touched = F.col("removed").isNotNull() & (F.col("removed") != "")
    kept = cut.filter(~touched | F.col("text").rlike("[^\\s]"))
    return kept.withColumn("n_chars", F.when(touched, F.length("text")).otherwise(F.col("n_chars"))).select(
        *[F.col(f.name).cast(f.dataType) for f in docs.schema.fields]
    )


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Puts a mark in place of every secret."""
    clean = redact(docs.withColumn("_old", F.col("text")), train_secrets(docs))
    changed = ~F.col("text").eqNullSafe(F.col("_old"))
    return clean.withColumn("n_chars", F.when(changed, F.length("text")).otherwise(F.col("n_chars"))).select(
        *[F.col(f.name).cast(f.dataType) for f in docs.schema.fields]
    )


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of 1024 ids: whose ids stand where."""
    return pack(docs, BYTE_BPE)


STAGES = [
    ("language_id", language),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("secret_scan", secret_scan),
    ("packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each over the written result of the one before."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(*COLUMNS)
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
