"""Documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and
reread as the next one's docs. All but the last return the columns of documents.
"""

from pyspark.sql import DataFrame, SparkSession

from millrace.llm import exact_dedup, jaccard_join, language_id, packing, secret_scan
from millrace.session import materialize


def identify_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language; those without a letter go, and a missing `lang` is the predicted one.

    Learned from the documents at hand.
    """
    return language_id.settle_languages(docs, language_id.fit_on_documents(docs))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents equal but for white space, the longest, then the one with the smallest id."""
    return exact_dedup.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of five-word shingle sets linked at a similarity of 0.75."""
    return jaccard_join.drop_near(docs)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, with its secrets replaced in the text."""
    return secret_scan.redact_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of a document in a sequence."""
    return packing.pack(docs, with_ids=False)


STAGES = [
    ("language_id", identify_languages),
    ("exact_dedup", drop_exact_copies),
    ("jaccard_join", drop_near_copies),
    ("secret_scan", redact_secrets),
    ("packing", pack_sequences),
]

# A trained classifier and a tokenizer cannot be written in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
