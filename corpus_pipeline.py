"""A training corpus from raw documents: five stages, each over all that the one before kept.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes it as Parquet to the shared
work folder and reads it again as the next stage's documents. All but the last return the columns of the
documents. A column that the tables lack is not invented, further ones are passed on.

Results by case: stages judge by ``doc_id``, ``text`` and, to learn the languages, ``lang``; null and empty
texts are rejected by the first stage; an empty table passes through; rows without an id stay in the stages
that drop by id. Language, copies, near copies and contamination are decided as the operators say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from podium.llm import byte_bpe, decontaminate, exact_dedup, jaccard_join, language
from podium.llm.queries import fold, ranks_path, split_pattern
from podium.llm.work import ship, stored
from podium.session import utc


def known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the model recognises; the same folds as in the registered query are learned from."""
    ship(spark)
    return language.drop_rejected(docs, language.train(docs, fold(4) != 2))


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least id of each group of equal texts."""
    return exact_dedup.drop_copies(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least id of each class of similar texts."""
    ship(spark)
    return jaccard_join.keep_one(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    ship(spark)
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, and the text decoded from them again."""
    ship(spark)
    return byte_bpe.round_trip(docs, ranks_path(), split_pattern())


STAGES = [
    ("language_id", known_languages),
    ("exact_dedup", without_copies),
    ("ngram_jaccard_join", without_near_copies),
    ("benchmark_decontamination", without_benchmark),
    ("byte_bpe", tokens),
]

#: SQL can express neither the trained language model nor the byte-pair merges.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over the table of documents."""
    spark = utc(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
