"""Corpus pipeline: documents to a decontaminated, mixed and tokenised training set.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the next stage's docs. All but the last return the
columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ratewise.llm import decontamination, mixing, near_dup, token_store, toxicity
from ratewise.llm.queries import vocabulary
from ratewise.session import scratch_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores below 0.5."""
    return toxicity.without_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), threshold=0.5)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: 5-word shingles, similarity 0.8."""
    return near_dup.deduplicated(docs, shingle=5, similarity=0.8)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no span of 10 words with a benchmark item."""
    return decontamination.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), span=10, k=5)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated or sampled so that sources weigh 5, 2, 1, ..., at most 3 times each."""
    return mixing.repeated(docs, weights=(5, 2, 1), budget=1.0, max_epochs=3.0, seed=17)


def write_token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, start, n_tokens, tokens) read back from the token files, in ascending doc_id order."""
    path = scratch_path(spark, "tokens")
    token_store.write_tokens(docs, path, vocabulary(), end_id=1)
    return token_store.read_tokens(spark, path)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("token_ids", write_token_ids),
]

#: The classifier and the tokenizer have no SQL form; tests compare with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
