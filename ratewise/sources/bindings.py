"""The review model bound to the star-schema tables.

``review_facts`` has one row for each order line and no text; ``review_text``
has one row for each document.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FACT_COLUMNS = ("author", "product", "date", "rating", "helpful")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame, key: str) -> DataFrame:
    """Distribute a text table that lies in fewer files than there are cores.

    A file with one row group feeds one task, however it is split. A table in
    many files is left as it is: its scan is parallel and texts are not moved.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if len(df.inputFiles()) >= cores else df.repartition(cores, key)


def review_facts(
    spark: SparkSession, sf_dir: str, columns: Sequence[str] = FACT_COLUMNS
) -> DataFrame:
    """Order lines as reviews, limited to ``columns``.

    The outer join keeps one row per order line whatever ``orders`` holds, so
    the join is left out entirely when no column of ``orders`` is asked for.
    """
    source = table(spark, sf_dir, "lineitem")
    if {"author", "date"} & set(columns):
        orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
        source = source.join(orders, F.col("l_orderkey") == F.col("o_orderkey"), "left")
    expressions = {
        "author": lambda: F.col("o_custkey").cast("string"),
        "product": lambda: F.col("l_partkey").cast("string"),
        "date": lambda: F.col("o_orderdate").cast("date"),
        "rating": lambda: F.ceil(F.col("l_quantity") / 10).cast("int"),
        "helpful": lambda: F.struct(
            F.round(F.col("l_discount") * 100).cast("int").alias("positive"),
            F.lit(10).alias("total"),
        ),
    }
    return source.select(*[expressions[c]().alias(c) for c in columns])


def review_text(spark: SparkSession, sf_dir: str, with_labels: bool = False) -> DataFrame:
    """Documents as reviews; ``label`` (quality) only on request, it needs a join."""
    docs = spread(table(spark, sf_dir, "documents"), "doc_id")
    reviews = docs.select(
        F.col("doc_id").alias("id"),
        F.concat(F.lit("u"), (F.col("doc_id") % 97).cast("string")).alias("author"),
        F.col("source").alias("product"),
        F.col("text").alias("content"),
        F.col("lang"),
        (1 + F.col("doc_id") % 5).cast("int").alias("rating"),
    )
    if not with_labels:
        return reviews
    labels = table(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("id"), F.col("quality").alias("label")
    )
    return reviews.join(labels, "id", "left")
