"""Chi-square scores on summed feature values, and selection by them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ratewise.operators.ordering import smallest


def chi2_scores(cells: DataFrame, documents: DataFrame, label: str = "rating") -> DataFrame:
    """(term, chi2) from long-form cells (id, term, value, label).

    Observed is the sum of a term's values per class, expected its total times
    the share of the class among ``documents``. Classes without the term enter
    through the identity sum((o-e)^2/e) = sum(o^2/e) - total.
    """
    classes = documents.groupBy(label).agg(F.count(F.lit(1)).alias("_n"))
    shares = classes.select(label, (F.col("_n") / F.sum("_n").over(Window.partitionBy())).alias("_share"))
    observed = cells.groupBy("term", label).agg(F.sum("value").alias("_o"))
    return (
        observed.join(F.broadcast(shares), label)
        .groupBy("term")
        .agg(F.sum(F.col("_o") * F.col("_o") / F.col("_share")).alias("_s"), F.sum("_o").alias("_t"))
        .where(F.col("_t") > 0)
        .select("term", (F.col("_s") / F.col("_t") - F.col("_t")).alias("chi2"))
    )


def select_k_best(scores: DataFrame, k: int) -> DataFrame:
    """The ``k`` terms with the highest score; ties go to the later term."""
    ranked = scores.withColumn("chi2", F.round("chi2", 9))
    return smallest(ranked, [F.desc("chi2"), F.desc("term")], k)
