"""Feature pipelines: content, content + product + author, and the full build."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.base import Estimator
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratewise.operators.features import (
    OneHotBlock,
    TfidfVectorizer,
    TruncatedSVD,
    UnitRange,
    assemble,
    default_spec,
    max_abs,
)
from ratewise.operators.randomized_svd import truncated_svd
from ratewise.operators.sparse_blocks import fit_blocks, stored_vectors
from ratewise.operators.tfidf import TermSpec
from ratewise.schema import FEATURES
from ratewise.session import removed, shuffles_removed, stored

SVD_COMPONENTS = 1000


# The defaults of the n-gram and document-frequency limits.
def content_stages(
    ngram: int = 3, max_df: float = 0.3, min_df: float = 0.0003, outputCol: str = "features", lemmas: DataFrame | None = None
) -> list:
    """TF-IDF of the content; with a table ``lemmas`` (form, lemma) of the lemmatised content."""
    return [TfidfVectorizer(default_spec(ngram, max_df, min_df), outputCol=outputCol, lemmas=lemmas)]


def all_stages(
    ngram: int = 3,
    max_df: float = 0.3,
    min_df: float = 0.0003,
    w_ct: float = 1,
    w_pd: float = 1,
    w_au: float = 1,
    k: int | None = None,
    outputCol: str = "features",
    lemmas: DataFrame | None = None,
) -> list:
    """Content (reduced to ``k`` components if given), product and author side by side.

    Block weights apply last, so they scale the reduced content block too.
    """
    spec = default_spec(ngram, max_df, min_df)
    if k is None:
        content: list[Estimator] = [TfidfVectorizer(spec, outputCol="ft_content", weight=w_ct, lemmas=lemmas)]
    else:
        # X.V is linear: weighting the cells weighs the components.
        content = [
            TfidfVectorizer(spec, outputCol="ft_terms", weight=w_ct, lemmas=lemmas),
            TruncatedSVD(k, "ft_terms", "ft_content"),
        ]
    return content + [
        OneHotBlock("product", "ft_product", w_pd),
        OneHotBlock("author", "ft_author", w_au),
        assemble(["ft_content", "ft_product", "ft_author"], outputCol),
    ]


def build_features(
    train: DataFrame, test: DataFrame, svd: bool = True, k: int = SVD_COMPONENTS, stages: Sequence | None = None
) -> tuple[DataFrame, PipelineModel]:
    """Fit on train, transform both; one table (id, features, rating, split).

    With ``svd`` the matrix is projected and scaled to [0, 1], otherwise it stays
    sparse and is scaled by its largest absolute values.
    """
    stages = list(stages) if stages is not None else all_stages(outputCol="raw")
    if svd:
        stages += [TruncatedSVD(k, "raw", "reduced"), UnitRange("reduced", "features")]
    else:
        stages += [max_abs("raw", "features")]
    model = Pipeline(stages=stages).fit(train)
    both = train.withColumn("split", F.lit("train")).unionByName(
        test.withColumn("split", F.lit("test")), allowMissingColumns=True
    )
    return model.transform(both).select(*FEATURES.fieldNames()), model


def unit_range(projected: DataFrame, train: DataFrame, k: int) -> DataFrame:
    """(id, z) with every component scaled to [0, 1] over the rows of ``train``, constant ones to 0.

    One row for each component reaches the driver.
    """
    if k == 0:
        return projected
    spread = train.select(F.posexplode("z").alias("i", "x")).groupBy("i").agg(F.min("x").alias("low"), F.max("x").alias("high"))
    ends = {r.i: (r.low, r.high) for r in spread.collect()}
    low = F.array(*[F.lit(ends[i][0]) for i in range(k)])
    span = F.array(*[F.lit(ends[i][1] - ends[i][0]) for i in range(k)])
    part = lambda x, lo: x - lo
    share = lambda x, width: F.when(width > 0, x / width).otherwise(0.0)
    return projected.withColumn("z", F.zip_with(F.zip_with("z", low, part), span, share))


def build_wide_features(
    train: DataFrame, test: DataFrame, spec: TermSpec | None = None, svd: bool = True, k: int = SVD_COMPONENTS, **weights: float
) -> DataFrame:
    """(id, features, rating, split) as ``build_features`` gives it, for any number of terms, values and components.

    Indexes and singular vectors are tables. ``weights`` are by column: content, product, author.
    """
    spec = spec or default_spec()
    if svd:
        with shuffles_removed(train.sparkSession):
            return _reduced_features(train, test, spec, k, weights)
    index = fit_blocks(train, spec, weights=weights)
    rows, both = _both(train, test)
    index = index.scaled(train)
    return stored_vectors(rows, index.cells(both), index.size).select(*FEATURES.fieldNames())


def _both(train: DataFrame, test: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(id, rating, split) of all rows, and the rows."""
    both = train.withColumn("split", F.lit("train")).unionByName(
        test.withColumn("split", F.lit("test")), allowMissingColumns=True
    )
    if "rating" not in both.columns:
        both = both.withColumn("rating", F.lit(None).cast("int"))
    return both.select("id", "rating", "split"), both


def _reduced_features(train: DataFrame, test: DataFrame, spec: TermSpec, k: int, weights: Mapping[str, float]) -> DataFrame:
    index = fit_blocks(train, spec, weights=weights)
    rows, _ = _both(train, test)
    # The cells of the training part are made once, for the factors and the projection.
    known, path = stored(index.packed(train), "cells")
    factors = truncated_svd(known, k)
    zeros = F.array_repeat(F.lit(0.0), factors.k)
    cells = known.unionByName(index.packed(test))
    projected = rows.join(factors.project(cells), "id", "left").withColumn("z", F.coalesce("z", zeros))
    projected, _ = stored(projected, "projected")
    removed(train.sparkSession, path)
    scaled = unit_range(projected, projected.where(F.col("split") == "train"), factors.k)
    return scaled.withColumn("features", array_to_vector("z")).select(*FEATURES.fieldNames())
