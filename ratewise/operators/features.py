"""Feature blocks: long-form cells and pyspark.ml stages that build vectors.

The ml stages keep a vocabulary, labels or components on the driver, as Spark's
own stages do. Each checks the size first and raises instead of growing with the
data; the long forms have no such limit.
"""

from __future__ import annotations

import itertools
import threading
from collections.abc import Mapping, Sequence

import numpy as np
import pandas as pd
from py4j.protocol import Py4JJavaError
from pyspark import StorageLevel
from pyspark.ml import Estimator, Pipeline, PipelineModel, Transformer
from pyspark.ml.common import _py2java
from pyspark.ml.feature import (
    CountVectorizerModel,
    ElementwiseProduct,
    MaxAbsScaler,
    MinMaxScaler,
    Normalizer,
    OneHotEncoder,
    PCAModel,
    StopWordsRemover,
    StringIndexer,
    VectorAssembler,
    VectorSlicer,
)
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import DenseMatrix, DenseVector, Vectors
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasOutputCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.mllib.linalg.distributed import RowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratewise.functions.stopwords import english_stop_words
from ratewise.functions.text import ngram_range, word_tokens
from ratewise.operators.joins import lookup_join
from ratewise.operators.lemmas import lemmatize
from ratewise.operators.ordering import with_position
from ratewise.operators.randomized_svd import TruncatedFactors, truncated_svd
from ratewise.operators.selection import chi2_scores, select_k_best
from ratewise.operators.tfidf import TermSpec, document_frequency
from ratewise.session import checkpointed

ITEMS = ("content", "product", "author")
MAX_DRIVER_ENTRIES = 4_000_000
MAX_DRIVER_CELLS = 200_000_000


def select_item(reviews: DataFrame, key: str, as_map: bool = False) -> DataFrame:
    """(id, item): the content, product or author, plain or as a one-entry map."""
    if key not in ITEMS:
        raise ValueError(f"key must be one of {ITEMS}")
    item = F.create_map(F.col(key), F.lit(1)) if as_map else F.col(key)
    return reviews.select("id", item.alias("item"))


# --- long form --------------------------------------------------------------------


def categories(train: DataFrame, column: str) -> DataFrame:
    """(value, n, idx): distinct values in alphabetical order with their frequency."""
    counts = train.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    return with_position(counts, ["value"], "idx", start=0)


def one_hot_cells(reviews: DataFrame, column: str, known: DataFrame) -> DataFrame:
    """(id, idx, value = 1); a value unseen in fit leaves no cell."""
    facts = reviews.select("id", F.col(column).alias("value"))
    return lookup_join(facts, known, "value", "n").select("id", "idx", F.lit(1.0).alias("value"))


def weighted_blocks(blocks: Mapping[str, DataFrame], weights: Mapping[str, float]) -> DataFrame:
    """One long table (id, block, term, value) of weighted blocks; weight 0 leaves a block out."""
    parts = [
        cells.select(
            "id", F.lit(name).alias("block"), "term", (F.col("value") * F.lit(float(weights.get(name, 1)))).alias("value")
        )
        for name, cells in blocks.items()
        if weights.get(name, 1) != 0
    ]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


# --- stages -------------------------------------------------------------------------


class WordTokens(Transformer, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """Lower-cased Unicode words; none for a null, which Spark's own stages cannot take."""

    def __init__(self, inputCol: str = "content", outputCol: str = "tokens"):
        super().__init__()
        self._set(inputCol=inputCol, outputCol=outputCol)

    def _transform(self, df: DataFrame) -> DataFrame:
        words = word_tokens(F.lower(self.getInputCol()))
        return df.withColumn(self.getOutputCol(), F.coalesce(words, F.array().cast("array<string>")))


class LemmaTokens(Transformer):
    """Tokens replaced by their lemmas from a table (form, lemma); rows need a unique ``id``."""

    def __init__(self, lemmas: DataFrame, inputCol: str = "tokens"):
        super().__init__()
        self.lemmas, self.input = lemmas, inputCol

    def _transform(self, df: DataFrame) -> DataFrame:
        return lemmatize(df, self.lemmas, self.input)


class NGramRange(Transformer, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """All n-grams of 1 to ``maxN`` tokens."""

    maxN = Param(Params._dummy(), "maxN", "longest n-gram", TypeConverters.toInt)

    def __init__(self, inputCol: str = "tokens", outputCol: str = "grams", maxN: int = 1):
        super().__init__()
        self._set(inputCol=inputCol, outputCol=outputCol, maxN=maxN)

    def _transform(self, df: DataFrame) -> DataFrame:
        grams = ngram_range(F.col(self.getInputCol()), 1, self.getOrDefault(self.maxN))
        return df.withColumn(self.getOutputCol(), grams)


class ClampRound(Transformer, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """Predictions clipped to [minR, maxR] and rounded half to even."""

    minR = Param(Params._dummy(), "minR", "lowest label", TypeConverters.toFloat)
    maxR = Param(Params._dummy(), "maxR", "highest label", TypeConverters.toFloat)

    def __init__(self, inputCol: str = "prediction", outputCol: str = "label", minR: float = 0.0, maxR: float = 5.0):
        super().__init__()
        self._set(inputCol=inputCol, outputCol=outputCol, minR=minR, maxR=maxR)

    def _transform(self, df: DataFrame) -> DataFrame:
        from ratewise.functions.numeric import clamp_round

        value = clamp_round(F.col(self.getInputCol()), self.getOrDefault(self.minR), self.getOrDefault(self.maxR))
        return df.withColumn(self.getOutputCol(), value)


def _bounded(df: DataFrame, limit: int, what: str) -> list:
    rows = df.limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"more than {limit} {what}: too many for vectors, use the long form")
    return rows


class TfidfVectorizer(Estimator):
    """Content to unit-length TF-IDF vectors; terms are indexed alphabetically.

    With a relative ``min_df`` the vocabulary is bounded whatever the corpus
    size: at most (mean distinct terms per text) / ``min_df`` terms.
    """

    # ``spec.lo`` must be 1: the vectors hold all n-grams up to ``spec.hi``.
    def __init__(
        self,
        spec: TermSpec,
        inputCol: str = "content",
        outputCol: str = "ft_content",
        weight: float = 1.0,
        lemmas: DataFrame | None = None,
    ):
        super().__init__()
        self.spec, self.input, self.output, self.weight, self.lemmas = spec, inputCol, outputCol, weight, lemmas

    def unweighed(self) -> tuple[tuple, TfidfVectorizer, WeightedColumn]:
        """What makes two of these fit alike, one of them without weight, and the stage that weighs its output."""
        made = f"{self.output}_shared"
        key = ("tfidf", self.spec.lo, self.spec.hi, self.spec.min_df, self.spec.max_df, tuple(self.spec.stop_words), self.input, made, id(self.lemmas))
        return key, TfidfVectorizer(self.spec, self.input, made, lemmas=self.lemmas), WeightedColumn(made, self.output, self.weight)

    def _fit(self, df: DataFrame) -> PipelineModel:
        out = self.output
        stages: list[Transformer] = [WordTokens(self.input, f"{out}_tokens")]
        if self.lemmas is not None:
            stages.append(LemmaTokens(self.lemmas, f"{out}_tokens"))
        if self.spec.stop_words:
            stages.append(
                StopWordsRemover(inputCol=f"{out}_tokens", outputCol=f"{out}_kept", stopWords=list(self.spec.stop_words), caseSensitive=True)
            )
        last = f"{out}_kept" if self.spec.stop_words else f"{out}_tokens"
        texts = df.select(*(["id"] if self.lemmas is not None else []), F.col(self.input).alias("content"))
        frequency = document_frequency(texts, self.spec, self.lemmas)
        rows = sorted(_bounded(frequency.select("term", "idf"), MAX_DRIVER_ENTRIES, "terms"))
        if not rows:
            raise ValueError("no term is left after the document-frequency limits")
        stages.append(NGramRange(last, f"{out}_grams", self.spec.hi))
        counts = _count_vectorizer(df, [r.term for r in rows], f"{out}_grams", f"{out}_tf")
        stages.append(counts)
        stages.append(
            ElementwiseProduct(scalingVec=Vectors.dense([r.idf for r in rows]), inputCol=f"{out}_tf", outputCol=f"{out}_raw")
        )
        name = out if self.weight == 1 else f"{out}_unit"
        stages.append(Normalizer(p=2.0, inputCol=f"{out}_raw", outputCol=name))
        if self.weight != 1:
            stages.append(_scaled(name, out, self.weight, len(rows)))
        return PipelineModel(stages)


def _count_vectorizer(df: DataFrame, terms: list[str], source: str, target: str) -> CountVectorizerModel:
    # Terms hold no control characters, so one string carries them all; passing
    # a list takes one call to the JVM per term.
    jvm = df.sparkSession.sparkContext._jvm
    vocabulary = jvm.java.util.regex.Pattern.compile("\u0001").split("\u0001".join(terms))
    java_model = jvm.org.apache.spark.ml.feature.CountVectorizerModel(vocabulary)
    return CountVectorizerModel(java_model).setInputCol(source).setOutputCol(target)


def _scaled(source: str, target: str, weight: float, size: int) -> ElementwiseProduct:
    return ElementwiseProduct(
        scalingVec=Vectors.dense(np.full(size, float(weight))), inputCol=source, outputCol=target
    )


class WeightedColumn(Estimator):
    """A vector column times a number, under another name."""

    def __init__(self, inputCol: str, outputCol: str, weight: float = 1.0):
        super().__init__()
        self.input, self.output, self.weight = inputCol, outputCol, weight

    def _fit(self, df: DataFrame) -> ElementwiseProduct:
        first = df.select(self.input).first()
        return _scaled(self.input, self.output, self.weight, 0 if first is None else first[0].size)


class OneHotBlock(Estimator):
    """One column per value seen in fit, alphabetical; an unseen value gives all zeros."""

    def __init__(self, inputCol: str, outputCol: str, weight: float = 1.0):
        super().__init__()
        self.input, self.output, self.weight = inputCol, outputCol, weight

    def unweighed(self) -> tuple[tuple, OneHotBlock, WeightedColumn]:
        """As :meth:`TfidfVectorizer.unweighed`."""
        made = f"{self.output}_shared"
        return ("one-hot", self.input, made), OneHotBlock(self.input, made), WeightedColumn(made, self.output, self.weight)

    def _fit(self, df: DataFrame) -> PipelineModel:
        n = df.select(self.input).where(F.col(self.input).isNotNull()).distinct().count()
        if n > MAX_DRIVER_ENTRIES:
            raise ValueError(f"more than {MAX_DRIVER_ENTRIES} values of {self.input}: use one_hot_cells")
        name = self.output if self.weight == 1 else f"{self.output}_unit"
        stages = [
            StringIndexer(inputCol=self.input, outputCol=f"{self.output}_idx", handleInvalid="keep", stringOrderType="alphabetAsc"),
            OneHotEncoder(inputCols=[f"{self.output}_idx"], outputCols=[name], dropLast=True),
        ]
        if self.weight != 1:
            stages.append(_scaled(name, self.output, self.weight, n))
        return Pipeline(stages=stages).fit(df)


#: The eigenvalue routine under computeSVD keeps state between calls: one at a time on a driver.
_ARPACK = threading.Lock()


class SparseProjection(Transformer):
    """Rows times singular vectors that are a table; rows need a unique ``id``."""

    def __init__(self, factors: TruncatedFactors, inputCol: str, outputCol: str):
        super().__init__()
        self.factors, self.input, self.output = factors, inputCol, outputCol

    def _transform(self, df: DataFrame) -> DataFrame:
        projected = self.factors.project(sparse_cells(df, self.input)).withColumnRenamed("z", "_z")
        zeros = F.array_repeat(F.lit(0.0), self.factors.k)
        return df.join(projected, "id", "left").withColumn(self.output, array_to_vector(F.coalesce("_z", zeros))).drop("_z")


class TruncatedSVD(Estimator):
    """Rank-k projection X.V without centring.

    Up to ``driver_cells`` singular vectors (features x k doubles) come from
    Spark's own decomposition and live on the driver, as a native matrix-product
    stage. Beyond that, and where that decomposition does not converge, they are a table made by random projections, and rows
    need a unique ``id``. k is cut to the number of features.
    """

    def __init__(
        self, k: int, inputCol: str = "features", outputCol: str = "reduced", driver_cells: int = MAX_DRIVER_CELLS
    ):
        super().__init__()
        self.k, self.input, self.output, self.driver_cells = int(k), inputCol, outputCol, driver_cells

    def _fit(self, df: DataFrame) -> PCAModel | SparseProjection:
        first = df.select(self.input).first()
        if first is not None and first[0].size * min(self.k, first[0].size) > self.driver_cells:
            return self._projection(df)
        # Each Lanczos step is a pass over the rows: keep them on the executors.
        kept = df.select(self.input).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            matrix = RowMatrix(MLUtils.convertVectorColumnsFromML(kept, self.input))
            n = matrix.numCols()
            k = min(self.k, n)
            with _ARPACK:
                svd = matrix.computeSVD(k)
            v = svd.V.toArray()
        except Py4JJavaError as error:
            if "ARPACK" not in str(error) or "id" not in df.columns:
                raise
            return self._projection(df)
        finally:
            kept.unpersist()
        sc = df.sparkSession.sparkContext
        # PCAModel multiplies by its matrix and does not centre.
        java_model = sc._jvm.org.apache.spark.ml.feature.PCAModel(
            self.uid,
            _py2java(sc, DenseMatrix(v.shape[0], v.shape[1], v.flatten("F"))),
            _py2java(sc, DenseVector(svd.s.toArray())),
        )
        model = PCAModel(java_model)._set(k=v.shape[1])
        return model.setInputCol(self.input).setOutputCol(self.output)

    def _projection(self, df: DataFrame) -> SparseProjection:
        return SparseProjection(truncated_svd(sparse_cells(df, self.input), self.k), self.input, self.output)


class SelectKBest(Estimator):
    """Keep the k columns with the highest chi-square of summed values; ties go to the later column.

    Sums per class and column are partial sums of the non-zero cells; the driver
    gets the numbers of the chosen columns only.
    """

    def __init__(self, k: int, inputCol: str = "features", outputCol: str = "reduced", labelCol: str = "label"):
        super().__init__()
        self.k, self.input, self.output, self.label = int(k), inputCol, outputCol, labelCol

    def _fit(self, df: DataFrame) -> VectorSlicer:
        row = df.select(self.input).first()
        size = row[0].size if row is not None else 0
        k = min(self.k, size)
        if k > MAX_DRIVER_ENTRIES:
            raise ValueError(f"more than {MAX_DRIVER_ENTRIES} columns to keep: use chi2_scores and select_k_best")
        cells = sparse_cells(df, self.input, self.label).withColumnRenamed("idx", "term")
        scored = checkpointed(chi2_scores(cells, df, self.label).where(F.round("chi2", 9) > 0))
        chosen = {r.term for r in select_k_best(scored, k).select("term").collect()}
        # Columns without a score, or without a value, tie at zero: the last ones fill up.
        zeros = (i for i in range(size - 1, -1, -1) if i not in chosen)
        filled = chosen | set(itertools.islice(zeros, k - len(chosen))) if len(chosen) < k else chosen
        return VectorSlicer(inputCol=self.input, outputCol=self.output, indices=sorted(filled))


class UnitRange(Estimator):
    """Columns scaled to [0, 1] over the training rows; a constant column becomes 0."""

    def __init__(self, inputCol: str, outputCol: str):
        super().__init__()
        self.input, self.output = inputCol, outputCol

    def _fit(self, df: DataFrame) -> PipelineModel:
        scaler = MinMaxScaler(inputCol=self.input, outputCol=f"{self.output}_raw").fit(df)
        varies = scaler.originalMin.toArray() != scaler.originalMax.toArray()
        mask = ElementwiseProduct(
            scalingVec=Vectors.dense(varies.astype(float)), inputCol=f"{self.output}_raw", outputCol=self.output
        )
        return PipelineModel([scaler, mask])


def max_abs(inputCol: str, outputCol: str) -> MaxAbsScaler:
    return MaxAbsScaler(inputCol=inputCol, outputCol=outputCol)


def assemble(blocks: Sequence[str], outputCol: str = "features") -> VectorAssembler:
    return VectorAssembler(inputCols=list(blocks), outputCol=outputCol)


def vector_cells(df: DataFrame, column: str, key: str = "id") -> DataFrame:
    """(id, idx, value) of every position of a (dense) vector column."""
    return df.select(key, F.posexplode(vector_to_array(column)).alias("idx", "value"))


def default_spec(ngram: int = 3, max_df: float = 0.3, min_df: float = 0.0003) -> TermSpec:
    return TermSpec(1, ngram, min_df, max_df, english_stop_words())


_ARRAYS = T.StructType(
    [
        T.StructField("kind", T.ByteType()),
        T.StructField("indices", T.ArrayType(T.IntegerType())),
        T.StructField("values", T.ArrayType(T.DoubleType())),
    ]
)


@F.pandas_udf(_ARRAYS)
def _vector_arrays(vectors: pd.DataFrame) -> pd.DataFrame:
    # Nothing but the arrays of the stored vector; Spark takes them apart.
    return pd.DataFrame({"kind": vectors["type"], "indices": vectors["indices"], "values": vectors["values"]})


def sparse_cells(df: DataFrame, column: str, key: str = "id") -> DataFrame:
    """(id, idx, value) of the non-zero positions of a vector column."""
    arrays = df.select(key, _vector_arrays(column).alias("_v"))
    dense = F.transform("_v.values", lambda x, i: F.struct(i.alias("idx"), x.alias("value")))
    sparse = F.transform(
        F.arrays_zip("_v.indices", "_v.values"), lambda c: F.struct(c["indices"].alias("idx"), c["values"].alias("value"))
    )
    cells = F.filter(F.when(F.col("_v.kind") == 1, dense).otherwise(sparse), lambda c: c["value"] != 0)
    return arrays.select(key, F.inline(cells))
