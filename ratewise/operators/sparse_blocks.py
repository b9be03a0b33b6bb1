"""Feature matrices of any width: cells from indexes that are tables.

A block is a column of texts (TF-IDF) or of values (one-hot). Fitting counts
its terms or values and numbers them by ranges; the index stays a table, which
cells are joined with behind a check of its size, its heaviest keys apart. No
list of terms or values reaches the driver, only their number. The largest value
of a column, for scaling, is one more column of the index, so scaling needs no
join of its own.

Defined results: a null text or value has no cells; terms and values that were
not fitted are dropped; a block of weight 0 keeps its columns without cells; an
empty table gives no cells.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratewise.operators import tfidf as V
from ratewise.operators.features import categories
from ratewise.operators.joins import lookup_join
from ratewise.operators.ordering import with_position
from ratewise.operators.randomized_svd import packed
from ratewise.session import checkpointed, scratch_path


@dataclass(frozen=True)
class Block:
    """A fitted column: its index (key, n, idx, scale, ...), first position, number of positions and weight."""

    column: str
    index: DataFrame
    start: int
    size: int
    weight: float
    spec: V.TermSpec | None = None
    frequent: DataFrame | None = None

    def cells(self, rows: DataFrame) -> DataFrame:
        """(id, idx, value) within the block, weighed but not scaled, and the scale."""
        if self.spec is not None:
            texts = rows.select("id", F.col(self.column).alias("content")).where(F.col("content").isNotNull())
            found = V.weigh_indexed(texts, self.spec, self.index)
            if found is None:
                found = V.weigh(texts, self.spec, self.index, frequent=self.frequent)
        else:
            facts = rows.select("id", F.col(self.column).alias("value")).where(F.col("value").isNotNull())
            found = lookup_join(facts, self.index, "value", "n").withColumn("value", F.lit(1.0))
        weight = F.lit(float(self.weight))
        return found.select("id", (F.col("idx") + F.lit(self.start)).alias("idx"), (F.col("value") * weight).alias("value"), "scale")


@dataclass(frozen=True)
class FeatureIndex:
    """Blocks side by side."""

    blocks: Sequence[Block]

    @property
    def size(self) -> int:
        return sum(b.size for b in self.blocks)

    def cells(self, rows: DataFrame) -> DataFrame:
        """(id, idx, value) of all blocks; ``rows`` need a unique id."""
        parts = [b.cells(rows) for b in self.blocks if b.weight != 0]
        if not parts:
            return rows.select("id", F.lit(0).cast("long").alias("idx"), F.lit(0.0).alias("value")).limit(0)
        made = parts[0]
        for part in parts[1:]:
            made = made.unionByName(part)
        return made.select("id", "idx", (F.col("value") / F.col("scale")).alias("value"))

    def packed(self, rows: DataFrame) -> DataFrame:
        """(id, idx, value): ``cells`` of ``rows`` with those of an id in one row of arrays."""
        used = [b for b in self.blocks if b.weight != 0]
        texts, facts = ([b for b in used if (b.spec is not None) == kind] for kind in (True, False))
        if len(texts) == 1:
            b = texts[0]
            known = rows.select("id", F.col(b.column).alias("content")).where(F.col("content").isNotNull())
            others = FeatureIndex(facts).cells(rows) if facts else None
            found = V.pack_indexed(known, b.spec, b.index, b.start, float(b.weight), others)
            if found is not None:
                return found
        return packed(self.cells(rows))

    def scaled(self, train: DataFrame) -> FeatureIndex:
        """The same columns divided by their largest absolute values over ``train``."""
        made = []
        for b in self.blocks:
            if b.weight != 0 and b.size:
                largest = b.cells(train).groupBy((F.col("idx") - F.lit(b.start)).alias("idx")).agg(F.max(F.abs("value")).alias("_most"))
                known = b.index.drop("scale").join(largest, "idx", "left")
                scale = F.when(F.col("_most") > 0, F.col("_most")).otherwise(1.0).alias("scale")
                b = replace(b, index=checkpointed(known.select(*[c for c in b.index.columns if c != "scale"], scale)))
            made.append(b)
        return FeatureIndex(made)


def fit_blocks(
    train: DataFrame,
    spec: V.TermSpec,
    text: str = "content",
    values: Sequence[str] = ("product", "author"),
    weights: Mapping[str, float] | None = None,
) -> FeatureIndex:
    """Index the terms of a text column and the values of others, in alphabetical order."""
    weights, unit = weights or {}, F.lit(1.0).alias("scale")
    texts = train.select("id", F.col(text).alias("content")).where(F.col("content").isNotNull())
    frequency, frequent = V.fit_terms(texts, spec)
    index = checkpointed(with_position(frequency, ["term"], "idx", start=0).select("*", unit))
    blocks = [Block(text, index, 0, index.count(), weights.get(text, 1.0), spec, frequent)]
    for column in values:
        known = categories(train.where(F.col(column).isNotNull()), column)
        index = checkpointed(known.select(F.col("value").cast("string").alias("value"), "n", "idx", unit))
        before = blocks[-1]
        blocks.append(Block(column, index, before.start + before.size, index.count(), weights.get(column, 1.0)))
    return FeatureIndex(blocks)


def stored_vectors(rows: DataFrame, cells: DataFrame, size: int, path: str | None = None) -> DataFrame:
    """``rows`` with a sparse vector ``features`` of their cells, written to ``path`` and read back.

    A vector is written as the fields it is stored by, so that no Python code touches
    the cells; reading them with the vector type makes them vectors.
    """
    if size >= 1 << 31:
        raise ValueError(f"{size} columns exceed the positions of a vector")
    ordered = F.array_sort(F.collect_list(F.struct(F.col("idx").cast("int").alias("i"), F.col("value").alias("v"))))
    held = cells.where(F.col("value") != 0).groupBy("id").agg(ordered.alias("_cells"))
    none = F.array().cast("array<struct<i: int, v: double>>")
    full = rows.join(held, "id", "left").withColumn("_cells", F.coalesce("_cells", none))
    vector = F.struct(
        F.lit(0).cast("byte").alias("type"),
        F.lit(size).cast("int").alias("size"),
        F.transform("_cells", lambda c: c["i"]).alias("indices"),
        F.transform("_cells", lambda c: c["v"]).alias("values"),
    )
    spark = rows.sparkSession
    path = path or scratch_path(spark, "vectors")
    full.select(*rows.columns, vector.alias("features")).write.parquet(path)
    return spark.read.schema(T.StructType([*rows.schema.fields, T.StructField("features", VectorUDT())])).parquet(path)
