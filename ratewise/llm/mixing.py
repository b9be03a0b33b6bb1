"""Mixing sources to target weights by capped water-filling.

Every source gets a share of a word budget by its weight. A source whose share
is above ``max_epochs`` times its own words is clamped there, and the excess is
shared among the others by weight until none is above. The share is then taken
as whole repetitions of all its documents plus a seeded sample for the rest.

Defined results: a null or empty text has size 0 and is never repeated; a null
source is a source of its own, last in order; documents that repeat count each
time; an empty table gives an empty mix. ``mix`` returns the columns it names;
``repeated`` keeps all columns and refuses names that clash with its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratewise.llm import kernels as K
from ratewise.session import checkpointed

_DIGITS = 3  # hex digits of the seeded digest that deal a source's rows into cells


def word_sizes(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """Number of words between white space, of every whole text."""

    def count(batch):
        return {"size": [len(K.space_words(t)[1]) for t in K.text_bytes(batch.column(text))]}

    return K.map_batches(docs.select(*dict.fromkeys([*keep, text])), count, "size long", keep)


def targets(sizes: DataFrame, weights: tuple[float, ...], budget: float = 1.0, max_epochs: float = 3.0) -> DataFrame:
    """(source, source_size, target) from rows of (source, size).

    ``weights`` repeat over the sources in code point order. One row per source
    is all that the windows see. With sources sorted by cap over weight, a
    source is clamped if its cap is not above its share of what the sources
    before it leave; that is where repeated redistribution ends.
    """
    by_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("_rank") - 1) % len(weights) + 1)
    weighted = by_source.withColumn("_rank", F.row_number().over(order)).select(
        "source", "source_size", weight.alias("_w"), (F.col("source_size") * float(max_epochs)).alias("_cap")
    )
    everything = Window.partitionBy()
    before = Window.orderBy(F.col("_cap") / F.col("_w"), F.col("source").asc_nulls_last()).rowsBetween(
        Window.unboundedPreceding, -1
    )
    whole = F.sum(F.col("source_size").cast("double")).over(everything) * float(budget)
    shared = weighted.select(
        "*",
        (whole - F.coalesce(F.sum("_cap").over(before), F.lit(0.0))).alias("_left"),
        (F.sum("_w").over(everything) - F.coalesce(F.sum("_w").over(before), F.lit(0.0))).alias("_open"),
    ).withColumn("_clamped", F.col("_cap") * F.col("_open") <= F.col("_w") * F.col("_left"))
    # The first source in order that is not clamped knows what is left for the open ones.
    level = F.min(F.when(~F.col("_clamped"), F.struct(F.col("_cap") / F.col("_w"), F.col("_left") / F.col("_open")))).over(
        everything
    )
    return shared.withColumn("_level", level["col2"]).select(
        "source",
        "source_size",
        F.when(F.col("_clamped"), F.col("_cap")).otherwise(F.col("_w") * F.col("_level")).alias("target"),
    )


def seeded_digest(seed: int, doc_id: str = "doc_id", text: str = "text") -> Column:
    """Order of the sample: a digest of seed, id and text, the same in every run."""
    return F.md5(
        F.concat_ws(
            ":", F.lit(str(seed)), F.coalesce(F.col(doc_id).cast("string"), F.lit("")), F.md5(F.coalesce(F.col(text), F.lit("")))
        )
    )


def sampling_plan(sized: DataFrame, plan: DataFrame) -> DataFrame:
    """(source, source_size, target, whole, cut): how each source is taken.

    Every document is taken ``whole`` times, and once more if its digest is not
    above ``cut``. Rows of (source, digest, size) are first summed by source and
    leading digits of the digest; only the one cell per source in which the
    words run out is looked at digest by digest, so no task sees a source. Rows
    with equal digests are equal rows and are treated alike. ``sized`` is read
    twice and should be materialised.
    """
    plan = plan.withColumn(
        "whole", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    ).withColumn("_rest", F.col("target") - F.col("whole") * F.col("source_size"))
    cell = F.substring("digest", 1, _DIGITS)
    upto = Window.partitionBy("source").orderBy("_cell")
    sums = (
        sized.groupBy(F.col("source"), cell.alias("_cell"))
        .agg(F.sum("size").alias("_sum"))
        .withColumn("_upto", F.sum("_sum").over(upto))
        .withColumnRenamed("source", "_source")
    )
    edge = (
        plan.join(sums, F.col("source").eqNullSafe(F.col("_source")))
        .where((F.col("_upto") > F.col("_rest")) & (F.col("_upto") - F.col("_sum") <= F.col("_rest")))
        .select("_source", F.col("_cell").alias("_edge"), (F.col("_upto") - F.col("_sum")).alias("_before"), "_rest")
    )
    running = Window.partitionBy("_source").orderBy("digest")
    cuts = (
        sized.withColumn("_cell", cell)
        .join(F.broadcast(edge) if _small(edge) else edge, F.col("source").eqNullSafe(F.col("_source")) & (F.col("_cell") == F.col("_edge")))
        .groupBy("_source", "digest", "_before", "_rest")
        .agg(F.sum("size").alias("_sum"))
        .withColumn("_upto", F.col("_before") + F.sum("_sum").over(running))
        .where(F.col("_upto") - F.col("_sum") / 2 <= F.col("_rest"))
        .groupBy("_source")
        .agg(F.max("digest").alias("_last"))
    )
    joined = plan.join(edge.select("_source", "_edge"), F.col("source").eqNullSafe(F.col("_source")), "left").drop("_source")
    joined = joined.join(cuts, F.col("source").eqNullSafe(F.col("_source")), "left").drop("_source")
    # Nothing of the edge cell fits: all earlier cells are taken, and they sort below its bare digits.
    # Without a rest nothing is taken once more, not even documents without words.
    cut = F.when(F.col("_rest") > 0, F.coalesce(F.col("_last"), F.col("_edge")))
    return joined.select("source", "source_size", "target", "whole", cut.alias("cut"))


def _small(sources: DataFrame, rows: int = 100_000) -> bool:
    """Whether a table with one row per source may be broadcast."""
    size = sources.agg(F.count(F.lit(1)).alias("n"), F.max(F.octet_length(sources.columns[0])).alias("width")).first()
    return size.n * ((size.width or 0) + 100) <= rows * 200


def apply_plan(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """Add source_size, target and copies to rows of (source, digest, ...)."""
    plan = checkpointed(plan.withColumnRenamed("source", "_source"))
    plan = F.broadcast(plan) if _small(plan) else plan
    joined = rows.join(plan, F.col("source").eqNullSafe(F.col("_source")), "left")
    extra = F.coalesce(F.col("digest") <= F.col("cut"), F.lit(False)).cast("int")
    return joined.withColumn("copies", (F.col("whole") + extra).cast("int")).drop("_source", "whole", "cut")


def plan_of(
    docs: DataFrame,
    weights: tuple[float, ...] = (5, 2, 1),
    budget: float = 1.0,
    max_epochs: float = 3.0,
    seed: int = 17,
) -> tuple[DataFrame, DataFrame]:
    """Materialised (doc_id, source, digest, size) of all documents, and their sampling plan."""
    keyed = docs.select("doc_id", "source", "text", seeded_digest(seed).alias("digest"))
    sized = checkpointed(word_sizes(keyed, keep=("doc_id", "source", "digest")))
    return sized, sampling_plan(sized, checkpointed(targets(sized, weights, budget, max_epochs)))


def mix(docs: DataFrame, **options) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, copies, taken."""
    sized, plan = plan_of(docs, **options)
    return apply_plan(sized, plan).drop("digest").withColumn("taken", F.col("size") * F.col("copies"))


def repeated(docs: DataFrame, **options) -> DataFrame:
    """The mixed corpus itself: each document as often as the mix takes it, with its own columns.

    Documents without words are taken like any other of their source.
    """
    clash = [c for c in docs.columns if c in ("digest", "source_size", "target", "copies", "whole", "cut", "_source")]
    if clash:
        raise ValueError(f"column names are taken: {clash}")
    _, plan = plan_of(docs, **options)
    mixed = apply_plan(docs.withColumn("digest", seeded_digest(options.get("seed", 17))), plan)
    return mixed.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.greatest("copies", F.lit(0))))).where(
        F.col("copies") > 0
    ).select(*docs.columns)
