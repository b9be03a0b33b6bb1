"""Noun lemmas by suffix rules checked against a lexicon."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratewise.operators.joins import fits_broadcast

# English noun endings and what replaces them.
NOUN_ENDINGS = (
    ("s", ""),
    ("ses", "s"),
    ("ves", "f"),
    ("xes", "x"),
    ("zes", "z"),
    ("ches", "ch"),
    ("shes", "sh"),
    ("men", "man"),
    ("ies", "y"),
)


def build_lemmas(
    forms: DataFrame,
    lexicon: DataFrame,
    endings: Sequence[tuple[str, str]] = NOUN_ENDINGS,
) -> DataFrame:
    """Table (form, lemma) for every form in ``forms.term`` whose lemma differs.

    Candidates are the form itself and each applicable ending rule; those found
    in ``lexicon.term`` count, the shortest wins (ties: the earlier rule).
    """
    candidates = F.array(
        F.struct(F.lit(0).alias("rule"), F.col("form").alias("lemma")),
        *[
            F.struct(
                F.lit(i).alias("rule"),
                F.when(
                    F.col("form").endswith(old),
                    F.concat(F.expr(f"left(form, length(form) - {len(old)})"), F.lit(new)),
                ).alias("lemma"),
            )
            for i, (old, new) in enumerate(endings, start=1)
        ],
    )
    proposed = (
        forms.select(F.col("term").alias("form"))
        .select("form", F.inline(candidates))
        .where(F.col("lemma").isNotNull())
    )
    known = lexicon.select(F.col("term").alias("lemma"))
    return (
        proposed.join(known, "lemma", "left_semi")
        .groupBy("form")
        .agg(F.min_by("lemma", F.struct(F.length("lemma"), F.col("rule"))).alias("lemma"))
        .where(F.col("form") != F.col("lemma"))
    )


def lemmatize(tokens: DataFrame, lemmas: DataFrame, column: str = "tokens") -> DataFrame:
    """Replace every token that has a lemma, keeping the order; ``id`` must be unique.

    A small lemma table goes to every executor, and tokens are replaced where they
    are. A larger one (materialise it) is joined by token, and adaptive
    execution splits the partitions of frequent tokens.
    """
    rest = [c for c in tokens.columns if c not in ("id", column)]
    if fits_broadcast(lemmas, "form"):
        replaced = _replaced(tokens.select("id", column), lemmas, column)
        numbered = lambda text: F.transform(text, lambda t, i: F.struct(i.alias("i"), t.alias("token")))
        merged = F.array_sort(F.flatten(F.transform("_all", numbered))).getField("token")
        # Rows of one id are one text, as they are in the join below.
        regrouped = replaced.groupBy("id").agg(F.collect_list(column).alias("_all")).select(
            "id", F.when(F.size("_all") == 1, F.col("_all")[0]).otherwise(merged).alias(column)
        )
        return tokens.select("id", *rest).join(regrouped, "id") if rest else regrouped
    table = lemmas.select(F.col("form").alias("_form"), "lemma")
    placed = tokens.select("id", F.posexplode_outer(column).alias("_pos", "_form"))
    joined = placed.join(table, "_form", "left")
    regrouped = joined.groupBy("id").agg(
        F.array_sort(
            F.collect_list(
                F.when(
                    F.col("_pos").isNotNull(),
                    F.struct("_pos", F.coalesce("lemma", "_form").alias("token")),
                )
            )
        ).getField("token").alias(column)
    )
    return tokens.select("id", *rest).join(regrouped, "id") if rest else regrouped


def _replaced(tokens: DataFrame, lemmas: DataFrame, column: str) -> DataFrame:
    """Tokens with their lemmas from a table of checked size; null tokens become none."""
    rows = lemmas.select("form", "lemma").collect()
    shared = tokens.sparkSession.sparkContext.broadcast(([r.form for r in rows], [r.lemma for r in rows]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forms, known = (pa.array(values, pa.string()) for values in shared.value)
        for batch in batches:
            lists = batch.column(column)
            size = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
            coded = lists.flatten().dictionary_encode()
            words = pc.coalesce(known.take(pc.index_in(coded.dictionary, value_set=forms)), coded.dictionary)
            offsets = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
            made = pa.ListArray.from_arrays(pa.array(offsets), words.take(coded.indices))
            yield pa.RecordBatch.from_arrays([batch.column("id"), made], names=["id", column])

    return tokens.mapInArrow(run, tokens.schema)
