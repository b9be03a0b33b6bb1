"""Splits, error measures, confusion matrices, votes and tuning-trial tables."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratewise.functions.numeric import (
    class_of_best,
    mean_absolute_error,
    seeded_draw,
    seeded_fraction,
    weighted_average,
)
from ratewise.operators.ordering import with_position

# The usual hold-out.
VALIDATE_PART = 0.05
SEED = 659


def holdout(
    df: DataFrame, test_size: float = VALIDATE_PART, seed: int = SEED, key: str = "id"
) -> tuple[DataFrame, DataFrame]:
    """(training, validation) by a seeded hash of the key: stable under recomputation."""
    df = require_key(df, key)
    draw = seeded_fraction(F.col(key), seed)
    return df.where(draw >= test_size), df.where(draw < test_size)


_DRAW_BITS, _LEVEL_BITS = 60, 15


def nth_draw(draws: DataFrame, n: int) -> tuple[int, int]:
    """(value, rest): the n-th smallest of a column ``draw`` of 60-bit numbers, and how many of its equals are among the n.

    Each level counts the numbers by their next 15 bits, within the cell that
    holds the n-th: partial sums in every task, at most 32,768 counts on the driver,
    no sort and no shuffle of rows. After four levels the cell is one number.
    """
    low, shift = 0, _DRAW_BITS
    while shift > 0:
        shift -= _LEVEL_BITS
        inside = (F.col("draw") >= F.lit(low)) & (F.col("draw") < F.lit(low + (1 << (shift + _LEVEL_BITS))))
        cell = F.shiftright(F.col("draw") - F.lit(low), shift).alias("cell")
        counts = draws.where(inside).groupBy(cell).agg(F.count(F.lit(1)).alias("n")).collect()
        for row in sorted(counts, key=lambda r: r.cell):
            if n <= row.n:
                low += row.cell << shift
                break
            n -= row.n
        else:
            raise ValueError("fewer rows than asked for")
    return low, n


def exact_holdout(
    df: DataFrame, test_size: float = VALIDATE_PART, seed: int = SEED, key: str = "id"
) -> tuple[DataFrame, DataFrame]:
    """(training, validation) with exactly ceil(test_size x rows) rows in the second, for unique keys.

    The rows with the smallest seeded hashes of the key are held out. Only the
    keys are read to find the largest of these hashes; rows stay where they are, and
    a recomputed partition is split alike. Keys with one hash are taken in their order.
    """
    df = require_key(df, key)
    draws = df.select(key, seeded_draw(F.col(key), seed).alias("draw"))
    wanted = math.ceil(test_size * draws.count())
    if wanted == 0:
        return df, df.limit(0)
    value, rest = nth_draw(draws, wanted)
    last = draws.where(F.col("draw") == F.lit(value)).select(key).orderBy(key).limit(rest).agg(F.max(key)).first()[0]
    draw = seeded_draw(F.col(key), seed)
    held = (draw < F.lit(value)) | ((draw == F.lit(value)) & (F.col(key) <= F.lit(last)))
    return df.where(~held), df.where(held)


_CUT_BITS = 10
MOST_CUTS = 1_000


def draw_cuts(draws: DataFrame, wanted: dict[object, list[int]]) -> dict[object, list[int]]:
    """For each group and each number n wanted of it, the n-th smallest draw of the group.

    ``draws`` has ``group`` and ``draw`` (60 bits). All cuts are narrowed down
    together, 10 bits a level: a level counts the draws of the cells that still hold
    a cut, by partial sums in the tasks, and brings at most 1,024 counts a cut
    to the driver. A cut that falls on the end of a cell is done, so the number of levels
    grows with the logarithm of the rows. No row is sorted or moved.
    """
    spark, shift = draws.sparkSession, _DRAW_BITS
    found: dict[tuple, int] = {}
    kind = draws.schema["group"].dataType.simpleString()
    open_cuts = {(g, 0): [(i, n) for i, n in enumerate(ranks)] for g, ranks in wanted.items() if ranks}
    while open_cuts:
        prefix = F.shiftright("draw", shift) if shift < _DRAW_BITS else F.lit(0).cast("bigint")
        active = spark.createDataFrame(list(open_cuts), f"group {kind}, prefix long")
        shift -= _CUT_BITS
        cell = F.shiftright("draw", shift).bitwiseAND(F.lit((1 << _CUT_BITS) - 1))
        inside = draws.withColumn("prefix", prefix).join(F.broadcast(active), ["group", "prefix"])
        counts: dict[tuple, list] = {}
        for r in inside.groupBy("group", "prefix", cell.alias("cell")).agg(F.count(F.lit(1)).alias("n")).collect():
            counts.setdefault((r.group, r.prefix), []).append((r.cell, r.n))
        narrower: dict[tuple, list] = {}
        for key, cuts in open_cuts.items():
            for cut, rest in cuts:
                for number, n in sorted(counts.get(key, [])):
                    if rest <= n:
                        place = (key[1] << _CUT_BITS) + number
                        if rest == n or shift == 0:
                            found[key[0], cut] = ((place + 1) << shift) - 1
                        else:
                            narrower.setdefault((key[0], place), []).append((cut, rest))
                        break
                    rest -= n
                else:
                    raise ValueError("fewer rows than asked for")
        open_cuts = narrower
    return {g: [found[g, i] for i in range(len(ranks))] for g, ranks in wanted.items()}


def _beyond(draw: Column, cuts: Sequence[int]) -> Column:
    """How many of the cuts lie below the draw."""
    return sum(((draw > F.lit(c)).cast("int") for c in cuts), F.lit(0))


def stratified_folds(
    df: DataFrame, label: str, n_folds: int = 3, seed: int = SEED, key: str = "id"
) -> DataFrame:
    """Add ``fold``: each class is cut into folds whose sizes differ by one at most, in a seeded order of the keys.

    Only keys and labels are read to find the cuts; rows are neither sorted nor
    moved, and a class may hold any part of them. Rows of one key and class
    come into one fold. Rows without a label are left out. Beyond ``MOST_CUTS`` cuts
    (classes x folds) the rows are numbered instead.
    """
    df = require_key(df, key).where(F.col(label).isNotNull())
    draw = seeded_draw(F.col(key), seed)
    sizes = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    few = sizes.limit(MOST_CUTS + 1).collect()
    if len(few) * (n_folds - 1) > MOST_CUTS:
        return _numbered_folds(df, label, n_folds, seed, key)
    wanted = {}
    for row in few:
        ends = [-(-(row.n - f) // n_folds) for f in range(n_folds)]
        wanted[row[label]] = [sum(ends[: f + 1]) for f in range(n_folds - 1)]
    cuts = draw_cuts(df.select(F.col(label).alias("group"), draw.alias("draw")), wanted)
    fold = F.lit(0)
    for value, own in cuts.items():
        fold = F.when(F.col(label) == F.lit(value), _beyond(F.col("_draw"), own)).otherwise(fold)
    return df.withColumn("_draw", draw).withColumn("fold", fold.cast("int")).drop("_draw")


def _numbered_folds(df: DataFrame, label: str, n_folds: int, seed: int, key: str) -> DataFrame:
    """Folds by global positions in (class, hash) order, for any number of classes."""
    draw = df.withColumn("_draw", seeded_fraction(F.col(key), seed))
    placed = with_position(draw, [label, "_draw", key], "_position", start=0)
    first = placed.groupBy(label).agg(F.min("_position").alias("_first"))
    return (
        placed.join(first, label)
        .withColumn("fold", ((F.col("_position") - F.col("_first")) % n_folds).cast("int"))
        .drop("_draw", "_position", "_first")
    )


def numbered_batches(
    df: DataFrame, batch_size: int | None = None, n_batches: int | None = None, seed: int = SEED, key: str = "id"
) -> DataFrame:
    """Add ``batch_no`` in a seeded order.

    With ``n_batches`` all rows are dealt over that many batches whose sizes
    differ by one at most; up to ``MOST_CUTS`` of them are cut by the hash of the
    key without moving a row. With ``batch_size`` a last batch shorter than the
    rest is dropped, as its step would weigh as much as a full one.
    """
    if (batch_size is None) == (n_batches is None):
        raise ValueError("give batch_size or n_batches")
    df = require_key(df, key)
    if n_batches is not None and n_batches <= MOST_CUTS:
        draw = seeded_draw(F.col(key), seed)
        n = df.count()
        dealt = min(n_batches, max(n, 1))
        ranks = [-(-b * n // dealt) for b in range(1, dealt)]
        draws = df.select(F.lit(0).alias("group"), draw.alias("draw"))
        cuts = draw_cuts(draws, {0: ranks})[0]
        batch = _beyond(F.col("_draw"), cuts).cast("bigint")
        return df.withColumn("_draw", draw).withColumn("batch_no", batch).drop("_draw")
    draw = df.withColumn("_draw", seeded_fraction(F.col(key), seed))
    placed = with_position(draw, ["_draw", key], "_position", start=0)
    n = placed.agg(F.count(F.lit(1)).alias("n")).first().n
    if n_batches is not None:
        batch = F.floor(F.col("_position") * min(n_batches, max(n, 1)) / F.lit(max(n, 1)))
    else:
        batch = F.floor(F.col("_position") / batch_size)
    numbered = placed.withColumn("batch_no", batch)
    if batch_size is not None:
        numbered = numbered.where(F.col("batch_no") < n // batch_size)
    return numbered.drop("_draw", "_position")


def require_key(df: DataFrame, key: str) -> DataFrame:
    """The rows, with an error in place of one without its key."""
    message = F.lit(f"row without {key}: splits, folds and batches need one")
    present = F.when(F.col(key).isNotNull(), True).otherwise(F.raise_error(message).cast("boolean"))
    return df.where(present)


def id_contiguity(df: DataFrame, key: str = "id") -> DataFrame:
    """Count, extremes and whether the ids are exactly 1..n (no sort needed)."""
    return df.agg(
        F.count(F.lit(1)).alias("n"),
        F.min(key).alias("min_id"),
        F.max(key).alias("max_id"),
        F.count_distinct(key).alias("n_distinct"),
    ).withColumn(
        "contiguous",
        F.coalesce(
            (F.col("n") == 0)
            | ((F.col("min_id") == 1) & (F.col("max_id") == F.col("n")) & (F.col("n_distinct") == F.col("n"))),
            F.lit(False),
        ),
    )


# --- scores ---------------------------------------------------------------------


def mae(df: DataFrame, truth: str = "rating", prediction: str = "prediction") -> DataFrame:
    return df.agg(mean_absolute_error(F.col(truth), F.col(prediction)).alias("mae"))


def confusion_matrix(
    df: DataFrame,
    classes: Sequence[int],
    truth: str = "rating",
    prediction: str = "prediction",
) -> DataFrame:
    """Counts with one row per predicted and one column ``truth_<c>`` per true class."""
    spark = df.sparkSession
    counts = (
        df.groupBy(F.col(prediction).cast("int").alias("prediction"))
        .pivot(truth, list(classes))
        .agg(F.count(F.lit(1)))
        .withColumnsRenamed({str(c): f"truth_{c}" for c in classes})
    )
    rows = spark.createDataFrame([(int(c),) for c in classes], "prediction int")
    return rows.join(counts, "prediction", "left").na.fill(0)


def normalize_rows(matrix: DataFrame, row: str = "prediction") -> DataFrame:
    """Each cell as a share of its row; NULL in a row without any count."""
    cells = [c for c in matrix.columns if c != row]
    total = F.lit(0)
    for c in cells:
        total = total + F.col(c)
    return matrix.select(row, *[F.try_divide(F.col(c), total).alias(c) for c in cells])


# --- votes ------------------------------------------------------------------------


def soft_vote(
    df: DataFrame,
    probabilities: Sequence[str | Column],
    weights: Sequence[float] | None = None,
    n_classes: int = 5,
) -> DataFrame:
    """Add ``vote_probability`` (weighted mean) and ``vote`` (1-based best class)."""
    columns = [F.col(p) if isinstance(p, str) else p for p in probabilities]
    weights = weights or [1.0] * len(columns)
    mean = weighted_average(columns, weights, n_classes)
    return df.withColumn("vote_probability", mean).withColumn(
        "vote", class_of_best(F.col("vote_probability"))
    )


# --- tuning trials -------------------------------------------------------------------


METRICS = ("score_training", "score_validate", "t_training")


def trial_summary(
    trials: DataFrame, params: Sequence[str], metrics: Sequence[str] = METRICS
) -> DataFrame:
    """Mean and population deviation of each metric per parameter combination."""
    return trials.groupBy(*params).agg(
        *[F.avg(m).alias(f"mean_{m}") for m in metrics],
        *[F.stddev_pop(m).alias(f"std_{m}") for m in metrics],
        F.count(F.lit(1)).alias("n_trials"),
    )


def best_trial(trials: DataFrame, score: str, tie_break: Sequence[str]) -> DataFrame:
    return trials.where(F.col(score).isNotNull()).orderBy(score, *tie_break).limit(1)


def best_k_trials(cells: DataFrame, score: str, k: int = 5) -> DataFrame:
    """Cells strictly below the (k+1)-th smallest score; ties with it stay out.

    Every cell is returned when there are at most ``k``.
    """
    kth = (
        cells.select(score)
        .orderBy(score)
        .limit(k + 1)
        .agg(F.when(F.count(F.lit(1)) == k + 1, F.max(score)))
        .scalar()
    )
    return cells.where(F.coalesce(F.col(score) < kth, F.lit(True)))


def trial_pivot(
    trials: DataFrame, row: str, column: str, values: Sequence, score: str, prefix: str
) -> DataFrame:
    """Mean score as a grid, one column ``<prefix><value>`` per given value."""
    return (
        trials.groupBy(row)
        .pivot(column, list(values))
        .agg(F.avg(score))
        .withColumnsRenamed({str(v): f"{prefix}{v}" for v in values})
    )
