"""Exploratory aggregates over reviews: entities, days, histograms, ECDFs.

Everything is pre-aggregated to entities, days or distinct values before it is
ordered. Histograms list occupied bins; an empty bin is a missing row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratewise.functions.dates import day_ordinal, from_ordinal
from ratewise.functions.numeric import abs_pearson, l2_norm
from ratewise.operators.ordering import with_position, with_running_total


# --- entities and days --------------------------------------------------------


def rating_stats(reviews: DataFrame, key: str) -> DataFrame:
    """Mean rating and number of reviews per product, author, date, ..."""
    return reviews.groupBy(key).agg(
        F.avg("rating").alias("avg_rating"), F.count(F.lit(1)).alias("n_reviews")
    )


def daily_stats(reviews: DataFrame) -> DataFrame:
    return rating_stats(reviews, "date").orderBy("date")


def popularity_correlation(stats: DataFrame) -> DataFrame:
    """|Pearson| between number of reviews and mean rating over entities."""
    return stats.agg(abs_pearson(F.col("avg_rating"), F.col("n_reviews")).alias("abs_corr"))


def length_correlation(reviews: DataFrame, length: Column) -> DataFrame:
    pairs = reviews.select("rating", length.alias("n_words"))
    return pairs.agg(abs_pearson(F.col("rating"), F.col("n_words")).alias("abs_corr"))


def vector_norms(stats: DataFrame) -> DataFrame:
    return stats.agg(
        l2_norm(F.col("avg_rating")).alias("norm_avg_rating"),
        l2_norm(F.col("n_reviews").cast("double")).alias("norm_n_reviews"),
    )


def rank_curve(stats: DataFrame, key: str) -> DataFrame:
    """Entities numbered by ascending mean rating, ties by key."""
    return with_position(stats.select(key, "avg_rating"), ["avg_rating", key])


# --- distinct values ------------------------------------------------------------


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct().orderBy(column)


def min_gap(df: DataFrame, column: str) -> DataFrame:
    """Smallest distance between neighbouring distinct values, 1 if there is only one.

    Meant for a small domain such as ratings: the window runs over its values.
    """
    ordered = Window.orderBy(column)
    gaps = df.select(column).distinct().select(
        (F.col(column) - F.lag(column).over(ordered)).alias("gap")
    )
    return gaps.agg(F.coalesce(F.min("gap").cast("double"), F.lit(1.0)).alias("min_gap"))


def ecdf(df: DataFrame, column: str, small_domain: bool = False) -> DataFrame:
    """Empirical distribution in run-length form.

    The row at position i (from 0) of the sorted column has height i/N; equal
    values are one output row with their first and last height. With
    ``small_domain`` (ratings, days) the running sum is one window over the
    distinct values, otherwise it is computed partition by partition.
    """
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    if small_domain:
        upto = Window.orderBy(column).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        running = counts.withColumn("_upto", F.sum("n").over(upto))
    else:
        running = with_running_total(counts, [column], "n", "_upto")
    total = df.agg(F.count(F.lit(1))).scalar()
    return running.select(
        F.col(column).alias("value"),
        "n",
        ((F.col("_upto") - F.col("n")) / total).alias("ecdf_first"),
        ((F.col("_upto") - 1) / total).alias("ecdf_last"),
    )


# --- histograms -----------------------------------------------------------------


def _bin(value: Column, left: Column, width: Column) -> Column:
    return F.floor((value - left) / width)


def rating_histogram(reviews: DataFrame) -> DataFrame:
    """Density over bins centred on the ratings, as wide as their smallest gap."""
    counts = reviews.groupBy("rating").agg(F.count(F.lit(1)).alias("n"))
    everything = Window.partitionBy()
    prepared = (
        counts.withColumn("_gap", F.col("rating") - F.lag("rating").over(Window.orderBy("rating")))
        .withColumn("_d", F.coalesce(F.min("_gap").over(everything).cast("double"), F.lit(1.0)))
        .withColumn("_left", F.min("rating").over(everything) - F.col("_d") / 2)
        .withColumn("_total", F.sum("n").over(everything))
    )
    return (
        prepared.groupBy(_bin(F.col("rating"), F.col("_left"), F.col("_d")).alias("_b"), "_d", "_left", "_total")
        .agg(F.sum("n").alias("n"))
        .select(
            (F.col("_left") + F.col("_b") * F.col("_d")).alias("bin_left"),
            (F.col("_left") + (F.col("_b") + 1) * F.col("_d")).alias("bin_right"),
            "n",
            (F.col("n") / (F.col("_total") * F.col("_d"))).alias("density"),
        )
    )


def average_histogram(stats: DataFrame, width: float = 0.5) -> DataFrame:
    """Share of entities per bin of mean rating; bins start half a width below the minimum."""
    edges = stats.agg(
        F.struct((F.min("avg_rating") - width / 2).alias("left"), F.count(F.lit(1)).alias("total"))
    ).scalar()
    left, total = edges.getField("left"), edges.getField("total")
    return (
        stats.groupBy(_bin(F.col("avg_rating"), left, F.lit(width)).alias("_b"))
        .agg(F.count(F.lit(1)).alias("n"))
        .select(
            (left + F.col("_b") * width).alias("bin_left"),
            (left + (F.col("_b") + 1) * width).alias("bin_right"),
            "n",
            (F.col("n") / total).alias("fraction"),
        )
    )


def count_histogram(stats: DataFrame) -> DataFrame:
    """Share of entities per number of reviews (unit bins centred on the integers)."""
    total = stats.agg(F.count(F.lit(1))).scalar()
    return (
        stats.groupBy("n_reviews")
        .agg(F.count(F.lit(1)).alias("n"))
        .select(
            (F.col("n_reviews") - 0.5).alias("bin_left"),
            (F.col("n_reviews") + 0.5).alias("bin_right"),
            "n",
            (F.col("n") / total).alias("fraction"),
        )
    )


def date_histogram(reviews: DataFrame, width: int = 100) -> DataFrame:
    """Density of reviews over bins of ``width`` days, the first half a bin before the first day."""
    days = reviews.groupBy("date").agg(F.count(F.lit(1)).alias("n"))
    everything = Window.partitionBy()  # one row per calendar day
    prepared = (
        days.withColumn("_day", day_ordinal(F.col("date")))
        .withColumn("_left", F.min("_day").over(everything) - width / 2)
        .withColumn("_total", F.sum("n").over(everything))
    )
    return (
        prepared.groupBy(_bin(F.col("_day"), F.col("_left"), F.lit(float(width))).alias("_b"), "_left", "_total")
        .agg(F.sum("n").alias("n"))
        .select(
            (F.col("_left") + F.col("_b") * width).alias("bin_left"),
            (F.col("_left") + (F.col("_b") + 1) * width).alias("bin_right"),
            "n",
            (F.col("n") / (F.col("_total") * width)).alias("density"),
        )
    )


def value_histogram(cells: DataFrame, value: str, bins: int) -> DataFrame:
    """Non-zero cells over ``bins`` equal bins from minimum to maximum, the last one closed."""
    cells = cells.where(F.col(value) != 0).select(value)
    span = cells.agg(F.struct(F.min(value).alias("lo"), F.max(value).alias("hi"))).scalar()
    lo, width = span.getField("lo"), (span.getField("hi") - span.getField("lo")) / bins
    position = F.coalesce(F.floor(F.try_divide(F.col(value) - lo, width)), F.lit(0))
    return (
        cells.groupBy(F.least(position, F.lit(bins - 1)).alias("_b"))
        .agg(F.count(F.lit(1)).alias("n"))
        .select(
            F.col("_b").alias("bin"),
            (lo + F.col("_b") * width).alias("bin_left"),
            (lo + (F.col("_b") + 1) * width).alias("bin_right"),
            "n",
        )
    )


# --- time and length --------------------------------------------------------------


def moving_average(daily: DataFrame, window: int = 50) -> DataFrame:
    """Mean over ``window`` consecutive days of the daily mean, full windows only.

    The value is placed ``window // 2`` days after the first day of its window.
    Input has one row per calendar day, so ordering it in one task is cheap.
    """
    before = window // 2
    frame = Window.orderBy("date").rowsBetween(-before, window - before - 1)
    return (
        daily.select(
            "date",
            "avg_rating",
            F.avg("avg_rating").over(frame).alias("smoothed"),
            F.count(F.lit(1)).over(frame).alias("_n"),
        )
        .where(F.col("_n") == window)
        .drop("_n")
    )


def date_ordinals(reviews: DataFrame) -> DataFrame:
    """Distinct days, their ordinal, and the day recovered from it."""
    days = reviews.select("date").distinct()
    return days.select(
        "date",
        day_ordinal(F.col("date")).alias("ordinal"),
        from_ordinal(day_ordinal(F.col("date"))).alias("restored"),
    )


def length_by_rating(reviews: DataFrame, length: Column, ratings: tuple[int, int] = (1, 5)) -> DataFrame:
    """Mean and population deviation of the length for each rating of the scale."""
    stats = (
        reviews.select("rating", length.alias("_len"))
        .groupBy("rating")
        .agg(
            F.avg("_len").alias("avg_words"),
            F.stddev_pop("_len").alias("std_words"),
            F.count(F.lit(1)).alias("n"),
        )
    )
    scale = reviews.sparkSession.range(ratings[0], ratings[1] + 1).select(
        F.col("id").cast("int").alias("rating")
    )
    return scale.join(stats, "rating", "left").withColumn("n", F.coalesce("n", F.lit(0)))


# --- baselines ---------------------------------------------------------------------


def predict_average(train: DataFrame, test: DataFrame) -> DataFrame:
    """The mean training rating as prediction for every test row."""
    return test.withColumn("prediction", train.agg(F.avg("rating")).scalar())


def predict_zero(test: DataFrame) -> DataFrame:
    return test.withColumn("prediction", F.lit(0.0))
