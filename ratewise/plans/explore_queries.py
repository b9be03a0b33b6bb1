"""Exploratory queries over the driver's tables, each with its SQL twin."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratewise.functions.dates import parse_review_date
from ratewise.functions.numeric import seeded_fraction
from ratewise.functions.text import word_count
from ratewise.operators import distributions as D
from ratewise.operators import evaluation as E
from ratewise.plans.registration import registrar
from ratewise.sources.bindings import review_facts, review_text, table

FACTS_SQL = """
facts AS (
  SELECT CAST(o_custkey AS VARCHAR) AS author, CAST(l_partkey AS VARCHAR) AS product,
         CAST(o_orderdate AS DATE) AS date, CAST(ceil(l_quantity / 10) AS INTEGER) AS rating
  FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey)"""

TEXT_SQL = """
reviews AS (
  SELECT doc_id AS id, 'u' || CAST(doc_id % 97 AS VARCHAR) AS author, source AS product,
         text AS content, lang, CAST(1 + doc_id % 5 AS INTEGER) AS rating
  FROM documents)"""

# Same split as operators.evaluation.holdout, for seed 659 and 5 per cent.
SPLIT_SQL = """
split AS (
  SELECT *, CAST('0x' || substr(md5(CAST(id AS VARCHAR) || ':659'), 1, 8) AS BIGINT) / 4294967296.0 < 0.05
            AS is_test
  FROM reviews)"""


def _rounded(df: DataFrame, *names: str, digits: int = 6) -> DataFrame:
    # + 0.0 turns -0.0 into 0.0
    return df.withColumns({n: F.round(F.col(n), digits) + F.lit(0.0) for n in names})


def _stats(key: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return D.rating_stats(review_facts(spark, sf_dir, (key, "rating")), key)

    return run


def _stats_sql(key: str) -> str:
    return f"stats AS (SELECT {key}, avg(rating) AS avg_rating, count(*) AS n_reviews FROM facts GROUP BY {key})"


def _facts(spark, sf_dir, *columns):
    return review_facts(spark, sf_dir, columns)


QUERIES, ORACLE, register = registrar()


for _key in ("product", "author"):
    register(
        f"{_key}_stats",
        f"WITH {FACTS_SQL}, {_stats_sql(_key)} SELECT {_key}, round(avg_rating, 6) AS avg_rating, n_reviews FROM stats",
    )(lambda s, d, k=_key: _rounded(_stats(k)(s, d), "avg_rating"))

    register(
        f"{_key}_rating_corr",
        f"WITH {FACTS_SQL}, {_stats_sql(_key)} SELECT round(abs(corr(avg_rating, n_reviews)), 6) AS abs_corr FROM stats",
    )(lambda s, d, k=_key: _rounded(D.popularity_correlation(_stats(k)(s, d)), "abs_corr"))

    register(
        f"{_key}_avg_histogram",
        f"""WITH {FACTS_SQL}, {_stats_sql(_key)},
        e AS (SELECT min(avg_rating) - 0.25 AS l, count(*) AS total FROM stats),
        b AS (SELECT floor((avg_rating - l) / 0.5) AS b, l, total, count(*) AS n FROM stats, e GROUP BY ALL)
        SELECT round(l + b * 0.5, 6) AS bin_left, round(l + (b + 1) * 0.5, 6) AS bin_right, n,
               round(n / total, 6) AS fraction FROM b""",
    )(lambda s, d, k=_key: _rounded(D.average_histogram(_stats(k)(s, d)), "bin_left", "bin_right", "fraction"))

    register(
        f"{_key}_count_histogram",
        f"""WITH {FACTS_SQL}, {_stats_sql(_key)}
        SELECT CAST(n_reviews - 0.5 AS DOUBLE) AS bin_left, CAST(n_reviews + 0.5 AS DOUBLE) AS bin_right,
               count(*) AS n, round(count(*) / (SELECT count(*) FROM stats), 6) AS fraction
        FROM stats GROUP BY n_reviews""",
    )(lambda s, d, k=_key: _rounded(D.count_histogram(_stats(k)(s, d)).withColumns(
        {c: F.col(c).cast("double") for c in ("bin_left", "bin_right")}), "fraction"))

    register(
        f"{_key}_rank_curve",
        f"""WITH {FACTS_SQL}, {_stats_sql(_key)}
        SELECT {_key}, round(avg_rating, 6) AS avg_rating,
               row_number() OVER (ORDER BY avg_rating, {_key}) AS position FROM stats""",
    )(lambda s, d, k=_key: _rounded(D.rank_curve(_stats(k)(s, d), k), "avg_rating"))


@register("daily_stats", f"WITH {FACTS_SQL}, {_stats_sql('date')} SELECT date, round(avg_rating, 6) AS avg_rating, n_reviews FROM stats")
def daily_stats(spark, sf_dir):
    return _rounded(D.daily_stats(_facts(spark, sf_dir, "date", "rating")), "avg_rating")


@register(
    "vector_norm",
    f"""WITH {FACTS_SQL}, {_stats_sql('product')}
    SELECT round(sqrt(sum(avg_rating * avg_rating)), 6) AS norm_avg_rating,
           round(sqrt(sum(CAST(n_reviews AS DOUBLE) * n_reviews)), 6) AS norm_n_reviews FROM stats""",
)
def vector_norm(spark, sf_dir):
    return _rounded(D.vector_norms(_stats("product")(spark, sf_dir)), "norm_avg_rating", "norm_n_reviews")


@register(
    "length_rating_corr",
    f"""WITH {TEXT_SQL} SELECT round(abs(corr(rating, len(regexp_extract_all(content, '\\S+')))), 6) AS abs_corr
    FROM reviews""",
)
def length_rating_corr(spark, sf_dir):
    return _rounded(D.length_correlation(review_text(spark, sf_dir), word_count(F.col("content"))), "abs_corr")


@register(
    "rating_histogram",
    f"""WITH {FACTS_SQL}, c AS (SELECT rating, count(*) AS n FROM facts GROUP BY rating),
    g AS (SELECT *, rating - lag(rating) OVER (ORDER BY rating) AS gap FROM c),
    e AS (SELECT CAST(coalesce(min(gap), 1) AS DOUBLE) AS d, min(rating) AS lo, sum(n) AS total FROM g),
    b AS (SELECT floor((rating - (lo - d / 2)) / d) AS b, d, lo - d / 2 AS l, total, sum(n) AS n FROM c, e GROUP BY ALL)
    SELECT l + b * d AS bin_left, l + (b + 1) * d AS bin_right, CAST(n AS BIGINT) AS n,
           round(n / (total * d), 6) AS density FROM b""",
)
def rating_histogram(spark, sf_dir):
    return _rounded(D.rating_histogram(_facts(spark, sf_dir, "rating")), "density")


@register(
    "date_histogram",
    f"""WITH {FACTS_SQL}, c AS (SELECT date_diff('day', DATE '0001-01-01', date) + 1 AS day, count(*) AS n FROM facts GROUP BY 1),
    e AS (SELECT min(day) - 50.0 AS l, sum(n) AS total FROM c),
    b AS (SELECT floor((day - l) / 100.0) AS b, l, total, sum(n) AS n FROM c, e GROUP BY ALL)
    SELECT CAST(l + b * 100 AS DOUBLE) AS bin_left, CAST(l + (b + 1) * 100 AS DOUBLE) AS bin_right,
           CAST(n AS BIGINT) AS n, round(n / (total * 100), 6) AS density FROM b""",
)
def date_histogram(spark, sf_dir):
    return _rounded(D.date_histogram(_facts(spark, sf_dir, "date")), "density")


def _ecdf_sql(source: str, column: str) -> str:
    return f"""{source}, p AS (
      SELECT {column} AS value, row_number() OVER (ORDER BY {column}) - 1 AS i, count(*) OVER () AS total FROM v)
    SELECT value, count(*) AS n, round(min(i) / any_value(total), 6) AS ecdf_first,
           round(max(i) / any_value(total), 6) AS ecdf_last FROM p GROUP BY value"""


@register("rating_ecdf", _ecdf_sql(f"WITH {FACTS_SQL}, v AS (SELECT rating FROM facts)", "rating"))
def rating_ecdf(spark, sf_dir):
    return _rounded(D.ecdf(_facts(spark, sf_dir, "rating"), "rating", True), "ecdf_first", "ecdf_last")


@register("date_ecdf", _ecdf_sql(f"WITH {FACTS_SQL}, v AS (SELECT date FROM facts)", "date"))
def date_ecdf(spark, sf_dir):
    return _rounded(D.ecdf(_facts(spark, sf_dir, "date"), "date", True), "ecdf_first", "ecdf_last")


@register(
    "length_ecdf",
    _ecdf_sql(
        f"WITH {TEXT_SQL}, v AS (SELECT CAST(len(regexp_extract_all(content, '\\S+')) AS INTEGER) AS n_words FROM reviews)",
        "n_words",
    ),
)
def length_ecdf(spark, sf_dir):
    lengths = review_text(spark, sf_dir).select(word_count(F.col("content")).alias("n_words"))
    return _rounded(D.ecdf(lengths, "n_words"), "ecdf_first", "ecdf_last")


@register(
    "date_moving_average",
    f"""WITH {FACTS_SQL}, {_stats_sql('date')},
    w AS (SELECT date, avg_rating,
                 avg(avg_rating) OVER (ORDER BY date ROWS BETWEEN 25 PRECEDING AND 24 FOLLOWING) AS smoothed,
                 count(*) OVER (ORDER BY date ROWS BETWEEN 25 PRECEDING AND 24 FOLLOWING) AS n FROM stats)
    SELECT date, round(avg_rating, 6) AS avg_rating, round(smoothed, 6) AS smoothed FROM w WHERE n = 50""",
)
def date_moving_average(spark, sf_dir):
    daily = D.rating_stats(_facts(spark, sf_dir, "date", "rating"), "date")
    return _rounded(D.moving_average(daily), "avg_rating", "smoothed")


@register(
    "min_gap",
    f"""WITH {FACTS_SQL}, v AS (SELECT DISTINCT rating FROM facts),
    g AS (SELECT rating - lag(rating) OVER (ORDER BY rating) AS gap FROM v)
    SELECT CAST(coalesce(min(gap), 1) AS DOUBLE) AS min_gap FROM g""",
)
def min_gap(spark, sf_dir):
    return D.min_gap(_facts(spark, sf_dir, "rating"), "rating")


@register("distinct_classes", f"WITH {FACTS_SQL} SELECT DISTINCT rating FROM facts")
def distinct_classes(spark, sf_dir):
    return D.distinct_values(_facts(spark, sf_dir, "rating"), "rating")


@register("rating_centred", f"WITH {FACTS_SQL} SELECT product, rating - 3 AS centred, count(*) AS n FROM facts GROUP BY ALL")
def rating_centred(spark, sf_dir):
    facts = _facts(spark, sf_dir, "product", "rating")
    return facts.groupBy("product", (F.col("rating") - 3).alias("centred")).agg(F.count(F.lit(1)).alias("n"))


@register(
    "length_by_rating",
    f"""WITH {TEXT_SQL}, s AS (
      SELECT rating, avg(len(regexp_extract_all(content, '\\S+'))) AS a,
             stddev_pop(len(regexp_extract_all(content, '\\S+'))) AS s, count(*) AS n FROM reviews GROUP BY rating)
    SELECT CAST(r AS INTEGER) AS rating, round(a, 6) AS avg_words, round(s, 6) AS std_words, coalesce(n, 0) AS n
    FROM range(1, 6) t(r) LEFT JOIN s ON r = rating""",
)
def length_by_rating(spark, sf_dir):
    result = D.length_by_rating(review_text(spark, sf_dir), word_count(F.col("content")))
    return _rounded(result, "avg_words", "std_words")


@register("word_count", f"WITH {TEXT_SQL} SELECT id, CAST(len(regexp_extract_all(content, '\\S+')) AS INTEGER) AS n_words FROM reviews")
def word_count_query(spark, sf_dir):
    return review_text(spark, sf_dir).select("id", word_count(F.col("content")).alias("n_words"))


@register(
    "date_parse",
    """SELECT CAST(o_orderdate AS DATE) AS date, count(*) AS n FROM orders GROUP BY 1""",
)
def date_parse(spark, sf_dir):
    """Order dates rendered as 'month day, year;' and parsed back."""
    day = F.col("o_orderdate").cast("date")
    raw = F.concat_ws(" ", F.month(day), F.concat(F.dayofmonth(day), F.lit(",")), F.concat(F.lit(" "), F.year(day), F.lit(";")))
    return (
        table(spark, sf_dir, "orders")
        .select(parse_review_date(raw).alias("date"))
        .groupBy("date")
        .agg(F.count(F.lit(1)).alias("n"))
    )


@register(
    "day_ordinal",
    f"""WITH {FACTS_SQL} SELECT DISTINCT date, CAST(date_diff('day', DATE '0001-01-01', date) + 1 AS INTEGER) AS ordinal,
    date AS restored FROM facts""",
)
def day_ordinal_query(spark, sf_dir):
    return D.date_ordinals(_facts(spark, sf_dir, "date"))


@register(
    "baseline_average",
    f"""WITH {TEXT_SQL}, {SPLIT_SQL} SELECT id, round((SELECT avg(rating) FROM split WHERE NOT is_test), 6) AS prediction
    FROM split WHERE is_test""",
)
def baseline_average(spark, sf_dir):
    train, test = E.holdout(review_text(spark, sf_dir).select("id", "rating"))
    return _rounded(D.predict_average(train, test.select("id")), "prediction")


@register("baseline_zero", f"WITH {TEXT_SQL}, {SPLIT_SQL} SELECT id, CAST(0 AS DOUBLE) AS prediction FROM split WHERE is_test")
def baseline_zero(spark, sf_dir):
    _, test = E.holdout(review_text(spark, sf_dir).select("id", "rating"))
    return D.predict_zero(test.select("id"))


@register("holdout_split", f"WITH {TEXT_SQL}, {SPLIT_SQL} SELECT id, rating, is_test FROM split")
def holdout_split(spark, sf_dir):
    docs = review_text(spark, sf_dir).select("id", "rating")
    return docs.withColumn("is_test", seeded_fraction(F.col("id"), 659) < 0.05)
