"""Quality rules whose limits adapt to language and source.

Every text is measured with built-in functions in one projection. The measures
of texts that pass the base rules go into quantile sketches, one per language,
source and measure: counts in fixed bins, at most BINS of them, that merge by
addition (so Spark sums them before the shuffle, and small groups are merged
into their language's). The limits are the outer fences of each sketch, with a
least spread; a join brings them to the documents.

Defined results: a null or empty text has no words and fails the base rule; null
language or source is a group of its own; a group of fewer than ``min_group``
documents uses its language's sketch, and a small language that of all
documents; rows that repeat count each time; an empty table gives no rows. Only
built-in functions are used.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratewise.session import checkpointed

SPACES = " \t\n\u000b\f\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 8
BINS = 400
#: measure: width of a bin, least spread of its fences in bins, and whether low values fail too.
MEASURES = {
    "symbol_share": (25, 16, False),  # symbols per 10,000 characters of words
    "dup_line_share": (25, 140, False),  # repeated lines per 10,000 lines with words
    "repeat_share": (25, 100, False),  # repeated words per 10,000 words
    "word_length": (5, 30, True),  # characters per 100 words
}


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once per row."""
    return F.transform(F.array(value), body)[0]


def _repeated_words(words: Column) -> Column:
    """Number of words inside windows that occur twice or more."""

    def grams_of(w: Column) -> Column:
        gram = lambda i: F.xxhash64(*[F.get(w, i + j) for j in range(WINDOW)])
        return F.when(
            F.size(w) >= WINDOW, F.transform(F.sequence(F.lit(0), F.size(w) - WINDOW), gram)
        ).otherwise(F.array().cast("array<bigint>"))

    def covered(grams: Column) -> Column:
        order = F.sort_array(F.transform(grams, lambda g, i: F.struct(g.alias("g"), i.alias("i"))))

        def places(s: Column) -> Column:
            same = lambda x, j: F.coalesce(F.get(s, j)["g"] == x["g"], F.lit(False))
            return F.sort_array(
                F.transform(F.filter(s, lambda x, j: same(x, j - 1) | same(x, j + 1)), lambda x: x["i"])
            )

        def width(p: Column) -> Column:
            return F.aggregate(
                F.transform(p, lambda x, j: F.least(F.lit(WINDOW), F.coalesce(F.get(p, j + 1) - x, F.lit(WINDOW)))),
                F.lit(0),
                lambda a, b: a + b,
            )

        return let(let(order, places), width)

    def counted(grams: Column) -> Column:
        # Most texts repeat no window: their distinct windows are as many as all.
        return F.when(F.size(F.array_distinct(grams)) < F.size(grams), covered(grams)).otherwise(F.lit(0))

    return let(let(words, grams_of), counted)


def measured(docs: DataFrame, *keep: str) -> DataFrame:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and n_lines (with a word) of every whole text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    words = F.array_remove(F.split(F.translate(text, SPACES[1:], " " * (len(SPACES) - 1)), " "), "")
    lines = F.filter(F.split(text, "\n"), lambda x: F.length(F.translate(x, SPACES, "")) > 0)
    numbers = let(words, lambda w: F.struct(F.size(w).alias("n"), _repeated_words(w).alias("r")))
    line_numbers = let(lines, lambda x: F.struct(F.size(x).alias("n"), (F.size(x) - F.size(F.array_distinct(x))).alias("d")))
    kept = [c for c in keep if c != "text"]
    made = docs.select(
        *kept,
        numbers.alias("_w"),
        line_numbers.alias("_l"),
        F.length(F.translate(text, SPACES, "")).alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).alias("n_symbols"),
    )
    return made.select(
        *kept,
        F.col("_w.n").cast("long").alias("n_words"),
        F.col("word_chars").cast("long"),
        F.col("n_symbols").cast("long"),
        F.col("_l.d").cast("long").alias("n_dup_lines"),
        F.col("_w.r").cast("long").alias("n_repeat_words"),
        F.col("_l.n").cast("long").alias("n_lines"),
    )


def base_failed(min_words: int = 20, max_repeat_percent: int = 30) -> Column:
    return (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words"))


def _share(part: str, whole: str, scale: int) -> Column:
    return F.floor(F.lit(scale) * F.col(part) / F.greatest(F.col(whole), F.lit(1))).cast("long")


def _binned() -> dict[str, Column]:
    values = {
        "symbol_share": _share("n_symbols", "word_chars", 10_000),
        "dup_line_share": _share("n_dup_lines", "n_lines", 10_000),
        "repeat_share": _share("n_repeat_words", "n_words", 10_000),
        "word_length": _share("word_chars", "n_words", 100),
    }
    return {name: F.least(F.floor(v / MEASURES[name][0]), F.lit(BINS - 1)).cast("int") for name, v in values.items()}


def sketches(rows: DataFrame) -> DataFrame:
    """(lang, source, measure, bin, n): one sketch per group and measure."""
    measures = F.explode(F.array(*[F.struct(F.lit(name).alias("measure"), bin_.alias("bin")) for name, bin_ in _binned().items()]))
    return rows.select("lang", "source", measures.alias("_m")).groupBy("lang", "source", "_m.measure", "_m.bin").agg(
        F.count(F.lit(1)).alias("n")
    )


def _quartiles(sketch: DataFrame, *group: str) -> DataFrame:
    """Bins of the quartiles and the number of rows of each group's sketch."""
    merged = sketch.groupBy(*group, "measure", "bin").agg(F.sum("n").alias("n"))
    upto = Window.partitionBy(*group, "measure").orderBy("bin")
    whole = Window.partitionBy(*group, "measure")
    ranked = merged.select(*group, "measure", "bin", F.sum("n").over(upto).alias("upto"), F.sum("n").over(whole).alias("total"))
    return ranked.groupBy(*group, "measure").agg(
        F.max("total").alias("total"),
        F.min(F.when(4 * F.col("upto") >= F.col("total"), F.col("bin"))).alias("q1"),
        F.min(F.when(4 * F.col("upto") >= 3 * F.col("total"), F.col("bin"))).alias("q3"),
    )


def limits(sketch: DataFrame, min_group: int = 50, fences: int = 3) -> DataFrame:
    """(lang, source, and for each measure its least and greatest bin that pass)."""
    by_source = _quartiles(sketch, "lang", "source")
    by_lang = _quartiles(sketch, "lang").select(
        F.col("lang").alias("_lang"), F.col("measure").alias("_m1"), F.col("total").alias("_t1"), F.col("q1").alias("_a1"), F.col("q3").alias("_b1")
    )
    overall = _quartiles(sketch).select(F.col("measure").alias("_m2"), F.col("q1").alias("_a2"), F.col("q3").alias("_b2"))
    joined = by_source.join(by_lang, F.col("lang").eqNullSafe(F.col("_lang")) & (F.col("measure") == F.col("_m1"))).join(
        F.broadcast(overall), F.col("measure") == F.col("_m2")  # one row per measure
    )
    own, language = F.col("total") >= min_group, F.col("_t1") >= min_group
    pick = lambda a, b, c: F.when(own, F.col(a)).when(language, F.col(b)).otherwise(F.col(c))
    q1, q3 = pick("q1", "_a1", "_a2"), pick("q3", "_b1", "_b2")
    spread = F.create_map(*[F.lit(x) for name, (_, least, _) in MEASURES.items() for x in (name, least)])[F.col("measure")]
    reach = F.greatest(fences * (q3 - q1), spread)
    rows = joined.select("lang", "source", "measure", (q1 - reach).alias("low"), (q3 + reach).alias("high"))
    columns = []
    for name, (_, _, low_fails) in MEASURES.items():
        mine = F.col("measure") == name
        columns.append(F.max(F.when(mine, F.col("high"))).alias(f"{name}_high"))
        if low_fails:
            columns.append(F.max(F.when(mine, F.col("low"))).alias(f"{name}_low"))
    return rows.groupBy("lang", "source").agg(*columns)


def _small(table: DataFrame, rows: int = 100_000) -> bool:
    size = table.agg(F.count(F.lit(1)).alias("n"), F.max(F.octet_length(F.concat_ws("", "lang", "source"))).alias("w")).first()
    return size.n * ((size.w or 0) + 100) <= rows * 200


def assess(docs: DataFrame, min_group: int = 50, fences: int = 3, min_words: int = 20, max_repeat_percent: int = 30) -> DataFrame:
    """One row per document: doc_id, lang, source, the measured numbers, base_failed and kept."""
    rows = measured(docs, "doc_id", "lang", "source").withColumn("base_failed", base_failed(min_words, max_repeat_percent))
    rows = checkpointed(rows)
    table = checkpointed(limits(checkpointed(sketches(rows.where(~F.col("base_failed")))), min_group, fences))
    table = table.withColumnRenamed("lang", "_lang").withColumnRenamed("source", "_source")
    small = _small(table.select(F.col("_lang").alias("lang"), F.col("_source").alias("source")))
    joined = rows.join(
        F.broadcast(table) if small else table,
        F.col("lang").eqNullSafe(F.col("_lang")) & F.col("source").eqNullSafe(F.col("_source")),
        "left",
    )
    passed = ~F.col("base_failed")
    for name, bin_ in _binned().items():
        passed &= bin_ <= F.col(f"{name}_high")
        if MEASURES[name][2]:
            passed &= bin_ >= F.col(f"{name}_low")
    return joined.withColumn("kept", F.coalesce(passed, F.lit(False))).select(*rows.columns, "kept")
