"""Tagged review files as typed rows.

A training file holds any number of 7-line reviews with one separator line
between them; it is read as splittable text cut at line-initial ``<Author>``,
so a file of any size spreads over many tasks. A test file holds one review.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ratewise.functions.dates import parse_review_date
from ratewise.operators.evaluation import id_contiguity
from ratewise.operators.joins import fits_broadcast
from ratewise.schema import REVIEW
from ratewise.session import checkpointed

# The tags, in line order.
TAGS = ("<Author>", "<Product>", "<Date>", "<Summary>", "<Content>", "<Helpful>", "<Rating>")
TRAIN_LINES = 7
TEST_LINES = 5

FAILFAST = "FAILFAST"
PERMISSIVE = "PERMISSIVE"


class ReviewFormatError(ValueError):
    """A file does not follow the review format."""


def _tagged(line: Column, tag: str) -> Column:
    """Text after the tag; outer whitespace of the line is dropped, blanks after the tag stay."""
    stripped = F.btrim(line, F.lit(" \t\n\r\f\v"))
    return F.when(line.startswith(tag), F.substr(stripped, F.lit(len(tag) + 1)))


def _integer(text: Column) -> Column:
    return F.when(text.rlike(r"^\s*[+-]?\d+\s*$"), F.trim(text).try_cast("int"))


def _first_problem(*checks: tuple[Column, str]) -> Column:
    return F.coalesce(*[F.when(bad, F.lit(message)) for bad, message in checks])


def _barrier(df: DataFrame, *keep: str, **columns: Column) -> DataFrame:
    """``columns`` computed once per row: a generator is not merged with the projections around it."""
    made = F.inline(F.array(F.struct(*[c.alias(name) for name, c in columns.items()])))
    return df.select(*keep, made)


def _parse_lines(df: DataFrame, n_lines: int, keep: tuple[str, ...], *extra_checks: tuple[Column, str]) -> DataFrame:
    """Fields from array column ``_lines``; the first violated rule goes to ``_problem``."""
    names = ("author", "product", "date_raw", "summary", "content", "_helpful", "_rating")[:n_lines]
    lines = {name: _tagged(F.get("_lines", F.lit(i)), tag) for i, (name, tag) in enumerate(zip(names, TAGS))}
    df = _barrier(df, *keep, **lines, _extra=_first_problem(*extra_checks))
    checks = [(F.col("_extra").isNotNull(), F.col("_extra"))]
    checks += [(F.col(name).isNull(), F.lit(f"line must start with {tag}")) for name, tag in zip(names, TAGS)]
    if n_lines == TRAIN_LINES:
        parts = F.split("_helpful", "/")
        df = _barrier(
            df,
            *keep,
            *names,
            "_extra",
            _n_parts=F.size(parts),
            _positive=_integer(F.get(parts, F.lit(0))),
            _total=_integer(F.get(parts, F.lit(1))),
            rating=_integer(F.col("_rating")),
        )
        positive, total = F.col("_positive"), F.col("_total")
        df = df.withColumn("helpful", F.struct(positive.alias("positive"), total.alias("total")))
        checks += [
            (F.col("_n_parts") != 2, F.lit("helpful must be two numbers with one slash")),
            (positive.isNull() | total.isNull(), F.lit("helpful must be two integers")),
            (positive > total, F.lit("helpful: more positive votes than votes")),
            (F.col("rating").isNull(), F.lit("rating must be an integer")),
        ]
    else:
        df = df.withColumn("helpful", F.lit(None).cast(REVIEW["helpful"].dataType))
        df = df.withColumn("rating", F.lit(None).cast("int"))
    problem = F.coalesce(*[F.when(bad, message) for bad, message in checks])
    return df.withColumn("date", parse_review_date(F.col("date_raw"))).withColumn("_problem", problem)


def _finish(df: DataFrame, split: str, mode: str, raw: str) -> DataFrame:
    df = df.withColumn("split", F.lit(split))
    if mode == FAILFAST:
        # As a filter the check also runs when no column of the row is read.
        message = F.concat(F.lit("bad review: "), "_problem")
        valid = F.when(F.col("_problem").isNull(), True).otherwise(F.raise_error(message).cast("boolean"))
        return df.where(valid).select(*REVIEW.fieldNames())
    if mode == PERMISSIVE:
        corrupt = F.when(F.col("_problem").isNotNull(), F.col(raw))
        return df.withColumn("_corrupt_record", corrupt).select(
            *REVIEW.fieldNames(), "_corrupt_record", F.col("_problem").alias("_corrupt_reason")
        )
    raise ValueError(f"mode must be {FAILFAST} or {PERMISSIVE}")


def parse_train_blocks(blocks: DataFrame, mode: str = FAILFAST) -> DataFrame:
    """Reviews from (``id``, ``first``, ``value``).

    ``value`` is the text from one line-initial ``<Author>`` to the next. The
    first block of a file still has its tag, all others lost it to the split.
    """
    text = F.when(F.col("first"), F.col("value")).otherwise(F.concat(F.lit(TAGS[0]), "value"))
    blocks = blocks.withColumn("_lines", F.split(text, "\n"))
    parsed = _parse_lines(
        blocks,
        TRAIN_LINES,
        ("id", "value"),
        (~F.size("_lines").isin(TRAIN_LINES, TRAIN_LINES + 1), "a review has 7 lines and one separator"),
    )
    return _finish(parsed, "train", mode, "value")


def _train_blocks(spark: SparkSession, folder: str) -> DataFrame:
    return (
        spark.read.option("pathGlobFilter", "*.txt")
        .text(folder, lineSep="\n" + TAGS[0])
        .select(
            "value",
            F.col("_metadata.file_path").alias("_path"),
            F.col("_metadata.file_block_start").alias("_start"),
            F.monotonically_increasing_id().alias("_row"),
        )
    )


def check_train_files(spark: SparkSession, folder: str) -> None:
    """Raise unless every file is blocks with a separator in between and none at its end.

    That is: only the last block of a file lacks the separator line. One pass
    with partial aggregation per file; an empty file is an error as well.
    """
    # Seven lines without a newline after them may only end the file; a last
    # block with an eighth line is fine when that is the empty rest after a
    # final newline.
    lines = F.split("value", "\n")
    blocks = _train_blocks(spark, folder)
    per_file = (
        blocks.groupBy("_path")
        .agg(
            F.count_if(F.size(lines) == TRAIN_LINES).alias("open"),
            F.max_by(
                F.struct(
                    F.size(lines).alias("n"),
                    (F.element_at(lines, -1) == "").alias("closed"),
                ),
                F.struct("_start", "_row"),
            ).alias("last"),
        )
        .select(
            "_path",
            F.when(F.col("last.n") == TRAIN_LINES, F.col("open") != 1)
            .otherwise(
                (F.col("open") != 0) | (F.col("last.n") != TRAIN_LINES + 1) | ~F.col("last.closed")
            )
            .alias("bad"),
        )
    )
    found = per_file.agg(
        F.count(F.lit(1)).alias("n"), F.min(F.when(F.col("bad"), F.col("_path"))).alias("path")
    ).first()
    if found.path is not None:
        raise ReviewFormatError(f"misplaced separator in review file {found.path}")
    listed = len(blocks.inputFiles())
    if listed != found.n:
        raise ReviewFormatError(f"{listed - found.n} of {listed} review files are empty")


def _block_positions(blocks: DataFrame) -> DataFrame:
    """(_path, _start, _first_row, _before): rows before each split of each file, in file order.

    One row per split of a file; the window sees nothing else.
    """
    per_split = blocks.groupBy("_path", "_start").agg(F.min("_row").alias("_first_row"), F.count(F.lit(1)).alias("_n"))
    earlier = Window.orderBy("_path", "_start").rowsBetween(Window.unboundedPreceding, -1)
    return per_split.select("_path", "_start", "_first_row", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))


def load_train(
    spark: SparkSession, folder: str, mode: str = FAILFAST, check_files: bool = True
) -> DataFrame:
    """All reviews of the ``*.txt`` files in a folder.

    ``id`` is -1, -2, ... in the order of file path and position in the file,
    however the files are split; being negative it never meets the id of a test
    review. The rows before each split are counted in a first pass over the
    same splits; a later pass that finds other splits stops with an error.
    """
    if mode == FAILFAST and check_files:
        check_train_files(spark, folder)
    blocks = _train_blocks(spark, folder)
    positions = checkpointed(_block_positions(blocks))
    if fits_broadcast(positions, "_path"):
        positions = F.broadcast(positions)
    joined = blocks.join(positions, ["_path", "_start"], "left")
    known = F.col("_before").isNotNull() & (F.col("_row") >= F.col("_first_row"))
    nth = F.when(known, F.col("_before") + F.col("_row") - F.col("_first_row") + 1).otherwise(
        F.raise_error(F.lit("the review files are split differently than when they were counted")).cast("bigint")
    )
    first = (F.col("_start") == 0) & (F.col("_row") == F.col("_first_row"))
    return parse_train_blocks(joined.select((-nth).alias("id"), first.alias("first"), "value"), mode)


def parse_test_files(files: DataFrame, mode: str = FAILFAST) -> DataFrame:
    """Reviews from (``value``: whole file, ``name``: base name with the id in it)."""
    runs = F.regexp_extract_all("name", F.lit(r"\d+"), F.lit(0))
    lines = F.split(F.regexp_replace("value", r"\n\z", ""), "\n")
    prepared = (
        files.withColumn("_runs", runs)
        .withColumn("id", F.get("_runs", F.lit(0)).try_cast("bigint"))
        .withColumn("_lines", lines)
    )
    parsed = _parse_lines(
        prepared,
        TEST_LINES,
        ("id", "value"),
        (F.size("_runs") != 1, "file name must hold exactly one number"),
        (F.size("_lines") != TEST_LINES, "a test review has 5 lines"),
    )
    return _finish(parsed, "test", mode, "value")


def load_test(
    spark: SparkSession, folder: str, mode: str = FAILFAST, check_ids: bool = True
) -> DataFrame:
    """One review per ``*.txt`` file; ids must be 1..n over all files."""
    files = (
        spark.read.option("pathGlobFilter", "*.txt")
        .text(folder, wholetext=True)
        .select("value", F.col("_metadata.file_name").alias("name"))
    )
    reviews = parse_test_files(files, mode)
    if mode == FAILFAST and check_ids:
        summary = id_contiguity(reviews).first()
        if not summary.contiguous:
            raise ReviewFormatError(f"test ids are not 1..{summary.n}")
    return reviews
