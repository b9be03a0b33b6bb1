"""Review dates and day ordinals."""

from pyspark.sql import Column
from pyspark.sql import functions as F

_DAY_ZERO = "0001-01-01"


def parse_review_date(raw: Column) -> Column:
    """``'3 7, 2005'`` (month day, year; ``;`` and ``,`` ignored) as a date, NULL if it is none."""
    cleaned = F.trim(F.regexp_replace(F.translate(raw, ";,", ""), r"\s+", " "))
    return F.try_to_date(cleaned, "M d yyyy")


def day_ordinal(day: Column) -> Column:
    """Day count with 0001-01-01 as day 1."""
    return F.datediff(day, F.lit(_DAY_ZERO).cast("date")) + 1


def from_ordinal(ordinal: Column) -> Column:
    return F.date_add(F.lit(_DAY_ZERO).cast("date"), (ordinal - 1).cast("int"))
