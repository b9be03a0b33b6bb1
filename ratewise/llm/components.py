"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratewise.session import checkpointed


def _star(links: DataFrame, large: bool) -> DataFrame:
    """One half step: every node ties its larger (or smaller) neighbours to the smallest of them."""
    both = links.select("a", "b")
    if large:
        both = both.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    # Without ``large`` the links run from the larger node a to the smaller b.
    least = both.groupBy("a").agg(F.min("b").alias("_least")).select("a", F.least("a", "_least").alias("least"))
    joined = both.join(least, "a")
    if large:
        made = joined.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("least").alias("b"))
    else:
        made = joined.select(F.col("b").alias("a"), F.col("least").alias("b")).unionByName(
            joined.select("a", F.col("least").alias("b"))
        )
    return made.where(F.col("a") > F.col("b")).distinct()


def components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component): the smallest node that each linked node reaches; nodes without links are absent.

    ``links`` has two bigint columns a and b. Alternates the large-star and
    small-star steps (Kiveris et al., 2014) until the links no longer change;
    every round is written to the shared folder. A node of any degree is
    handled by partial minima and a join whose hot key Spark may split.
    """
    ends = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    current = checkpointed(ends.where(F.col("a") > F.col("b")).distinct())
    state = None
    for _ in range(max_rounds):
        mark = current.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b") % (1 << 40)).alias("s")).first()
        if mark.n == 0 or (mark.n, mark.s) == state:
            break
        state = (mark.n, mark.s)
        current = checkpointed(_star(_star(current, True), False))
    else:
        raise RuntimeError("components did not settle")
    roots = current.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return roots.unionByName(current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
