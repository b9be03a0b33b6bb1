"""Shards of near equal bytes by a k-d tree over document metadata.

Documents are points: rank of source, rank of language, log size and doc_id,
each scaled to 30 bits, with a hash of the text below them to part equal values.
A node that holds m shards is split along its widest dimension where the bytes
on its left come nearest to (m // 2) / m of the node's. That weighted median is
found by histograms: Spark sums the bytes of BINS bins per node, and the bin
that holds the cut is cut into BINS again until it weighs next to nothing. All
nodes of a level share one job; the driver holds the tree and one histogram per
node. Points of equal texts are equal, so equal texts stay in one shard; only if
they outweigh a shard are they parted, by doc_id.

Defined results: a null text has no bytes and counts as an empty one; null
source, language or doc_id come first in their dimension; repeated rows are
rows of their own; an empty table gives no rows; fewer documents than shards
leave shards empty. Only built-in functions are used.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratewise.session import checkpointed

OVERHEAD = 8
BINS = 4096
CELL_ROWS = 4096
_VALUE_BITS, _TIE_BITS = 30, 32
DIMENSIONS = ("source_point", "lang_point", "size_point", "id_point")


@dataclass
class Node:
    """Shards first..first+count-1; split below ``cut`` along ``dimension``."""

    first: int
    count: int
    dimension: str | None = None
    cut: int = 0
    left: Node | None = None
    right: Node | None = None

    def place(self, at) -> Column:
        """Column that follows the tree; ``at`` maps a leaf to a value."""
        if self.left is None:
            return F.lit(at(self))
        return F.when(F.col(self.dimension) < self.cut, self.left.place(at)).otherwise(self.right.place(at))

    def leaves(self) -> list[Node]:
        return [self] if self.left is None else self.left.leaves() + self.right.leaves()


def narrow(docs: DataFrame) -> DataFrame:
    """(doc_id, lang, source, size, text_crc32, text_key) of every document."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(
        "doc_id",
        "lang",
        "source",
        (F.octet_length(text) + OVERHEAD).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.md5(text).alias("text_key"),
    )


def _scaled(value: Column, least: float, most: float) -> Column:
    share = (value.cast("double") - F.lit(float(least))) / F.lit(float(most - least) or 1.0)
    return F.floor(F.coalesce(share, F.lit(0.0)) * ((1 << _VALUE_BITS) - 1)).cast("long")


def _ranks(groups: DataFrame, name: str) -> DataFrame:
    """Rank of each distinct value; one row per source or language."""
    values = groups.select(F.col(name).alias(f"_{name}")).distinct()
    return values.withColumn(f"{name}_rank", F.row_number().over(Window.orderBy(F.col(f"_{name}").asc_nulls_first())))


def points(rows: DataFrame, leaf_bytes: float) -> DataFrame:
    """Add the coordinates of each document's text to ``rows`` of ``narrow``."""
    groups = rows.groupBy("text_key").agg(
        F.sum("size").alias("_bytes"),
        F.max("size").alias("_size"),
        F.min("source").alias("_group_source"),
        F.min("lang").alias("_group_lang"),
        F.min("doc_id").alias("_id"),
    )
    groups = groups.withColumnsRenamed({"_group_source": "source", "_group_lang": "lang"})
    sources, langs = checkpointed(_ranks(rows, "source")), checkpointed(_ranks(rows, "lang"))
    extent = rows.agg(
        F.min("doc_id").alias("id0"), F.max("doc_id").alias("id1"), F.min("size").alias("s0"), F.max("size").alias("s1")
    ).first()
    n_sources, n_langs = sources.count(), langs.count()
    ranked = groups.join(sources, F.col("source").eqNullSafe(F.col("_source"))).join(langs, F.col("lang").eqNullSafe(F.col("_lang")))
    values = (
        _scaled(F.col("source_rank"), 1, max(1, n_sources)),
        _scaled(F.col("lang_rank"), 1, max(1, n_langs)),
        _scaled(F.log2("_size"), math.log2(extent.s0 or 1), math.log2(extent.s1 or 1)),
        _scaled(F.col("_id"), extent.id0 or 0, extent.id1 or 0),
    )
    placed = ranked.select(
        "text_key", (F.col("_bytes") > leaf_bytes).alias("_split"), *[v.alias(d) for v, d in zip(values, DIMENSIONS)]
    )
    joined = rows.join(placed, "text_key")
    own = F.xxhash64("text_key", "doc_id")
    tie = F.when(F.col("_split"), own).otherwise(F.xxhash64("text_key")).bitwiseAND((1 << _TIE_BITS) - 1)
    shifted = [(F.shiftleft(d, _TIE_BITS) + tie).alias(d) for d in DIMENSIONS]
    return joined.select("doc_id", "size", "text_crc32", "text_key", *shifted)


def _widest(rows: DataFrame, root: Node, active: list[Node]) -> dict[int, tuple[str, int, int]]:
    """Dimension of the largest extent of each active node, with its least and greatest coordinate."""
    found = (
        rows.groupBy(root.place(lambda n: n.first).alias("node"))
        .agg(*[f(d).alias(f"{d}_{k}") for d in DIMENSIONS for k, f in (("lo", F.min), ("hi", F.max))])
        .collect()
    )
    out = {}
    for r in found:
        extent = {d: (r[f"{d}_hi"] >> _TIE_BITS) - (r[f"{d}_lo"] >> _TIE_BITS) for d in DIMENSIONS}
        best = max(DIMENSIONS, key=lambda d: extent[d])
        if not extent[best]:  # one value in all dimensions: part it by the hash
            best = max(DIMENSIONS, key=lambda d: r[f"{d}_hi"] - r[f"{d}_lo"])
        out[r["node"]] = (best, r[f"{best}_lo"], r[f"{best}_hi"] + 1)
    return {n.first: out[n.first] for n in active if n.first in out}


def _cuts(rows: DataFrame, root: Node, chosen: dict[int, tuple[str, int, int]], share: dict[int, float], slack: float) -> dict[int, int]:
    """Coordinate of each node's cut: bytes below it come nearest to ``share`` of the node's."""
    cuts, open_, below, goal = {}, dict(chosen), {n: 0 for n in chosen}, {}
    while open_:
        node = root.place(lambda n: n.first)
        step = {n: max(1, -(-(hi - lo) // BINS)) for n, (_, lo, hi) in open_.items()}
        bin_, inside = F.lit(None).cast("long"), F.lit(False)
        for n, (d, lo, hi) in open_.items():
            mine = (node == n) & (F.col(d) >= lo) & (F.col(d) < hi)
            inside = inside | mine
            bin_ = F.when(mine, F.expr(f"({d} - {lo}) div {step[n]}")).otherwise(bin_)
        table = (
            rows.where(inside).groupBy(node.alias("node"), bin_.alias("bin")).agg(F.sum("size").alias("bytes")).orderBy("node", "bin").collect()
        )
        following = {}
        for n, (d, lo, hi) in open_.items():
            bins = [(r["bin"], r["bytes"]) for r in table if r["node"] == n]
            if n not in goal:
                goal[n] = share[n] * sum(b for _, b in bins)
            run = below[n]
            for k, weight in bins:
                if run + weight >= goal[n]:
                    break
                run += weight
            start, end = lo + k * step[n], lo + (k + 1) * step[n]
            if weight <= slack or step[n] == 1:
                # The nearer edge of the last bin, but never one that leaves a side empty.
                before = goal[n] - run < run + weight - goal[n] and start > chosen[n][1]
                cuts[n] = start if before else end
            else:
                below[n] = run
                following[n] = (d, start, min(end, hi))
        open_ = following
    return cuts


def tree(rows: DataFrame, n_shards: int, total: int) -> Node:
    """The k-d tree of ``n_shards`` leaves over ``rows`` of ``points``."""
    root = Node(0, n_shards)
    slack = max(1.0, 0.002 * total / n_shards)
    while True:
        active = [n for n in root.leaves() if n.count > 1]
        if not active:
            return root
        chosen = _widest(rows, root, active)
        share = {n.first: (n.count // 2) / n.count for n in active}
        cuts = _cuts(rows, root, chosen, share, slack)
        for n in active:
            half = n.count // 2
            # Nodes without documents split anywhere.
            n.dimension, n.cut = (chosen[n.first][0], cuts[n.first]) if n.first in cuts else (DIMENSIONS[0], 0)
            n.left, n.right = Node(n.first, half), Node(n.first + half, n.count - half)


def with_slots(rows: DataFrame, n_rows: int, n_shards: int) -> DataFrame:
    """Add ``slot``: 0, 1, 2, ... inside each shard.

    Rows are numbered in cells of about CELL_ROWS and get the number of rows in
    the cells before, so no task sorts a shard.
    """
    cells = max(1, -(-n_rows // (n_shards * CELL_ROWS)))
    dealt = rows.withColumn("_cell", F.pmod(F.xxhash64("doc_id", "text_key"), F.lit(cells)).cast("int"))
    earlier = Window.partitionBy("shard").orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    before = (
        dealt.groupBy("shard", "_cell")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("shard", "_cell", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    )
    inside = Window.partitionBy("shard", "_cell").orderBy("doc_id", "text_key")
    numbered = dealt.withColumn("_nth", F.row_number().over(inside) - 1).join(before, ["shard", "_cell"])
    return numbered.withColumn("slot", (F.col("_before") + F.col("_nth")).cast("long")).drop("_cell", "_nth", "_before")


def shard(docs: DataFrame, n_shards: int | None = None, target_bytes: int | None = None) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot); as many shards as asked for, or as ``target_bytes`` needs."""
    rows = checkpointed(narrow(docs))
    whole = rows.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("bytes"), F.count(F.lit(1)).alias("n")).first()
    if n_shards is None:
        n_shards = max(1, -(-whole.bytes // (target_bytes or whole.bytes or 1)))
    placed = checkpointed(points(rows, whole.bytes / n_shards))
    root = tree(placed, n_shards, whole.bytes)
    dealt = placed.withColumn("shard", root.place(lambda n: n.first).cast("int"))
    return with_slots(dealt, whole.n, n_shards).select("doc_id", "size", "text_crc32", "shard", "slot")
