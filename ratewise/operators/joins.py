"""Look-up join that neither broadcasts an unbounded table nor shuffles a hot key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_ROWS = 300_000
BROADCAST_KEY_BYTES = 64 << 20
HOT_ROWS = 100_000
_SALTS = 4096


def fits_broadcast(
    dim: DataFrame, key: str, rows: int = BROADCAST_ROWS, key_bytes: int = BROADCAST_KEY_BYTES
) -> bool:
    """Whether ``dim`` is small both in rows and in bytes of its string key (one aggregate)."""
    size = dim.agg(
        F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(F.octet_length(key)), F.lit(0)).alias("bytes")
    ).first()
    return size.rows <= rows and size.bytes <= key_bytes


def lookup_join(
    facts: DataFrame,
    dim: DataFrame,
    key: str,
    weight: str,
    broadcast_rows: int = BROADCAST_ROWS,
    hot_rows: int = HOT_ROWS,
    absent: DataFrame | None = None,
) -> DataFrame:
    """Inner join of ``facts`` with ``dim``, one row per string ``key``.

    ``weight`` is how many fact rows carry the key. A ``dim`` of checked small
    size is broadcast. Otherwise its ``hot_rows`` heaviest keys are broadcast and
    only the rest is shuffled: a key of ``dim`` outside its heaviest H holds at
    most 1/H of the facts. Keys that are frequent in the facts but not in
    ``dim`` may be named in ``absent``; they leave before the shuffle. Rows that found a hot key travel under a salted key that matches
    nothing, so they spread evenly. ``dim`` should be materialised.
    """
    if fits_broadcast(dim, key, broadcast_rows):
        return facts.join(F.broadcast(dim), key)
    if absent is not None and fits_broadcast(absent, key):
        facts = facts.join(F.broadcast(absent.select(key)), key, "left_anti")
    payload = [c for c in dim.columns if c != key]
    packed = dim.select(key, F.struct(*payload).alias("_cold"))
    widest = dim.agg(F.max(F.octet_length(key))).first()[0] or 0
    hot_rows = min(hot_rows, max(1, BROADCAST_KEY_BYTES // max(1, widest)))
    hot = dim.orderBy(F.desc(weight), key).limit(hot_rows).select(
        key, F.struct(*payload).alias("_hot")
    )
    cold = packed.join(F.broadcast(hot.select(key)), key, "left_anti").withColumnRenamed(
        key, "_join_key"
    )
    salt = F.concat(F.lit("\u0000"), F.pmod(F.hash(*facts.columns), F.lit(_SALTS)).cast("string"))
    joined = (
        facts.join(F.broadcast(hot), key, "left")
        .withColumn("_join_key", F.when(F.col("_hot").isNull(), F.col(key)).otherwise(salt))
        .join(cold, "_join_key", "left")
        .withColumn("_found", F.coalesce("_hot", "_cold"))
        .where(F.col("_found").isNotNull())
    )
    return joined.select(*facts.columns, *[F.col(f"_found.{c}").alias(c) for c in payload])
