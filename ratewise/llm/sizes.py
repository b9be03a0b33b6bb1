"""Broadcasts behind a check of their size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratewise.session import checkpointed

#: Ids (8 bytes each) that may be broadcast.
BROADCAST_IDS = 1_000_000


def ids_for_join(ids: DataFrame, limit: int = BROADCAST_IDS) -> DataFrame:
    """``ids`` written once, and marked for broadcast if there are at most ``limit``; more are joined by a shuffle."""
    stored = checkpointed(ids)
    return F.broadcast(stored) if stored.limit(limit + 1).count() <= limit else stored


def text_key(text: str = "text") -> Column:
    """128 bits of the whole text, to tell rows that share a doc_id or have none; null is as empty."""
    return F.unhex(F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary")))
