"""Pairs of Bloom filters for hashes seen at least once and at least twice.

A filter is cut into segments of 2^18 bits; all probes of a hash fall into one
segment, so segments can be built and merged apart. A task reports only the
bits it has set. The size of a filter is a fixed number of bits, whatever the
data: a fuller filter lets more hashes pass, and never rejects one it has seen.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SEGMENT_BITS = 18
PROBES = 3
_WIDTH = 1 << SEGMENT_BITS
_FLUSH = 1 << 20


def filter_bits(n: int, per_hash: int = 12, least: int = 20, most: int = 28) -> int:
    """Exponent of the filter size for ``n`` hashes, within fixed bounds."""
    return int(min(most, max(least, np.ceil(np.log2(max(1, n) * per_hash)))))


def _positions(hashes: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Segment of each hash, and its probed bits inside the segment."""
    h = hashes.view(np.uint64)
    segment = (h >> np.uint64(64 - (bits - SEGMENT_BITS))) if bits > SEGMENT_BITS else np.zeros(len(h), np.uint64)
    mask = np.uint64(_WIDTH - 1)
    probes = np.stack([(h * np.uint64(m)) >> np.uint64(20) & mask for m in (1, 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)[:PROBES]])
    return segment.astype(np.int64), probes.astype(np.int64)


class Filter:
    """One filter in memory, for look-ups in tasks."""

    def __init__(self, bits: int, words: bytes):
        self.bits, self.words = bits, words

    def has(self, hashes: np.ndarray) -> np.ndarray:
        if not len(hashes):
            return np.zeros(0, bool)
        data = np.frombuffer(self.words, np.uint8)
        segment, probes = _positions(hashes, self.bits)
        at = segment * _WIDTH + probes
        return ((data[at >> 3] >> (at & 7).astype(np.uint8)) & 1).astype(bool).all(axis=0)


def _sparse(segment: int, once: np.ndarray, twice: np.ndarray) -> dict:
    return {"segment": segment, "once": np.unique(once).astype("<u4").tobytes(), "twice": np.unique(twice).astype("<u4").tobytes()}


_SCHEMA = pa.schema([("segment", pa.int32()), ("once", pa.binary()), ("twice", pa.binary())])


def build(rows: DataFrame, column: str, bits: int, which: str) -> Filter:
    """Filter of the hashes in an array column; ``which`` is "once" or "twice".

    The hashes of one row are distinct, so "twice" means in two rows or more.
    The result has 2^bits bits and is returned to the driver for broadcasting.
    """

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        count = 0

        def flush():
            hashes = np.sort(np.concatenate(held)) if held else np.zeros(0, np.int64)
            values, counts = np.unique(hashes, return_counts=True)
            segment, probes = _positions(values, bits)
            order = np.argsort(segment, kind="stable")
            cuts = np.flatnonzero(np.diff(segment[order], prepend=-1))
            out = []
            for a, b in zip(cuts, [*cuts[1:], len(order)]):
                part = order[a:b]
                out.append(_sparse(int(segment[part[0]]), probes[:, part], probes[:, part][:, counts[part] > 1]))
            return pa.RecordBatch.from_pylist(out, _SCHEMA)

        for batch in batches:
            values = batch.column(0).flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            held.append(values)
            count += len(values)
            if count >= _FLUSH:
                yield flush()
                held, count = [], 0
        if held:
            yield flush()

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, once, twice = None, None, None

        def done():
            bitmap = np.packbits(once if which == "once" else twice, bitorder="little")
            return pa.RecordBatch.from_pylist([{"segment": current, "words": bitmap.tobytes()}], _MERGED)

        for batch in batches:
            for segment, a, b in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if segment != current:
                    if current is not None:
                        yield done()
                    current, once, twice = segment, np.zeros(_WIDTH, bool), np.zeros(_WIDTH, bool)
                at = np.frombuffer(a, "<u4")
                # Seen before and seen here: at least twice. Bits of other hashes only add suspects.
                twice[at] |= once[at]
                twice[np.frombuffer(b, "<u4")] = True
                once[at] = True
        if current is not None:
            yield done()

    parts = rows.select(column).mapInArrow(local, "segment int, once binary, twice binary")
    merged = (
        parts.repartition(F.col("segment"))
        .sortWithinPartitions("segment")
        .mapInArrow(merge, "segment int, words binary")
    )
    size = _WIDTH >> 3
    words = bytearray(size << max(0, bits - SEGMENT_BITS))
    for row in merged.toLocalIterator():
        words[row.segment * size : (row.segment + 1) * size] = row.words
    return Filter(bits, bytes(words))


_MERGED = pa.schema([("segment", pa.int32()), ("words", pa.binary())])
