"""Array kernels over the UTF-8 bytes of one text, run inside Arrow-batched tasks.

Every function takes whole texts. Bytes of non-ASCII characters are all above
0x7F, so the ASCII-only word classes below can be decided byte by byte.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True

#: Words of digits, letters and non-ASCII characters; everything else separates.
ALNUM = np.zeros(256, dtype=bool)
ALNUM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True

#: A-Z to a-z, all other bytes unchanged.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32

_MIX = np.random.default_rng(20240917)
_BYTE = _MIX.integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = int(_MIX.integers(0, 2**63)) * 2 + 1
_INVERSE = pow(_BASE, -1, 2**64)
_POWERS: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n of the base and of its inverse modulo 2^64; long tables are not kept."""
    if len(_POWERS[0]) <= n:
        size = max(n + 1, 1 << 14)
        made = []
        for base in (_BASE, _INVERSE):
            step = np.full(size, base & (2**64 - 1), np.uint64)
            step[0] = 1
            made.append(np.multiply.accumulate(step))
        if size > 1 << 20:
            return made[0], made[1]
        _POWERS[:] = made
    return _POWERS[0], _POWERS[1]


def mixed(x: np.ndarray) -> np.ndarray:
    """Finaliser of SplitMix64: spreads all input bits over the word."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def as_bytes(text: bytes | None) -> np.ndarray:
    return np.frombuffer(text or b"", np.uint8)


def spans(inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true values."""
    edges = np.flatnonzero(np.diff(inside.view(np.int8), prepend=np.int8(0), append=np.int8(0)))
    return edges[::2], edges[1::2]


def rolling(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each slice ``values[start:end]`` of a uint64 sequence."""
    power, inverse = _powers(len(values))
    prefix = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * power[: len(values)], out=prefix[1:])
    length = (ends - starts).astype(np.uint64)
    return mixed((prefix[ends] - prefix[starts]) * inverse[starts] + length * np.uint64(0x9E3779B97F4A7C15))


def byte_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of the bytes of each span."""
    return rolling(_BYTE[data], starts, ends) if len(starts) else np.zeros(0, np.uint64)


def gram_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of ``k`` words, from their hashes."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    at = np.arange(n)
    return rolling(words, at, at + k)


def space_words(text: bytes | None, lower: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes, and starts and ends of the words between white space."""
    data = as_bytes(text)
    if lower:
        data = LOWER[data]
    starts, ends = spans(~SPACE[data])
    return data, starts, ends


def alnum_words(text: bytes | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased bytes, and starts and ends of the words of letters and digits."""
    data = LOWER[as_bytes(text)]
    starts, ends = spans(ALNUM[data])
    return data, starts, ends


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def text_bytes(column: pa.Array) -> list[bytes | None]:
    return column.cast(pa.binary()).to_pylist()


def _give_back() -> None:
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU library only
    if trim is not None:
        trim(0)


def giving_back(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """``run``, which returns its free memory to the system when a task ends: workers outlive tasks, and those that idle add up."""

    def outer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            _give_back()

    return outer


def map_batches(
    df: DataFrame, fn: Callable[[pa.RecordBatch], dict], schema: str, keep: tuple[str, ...] = (), rows: int = 512
) -> DataFrame:
    """Run ``fn`` over slices of at most ``rows`` rows; it returns the new columns by name.

    Columns in ``keep`` pass through unchanged. Slices bound what a task holds
    beside the batch that Spark sends.
    """
    from pyspark.sql import types as T
    from pyspark.sql.pandas.types import to_arrow_schema

    made = T.StructType.fromDDL(schema) if hasattr(T.StructType, "fromDDL") else T._parse_datatype_string(schema)
    kept = [df.schema[name] for name in keep]
    full = T.StructType([*kept, *made.fields])
    arrow = to_arrow_schema(full)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, rows):
                part = batch.slice(start, rows)
                new = fn(part)
                columns = []
                for field in arrow:
                    value = new[field.name] if field.name in new else part.column(field.name)
                    columns.append(value.cast(field.type) if isinstance(value, pa.Array) else pa.array(value, field.type))
                yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    return df.mapInArrow(giving_back(run), full)
