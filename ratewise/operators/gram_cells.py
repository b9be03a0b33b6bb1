"""Counts of n-grams under numeric keys, so that no n-gram is shuffled as a string.

Spark cuts the texts to tokens; a task turns the tokens of a batch to n-gram keys
of 96 bits with NumPy and counts them within each text. All grouping over texts
is left to Spark. Strings are looked up afterwards, for the few keys that are
reported. Two of 10^9 n-grams share a key with a chance of 10^-11.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratewise.operators.joins import BROADCAST_ROWS
from ratewise.session import checkpointed

#: Bytes of text of a task; its n-grams of one length are about a sixth as many.
TASK_BYTES = 8 << 20
#: Tokens that a task counts at once, a longer text by itself.
SLICE_TOKENS = 1 << 19
#: Keys that go to every executor as numbers; beyond, all n-grams are joined.
MOST_KEYS = 4_000_000
#: ``h2`` of the row that stands for a whole text.
WHOLE = -1
#: Slots that a task counts n-grams in at most, four bytes each, and those of a row of the shuffle.
MOST_SLOT_BITS, _SLOT_BITS = 24, 16

_TEXT_STEP = np.int64(0x9E3779B97F4A7C15 - (1 << 64))
#: Rows of a batch of counts.
_ROWS = 1 << 16
_FACTORS = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93))
KEY = ("h1", "h2")


def text_size(texts: DataFrame, column: str = "content") -> tuple[int, int]:
    """Number of rows, and bytes of their texts."""
    size = texts.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.octet_length(column)), F.lit(0)).alias("bytes")).first()
    return size.n, size.bytes


def text_tasks(texts: DataFrame, column: str = "content", task_bytes: int = TASK_BYTES) -> tuple[int, int]:
    """Number of rows, and of tasks whose share of the texts stays the same however many there are."""
    n, size = text_size(texts, column)
    return n, max(texts.sparkSession.sparkContext.defaultParallelism, -(-size // task_bytes))


def dealt(texts: DataFrame, tasks: int) -> DataFrame:
    """The texts in ``tasks`` partitions by id, or round about without one."""
    return texts.repartition(tasks, "id") if "id" in texts.columns else texts.repartition(tasks)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _word_keys(words: list[str]) -> np.ndarray:
    raw = b"".join(hashlib.blake2b(w.encode("utf-8", "surrogatepass"), digest_size=16).digest() for w in words)
    return np.frombuffer(raw, np.uint64).reshape(-1, 2)


def _gram_keys(words: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(h1, h2) of the runs of ``n`` rows of word keys."""
    m, made = max(0, len(words) - n + 1), []
    for j, factor in enumerate(_FACTORS):
        key = np.full(m, n, np.uint64)
        for i in range(n):
            key = key * factor + words[i : i + m, j]
        made.append(_mixed(key))
    return made[0].view(np.int64), (made[1] >> np.uint64(33)).astype(np.int32)


def _among(keys: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which keys are among sorted ones."""
    if not len(known):
        return np.zeros(len(keys), bool)
    return known[np.minimum(np.searchsorted(known, keys), len(known) - 1)] == keys


def _slices(lengths: np.ndarray) -> Iterator[tuple[int, int]]:
    """(start, end) of rows with about SLICE_TOKENS tokens."""
    part, start = (np.cumsum(lengths) - lengths) // SLICE_TOKENS, 0
    for end in [*(np.flatnonzero(np.diff(part)) + 1).tolist(), len(lengths)]:
        if end > start:
            yield start, end
        start = end


def gram_cells(
    tokens: DataFrame,
    lengths: Sequence[int],
    stop_words: Sequence[str] = (),
    only: np.ndarray | None = None,
    whole: bool = False,
    terms: bool = False,
    within: np.ndarray | None = None,
) -> DataFrame:
    """(columns of ``tokens`` but the tokens, h1, h2, tf, n): a row for each text and distinct n-gram.

    ``only`` are values of ``h1``; other n-grams are left out. With ``whole``
    each text with n-grams has one more row with ``h2`` WHOLE, the sum of the squares of ``tf`` as its ``tf``, and the
    number of its n-grams as ``n``, which is 1 elsewhere; its ``h1`` is the column
    ``h1`` of ``tokens``. With ``terms`` there are rows (h1, h2, term) instead, at least one for each n-gram.
    ``within`` are values of ``h1`` of shorter n-grams; an n-gram stays if both its parts of n - 1 words are among them.
    """
    kept = [] if terms else [f for f in tokens.schema.fields if f.name not in ("tokens", *KEY)]
    key = [T.StructField("h1", T.LongType()), T.StructField("h2", T.IntegerType())]
    counts = [T.StructField("tf", T.LongType()), T.StructField("n", T.LongType())]
    schema = T.StructType([*kept, *key, *([T.StructField("term", T.StringType())] if terms else counts)])
    stops = pa.array(sorted(set(stop_words)), pa.string())
    given = [None if keys is None else np.sort(np.asarray(keys, np.int64)) for keys in (only, within)]
    shared = tokens.sparkSession.sparkContext.broadcast(given) if any(keys is not None for keys in given) else None

    def count(batch: pa.RecordBatch, limit: np.ndarray | None, parts_of: np.ndarray | None) -> Iterator[pa.RecordBatch]:
        column = batch.column("tokens")
        size = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        coded = column.flatten().dictionary_encode()
        words, at = coded.dictionary, coded.indices.to_numpy(zero_copy_only=False)
        doc = np.repeat(np.arange(len(size)), size)
        if len(stops):
            stays = ~pc.is_in(words, stops).to_numpy(zero_copy_only=False)[at]
            at, doc = at[stays], doc[stays]
        word_keys = _word_keys(words.to_pylist())[at]
        for n in lengths:
            h1, h2 = _gram_keys(word_keys, n)
            place = np.flatnonzero(doc[: len(h1)] == doc[n - 1 :][: len(h1)])
            if parts_of is not None:
                known = _among(_gram_keys(word_keys, n - 1)[0], parts_of)
                place = place[known[place] & known[place + 1]]
            if limit is not None:
                place = place[_among(h1[place], limit)]
            # A stable sort leaves the texts in order among equal keys.
            place = place[np.argsort(h1[place], kind="stable")]
            if not len(place):
                continue
            h1, h2, text = h1[place], h2[place], doc[place]
            if terms:
                first = np.flatnonzero(np.concatenate([[True], (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])]))
                parts = [words.take(pa.array(at[place[first] + i])) for i in range(n)]
                made = pc.binary_join_element_wise(*parts, " ") if n > 1 else parts[0]
                yield pa.RecordBatch.from_arrays([pa.array(h1[first]), pa.array(h2[first]), made], names=schema.fieldNames())
                continue
            first = np.flatnonzero(np.concatenate([[True], (h1[1:] != h1[:-1]) | (text[1:] != text[:-1]) | (h2[1:] != h2[:-1])]))
            tf = np.diff(first, append=len(place))
            h1, h2, text = h1[first], h2[first], text[first]
            ones = np.ones(len(tf), np.int64)
            if whole:
                squares, grams = np.bincount(text, tf * tf, len(size)).astype(np.int64), np.bincount(text, minlength=len(size))
                rows = np.flatnonzero(grams)
                spread = batch.column("h1").to_numpy(zero_copy_only=False)[rows]
                h1, h2 = np.concatenate([h1, spread]), np.concatenate([h2, np.full(len(rows), WHOLE, np.int32)])
                text, tf, ones = np.concatenate([text, rows]), np.concatenate([tf, squares[rows]]), np.concatenate([ones, grams[rows]])
            # Rows of one text in a row: what they have in common is compressed away in the shuffle.
            order = np.argsort(text.astype(np.min_scalar_type(len(size))), kind="stable")
            h1, h2, text, tf, ones = h1[order], h2[order], text[order], tf[order], ones[order]
            columns = [batch.column(f.name).take(pa.array(text)) for f in kept]
            columns += [pa.array(h1), pa.array(h2), pa.array(tf.astype(np.int64)), pa.array(ones.astype(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, names=schema.fieldNames())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        limits = (None, None) if shared is None else shared.value
        for part in _parts(batches):
            yield from count(part, *limits)

    return tokens.mapInArrow(run, schema)


def _distinct_grams(
    batch: pa.RecordBatch, lengths: Sequence[int], stops: pa.Array, wanted=None
) -> Iterator[tuple[int, np.ndarray, np.ndarray, list[pa.Array]]]:
    """(variant, h1, h2, words) of each text's distinct n-grams; a variant is 2 n, and one more with stop words left out.

    ``wanted`` says of a variant and its h1 which n-grams are looked at.
    """
    column = batch.column("tokens")
    size = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    coded = column.flatten().dictionary_encode()
    words, every = coded.dictionary, coded.indices.to_numpy(zero_copy_only=False)
    keys, doc = _word_keys(words.to_pylist()), np.repeat(np.arange(len(size)), size)
    stays = ~pc.is_in(words, stops).to_numpy(zero_copy_only=False)[every]
    for removed in (1, 0):
        at, text = (every[stays], doc[stays]) if removed else (every, doc)
        word_keys = keys[at]
        for n in lengths:
            h1, h2 = _gram_keys(word_keys, n)
            place = np.flatnonzero(text[: len(h1)] == text[n - 1 :][: len(h1)])
            if wanted is not None:
                place = place[wanted(2 * n + removed, h1[place])]
            if not len(place):
                continue
            # Equal n-grams of one text meet in this order; which comes first does not matter.
            place = place[np.argsort(h1[place] + text[place] * _TEXT_STEP)]
            a, b, t = h1[place], h2[place], text[place]
            first = np.concatenate([[True], (a[1:] != a[:-1]) | (t[1:] != t[:-1]) | (b[1:] != b[:-1])])
            place = place[first]
            yield 2 * n + removed, a[first], b[first], [words.take(pa.array(at[place + i])) for i in range(n)] if wanted is not None else []


def cell_counts(
    tokens: DataFrame, lengths: Sequence[int], stop_words: Sequence[str], bits: dict[int, int], least_bits: int, candidates: dict[int, np.ndarray]
) -> DataFrame:
    """(variant, slot, df) of a task's texts: in how many a cell of n-grams comes, an n-gram of a text counted once.

    A cell holds the n-grams of a variant with the same last ``bits`` of ``h1``; ``h1`` of a variant's i-th candidate has a
    slot of its own beside that, -1 - i. A task holds four bytes a cell.
    """
    stops, shared = pa.array(sorted(set(stop_words)), pa.string()), tokens.sparkSession.sparkContext.broadcast(candidates)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells: dict[int, np.ndarray] = {}
        found: dict[int, np.ndarray] = {}
        for part in _parts(batches):
            for variant, h1, _, _ in _distinct_grams(part, lengths, stops):
                width = 1 << bits.get(variant, least_bits)
                held = cells.setdefault(variant, np.zeros(width, np.int32))
                slot = h1 & (width - 1)
                if len(slot) < width // 8:
                    np.add.at(held, slot, 1)
                else:
                    held += np.bincount(slot, minlength=width).astype(np.int32)
                known = shared.value.get(variant, np.zeros(0, np.int64))
                if len(known):
                    order = np.argsort(known)
                    at = np.searchsorted(known, h1[_among(h1, known[order])], sorter=order)
                    found[variant] = found.get(variant, 0) + np.bincount(order[at], minlength=len(known))
        for table, slots in ((cells, lambda at: at), (found, lambda at: -1 - at)):
            for variant, held in table.items():
                used = np.flatnonzero(held)
                for start in range(0, len(used), _ROWS):
                    at = used[start : start + _ROWS]
                    columns = [np.full(len(at), variant, np.int32), slots(at), held[at].astype(np.int64)]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["variant", "slot", "df"])

    return tokens.mapInArrow(run, "variant int, slot long, df long")


def grams_of_cells(
    tokens: DataFrame, lengths: Sequence[int], stop_words: Sequence[str], bits: dict[int, int], least_bits: int, reached: dict[int, np.ndarray] | None
) -> DataFrame:
    """(variant, slot, h1, h2, term, df): n-grams of the cells ``reached``, or of all, with counts of a part of the texts."""
    stops, shared = pa.array(sorted(set(stop_words)), pa.string()), tokens.sparkSession.sparkContext.broadcast(reached)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = lambda variant: 1 << bits.get(variant, least_bits)
        marks: dict[int, np.ndarray] = {}
        for variant, slots in (shared.value or {}).items():
            marks[variant] = np.zeros(width(variant), bool)
            marks[variant][slots] = True

        def wanted(variant: int, h1: np.ndarray) -> np.ndarray:
            if shared.value is None:
                return np.ones(len(h1), bool)
            return marks[variant][h1 & (width(variant) - 1)] if variant in marks else np.zeros(len(h1), bool)

        for part in _parts(batches):
            for variant, h1, h2, parts in _distinct_grams(part, lengths, stops, wanted):
                order = np.lexsort((h2, h1))
                a, b = h1[order], h2[order]
                first = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])]))
                some = pa.array(order[first])
                term = pc.binary_join_element_wise(*[p.take(some) for p in parts], " ") if len(parts) > 1 else parts[0].take(some)
                columns = [np.full(len(first), variant, np.int32), a[first] & (width(variant) - 1), a[first], b[first]]
                made = [*[pa.array(c) for c in columns], term, pa.array(np.diff(first, append=len(a)).astype(np.int64))]
                yield pa.RecordBatch.from_arrays(made, names=["variant", "slot", "h1", "h2", "term", "df"])

    return tokens.mapInArrow(run, "variant int, slot long, h1 long, h2 int, term string, df long")


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        size = pc.fill_null(pc.list_value_length(batch.column("tokens")), 0).to_numpy(zero_copy_only=False)
        for start, end in _slices(size.astype(np.int64)):
            yield batch.slice(start, end - start)


def reached_slots(tokens: DataFrame, lengths: Sequence[int], stop_words: Sequence[str], least: float, bits: int) -> np.ndarray:
    """The slots, of 2 ** ``bits``, in which n-grams with the same last bits of ``h1`` come ``least`` times or more, packed to bits.

    An n-gram is in no more texts than its slot has occurrences, so those of other slots are in fewer than ``least``
    texts. A task holds four bytes a slot, and shuffles as many at most.
    """
    width, row = 1 << bits, 1 << min(bits, _SLOT_BITS)
    stops = pa.array(sorted(set(stop_words)), pa.string())

    def emptied(held: np.ndarray) -> Iterator[pa.RecordBatch]:
        for at in range(0, width, row):
            part = held[at : at + row]
            if part.any():
                packed = part.astype(np.min_scalar_type(part.max())).tobytes()
                yield pa.RecordBatch.from_arrays([pa.array([at], pa.int64()), pa.array([packed], pa.binary())], names=["at", "counts"])
        held[:] = 0

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, seen = np.zeros(width, np.uint32), 0
        for part in _parts(batches):
            word_keys, doc = _kept_words(part, stops)
            if seen + len(doc) * len(lengths) >= 1 << 31:
                yield from emptied(held)
                seen = 0
            for n in lengths:
                h1, _ = _gram_keys(word_keys, n)
                np.add.at(held, h1[doc[: len(h1)] == doc[n - 1 :][: len(h1)]] & (width - 1), np.uint32(1))
            seen += len(doc) * len(lengths)
        yield from emptied(held)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for at, packed in zip(batch.column("at").to_pylist(), batch.column("counts").to_pylist()):
                held = sums.setdefault(at, np.zeros(row, np.int64))
                held += np.frombuffer(packed, f"u{len(packed) // row}")
        for at, held in sums.items():
            marks = np.packbits(held >= least).tobytes()
            yield pa.RecordBatch.from_arrays([pa.array([at], pa.int64()), pa.array([marks], pa.binary())], names=["at", "marks"])

    counts = tokens.select("tokens").mapInArrow(count, "at long, counts binary")
    tasks = min(width // row, tokens.sparkSession.sparkContext.defaultParallelism)
    reached = np.zeros(width // 8, np.uint8)
    for r in counts.repartition(tasks, "at").mapInArrow(add, "at long, marks binary").collect():
        reached[r["at"] // 8 : (r["at"] + row) // 8] = np.frombuffer(r["marks"], np.uint8)
    return reached


def text_counts(
    tokens: DataFrame, lengths: Sequence[int], stop_words: Sequence[str] = (), reached: np.ndarray | None = None
) -> DataFrame:
    """(h1, h2, n): in how many texts of a slice of a task an n-gram comes; to be summed by key.

    With the slots of ``reached_slots`` n-grams of other slots are left out.
    """
    stops = pa.array(sorted(set(stop_words)), pa.string())
    shared = None if reached is None else tokens.sparkSession.sparkContext.broadcast(reached)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks = None if shared is None else np.unpackbits(shared.value).view(bool)
        for part in _parts(batches):
            word_keys, doc = _kept_words(part, stops)
            for n in lengths:
                h1, h2 = _gram_keys(word_keys, n)
                place = np.flatnonzero(doc[: len(h1)] == doc[n - 1 :][: len(h1)])
                if marks is not None:
                    place = place[marks[h1[place] & (len(marks) - 1)]]
                if not len(place):
                    continue
                # A stable sort leaves the texts in order among equal keys.
                place = place[np.argsort(h1[place], kind="stable")]
                h1, h2, text = h1[place], h2[place], doc[place]
                other = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
                once = np.flatnonzero(np.concatenate([[True], other | (text[1:] != text[:-1])]))
                h1, h2 = h1[once], h2[once]
                first = np.flatnonzero(np.concatenate([[True], (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])]))
                made = [pa.array(h1[first]), pa.array(h2[first]), pa.array(np.diff(first, append=len(h1)).astype(np.int64))]
                yield pa.RecordBatch.from_arrays(made, names=["h1", "h2", "n"])

    return tokens.select("tokens").mapInArrow(run, "h1 long, h2 int, n long")


def _kept_words(batch: pa.RecordBatch, stops: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(key, row) of each word of a batch, stop words left out."""
    column = batch.column("tokens")
    size = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    coded = column.flatten().dictionary_encode()
    words, at = coded.dictionary, coded.indices.to_numpy(zero_copy_only=False)
    doc = np.repeat(np.arange(len(size)), size)
    if len(stops):
        stays = ~pc.is_in(words, stops).to_numpy(zero_copy_only=False)[at]
        at, doc = at[stays], doc[stays]
    return _word_keys(words.to_pylist())[at], doc


def term_keys(index: DataFrame) -> DataFrame:
    """``index`` with the keys (h1, h2) of its column ``term``, n-grams joined by spaces, instead of it."""
    kept = [f for f in index.schema.fields if f.name != "term"]
    schema = T.StructType([*kept, T.StructField("h1", T.LongType()), T.StructField("h2", T.IntegerType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            split = [term.split(" ") for term in batch.column("term").to_pylist()]
            h1, h2 = np.zeros(len(split), np.int64), np.zeros(len(split), np.int32)
            for n in {len(words) for words in split}:
                at = np.array([i for i, words in enumerate(split) if len(words) == n])
                keys = _word_keys([word for i in at for word in split[i]])
                a, b = _gram_keys(keys, n)
                h1[at], h2[at] = a[::n], b[::n]
            columns = [*[batch.column(f.name) for f in kept], pa.array(h1), pa.array(h2)]
            yield pa.RecordBatch.from_arrays(columns, names=schema.fieldNames())

    return index.select(*[f.name for f in kept], "term").mapInArrow(run, schema)


class _Weights:
    """Cells tf x idf of the n-grams of ``keyed`` (h1, h2, idx, idf, scale), which goes to every executor; the cells of an id have length 1."""

    def __init__(self, tokens: DataFrame, lengths: Sequence[int], stop_words: Sequence[str], keyed: pa.Table):
        order = np.lexsort((keyed.column("h2").to_numpy(), keyed.column("h1").to_numpy()))
        known = {c: keyed.column(c).to_numpy()[order] for c in ("h1", "h2", "idx", "idf", "scale")}
        self.shared, self.stops = tokens.sparkSession.sparkContext.broadcast(known), pa.array(sorted(set(stop_words)), pa.string())
        self.lengths = lengths

    def of(self, parts: Iterator[pa.RecordBatch]) -> tuple[pa.DictionaryArray, np.ndarray, np.ndarray, np.ndarray, np.ndarray] | None:
        """(ids of the rows, codes of the ids of the cells in order, idx, value, scale) of the rows (id, tokens) of a task, None without rows."""
        h1, h2 = self.shared.value["h1"], self.shared.value["h2"]
        # Equal h1 with another h2 are a chance of 10^-8 in 10^6 terms; they lie side by side.
        most = int(np.diff(np.flatnonzero(np.concatenate([[True], h1[1:] != h1[:-1], [True]]))).max()) if len(h1) else 0
        none = np.zeros(0, np.int64)
        ids, texts, places, counts, before = [], [none], [none], [none], 0
        for part in parts:
            ids.append(part.column("id"))
            word_keys, doc = _kept_words(part, self.stops)
            for n in self.lengths if most else ():
                a, b = _gram_keys(word_keys, n)
                within = np.flatnonzero(doc[: len(a)] == doc[n - 1 :][: len(a)])
                a, b, text = a[within], b[within], doc[within]
                at = np.searchsorted(h1, a)
                for next_one in range(most):
                    there = np.minimum(at + next_one, len(h1) - 1)
                    hit = np.flatnonzero((h1[there] == a) & (h2[there] == b) & (at + next_one < len(h1)))
                    cell, tf = np.unique((text[hit] + before) * len(h1) + there[hit], return_counts=True)
                    texts.append(cell // len(h1))
                    places.append(cell % len(h1))
                    counts.append(tf)
            before += part.num_rows
        if not ids:
            return None
        coded = pa.chunked_array(ids).combine_chunks().dictionary_encode(null_encoding="encode")
        code = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        texts, places, counts = (np.concatenate(x) for x in (texts, places, counts))
        cell, at = np.unique(code[texts] * max(len(h1), 1) + places, return_inverse=True)
        tf = np.bincount(at, counts, len(cell))
        owner, place = cell // max(len(h1), 1), cell % max(len(h1), 1)
        raw = tf * self.shared.value["idf"][place]
        value = raw / np.sqrt(np.bincount(owner, raw * raw, len(coded.dictionary)))[owner]
        return coded, owner, self.shared.value["idx"][place].astype(np.int64), value, self.shared.value["scale"][place]


def weighed_cells(tokens: DataFrame, lengths: Sequence[int], stop_words: Sequence[str], keyed: pa.Table) -> DataFrame:
    """(id, idx, value, scale): cells tf x idf of the n-grams of ``keyed`` (h1, h2, idx, idf, scale), the cells of an id of length 1.

    All rows of an id must lie in one partition of ``tokens`` (id, tokens), whose counts a task holds at once.
    ``keyed`` goes to every executor.
    """
    weights = _Weights(tokens, lengths, stop_words, keyed)
    numbers = [T.StructField("idx", T.LongType()), T.StructField("value", T.DoubleType()), T.StructField("scale", T.DoubleType())]
    schema = T.StructType([tokens.schema["id"], *numbers])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = weights.of(_parts(batches))
        if found is None:
            return
        coded, owner, idx, value, scale = found
        for start in range(0, len(owner), _ROWS):
            some = slice(start, start + _ROWS)
            columns = [coded.dictionary.take(pa.array(owner[some])), pa.array(idx[some]), pa.array(value[some]), pa.array(scale[some])]
            yield pa.RecordBatch.from_arrays(columns, names=schema.fieldNames())

    return tokens.select("id", "tokens").mapInArrow(run, schema)


def packed_cells(
    tokens: DataFrame, lengths: Sequence[int], stop_words: Sequence[str], keyed: pa.Table, start: int, weight: float
) -> DataFrame:
    """(id, idx, value), one row of arrays for each id: its cells as ``weighed_cells`` gives them, idx from ``start`` on, values times
    ``weight`` by scale, and the cells of rows of ``tokens`` (id, tokens, idx, value) without tokens.

    All rows of an id must lie in one partition.
    """
    weights = _Weights(tokens, lengths, stop_words, keyed)
    schema = T.StructType([tokens.schema["id"], T.StructField("idx", T.ArrayType(T.LongType())), T.StructField("value", T.ArrayType(T.DoubleType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        others: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

        def parts() -> Iterator[pa.RecordBatch]:
            before = 0
            for part in _parts(batches):
                at = np.flatnonzero(part.column("idx").is_valid().to_numpy(zero_copy_only=False))
                cells = part.select(["idx", "value"]).take(pa.array(at))
                others.append((at + before, *(c.to_numpy(zero_copy_only=False) for c in cells.columns)))
                before += part.num_rows
                yield part

        found = weights.of(parts())
        if found is None:
            return
        coded, owner, idx, value, scale = found
        row, place, given = (np.concatenate(x) for x in zip(*others))
        owner = np.concatenate([owner, coded.indices.to_numpy(zero_copy_only=False)[row]])
        order = np.argsort(owner, kind="stable")
        owner, idx = owner[order], np.concatenate([start + idx, place])[order]
        value = np.concatenate([value * weight / scale, given])[order]
        first = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]])) if len(owner) else owner
        ends, at = np.append(first, len(owner)), 0
        while at < len(first):
            # Ids with about _ROWS cells.
            end = max(at + 1, int(np.searchsorted(ends, ends[at] + _ROWS, "right")) - 1)
            some, offsets = slice(ends[at], ends[end]), pa.array((ends[at : end + 1] - ends[at]).astype(np.int32))
            lists = [pa.ListArray.from_arrays(offsets, pa.array(x[some])) for x in (idx, value)]
            yield pa.RecordBatch.from_arrays([coded.dictionary.take(pa.array(owner[first[at:end]])), *lists], names=schema.fieldNames())
            at = end

    return tokens.select("id", "tokens", "idx", "value").mapInArrow(run, schema)


def with_terms(keyed: DataFrame, tokens: DataFrame, lengths: Sequence[int], stop_words: Sequence[str] = ()) -> DataFrame:
    """``keyed`` (h1, h2, ...), which is materialised, with the strings of its keys instead of them, read from the texts."""
    n = keyed.count()
    only = keyed.select("h1").toArrow().column("h1").to_numpy() if n <= MOST_KEYS else None
    found = gram_cells(tokens, lengths, stop_words, only=only, terms=True).distinct()
    return found.join(F.broadcast(keyed) if n <= BROADCAST_ROWS else keyed, list(KEY)).drop(*KEY)


def _counts(tokens: DataFrame, n: int, stop_words: Sequence[str], least: int, within: np.ndarray | None) -> DataFrame:
    found = gram_cells(tokens, [n], stop_words, within=within).groupBy(*KEY).agg(F.sum("n").alias("df"))
    return checkpointed(found.where(F.col("df") >= least))


def frequent_counts(
    tokens: DataFrame, sample: DataFrame, share: float, lengths: Sequence[int], stop_words: Sequence[str], k: int
) -> dict[int, DataFrame]:
    """For each n a table (h1, h2, df) that holds the ``k`` n-grams in most texts, with their exact counts.

    An n-gram is in no more texts than its parts of n - 1 words, so only n-grams whose parts reach a
    bound are counted. The bound is guessed from a sample of about ``share`` of
    the texts. The counts are those of all n-grams that reach it: with fewer than ``k`` of
    them the guess was too high, and the n-grams are counted without one.
    """
    bounds = {}
    for n in lengths:
        seen = gram_cells(sample, [n], stop_words).groupBy(*KEY).agg(F.sum("n").alias("df"))
        best = [r.df for r in seen.orderBy(F.desc("df")).limit(k).select("df").collect()]
        # Three deviations below the k-th best of the sample, and a margin.
        low = best[-1] - 3 * best[-1] ** 0.5 if len(best) == k else 0
        bounds[n] = max(1, int(0.8 * low / max(share, 1e-9)))
    made: dict[int, DataFrame] = {}
    parts: np.ndarray | None = None
    for n in range(1, max(lengths) + 1):
        least = min(b for m, b in bounds.items() if m >= n)
        counted = _counts(tokens, n, stop_words, least, parts)
        size = counted.count()
        if n in bounds and size < k and least > 1:
            # The parts of longer n-grams are among them still.
            made[n] = _counts(tokens, n, stop_words, 1, None)
        elif n in bounds:
            made[n] = counted
        parts = counted.select("h1").toArrow().column("h1").to_numpy() if 1 < least and size <= MOST_KEYS else None
    return made
