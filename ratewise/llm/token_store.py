"""Token ids of documents in Parquet list columns.

Texts are dealt out by ranges of doc_id, sorted, and encoded in their partition;
each partition becomes one file, so file order is doc_id order. The ids are a
dictionary-encoded list column; doc_id and the counts are delta-encoded. Row
groups and pages are small and carry page indexes, so that a reader of some
documents, or of the metadata alone, skips the rest.

Defined results: a null or empty text is the end id alone; documents come in
ascending doc_id order, those without doc_id first, and equal ids by a hash of
the text; each row is a document, also if rows repeat; an empty table gives no
rows; only doc_id and text are stored.
"""

from __future__ import annotations

import codecs
import functools
import json
import string
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ratewise.llm import kernels as K
from ratewise.llm.sizes import ids_for_join

ROW_GROUP_BYTES = 16 << 20
PAGE_BYTES = 128 << 10
#: Words whose ids a task remembers take about this much memory in each of two generations.
MEMO_BYTES = 40 << 20
#: Longer words are encoded anew each time.
MEMO_LONGEST = 256
#: Texts are encoded in slices of about this many bytes, a longer text by itself.
SLICE_BYTES = 4 << 20

_PUNCTUATION = string.punctuation.encode()
_ENTRY_BYTES = 150  # of a word in a dict, beside its bytes and those of its ids
# Byte-level BPE puts characters from U+0100 on for bytes outside its printable ones.
_HIDDEN = [*range(0x21), *range(0x7F, 0xA1), 0xAD]
_SHIFTED = "".join(chr(0x100 + _HIDDEN.index(b) if b in _HIDDEN else b) for b in range(256))
# What a tokenizer does before its model, if words may be given to the model one by one.
_NORMALIZER = [("NFC", None), ("Replace", r"\s+"), ("Lowercase", None)]
_PIECES = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

#: Words that Arrow may lower-case one character by one: letters up to U+017F, but U+0130, which becomes two.
_LATIN = "^[A-Za-zÀ-ÖØ-öø-įı-ſ]+$"


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


def encodes_by_word(tokenizer) -> bool:
    """Whether a tokenizer lower-cases, drops white space, and cuts words at the pieces that ``WordEncoder`` knows."""
    spec = json.loads(tokenizer.to_str())
    steps = (spec.get("normalizer") or {}).get("normalizers", [])
    cuts = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])
    return (
        [(s["type"], s.get("pattern", {}).get("Regex")) for s in steps] == _NORMALIZER
        and steps[1]["content"] == " "
        and [c["type"] for c in cuts] == ["Split", "ByteLevel"]
        and (cuts[0]["pattern"].get("Regex"), cuts[0]["behavior"], cuts[0]["invert"]) == (_PIECES, "Removed", True)
        and not (cuts[1]["add_prefix_space"] or cuts[1]["use_regex"])
        and spec["model"]["type"] == "BPE"
        and not (spec.get("truncation") or spec.get("padding"))
    )


def _values(strings: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each string of an array without nulls."""
    at, raw = _offsets(strings).tolist(), strings.buffers()[2]
    raw = raw.to_pybytes() if raw else b""
    return [raw[a:b] for a, b in zip(at, at[1:])]


def _offsets(strings: pa.Array) -> np.ndarray:
    return np.frombuffer(strings.buffers()[1], np.int32)[strings.offset : strings.offset + len(strings) + 1] if len(strings) else np.zeros(1, np.int32)


def _tails(strings: pa.Array, lengths: np.ndarray) -> list[bytes]:
    """The last bytes of each string, ``lengths`` of them."""
    ends, raw = _offsets(strings)[1:], strings.buffers()[2]
    raw = raw.to_pybytes() if raw else b""
    return [raw[a:b] for a, b in zip((ends - lengths).tolist(), ends.tolist())]


def _joined(made: list[bytes], at: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """Ids of the pieces at the places ``at`` of a list of packed ids, and the size of each of these pieces."""
    size = np.fromiter(map(len, made), np.int64, len(made)) // 4
    return _taken(pa.array(np.frombuffer(b"".join(made), "<i4")), size, at), size[at]


def _taken(ids: pa.Array, size: np.ndarray, at: np.ndarray) -> pa.Array:
    offsets = pa.array(np.concatenate([[0], np.cumsum(size)]), pa.int64())
    return pa.LargeListArray.from_arrays(offsets, ids).take(pa.array(at)).flatten()


class WordEncoder:
    """Ids of texts, equal to those of the tokenizer's own ``encode``.

    With a tokenizer that ``encodes_by_word``, each distinct word of a slice of
    texts is encoded once: words of Latin letters go to the tokenizer's model
    directly, the punctuation behind them and all other words through its full
    pipeline, and what came out is remembered, of words of Latin letters
    without case and punctuation. Any other tokenizer gets whole texts.
    """

    def __init__(self, path: str, memo_bytes: int = MEMO_BYTES):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.by_word = encodes_by_word(self.tokenizer)
        self.memo_bytes = memo_bytes
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}
        self.used = 0

    def _full(self, word: bytes) -> bytes:
        return _packed(self.tokenizer.encode(word.decode("utf-8", "replace"), add_special_tokens=False).ids)

    def _letters(self, piece: bytes) -> bytes:
        text = piece.decode("ascii") if piece.isascii() else codecs.charmap_decode(piece, "strict", _SHIFTED)[0]
        return _packed([t.id for t in self.model.tokenize(text)])

    def _remembered(self, key: bytes, make) -> bytes:
        ids = self.young.get(key)
        if ids is None:
            ids = self.old.get(key)
            if ids is None:
                ids = make(key)
                if len(key) > MEMO_LONGEST:
                    return ids
            self.young[key] = ids
            self.used += len(key) + len(ids) + _ENTRY_BYTES
            if self.used > self.memo_bytes:
                self.old, self.young, self.used = self.young, {}, 0
        return ids

    def _word(self, word: bytes) -> bytes:
        core = word.rstrip(_PUNCTUATION)
        if core.isascii():
            if not core.isalpha():
                return self._full(word)
            key = core.lower()
        else:
            text = core.decode("utf-8", "replace")
            lower = text.lower()
            if not (lower.isalpha() and max(lower) < "ɐ" and max(text) < "ɐ"):
                return self._full(word)
            key = lower.encode("utf-8")
        if key == word:
            return self._letters(key)
        ids = self._remembered(key, self._letters)
        return ids + self._remembered(word[len(core) :], self._full) if len(core) < len(word) else ids

    def _each(self, words: list[bytes], make) -> list[bytes]:
        found = list(map(self.young.get, words))
        for i, ids in enumerate(found):
            if ids is None:
                found[i] = self._remembered(words[i], make)
        return found

    def words(self, words: list[bytes]) -> list[bytes]:
        """Packed ids of each word; words hold no white space."""
        return self._each(words, self._word)

    def _distinct(self, words: pa.Array, end: int) -> tuple[pa.Array, np.ndarray]:
        """Ids of all words, the id ``end`` as one more, and the number of ids of each."""
        core = pc.ascii_rtrim(words, characters=string.punctuation)
        latin = pc.match_substring_regex(core, _LATIN)
        is_latin = latin.to_numpy(zero_copy_only=False)
        core = core.filter(latin)
        heads = pc.utf8_lower(core).dictionary_encode()
        made = self._each(_values(heads.dictionary), self._letters)
        first, second = np.empty(len(words) + 1, np.int64), np.empty(len(words) + 1, np.int64)
        first[:-1][is_latin] = heads.indices.to_numpy()

        words_of_letters = words.filter(latin)
        length = np.diff(_offsets(words_of_letters)) - np.diff(_offsets(core))
        behind = pa.array(_tails(words_of_letters, length), pa.binary()).dictionary_encode()
        second[:-1][is_latin] = len(made) + behind.indices.to_numpy()
        made += [self._remembered(tail, self._full) if tail else b"" for tail in behind.dictionary.to_pylist()]

        first[:-1][~is_latin] = len(made) + np.arange(len(words) - len(core))
        made += self.words(_values(words.filter(pc.invert(latin))))
        made += [_packed([end]), b""]
        first[-1], second[-1] = len(made) - 2, len(made) - 1
        second[:-1][~is_latin] = len(made) - 1
        ids, size = _joined(made, np.column_stack([first, second]).ravel())
        return ids, size.reshape(-1, 2).sum(axis=1)

    def encode(self, text: bytes) -> bytes:
        """Little-endian unsigned 32-bit ids of one text."""
        return b"".join(self.words(text.split())) if self.by_word else self._full(text)

    def encode_all(self, texts: pa.Array, end: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, each followed by the id ``end``, and the number of ids of each."""
        texts = pc.fill_null(texts.cast(pa.string()), "")
        if self.by_word:
            lists = pc.ascii_split_whitespace(texts)
            ends, words = np.cumsum(pc.list_value_length(lists).to_numpy()), lists.flatten().dictionary_encode()
            ids, size = self._distinct(words.dictionary, end)
            at = words.indices.to_numpy()
        else:
            at = np.arange(len(texts))
            ids, size = _joined([*map(self._full, _values(texts)), _packed([end])], np.arange(len(texts) + 1))
            ends = at + 1
        at = np.insert(at, ends, len(size) - 1)  # the end id is one more word
        written = np.concatenate([[0], np.cumsum(size[at])])[ends + np.arange(1, len(ends) + 1)]
        return _taken(ids, size, at).to_numpy(), np.diff(written, prepend=0)


def _slices(column: pa.Array) -> Iterator[tuple[int, int]]:
    """(start, rows) of slices of about SLICE_BYTES."""
    size = pc.fill_null(pc.binary_length(column), 0).to_numpy().astype(np.int64)
    part, start = (np.cumsum(size) - size) // SLICE_BYTES, 0
    for end in [*(np.flatnonzero(np.diff(part)) + 1).tolist(), len(size)]:
        if end > start:
            yield start, end - start
        start = end


@functools.cache
def _encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


_STORED = "doc_id long, tokens array<int>, n_tokens long, part int, local_start long"


def encoded(docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """(doc_id, tokens, n_tokens, part, local_start) in partitions that are ranges of doc_id."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    schema = _parse_datatype_string(_STORED)
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, start = _encoder(tokenizer), TaskContext.get().partitionId(), 0
        for batch in batches:
            for at, rows in _slices(batch.column("text")):
                piece = batch.slice(at, rows)
                ids, sizes = encoder.encode_all(piece.column("text"), end_id)
                offsets = np.concatenate([[0], np.cumsum(sizes)])
                tokens = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids))
                columns = [
                    piece.column("doc_id"), tokens, pa.array(sizes), pa.array(np.full(rows, part, np.int32)), pa.array(start + offsets[:-1])
                ]
                start += int(offsets[-1])
                yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, arrow)], schema=arrow)

    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn("_tie", F.xxhash64("text"))
    dealt = keyed.repartitionByRange("doc_id", "_tie").sortWithinPartitions("doc_id", "_tie")
    return dealt.select("doc_id", "text").mapInArrow(K.giving_back(run), schema)


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int = 1) -> None:
    """Encode all documents into Parquet files under ``path``."""
    writer = encoded(docs, tokenizer, end_id).write.option("compression", "zstd")
    for name, value in {
        "parquet.writer.version": "v2",
        "parquet.block.size": ROW_GROUP_BYTES,
        "parquet.page.size": PAGE_BYTES,
        "parquet.enable.dictionary": "false",  # delta encoding, but for the ids
        "parquet.enable.dictionary#tokens.list.element": "true",
    }.items():
        writer = writer.option(name, str(value))
    writer.parquet(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, tokens); ``start`` counts the ids of all documents before.

    A filter on doc_id or a choice of columns reaches the files. The window
    sees one row per file; these rows are broadcast after a check of their number.
    """
    stored = spark.read.schema(_STORED).parquet(path)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = stored.groupBy("part").agg(F.sum("n_tokens").alias("_n"))
    parts = parts.select(F.col("part"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    return stored.join(ids_for_join(parts), "part").select(
        "doc_id", (F.col("_before") + F.col("local_start")).alias("start"), "n_tokens", "tokens"
    )


def with_crc32(stored: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32): checksum of each document's ids as little-endian 32-bit integers."""

    def run(batch):
        tokens = batch.column("tokens")
        offsets = tokens.offsets.to_numpy()
        raw = memoryview(tokens.values.to_numpy().astype("<i4", copy=False)).cast("B")
        return {"ids_crc32": [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]}

    return K.map_batches(stored, run, "ids_crc32 long", ("doc_id", "start", "n_tokens"), rows=2048)
