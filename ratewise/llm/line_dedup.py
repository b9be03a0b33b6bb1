"""Lines that many documents share, found with two Bloom filters.

Lines are reduced to a key (stripped of white space at both ends, A-Z
lower-cased) and hashed to 128 bits. A first pass over the texts writes the
keys of each document, a few bytes a line. From them tasks set the bits of two
filters, for keys seen once and keys seen twice; merging is a bitwise union, and
a bit that was set on both sides counts as seen twice. Only keys that the second
filter knows are shuffled, counted exactly by their 128 bits, and get a first
document. The texts are then filtered in place.

Defined results: a null or empty text is one empty line; keys shorter than
``min_chars`` code points are never dropped; each row is a document of its own,
also if rows repeat; an empty table gives no rows; the columns returned are
those named.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratewise.llm import bloom
from ratewise.llm import kernels as K
from ratewise.session import checkpointed

#: Frequent keys that fit a broadcast (24 bytes each); more are joined instead.
BROADCAST_KEYS = 1_000_000


def line_keys(text: bytes | None, min_chars: int = 1):
    """Raw starts and ends of the lines, their two hashes, and whether the key is long enough."""
    data = K.as_bytes(text)
    breaks = np.flatnonzero(data == 0x0A)
    starts, ends = np.concatenate([[0], breaks + 1]), np.concatenate([breaks, [len(data)]])
    solid = np.flatnonzero(~K.SPACE[data])
    first, last = np.searchsorted(solid, starts), np.searchsorted(solid, ends)
    filled = last > first
    a, b = starts.copy(), starts.copy()
    a[filled], b[filled] = solid[first[filled]], solid[last[filled] - 1] + 1
    lower = K.LOWER[data]
    heads = np.concatenate([[0], np.cumsum((lower & 0xC0) != 0x80)])  # code points start outside 0x80-0xBF
    return starts, ends, K.byte_hashes(lower, a, b), K.byte_hashes(lower[::-1].copy(), len(data) - b, len(data) - a), heads[b] - heads[a] >= min_chars


def _keys_table(docs: DataFrame, min_chars: int) -> DataFrame:
    """The distinct keys of each document in parallel arrays, beside its columns other than the text."""

    def run(batch):
        ones, twos = [], []
        for text in K.text_bytes(batch.column("text")):
            _, _, one, two, long = line_keys(text, min_chars)
            _, at = np.unique(one[long], return_index=True)
            ones.append(K.signed(one[long][at]))
            twos.append(K.signed(two[long][at]))
        return {"one": ones, "two": twos}

    kept = tuple(c for c in docs.columns if c != "text")
    return K.map_batches(docs, run, "one array<long>, two array<long>", kept)


def frequent_keys(docs: DataFrame, min_docs: int, min_chars: int = 1, filter_bits: int | None = None) -> DataFrame:
    """(one, two, n_docs, first_doc) of the keys in at least ``min_docs`` >= 2 documents, exact."""
    keys = checkpointed(_keys_table(docs.select("doc_id", "text"), min_chars))
    if filter_bits is None:
        n = keys.agg(F.sum(F.size("one"))).first()[0] or 0
        filter_bits = bloom.filter_bits(n)
    twice = keys.sparkSession.sparkContext.broadcast(bloom.build(keys, "one", filter_bits, "twice"))

    def suspects(batch):
        ones, twos = [], []
        for one, two in zip(batch.column("one"), batch.column("two")):
            one, two = one.values.to_numpy(), two.values.to_numpy()
            hit = twice.value.has(one)
            ones.append(one[hit])
            twos.append(two[hit])
        return {"one": ones, "two": twos}

    found = K.map_batches(keys, suspects, "one array<long>, two array<long>", ("doc_id",), rows=4096)
    pairs = found.select("doc_id", F.inline(F.arrays_zip("one", "two")))
    counted = pairs.groupBy("one", "two").agg(F.count(F.lit(1)).alias("n_docs"), F.min("doc_id").alias("first_doc"))
    return counted.where(F.col("n_docs") >= min_docs)


def drop_lines(
    docs: DataFrame,
    min_docs: int = 10,
    min_chars: int = 1,
    keep_first: bool = False,
    filter_bits: int | None = None,
    broadcast_keys: int = BROADCAST_KEYS,
) -> DataFrame:
    """(doc_id, text, n_lines, n_dropped): texts without the lines that ``min_docs`` documents share.

    With ``keep_first`` the first such line of the document with the smallest
    doc_id stays.
    """
    frequent = checkpointed(frequent_keys(docs, max(2, min_docs), min_chars, filter_bits))
    schema = "text string, n_lines long, n_dropped long"

    def cleaned(text, doc_id, ones, twos, firsts):
        starts, ends, one, two, long = line_keys(text, min_chars)
        one, two = K.signed(one), K.signed(two)
        drop = np.zeros(len(one), bool)
        if len(ones):
            at = np.searchsorted(ones, one)
            while True:  # equal first hashes stand side by side
                inside = at < len(ones)
                same = inside & (ones[np.where(inside, at, 0)] == one)
                hit = same & (twos[np.where(inside, at, 0)] == two)
                if keep_first and doc_id is not None:
                    mine = hit & (firsts[np.where(inside, at, 0)] == doc_id)
                    _, seen = np.unique(one, return_index=True)
                    keep = np.zeros(len(one), bool)
                    keep[seen] = True
                    hit &= ~(mine & keep)
                drop |= hit
                if not (same & ~hit).any():
                    break
                at = np.where(same & ~hit, at + 1, len(ones))
            drop &= long
        if not drop.any():
            return text or b"", len(one), 0
        raw = text or b""
        return b"\n".join([raw[a:b] for a, b, gone in zip(starts, ends, drop) if not gone]), len(one), int(drop.sum())

    def rows(batch, lookup):
        texts, lines, dropped = [], [], []
        for i, (doc_id, text) in enumerate(zip(batch.column("doc_id").to_pylist(), K.text_bytes(batch.column("text")))):
            kept, n, gone = cleaned(text, doc_id, *lookup(i))
            texts.append(kept.decode("utf-8", "surrogatepass"))
            lines.append(n)
            dropped.append(gone)
        return {"text": texts, "n_lines": lines, "n_dropped": dropped}

    docs = docs.select("doc_id", "text")
    if frequent.limit(broadcast_keys + 1).count() <= broadcast_keys:
        table = frequent.select("one", "two", "first_doc").toArrow()
        none = np.iinfo(np.int64).min
        arrays = [table.column(0).to_numpy(), table.column(1).to_numpy(), table.column(2).fill_null(none).to_numpy()]
        order = np.lexsort((arrays[1], arrays[0]))
        shared = docs.sparkSession.sparkContext.broadcast([a[order] for a in arrays])
        return K.map_batches(docs, lambda batch: rows(batch, lambda i: shared.value), schema, ("doc_id",))

    # Too many for a broadcast: each document gets the frequent keys it holds, by a join on the key.
    keyed = docs.withColumn("_row", F.xxhash64("doc_id", "text"))
    own = checkpointed(_keys_table(keyed, min_chars))
    held = (
        own.distinct()
        .select("doc_id", "_row", F.inline(F.arrays_zip("one", "two")))
        .join(frequent, ["one", "two"])
        .groupBy("doc_id", "_row")
        .agg(F.sort_array(F.collect_list(F.struct("one", "two", "first_doc"))).alias("_held"))
        .withColumnRenamed("doc_id", "_doc")
        .withColumnRenamed("_row", "_key")
    )
    joined = keyed.join(held, keyed["doc_id"].eqNullSafe(held["_doc"]) & (keyed["_row"] == held["_key"]), "left")

    def from_row(batch):
        column = batch.column("_held").to_pylist()

        def lookup(i):
            own_rows = column[i] or []
            none = np.iinfo(np.int64).min
            return tuple(np.array([none if r[k] is None else r[k] for r in own_rows], np.int64) for k in ("one", "two", "first_doc"))

        return rows(batch, lookup)

    return K.map_batches(joined.select("doc_id", "text", "_held"), from_row, schema, ("doc_id",))

