"""Near-duplicate documents by an inverted join of MinHash coordinates.

1. Each text becomes its set of distinct word shingles, as 64-bit hashes, an
   identity of 128 bits for the whole set, and ``coordinates`` MinHash values.
   Documents with one set form a class with a number; only its first document,
   by doc_id and a hash of the text, goes on.
2. A class is posted under its (coordinate, value) pairs. Pairs that occur once
   cannot collide and are skipped. Two sets above the threshold agree in at
   least ``matches`` coordinates (but for a chance of MISS), so a class with
   fewer shared pairs is out, and with u of them it need only be posted under
   the u - matches + 1 rarest (prefix filter over one global order): very
   frequent values, as of a passage that many documents quote, are not posted.
3. Classes that meet under a posted pair are tied to the smallest of them, and
   components of these ties are groups of candidates.
4. In each group, sets that agree in ``matches`` coordinates or more are compared
   in full, but for those already linked through others. Groups above
   BLOCK_SHINGLES are cut into blocks that are compared inside and with one
   pivot; what is then not in the largest component of its group meets all
   blocks of the group, so a task holds two blocks at most. Only links that
   join something new are written.
5. Components of the confirmed links give every document its component, named
   after its smallest doc_id. Its first document is kept.

Defined results: a text without words has no shingles and is linked with
nothing; each row is a document of its own, also if a doc_id repeats, and of a
kept document all exact repeats are; a row without doc_id takes no part and
has no component; an empty table gives no rows; only doc_id and text are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratewise.llm import kernels as K
from ratewise.llm.components import components
from ratewise.llm.sizes import BROADCAST_IDS, ids_for_join, text_key
from ratewise.session import checkpointed

COORDINATES = 40
#: Chance that two sets at the threshold agree in fewer coordinates than asked for.
MISS = 1e-7
BLOCK_SHINGLES = 2_000_000

_SEEDS = np.random.default_rng(7).integers(0, 2**63, (2, 256), dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def matches_for(similarity: float, coordinates: int = COORDINATES, miss: float = MISS) -> int:
    """Largest t with P(fewer than t of the coordinates agree) <= miss at this similarity."""
    below, t = 0.0, 0
    while t < coordinates:
        below += math.comb(coordinates, t) * similarity**t * (1 - similarity) ** (coordinates - t)
        if below > miss:
            break
        t += 1
    return max(1, t)


def shingle_set(text: bytes | None, size: int) -> np.ndarray:
    """Sorted distinct hashes of the word shingles; fewer words than ``size`` are one shingle."""
    data, starts, ends = K.space_words(text, lower=True)
    n = len(starts)
    return np.unique(K.gram_hashes(K.byte_hashes(data, starts, ends), min(n, size))) if n else np.zeros(0, np.uint64)


def signature(hashes: np.ndarray, coordinates: int) -> np.ndarray:
    """MinHash value of each coordinate, mixed with its number so that a value tells its coordinate."""
    a, b = _SEEDS[0, :coordinates, None], _SEEDS[1, :coordinates, None]
    least = np.full(coordinates, np.iinfo(np.uint64).max)
    for i in range(0, len(hashes), 1 << 14):
        part = hashes[None, i : i + (1 << 14)] * a
        part ^= part >> np.uint64(32)
        part *= b
        np.minimum(least, part.min(axis=1), out=least)
    return K.mixed(least + _SEEDS[1, :coordinates])


def fingerprints(docs: DataFrame, size: int, coordinates: int) -> DataFrame:
    """(doc_id, text_key, n_shingles, one, two, signature) of every document."""

    def run(batch):
        out = {"n_shingles": [], "one": [], "two": [], "signature": []}
        for text in K.text_bytes(batch.column("text")):
            hashes = shingle_set(text, size)
            n = len(hashes)
            ends = (np.array([0]), np.array([n]))
            out["n_shingles"].append(n)
            out["one"].append(int(K.signed(K.rolling(hashes, *ends))[0]))
            out["two"].append(int(K.signed(K.rolling(K.mixed(hashes), *ends))[0]))
            out["signature"].append(K.signed(signature(hashes, coordinates)) if n else None)
        return out

    return K.map_batches(
        docs.select("doc_id", "text", text_key().alias("text_key")),
        run,
        "n_shingles long, one long, two long, signature array<long>",
        ("doc_id", "text_key"),
    )


def candidate_groups(classes: DataFrame, matches: int) -> DataFrame:
    """(node, component): classes that may be linked, by group of candidates.

    ``classes`` has (rep, signature), one row per distinct set.
    """
    posts = classes.select("rep", F.explode("signature").alias("element"))
    shared = posts.groupBy("element").agg(F.count(F.lit(1)).alias("df")).where(F.col("df") > 1)
    by_rep = (
        posts.join(shared, "element")
        .groupBy("rep")
        .agg(F.sort_array(F.collect_list(F.struct("df", "element"))).alias("shared"))
        .where(F.size("shared") >= matches)
    )
    prefix = F.slice("shared", 1, F.size("shared") - (matches - 1))
    posted = checkpointed(by_rep.select("rep", F.explode(F.transform(prefix, lambda s: s["element"])).alias("element")))
    least = posted.groupBy("element").agg(F.min("rep").alias("least"))
    ties = posted.join(least, "element").where(F.col("rep") != F.col("least"))
    return components(ties.select(F.col("rep").alias("a"), F.col("least").alias("b")))


class _Linker:
    """Links among sets of one task: exact comparison, skipping what is already connected."""

    def __init__(self, similarity: float, matches: int, coordinates: int):
        self.percent = round(similarity * 100)
        self.matches, self.coordinates = matches, coordinates

    def links(self, reps, sets, labels, rows) -> list[tuple[int, int]]:
        """Confirmed links that join different labels; ``rows`` are compared with all sets."""
        n = len(reps)
        if n < 2:
            return []
        sizes = np.array([len(s) for s in sets])
        signs = np.stack([signature(s, self.coordinates) for s in sets])
        ids = np.unique(np.concatenate(sets), return_inverse=True)[1]
        ends = np.cumsum(sizes)
        starts = ends - sizes
        marked = np.zeros(ids.max() + 1, np.int32)
        made = []
        todo = np.zeros(n, bool)
        todo[rows] = True
        always = ~todo
        for i in rows:
            # Rows compared before this one have met it already.
            todo[i] = False
            others = np.flatnonzero((labels != labels[i]) & (todo | always))
            if not len(others):
                continue
            others = others[(signs[others] == signs[i]).sum(axis=1) >= self.matches]
            # |A & B| / |A | B| >= s needs the smaller set to reach s times the larger.
            others = others[100 * np.minimum(sizes[others], sizes[i]) >= self.percent * np.maximum(sizes[others], sizes[i])]
            mine = ids[starts[i] : ends[i]]
            marked[mine] = 1
            for j in others:
                if labels[j] == labels[i]:
                    continue
                both = int(marked[ids[starts[j] : ends[j]]].sum())
                if 100 * both >= self.percent * (sizes[i] + sizes[j] - both):
                    made.append((int(reps[i]), int(reps[j])))
                    labels[labels == labels[j]] = labels[i]
            marked[mine] = 0
        return made


_LINKS = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _grouped(batches: Iterator[pa.RecordBatch], key: list[str]) -> Iterator[list[dict]]:
    """Rows of one key at a time, from batches sorted by it."""
    held, current = [], None
    for batch in batches:
        names = batch.schema.names
        columns = [batch.column(i) if pa.types.is_list(batch.schema.field(i).type) else batch.column(i).to_pylist() for i in range(len(names))]
        for row in zip(*columns):
            row = dict(zip(names, row))
            at = tuple(row[k] for k in key)
            if at != current and held:
                yield held
                held = []
            current = at
            held.append(row)
    if held:
        yield held


def confirmed_links(sets: DataFrame, similarity: float, matches: int, coordinates: int, block_shingles: int) -> DataFrame:
    """(a, b): links that connect what is truly linked in each group of (grp, rep, hashes)."""
    linker = _Linker(similarity, matches, coordinates)

    def run(batches):
        for rows in _grouped(batches, ["grp", "i", "j"]):
            seen, unique, numbers = set(), [], {}
            for row in rows:
                hashes = row["hashes"].values.to_numpy().view(np.uint64)
                mark = (row["rep"], hashes.tobytes())
                if mark not in seen:
                    seen.add(mark)
                    unique.append((row["rep"], row["outside"], numbers.setdefault(row["label"], len(numbers)), hashes))
            reps, outside, labels = (np.array([u[k] for u in unique]) for k in range(3))
            made = linker.links(reps, [u[3] for u in unique], labels, np.flatnonzero(outside))
            if made:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*made)], schema=_LINKS)

    def deal(rows):
        # Outsiders come first: a set that is both stays one.
        sorted_rows = rows.repartition("grp", "i", "j").sortWithinPartitions("grp", "i", "j", F.desc("outside"), "rep")
        return sorted_rows.select("grp", "i", "j", "rep", "label", "outside", "hashes").mapInArrow(run, "a long, b long")

    size = sets.groupBy("grp").agg(F.sum(F.size("hashes")).alias("total"), F.min("rep").alias("pivot"))
    size = checkpointed(size.withColumn("blocks", F.ceil(F.col("total") / F.lit(block_shingles)).cast("int")))
    fresh = sets.join(size, "grp").withColumns({"label": F.col("rep"), "outside": F.lit(True)})
    zero = F.lit(0)
    links = deal(fresh.where(F.col("blocks") <= 1).withColumns({"i": zero, "j": zero}))
    if size.where(F.col("blocks") > 1).limit(1).count() == 0:
        return links

    # Each block on its own, and with the pivot, which ties the blocks together.
    big = fresh.where(F.col("blocks") > 1).withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    guests = big.where(F.col("rep") == F.col("pivot")).withColumn("i", every("blocks"))
    inside = checkpointed(deal(big.withColumn("i", F.col("block")).unionByName(guests).withColumn("j", zero)))

    # What is not in the largest component of its group so far meets all blocks of the group.
    known = components(inside).withColumnsRenamed({"node": "rep", "component": "_label"})
    labelled = checkpointed(
        big.drop("label", "outside").join(known, "rep", "left").withColumn("label", F.coalesce("_label", "rep")).drop("_label")
    )
    counts = labelled.groupBy("grp", "label").agg(F.count(F.lit(1)).alias("n"))
    main = counts.groupBy("grp").agg(F.max(F.struct("n", "label"))["label"].alias("_main"))
    placed = labelled.join(main, "grp").withColumn("outside", F.col("label") != F.col("_main"))
    tasks = placed.where("outside").groupBy("grp").agg(F.ceil(F.sum(F.size("hashes")) / F.lit(block_shingles)).cast("int").alias("tasks"))
    placed = placed.join(tasks, "grp")
    mine = placed.where("outside").withColumn("i", F.pmod(F.xxhash64("rep"), F.col("tasks")).cast("int")).withColumn("j", every("blocks"))
    theirs = placed.withColumns({"i": every("tasks"), "j": F.col("block"), "outside": F.lit(False)})
    return links.unionByName(inside).unionByName(deal(mine.unionByName(theirs)))


def _judged(
    docs: DataFrame,
    shingle: int = 5,
    similarity: float = 0.8,
    coordinates: int = COORDINATES,
    block_shingles: int = BLOCK_SHINGLES,
    broadcast_ids: int = BROADCAST_IDS,
) -> DataFrame:
    """(doc_id, text_key, n_shingles, component_id, kept) of every document."""
    matches = matches_for(similarity, coordinates)
    prints = checkpointed(fingerprints(docs, shingle, coordinates))
    filled = prints.where((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull())
    first = F.min(F.struct("doc_id", "text_key")).alias("first")
    classes = filled.groupBy("one", "two", "n_shingles").agg(first, F.any_value("signature").alias("signature"))
    # Numbers, as two classes may have one doc_id.
    classes = checkpointed(classes.withColumn("rep", F.monotonically_increasing_id()))
    groups = candidate_groups(classes, matches)
    members = groups.join(classes, groups["node"] == classes["rep"]).select(
        F.col("first.doc_id").alias("doc_id"), F.col("first.text_key").alias("_key"), "rep", F.col("component").alias("grp")
    )
    # These rows are some four times as wide as an id.
    ids = ids_for_join(members, broadcast_ids // 4)

    def sets_of(batch):
        return {"hashes": [K.signed(shingle_set(t, shingle)) for t in K.text_bytes(batch.column("text"))]}

    keyed = docs.select("doc_id", "text", text_key().alias("_key"))
    texts = keyed.join(ids, ["doc_id", "_key"]).select("rep", "grp", "text")
    sets = K.map_batches(texts, sets_of, "hashes array<long>", ("rep", "grp")).where(F.size("hashes") > 0)
    found = components(confirmed_links(checkpointed(sets), similarity, matches, coordinates, block_shingles))
    linked = checkpointed(found.join(classes.select("rep", "first"), found["node"] == F.col("rep")).select("rep", "component", "first"))
    heads = linked.groupBy("component").agg(F.min("first").alias("head"))
    placed = classes.join(linked.select("rep", "component").join(heads, "component"), "rep", "left").select(
        "one", "two", "n_shingles", F.coalesce("head", "first").alias("head")
    )
    joined = filled.select("doc_id", "text_key", "one", "two", "n_shingles").join(placed, ["one", "two", "n_shingles"])
    judged = joined.select(
        "doc_id",
        "text_key",
        "n_shingles",
        F.col("head.doc_id").alias("component_id"),
        (F.struct("doc_id", "text_key") == F.col("head")).alias("kept"),
    )
    alone = prints.where((F.col("n_shingles") == 0) | F.col("doc_id").isNull()).select(
        "doc_id", "text_key", "n_shingles", F.col("doc_id").alias("component_id"), F.lit(True).alias("kept")
    )
    return judged.unionByName(alone)


def near_duplicates(docs: DataFrame, shingle: int = 5, similarity: float = 0.8, **options) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every document."""
    return _judged(docs, shingle, similarity, **options).drop("text_key")


def deduplicated(docs: DataFrame, **options) -> DataFrame:
    """The documents that stand for their component, with all their columns.

    Each row is judged by its own text. Of exact repeats of a row's id and text
    one stays; only those repeats are shuffled.
    """
    result = checkpointed(_judged(docs, **options).select("doc_id", "text_key", "kept"))
    named = lambda rows, name: rows.select(F.col("doc_id").alias(f"_{name}"), F.col("text_key").alias(f"_{name}_text"))
    gone = ids_for_join(named(result.where(~F.col("kept")), "gone").distinct())
    repeats = result.where(F.col("kept")).groupBy("doc_id", "text_key").count().where((F.col("count") > 1) & F.col("doc_id").isNotNull())
    again = ids_for_join(named(repeats, "again"))
    same = lambda name: (docs["doc_id"] == F.col(f"_{name}")) & (text_key() == F.col(f"_{name}_text"))
    left = docs.join(gone, same("gone"), "left_anti")
    once = left.join(again, same("again"), "left_anti")
    more = left.join(again, same("again"), "left_semi").dropDuplicates(["doc_id", "text"])
    return once.unionByName(more)
