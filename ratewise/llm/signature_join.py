"""Exact Jaccard join of word n-gram sets with signature trees.

1. Each text becomes its set of distinct word shingles, as 64-bit hashes, with
   an identity of 128 bits. Documents with one set form a class; its first
   document, by doc_id and a hash of the text, stands for it.
2. Linked sets of a and b shingles differ in at most d = (a + b)(1 - s) / (1 + s)
   of them. The hash range is cut into d + m parts, so m parts at least hold the same
   shingles in both sets; each set leaves out its m - 1 smallest parts, and one equal
   part remains in both. Cuts follow the band of sizes of the smaller set, and a set
   that can have a partner in the band below is cut that way too. Classes that share
   the hash of a part are tied to the smallest of them; components of ties are groups
   of candidates. No linked pair is missed.
3. The sets of a group are leaves of a signature tree: a leaf has a bitmap of its
   shingles that others of the task hold too, an inner node the OR of its
   children with the range of their sizes. A dual traversal from (root, root)
   drops a pair of nodes if their sizes are too far apart, if the common bits
   cannot reach the least overlap, or if all below them is linked already. Pairs of
   leaves that remain are confirmed on the full sets.
4. Groups above ``block_shingles`` are cut into blocks, each with a tree of its own and
   the group's first set in all of them. What is then outside the group's largest
   component meets, as a second tree, those blocks that share a part with it.
5. Components of the links give each document the smallest doc_id it reaches.

Defined results: a text without words has no shingles and is linked with
nothing; fewer words than a shingle has are one shingle; each row is a document
of its own, also if a doc_id repeats; a row without doc_id takes no part and has
no component; an empty table gives no rows; only doc_id and text are read.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratewise.llm import kernels as K
from ratewise.llm.components import components
from ratewise.llm.sizes import ids_for_join, text_key
from ratewise.session import checkpointed

FANOUT = 8
#: Bits of a leaf at most, and bytes of all leaves of a tree.
MOST_BITS, TREE_BYTES = 1 << 14, 64 << 20
BLOCK_SHINGLES = 500_000
#: Rows of some 40 bytes that may be broadcast.
BROADCAST_ROWS = 250_000
#: Largest to smallest size in a band, in steps of the threshold.
BAND_STEPS = 4
#: One more part, to be left out, for so many differences.
SPARE_PARTS = 2
_ODD = np.uint64(0x9E3779B97F4A7C15)


def shingle_set(text: bytes | None, size: int) -> np.ndarray:
    """Sorted distinct hashes of the word shingles; fewer words than ``size`` are one shingle."""
    data, starts, ends = K.space_words(text, lower=True)
    n = len(starts)
    return np.unique(K.gram_hashes(K.byte_hashes(data, starts, ends), min(n, size))) if n else np.zeros(0, np.uint64)


# --- parts that linked sets share --------------------------------------------------------


def least_overlap(a, b, percent: int):
    """Fewest common members with which sets of ``a`` and ``b`` members are linked."""
    return -(-percent * (a + b) // (100 + percent))


@functools.cache
def band(size: int, percent: int) -> tuple[int, int]:
    """Least and greatest size of the band that holds ``size``."""
    low = 1
    while True:
        high = low
        for _ in range(BAND_STEPS):
            high = 100 * high // percent
        if size <= high:
            return low, high
        low = high + 1


@functools.cache
def most_different(high: int, percent: int) -> int:
    """How many members linked sets may differ in, if the smaller has at most ``high``."""
    return (high + 100 * high // percent) * (100 - percent) // (100 + percent)


def part_keys(hashes: np.ndarray, percent: int) -> np.ndarray:
    """Hashes of parts of a set, under the cuts of its band and of the one below if a partner may lie there.

    With d differences and d + m parts, linked sets have m equal parts. Each
    leaves out its m - 1 parts of fewest members, the first of equals: the largest
    of the equal parts stays in both. Small parts would tie sets that are not alike.
    """
    size, found = len(hashes), []
    low, high = band(size, percent)
    cuts = [high]
    if low > 1 and 100 * (low - 1) >= percent * size:
        cuts.append(low - 1)
    for top in cuts:
        differ = most_different(top, percent)
        if differ == 0:  # only equal sets are linked, and these are one class
            continue
        parts = differ + 1 + differ // SPARE_PARTS
        step = (1 << 64) // parts + 1
        bounds = np.arange(1, parts, dtype=np.uint64) * np.uint64(step)
        at = np.concatenate([[0], np.searchsorted(hashes, bounds), [size]])
        kept = np.sort(np.argsort(np.diff(at), kind="stable")[parts - differ - 1 :])
        name = (kept.astype(np.uint64) + np.uint64(top << 32)) * _ODD
        found.append(K.mixed(K.rolling(hashes, at[kept], at[kept + 1]) + name))
    return np.concatenate(found) if found else np.zeros(0, np.uint64)


def fingerprints(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """(doc_id, text_key, n_shingles, one, two, parts) of every document."""

    def run(batch):
        out = {"n_shingles": [], "one": [], "two": [], "parts": []}
        for text in K.text_bytes(batch.column("text")):
            hashes = shingle_set(text, size)
            n = len(hashes)
            ends = (np.array([0]), np.array([n]))
            out["n_shingles"].append(n)
            out["one"].append(int(K.signed(K.rolling(hashes, *ends))[0]))
            out["two"].append(int(K.signed(K.rolling(K.mixed(hashes), *ends))[0]))
            out["parts"].append(K.signed(part_keys(hashes, percent)) if n else None)
        return out

    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", text_key().alias("text_key"))
    return K.map_batches(keyed, run, "n_shingles long, one long, two long, parts array<long>", ("doc_id", "text_key"))


def candidate_groups(posts: DataFrame) -> DataFrame:
    """(node, component): classes that may be linked, by group; ``posts`` has (rep, part).

    Parts are counted by partial sums. A part of two classes ties them at once;
    only parts of more are joined with the posts again.
    """
    shared = posts.groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.min("rep").alias("low"), F.max("rep").alias("high"))
    shared = checkpointed(shared.where(F.col("n") > 1))
    pairs = shared.where(F.col("n") == 2).select(F.col("high").alias("a"), F.col("low").alias("b"))
    more = ids_for_join(shared.where(F.col("n") > 2).select("part", "low"))
    ties = posts.join(more, "part").where(F.col("rep") != F.col("low")).select(F.col("rep").alias("a"), F.col("low").alias("b"))
    return components(pairs.unionByName(ties).distinct())


# --- signature trees ----------------------------------------------------------------------


class Linked:
    """Which sets are known to be connected."""

    def __init__(self, labels):
        first: dict = {}
        self.root = [first.setdefault(label, i) for i, label in enumerate(labels)]

    def find(self, i: int) -> int:
        while self.root[i] != i:
            self.root[i] = self.root[self.root[i]]
            i = self.root[i]
        return i

    def join(self, i: int, j: int) -> None:
        a, b = self.find(i), self.find(j)
        self.root[max(a, b)] = min(a, b)


class SignatureTree:
    """Bitmaps and size ranges over some sets; ``at`` holds their numbers in the order of the leaves.

    Similar sets have the same least hashes, so in this order they are near each other.
    """

    def __init__(self, at: np.ndarray, bits: np.ndarray, sizes: np.ndarray, spare: np.ndarray):
        self.at = at
        self.levels = [(bits[at], sizes[at], sizes[at], spare[at])]
        while len(self.levels[-1][0]) > 1:
            below, low, high, more = self.levels[-1]
            edges = np.arange(0, len(below), FANOUT)
            self.levels.append(
                (
                    np.bitwise_or.reduceat(below, edges, axis=0),
                    np.minimum.reduceat(low, edges),
                    np.maximum.reduceat(high, edges),
                    np.maximum.reduceat(more, edges),
                )
            )
        self.uniform = [{} for _ in self.levels]

    def one_component(self, level: int, node: int, linked: Linked) -> int:
        """The component that holds all below a node, or -1. What was one stays one."""
        if level == 0:
            return linked.find(int(self.at[node]))
        known = self.uniform[level].get(node)
        if known is not None:
            return linked.find(known)
        children = range(node * FANOUT, min((node + 1) * FANOUT, len(self.levels[level - 1][0])))
        first = self.one_component(level - 1, children[0], linked)
        if first < 0 or any(self.one_component(level - 1, c, linked) != first for c in children[1:]):
            return -1
        self.uniform[level][node] = first
        return first

    def children(self, level: int, node: int) -> tuple[int, slice]:
        if level == 0:
            return 0, slice(node, node + 1)
        return level - 1, slice(node * FANOUT, min((node + 1) * FANOUT, len(self.levels[level - 1][0])))


def _bitmaps(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, bool]:
    """(bits, spare, exact): a bitmap for each set of its members that occur in several sets.

    ``spare`` is how many such members have no bit of their own; if all have one, common bits are the overlap.
    """
    members, ids, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    several = counts > 1
    numbers = np.cumsum(several) - 1
    most = max(64, min(MOST_BITS, 8 * TREE_BYTES // len(sets)) // 64 * 64)
    vocabulary = int(several.sum())
    width = min(most, max(64, -(-vocabulary // 64) * 64))
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    shared = several[ids]
    place, owner = numbers[ids[shared]] % width, owner[shared]
    bits = np.zeros((len(sets), width // 64), np.uint64)
    np.bitwise_or.at(bits, (owner, place // 64), np.uint64(1) << (place % 64).astype(np.uint64))
    spare = np.bincount(owner, minlength=len(sets)) - np.bitwise_count(bits).sum(axis=1, dtype=np.int64)
    return bits, spare, vocabulary <= width


def links(sets: list[np.ndarray], labels: list, outside: np.ndarray, percent: int) -> Iterator[tuple[int, int]]:
    """Links (i, j) that connect what is truly linked, and known already by ``labels``.

    Sets outside are joined with all; without any, all sets are joined with each other.
    """
    if len(sets) < 2:
        return
    bits, spare, exact = _bitmaps(sets)
    sizes = np.array([len(s) for s in sets])
    order = sorted(range(len(sets)), key=lambda i: tuple(sets[i][:2]))
    linked = Linked(labels)
    tree = SignatureTree(np.array(order), bits, sizes, spare)
    other = tree
    if outside.any():
        other = SignatureTree(np.array([i for i in order if outside[i]]), bits, sizes, spare)
    stack = [(len(tree.levels) - 1, 0, len(other.levels) - 1, 0)]
    while stack:
        x, i, y, j = stack.pop()
        if x == 0 and y == 0:
            a, b = int(tree.at[i]), int(other.at[j])
            if linked.find(a) != linked.find(b) and (exact or _linked(sets[a], sets[b], percent)):
                linked.join(a, b)
                yield a, b
            continue
        here = tree.one_component(x, i, linked)
        if here >= 0 and here == other.one_component(y, j, linked):
            continue
        # The taller tree is opened first; trees of one height are opened together.
        (x2, xs) = tree.children(x, i) if x >= y else (x, slice(i, i + 1))
        (y2, ys) = other.children(y, j) if y >= x else (y, slice(j, j + 1))
        p, q = tree.levels[x2], other.levels[y2]
        common = np.bitwise_count(p[0][xs, None, :] & q[0][None, ys, :]).sum(axis=2, dtype=np.int64)
        low, high = (p[1][xs, None], q[1][None, ys]), (p[2][xs, None], q[2][None, ys])
        most = np.minimum(common + np.minimum(p[3][xs, None], q[3][None, ys]), np.minimum(*high))
        open_ = (most >= least_overlap(*low, percent)) & (100 * high[0] >= percent * low[1]) & (100 * high[1] >= percent * low[0])
        rows, columns = (k.tolist() for k in np.nonzero(open_))
        pairs = [(x2, r + xs.start, y2, c + ys.start) for r, c in zip(rows, columns)]
        if tree is other and x2 == y2:
            pairs = [k for k in pairs if k[1] < k[3] or (k[1] == k[3] and x2)]
            pairs.sort(key=lambda k: k[3] - k[1], reverse=True)  # neighbours are opened first
        stack += pairs


def _linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


# --- groups and blocks ----------------------------------------------------------------------

_KEY = ("grp", "block", "chunk")


def _deal(sets: DataFrame, placed: DataFrame, percent: int) -> DataFrame:
    """(a, b): links within each (grp, block, chunk) of ``placed``, rows with rep, label and outside.

    Only here the sets themselves move, once if ``placed`` can be broadcast.
    """
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def found(held: dict):
        reps = list(held)
        labels, outside, sets = zip(*held.values())
        made = [(reps[i], reps[j]) for i, j in links(list(sets), labels, np.array(outside), percent)]
        return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (zip(*made) if made else ([], []))], schema=schema)

    def run(batches):
        current, held = None, {}
        for batch in batches:
            names = [batch.column(name).to_pylist() for name in (*_KEY, "rep", "label", "outside")]
            hashes = batch.column("hashes")
            flat, ends = hashes.values.to_numpy().view(np.uint64), hashes.offsets.to_numpy()
            for k, (*key, rep, label, outside) in enumerate(zip(*names)):
                if key != current:
                    if held:
                        yield found(held)
                    current, held = key, {}
                if rep not in held or outside:
                    held[rep] = (label, outside, flat[ends[k] : ends[k + 1]].copy())
        if held:
            yield found(held)

    narrow = ids_for_join(placed.select(*_KEY, "rep", "label", "outside"), BROADCAST_ROWS)
    rows = sets.join(narrow, "rep").select(*_KEY, "rep", "label", "outside", "hashes")
    dealt = rows.repartition(*_KEY).sortWithinPartitions(*_KEY)
    return dealt.mapInArrow(run, "a long, b long")


def confirmed_links(sets: DataFrame, members: DataFrame, posts: DataFrame, percent: int, block_shingles: int) -> DataFrame:
    """(a, b): links that connect what is truly linked in each group.

    ``sets`` has (rep, hashes), ``members`` (rep, grp, n_shingles), ``posts`` (rep, part).
    """
    zero = F.lit(0)
    size = members.groupBy("grp").agg(F.sum("n_shingles").alias("total"), F.min("rep").alias("pivot"))
    blocks = F.ceil(F.col("total") / F.lit(block_shingles)).cast("int").alias("blocks")
    placed = members.join(size.select("grp", "pivot", blocks), "grp")
    placed = checkpointed(placed.withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")))

    # Each block on its own, with the first set of the group, which ties the blocks together.
    every = F.explode(F.sequence(zero, F.col("blocks") - 1))
    guests = placed.where((F.col("blocks") > 1) & (F.col("rep") == F.col("pivot"))).withColumn("block", every)
    alone = placed.unionByName(guests).withColumns({"label": F.col("rep"), "outside": F.lit(False), "chunk": zero})
    inside = checkpointed(_deal(sets, alone, percent))
    big = placed.where(F.col("blocks") > 1)
    if big.limit(1).count() == 0:
        return inside

    # What is not in the largest component of its group meets the blocks that share a part with it.
    known = components(inside).withColumnsRenamed({"node": "rep", "component": "_label"})
    labelled = big.join(known, "rep", "left").withColumn("label", F.coalesce("_label", "rep")).drop("_label")
    counts = labelled.groupBy("grp", "label").agg(F.count(F.lit(1)).alias("n"))
    main = counts.groupBy("grp").agg(F.max(F.struct("n", "label"))["label"].alias("main"))
    labelled = checkpointed(labelled.join(main, "grp").withColumn("outside", F.col("label") != F.col("main")))
    posted = posts.join(ids_for_join(labelled.select("rep", "grp", "block", "outside"), BROADCAST_ROWS), "rep")
    guests = checkpointed(posted.where("outside").select("grp", "part", "rep"))
    asked = ids_for_join(guests.select("part").distinct())
    hosts = posted.join(asked, "part").select("grp", "part", "block").distinct()
    meets = guests.join(hosts, ["grp", "part"]).select("rep", F.col("block").alias("host")).distinct()
    sent = checkpointed(labelled.where("outside").join(meets, "rep").withColumn("block", F.col("host")).drop("host"))
    chunks = sent.groupBy("grp", "block").agg(F.ceil(F.sum("n_shingles") / F.lit(block_shingles)).cast("int").alias("chunks"))
    sent = sent.join(chunks, ["grp", "block"]).withColumn("chunk", F.pmod(F.xxhash64("rep"), F.col("chunks")).cast("int"))
    met = labelled.join(chunks, ["grp", "block"]).withColumn("chunk", F.explode(F.sequence(zero, F.col("chunks") - 1)))
    across = sent.unionByName(met.withColumn("outside", F.lit(False)))
    return inside.unionByName(_deal(sets, across, percent))


def jaccard_components(
    docs: DataFrame, shingle: int = 5, similarity: float = 0.8, block_shingles: int = BLOCK_SHINGLES
) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every document."""
    percent = round(100 * similarity)
    prints = checkpointed(fingerprints(docs, shingle, percent))
    filled = prints.where((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull())
    first = F.min(F.struct("doc_id", "text_key")).alias("first")
    classes = filled.groupBy("one", "two", "n_shingles").agg(first, F.any_value("parts").alias("parts"))
    # Numbers, as two classes may have one doc_id.
    classes = checkpointed(classes.withColumn("rep", F.monotonically_increasing_id()))
    posts = classes.select("rep", F.explode("parts").alias("part"))
    groups = candidate_groups(posts)
    members = groups.join(classes, groups["node"] == classes["rep"]).select(
        F.col("first.doc_id").alias("_id"), F.col("first.text_key").alias("_key"), "rep", F.col("component").alias("grp"), "n_shingles"
    )
    members = checkpointed(members)
    named = ids_for_join(members.select("_id", "_key", "rep"), BROADCAST_ROWS)

    def sets_of(batch):
        return {"hashes": [K.signed(shingle_set(t, shingle)) for t in K.text_bytes(batch.column("text"))]}

    keyed = docs.select(F.col("doc_id").cast("long").alias("_id"), "text", text_key().alias("_key"))
    texts = keyed.join(named, ["_id", "_key"]).select("rep", "text")
    sets = checkpointed(K.map_batches(texts, sets_of, "hashes array<long>", ("rep",)))
    members = members.select("rep", "grp", "n_shingles")
    found = components(confirmed_links(sets, members, posts, percent, block_shingles))
    linked = checkpointed(found.join(classes.select("rep", "first"), found["node"] == F.col("rep")).select("rep", "component", "first"))
    heads = linked.groupBy("component").agg(F.min("first.doc_id").alias("head"))
    placed = classes.select("rep", "one", "two", "n_shingles", "first").join(
        linked.select("rep", "component").join(heads, "component"), "rep", "left"
    )
    placed = placed.select("one", "two", "n_shingles", F.coalesce("head", "first.doc_id").alias("component_id"))
    judged = filled.join(placed, ["one", "two", "n_shingles"]).select("doc_id", "n_shingles", "component_id")
    alone = prints.where((F.col("n_shingles") == 0) | F.col("doc_id").isNull())
    return judged.unionByName(alone.select("doc_id", "n_shingles", F.col("doc_id").alias("component_id")))
