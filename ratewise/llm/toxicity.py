"""Toxicity scores: boosted trees over dense text features, calibrated by isotonic regression.

A bounded, seeded sample of labelled documents (``sample`` rows) is the only
thing the model is fitted on. From it comes a weighted lexicon of words and word
beginnings, by a log-likelihood ratio test, counted by Spark. The trees see, per
text: densities of that lexicon and of a fixed one, their closeness to
second-person words, capitals, punctuation and obfuscation rates. For training,
a text's lexicon features come from the half of the sample it is not in. One
quarter of the sample calibrates the trees. All texts are then scored whole.

Defined results: a null or empty text is scored like any other, with all rates
0; documents without a label are scored too; labels that are null are ignored,
and of several labels of one doc_id the largest counts; with fewer than
MIN_CLASS examples of either class all scores are the smoothed share of toxic
labels; rows that repeat get equal scores; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratewise.llm import kernels as K
from ratewise.session import checkpointed

SAMPLE = 16_000
LEXICON = 20_000
MIN_CLASS = 12
_PREFIXES = range(3, 10)
_NEAR = 5

# Common insults and second-person words, matched as whole words.
INSULTS = (
    "idiot idiots stupid moron morons trash garbage pathetic disgusting worthless clown loser losers scum dumb fool "
    "ugly filthy vermin pig hate shut kill die imbecile jerk"
).split()
SECOND_PERSON = (
    "you your yours yourself u ur du dich dir dein deine deinen euch euer tu te toi ton ta tes vous votre vos "
    "ti tuyo usted ustedes vosotros os"
).split()

FEATURES = (
    "learned_density learned_count learned_max learned_sum learned_mean insult_density insult_count near_second_person "
    "second_person upper_letters upper_words exclamations questions symbols punctuation_runs digits_in_words "
    "symbols_in_words spaced_letters word_length log_words"
).split()


def _hashes_of(words) -> np.ndarray:
    out = []
    for word in words:
        data = np.frombuffer(word.encode(), np.uint8)
        out.append(K.byte_hashes(data, np.array([0]), np.array([len(data)]))[0])
    return np.sort(np.array(out, np.uint64))


def _among(values: np.ndarray, table: np.ndarray) -> np.ndarray:
    at = np.searchsorted(table, values)
    return table[np.minimum(at, len(table) - 1)] == values if len(table) else np.zeros(len(values), bool)


_INSULTS, _SECOND = _hashes_of(INSULTS), _hashes_of(SECOND_PERSON)
_UPPER = np.zeros(256, bool)
_UPPER[0x41:0x5B] = True
_LETTER = K.ALNUM.copy()
_LETTER[0x30:0x3A] = False
_DIGIT = np.zeros(256, bool)
_DIGIT[0x30:0x3A] = True
_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "*$@#%&_+!|"]] = True


def _keys(lower: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of the whole word and of its beginnings, one row per word; 0 where it is too short."""
    out = np.zeros((len(starts), len(_PREFIXES) + 1), np.uint64)
    out[:, 0] = K.byte_hashes(lower, starts, ends)
    for i, size in enumerate(_PREFIXES, 1):
        long = ends - starts > size
        out[long, i] = K.byte_hashes(lower, starts[long], starts[long] + size)
    return out


class Lexicon:
    """Sorted key hashes with weights; a bit table rejects most words at once."""

    def __init__(self, keys: np.ndarray, weights: np.ndarray):
        order = np.argsort(keys)
        self.keys, self.weights = keys[order], weights[order]
        self.bits = np.zeros(1 << 18, bool)
        self.bits[(self.keys & np.uint64(0x3FFFF)).astype(np.int64)] = True

    def weigh(self, keys: np.ndarray) -> np.ndarray:
        """Largest weight of each word's keys, 0 without a match."""
        out = np.zeros(len(keys))
        if not len(self.keys) or not len(keys):
            return out
        rows, columns = np.nonzero(self.bits[(keys & np.uint64(0x3FFFF)).astype(np.int64)])
        found = keys[rows, columns]
        at = np.minimum(np.searchsorted(self.keys, found), len(self.keys) - 1)
        np.maximum.at(out, rows, np.where(self.keys[at] == found, self.weights[at], 0.0))
        return out


def text_features(text: bytes | None, lexicon: Lexicon) -> np.ndarray:
    data = K.as_bytes(text)
    starts, ends = K.spans(K.ALNUM[data])
    out, n = np.zeros(len(FEATURES)), len(starts)
    if not n:
        return out
    lower = K.LOWER[data]
    keys = _keys(lower, starts, ends)
    weight = lexicon.weigh(keys)
    learned, insult, second = weight > 0, _among(keys[:, 0], _INSULTS), _among(keys[:, 0], _SECOND)
    marked, persons = np.flatnonzero(learned | insult), np.flatnonzero(second)
    near = 0
    if len(marked) and len(persons):
        at = np.searchsorted(persons, marked)
        left = marked - persons[np.maximum(at - 1, 0)]
        right = persons[np.minimum(at, len(persons) - 1)] - marked
        near = int(((np.abs(left) <= _NEAR) | (np.abs(right) <= _NEAR)).sum())
    count = lambda flags: np.concatenate([[0], np.cumsum(flags)])
    uppers, letters, digits = (count(table[data]) for table in (_UPPER, _LETTER, _DIGIT))
    lengths = ends - starts
    all_upper = (uppers[ends] - uppers[starts] == lengths) & (lengths > 1)
    digit_words = (digits[ends] > digits[starts]) & (letters[ends] > letters[starts])
    between = _LETTER[data[:-2]] & _SYMBOL[data[1:-1]] & _LETTER[data[2:]] if len(data) > 2 else np.zeros(0, bool)
    other = ~K.ALNUM[data] & ~K.SPACE[data]
    runs = int((other[1:] & (data[1:] == data[:-1])).sum())
    single = lengths == 1
    spaced = int((single[2:] & single[1:-1] & single[:-2]).sum())
    total = weight.sum()
    out[:] = (
        learned.sum() / n, np.log1p(learned.sum()), weight.max(), total / n, total / max(1, learned.sum()),
        insult.sum() / n, np.log1p(insult.sum()), near / max(1, len(marked)), second.sum() / n,
        uppers[-1] / max(1, letters[-1]), all_upper.sum() / n, (data == 0x21).sum() / n, (data == 0x3F).sum() / n,
        other.sum() / n, runs / n, digit_words.sum() / n, between.sum() / n, spaced / n, lengths.mean(), np.log1p(n),
    )
    return out


def is_held_out(doc_id: str = "doc_id") -> Column:
    return F.crc32(F.col(doc_id).cast("string")) % 5 == 0


def labelled_sample(docs: DataFrame, labels: DataFrame, size: int, seed: int = 11) -> DataFrame:
    """(doc_id, text, toxic, half, calibrate) of at most ``size`` labelled documents that are not held out.

    The rows with the smallest seeded hashes are taken: a bound on the hash that
    lets somewhat more than ``size`` pass, then a top-k of those. The broadcast
    holds ``size`` short rows at most.
    """
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~is_held_out())
    known = known.groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    known = checkpointed(known.withColumn("_h", F.xxhash64(F.lit(seed), "doc_id")))
    share = min(1.0, (size + 8 * size**0.5) / max(1, known.count()))
    bound = min(2**63 - 1, int(2**64 * share) - 2**63)
    chosen = known.where(F.col("_h") <= bound).orderBy("_h", "doc_id").limit(size)
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "toxic", "_h")
    return rows.select("doc_id", "text", "toxic", (F.col("_h") % 2 == 0).alias("half"), (F.shiftright("_h", 8) % 4 == 0).alias("calibrate"))


def lexicons(sample: DataFrame, most: int = LEXICON) -> tuple[Lexicon, Lexicon, Lexicon]:
    """Lexicons of both halves of the sample, and of all of it."""
    cells = ("t0", "f0", "t1", "f1")

    def count(batch):
        held, which = [], []
        for text, toxic, half in zip(K.text_bytes(batch.column("text")), batch.column("toxic").to_pylist(), batch.column("half").to_pylist()):
            data, starts, ends = K.alnum_words(text)
            keys = np.unique(_keys(data, starts, ends))
            held.append(keys[keys != 0])
            which.append(np.full(len(held[-1]), 2 * int(half) + (0 if toxic else 1)))
        keys, at = np.unique(np.concatenate(held), return_inverse=True)
        table = np.zeros((4, len(keys)), np.int64)
        np.add.at(table, (np.concatenate(which), at), 1)
        return [K.signed(keys), *table]

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in count(batch.slice(start, 512))], names=["key", *cells])

    counts = sample.select("text", "toxic", "half").mapInArrow(run, "key long, t0 long, f0 long, t1 long, f1 long")
    sums = counts.groupBy("key").agg(*[F.sum(c).alias(c) for c in cells])
    sums = checkpointed(sums.where(F.col("t0") + F.col("t1") >= 3))
    totals = sample.groupBy("toxic", "half").count().collect()
    total = {(r["toxic"] > 0, r["half"]): r["count"] for r in totals}

    def lexicon(toxic: Column, other: Column, n_toxic: int, n_other: int) -> Lexicon:
        n_toxic, n_other = max(1, n_toxic), max(1, n_other)
        rate = (toxic + other) / (n_toxic + n_other)
        term = lambda k, expected: F.when(k > 0, k * F.log(k / expected)).otherwise(0.0)
        ratio = 2 * (term(toxic, n_toxic * rate) + term(other, n_other * rate))
        odds = F.log(((toxic + 0.5) / (n_toxic + 1)) / ((other + 0.5) / (n_other + 1)))
        rows = (
            sums.select("key", ratio.alias("g"), odds.alias("w"))
            .where((F.col("w") > 1.0) & (F.col("g") > 16.0))
            .orderBy(F.desc("g"), "key")
            .limit(most)
            .select("key", "w")
            .toArrow()
        )
        return Lexicon(rows.column(0).to_numpy().view(np.uint64), rows.column(1).to_numpy())

    t0, f0, t1, f1 = (F.col(c) for c in cells)
    n = lambda toxic, half: total.get((toxic, half), 0)
    return (
        lexicon(t0, f0, n(True, False), n(False, False)),
        lexicon(t1, f1, n(True, True), n(False, True)),
        lexicon(t0 + t1, f0 + f1, n(True, False) + n(True, True), n(False, False) + n(False, True)),
    )


class Model:
    """A fitted scorer: lexicon, trees and calibration, all of bounded size."""

    def __init__(self, prior: float, lexicon: Lexicon | None = None, trees=None, calibration=None):
        self.prior, self.lexicon, self.trees, self.calibration = prior, lexicon, trees, calibration

    def score(self, docs: DataFrame) -> DataFrame:
        """(doc, score): every row as a struct of its columns, and its score."""
        rows = docs.select(F.struct(*docs.columns).alias("doc"))
        if self.trees is None:
            return rows.withColumn("score", F.lit(self.prior))
        shared = docs.sparkSession.sparkContext.broadcast(self.lexicon)

        def run(batch):
            return {"values": [text_features(t, shared.value) for t in K.text_bytes(batch.column("doc").field("text"))]}

        made = K.map_batches(rows, run, "values array<double>", ("doc",))
        return _calibrated(self.trees, self.calibration, made.select("doc", array_to_vector("values").alias("features")))


def _raw(trees, rows: DataFrame) -> DataFrame:
    return trees.transform(rows).withColumn("raw", vector_to_array("probability")[1])


def _calibrated(trees, calibration, rows: DataFrame) -> DataFrame:
    # A thousandth of the trees' own score keeps the order inside the steps of the calibration.
    scored = calibration.transform(_raw(trees, rows))
    score = 0.999 * F.least(F.greatest("calibrated", F.lit(0.0)), F.lit(1.0)) + 0.001 * F.col("raw")
    return scored.select("doc", score.alias("score"))


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, trees: int = 24, depth: int = 4, seed: int = 11) -> Model:
    rows = checkpointed(labelled_sample(docs, labels, sample, seed))
    counts = {r["toxic"] > 0: r["count"] for r in rows.groupBy("toxic").count().collect()}
    toxic, other = counts.get(True, 0), counts.get(False, 0)
    prior = (toxic + 1) / (toxic + other + 2)
    if min(toxic, other) < MIN_CLASS:
        return Model(prior)
    halves = lexicons(rows)
    shared = docs.sparkSession.sparkContext.broadcast(halves)

    def run(batch):
        a, b, _ = shared.value
        return {
            "values": [
                text_features(t, a if half else b)
                for t, half in zip(K.text_bytes(batch.column("text")), batch.column("half").to_pylist())
            ]
        }

    values = K.map_batches(rows, run, "values array<double>", ("toxic", "calibrate"))
    table = values.select(F.col("toxic").cast("double").alias("label"), "calibrate", array_to_vector("values").alias("features"))
    table = checkpointed(table.coalesce(4))
    gbt = GBTClassifier(maxIter=trees, maxDepth=depth, stepSize=0.2, minInstancesPerNode=4, seed=seed, cacheNodeIds=False)
    fitted = gbt.fit(table.where(~F.col("calibrate")))
    isotonic = IsotonicRegression(featuresCol="raw", labelCol="label", predictionCol="calibrated")
    calibration = isotonic.fit(_raw(fitted, table.where("calibrate")).select("raw", "label"))
    return Model(prior, halves[2], fitted, calibration)


def scores(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document."""
    scored = fit(docs, labels, **options).score(docs.select("doc_id", "text")).select("doc.doc_id", "score")
    return scored.select(
        "doc_id",
        F.coalesce(is_held_out(), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def without_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, **options) -> DataFrame:
    """The documents scored below ``threshold``, with all their columns."""
    scored = fit(docs, labels, **options).score(docs)
    return scored.where(F.col("score") < threshold).select("doc.*")
