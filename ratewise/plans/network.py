"""Tanh networks with a weight penalty, trained by gradients summed over partitions.

Spark's own network is sigmoid and has no penalty. Here a step is one Spark job
over one batch: each task adds up the gradients of its rows, the sums are merged
by a tree of tasks, and one Adam step is taken with them. All networks of a
grid, and all folds of each, learn in the same pass over the batches.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratewise.functions.numeric import log_grid
from ratewise.operators.evaluation import stratified_folds
from ratewise.plans.models import N_CLASSES, batch_table, feature_count

# Penalties, hidden widths and step of the network search.
ALPHAS = tuple(log_grid(-7, -2, 6))
WIDTHS = (10, 15, 20, 50, 100)
STEP = 0.01

# Usual constants of the Adam update.
_DECAY_1, _DECAY_2, _TINY = 0.9, 0.999, 1e-8

MAX_WEIGHTS = 8_000_000  # of all networks together: they are sent to every executor in each step
_BLOCK_CELLS = 1 << 21  # of a dense block of rows inside a task
_BRANCHES = 32  # first merges of a tree; a batch of fewer tasks needs none


@dataclass(frozen=True)
class Point:
    hidden: int
    alpha: float = 1e-4
    fold: int | None = None  # rows of this fold are left out in training


@dataclass
class Network:
    """Weights of one hidden tanh layer and a softmax layer, in one array."""

    point: Point
    n_features: int
    n_classes: int
    weights: np.ndarray
    steps: int = 0
    mean: np.ndarray = field(default=None)
    square: np.ndarray = field(default=None)

    def parts(self, flat: np.ndarray) -> tuple[np.ndarray, ...]:
        """Views: input weights, hidden offsets, output weights, class offsets."""
        f, h, c = self.n_features, self.point.hidden, self.n_classes
        ends = np.cumsum([f * h, h, h * c, c])
        a, b, w, o = np.split(flat, ends[:-1])
        return a.reshape(f, h), b, w.reshape(h, c), o

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        return self._forward(x)[1]

    def _forward(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        into, b, out, o = self.parts(self.weights)
        hidden = np.tanh(x @ into + b)
        scores = hidden @ out + o
        scores -= scores.max(axis=1, keepdims=True)
        e = np.exp(scores)
        return hidden, e / e.sum(axis=1, keepdims=True)

    def gradient_sum(self, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, float]:
        """Gradient and value of the log loss, summed over the rows, without the penalty."""
        hidden, p = self._forward(x)
        rows = np.arange(len(y))
        loss = -np.log(np.maximum(p[rows, y], 1e-300)).sum()
        error = p
        error[rows, y] -= 1.0
        inner = (error @ self.parts(self.weights)[2].T) * (1.0 - hidden**2)
        total = [x.T @ inner, inner.sum(axis=0), hidden.T @ error, error.sum(axis=0)]
        return np.concatenate([part.ravel() for part in total]), float(loss)

    def penalised(self, gradient: np.ndarray, n: int) -> np.ndarray:
        """Mean gradient of ``n`` rows with that of alpha / 2n x squared weights; offsets are not penalised."""
        total = gradient.copy()
        into, _, out, _ = self.parts(total)
        w_into, _, w_out, _ = self.parts(self.weights)
        into += self.point.alpha * w_into
        out += self.point.alpha * w_out
        return total / n

    def step(self, gradient: np.ndarray, size: float) -> None:
        self.steps += 1
        self.mean = _DECAY_1 * self.mean + (1 - _DECAY_1) * gradient
        self.square = _DECAY_2 * self.square + (1 - _DECAY_2) * gradient**2
        scale = size * np.sqrt(1 - _DECAY_2**self.steps) / (1 - _DECAY_1**self.steps)
        self.weights = self.weights - scale * self.mean / (np.sqrt(self.square) + _TINY)


def new_network(point: Point, n_features: int, n_classes: int, seed: int = 42) -> Network:
    """Uniform weights within the root of 6 / (inputs + outputs) of their layer."""
    rng = np.random.default_rng([seed, point.hidden])
    first, second = (np.sqrt(6.0 / (n + m)) for n, m in ((n_features, point.hidden), (point.hidden, n_classes)))
    sizes = ((n_features * point.hidden, first), (point.hidden, first), (point.hidden * n_classes, second), (n_classes, second))
    weights = np.concatenate([rng.uniform(-limit, limit, n) for n, limit in sizes])
    return Network(point, n_features, n_classes, weights, 0, np.zeros_like(weights), np.zeros_like(weights))


# --- rows in tasks ------------------------------------------------------------------


def _sparse(df: DataFrame, *others: str) -> DataFrame:
    """``features`` as the arrays ``at`` and ``value`` of its cells that are not 0."""
    cells = F.filter(
        F.transform(vector_to_array("features"), lambda v, i: F.struct(i.alias("at"), v.alias("value"))),
        lambda cell: cell.value != 0,
    )
    return df.select(*others, cells.alias("_cells")).select(*others, F.col("_cells.at").alias("at"), F.col("_cells.value").alias("value"))


def _blocks(frame: pd.DataFrame, n_features: int) -> Iterator[tuple[slice, np.ndarray]]:
    """Dense blocks of a bounded number of cells."""
    size = max(1, _BLOCK_CELLS // max(1, n_features))
    for first in range(0, len(frame), size):
        part = frame.iloc[first : first + size]
        x = np.zeros((len(part), n_features))
        for row, (at, value) in enumerate(zip(part["at"], part["value"])):
            x[row, np.asarray(at, dtype=np.int64)] = value
        yield slice(first, first + len(part)), x


def _learns(point: Point, folds: np.ndarray) -> np.ndarray:
    return np.ones(len(folds), bool) if point.fold is None else folds != point.fold


_SUMS = "point int, task int, n long, loss double, gradient binary"


def gradient_sums(batch: DataFrame, networks: Sequence[Network]) -> list[tuple[int, float, np.ndarray]]:
    """(rows, summed loss, summed gradient) of each network over a batch.

    ``batch`` has ``features``, ``label`` (0-based class) and ``fold``. The sums of
    tasks are added in the order of the tasks, so that a run can be repeated.
    """
    spark = batch.sparkSession
    shared = spark.sparkContext.broadcast(list(networks))

    def sums(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        nets = shared.value
        totals = [[0, 0.0, np.zeros_like(net.weights)] for net in nets]
        task = None
        for frame in frames:
            if len(frame):
                task = int(frame["task"].iloc[0])
            labels, folds = frame["label"].to_numpy(np.int64), frame["fold"].to_numpy()
            for rows, x in _blocks(frame, nets[0].n_features):
                for net, total in zip(nets, totals):
                    own = _learns(net.point, folds[rows])
                    if own.any():
                        gradient, loss = net.gradient_sum(x[own], labels[rows][own])
                        total[0] += int(own.sum())
                        total[1] += loss
                        total[2] += gradient
        if task is not None:
            yield pd.DataFrame(
                [(i, task, n, loss, g.tobytes()) for i, (n, loss, g) in enumerate(totals)],
                columns=["point", "task", "n", "loss", "gradient"],
            )

    def merge(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("task")
        total = sum(np.frombuffer(g) for g in frame["gradient"])
        return pd.DataFrame(
            [(frame["point"].iloc[0], frame["task"].iloc[0], frame["n"].sum(), frame["loss"].sum(), total.tobytes())],
            columns=["point", "task", "n", "loss", "gradient"],
        )

    try:
        rows = _sparse(batch, "label", "fold").withColumn("task", F.spark_partition_id())
        found = rows.mapInPandas(sums, _SUMS)
        if batch.rdd.getNumPartitions() > _BRANCHES:
            found = found.groupBy("point", F.pmod("task", F.lit(_BRANCHES)).alias("branch")).applyInPandas(merge, _SUMS)
        merged = {r.point: r for r in found.groupBy("point").applyInPandas(merge, _SUMS).collect()}
    finally:
        shared.unpersist()
    return [
        (merged[i].n, merged[i].loss, np.frombuffer(merged[i].gradient)) if i in merged else (0, 0.0, np.zeros_like(net.weights))
        for i, net in enumerate(networks)
    ]


# --- training and search ------------------------------------------------------------


def train_networks(
    train: DataFrame,
    points: Sequence[Point],
    n_classes: int = N_CLASSES,
    batch_size: int | None = None,
    n_batches: int = 20,
    step: float = STEP,
    seed: int = 42,
    passes: int = 1,
) -> tuple[list[Network], list[dict]]:
    """The networks of all points after ``passes`` over the batches, and the mean loss of each step.

    ``train`` has ``id``, ``features``, ``label`` and, where a point names one,
    ``fold``. Without a batch size all rows are dealt over ``n_batches`` steps, so
    that a step stays worth a job whatever the data size. A batch without
    rows of a network's folds leaves that network as it is.
    """
    n_features = feature_count(train)
    networks = [new_network(p, n_features, n_classes, seed) for p in points]
    size = sum(len(net.weights) for net in networks)
    if size > MAX_WEIGHTS:
        raise ValueError(f"{size} weights, at most {MAX_WEIGHTS}: reduce the features or train fewer points at once")
    fold = F.col("fold") if "fold" in train.columns else F.lit(-1).alias("fold")
    path, batches = batch_table(train.select("id", "features", "label", fold), batch_size, None if batch_size else n_batches)
    if batches == 0:
        raise ValueError("fewer rows than one batch")
    stored = train.sparkSession.read.parquet(path)
    history = []
    for number in range(passes * batches):
        sums = gradient_sums(stored.where(F.col("batch_no") == number % batches), networks)
        for index, (net, (n, loss, gradient)) in enumerate(zip(networks, sums)):
            if n:
                net.step(net.penalised(gradient, n), step)
                history.append({"point": index, "step": number, "rows": n, "loss": loss / n})
    return networks, history


def network_probabilities(df: DataFrame, network: Network, name: str = "probability") -> DataFrame:
    """(id, ``name``): the probability of each class, as :func:`~ratewise.operators.evaluation.soft_vote` takes it."""
    shared = df.sparkSession.sparkContext.broadcast(network)

    def score(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for rows, x in _blocks(frame, shared.value.n_features):
                yield pd.DataFrame({"id": frame["id"].iloc[rows], name: list(shared.value.probabilities(x))})

    return _sparse(df, "id").mapInPandas(score, f"id long, {name} array<double>")


def grid_errors(df: DataFrame, networks: Sequence[Network]) -> DataFrame:
    """(point, n, mae): error of each network on the rows of its own fold, or on all rows, in one pass."""
    shared = df.sparkSession.sparkContext.broadcast(list(networks))

    def errors(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            labels, folds = frame["label"].to_numpy(np.int64), frame["fold"].to_numpy()
            for rows, x in _blocks(frame, shared.value[0].n_features):
                for i, net in enumerate(shared.value):
                    own = np.ones(len(x), bool) if net.point.fold is None else folds[rows] == net.point.fold
                    if own.any():
                        wrong = np.abs(net.probabilities(x[own]).argmax(axis=1) - labels[rows][own]).sum()
                        yield pd.DataFrame({"point": [i], "n": [int(own.sum())], "wrong": [int(wrong)]})

    fold = F.col("fold") if "fold" in df.columns else F.lit(-1).alias("fold")
    sums = _sparse(df.select("features", "label", fold), "label", "fold").mapInPandas(errors, "point int, n long, wrong long")
    return sums.groupBy("point").agg(F.sum("n").alias("n"), (F.sum("wrong") / F.sum("n")).alias("mae"))


def network_grid(alphas: Sequence[float] = ALPHAS, widths: Sequence[int] = WIDTHS) -> list[Point]:
    return [Point(h, a) for a in alphas for h in widths]


def network_search(
    rows: DataFrame, points: Sequence[Point] | None = None, n_folds: int = 3, n_classes: int = N_CLASSES, **training
) -> DataFrame:
    """(alpha, hidden, mean_mae, worst_mae, n_folds) of a grid by cross-validation, best first.

    Every network of every fold learns in the same pass: the batches are read
    once for the whole grid, and the validation rows once.
    """
    points = list(network_grid() if points is None else points)
    folded = stratified_folds(rows.select("id", "features", "label"), "label", n_folds)
    every = [Point(p.hidden, p.alpha, f) for p in points for f in range(n_folds)]
    networks, _ = train_networks(folded, every, n_classes, **training)
    errors = {r.point: r.mae for r in grid_errors(folded, networks).collect()}
    found = []
    for i, p in enumerate(points):
        own = [errors[j] for j in range(i * n_folds, (i + 1) * n_folds) if j in errors]
        found.append((float(p.alpha), p.hidden, float(np.mean(own)), float(max(own)), len(own)))
    schema = "alpha double, hidden int, mean_mae double, worst_mae double, n_folds int"
    return rows.sparkSession.createDataFrame(sorted(found, key=lambda r: (r[2], r[0], r[1])), schema)
