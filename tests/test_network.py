"""Tanh networks: gradients, sums over partitions, learning, the grid."""

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors

from ratewise.plans import network as N


def sample(n=240, f=6, classes=3, seed=1):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, f)) * (rng.random((n, f)) < 0.7)
    y = np.abs(x[:, 0] * 2 + x[:, 1]).astype(int).clip(0, classes - 1)
    return x, y


def rows(spark, x, y, folds=None):
    data = [
        (i, Vectors.dense(r) if i % 2 else Vectors.sparse(len(r), [(j, v) for j, v in enumerate(r) if v]), float(c), int(i % 3))
        for i, (r, c) in enumerate(zip(x.tolist(), y))
    ]
    return spark.createDataFrame(data, ["id", "features", "label", "fold"]).repartition(4, "id")


def loss(net, x, y):
    into, _, out, _ = net.parts(net.weights)
    p = net.probabilities(x)
    return (-np.log(p[np.arange(len(y)), y]).sum() + net.point.alpha / 2 * ((into**2).sum() + (out**2).sum())) / len(y)


@pytest.mark.parametrize("alpha", [0.0, 0.5])
def test_gradient_is_the_slope_of_the_loss(alpha):
    x, y = sample(40)
    net = N.new_network(N.Point(5, alpha), 6, 3)
    found = net.penalised(net.gradient_sum(x, y)[0], len(y))
    start = net.weights
    for i in range(len(start)):
        ends = []
        for side in (1e-6, -1e-6):
            net.weights = start + side * (np.arange(len(start)) == i)
            ends.append(loss(net, x, y))
        assert found[i] == pytest.approx((ends[0] - ends[1]) / 2e-6, abs=1e-7)


@pytest.mark.parametrize("branches", [32, 2])
def test_sums_over_partitions(spark, monkeypatch, branches):
    """Straight and by a tree; each network without the rows of its fold; blocks of a few rows."""
    monkeypatch.setattr(N, "_BRANCHES", branches)
    x, y = sample()
    nets = [N.new_network(p, 6, 3) for p in (N.Point(4, 0.1), N.Point(7, 0.0, 1), N.Point(3, 0.0, 9))]
    keep = [np.ones(240, bool), np.arange(240) % 3 != 1, np.ones(240, bool)]
    for net, own, (n, total, gradient) in zip(nets, keep, N.gradient_sums(rows(spark, x, y), nets)):
        wanted, wanted_loss = net.gradient_sum(x[own], y[own])
        assert n == own.sum() and total == pytest.approx(wanted_loss) and np.allclose(gradient, wanted)


def test_steps_equal_one_machine(spark):
    """One batch, three passes: the same weights as the plain loop."""
    x, y = sample()
    (net,), history = N.train_networks(rows(spark, x, y), [N.Point(5, 0.01)], 3, n_batches=1, passes=3)
    plain = N.new_network(N.Point(5, 0.01), 6, 3)
    losses = []
    for _ in range(3):
        gradient, total = plain.gradient_sum(x, y)
        losses.append(total / len(y))
        plain.step(plain.penalised(gradient, len(y)), N.STEP)
    assert np.allclose(net.weights, plain.weights) and [h["loss"] for h in history] == pytest.approx(losses)
    found = {r.id: r.probability for r in N.network_probabilities(rows(spark, x, y), net).collect()}
    assert np.allclose([found[i] for i in range(240)], plain.probabilities(x))


def test_search_prefers_networks_that_learn(spark):
    x, y = sample(600)
    points = [N.Point(12, 1e-4), N.Point(12, 1e5)]
    found = N.network_search(rows(spark, x, y).drop("fold"), points, 2, 3, n_batches=3, passes=8, step=0.05).collect()
    assert [r.alpha for r in found] == [1e-4, 1e5] and found[0].mean_mae < 0.6 * found[1].mean_mae
    assert all(r.n_folds == 2 and r.worst_mae >= r.mean_mae for r in found)


def test_grid_and_limits(spark, monkeypatch):
    grid = N.network_grid()
    assert len(grid) == 30 and {p.hidden for p in grid} == {10, 15, 20, 50, 100}
    assert sorted({p.alpha for p in grid}) == pytest.approx([1e-7, 1e-6, 1e-5, 1e-4, 1e-3, 1e-2])
    x, y = sample(20)
    with pytest.raises(ValueError, match="one batch"):
        N.train_networks(rows(spark, x, y), grid[:1], 3, batch_size=1000)
    monkeypatch.setattr(N, "MAX_WEIGHTS", 10)
    with pytest.raises(ValueError, match="weights"):
        N.train_networks(rows(spark, x, y), grid[:1], 3)
