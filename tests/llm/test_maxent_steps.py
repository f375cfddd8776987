"""The steps and the size of the maximum-entropy model."""

import numpy as np
import pytest

from crossfeed.llm import maxent


def test_the_softmax_has_all_classes_and_rounds():
    assert (maxent.OWN_CLASSES, maxent.ENDING_CLASSES, maxent.CLASSES) == (31, 17, 48)
    assert (maxent.ROUNDS, maxent.BATCH) == (3, 4096)


def test_every_weight_has_its_own_step_size():
    rng = np.random.default_rng(3)
    rows, n = 6, 200
    weights = rng.normal(size=(rows + 1, maxent.CLASSES))
    gathered, seen = np.ones_like(weights), np.zeros(rows + 1)
    features = rng.integers(0, rows, (n, maxent.ORDERS)).astype(np.uint16)
    kind = rng.integers(0, maxent.CLASSES, n) ** 2 % maxent.CLASSES
    wanted, squares, times = weights.copy(), gathered.copy(), seen.copy()
    slope = np.exp(maxent.log_chances(weights, features))
    slope[np.arange(n), kind] -= 1
    for k in range(maxent.ORDERS):
        for row in range(rows):
            here = features[:, k] == row
            total = slope[here].sum(0)
            squares[row] += total ** 2
            wanted[row] -= maxent.RATE * total / np.sqrt(squares[row])
            times[row] += here.sum()
    total = slope.sum(0)
    squares[-1] += total ** 2
    wanted[-1] -= maxent.RATE * total / np.sqrt(squares[-1])
    times[-1] += n
    maxent.descend(weights, gathered, seen, features, kind)
    assert np.allclose(gathered, squares) and np.allclose(weights, wanted) and (seen == times).all()


def test_one_exponential_per_step(monkeypatch):
    """Chances are made once per step, and of a text only those of its own classes are logged."""
    rng = np.random.default_rng(6)
    weights = rng.normal(0, 0.3, (maxent.FEATURES + 1, maxent.CLASSES)).astype(np.float32)
    features = rng.integers(0, 50, (400, maxent.ORDERS)).astype(np.uint16)
    kind = rng.integers(0, maxent.CLASSES, 400)
    whole = maxent.log_chances(weights, features)[np.arange(400), kind]
    assert maxent.chances_of(weights, features, kind) == pytest.approx(whole, abs=1e-4)
    made, exp = [0], np.exp

    def counted(values, *more, **named):
        made[0] += np.size(values)
        return exp(values, *more, **named)

    monkeypatch.setattr(np, "exp", counted)
    maxent.descend(weights, np.ones_like(weights), np.zeros(len(weights)), features, kind)
    assert made[0] == 400 * maxent.CLASSES
