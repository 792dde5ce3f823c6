"""The classifier's training against a plain dense version, and what the penalty does."""

import numpy as np
import pytest

from treeframe.llm import toxicity


def sample(seed, n=200, size=12):
    """Texts as features; feature 0 names a group and goes with the label, as 1 does by itself."""
    pick = np.random.default_rng(seed)
    x = pick.random((n, size)) < 0.25
    y = (x[:, 1] | (pick.random(n) < 0.05)).astype(float)
    x[:, 0] = np.where(pick.random(n) < 0.8, y > 0, pick.random(n) < 0.2)
    swapped = x.copy()
    # A group's name is swapped for another one, feature 2; texts without any get one.
    swapped[:, 2], swapped[:, 0] = x[:, 0], ~x[:, 0]
    return x, swapped, y


def dense_fit(x, swapped, y):
    """Adam on the label loss, the size of the weights and the squared counterfactual change."""
    n, size = x.shape
    w, b = np.zeros(size), np.log((y.sum() + 1) / (n - y.sum() + 1))
    m, v = np.zeros(size + 1), np.zeros(size + 1)
    for t in range(1, toxicity.ROUNDS + 1):
        score, other = x @ w + b, swapped @ w + b
        slope = 1 / (1 + np.exp(-score)) - y
        grad = x.T @ slope / n + 2 * toxicity.L2 * w
        grad += 2 * toxicity.FAIRNESS / n * (swapped.astype(float) - x).T @ (other - score)
        grad = np.append(grad, slope.mean())
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        step = toxicity.RATE * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-9)
        w, b = w - step[:-1], b - step[-1]
    return w, b


@pytest.mark.parametrize("seed", range(3))
def test_training_against_a_dense_version(seed):
    x, swapped, y = sample(seed)
    got, bias = toxicity._descend(y, np.nonzero(x), np.nonzero(swapped), x.shape[1])
    want, want_bias = dense_fit(x, swapped, y)
    assert np.allclose(got, want, atol=1e-6) and abs(bias - want_bias) < 1e-6


@pytest.mark.parametrize("seed", range(3))
def test_the_penalty_takes_the_weight_off_group_names(seed, monkeypatch):
    x, swapped, y = sample(seed)
    fair, _ = toxicity._descend(y, np.nonzero(x), np.nonzero(swapped), x.shape[1])
    monkeypatch.setattr(toxicity, "FAIRNESS", 0.0)
    plain, _ = toxicity._descend(y, np.nonzero(x), np.nonzero(swapped), x.shape[1])
    assert plain[0] > 1 and abs(fair[0] - fair[2]) < 0.3 * abs(plain[0] - plain[2])
    assert fair[1] > 1.5


def test_descent_ends_where_the_loss_is_flat():
    """The loss written out, and its numeric slope."""
    x, swapped, y = sample(9, 60, 6)

    def loss(w, b):
        score, other = x @ w + b, swapped @ w + b
        fit = np.mean(np.log1p(np.exp(score)) - y * score)
        return fit + toxicity.L2 * w @ w + toxicity.FAIRNESS * np.mean((other - score) ** 2)

    w, b = toxicity._descend(y, np.nonzero(x), np.nonzero(swapped), x.shape[1])
    slope = [
        (loss(w + 1e-5 * unit, b) - loss(w - 1e-5 * unit, b)) / 2e-5 for unit in np.eye(len(w))
    ]
    # Almost flat where the descent ends, and far below where it began.
    assert np.abs(slope).max() < 0.02
    assert loss(w, b) < 0.5 * loss(np.zeros(len(w)), np.log(y.mean() / (1 - y.mean())))
