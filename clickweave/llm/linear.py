"""Small linear models, fitted on the driver on bounded samples."""

from __future__ import annotations

import numpy as np


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))


def fit_svm(x: np.ndarray, y: np.ndarray, *, cost: float = 10.0, passes: int = 20, seed: int = 7) -> np.ndarray:
    """Linear support vector machine (L2 loss) by dual coordinate descent; y is +1 or -1.

    The last weight is the bias.  Classes are weighted to count the same.
    """
    # one copy of the rows and no more: they are what the driver's memory goes to
    rows = np.ones((len(x), x.shape[1] + 1))
    rows[:, :-1] = x
    x = rows
    share = np.where(y > 0, max(1, (y > 0).sum()), max(1, (y < 0).sum()))
    diagonal = 0.5 * share / (cost * len(y) / 2)
    parts = [(x[a : a + 256] * x[a : a + 256]).sum(axis=1) for a in range(0, len(x), 256)]
    curvature = np.concatenate([np.zeros(0), *parts]) + diagonal
    alpha, weights = np.zeros(len(y)), np.zeros(x.shape[1])
    order = np.random.default_rng(seed)
    for _ in range(passes):
        largest = 0.0
        for i in order.permutation(len(y)):
            gradient = y[i] * (x[i] @ weights) - 1 + diagonal[i] * alpha[i]
            if alpha[i] == 0 and gradient >= 0:
                continue
            new = max(0.0, alpha[i] - gradient / curvature[i])
            weights += (new - alpha[i]) * y[i] * x[i]
            alpha[i] = new
            largest = max(largest, abs(gradient))
        if largest < 1e-3:
            break
    return weights


def fit_logistic(
    rows: np.ndarray, columns: np.ndarray, target: np.ndarray, width: int, *, l2: float = 0.1, steps: int = 600
) -> tuple[np.ndarray, float]:
    """Logistic regression on sparse 0/1 features against soft targets.

    ``rows`` and ``columns`` are the places of the ones.  Full-batch descent with
    a step of its own per weight (Adam), so that rare features move too.
    ``l2`` is the penalty in rows.  Returns weights and bias.
    """
    n = len(target)
    weights = np.zeros(width + 1)
    first, second = np.zeros(width + 1), np.zeros(width + 1)
    for step in range(1, steps + 1 if n else 1):
        margin = np.bincount(rows, weights=weights[columns], minlength=n) + weights[-1]
        wrong = (sigmoid(margin) - target) / n
        gradient = np.bincount(columns, weights=wrong[rows], minlength=width + 1) + l2 / n * weights
        gradient[-1] = wrong.sum()
        first = 0.9 * first + 0.1 * gradient
        second = 0.999 * second + 0.001 * gradient**2
        weights -= 0.05 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-9)
    return weights[:-1], float(weights[-1])
