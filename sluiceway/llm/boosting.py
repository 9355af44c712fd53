"""Gradient-boosted trees over a table of distinct feature rows, as SQL expressions.

The features are small integers, so all examples of a corpus fold into one row for each
combination, with the number of examples and of positive ones. Trees are grown on that
table, which is bounded by the feature space and not by the corpus.
"""

from dataclasses import dataclass

import numpy as np


@dataclass
class Split:
    """``feature <= bound`` goes left. Leaves are numbers."""

    feature: int
    bound: int
    left: "Split | float"
    right: "Split | float"


def grow_trees(
    x: np.ndarray, count: np.ndarray, positive: np.ndarray, rounds: int, depth: int, rate: float
) -> tuple[float, list]:
    """Start value and trees, each fitted by a Newton step on the logistic loss."""
    total = count.sum()
    share = (positive.sum() + 1.0) / (total + 2.0)
    start = float(np.log(share / (1 - share)))
    margin = np.full(len(x), start)
    trees = []
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-margin))
        gradient, curvature = positive - count * p, count * p * (1 - p)
        tree = _grow(x, gradient, curvature, np.arange(len(x)), depth, rate)
        margin = margin + evaluate(tree, x)
        trees.append(tree)
    return start, trees


def _grow(x, gradient, curvature, rows, depth, rate, ridge=1.0):
    g, h = gradient[rows].sum(), curvature[rows].sum()
    leaf = float(rate * g / (h + ridge))
    if not depth or len(rows) < 2:
        return leaf
    best, choice = 1e-6, None
    for feature in range(x.shape[1]):
        values = x[rows, feature]
        for bound in np.unique(values)[:-1]:
            left = rows[values <= bound]
            gl, hl = gradient[left].sum(), curvature[left].sum()
            gr, hr = g - gl, h - hl
            gain = gl**2 / (hl + ridge) + gr**2 / (hr + ridge) - g**2 / (h + ridge)
            if gain > best:
                best, choice = gain, (feature, int(bound))
    if choice is None:
        return leaf
    feature, bound = choice
    left = x[rows, feature] <= bound
    sides = (rows[left], rows[~left])
    return Split(feature, bound, *(_grow(x, gradient, curvature, s, depth - 1, rate) for s in sides))


def evaluate(tree, x: np.ndarray) -> np.ndarray:
    if not isinstance(tree, Split):
        return np.full(len(x), tree)
    left = x[:, tree.feature] <= tree.bound
    return np.where(left, evaluate(tree.left, x), evaluate(tree.right, x))


def tree_sql(tree, names: list[str]) -> str:
    if not isinstance(tree, Split):
        return f"{tree!r}D"
    left, right = tree_sql(tree.left, names), tree_sql(tree.right, names)
    return f"CASE WHEN {names[tree.feature]} <= {tree.bound} THEN {left} ELSE {right} END"


def calibrate(margin: np.ndarray, count: np.ndarray, positive: np.ndarray) -> tuple[float, float]:
    """Scale and shift that make margins log-odds on other examples (a small prior keeps
    both finite)."""
    a, b = 1.0, 0.0
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(a * margin + b, -30, 30)))
        gradient, curvature = positive - count * p, count * p * (1 - p)
        g = np.array([(gradient * margin).sum() - (a - 1), gradient.sum() - b])
        h = np.array(
            [
                [(curvature * margin**2).sum() + 1, (curvature * margin).sum()],
                [(curvature * margin).sum(), curvature.sum() + 1],
            ]
        )
        step = np.linalg.solve(h, g)
        a, b = a + np.clip(step[0], -1, 1), b + np.clip(step[1], -1, 1)
    return float(a), float(b)


def lowest_threshold(
    probability: np.ndarray, count: np.ndarray, positive: np.ndarray, precision: float
) -> float:
    """The lowest probability from which on at least ``precision`` are positive; 2 if none."""
    order = np.argsort(-probability, kind="stable")
    reached = np.cumsum(positive[order]) >= precision * np.cumsum(count[order])
    # Equal probabilities are taken together.
    last = np.append(np.diff(probability[order]) != 0, True) if len(order) else np.zeros(0, bool)
    good = np.flatnonzero(reached & last & (np.cumsum(count[order]) > 0))
    return float(probability[order][good[-1]]) if len(good) else 2.0
