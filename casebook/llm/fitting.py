"""Bounded labelled samples and small linear models for the classifiers."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def share(key: Column) -> Column:
    """A fixed pseudo-random number in [0, 1) of a row's key."""
    return F.pmod(F.xxhash64(key, F.lit("sample")), F.lit(1 << 40)) / F.lit(float(1 << 40))


def per_class(rows: DataFrame, label: str, size: int) -> tuple[DataFrame, dict]:
    """About ``size`` rows of each value of ``label`` in ``rows(id, label, ...)``, by a hash of the id, and each value's sampling rate.

    The driver learns every value and its rate; rows without a value aren't picked.
    """
    known = rows.where(F.col(label).isNotNull()).groupBy(label).count()
    rates = {r[0]: min(1.0, size / r[1]) for r in known.collect()}
    if not rates:
        return rows.where("false"), rates
    every = F.create_map(*[F.lit(x) for pair in rates.items() for x in pair])
    return rows.where(share(F.col("id")) < F.try_element_at(every, F.col(label))), rates


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, l2: float = 1.0, steps: int = 25) -> np.ndarray:
    """Weights of a logistic model on soft labels ``y``; the last column of ``x`` is the intercept, which isn't shrunk."""
    w = np.zeros(x.shape[1])
    ridge = np.full(x.shape[1], l2)
    ridge[-1] = 1e-6
    for _ in range(steps):
        p = sigmoid(x @ w)
        g = x.T @ (weight * (p - y)) + ridge * w
        h = (x * (weight * p * (1 - p))[:, None]).T @ x + np.diag(ridge)
        step = np.linalg.solve(h, g)
        w -= step * min(1.0, 5.0 / max(1e-9, np.abs(step).max()))
        if np.abs(step).max() < 1e-6:
            break
    return w
