"""Labelled rows, bounded samples of them, and logistic fits on those."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def labelled(labels: DataFrame, label: str, where: Column | None = None, id_col: str = "doc_id") -> DataFrame:
    """Every labelled id once: `id`, `label` (0 or 1; the lesser of several)."""
    chosen = labels.where(F.col(id_col).isNotNull() & F.col(label).isin(0, 1))
    if where is not None:
        chosen = chosen.where(where)
    return chosen.groupBy(F.col(id_col).cast("long").alias("id")).agg(F.min(label).cast("int").alias("label"))


def sample(labels: DataFrame, label: str, rows: int, where: Column | None = None, id_col: str = "doc_id", seed: int = 0) -> DataFrame:
    """At most `rows` labelled ids, those with the least hashes: `id`, `label` (0 or 1; the lesser of several)."""
    return labelled(labels, label, where, id_col).orderBy(F.xxhash64(F.lit(seed), "id"), "id").limit(rows)


def with_text(docs: DataFrame, chosen: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`id`, `label`, `text` of sampled rows; a sample has a known bound, so it goes to every task."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    return rows.join(F.broadcast(chosen), "id")


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None, ridge: float = 1.0, steps: int = 50) -> np.ndarray:
    """Coefficients, intercept last, by Newton steps on the ridge log-likelihood."""
    x = np.column_stack([x, np.ones(len(x))])
    weight = np.ones(len(x)) if weight is None else weight
    beta, penalty = np.zeros(x.shape[1]), np.full(x.shape[1], ridge)
    penalty[-1] = 1e-6
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        slope = x.T @ (weight * (y - p)) - penalty * beta
        curve = (x * (weight * p * (1 - p) + 1e-9)[:, None]).T @ x + np.diag(penalty)
        step = np.linalg.solve(curve, slope)
        beta += step
        if np.abs(step).max() < 1e-8:
            break
    return beta
