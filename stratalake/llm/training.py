"""Bounded, repeatable samples of labelled documents, and a small logistic regression in numpy."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def labelled(
    docs: DataFrame, labels: DataFrame, label: str, rows: int, max_bytes: int, seed: int, usable: Column | None = None, only: int | None = None
) -> list[tuple[str, int]]:
    """Up to ``rows`` labelled texts of at most ``max_bytes`` each, as (text, label), in a fixed order.

    Labels are made distinct first: an id counts once however often it is labelled, and an id whose labels disagree
    is not used. Then ids are sampled by a hash (with ``only``, those of one label), so that only a bounded list of ids
    meets the documents; of an id's documents the least text counts. Texts are whole; labelled rows with longer texts are not
    used for training. Null labels, ids and texts are not used. ``rows`` times ``max_bytes`` bounds what reaches the driver.
    """
    order = F.xxhash64("doc_id", F.lit(seed))
    known = labels.select("doc_id", F.col(label).alias("y")).where("doc_id is not null and y in (0, 1)")
    if usable is not None:
        known = known.where(usable)
    agreed = known.groupBy("doc_id").agg(F.min("y").alias("y"), F.max("y").alias("most")).where("y = most").drop("most")
    if only is not None:
        agreed = agreed.where(F.col("y") == only)
    chosen = agreed.orderBy(order, "doc_id").limit(rows)
    found = docs.select("doc_id", "text").where(F.octet_length("text") <= max_bytes).join(F.broadcast(chosen), "doc_id")
    found = found.groupBy("doc_id", "y").agg(F.min("text").alias("text"))
    return [(r.text, r.y) for r in found.orderBy(order, "doc_id").limit(rows).select("text", "y").collect()]


def crc32_of_id() -> Column:
    return F.crc32(F.col("doc_id").cast("string").cast("binary"))


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -35, 35)))


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-4, steps: int = 100) -> np.ndarray:
    """Newton's method on scaled columns, halving steps that don't help; the last weight is the intercept.

    One class only: the smoothed log odds, no slope.
    """
    n, d = x.shape
    ones = float(np.sum(y))
    w = np.zeros(d + 1)
    w[-1] = np.log((ones + 1) / (n - ones + 1))
    if ones in (0.0, float(n)):
        return w
    middle, scale = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-9)
    z = np.column_stack([(x - middle) / scale, np.ones(n)])
    keep = np.append(np.full(d, ridge * n), 0)

    def loss(v: np.ndarray) -> float:
        m = z @ v
        return float(np.logaddexp(0, m).sum() - y @ m + (keep * v * v).sum() / 2)

    now = loss(w)
    for _ in range(steps):
        p = sigmoid(z @ w)
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + np.diag(keep + 1e-9), z.T @ (y - p) - keep * w)
        size = 1.0
        while size > 1e-4 and loss(w + size * step) > now:
            size /= 2
        if size <= 1e-4:
            break
        w, before = w + size * step, now
        now = loss(w)
        if before - now < 1e-9 * (1 + abs(now)):
            break
    out = w[:-1] / scale
    return np.append(out, w[-1] - out @ middle)
