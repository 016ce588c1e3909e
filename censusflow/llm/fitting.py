"""Small numeric helpers for classifiers fitted on a bounded sample of labelled rows."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def id_remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % modulus


def labelled(docs: DataFrame, labels: DataFrame, label: str, allowed: Column, per_class: int, salt: int) -> DataFrame:
    """(doc_id, text, y, part, w): at most ``per_class`` training documents of each class, by a hash of the id.

    ``allowed`` is a condition on doc_id. ``part`` is a second hash, to split the sample. ``w`` is the number of allowed labels
    that a row stands for: the sample has more of the rarer class than the table, and the weights undo that. Null labels, ids and
    texts are no training rows; an id with several labels or texts gives several rows. The ids (a proven
    bound of 2 * per_class rows) are broadcast, so the texts are scanned once and only sampled ones move.
    """
    rows = labels.select("doc_id", F.col(label).cast("int").alias("y")).filter(F.col("doc_id").isNotNull() & F.col("y").isin(0, 1) & allowed)
    order = F.xxhash64(F.lit(salt), F.col("doc_id"))
    total = {r["y"]: r["count"] for r in rows.groupBy("y").count().collect()}
    weight = lambda y: F.lit(max(1.0, total.get(y, 0) / per_class))
    pick = [rows.filter(F.col("y") == y).orderBy(order, "doc_id").limit(per_class).withColumn("w", weight(y)) for y in (0, 1)]
    ids = pick[0].unionByName(pick[1]).withColumn("part", F.pmod(F.xxhash64(F.lit(salt + 1), "doc_id"), F.lit(1000)).cast("int"))
    return docs.select("doc_id", "text").filter("text is not null").join(F.broadcast(ids), "doc_id")


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1.0, rounds: int = 50) -> np.ndarray:
    """Coefficients of a ridge-penalised logistic regression of weighted rows by damped Newton steps; x has a column of ones."""
    w = np.zeros(x.shape[1])
    share = weight / weight.mean()
    penalty = np.full(x.shape[1], ridge)
    penalty[0] = 1e-6

    def loss(v: np.ndarray) -> float:
        z = x @ v
        return float((share * (np.logaddexp(0, z) - y * z)).sum() + (penalty * v * v).sum() / 2)

    now = loss(w)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (share * (p - y)) + penalty * w
        hess = (x * (share * p * (1 - p))[:, None]).T @ x + np.diag(penalty)
        step = np.linalg.solve(hess + 1e-9 * np.eye(len(w)), grad)
        size = 1.0
        while size > 1e-6 and loss(w - size * step) > now:
            size /= 2
        w = w - size * step
        before, now = now, loss(w)
        if before - now < 1e-9 * max(1.0, abs(before)):
            break
    return w


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def isotonic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knots (x, mean of y) of the best non-decreasing step fit, by pooling adjacent violators."""
    order = np.argsort(x, kind="stable")
    values, first = np.unique(x[order], return_index=True)
    total = np.add.reduceat(y[order].astype(float), first) if len(values) else np.empty(0)
    weight = np.diff(np.append(first, len(x))).astype(float)
    pools: list[list[float]] = []  # sum, weight, last x
    for s, w, v in zip(total, weight, values):
        pools.append([s, w, v])
        while len(pools) > 1 and pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1]:
            s, w, v = pools.pop()
            pools[-1][0] += s
            pools[-1][1] += w
            pools[-1][2] = v
    return np.array([p[2] for p in pools]), np.array([p[0] / p[1] for p in pools])
