"""Linear models from Gram matrices.

One pass gives, per fold, the matrix ``[1 X y]'[1 X y]`` (features + 2 square, whatever the
number of rows). Least squares, ridge, elastic net, their cross-validation, grid search and
feature selection need nothing else, so no candidate reads the data again.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F


def fold_grams(df: DataFrame, columns: list[str], y: str, fold: str | None = None) -> dict[int, np.ndarray]:
    """Gram matrix of ``[1, columns, y]`` per fold (fold 0 without a fold column)."""
    size = len(columns) + 2

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            folds = b.column(0).to_numpy(zero_copy_only=False)
            data = np.column_stack([np.ones(b.num_rows)] + [
                b.column(i).to_numpy(zero_copy_only=False) for i in range(1, b.num_columns)])
            for f in np.unique(folds):
                part = data[folds == f]
                sums[f] = sums.get(f, 0) + part.T @ part
        for f, g in sums.items():
            yield pa.RecordBatch.from_pydict({
                "fold": pa.array(np.full(size * size, f), pa.int32()),
                "at": pa.array(np.arange(size * size), pa.int32()), "s": pa.array(g.ravel())})
    source = df.select((F.col(fold) if fold else F.lit(0)).cast("int").alias("fold"),
                       *[F.col(c).cast("double") for c in [*columns, y]])
    rows = source.mapInArrow(partial, "fold int, at int, s double").groupBy("fold", "at").agg(
        F.sum("s").alias("s")).collect()  # folds x (features + 2)^2 numbers
    out = {f: np.zeros(size * size) for f in sorted({r["fold"] for r in rows})}
    for r in rows:
        out[r["fold"]][r["at"]] = r["s"]
    return {f: g.reshape(size, size) for f, g in out.items()}


def bootstrap_grams(df: DataFrame, columns: list[str], y: str, id_col: str, members: int, seed: int = 0) -> list[np.ndarray]:
    """Gram matrices of ``members`` bootstrap draws in one pass: each row counts Poisson(1) times in each draw.

    The counts come from hashes of the row's id, so a task that runs again draws the same.
    """
    size = len(columns) + 2
    steps = np.cumsum([math.exp(-1.0) / math.factorial(k) for k in range(12)])

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((members, size, size))
        for b in batches:
            keys = b.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            data = np.column_stack([np.ones(b.num_rows)] + [
                b.column(i).to_numpy(zero_copy_only=False) for i in range(1, b.num_columns)])
            for m in range(members):
                h = (keys ^ np.uint64(m + 1)) * np.uint64(0x9E3779B97F4A7C15)
                h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
                times = np.searchsorted(steps, (h >> np.uint64(11)).astype(float) / 2.0**53)
                sums[m] += (data * times[:, None]).T @ data
        yield pa.RecordBatch.from_pydict({
            "at": pa.array(np.arange(sums.size), pa.int32()), "s": pa.array(sums.ravel())})
    source = df.select(F.xxhash64(F.col(id_col), F.lit(seed)).alias("key"), *[F.col(c).cast("double") for c in [*columns, y]])
    rows = source.mapInArrow(partial, "at int, s double").groupBy("at").agg(F.sum("s").alias("s")).collect()  # members x (features + 2)^2
    out = np.zeros(members * size * size)
    for r in rows:
        out[r["at"]] = r["s"]
    return list(out.reshape(members, size, size))


def total(grams: dict[int, np.ndarray], without: int | None = None) -> np.ndarray:
    return sum(g for f, g in grams.items() if f != without)


def _centred(gram: np.ndarray) -> tuple[float, np.ndarray, np.ndarray, np.ndarray, float]:
    n, mean = gram[0, 0], gram[0, 1:] / gram[0, 0]
    cov = gram[1:, 1:] - n * np.outer(mean, mean)
    return n, cov[:-1, :-1], cov[:-1, -1], mean[:-1], mean[-1]


def ridge(gram: np.ndarray, alpha: float = 0.0) -> np.ndarray:
    """Intercept and weights minimising squared error plus ``alpha |w|^2`` (0 = least squares)."""
    _, xx, xy, mx, my = _centred(gram)
    w = np.linalg.lstsq(xx + alpha * np.eye(len(xy)), xy, rcond=None)[0]
    return np.concatenate(([my - mx @ w], w))


def elastic_net(gram: np.ndarray, alpha: float, l1_ratio: float, tol: float = 1e-4,
                selection: str = "cyclic", rounds: int = 10000, seed: int = 0) -> np.ndarray:
    """Coordinate descent on the Gram matrix for the usual elastic-net objective."""
    n, xx, xy, mx, my = _centred(gram)
    w, l1, l2 = np.zeros(len(xy)), alpha * l1_ratio * n, alpha * (1 - l1_ratio) * n
    order, rng = np.arange(len(xy)), np.random.default_rng(seed)
    for _ in range(rounds):
        if selection == "random":
            rng.shuffle(order)
        step = 0.0
        for j in order:
            if xx[j, j] <= 0:
                continue
            rest = xy[j] - xx[j] @ w + xx[j, j] * w[j]
            new = np.sign(rest) * max(abs(rest) - l1, 0.0) / (xx[j, j] + l2)
            step, w[j] = max(step, abs(new - w[j])), new
        if step <= tol * max(np.abs(w).max(), 1e-12):
            break
    return np.concatenate(([my - mx @ w], w))


def squared_error(gram: np.ndarray, beta: np.ndarray) -> float:
    v = np.append(beta, -1.0)
    return float(v @ gram @ v)


def r2(gram: np.ndarray, beta: np.ndarray) -> float:
    """R2 of a model on the rows behind a Gram matrix."""
    sst = gram[-1, -1] - gram[0, -1] ** 2 / gram[0, 0]
    return 1 - squared_error(gram, beta) / sst if sst > 0 else 0.0


def subset(gram: np.ndarray, features: tuple[int, ...]) -> np.ndarray:
    keep = [0, *[f + 1 for f in features], gram.shape[0] - 1]
    return gram[np.ix_(keep, keep)]


def standardised(gram: np.ndarray) -> np.ndarray:
    """Factors that scale the columns of a Gram matrix to unit population deviation."""
    n, mean = gram[0, 0], gram[0] / gram[0, 0]
    var = np.diag(gram) / n - mean ** 2
    scale = np.where(var > 1e-12, 1 / np.sqrt(np.maximum(var, 1e-300)), 1.0)
    scale[0] = scale[-1] = 1.0
    return scale


FITTERS = {
    "Linear": lambda g, **p: ridge(g),
    "Ridge": lambda g, alpha=1.0, **p: ridge(g, float(alpha)),
    "Elastic": lambda g, alpha=1.0, l1_ratio=0.5, tol=1e-4, selection="cyclic", **p: elastic_net(
        g, float(alpha), float(l1_ratio), float(tol), selection),
}


def cross_validate(grams: dict[int, np.ndarray], model: str, params: dict, leaky: bool = False) -> list[float]:
    """R2 per held-out fold. Features are scaled on the training folds, or on all rows if leaky."""
    scores = []
    for f, held in grams.items():
        train = total(grams, without=f)
        s = standardised(total(grams) if leaky else train)
        scale = np.outer(s, s)
        scores.append(r2(held * scale, FITTERS[model](train * scale, **params)))
    return scores
