"""Kernel regression with an epsilon-insensitive loss on landmark features.

A row is mapped to its kernel values against a fixed number of landmark rows (Nystrom); the
linear machine on top is fitted by reweighted least squares, one distributed aggregate of a
landmark-sized matrix per step. The memory of a fit does not depend on the number of rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from folioscore.operators.evaluate import split_order


def kernel(kind: str, x: np.ndarray, z: np.ndarray, gamma: float, degree: int, coef0: float = 0.0) -> np.ndarray:
    dot = x @ z.T
    if kind == "rbf":
        return np.exp(-gamma * np.maximum((x * x).sum(1)[:, None] + (z * z).sum(1) - 2 * dot, 0))
    if kind == "poly":
        return (gamma * dot + coef0) ** degree
    if kind == "sigmoid":
        return np.tanh(gamma * dot + coef0)
    return dot


def gamma_value(gamma: str | float, features: int, variance: float) -> float:
    """``scale`` and ``auto`` as in the usual definitions, or the number itself."""
    if gamma == "scale":
        return 1.0 / (features * variance) if variance else 1.0
    return 1.0 / features if gamma == "auto" else float(gamma)


def fit_svr(df: DataFrame, columns: list[str], y: str, id_col: str, kind: str = "rbf", gamma: str | float = 0.1,
            degree: int = 3, c: float = 1.0, epsilon: float = 0.1, landmarks: int = 64, steps: int = 12) -> dict:
    """Landmarks, kernel settings and weights of a fitted machine on (already scaled) columns."""
    x = [F.col(k).cast("double").alias(k) for k in columns]
    spread = F.array(*[F.var_pop(k) + F.avg(k) * F.avg(k) for k in columns]), F.array(*[F.avg(k) for k in columns])
    second, mean = df.agg(*[s.alias(n) for s, n in zip(spread, "sm")]).first()
    g = gamma_value(gamma, len(columns), float(np.mean(second) - np.mean(mean) ** 2))
    chosen = df.orderBy(split_order(id_col, 0)).select(*x).limit(landmarks).collect()
    z = np.array(chosen, dtype=float).reshape(-1, len(columns))
    vals, vecs = np.linalg.eigh(kernel(kind, z, z, g, degree))
    keep = np.abs(vals) > 1e-9 * max(np.abs(vals).max(), 1e-12)
    root = vecs[:, keep] / np.sqrt(np.abs(vals[keep]))
    data = df.select(*x, F.col(y).cast("double").alias("__y"))
    w = np.zeros(root.shape[1] + 1)
    for step in range(steps):
        gram = _weighted_gram(data, z, root, w, (kind, g, degree), c, epsilon, first=step == 0)
        penalty = np.eye(len(w))
        penalty[0, 0] = 1e-9
        new = np.linalg.solve(gram[:-1, :-1] + penalty, gram[:-1, -1])
        done = np.abs(new - w).max() <= 1e-6 * max(np.abs(new).max(), 1e-12)
        w = new
        if done:
            break
    return {"kind": kind, "gamma": g, "degree": degree, "landmarks": z, "weights": root @ w[1:], "intercept": float(w[0])}


def _weighted_gram(data: DataFrame, z, root, w, how, c: float, epsilon: float, first: bool) -> np.ndarray:
    size = len(w) + 1

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        acc = np.zeros((size, size))
        for b in batches:
            m = np.column_stack([b.column(i).to_numpy(zero_copy_only=False) for i in range(b.num_columns)])
            phi = np.column_stack([np.ones(len(m)), kernel(how[0], m[:, :-1], z, how[1], how[2]) @ root])
            r = m[:, -1] - phi @ w
            out = np.abs(r) - epsilon
            a = np.ones(len(m)) if first else np.where(out > 0, c / np.maximum(out, 1e-4), 0.0)
            target = m[:, -1] if first else m[:, -1] - epsilon * np.sign(r)
            full = np.column_stack([phi, target])
            acc += full.T @ (full * a[:, None])
        yield pa.RecordBatch.from_pydict({"at": pa.array(np.arange(size * size), pa.int32()), "s": pa.array(acc.ravel())})
    rows = data.mapInArrow(partial, "at int, s double").groupBy("at").agg(F.sum("s").alias("s")).collect()
    out = np.zeros(size * size)
    for r in rows:
        out[r["at"]] = r["s"]
    return out.reshape(size, size)


def prediction_sql(model: dict, columns: list[str]) -> str:
    """The fitted function as a SQL expression, so that it stays in the JVM and can be saved."""
    arr = "array(" + ",".join(f"cast({c} as double)" for c in columns) + ")"
    marks = ",".join("struct(array(" + ",".join(f"{v!r}D" for v in map(float, z)) + f") as z, {float(a)!r}D as a)"
                     for z, a in zip(model["landmarks"], model["weights"]))
    g, add = float(model["gamma"]), "(s, t) -> s + t"
    dot = f"aggregate(zip_with(l.z, {arr}, (p, q) -> p * q), 0D, {add})"
    form = {"rbf": f"exp(-{g!r}D * aggregate(zip_with(l.z, {arr}, (p, q) -> (p - q) * (p - q)), 0D, {add}))",
            "poly": f"power({g!r}D * {dot}, {model['degree']})", "sigmoid": f"tanh({g!r}D * {dot})", "linear": dot}[model["kind"]]
    return f"{model['intercept']!r}D + aggregate(array({marks}), 0D, (acc, l) -> acc + l.a * {form})"
