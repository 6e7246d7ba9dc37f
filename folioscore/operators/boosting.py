"""Boosted regression trees on whole tables, from histograms of cells.

Trees only see between which cuts a value lies, so rows with the same places (a cell) share every prediction. Rows are
dealt once, sorted by cell and target; they stay in tasks with the prediction of each cell. A tree takes a job for every two
levels: histograms of pairs of columns tell a node's cut and those of the nodes below it. The driver gets histograms alone.

Trees, losses and cuts are those of Spark ML's ``GBTRegressor``: the first tree learns the target, each other one the
negative gradient, times the rate; cuts come from about ``CUT_ROWS`` rows (all, if there are fewer). A tree's share of the
rows is drawn by hash of cell, target and tree, so reruns agree.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import RDD, StorageLevel, keyword_only
from pyspark.errors import IllegalArgumentException
from pyspark.ml import Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame, functions as F

from folioscore.session import scratch_root

BINS = 32                   # places per column
CUT_ROWS = 10_000           # rows that cuts are taken from, about
CHUNK_ROWS = 1 << 20        # rows of a piece that tasks keep
PARTITION_ROWS = 20_000     # a task more for each so many rows, up to the cores
DEEP_ROWS = 4 << 20         # and beyond them, so that no partition has more
HISTOGRAM_BYTES = 4 << 20   # histograms a task sends at once
CUT_LINEAGE = 25            # trees between two checkpoints
PAIR_COLUMNS = 5            # up to so many columns, one job gives two levels: no more pairs than twice the columns
SMALL = 1 << 24             # up to so many rows, a count and a sum of signs share one float

Tree = dict[str, np.ndarray]    # feature (-1: a leaf), cut (its number), left (right is next), value; by node, root first


# ------------------------------------------------------------------ cuts and cells

def find_cuts(values: np.ndarray, bins: int) -> np.ndarray:
    """Cuts that part sorted values into nearly equal shares, midway between neighbours; all, if these are few."""
    distinct, counts = np.unique(values, return_counts=True)
    middle = (distinct[:-1] + distinct[1:]) / 2
    if len(middle) < bins:
        return middle
    stride, out = len(values) / bins, []
    target, before = stride, counts[0]
    for m, n in zip(middle.tolist(), counts[1:].tolist()):
        if abs(before - target) < abs(before + n - target):
            out.append(m)
            target += stride
        before += n
    return np.array(out)


def _usable(df: DataFrame, columns: list[str], y: str) -> DataFrame:
    """Features and target as doubles; null or NaN features, null or non-finite targets are refused."""
    target = F.col(y).cast("double")
    refused = target.isNull() | F.isnan(target) | (F.abs(target) == float("inf"))
    return df.select(*_features(columns), F.when(refused, F.raise_error(F.lit("targets must be finite numbers")).cast("double"))
                     .otherwise(target).alias("__y"))


def _features(columns: list[str]) -> list[Column]:
    def one(c: str) -> Column:
        v = F.col(c).cast("double")
        return F.when(v.isNull() | F.isnan(v), F.raise_error(F.lit(f"null or NaN in {c}")).cast("double")).otherwise(v)
    return [one(c).alias(c) for c in columns]


def _codes(cuts: list[np.ndarray], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(places of a row, one byte a column; target)."""
    for batch in batches:
        n = batch.num_rows
        places = np.stack([np.searchsorted(e, batch.column(j).to_numpy(), side="left") for j, e in enumerate(cuts)], axis=1)
        ends = np.arange(n + 1, dtype=np.int32) * len(cuts)
        cells = pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(ends), pa.py_buffer(places.astype(np.uint8).tobytes())])
        yield pa.RecordBatch.from_arrays([cells, batch.column(len(cuts))], ["cell", "y"])


def _pieces(width: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (cell, y, n) rows as pieces of arrays: places by column and cell, first row of each cell, targets, numbers of rows."""
    waiting: list[pa.RecordBatch] = []

    def piece() -> pa.RecordBatch:
        t = pa.Table.from_batches(waiting)
        codes = np.frombuffer(b"".join(t.column("cell").to_pylist()), dtype=np.uint8).reshape(-1, width)
        new = np.ones(len(codes), dtype=bool)
        new[1:] = (codes[1:] != codes[:-1]).any(axis=1)
        first, n = np.flatnonzero(new), t.column("n").to_numpy()
        arrays = (np.ascontiguousarray(codes[first].T), first, t.column("y").to_numpy(), n if (n > 1).any() else n[:0])
        return pa.RecordBatch.from_arrays([pa.array([a.tobytes()], pa.binary()) for a in arrays], ["codes", "first", "y", "n"])

    for batch in batches:
        waiting.append(batch)
        if sum(b.num_rows for b in waiting) >= CHUNK_ROWS:
            yield piece()
            waiting = []
    if sum(b.num_rows for b in waiting):
        yield piece()


# ------------------------------------------------------------------ work in tasks

def _mixed(v: np.ndarray) -> np.ndarray:
    v = (v ^ (v >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    v = (v ^ (v >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return v ^ (v >> np.uint64(31))


def drawn(key: np.ndarray, n: np.ndarray, share: float, tree: int) -> np.ndarray:
    """How many of ``n`` equal rows (one, where n is empty) are in a tree's share; keys of 32 bits, hashed anew per tree."""
    if share >= 1:
        return n if len(n) else np.ones(len(key), dtype=np.int64)
    limit = np.uint64(int(share * 2.0 ** 64))
    factor, more = np.random.default_rng(tree).integers(0, 2 ** 64, 2, dtype=np.uint64) | np.array([1, 0], dtype=np.uint64)

    def hit(k: np.ndarray) -> np.ndarray:
        h = k.astype(np.uint64)
        h *= factor
        h += more
        return h < limit
    out = hit(key).astype(np.int64)
    for i in range(1, min(int(n.max(initial=1)), 64)):
        some = np.flatnonzero(n > i)
        out[some] += hit(_mixed(key[some].astype(np.uint64) + np.uint64(i << 32)) >> np.uint64(32))
    for i in np.flatnonzero(n > 64):
        out[i] += np.random.default_rng((tree, int(key[i]))).binomial(int(n[i]) - 64, share)
    return out


def leaf_of(tree: Tree, codes: np.ndarray) -> np.ndarray:
    """Node that each cell ends in."""
    inner, deep = tree["feature"] >= 0, np.zeros(len(tree["feature"]), dtype=int)
    for i in np.flatnonzero(inner).tolist():
        deep[tree["left"][i]:tree["left"][i] + 2] = deep[i] + 1
    here = np.arange(len(inner))        # a leaf asks nothing and stays
    width, flat = codes.shape[1], codes.ravel()
    row = np.where(inner, tree["feature"], 0) * width
    cut, left = np.where(inner, tree["cut"], 255), np.where(inner, tree["left"], here)
    node, at = np.zeros(width, dtype=np.int64), np.arange(width)
    for _ in range(int(deep.max())):
        node = left.take(node) + (flat.take(row.take(node) + at) > cut.take(node))
    return node


def _start(share: float, start: float, row) -> tuple:
    """Rows as arrays, and the prediction of each cell; the keys, for shares of rows, tell apart rows of different cells or targets."""
    first, y, n = np.frombuffer(row["first"], dtype=np.int64), np.frombuffer(row["y"]), np.frombuffer(row["n"], dtype=np.int64)
    codes, key = np.frombuffer(row["codes"], dtype=np.uint8).reshape(-1, len(first)), np.zeros(0, dtype=np.uint32)
    if share < 1:
        name = np.zeros(len(first), dtype=np.uint64)
        for c in codes:
            name = _mixed(name * np.uint64(257) + c.astype(np.uint64))
        key = (_mixed(_mixed(y.view(np.uint64)) ^ np.repeat(name, np.diff(np.append(first, len(y))))) >> np.uint64(32)).astype(np.uint32)
    # a cell each: their places need not be told
    return codes, first[:0] if len(first) == len(y) else first, y, n, key, np.full(len(first), start)


def _next(tree: Tree, rate: float, rows: tuple) -> tuple:
    """The rows, with a tree added to the predictions."""
    *same, at = rows
    return *same, at + rate * tree["value"][leaf_of(tree, same[0])]


def _sums(number: int, share: float, absolute: bool, rows: tuple) -> tuple:
    """Rows and sum of a tree's targets by cell."""
    _, first, y, n, key, at = rows
    miss = y - (np.repeat(at, np.diff(np.append(first, len(y)))) if len(first) else at)
    target = miss if number == 0 else np.where(miss < 0, -1.0, 1.0) if absolute else 2 * miss
    if share < 1:
        n = drawn(key, n, share, number)
    weight = n.astype(float) if len(n) else np.ones(len(y))
    target = weight * target if len(n) else target
    return (np.add.reduceat(weight, first), np.add.reduceat(target, first)) if len(first) else (weight, target)


def _histograms(tree: Tree, low: int, high: int, pairs: bool, number: int, share: float, absolute: bool,
                states: Iterator[tuple]) -> Iterator[np.ndarray]:
    """Rows and sums by node (``low`` to ``high``) and, for each column or pair of columns, place (of the first, of the second)."""
    total, bins = None, BINS * BINS if pairs else BINS
    size = (high - low) * bins
    for rows in states:
        codes, (n, s) = rows[0], _sums(number, share, absolute, rows)
        if low or high > 1:
            node = leaf_of(tree, codes) - low
            kept = np.flatnonzero((node >= 0) & (node < high - low))
            if len(kept) < len(node):
                node, n, s, codes = node[kept], n[kept], s[kept], codes[:, kept]
            node *= bins
        else:
            node = np.int16(0)
        wide = codes.astype(np.int16)
        keys = ([wide[i] * np.int16(BINS) + wide[j] for i in range(len(wide)) for j in range(i)] if pairs else wide)
        both = absolute and number > 0 and n.sum() < SMALL      # whole numbers, and so small that one holds two
        values = [n * (4.0 * SMALL) + s] if both else [n, s]
        out = np.stack([[np.bincount(node + k, v, size) for k in keys] for v in values])
        if both:
            rows_in = np.round(out[0] / (4.0 * SMALL))
            out = np.stack([rows_in, out[0] - rows_in * (4.0 * SMALL)])
        total = out if total is None else total + out
    if total is not None:
        yield total.reshape(2, len(total[0]), high - low, *([BINS, BINS] if pairs else [BINS]))


# ------------------------------------------------------------------ trees

def best_cut(n: np.ndarray, s: np.ndarray, least: int, columns: np.ndarray) -> tuple | None:
    """(column, cut, rows and sum left of it) with the largest gain in one node; (column, place) histograms."""
    rows, total = n[0].sum(), s[0].sum()
    left, sums = n.cumsum(1)[:, :-1], s.cumsum(1)[:, :-1]
    right, rest = rows - left, total - sums
    gain = sums ** 2 / np.maximum(left, 1) + rest ** 2 / np.maximum(right, 1)
    gain[(left < least) | (right < least)] = -np.inf
    gain = gain[columns]
    whole = total ** 2 / max(rows, 1)
    if not gain.size or not gain.max() > whole * (1 + 1e-12) + 1e-300:
        return None
    # the first of equal gains, whatever the order that sums were made in
    j, k = np.unravel_index(int((gain >= gain.max() * (1 - 1e-11)).argmax()), gain.shape)
    return int(columns[j]), int(k), left[columns[j], k], sums[columns[j], k]


def _margins(pairs: np.ndarray, columns: int) -> np.ndarray:
    """(rows and sums, column, place) from the pairs of one node."""
    place = {(i, j): k for k, (i, j) in enumerate((i, j) for i in range(columns) for j in range(i))}
    return np.stack([pairs[:, place[1, 0]].sum(1) if c == 0 else pairs[:, place[c, 0]].sum(2) for c in range(columns)], axis=1)


def _below(pairs: np.ndarray, columns: int, column: int, cut: int) -> list[np.ndarray]:
    """The same for the two nodes that a cut makes."""
    whole, out = _margins(pairs, columns), []
    place = {(i, j): k for k, (i, j) in enumerate((i, j) for i in range(columns) for j in range(i))}
    for side in (slice(None, cut + 1), slice(cut + 1, None)):
        own = np.zeros_like(whole)
        own[:, column, side] = whole[:, column, side]
        for c in range(columns):
            if c < column:
                own[:, c] = pairs[:, place[column, c], side].sum(1)
            elif c > column:
                own[:, c] = pairs[:, place[c, column], :, side].sum(2)
        out.append(own)
    return out


def grow(states: RDD, depth: int, least: int, width: int, columns: int, seed: int, target: tuple) -> Tree:
    """One tree: a job for two levels where histograms of pairs of columns are small, else for one; more where a level's are large.

    ``target``: number of the tree, share of the rows, absolute loss.
    """
    feature, cut, left, value = [-1], [0], [0], [0.0]
    rng = np.random.default_rng(seed)

    def tree() -> Tree:
        return {"feature": np.array(feature), "cut": np.array(cut), "left": np.array(left), "value": np.array(value)}

    def split(node: int, n: np.ndarray, s: np.ndarray) -> bool:
        some = np.arange(columns) if width == columns else np.sort(rng.choice(columns, width, replace=False))
        got = best_cut(n, s, least, some)
        if node == 0 and n[0].sum() > 0:
            value[0] = float(s[0].sum() / n[0].sum())
        if got is None:
            return False
        feature[node], cut[node], rows, total = got
        left[node] = len(feature)
        own, all_of = n[0].sum(), s[0].sum()
        for v in (total / rows, (all_of - total) / (own - rows)):
            feature.append(-1)
            cut.append(0)
            left.append(0)
            value.append(float(v))
        return True

    def found(now: Tree, a: int, b: int, pairs: bool) -> np.ndarray:
        return sum(states.mapPartitions(partial(_histograms, now, a, b, pairs, *target)).collect())

    low, level, step = 0, 0, max(1, HISTOGRAM_BYTES // (16 * columns * BINS))
    two = HISTOGRAM_BYTES // (8 * columns * (columns - 1) * BINS * BINS) if 2 <= columns <= PAIR_COLUMNS else 0
    while level < depth and low < len(feature):
        now, high = tree(), len(feature)
        if high - low <= two and level + 1 < depth:
            sums, children = found(now, low, high, True), []
            for node in range(low, high):
                pairs = sums[:, :, node - low]
                if split(node, *_margins(pairs, columns)):
                    children += _below(pairs, columns, feature[node], cut[node])
            low, high = high, len(feature)
            for node, own in zip(range(low, high), children):
                split(node, *own)
            level += 1
        else:
            for a in range(low, high, step):
                n, s = found(now, a, min(a + step, high), False)
                for node in range(a, min(a + step, high)):
                    split(node, n[:, node - a], s[:, node - a])
        low, level = high, level + 1
    return tree()


def columns_per_node(strategy: str, columns: int) -> int:
    """Number of columns a node may ask for, by the names that Spark ML has for it."""
    named = {"all": columns, "auto": columns, "onethird": math.ceil(columns / 3), "sqrt": math.ceil(math.sqrt(columns)),
             "log2": max(1, math.ceil(math.log2(columns)))}
    if strategy in named:
        return named[strategy]
    try:
        if strategy.isdigit() and int(strategy) > 0:
            return min(int(strategy), columns)
        if 0 < float(strategy) <= 1:
            return math.ceil(float(strategy) * columns)
    except ValueError:
        pass
    raise IllegalArgumentException(f"no such share of columns: {strategy}")


def boosted_trees(df: DataFrame, columns: list[str], y: str, rounds: int, depth: int, rate: float, absolute: bool,
                  share: float = 1.0, least: int = 1, per_node: str = "all", seed: int = 0) -> BoostedTrees:
    """Trees fitted on all rows of ``df``; ``share`` of them, drawn anew, per tree."""
    if not (rounds >= 1 and 0 <= depth <= 30 and 0 < rate <= 1 and 0 < share <= 1 and least >= 1):
        raise IllegalArgumentException(f"out of range: rounds {rounds}, depth {depth}, rate {rate}, share {share}, least {least}")
    spark, width = df.sparkSession, columns_per_node(per_node, len(columns))
    sc = spark.sparkContext
    usable = _usable(df, columns, y)
    rows, start = usable.agg(F.count(F.lit(1)), F.avg("__y")).first()
    if not rows:
        raise IllegalArgumentException("no rows to learn from")
    some = usable if rows <= CUT_ROWS else usable.where(
        F.pmod(F.xxhash64("__y", *columns), F.lit(1 << 40)) < int(CUT_ROWS / rows * (1 << 40)))
    marks = some.select(*columns).toArrow()
    cuts = [find_cuts(marks.column(j).to_numpy(), min(BINS, rows)) for j in range(len(columns))]

    parts = max(min(sc.defaultParallelism, 1 + rows // PARTITION_ROWS), 1 + rows // DEEP_ROWS)
    cells = usable.mapInArrow(partial(_codes, cuts), "cell binary, y double").groupBy("cell", "y").agg(F.count(F.lit(1)).alias("n"))
    pieces = cells.repartitionByRange(parts, "cell", "y").sortWithinPartitions("cell", "y").mapInArrow(
        partial(_pieces, len(columns)), "codes binary, first binary, y binary, n binary")
    states, trees = pieces.rdd.map(partial(_start, share, start)).persist(StorageLevel.MEMORY_AND_DISK), []
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(scratch_root(spark))
    for number in range(rounds):
        if number:
            new = states.map(partial(_next, trees[-1], 1.0 if number == 1 else rate)).persist(StorageLevel.MEMORY_AND_DISK)
            if number % CUT_LINEAGE == CUT_LINEAGE - 1:
                new.checkpoint()
        else:
            new = states
        trees.append(grow(new, depth, least, width, len(columns), seed + number, (number, share, absolute)))
        if number:
            states.unpersist()
        states = new
    states.unpersist()
    flat = []
    for t in trees:
        cut = [float(cuts[f][k]) if f >= 0 else 0.0 for f, k in zip(t["feature"].tolist(), t["cut"].tolist())]
        flat.append([*map(float, t["feature"]), *cut, *map(float, t["left"]), *t["value"].tolist()])
    return BoostedTrees(inputCols=columns, trees=flat, start=start, rate=rate)


# ------------------------------------------------------------------ the model

class BoostedTrees(Transformer, HasInputCols, DefaultParamsReadable, DefaultParamsWritable):
    """Adds ``prediction``; a pipeline stage, saved and loaded like others."""

    trees = Param(Params._dummy(), "trees", "per tree: features, cuts, left nodes, values", TypeConverters.toListListFloat)
    start = Param(Params._dummy(), "start", "what all predictions begin with", TypeConverters.toFloat)
    rate = Param(Params._dummy(), "rate", "weight of all trees but the first", TypeConverters.toFloat)

    @keyword_only
    def __init__(self, *, inputCols=None, trees=None, start=None, rate=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        columns = self.getInputCols()
        score = partial(_scores, _placed(self.getOrDefault("trees"), len(columns)), self.getOrDefault("start"), self.getOrDefault("rate"))

        @F.pandas_udf("double")
        def prediction(parts: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
            for x in parts:
                yield pd.Series(score(x.to_numpy(dtype=float)))
        return dataset.withColumn("prediction", prediction(F.struct(*_features(columns))))


def _placed(flat: list[list[float]], columns: int) -> tuple[list[np.ndarray], list[Tree]]:
    """Cuts by column, and trees that ask for their numbers."""
    trees = [dict(zip(("feature", "cut", "left", "value"), np.array(f).reshape(4, -1))) for f in flat]
    for t in trees:
        t["feature"], t["left"] = t["feature"].astype(np.int64), t["left"].astype(np.int64)
    edges = [np.unique(np.concatenate([np.zeros(0), *[t["cut"][t["feature"] == j] for t in trees]])) for j in range(columns)]
    for t in trees:
        t["cut"] = np.array([np.searchsorted(edges[f], c) if f >= 0 else 0 for f, c in zip(t["feature"], t["cut"])])
    return edges, trees


def _scores(model: tuple[list[np.ndarray], list[Tree]], start: float, rate: float, x: np.ndarray) -> np.ndarray:
    edges, trees = model
    codes = np.stack([np.searchsorted(e, c, side="left") for e, c in zip(edges, x.T)]).astype(np.uint8)
    cells, of = np.unique(codes, axis=1, return_inverse=True)
    out = np.full(cells.shape[1], start)
    for i, t in enumerate(trees):
        out += (rate if i else 1.0) * t["value"][leaf_of(t, cells)]
    return out[of.ravel()]
