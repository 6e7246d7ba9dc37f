"""Approximate nearest neighbours: one navigable small-world graph per shard, results merged.

Vectors are dealt over shards by a hash of their number. A shard's graph is built by insertion: levels drawn from a
hash, each layer's new points searched in the graph so far and linked to a diverse choice of what was found.
It is stored as flat neighbour arrays. All queries are searched in all shards, in blocks, and the nearest of
all shards are ranked by exact distance.

Defined cases: vectors that are null, empty, zero or hold null or non-finite components take no part, as
query or candidate, nor do rows with a null id; vectors of different lengths don't meet; equal vectors stand in the
graph once and come back with all their rows (ties to the smaller id). Rows with a repeated id are rows of their own: each
different vector of a query's id is a query (``query_key`` tells them apart), and a query leaves out its own row only.
An empty table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import materialize
from .common import bound_batches, mix64
from .vectors import asked_vectors, block_count, every, finite, members, pack, ranked

LINKS = 16              # per point and layer; twice as many on the lowest
BUILD_WIDTH = 64
SEARCH_WIDTH = 128
SHARD_ROWS = 4096
QUERY_ROWS = 1024
BATCH = 256
STEP = 4                # beam entries expanded at once


class Layer:
    """Flat neighbour array of one layer over all points of a shard (-1: free)."""

    def __init__(self, x: np.ndarray, links: int):
        self.x = x
        self.square = (x * x).sum(axis=1)
        self.near = np.full((len(x), links), -1, dtype=np.int32)

    def distances(self, q: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Squared distances less the query's own square, infinite where ``at`` is -1."""
        d = self.square[at] - 2.0 * np.matmul(self.x[at], q[:, :, None])[:, :, 0]
        return np.where(at < 0, np.inf, d)

    def search(self, q: np.ndarray, start: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Beam search of many queries side by side: ids (-1 where fewer) and distances, nearest first."""
        n = len(q)
        rows = np.arange(n)[:, None]
        beam = np.full((n, width), -1, dtype=np.int64)
        dist = np.full((n, width), np.inf)
        done = np.zeros((n, width), dtype=bool)
        seen = np.zeros((n, len(self.x) + 1), dtype=bool)
        seen[:, -1] = True      # free links point here
        beam[:, 0] = start
        dist[:, 0] = self.distances(q, start[:, None])[:, 0]
        seen[np.arange(n), start] = True
        step = min(STEP, width)
        live = np.arange(n)
        while len(live):
            open_ = np.where(done[live], np.inf, dist[live])
            pick = np.argsort(open_, axis=1, kind="stable")[:, :step]
            has = np.isfinite(np.take_along_axis(open_, pick, axis=1))
            live, pick, has = live[has[:, 0]], pick[has[:, 0]], has[has[:, 0]]
            if not len(live):
                break
            r = live[:, None]
            node = np.where(has, beam[r, pick], -1)
            done[r, pick] = True
            found = np.where(node[:, :, None] < 0, -1, self.near[node]).reshape(len(live), -1)
            found = np.sort(found, axis=1)
            found[:, 1:][found[:, 1:] == found[:, :-1]] = -1
            found = np.where(seen[r, found], -1, found)
            seen[r, found] = True
            away = self.distances(q[live], found)
            ids = np.concatenate([beam[live], found], axis=1)
            away = np.concatenate([dist[live], away], axis=1)
            was = np.concatenate([done[live], np.zeros(found.shape, dtype=bool)], axis=1)
            best = np.argpartition(away, width - 1, axis=1)[:, :width]
            beam[live] = np.take_along_axis(ids, best, axis=1)
            dist[live] = np.take_along_axis(away, best, axis=1)
            done[live] = np.take_along_axis(was, best, axis=1)
        order = np.argsort(dist, axis=1, kind="stable")
        beam, dist = beam[rows, order], dist[rows, order]
        return np.where(np.isfinite(dist), beam, -1), dist

    def diverse(self, ids: np.ndarray, dist: np.ndarray, links: int) -> np.ndarray:
        """Of candidates sorted by distance, those nearer to the point than to any chosen before; then the nearest left."""
        n, width = ids.shape
        v = self.x[ids]
        square = self.square[ids]
        between = square[:, :, None] + square[:, None, :] - 2.0 * np.matmul(v, v.transpose(0, 2, 1))
        chosen = np.zeros((n, width), dtype=bool)
        for k in range(width):
            blocked = ((between[:, k, :] < dist[:, k, None]) & chosen).any(axis=1)
            chosen[:, k] = ~blocked & (ids[:, k] >= 0) & (chosen.sum(axis=1) < links)
        rank = np.where(ids < 0, 2 * width + np.arange(width), np.where(chosen, 0, width) + np.arange(width))
        order = np.argsort(rank, axis=1)[:, :links]
        out = np.take_along_axis(ids, order, axis=1)
        if out.shape[1] < links:
            out = np.pad(out, ((0, 0), (0, links - out.shape[1])), constant_values=-1)
        return out

    def link(self, new: np.ndarray, ids: np.ndarray, dist: np.ndarray, links: int) -> None:
        """Connect new points to chosen candidates (``dist`` are full squared distances), both ways."""
        cap = self.near.shape[1]
        picked = self.diverse(ids, dist, links)
        self.near[new, :links] = picked
        to, back = picked.ravel(), np.repeat(new, links)
        to, back = to[to >= 0], back[to >= 0]
        order = np.argsort(to, kind="stable")
        to, back = to[order], back[order]
        target, first, count = np.unique(to, return_index=True, return_counts=True)
        for at in range(0, len(target), 128):
            t, f, c = (z[at:at + 128] for z in (target, first, count))
            wide = np.full((len(t), cap + int(c.max())), -1, dtype=np.int64)
            wide[:, :cap] = self.near[t]
            place = np.arange(c.sum()) - np.repeat(np.cumsum(c) - c, c)
            wide[np.repeat(np.arange(len(t)), c), cap + place] = back[f[0]:f[0] + c.sum()]
            wide.sort(axis=1)
            wide[:, 1:][wide[:, 1:] == wide[:, :-1]] = -1
            away = self.distances(self.x[t], wide) + self.square[t][:, None]
            order = np.argsort(away, axis=1, kind="stable")
            wide, away = np.take_along_axis(wide, order, axis=1), np.take_along_axis(away, order, axis=1)
            self.near[t] = self.diverse(wide, away, cap)


class Graph:
    """The layers of one shard, lowest first, and the point where searches start."""

    def __init__(self, x: np.ndarray, layers: list[Layer], entry: int):
        self.x, self.layers, self.entry = x, layers, entry

    @classmethod
    def build(cls, x: np.ndarray, ids: np.ndarray) -> Graph:
        x = x.astype(np.float32)
        n = len(x)
        u = (mix64(ids.astype(np.int64).view(np.uint64)).astype(np.float64) + 1.0) / 2.0**64
        level = np.minimum(np.floor(-np.log(u) / np.log(LINKS)).astype(int), 8)
        order = np.argsort(-level, kind="stable")       # points of higher layers come first in each layer
        layers = [Layer(x, 2 * LINKS if k == 0 else LINKS) for k in range(int(level.max()) + 1)]
        graph = cls(x, layers, int(order[0]))
        for k in range(len(layers) - 1, -1, -1):
            inside = order[level[order] >= k]
            at = 1
            while at < len(inside):
                new = inside[at:at + min(BATCH, at)]
                graph._insert(k, new, inside[:at])
                at += len(new)
        return graph

    def _insert(self, k: int, new: np.ndarray, old: np.ndarray) -> None:
        layer = self.layers[k]
        q = self.x[new]
        start = self._descend(q, k) if k + 1 < len(self.layers) else np.full(len(new), self.entry)
        ids, dist = layer.search(q, start, min(BUILD_WIDTH, len(old)))
        own = layer.square[new][:, None]
        fellow = own.T - 2.0 * (q @ q.T)
        earlier = np.tril(np.ones((len(new), len(new)), dtype=bool), -1)
        fellow = np.where(earlier, fellow, np.inf)
        near = np.argsort(fellow, axis=1)[:, :LINKS]
        more = np.take_along_axis(fellow, near, axis=1)
        ids = np.concatenate([ids, np.where(np.isfinite(more), new[near], -1)], axis=1)
        dist = np.concatenate([dist, more], axis=1) + own
        order = np.argsort(dist, axis=1, kind="stable")
        layer.link(new, np.take_along_axis(ids, order, axis=1), np.take_along_axis(dist, order, axis=1), LINKS)

    def _descend(self, q: np.ndarray, k: int) -> np.ndarray:
        at = np.full(len(q), self.entry)
        for layer in reversed(self.layers[k + 1:]):
            at = layer.search(q, at, 1)[0][:, 0]
        return at

    def search(self, q: np.ndarray, width: int) -> np.ndarray:
        """Positions of the nearest points found, -1 where fewer."""
        q = q.astype(np.float32)
        return self.layers[0].search(q, self._descend(q, 0), min(width, max(len(self.x), 1)))[0]

    def flat(self) -> bytes:
        """Entry, number of layers, then each layer's neighbour array."""
        head = np.array([self.entry, len(self.layers)], dtype=np.int32)
        return b"".join([head.tobytes(), *(layer.near.tobytes() for layer in self.layers)])

    @classmethod
    def from_flat(cls, x: np.ndarray, raw: bytes) -> Graph:
        x = x.astype(np.float32)
        entry, count = np.frombuffer(raw, dtype=np.int32, count=2)
        at, layers = 8, []
        for k in range(count):
            layer = Layer(x, 2 * LINKS if k == 0 else LINKS)
            layer.near = np.frombuffer(raw, dtype=np.int32, count=layer.near.size, offset=at).reshape(layer.near.shape)
            at += layer.near.nbytes
            layers.append(layer)
        return cls(x, layers, int(entry))


def build_index(rows: DataFrame, shards: int) -> DataFrame:
    """(shard, dim, ids, data, first, graph): one graph per shard, over (id, vector, first) rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            graphs = []
            for ids, data, dim in zip(*(batch.column(c).to_pylist() for c in ("ids", "data", "dim")), strict=True):
                x = np.frombuffer(data, dtype=np.float64).reshape(-1, dim)
                graphs.append(Graph.build(x, np.frombuffer(ids, dtype=np.int64)).flat())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(graphs, pa.binary())], [*batch.schema.names, "graph"])

    return pack(rows, shards, "float64", "shard", "first").mapInArrow(
        run, "shard int, dim int, ids binary, data binary, first binary, graph binary")


def search_index(index: DataFrame, queries: DataFrame, query_blocks: int, k: int, width: int) -> DataFrame:
    """(query, rep, first, score): the k nearest found in every shard, with exact distances."""
    asked = pack(queries, query_blocks, "float64", "q").select("q", "dim", F.col("ids").alias("q_ids"), F.col("data").alias("q_data"))
    cells = index.select("*", every("q", query_blocks)).join(asked, ["q", "dim"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                x = np.frombuffer(row["data"], dtype=np.float64).reshape(-1, row["dim"])
                q = np.frombuffer(row["q_data"], dtype=np.float64).reshape(-1, row["dim"])
                ids, asked, first = (np.frombuffer(row[c], dtype=np.int64) for c in ("ids", "q_ids", "first"))
                graph = Graph.from_flat(x, row["graph"])
                for at in range(0, len(q), BATCH):
                    part = q[at:at + BATCH]
                    found = graph.search(part, width)[:, :4 * k]
                    who, slot = np.nonzero(found >= 0)
                    pos = found[who, slot]
                    exact = np.sqrt(((x[pos] - part[who]) ** 2).sum(axis=1))
                    order = np.lexsort((first[pos], exact, who))
                    who, pos, exact = who[order], pos[order], exact[order]
                    place = np.arange(len(who)) - np.searchsorted(who, who)
                    keep = place < k
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(asked[at + who[keep]]), pa.array(ids[pos[keep]]), pa.array(first[pos[keep]]), pa.array(exact[keep])],
                        ["query", "rep", "first", "score"])

    return cells.select("dim", "ids", "data", "first", "graph", "q_ids", "q_data").mapInArrow(
        run, "query long, rep long, first long, score double")


def nearest(rows: DataFrame, is_query: Column, k: int = 10, id_col: str = "vec_id", vector: str = "embedding",
            shard_rows: int = SHARD_ROWS, width: int = SEARCH_WIDTH) -> DataFrame:
    """query_id, rank, id, score (Euclidean distance) of each query's k nearest other rows, as found."""
    bound_batches(rows.sparkSession, rows=10_000)
    usable = rows.where(finite(vector) & F.exists(vector, lambda x: x != 0) & F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vector"), is_query.alias("asked"))
    known = materialize(members(usable, k + 1), "vectors")
    reps = known.where("place = 1").select(F.col("rep").alias("id"), "vector", "first")
    queries = materialize(asked_vectors(usable.where("asked"), reps), "queries")
    query_reps = reps.select("id", "vector").join(queries.select(F.col("rep").alias("id")).distinct(), "id", "left_semi")
    shards, blocks = block_count(reps.count(), shard_rows), block_count(query_reps.count(), QUERY_ROWS)
    index = materialize(build_index(reps, shards).repartition(shards, "shard"), "graphs")
    found = search_index(index, query_reps, blocks, k + 1, width)
    best = Window.partitionBy("query").orderBy("score", "first", "rep")
    found = found.withColumn("n", F.row_number().over(best)).where(F.col("n") <= k + 1).drop("n", "first")
    return ranked(queries, found, known, F.asc("score"), k, id_col)
