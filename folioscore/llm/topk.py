"""Exact top-k search by integer inner product with a three-phase uniform threshold.

Components are cut into slices, and each slice scores all candidates on its own. Phase one gathers the
highest entries of every slice's list and scores the rows met exactly; the k-th best is a score that k rows are known
to reach. Phase two sends that cutoff to all blocks, and each list returns its entries of at least cutoff / slices:
a row that no list returns stays below the cutoff. The rows that all lists return raise it. Phase three drops rows whose known parts plus the most
the missing ones can add fall short, and resolves what is left exactly.

Defined cases: vectors that are null, empty or hold null or non-finite components and rows with a null id take no
part; vectors of different lengths don't meet; equal vectors are scored once and come back with all their rows.
Rows with a repeated id are rows of their own: each different vector of a query's id is a query (``query_key`` tells
them apart), and a query leaves out its own row only. Products are 64-bit integers: components whose scaled values
reach 2^31 divided by the root of the dimension may leave that range, and their rows take no part. With fewer than k
rows all come back; an empty table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import materialize
from .common import bound_batches
from .vectors import asked_vectors, block_count, every, finite, members, pack, ranked

SLICES = 2
ROW_BLOCK = 8192
QUERY_BLOCK = 1024
GATHER = 4              # phase one takes so many times k entries of each list: a higher cutoff for little
LOW = -(1 << 62)


def _product(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Integer products of all rows, in double precision where that is exact."""
    top = float(np.abs(q).max(initial=0)) * float(np.abs(x).max(initial=0)) * max(q.shape[1], 1)
    if top < 2.0**52:
        return (q.astype(np.float64) @ x.astype(np.float64).T).astype(np.int64)
    return q @ x.T


def _cell(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    take = lambda c: np.frombuffer(row[c], dtype=np.int64)
    return (take("q_ids"), take("q_data").reshape(-1, row["dim"]), take("ids"), take("data").reshape(-1, row["dim"]))


def _slices(dim: int, slices: int) -> list[slice]:
    cuts = [dim * g // slices for g in range(slices + 1)]
    return [slice(a, b) for a, b in zip(cuts, cuts[1:], strict=False)]


def _lists(cells: DataFrame, k: int, slices: int) -> DataFrame:
    """Phase one: (query, g, rep, part), the k highest entries of each slice and block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                asked, q, ids, x = _cell(row)
                for at in range(0, len(q), 256):
                    for g, s in enumerate(_slices(row["dim"], slices)):
                        part = _product(q[at:at + 256, s], x[:, s])
                        top = np.argpartition(-part, min(k, len(ids)) - 1, axis=1)[:, :k]
                        n = top.shape[1]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.repeat(asked[at:at + 256], n)), pa.array(np.full(top.size, g, dtype=np.int32)),
                             pa.array(ids[top.ravel()]), pa.array(np.take_along_axis(part, top, axis=1).ravel())],
                            ["query", "g", "rep", "part"])

    return cells.mapInArrow(run, "query long, g int, rep long, part long")


def _above(cells: DataFrame, slices: int) -> DataFrame:
    """Phase two: entries of every slice's list that reach the query's cutoff / slices."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                asked, q, ids, x = _cell(row)
                least = -(-np.frombuffer(row["cutoff"], dtype=np.int64) // slices)
                for at in range(0, len(q), 256):
                    for g, s in enumerate(_slices(row["dim"], slices)):
                        part = _product(q[at:at + 256, s], x[:, s])
                        who, pos = np.nonzero(part >= least[at:at + 256, None])
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(asked[at + who]), pa.array(np.full(len(who), g, dtype=np.int32)), pa.array(ids[pos]),
                             pa.array(part[who, pos])], ["query", "g", "rep", "part"])

    return cells.mapInArrow(run, "query long, g int, rep long, part long")


def _resolve(cells: DataFrame, pairs: DataFrame, blocks: int, query_blocks: int) -> DataFrame:
    """Exact totals of (query, rep) pairs, worked out where both blocks meet."""

    def bundle(key: tuple, table: pa.Table) -> pa.Table:
        return pa.table({"q": pa.array([key[0].as_py()], pa.int32()), "b": pa.array([key[1].as_py()], pa.int32()),
                         "who": pa.array([table.column("query").to_numpy().tobytes()], pa.binary()),
                         "what": pa.array([table.column("rep").to_numpy().tobytes()], pa.binary())})

    home = lambda c, n: F.pmod(F.xxhash64(c), F.lit(n)).cast("int")  # noqa: E731  as pack() deals them
    bundles = pairs.select("query", "rep", home("query", query_blocks).alias("q"), home("rep", blocks).alias("b")).groupBy(
        "q", "b").applyInArrow(bundle, "q int, b int, who binary, what binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                asked, q, ids, x = _cell(row)
                who, what = (np.frombuffer(row[c], dtype=np.int64) for c in ("who", "what"))
                i, j = (np.minimum(np.searchsorted(a, b), len(a) - 1) for a, b in ((asked, who), (ids, what)))
                here = (asked[i] == who) & (ids[j] == what)      # both have this vector length
                for at in range(0, len(who), 1 << 16):
                    ok = np.flatnonzero(here[at:at + (1 << 16)]) + at
                    total = (q[i[ok]] * x[j[ok]]).sum(axis=1)
                    yield pa.RecordBatch.from_arrays([pa.array(who[ok]), pa.array(what[ok]), pa.array(total)],
                                                     ["query", "rep", "total"])

    return cells.join(bundles, ["q", "b"]).mapInArrow(run, "query long, rep long, total long")


def top_products(rows: DataFrame, is_query: Column, k: int = 20, scale: float = 64.0, id_col: str = "vec_id",
                 vector: str = "embedding", slices: int = SLICES) -> DataFrame:
    """query_id, rank, id, score: each query's k highest integer products floor(scale * x) . floor(scale * y)."""
    bound_batches(rows.sparkSession, rows=10_000)
    scaled = F.transform(F.col(vector).cast("array<double>"), lambda x: F.floor(F.lit(scale) * x).cast("long"))
    usable = rows.where(finite(vector) & F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("id"), scaled.alias("vector"), is_query.alias("asked"))
    usable = usable.where(~F.exists("vector", lambda x: F.abs(x).cast("double") * F.sqrt(F.size("vector")) >= 2.0**31))
    need = k + 1        # a query's own row may be among them
    known = materialize(members(usable, need), "vectors")
    reps = known.where("place = 1").select(F.col("rep").alias("id"), "vector", "first")
    queries = materialize(asked_vectors(usable.where("asked"), reps), "queries")
    asked = reps.select("id", "vector").join(queries.select(F.col("rep").alias("id")).distinct(), "id", "left_semi")
    blocks, query_blocks = block_count(reps.count(), ROW_BLOCK), block_count(asked.count(), QUERY_BLOCK)
    stored = materialize(pack(reps, blocks, "int64", "b"), "blocks")

    def cells(questions: DataFrame, extra: str | None = None) -> DataFrame:
        sent = pack(questions, query_blocks, "int64", "q", extra).withColumnsRenamed({"ids": "q_ids", "data": "q_data"})
        return stored.select("*", every("q", query_blocks)).join(sent, ["q", "dim"]).repartition("q", "b")

    lists = _lists(cells(asked), GATHER * need, slices)
    best = Window.partitionBy("query", "g").orderBy(F.desc("part"), "rep")
    gathered = lists.withColumn("n", F.row_number().over(best)).where(F.col("n") <= GATHER * need).select("query", "rep").distinct()
    totals = _resolve(cells(asked), gathered, blocks, query_blocks)
    order = Window.partitionBy("query").orderBy(F.desc("total"))
    cutoffs = totals.withColumn("n", F.row_number().over(order)).where(F.col("n") == need).select(
        F.col("query").alias("id"), F.col("total").alias("cutoff"))
    cut = materialize(asked.join(cutoffs, "id", "left").withColumn("cutoff", F.coalesce("cutoff", F.lit(LOW))), "cutoffs")

    least = F.ceil(F.col("cutoff") / slices).cast("long")
    parts = _above(cells(cut, "cutoff"), slices).groupBy("query", "rep").agg(F.sum("part").alias("sum"), F.count(F.lit(1)).alias("seen"))
    parts = materialize(parts, "entries")
    whole = parts.where(F.col("seen") == slices).select("query", "rep", F.col("sum").alias("total"))
    higher = whole.withColumn("n", F.row_number().over(order)).where(F.col("n") == need).select("query", F.col("total").alias("higher"))
    bounds = cut.select(F.col("id").alias("query"), "cutoff").join(higher, "query", "left")
    open_ = parts.where(F.col("seen") < slices).join(bounds, "query").where(
        (F.col("cutoff") == LOW) | (F.col("sum") + (slices - F.col("seen")) * (least - 1)
                                    >= F.greatest("cutoff", F.coalesce("higher", "cutoff"))))
    rest = _resolve(cells(asked), open_, blocks, query_blocks)
    scored = whole.unionByName(rest).join(reps.select(F.col("id").alias("rep"), "first"), "rep")
    best = Window.partitionBy("query").orderBy(F.desc("total"), "first", "rep")
    scored = scored.withColumn("n", F.row_number().over(best)).where(F.col("n") <= need)
    return ranked(queries, scored.select("query", "rep", F.col("total").alias("score")), known, F.desc("score"), k, id_col)
