"""Vectors in packed blocks: what the two searches share."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F


def finite(vector: str) -> Column:
    """The vector is there, is not empty and has no null or non-finite component."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.col(vector).isNotNull() & (F.size(vector) > 0) & ~bad


def members(rows: DataFrame, most: int) -> DataFrame:
    """Equal vectors as one: (id, vector, rep, first, place, again) with the ``most`` smallest ids of each vector.

    Copies of a vector tie in every search, and ties go to smaller ids, so the others can't be in a result
    of fewer than ``most`` rows. The limit is applied on the map side first: a hot vector costs one short list.
    ``rep`` is a number of the vector's own, whatever ids stand for it (write the result once: the numbers hold for one
    computation); ``first`` is its smallest id; ``again`` marks further rows of the same id and vector.
    """
    same = Window.partitionBy("vector").orderBy("id")
    placed = rows.select("id", "vector").withColumn("place", F.row_number().over(same)).where(F.col("place") <= most)
    placed = placed.withColumn("again", F.coalesce(F.lag("id").over(same) == F.col("id"), F.lit(False)))
    whole = Window.partitionBy("vector")
    return placed.withColumn("number", F.monotonically_increasing_id()).withColumns(
        {"rep": F.min("number").over(whole), "first": F.min("id").over(whole)}).drop("number")


def asked_vectors(rows: DataFrame, reps: DataFrame) -> DataFrame:
    """(query_id, rep) of rows that are queries; rows equal in id and vector are one query."""
    return rows.join(reps.select("vector", F.col("id").alias("rep")), "vector").select(
        F.col("id").alias("query_id"), "rep").distinct()


def ranked(queries: DataFrame, hits: DataFrame, known: DataFrame, score: Column, k: int, id_col: str) -> DataFrame:
    """Each query's ``k`` best rows by ``score``, ties to smaller ids, all but the query's own row.

    ``hits`` are (query, rep, score) over vectors; every row of such a vector takes part.
    """
    rows = known.select(F.col("rep").alias("hit"), "id", "again")
    paired = queries.join(hits.withColumnRenamed("rep", "hit"), F.col("rep") == F.col("query")).join(rows, "hit")
    own = (F.col("hit") == F.col("rep")) & (F.col("id") == F.col("query_id")) & ~F.col("again")
    place = F.row_number().over(Window.partitionBy("query_id", "rep").orderBy(score, "id"))
    return paired.where(~own).select(
        "query_id", place.cast("int").alias("rank"), F.col("id").alias(id_col), "score", F.col("rep").alias("query_key")).where(F.col("rank") <= k)


def block_count(rows: int, size: int) -> int:
    return max(1, math.ceil(rows / size))


def pack(rows: DataFrame, blocks: int, dtype: str, name: str, extra: str | None = None) -> DataFrame:
    """(``name``, dim, ids, data[, extra]) with one row per block and vector length; ids and data are flat arrays."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        ids = table.column("id").combine_chunks()
        order = np.argsort(ids.to_numpy(), kind="stable")
        flat = table.column("vector").combine_chunks().flatten().to_numpy(zero_copy_only=False)
        data = flat.astype(dtype).reshape(len(ids), -1)[order]
        out = {name: pa.array([key[0].as_py()], pa.int32()), "dim": pa.array([data.shape[1]], pa.int32()),
               "ids": pa.array([ids.to_numpy()[order].tobytes()], pa.binary()), "data": pa.array([data.tobytes()], pa.binary())}
        if extra:
            out[extra] = pa.array([table.column(extra).to_numpy()[order].astype(np.int64).tobytes()], pa.binary())
        return pa.table(out)

    keyed = rows.select("id", "vector", *([extra] if extra else []), F.size("vector").alias("dim"),
                        F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int").alias(name))
    schema = f"{name} int, dim int, ids binary, data binary" + (f", {extra} binary" if extra else "")
    return keyed.groupBy(name, "dim").applyInArrow(run, schema)


def every(column: str, blocks: int) -> Column:
    return F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias(column)
