"""Running aggregates over a long order without a one-task window.

Rows are cut into blocks by value ranges of the order column. Each block's aggregate is carried
forward over the (few) blocks, and a window inside (keys, block) does the rest.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import NumericType


def is_number(df: DataFrame, order: str) -> bool:
    return isinstance(df.schema[order].dataType, NumericType)


def block_bounds(df: DataFrame, order: str, blocks: int | None = None) -> list:
    """Increasing range borders; their number is the shuffle width, not the data size.

    Columns that are no numbers get borders of their own type from a bounded sample; borders only
    balance the blocks, so the result doesn't depend on it.
    """
    blocks = blocks or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    at = [i / blocks for i in range(1, blocks)] or [0.5]
    if not is_number(df, order):
        some = sorted(r[0] for r in df.where(F.col(order).isNotNull()).select(order).orderBy(F.xxhash64(order)).limit(
            100 * blocks).collect())
        return sorted({some[int(p * len(some))] for p in at}) if some else []
    cuts = df.agg(F.percentile_approx(F.col(order).cast("double"), at, 10000).alias("c")).first()["c"]
    return sorted(set(cuts or []))


def with_block(df: DataFrame, order: str, bounds: list) -> DataFrame:
    if not is_number(df, order):
        above = [F.when(F.col(order).isNull() | (F.col(order) >= F.lit(b)), 1).otherwise(0) for b in bounds]
        return df.withColumn("block", sum(above, F.lit(0)).cast("double"))
    splits = [-float("inf"), *bounds, float("inf")]
    cut = Bucketizer(splits=splits, inputCol="__order", outputCol="block", handleInvalid="keep")
    cut = cut.transform(df.withColumn("__order", F.col(order).cast("double"))).drop("__order")
    return cut.withColumn("block", F.coalesce("block", F.lit(float(len(splits)))))


def join_same(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Inner join on keys of which NULL is a value like any other; the keys stand once."""
    named = {k: f"__same_{i}" for i, k in enumerate(keys)}
    right = right.withColumnsRenamed(named)
    same = [left[k].eqNullSafe(right[n]) for k, n in named.items()]
    return left.join(right, reduce(lambda a, b: a & b, same)).drop(*named.values())


def running(df: DataFrame, keys: list[str], order: str, value: str, fn: str, out: str,
            bounds: list[float] | None = None) -> DataFrame:
    """Inclusive running ``fn`` ("sum", "min" or "max") of ``value`` by ``order`` within ``keys``.

    A NULL key is a key of its own; rows without an order come last.
    """
    agg = {"sum": F.sum, "min": F.min, "max": F.max}[fn]
    df = with_block(df, order, bounds if bounds is not None else block_bounds(df, order))
    ahead = Window.partitionBy(*keys, "block").orderBy(F.col(order).asc_nulls_last()).rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy(*keys).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carried = df.groupBy(*keys, "block").agg(agg(value).alias("t")).select(
        *keys, "block", agg("t").over(earlier).alias("carried"))
    inside = agg(value).over(ahead)
    joined = join_same(df, carried, [*keys, "block"]).withColumn("inside", inside)
    if fn == "sum":
        total = F.col("inside") + F.coalesce(F.col("carried"), F.lit(0))
    else:
        total = (F.least if fn == "min" else F.greatest)("inside", "carried")
    return joined.withColumn(out, total).drop("block", "carried", "inside")


def value_ranks(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Distinct values with ``n``, ``upto`` (rows not above) and ``total``, per key.

    Rows are counted per value first, so a value that a third of the rows share costs one row.
    """
    counts = df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("n"))
    ranked = running(counts, keys, value, "n", "sum", "upto")
    if not keys:
        return ranked.withColumn("total", F.lit(counts.agg(F.sum("n")).first()[0]))
    return join_same(ranked, counts.groupBy(*keys).agg(F.sum("n").alias("total")), keys)


def positions(df: DataFrame, order: str) -> DataFrame:
    """0-based position in the order of a unique column, as ``pos``."""
    ranked = running(df.withColumn("__one", F.lit(1).cast("long")), [], order, "__one", "sum", "pos")
    return ranked.withColumn("pos", F.col("pos") - 1).drop("__one")
