"""Splits, folds, scaling and evaluation metrics."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from folioscore import schema as S
from folioscore.operators.prefix import positions, value_ranks

Y, P = "y_true", "y_pred"


# ------------------------------------------------------------------ cleaning and splitting

def clean(df: DataFrame, columns: list[str]) -> DataFrame:
    """Non-finite values become 0 in every listed column."""
    from folioscore.functions import finite_or_zero
    return df.withColumns({c: finite_or_zero(F.col(c).cast("double")) for c in columns})


def split_order(id_col: str, seed: int = S.SPLIT_SEED) -> Column:
    return F.md5(F.concat(F.col(id_col).cast("string"), F.lit(str(seed))))


def train_test_split(df: DataFrame, id_col: str, share: float = S.TEST_SHARE,
                     seed: int = S.SPLIT_SEED) -> DataFrame:
    """Add ``split``: exactly ``ceil(share * n)`` rows with the smallest hash are the test set.

    Counting hashes by prefix finds the prefix in which the cut falls; only rows of that one
    prefix (1 in 65,536) are ranked. Rows with equal ids at the cut are ordered by a hash of
    all their columns; rows that are equal in everything may stand for each other. An empty table stays empty.
    """
    hashed = df.withColumn("__h", split_order(id_col, seed)).withColumn("__p", F.substring("__h", 1, 4))
    counts = hashed.groupBy("__p").agg(F.count(F.lit(1)).alias("n"))  # at most 65,536 rows
    before = Window.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)
    total = Window.partitionBy()
    cut = counts.select("__p", "n", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"),
                        F.ceil(F.sum("n").over(total) * share).alias("want")).where(
        (F.col("before") < F.col("want")) & (F.col("before") + F.col("n") >= F.col("want"))).first()
    if cut is None:
        return df.withColumn("split", F.lit("train"))
    prefix, room = cut["__p"], cut["want"] - cut["before"]
    edge = hashed.where(F.col("__p") == prefix).select("__h")
    ranked = edge.groupBy("__h").agg(F.count(F.lit(1)).alias("n")).orderBy("__h").limit(room).collect()
    for row in ranked:
        last, left, room = row["__h"], room, room - row["n"]
        if room <= 0:
            break
    side = F.when(F.col("__h") <= last, F.lit("test")).otherwise(F.lit("train"))
    if room == 0:  # the cut falls between two hashes
        return hashed.withColumn("split", side).drop("__h", "__p")
    rank = F.row_number().over(Window.partitionBy("__h").orderBy(F.xxhash64(*df.columns)))
    tied = hashed.where(F.col("__h") == last).withColumn("split", F.when(rank <= left, F.lit("test")).otherwise(F.lit("train")))
    rest = hashed.where(F.col("__h").isNull() | (F.col("__h") != last)).withColumn("split", side)
    return rest.unionByName(tied).drop("__h", "__p")


def kfold(df: DataFrame, id_col: str, k: int) -> DataFrame:
    """Add ``fold``: contiguous folds in id order; the first ``n % k`` have one more row."""
    placed = positions(df, id_col)
    n = df.count()
    small, extra = divmod(n, k)
    pos = F.col("pos")
    fold = F.when(pos < extra * (small + 1), F.floor(pos / (small + 1))).otherwise(
        extra + F.floor((pos - extra * (small + 1)) / max(small, 1)))
    return placed.withColumn("fold", fold.cast("int")).drop("pos")


def scale_parameters(df: DataFrame, columns: list[str]) -> dict[str, dict[str, float]]:
    """Minimum, maximum, mean and population deviation of each column: one aggregate."""
    fns = {"min": F.min, "max": F.max, "mean": F.avg, "sd": F.stddev_pop}
    row = df.agg(*[f(c).alias(f"{c}|{n}") for c in columns for n, f in fns.items()]).first()
    return {c: {n: row[f"{c}|{n}"] for n in fns} for c in columns}


def min_max_scale(df: DataFrame, params: dict[str, dict[str, float]]) -> DataFrame:
    """``(x - min) / (max - min)``; a constant column gives 0."""
    def one(c: str, p: dict[str, float]) -> Column:
        span = p["max"] - p["min"]
        return (F.col(c) - F.lit(p["min"])) / F.lit(span if span else 1.0)
    return df.withColumns({c: one(c, p) for c, p in params.items()})


def standard_scale(df: DataFrame, params: dict[str, dict[str, float]]) -> DataFrame:
    """Zero mean and unit population deviation; a constant column gives 0.

    Min-max scaling before it changes nothing (both are affine), so the pair is this one step.
    """
    return df.withColumns({c: (F.col(c) - F.lit(p["mean"])) / F.lit(p["sd"] or 1.0)
                           for c, p in params.items()})


# ------------------------------------------------------------------ metrics

Metric = Callable[[Column, Column], Column]


def _mse(y: Column, p: Column) -> Column:
    return F.avg((y - p) * (y - p))


METRICS: dict[str, Metric] = {
    "R2": lambda y, p: 1 - F.try_divide(_mse(y, p), F.var_pop(y)),
    "MAE": lambda y, p: F.avg(F.abs(y - p)),
    "MSE": _mse,
    "PLCC": lambda y, p: F.corr(y, p),
}


def register_metric(name: str, metric: Metric) -> None:
    """Add a metric: a function of the two columns that returns an aggregate."""
    METRICS[name] = metric


def metric_row(pred: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """All registered metrics in one aggregate."""
    y, p = F.col(Y), F.col(P)
    return pred.groupBy(*(keys or [])).agg(*[m(y, p).alias(n) for n, m in METRICS.items()])


def average_ranks(df: DataFrame, value: str) -> DataFrame:
    """Distinct values with their average rank (1-based, ties share the mean)."""
    v = value_ranks(df, [], value)
    return v.select(value, (F.col("upto") - (F.col("n") - 1) / 2).alias(f"{value}_rank"), "n")


def srocc(pred: DataFrame) -> DataFrame:
    """Rank correlation: Pearson's r of average ranks.

    Works on counted (true, predicted) pairs; ranks are joined by value.
    """
    pairs = pred.groupBy(Y, P).agg(F.count(F.lit(1)).alias("n"))
    ranked = pairs.join(average_ranks(pred, Y).drop("n"), Y).join(average_ranks(pred, P).drop("n"), P)
    a, b, n = F.col(f"{Y}_rank"), F.col(f"{P}_rank"), F.col("n")
    mean = ((pairs.agg(F.sum("n")).first()[0] or 0) + 1) / 2  # the mean of all ranks is known
    da, db = a - F.lit(mean), b - F.lit(mean)
    return ranked.agg(F.try_divide(F.sum(da * db * n), F.sqrt(F.sum(da * da * n) * F.sum(db * db * n)))
                      .alias("SROCC"))


def evaluate(pred: DataFrame) -> DataFrame:
    """Metric table ``(name, value)``."""
    def long(row: DataFrame, names: list[str]) -> DataFrame:
        return row.select(F.explode(F.array(*[
            F.struct(F.lit(n).alias("name"), F.col(n).alias("value")) for n in names])).alias("m")).select("m.*")
    return long(metric_row(pred), list(METRICS)).unionByName(long(srocc(pred), ["SROCC"]))


def residual_histogram(pred: DataFrame, bins: int = 100) -> DataFrame:
    """Equal-width counts of ``y_pred - y_true`` between its extremes."""
    r = pred.select((F.col(P) - F.col(Y)).alias("r"))
    lo, hi = r.agg(F.min("r"), F.max("r")).first()
    at = F.least(F.floor((F.col("r") - F.lit(lo)) / F.lit((hi - lo) or 1.0) * bins), F.lit(bins - 1))
    return r.groupBy(at.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n"))


