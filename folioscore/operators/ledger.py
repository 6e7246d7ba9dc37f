"""Run ledger and trial tables: append, best, latest, compare, history."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from folioscore import schema as S
from folioscore.operators.prefix import join_same, running, value_ranks


def append_runs(runs: DataFrame, path: str) -> None:
    """Append runs with parameters, metrics and tags; old files are never rewritten."""
    runs.select([F.col(f.name).cast(f.dataType) for f in S.LEDGER.fields]).write.mode("append").parquet(path)


def read_ledger(spark, path: str) -> DataFrame:
    return spark.read.schema(S.LEDGER).parquet(path)


def strip_prefix(params: Column, prefix: str = "regressor__") -> Column:
    """Remove a step prefix from parameter names."""
    return F.transform_keys(params, lambda k, _: F.regexp_replace(k, "^" + prefix, ""))


def latest_run(ledger: DataFrame) -> DataFrame:
    """The run that started last: one aggregate, no sort."""
    return ledger.agg(F.max_by("run_id", F.struct("start_time", "run_id")).alias("run_id"),
                      F.max("start_time").alias("start_time"))


def best_per_group(trials: DataFrame, group: str, params: list[str], score: str, smallest: bool = True) -> DataFrame:
    """Parameters of the best trial per group; the earliest trial wins ties."""
    order = F.struct(F.col(score), F.col("trial")) if smallest else F.struct(
        F.col(score), (-F.col("trial")).alias("t"))
    pick = F.min_by if smallest else F.max_by
    return trials.groupBy(group).agg(pick(F.struct("trial", *params), order).alias("best"),
                                     (F.min if smallest else F.max)(score).alias(score)).select(
        group, "best.*", score)


def best_subset_size(sfs: DataFrame, backward: bool = True) -> DataFrame:
    """Subset size with the highest average score; the size tried first wins ties."""
    first = F.col("k") if backward else -F.col("k")
    return sfs.agg(F.max_by(F.struct("k", "avg_score"), F.struct("avg_score", first.alias("o"))).alias("b")).select("b.*")


def comparison(metrics: DataFrame, key: str, names: list[str]) -> DataFrame:
    """One row per run, one column per metric."""
    return metrics.groupBy(key).pivot("name", names).agg(F.first("value"))


def optimisation_history(trials: DataFrame) -> DataFrame:
    """Best value so far per study."""
    return running(trials, ["study"], "trial", "value", "min", "best")


def value_distribution(trials: DataFrame) -> DataFrame:
    """Empirical distribution function of the trial values per study."""
    return value_ranks(trials, ["study"], "value").select(
        "study", "value", (F.col("upto") / F.col("total")).alias("edf"))


def trial_ranks(trials: DataFrame) -> DataFrame:
    """Rank of each trial by value (ties share the lowest rank, trials without a value come last)."""
    ranks = value_ranks(trials, ["study"], "value").select(
        "study", "value", (F.col("upto") - F.col("n") + 1).alias("rank"))
    return join_same(trials, ranks, ["study", "value"])


def parameter_slices(trials: DataFrame, params: list[str]) -> DataFrame:
    """Long form (study, trial, param, setting, value) for slice and parallel-coordinate views."""
    pairs = F.array(*[F.struct(F.lit(p).alias("param"), F.col(p).cast("double").alias("setting")) for p in params])
    return trials.select("study", "trial", "value", F.explode(pairs).alias("p")).select(
        "study", "trial", "p.param", "p.setting", "value")


def contour(trials: DataFrame, a: str, b: str) -> DataFrame:
    """Mean value for each pair of settings."""
    return trials.groupBy("study", a, b).agg(F.avg("value").alias("value"))


def durations(ledger: DataFrame) -> DataFrame:
    seconds = F.expr("timestampdiff(MICROSECOND, start_time, end_time)") / 1e6
    return ledger.select("run_id", seconds.alias("seconds"))


def parameter_grid(values: DataFrame, group: str, params: list[str]) -> DataFrame:
    """All combinations of the listed settings per group, from one array column per parameter."""
    out = values
    for p in params:
        out = out.withColumn(p, F.explode(p))
    return out.select(group, *params)
