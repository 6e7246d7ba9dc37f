"""Running score histogram, error counter and request rates over a stream of score events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from folioscore import schema as S
from folioscore.session import scratch_path


def score_histogram(scores: DataFrame) -> DataFrame:
    """Cumulative bucket counts, sum and count of the scores that were produced.

    One global aggregate: the state is a single row and partial counts are combined map-side.
    """
    ok, s = ~F.col("is_error"), F.col("score")
    return scores.agg(*[F.count_if(ok & (s <= b)).alias(f"le_{int(b * 100)}") for b in S.SCORE_BUCKETS],
                      F.count_if(ok).alias("le_inf"), F.sum(F.when(ok, s)).alias("total"))


def histogram_rows(hist: DataFrame) -> DataFrame:
    """Long form ``(le, n)`` with the overflow bucket last."""
    rows = [(f"{b:g}", f"le_{int(b * 100)}") for b in S.SCORE_BUCKETS] + [("+Inf", "le_inf")]
    return hist.select(F.explode(F.array(*[F.struct(F.lit(le).alias("le"), F.col(c).alias("n")) for le, c in rows])).alias("b"),
                       F.round("total", 4).alias("total")).select("b.*", "total")


def error_count(scores: DataFrame) -> DataFrame:
    return scores.agg(F.count_if("is_error").alias("errors"), F.count(F.lit(1)).alias("requests"))


def request_rates(scores: DataFrame, every: str = "15 seconds") -> DataFrame:
    """Requests per handler and sampling interval of one batch."""
    return scores.withColumn("ts", F.col("ts").cast("timestamp")).groupBy(F.window("ts", every).alias("w"), "event_type").agg(
        F.count(F.lit(1)).alias("n"))


def run_rates(stream: DataFrame, every: str = "15 seconds") -> DataFrame:
    """Request rates over what is available: partial counts per batch, summed when read.

    No watermark is needed, because counts add up: a request counts however late it arrives. A
    repeated batch overwrites its own folder.
    """
    spark: SparkSession = stream.sparkSession
    out = scratch_path(spark, "rates")

    def save(batch: DataFrame, batch_id: int) -> None:
        request_rates(batch, every).write.mode("overwrite").parquet(f"{out}/batch={batch_id}")
    q = (stream.writeStream.foreachBatch(save).trigger(availableNow=True)
         .option("checkpointLocation", scratch_path(spark, "rates-state")).start())
    q.awaitTermination()
    return spark.read.parquet(out).groupBy("w", "event_type").agg(F.sum("n").alias("n"))


def run_to_table(stream: DataFrame, mode: str, name: str) -> DataFrame:
    """Run a streaming aggregate over what is available; results per batch in the shared folder.

    A repeated batch overwrites its own folder, so a restart adds nothing.
    """
    spark: SparkSession = stream.sparkSession
    out = scratch_path(spark, name)

    def save(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")
    q = (stream.writeStream.outputMode(mode).foreachBatch(save).trigger(availableNow=True)
         .option("checkpointLocation", scratch_path(spark, name + "-state")).start())
    q.awaitTermination()
    return spark.read.parquet(out)


def latest(results: DataFrame) -> DataFrame:
    """Complete-mode result: that of the last batch."""
    last = results.agg(F.max("batch")).first()[0]
    return results.where(F.col("batch") == last).drop("batch")
