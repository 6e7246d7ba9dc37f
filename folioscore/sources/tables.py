"""Feature, split and metric tables at rest."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

FeatureSchema = T.StructType


def write_features(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Feature table sink: Parquet, or CSV with a header."""
    if fmt == "csv":
        df.write.mode("overwrite").option("header", True).csv(path)
    else:
        df.write.mode("overwrite").parquet(path)


def read_features(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet") -> DataFrame:
    reader = spark.read.schema(schema)
    return reader.option("header", True).csv(path) if fmt == "csv" else reader.parquet(path)


def write_split(df: DataFrame, path: str) -> None:
    """Split table, partitioned so that reading one side touches only its files."""
    df.write.mode("overwrite").partitionBy("split").parquet(path)


def read_split(spark: SparkSession, path: str, side: str) -> DataFrame:
    return spark.read.parquet(path).where(F.col("split") == side)


def write_metrics(metrics: DataFrame, path: str, dated: bool = False) -> None:
    """Metric table as CSV separated by semicolons; ``dated`` keeps one folder per run date."""
    if dated:
        day = metrics.withColumn("ds", F.date_format(F.current_date(), "yyyy-MM-dd"))
        day.write.mode("append").partitionBy("ds").option("sep", ";").option("header", True).csv(path)
    else:
        metrics.write.mode("overwrite").option("sep", ";").option("header", True).csv(path)


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("name string, value double").option("sep", ";").option("header", True).csv(path)
