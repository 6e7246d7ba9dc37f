"""OCR accuracy reports and their join with images."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from folioscore.functions import file_stem

DEVICES = ("Nokia_phone", "Samsung_phone")  # fixed folder names of the corpus layout
FOLDERS = {"image": "Images", "fine": "OCR_Accuracy_Finereader", "tess": "OCR_Accuracy_Tesseract"}
ACCURACY_TOKEN = 13  # 1-based position of the percentage among the whitespace tokens


def parse_accuracy(body: Column) -> Column:
    """The 13th token without its last character, as a number; NULL when it is not one."""
    token = F.try_element_at(F.split(F.trim(F.regexp_replace(body, r"\s+", " ")), " "), F.lit(ACCURACY_TOKEN))
    return F.substring(token, F.lit(1), F.length(token) - 1).try_cast("double")


def read_reports(spark: SparkSession, root: str, engine: str) -> DataFrame:
    """``(device, file_name, acc)`` of one engine over both device folders."""
    raw = spark.read.option("wholetext", True).option("pathGlobFilter", "*.wacc.txt").text(
        [f"{root}/Captured_Images/{d}/{FOLDERS[engine]}" for d in DEVICES])
    path = F.input_file_name()
    return raw.select(F.regexp_extract(path, r"Captured_Images/([^/]+)/", 1).alias("device"),
                      file_stem(path).alias("file_name"), parse_accuracy(F.col("value")).alias("acc"))


def labelled(features: DataFrame, tess: DataFrame, fine: DataFrame, keys: list[str]) -> DataFrame:
    """Inner join of the features with both accuracies; report B (tess) drives."""
    return (tess.select(*keys, F.col("acc").alias("tess_acc"))
            .join(fine.select(*keys, F.col("acc").alias("fine_acc")), keys)
            .join(features, keys))


def missing_partners(features: DataFrame, tess: DataFrame, fine: DataFrame, keys: list[str],
                     strict: bool = False) -> DataFrame:
    """Reports of engine B without an image or without a report of engine A."""
    gaps = tess.select(*keys).join(fine.select(*keys), keys, "left_anti").withColumn("missing", F.lit("fine"))
    gaps = gaps.unionByName(tess.select(*keys).join(features.select(*keys), keys, "left_anti").withColumn(
        "missing", F.lit("image")))
    if strict and not gaps.isEmpty():
        raise ValueError("incomplete image/report triples")
    return gaps
