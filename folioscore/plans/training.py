"""Corpus to feature table, and feature table to an evaluated model."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F

from folioscore import schema as S
from folioscore.operators import evaluate as ev, geometry as geo, models as md
from folioscore.plans.features import feature_table, labelled_table
from folioscore.session import materialize
from folioscore.sources import corpus as cp, reports as rp


def corpus_features(spark: SparkSession, root: str, width: int = S.PAGE_WIDTH, prepared: str | None = None,
                    min_page: int = S.MIN_PAGE_SIZE, strict: bool = False) -> DataFrame:
    """Both device folders to labelled features; prepared pages are kept when a path is given.

    What can't take part is listed by ``corpus_rejects``; with ``strict`` it raises.
    """
    if strict and not corpus_rejects(spark, root).isEmpty():
        raise ValueError("incomplete corpus")
    pages = geo.prepare_pages(cp.image_rows(cp.corpus_images(spark, root)), width, min_page)
    if prepared:
        pages = materialize(pages, "prepared")
        cp.write_pages(cp.image_key(pages), prepared)
    features = cp.image_key(feature_table(pages)).drop("image_id")
    return labelled_table(features, rp.read_reports(spark, root, "tess"), rp.read_reports(spark, root, "fine"))


def unlabelled_features(spark: SparkSession, folder: str, glob: str = "*.jpeg", width: int = S.PAGE_WIDTH,
                        min_page: int = S.MIN_PAGE_SIZE) -> DataFrame:
    """Features of a folder of images without reports."""
    return feature_table(geo.prepare_pages(cp.image_rows(cp.image_files(spark, folder, glob)), width, min_page))


def has_label(label: str = "fine_acc"):
    """The report gave a finite number."""
    value = F.col(label).cast("double")
    return value.isNotNull() & ~F.isnan(value) & (F.abs(value) != float("inf"))


def label_rejects(table: DataFrame, label: str = "fine_acc") -> DataFrame:
    """Pages whose report is unreadable; they are not trained or tested on."""
    return table.where(~has_label(label)).select("device", "file_name", F.lit("unreadable report").alias("reason"))


def corpus_rejects(spark: SparkSession, root: str) -> DataFrame:
    """(device, file_name, reason) of images that are none and of reports or images without partner."""
    images = cp.image_key(cp.corpus_images(spark, root).select(F.col("origin").alias("image_id"), "height"))
    tess, fine = (rp.read_reports(spark, root, e) for e in ("tess", "fine"))
    keys = ["device", "file_name"]
    broken = images.where("height <= 0").select(*keys, F.lit("not an image").alias("reason"))
    gaps = rp.missing_partners(images, tess, fine, keys).select(*keys, F.concat(F.lit("no "), "missing").alias("reason"))
    alone = images.join(tess, keys, "left_anti").select(*keys, F.lit("no tess").alias("reason"))
    return broken.unionByName(gaps).unionByName(alone)


def split_dataset(table: DataFrame, scale_target: bool = True, strict: bool = False) -> DataFrame:
    """Drop the second engine's label, clean the features, scale the target to 0..1 and split 80/20.

    Rows without a readable label are left out (``label_rejects`` lists them); with ``strict`` they raise.
    """
    if strict and not label_rejects(table).isEmpty():
        raise ValueError("unreadable accuracy reports")
    target = F.col("fine_acc") / 100 if scale_target else F.col("fine_acc")
    keyed = ev.clean(table.where(has_label()).drop("tess_acc"), S.FEATURES).select(
        F.concat_ws("/", "device", "file_name").alias("id"), *S.FEATURES, target.alias("y"))
    return ev.train_test_split(keyed, "id")


def train_and_evaluate(split: DataFrame, model: str = md.SHIPPED_MODEL[0], params: dict | None = None) -> tuple[PipelineModel, DataFrame]:
    params = md.SHIPPED_MODEL[1] if params is None else params
    fitted = md.train(split.where("split = 'train'"), S.FEATURES, "y", "id", model, params)
    return fitted, ev.evaluate(md.predict(fitted, split.where("split = 'test'"), "y"))
