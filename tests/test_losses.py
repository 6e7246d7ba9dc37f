"""Nothing is lost silently: late events, unreadable labels, incomplete corpora, tied ids, odd numbers."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from folioscore import schema as S
from folioscore.operators import evaluate as ev, models as md
from folioscore.operators.prefix import positions
from folioscore.plans import training as tr
from folioscore.streaming import telemetry as tm


def test_late_events_are_counted(spark, tmp_path):
    base = dt.datetime(2024, 1, 1, 12)
    for i, minutes in enumerate((60, 61, 0)):       # the last file is an hour late
        rows = [(base + dt.timedelta(minutes=minutes, seconds=s), "view") for s in range(10)]
        spark.createDataFrame(rows, "ts timestamp, event_type string").coalesce(1).write.parquet(str(tmp_path / f"in/f{i}"))
    stream = spark.readStream.schema("ts timestamp, event_type string").option("maxFilesPerTrigger", 1).option(
        "recursiveFileLookup", True).parquet(str(tmp_path / "in"))
    assert tm.run_rates(stream).agg(F.sum("n")).first()[0] == 30


def test_unreadable_labels_are_rejected(spark):
    rows = [("d", f"p{i}", *[float(i)] * len(S.FEATURES), 50.0, None if i < 5 else 90.0) for i in range(25)]
    fields = ", ".join(f"{c} double" for c in S.FEATURES)
    table = spark.createDataFrame(rows, f"device string, file_name string, {fields}, tess_acc double, fine_acc double")
    assert tr.label_rejects(table).count() == 5
    split = tr.split_dataset(table)
    assert split.count() == 20 and split.where("y < 0.5").count() == 0
    assert split.where("split = 'test'").count() == 4
    with pytest.raises(ValueError):
        tr.split_dataset(table, strict=True)


def test_split_is_exact_with_tied_ids_and_empty_tables(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("id"), F.col("id").alias("x"))
    split = ev.train_test_split(df, "id")
    assert split.count() == 100 and split.where("split = 'test'").count() == 20
    assert ev.train_test_split(df.where("x < 0"), "id").count() == 0


def test_string_ids_have_positions_and_folds(spark):
    df = spark.range(50).select(F.format_string("page/%03d", F.col("id")).alias("id"), F.col("id").alias("n"))
    assert positions(df, "id").where("pos <> n").count() == 0
    folds = ev.kfold(df, "id", 4)
    assert sorted(r["count"] for r in folds.groupBy("fold").count().collect()) == [12, 12, 13, 13]


def test_importance_with_string_ids(spark):
    df = spark.range(40).select(F.format_string("p%02d", F.col("id")).alias("id"), F.col("id").cast("double").alias("x"),
                                (F.col("id") * 2.0).alias("y"))
    rows = md.permutation_importance(df, ["x"], "y", "id", lambda c: c["x"] * 2.0, repeats=2).collect()
    assert rows[0]["importance"] > 0.5


def test_large_generated_values_stay(spark):
    df = spark.createDataFrame([(40.0, 1.0), (45.0, 2.0)], "x double, y double")
    made = md.generate_features(df, ["x"], second_step=False)
    assert made.where("exp_x > 1e15").count() == 2 if "exp_x" in made.columns else True


def test_wide_pages_keep_their_components_apart(spark):
    from folioscore.operators.components import ROOT_STRIDE
    assert ROOT_STRIDE > 2**31 - 1


def test_corpus_rejects(spark, tmp_path):
    from folioscore.sources import reports as rp
    for device in rp.DEVICES:
        for folder in rp.FOLDERS.values():
            (tmp_path / "Captured_Images" / device / folder).mkdir(parents=True)
        base = tmp_path / "Captured_Images" / device
        (base / rp.FOLDERS["image"] / "broken.jpg").write_bytes(b"no image")
        for engine in ("tess", "fine"):
            (base / rp.FOLDERS[engine] / "alone.wacc.txt").write_text("x")
    found = {(r["file_name"], r["reason"]) for r in tr.corpus_rejects(spark, str(tmp_path)).collect()}
    assert {("broken", "not an image"), ("broken", "no tess"), ("alone", "no image")} <= found
    with pytest.raises(ValueError):
        tr.corpus_features(spark, str(tmp_path), strict=True)


def test_search_covers_every_family_and_reports_refused_settings(spark):
    df = spark.range(90).select("id", (F.col("id") % 10).cast("double").alias("x"), (F.col("id") % 10 * 2.0 + 1).alias("y"))
    folded = ev.kfold(df, "id", 3)
    found = md.search(folded, ["x"], "y", "id", {
        "Ridge": [{"alpha": 0.1}], "SVR": [{"kernel": "rbf", "gamma": 0.1, "degree": 2}], "Tree": [{"max_depth": 6}],
        "Bagging": [{"base": "Linear", "n_estimators": 10, "max_features": 1.0}],
        "Gradient Boosting": [{"loss": "absolute_error", "learning_rate": r, "n_estimators": 5, "max_depth": 3} for r in (1, 2)]})
    scores = [s for _, _, s in found]
    assert len(found) == 6 and scores[0] > 0.99 and scores[2] > 0.9 and scores[3] > 0.9 and scores[4] is not None and scores[5] is None
    assert len(md.candidates_of("SVR", 20)) == 20


def test_generated_plan_applies_to_new_rows(spark):
    df = spark.createDataFrame([(1.0, 2.0, 3.0), (2.0, 5.0, 10.0), (3.0, 1.0, 3.0)], "a double, b double, y double")
    plan = [c for c in md.generate_features(df, ["a", "b"]).columns if c not in ("a", "b", "y")][:4] + ["a_x_b"]
    new = md.apply_generated(spark.createDataFrame([(0.0, 7.0)], "a double, b double"), ["a", "b"], plan).first()
    assert new["a_x_b"] == 0.0 and all(new[c] is not None for c in plan)
    with pytest.raises(ValueError):
        md.apply_generated(df, ["a", "b"], ["nothing"])


def test_boosted_trees_are_registered_with_the_surveyed_rounds(monkeypatch):
    from folioscore.catalog import learning
    monkeypatch.setattr(learning, "fit_metrics", lambda spark, sf, model, params: params)
    assert learning.boosted_absolute(None, "")["iterations"] == 300
    assert learning.boosted_squared(None, "")["n_estimators"] >= 400
