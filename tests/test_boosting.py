import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from folioscore.operators import boosting as bo, models as md

X = ["a", "b", "c"]


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(5)
    a, b, c = rng.normal(size=900), rng.integers(0, 6, 900).astype(float), rng.random(900)
    y = np.sin(2 * a) + 0.3 * b * (c > 0.5) + rng.normal(0, 0.1, 900)
    rows = [(i, *map(float, r)) for i, r in enumerate(zip(a, b, c, y))]
    return spark.createDataFrame(rows, "id long, a double, b double, c double, y double").repartition(3).cache()


@pytest.mark.parametrize("loss", ["squared", "absolute"])
def test_trees_are_those_of_spark_ml(spark, table, loss, monkeypatch):
    monkeypatch.setattr(bo, "PARTITION_ROWS", 200)      # several tasks
    monkeypatch.setattr(bo, "CHUNK_ROWS", 100)
    monkeypatch.setattr(bo, "CUT_LINEAGE", 4)
    doubled = table.union(table.where("id % 3 = 0"))    # rows that come twice count twice
    theirs = GBTRegressor(lossType=loss, maxIter=12, maxDepth=4, stepSize=0.1, labelCol="y", seed=0)
    assemble = VectorAssembler(inputCols=X, outputCol="features")
    want = theirs.fit(assemble.transform(doubled)).transform(assemble.transform(doubled)).select("id", F.col("prediction").alias("want"))
    ours = bo.boosted_trees(doubled, X, "y", 12, 4, 0.1, loss == "absolute")
    got = ours.transform(doubled).select("id", "prediction").distinct().join(want.distinct(), "id")
    worst, n = got.agg(F.max(F.abs(F.col("prediction") - F.col("want"))), F.count(F.lit(1))).first()
    assert n == 900 and worst < 1e-9


def test_a_tree_takes_few_jobs_whatever_the_rows(spark, table):
    sc = spark.sparkContext
    sc.setJobGroup("boosting", "")
    md.train(table, X, "y", "id", "Boosting squared", {"n_estimators": 20, "max_depth": 4, "subsample": 0.8})
    jobs = len(sc.statusTracker().getJobIdsForGroup("boosting"))
    sc.setJobGroup("", "")
    assert jobs <= 20 * 4 + 12


def test_shares_are_drawn_by_row_and_agree(spark, table):
    key = np.random.default_rng(1).integers(0, 2**32, 40_000, dtype=np.uint32)
    one = bo.drawn(key, np.zeros(0, np.int64), 0.8, 3)
    assert abs(one.mean() - 0.8) < 0.01 and (one == bo.drawn(key, np.zeros(0, np.int64), 0.8, 3)).all()
    assert abs((one & bo.drawn(key, np.zeros(0, np.int64), 0.8, 4)).mean() - 0.64) < 0.01
    many = bo.drawn(key[:2000], np.full(2000, 100), 0.8, 0)
    assert abs(many.mean() - 80) < 0.5 and abs(many.std() - 4) < 0.4
    fitted = [md.train(table.repartition(p), X, "y", "id", "Boosting squared", {"n_estimators": 6, "subsample": 0.8}) for p in (2, 5)]
    a, b = (f.transform(table).agg(F.sum("prediction"), F.avg((F.col("y") - F.col("prediction")) ** 2)).first() for f in fitted)
    assert a[0] == pytest.approx(b[0], rel=1e-9) and a[1] < 0.2


def test_model_is_saved_and_loaded(spark, table, tmp_path):
    model = md.train(table, X, "y", "id", "Boosting", {"n_estimators": 5})
    model.write().overwrite().save(str(tmp_path / "m"))
    again = PipelineModel.load(str(tmp_path / "m"))
    pairs = model.transform(table).select("id", "prediction").join(again.transform(table).select("id", F.col("prediction").alias("p")), "id")
    assert pairs.where("prediction != p").count() == 0


def test_refused_targets_and_settings(spark, table):
    from pyspark.errors import IllegalArgumentException
    with pytest.raises(Exception, match="finite"):
        bo.boosted_trees(table.withColumn("y", F.when(F.col("id") > 0, F.col("y"))), X, "y", 2, 2, 0.1, False)
    with pytest.raises(Exception, match="null or NaN"):
        bo.boosted_trees(table.withColumn("a", F.when(F.col("id") > 0, F.col("a"))), X, "y", 2, 2, 0.1, False)
    for bad in ({"learning_rate": 2}, {"max_depth": 31}):
        with pytest.raises(IllegalArgumentException):
            md.train(table, X, "y", "id", "Boosting", bad)
    constant = md.train(table.withColumn("y", F.lit(2.5)), X, "y", "id", "Boosting", {"n_estimators": 3, "loss": "squared_error"})
    assert constant.transform(table).where("abs(prediction - 2.5) > 1e-12").count() == 0


def test_two_levels_take_one_job(spark, table, monkeypatch):
    sc = spark.sparkContext

    def fit(**more):
        return bo.boosted_trees(table.union(table.where("id % 3 = 0")), X, "y", 8, 5, 0.1, **{"absolute": True, **more})
    sc.setJobGroup("two levels", "")
    got = [fit(), fit(absolute=False, share=0.7, per_node="onethird", least=3)]
    jobs = len(sc.statusTracker().getJobIdsForGroup("two levels"))
    sc.setJobGroup("", "")
    assert jobs <= 2 * (8 * 3 + 15)
    monkeypatch.setattr(bo, "PAIR_COLUMNS", 0)      # a level each
    for a, b in zip(got, [fit(), fit(absolute=False, share=0.7, per_node="onethird", least=3)]):
        assert np.allclose(sum(a.getOrDefault("trees"), []), sum(b.getOrDefault("trees"), []), rtol=1e-9, atol=1e-12)
