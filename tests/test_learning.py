"""Splits, folds, linear and kernel models, search and selection."""

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from folioscore.operators import evaluate as ev, linear as ln, models as md

COLS = ["a", "b", "c"]


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(400, 3)) * [1, 10, 0.1] + [0, 5, 2]
    y = 2 + x @ [0.5, -0.2, 3.0] + rng.normal(scale=0.01, size=400)
    rows = [(i, *map(float, r), float(t)) for i, (r, t) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "id long, a double, b double, c double, y double").cache()


def test_planted_weights(data):
    beta = ln.ridge(ln.total(ln.fold_grams(data, COLS, "y")))
    assert np.allclose(beta, [2, 0.5, -0.2, 3.0], atol=0.03)


def test_ridge_and_elastic_net_conditions(data):
    m = np.array(data.select(*COLS, "y").collect())
    x, y = m[:, :-1] - m[:, :-1].mean(0), m[:, -1] - m[:, -1].mean()
    gram = ln.total(ln.fold_grams(data, COLS, "y"))
    want = np.linalg.solve(x.T @ x + 0.5 * np.eye(3), x.T @ y)
    assert np.allclose(ln.ridge(gram, 0.5)[1:], want)
    alpha, l1 = 0.05, 0.5
    w = ln.elastic_net(gram, alpha, l1, tol=1e-10)[1:]
    grad = -x.T @ (y - x @ w) / len(y) + alpha * (1 - l1) * w
    assert np.all(np.where(w != 0, np.abs(grad + alpha * l1 * np.sign(w)) < 1e-6, np.abs(grad) <= alpha * l1 + 1e-6))


def test_split_is_exact_and_repeatable(data):
    a = ev.train_test_split(data, "id")
    assert a.where("split = 'test'").count() == 80
    assert a.exceptAll(ev.train_test_split(data, "id")).count() == 0


def test_fold_sizes(spark):
    sizes = ev.kfold(spark.range(10), "id", 4).groupBy("fold").agg(F.count("*").alias("n"), F.max("id").alias("m")).orderBy("fold")
    assert [tuple(r) for r in sizes.collect()] == [(0, 3, 2), (1, 3, 5), (2, 2, 7), (3, 2, 9)]


def test_metrics_of_perfect_and_monotone_predictions(spark):
    same = spark.createDataFrame([(float(i), float(i)) for i in range(20)], "y_true double, y_pred double")
    got = {r["name"]: r["value"] for r in ev.evaluate(same).collect()}
    assert got["R2"] == 1 and got["MAE"] == 0 and got["SROCC"] == pytest.approx(1)
    bent = same.withColumn("y_pred", F.exp(F.col("y_pred") / 3))
    assert ev.srocc(bent).first()[0] == pytest.approx(1)
    flat = same.withColumn("y_true", F.lit(1.0))
    assert ev.srocc(flat).first()[0] is None


def test_constant_column_scales_to_zero(spark):
    df = spark.createDataFrame([(3.0,), (3.0,)], "k double")
    p = ev.scale_parameters(df, ["k"])
    assert ev.min_max_scale(df, p).first()[0] == 0 and ev.standard_scale(df, p).first()[0] == 0


def test_clean(spark):
    df = spark.createDataFrame([(float("inf"),), (float("nan"),), (None,), (2.0,)], "k double")
    assert sorted(r[0] for r in ev.clean(df, ["k"]).collect()) == [0, 0, 0, 2]


@pytest.mark.parametrize("model,params", [
    ("SVR", {"kernel": "rbf", "gamma": 0.1, "epsilon": 0.05}), ("SVR", {"kernel": "linear", "gamma": "scale"}),
    ("Tree", {"max_depth": 6}), ("Boosting squared", {"n_estimators": 5, "max_depth": 3}),
    ("Bagging", {"n_estimators": 4, "max_features": 1.0})])
def test_models_beat_the_mean(data, model, params):
    _, metrics = md.run_experiment(data, COLS, "y", "id", model, params)
    assert metrics["R2"] > 0.5


def test_saved_model_scores_the_same(spark, data, tmp_path):
    fitted = md.train(data, COLS, "y", "id", "SVR", {"kernel": "poly", "degree": 2, "gamma": 0.1})
    fitted.write().overwrite().save(str(tmp_path / "model"))
    again = PipelineModel.load(str(tmp_path / "model"))
    a, b = (md.predict(m, data).agg(F.sum("prediction")).first()[0] for m in (fitted, again))
    assert a == pytest.approx(b)


def test_search_and_selection(data):
    grams = ln.fold_grams(ev.kfold(data, "id", 4), COLS, "y", "fold")
    found = md.grid_search(grams, ["Linear", "Ridge", "Elastic"])
    assert len(found) == 1 + 9 + 54 and max(found, key=lambda t: t[2])[0] in ("Linear", "Ridge")
    backward, forward = (md.sequential_selection(grams, k, f) for k, f in ((1, False), (3, True)))
    assert set(backward) == {1, 2, 3} and forward[1]["feature_idx"] == backward[1]["feature_idx"]


def test_study_resumes(data):
    def objective(p):
        return (p["l1_ratio"] - 0.4) ** 2
    first = md.optimise(objective, md.SPACES["Elastic"], 12)
    more = md.optimise(objective, md.SPACES["Elastic"], 8, done=first)
    assert more[:12] == first and more == md.optimise(objective, md.SPACES["Elastic"], 20)


def test_importance_finds_the_strong_column(data):
    beta = ln.ridge(ln.total(ln.fold_grams(data, COLS, "y")))

    def score(cols):
        return sum((cols[c] * float(b) for c, b in zip(COLS, beta[1:])), F.lit(float(beta[0])))
    got = {r["idx"]: r["importance"] for r in md.permutation_importance(data, COLS, "y", "id", score, 2).collect()}
    assert max(got, key=got.get) == 1 and got[2] < got[1]


def test_null_keys_and_values_keep_their_rows(spark):
    from folioscore.operators import ledger as lg
    rows = [(s, t, v) for s in ("a", None) for t, v in ((1, 3.0), (2, None), (3, 1.0), (4, 3.0), (5, None))]
    trials = spark.createDataFrame(rows, "study string, trial long, value double")
    best = {(r["study"], r["trial"]): r["best"] for r in lg.optimisation_history(trials).collect()}
    ranks = {(r["study"], r["trial"]): r["rank"] for r in lg.trial_ranks(trials).collect()}
    for s in ("a", None):
        assert [best[s, t] for t in range(1, 6)] == [3.0, 3.0, 1.0, 1.0, 1.0]
        assert [ranks[s, t] for t in range(1, 6)] == [2, 4, 1, 2, 4]
    edf = {(r["study"], r["value"]): r["edf"] for r in lg.value_distribution(trials).collect()}
    assert edf["a", 1.0] == 0.2 and edf[None, 3.0] == 0.6 and edf[None, None] == 1.0


def test_programs_read_the_joined_rows_from_one_table(spark, tmp_path):
    """What is fitted in many passes does not join and group the given tables again in each of them."""
    from folioscore.catalog import learning
    lines = [(o, n, float(o % 9 + n), 0.01 * n, 0.02, 100.0 * o) for o in range(40) for n in range(3)]
    spark.createDataFrame([(o,) for o in range(40)], "o_orderkey long").write.parquet(str(tmp_path / "orders.parquet"))
    spark.createDataFrame(lines, "l_orderkey long, l_linenumber int, l_quantity double, l_discount double, l_tax double, "
                          "l_extendedprice double").write.parquet(str(tmp_path / "lineitem.parquet"))
    split = learning.clean_split(spark, str(tmp_path))
    assert split.count() == 40
    assert not any("lineitem" in f or "orders" in f for f in split.inputFiles())


def test_bagging_settings_share_their_draws(data, monkeypatch):
    """One pass of draws per fold for all settings; scores are those of each setting fitted alone."""
    folded = ev.kfold(data, "id", 2).cache()
    settings = [{"base": b, "n_estimators": n, "max_features": 0.7} for b in ("Ridge", "Linear") for n in (3, 5)]
    alone = []
    for p in settings:
        r2 = []
        for f in (0, 1):
            fitted = md.train(folded.where(F.col("fold") != f), COLS, "y", "id", "Bagging", p)
            r2.append(md.predict(fitted, folded.where(F.col("fold") == f), "y").agg(ev.METRICS["R2"](F.col(ev.Y), F.col(ev.P))).first()[0])
        alone.append(np.mean(r2))
    calls, plain = [], ln.bootstrap_grams
    monkeypatch.setattr(ln, "bootstrap_grams", lambda *a: calls.append(a[4:]) or plain(*a))
    found = md.search(folded, COLS, "y", "id", {"Bagging": settings})
    assert calls == [(5, 0)] * 2
    assert [f[:2] for f in found] == [("Bagging", p) for p in settings] and np.allclose([f[2] for f in found], alone)
