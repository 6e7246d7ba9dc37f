"""Scaling, fitting, evaluation, search, selection: M2-M30, W2, X1-X4."""

from __future__ import annotations

import json
import re
from functools import reduce

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, functions as F

from folioscore.catalog import query
from folioscore.operators import evaluate as ev, linear as ln, models as md, trials as tl
from folioscore.session import materialize, scratch_path
from folioscore.sources.derive import FEAT_SQL, FEATURE_NAMES, PRED_SQL, feature_rows, predictions, with_sql

X = FEATURE_NAMES
TERMS = "term string, weight double"
_LINE = "+".join(f"b{i}*({c}-m{i})/s{i}" for i, c in enumerate(X))
_PARAMS = ", ".join(f"avg({c}) m{i}, stddev_pop({c}) s{i}" for i, c in enumerate(X))
RANK = "rank() over (order by {c})+(count(*) over (partition by {c})-1)/2"
SPLIT_SQL = """ranked as materialized (select *, row_number() over (order by md5(concat(id,'42'))) r, count(*) over () n from feat),
 split as materialized (select *, case when r<=ceil(0.2*n) then 'test' else 'train' end split from ranked)"""


def each(template: str, sep: str = ", ") -> str:
    return sep.join(template.format(c=c) for c in X)


def scaled(spark, sf):
    df = feature_rows(spark, sf)
    return ev.standard_scale(df, ev.scale_parameters(df, X))


def kept_rows(spark, sf):
    """The regression table, joined once and written, for programs that read it many times."""
    return materialize(feature_rows(spark, sf), "rows")


def clean_split(spark, sf):
    return ev.train_test_split(ev.clean(kept_rows(spark, sf), X), "id")


@query("M2_min_max_scaler", with_sql(FEAT_SQL) + "select id, " + each(
    "round(({c}-min({c}) over ())/nullif(max({c}) over ()-min({c}) over (),0),6) {c}") + ", 0.0::double const from feat")
def min_max(spark, sf):
    df = feature_rows(spark, sf).withColumn("const", F.lit(7.0))
    out = ev.min_max_scale(df, ev.scale_parameters(df, [*X, "const"]))
    return out.select("id", *[F.round(c, 6).alias(c) for c in [*X, "const"]])


@query("M3_standard_scaler", with_sql(FEAT_SQL) + ", p as (select " + each("avg({c}) m{c}, stddev_pop({c}) s{c}")
       + " from feat) select id, " + each("round(({c}-m{c})/s{c},6) {c}") + " from feat, p")
def standard(spark, sf):
    return scaled(spark, sf).select("id", *[F.round(c, 6).alias(c) for c in X])


def solve_sql(alpha: float, final: str = "") -> str:
    """Normal equations of the scaled features, solved by elimination written out as CTEs."""
    idx = range(len(X))
    first = [f"n*covar_pop({X[i]},{X[j]})/(stddev_pop({X[i]})*stddev_pop({X[j]}))" + (f"+{alpha}" if i == j else "") + f" a{i}{j}"
             for i in idx for j in idx] + [f"n*covar_pop({X[i]},y)/stddev_pop({X[i]}) b{i}" for i in idx]
    ctes = [f"m0 as (select avg(y) b, {', '.join(first)} from feat, (select count(*) n from feat) group by n)"]
    for k in idx:
        cols = []
        for i in idx:
            f = f"a{i}{k}/a{k}{k}"
            for j in idx:
                cols.append(f"a{k}{j}/a{k}{k} a{k}{j}" if i == k else f"a{i}{j}-a{k}{j}*{f} a{i}{j}")
            cols.append(f"b{k}/a{k}{k} b{k}" if i == k else f"b{i}-b{k}*{f} b{i}")
        ctes.append(f"m{k + 1} as (select b, {', '.join(cols)} from m{k})")
    names = ", ".join(f"'{c}'" for c in X)
    if final:
        return with_sql(FEAT_SQL, *ctes) + final
    return with_sql(FEAT_SQL, *ctes) + f"""select unnest(['intercept', {names}]) term,
 round(unnest([b, {', '.join(f'b{i}' for i in idx)}]),6) weight from m{len(X)}"""


def weights(spark, sf, model, **params):
    gram = ln.total(ln.fold_grams(scaled(spark, sf), X, "y"))
    beta = ln.FITTERS[model](gram, **params)
    rows = [(t, round(float(b), 6) + 0.0) for t, b in zip(["intercept", *X], beta)]
    return spark.createDataFrame(rows, TERMS)


@query("M5_least_squares", solve_sql(0.0))
def least_squares(spark, sf):
    return weights(spark, sf, "Linear")


@query("M6_ridge", solve_sql(0.5))
def ridge(spark, sf):
    return weights(spark, sf, "Ridge", alpha=0.5)


@query("M7_elastic_net")
def elastic(spark, sf):
    return weights(spark, sf, "Elastic", alpha=0.001, l1_ratio=0.5, tol=1e-6)


def fit_metrics(spark, sf, model, params=None):
    """Train on the 80 %, evaluate on the 20 %: the metric table of one model."""
    split = clean_split(spark, sf)
    fitted = md.train(split.where("split = 'train'"), X, "y", "id", model, params)
    scored = md.predict(fitted, split.where("split = 'test'"), "y").select(ev.Y, ev.P)
    return ev.evaluate(materialize(scored, "scored"))  # ranks and metrics read it several times


def metrics_sql(alpha: float) -> str:
    """Split, scaling by the training rows, ridge by elimination, and the five metrics on the test rows."""
    _, _, ctes = solve_sql(alpha, " ").partition("m0 as")
    stages = ("m0 as" + ctes).replace(" from feat", " from train").strip().removesuffix(",")
    p = f"""pred as materialized (select y, b+{_LINE} p from split, m{len(X)}, (select {_PARAMS} from train) where split='test'),
 ranked2 as (select {RANK.format(c='y')} a, {RANK.format(c='p')} b from pred),
 row as (select 1-avg((y-p)*(y-p))/var_pop(y) r2, avg(abs(y-p)) mae, avg((y-p)*(y-p)) mse, corr(y,p) plcc from pred)"""
    return with_sql(FEAT_SQL, SPLIT_SQL, "train as materialized (select * exclude (n) from split where split='train')", stages, p) + """
 select unnest(['R2','MAE','MSE','PLCC','SROCC']) as name, round(unnest([r2,mae,mse,plcc,(select corr(a,b) from ranked2)]),6) as value from row"""


@query("M4_fit_pipeline", metrics_sql(0.5))
def fit_pipeline(spark, sf):
    return fit_metrics(spark, sf, "Ridge", {"alpha": 0.5}).select("name", F.round("value", 6).alias("value"))


@query("M8_kernel_regression")
def kernel_regression(spark, sf):
    name, params = md.SHIPPED_MODEL
    return fit_metrics(spark, sf, name, {**params, "epsilon": 0.01})


@query("M9_regression_tree")
def tree(spark, sf):
    return fit_metrics(spark, sf, "Tree", {"max_depth": 6})


@query("M10_boosted_trees_absolute")
def boosted_absolute(spark, sf):
    return fit_metrics(spark, sf, "Boosting absolute", {"iterations": 300, "depth": 4, "learning_rate": 0.1})


@query("M11_boosted_trees_squared")
def boosted_squared(spark, sf):
    return fit_metrics(spark, sf, "Boosting squared", {"n_estimators": 400, "max_depth": 4, "learning_rate": 0.1, "subsample": 0.8})


@query("M12_bagging")
def bagging(spark, sf):
    return fit_metrics(spark, sf, "Bagging", {"n_estimators": 50, "max_features": 0.5})




@query("S8_M13_saved_model_prediction", solve_sql(0.0, f"select id, round(b+{_LINE},6) prediction from feat, m{len(X)}, (select {_PARAMS} from feat)"))
def saved_model(spark, sf):
    df, path = feature_rows(spark, sf), scratch_path(spark, "model")
    md.train(df, X, "y", "id", "Linear").write().overwrite().save(path)
    return md.predict(PipelineModel.load(path), df).select("id", F.round("prediction", 6).alias("prediction"))


def metric_query(name: str, sql: str, scale: float = 1.0):
    @query(name, with_sql(PRED_SQL) + f"select round({sql},6) as value from pred")
    def run(spark, sf):
        key = name.split("_")[1]
        return ev.metric_row(predictions(spark, sf)).select(F.round(F.col(key) / F.lit(scale), 6).alias("value"))


_SQ = "avg((y_true-y_pred)*(y_true-y_pred))"
metric_query("M14_R2", f"1-{_SQ}/var_pop(y_true)")
metric_query("M15_MAE", "avg(abs(y_true-y_pred))/1000", 1000.0)
metric_query("M16_MSE", f"{_SQ}/1000000", 1000000.0)
metric_query("M17_PLCC", "corr(y_true,y_pred)")




@query("M18_SROCC", with_sql(PRED_SQL) + f"""select round(corr(a,b),6) "SROCC" from
 (select {RANK.format(c='y_true')} a, {RANK.format(c='y_pred')} b from pred)""")
def srocc(spark, sf):
    return ev.srocc(predictions(spark, sf)).select(F.round("SROCC", 6).alias("SROCC"))


@query("W2_average_ranks", with_sql(FEAT_SQL) + f"select distinct x1, {RANK.format(c='x1')} x1_rank, count(*) over (partition by x1) n from feat")
def average_ranks(spark, sf):
    return ev.average_ranks(feature_rows(spark, sf), "x1")


@query("M29_residual_histogram", with_sql(PRED_SQL) + """, r as (select y_pred-y_true r from pred), e as (select min(r) lo, max(r) hi from r)
 select cast(least(floor((r-lo)/(hi-lo)*100),99) as int) bin, count(*) n from r, e group by 1""")
def residuals(spark, sf):
    return ev.residual_histogram(predictions(spark, sf))


FOLDS = """placed as (select *, row_number() over (order by id)-1 pos, count(*) over () n from feat),
 folded as materialized (select *, cast(case when pos < (n%{k})*(n//{k}+1) then pos//(n//{k}+1) else (n%{k})+(pos-(n%{k})*(n//{k}+1))//(n//{k}) end as int) fold from placed)"""


@query("M20_kfold", with_sql(FEAT_SQL, FOLDS.format(k=4)) + "select id, fold from folded")
def kfold(spark, sf):
    return ev.kfold(feature_rows(spark, sf), "id", 4).select("id", "fold")


def fold_mae_sql(k: int) -> str:
    """Least squares on the rows outside each fold, by elimination, and the mean absolute error inside."""
    _, _, ctes = solve_sql(0.0, " ").partition("m0 as")
    stages, errors = [], []
    for h in range(k):
        own = re.sub(r"\bm(\d+)\b", rf"f{h}m\1", ("m0 as" + ctes).replace(" from feat", f" from (select * exclude (n, pos) from folded where fold<>{h})"))
        stages.append(own.strip().removesuffix(","))
        scale = f"(select {_PARAMS} from (select * exclude (n, pos) from folded where fold<>{h}))"
        errors.append(f"select avg(abs(y-(b+{_LINE}))) mae from folded, f{h}m{len(X)}, {scale} where fold={h}")
    return with_sql(FEAT_SQL, FOLDS.format(k=k), *stages) + f"select round(median(mae),6) mae from ({' union all '.join(errors)})"


@query("M21_kfold_median_mae", fold_mae_sql(3))
def kfold_mae(spark, sf):
    folded = ev.kfold(feature_rows(spark, sf), "id", 3)
    return spark.createDataFrame([(round(md.kfold_median_mae(folded, X, "y"), 6),)], "mae double")


def fold_grams(spark, sf, k):
    return ln.fold_grams(ev.kfold(scaled(spark, sf), "id", k), X, "y", "fold")


SEARCH = "model string, params string, score double"


def search_rows(spark, found):
    return spark.createDataFrame([(m, json.dumps(p), s) for m, p, s in found], SEARCH)


@query("M22_grid_search")
def grid_search(spark, sf):
    """Every setting of seven families: mean held-out R2."""
    folded = materialize(ev.kfold(kept_rows(spark, sf), "id", 5), "folded")
    found = md.search(folded, X, "y", "id", {m: md.candidates_of(m) for m in ("Tree", "Bagging")})
    settings = [(m, p) for m in ("Linear", "Ridge", "Elastic", "SVR", "Gradient Boosting") for p in md.candidates_of(m)]
    return search_rows(spark, tl.search(folded, X, "y", "id", settings) + found)


@query("M23_random_search")
def random_search(spark, sf):
    """100 settings of each of five families, drawn from the grids; all where a grid has fewer."""
    folded = ev.kfold(kept_rows(spark, sf), "id", 5)
    settings = [(m, p) for m in ("Linear", "Ridge", "Elastic", "SVR", "Gradient Boosting") for p in md.candidates_of(m, 100)]
    return search_rows(spark, tl.search(folded, X, "y", "id", settings))


STUDIES = {"SVR": 20, "Boosting": 20, "Elastic": 50}    # trials of each space


@query("M24_M25_parameter_study")
def study(spark, sf):
    """Three parameter spaces, each a study on median MAE over three folds, logged to one ledger."""
    source = tl.source_of(ev.kfold(kept_rows(spark, sf), "id", 3), X, "y", "id")
    path = scratch_path(spark, "studies")
    done = [tl.study(source, family, family, md.SPACES[family], n, path).select(F.lit(family).alias("study"), "*")
            for family, n in STUDIES.items()]
    return reduce(DataFrame.unionByName, done).select(
        "study", "trial", F.array_join(F.array_sort(F.transform(F.map_entries("params"), lambda e: F.concat(e["key"], F.lit("="), e["value"]))), " ").alias("params"),
        "value")


@query("M26_sequential_selection")
def selection(spark, sf):
    found = md.sequential_selection(fold_grams(spark, sf, 4), 1, forward=False)
    rows = [(k, list(v["feature_idx"]), v["avg_score"], v["std_dev"], v["std_err"]) for k, v in found.items()]
    return spark.createDataFrame(rows, "k long, feature_idx array<long>, avg_score double, std_dev double, std_err double")


@query("M27_feature_generation")
def generation(spark, sf):
    split = clean_split(spark, sf)
    train = md.generate_features(split.where("split = 'train'"), X)
    made = [c for c in train.columns if c not in ("id", "y", "split")]
    kept = md.select_features(train, made, "y", 6)
    return spark.createDataFrame([(i, c) for i, c in enumerate(kept)], "rank long, feature string")


@query("M28_permutation_importance")
def importance(spark, sf):
    df = materialize(scaled(spark, sf), "scaled")
    beta = ln.ridge(ln.total(ln.fold_grams(df, X, "y")))

    def score(cols):
        out = F.lit(float(beta[0]))
        for c, b in zip(X, beta[1:]):
            out = out + cols[c] * F.lit(float(b))
        return out
    return md.permutation_importance(df, X, "y", "id", score)


@query("M30_run_experiment", metrics_sql(0.1))
def experiment(spark, sf):
    _, metrics = md.run_experiment(feature_rows(spark, sf), X, "y", "id", "Ridge", {"alpha": 0.1})
    return spark.createDataFrame(sorted((n, round(v, 6)) for n, v in metrics.items()), "name string, value double")


@query("X1_metric_registry", with_sql(PRED_SQL) + "select round(max(abs(y_true-y_pred)),6) as worst from pred")
def metric_registry(spark, sf):
    ev.register_metric("worst", lambda y, p: F.max(F.abs(y - p)))
    try:
        return ev.metric_row(predictions(spark, sf)).select(F.round("worst", 6).alias("worst"))
    finally:
        ev.METRICS.pop("worst")
