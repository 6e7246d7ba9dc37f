"""Model registry, pipelines, search, selection and importance."""

from __future__ import annotations

from collections.abc import Callable
from itertools import product

import numpy as np
from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.errors import IllegalArgumentException
from pyspark.sql import Column, DataFrame, functions as F

from folioscore.functions import unary_maps
from folioscore.operators import boosting as bo, evaluate as ev, kernel as kn, linear as ln
from folioscore.operators.prefix import positions

# --- fixed values: the searched settings ---
GRID = {
    "Linear": {},
    "Ridge": {"alpha": [0.1, 0.5, 1.0], "solver": ["auto", "sparse_cg", "sag"]},
    "Elastic": {"alpha": [0.1, 0.5, 1.0], "l1_ratio": [0.25, 0.5, 0.75], "tol": [1e-6, 1e-4, 1e-3],
                "selection": ["cyclic", "random"]},
    "SVR": {"kernel": ["rbf", "linear", "poly", "sigmoid"], "degree": [2, 3],
            "gamma": ["scale", "auto", 0.1, 0.25, 0.2, 0.3]},
    "Tree": {"max_depth": [6, 12, 16]},
    "Gradient Boosting": {"loss": ["absolute_error"], "learning_rate": [0.01, 1, 2],
                          "n_estimators": [30, 50, 100], "max_depth": [3, 5, 10]},
    "Bagging": {"base": ["Ridge", "Linear"], "n_estimators": [50, 100], "max_features": [0.1, 0.5, 1.0]},
}
SHIPPED_MODEL = ("SVR", {"kernel": "rbf", "gamma": 0.1, "degree": 2})
SPACES = {
    "SVR": {"kernel": ("choice", ["rbf", "linear", "poly", "sigmoid"]), "degree": ("int", 1, 3),
            "gamma": ("log", 0.01, 1), "tol": ("log", 1e-5, 0.1), "C": ("real", 0.01, 10),
            "epsilon": ("log", 0.001, 0.5)},
    "Boosting": {"learning_rate": ("log", 0.001, 0.1), "max_depth": ("int", 1, 12)},
    "Elastic": {"alpha": ("log", 0.001, 1), "l1_ratio": ("real", 0.05, 1.0)},
}
# --- end of fixed values ---


def grid(model: str) -> list[dict]:
    names = list(GRID[model])
    return [dict(zip(names, values)) for values in product(*[GRID[model][n] for n in names])]


# ------------------------------------------------------------------ pipelines

def scaling_stage(params: dict[str, dict[str, float]]) -> SQLTransformer:
    """Min-max and standard scaling fused into one affine map per column (``z_<column>``)."""
    parts = [f"(cast({c} as double) - {float(p['mean'])!r}D) / {float(p['sd'] or 1.0)!r}D as z_{c}" for c, p in params.items()]
    return SQLTransformer(statement=f"SELECT *, {', '.join(parts)} FROM __THIS__")


def _line_sql(beta: np.ndarray, columns: list[str]) -> str:
    return " + ".join([f"{float(b)!r}D" for b in beta[:1]] + [f"{float(b)!r}D * z_{c}" for b, c in zip(beta[1:], columns)])


def _linear_stage(beta: np.ndarray, columns: list[str]) -> SQLTransformer:
    return SQLTransformer(statement=f"SELECT *, {_line_sql(beta, columns)} AS prediction FROM __THIS__")


Fit = Callable[[DataFrame, list[str], str, str, dict], list[Transformer]]


def _fit_linear(name: str) -> Fit:
    def fit(scaled: DataFrame, columns: list[str], y: str, id_col: str, params: dict) -> list[Transformer]:
        gram = ln.total(ln.fold_grams(scaled, [f"z_{c}" for c in columns], y))
        return [_linear_stage(ln.FITTERS[name](gram, **params), columns)]
    return fit


def _fit_svr(scaled: DataFrame, columns: list[str], y: str, id_col: str, params: dict) -> list[Transformer]:
    renames = {"kernel": "kind", "C": "c"}
    p = {renames.get(k, k): v for k, v in params.items() if k != "tol"}
    z = [f"z_{c}" for c in columns]
    model = kn.fit_svr(scaled, z, y, id_col, **p)
    return [SQLTransformer(statement=f"SELECT *, {kn.prediction_sql(model, z)} AS prediction FROM __THIS__")]


def _fit_trees(make: Callable[[dict], object]) -> Fit:
    def fit(scaled: DataFrame, columns: list[str], y: str, id_col: str, params: dict) -> list[Transformer]:
        assemble = VectorAssembler(inputCols=[f"z_{c}" for c in columns], outputCol="features")
        est = make(params).setFeaturesCol("features").setLabelCol(y).setPredictionCol("prediction")
        return [assemble, est.fit(assemble.transform(scaled))]
    return fit


def _fit_boosted(settings: Callable[[dict], dict]) -> Fit:
    def fit(scaled: DataFrame, columns: list[str], y: str, id_col: str, params: dict) -> list[Transformer]:
        return [bo.boosted_trees(scaled, [f"z_{c}" for c in columns], y, **settings(params))]
    return fit


def _fit_bagging(scaled: DataFrame, columns: list[str], y: str, id_col: str, params: dict) -> list[Transformer]:
    """Average of linear members, each on a bootstrap draw and a share of the columns; one pass draws for all."""
    grams = ln.bootstrap_grams(scaled, [f"z_{c}" for c in columns], y, id_col, *_members(params))
    return [_linear_stage(_bagged(grams, len(columns), params), columns)]


def _members(params: dict) -> tuple[int, int]:
    """Number of members and seed of their draws."""
    return int(params.get("n_estimators", 10)), int(params.get("seed", 0))


def _bagged(grams: list[np.ndarray], columns: int, params: dict) -> np.ndarray:
    """Mean weights of the first members of the draws behind ``grams``."""
    members, _ = _members(params)
    width = max(1, round(float(params.get("max_features", 1.0)) * columns))
    mean = np.zeros(columns + 1)
    base = params.get("base", "Linear")
    fitting = {} if base == "Linear" else {"alpha": float(params.get("alpha", 0.1))}
    for m in range(members):
        rng = np.random.default_rng(m)
        used = sorted(rng.choice(columns, width, replace=False))
        beta = ln.FITTERS[base](ln.subset(grams[m], used), **fitting)
        mean[[0, *[i + 1 for i in used]]] += beta / members
    return mean


MODELS: dict[str, Fit] = {
    "Linear": _fit_linear("Linear"), "Ridge": _fit_linear("Ridge"), "Elastic": _fit_linear("Elastic"),
    "SVR": _fit_svr, "Bagging": _fit_bagging,
    "Tree": _fit_trees(lambda p: DecisionTreeRegressor(maxDepth=int(p.get("max_depth", 5)), maxBins=64)),
    "Boosting absolute": _fit_boosted(lambda p: {
        "absolute": True, "rounds": int(p.get("iterations", 300)), "depth": int(p.get("depth", 6)),
        "rate": float(p.get("learning_rate", 0.03)), "seed": int(p.get("random_seed", 0))}),
    "Boosting squared": _fit_boosted(lambda p: {
        "absolute": False, "rounds": int(p.get("n_estimators", 100)), "depth": int(p.get("max_depth", 6)),
        "rate": float(p.get("learning_rate", 0.3)), "share": float(p.get("subsample", 1.0)),
        "least": int(p.get("min_child_weight", 1)), "per_node": str(p.get("colsample_bytree", "all"))}),
}


def _boosting(p: dict) -> dict:
    """Boosted trees under the names of the searched settings."""
    return {"absolute": p.get("loss", "absolute_error") == "absolute_error", "rounds": int(p.get("n_estimators", 100)),
            "depth": int(p.get("max_depth", 3)), "rate": float(p.get("learning_rate", 0.1))}


MODELS["Gradient Boosting"] = MODELS["Boosting"] = _fit_boosted(_boosting)


def register_model(name: str, fit: Fit) -> None:
    MODELS[name] = fit


def train(df: DataFrame, columns: list[str], y: str, id_col: str, model: str, params: dict | None = None) -> PipelineModel:
    """Scalers and regressor fitted on ``df``; saved and loaded like any pipeline model."""
    scale = scaling_stage(ev.scale_parameters(df, columns))
    return PipelineModel(stages=[scale, *MODELS[model](scale.transform(df), columns, y, id_col, params or {})])


def predict(model: PipelineModel, df: DataFrame, y: str | None = None) -> DataFrame:
    """Score rows; with ``y`` the result has the columns metrics expect."""
    out = model.transform(df)
    if y is None:
        return out.select(*df.columns, "prediction")
    return out.select(*[c for c in df.columns if c != y], F.col(y).alias(ev.Y), F.col("prediction").alias(ev.P))


def run_experiment(df: DataFrame, columns: list[str], y: str, id_col: str, model: str, params: dict) -> tuple[PipelineModel, dict]:
    """Clean, split, train on 80 %, evaluate on the rest."""
    split = ev.train_test_split(ev.clean(df, columns), id_col)
    fitted = train(split.where("split = 'train'"), columns, y, id_col, model, params)
    pred = predict(fitted, split.where("split = 'test'"), y)
    return fitted, {r["name"]: r["value"] for r in ev.evaluate(pred).collect()}


# ------------------------------------------------------------------ search

def grid_search(grams: dict[int, np.ndarray], models: list[str], leaky: bool = False,
                sample: int | None = None, seed: int = 42) -> list[tuple[str, dict, float]]:
    """(model, params, mean R2 over folds) for every candidate, or for ``sample`` of them."""
    out = []
    for m in models:
        candidates = grid(m)
        if sample is not None and len(candidates) > sample:
            picked = np.random.default_rng(seed).choice(len(candidates), sample, replace=False)
            candidates = [candidates[i] for i in sorted(picked)]
        out += [(m, p, float(np.mean(ln.cross_validate(grams, m, p, leaky)))) for p in candidates]
    return out


def candidates_of(model: str, sample: int | None = None, seed: int = 42) -> list[dict]:
    """The settings of a grid, or ``sample`` of them."""
    found = grid(model)
    if sample is None or len(found) <= sample:
        return found
    picked = np.random.default_rng(seed).choice(len(found), sample, replace=False)
    return [found[i] for i in sorted(picked)]


def search(folded: DataFrame, columns: list[str], y: str, id_col: str, candidates: dict[str, list[dict]]) -> list[tuple[str, dict, float | None]]:
    """(model, params, mean held-out R2) for settings of any registered model.

    Linear families never read the data again after one Gram pass; settings of bagging share their draws and are scored
    together, one pass each per fold; others are fitted and scored by one job per fold. A setting that the model refuses
    gets no score.
    """
    grams = ln.fold_grams(folded, columns, y, "fold")
    folds = sorted(grams)
    out: list[tuple[str, dict, float | None]] = []
    for model, settings in candidates.items():
        if model == "Bagging":
            out += zip([model] * len(settings), settings, _search_bagging(folded, columns, y, id_col, folds, settings))
            continue
        for params in settings:
            if model in ln.FITTERS:
                out.append((model, params, float(np.mean(ln.cross_validate(grams, model, params)))))
                continue
            try:
                scores = []
                for f in folds:
                    fitted = train(folded.where(F.col("fold") != f), columns, y, id_col, model, params)
                    held = predict(fitted, folded.where(F.col("fold") == f), y)
                    scores.append(held.agg(ev.METRICS["R2"](F.col(ev.Y), F.col(ev.P))).first()[0])
                out.append((model, params, float(np.mean(scores))))
            except IllegalArgumentException:
                out.append((model, params, None))
    return out


def _search_bagging(folded: DataFrame, columns: list[str], y: str, id_col: str, folds: list[int], settings: list[dict]) -> list[float]:
    scores: list[list[float]] = [[] for _ in settings]
    most: dict[int, int] = {}       # members by seed: fewer of them are the first of the same draws
    for members, seed in map(_members, settings):
        most[seed] = max(members, most.get(seed, 0))
    for f in folds if settings else []:
        rest = folded.where(F.col("fold") != f)
        scale = scaling_stage(ev.scale_parameters(rest, columns))
        scaled = scale.transform(rest)
        grams = {s: ln.bootstrap_grams(scaled, [f"z_{c}" for c in columns], y, id_col, n, s) for s, n in most.items()}
        lines = [_line_sql(_bagged(grams[_members(p)[1]], len(columns), p), columns) for p in settings]
        held = scale.transform(folded.where(F.col("fold") == f))
        for own, r in zip(scores, held.agg(*[ev.METRICS["R2"](F.col(y), F.expr(line)) for line in lines]).first()):
            own.append(r)
    return [float(np.mean(own)) for own in scores]


def draw(space: dict, rng: np.random.Generator, around: list[dict] | None = None) -> dict:
    """One setting of a parameter space; near one of the good settings when some are given."""
    centre = around[rng.integers(len(around))] if around else None
    out = {}
    for name, (kind, *args) in space.items():
        if kind == "choice":
            out[name] = centre[name] if centre and rng.random() < 0.8 else args[0][rng.integers(len(args[0]))]
            continue
        lo, hi = (np.log(args[0]), np.log(args[1])) if kind == "log" else (float(args[0]), float(args[1]))
        if centre:
            at = np.log(centre[name]) if kind == "log" else float(centre[name])
            v = float(np.clip(rng.normal(at, (hi - lo) / 8), lo, hi))
        else:
            v = rng.uniform(lo, hi)
        out[name] = float(np.exp(v)) if kind == "log" else int(round(v)) if kind == "int" else float(v)
    return out


def optimise(objective: Callable[[dict], float], space: dict, trials: int, done: list[tuple[dict, float]] | None = None,
             seed: int = 0) -> list[tuple[dict, float]]:
    """Sequential study that minimises the objective and resumes from trials already done.

    After ten random trials, new ones are drawn around the best quarter.
    """
    history = list(done or [])
    for i in range(len(history), len(history) + trials):
        rng = np.random.default_rng((seed, i))
        best = sorted(history, key=lambda h: h[1])[:max(1, len(history) // 4)] if i >= 10 else []
        setting = draw(space, rng, [p for p, _ in best])
        history.append((setting, float(objective(setting))))
    return history


def fold_predictions(folded: DataFrame, columns: list[str], y: str, betas: dict[int, np.ndarray]) -> DataFrame:
    """Held-out predictions of per-fold linear models, all folds in one pass."""
    def line(b: np.ndarray) -> Column:
        out = F.lit(float(b[0]))
        for c, v in zip(columns, b[1:]):
            out = out + F.col(c) * F.lit(float(v))
        return out
    pred = F.coalesce(*[F.when(F.col("fold") == f, line(b)) for f, b in betas.items()])
    return folded.select("fold", F.col(y).alias(ev.Y), pred.alias(ev.P))


def kfold_median_mae(folded: DataFrame, columns: list[str], y: str, model: str = "Linear", params: dict | None = None) -> float:
    """Median over folds of the held-out mean absolute error of a linear family model."""
    grams = ln.fold_grams(folded, columns, y, "fold")
    betas = {f: ln.FITTERS[model](ln.total(grams, without=f), **(params or {})) for f in grams}
    per_fold = fold_predictions(folded, columns, y, betas).groupBy("fold").agg(F.avg(F.abs(F.col(ev.Y) - F.col(ev.P))).alias("mae"))
    return per_fold.agg(F.percentile("mae", 0.5)).first()[0]


def kfold_median_mae_any(folded: DataFrame, columns: list[str], y: str, id_col: str, model: str, params: dict) -> float:
    """The same for any registered model: one fit and one scoring job per fold."""
    maes = []
    for (f,) in folded.select("fold").distinct().orderBy("fold").collect():
        fitted = train(folded.where(F.col("fold") != f), columns, y, id_col, model, params)
        held = predict(fitted, folded.where(F.col("fold") == f), y)
        maes.append(held.agg(F.avg(F.abs(F.col(ev.Y) - F.col(ev.P)))).first()[0])
    return float(np.median(maes))


# ------------------------------------------------------------------ feature selection, generation

def _subset_score(grams: dict[int, np.ndarray], features: tuple[int, ...]) -> list[float]:
    """Negative held-out mean squared error per fold of least squares on a subset."""
    scores = []
    for f, held in grams.items():
        beta = ln.ridge(ln.subset(ln.total(grams, without=f), features))
        part = ln.subset(held, features)
        scores.append(-ln.squared_error(part, beta) / part[0, 0])
    return scores


def sequential_selection(grams: dict[int, np.ndarray], target: int, forward: bool = True) -> dict[int, dict]:
    """Floating forward or backward selection; statistics per subset size in the order visited."""
    p = next(iter(grams.values())).shape[0] - 2
    current: tuple[int, ...] = () if forward else tuple(range(p))
    best: dict[int, tuple[float, tuple[int, ...]]] = {}

    def mean(s: tuple[int, ...]) -> float:
        return float(np.mean(_subset_score(grams, s)))

    def moves(s: tuple[int, ...], add: bool) -> list[tuple[int, ...]]:
        return [tuple(sorted((*s, i))) for i in range(p) if i not in s] if add else [
            tuple(j for j in s if j != i) for i in s]

    def note(s: tuple[int, ...]) -> None:
        if s and (len(s) not in best or mean(s) > best[len(s)][0]):
            best[len(s)] = (mean(s), s)
    note(current)
    while len(current) != target:
        current = max(moves(current, forward), key=mean)
        note(current)
        while True:  # floating step: undo a move while that beats the best set of that size
            back = moves(current, not forward)
            cand = max(back, key=mean) if back and 0 < len(back[0]) < p else None
            if cand is None or len(cand) not in best or mean(cand) <= best[len(cand)][0]:
                break
            current = cand
            note(current)
    out = {}
    for k, (_, s) in best.items():
        scores = np.array(_subset_score(grams, s))
        sd, n = scores.std(), len(scores)
        out[k] = {"feature_idx": s, "avg_score": float(scores.mean()), "cv_scores": scores.tolist(),
                  "std_dev": float(sd), "std_err": float(sd / np.sqrt(n - 1))}
    return out


def generate_features(df: DataFrame, columns: list[str], second_step: bool = True) -> DataFrame:
    """Eight unary maps of every column and, as second step, pairwise products of the inputs.

    A map that is not finite for any row is dropped: one aggregate decides for all of them.
    """
    made = {f"{n}_{c}": e for c in columns for n, e in unary_maps(F.col(c)).items()}
    if second_step:
        made |= {f"{a}_x_{b}": F.col(a) * F.col(b) for i, a in enumerate(columns) for b in columns[i + 1:]}
    wide = df.withColumns(made)
    bad = wide.agg(*[F.count_if(F.col(n).isNull() | F.isnan(n) | (F.abs(n) == float("inf"))).alias(n) for n in made]).first()
    return wide.drop(*[n for n in made if bad[n]])


def apply_generated(df: DataFrame, columns: list[str], plan: list[str]) -> DataFrame:
    """The features of a plan (names that ``generate_features`` and ``select_features`` gave) for new rows.

    Values that are not finite there become 0, as everywhere in this library.
    """
    made = {f"{n}_{c}": e for c in columns for n, e in unary_maps(F.col(c)).items()}
    made |= {f"{a}_x_{b}": F.col(a) * F.col(b) for i, a in enumerate(columns) for b in columns[i + 1:]}
    made |= {c: F.col(c) for c in columns}
    unknown = [n for n in plan if n not in made]
    if unknown:
        raise ValueError(f"no such generated features: {unknown}")
    return ev.clean(df.withColumns({n: made[n] for n in plan}), plan)


def select_features(df: DataFrame, candidates: list[str], y: str, keep: int) -> list[str]:
    """Candidates with the strongest linear relation to ``y`` that elastic net retains."""
    row = df.agg(*[F.abs(F.corr(c, y)).alias(c) for c in candidates]).first()
    ranked = sorted((c for c in candidates if row[c] is not None and row[c] == row[c]), key=lambda c: (-row[c], c))
    gram = ln.total(ln.fold_grams(df, ranked, y))
    s = ln.standardised(gram)
    beta = ln.elastic_net(gram * np.outer(s, s), alpha=0.001, l1_ratio=0.9)
    order = sorted(range(len(ranked)), key=lambda i: -abs(beta[i + 1]))
    return [ranked[i] for i in order[:keep] if beta[i + 1] != 0]


def permutation_importance(df: DataFrame, columns: list[str], y: str, id_col: str,
                           score: Callable[[dict[str, Column]], Column], repeats: int = 5) -> DataFrame:
    """Mean loss of R2 when one column is shuffled: ``(idx, importance)``.

    Each repeat pairs every row with the row at the same place of a hash order; all columns of a
    repeat are rescored in one aggregate.
    """
    target = F.col(y)
    own = {c: F.col(c) for c in columns}

    def r2(p: Column) -> Column:
        return ev.METRICS["R2"](target, p)
    placed = positions(df.select(id_col, *columns, y), id_col)
    parts = []
    for r in range(repeats):
        key = F.conv(F.substring(ev.split_order(id_col, r), 1, 12), 16, 10).cast("long")
        other = positions(df.select(*[F.col(c).alias(f"o_{c}") for c in columns], key.alias("k")), "k").drop("k")
        pair = placed.join(other, "pos")
        drops = pair.agg(r2(score(own)).alias("base"), *[r2(score({**own, c: F.col(f"o_{c}")})).alias(c) for c in columns])
        parts.append(drops.select(F.posexplode(F.array(*[F.col("base") - F.col(c) for c in columns])).alias("idx", "loss")))
    union = parts[0]
    for p in parts[1:]:
        union = union.unionByName(p)
    return union.groupBy("idx").agg(F.avg("loss").alias("importance"))
