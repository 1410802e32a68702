"""Two-target regressors (R0-R10, R12 partially, R14-R21).

Every model is a *builder* ``(train_df, label_col) -> pyspark.ml.Estimator``; the builder
sees the training frame so data-dependent settings (the ridge penalty that matches the
closed form) are resolved at fit time. ``MultiTargetRegressor`` adds ``pred_<target>``.

Tree ensembles are ``TreeBuilder``s: their growth rules (variance or second-order gain, best-first,
symmetric, random cuts, splits shared by both targets) run in ``ensembles.py``, where any number of them grows
in the same jobs: both targets, the members of a vote or stack, and the folds and trials of ``validation.py``.
Bayesian ridge lives in ``iterative.py``, the MLP in ``mlp.py``. Not built (README): RBF SVR.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.ml import Estimator, Model
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geotrace.operators import ensembles, gram
from geotrace.operators.trees import NO_LIMIT, Grower

Builder = Callable[[DataFrame, str], Estimator]
SEED = 42

# Model lists of the reference, in its order.
DEFAULT_MODELS = ["RandomForest", "XGBoost", "LightGBM", "GradientBoosting", "HistGradientBoosting",
                  "ExtraTrees", "CatBoost", "Ridge", "Lasso", "ElasticNet", "BayesianRidge", "KNN", "SVR",
                  "MLP", "AdaBoost", "BaggedGB"]
PRIORITY_MODELS = ["RandomForest", "XGBoost", "LightGBM", "GradientBoosting", "BaggedGB", "HistGradientBoosting"]


def tree_count(n_samples: int | None) -> int:
    """Size-dependent number of trees / boosting rounds."""
    if not n_samples:
        return 100
    if n_samples < 1000:
        return 50
    if n_samples < 5000:
        return 100
    return 200


def model_params(name: str, n_samples: int | None = None) -> dict:
    """The reference's parameter table under Spark ML's names where those exist."""
    n = tree_count(n_samples)
    table = {
        "RandomForest": dict(numTrees=max(n, 200), maxDepth=20, minInstancesPerNode=4, minInstancesToSplit=10,
                             featureSubsetStrategy="sqrt", bootstrap=True),
        "XGBoost": dict(maxIter=max(n, 200), maxDepth=7, stepSize=0.05, subsamplingRate=0.85, treeFeatures=0.85,
                        regAlpha=0.5, regLambda=1.5, minInfoGain=0.1, minChildWeight=3.0),
        "LightGBM": dict(maxIter=max(n, 200), maxDepth=8, numLeaves=31, stepSize=0.05, subsamplingRate=0.85, treeFeatures=0.85,
                         regAlpha=0.5, regLambda=0.5, minInstancesPerNode=100),
        "GradientBoosting": dict(maxIter=107, stepSize=0.04598148562780493, maxDepth=9, minInstancesPerNode=8, minInstancesToSplit=20,
                                 subsamplingRate=0.6794037373341343, featureSubsetStrategy="log2"),
        "HistGradientBoosting": dict(maxIter=n, stepSize=0.1, maxDepth=None, numLeaves=31, minInstancesPerNode=20, maxBins=255),
        "ExtraTrees": dict(numTrees=n, maxDepth=None, minInstancesPerNode=2, minInstancesToSplit=5, featureSubsetStrategy="sqrt", bootstrap=False),
        "CatBoost": dict(maxIter=n, maxDepth=6, stepSize=0.1, regLambda=3.0, maxBins=254),
        "Ridge": dict(alpha=1.0),
        "Lasso": dict(alpha=1.0, maxIter=1000),
        "ElasticNet": dict(alpha=1.0, l1_ratio=0.5, maxIter=1000),
        "LinearRegression": dict(),
        "BaggedGB": dict(n_bags=5, maxIter=100, stepSize=0.1, maxDepth=3),
        "KNN": dict(k=5),
        "BayesianRidge": dict(max_iter=300, tol=1e-3),
        "AdaBoost": dict(n_estimators=n, learning_rate=1.0),
        "MLP": dict(hidden=(100, 50), learning_rate=1e-3, alpha=1e-4, max_iter=200),
    }
    if name not in table:
        raise KeyError(f"model {name!r} is not available on Spark")
    return dict(table[name])


def _label_stats(df: DataFrame, label: str) -> tuple[int, float]:
    n, sd = df.agg(F.count(label), F.stddev_pop(label)).first()
    return n, (sd or 0.0)


@dataclass
class LinearBuilder:
    """R8-R11 (and plain OLS) with penalties matching the closed-form objectives."""

    kind: str
    params: dict

    def __call__(self, train: DataFrame, label: str) -> Estimator:
        if self.kind == "BayesianRidge":
            from geotrace.operators.iterative import BayesianRidge
            return BayesianRidge(labelCol=label, **self.params)
        alpha, rho = self.params.get("alpha", 1.0), self.params.get("l1_ratio", 0.5)
        base = dict(labelCol=label, standardization=False, fitIntercept=True, maxIter=self.params.get("maxIter", 100), tol=1e-10)
        if self.kind == "LinearRegression":
            return LinearRegression(regParam=0.0, **base)
        n, sd = _label_stats(train, label)
        if self.kind == "Ridge":
            lam = alpha * sd / max(n, 1)
            return LinearRegression(regParam=lam, elasticNetParam=0.0, solver="normal", **base)
        if self.kind == "Lasso":
            return LinearRegression(regParam=alpha, elasticNetParam=1.0, **base)
        lam = alpha * (rho + (1 - rho) * sd)
        return LinearRegression(regParam=lam, elasticNetParam=(alpha * rho / lam) if lam else 0.0, **base)


def _linear(kind: str, params: dict) -> LinearBuilder:
    return LinearBuilder(kind, params)


def grower_of(name: str, params: dict) -> Grower:
    """The growth rules of a tree model (R1-R7, R14, R15). Forests share their splits between the targets."""
    p = dict(params)
    kind = {"RandomForest": "bag", "ExtraTrees": "bag", "AdaBoost": "adaboost"}.get(name, "boost")
    depth = p.get("maxDepth", 3)
    strategy = p.get("featureSubsetStrategy", "all")
    return Grower(
        kind=kind, trees=p.get("numTrees") or p.get("maxIter") or p.get("n_estimators"), depth=NO_LIMIT if depth is None else depth,
        rate=p.get("stepSize", p.get("learning_rate", 0.1)), joint=kind == "bag", leaves=p.get("numLeaves") or 0,
        symmetric=name == "CatBoost", random_cuts=name == "ExtraTrees", node_features=strategy, tree_features=float(p.get("treeFeatures", 1.0)),
        rows=p.get("subsamplingRate", 1.0), bootstrap="bayes" if name == "CatBoost" else "poisson" if p.get("bootstrap") else "none",
        min_leaf=p.get("minInstancesPerNode", 1), min_split=p.get("minInstancesToSplit", 2), min_weight=p.get("minChildWeight", 0.0),
        l1=p.get("regAlpha", 0.0), l2=p.get("regLambda", 0.0), min_gain=2.0 * p.get("minInfoGain", 0.0), bags=p.get("n_bags", 1),
        bins=p.get("maxBins", 255), seed=p.get("seed", SEED))


@dataclass
class TreeBuilder:
    """Builder of a tree ensemble; any number of these is fitted in the same jobs."""

    name: str
    params: dict

    @property
    def grower(self) -> Grower:
        return grower_of(self.name, self.params)

    def __call__(self, train: DataFrame, label: str) -> Estimator:
        return TreeEnsemble(self, label)


class TreeEnsemble(Estimator):
    """One target's tree ensemble."""

    def __init__(self, build: TreeBuilder, label: str):
        super().__init__()
        self.build, self.label, self.features, self.pred = build, label, "features", "prediction"

    def getOrDefault(self, param):
        return self.build.params[param] if isinstance(param, str) else super().getOrDefault(param)

    def setFeaturesCol(self, c):
        self.features = c
        return self

    def setPredictionCol(self, c):
        self.pred = c
        return self

    def _fit(self, df: DataFrame) -> Model:
        design = ensembles.design(df, self.features, (self.label,))
        return TreeModel(design, ensembles.fit_many(design, [ensembles.Job(self.build.grower)]).pieces[0], (self.pred,), self.features)


class TreeModel(Model):
    """Fitted ensembles; their pieces' predictions are added up in one pandas UDF per batch."""

    def __init__(self, design: ensembles.Design, pieces: list[ensembles.Piece], preds: tuple[str, ...], features: str):
        super().__init__()
        self.design, self.pieces, self.preds, self.features = design, pieces, preds, features

    def getPredictionCol(self) -> str:
        return self.preds[0]

    def _transform(self, df: DataFrame) -> DataFrame:
        out = ensembles.with_predictions(df, self.features, self.design, self.pieces, "_tree")
        return out.withColumns({c: F.col("_tree")[i] for i, c in enumerate(self.preds)}).drop("_tree")


class LinearModels(Model):
    """Linear predictions of several targets as array expressions."""

    def __init__(self, coef, intercept, preds: tuple[str, ...], features: str):
        super().__init__()
        self.coef, self.intercept, self.preds, self.features = coef, intercept, preds, features

    def _transform(self, df: DataFrame) -> DataFrame:
        out = df.withColumn("_x", vector_to_array(self.features))
        return out.withColumns({c: gram.linear_column("_x", self.coef[:, i], self.intercept[i]) for i, c in enumerate(self.preds)}).drop("_x")


class _Average(Estimator):
    """Average of several estimators fitted on the same frame (votes with members that aren't trees)."""

    def __init__(self, members: list[Estimator], label: str):
        super().__init__()
        self.members, self.label = members, label
        self._pred, self._features = "prediction", None

    def setPredictionCol(self, c: str) -> "_Average":
        self._pred = c
        return self

    def setFeaturesCol(self, c: str) -> "_Average":
        self._features = c
        return self

    def _fit(self, df: DataFrame) -> "_AverageModel":
        models = []
        for i, est in enumerate(self.members):
            e = est.copy()
            if self._features and hasattr(e, "setFeaturesCol"):
                e.setFeaturesCol(self._features)
            e.setPredictionCol(f"_p{i}_{self._pred}")
            models.append(e.fit(df))
        return _AverageModel(models).setPredictionCol(self._pred)


class _AverageModel(Model):
    def __init__(self, models: list[Model]):
        super().__init__()
        self.models = models
        self._pred = "prediction"

    def setPredictionCol(self, c: str) -> "_AverageModel":
        self._pred = c
        return self

    def getPredictionCol(self) -> str:
        return self._pred

    def _transform(self, df: DataFrame) -> DataFrame:
        out = df
        for m in self.models:
            out = m.transform(out)
        cols = [F.col(m.getPredictionCol()) for m in self.models]
        out = out.withColumn(self._pred, sum(cols) / F.lit(float(len(cols))))
        return out.drop(*[m.getPredictionCol() for m in self.models])


def builder(name: str, n_samples: int | None = None, overrides: dict | None = None) -> Builder:
    """Model name -> builder (R19's factory); ``overrides`` win over the table."""
    params = model_params(name, n_samples)
    params.update(overrides or {})
    if name in gram.KINDS:
        return _linear(name, params)
    if name == "KNN":
        from geotrace.operators.knn import knn_builder
        return knn_builder(params.get("k", 5))
    if name == "MLP":
        from geotrace.operators.mlp import MLPBuilder
        return MLPBuilder(params)
    return TreeBuilder(name, params)


class _Stacking(Estimator):
    """Out-of-fold base predictions -> ridge meta-model; bases refitted on all rows."""

    def __init__(self, bases: list[Builder], label: str, k: int = 5, alpha: float = 1.0):
        super().__init__()
        self.bases, self.label, self.k, self.alpha = bases, label, k, alpha
        self._pred, self._features = "prediction", "features"

    def setPredictionCol(self, c: str) -> "_Stacking":
        self._pred = c
        return self

    def setFeaturesCol(self, c: str) -> "_Stacking":
        self._features = c
        return self

    def _fit_bases(self, df: DataFrame) -> list[Model]:
        out = []
        for j, b in enumerate(self.bases):
            e = b(df, self.label)
            e.setFeaturesCol(self._features)
            e.setPredictionCol(f"_sp{j}")
            out.append(e.fit(df))
        return out

    def _fit(self, df: DataFrame) -> "_StackingModel":
        from pyspark.ml.feature import VectorAssembler
        fold = F.pmod(F.xxhash64(F.lit(SEED), F.col("trajectory_id")), F.lit(self.k))
        d = df.withColumn("_sf", fold)
        oof = None
        for f in range(self.k):
            held = d.where(F.col("_sf") == f)
            part = held
            for m in self._fit_bases(d.where(F.col("_sf") != f)):
                part = m.transform(part)
            part = part.select("trajectory_id", self.label, *[f"_sp{j}" for j in range(len(self.bases))])
            oof = part if oof is None else oof.unionByName(part)
        va = VectorAssembler(inputCols=[f"_sp{j}" for j in range(len(self.bases))], outputCol="_sv")
        meta = _linear("Ridge", {"alpha": self.alpha})(oof, self.label)
        meta.setFeaturesCol("_sv").setPredictionCol(self._pred)
        meta_model = meta.fit(va.transform(oof))
        return _StackingModel(self._fit_bases(df), va, meta_model)


class _StackingModel(Model):
    def __init__(self, bases: list[Model], va, meta: Model):
        super().__init__()
        self.bases, self.va, self.meta = bases, va, meta

    def _transform(self, df: DataFrame) -> DataFrame:
        out = df
        for m in self.bases:
            out = m.transform(out)
        out = self.meta.transform(self.va.transform(out))
        return out.drop("_sv", *[m.getPredictionCol() for m in self.bases])


@dataclass
class StackBuilder:
    """Out-of-fold predictions of the bases feed a ridge, for each target; the bases are refitted on all rows."""

    bases: list[Builder]
    k: int = 5
    alpha: float = 1.0

    def __call__(self, train: DataFrame, label: str) -> Estimator:
        return _Stacking(self.bases, label, self.k, self.alpha)

    def together(self) -> bool:
        """Whether all bases can be fitted in the same jobs."""
        return all(isinstance(b, (TreeBuilder, LinearBuilder)) for b in self.bases)


@dataclass
class VoteBuilder:
    """Mean of the members' predictions."""

    members: list[Builder]

    def __call__(self, train: DataFrame, label: str) -> Estimator:
        return _Average([b(train, label) for b in self.members], label)


def stacking_builder(builders: list[Builder], k: int = 5) -> StackBuilder:
    """Stack ``builders`` with a 5-fold out-of-fold ridge meta-model (per target)."""
    return StackBuilder(builders, k)


def voting_builder(builders: list[Builder]) -> VoteBuilder:
    """Mean of the members' predictions."""
    return VoteBuilder(builders)


def members_of(build: Builder) -> list[tuple[TreeBuilder | LinearBuilder, float]] | None:
    """The builder as a weighted sum of tree and linear models that can be fitted in the same jobs, if it is one."""
    if isinstance(build, (TreeBuilder, LinearBuilder)):
        return [(build, 1.0)]
    if isinstance(build, VoteBuilder):
        inner = [members_of(b) for b in build.members]
        return None if any(m is None for m in inner) else [(b, w / len(inner)) for m in inner for b, w in m]
    return None


def tree_members(build: Builder) -> list[tuple[TreeBuilder, float]] | None:
    found = members_of(build)
    return found if found and all(isinstance(b, TreeBuilder) for b, _ in found) else None


def weighted(pieces: list[ensembles.Piece], weight: float) -> list[ensembles.Piece]:
    return [replace(p, share=p.share * weight) for p in pieces]


class MultiTargetRegressor(Estimator):
    """One fitted estimator per target; adds ``pred_<target>`` columns."""

    def __init__(self, build: Builder, targets: tuple[str, ...] = ("dx", "dy"), features: str = "features"):
        super().__init__()
        self.build, self.targets, self.features = build, targets, features

    def _fit(self, df: DataFrame) -> "MultiTargetModel":
        trees = tree_members(self.build)
        if trees:
            design = ensembles.design(df, self.features, self.targets)
            found = ensembles.fit_many(design, [ensembles.Job(b.grower) for b, _ in trees]).pieces
            pieces = [p for i, (_, w) in enumerate(trees) for p in weighted(found.get(i, []), w)]
            return MultiTargetModel([TreeModel(design, pieces, tuple(f"pred_{t}" for t in self.targets), self.features)], self.targets)
        if isinstance(self.build, StackBuilder) and self.build.together():
            return MultiTargetModel([_stacked(df, self.build, self.targets, self.features)], self.targets)
        if hasattr(self.build, "of_all"):  # one fit serves all targets
            return MultiTargetModel([self.build.of_all(self.targets, self.features).fit(df)], self.targets)
        fitted = []
        for t in self.targets:
            est = self.build(df, t)
            est = est.copy() if hasattr(est, "copy") else est
            if hasattr(est, "setFeaturesCol"):
                est.setFeaturesCol(self.features)
            if hasattr(est, "setPredictionCol"):
                est.setPredictionCol(f"pred_{t}")
            fitted.append(est.fit(df))
        return MultiTargetModel(fitted, self.targets)


def _stacked(df: DataFrame, build: StackBuilder, targets: tuple[str, ...], features: str) -> "_StackedModel":
    """All folds' and the final bases in the same jobs, then one ridge a target on the out-of-fold predictions."""
    fold = F.pmod(F.xxhash64(F.lit(SEED), F.col("trajectory_id")), F.lit(build.k)).cast("int")
    raw = ensembles.raw_rows(df.withColumn("_sf", fold), features, targets, "_sf")
    k, bases, pred = len(targets), build.bases, None
    full: dict[int, Model] = {}
    tree_at = [i for i, b in enumerate(bases) if isinstance(b, TreeBuilder)]
    linear_at = [i for i, b in enumerate(bases) if isinstance(b, LinearBuilder)]
    names = {i: tuple(f"_sp{i}_{t}" for t in targets) for i in range(len(bases))}
    if tree_at:
        design = ensembles.binned(raw)
        folds = [*range(build.k), None]
        found = ensembles.fit_many(design, [ensembles.Job(bases[i].grower, f) for i in tree_at for f in folds])
        base = F.element_at(F.array(*[F.lit(i) for i in tree_at]), F.floor(F.col("job") / len(folds)).cast("int") + 1)
        pred = found.out.select(base.alias("model"), "row", F.array(*[F.col(f"p{t}") for t in range(k)]).alias("p"))
        for n, i in enumerate(tree_at):
            full[i] = TreeModel(design, found.pieces.get(n * len(folds) + build.k, []), names[i], features)
    if linear_at:
        whole, parts = gram.fold_grams(raw.rows, raw.features, k, build.k)
        systems = [[gram.solved(bases[i].kind, whole.less(part), bases[i].params) for part in parts] for i in linear_at]
        at = F.element_at(F.array(*[F.lit(i) for i in linear_at]), F.col("model") + 1)
        lines = gram.held_out(raw.rows, systems, k).select(at.alias("model"), "row", "p")
        pred = lines if pred is None else pred.unionByName(lines)
        for i in linear_at:
            full[i] = LinearModels(*gram.solved(bases[i].kind, whole, bases[i].params), names[i], features)
    meta = []
    wide = pred.groupBy("row").agg(*[F.max(F.when(F.col("model") == i, F.col("p"))).alias(f"m{i}") for i in range(len(bases))])
    wide = raw.rows.select("row", "fold", "y").join(wide, "row")
    for t in range(k):
        rows = wide.select("fold", F.array(*[F.col(f"m{i}")[t] for i in range(len(bases))]).alias("x"), F.array(F.col("y")[t]).alias("y"))
        meta.append(gram.solved("Ridge", gram.fold_grams(rows, len(bases), 1, 0)[0], {"alpha": build.alpha}))
    return _StackedModel([full[i] for i in range(len(bases))], meta, names, targets)


class _StackedModel(Model):
    def __init__(self, bases: list[Model], meta: list, names: dict[int, tuple[str, ...]], targets: tuple[str, ...]):
        super().__init__()
        self.bases, self.meta, self.names, self.targets = bases, meta, names, targets

    def _transform(self, df: DataFrame) -> DataFrame:
        out = df
        for m in self.bases:
            out = m.transform(out)
        for t, (name, (coef, intercept)) in enumerate(zip(self.targets, self.meta, strict=True)):
            line = sum((F.col(self.names[i][t]) * float(c) for i, c in enumerate(coef[:, 0])), F.lit(float(intercept[0])))
            out = out.withColumn(f"pred_{name}", line)
        return out.drop(*[c for names in self.names.values() for c in names])


class MultiTargetModel(Model):
    def __init__(self, models: list[Model], targets: tuple[str, ...]):
        super().__init__()
        self.models, self.targets = models, targets

    def _transform(self, df: DataFrame) -> DataFrame:
        out = df
        for m in self.models:
            out = m.transform(out)
        return out


@dataclass
class NamedModel:
    name: str
    build: Builder


def create_all_models(names: list[str] | None = None, n_samples: int | None = None,
                      params: dict[str, dict] | None = None, ensemble: bool = False) -> list[NamedModel]:
    """Buildable models in list order; unknown or unavailable names are skipped."""
    out = []
    for name in names or PRIORITY_MODELS:
        try:
            out.append(NamedModel(name, builder(name, n_samples, (params or {}).get(name))))
        except KeyError:
            continue
    if ensemble and len(out) >= 3:
        out.append(NamedModel("EnsembleVoting", voting_builder([m.build for m in out[:3]])))
    return out


def mean_baseline(train: DataFrame, test: DataFrame) -> DataFrame:
    """Every test id gets the mean training destination (a 1-row aggregate as scalar subquery)."""
    m = train.agg(F.struct(F.avg("dest_lat").alias("a"), F.avg("dest_lon").alias("o"))).scalar()
    return test.select("trajectory_id", m["a"].alias("latitude_pred"), m["o"].alias("longitude_pred"))


def score(model: MultiTargetModel, df: DataFrame) -> float:
    """Mean R^2 over the targets (the base-model ``score``), one aggregate pass."""
    p = model.transform(df)
    aggs = []
    for t in model.targets:
        sse = F.sum(F.pow(F.col(t) - F.col(f"pred_{t}"), 2))
        sst = F.var_pop(t) * F.count(F.lit(1))
        aggs.append(F.lit(1.0) - sse / F.nullif(sst, F.lit(0.0)))
    row = p.agg(*aggs).first()
    vals = [v for v in row if v is not None]
    return float(sum(vals) / len(vals)) if vals else float("nan")
