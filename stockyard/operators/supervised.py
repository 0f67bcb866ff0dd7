"""Competing price and fraud models: trees, boosted trees and forests of ``boosting``."""

from __future__ import annotations

import json
import math
import random
from collections.abc import Callable
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, PipelineModel, Transformer
from pyspark.ml.evaluation import Evaluator, RegressionEvaluator
from pyspark.ml.feature import QuantileDiscretizer, RobustScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from stockyard.functions.scalars import heuristic_price
from stockyard.operators.boosting import (BoostedClassifier, BoostedRegressor, ForestClassifier, ForestRegressor, Packed, TreeClassifier, TreeRegressor, errors,
                                         same_rows)
from stockyard.operators.commerce import class_weights
from stockyard.operators.features import fill_zero
from stockyard.operators.metrics import best_model, classification_metrics, cv_summary, regression_metrics, roc_auc
from stockyard.operators.sampling import assign_folds, split_random, split_stratified
from stockyard.operators.tracking import model_comparison
from stockyard.sources.records import Records
from stockyard.workspace import fresh_dir, materialize, spread


def _assembler(features: list[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=features, outputCol="_raw", handleInvalid="keep")


def _scaler() -> RobustScaler:
    """Fitted with the model on training rows only."""
    return RobustScaler(inputCol="_raw", outputCol="features", withCentering=True, withScaling=True)


def scaling_stages(features: list[str]) -> list[Estimator]:
    return [_assembler(features), _scaler()]


# Default size of the competing models (trees, depth, learning rate).
TREES, DEPTH, RATE = 200, 6, 0.05


#: Bins of a feature in cross-validation and tuning: what the trees would cut it into themselves.
BINS = 32


#: Rows that the fits running at a time may cache together: each keeps its own copy, about 150 bytes a row, and copies that do not fit are
#: written to disk and read back at every level of a tree.  Boosted trees that grow side by side share a copy and have 16 bytes a row of their own.
ROWS_IN_FITS = 60_000_000


class Folds:
    """Rows binned once for all folds and trials: ``fold``, the target and ``features``, written once.

    Trees look at the order of values only, so a scaler changes nothing for them and rows need no rescaling per fold.  The edges of the
    bins come from all rows; no target is looked at.  A fold's training rows are all rows but those it masks out.
    """

    def __init__(self, df: DataFrame, features: list[str], target: str, order: list[str], folds: int):
        columns = list(dict.fromkeys([*order, *features, target]))
        data = assign_folds(fill_zero(df.select(*columns), features), order, folds)
        binned = [f"_bin_{i}" for i in range(len(features))]
        finder = QuantileDiscretizer(inputCols=features, outputCols=binned, numBuckets=BINS, relativeError=0.001, handleInvalid="keep")
        self.stages = [finder.fit(data), VectorAssembler(inputCols=binned, outputCol="features")]
        for stage in self.stages:
            data = stage.transform(data)
        self.rows = materialize(spread(data.select("fold", F.col(target).cast("double").alias(target), "features")), "binned")
        self.count, self.target, self._packed = folds, target, None

    def at_a_time(self, parallelism: int) -> int:
        """Fits that may run at a time, at least one."""
        return max(1, min(parallelism, ROWS_IN_FITS // max(1, self.rows.count())))

    def train(self, fold: int) -> DataFrame:
        return self.rows.where(F.col("fold") != fold)

    def test(self, fold: int) -> DataFrame:
        return self.rows.where(F.col("fold") == fold)

    def packed(self, estimator: Estimator) -> Packed:
        """Rows for trees of histograms, packed once for all families, folds and trials."""
        if self._packed is None or not same_rows([self._packed[0], estimator]):
            self.close()
            self._packed = estimator, estimator.packed(self.rows, "fold")
        return self._packed[1]

    def close(self) -> None:
        if self._packed is not None:
            self._packed[1].unpersist()
            self._packed = None

    def each(self, jobs: list[tuple[Estimator, int]], use: Callable[[int, Transformer, dict | None], object], parallelism: int,
             ask: bool = False) -> list:
        """What ``use`` makes of the number and the model of every job, an estimator fitted without a fold.  Trees of histograms of a kind grow side
        by side, others are fitted each by itself.  Where rows are many, or if ``ask``, all regression trees of histograms are asked for their errors in
        their folds in one pass over the rows, and ``use`` gets them as its third argument."""
        shared = [k for k, (e, _) in enumerate(jobs) if same_rows([e])]
        shared = [k for k in shared if same_rows([jobs[shared[0]][0], jobs[k][0]])]
        kinds: dict[type, list[int]] = {}
        for k in shared:
            kinds.setdefault(type(jobs[k][0]), []).append(k)
        together = max(1, (150 * ROWS_IN_FITS // max(1, self.rows.count()) - 30) // 16)
        units = [kind[i:i + together] for kind in kinds.values() for i in range(0, len(kind), together)] + [[k] for k in range(len(jobs)) if k not in shared]
        packed = self.packed(jobs[shared[0]][0]) if shared else None

        def fit(unit: list[int]) -> list[tuple[int, Transformer]]:
            if unit[0] not in shared:
                return [(k, jobs[k][0].fit(self.train(jobs[k][1]))) for k in unit]
            return list(zip(unit, jobs[unit[0]][0].fit_packed([jobs[k][0] for k in unit], packed, [jobs[k][1] for k in unit])))

        inherit = inheritable_thread_target(self.rows.sparkSession)
        with ThreadPool(self.at_a_time(parallelism)) as pool:
            models = dict(sum(pool.map(inherit(fit), units, chunksize=1), []))
            told = [k for k in shared if (ask or not packed.alone) and models[k].getOrDefault(models[k].kind) == "regression"]
            found = dict(zip(told, errors(self.rows, [(models[k], jobs[k][1]) for k in told], self.target)))
            return pool.map(inherit(lambda k: use(k, models[k], found.get(k))), range(len(jobs)), chunksize=1)

    def model(self, estimator: Estimator) -> PipelineModel:
        """Fitted on all rows; takes rows of the original columns."""
        fitted = estimator.fit_packed([estimator], self.packed(estimator))[0] if same_rows([estimator]) else estimator.fit(self.rows)
        return PipelineModel([*self.stages, fitted])


def regressors(trees: int = TREES, depth: int = DEPTH, rate: float = RATE, seed: int = 42) -> dict[str, Estimator]:
    return {
        "gradient_boosting": BoostedRegressor(maxIter=trees, maxDepth=depth, stepSize=rate, seed=seed),
        "random_forest": ForestRegressor(numTrees=trees, maxDepth=depth, seed=seed),
        "decision_tree": TreeRegressor(maxDepth=depth, seed=seed),
    }


def classifiers(trees: int = TREES, depth: int = DEPTH, rate: float = RATE, seed: int = 42) -> dict[str, Estimator]:
    return {
        "gradient_boosting": BoostedClassifier(maxIter=trees, maxDepth=depth, stepSize=rate, seed=seed),
        "random_forest": ForestClassifier(numTrees=trees, maxDepth=depth, seed=seed),
        "decision_tree": TreeClassifier(maxDepth=depth, seed=seed),
    }


def _fit_all(estimators: dict[str, Estimator], train: DataFrame) -> dict[str, Transformer]:
    """Every estimator fitted on the same rows; trees of histograms that may share packed rows do."""
    models, left = {}, dict(estimators)
    while left:
        first = next(iter(left))
        mine = [n for n in left if same_rows([left[first], left[n]])] or [first]
        if same_rows([left[first]]):
            packed = left[first].packed(train)
            for name in mine:
                models[name] = left[name].fit_packed([left[name]], packed)[0]
            packed.unpersist()
        else:
            models[first] = left[first].fit(train)
        left = {n: e for n, e in left.items() if n not in mine}
    return {n: models[n] for n in estimators}


class Competition:
    """Fitted models by name, their metrics, and the winner."""

    def __init__(self, features: list[str], models: dict[str, PipelineModel], metrics: DataFrame, best: str | None):
        self.features, self.models, self.metrics, self.best = features, models, metrics, best

    def model(self, name: str | None = None) -> PipelineModel:
        name = name or self.best
        if name not in self.models:
            raise ValueError(f"no fitted model is called '{name}', only {sorted(self.models)}")
        return self.models[name]

    def predict(self, df: DataFrame, name: str | None = None) -> DataFrame:
        return self.model(name).transform(fill_zero(df, self.features)).drop("_raw", "features")

    def forecast_regions(self, df: DataFrame, horizon_days: int = 30) -> DataFrame:
        """Best model on every row with a constant horizon; it projects nothing in time."""
        if "region" not in df.columns:
            df = df.withColumn("region", F.lit("ALL"))
        return self.predict(df).select("region", F.col("prediction").alias("forecast_price"),
                                       F.lit(horizon_days).alias("horizon_days"))


def _with_order(metrics: DataFrame, names: list[str]) -> DataFrame:
    order = F.array_position(F.array(*[F.lit(n) for n in names]), F.col("model"))
    return metrics.withColumn("ord", order.cast("int"))


def train_regressors(df: DataFrame, key: str, features: list[str], target: str, order: list[str] | None = None,
                     estimators: dict[str, Estimator] | None = None, test_size: float = 0.2, folds: int = 0,
                     seed: int = 42) -> Competition:
    """Fit every estimator on the same split; the lowest test rmse wins, the first listed on ties.

    ``folds`` > 0 adds contiguous k-fold errors along ``order``.
    """
    features = [c for c in features if c in df.columns]
    estimators = estimators or regressors(seed=seed)
    data = fill_zero(df.select(key, *[c for c in features if c != key], target)
                     .withColumn(target, F.col(target).cast("double")), features)
    assembler = _assembler(features)
    # written once and read by columns: many rows of vectors fill the memory that is left for training
    data = materialize(split_random(data, key, test_size, seed).select("split", target, *features), "split")
    data = assembler.transform(spread(data)).select("split", target, "_raw")
    scaler = _scaler().fit(data.where("split = 'train'"))
    train, test = (scaler.transform(data.where(F.col("split") == part)) for part in ("train", "test"))
    fitted = _fit_all({n: e.copy({e.labelCol: target}) for n, e in estimators.items()}, train)
    models, answers = {n: PipelineModel([assembler, scaler, m]) for n, m in fitted.items()}, test
    for name, model in fitted.items():
        answers = model.transform(answers).withColumn(f"_of_{name}", F.struct(F.lit(name).alias("model"), F.col("prediction").alias("y_hat"))).drop("prediction")
    # all models answer in one pass over the test rows
    scored = answers.select(F.col(target).alias("y_true"), F.inline(F.array(*[F.col(f"`_of_{name}`") for name in fitted])))
    metrics = regression_metrics(scored, by=["model"])
    if folds:
        metrics = metrics.join(cross_validate(df, features, target, order, estimators, folds), "model")
    rows = _with_order(metrics, list(estimators)).collect()  # one row per model
    metrics = df.sparkSession.createDataFrame(rows)
    return Competition(features, models, metrics, best_model(metrics).head()["best_model"])


def fold_results(df: DataFrame, features: list[str], target: str, order: list[str], estimators: dict[str, Estimator], folds: int = 5,
                 parallelism: int = 4, held: Folds | None = None) -> DataFrame:
    """Unshuffled k-fold errors: ``model``, ``fold``, ``n`` (its rows), ``mean_y`` and ``var_y`` (of its targets), ``mse``.

    All models and folds read one binned table, ``held`` if the caller has it; up to ``parallelism`` fits run at a time, fewer where their cached
    rows are many.
    """
    held = held or Folds(df, [c for c in features if c in df.columns], target, order, folds)
    jobs = [(name, f) for name in estimators for f in range(held.count)]

    def measured(k: int, model: Transformer, told: dict | None) -> Row:
        (name, fold), y = jobs[k], F.col(target)
        if told is not None:
            return Row(model=name, fold=fold, n=told["n"], mean_y=told["mean_y"], var_y=told["var_y"], mse=told["mse"])
        return model.transform(held.test(fold)).agg(
            F.lit(name).alias("model"), F.lit(fold).alias("fold"), F.count(F.lit(1)).alias("n"), F.avg(y).alias("mean_y"),
            F.var_pop(y).alias("var_y"), F.avg((y - F.col("prediction")) ** 2).alias("mse")).first()

    fits = [(estimators[name].copy({estimators[name].labelCol: target}), fold) for name, fold in jobs]
    rows = held.each(fits, measured, parallelism, ask=True)  # models x folds rows
    held.close()
    return df.sparkSession.createDataFrame(rows, "model string, fold int, n long, mean_y double, var_y double, mse double")


def cross_validate(df: DataFrame, features: list[str], target: str, order: list[str],
                   estimators: dict[str, Estimator], folds: int = 5, parallelism: int = 4) -> DataFrame:
    """Unshuffled k-fold errors per model: cv_rmse_mean, cv_rmse_std."""
    return cv_summary(fold_results(df, features, target, order, estimators, folds, parallelism), by=["model"])


def train_classifiers(df: DataFrame, key: str, features: list[str], label: str, weighted: bool = True,
                      weighted_models: list[str] | None = None, estimators: dict[str, Estimator] | None = None,
                      test_size: float = 0.2, train_rows: Callable[[DataFrame], DataFrame] | None = None,
                      seed: int = 42) -> Competition:
    """Fit every estimator on the same stratified split and score accuracy, weighted F1 and AUC.

    Class weights apply to ``weighted_models`` (default: the first family only).  ``train_rows``
    may resample the training part, e.g. with SMOTE.
    """
    features = [c for c in features if c in df.columns]
    estimators = estimators or classifiers(seed=seed)
    weighted_models = list(estimators)[:1] if weighted_models is None else weighted_models
    data = split_stratified(fill_zero(df.select(key, *features, label), features), key, label, test_size, seed)
    # written once: the training rows, their weights and the test rows all follow from the ranks and the join of the split
    data = spread(materialize(data.withColumn(label, F.col(label).cast("double")), "split"))
    train, test = data.where("split = 'train'").drop("split"), data.where("split = 'test'").drop("split")
    if train_rows is not None:
        train = spread(materialize(train_rows(train), "resampled"))
    # a map with one entry per class: joining on the label would send most rows to one task
    weights = class_weights(train, label).agg(
        F.map_from_entries(F.collect_list(F.struct("label", "weight"))).alias("w")).scalar()
    train = train.withColumn("_weight", F.element_at(weights, F.col(label)))
    assembler = _assembler(features)
    train = assembler.transform(train).select(label, "_weight", "_raw")
    scaler = _scaler().fit(train)
    scaled = scaler.transform(train)
    models, answers = {}, scaler.transform(assembler.transform(test).select(F.col(label).cast("int").alias("label"), "_raw"))
    weigh = lambda n, e: {e.labelCol: label} | ({e.weightCol: "_weight"} if weighted and n in weighted_models else {})
    for name, fitted in _fit_all({n: e.copy(weigh(n, e)) for n, e in estimators.items()}, scaled).items():
        models[name] = PipelineModel([assembler, scaler, fitted])
        answers = fitted.transform(answers).withColumn(f"_of_{name}", F.struct(
            F.lit(name).alias("model"), F.col("prediction").cast("int").alias("pred"), vector_to_array("probability")[1].alias("prob"))
        ).drop("prediction", "probability", "rawPrediction")
    # all models answer in one pass over the test rows
    scored = answers.select("label", F.inline(F.array(*[F.col(f"`_of_{name}`") for name in estimators]))).persist()
    metrics = classification_metrics(scored, by=["model"]).join(roc_auc(scored, by=["model"]), "model")
    rows = _with_order(metrics, list(estimators)).collect()  # one row per model
    scored.unpersist()
    return Competition(features, models, df.sparkSession.createDataFrame(rows), None)


def comparison(result: Competition) -> DataFrame:
    return model_comparison(result.metrics, [c for c in result.metrics.columns if c not in ("model", "ord")])


# ---------------------------------------------------------------- tuning

# Search space of the price model.
SEARCH_SPACE = {"trees": ("int", 50, 300), "depth": ("int", 3, 10), "rate": ("log", 0.01, 0.3),
                "subsample": ("float", 0.6, 1.0), "features": ("float", 0.6, 1.0)}


def draw_params(space: dict, trials: int, seed: int = 42) -> list[dict]:
    """Seeded random draws from a space of int, float and log-float ranges."""
    rng = random.Random(seed)
    draw = {"int": lambda a, b: rng.randint(a, b), "float": rng.uniform,
            "log": lambda a, b: math.exp(rng.uniform(math.log(a), math.log(b)))}
    return [{k: draw[kind](a, b) for k, (kind, a, b) in space.items()} for _ in range(trials)]


def boosted_regressor(params: dict, target: str, seed: int = 42) -> Estimator:
    return BoostedRegressor(labelCol=target, maxIter=params["trees"], maxDepth=params["depth"], stepSize=params["rate"],
                        subsamplingRate=params["subsample"], featureSubsetStrategy=str(params["features"]), seed=seed)


LEDGER = "trial int, fold int, value double, study string"


class Ledger:
    """Finished folds of a study, one record each, so that a driver that starts again repeats none of them.

    A ledger belongs to one study: opening it for another one is refused.
    """

    def __init__(self, spark: SparkSession, path: str, study: dict):
        self.records, self.study = Records(spark, path, LEDGER), json.dumps(study, sort_keys=True, default=str)
        self.records.create("study", {"trial": -1, "fold": -1, "study": self.study})
        rows = self.records.read().collect()  # one record per trial and fold
        if any(r["study"] not in (None, self.study) for r in rows):
            raise ValueError(f"the ledger at {path} belongs to another study")
        self.done = {(r["trial"], r["fold"]): r["value"] for r in rows if r["trial"] >= 0}

    def run(self, trial: int, fold: int, fit: Callable[[int, int], float]) -> float:
        if (trial, fold) not in self.done:
            value = fit(trial, fold)
            self.records.create(f"trial-{trial:05d}-fold-{fold:03d}", {"trial": trial, "fold": fold, "value": value})
            self.done[trial, fold] = value
        return self.done[trial, fold]


def ideal_value(evaluator: Evaluator) -> float | None:
    """The best a fold can reach; None if the metric has no bound."""
    metric = evaluator.getOrDefault("metricName")
    if evaluator.isLargerBetter():
        return 1.0 if metric in ("r2", "areaUnderROC", "areaUnderPR", "accuracy", "f1") else None
    return 0.0 if metric in ("mse", "rmse", "mae", "logLoss", "hammingLoss") else None


def value_of(evaluator: Evaluator, target: str, told: dict | None) -> float | None:
    """What the evaluator says of a model whose errors are known; None if it has to see the rows."""
    if told is None or not told["n"] or type(evaluator) is not RegressionEvaluator or evaluator.isDefined("weightCol") or evaluator.getThroughOrigin():
        return None
    if (evaluator.getLabelCol(), evaluator.getPredictionCol()) != (target, "prediction"):
        return None
    made = {"mse": lambda: told["mse"], "rmse": lambda: math.sqrt(told["mse"]), "mae": lambda: told["mae"], "r2": lambda: 1 - told["mse"] / told["var_y"] if told["var_y"] else None}
    return made.get(evaluator.getMetricName(), lambda: None)()


def race(trials: int, folds: int, run: Callable[[list[tuple[int, int]]], list[float]], larger: bool, ideal: float | None) -> dict[int, list[float]]:
    """Values of each trial's finished folds.  A trial stops once it cannot win: even with ideal values in its other folds its mean would be
    worse than that of a finished one.  Nothing is sampled or estimated, so the winner is that of the full search.

    First all trials run one fold, then the one that leads finishes, then the others go on fold by fold, ``run`` taking a whole step at once.
    """
    sign = -1.0 if larger else 1.0
    values: dict[int, list[float]] = {t: [] for t in range(trials)}

    def step(jobs: list[tuple[int, int]]) -> None:
        for (t, _), value in zip(jobs, run(jobs)):
            values[t].append(value)

    if folds > 1:
        step([(t, 0) for t in range(trials)])
        lead = min(range(trials), key=lambda t: sign * values[t][0])
        step([(lead, f) for f in range(1, folds)])
    for f in range(min(1, folds - 1), folds):
        best = min((sign * sum(v) for v in values.values() if len(v) == folds), default=math.inf)

        def may_win(v: list[float]) -> bool:
            return ideal is None or sign * (sum(v) + (folds - len(v)) * ideal) <= best

        jobs = [(t, f) for t, v in values.items() if len(v) == f and may_win(v)]
        if jobs:
            step(jobs)
    return values


def tune_generic(df: DataFrame, features: list[str], target: str, factory: Callable[[dict], Estimator],
                 space: dict, evaluator: Evaluator, order: list[str], trials: int = 10, folds: int = 5,
                 parallelism: int = 4, seed: int = 42, ledger: str | None = None, racing: bool = True) -> dict:
    """Random search over contiguous folds; the evaluator says whether larger is better, and the mean over folds decides, the first trial on ties.

    With ``racing`` (where the metric has a bound) a trial that cannot win any more stops; ``values`` has what each trial ran, ``folds_saved`` the
    fits that were not needed, ``held`` the binned rows.  ``ledger`` names a folder that keeps finished folds, and a search that starts again there goes on from them.
    Only the winner is fitted on all rows.
    """
    features = [c for c in features if c in df.columns]
    held, draws = Folds(df, features, target, order, folds), draw_params(space, trials, seed)
    study = {"space": space, "trials": trials, "folds": folds, "seed": seed, "features": features, "target": target, "order": order,
             "metric": evaluator.getOrDefault("metricName")}
    book = Ledger(df.sparkSession, ledger or fresh_dir(df.sparkSession, "trials"), study)

    def run(jobs: list[tuple[int, int]]) -> list[float]:
        new = [job for job in jobs if job not in book.done]

        def evaluate(k: int, model: Transformer, told: dict | None) -> float:
            known = value_of(evaluator, target, told)
            return book.run(*new[k], lambda _, fold: evaluator.evaluate(model.transform(held.test(fold))) if known is None else known)

        if new:
            held.each([(factory(draws[trial]), fold) for trial, fold in new], evaluate, parallelism)
        return [book.done[job] for job in jobs]

    values = race(trials, folds, run, evaluator.isLargerBetter(), ideal_value(evaluator) if racing else None)
    means = {t: sum(v) / folds for t, v in values.items() if len(v) == folds}
    winner = (max if evaluator.isLargerBetter() else min)(means, key=means.get)
    best = held.model(factory(draws[winner]))
    held.close()
    return {"best_params": draws[winner], "best_value": means[winner], "best_trial": winner, "best_model": best,
            "features": features, "held": held, "params": draws, "values": values, "means": means,
            "folds_saved": trials * folds - sum(map(len, values.values()))}


def tune_regressor(df: DataFrame, features: list[str], target: str, order: list[str], trials: int = 20,
                   folds: int = 5, space: dict | None = None, seed: int = 42, **more) -> dict:
    """Minimises the root of the mean squared error averaged over folds, which is ``best_value``."""
    evaluator = RegressionEvaluator(labelCol=target, metricName="mse")
    found = tune_generic(df, features, target, lambda p: boosted_regressor(p, target, seed), space or SEARCH_SPACE,
                         evaluator, order, trials, folds, seed=seed, **more)
    return found | {"best_value": math.sqrt(found["best_value"])}


def tuned_model(result: dict | None, target: str, seed: int = 42) -> Estimator:
    """Unfitted estimator with the best parameters."""
    if not result or not result.get("best_params"):
        raise ValueError("a tuned estimator needs the result of a search")
    return boosted_regressor(result["best_params"], target, seed)


# ---------------------------------------------------------------- scoring and persistence


def score_prices(df: DataFrame, competition: Competition | None = None) -> DataFrame:
    """Predicted price and the name of what produced it; without a model the heuristic answers."""
    if competition is None:
        return df.withColumns({"predicted_price": heuristic_price(), "model_used": F.lit("heuristic")})
    return (competition.predict(df).withColumn("predicted_price", F.round("prediction", 2))
            .withColumn("model_used", F.lit(competition.best)).drop("prediction"))


def save_model(model: PipelineModel, path: str) -> str:
    model.write().overwrite().save(path)
    return path


def load_model(path: str) -> PipelineModel:
    try:
        return PipelineModel.load(path)
    except Exception as error:
        raise FileNotFoundError(f"nothing loadable at {path}") from error
