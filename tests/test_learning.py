"""Invariants of fitted models and clusters."""

import random
from multiprocessing.pool import ThreadPool

import pytest
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor
from pyspark.sql import functions as F

from stockyard.operators import sampling
from stockyard.operators import supervised as M
from stockyard.plans import views
from stockyard.plans.stages import Inputs, Run, Settings
from stockyard.schema import MODEL_FEATURES, TARGET
from stockyard.sources.records import Records
from stockyard.workspace import fresh_dir, materialize


SMALL = {"trees": 3, "depth": 3, "rate": 0.3}
TX, COLUMNS, ORDER = "transaction_id", MODEL_FEATURES, ["ts", "transaction_id"]


@pytest.fixture(scope="module")
def rows(spark, sf):
    return materialize(views.tx_features(spark, sf).select(TX, "ts", "region", "is_fraud", TARGET, *MODEL_FEATURES), "rows")


def test_price_competition(spark, rows):
    got = M.train_regressors(rows, TX, COLUMNS, TARGET, ORDER, M.regressors(**SMALL), folds=2)
    metrics = got.metrics.collect()
    best = min(metrics, key=lambda r: (r["rmse"], r["ord"]))
    assert len(metrics) == 3 and got.best == best["model"] and best["r2"] > 0.5
    assert all(r["cv_rmse_mean"] > 0 for r in metrics)
    assert M.score_prices(rows, got).where(F.col("model_used") == got.best).count() == 6000
    assert {r["region"] for r in got.forecast_regions(rows.drop("region")).select("region").distinct().collect()} == {"ALL"}


def test_fraud_competition(spark, rows):
    resample = lambda t: sampling.smote(t, TX, COLUMNS, "is_fraud").drop("origin")
    for train_rows in (None, resample):
        got = M.train_classifiers(rows, TX, COLUMNS, "is_fraud", estimators=M.classifiers(**SMALL), train_rows=train_rows).metrics.collect()
        assert len(got) == 3 and all(0 <= r["roc_auc"] <= 1 and 0 < r["f1"] <= 1 for r in got)


SPACE = {"trees": ("int", 1, 4), "depth": ("int", 1, 4), "rate": ("log", 0.05, 0.5), "subsample": ("float", 0.8, 1.0), "features": ("float", 0.8, 1.0)}


def test_folds_share_one_binned_table(spark, rows):
    held = M.Folds(rows, COLUMNS, TARGET, ORDER, 5)
    want = {r["fold"]: r["count"] for r in sampling.assign_folds(rows, ORDER).groupBy("fold").count().collect()}
    assert {r["fold"]: r["count"] for r in held.rows.groupBy("fold").count().collect()} == want
    assert all(held.test(f).count() == want[f] and held.train(f).count() == 6000 - want[f] for f in range(5))
    assert max(x for r in held.rows.collect() for x in r["features"]) < M.BINS
    results = M.fold_results(rows, COLUMNS, TARGET, ORDER, {"mean": DecisionTreeRegressor(maxDepth=0), "tree": DecisionTreeRegressor(maxDepth=4)}, 5).collect()
    y = {f: [r[TARGET] for r in held.test(f).collect()] for f in range(5)}
    for r in results:
        rest = [v for f in range(5) if f != r["fold"] for v in y[f]]
        mean = sum(rest) / len(rest)
        if r["model"] == "mean":  # knows the other folds' mean and nothing else
            assert r["mse"] == pytest.approx(sum((v - mean) ** 2 for v in y[r["fold"]]) / r["n"], rel=1e-9)
        else:
            assert 0 < r["mse"] < r["var_y"]


def test_many_rows_are_fitted_by_fewer_fits_at_a_time(spark, rows, monkeypatch):
    held = M.Folds(rows, COLUMNS, TARGET, ORDER, 2)
    assert held.at_a_time(5) == 5
    values = {}
    for most, fits in ((12_000, 2), (100, 1)):
        monkeypatch.setattr(M, "ROWS_IN_FITS", most)
        assert held.at_a_time(5) == fits
        found = M.tune_generic(rows, COLUMNS, TARGET, lambda p: DecisionTreeRegressor(labelCol=TARGET, maxDepth=p["depth"]),
                               {"depth": ("int", 1, 4)}, M.RegressionEvaluator(labelCol=TARGET), ORDER, 3, 2)
        values[fits] = found["values"]
    assert values[1] == values[2]


def test_tuning_minimises_the_root_of_the_mean_error(spark, rows):
    got = M.tune_regressor(rows, COLUMNS, TARGET, ORDER, trials=2, folds=2, space=SPACE)
    assert len(got["values"]) == 2 and got["best_value"] ** 2 == pytest.approx(min(got["means"].values()))
    params = got["best_params"]
    errors = M.cross_validate(rows, COLUMNS, TARGET, ORDER, {"one": M.boosted_regressor(params, TARGET)}, folds=2).head()
    assert errors["cv_rmse_mean"] == pytest.approx(got["best_value"], rel=1e-6)
    assert got["best_model"].transform(M.fill_zero(rows, COLUMNS)).where("prediction IS NOT NULL").count() == 6000
    assert isinstance(M.tuned_model(got, TARGET), GBTRegressor)


def test_racing_finds_the_winner_of_the_full_search(spark, rows, tmp_path):
    """Ten trials of five folds; a search that is killed after some folds goes on from its ledger and repeats none."""
    path, fits, most = str(tmp_path / "ledger"), [], [13]
    search = lambda **more: M.tune_regressor(rows, COLUMNS, TARGET, ORDER, 10, 5, SPACE, parallelism=4, **more)
    real = M.RegressionEvaluator.evaluate

    def counted(evaluator, df, *a):
        if len(fits) >= most[0]:
            raise RuntimeError("killed")
        value = real(evaluator, df, *a)
        fits.append(value)
        return value

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(M.RegressionEvaluator, "evaluate", counted)
        with pytest.raises(RuntimeError):
            search(ledger=path)
        finished = len([n for n in M.Records(spark, path, M.LEDGER).names() if n != "study"])
        before, most[0] = len(fits), 1000
        assert 10 <= finished == before
        raced = search(ledger=path)
        assert len(fits) == 50 - raced["folds_saved"]  # the finished ones were not fitted again
    whole = search(racing=False)
    assert whole["folds_saved"] == 0 and raced["folds_saved"] > 0
    assert (raced["best_trial"], raced["best_params"], raced["best_value"]) == (whole["best_trial"], whole["best_params"], whole["best_value"])
    assert all(v == whole["values"][t][:len(v)] for t, v in raced["values"].items())
    with pytest.raises(ValueError):
        M.tune_regressor(rows, COLUMNS, TARGET, ORDER, 9, 5, SPACE, ledger=path)


@pytest.mark.parametrize("larger", [False, True])
def test_race_against_brute_force(larger):
    rng = random.Random(larger)
    for _ in range(300):
        trials, folds = rng.randrange(1, 9), rng.randrange(1, 6)
        table = [[rng.choice([rng.random(), round(rng.random(), 1)]) for _ in range(folds)] for _ in range(trials)]
        values = M.race(trials, folds, lambda jobs: [table[t][f] for t, f in jobs], larger, 1.0 if larger else 0.0)
        done = {t: sum(v) / folds for t, v in values.items() if len(v) == folds}
        pick = max if larger else min
        means = [sum(v) / folds for v in table]
        assert pick(done, key=done.get) == means.index(pick(means)) and all(v == table[t][:len(v)] for t, v in values.items())
        assert all(len(v) == folds for v in M.race(trials, folds, lambda jobs: [table[t][f] for t, f in jobs], larger, None).values())


def test_generic_search_follows_the_metric(spark, rows):
    tree = lambda p: DecisionTreeRegressor(labelCol=TARGET, maxDepth=p["depth"])
    for metric, pick in (("mae", min), ("r2", max), ("var", max)):
        found = M.tune_generic(rows, COLUMNS, TARGET, tree, {"depth": ("int", 0, 6)}, M.RegressionEvaluator(labelCol=TARGET, metricName=metric), ORDER, 4, 3)
        assert found["best_value"] == pick(found["means"].values())
        assert M.ideal_value(M.RegressionEvaluator(metricName=metric)) == {"mae": 0.0, "r2": 1.0, "var": None}[metric]


def test_records(spark, tmp_path):
    records = Records(spark, str(tmp_path / "r"), "n int, t string")
    assert records.names() == [] and records.read().count() == 0
    with ThreadPool(8) as pool:  # one name, many writers: one wins
        assert sum(pool.map(lambda i: records.create("a", {"n": i, "t": "x"}), range(8))) == 1
    assert records.create("b", {"n": 10, "t": "ü\n"}, {"n": 11}) and not records.create("b", {"n": 0})
    records.replace("b", {"n": 12, "t": None})
    assert records.names() == ["a", "b"] and [tuple(r) for r in records.read(["b"]).collect()] == [(12, None)]
    records.remove("a")
    assert records.names() == ["b"] and not [p for p in (tmp_path / "r").iterdir() if p.name.startswith("_")]


def test_errors_for_missing_models(tmp_path):
    with pytest.raises(ValueError):
        M.Competition([], {}, None, None).model("x")
    with pytest.raises(ValueError):
        M.tuned_model({}, "y")
    with pytest.raises(FileNotFoundError):
        M.load_model(str(tmp_path / "none"))


def test_draws_are_seeded_and_inside_the_space():
    a, b = (M.draw_params(M.SEARCH_SPACE, 20, 7) for _ in range(2))
    assert a == b and all(50 <= p["trees"] <= 300 and 0.01 <= p["rate"] <= 0.3 for p in a)


def test_whole_run_and_recorded_failure(spark, sf):
    space = {"trees": ("int", 2, 3), "depth": ("int", 2, 3), "rate": ("log", 0.1, 0.3), "subsample": ("float", 0.8, 1.0), "features": ("float", 0.8, 1.0)}
    inputs = Inputs(views.tx(spark, sf), views.warehouses(spark, sf), views.img(spark, sf), views.det(spark, sf), views.frames(spark, sf))
    settings = Settings(folds=2, trials=1, space=space, **SMALL)
    report = Run(spark, inputs, fresh_dir(spark, "run"), settings).run_all().collect()
    value = {(r["stage"], r["key"]): r["value"] for r in report}
    assert value["RUN", "status"] == "success", value["RUN", "error"]
    assert value["DATA INGESTION", "transactions"] == "6000" and value["FEATURE ENGINEERING", "enriched features"] == "34"
    assert "Features drifted" in value["MLOPS", "drift report"]
    empty = spark.range(1)
    failed = Run(spark, Inputs(empty, empty, empty, empty, empty), fresh_dir(spark, "run")).run_all().collect()
    assert {(r["key"], r["value"]) for r in failed if r["key"] == "status"} == {("status", "failed in ingest")}
