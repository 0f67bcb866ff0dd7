"""Ordering, metrics, drift and neighbours against brute force."""

import functools
import math
import random
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stockyard.functions import scalars
from stockyard.functions.scalars import hash_int, keyed
from stockyard.operators import cluster, commerce, drift, features, metrics, neighbors, ordering, sampling
from stockyard.plans import views
from stockyard.schema import MODEL_FEATURES

FEW = settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def test_row_numbers_follow_the_whole_key_even_when_one_value_is_hot(spark):
    rows = [(1 if i % 3 else 0, i) for i in range(2000)]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, "a int, b int").repartition(7)
    got = ordering.number_rows(df, ["a", "b"], "n", total="t").collect()
    assert [(r["a"], r["b"]) for r in sorted(got, key=lambda r: r["n"])] == sorted(rows)
    assert sorted(r["n"] for r in got) == list(range(2000)) and {r["t"] for r in got} == {2000}


def test_rank_within_groups(spark):
    df = spark.createDataFrame([(g, v) for g in "abc" for v in range({"a": 1, "b": 50, "c": 7}[g])], "g string, v int")
    got = ordering.rank_within(df, ["g"], ["v"], "r", "size").collect()
    assert all(r["r"] == r["v"] for r in got)
    assert {(r["g"], r["size"]) for r in got} == {("a", 1), ("b", 50), ("c", 7)}


@FEW
@given(st.lists(st.integers(-5, 5), min_size=1, max_size=40))
def test_quantiles_match_numpy(spark, values):
    df = spark.createDataFrame([("x", float(v)) for v in values], "g string, v double")
    row = ordering.exact_quantiles(df, ["g"], "v", {"q1": .25, "q2": .5, "q3": .75}).head()
    assert [row["q1"], row["q2"], row["q3"]] == pytest.approx(np.quantile(values, [.25, .5, .75]).tolist())


def test_regression_metrics_on_known_pairs(spark):
    df = spark.createDataFrame(list(zip([1., 2., 3., 4., 5.], [1.1, 2.1, 2.9, 4.2, 4.8])), "y_true double, y_hat double")
    row = metrics.regression_metrics(df).head()
    assert row["r2"] == pytest.approx(0.989) and row["mae"] == pytest.approx(0.14)
    assert row["rmse"] == pytest.approx(0.148324, abs=1e-6)
    flat = spark.createDataFrame([(2.0, 2.0), (2.0, 3.0)], "y_true double, y_hat double")
    assert metrics.regression_metrics(flat).head()["r2"] == 0.0


@FEW
@given(st.lists(st.tuples(st.integers(0, 1), st.integers(0, 6)), min_size=4, max_size=40))
def test_auc_counts_pairs_and_turns_around(spark, rows):
    df = spark.createDataFrame([(a, float(s)) for a, s in rows], "label int, prob double")
    pos, neg = [s for a, s in rows if a], [s for a, s in rows if not a]
    auc = metrics.roc_auc(df).head()["roc_auc"]
    if not pos or not neg:
        assert auc is None
        return
    wins = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg)
    assert auc == pytest.approx(wins / len(pos) / len(neg))
    back = metrics.roc_auc(df.withColumn("prob", -F.col("prob"))).head()["roc_auc"]
    assert back == pytest.approx(1 - auc)


@FEW
@given(st.lists(st.integers(0, 9), min_size=1, max_size=30), st.lists(st.integers(0, 9), min_size=1, max_size=30))
def test_ks_is_the_largest_gap_and_symmetric(spark, a, b):
    def frame(values):
        return spark.createDataFrame([(float(v),) for v in values], "x double")

    gap = max(abs(np.mean(np.array(a) <= v) - np.mean(np.array(b) <= v)) for v in range(10))
    one, two = (drift.prediction_drift(frame(p), frame(q), "x").head() for p, q in ((a, b), (b, a)))
    assert one["ks_statistic"] == pytest.approx(gap) and two["ks_statistic"] == pytest.approx(gap)
    assert 0 <= one["ks_pvalue"] <= 1


def test_classification_metrics_with_an_unpredicted_class(spark):
    df = spark.createDataFrame([(0, 0)] * 9 + [(1, 0)], "label int, pred int")
    row = metrics.classification_metrics(df).head()
    assert row["accuracy"] == pytest.approx(0.9) and row["f1"] == pytest.approx(0.9 * 18 / 19)


def test_anomaly_rule_uses_one_for_a_null_deviation(spark):
    one = spark.createDataFrame([("a", 5.0)], "transaction_id string, price_usd double")
    assert commerce.price_anomalies(one).head()["is_price_anomaly"] == 0


def test_first_listed_model_wins_a_tie(spark):
    df = spark.createDataFrame([("b", 1.0, 2), ("a", 1.0, 1), ("c", 3.0, 0)], "model string, rmse double, ord int")
    assert metrics.best_model(df).head()["best_model"] == "a"


@pytest.mark.parametrize("n,k", [(10, 5), (13, 5), (7, 3), (3, 5)])
def test_folds_are_contiguous_and_the_first_are_larger(spark, n, k):
    got = sampling.assign_folds(spark.range(n), ["id"], k).orderBy("id").collect()
    expect = [f for f in range(k) for _ in range(n // k + (f < n % k))]
    assert [r["fold"] for r in got] == expect


def test_head_tail_split(spark):
    got = sampling.split_head_tail(spark.range(11), ["id"]).orderBy("id").collect()
    assert [r["part"] for r in got] == ["head"] * 8 + ["tail"] * 3


def test_category_codes(spark):
    df = spark.createDataFrame([("b",), (None,), ("a",), ("c",), ("b",)], "c string").withColumn("d", F.lit("x"))
    got = features.encode_categories(df, {"c": "code", "d": "other"}).collect()
    assert {(r["c"], r["code"]) for r in got} == {("a", 0), ("b", 1), ("c", 2), (None, -1)} and len(got) == 5
    assert all(r["other"] == 0 for r in got)


def brute_neighbors(points, k):
    out = {}
    for i, a in points:
        gaps = sorted((round(math.dist(a, b), 6), j) for j, b in points if j != i)
        out[i] = [j for _, j in gaps[:k]]
    return out


@pytest.mark.parametrize("kind", ["spread", "clumped", "copies", "flat", "wide", "wide clumps"])
def test_neighbors_equal_brute_force(spark, kind, monkeypatch):
    monkeypatch.setattr(neighbors, "FANOUT", 3)
    monkeypatch.setattr(neighbors, "BOXES_PER_TASK", 4)
    rng = np.random.default_rng(5)
    n = 240
    if kind == "spread":
        xs = rng.normal(size=(n, 3)) * [1, 10, 100]
    elif kind == "clumped":
        xs = np.concatenate([rng.normal(size=(n // 2, 3)) * 0.01, rng.normal(size=(n // 2, 3)) * 50])
    elif kind == "copies":  # two fifths of all rows are one vector
        xs = np.round(rng.normal(size=(n, 3)) * 2)
        xs[: 2 * n // 5] = 0
    elif kind == "wide":
        xs = rng.normal(size=(n, 64))
    elif kind == "wide clumps":
        xs = np.concatenate([rng.normal(size=(1, 64)) * 5 + rng.normal(size=(n // 8, 64)) * 0.1 for _ in range(8)])
    else:
        xs = np.ones((n, 3))
    points = [(f"p{i:03d}", [float(v) for v in x]) for i, x in enumerate(xs)]
    df = spark.createDataFrame(points, "id string, vec array<double>")
    got = {r["id"]: [x["id"] for x in r["neighbors"]] for r in neighbors.k_nearest(df, 5, tile_rows=16).collect()}
    assert got == brute_neighbors(points, 5)
    if kind == "wide clumps":  # a point sees the tiles of its own clump and the edges between clumps
        assert neighbors.Tiles(df, 6, 16).visits.count() < 0.4 * n * (n // 16)


def test_neighbors_visit_few_tiles_as_rows_grow(spark):
    """Seven axes matter, 16 and 125 tiles."""
    rng, k = np.random.default_rng(3), 6
    wide = [100, 53, 49, 19, 5, 6, 4]
    visits = []
    for n in (2000, 16000):
        xs = np.round(rng.random((n, 7)) ** 2 * wide, 2)
        df = spark.createDataFrame([(f"p{i:05d}", [float(v) for v in x]) for i, x in enumerate(xs)], "id string, vec array<double>")
        plan = neighbors.Tiles(df, k, 128)
        visits.append(plan.visits.count() / n)
        sizes = [r["count"] for r in plan.tiled.groupBy("tile").count().collect()]
        assert sum(sizes) == n and max(sizes) <= 128
    assert visits[1] < 8, visits  # 5.1; nearest pivots with shells around them gave 12.3


def test_cells_are_halves_of_halves():
    rng = np.random.default_rng(4)
    xs = np.concatenate([rng.random((512, 2)) * [1, 8], np.ones((64, 2))])
    axis, edge = neighbors.halve(xs, 5)
    cells = neighbors.cell_of(xs, axis, edge, 5)
    assert axis[0] == 1 and cells.min() >= 0 and cells.max() < 32
    # equal rows are not parted; without them cells are about equal
    assert len(set(cells[512:])) == 1 and np.bincount(cells[:512], minlength=32).max() <= 32
    assert (neighbors.cell_of(np.zeros((3, 2)), *neighbors.halve(np.zeros((3, 2)), 2), 2) == 0).all()


def test_rows_for_resampling_are_joined_once(spark, sf):
    columns = ["transaction_id", "is_defect", *MODEL_FEATURES]
    once, plain = views.tx_features(spark, sf, "is_defect"), views.tx_features(spark, sf)
    assert not [f for f in once.inputFiles() if "lineitem" in f or "orders" in f]
    assert sorted(map(tuple, once.select(*columns).collect())) == sorted(map(tuple, plain.select(*columns).collect()))


def test_neighbors_of_nothing(spark):
    assert neighbors.k_nearest(spark.createDataFrame([], "id string, vec array<double>")).count() == 0
    assert neighbors.k_nearest(spark.createDataFrame([("a", [1.0])], "id string, vec array<double>")).head()["neighbors"] == []


def test_smote_sizes_and_segments(spark):
    rows = [(f"k{i}", float(i % 7), float(i), 1 if i < 20 else 0) for i in range(200)]
    df = spark.createDataFrame(rows, "key string, a double, b double, y int")
    out = sampling.smote(df, "key", ["a", "b"], "y", ratio=0.3)
    counts = {r["label"]: r["n"] for r in commerce.class_distribution(out, "y").collect()}
    assert counts == {0: 180, 1: sampling.smote_target(180, 20, 0.3)} and counts[1] == 66
    made = out.where("origin = 'synthetic'").collect()
    assert len({r["key"] for r in made}) == 46 and all(0 <= r["a"] <= 6 and 0 <= r["b"] <= 19 for r in made)
    few = sampling.smote(df.where("y = 0 OR b < 5"), "key", ["a", "b"], "y")
    assert few.where("origin = 'synthetic'").count() == 0
    with pytest.raises(ValueError):
        sampling.smote(df, "key", ["a", "b"], "y", ratio=1.5)


def _paths(n, m, h):
    """Share of the lattice paths that reach |i m - j n| >= h, by counting them."""
    @functools.cache
    def inside(i, j):
        if abs(i * m - j * n) >= h:
            return 0
        return 1 if i == j == 0 else (inside(i - 1, j) if i else 0) + (inside(i, j - 1) if j else 0)

    return 1 - Fraction(inside(n, m), math.comb(n + m, n))


@pytest.mark.parametrize("n,m", [(1, 1), (1, 9), (7, 7), (12, 18), (13, 8), (30, 29), (40, 10)])
def test_exact_ks_tail_counts_paths(n, m):
    unit = math.gcd(n, m)
    for h in range(0, n * m + 1, max(unit, n * m // 12 // unit * unit)):
        assert metrics.ks_tail(h / (n * m), n, m) == pytest.approx(float(_paths(n, m, h)), abs=1e-12)
    assert metrics.ks_tail(0.0, n, m) == 1.0


def test_known_ks_tails():
    """Values of published tables and closed forms."""
    assert metrics.ks_tail(1.0, 5, 5) == pytest.approx(2 / math.comb(10, 5), abs=1e-15)
    # equal samples: alternating sum of binomials
    for n, h in ((2000, 70), (9999, 200)):
        want, k = 0.0, n // h
        logs = math.lgamma(2 * n + 1)
        for j in range(k, 0, -1):
            want += (-1) ** (j - 1) * 2 * math.exp(2 * math.lgamma(n + 1) - math.lgamma(n - j * h + 1) - math.lgamma(n + j * h + 1))
        assert logs > 0 and metrics.ks_tail(h / n, n, n) == pytest.approx(want, abs=1e-9)


def test_limits_meet_the_exact_distribution():
    for n in (50, 300):
        for z in (0.45, 0.7, 1.1, 1.9):
            exact = metrics._durbin_cdf(n, z / math.sqrt(n))
            assert metrics._limit_cdf(n, z / math.sqrt(n)) == pytest.approx(exact, abs=0.2 / n ** 2)
    assert metrics._durbin_cdf(1, 0.75) == pytest.approx(0.5) and metrics._durbin_cdf(10, 0.274) == pytest.approx(0.6284796154565, abs=1e-9)
    # both sides of the limit of exact counting agree as far as an effective size allows
    below, above = metrics.ks_tail(0.02, 10_000, 10_000), metrics.ks_tail(0.02, 10_001, 10_001)
    assert abs(below - above) < 2e-3 and metrics.ks_tail(0.3, 20_000, 20_000) == 0.0 and metrics.ks_tail(1e-5, 20_000, 30_000) == 1.0


def test_grouped_drift(spark):
    rng = random.Random(5)
    rows = [(rng.choice([None, "a", "b", "lonely"]), float(rng.randrange(6)), rng.randrange(2)) for _ in range(120)]
    rows = [(g, v, 0 if g == "lonely" else c) for g, v, c in rows] + [("a", None, 1)]
    got = drift.grouped_drift(spark.createDataFrame(rows, "g string, v double, c int"), "v", "c", ["g"]).collect()
    assert {r["g"] for r in got} == {None, "a", "b"}
    for r in got:
        x, y = ([v for g, v, c in rows if g == r["g"] and c == k and v is not None] for k in (0, 1))
        d = max(abs(sum(v <= t for v in x) / len(x) - sum(v <= t for v in y) / len(y)) for t in range(6))
        assert (r["n_ref"], r["n_cur"]) == (len(x), len(y)) and r["ks_statistic"] == pytest.approx(d)
        assert r["ks_pvalue"] == pytest.approx(float(_paths(len(x), len(y), round(d * len(x) * len(y)))), abs=1e-12)


def test_nearest_centre_rounds_only_ties(spark):
    """Distances are plain expressions (no function over arrays), and rounded ones still decide ties, nulls and gaps below a billionth."""
    centers = [[0.0, 0.0], [2.0, 0.0], [0.0, 2.0], [2.0, 2e-11]]
    points = [(1.0, 0.0), (1.0, 1.0), (1.0 + 2e-10, 0.0), (1.0 + 2e-8, 0.0), (0.0, 2.0), (2.0, 1e-11), (1e8, 1e8), (None, 1.0), (None, None), (float("nan"), 0.0)]
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(points)], "i int, a double, b double")
    near = cluster._nearest(df, ["a", "b"], centers, "c")
    vec = F.array("a", "b")
    gaps = [F.struct(F.round(scalars.distance(vec, F.array(*map(F.lit, c))), 9).alias("d"), F.lit(n).alias("cluster")) for n, c in enumerate(centers)]
    want = df.select("i", F.array_min(F.array(*gaps))["cluster"].alias("c"))
    assert sorted(map(tuple, near.select("i", "c").collect())) == sorted(map(tuple, want.collect()))
    assert "zip_with" not in near._jdf.queryExecution().toString() and near.columns == ["i", "a", "b", "c"]


def test_split_sums_are_the_decimal_ones(spark):
    values = [0.1, -0.1, 1e-12, -3e-12, 123456789.123456, -99999.999999999, 7e17, None, 0.0, 2.5e-13]
    df = spark.createDataFrame([(i % 2, v) for i, v in enumerate(values * 50)], "g int, x double")
    whole, behind = scalars.split_places("x", 12)
    fast = df.select("g", whole.alias("w"), behind.alias("p")).groupBy("g").agg(scalars.exact_avg((F.col("w"), F.col("p")), 12).alias("m"))
    assert sorted(map(tuple, fast.collect())) == sorted(map(tuple, df.groupBy("g").agg(scalars.exact_avg("x", 12)).collect()))


@pytest.mark.parametrize("most", [1, 3, 50])
def test_lloyd_follows_its_steps(spark, most, monkeypatch):
    rng = np.random.default_rng(7)
    x = np.concatenate([rng.normal(c, 0.6, (40, 2)) for c in ((0, 0), (3, 3), (0, 4))]).round(3)
    df = spark.createDataFrame([(f"k{i}", *map(float, v)) for i, v in enumerate(x)], "key string, a double, b double")
    seeds = [r["key"] for r in df.orderBy(hash_int(keyed("key", 42)), "key").limit(4).collect()]
    centers, labels, steps = [x[int(s[1:])] for s in seeds], np.zeros(len(x), int), 0
    for _ in range(most):
        new = np.array([min(range(4), key=lambda c: (round(math.dist(v, centers[c]), 9), c)) for v in x])
        if (new == labels).all():
            break
        labels, steps = new, steps + 1
        for c in range(4):
            if (labels == c).any():
                centers[c] = x[labels == c].mean(axis=0)
    passes, average = [], cluster.exact_avg
    monkeypatch.setattr(cluster, "exact_avg", lambda c, d: passes.append(c) or average(c, d))
    got = {r["key"]: r["cluster"] for r in cluster.lloyd(df, ["a", "b"], "key", 4, most).collect()}
    assert got == {f"k{i}": int(v) for i, v in enumerate(labels)}
    # it stopped when labels repeated: one pass more than labellings that changed something
    assert len(passes) // 2 == min(most, steps + 1) and (most < 50 or steps < 49)
    # equal points, fewer rows than clusters, none at all
    assert {r["cluster"] for r in cluster.lloyd(df.withColumns({"a": F.lit(1.0), "b": F.lit(1.0)}), ["a", "b"], "key").collect()} == {0}
    assert cluster.lloyd(df.limit(2), ["a", "b"], k=4).count() == 2 and cluster.lloyd(df.limit(0), ["a", "b"]).count() == 0
