"""Queries on metrics, drift, sampling, clustering and model tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockyard.functions.scalars import distance
from stockyard.operators import cluster, drift, metrics, neighbors, sampling, tracking
from stockyard.plans import views
from stockyard.plans.registry import h, ks_p, query, rounded, u
from stockyard.schema import MODEL_FEATURES, NUMERIC_COLUMNS
from stockyard.workspace import fresh_dir, materialize

TX = "transaction_id"
DRIFT_COLUMNS = ["quantity", "price_usd", "shipping_days", "market_index"]


# ---------------------------------------------------------------- model quality


def _model_rows(spark, sf) -> DataFrame:
    """Predictions of three simple models side by side."""
    scored = views.scored(spark, sf)
    means = scored.groupBy("category").agg(F.avg("y_true").alias("y_mean"))
    wide = scored.join(means, "category")
    return wide.select("y_true", F.explode(F.array(*[
        F.struct(F.lit(n).alias("model"), F.lit(i).alias("ord"), F.col(c).alias("y_hat"))
        for i, (n, c) in enumerate((("heuristic", "y_hat"), ("flat_index", "y_flat"), ("category_mean", "y_mean")), 1)
    ])).alias("m")).select("y_true", "m.*")


def _model_metrics(spark, sf) -> DataFrame:
    return metrics.regression_metrics(_model_rows(spark, sf), by=["model", "ord"])


@query("SELECT round(rmse, 4) AS rmse, round(mae, 4) AS mae, round(r2, 6) AS r2 FROM model_metrics WHERE model = 'heuristic'")
def regression_metrics(spark, sf):
    return rounded(metrics.regression_metrics(views.scored(spark, sf)), rmse=4, mae=4, r2=6)


@query("""WITH c AS (SELECT label, pred, count(*) AS n FROM scored GROUP BY 1, 2),
  k AS (SELECT k, sum(CASE WHEN label = k THEN n ELSE 0 END) AS s, sum(CASE WHEN pred = k THEN n ELSE 0 END) AS q,
               sum(CASE WHEN label = k AND pred = k THEN n ELSE 0 END) AS t
        FROM c, (SELECT label AS k FROM c UNION SELECT pred FROM c) ks GROUP BY k)
  SELECT round(sum(t) / sum(s)::double, 9) AS accuracy, round(sum(s * (2 * t / (s + q)::double)) / sum(s)::double, 9) AS f1 FROM k""")
def classification_metrics(spark, sf):
    return rounded(metrics.classification_metrics(views.scored(spark, sf)), accuracy=9, f1=9)


@query("""WITH r AS (SELECT label, (rank() OVER (ORDER BY prob) + rank() OVER (ORDER BY prob) + count(*) OVER (PARTITION BY prob) - 1) / 2.0::double AS rk FROM scored)
  SELECT round((sum(rk) FILTER (label = 1) - count(*) FILTER (label = 1) * (count(*) FILTER (label = 1) + 1) / 2.0::double)
         / (count(*) FILTER (label = 1)::double * count(*) FILTER (label = 0)), 9) AS roc_auc FROM r""")
def roc_auc(spark, sf):
    return rounded(metrics.roc_auc(views.scored(spark, sf)), roc_auc=9)


@query("""WITH f AS (SELECT ntile(5) OVER (ORDER BY ts, transaction_id) AS fold, y_true, y_hat FROM scored),
  e AS (SELECT fold, avg((y_true - y_hat) * (y_true - y_hat)) AS mse FROM f GROUP BY fold)
  SELECT round(sqrt(avg(mse)), 4) AS cv_rmse_mean, round(sqrt(stddev_pop(mse)), 4) AS cv_rmse_std FROM e""")
def cv_summary(spark, sf):
    rows = sampling.assign_folds(views.scored(spark, sf).select(TX, "ts", "y_true", "y_hat"), ["ts", TX])
    return rounded(metrics.cv_summary(metrics.fold_errors(rows)), cv_rmse_mean=4, cv_rmse_std=4)


@query("SELECT model AS best_model, round(rmse, 4) AS best_score FROM model_metrics ORDER BY rmse, ord LIMIT 1")
def best_model(spark, sf):
    return rounded(metrics.best_model(_model_metrics(spark, sf)), best_score=4)


@query("""SELECT model, 'rmse' AS metric, round(rmse, 4) AS value FROM model_metrics
  UNION ALL SELECT model, 'mae', round(mae, 4) FROM model_metrics UNION ALL SELECT model, 'r2', round(r2, 4) FROM model_metrics""")
def model_comparison(spark, sf):
    return rounded(tracking.model_comparison(_model_metrics(spark, sf), ["rmse", "mae", "r2"]), value=4)


@query("SELECT model, round(rmse, 4) AS rmse, model = (SELECT min_by(model, rmse) FROM model_metrics) AS is_best FROM model_metrics")
def chart_rmse(spark, sf):
    return rounded(tracking.chart_rmse(_model_metrics(spark, sf)), rmse=4)


@query("""WITH c AS (SELECT model, label, CASE WHEN prob >= cut THEN 1 ELSE 0 END AS pred FROM scored,
    (VALUES ('cut_40', 0.4::double), ('cut_60', 0.6::double), ('cut_80', 0.8::double)) v(model, cut)),
  k AS (SELECT model, k, sum(CASE WHEN label = k THEN 1 ELSE 0 END) AS s, sum(CASE WHEN pred = k THEN 1 ELSE 0 END) AS q,
               sum(CASE WHEN label = k AND pred = k THEN 1 ELSE 0 END) AS t FROM c, (VALUES (0), (1)) ks(k) GROUP BY 1, 2)
  SELECT model, round(sum(s * (2 * t / (s + q)::double)) / sum(s)::double, 9) AS f1 FROM k GROUP BY model""")
def chart_f1(spark, sf):
    cuts = F.explode(F.array(*[F.struct(F.lit(n).alias("model"), F.lit(c).alias("cut"))
                               for n, c in (("cut_40", 0.4), ("cut_60", 0.6), ("cut_80", 0.8))]))
    rows = views.scored(spark, sf).select("label", "prob", cuts.alias("m")).select(
        "m.model", "label", F.when(F.col("prob") >= F.col("m.cut"), 1).otherwise(0).alias("pred"))
    return rounded(metrics.classification_metrics(rows, by=["model"]).select("model", "f1"), f1=9)


@query("""SELECT r.run_name AS run_name, metric, value, 3 AS step, features FROM (
    SELECT 'rmse' AS metric, round(rmse, 4) AS value FROM model_metrics WHERE model = 'heuristic'
    UNION ALL SELECT 'mae', round(mae, 4) FROM model_metrics WHERE model = 'heuristic') m,
  (SELECT 'register_price' AS run_name, '3' AS features) r""")
def run_log(spark, sf):
    log = tracking.RunLog(spark, fresh_dir(spark, "runs"))
    log.start("run-1", "register_price")
    log.log_params("run-1", {"features": 3})
    wide = _model_metrics(spark, sf).where("model = 'heuristic'")
    long = tracking.model_comparison(wide, ["rmse", "mae"])
    log.log_metrics("run-1", rounded(long, value=4), step=3)
    params = log.table("params").where("param = 'features'").select("run_id", F.col("value").alias("features"))
    return (log.table("metrics").join(log.table("runs"), "run_id").join(params, "run_id")
            .select("run_name", "metric", "value", "step", "features"))


# ---------------------------------------------------------------- drift


def _pairs(spark, sf) -> dict[str, tuple[DataFrame, DataFrame]]:
    tx = materialize(views.tx(spark, sf).select(TX, "ts", "is_fraud", *DRIFT_COLUMNS), "drift-input")
    parts = sampling.split_head_tail(tx, ["ts", TX])
    return {"time": (parts.where("part = 'head'"), parts.where("part = 'tail'")),
            "label": (tx.where("is_fraud = 0"), tx.where("is_fraud = 1"))}


def _drift(spark, sf) -> DataFrame:
    return drift.feature_drifts(_pairs(spark, sf), DRIFT_COLUMNS)


def _profile(c):
    return (f"SELECT '{c}' AS feature, round(avg({c}), 3) AS mean, round(stddev_samp({c}), 4) AS std, "
            f"cast(min({c}) AS double) AS min, cast(max({c}) AS double) AS max FROM tx")


@query(" UNION ALL ".join(_profile(c) for c in DRIFT_COLUMNS))
def reference_profile(spark, sf):
    profile = drift.reference_profile(views.tx(spark, sf), DRIFT_COLUMNS)
    return rounded(profile, mean=3, std=4)


@query("SELECT pair, feature, round(d, 9) AS ks_statistic FROM ks")
def ks_statistic(spark, sf):
    return rounded(_drift(spark, sf).select("pair", "feature", "ks_statistic"), ks_statistic=9)


@query("SELECT pair, feature, round(p, 9) AS ks_pvalue FROM ks_p")
def ks_pvalue(spark, sf):
    return rounded(_drift(spark, sf).select("pair", "feature", "ks_pvalue"), ks_pvalue=9)


@query(f"""WITH c AS (SELECT region, cast(date_trunc('week', ts) AS date) AS week, price_usd AS value, count(*) FILTER (shipping_days <= 10) AS a,
    count(*) FILTER (shipping_days > 10) AS b FROM tx GROUP BY 1, 2, 3),
  x AS (SELECT region, week, sum(a) OVER w AS ca, sum(b) OVER w AS cb, sum(a) OVER g AS n, sum(b) OVER g AS m FROM c
        WINDOW w AS (PARTITION BY region, week ORDER BY value), g AS (PARTITION BY region, week)),
  k AS (SELECT region, week, cast(max(n) AS bigint) AS n_ref, cast(max(m) AS bigint) AS n_cur, max(abs(ca / n - cb / m)) AS d
        FROM x WHERE n > 0 AND m > 0 GROUP BY 1, 2)
  SELECT region, strftime(week, '%Y-%m-%d') AS week, n_ref, n_cur, round(d, 9) AS ks_statistic, round({ks_p("d", "n_ref", "n_cur")}, 9) AS ks_pvalue FROM k""")
def weekly_drift(spark, sf):
    """Prices of slow and quick shipments of every region and week: many small samples, exact tails."""
    tx = views.tx(spark, sf).select("region", F.date_format(F.date_trunc("week", "ts"), "yyyy-MM-dd").alias("week"), "price_usd",
                                    (F.col("shipping_days") > 10).cast("int").alias("slow"))
    return rounded(drift.grouped_drift(tx, "price_usd", "slow", ["region", "week"]), ks_statistic=9, ks_pvalue=9)


@query("""SELECT pair, feature, round(ks_statistic, 9) AS ks_statistic, round(ks_pvalue, 9) AS ks_pvalue,
          round(mean_shift, 6) AS mean_shift, drifted FROM drift""")
def feature_drift(spark, sf):
    return rounded(_drift(spark, sf), ks_statistic=9, ks_pvalue=9, mean_shift=6)


@query("""SELECT pair, count(*) FILTER (drifted) AS n_drifted, bool_or(drifted) AS drift_detected,
          round(count(*) FILTER (drifted) / count(*)::double, 9) AS drift_ratio FROM drift GROUP BY pair""")
def drift_summary(spark, sf):
    return rounded(drift.drift_summary(_drift(spark, sf), ["pair"]), drift_ratio=9)


_PRED_LONG = """SELECT 'pred' AS feature, y_hat AS value, label AS cur FROM scored"""


@query(f"""WITH l AS ({_PRED_LONG}),
  c AS (SELECT value, sum(1 - cur) AS a, sum(cur) AS b FROM l GROUP BY value),
  x AS (SELECT sum(a) OVER (ORDER BY value) / 1.0::double AS ca, sum(b) OVER (ORDER BY value) / 1.0::double AS cb,
               sum(a) OVER () / 1.0::double AS n, sum(b) OVER () / 1.0::double AS m FROM c),
  k AS (SELECT max(abs(ca / n - cb / m)) AS d FROM x),
  s AS (SELECT avg(value) FILTER (cur = 0) AS rm, avg(value) FILTER (cur = 1) AS cm, stddev_pop(value) FILTER (cur = 0) AS sd FROM l)
  SELECT round(d, 9) AS ks_statistic, round(abs(cm - rm) / (sd + 1e-8::double), 6) AS mean_shift, d > 0.15::double AS drift_detected,
         round(rm, 4) AS reference_mean, round(cm, 4) AS current_mean FROM k, s""")
def prediction_drift(spark, sf):
    scored = views.scored(spark, sf)
    out = drift.prediction_drift(scored.where("label = 0"), scored.where("label = 1"), "y_hat")
    return rounded(out.drop("ks_pvalue"), ks_statistic=9, mean_shift=6, reference_mean=4, current_mean=4)


@query("""WITH o AS (SELECT * FROM (VALUES ('quantity', 2), ('price_usd', 3), ('shipping_days', 4), ('market_index', 5)) v(feature, line_no))
  SELECT 0 AS line_no, '=== Model Drift Report ===' AS line
  UNION ALL SELECT 1, concat('Features drifted: ', count(*) FILTER (drifted), '/', count(*)) FROM drift WHERE pair = 'label'
  UNION ALL SELECT line_no, concat('  [', CASE WHEN drifted THEN 'DRIFT' ELSE 'OK' END, '] ', drift.feature, ': KS=',
            format('{:.4f}', ks_statistic), ', shift=', format('{:.4f}', mean_shift))
            FROM drift JOIN o ON drift.feature = o.feature WHERE pair = 'label'
  UNION ALL SELECT 6, concat('Predictions [', CASE WHEN ks_statistic > 0.15::double THEN 'DRIFT' ELSE 'OK' END, ']: KS=',
            format('{:.4f}', ks_statistic)) FROM drift WHERE pair = 'label' AND feature = 'price_usd'""")
def drift_report(spark, sf):
    tx = views.tx(spark, sf).select("is_fraud", *DRIFT_COLUMNS)
    ref, cur = tx.where("is_fraud = 0"), tx.where("is_fraud = 1")
    return drift.drift_report(drift.feature_drift(ref, cur, DRIFT_COLUMNS), DRIFT_COLUMNS,
                              drift.prediction_drift(ref, cur, "price_usd"))


# ---------------------------------------------------------------- splits and folds


@query("SELECT transaction_id, cast(ntile(5) OVER (ORDER BY ts, transaction_id) - 1 AS int) AS fold FROM tx")
def kfold_assign(spark, sf):
    return sampling.assign_folds(views.tx(spark, sf).select(TX, "ts"), ["ts", TX]).select(TX, "fold")


@query("SELECT transaction_id, CASE WHEN rn < floor(n * 0.8::double) THEN 'head' ELSE 'tail' END AS part FROM ordered_tx")
def time_split(spark, sf):
    return sampling.split_head_tail(views.tx(spark, sf).select(TX, "ts"), ["ts", TX]).select(TX, "part")


@query(f"""SELECT transaction_id, CASE WHEN {u("concat(transaction_id, '|42')")} < 0.2::double THEN 'test' ELSE 'train' END AS split FROM tx""")
def split_random(spark, sf):
    return sampling.split_random(views.tx(spark, sf).select(TX), TX)


@query(f"""SELECT transaction_id, is_fraud, CASE WHEN rk < floor(n * 0.2::double + 0.5::double) THEN 'test' ELSE 'train' END AS split FROM (
    SELECT transaction_id, is_fraud, count(*) OVER (PARTITION BY is_fraud) AS n,
           row_number() OVER (PARTITION BY is_fraud ORDER BY {h("concat(transaction_id, '|42')")}, transaction_id) - 1 AS rk FROM tx) s""")
def split_stratified(spark, sf):
    return sampling.split_stratified(views.tx(spark, sf).select(TX, "is_fraud"), TX, "is_fraud")


# ---------------------------------------------------------------- class balancing

_FEATURES = ", ".join(MODEL_FEATURES)


def _gap2(a, b):
    return " + ".join(f"({a}.{c} - {b}.{c}) * ({a}.{c} - {b}.{c})" for c in MODEL_FEATURES)


def _neighbor_ctes(label):
    return f"""mino AS (SELECT transaction_id AS id, {_FEATURES} FROM tx_features WHERE {label} = 1),
  pairs AS (SELECT a.id AS id, b.id AS neighbor_id, round(sqrt({_gap2('a', 'b')}), 6) AS distance FROM mino a JOIN mino b ON a.id <> b.id),
  nn AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY distance, neighbor_id) AS rank FROM pairs QUALIFY rank <= 5)"""


@query(f"WITH {_neighbor_ctes('is_fraud')} SELECT id, cast(rank AS int) AS rank, neighbor_id, distance FROM nn")
def smote_neighbors(spark, sf):
    rows = views.tx_features(spark, sf).where("is_fraud = 1").select(
        F.col(TX).alias("id"), F.array(*[F.col(c).cast("double") for c in MODEL_FEATURES]).alias("vec"))
    return neighbors.neighbor_rows(neighbors.k_nearest(rows))


def _smote_sql(label):
    new = ", ".join(f"m.{c} + g.u * (o.{c} - m.{c}) AS {c}" for c in MODEL_FEATURES)
    return f"""{_neighbor_ctes(label)},
  sizes AS (SELECT count(*) FILTER ({label} = 0) AS n0, count(*) FILTER ({label} = 1) AS n1 FROM tx),
  need AS (SELECT least(n0, 2 * n1) - n1 AS missing, n1 FROM sizes),
  seq AS (SELECT id, row_number() OVER (ORDER BY id) - 1 AS no FROM mino),
  draw AS (SELECT id, no, unnest(generate_series(1, missing // n1 + CASE WHEN no < missing % n1 THEN 1 ELSE 0 END)) AS copy FROM seq, need),
  g AS (SELECT id, copy, {h("concat(id, '|', copy, '|neighbour|42')")} % 5 + 1 AS pick, {u("concat(id, '|', copy, '|gap|42')")} AS u FROM draw),
  made AS (SELECT concat(g.id, '#', g.copy) AS transaction_id, {new}
           FROM g JOIN mino m ON g.id = m.id JOIN nn ON nn.id = g.id AND nn.rank = g.pick JOIN mino o ON o.id = nn.neighbor_id)"""


_ROUNDED = ", ".join(f"round({c}, 6) AS {c}" for c in MODEL_FEATURES)


@query(f"""WITH {_smote_sql('is_fraud')}
  SELECT transaction_id, is_fraud, 'original' AS origin, {_ROUNDED} FROM tx_features
  UNION ALL SELECT transaction_id, 1, 'synthetic', {_ROUNDED} FROM made""")
def smote(spark, sf):
    rows = sampling.smote(views.tx_features(spark, sf, "is_fraud"), TX, MODEL_FEATURES, "is_fraud")
    return rounded(rows, **{c: 6 for c in MODEL_FEATURES})


def _dataset_sql(label):
    return f"""WITH c AS (SELECT {label} AS label, count(*) AS n FROM tx GROUP BY 1), t AS (SELECT sum(n) AS total, count(*) AS k FROM c),
  r AS (SELECT label, CASE WHEN label = 1 THEN least((SELECT n FROM c WHERE label = 0), 2 * n) ELSE n END AS n FROM c)
  SELECT 'original' AS part, label, round(n::double, 9) AS value FROM c
  UNION ALL SELECT 'resampled', label, round(n::double, 9) FROM r
  UNION ALL SELECT 'weight', label, round(total / (k * n::double), 9) FROM c, t"""


def _dataset(spark, sf, label):
    d = sampling.imbalanced_dataset(views.tx_features(spark, sf, label), TX, MODEL_FEATURES, label)
    parts = [("original", d["original_distribution"], "n"), ("resampled", d["resampled_distribution"], "n"),
             ("weight", d["class_weights"], "weight")]
    return reduce(DataFrame.unionByName, [
        f.select(F.lit(p).alias("part"), "label", F.round(F.col(c).cast("double"), 9).alias("value")) for p, f, c in parts])


@query(_dataset_sql("is_fraud"))
def fraud_dataset(spark, sf):
    return _dataset(spark, sf, "is_fraud")


@query(_dataset_sql("is_defect"))
def defect_dataset(spark, sf):
    return _dataset(spark, sf, "is_defect")


# ---------------------------------------------------------------- clusters and components


def _points(spark, sf):
    return views.table(spark, sf, "embeddings").select(
        "vec_id", F.col("embedding").cast("array<double>").alias("vec"))


def _seeds(points, k=4):
    """The k lowest ids start the clusters 0..k-1."""
    first = points.orderBy("vec_id").limit(k)
    return first.select(F.col("vec_id").cast("int").alias("cluster"), "vec")


def _assign(points, cents):
    return f"""SELECT vec_id, cluster, d FROM (SELECT p.vec_id AS vec_id, c.cluster AS cluster,
      round(sqrt(sum((p.v - c.v) * (p.v - c.v))), 9) AS d FROM {points} p JOIN {cents} c ON p.i = c.i GROUP BY 1, 2) x
      QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY d, cluster) = 1"""


_C0 = "c0 AS (SELECT cast(vec_id AS int) AS cluster, i, v FROM dims WHERE vec_id < 4)"


def _step(n):
    return f"""a{n} AS ({_assign('dims', f'c{n}')}),
  c{n + 1} AS (SELECT c.cluster AS cluster, c.i AS i, coalesce(avg(d.v), min(c.v)) AS v FROM c{n} c
    LEFT JOIN a{n} a ON a.cluster = c.cluster LEFT JOIN dims d ON d.vec_id = a.vec_id AND d.i = c.i GROUP BY 1, 2)"""


@query(f"WITH {_C0} SELECT vec_id, cluster, d AS distance FROM ({_assign('dims', 'c0')}) r")
def kmeans_assign(spark, sf):
    points = _points(spark, sf)
    return cluster.assign_nearest(points, _seeds(points)).select("vec_id", "cluster", "distance")


@query(f"WITH {_C0}, {_step(0)}, {_step(1)} SELECT cluster, cast(i - 1 AS int) AS dim, round(v, 6) AS value FROM c2")
def kmeans_step(spark, sf):
    points = _points(spark, sf)
    width = len(points.select("vec").head()["vec"])
    moved = cluster.lloyd_steps(points, _seeds(points), width, 2)
    return rounded(moved.select("cluster", F.posexplode("vec").alias("dim", "value")), value=6)


_PAIRS = [(a, b) for i, a in enumerate(NUMERIC_COLUMNS) for b in NUMERIC_COLUMNS[i:]]


@query(" UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, round(covar_samp({a}, {b}), 1) AS cov FROM tx" for a, b in _PAIRS))
def covariance(spark, sf):
    return rounded(cluster.covariance(views.tx(spark, sf), NUMERIC_COLUMNS), cov=1)


# Loadings (features x components) that the projection query applies.
LOADINGS = [[0.5, -0.25, 0.125], [0.25, 0.5, -0.75], [0.001, 0.002, -0.003], [-0.5, 0.125, 0.25], [0.75, -0.5, 1.5]]


@query("SELECT transaction_id, " + ", ".join(
    "round(" + " + ".join(f"{c} * ({w[j]})::double" for c, w in zip(NUMERIC_COLUMNS, LOADINGS)) + f", 6) AS pca_{j}"
    for j in range(3)) + " FROM tx")
def pca_project(spark, sf):
    out = cluster.project(views.tx(spark, sf), NUMERIC_COLUMNS, LOADINGS).select(TX, "pca_0", "pca_1", "pca_2")
    return rounded(out, pca_0=6, pca_1=6, pca_2=6)


@query("SELECT cast(j AS int) AS component, true AS unit_length, true AS eigenvector FROM range(3) r(j) WHERE (SELECT count(*) FROM tx) > 0")
def pca_components(spark, sf):
    """Every component has length one, and the covariance only stretches it, by its explained variance."""
    tx = views.tx(spark, sf).select(*NUMERIC_COLUMNS)
    parts, cov = materialize(cluster.pca_components(tx), "loadings"), materialize(cluster.covariance(tx, NUMERIC_COLUMNS), "covariance")
    full = cov.union(cov.where("a <> b").select("b", "a", "cov"))
    total = cov.where("a = b").agg(F.sum("cov")).scalar()
    image = (full.join(parts.withColumnRenamed("feature", "b"), "b").groupBy(F.col("a").alias("feature"), "component")
             .agg(F.sum(F.col("cov") * F.col("loading")).alias("image")))
    gap = F.abs(F.col("image") / total - F.col("explained_variance") * F.col("loading"))
    return parts.join(image, ["feature", "component"]).groupBy("component").agg(
        (F.abs(F.sum(F.col("loading") * F.col("loading")) - 1) < 1e-9).alias("unit_length"), (F.max(gap) < 1e-9).alias("eigenvector"))


def _lloyd_sql(source: str, values: list[str], k: int, output: str, more: str = "", steps: int = 50) -> str:
    """All steps one after another; once labels repeat, further steps change nothing."""
    gap = " + ".join(f"power(vec[{i}] - c.vec[{i}], 2)" for i in range(1, len(values) + 1))
    label = f"list_min(list_transform(cs, lambda c: {{'d': round(sqrt({gap}), 9), 'cluster': c.cluster}})).cluster"
    mean = ", ".join(f"cast(sum(cast(vec[{i}] AS decimal(38,12))) AS double) / count(*)" for i in range(1, len(values) + 1))
    ctes = [f"pts AS MATERIALIZED (SELECT transaction_id, [{', '.join(values)}] AS vec{more} FROM {source})",
            f"""c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h, transaction_id) - 1 AS cluster, vec FROM (
                SELECT *, {h("concat(transaction_id, '|42')")} AS h FROM pts) s ORDER BY h, transaction_id LIMIT {k})"""]
    for i in range(steps - 1):
        ctes.append(f"""c{i + 1} AS MATERIALIZED (SELECT c.cluster, coalesce(m.vec, c.vec) AS vec FROM c{i} c LEFT JOIN (
            SELECT cluster, [{mean}] AS vec FROM (SELECT {label} AS cluster, vec FROM pts,
              (SELECT list({{'cluster': cluster, 'vec': vec}} ORDER BY cluster) AS cs FROM c{i}) l) a GROUP BY cluster) m ON c.cluster = m.cluster)""")
    return (f"WITH {', '.join(ctes)} SELECT transaction_id, cast({label} AS int) AS {output}{more} FROM pts, "
            f"(SELECT list({{'cluster': cluster, 'vec': vec}} ORDER BY cluster) AS cs FROM c{steps - 1}) l")


@query(_lloyd_sql("tx", [f"{c}::double" for c in NUMERIC_COLUMNS], 4, "market_cluster"))
def market_clusters(spark, sf):
    return cluster.market_clusters(views.tx(spark, sf), key=TX).select(TX, "market_cluster")


SEGMENT_COLUMNS = ["quantity", "unit_cost", "price_usd"]


@query(_lloyd_sql("tx, (SELECT " + ", ".join(f"avg({c}) AS m{i}, stddev_samp({c}) AS d{i}" for i, c in enumerate(SEGMENT_COLUMNS)) + " FROM tx) s",
                  [f"({c} - m{i}) / d{i}" for i, c in enumerate(SEGMENT_COLUMNS)], 3, "market_segment"))
def market_segments(spark, sf):
    return cluster.market_segments(views.tx(spark, sf), SEGMENT_COLUMNS, k=3, key=TX).select(TX, "market_segment")


@query(_lloyd_sql("tx_features", [f"{c}::double" for c in NUMERIC_COLUMNS], 4, "market_cluster").replace(
    "SELECT transaction_id, cast(", "SELECT transaction_id, cast(34 AS int) AS n_columns, true AS projected, cast("))
def enriched_features(spark, sf):
    """Every row's cluster, the number of columns, and whether its projections are the products of its columns with the loadings."""
    out = cluster.enriched_features(views.tx_features(spark, sf), key=TX)
    loadings = {(r["feature"], r["component"]): r["loading"] for r in cluster.pca_components(views.tx(spark, sf)).collect()}  # columns x components
    same = [F.abs(F.col(f"pca_{j}") - sum((F.col(c) * F.lit(loadings[c, j]) for c in NUMERIC_COLUMNS), F.lit(0.0)))
            <= 1e-6 * (1 + F.abs(F.col(f"pca_{j}"))) for j in range(3)]
    return out.select(TX, F.lit(len(out.columns)).alias("n_columns"), F.coalesce(same[0] & same[1] & same[2], F.lit(False)).alias("projected"),
                      "market_cluster")


@query("""SELECT count(*) AS n, cast(4 AS bigint) AS clusters, cast(0 AS bigint) AS misplaced, true AS unit_loadings, true AS falling_variance
          FROM embeddings""")
def damage_clusters(spark, sf):
    """Vectors in the cluster of their nearest centre, with what the projection keeps."""
    got = cluster.damage_clusters(views.frames(spark, sf))
    gaps = F.array(*[distance(F.col("components"), F.array(*[F.lit(float(v)) for v in c])) for c in got["centers"]])
    lengths = [sum(row[j] ** 2 for row in got["loadings"]) for j in range(len(got["explained_variance"]))]
    variance = got["explained_variance"]
    return got["labels"].withColumn("_gaps", gaps).agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("cluster").alias("clusters"),
        F.count_if(F.col("_gaps")[F.col("cluster")] > F.array_min("_gaps") + 1e-9).alias("misplaced"),
        F.lit(all(abs(n - 1) < 1e-9 for n in lengths)).alias("unit_loadings"),
        F.lit(variance == sorted(variance, reverse=True)).alias("falling_variance"))
