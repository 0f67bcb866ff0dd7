"""Queries on scans, sinks, projections, filters, joins and aggregates."""

from __future__ import annotations

from pyspark.sql import functions as F

from stockyard.functions import scalars as S
from stockyard.operators import commerce, detections, features, tracking
from stockyard.operators.feature_store import FeatureStore
from stockyard.plans import views
from stockyard.plans.registry import query, rounded, text_ts, u
from stockyard.schema import MODEL_FEATURES, NUMERIC_COLUMNS
from stockyard.sources import tables
from stockyard.workspace import fresh_dir

TX = "transaction_id"
TX_COLUMNS = ["transaction_id", "region", "category", "quantity", "unit_cost", "price_usd", "warehouse_id",
              "supplier_id", "is_fraud", "is_defect", "shipping_days", "market_index"]
TX_LIST = ", ".join(TX_COLUMNS)
METRICS_SQL = """count(transaction_id) AS txn_count, cast(sum(cast(price_usd AS decimal(38,2))) AS double) AS total_revenue,
  cast(sum(cast(price_usd AS decimal(38,2))) AS double) / count(price_usd) AS avg_price,
  cast(sum(is_fraud) AS bigint) AS fraud_count, cast(sum(is_defect) AS bigint) AS defect_count"""


# ---------------------------------------------------------------- scans


@query("""SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate,
          o_orderpriority FROM orders""")
def scan_parquet(spark, sf):
    return tables.read_parquet(spark, f"{sf}/orders.parquet").withColumn("o_orderdate", text_ts("o_orderdate"))


@query("SELECT l_orderkey, l_extendedprice FROM lineitem")
def scan_projected(spark, sf):
    return tables.read_parquet(spark, f"{sf}/lineitem.parquet", ["l_orderkey", "l_extendedprice"])


@query("""SELECT l_orderkey, l_linenumber, l_quantity, l_discount, l_returnflag FROM lineitem
          WHERE (l_quantity > 45 AND l_returnflag IN ('A', 'R') AND l_linestatus NOT IN ('X'))
             OR (l_discount < 0.01::double AND l_linestatus <> 'O' AND l_quantity <= 5)""")
def scan_filtered(spark, sf):
    kept = tables.read_filtered(spark, f"{sf}/lineitem.parquet", [
        [("l_quantity", ">", 45), ("l_returnflag", "in", ["A", "R"]), ("l_linestatus", "not in", ["X"])],
        [("l_discount", "<", 0.01), ("l_linestatus", "!=", "O"), ("l_quantity", "<=", 5)]])
    return kept.select("l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_returnflag")


@query("""SELECT cast(row_number() OVER () - 1 AS int) AS position, column_name AS name,
          CASE column_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'DOUBLE' THEN 'double'
               WHEN 'VARCHAR' THEN 'string' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' END AS type
          FROM (DESCRIBE SELECT * FROM lineitem) d""")
def schema_inspect(spark, sf):
    return tables.schema_table(tables.read_parquet(spark, f"{sf}/lineitem.parquet"))


def _archive(spark, sf):
    return tables.archive_transactions(views.tx(spark, sf), fresh_dir(spark, "archive"))


@query(f"SELECT {TX_LIST} FROM tx")
def merge_partitions(spark, sf):
    return tables.merge_partitions(spark, _archive(spark, sf)).select(*TX_COLUMNS)


@query("SELECT transaction_id, category, price_usd FROM tx")
def scan_recursive(spark, sf):
    return tables.read_recursive(spark, _archive(spark, sf)).select(TX, "category", "price_usd")


@query("SELECT transaction_id, region, price_usd FROM tx WHERE region IN ('ASIA', 'EUROPE') AND price_usd > 50000")
def archive_roundtrip(spark, sf):
    return tables.read_filtered(spark, _archive(spark, sf), [
        ("region", "in", ["ASIA", "EUROPE"]), ("price_usd", ">", 50000)]).select(TX, "region", "price_usd")


@query("""WITH m AS (SELECT region, category, cast(sum(cast(price_usd AS decimal(18,2))) AS double) AS revenue FROM tx GROUP BY 1, 2)
          SELECT region, category, round(revenue / sum(revenue) OVER (PARTITION BY region), 9) AS revenue_share FROM m""")
def ingest_frame(spark, sf):
    tx = views.tx(spark, sf)
    per_region = commerce.regional_summary(tx).toPandas()  # one row per region
    known = tables.ingest_frame(spark, per_region, ["region", "total_revenue", "not_there"])
    share = commerce.regional_metrics(tx).select("region", "category", F.col("total_revenue").alias("revenue"))
    return rounded(share.join(known, "region").select(
        "region", "category", (F.col("revenue") / F.col("total_revenue")).alias("revenue_share")), revenue_share=9)


@query(f"SELECT strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, {TX_LIST} FROM tx")
def scan_json(spark, sf):
    rows = views.tx(spark, sf).withColumn("timestamp", text_ts("ts")).drop("ts")
    path = tables.write_json(rows, fresh_dir(spark, "json"))
    return tables.read_json(spark, path).withColumnRenamed("timestamp", "ts")


def _seed(spark, sf):
    root = fresh_dir(spark, "tables")
    return tables.seed_tables(views.tx(spark, sf), views.warehouses(spark, sf), root, "_" + root[-8:])


@query("""SELECT warehouse_id, count(*) AS n, cast(sum(quantity) AS bigint) AS quantity FROM tx GROUP BY warehouse_id""")
def relational_scan(spark, sf):
    fact, _ = _seed(spark, sf)
    return tables.read_table(spark, fact).groupBy("warehouse_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum("quantity").alias("quantity"))


@query("SELECT warehouse_id, region, capacity, lat, lon FROM warehouses")
def scan_warehouses(spark, sf):
    root = fresh_dir(spark, "tables")
    return tables.read_table(spark, tables.write_table(views.warehouses(spark, sf), "warehouses_" + root[-8:], root))


@query("""SELECT 'transactions' AS table_name, count(*) AS n_rows, count(DISTINCT warehouse_id) AS n_warehouses FROM tx
          UNION ALL SELECT 'warehouses', count(*), count(DISTINCT warehouse_id) FROM warehouses""")
def seed_tables(spark, sf):
    def size(name, label):
        return spark.table(name).agg(F.lit(label).alias("table_name"), F.count(F.lit(1)).alias("n_rows"),
                                     F.count_distinct("warehouse_id").alias("n_warehouses"))

    fact, dimension = _seed(spark, sf)
    return size(fact, "transactions").unionByName(size(dimension, "warehouses"))


@query("""SELECT region, count(*) AS n, max(price_usd) AS top_price FROM tx
          WHERE price_usd > 40000 AND shipping_days <= 10 GROUP BY region""")
def sql_params(spark, sf):
    return tables.run_sql(
        spark, "SELECT region, count(*) AS n, max(price_usd) AS top_price FROM {tx} "
               "WHERE price_usd > :low AND shipping_days <= :days GROUP BY region",
        {"low": 40000, "days": 10}, tx=views.tx(spark, sf))


# ---------------------------------------------------------------- sinks


@query("SELECT transaction_id, price_usd FROM tx UNION ALL SELECT transaction_id, price_usd FROM tx WHERE is_fraud = 1")
def write_mode(spark, sf):
    path, tx = fresh_dir(spark, "mode"), views.tx(spark, sf).select(TX, "price_usd", "is_fraud")
    tables.write_parquet(commerce.fraud_samples(tx), path)
    tables.write_parquet(tx, path)
    tables.write_parquet(commerce.fraud_samples(tx), path, mode="append")
    return tables.read_parquet(spark, path, [TX, "price_usd"])


@query("""SELECT transaction_id, cast(round(cast(quantity AS decimal(19,2)) * cast(unit_cost AS decimal(14,6))
          * cast(market_index AS decimal(12,8)), 2) AS double) AS predicted_price FROM tx""")
def predictions_table(spark, sf):
    root = fresh_dir(spark, "predictions")
    scored = views.tx(spark, sf).select(TX, S.heuristic_price().alias("predicted_price"))
    name = tables.write_table(scored, "predictions_" + root[-8:], root)
    return tables.read_table(spark, name)


@query("""SELECT 'DATA INGESTION' AS stage, 'transactions' AS key, count(*)::varchar AS value FROM tx
  UNION ALL SELECT 'DATA INGESTION', 'joined rows', count(*)::varchar FROM tx LEFT JOIN warehouses w ON tx.warehouse_id = w.warehouse_id
  UNION ALL SELECT 'DATA INGESTION', 'aggregated rows', count(*)::varchar FROM (SELECT DISTINCT region, category FROM tx) a
  UNION ALL SELECT 'ML TRAINING', 'class 0', count(*)::varchar FROM tx WHERE is_fraud = 0
  UNION ALL SELECT 'ML TRAINING', 'class 1', count(*)::varchar FROM tx WHERE is_fraud = 1
  UNION ALL SELECT 'COMPUTER VISION', 'total detections', count(*)::varchar FROM detections
  UNION ALL SELECT 'COMPUTER VISION', 'total frames', count(DISTINCT frame)::varchar FROM det""")
def run_report(spark, sf):
    tx, det = views.tx(spark, sf), views.det(spark, sf)
    joined = commerce.join_warehouses(tx, views.warehouses(spark, sf))
    ingest = tx.agg(F.count(F.lit(1)).alias("transactions"))
    rows = joined.agg(F.count(F.lit(1)).alias("joined_rows"))
    metrics = commerce.regional_metrics(tx).agg(F.count(F.lit(1)).alias("aggregated_rows"))
    fraud = tx.agg(F.count_if(F.col("is_fraud") == 0).alias("class_0"), F.count_if(F.col("is_fraud") == 1).alias("class_1"))
    vision = detections.track_summary(detections.classify_boxes(det), det).select("total_detections", "total_frames")
    report = tracking.stage_rows("data ingestion", ingest)
    for stage, part in (("data ingestion", rows), ("data ingestion", metrics), ("ml training", fraud),
                        ("computer vision", vision)):
        report = report.unionByName(tracking.stage_rows(stage, part))
    path = tracking.write_report(report, fresh_dir(spark, "report"))
    return spark.read.schema("stage string, key string, value string").json(path)


# ---------------------------------------------------------------- projections


@query("""SELECT event_id, strftime(try_cast(CASE WHEN event_type = 'error' THEN concat('bad ', event_id)
          ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS timestamp), '%Y-%m-%d %H:%M:%S') AS parsed FROM events""")
def parse_ts(spark, sf):
    raw = F.when(F.col("event_type") == "error", F.concat(F.lit("bad "), F.col("event_id").cast("string"))).otherwise(
        text_ts("ts"))
    return (views.table(spark, sf, "events").withColumn("raw", raw)
            .select("event_id", F.date_format(S.parse_ts("raw"), "yyyy-MM-dd HH:mm:ss").alias("parsed")))


@query("""SELECT transaction_id, month, day_of_week, region_encoded, category_encoded, round(price_per_unit, 9) AS price_per_unit,
          round(cost_ratio, 9) AS cost_ratio, round(log_quantity, 9) AS log_quantity FROM tx_features""")
def market_features(spark, sf):
    out = features.market_features(views.tx(spark, sf)).select(
        TX, "month", "day_of_week", "region_encoded", "category_encoded", "price_per_unit", "cost_ratio", "log_quantity")
    return rounded(out, price_per_unit=9, cost_ratio=9, log_quantity=9)


@query("""WITH t AS (SELECT transaction_id, supplier_id, nullif(category, 'PROMO') AS category FROM tx),
  c AS (SELECT category, row_number() OVER (ORDER BY category) - 1 AS code FROM (SELECT DISTINCT category FROM t WHERE category IS NOT NULL) a),
  s AS (SELECT supplier_id, row_number() OVER (ORDER BY supplier_id) - 1 AS code FROM (SELECT DISTINCT supplier_id FROM t) b)
  SELECT transaction_id, cast(coalesce(c.code, -1) AS int) AS category_encoded, cast(coalesce(s.code, -1) AS int) AS supplier_encoded
  FROM t LEFT JOIN c ON t.category = c.category LEFT JOIN s ON t.supplier_id = s.supplier_id""")
def encode_categories(spark, sf):
    raw = views.tx(spark, sf).select(TX, "supplier_id", F.nullif("category", F.lit("PROMO")).alias("category"))
    small = features.encode_categories(raw, {"category": "category_encoded"})
    large = features.encode_categories(small, {"supplier_id": "supplier_encoded"})
    return large.select(TX, "category_encoded", "supplier_encoded")


def _z(c):
    return f"({c} - avg({c}) OVER ()) / (stddev_pop({c}) OVER () + 1e-8::double)"


@query(f"SELECT transaction_id, round({_z('price_usd')}, 6) AS price_usd_zscore, round({_z('quantity')}, 6) AS quantity_zscore FROM tx")
def zscore(spark, sf):
    out = features.zscores(views.tx(spark, sf), ["price_usd", "quantity"])
    return rounded(out.select(TX, "price_usd_zscore", "quantity_zscore"), price_usd_zscore=6, quantity_zscore=6)


@query("SELECT event_id, round(ln(1 + abs(value - 50)) * sign(value - 50), 9) AS delta_log FROM events")
def signed_log(spark, sf):
    shifted = views.table(spark, sf, "events").select("event_id", (F.col("value") - 50).alias("delta"))
    return rounded(features.signed_logs(shifted, ["delta"]).select("event_id", "delta_log"), delta_log=9)


_ENRICHED = ", ".join(f"round({_z(c)}, 6) AS {c}_zscore, round(ln(1 + abs({c})) * sign({c}), 9) AS {c}_log"
                      for c in NUMERIC_COLUMNS)


@query(f"SELECT transaction_id, {_ENRICHED} FROM tx")
def enrich_numeric(spark, sf):
    out = features.enrich_numeric(views.tx(spark, sf)).select(
        TX, *[f"{c}{s}" for c in NUMERIC_COLUMNS for s in ("_zscore", "_log")])
    return rounded(out, **{f"{c}_zscore": 6 for c in NUMERIC_COLUMNS}, **{f"{c}_log": 9 for c in NUMERIC_COLUMNS})


@query("""WITH s AS (SELECT avg(price_usd) AS m, stddev_samp(price_usd) AS d FROM tx)
          SELECT transaction_id, CASE WHEN abs(price_usd - m) > 1.7::double * coalesce(d, 1.0) THEN 1 ELSE 0 END AS is_price_anomaly FROM tx, s""")
def price_anomalies(spark, sf):
    return commerce.price_anomalies(views.tx(spark, sf), 1.7).select(TX, "is_price_anomaly")


@query("""WITH s AS (SELECT avg(value) AS m, stddev_samp(value) AS d FROM events)
          SELECT event_id, value FROM events, s WHERE abs(value - m) > 3.0::double * coalesce(d, 1.0)""")
def value_anomalies(spark, sf):
    flagged = commerce.price_anomalies(views.table(spark, sf, "events"), 3.0, "value", "flag")
    return flagged.where("flag = 1").select("event_id", "value")


@query("SELECT region, transaction_id, price_usd FROM tx")
def project_available(spark, sf):
    return features.project_available(views.tx(spark, sf), ["region", "latitude", TX, "price_usd"])


@query("SELECT event_id, CASE WHEN value > 200 THEN 0 ELSE value END AS value, CASE WHEN user_id < 20 THEN 0 ELSE user_id END AS user_id FROM events")
def fill_zero(spark, sf):
    holes = views.table(spark, sf, "events").select(
        "event_id", F.when(F.col("value") <= 200, F.col("value")).alias("value"),
        F.when(F.col("user_id") >= 20, F.col("user_id")).alias("user_id"))
    return features.fill_zero(holes, ["value", "user_id", "missing"])


@query("""SELECT transaction_id, 'heuristic' AS model_used, cast(round(cast(quantity AS decimal(19,2)) * cast(unit_cost AS decimal(14,6))
          * cast(market_index AS decimal(12,8)), 2) AS double) AS predicted_price FROM tx""")
def heuristic_price(spark, sf):
    from stockyard.operators.supervised import score_prices
    return score_prices(views.tx(spark, sf)).select(TX, "predicted_price", "model_used")


def _robust(c):
    q = {n: f"quantile_cont({c}, {p}) OVER ()" for n, p in (("q1", .25), ("q2", .5), ("q3", .75))}
    return (f"round(({c} - {q['q2']}) / CASE WHEN {q['q3']} = {q['q1']} THEN 1 ELSE {q['q3']} - {q['q1']} END, 6) "
            f"AS {c}_scaled")


@query(f"SELECT transaction_id, {', '.join(_robust(c) for c in ('quantity', 'price_usd', 'is_fraud'))} FROM tx")
def robust_scale(spark, sf):
    out = features.robust_scale(views.tx(spark, sf), ["quantity", "price_usd", "is_fraud"])
    return rounded(out.select(TX, "quantity_scaled", "price_usd_scaled", "is_fraud_scaled"),
                   quantity_scaled=6, price_usd_scaled=6, is_fraud_scaled=6)


# ---------------------------------------------------------------- filters, joins, limits, set operations


@query("SELECT transaction_id, region, price_usd FROM tx WHERE is_fraud = 1")
def fraud_samples(spark, sf):
    return commerce.fraud_samples(views.tx(spark, sf)).select(TX, "region", "price_usd")


@query("""SELECT transaction_id, tx.warehouse_id AS warehouse_id, w.region AS warehouse_region, capacity, lat, lon
          FROM tx LEFT JOIN warehouses w ON tx.warehouse_id = w.warehouse_id""")
def join_warehouse(spark, sf):
    out = commerce.join_warehouses(views.tx(spark, sf), views.warehouses(spark, sf))
    return out.select(TX, "warehouse_id", "warehouse_region", "capacity", "lat", "lon")


@query("SELECT transaction_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts FROM tx ORDER BY tx.ts, transaction_id LIMIT 1000")
def limit_rows(spark, sf):
    return commerce.first_rows(views.tx(spark, sf).select(TX, "ts"), ["ts", TX], 1000).withColumn("ts", text_ts("ts"))


@query("""SELECT transaction_id, 'fraud' AS kind, price_usd, cast(NULL AS int) AS shipping_days FROM tx WHERE is_fraud = 1
          UNION ALL SELECT transaction_id, 'defect', cast(NULL AS double), shipping_days FROM tx WHERE is_defect = 1""")
def union_all(spark, sf):
    tx = views.tx(spark, sf)
    fraud = commerce.fraud_samples(tx).select(TX, F.lit("fraud").alias("kind"), "price_usd")
    defect = tx.where("is_defect = 1").select(TX, F.lit("defect").alias("kind"), "shipping_days")
    return commerce.union_frames(fraud, defect)


@query("SELECT DISTINCT region FROM tx")
def distinct_regions(spark, sf):
    return commerce.distinct_values(views.tx(spark, sf), "region")


# ---------------------------------------------------------------- aggregates


@query(f"SELECT region, category, {METRICS_SQL}, cast(sum(cast(market_index AS decimal(38,12))) AS double) / count(market_index) AS avg_market_index FROM tx GROUP BY region, category")
def regional_metrics(spark, sf):
    return commerce.regional_metrics(views.tx(spark, sf))


@query(f"SELECT region, {METRICS_SQL} FROM tx GROUP BY region")
def regional_summary(spark, sf):
    return commerce.regional_summary(views.tx(spark, sf))


@query("SELECT is_fraud AS label, count(*) AS n FROM tx GROUP BY is_fraud")
def class_distribution(spark, sf):
    return commerce.class_distribution(views.tx(spark, sf), "is_fraud")


@query("""SELECT label, n, round(sum(n) OVER () / (count(*) OVER () * n::double), 9) AS weight
          FROM (SELECT is_fraud AS label, count(*) AS n FROM tx GROUP BY 1) c""")
def class_weights(spark, sf):
    return rounded(commerce.class_weights(views.tx(spark, sf), "is_fraud"), weight=9)


@query("""SELECT label, n, round(sum(n) OVER () / (count(*) OVER () * n::double), 9) AS weight
          FROM (SELECT toxic AS label, count(*) AS n FROM labels GROUP BY 1) c""")
def label_weights(spark, sf):
    return rounded(commerce.class_weights(views.table(spark, sf, "labels"), "toxic"), weight=9)


@query("SELECT region, round(cast(sum(cast(price_usd AS decimal(18,2))) AS double) / 1e6::double, 6) AS revenue_musd FROM tx GROUP BY region")
def chart_regional(spark, sf):
    return rounded(tracking.chart_revenue(commerce.regional_summary(views.tx(spark, sf))), revenue_musd=6)


@query("SELECT region, cast(sum(is_fraud) AS bigint) AS fraud_count, cast(sum(is_defect) AS bigint) AS defect_count FROM tx GROUP BY region")
def chart_fraud_defect(spark, sf):
    return tracking.chart_fraud_defect(commerce.regional_summary(views.tx(spark, sf)))


# ---------------------------------------------------------------- feature store


def _store(spark):
    return FeatureStore(spark, fresh_dir(spark, "store"))


def _market_group(spark, sf):
    from stockyard.operators.cluster import assign_nearest
    tx = views.tx(spark, sf).withColumn("vec", F.array("price_usd"))
    bands = spark.createDataFrame([(0, [15000.0]), (1, [35000.0]), (2, [60000.0]), (3, [90000.0])],
                                  "cluster int, vec array<double>")
    banded = assign_nearest(tx, bands).withColumnRenamed("cluster", "market_cluster")
    return banded.select("region", "category", "price_usd", "market_index", "market_cluster")


_FEATURE_COLUMNS = [TX, *MODEL_FEATURES, "price_usd"]


@query(f"""SELECT 'transaction_features' AS name, '{",".join(_FEATURE_COLUMNS)}' AS columns, count(*) AS n_rows,
          'model features' AS description, 'transactions,model' AS tags FROM tx_features""")
def fs_register(spark, sf):
    store = _store(spark)
    tx = views.tx_features(spark, sf).select(*_FEATURE_COLUMNS)
    store.register("transaction_features", tx.select(TX, "price_usd"), "replaced below")
    store.register("transaction_features", tx, "model features", ["transactions", "model"])
    return store.groups().select("name", F.array_join("columns", ",").alias("columns"), "n_rows", "description",
                                 F.array_join("tags", ",").alias("tags"))


@query("SELECT transaction_id, quantity, region_encoded, round(cost_ratio, 9) AS cost_ratio FROM tx_features")
def fs_get(spark, sf):
    store = _store(spark)
    store.register("features", views.tx_features(spark, sf).select(TX, "quantity", "region_encoded", "cost_ratio"))
    return rounded(store.get("features"), cost_ratio=9)


@query("""SELECT 'fraud' AS name, count(*) AS n_rows FROM tx WHERE is_fraud = 1
          UNION ALL SELECT 'prices', count(*) FROM tx UNION ALL SELECT 'warehouses', count(*) FROM warehouses""")
def fs_list(spark, sf):
    store, tx = _store(spark), views.tx(spark, sf)
    store.register("prices", tx.select(TX, "price_usd"))
    store.register("warehouses", views.warehouses(spark, sf))
    store.register("fraud", commerce.fraud_samples(tx).select(TX))
    return store.groups().select("name", "n_rows")


@query("""SELECT region, category, price_usd, market_index, CASE WHEN price_usd <= 25000 THEN 0 WHEN price_usd <= 47500 THEN 1
          WHEN price_usd <= 75000 THEN 2 ELSE 3 END AS market_cluster FROM tx""")
def market_group(spark, sf):
    store = _store(spark)
    store.register("market_features", _market_group(spark, sf), "market columns", ["market"])
    return store.get("market_features")


@query("""SELECT t.transaction_id, t.price_usd AS prices__price_usd, t.quantity AS prices__quantity,
          CASE WHEN t.is_fraud = 1 THEN t.region END AS fraud__region FROM tx t""")
def unified_features(spark, sf):
    store, tx = _store(spark), views.tx(spark, sf)
    store.register("prices", tx.select(TX, "price_usd", "quantity"))
    store.register("fraud", commerce.fraud_samples(tx).select(TX, "region"))
    return store.compile_unified(["prices", "fraud"], key=[TX])


@query("""WITH a AS (SELECT transaction_id, price_usd, row_number() OVER (ORDER BY transaction_id) AS rn FROM tx),
  b AS (SELECT transaction_id, region, row_number() OVER (ORDER BY region, transaction_id) AS rn FROM tx WHERE is_fraud = 1)
  SELECT a.transaction_id AS prices__transaction_id, a.price_usd AS prices__price_usd,
         b.transaction_id AS fraud__transaction_id, b.region AS fraud__region FROM a FULL JOIN b ON a.rn = b.rn""")
def unified_by_position(spark, sf):
    store, tx = _store(spark), views.tx(spark, sf)
    store.register("prices", tx.select(TX, "price_usd"))
    store.register("fraud", commerce.fraud_samples(tx).select(TX, "region"))
    return store.compile_unified(["prices", "fraud"], order={"prices": [TX], "fraud": ["region", TX]})


@query("SELECT count(*) AS n, cast(8 AS int) AS n_features, 0.0::double AS max_gap FROM tx_features")
def fs_transformer(spark, sf):
    """Model features scaled by a transformer and by its stored copy: no row differs."""
    from pyspark.ml import Pipeline
    from pyspark.ml.functions import vector_to_array

    from stockyard.operators.supervised import scaling_stages
    store, rows = _store(spark), views.tx_features(spark, sf).select(TX, *MODEL_FEATURES)
    fitted = Pipeline(stages=scaling_stages(MODEL_FEATURES)).fit(rows)
    store.register_transformer("scaler", fitted)
    first = fitted.transform(rows).select(*rows.columns, vector_to_array("features").alias("_once"))
    both = store.get_transformer("scaler").transform(first)
    gaps = F.zip_with("_once", vector_to_array("features"), lambda x, y: F.abs(x - y))
    return both.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("_once")).alias("n_features"),
                    F.max(F.array_max(gaps)).alias("max_gap"))
