"""Readers, writers, feature store, image jobs and streams."""

import json
from multiprocessing.pool import ThreadPool

import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockyard.functions import vision as V
from stockyard.operators import detections as D
from stockyard.operators import feature_store
from stockyard.operators import image_jobs as I
from stockyard.operators.commerce import regional_metrics, regional_summary
from stockyard.operators.feature_store import FeatureStore
from stockyard.operators.tracking import RunLog
from stockyard.plans import continuous
from stockyard.plans.visual import BITMAP_8X8
from stockyard.schema import TRANSACTION, model_features
from stockyard.sources import files, tables
from stockyard.streaming import streams
from stockyard.workspace import fresh_dir


def transactions(spark, n):
    pick = "element_at(split('{}', ' '), cast(id % {} + 1 as int))"
    return spark.range(n).selectExpr(
        "concat('TXN-', id) AS transaction_id", f"{pick.format('NA EU APAC', 3)} AS region", f"{pick.format('food pharma', 2)} AS category",
        "cast(1 + id * 37 % 499 as int) AS quantity", "5.25D + id % 190 AS unit_cost", "round(100 + id * 7.13D % 900, 2) AS price_usd",
        "concat('WH-', id % 11 + 1) AS warehouse_id", "concat('SUP-', id) AS supplier_id", "cast(id % 13 = 0 as int) AS is_fraud",
        "cast(id % 17 = 0 as int) AS is_defect", "cast(1 + id % 20 as int) AS shipping_days", "0.8D + id % 5 * 0.05D AS market_index",
        "date_format(timestamp_seconds(1704067200 + id * 3600), 'yyyy-MM-dd HH:mm:ss') AS timestamp"
    ).select(*[f.name for f in TRANSACTION.fields])


def test_filters_reach_the_parquet_reader(spark):
    path = tables.write_parquet(transactions(spark, 50), fresh_dir(spark, "t"))
    plan = tables.read_filtered(spark, path, [("quantity", ">", 100)])._jdf.queryExecution().toString()
    assert "GreaterThan(quantity,100)" in plan
    with pytest.raises(ValueError):
        tables.predicate([("a", "like", "x")])


def test_partition_filter_prunes(spark):
    path = tables.archive_transactions(transactions(spark, 50), fresh_dir(spark, "a"))
    plan = tables.read_filtered(spark, path, [("region", "=", "EU")])._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(region" in plan
    assert tables.merge_partitions(spark, path).count() == 50


def test_recursive_scan_of_nothing_fails(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        tables.read_recursive(spark, str(tmp_path / "none"))


def test_ingest_frame_types(spark):
    frame = pd.DataFrame({"t": pd.to_datetime(["2024-01-01", "2024-01-02"]), "s": ["a", None], "i": [1, 2], "f": [1.5, None]})
    got = tables.ingest_frame(spark, frame, ["s", "t", "i", "f", "missing"])
    assert [f.dataType.simpleString() for f in got.schema] == ["string", "string", "bigint", "double"]
    rows = got.orderBy("i").collect()
    assert rows[1]["s"] is None and rows[0]["t"].startswith("2024-01-01")


def test_jdbc_partition_options():
    assert tables.jdbc_partitions("id", 1, 9, 4)["numPartitions"] == "4"
    with pytest.raises(ValueError):
        tables.jdbc_partitions("id", 9, 1, 4)


def test_leak_free_features():
    assert "cost_ratio" in model_features() and "cost_ratio" not in model_features(leak_free=True)


def test_store_overwrites_lists_and_raises(spark):
    store = FeatureStore(spark, fresh_dir(spark, "s"))
    assert store.groups().count() == 0
    store.register("g", spark.range(3).withColumnRenamed("id", "k"), "old")
    old = store.get("g")
    store.register("g", spark.range(5).withColumnRenamed("id", "k"), "new", ["t"])
    entry = store.groups().collect()
    assert [(e["name"], e["n_rows"], e["description"], e["tags"]) for e in entry] == [("g", 5, "new", ["t"])]
    assert store.get("g").count() == 5 and old.count() == 3
    for call in (store.get, store.get_transformer):
        with pytest.raises(KeyError):
            call("nope")
    store.register("h", spark.range(2).withColumnRenamed("id", "k"))
    joined = store.compile_unified(["g", "h"], order={"g": ["k"], "h": ["k"]}).orderBy("g__k").collect()
    assert [(r["g__k"], r["h__k"]) for r in joined] == [(0, 0), (1, 1), (2, None), (3, None), (4, None)]
    assert list(store.metadata().head()["tags"]) == ["g", "h"]


def test_two_writers_of_the_registry(spark, monkeypatch):
    """Writers with clocks of their own commit at once; every commit gets its own number, the newest one wins for every reader, and snapshots keep the rest."""
    monkeypatch.setattr(feature_store, "COMPACT", 5)
    root = fresh_dir(spark, "s")
    stores = [FeatureStore(spark, root) for _ in range(4)]
    with ThreadPool(4) as pool:
        got = pool.map(lambda i: (stores[i % 4]._append("group", f"g{i % 3}", f"p{i}", ["c"], i), i), range(24), chunksize=1)
    assert sorted(n for n, _ in got) == list(range(1, 25))
    want = {}
    for seq, i in sorted(got):
        want[f"g{i % 3}"] = (f"p{i}", i)
    for store in (stores[0], FeatureStore(spark, root)):
        assert {r["name"]: (r["path"], r["n_rows"]) for r in store.groups().collect()} == want
    firsts = {}
    for seq, i in sorted(got):
        firsts.setdefault(f"g{i % 3}", seq)
    assert [r["name"] for r in stores[0].groups().collect()] == sorted(firsts, key=firsts.get)
    assert len(stores[0].registry.names()) < 24  # what a snapshot holds does not stay for ever


def test_run_log_appends(spark):
    log = RunLog(spark, fresh_dir(spark, "r"))
    for run in ("a", "b"):
        log.start(run, "train")
        log.log_params(run, {"depth": 6, "rate": 0.05})
        log.log_metrics(run, spark.createDataFrame([("rmse", 1.5)], "metric string, value double"), step=1)
    assert log.table("params").where("value = '0.05'").count() == 2 and log.table("metrics").count() == 2


# ---------------------------------------------------------------- boxes and images


def test_flip_twice_is_identity(spark):
    df = spark.createDataFrame([([10, 20, 110, 60],)], "b array<int>")
    row = df.select(V.flip_box(V.flip_box(F.col("b"), 640), 640).alias("b")).head()
    assert row["b"] == [10, 20, 110, 60]


def test_caption_rounds_like_printf(spark):
    values = [i / 10000 for i in range(5000, 9501)]
    got = spark.createDataFrame([(v,) for v in values], "confidence double").select(
        "confidence", V.caption(F.lit("box")).alias("c")).collect()
    assert all(r["c"] == f"box {r['confidence']:.2f}" for r in got)


def test_unknown_class_and_empty_labels(spark):
    df = spark.createDataFrame([(3, []), (42, [])], "i int, l array<struct<label:string,confidence:double>>")
    got = D.shipment_labels(df.withColumn("labels", F.col("l"))).withColumn("n", V.class_name("i")).orderBy("i").collect()
    assert [r["n"] for r in got] == ["drum", "class_42"]
    assert got[0]["primary_category"] == "unknown" and got[0]["confidence"] == 0.0


def test_image_files_and_sidecars(spark, tmp_path):
    for name in ("bay_a", "bay_b"):
        (tmp_path / f"{name}.bmp").write_bytes(bytes.fromhex(BITMAP_8X8) + bytes([0, 0, 200]) * 64)
    (tmp_path / "broken.png").write_bytes(b"not an image")
    images = files.read_images(spark, str(tmp_path))
    assert sorted(r["stem"] for r in images.select("stem").collect()) == ["bay_a", "bay_b"]
    keyed = images.withColumn("image_id", F.length("stem").cast("bigint"))
    row = I.image_stats(keyed).head()
    assert (row["r"], row["g"], row["b"]) == (200.0, 0.0, 0.0)
    side = tmp_path / "json"
    side.mkdir()
    (side / "bay_a.json").write_text(json.dumps({"boxes": [{"label": "box", "bbox": [1, 2, 3, 4]}], "camera": "bay_1"}))
    both = files.with_annotations(images, files.read_annotations(spark, str(side))).orderBy("stem").collect()
    assert both[0]["label"] == "box" and both[0]["bbox"] == [1, 2, 3, 4] and both[1]["label"] is None


# ---------------------------------------------------------------- streams


@pytest.mark.parametrize("batches, micro", [(3, 3), (7, 4), (400, 7)])
def test_triggers_take_whole_batches_and_their_number_is_bounded(spark, batches, micro):
    """Few batches make three triggers or so; many share triggers, so 36 million rows (360 batches) need six and not 360."""
    path = fresh_dir(spark, "numbered")
    rows = spark.range(batches).selectExpr("cast(id AS int) AS batch", "id AS n")
    rows.repartition(1).write.partitionBy("batch").json(path)
    per = continuous._per_trigger(spark, path)
    assert -(-batches // per) == micro and per <= continuous.TRIGGER_BATCHES


def test_json_is_compressed_and_read_back(spark):
    path = tables.write_json(transactions(spark, 30), fresh_dir(spark, "packed"), rows_per_file=10)
    assert all(f.endswith(".json.gz") for f in spark.read.text(path).inputFiles())
    assert tables.read_json(spark, path).count() == 30


def test_running_totals_are_an_upsert_log(spark):
    """Nine batches, the last ones of one region only: they write its keys alone, and snapshots and a restart change no total."""
    rows = transactions(spark, 300)
    path, out, state = (fresh_dir(spark, n) for n in ("in", "totals", "state"))
    tables.write_json(rows.coalesce(1), path, rows_per_file=60)
    exact = lambda df: {(r["region"], r["category"]): r["txn_count"] for r in regional_metrics(df).collect()}
    running = lambda: {(r["region"], r["category"]): r["txn_count"] for r in streams.running_regional_metrics(
        streams.json_stream(spark, path), out, 2, state).collect()}
    assert running() == exact(rows)
    region = rows.first()["region"]
    late = rows.where(F.col("region") == region).limit(12)
    for _ in range(4):
        late.coalesce(1).write.mode("append").json(path)
        rows = rows.union(late)
    assert running() == exact(rows)
    deltas = spark.read.parquet(f"{out}/delta")
    assert [r["batch_id"] for r in deltas.select("batch_id").distinct().orderBy("batch_id").collect()] == list(range(9))
    assert {r["region"] for r in deltas.where("batch_id >= 5").select("region").distinct().collect()} == {region}
    changed = deltas.groupBy("batch_id").count().collect()
    assert all(r["count"] <= late.select("category").distinct().count() for r in changed if r["batch_id"] >= 5)
    assert streams.Records(spark, f"{out}/_snapshots", "upto long").names() == [f"snapshot-{n:012d}" for n in (1, 3, 5, 7)]
    columns = ["region", "category", "txn_count", "total_revenue", "fraud_count"]
    final = streams.running_regional_metrics(streams.json_stream(spark, path), out, 2, state)
    assert final.select(columns).exceptAll(regional_metrics(rows).select(columns)).isEmpty()
    assert streams.running_regional_metrics(streams.json_stream(spark, fresh_dir_with_nothing(spark)), fresh_dir(spark, "none")).count() == 0


def fresh_dir_with_nothing(spark):
    path = fresh_dir(spark, "empty")
    spark.createDataFrame([], "x int").write.json(path)
    return path


def test_a_replayed_batch_leaves_one_result(spark):
    """Batches numbered in the data: a second stream over the same files, in triggers of several files, replaces what the first has written."""
    rows = transactions(spark, 240).withColumn("batch", F.pmod(F.xxhash64("transaction_id"), F.lit(4)).cast("int"))
    path, out = fresh_dir(spark, "in"), fresh_dir(spark, "batches")
    rows.repartition("batch").write.partitionBy("batch").json(path)
    schema = T.StructType([*rows.drop("batch").schema.fields, T.StructField("batch", T.IntegerType())])
    results = [sorted(map(tuple, streams.batch_metrics(streams.json_stream(spark, path, schema, files), out, 1.0, "batch").collect()))
               for files in (1, 3)]
    assert results[0] == results[1] and {r[0] for r in results[0]} == {0, 1, 2, 3}
    ledger = streams.Records(spark, f"{out}/_ledger", "batch_id long, micro_batch long, n long").read().collect()
    assert {r["batch_id"]: r["n"] for r in ledger} == {r["batch"]: r["count"] for r in rows.groupBy("batch").count().collect()}
    assert max(r["micro_batch"] for r in ledger) == 1
    for n in range(4):  # each batch is flagged by its own statistics
        own = [r["price_usd"] for r in rows.where(F.col("batch") == n).collect()]
        mean = sum(own) / len(own)
        std = (sum((v - mean) ** 2 for v in own) / (len(own) - 1)) ** 0.5
        got = streams.regional_metrics(rows.where(F.col("batch") == n)).count()
        assert got == len([r for r in results[0] if r[0] == n])
        flags = spark.read.parquet(out).where(F.col("batch_id") == n).agg(F.sum("anomaly_count")).head()[0]
        assert flags == sum(abs(v - mean) > std for v in own)


def test_stream_resumes_from_its_checkpoint(spark):
    path, out, state = (fresh_dir(spark, n) for n in ("in", "out", "state"))
    transactions(spark, 40).coalesce(1).write.json(path)
    assert streams.run_to_parquet(streams.json_stream(spark, path), out, state).count() == 40
    transactions(spark, 25).coalesce(1).write.mode("append").json(path)
    assert streams.run_to_parquet(streams.json_stream(spark, path), out, state).count() == 65


# ---------------------------------------------------------------- null groups and small amounts


def test_sub_cent_amounts_are_kept(spark):
    df = spark.range(1000).selectExpr("cast(id as string) AS transaction_id", "'EU' AS region", "'food' AS category", "0.004D AS price_usd",
                                      "0 AS is_fraud", "0 AS is_defect", "0.123456789D AS market_index")
    row = regional_metrics(df).head()
    assert (row["total_revenue"], row["avg_price"], row["avg_market_index"]) == (4.0, 0.004, 0.123456789)
    assert regional_summary(df).head()["total_revenue"] == 4.0


def test_null_groups_keep_their_rows(spark):
    from stockyard.operators import ordering, sampling

    df = spark.range(40).selectExpr("id", "CASE WHEN id % 4 > 0 THEN id % 4 END AS g", "cast(id as double) AS v")
    ranks = ordering.rank_within(df, ["g"], ["id"], "r", group_size="n").collect()
    assert len(ranks) == 40 and all(r["r"] == r["id"] // 4 and r["n"] == 10 for r in ranks)
    sums = ordering.running_sums(df, ["g"], ["id"], {"s": "v"}).collect()
    assert len(sums) == 40 and {r["g"]: r["s_total"] for r in sums}[None] == sum(range(0, 40, 4))
    assert ordering.exact_quantiles(df, ["g"], "v", {"m": 0.5}).count() == 4
    assert sampling.split_stratified(df, "id", "g", 0.2, 1).count() == 40
    boxes = spark.range(40).selectExpr("id AS det_id", "CASE WHEN id % 4 > 0 THEN id % 4 END AS frame", "id AS x", "id AS y",
                                       "40L AS w", "40L AS h", "1600L AS area", "'a' AS class_name")
    assert D.classify_boxes(boxes).count() == 40
    assert D.inventory_snapshot(boxes).where("object_count = 10").count() == 40
    tracks = D.asset_tracks(D.classify_boxes(boxes).withColumn("class_name", F.lit(None).cast("string")))
    assert tracks.count() == 40
    assert D.tail_sample(df, "g", "id", "v", 0.5, 2).where("g IS NULL").count() == 2


def test_jdbc_scan_wants_partitions(spark):
    with pytest.raises(ValueError):
        tables.read_jdbc(spark, "jdbc:none", "t")


def test_registry_overview_and_registration(spark):
    from pyspark.ml import PipelineModel

    store = FeatureStore(spark, fresh_dir(spark, "store"))
    for name in ("a", "b"):
        store.register(name, spark.range(5).selectExpr("id", f"id AS {name}"))
    store.compile_unified(["a", "b"], key=["id"])
    row = store.overview().where("kind = 'compilation'").head()
    assert (list(row["tags"]), row["n_features"], row["n_rows"]) == (["a", "b"], 3, 5)
    log = RunLog(spark, fresh_dir(spark, "runs"))
    run = log.register("first", {"depth": 3}, spark.createDataFrame([("rmse", 1.5)], "metric string, value double"), PipelineModel([]))
    assert log.table("runs").where(F.col("run_id") == run).count() == 1 and log.table("params").where("param = 'depth'").count() == 1
