"""The driver tables seen through the contracts of this package.

``tx`` sales lines as transactions, ``warehouses`` a small dimension in which one warehouse is
missing, ``det`` contour boxes of frames, ``frames`` vectors, ``img`` 8 x 8 images, ``img_stats``
colour statistics and ``scored`` transactions with predictions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockyard.functions import scalars as S
from stockyard.operators.features import market_features
from stockyard.workspace import materialize, spread


# Column types of the driver tables; a declared schema saves a job per table.
TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
                "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "labels": "doc_id bigint, quality int, toxic int",
}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf}/{name}.parquet")


def tx(spark: SparkSession, sf: str) -> DataFrame:
    t = {n: table(spark, sf, n) for n in ("lineitem", "orders", "customer", "nation", "region", "part")}
    # an order finds its region before it meets its lines, so lines are not shuffled by customer
    placed = (t["orders"].join(t["customer"].join(t["nation"], F.col("c_nationkey") == F.col("n_nationkey"))
                               .join(t["region"], F.col("n_regionkey") == F.col("r_regionkey")), F.col("o_custkey") == F.col("c_custkey"))
              .select("o_orderkey", "o_orderdate", "r_name"))
    joined = (spread(t["lineitem"]).join(placed, F.col("l_orderkey") == F.col("o_orderkey"))
              .join(t["part"], F.col("l_partkey") == F.col("p_partkey")))
    days = F.datediff("l_shipdate", "o_orderdate")
    return joined.select(
        F.concat_ws("-", *[F.col(c).cast("string") for c in ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")],
                    F.col("l_quantity").cast("int").cast("string"),
                    S.cents("l_extendedprice").cast("string")).alias("transaction_id"),
        F.col("l_shipdate").cast("timestamp").alias("ts"), F.col("r_name").alias("region"),
        F.col("p_type").alias("category"), F.col("l_quantity").cast("int").alias("quantity"),
        F.col("p_retailprice").alias("unit_cost"), F.col("l_extendedprice").alias("price_usd"),
        F.concat(F.lit("WH-"), (F.col("l_suppkey") % 11 + 1).cast("string")).alias("warehouse_id"),
        F.concat(F.lit("SUP-"), F.col("l_suppkey").cast("string")).alias("supplier_id"),
        F.when((F.col("l_discount") >= 0.095) & (F.col("l_tax") >= 0.045), 1).otherwise(0).alias("is_fraud"),
        F.when((F.col("l_discount") <= 0.005) & (F.col("l_tax") < 0.055), 1).otherwise(0).alias("is_defect"),
        (F.pmod(days, F.lit(20)) + 1).cast("int").alias("shipping_days"),
        F.round(0.8 + 5 * F.col("l_tax"), 4).alias("market_index"))


#: Columns of ``tx`` that the model features are made of.
FEATURE_INPUT = ["transaction_id", "ts", "region", "category", "quantity", "unit_cost", "price_usd", "shipping_days", "market_index"]


def tx_features(spark: SparkSession, sf: str, *labels: str) -> DataFrame:
    """With ``labels`` only these and what the model features need, joined and written once for queries that read them several times."""
    rows = tx(spark, sf)
    return market_features(materialize(rows.select(*FEATURE_INPUT, *labels), "tx") if labels else rows)


def warehouses(spark: SparkSession, sf: str) -> DataFrame:
    """Ten warehouses summed up from all suppliers; transactions know eleven."""
    region = table(spark, sf, "region")
    slot = F.col("s_suppkey") % 10
    return (table(spark, sf, "supplier").groupBy(slot.alias("slot")).agg(F.sum("s_suppkey").alias("k"))
            .join(region, F.col("slot") % 5 == F.col("r_regionkey"))
            .select(F.concat(F.lit("WH-"), (F.col("slot") + 1).cast("string")).alias("warehouse_id"),
                    F.col("r_name").alias("region"), (5000 + F.col("k") * 7919 % 45000).cast("int").alias("capacity"),
                    (-60 + F.col("k") * 37 % 121).cast("double").alias("lat"),
                    (-150 + F.col("k") * 53 % 301).cast("double").alias("lon")))


def det(spark: SparkSession, sf: str) -> DataFrame:
    e, u = F.col("event_id"), F.col("user_id")
    boxes = table(spark, sf, "events").select(
        e.alias("det_id"), F.floor(e / 16).cast("bigint").alias("frame"), (50 + e * 7 % 350).alias("x"),
        (50 + u % 150).alias("y"), (10 + e * 13 % 171).alias("w"), (10 + e * 17 % 141).alias("h"))
    return boxes.withColumn("area", F.col("w") * F.col("h"))


def frames(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "embeddings").select(F.col("vec_id").alias("frame"), F.col("embedding").alias("vec"), "label")


def img_stats(spark: SparkSession, sf: str) -> DataFrame:
    e = F.col("event_id")
    return table(spark, sf, "events").select(
        e.alias("image_id"), (e * 31 % 256).cast("double").alias("r"), (e * 17 % 256).cast("double").alias("g"),
        (e * 7 % 256).cast("double").alias("b"), (e % 100).cast("double").alias("sd"))


def img(spark: SparkSession, sf: str) -> DataFrame:
    byte = F.transform("embedding", lambda x: F.floor((x.cast("double") + 1) * 127.5).cast("int"))
    pixels = F.transform(byte, lambda v: F.concat(*[F.lpad(F.hex(c), 2, "0") for c in (v, v * 3 % 256, v * 7 % 256)]))
    return table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("image_id"),
        F.struct(F.concat(F.lit("mem://"), F.col("vec_id").cast("string")).alias("origin"), F.lit(8).alias("height"),
                 F.lit(8).alias("width"), F.lit(3).alias("nChannels"), F.lit(16).alias("mode"),
                 F.unhex(F.concat_ws("", pixels)).alias("data")).alias("image"))


def scored(spark: SparkSession, sf: str) -> DataFrame:
    noise = S.hash_int(S.keyed("transaction_id", 42)) % 1000 + 250 * F.col("is_fraud")
    return (tx(spark, sf).withColumn("prob", noise.cast("double") / 1250)
            .select("transaction_id", "ts", "category", F.col("price_usd").alias("y_true"),
                    (F.col("quantity") * F.col("unit_cost") * F.col("market_index")).alias("y_hat"),
                    (F.col("quantity") * F.col("unit_cost")).alias("y_flat"),
                    F.col("is_fraud").alias("label"), "prob",
                    F.when(F.col("prob") >= 0.6, 1).otherwise(0).alias("pred")))
