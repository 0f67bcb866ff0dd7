"""Fixed table contracts."""

from pyspark.sql import types as T

# The transaction contract.
TRANSACTION = T.StructType([
    T.StructField("transaction_id", T.StringType(), False),
    T.StructField("timestamp", T.StringType(), False),
    T.StructField("region", T.StringType(), False),
    T.StructField("category", T.StringType(), False),
    T.StructField("quantity", T.IntegerType(), False),
    T.StructField("unit_cost", T.DoubleType(), False),
    T.StructField("price_usd", T.DoubleType(), False),
    T.StructField("warehouse_id", T.StringType(), False),
    T.StructField("supplier_id", T.StringType(), False),
    T.StructField("is_fraud", T.IntegerType(), False),
    T.StructField("is_defect", T.IntegerType(), False),
    T.StructField("shipping_days", T.IntegerType(), False),
    T.StructField("market_index", T.DoubleType(), False),
])

# The annotation document.
ANNOTATION = T.StructType([
    T.StructField("boxes", T.ArrayType(T.StructType([
        T.StructField("label", T.StringType()),
        T.StructField("bbox", T.ArrayType(T.IntegerType())),
    ]))),
    T.StructField("camera", T.StringType()),
])

IMAGE = ("struct<origin:string,height:int,width:int,nChannels:int,mode:int,data:binary>")

# Numeric columns that are enriched, model features, prediction target.
NUMERIC_COLUMNS = ["quantity", "unit_cost", "price_usd", "shipping_days", "market_index"]
MODEL_FEATURES = ["quantity", "unit_cost", "shipping_days", "market_index",
                  "region_encoded", "category_encoded", "log_quantity", "cost_ratio"]
TARGET = "price_usd"


def model_features(leak_free: bool = False) -> list[str]:
    """Feature list; ``cost_ratio`` is computed from the price, so it leaks the target."""
    return [c for c in MODEL_FEATURES if not (leak_free and c == "cost_ratio")]
