"""Splits, folds and class balancing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockyard.functions import scalars as S
from stockyard.operators.commerce import class_distribution, class_weights
from stockyard.operators.features import fill_zero
from stockyard.operators.neighbors import k_nearest
from stockyard.operators.ordering import number_rows, rank_within
from stockyard.workspace import materialize


def split_random(df: DataFrame, key: str, test_size: float = 0.2, seed: int = 42) -> DataFrame:
    """Add ``split`` = train/test from a hash of the key: repeatable, no shuffle."""
    return df.withColumn("split", F.when(S.uniform(S.keyed(key, seed)) < test_size, "test").otherwise("train"))


def split_stratified(df: DataFrame, key: str, label: str, test_size: float = 0.2, seed: int = 42) -> DataFrame:
    """Exactly round(test_size * n) test rows of every class, chosen in hash order."""
    hashed = df.withColumn("_h", S.hash_int(S.keyed(key, seed)))
    ranked = rank_within(hashed, [label], ["_h", key], "_rank", "_size")
    cut = F.floor(F.col("_size") * F.lit(float(test_size)) + 0.5)
    return (ranked.withColumn("split", F.when(F.col("_rank") < cut, "test").otherwise("train"))
            .drop("_h", "_rank", "_size"))


def assign_folds(df: DataFrame, order: list[str], k: int = 5) -> DataFrame:
    """Contiguous folds 0..k-1 along ``order``; the first n % k folds are one row larger."""
    out = number_rows(df, order, "_no", total="_n")
    size, extra = F.floor(F.col("_n") / k), F.col("_n") % k
    big = extra * (size + 1)
    fold = F.when(F.col("_no") < big, F.floor(F.col("_no") / (size + 1))).otherwise(
        extra + F.floor((F.col("_no") - big) / F.greatest(size, F.lit(1))))
    return out.withColumn("fold", fold.cast("int")).drop("_no", "_n")


def split_head_tail(df: DataFrame, order: list[str], head: float = 0.8) -> DataFrame:
    """``part`` = head for the first int(head * n) rows along ``order``, else tail."""
    out = number_rows(df, order, "_no", total="_n")
    cut = F.floor(F.col("_n") * F.lit(float(head)))
    return out.withColumn("part", F.when(F.col("_no") < cut, "head").otherwise("tail")).drop("_no", "_n")


def smote_target(n_major: int, n_minor: int, ratio: float) -> int:
    """Wanted minority size; 0 < ratio <= 1 so that it never falls below the present size."""
    if not 0 < ratio <= 1:
        raise ValueError("ratio must be in (0, 1]")
    return min(n_major, int(n_minor / ratio))


def smote(df: DataFrame, key: str, features: list[str], label: str, ratio: float = 0.5, seed: int = 42,
          neighbors: int = 5, tile_rows: int = 1024) -> DataFrame:
    """Original rows plus synthetic minority rows x + u * (neighbour - x).

    Columns: key, features, label, origin (original/synthetic).  The new rows are dealt evenly to
    the minority rows (remainder in key order); neighbour and u come from a hash of the key.
    """
    base = fill_zero(df.select(key, *features, label), features)
    counts = {r["label"]: r["n"] for r in class_distribution(base, label).where("label IN (0, 1)").collect()}
    n0, n1 = counts.get(0, 0), counts.get(1, 0)
    original = base.withColumns({c: F.col(c).cast("double") for c in features}).withColumn("origin", F.lit("original"))
    if n1 < 6:
        return original
    missing = smote_target(n0, n1, ratio) - n1
    if missing <= 0:
        return original
    k = min(neighbors, n1 - 1)
    minority = base.where(F.col(label) == 1).select(
        F.col(key).cast("string").alias("id"), F.array(*[F.col(c).cast("double") for c in features]).alias("vec"))
    bases = materialize(k_nearest(minority, k, tile_rows), "neighbours")
    each, extra = divmod(missing, n1)
    copies = F.lit(each)
    if extra:
        bases = number_rows(bases, ["id"], "_no")
        copies = copies + F.when(F.col("_no") < extra, 1).otherwise(0)
    chosen = bases.select(F.col("id").alias("_picked"), F.col("vec").alias("_other"))
    drawn = (bases.where(copies > 0).withColumn("copy", F.explode(F.sequence(F.lit(1), copies)))
             .withColumn("_pick", (S.hash_int(S.keyed("id", F.col("copy"), "neighbour", seed)) % k + 1).cast("int"))
             .withColumn("_picked", F.element_at("neighbors", F.col("_pick"))["id"])
             .withColumn("_u", S.uniform(S.keyed("id", F.col("copy"), "gap", seed)))
             .join(chosen, "_picked"))
    synthetic = drawn.select(
        F.concat_ws("#", "id", F.col("copy").cast("string")).alias(key),
        *[(F.col("vec")[i] + F.col("_u") * (F.col("_other")[i] - F.col("vec")[i])).alias(c)
          for i, c in enumerate(features)],
        F.lit(1).alias(label), F.lit("synthetic").alias("origin"))
    return original.withColumn(key, F.col(key).cast("string")).unionByName(synthetic)


def imbalanced_dataset(df: DataFrame, key: str, features: list[str], label: str, ratio: float = 0.5,
                       use_smote: bool = True, seed: int = 42) -> dict[str, DataFrame]:
    """Rows, class weights, and the class counts before and after resampling."""
    features = [c for c in features if c in df.columns]
    base = fill_zero(df.select(key, *features, label), features)
    rows = smote(base, key, features, label, ratio, seed) if use_smote else base
    return {"rows": rows, "class_weights": class_weights(base, label),
            "original_distribution": class_distribution(base, label),
            "resampled_distribution": class_distribution(rows, label)}
