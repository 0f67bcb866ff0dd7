"""Aggregates, joins and anomaly flags on transactions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockyard.functions import scalars as S
from stockyard.operators.features import one_row


def _totals() -> list[Column]:
    return [S.exact_sum("price_usd").alias("total_revenue"), S.exact_avg("price_usd").alias("avg_price"),
            *[F.sum(f"is_{k}").alias(f"{k}_count") for k in ("fraud", "defect")]]


def regional_metrics(df: DataFrame, *more: Column, by: list[str] = ()) -> DataFrame:
    """Region x category (and ``by``): counts, revenue, fraud, defects and mean market index (and ``more`` aggregates)."""
    return df.groupBy(*by, "region", "category").agg(
        F.count("transaction_id").alias("txn_count"), *_totals(), S.exact_avg("market_index", 12).alias("avg_market_index"), *more)


def regional_summary(df: DataFrame) -> DataFrame:
    return df.groupBy("region").agg(F.count(F.lit(1)).alias("txn_count"), *_totals())


def price_anomalies(df: DataFrame, threshold: float = 3.0, column: str = "price_usd",
                    flag: str = "is_price_anomaly", by: str | None = None) -> DataFrame:
    """1 where |x - mean| > threshold x sample deviation (a null deviation counts as 1), of all rows or of those with the same ``by`` (not null)."""
    columns = F.avg(column).alias("mean"), F.coalesce(F.stddev(column), F.lit(1.0)).alias("std")
    gap = F.abs(F.col(column) - F.col("_stats.mean"))
    if by:
        stats = df.groupBy(by).agg(*columns).select(by, F.struct("mean", "std").alias("_stats"))
        known = df.join(stats, by)
    else:
        known = df.withColumn("_stats", one_row(df.agg(*columns)))
    return (known.withColumn(flag, F.when(gap > F.lit(threshold) * F.col("_stats.std"), 1).otherwise(0))
            .drop("_stats"))


def join_warehouses(tx: DataFrame, warehouses: DataFrame) -> DataFrame:
    """Left join on the warehouse id; Catalyst broadcasts the dimension only while it is small."""
    dim = warehouses.select("warehouse_id", F.col("region").alias("warehouse_region"), "capacity", "lat", "lon")
    return tx.join(dim, "warehouse_id", "left")


def fraud_samples(df: DataFrame) -> DataFrame:
    return df.where(F.col("is_fraud") == 1)


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def union_frames(*frames: DataFrame) -> DataFrame:
    """UNION ALL by name; columns missing on one side become null."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def first_rows(df: DataFrame, order: list[str], n: int) -> DataFrame:
    return df.orderBy(*order).limit(n)


def with_totals(summary: DataFrame, **totals: Column) -> DataFrame:
    """Attach totals to every row of a summary of any length, as scalar subqueries."""
    sums = summary.agg(F.struct(*[e.alias(n) for n, e in totals.items()]).alias("t"))
    return summary.withColumn("_totals", sums.scalar()).select("*", *[F.col(f"_totals.{n}").alias(n) for n in totals]).drop("_totals")


def class_distribution(df: DataFrame, label: str) -> DataFrame:
    return df.groupBy(F.col(label).alias("label")).agg(F.count(F.lit(1)).alias("n"))


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Balanced weights n / (k * n_c); the table is read once and the k counts share one row."""
    counts = with_totals(class_distribution(df, label), rows=F.sum("n"), classes=F.count(F.lit(1)))
    return counts.select("label", "n", (F.col("rows") / (F.col("classes") * F.col("n"))).alias("weight"))
