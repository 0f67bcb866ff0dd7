"""Feature engineering on transaction tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockyard.functions import scalars as S
from stockyard.operators.ordering import exact_quantiles, rank_within, to_long
from stockyard.schema import NUMERIC_COLUMNS
from stockyard.workspace import materialize


def project_available(df: DataFrame, wanted: list[str]) -> DataFrame:
    """The wanted columns that exist, in the wanted order."""
    have = set(df.columns)
    return df.select(*[c for c in wanted if c in have])


def fill_zero(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.fillna(0, subset=[c for c in columns if c in df.columns])


def encode_categories(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Add 0-based codes ``{column: code column}`` in sorted order of the values; null gives -1.

    The rows' distinct combinations are found in one pass, before anything is multiplied; their values are numbered together as one
    table, whatever their number, and joined.
    """
    combinations = df.select(*columns).distinct()
    pairs = combinations.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("_c"), F.col(c).cast("string").alias("_v")) for c in columns])).alias("p")).select("p.*")
    codes = materialize(rank_within(pairs.where("_v IS NOT NULL").distinct(), ["_c"], ["_v"], "_code"), "codes")
    for column, code in columns.items():
        own = codes.where(F.col("_c") == column).select("_v", "_code")
        df = (df.join(own, F.col(column).cast("string") == F.col("_v"), "left")
              .withColumn(code, F.coalesce("_code", F.lit(-1)).cast("int")).drop("_v", "_code"))
    return df


def market_features(df: DataFrame, ts: str = "ts", encode: bool = True) -> DataFrame:
    """Calendar parts, category codes, unit price, cost ratio and log quantity."""
    out = df.withColumn(ts, S.parse_ts(ts))
    if encode:
        out = encode_categories(out, {"region": "region_encoded", "category": "category_encoded"})
    return out.withColumns({
        "month": F.month(ts).cast("int"),
        "day_of_week": F.weekday(ts).cast("int"),
        "price_per_unit": S.price_per_unit(),
        "cost_ratio": S.cost_ratio(),
        "log_quantity": F.log1p("quantity"),
    })


def one_row(stats: DataFrame) -> Column:
    """A one-row aggregate as a struct-valued scalar subquery: no join of any kind."""
    return stats.select(F.struct(*stats.columns).alias("s")).scalar()


def numeric_stats(df: DataFrame, columns: list[str]) -> DataFrame:
    """Mean and population deviation of all columns in one pass and one row."""
    return df.agg(*[e for c in columns for e in (F.avg(c).alias(f"{c}_mean"), F.stddev_pop(c).alias(f"{c}_std"))])


def zscores(df: DataFrame, columns: list[str], suffix: str = "_zscore") -> DataFrame:
    """(x - mean) / (population deviation + 1e-8)."""
    stats = numeric_stats(df, columns)
    return (df.withColumn("_stats", one_row(stats))
            .withColumns({f"{c}{suffix}": (F.col(c) - F.col(f"_stats.{c}_mean")) / (F.col(f"_stats.{c}_std") + 1e-8)
                          for c in columns})
            .drop("_stats"))


def signed_logs(df: DataFrame, columns: list[str], suffix: str = "_log") -> DataFrame:
    return df.withColumns({f"{c}{suffix}": S.signed_log(c) for c in columns})


def enrich_numeric(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """z-score and signed log of every numeric column, statistics from one pass."""
    columns = [c for c in (columns or NUMERIC_COLUMNS) if c in df.columns]
    return signed_logs(zscores(df, columns), columns)


def robust_scale(df: DataFrame, columns: list[str], suffix: str = "_scaled") -> DataFrame:
    """(x - median) / (q3 - q1) with exact quantiles; nulls count as 0, a zero range divides by 1."""
    filled = fill_zero(df, columns)
    quartiles = exact_quantiles(to_long(filled, columns), ["feature"], "value",
                                {"q1": 0.25, "q2": 0.5, "q3": 0.75})
    spread = F.col("q3") - F.col("q1")
    # one entry per column: bounded by the width of the table
    table = quartiles.agg(F.map_from_entries(F.collect_list(F.struct(
        "feature", F.struct(F.col("q2").alias("centre"),
                            F.when(spread == 0, 1.0).otherwise(spread).alias("width"))))).alias("m")).scalar()
    out = filled.withColumn("_scale", table)
    return out.withColumns({
        f"{c}{suffix}": (F.col(c) - F.col("_scale")[c]["centre"]) / F.col("_scale")[c]["width"] for c in columns
    }).drop("_scale")
