"""Distribution drift between a reference and a current table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockyard.operators.metrics import ks_of_counts, ks_pvalue, ks_statistics, value_counts
from stockyard.operators.ordering import to_long
from stockyard.workspace import materialize


def reference_profile(df: DataFrame, columns: list[str]) -> DataFrame:
    """Mean, sample deviation, minimum and maximum per feature, one pass."""
    columns = [c for c in columns if c in df.columns]
    return to_long(df, columns).groupBy("feature").agg(
        F.avg("value").alias("mean"), F.stddev("value").alias("std"),
        F.min("value").alias("min"), F.max("value").alias("max"))


Pairs = dict[str, tuple[DataFrame, DataFrame]]
_BY = ["pair", "feature"]


def _counts(pairs: Pairs, columns: list[str]) -> DataFrame:
    """Values of all features of all pairs with their counts in both samples, written once: distance and moments come from it."""
    parts = []
    for name, both in pairs.items():
        shared = [c for c in columns if all(c in df.columns for df in both)]
        parts += [to_long(df, shared).withColumns({"pair": F.lit(name), "cur": F.lit(i)}) for i, df in enumerate(both)]
    return materialize(value_counts(reduce(DataFrame.unionByName, parts), "value", "cur", _BY), "value-counts")


def _moments(counts: DataFrame) -> DataFrame:
    """Means of both samples and the reference's size and sum of squared gaps; one row per pair and feature."""
    means = counts.groupBy(*_BY).agg(
        F.try_divide(F.sum(F.col("value") * F.col("_a")), F.sum("_a")).alias("ref_mean"),
        F.try_divide(F.sum(F.col("value") * F.col("_b")), F.sum("_b")).alias("cur_mean"), F.sum("_a").alias("_n"))
    # one row per column asked for
    gaps = counts.join(F.broadcast(means), _BY)
    squares = F.sum(F.col("_a") * F.pow(F.col("value") - F.col("ref_mean"), 2))
    return gaps.groupBy(*_BY).agg(*[F.first(c).alias(c) for c in ("ref_mean", "cur_mean", "_n")], squares.alias("_squares"))


def feature_drifts(pairs: Pairs, columns: list[str], threshold: float = 0.15) -> DataFrame:
    """KS distance, p-value and mean shift in reference sample deviations of every ``pair`` (name: reference and current) and feature, in one job."""
    counts = _counts(pairs, columns)
    deviation = F.sqrt(F.try_divide(F.col("_squares"), F.col("_n") - 1))
    shift = _moments(counts).select(*_BY, (F.abs(F.col("cur_mean") - F.col("ref_mean")) / (deviation + 1e-8)).alias("mean_shift"))
    ks = ks_of_counts(counts, "value", _BY)
    return ks.join(shift, _BY).select(
        *_BY, "ks_statistic", ks_pvalue("ks_statistic", "n_ref", "n_cur").alias("ks_pvalue"), "mean_shift",
        ((F.col("ks_statistic") > threshold) | (F.col("mean_shift") > threshold)).alias("drifted"))


def feature_drift(reference: DataFrame, current: DataFrame, columns: list[str], threshold: float = 0.15) -> DataFrame:
    """:func:`feature_drifts` of one pair."""
    return feature_drifts({"only": (reference, current)}, columns, threshold).drop("pair")


def grouped_drift(df: DataFrame, value: str, current: str, by: list[str]) -> DataFrame:
    """Distance and p-value of one column between the rows with ``current`` 0 and 1 of every group that has both.

    Groups are keys like any others: values are counted per group before a shuffle, and a group is ordered by ranges, so neither their number nor
    the size of one matters.
    """
    ks = ks_statistics(df.withColumn(value, F.col(value).cast("double")), value, current, by)
    return ks.select(*by, "n_ref", "n_cur", "ks_statistic", ks_pvalue("ks_statistic", "n_ref", "n_cur").alias("ks_pvalue"))


def drift_summary(features: DataFrame, by: list[str] = ()) -> DataFrame:
    """Number of drifted features, whether any drifted, and their share."""
    n = F.count_if("drifted")
    return features.groupBy(*by).agg(n.alias("n_drifted"), (n > 0).alias("drift_detected"),
                        (n / F.greatest(F.count(F.lit(1)), F.lit(1))).alias("drift_ratio"))


def prediction_drift(reference: DataFrame, current: DataFrame, column: str, threshold: float = 0.15) -> DataFrame:
    """As for features, but only KS decides and the shift uses the population deviation."""
    counts = _counts({"only": (reference, current)}, [column])
    means = _moments(counts).select(*_BY, F.col("ref_mean").alias("reference_mean"), F.col("cur_mean").alias("current_mean"),
                                    F.sqrt(F.try_divide("_squares", "_n")).alias("_std"))
    ks = ks_of_counts(counts, "value", _BY)
    shift = F.abs(F.col("current_mean") - F.col("reference_mean")) / (F.col("_std") + 1e-8)
    return ks.join(means, _BY).select(
        "ks_statistic", ks_pvalue("ks_statistic", "n_ref", "n_cur").alias("ks_pvalue"), shift.alias("mean_shift"),
        (F.col("ks_statistic") > threshold).alias("drift_detected"), "reference_mean", "current_mean")


# Texts of the report.
TITLE = "=== Model Drift Report ==="
COUNT_LINE = "Features drifted: %d/%d"
FEATURE_LINE = "  [%s] %s: KS=%.4f, shift=%.4f"
PREDICTION_LINE = "Predictions [%s]: KS=%.4f"


def drift_report(features: DataFrame, order: list[str], predictions: DataFrame | None = None) -> DataFrame:
    """Text report as rows (line_no, line); one line per feature, in the given order."""
    spark = features.sparkSession
    head = features.agg(F.format_string(COUNT_LINE, F.count_if("drifted"), F.count(F.lit(1))).alias("line"))
    rank = F.array_position(F.array(*[F.lit(c) for c in order]), F.col("feature"))
    body = features.select(
        (rank + 1).cast("int").alias("line_no"),
        F.format_string(FEATURE_LINE, F.when(F.col("drifted"), "DRIFT").otherwise("OK"),
                        "feature", "ks_statistic", "mean_shift").alias("line"))
    title = spark.range(1).select(F.lit(0).alias("line_no"), F.lit(TITLE).alias("line"))
    lines = title.unionByName(head.withColumn("line_no", F.lit(1))).unionByName(body)
    if predictions is not None:
        tail = predictions.select(
            F.lit(len(order) + 2).alias("line_no"),
            F.format_string(PREDICTION_LINE, F.when(F.col("drift_detected"), "DRIFT").otherwise("OK"),
                            "ks_statistic").alias("line"))
        lines = lines.unionByName(tail)
    return lines


def report_text(lines: DataFrame) -> DataFrame:
    """The report as one text; it has one line per feature, so the row stays small."""
    ordered = F.array_sort(F.collect_list(F.struct("line_no", "line")))
    return lines.agg(F.array_join(F.transform(ordered, lambda x: x["line"]), "\n").alias("report"))
