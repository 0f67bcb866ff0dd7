"""Model quality measures as aggregations."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockyard.operators.ordering import running_sums


def regression_metrics(df: DataFrame, y: str = "y_true", p: str = "y_hat", by: list[str] = ()) -> DataFrame:
    """rmse, mae and r2 in one pass, optionally per model."""
    err = F.col(y) - F.col(p)
    agg = df.groupBy(*by).agg(F.avg(err * err).alias("_mse"), F.avg(F.abs(err)).alias("mae"),
                              F.var_pop(y).alias("_var"))
    r2 = F.when(F.col("_var") > 0, 1 - F.col("_mse") / F.greatest(F.col("_var"), F.lit(5e-324)))
    return agg.select(*by, F.sqrt("_mse").alias("rmse"), "mae",
                      r2.otherwise(F.when(F.col("_mse") == 0, 1.0).otherwise(0.0)).alias("r2"))


def classification_metrics(df: DataFrame, label: str = "label", pred: str = "pred", by: list[str] = ()) -> DataFrame:
    """Accuracy and support-weighted F1 (0 where undefined) from the confusion counts."""
    by = list(by)
    pairs = df.groupBy(*by, label, pred).agg(F.count(F.lit(1)).alias("_n"))
    hit = F.when(F.col(label) == F.col(pred), F.col("_n")).otherwise(0)
    per_class = (pairs.select(*by, F.explode(F.array(
        F.struct(F.col(label).alias("cls"), F.col("_n").alias("support"), F.lit(0).cast("bigint").alias("called"),
                 hit.cast("bigint").alias("hits")),
        F.struct(F.col(pred).alias("cls"), F.lit(0).cast("bigint").alias("support"), F.col("_n").alias("called"),
                 F.lit(0).cast("bigint").alias("hits")))).alias("c"))
        .groupBy(*by, "c.cls")
        .agg(F.sum("c.support").alias("support"), F.sum("c.called").alias("called"), F.sum("c.hits").alias("hits")))
    f1 = 2 * F.col("hits") / (F.col("support") + F.col("called"))
    total = F.sum("support")
    return per_class.groupBy(*by).agg((F.sum("hits") / total).alias("accuracy"),
                                      (F.sum(F.col("support") * f1) / total).alias("f1"))


def roc_auc(df: DataFrame, label: str = "label", score: str = "prob", by: list[str] = ()) -> DataFrame:
    """Area under the ROC curve with ties counted half; null unless both classes occur.

    Rank sum over counts per distinct score: sum of pos * (2 * negatives below + negatives tied).
    """
    by = list(by) or ["_all"]
    base = df if by != ["_all"] else df.withColumn("_all", F.lit(1))
    counts = base.groupBy(*by, score).agg(
        F.sum(F.when(F.col(label) == 1, 1).otherwise(0)).alias("_pos"),
        F.sum(F.when(F.col(label) == 0, 1).otherwise(0)).alias("_neg"))
    run = running_sums(counts, by, [score], {"_below": "_neg"})
    wins = F.col("_pos").cast("decimal(18,0)") * (2 * F.col("_below") - F.col("_neg")).cast("decimal(19,0)")
    pairs = 2.0 * F.sum("_pos").cast("double") * F.sum("_neg")
    out = run.groupBy(*by).agg(
        F.when((F.sum("_pos") > 0) & (F.sum("_neg") > 0),
               F.sum(wins).cast("double") / F.greatest(pairs, F.lit(1.0))).alias("roc_auc"))
    return out.drop("_all")


def cv_summary(fold_mse: DataFrame, by: list[str] = ()) -> DataFrame:
    """Root of the mean fold error and root of the deviation of the fold errors (population)."""
    return fold_mse.groupBy(*by).agg(F.sqrt(F.avg("mse")).alias("cv_rmse_mean"),
                                     F.sqrt(F.stddev_pop("mse")).alias("cv_rmse_std"))


def fold_errors(df: DataFrame, y: str = "y_true", p: str = "y_hat", fold: str = "fold", by: list[str] = ()) -> DataFrame:
    err = F.col(y) - F.col(p)
    return df.groupBy(*by, fold).agg(F.avg(err * err).alias("mse"))


def best_model(metrics: DataFrame, metric: str = "rmse", order: str = "ord", model: str = "model") -> DataFrame:
    """Model with the lowest metric; the first one listed wins a tie."""
    return metrics.agg(F.min_by(model, F.struct(metric, order)).alias("best_model"),
                       F.min(metric).alias("best_score"))


def value_counts(df: DataFrame, value: str, current: str, by: list[str]) -> DataFrame:
    """How often each value occurs in the reference (_a) and in the current sample (_b); ``current`` is 0/1."""
    return df.where(F.col(value).isNotNull()).groupBy(*by, value).agg(
        F.sum(F.when(F.col(current) == 0, 1).otherwise(0)).alias("_a"),
        F.sum(F.when(F.col(current) == 1, 1).otherwise(0)).alias("_b"))


def ks_statistics(df: DataFrame, value: str, current: str, by: list[str]) -> DataFrame:
    """Two-sample Kolmogorov-Smirnov distance and sample sizes; ``current`` is 0/1."""
    return ks_of_counts(value_counts(df, value, current, by), value, by)


def ks_of_counts(counts: DataFrame, value: str, by: list[str]) -> DataFrame:
    run = (running_sums(counts, by, [value], {"_ca": "_a", "_cb": "_b"})
           .withColumnsRenamed({"_ca_total": "n_ref", "_cb_total": "n_cur"}))
    gap = F.abs(F.col("_ca") / F.col("n_ref") - F.col("_cb") / F.col("n_cur"))
    return (run.where("n_ref > 0 AND n_cur > 0").groupBy(*by)
            .agg(F.max(gap).alias("ks_statistic"), F.max("n_ref").alias("n_ref"), F.max("n_cur").alias("n_cur")))


#: Largest sample for which the tail is counted exactly; beyond it (fixed value of the usual two-sample test) a limit with corrections answers.
EXACT_SAMPLE = 10_000


def _lattice_tail(h: int, n: int, m: int) -> float:
    """Chance that |i/n - j/m| reaches h / lcm(n, m) somewhere on a random lattice path from (0, 0) to (n, m).

    Paths are followed by diagonals s = i + j: a path to (i, s - i) came from (i - 1, s - i) with chance i / s.  Points inside the band hold the
    chance to have left it before, all others 1; only the band is kept, so the work is at most (n + m) x the smaller sample.
    """
    n, m = sorted((n, m))
    g = math.gcd(n, m)
    a, b = n // g, m // g  # (i, j) is inside the band while |i b - j a| < h
    left = np.ones(n + 2)  # left[i + 1] belongs to i
    if h <= 0:
        return 1.0
    left[1] = 0.0
    low = high = 0
    for s in range(1, n + m + 1):
        new_low = max((s * a - h) // (a + b) + 1, 0, s - m)
        new_high = min(-((-s * a - h) // (a + b)) - 1, n, s)
        if new_low > new_high:
            return 1.0
        i = np.arange(new_low, new_high + 1)
        inside = (left[new_low:new_high + 1] * i + left[new_low + 1:new_high + 2] * (s - i)) / s
        left[low + 1:high + 2] = 1.0
        left[new_low + 1:new_high + 2] = inside
        low, high = new_low, new_high
    return float(left[n + 1])


def _durbin_cdf(n: int, d: float) -> float:
    """Chance that the distance of n uniform values from their distribution stays below d: a power of a small matrix."""
    k = int(n * d) + 1
    size, gap = 2 * k - 1, k - n * d
    i = np.arange(size)
    fact = np.array([math.lgamma(x + 1) for x in range(size + 2)])
    step = np.where(i[:, None] - i[None, :] + 1 >= 0, np.exp(-fact[np.maximum(i[:, None] - i[None, :] + 1, 0)]), 0.0)
    edge = gap ** (i + 1.0) * np.exp(-fact[i + 1])
    step[:, 0] -= edge
    step[-1, :] -= edge[::-1]
    step[-1, 0] += max(2 * gap - 1, 0.0) ** size * math.exp(-fact[size])
    total, power, scale, shift = np.eye(size), step, 0.0, 0.0
    for bit in bin(n)[:1:-1]:
        if bit == "1":
            total, scale = total @ power, scale + shift
        power, shift = power @ power, 2 * shift
        largest = np.abs(power).max()
        power, shift = power / largest, shift + math.log(largest)
        largest = np.abs(total).max()
        total, scale = total / largest, scale + math.log(largest)
    value = total[k - 1, k - 1]
    return math.exp(math.log(value) + scale + math.lgamma(n + 1) - n * math.log(n)) if value > 0 else 0.0


def _limit_cdf(n: int, d: float) -> float:
    """The same for large n: Kolmogorov's limit with the corrections of order n^-1/2, n^-1 and n^-3/2 (Pelz and Good)."""
    z = d * math.sqrt(n)
    k = np.arange(-60, 61)
    q, r = (k + 0.5) ** 2 * math.pi ** 2, k ** 2 * math.pi ** 2
    e, f, c = np.exp(-q / (2 * z * z)), np.exp(-r / (2 * z * z)), math.sqrt(math.pi / 2)
    first = ((q - z * z) * e).sum() * c / (6 * z ** 4)
    second = (((6 * z ** 6 + 2 * z ** 4) + (2 * z ** 4 - 5 * z * z) * q + (1 - 2 * z * z) * q * q) * e).sum() * c / (72 * z ** 7) - (
        r * f).sum() * c / (36 * z ** 3)
    third = ((q ** 3 * (5 - 30 * z * z) + q * q * (212 * z ** 4 - 60 * z * z) + q * (135 * z ** 4 - 96 * z ** 6)
              - 30 * z ** 6 - 90 * z ** 8) * e).sum() * c / (6480 * z ** 10) + (r * (3 * z * z - r) * f).sum() * c / (216 * z ** 6)
    return c / z * e.sum() + first / math.sqrt(n) + second / n + third / n ** 1.5


def ks_tail(d: float, n: int, m: int) -> float:
    """Two-sided p-value of a two-sample distance d between samples of n and m values.

    Exact up to EXACT_SAMPLE values a side; beyond, the tail of the one-sample distance at the effective size nm / (n + m), exact again up to 500.
    """
    if max(n, m) <= EXACT_SAMPLE:
        return _lattice_tail(round(d * (n // math.gcd(n, m) * m)), n, m)
    size = max(1, int(np.round(n * m / (n + m))))
    z2 = size * d * d
    if size * d <= 0.5:
        return 1.0
    if z2 >= 370 or d >= 1:
        return 0.0
    if z2 < 0.02 * min(1.0, size / 500):  # below, the tail is 1 to more than twelve digits
        return 1.0
    return min(1.0, max(0.0, 1.0 - (_durbin_cdf(size, d) if size <= 500 else _limit_cdf(size, d))))


def _ks_tails(d: pd.Series, n: pd.Series, m: pd.Series) -> pd.Series:
    return pd.Series([None if pd.isna(x) or not (a > 0 and b > 0) else ks_tail(float(x), int(a), int(b)) for x, a, b in zip(d, n, m)], dtype="float64")


def ks_pvalue(d: Column | str, n: Column | str, m: Column | str) -> Column:
    """p-values of two-sample distances (:func:`ks_tail`), one for each row of distance and sample sizes; null without samples."""
    return F.pandas_udf(_ks_tails, T.DoubleType())(d, n, m)
