"""Run log, model comparison, chart data and stage report as tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockyard.operators.commerce import with_totals


def model_comparison(wide: DataFrame, metrics: list[str], by: str = "model") -> DataFrame:
    return wide.select(by, *[F.col(m).cast("double").alias(m) for m in metrics]).unpivot(
        by, metrics, "metric", "value")


class RunLog:
    """Runs, parameters (as text) and metrics (with step), appended as Parquet."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _append(self, table: str, df: DataFrame) -> None:
        df.write.mode("append").parquet(f"{self.root}/{table}")

    def start(self, run_id: str, run_name: str) -> None:
        self._append("runs", self.spark.createDataFrame([(run_id, run_name)], "run_id string, run_name string"))

    def log_params(self, run_id: str, params: dict) -> None:
        rows = [(run_id, k, str(v)) for k, v in params.items()]
        self._append("params", self.spark.createDataFrame(rows, "run_id string, param string, value string"))

    def log_metrics(self, run_id: str, metrics: DataFrame, step: int | None = None) -> None:
        """``metrics`` has columns metric and value."""
        self._append("metrics", metrics.select(F.lit(run_id).alias("run_id"), "metric", F.col("value").cast("double"),
                                               F.lit(step).cast("int").alias("step")))

    def register(self, run_name: str, params: dict, metrics: DataFrame, model) -> str:
        """Log parameters, metrics and the stored model under one new run; returns its id."""
        run_id = uuid.uuid4().hex
        self.start(run_id, run_name)
        self.log_params(run_id, {**params, "model_path": f"{self.root}/models/{run_id}"})
        self.log_metrics(run_id, metrics)
        model.write().save(f"{self.root}/models/{run_id}")
        return run_id

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/{name}")


def chart_rmse(metrics: DataFrame) -> DataFrame:
    """rmse per model with a flag on the best one (first listed wins a tie)."""
    marked = with_totals(metrics.select("model", "rmse", "ord"), best=F.min_by("model", F.struct("rmse", "ord")))
    return marked.select("model", "rmse", (F.col("model") == F.col("best")).alias("is_best"))


def chart_revenue(summary: DataFrame) -> DataFrame:
    return summary.select("region", (F.col("total_revenue") / 1e6).alias("revenue_musd"))


def chart_fraud_defect(summary: DataFrame) -> DataFrame:
    return summary.select("region", "fraud_count", "defect_count")


def stage_rows(stage: str, values: DataFrame) -> DataFrame:
    """One-row table of results as report rows (stage, key, value); names lose their underscores."""
    names = values.columns
    wide = values.select(*[F.col(c).cast("string").alias(c) for c in names])
    long = wide.unpivot([], names, "key", "value")
    return long.select(F.upper(F.lit(stage)).alias("stage"), F.translate("key", "_", " ").alias("key"), "value")


def write_report(rows: DataFrame, path: str) -> str:
    """Report rows as JSON lines."""
    rows.select(F.to_json(F.struct(*rows.columns)).alias("value")).write.mode("overwrite").text(path)
    return path
