"""The whole job in five stages: ingest, features, training, vision, monitoring.

Each stage leaves its tables below ``root`` and adds rows (stage, key, value) to the report.  The
first failing stage ends the run and is named in the report.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockyard.operators import commerce, detections, drift, image_jobs, sampling, supervised, tracking
from stockyard.operators.cluster import enriched_features
from stockyard.operators.feature_store import FeatureStore
from stockyard.operators.features import market_features
from stockyard.schema import MODEL_FEATURES, TARGET
from stockyard.sources import tables
from stockyard.workspace import spread


@dataclass
class Inputs:
    """Tables the run works on; ``transactions`` carries ``ts`` and the transaction contract."""

    transactions: DataFrame
    warehouses: DataFrame
    images: DataFrame
    boxes: DataFrame
    frames: DataFrame


@dataclass
class Settings:
    """Defaults of a run."""

    test_size: float = 0.2
    folds: int = 5
    trials: int = 10
    smote_ratio: float = 0.5
    drift_threshold: float = 0.15
    horizon_days: int = 30
    trees: int = 200
    depth: int = 6
    rate: float = 0.05
    seed: int = 42
    key: str = "transaction_id"
    space: dict = field(default_factory=lambda: supervised.SEARCH_SPACE)


class Run:
    def __init__(self, spark: SparkSession, inputs: Inputs, root: str, settings: Settings | None = None):
        self.spark, self.inputs, self.root, self.settings = spark, inputs, root.rstrip("/"), settings or Settings()
        self.store = FeatureStore(spark, f"{self.root}/feature_store")
        self.log = tracking.RunLog(spark, f"{self.root}/runs")
        self.report: list[DataFrame] = []

    def _add(self, stage: str, values: DataFrame) -> None:
        self.report.append(tracking.stage_rows(stage, values))

    def ingest(self) -> None:
        path = tables.archive_transactions(market_features(self.inputs.transactions), f"{self.root}/transactions")
        self.rows = tables.merge_partitions(self.spark, path)
        joined = commerce.join_warehouses(self.rows, self.inputs.warehouses)
        flagged = commerce.price_anomalies(self.rows)
        tables.write_parquet(commerce.regional_metrics(flagged, F.sum("is_price_anomaly").alias("anomaly_count")),
                             f"{self.root}/regional_metrics")
        self._add("data ingestion", joined.agg(F.count(F.lit(1)).alias("joined_rows")))
        self._add("data ingestion", tables.read_parquet(self.spark, f"{self.root}/regional_metrics").agg(
            F.count(F.lit(1)).alias("aggregated_rows"), F.sum("txn_count").alias("transactions")))

    def features(self) -> None:
        self.store.register("transaction_features", enriched_features(self.rows, key=self.settings.key), "enriched transactions",
                            ["transactions", "pca"])
        self.enriched = spread(self.store.get("transaction_features"))
        self.store.register("market_features", self.enriched.select(
            "region", "category", "price_usd", "market_index", "market_cluster"), "market columns", ["market"])
        self._add("feature engineering", self.store.groups().agg(
            F.count(F.lit(1)).alias("feature_groups"), F.max(F.size("columns")).alias("enriched_features"),
            F.max("n_rows").alias("rows")))

    def training(self) -> None:
        s = self.settings
        order = ["ts", s.key]
        estimators = supervised.regressors(s.trees, s.depth, s.rate, s.seed)
        self.prices = supervised.train_regressors(self.enriched, s.key, MODEL_FEATURES, TARGET, order, estimators,
                                                  s.test_size, s.folds, s.seed)
        fraud = supervised.train_classifiers(
            self.enriched, s.key, MODEL_FEATURES, "is_fraud",
            estimators=supervised.classifiers(s.trees, s.depth, s.rate, s.seed), test_size=s.test_size,
            train_rows=lambda t: sampling.smote(t, s.key, MODEL_FEATURES, "is_fraud", s.smote_ratio, s.seed).drop("origin"))
        tuned = supervised.tune_regressor(self.enriched, MODEL_FEATURES, TARGET, order, s.trials, s.folds, s.space, s.seed)
        supervised.save_model(self.prices.model(), f"{self.root}/models/best_price_model")
        tables.write_parquet(self.prices.forecast_regions(self.enriched, s.horizon_days), f"{self.root}/forecast")
        self.log.start("price", "register_price_model")
        self.log.log_params("price", tuned["best_params"])
        self.log.log_metrics("price", supervised.comparison(self.prices).where(F.col("model") == self.prices.best))
        for result in (self.prices, fraud):
            rows = supervised.comparison(result)
            self.report.append(rows.select(F.lit("ML TRAINING").alias("stage"), F.concat_ws(" ", "model", "metric").alias("key"),
                                           F.col("value").cast("string").alias("value")))
        self._add("ml training", self.spark.createDataFrame(
            [(self.prices.best, float(tuned["best_value"]))], "best_model string, tuned_rmse double"))

    def vision(self) -> None:
        found = detections.first_per_frame(detections.classify_boxes(self.inputs.boxes))
        quality = image_jobs.image_qa(self.inputs.images, found)
        tables.write_parquet(quality, f"{self.root}/image_qa")
        tables.write_parquet(detections.frame_motion(self.inputs.frames), f"{self.root}/motion")
        written = tables.read_parquet(self.spark, f"{self.root}/image_qa")
        self._add("computer vision", detections.track_summary(found, self.inputs.boxes))
        self._add("computer vision", written.agg(F.count(F.lit(1)).alias("images"),
                                                 F.count_if(F.col("detections") > 0).alias("images_with_objects")))

    def monitoring(self) -> None:
        s = self.settings
        parts = sampling.split_head_tail(self.prices.predict(self.enriched), ["ts", s.key])
        head, tail = parts.where("part = 'head'"), parts.where("part = 'tail'")
        features = drift.feature_drift(head, tail, MODEL_FEATURES, s.drift_threshold)
        predictions = drift.prediction_drift(head, tail, "prediction", s.drift_threshold)
        tables.write_parquet(features, f"{self.root}/feature_drift")
        features = tables.read_parquet(self.spark, f"{self.root}/feature_drift")
        self._add("mlops", drift.drift_summary(features))
        self._add("mlops", predictions.select(F.col("drift_detected").alias("prediction_drift")))
        self._add("mlops", drift.report_text(drift.drift_report(features, MODEL_FEATURES, predictions)).select(
            F.col("report").alias("drift_report")))

    def run_all(self) -> DataFrame:
        """Run the stages in order and write the report; returns its rows."""
        status, error = "success", None
        for stage in (self.ingest, self.features, self.training, self.vision, self.monitoring):
            try:
                stage()
            except Exception as problem:  # recorded, later stages need this one
                status, error = f"failed in {stage.__name__}", str(problem)
                break
        self._add("run", self.spark.createDataFrame([(status, error)], "status string, error string"))
        path = tracking.write_report(reduce(DataFrame.unionByName, self.report), f"{self.root}/report")
        return self.spark.read.schema("stage string, key string, value string").json(path)
