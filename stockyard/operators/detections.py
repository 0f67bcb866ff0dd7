"""Operators on detection, label and frame tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from stockyard.functions import scalars as S
from stockyard.functions import vision as V
from stockyard.operators.commerce import with_totals
from stockyard.operators.ordering import exact_quantiles, join_groups, number_rows, rank_within


def classify_boxes(boxes: DataFrame, min_area: int = 800) -> DataFrame:
    """Contour boxes (frame, det_id, x, y, w, h, area) -> class id, class, confidence, xyxy box.

    The class id is the position of the contour in its frame modulo 5, counted before small
    contours are dropped.
    """
    # a frame is a bounded group
    placed = boxes.withColumn("_i", F.row_number().over(W.partitionBy("frame").orderBy("det_id")) - 1)
    return placed.where(F.col("area") >= min_area).select(
        "frame", "det_id", (F.col("_i") % 5).cast("int").alias("class_id"), V.box_class().alias("class_name"),
        V.box_confidence().alias("confidence"), V.xyxy().alias("bbox"), "area")


def first_per_frame(detections: DataFrame, n: int = 10) -> DataFrame:
    """The first n detections of each frame (top-k per group, cut before the shuffle)."""
    order = W.partitionBy("frame").orderBy("det_id")
    return detections.withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= n).drop("_r")


def confident(detections: DataFrame, threshold: float = 0.5) -> DataFrame:
    return detections.where(F.col("confidence") >= threshold)


def inventory_snapshot(boxes: DataFrame, min_area: int = 500) -> DataFrame:
    """Objects above the area with the number of objects in their frame, one row per object."""
    large = boxes.where(F.col("area") > min_area)
    counted = large.withColumn("object_count", F.count(F.lit(1)).over(W.partitionBy("frame")))
    return counted.select("frame", "det_id", V.xyxy().alias("bbox"), "area", "object_count")


def track_counts(detections: DataFrame) -> DataFrame:
    return detections.groupBy("class_name").agg(F.count(F.lit(1)).alias("detections"))


def track_summary(detections: DataFrame, frames: DataFrame) -> DataFrame:
    """total_frames, asset_types and total_detections; ``frames`` also lists frames without detections."""
    per_class = track_counts(detections).agg(F.count(F.lit(1)).alias("asset_types"),
                                             F.coalesce(F.sum("detections"), F.lit(0)).alias("total_detections"))
    total = frames.select("frame").distinct().agg(F.count(F.lit(1)).alias("n")).scalar()
    return per_class.withColumn("total_frames", total)


def asset_tracks(detections: DataFrame) -> DataFrame:
    """Track of every class as ordered rows (class_name, seq, frame, bbox, confidence).

    A class can hold most of the data, so a track is a numbered set of rows, not one array.
    """
    return rank_within(detections, ["class_name"], ["frame", "det_id"], "seq").select(
        "class_name", "seq", "frame", "det_id", "bbox", "confidence")


def sample_frames(frames: DataFrame, every: int = 5) -> DataFrame:
    """Every n-th frame by frame index."""
    return frames.where(F.pmod(F.col("frame"), F.lit(every)) == 0)


def replay_frames(frames: DataFrame, cycles: int = 3) -> DataFrame:
    """The frame list repeated: position = cycle * number of frames + place in the list."""
    placed = number_rows(frames, ["frame"], "_at", total="_n")
    return (placed.withColumn("cycle", F.explode(F.sequence(F.lit(0), F.lit(cycles - 1))))
            .withColumn("position", F.col("cycle") * F.col("_n") + F.col("_at")).drop("_at", "_n"))


def frame_motion(frames: DataFrame) -> DataFrame:
    """Mean and largest absolute change against the previous frame; the first frame has no row."""
    placed = number_rows(frames.select("frame", F.col("vec").cast("array<double>").alias("vec")), ["frame"], "_at")
    before = placed.select((F.col("_at") + 1).alias("_at"), F.col("vec").alias("_old"))
    change = F.zip_with("vec", "_old", lambda a, b: F.abs(a - b))
    return (placed.join(before, "_at").withColumn("_c", change)
            .select("frame", (F.aggregate("_c", F.lit(0.0), lambda s, x: s + x) / F.size("_c")).alias("mean_motion"),
                    F.array_max("_c").alias("max_motion")))


def augment_boxes(detections: DataFrame, copies: int = 3, width: int = 640, seed: int = 42) -> DataFrame:
    """Each box ``copies`` times, mirrored where a hash coin above one half says so."""
    return (detections.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(copies))))
            .withColumn("flipped", S.uniform(S.keyed("frame", F.col("copy"), "flip", seed)) > 0.5)
            .withColumn("bbox", F.when(F.col("flipped"), V.flip_box(F.col("bbox"), width)).otherwise(F.col("bbox"))))


def samples_per_case(df: DataFrame, case: str) -> DataFrame:
    """Rows per case, and their total on every row."""
    counts = df.groupBy(F.col(case).alias("case")).agg(F.count(F.lit(1)).alias("n"))
    return with_totals(counts, total=F.sum("n"))


def top_labels(df: DataFrame, key: str, scores: str, k: int = 5) -> DataFrame:
    """The k most probable labels per row; equal probabilities keep their position order."""
    entries = F.transform(scores, lambda p, i: F.struct((-p).alias("neg"), i.alias("i")))
    top = F.slice(F.array_sort(entries), 1, k)
    return df.select(key, F.posexplode(top).alias("_r", "_e")).select(
        key, (F.col("_r") + 1).alias("rank"), F.concat(F.lit("class_"), F.col("_e.i").cast("string")).alias("label"),
        (-F.col("_e.neg")).alias("probability"))


def best_candidate(df: DataFrame, group: str, candidate: str, score: str) -> DataFrame:
    """Candidate with the highest score per group; the lowest candidate id wins a tie."""
    order = F.struct(F.col(score), -F.col(candidate))
    return df.groupBy(group).agg(F.max_by(candidate, order).alias(candidate), F.max(score).alias(score))


def tail_sample(df: DataFrame, group: str, key: str, value: str, p: float = 0.95, n: int = 3, seed: int = 42) -> DataFrame:
    """n rows per group drawn in hash order among the values above the exact p-quantile."""
    cuts = exact_quantiles(df.select(group, F.col(value).cast("double").alias("_v")), [group], "_v", {"cut": p})
    order = W.partitionBy(group).orderBy("_h", key)
    return (join_groups(df, cuts, [group]).where(F.col(value) > F.col("cut"))
            .withColumn("_h", S.hash_int(S.keyed(key, seed)))
            .withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n).drop("_h"))


def shipment_labels(df: DataFrame, labels: str = "labels") -> DataFrame:
    """Primary label with confidence, the whole label list, and hazmat / fragile flags."""
    first = V.primary_label(F.col(labels))
    return df.withColumns({"primary_category": first["label"], "confidence": first["confidence"],
                           "all_labels": F.col(labels), "is_hazmat": V.has_label(F.col(labels), "hazmat"),
                           "is_fragile": V.has_label(F.col(labels), "fragile")})
