"""Queries on boxes, labels, frames and images."""

from __future__ import annotations

from pyspark.sql import functions as F

from stockyard.functions import vision as V
from stockyard.operators import detections as D
from stockyard.operators import image_jobs
from stockyard.plans import views
from stockyard.plans.registry import corners, h, query, rounded, u
from stockyard.sources import files, tables
from stockyard.streaming import streams
from stockyard.workspace import fresh_dir, materialize


def _detections(spark, sf):
    return D.classify_boxes(views.det(spark, sf))


def _rounded_conf(df):
    return rounded(df, confidence=9)


@query("SELECT frame, det_id, class_id, class_name, round(confidence, 9) AS confidence, x1, y1, x2, y2, area FROM detections")
def classify_boxes(spark, sf):
    return _rounded_conf(corners(_detections(spark, sf)))


@query("SELECT frame, det_id, class_name, round(confidence, 9) AS confidence FROM detections WHERE confidence >= 0.9::double")
def detections_conf(spark, sf):
    return _rounded_conf(D.confident(_detections(spark, sf), 0.9).select("frame", "det_id", "class_name", "confidence"))


@query("SELECT frame, det_id, class_name FROM capped")
def detections_cap(spark, sf):
    return D.first_per_frame(_detections(spark, sf)).select("frame", "det_id", "class_name")


@query("""SELECT frame, det_id, x AS x1, y AS y1, x + w AS x2, y + h AS y2, area, count(*) OVER (PARTITION BY frame) AS object_count
          FROM det WHERE area > 500""")
def inventory_snapshot(spark, sf):
    return corners(D.inventory_snapshot(views.det(spark, sf)))


@query("""SELECT class_name, count(*) AS detections, (SELECT count(DISTINCT class_name) FROM detections) AS asset_types,
          (SELECT count(*) FROM detections) AS total_detections, (SELECT count(DISTINCT frame) FROM det) AS total_frames
          FROM detections GROUP BY class_name""")
def track_counts(spark, sf):
    det = views.det(spark, sf)
    found = D.classify_boxes(det)
    summary = D.track_summary(found, det).select(F.struct("asset_types", "total_detections", "total_frames").alias("s"))
    return D.track_counts(found).withColumn("s", summary.scalar()).select("class_name", "detections", "s.*")


@query("""SELECT class_name, row_number() OVER (PARTITION BY class_name ORDER BY frame, det_id) - 1 AS seq, frame, x1, y1, x2, y2,
          round(confidence, 9) AS confidence FROM detections""")
def asset_tracks(spark, sf):
    return _rounded_conf(corners(D.asset_tracks(_detections(spark, sf)).drop("det_id")))


@query("SELECT det_id, concat(class_name, ' ', format('{:.2f}', confidence)) AS caption FROM detections")
def box_captions(spark, sf):
    return _detections(spark, sf).select("det_id", V.caption().alias("caption"))


@query("""SELECT det_id, user AS class_id, coalesce((['pallet', 'box', 'crate', 'drum', 'container', 'forklift', 'person', 'truck'])[user + 1],
          concat('class_', user)) AS class_name FROM (SELECT det_id, cast((x + y) % 12 AS int) AS user FROM det) d""")
def class_names(spark, sf):
    ids = views.det(spark, sf).select("det_id", ((F.col("x") + F.col("y")) % 12).cast("int").alias("class_id"))
    return ids.withColumn("class_name", V.class_name("class_id"))


_FLIP = u("concat(frame, '|', copy, '|flip|42')")


@query(f"""SELECT det_id, copy, flipped, CASE WHEN flipped THEN 640 - x2 ELSE x1 END AS x1, y1, CASE WHEN flipped THEN 640 - x1 ELSE x2 END AS x2, y2
  FROM (SELECT *, {_FLIP} > 0.5::double AS flipped FROM (SELECT *, cast(unnest([1, 2, 3]) AS int) AS copy FROM detections) c) f""")
def augment_boxes(spark, sf):
    return corners(D.augment_boxes(_detections(spark, sf)).select("det_id", "copy", "flipped", "bbox"))


@query("SELECT class_name AS \"case\", 3 * count(*) AS n, cast(3 * sum(count(*)) OVER () AS bigint) AS total FROM detections GROUP BY class_name")
def augment_counts(spark, sf):
    return D.samples_per_case(D.augment_boxes(_detections(spark, sf)), "class_name")


@query("""SELECT frame, min(det_id) FILTER (confidence = top) AS det_id, round(max(confidence), 9) AS confidence
  FROM (SELECT *, max(confidence) OVER (PARTITION BY frame) AS top FROM detections) d GROUP BY frame""")
def best_candidate(spark, sf):
    return _rounded_conf(D.best_candidate(_detections(spark, sf), "frame", "det_id", "confidence"))


_LABELS = """concat_ws(',', CASE WHEN r > 150 AND g < 100 THEN 'industrial:0.75' END, CASE WHEN g > 120 THEN 'food:0.65' END,
  CASE WHEN b > 130 THEN 'electronics:0.70' END, CASE WHEN sd > 60 THEN 'fragile:0.55' END)"""
_LABELLED = f"(SELECT *, CASE WHEN {_LABELS} = '' THEN 'apparel:0.50' ELSE {_LABELS} END AS l FROM {{}}) x"


@query(f"SELECT image_id, l AS labels FROM {_LABELLED.format('img_stats')}")
def heuristic_labels(spark, sf):
    return views.img_stats(spark, sf).select("image_id", V.label_text(V.colour_labels()).alias("labels"))


_SHIPMENT = """SELECT image_id, split_part(l, ':', 1) AS primary_category, cast(substr(split_part(l, ',', 1), -4) AS double) AS confidence,
  l AS all_labels, contains(l, 'hazmat') AS is_hazmat, contains(l, 'fragile') AS is_fragile FROM """


def _shipment_columns(df, *more):
    return df.select("image_id", "primary_category", "confidence", V.label_text(F.col("all_labels")).alias("all_labels"),
                     "is_hazmat", "is_fragile", *more)


@query(_SHIPMENT + _LABELLED.format("img_stats"))
def shipment_labels(spark, sf):
    return _shipment_columns(D.shipment_labels(views.img_stats(spark, sf).withColumn("labels", V.colour_labels())))


@query(_SHIPMENT + _LABELLED.format("pixel_stats"))
def classify_images(spark, sf):
    return _shipment_columns(image_jobs.classify_images(views.img(spark, sf)))


# Fixed value: header of an 8 x 8 bitmap with 24 bits per pixel and rows from the top.
BITMAP_8X8 = "424DF60000000000000036000000" "28000000" "08000000" "F8FFFFFF" "01001800" "00000000" "C0000000" + "00" * 16

_STATS = "SELECT image_id, round(r, 6) AS r, round(g, 6) AS g, round(b, 6) AS b, round(sd, 6) AS sd FROM pixel_stats"


@query(_STATS)
def image_stats(spark, sf):
    return rounded(image_jobs.image_stats(views.img(spark, sf)), r=6, g=6, b=6, sd=6)


@query(_STATS.replace("image_id,", "image_id, 8 AS height, 8 AS width, 3 AS channels,"))
def scan_images(spark, sf):
    """Bitmap files written by the tasks, scanned back once by the image reader."""
    folder = fresh_dir(spark, "bitmaps")
    content = views.img(spark, sf).select(F.concat(F.col("image_id").cast("string"), F.lit(".bmp")).alias("file"),
                                          F.concat(F.unhex(F.lit(BITMAP_8X8)), "image.data").alias("content"))
    files.write_files(content, folder, "file", "content").write.parquet(fresh_dir(spark, "bitmap-manifest"))
    found = materialize(files.read_images(spark, folder).withColumn("image_id", F.col("stem").cast("bigint")), "images")
    shape = found.select("image_id", "image.height", "image.width", F.col("image.nChannels").alias("channels"))
    return rounded(shape.join(image_jobs.image_stats(found), "image_id"), r=6, g=6, b=6, sd=6)


@query("""WITH b AS (SELECT frame, class_name, x1, y1, x2, y2, row_number() OVER (PARTITION BY frame ORDER BY det_id) - 1 AS box_no
    FROM capped)
  SELECT f.frame::varchar AS stem, CASE WHEN b.frame IS NOT NULL THEN concat('bay_', f.frame % 3 + 1) END AS camera, cast(box_no AS int) AS box_no,
         class_name AS label, cast(x1 AS int) AS x1, cast(y1 AS int) AS y1, cast(x2 AS int) AS x2, cast(y2 AS int) AS y2
  FROM (SELECT DISTINCT frame FROM det) f LEFT JOIN b ON f.frame = b.frame""")
def scan_annotations(spark, sf):
    """Sidecar documents of every frame with boxes; frames without one keep a row of nulls."""
    det = views.det(spark, sf)
    boxes = D.first_per_frame(D.classify_boxes(det))  # at most ten per frame
    documents = boxes.groupBy("frame").agg(F.transform(
        F.array_sort(F.collect_list(F.struct("det_id", "class_name", "bbox"))),
        lambda x: F.struct(x["class_name"].alias("label"), x["bbox"].alias("bbox"))).alias("boxes"))
    content = F.to_json(F.struct("boxes", F.concat(F.lit("bay_"), (F.col("frame") % 3 + 1).cast("string")).alias("camera")))
    folder = fresh_dir(spark, "sidecars")
    files.write_files(documents.select(F.concat(F.col("frame").cast("string"), F.lit(".json")).alias("file"),
                                       content.cast("binary").alias("content")), folder, "file", "content"
                      ).write.parquet(fresh_dir(spark, "sidecar-manifest"))
    images = det.select(F.col("frame").cast("string").alias("stem")).distinct()
    return corners(files.with_annotations(images, files.read_annotations(spark, folder)))


@query("""SELECT vec_id AS image_id, cast(rank AS int) AS rank, concat('class_', i - 1) AS label, round(p, 9) AS probability FROM (
    SELECT vec_id, i, p, row_number() OVER (PARTITION BY vec_id ORDER BY v DESC, i) AS rank FROM (
      SELECT vec_id, i, v, exp(v) / sum(exp(v)) OVER (PARTITION BY vec_id) AS p FROM dims) a) b WHERE rank <= 5""")
def topk_labels(spark, sf):
    scores = views.table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("image_id"), V.softmax(F.col("embedding").cast("array<double>")).alias("p"))
    return rounded(D.top_labels(scores, "image_id", "p"), probability=9)


@query(f"""WITH c AS (SELECT event_type, quantile_cont(value, 0.95) AS cut FROM events GROUP BY 1)
  SELECT event_type, event_id, value, cast(rank AS int) AS rank, round(cut, 6) AS cut FROM (
    SELECT e.*, cut, row_number() OVER (PARTITION BY e.event_type ORDER BY {h("concat(event_id, '|42')")}, event_id) AS rank
    FROM events e JOIN c ON e.event_type = c.event_type WHERE value > cut) s WHERE rank <= 3""")
def tail_sample(spark, sf):
    out = D.tail_sample(views.table(spark, sf, "events"), "event_type", "event_id", "value")
    return rounded(out.select("event_type", "event_id", "value", "rank", "cut"), cut=6)


@query("SELECT vec_id AS frame, label FROM embeddings WHERE vec_id % 5 = 0")
def sample_frames(spark, sf):
    return D.sample_frames(views.frames(spark, sf), 5).select("frame", "label")


@query("""SELECT vec_id AS frame, cast(cycle AS int) AS cycle, cycle * n + rn AS position FROM (
    SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS rn, count(*) OVER () AS n FROM embeddings) e, range(3) c(cycle)""")
def replay_frames(spark, sf):
    """The replayed frame list sent through a file stream."""
    frames = views.frames(spark, sf).select("frame")
    path = tables.write_json(D.replay_frames(frames, 3), fresh_dir(spark, "replay"))
    return streams.run_to_parquet(streams.json_stream(
        spark, path, "frame bigint, cycle int, position bigint", files_per_batch=None))


@query("""SELECT frame, round(avg(c), 9) AS mean_motion, round(max(c), 9) AS max_motion FROM (
    SELECT vec_id AS frame, abs(v - lag(v) OVER (PARTITION BY i ORDER BY vec_id)) AS c FROM dims) m WHERE c IS NOT NULL GROUP BY frame""")
def frame_motion(spark, sf):
    return rounded(D.frame_motion(views.frames(spark, sf)), mean_motion=9, max_motion=9)


# ---------------------------------------------------------------- image jobs

_OBJECTS = "string_agg(concat(class_name, ':', cast(round(confidence, 3) AS decimal(4,3))), ',' ORDER BY det_id)"


@query(f"""WITH d AS (SELECT frame, count(*) AS n, {_OBJECTS} AS o FROM capped GROUP BY frame),
  s AS ({_SHIPMENT + _LABELLED.format("pixel_stats")})
  SELECT s.*, coalesce(d.n, 0) AS detections, coalesce(d.o, '') AS objects FROM s LEFT JOIN d ON d.frame = s.image_id""")
def image_qa(spark, sf):
    """Per-image report, read from its JSON text."""
    capped = D.first_per_frame(_detections(spark, sf))
    report = image_jobs.image_qa(views.img(spark, sf), capped)
    label = "struct<label:string,confidence:double>"
    r = F.from_json("report", "detections bigint, objects array<struct<class:string,conf:double>>, shipment_labels struct<"
                    f"primary_category:string,confidence:double,all_labels:array<{label}>,is_hazmat:boolean,is_fragile:boolean>")
    text = F.transform("r.objects", lambda o: F.concat(o["class"], F.lit(":"), o["conf"].cast("decimal(4,3)").cast("string")))
    return _shipment_columns(report.withColumn("r", r).select("image_id", "r.detections", F.array_join(text, ",").alias("objects"),
                                                              "r.shipment_labels.*"), "detections", "objects")
