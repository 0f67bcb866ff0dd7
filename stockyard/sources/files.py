"""Image and annotation files: one small file per image."""

from __future__ import annotations

import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockyard.schema import ANNOTATION


def write_files(df: DataFrame, root: str, name: str, content: str) -> DataFrame:
    """Write one file per row (binary column ``content``) below a shared folder; returns the names.

    Runs inside the tasks; a retried task writes the same bytes again.
    """
    def run(batches):
        store, base = fs.FileSystem.from_uri(root)
        store.create_dir(base, recursive=True)
        for pdf in batches:
            for file, data in zip(pdf[name], pdf[content]):
                with store.open_output_stream(f"{base}/{file}") as out:
                    out.write(bytes(data))
            yield pd.DataFrame({"file": pdf[name]})

    return df.select(name, content).mapInPandas(run, "file string")


def read_images(spark: SparkSession, path: str, drop_invalid: bool = True) -> DataFrame:
    """(stem, image) of every image file; undecodable files are dropped or kept as invalid rows."""
    df = spark.read.format("image").option("dropInvalid", drop_invalid).load(path)
    return df.select(stem_of(F.col("image.origin")).alias("stem"), "image")


def stem_of(path):
    """File name without folders and extension."""
    return F.regexp_replace(F.regexp_extract(path, r"([^/]+)$", 1), r"\.[^.]*$", "")


def read_annotations(spark: SparkSession, path: str) -> DataFrame:
    """One row per box of the sidecar documents: (stem, camera, box_no, label, bbox)."""
    docs = (spark.read.schema(ANNOTATION).option("multiLine", True).json(path)
            .select(stem_of(F.col("_metadata.file_name")).alias("stem"), "camera", "boxes"))
    return (docs.select("stem", "camera", F.posexplode("boxes").alias("box_no", "box"))
            .select("stem", "camera", "box_no", "box.label", "box.bbox"))


def with_annotations(images: DataFrame, boxes: DataFrame) -> DataFrame:
    """Images with their boxes by stem; an image without a sidecar keeps one row with null box."""
    return images.join(boxes, "stem", "left")
