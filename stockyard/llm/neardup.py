"""Near-duplicates by MinHash bands, sequential Bayesian verification and exact confirmation.

Copies (equal shingle sets) are one class before anything is compared.  Class representatives meet in
buckets of equal bands.  A pair is compared signature batch by signature batch and given up as soon as the
posterior probability that its similarity reaches the threshold falls below the miss probability; whatever
survives is confirmed on full shingle sets.

A bucket's members are first compared with one pivot, which settles groups of copies at the cost of their number.
Where members of one bucket are then still in different components, the bucket is cut into
blocks of bounded size and every block meets every other of its bucket inside a task, skipping pairs already connected and
pairs that an earlier band brings together; a task hands on no more links than it has members.  No bucket is capped.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockyard.llm.graph import components
from stockyard.llm.texts import MULTIPLIERS, hash_runs, hash_words, map_texts, mix
from stockyard.workspace import materialize

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
#: Members of a block.
BLOCK = 256


def shingles(text: bytes | None, size: int = 5) -> np.ndarray:
    """Sorted distinct 64-bit hashes of all runs of ``size`` words; of fewer words, of the whole sequence."""
    words = hash_words(text.translate(_LOWER).split()) if text else np.empty(0, np.uint64)
    n = len(words)
    if n < size:
        return mix(hash_runs(words, n) + MULTIPLIERS[n]) if n else words
    return np.unique(hash_runs(words, size))


@dataclass(frozen=True)
class Plan:
    """Similarity threshold in percent, and the chance to miss a pair exactly at it: of finding no common band, and
    of giving up in any one comparison step."""

    percent: int = 80
    size: int = 5
    miss: float = 1e-6
    batch: int = 32

    @cached_property
    def rows(self) -> int:
        """Hashes per band: as many as leave a pair at the threshold a quarter chance to share a band."""
        return max(1, round(math.log(0.27) / math.log(min(0.99, self.percent / 100))))

    @cached_property
    def bands(self) -> int:
        return math.ceil(math.log(self.miss) / math.log(1 - (self.percent / 100) ** self.rows))

    @cached_property
    def hashes(self) -> tuple[np.ndarray, np.ndarray]:
        draw = np.random.Generator(np.random.PCG64(7))
        n = self.rows * self.bands
        return draw.integers(0, 2**31, n, np.uint32) * np.uint32(2) + np.uint32(1), draw.integers(0, 2**32, n, np.uint32)

    def signature(self, hashes: np.ndarray) -> np.ndarray:
        factor, shift = self.hashes
        half = len(factor) // 2
        low, high = hashes.astype(np.uint32), (hashes >> np.uint64(32)).astype(np.uint32)
        out = np.full(len(factor), 0xFFFFFFFF, np.uint32)
        for i in range(0, len(hashes), 512):
            for part, x in ((slice(0, half), low), (slice(half, None), high)):
                values = x[i:i + 512, None] * factor[None, part] + shift[None, part]
                np.minimum(out[part], values.min(axis=0), out=out[part])
        return out

    def keys(self, signature: np.ndarray) -> np.ndarray:
        """One bucket number per band."""
        by_band = signature.reshape(self.bands, self.rows).astype(np.uint64)
        return mix((by_band * MULTIPLIERS[:self.rows]).sum(axis=1, dtype=np.uint64)
                   + np.arange(self.bands, dtype=np.uint64) * MULTIPLIERS[63]).astype(np.int64)

    @cached_property
    def cuts(self) -> list[tuple[int, int]]:
        """(hashes compared, fewest matches to go on).  With a uniform prior the posterior after m matches of n is a
        beta distribution, and P(similarity >= t) is the chance of at most m successes in n + 1 trials at t."""
        t, out = self.percent / 100, []
        n_all = self.rows * self.bands
        for n in [*range(self.batch, n_all, self.batch), n_all]:
            total, m = (1 - t) ** (n + 1), 0
            while total < self.miss:
                m += 1
                total += math.comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)
            out.append((n, m))
        return out

    def survivors(self, a: np.ndarray, b: np.ndarray, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of the pairs of rows (a[i], b[j]) of signatures those not given up, and their matches."""
        matches, seen = np.zeros(len(i), np.int64), 0
        for n, least in self.cuts:
            matches = matches + np.count_nonzero(a[i, seen:n] == b[j, seen:n], axis=1)
            on = matches >= least
            i, j, matches, seen = i[on], j[on], matches[on], n
        return i, j, matches

    def linked(self, a: np.ndarray, b: np.ndarray) -> bool:
        if 100 * min(len(a), len(b)) < self.percent * max(len(a), len(b)):
            return False
        common = len(np.intersect1d(a, b, assume_unique=True))
        return 100 * common >= self.percent * (len(a) + len(b) - common)


def _sketches(docs: DataFrame, plan: Plan) -> DataFrame:
    def batch(texts: list[bytes | None]) -> dict:
        sets = [shingles(t, plan.size) for t in texts]
        return {"n_shingles": [len(s) for s in sets],
                "set_key": [xxhash.xxh3_128_digest(s.tobytes()) for s in sets],
                "buckets": [plan.keys(plan.signature(s)).tolist() if len(s) else [] for s in sets]}

    return map_texts(docs, "text", ["id"], "n_shingles long, set_key binary, buckets array<long>", batch)


def _plausible(pairs: DataFrame, texts: DataFrame, plan: Plan) -> DataFrame:
    """The pairs (a, b) that sequential verification does not give up."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(n, -1) for c in ("sa", "sb"))
            kept = pa.array(np.sort(plan.survivors(a, b, np.arange(n), np.arange(n))[0]))
            yield pa.RecordBatch.from_arrays([batch.column("a").take(kept), batch.column("b").take(kept)], names=["a", "b"])

    side = {s: texts.select(F.col("id").alias(s), F.col("signature").alias(f"s{s}")) for s in "ab"}
    return (pairs.join(side["b"], "b").join(side["a"], "a").select("a", "b", "sa", "sb")
            .mapInArrow(run, T.StructType([pairs.schema["a"], pairs.schema["b"]])))


def _confirmed(pairs: DataFrame, texts: DataFrame, plan: Plan) -> DataFrame:
    """The pairs (a, b) whose whole sets are similar enough."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = (None, None)
        for batch in batches:
            keep = []
            for i, (ta, tb) in enumerate(zip(*(batch.column(c).cast(pa.binary()).to_pylist() for c in ("ta", "tb")))):
                if last[0] != tb:  # rows come in runs of one pivot
                    last = (tb, shingles(tb, plan.size))
                if plan.linked(shingles(ta, plan.size), last[1]):
                    keep.append(i)
            take = pa.array(keep, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("a").take(take), batch.column("b").take(take)], names=["a", "b"])

    side = {s: texts.select(F.col("id").alias(s), F.col("text").alias(f"t{s}")) for s in "ab"}
    return (pairs.join(side["a"], "a").join(side["b"], "b").select("a", "b", "ta", "tb")
            .mapInArrow(run, T.StructType([pairs.schema["a"], pairs.schema["b"]])))


def _within_buckets(members: DataFrame, texts: DataFrame, plan: Plan, block: int) -> DataFrame:
    """Links (a, b) that join different components inside buckets; ``members`` has bucket, id, component."""
    sizes = members.groupBy("bucket").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("_blocks"))
    placed = members.join(sizes, "bucket").withColumn("_block", F.pmod(F.xxhash64("id"), F.col("_blocks")))
    rows = placed.join(texts.select("id", "signature", "keys", "text"), "id")
    member = F.struct("id", "component", "signature", "keys", "text")
    # a block holds about BLOCK members: ids are dealt by their hash
    blocks = rows.groupBy("bucket", "_blocks", "_block").agg(F.collect_list(member).alias("left"))
    others = (blocks.where("_block < _blocks - 1")
              .withColumn("_other", F.explode(F.sequence(F.col("_block") + 1, F.col("_blocks") - 1)))
              .join(blocks.select("bucket", F.col("_block").alias("_other"), F.col("left").alias("right")), ["bucket", "_other"]))
    work = blocks.select("bucket", "left", F.lit(None).cast(blocks.schema["left"].dataType).alias("right")).union(
        others.select("bucket", "left", "right"))
    schema = "a long, b long"

    def columns(block: pa.ListScalar) -> dict:
        table = block.values
        n = len(table)
        return {"id": table.field("id").to_pylist(), "component": table.field("component").to_pylist(),
                "signature": np.frombuffer(b"".join(table.field("signature").to_pylist()), np.uint8).reshape(n, -1),
                "keys": np.frombuffer(b"".join(table.field("keys").to_pylist()), np.int64).reshape(n, -1),
                "text": table.field("text"), "sets": {}}

    def set_of(side: dict, i: int) -> np.ndarray:
        if i not in side["sets"]:
            side["sets"][i] = shingles(side["text"][i].cast(pa.binary()).as_py(), plan.size)
        return side["sets"][i]

    def links(bucket: int, left: dict, right: dict) -> Iterator[tuple]:
        root = {c: c for c in (*left["component"], *right["component"])}

        def find(c):
            while root[c] != c:
                root[c] = root[root[c]]
                c = root[c]
            return c

        number = {c: k for k, c in enumerate(root)}
        mine, theirs = (np.array([number[c] for c in side["component"]]) for side in (left, right))
        differ = mine[:, None] != theirs[None, :]
        i, j = np.nonzero(np.triu(differ) if left is right else differ)
        i, j, matches = plan.survivors(left["signature"], right["signature"], i, j)
        band = int(np.argmax(left["keys"][0] == bucket))
        first = ~(left["keys"][i, :band] == right["keys"][j, :band]).any(axis=1)
        for k in np.argsort(-matches[first], kind="stable").tolist():
            x, y = int(i[first][k]), int(j[first][k])
            a, b = find(left["component"][x]), find(right["component"][y])
            if a != b and plan.linked(set_of(left, x), set_of(right, y)):
                root[a] = b
                yield left["id"][x], right["id"][y]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for bucket, left, right in zip(*(batch.column(c) for c in ("bucket", "left", "right"))):
                one = columns(left)
                found += links(bucket.as_py(), one, columns(right) if right.is_valid else one)
            yield pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], pa.int64()) for k in (0, 1)], names=["a", "b"])

    return work.mapInArrow(run, schema)


def near_duplicates(docs: DataFrame, plan: Plan = Plan(), doc_id: str = "doc_id", text: str = "text",
                    block: int = BLOCK) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id`` (the smallest id a document is linked with, directly or through
    others) and ``kept`` (it is that document), one row per row of ``docs``.  Ids must be whole numbers.

    Words are runs of non-blank characters with A-Z in lower case.  A null, empty or blank text has no shingles and is linked
    with nothing.  A row with a null id takes no part: null component, kept.  Rows that share an id are one
    document, linked through any of their texts.  Further columns make no difference; an empty table gives an empty result.
    """
    source = docs.select(F.col(f"`{doc_id}`").cast("long").alias("id"), F.col(f"`{text}`").cast("string").alias("text"))
    sketches = materialize(_sketches(source, plan), "sketches")
    classes = (sketches.where("n_shingles > 0 AND id IS NOT NULL").groupBy("set_key")
               .agg(F.min("id").alias("id"), F.first("buckets").alias("buckets")))
    classes = materialize(classes, "classes")
    members = classes.select("id", F.explode("buckets").alias("bucket"))
    shared = members.groupBy("bucket").agg(F.min("id").alias("pivot"), F.max("id").alias("_last")).where("pivot <> _last").drop("_last")
    members = materialize(members.join(shared, "bucket"), "members")

    def signatures(texts: list[bytes | None]) -> dict:
        whole = [plan.signature(shingles(t, plan.size)) for t in texts]
        return {"signature": [s.astype(np.uint8).tobytes() for s in whole], "keys": [plan.keys(s).tobytes() for s in whole]}

    # both sides grow with the corpus: merged at every size, never sent to all tasks
    wanted = source.join(members.select("id").distinct().hint("merge"), "id", "left_semi")
    texts = materialize(map_texts(wanted.select("id", "text", F.col("text").alias("_t")), "_t", ["id", "text"],
                                  "signature binary, keys binary", signatures), "texts")

    pairs = materialize(members.where("id <> pivot").select(F.col("id").alias("a"), F.col("pivot").alias("b")).distinct(), "pairs")
    plausible = materialize(_plausible(pairs, texts, plan), "plausible")
    links = materialize(_confirmed(plausible, texts, plan), "links")
    labels = components(links).withColumnRenamed("node", "id")
    labelled = members.select("bucket", "id").join(labels, "id", "left").withColumn("component", F.coalesce("component", "id"))
    mixed = labelled.groupBy("bucket").agg(F.min("component").alias("_low"), F.max("component").alias("_high")).where("_low <> _high")
    undecided = materialize(labelled.join(mixed.select("bucket"), "bucket", "left_semi"), "undecided")
    more = materialize(_within_buckets(undecided, texts, plan, block), "links")
    labels = components(links.union(more))
    result = (sketches.join(classes.select("set_key", F.col("id").alias("_first")), "set_key", "left")
              .join(labels.select(F.col("node").alias("_first"), "component"), "_first", "left"))
    component = F.when(F.col("id").isNotNull(), F.when(F.col("n_shingles") > 0, F.coalesce("component", "_first")).otherwise(F.col("id")))
    result = result.select("id", "n_shingles", component.alias("component_id"))
    return result.select(F.col("id").alias(doc_id), "n_shingles", "component_id",
                         F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)).alias("kept"))


def op10_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"), Plan(percent=85))


#: The same by all pairs of classes that share a shingle; components by reach, as the small tables allow.
ORACLE = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN []::VARCHAR[] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_sort(list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')))) END AS s
  FROM words),
keyed AS (SELECT doc_id, s, len(s) AS n, CASE WHEN len(s) > 0 THEN min(doc_id) OVER (PARTITION BY s) ELSE doc_id END AS class FROM sets),
shingle AS (SELECT doc_id AS id, n, unnest(s) AS x FROM keyed WHERE doc_id = class),
link AS (
  SELECT a.id AS a, b.id AS b FROM shingle a JOIN shingle b ON a.x = b.x AND a.id <> b.id
  GROUP BY a.id, b.id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
reach AS (
  SELECT DISTINCT class AS id, class AS other FROM keyed
  UNION SELECT r.id, l.b FROM reach r JOIN link l ON r.other = l.a),
component AS (SELECT id, min(other) AS component_id FROM reach GROUP BY id)
SELECT k.doc_id, k.n AS n_shingles, c.component_id, k.doc_id = c.component_id AS kept
FROM keyed k JOIN component c ON k.class = c.id
"""
