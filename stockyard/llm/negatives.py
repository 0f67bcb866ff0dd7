"""Hard negatives by slot-decomposed selection.

A positive with score s allows negatives whose score lies in a window [s·low, s·high].  The windows of an anchor's positives
overlap, but their upper ends cut the scores into disjoint slots: slot i reaches from the i-th highest end down to
the next one.  Every pair of an anchor block and a candidate block keeps the best k rows of each slot, the parts are merged slot
by slot, and what a positive wants is a suffix: the best k of its own slot and all lower ones, down to its window's
lower end.  So one pass over the candidates answers all windows, and nothing but k rows a slot and block is handed on.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from stockyard.llm.topk import quantise
from stockyard.workspace import materialize

#: Rows of a block, which bound a task's memory, and anchors whose scores a task holds at a time.
ANCHOR_ROWS = 2048
CANDIDATE_ROWS = 16_384
AT_ONCE = 128
_NEVER = np.iinfo(np.int64).min


@dataclass(frozen=True)
class Window:
    """Positives of an anchor, negatives of a positive, and the window's ends in percent of the positive's score."""

    positives: int = 5
    negatives: int = 10
    low: int = 30
    high: int = 90


def _packed(rows: DataFrame, size: int, prefix: str) -> DataFrame:
    """Up to ``size`` rows (id, label, vector) of one length in one row, in order of id: ids, and labels and vectors as bytes.
    Each task packs its own rows."""
    names = ["length", f"{prefix}_ids", f"{prefix}_labels", f"{prefix}_vectors"]

    def block(part: list, length: int) -> pa.RecordBatch:
        part.sort(key=lambda r: r[0])
        ids, labels, values = ([r[i] for r in part] for i in range(3))
        return pa.RecordBatch.from_arrays(
            [pa.array([length], pa.int32()), pa.array([ids], pa.list_(pa.int64())),
             *[pa.array([np.array(x, np.int64).tobytes()]) for x in (labels, values)]], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(3))):
                part = held.setdefault(len(row[2]), [])
                part.append(row)
                if len(part) == size:
                    yield block(held.pop(len(row[2])), len(row[2]))
        for length, part in held.items():
            yield block(part, length)

    schema = f"length int, {prefix}_ids array<bigint>, {prefix}_labels binary, {prefix}_vectors binary"
    return rows.select("id", "label", "vector").mapInArrow(run, schema)


def _numbered(blocks: DataFrame, name: str) -> DataFrame:
    """Written blocks with dense numbers; the window sees a number of each block, not its vectors."""
    stored = materialize(blocks.withColumn("_at", F.monotonically_increasing_id()), f"{name}s")
    numbers = stored.select("_at").withColumn(name, (F.row_number().over(W.orderBy("_at")) - 1).cast("long"))
    return materialize(stored.join(numbers, "_at").drop("_at"), f"{name}s")


def _scored(batch: pa.RecordBatch, extra: tuple[str, ...] = ()) -> Iterator[tuple]:
    """Per pair of blocks and slice of anchors: places, ids and labels of the anchors, ids and labels of the candidates (in
    order of id), inner products as whole numbers, and the slice of each extra column (one list entry an anchor)."""
    names = ("length", "a_ids", "a_labels", "a_vectors", "c_ids", "c_labels", "c_vectors", *extra)
    for length, a_ids, a_labels, a_vectors, c_ids, c_labels, c_vectors, *more in zip(*(batch.column(n).to_pylist() for n in names)):
        ai, ci, al, cl = np.array(a_ids), np.array(c_ids), np.frombuffer(a_labels, np.int64), np.frombuffer(c_labels, np.int64)
        a = np.frombuffer(a_vectors, np.int64).reshape(len(ai), length)
        c = np.frombuffer(c_vectors, np.int64).reshape(len(ci), length)
        # a product of doubles is exact as long as no sum can reach 2**53
        exact = float(np.abs(a).max(initial=0)) * float(np.abs(c).max(initial=0)) * length < 2**53
        ct = c.T.astype(np.float64) if exact else c.T
        for start in range(0, len(ai), AT_ONCE):
            at = np.arange(start, min(start + AT_ONCE, len(ai)))
            s = (a[at].astype(np.float64) @ ct).astype(np.int64) if exact else a[at] @ ct
            yield at, ai[at], al[at], ci, cl, s, [x[start:start + AT_ONCE] for x in more]


def _best(s: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of the k highest entries of each row but for ``_NEVER``; ties go to the smaller column."""
    if s.shape[1] > k:
        floor = np.partition(s, s.shape[1] - k, axis=1)[:, s.shape[1] - k]
        i, j = np.nonzero((s >= floor[:, None]) & (s != _NEVER))
    else:
        i, j = np.nonzero(s != _NEVER)
    order = np.lexsort((j, -s[i, j], i))
    i, j = i[order], j[order]
    keep = np.arange(len(i)) - np.searchsorted(i, i, side="left") < k
    return i[keep], j[keep]


def _rows(out: list[list[np.ndarray]], names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x) if x else [], pa.int64()) for x in out], names=names)


def _positives(k: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The k best other rows of an anchor's label in a block."""
    for batch in batches:
        out = [[], [], []]
        for _, ai, al, ci, cl, s, _ in _scored(batch):
            s[(al[:, None] != cl[None, :]) | (ai[:, None] == ci[None, :])] = _NEVER
            i, j = _best(s, k)
            for column, values in zip(out, (ai[i], ci[j], s[i, j])):
                column.append(values)
        yield _rows(out, ["anchor_id", "other_id", "score"])


def _negatives(k: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The k best rows of another label in each slot of an anchor; ``ends``: the slots' upper ends, descending, then the lowest
    score of any window."""
    for batch in batches:
        out = [[], [], [], []]
        for _, ai, al, ci, cl, s, (ends,) in _scored(batch, ("ends",)):
            slots = max(map(len, ends), default=1) - 1
            # an anchor with fewer slots has empty ones at the end
            cuts = np.array([e[:-1] + [e[-1] - 1] * (slots + 2 - len(e)) if e else [_NEVER] * (slots + 1) for e in ends], np.int64)
            s[al[:, None] == cl[None, :]] = _NEVER
            for slot in range(slots):
                inside = np.where((s <= cuts[:, slot, None]) & (s > cuts[:, slot + 1, None]), s, _NEVER)
                i, j = _best(inside, k)
                for column, values in zip(out, (ai[i], np.full(len(i), slot), ci[j], s[i, j])):
                    column.append(values)
        yield _rows(out, ["anchor_id", "slot", "other_id", "score"])


def _first(rows: DataFrame, keys: list[str], k: int) -> DataFrame:
    """The k highest scores of a key, ties to the smaller id; each task cuts its own rows first."""
    rank = F.row_number().over(W.partitionBy(*keys).orderBy(F.desc("score"), "other_id"))
    return rows.withColumn("_rank", rank).where(F.col("_rank") <= k)


def mine(vectors: DataFrame, anchors: DataFrame, window: Window = Window()) -> DataFrame:
    """Hard negatives: ``anchor_id``, ``positive_id``, ``rank`` (from 1), ``negative_id``, ``positive_score``, ``negative_score``.

    Both inputs have ``id`` (long), ``label`` (long) and ``vector`` (array of long).  An anchor's positives are its
    ``window.positives`` best other rows of the same label by inner product; for each, the ``window.negatives`` best rows of another label with
    low · positive score <= 100 · negative score <= high · positive score are returned; ties go to the smaller id, and where there are fewer, all.

    Rows with a null id, label or vector take no part; an id that occurs more than once counts once, with the smallest label and of that the
    smallest vector; only vectors of one length are compared.  A window that holds nothing (any of a negative score) gives no
    row; further columns are not looked at; empty tables give an empty result.  Inner products times 100 must fit a long.
    A label, vector or score that a large part of the rows share changes no task's size: rows are dealt by blocks.
    """
    def rows(df: DataFrame) -> DataFrame:
        named = df.select(F.col("id").cast("long"), F.struct(F.col("label").cast("long").alias("label"), "vector").alias("_row"))
        once = named.where("id IS NOT NULL AND _row.label IS NOT NULL AND _row.vector IS NOT NULL").groupBy("id").agg(F.min("_row").alias("_row"))
        return once.select("id", "_row.label", "_row.vector")

    known = materialize(rows(vectors), "vectors")
    asked = rows(anchors)
    a = _numbered(_packed(asked.repartition(max(1, -(-asked.count() // ANCHOR_ROWS))), ANCHOR_ROWS, "a"), "a_block")
    c = _numbered(_packed(known, CANDIDATE_ROWS, "c"), "c_block")
    n_blocks = c.count()
    widest = known.agg(F.max(F.greatest(F.abs(F.array_max("vector")), F.abs(F.array_min("vector")))).alias("m"),
                       F.max(F.size("vector")).alias("d")).first()
    if 100 * int(widest["m"] or 0) ** 2 * int(widest["d"] or 0) >= 2**63:
        raise ValueError("100 times an inner product may not fit a long")

    def paired(blocks: DataFrame) -> DataFrame:
        every = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(max(n_blocks - 1, 0)).cast("long")))
        return blocks.withColumn("c_block", every).join(c, ["c_block", "length"])

    near = paired(a).mapInArrow(partial(_positives, window.positives), "anchor_id long, other_id long, score long")
    positives = materialize(
        _first(near, ["anchor_id"], window.positives).where("score >= 0")
        .select("anchor_id", F.col("other_id").alias("positive_id"), F.col("score").alias("positive_score"),
                F.expr(f"({window.high}L * score) div 100").alias("upper"), F.expr(f"({window.low}L * score + 99) div 100").alias("lower")),
        "positives")
    ends = positives.groupBy("anchor_id").agg(F.sort_array(F.collect_set("upper"), asc=False).alias("uppers"), F.min("lower").alias("lowest"))
    # a block's anchors in their order, each with the ends of its slots: at most as many as there are positives
    places = a.select("a_block", F.posexplode("a_ids").alias("at", "anchor_id")).join(ends, "anchor_id", "left")
    by_block = places.groupBy("a_block").agg(F.sort_array(F.collect_list(F.struct(
        "at", F.coalesce(F.concat("uppers", F.array("lowest")), F.array().cast("array<bigint>")).alias("ends")))).alias("s"))
    slotted = a.join(by_block.select("a_block", F.col("s.ends").alias("ends")), "a_block")
    parts = paired(slotted).mapInArrow(partial(_negatives, window.negatives), "anchor_id long, slot long, other_id long, score long")
    slots = _first(parts, ["anchor_id", "slot"], window.negatives).groupBy("anchor_id").agg(
        F.sort_array(F.collect_list(F.struct("slot", (-F.col("score")).alias("down"), "other_id"))).alias("slots"))
    # slots follow each other downwards, so what stands from a positive's own slot on is its suffix, merged and in order
    own = F.array_position("uppers", F.col("upper")) - 1
    suffix = F.slice(F.filter("slots", lambda x: x["slot"] >= own), 1, window.negatives)
    answers = positives.join(ends, "anchor_id").join(slots, "anchor_id").select(
        "anchor_id", "positive_id", "positive_score",
        F.posexplode(F.filter(suffix, lambda x: -x["down"] >= F.col("lower"))).alias("_at", "_negative"))
    return answers.select("anchor_id", "positive_id", (F.col("_at") + 1).alias("rank"), F.col("_negative.other_id").alias("negative_id"),
                          "positive_score", (-F.col("_negative.down")).alias("negative_score"))


def moved_label(label: str = "label", vec_id: str = "vec_id") -> Column:
    """The label of the fixed task: one further, mod 10, where the id is divisible by 7."""
    wide = F.col(label).cast("long")
    return F.when(F.col(vec_id) % 7 == 0, (wide + 1) % 10).otherwise(wide)


def op11_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select(
        F.col("vec_id").alias("id"), moved_label().alias("label"), quantise().alias("vector"))
    return mine(table, table.where(F.col("id") % 100 == 0))


ORACLE = """
WITH whole AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (cast(label AS bigint) + 1) % 10 ELSE cast(label AS bigint) END AS label,
         list_transform(embedding, lambda x: cast(floor(256 * cast(x AS double)) AS bigint)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, c.vec_id AS vec_id, a.label = c.label AS same,
         cast(list_sum(list_transform(list_zip(a.v, c.v), lambda p: p[1] * p[2])) AS bigint) AS score
  FROM whole a JOIN whole c ON a.vec_id % 100 = 0 AND a.vec_id <> c.vec_id),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM (
    SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS r FROM scored WHERE same) s WHERE r <= 5),
negatives AS (
  SELECT p.anchor_id, positive_id, n.vec_id AS negative_id, positive_score, n.score AS negative_score,
         cast(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY n.score DESC, n.vec_id) AS int) AS rank
  FROM positives p JOIN scored n ON p.anchor_id = n.anchor_id AND NOT n.same
   AND 30 * positive_score <= 100 * n.score AND 100 * n.score <= 90 * positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM negatives WHERE rank <= 10"""
