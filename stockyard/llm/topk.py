"""Exact top-k inner products by distributed histogram selection.

Vectors are packed into blocks of fixed size and every block of queries meets every block of candidates,
a dense matrix product each.  The first passes only count: each pass sums score histograms over all
blocks and narrows, per query, the interval that holds its k-th best score, until the interval is one score wide.
The last pass keeps the rows at or above that score and breaks ties by id.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from stockyard.workspace import materialize

#: Rows of a block, which bound a task's memory, and bins of a histogram.
QUERY_ROWS = 2048
CANDIDATE_ROWS = 16_384
BINS = 1024


def quantise(vector: str = "embedding", scale: int = 256) -> Column:
    """floor(scale * x) of every component, x as double; null when the vector is null or empty or holds a
    null or non-finite component."""
    wide = F.transform(F.col(f"`{vector}`"), lambda x: x.cast("double"))
    whole = F.forall(wide, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.when(whole & (F.size(wide) > 0), F.transform(wide, lambda x: F.floor(scale * x).cast("long")))


def _blocks(vectors: DataFrame, rows: int, prefix: str) -> DataFrame:
    """Up to ``rows`` vectors of one length packed into one row: ``length``, ``{prefix}_ids`` and
    ``{prefix}_vectors`` (binary).  Each task packs its own rows, so nothing is shuffled."""
    names = ["length", f"{prefix}_ids", f"{prefix}_vectors"]

    def packed(part: list, length: int) -> pa.RecordBatch:
        ids, values = np.array([i for i, _ in part], np.int64), np.array([v for _, v in part], np.int64)
        return pa.RecordBatch.from_arrays([pa.array([length], pa.int32()), pa.array([ids.tobytes()]),
                                           pa.array([values.tobytes()])], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        for batch in batches:
            for i, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                held.setdefault(len(v), []).append((i, v))
                if len(held[len(v)]) == rows:
                    yield packed(held.pop(len(v)), len(v))
        for length, part in held.items():
            yield packed(part, length)

    return vectors.mapInArrow(run, f"length int, {prefix}_ids binary, {prefix}_vectors binary")


def _numbered(blocks: DataFrame, name: str, label: str) -> DataFrame:
    """Written blocks with dense numbers; the window sees one number per block, not the vectors."""
    stored = materialize(blocks.withColumn("_at", F.monotonically_increasing_id()), label)
    numbers = stored.select("_at").withColumn(name, F.row_number().over(W.orderBy("_at")) - 1)
    return materialize(stored.join(numbers, "_at").drop("_at"), label)


def _products(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Whole-number inner products; as a product of doubles, exact below 2**53, wherever that bound holds."""
    most = float(np.abs(q).max(initial=0)) * float(np.abs(c).max(initial=0)) * q.shape[1]
    return (q.astype(np.float64) @ c.astype(np.float64).T).astype(np.int64) if most < 2**53 else q @ c.T


_OWN = np.iinfo(np.int64).min


def _scores(batch: pa.RecordBatch) -> Iterator[tuple]:
    """Per pair of blocks and slice of queries: block number, indexes, query ids, lowest scores that still count,
    candidate ids, scores; a query's score with itself is the smallest integer."""
    columns = [batch.column(n).to_pylist() for n in ("length", "q_ids", "q_vectors", "q_low", "q_block", "c_ids", "c_vectors")]
    for length, q_ids, q_vectors, low, block, c_ids, c_vectors in zip(*columns):
        qi, ci, lows = np.frombuffer(q_ids, np.int64), np.frombuffer(c_ids, np.int64), np.array(low, np.int64)
        q = np.frombuffer(q_vectors, np.int64).reshape(len(qi), length)
        c = np.frombuffer(c_vectors, np.int64).reshape(len(ci), length)
        for a in range(0, len(qi), 128):
            at = np.arange(a, min(a + 128, len(qi)))
            s = _products(q[at], c)
            s[qi[at][:, None] == ci[None, :]] = _OWN
            yield block, at, qi[at], lows[at], ci, s


def _count(k: int, width: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Histogram of each query's scores from the top down to the bin that holds the block's own k-th best: a
    lower bin cannot hold the k-th best of all blocks, so leaving those out loses nothing."""
    for batch in batches:
        out = [[], [], [], []]
        for block, at, _, low, _, s in _scores(batch):
            lo, n = low[:, None], len(at)
            bins = np.where((s != _OWN) & (s >= lo), np.minimum((np.maximum(s, lo) - lo) // width, BINS), -1)
            flat = np.bincount((bins + 1 + np.arange(n)[:, None] * (BINS + 2)).ravel(), minlength=n * (BINS + 2))
            flat = flat.reshape(n, BINS + 2)[:, 1:]
            above = np.cumsum(flat[:, ::-1], axis=1)[:, ::-1] - flat
            i, b = np.nonzero((flat > 0) & (above < k))
            out[0].append(np.full(len(i) + n, block, np.int64))
            out[1].append(np.concatenate([at, at[i]]))
            out[2].append(np.concatenate([low, low[i] + b * width]))  # first an empty bin for every query
            out[3].append(np.concatenate([np.zeros(n, np.int64), flat[i, b]]))
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x) if x else [], pa.int64()) for x in out],
                                         names=["q_block", "q_at", "edge", "n"])


def _select(k: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows at or above each query's k-th best score; a block sends its k best at most, ties by id."""
    for batch in batches:
        out = [[], [], []]
        for _, _, qi, low, ci, s in _scores(batch):
            i, j = np.nonzero((s >= low[:, None]) & (s != _OWN))
            order = np.lexsort((ci[j], -s[i, j], i))
            i, j = i[order], j[order]
            keep = np.arange(len(i)) - np.searchsorted(i, i, side="left") < k
            i, j = i[keep], j[keep]
            for column, values in zip(out, (qi[i], ci[j], s[i, j])):
                column.append(values)
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x) if x else [], pa.int64()) for x in out],
                                         names=["query_id", "vec_id", "score"])


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5) -> DataFrame:
    """The ``k`` highest inner products of every query over all vectors but its own: ``query_id``, ``rank``
    (from 1), ``vec_id``, ``score``; equal scores go to the smaller id.

    Both inputs have ``id`` (long) and ``vector`` (array of long); inner products must fit a long.  Rows without id or vector
    take no part; an id that occurs more than once counts once, with the smallest of its vectors.  Only
    vectors of the same length are compared.  A query with fewer than ``k`` partners gets all, one without partners no row.
    Each pass hands on at most k bins or rows per query and block, whatever the number of ties, and passes number
    the logarithm of the score range to base 1024.
    """
    def rows(df: DataFrame) -> DataFrame:
        return (df.select(F.col("id").cast("long").alias("id"), "vector").where("id IS NOT NULL AND vector IS NOT NULL")
                .groupBy("id").agg(F.min("vector").alias("vector")))

    asked = rows(queries)
    parts = max(1, -(-asked.count() // QUERY_ROWS))
    q = _numbered(_blocks(asked.repartition(parts), QUERY_ROWS, "q"), "q_block", "query-blocks")
    c = _numbered(_blocks(rows(vectors), CANDIDATE_ROWS, "c"), "c_block", "vector-blocks")
    n_blocks = c.count()
    widest = rows(vectors).agg(F.max(F.greatest(F.abs(F.array_max("vector")), F.abs(F.array_min("vector")))).alias("m"),
                               F.max(F.size("vector")).alias("d")).first()
    reach = max(1, int(widest["m"] or 0) ** 2 * int(widest["d"] or 0))
    if reach >= 2**62:
        raise ValueError("inner products may not fit a long")

    # each block of queries goes to every block of candidates; the blocks, not the pairs of rows, are joined
    to_all = q.withColumn("c_block", F.explode(F.sequence(F.lit(0), F.lit(max(n_blocks - 1, 0)))))

    def paired(low: DataFrame) -> DataFrame:
        return to_all.join(low, "q_block").join(c, ["c_block", "length"]).select(
            "length", "q_ids", "q_vectors", "q_low", F.col("q_block").cast("long").alias("q_block"), "c_ids", "c_vectors")

    low = q.select("q_block", F.array_repeat(F.lit(-reach).cast("long"), F.expr("cast(length(q_ids) / 8 as int)")).alias("q_low"))
    width = 2 * reach + 1
    down = W.partitionBy("q_block", "q_at").orderBy(F.desc("edge"))
    while width > 1:
        width = -(-width // BINS)
        bins = paired(low).mapInArrow(partial(_count, k, width), "q_block long, q_at long, edge long, n long")
        bins = bins.groupBy("q_block", "q_at", "edge").agg(F.sum("n").alias("n")).withColumn("_above", F.sum("n").over(down))
        kth = bins.groupBy("q_block", "q_at").agg(F.coalesce(F.max(F.when(F.col("_above") >= k, F.col("edge"))), F.min("edge")).alias("low"))
        low = materialize(kth.groupBy("q_block").agg(F.sort_array(F.collect_list(F.struct("q_at", "low"))).alias("s"))
                          .select("q_block", F.col("s.low").alias("q_low")), "kth-scores")  # one entry per query of the block
    best = paired(low).mapInArrow(partial(_select, k), "query_id long, vec_id long, score long")
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return best.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op9_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select(F.col("vec_id").alias("id"), quantise().alias("vector"))
    return top_k(table, table.where(F.col("id") % 50 == 0), k=5)


ORACLE = """
WITH whole AS (
  SELECT vec_id, list_transform(embedding, lambda x: cast(floor(256 * cast(x AS double)) AS bigint)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
         cast(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS bigint) AS score
  FROM whole q JOIN whole c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id)
SELECT query_id, cast(rank AS int) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored) r
WHERE rank <= 5"""
