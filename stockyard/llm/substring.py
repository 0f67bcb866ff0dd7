"""Substring deduplication: passages of whole windows of words that an earlier document has are cut.

Every window has an anchor, the smallest hash of any eight words in it; equal windows have equal anchors.  Runs
of consecutive windows with one anchor, where the anchor occurs in several documents, are cut out as segments and
gathered into shards by anchor.  Each shard builds a compressed FM-index of its different segments and
streams them through it: backward search gives each window's suffix interval, and the smallest document
in the interval tells whether, and from where on, the match with earlier documents reaches the window's length.
Consecutive such windows are the intervals that are removed.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockyard.llm.fmindex import FMIndex
from stockyard.llm.quality import words_of
from stockyard.llm.texts import carried, hash_runs, hash_words, map_texts, split_words
from stockyard.workspace import materialize

ANCHOR = 8
#: Words of a shard's index, and segments of one anchor beyond which its windows are told apart by their own hash.
SHARD_WORDS = 400_000
HOT_SEGMENTS = 16_384

_WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def anchor_runs(hashes: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchor, first window and number of windows of each run of windows with one anchor."""
    n = len(hashes) - window + 1
    if n <= 0:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
    least, have, need = hash_runs(hashes, min(ANCHOR, window)), 1, max(1, window - ANCHOR + 1)
    while have < need:  # minimum of ever longer stretches
        step = min(have, need - have)
        least = np.minimum(least[:len(least) - step], least[step:])
        have += step
    first = np.flatnonzero(np.concatenate([[True], least[1:] != least[:-1]]))
    return least[first].astype(np.int64), first, np.diff(np.concatenate([first, [n]]))


def _sketches(source: DataFrame, window: int) -> DataFrame:
    def batch(texts: list[bytes | None]) -> dict:
        out: dict[str, list] = {k: [] for k in ("n_words", "word_key", "anchors", "starts", "counts")}
        for t in texts:
            words = hash_words(split_words(t))
            anchors, starts, counts = anchor_runs(words, window)
            for k, v in zip(out, (len(words), xxhash.xxh3_128_digest(words.tobytes()), anchors, starts, counts)):
                out[k].append(v)
        return out

    return map_texts(source, "text", ["id", "tkey"],
                     "n_words long, word_key binary, anchors array<long>, starts array<long>, counts array<long>", batch)


def _segments(rows: DataFrame, window: int) -> DataFrame:
    """(anchor, seg_key, id, tkey, start, count, words, hot) of each run of each document."""
    schema = T.StructType([T.StructField("anchor", T.LongType()), T.StructField("seg_key", T.BinaryType()), rows.schema["id"],
                           T.StructField("tkey", T.LongType()), T.StructField("start", T.LongType()),
                           T.StructField("count", T.LongType()), T.StructField("words", T.BinaryType()),
                           T.StructField("hot", T.BooleanType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            origin, out = [], [[] for _ in range(6)]
            for i, (text, runs) in enumerate(zip(batch.column("text").cast(pa.binary()), batch.column("runs"))):
                words = text.as_py().split()
                for r in runs.as_py():
                    joined = b" ".join(words[r["start"]:r["start"] + r["count"] + window - 1])
                    origin.append(i)
                    for column, v in zip(out, (r["anchor"], xxhash.xxh3_128_digest(joined), r["start"], r["count"], joined, r["hot"])):
                        column.append(v)
            take = pa.array(origin, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[0], pa.int64()), pa.array(out[1], pa.binary()), batch.column("id").take(take), batch.column("tkey").take(take),
                 pa.array(out[2], pa.int64()), pa.array(out[3], pa.int64()), pa.array(out[4], pa.binary()), pa.array(out[5], pa.bool_())],
                names=schema.names)

    return rows.select("id", "tkey", "text", "runs").mapInArrow(run, schema)


def _single_windows(segments: DataFrame, window: int) -> DataFrame:
    """The same rows as one segment per window, under the hash of its words as anchor."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            origin, out = [], [[] for _ in range(4)]
            for i, (start, text) in enumerate(zip(batch.column("start").to_pylist(), batch.column("words").to_pylist())):
                words = text.split(b" ")
                for j in range(len(words) - window + 1):
                    joined = b" ".join(words[j:j + window])
                    origin.append(i)
                    for column, v in zip(out, (np.uint64(xxhash.xxh3_64_intdigest(joined)).astype(np.int64), xxhash.xxh3_128_digest(joined), start + j, joined)):
                        column.append(v)
            take = pa.array(origin, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[0], pa.int64()), pa.array(out[1], pa.binary()), batch.column("id").take(take), batch.column("tkey").take(take),
                 pa.array(out[2], pa.int64()), pa.array([1] * len(origin), pa.int64()), pa.array(out[3], pa.binary()),
                 pa.array([True] * len(origin), pa.bool_())], names=batch.schema.names)

    return segments.mapInArrow(run, segments.schema)


def _match(different: DataFrame, window: int) -> DataFrame:
    """(anchor, seg_key, firsts): per window of each different segment, the smallest owner of any segment of its
    anchor that has the window.  Rows must come by anchor."""
    def shard(rows: list[tuple]) -> pa.RecordBatch:
        numbers: dict[bytes, int] = {}
        sequences = [np.array([numbers.setdefault(w, len(numbers) + 1) for w in words.split(b" ")], np.int64) for _, _, _, words in rows]
        ids = np.array([r[2] for r in rows], np.int64)
        firsts = FMIndex(sequences, ids).first_owners(window)
        return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.binary()),
                                           pa.array(firsts, pa.list_(pa.int64()))], names=["anchor", "seg_key", "firsts"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, words, last = [], 0, None
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("anchor", "seg_key", "owner", "words"))):
                if row[0] != last and words >= SHARD_WORDS:
                    yield shard(held)
                    held, words = [], 0
                last = row[0]
                held.append(row)
                words += row[3].count(b" ") + 1
        if held:
            yield shard(held)

    return different.select("anchor", "seg_key", "owner", "words").mapInArrow(run, "anchor long, seg_key binary, firsts array<long>")


def _covers(segments: DataFrame, window: int) -> DataFrame:
    """(id, tkey, places): the windows that a smaller id has, for segments whose anchors stand in several documents."""
    # one shuffle by anchor serves the different segments and their shard
    different = (segments.repartition("anchor").groupBy("anchor", "seg_key")
                 .agg(F.min("id").alias("owner"), F.first("words").alias("words")).sortWithinPartitions("anchor", "seg_key"))
    firsts = _match(different, window)
    hits = segments.select("anchor", "seg_key", "id", "tkey", "start").join(firsts, ["anchor", "seg_key"])
    # windows that start in a smaller document, as places; neighbours are joined when the text is cut
    places = F.filter(F.transform("firsts", lambda f, i: F.when(f < F.col("id"), F.col("start") + i)), lambda p: p.isNotNull())
    return hits.select("id", "tkey", places.alias("places")).where(F.size("places") > 0)


def remove_repeats(docs: DataFrame, window: int = 50, doc_id: str = "doc_id", text: str = "text", carry: Sequence[str] | None = None,
                   hot: int = HOT_SEGMENTS) -> DataFrame:
    """Cuts every word that a window of ``window`` words covers whose words also start in a document with a smaller id.

    One row per row of ``docs``: the ``carry`` columns (the id alone, unless given), ``n_words``, ``n_removed`` and ``kept_text``, the
    text without the removed passages and otherwise unchanged, blanks included.  Ids must be whole numbers.  Windows are judged
    on the input, not on what is left.  Documents of the same words are one before anything else: all but those with the smallest id go
    entirely (if they fill a window).  An anchor with more than ``hot`` runs is split by the hash of each whole window, so no
    shard depends on how often a passage occurs.

    A null or empty text stays as it is; a row with a null id is neither cut nor a source.  Rows that share an id are no
    sources for each other.  Further columns make no difference; an empty table gives an empty result.
    """
    carry = carried(carry or [doc_id], ("n_words", "n_removed", "kept_text"))
    key = F.xxhash64(F.col(f"`{text}`").cast("string"))
    source = (docs.select(F.col(f"`{doc_id}`").cast("long").alias("id"), F.col(f"`{text}`").cast("string").alias("text"), key.alias("tkey"))
              .where("id IS NOT NULL AND text IS NOT NULL"))
    sketches = materialize(_sketches(source, window), "sketches").where(F.col("n_words") >= window)
    firsts = sketches.groupBy("word_key").agg(F.min("id").alias("_first"))
    judged = sketches.join(firsts, "word_key")
    copies = judged.where("id > _first").select("id", "tkey").distinct()
    run = F.explode(F.arrays_zip("anchors", "starts", "counts")).alias("r")
    runs = (judged.where("id = _first").dropDuplicates(["id", "tkey"]).select("id", "tkey", run)
            .select("id", "tkey", F.col("r.anchors").alias("anchor"), F.col("r.starts").alias("start"), F.col("r.counts").alias("count")))
    anchors = (runs.groupBy("anchor").agg(F.min("id").alias("_a"), F.max("id").alias("_b"), F.count(F.lit(1)).alias("_n"))
               .where("_a <> _b").select("anchor", (F.col("_n") > hot).alias("hot")))
    wanted = (runs.join(anchors, "anchor").groupBy("id", "tkey")
              .agg(F.collect_list(F.struct("anchor", "start", "count", "hot")).alias("runs")))  # at most a document's own
    found = materialize(_segments(source.join(wanted, ["id", "tkey"]).dropDuplicates(["id", "tkey"]), window), "segments")
    windows = _single_windows(found.where("hot"), window)
    shared = windows.groupBy("anchor").agg(F.min("id").alias("_a"), F.max("id").alias("_b")).where("_a <> _b").select("anchor")
    places = _covers(found.where("NOT hot"), window).union(_covers(windows.join(shared, "anchor", "left_semi"), window))
    covers = places.groupBy("id", "tkey").agg(F.sort_array(F.flatten(F.collect_list("places"))).alias("_places"))
    covers = covers.withColumn("_copy", F.lit(False)).unionByName(
        copies.select("id", "tkey", F.lit(None).cast("array<long>").alias("_places"), F.lit(True).alias("_copy")))
    covers = materialize(covers, "covers")

    wide = docs.select(*[F.col(f"`{c}`").alias(f"_carry_{i}") for i, c in enumerate(carry)], F.col(f"`{doc_id}`").cast("long").alias("id"),
                       F.col(f"`{text}`").cast("string").alias("_text"), key.alias("tkey"))
    joined = wide.join(covers, ["id", "tkey"], "left")
    n = len(carry)
    schema = T.StructType([T.StructField(c, docs.schema[c].dataType) for c in carry]
                          + list(T._parse_datatype_string("n_words long, n_removed long, kept_text string")))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, removed, kept = [], [], []
            for raw, places, copy in zip(*(batch.column(n + i) for i in range(3))):
                body = raw.cast(pa.binary()).as_py()
                n_words = len(split_words(body))
                gone = 0
                if copy.as_py():
                    body, gone = b"", n_words
                elif places.is_valid and len(places):
                    at = np.asarray(places.values.to_numpy(zero_copy_only=False), np.int64)
                    body, gone = _without(body, np.unique(at), window)
                sizes.append(n_words)
                removed.append(gone)
                kept.append(None if body is None else body)
            yield pa.RecordBatch.from_arrays([batch.column(i) for i in range(n)] + [
                pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())], names=schema.names)

    return joined.select(*[f"_carry_{i}" for i in range(n)], "_text", "_places", "_copy").mapInArrow(cut, schema)


def _without(body: bytes, starts: np.ndarray, window: int) -> tuple[bytes, int]:
    """The text without the words of the windows at ``starts`` (sorted), and the number of those words."""
    spans = [m.span() for m in _WORD.finditer(body)]
    breaks = np.flatnonzero(np.diff(starts) > window)
    firsts = starts[np.concatenate([[0], breaks + 1])]
    lasts = starts[np.concatenate([breaks, [len(starts) - 1]])] + window
    parts, at, gone = [], 0, 0
    for first, last in zip(firsts.tolist(), lasts.tolist()):
        parts.append(body[at:spans[first][0]])
        at = spans[last - 1][1]
        gone += last - first
    return b"".join(parts) + body[at:], gone


def op7_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    kept = F.array_join(words_of(F.coalesce("kept_text", F.lit(""))), " ")
    return done.select("doc_id", "n_words", "n_removed", F.sha2(kept, 256).alias("kept_sha256"))


#: The same by the smallest owner of every window.
ORACLE = r"""
WITH words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
windows AS (
  SELECT doc_id, unnest(list_transform(range(1, len(w) - 48), lambda i: {'i': i, 'k': md5(array_to_string(w[i:i + 49], ' '))})) AS v
  FROM words WHERE len(w) >= 50),
owned AS (SELECT doc_id, v.i AS i, min(doc_id) OVER (PARTITION BY v.k) AS owner FROM windows),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS i FROM owned WHERE owner < doc_id),
placed AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM words),
kept AS (
  SELECT p.doc_id, count(*) AS n, string_agg(p.word, ' ' ORDER BY p.i) AS text
  FROM placed p ANTI JOIN gone g ON p.doc_id = g.doc_id AND p.i = g.i GROUP BY p.doc_id)
SELECT w.doc_id, len(w.w) AS n_words, len(w.w) - coalesce(k.n, 0) AS n_removed, sha256(coalesce(k.text, '')) AS kept_sha256
FROM words w LEFT JOIN kept k ON w.doc_id = k.doc_id
"""
