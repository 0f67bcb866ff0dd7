"""Toxicity by class-conditional Kneser-Ney models.

The probability of a word given a class is interpolated.  Its upper level counts the labelled texts of the class that hold
the word, so a fixed expression or a copied text gains with every text.  The lower one, which both classes share, is the
Kneser-Ney continuation count: the number of different words it follows.  The discount that the upper level gives to the
lower is estimated for each class from the words it has in one and in two texts.  A contrast that few texts carry is
noise, so it shrinks as its log-likelihood ratio against equal use in both classes falls.  A text is judged by the difference of the two log-likelihoods per word,
of the whole text and of its most suspicious span; a logistic curve, fitted on labelled rows that the counts
have not seen, turns this into a probability.

Counts cover every labelled row they may use and are a Spark table with one row per word, known by its 64-bit hash, so
the model grows with the corpus.  Tasks get the most frequent words, a fixed number, and a filter of fixed size that
tells which other words may be in the table; those are looked up by a join, so every word counts with its own numbers.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockyard.llm.licenses import _LOWER_AND_BLANK
from stockyard.llm.texts import carried, hash_runs, hash_words, map_texts, slices
from stockyard.workspace import materialize

#: Words that the driver and all tasks may hold, 16 bytes each, and bits of the filter for the others: a fuller filter only sends
#: more words to the join.
FREQUENT = 1 << 20
FILTER_BITS = 1 << 26
#: Words whose pairs a task gathers before it sends them.
GATHERED = 4_000_000
#: Log-likelihood ratio (chance of one in a thousand) up to which a contrast is noise; at twice that it has half its weight.
NOISE = 10.83
SPAN = 4
FEATURES = ("_whole", "_span", "_length")


def word_keys(texts: Sequence[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the lower-case words of all texts, one text after another, and the words of each."""
    words = [(t or b"").translate(_LOWER_AND_BLANK).split() for t in texts]
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    return hash_words([w for text in words for w in text]).view(np.int64), sizes


def _spans(n: int, width: int, spots: np.ndarray) -> np.ndarray:
    """Starts of the spans of a text of n words that hold one of the places."""
    starts = np.unique(spots[:, None] - np.arange(width))
    return starts[(starts >= 0) & (starts <= n - width)]


@dataclass
class Known:
    """What tasks get of the table: the frequent words, sorted, with their contrasts, and the filter for the others."""

    words: np.ndarray
    contrast: np.ndarray
    cells: np.ndarray | None
    unseen: float

    def look_up(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Contrasts, and which words have to be looked up in the table; those count as unseen until then."""
        if len(self.words):
            at = np.minimum(np.searchsorted(self.words, keys), len(self.words) - 1)
            found = self.words[at] == keys
            values = np.where(found, self.contrast[at], self.unseen)
        else:
            found, values = np.zeros(len(keys), bool), np.full(len(keys), self.unseen)
        if self.cells is None:
            return values, np.zeros(len(keys), bool)
        maybe = ~found
        for bit in (keys & (FILTER_BITS - 1), (keys >> 32) & (FILTER_BITS - 1)):
            maybe &= (self.cells[bit >> 6] >> (bit & 63)) & 1 > 0
        return values, maybe

    def measure(self, texts: Sequence[bytes | None]) -> dict[str, list]:
        """Per text: words, summed contrast and highest span sum as far as known; and of texts with words to look
        up their places, hashes and the sums of the spans that hold them."""
        keys, sizes = word_keys(texts)
        values, maybe = self.look_up(keys)
        total = np.concatenate([[0.0], np.cumsum(values)])
        out = {"_n": sizes.tolist(), **{c: [] for c in ("_total", "_best", "_spots", "_words", "_sums")}}
        for end, n in zip(np.cumsum(sizes).tolist(), sizes.tolist()):
            begin, width = end - n, min(n, SPAN)
            sums = total[begin + width:end + 1] - total[begin:end + 1 - width]
            spots = np.flatnonzero(maybe[begin:end])
            later = _spans(n, width, spots)
            settled = np.delete(sums, later)
            out["_total"].append(float(total[end] - total[begin]))
            out["_best"].append(float(settled.max()) if len(settled) else None)
            out["_spots"].append(spots.astype("<i4").tobytes() if len(spots) else None)
            out["_words"].append(keys[begin + spots].tolist() if len(spots) else None)
            out["_sums"].append(sums[later].astype("<f8").tobytes() if len(spots) else None)
        return out


@dataclass
class Model:
    """``known``: what tasks hold; ``rest``: word and contrast of all other words, a Spark table (None without any);
    ``curve``: intercept and weights of the features."""

    known: Known
    rest: DataFrame | None = None
    curve: tuple[float, ...] = field(default=())


def _settle(n: int, total: float, best: float | None, spots: bytes, words: list[int], sums: bytes,
            contrasts: dict[int, float], unseen: float) -> tuple[float, float]:
    """Summed contrast and highest span sum of a text, now that the words that were looked up are known."""
    at, width = np.frombuffer(spots, "<i4").astype(np.int64), min(n, SPAN)
    more = np.array([contrasts.get(w, unseen) - unseen for w in words])
    starts, sums = _spans(n, width, at), np.frombuffer(sums, "<f8").copy()
    upto = np.concatenate([[0.0], np.cumsum(more)])
    sums += upto[np.searchsorted(at, starts + width)] - upto[np.searchsorted(at, starts)]
    return total + float(more.sum()), max(float(sums.max()), -np.inf if best is None else best)


def _measured(docs: DataFrame, model: Model, text: str, carry: Sequence[str]) -> DataFrame:
    """The ``carry`` columns and FEATURES as ``_whole`` (mean contrast), ``_span`` (mean of the highest span of ``SPAN``
    words, of all if fewer) and ``_length`` (log(1 + words)), one row per row.  Other names must not begin so."""
    shipped = docs.sparkSession.sparkContext.broadcast(model.known)
    rows = map_texts(docs, text, carry, "_n long, _total double, _best double, _spots binary, _words array<bigint>, _sums binary",
                     lambda texts: shipped.value.measure(texts))
    if model.rest is not None:
        # written once: the words that are looked up come back to the rows by number
        stored = materialize(rows.withColumn("_row", F.monotonically_increasing_id()), "measured")
        late = stored.where(F.col("_words").isNotNull())
        found = (late.select("_row", F.explode(F.array_distinct("_words")).alias("word")).join(model.rest.hint("merge"), "word")
                 .groupBy("_row").agg(F.collect_list("word").alias("_found"), F.collect_list("contrast").alias("_contrasts")))
        k = len(carry)
        schema = T.StructType([late.schema[c] for c in carry] + list(T._parse_datatype_string("_n long, _total double, _best double")))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                settled = [_settle(*row, dict(zip(words or (), contrasts or ())), shipped.value.unseen)
                           for *row, words, contrasts in zip(*(batch.column(k + i).to_pylist() for i in range(8)))]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(i) for i in range(k + 1)]
                    + [pa.array([x[i] for x in settled], pa.float64()) for i in range(2)], names=schema.names)

        fields = ["_n", "_total", "_best", "_spots", "_words", "_sums", "_found", "_contrasts"]
        late = late.join(found, "_row", "left").select(*carry, *fields).mapInArrow(run, schema)
        rows = stored.where(F.col("_words").isNull()).select(*carry, "_n", "_total", "_best").unionByName(late)
    n = F.greatest("_n", F.lit(1))
    return rows.select(
        *carry, (F.col("_total") / n).alias("_whole"),
        (F.coalesce("_best", F.lit(0.0)) / F.least(n, F.lit(SPAN))).alias("_span"), F.log1p("_n").alias("_length"))


def _counts(rows: DataFrame) -> DataFrame:
    """(word, toxic, ordinary, before): the texts of each class that hold a word and the different words before it, over
    all rows of ``text`` and ``toxic``.  A task sends a word and a pair of words once for many texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def counted(found: list[tuple[np.ndarray, ...]], pairs: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
            held, label = (np.concatenate(c) for c in zip(*found))
            words, at = np.unique(held, return_inverse=True)
            toxic = np.bincount(at, label, len(words)).astype(np.int64)
            word, before, pair = (np.concatenate(c) for c in zip(*pairs))
            once = np.unique(pair, return_index=True)[1]
            zero = np.zeros(len(once), np.int64)
            return pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([words, word[once]])),
                 pa.concat_arrays([pa.nulls(len(words), pa.int64()), pa.array(before[once])]),
                 pa.array(np.concatenate([toxic, zero])),
                 pa.array(np.concatenate([np.bincount(at, minlength=len(words)) - toxic, zero]))],
                names=["word", "before", "toxic", "ordinary"])

        found, pairs, n = [], [], 0
        for batch in batches:
            labels, row = np.asarray(batch.column(1).to_numpy(zero_copy_only=False), np.int64), 0
            for texts in slices(batch.column(0)):
                keys, sizes = word_keys(texts)
                if len(keys):
                    ends = np.cumsum(sizes)
                    for label, begin, end in zip(labels[row:row + len(texts)].tolist(), (ends - sizes).tolist(), ends.tolist()):
                        held = np.unique(keys[begin:end])
                        found.append((held, np.full(len(held), label)))
                    inner = np.ones(len(keys), bool)
                    inner[(ends - sizes)[sizes > 0]] = False
                    after = np.flatnonzero(inner)
                    pairs.append((keys[after], keys[after - 1], hash_runs(keys.view(np.uint64), 2)[after - 1]))
                row, n = row + len(texts), n + len(keys)
                if n > GATHERED:
                    yield counted(found, pairs)
                    found, pairs, n = [], [], 0
        if found:
            yield counted(found, pairs)

    sent = rows.select(F.col("text").cast("string"), F.col("toxic").cast("int")).mapInArrow(
        run, "word long, before long, toxic long, ordinary long")
    sums = [F.sum(c).alias(c) for c in ("toxic", "ordinary")]
    return sent.groupBy("word", "before").agg(*sums).groupBy("word").agg(*sums, F.count("before").alias("before"))


def _contrasts(counts: DataFrame) -> tuple[DataFrame, float]:
    """(word, contrast, seen) and the contrast of a word never seen, 0; contrast is log p(word | toxic) -
    log p(word | ordinary), weighed by the evidence; ``seen``: texts with the word."""
    classes = ("toxic", "ordinary")
    sums = counts.agg(F.count(F.lit(1)).alias("words"), F.sum("before").alias("before"), *[
        x for c in classes for x in (F.sum(c).alias(c), *[F.count_if(F.col(c) == k).alias(f"{c}_{k}") for k in (1, 2)],
                                     F.count_if(F.col(c) > 0).alias(f"{c}_words"))]).first()
    # the half beyond the words is for those never seen
    mass = (sums["before"] or 0) + 0.5 * (sums["words"] + 1)
    shared = (F.col("before") + 0.5) / mass

    def share(c: str) -> Column:
        if not sums[c]:
            return shared
        # n1 / (n1 + 2 n2), kept between 0 and 1
        discount = (sums[f"{c}_1"] + 0.5) / (sums[f"{c}_1"] + 2 * sums[f"{c}_2"] + 1)
        kept = F.greatest(F.col(c) - discount, F.lit(0.0))
        return (kept + discount * sums[f"{c}_words"] * shared) / sums[c]

    seen = F.col("toxic") + F.col("ordinary")
    every = sum(sums[c] or 0 for c in classes)
    # twice the sum of count x log(count / expected count)
    ratio = sum((2 * F.when(F.col(c) > 0, F.col(c) * F.log(F.col(c) * every / (seen * sums[c]))).otherwise(0.0)
                 for c in classes if sums[c]), F.lit(0.0))
    weight = F.when(ratio > NOISE, 1 - NOISE / ratio).otherwise(0.0)
    contrast = weight * (F.log(share("toxic")) - F.log(share("ordinary")))
    return counts.select("word", contrast.alias("contrast"), seen.alias("seen")), 0.0


def _model(table: DataFrame, unseen: float, frequent: int) -> Model:
    """The words seen most often, at most ``frequent``, for the tasks; the others stay in the table."""
    bits = F.length(F.bin("seen"))
    # at most 64 rows: how many words have a count of so many bits
    sizes = {r["bits"]: r["n"] for r in table.groupBy(bits.alias("bits")).agg(F.count(F.lit(1)).alias("n")).collect()}
    least, held = 65, 0
    while least > 1 and held + sizes.get(least - 1, 0) <= frequent:
        least -= 1
        held += sizes.get(least, 0)
    top = table.where(bits >= least).select("word", "contrast").toArrow()  # at most ``frequent`` rows
    order = np.argsort(top["word"].to_numpy())
    known = Known(top["word"].to_numpy()[order], top["contrast"].to_numpy()[order], None, unseen)
    if held == sum(sizes.values()):
        return Model(known)
    rest = table.where(bits < least).select("word", "contrast")
    bit = F.explode(F.array(F.col("word").bitwiseAND(F.lit(FILTER_BITS - 1)),
                            F.shiftright("word", 32).bitwiseAND(F.lit(FILTER_BITS - 1)))).alias("bit")
    cells = (rest.select(bit).groupBy(F.shiftright("bit", 6).alias("cell"))
             .agg(F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 AS int))")).alias("bits")).toArrow())  # at most FILTER_BITS / 64 rows
    known.cells = np.zeros(FILTER_BITS // 64, np.int64)
    known.cells[cells["cell"].to_numpy()] = cells["bits"].to_numpy()
    return Model(known, rest)


def _side(doc_id: str) -> F.Column:
    return F.crc32(F.col(f"`{doc_id}`").cast("string").cast("binary")) % 4


def _maybe_labelled(rows: DataFrame, known: DataFrame) -> DataFrame:
    """The rows whose id may be labelled, by a filter of FILTER_BITS bits, so that few other texts are sent to the join that
    decides.  The filter has a fixed size (2^20 cells at most); a fuller one only lets more rows through."""
    bit = F.xxhash64("id").bitwiseAND(F.lit(FILTER_BITS - 1))
    cells = (known.select(bit.alias("_bit")).groupBy(F.shiftright("_bit", 6).alias("_cell"))
             .agg(F.bit_or(F.expr("shiftleft(1L, cast(_bit & 63 AS int))")).alias("_bits")))
    held = rows.withColumn("_bit", bit).withColumn("_cell", F.shiftright("_bit", 6)).join(F.broadcast(cells), "_cell")
    return held.where(F.expr("shiftright(_bits, cast(_bit & 63 AS int)) & 1 = 1")).select(*rows.columns)


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic",
        frequent: int = FREQUENT) -> Model:
    """Models and curve from the labelled rows whose crc32(id) mod 4 is not 2: those at 0 and 1 are counted, those
    at 3 fit the curve.  A document labelled several times is toxic if any label says so; null labels,
    unlabelled and null ids are left out.  Without rows of both classes on both sides the curve is flat:
    the share of toxic rows, 0 without any.  ``frequent`` words at most are sent to the tasks; it changes no result."""
    known = (labels.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{label}`").cast("int").alias("toxic")).dropna()
             .groupBy("id").agg(F.max(F.when(F.col("toxic") > 0, 1).otherwise(0)).alias("toxic")))
    rows = (docs.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{text}`").cast("string").alias("text"))
            .where(F.col("id").isNotNull() & (_side("id") != 2)))
    # labels grow with the corpus: merged at every size, never sent to all tasks
    rows = _maybe_labelled(rows, known.where(_side("id") != 2))
    known = known.where(_side("id") != 2).hint("merge")
    counted = _counts(rows.where(_side("id") < 2).join(known.where(_side("id") < 2), "id"))
    model = _model(*_contrasts(materialize(counted, "words")), frequent)
    rest = rows.where(_side("id") == 3).join(known.where(_side("id") == 3), "id")
    x = _measured(rest, model, "text", ["toxic"]).cache()
    seen = x.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("toxic"), F.lit(0)).alias("toxic")).first()
    if 0 < seen["toxic"] < seen["n"]:
        rows = VectorAssembler(inputCols=list(FEATURES), outputCol="x").transform(x)
        curve = LogisticRegression(featuresCol="x", labelCol="toxic", regParam=1e-4, maxIter=100).fit(rows)
        model.curve = (float(curve.intercept), *map(float, curve.coefficients))
    else:
        share = seen["toxic"] / seen["n"] if seen["n"] else 0.0
        model.curve = (500.0 if share == 1 else -500.0, *[0.0] * len(FEATURES))
    x.unpersist()
    return model


def score(docs: DataFrame, model: Model, text: str = "text", carry: Sequence[str] = ("doc_id",)) -> DataFrame:
    """``score`` (0 to 1) of every whole text, one row per row of ``docs``; only the text is looked at.

    A null or empty text, or one without words, has contrast 0 and gets what the curve gives for that.  Repeated rows score
    alike; null ids and further columns make no difference; an empty table gives an empty result.
    """
    carry = carried(carry, ("score",))
    inner = [f"carry_{i}" for i in range(len(carry))]
    named = docs.select(*[F.col(f"`{c}`").alias(i) for c, i in zip(carry, inner)],
                        *([] if text in carry else [F.col(f"`{text}`").alias("text")]))
    rows = _measured(named, model, inner[carry.index(text)] if text in carry else "text", inner)
    z = F.lit(model.curve[0])
    for weight, feature in zip(model.curve[1:], FEATURES):
        z = z + weight * F.col(feature)
    z = F.greatest(F.lit(-500.0), F.least(F.lit(500.0), z))
    return rows.select(*[F.col(i).alias(c) for c, i in zip(carry, inner)], (1 / (1 + F.exp(-z))).alias("score"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    scored = score(docs, fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
    return scored.select("doc_id", F.coalesce(_side("doc_id") == 2, F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= 0.3).cast("int").alias("predicted"))
