"""Quality of documents by a linear-chain conditional random field over their lines.

Every line is good or bad.  What speaks for either is the line itself and its neighbours (measures of symbols, capitals,
repetition and sentence form of the line, the line before and the line after), and the state of the line before.  Labels
are known for documents only, so lines are labelled first: all lines of a good document are good; of a bad one those that a
field without transitions finds bad, its worst line at least.  The full field is then trained on these lines.  Its
forward-backward marginals, weighed by the words of the lines, give a document's share of good text, and a
logistic curve, fitted on labelled documents that the field has not seen, turns it into a probability.

Training reads a bounded sample of the labelled documents, chosen by hash; each step of the optimiser is one Spark job whose tasks
send one sum of values and gradients each.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stockyard.llm.texts import carried, map_texts, mix
from stockyard.workspace import materialize

#: Labelled documents that the field, and as many that the curve is fitted on (expected number; chosen by the hash of the id).
TRAIN_DOCS = 20_000
#: Strength of the quadratic penalty, and steps of the optimiser, without and with transitions.
PENALTY = 1.0
STEPS = (25, 40)

#: Measures of a line.
MEASURES = ("words", "word_length", "symbols", "capitals", "digits", "marks", "stranger", "ends", "starts", "shout",
            "repeated", "again", "same", "copy", "wordless")
SIZE = 3 * len(MEASURES) + 3  # with both neighbours, first line, last line, constant
FEATURES = ("_good", "_worst", "_length")

# Kinds of bytes.
_BLANK, _UPPER, _LOWER, _DIGIT, _SYMBOL, _MARK, _END, _HIGH = (1 << i for i in range(8))
KINDS = np.zeros(256, np.uint8)
for _kind, _characters in ((_BLANK, b" \t\n\x0b\x0c\r"), (_UPPER, bytes(range(65, 91))), (_LOWER, bytes(range(97, 123))),
                           (_DIGIT, b"0123456789"), (_SYMBOL, b"#*$%&|<>{}[]\\^~_=+@/"), (_MARK, b"!?,;:-'\"()"), (_END, b".!?"),
                           (_HIGH, bytes(range(128, 256)))):
    KINDS[list(_characters)] |= _kind


def _sums(flags: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Flags that are set between each begin and end."""
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return (total[ends] - total[begins]).astype(np.float64)


def _recurs(keys: np.ndarray) -> np.ndarray:
    """Which keys occur more than once."""
    _, at, n = np.unique(keys, return_inverse=True, return_counts=True)
    return n[at] > 1


_POWERS = np.cumprod(np.full(256, 0x9E3779B97F4A7C15, np.uint64))


def measure(texts: Sequence[bytes | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """MEASURES of all lines of all texts, one text after another; the words of each line; the lines of each text.

    Lines are what newlines separate; a text without bytes has none.  All counts are taken over the bytes of all texts at once.
    """
    filled = [t for t in texts if t]
    n_lines = np.array([t.count(b"\n") + 1 if t else 0 for t in texts], np.int64)
    if not filled:
        return np.zeros((0, len(MEASURES))), np.zeros(0), n_lines
    raw = np.frombuffer(b"\n".join(filled) + b"\n", np.uint8)
    kind = KINDS[raw]
    ends = np.flatnonzero(raw == 10)
    begins = np.concatenate([[0], ends[:-1] + 1])
    doc = np.repeat(np.arange(len(texts)), n_lines)
    # words and their hashes: a sum of byte times power of the place in the word
    dark = (kind & _BLANK) == 0
    edge = np.diff(np.concatenate([[False], dark, [False]]).astype(np.int8))
    w_begin, w_end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    line_of = np.searchsorted(ends, w_begin)
    words = np.bincount(line_of, minlength=len(ends)).astype(np.float64)
    if len(w_begin):
        inside = np.flatnonzero(dark)
        place = inside - np.repeat(w_begin, w_end - w_begin)
        word = np.add.reduceat((raw[inside].astype(np.uint64) + np.uint64(1)) * _POWERS[place & 255],
                               np.concatenate([[0], np.cumsum(w_end - w_begin)[:-1]]))
        word = mix(word + (w_end - w_begin).astype(np.uint64))
    else:
        word = np.zeros(0, np.uint64)
    salt = mix(np.arange(len(texts), dtype=np.uint64) + np.uint64(77))
    own = mix(word ^ salt[doc[line_of]])  # equal words of one text
    pair = mix(own[1:] + word[:-1] * np.uint64(3))
    inner = doc[line_of[1:]] == doc[line_of[:-1]]
    same = np.append(False, (word[1:] == word[:-1]) & inner)
    again = np.append(False, _recurs(np.where(inner, pair, np.arange(len(pair), dtype=np.uint64)))) if len(own) > 1 else np.zeros(len(own), bool)
    # words of a line that the line has already had
    in_line = mix(own + line_of.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    first = np.zeros(len(word), bool)
    first[np.unique(in_line, return_index=True)[1]] = True
    # whole lines that the text has more than once
    whole = np.zeros(len(ends), np.uint64)
    np.add.at(whole, line_of, mix(word + (np.arange(len(word)) - np.searchsorted(line_of, line_of)).astype(np.uint64)))
    copies = np.zeros(len(ends), bool)
    has = words > 0
    copies[has] = _recurs(mix(whole[has] ^ salt[doc[has]]))

    many = np.maximum(words, 1)
    chars = np.maximum(_sums((raw & 0xC0) != 0x80, begins, ends) - _sums(kind & _BLANK > 0, begins, ends), 1)
    count = {k: _sums(kind & k > 0, begins, ends) for k in (_UPPER, _LOWER, _DIGIT, _SYMBOL, _MARK, _HIGH)}
    letters = np.maximum(count[_UPPER] + count[_LOWER], 1)
    by_word = {"last": kind[w_end - 1], "first": kind[w_begin]} if len(w_begin) else {"last": np.zeros(0, np.uint8), "first": np.zeros(0, np.uint8)}
    strange = np.bincount(line_of, by_word["last"] & _SYMBOL > 0, len(ends)) / many
    shout = np.bincount(line_of, raw[np.maximum(w_end - 1, 0)] == 33, len(ends)) / many
    last, start = np.zeros(len(ends)), np.zeros(len(ends))
    last[line_of] = (by_word["last"] & _END > 0).astype(float)  # of the last word: later ones overwrite earlier ones
    start[line_of[::-1]] = (by_word["first"][::-1] & (_UPPER | _HIGH) > 0).astype(float)
    out = np.stack([
        np.log1p(words), np.log1p(chars / many), count[_SYMBOL] / chars, count[_UPPER] / letters, count[_DIGIT] / chars,
        count[_MARK] / chars, strange, last, start, shout, (words - np.bincount(line_of, first, len(ends))) / many,
        np.bincount(line_of, again, len(ends)) / many, np.bincount(line_of, same, len(ends)) / many, copies.astype(float),
        (words == 0).astype(float)], axis=1)
    return out, words, n_lines


def with_neighbours(measures: np.ndarray, n_lines: np.ndarray) -> np.ndarray:
    """SIZE features of every line: its own measures, those of the lines before and after in the same text (zeros without any), whether it is the
    first or last, and a constant."""
    starts = np.cumsum(n_lines) - n_lines
    n_lines, starts = n_lines[n_lines > 0], starts[n_lines > 0]
    first, last = np.zeros(len(measures)), np.zeros(len(measures))
    first[starts], last[starts + n_lines - 1] = 1, 1
    before, after = np.zeros_like(measures), np.zeros_like(measures)
    before[1:], after[:-1] = measures[:-1], measures[1:]
    before[first > 0], after[last > 0] = 0, 0
    return np.concatenate([measures, before, after, first[:, None], last[:, None], np.ones((len(measures), 1))], axis=1)


@dataclass
class Marginals:
    """Probabilities that each line is good, and of the four pairs of states (from, to) at each line (zeros at first lines);
    log normaliser of every text."""

    good: np.ndarray
    pairs: np.ndarray
    log_z: np.ndarray


def forward_backward(odds: np.ndarray, n_lines: np.ndarray, change: np.ndarray) -> Marginals:
    """Marginals of chains laid end to end.  ``odds``: what each line itself gives the good state over the bad one, in logs; ``change[i, j]``:
    log weight of a line in state j after one in state i (0 bad, 1 good).  A step is taken for all chains that are long enough at once."""
    chains = np.flatnonzero(n_lines > 0)
    order = chains[np.argsort(-n_lines[chains], kind="stable")]
    starts, sizes = (np.cumsum(n_lines) - n_lines)[order], n_lines[order]
    n, longest = len(odds), int(sizes[0]) if len(sizes) else 0
    live = np.searchsorted(-sizes, -np.arange(longest), side="left")  # chains with more lines than t
    ahead, bad, back, rest = np.zeros(n), np.zeros(n), np.zeros(n), np.zeros(n)
    for t in range(longest):
        at = starts[:live[t]] + t
        if t == 0:
            ahead[at] = odds[at]
        else:
            r = ahead[at - 1]
            to_bad = np.logaddexp(change[0, 0], r + change[1, 0])
            ahead[at] = odds[at] + np.logaddexp(change[0, 1], r + change[1, 1]) - to_bad
            bad[at] = bad[at - 1] + to_bad  # log weight of all ways that end in bad here
    for t in range(longest - 2, -1, -1):
        at = starts[:live[t + 1]] + t
        r = odds[at + 1] + back[at + 1]
        from_bad = np.logaddexp(change[0, 0], r + change[0, 1])
        back[at] = np.logaddexp(change[1, 0], r + change[1, 1]) - from_bad
        rest[at] = from_bad + rest[at + 1]  # log weight of all ways on from bad here
    log_z = np.zeros(len(n_lines))
    ends = starts + sizes - 1
    log_z[order] = bad[ends] + np.logaddexp(0, ahead[ends])
    good = 1 / (1 + np.exp(-np.clip(ahead + back, -500, 500)))
    pairs = np.zeros((n, 4))
    inner = np.ones(n, bool)
    inner[starts] = False
    at = np.flatnonzero(inner)
    if len(at):
        weights = np.stack([change[i, j] + i * ahead[at - 1] + j * (odds[at] + back[at]) for i in (0, 1) for j in (0, 1)], axis=1)
        weights = np.exp(weights - weights.max(axis=1, keepdims=True))
        pairs[at] = weights / weights.sum(axis=1, keepdims=True)
    return Marginals(good, pairs, log_z)


@dataclass
class Field:
    """``shift`` and ``scale`` of the features, their weights, the four weights of changes (from, to), and the curve."""

    shift: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    change: np.ndarray
    curve: tuple[float, ...] = ()

    def odds(self, features: np.ndarray) -> np.ndarray:
        return ((features - self.shift) / self.scale) @ self.weights

    def judge(self, texts: Sequence[bytes | None]) -> dict[str, list]:
        """Per text: FEATURES, lines and lines more likely bad than good."""
        measures, words, n_lines = measure(texts)
        good = forward_backward(self.odds(with_neighbours(measures, n_lines)), n_lines, self.change).good
        doc = np.repeat(np.arange(len(texts)), n_lines)
        share = np.bincount(doc, good * words, len(texts))
        total = np.bincount(doc, words, len(texts))
        filled = total > 0
        share = np.where(filled, share / np.maximum(total, 1), 0.5)
        worst = np.ones(len(texts))
        np.minimum.at(worst, doc[words > 0], good[words > 0])
        worst = np.where(filled, worst, 0.5)
        log_odds = [np.log(np.clip(p, 1e-4, 1 - 1e-4) / (1 - np.clip(p, 1e-4, 1 - 1e-4))) for p in (share, worst)]
        return {"_good": log_odds[0], "_worst": log_odds[1], "_length": np.log1p(total), "n_lines": n_lines,
                "n_bad": np.bincount(doc, (good < 0.5) & (words > 0), len(texts)).astype(np.int64)}


def _descend(evaluate: Callable[[np.ndarray], tuple[float, np.ndarray]], x: np.ndarray, steps: int) -> np.ndarray:
    """Minimum by limited-memory quasi-Newton steps with backtracking; each evaluation is one Spark job."""
    value, slope = evaluate(x)
    past: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(steps):
        way, parts = -slope, []
        for s, y in reversed(past):
            a = (s @ way) / (s @ y)
            way = way - a * y
            parts.append(a)
        if past:
            s, y = past[-1]
            way = way * ((s @ y) / (y @ y))
        else:
            way = way / max(1.0, float(np.linalg.norm(way)))
        for (s, y), a in zip(past, reversed(parts)):
            way = way + s * (a - (y @ way) / (s @ y))
        length, down = 1.0, float(way @ slope)
        while True:
            new_value, new_slope = evaluate(x + length * way)
            if new_value <= value + 1e-4 * length * down or length < 1e-4:
                break
            length /= 4
        if new_value > value:
            break
        s, y, gain = length * way, new_slope - slope, value - new_value
        if s @ y > 1e-12:
            past = [*past[-7:], (s, y)]
        x, value, slope = x + s, new_value, new_slope
        if gain < 1e-6 * max(1.0, abs(value)) or np.abs(slope).max() < 1e-5:
            break
    return x


def _batch(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Labels, lines and measures of stored documents."""
    n_lines = np.asarray(batch.column(1), np.int64)
    values = np.frombuffer(b"".join(batch.column(2).to_pylist()), "<f4").astype(np.float64)
    return np.asarray(batch.column(0), np.int64), n_lines, values.reshape(-1, len(MEASURES))


def _total(stored: DataFrame, fn: Callable[[np.ndarray, np.ndarray, np.ndarray], np.ndarray], size: int) -> np.ndarray:
    """Sum of ``fn`` over all batches: one vector a task comes back."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            if batch.num_rows:
                total += fn(*_batch(batch))
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()])], names=["total"])

    rows = stored.select("good", "n_lines", "measures").mapInArrow(run, "total binary").collect()
    return sum((np.frombuffer(r["total"]) for r in rows), np.zeros(size))


def _value(good: np.ndarray, n_lines: np.ndarray, measures: np.ndarray, field: Field, before: Field | None) -> np.ndarray:
    """Negative log-likelihood of the lines' labels and its gradient by weights and changes."""
    features = (with_neighbours(measures, n_lines) - field.shift) / field.scale
    odds = features @ field.weights
    doc = np.repeat(np.arange(len(good)), n_lines)
    y = good[doc]
    if before is not None:
        first = before.odds(with_neighbours(measures, n_lines))
        worst = np.full(len(good), np.inf)
        np.minimum.at(worst, doc, first)
        y = np.where((good[doc] > 0) | ((first >= 0) & (first > worst[doc])), 1, 0)
    found = forward_backward(odds, n_lines, field.change)
    inner = np.flatnonzero(np.append(False, doc[1:] == doc[:-1])) if len(doc) else np.zeros(0, np.int64)
    moves = y[inner - 1] * 2 + y[inner]
    loss = found.log_z.sum() - float(odds @ y) - float(field.change.ravel()[moves].sum())
    return np.concatenate([[loss], features.T @ (found.good - y), found.pairs.sum(axis=0) - np.bincount(moves, minlength=4)])


def _side(doc_id: str) -> Column:
    return F.crc32(F.col(f"`{doc_id}`").cast("string").cast("binary")) % 4


def _sampled(known: DataFrame, most: int) -> DataFrame:
    """About ``most`` rows, chosen by the hash of the id; all, if there are no more."""
    n = known.count()
    return known if n <= most else known.where(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) * F.lit(n / most) < F.lit(1 << 30))


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality", most: int = TRAIN_DOCS) -> Field:
    """Field and curve from labelled rows whose crc32(id) mod 4 is not 2: about ``most`` of those at 0 and 1 train the field, as
    many of those at 3 fit the curve.  A document labelled several times is bad if any label says so; null labels, unlabelled and null
    ids are left out.  Without rows of both classes the field is flat, and so is the curve: the share of good rows, 1 without any."""
    known = (labels.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{label}`").cast("int").alias("good")).dropna()
             .groupBy("id").agg(F.min(F.when(F.col("good") > 0, 1).otherwise(0)).alias("good")))
    rows = docs.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{text}`").cast("string").alias("text")).where(F.col("id").isNotNull())

    def labelled(side: Column) -> DataFrame:
        # labels grow with the corpus: merged at every size, never sent to all tasks
        return rows.where(side).join(_sampled(known.where(side), most).hint("merge"), "id").select("text", "good")

    def stored_lines(texts: list[bytes | None]) -> dict[str, list]:
        measures, _, n_lines = measure(texts)
        cuts = np.cumsum(n_lines)
        return {"n_lines": n_lines, "measures": [measures[e - n:e].astype("<f4").tobytes() for n, e in zip(n_lines.tolist(), cuts.tolist())]}

    lines = map_texts(labelled(_side("id") < 2), "text", ["good"], "n_lines long, measures binary", stored_lines)
    stored = materialize(lines.where("n_lines > 0"), "lines")

    def moments(good: np.ndarray, n_lines: np.ndarray, measures: np.ndarray) -> np.ndarray:
        x = with_neighbours(measures, n_lines)
        return np.concatenate([[len(good), good.sum(), len(x)], x.sum(axis=0), (x * x).sum(axis=0)])

    n_docs, n_good, n_lines, *sums = _total(stored, moments, 3 + 2 * SIZE)
    mean, square = np.array(sums[:SIZE]) / max(n_lines, 1), np.array(sums[SIZE:]) / max(n_lines, 1)
    scale = np.sqrt(np.maximum(square - mean * mean, 0))
    shift, scale = np.where(scale > 1e-6, mean, 0.0), np.where(scale > 1e-6, scale, 1.0)
    model = Field(shift, scale, np.zeros(SIZE), np.zeros((2, 2)))
    if 0 < n_good < n_docs:
        def step(before: Field | None, free: np.ndarray) -> Callable[[np.ndarray], tuple[float, np.ndarray]]:
            def evaluate(x: np.ndarray) -> tuple[float, np.ndarray]:
                now = Field(shift, scale, x[:SIZE], x[SIZE:].reshape(2, 2))
                total = _total(stored, lambda *part: _value(*part, now, before), 1 + SIZE + 4)
                bound = np.append(np.ones(SIZE - 1), np.zeros(5)) * x * PENALTY
                bound[SIZE:] = x[SIZE:] * PENALTY
                return (total[0] + float(bound @ x) / 2) / n_lines, (total[1:] + bound) * free / n_lines
            return evaluate

        x = _descend(step(None, np.append(np.ones(SIZE), np.zeros(4))), np.zeros(SIZE + 4), STEPS[0])
        alone = Field(shift, scale, x[:SIZE], np.zeros((2, 2)))
        x = _descend(step(alone, np.ones(SIZE + 4)), x, STEPS[1])
        model = Field(shift, scale, x[:SIZE], x[SIZE:].reshape(2, 2))
    seen = _judged(labelled(_side("id") == 3), model, "text", ["good"]).cache()
    sums = seen.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("good"), F.lit(0)).alias("good")).first()
    if 0 < sums["good"] < sums["n"]:
        x = VectorAssembler(inputCols=list(FEATURES), outputCol="x").transform(seen)
        curve = LogisticRegression(featuresCol="x", labelCol="good", regParam=1e-4, maxIter=100).fit(x)
        model.curve = (float(curve.intercept), *map(float, curve.coefficients))
    else:
        share = sums["good"] / sums["n"] if sums["n"] else 1.0
        model.curve = (500.0 if share == 1 else -500.0, *[0.0] * len(FEATURES))
    seen.unpersist()
    return model


def _judged(docs: DataFrame, model: Field, text: str, carry: Sequence[str]) -> DataFrame:
    shipped = docs.sparkSession.sparkContext.broadcast(model)
    return map_texts(docs, text, carry, "_good double, _worst double, _length double, n_lines long, n_bad long", lambda texts: shipped.value.judge(texts))


def score(docs: DataFrame, model: Field, text: str = "text", carry: Sequence[str] = ("doc_id",)) -> DataFrame:
    """``score`` (0 to 1, higher: good likelier), ``n_lines`` and ``n_bad`` (lines more likely bad than good) of every whole text, one row per
    row of ``docs``; only the text is looked at.

    A null or empty text has no lines, and one without words no weight: both count as undecided and get what the curve gives for that.
    Repeated rows score alike; null ids and further columns make no difference; an empty table gives an empty result.
    """
    out = ("score", "n_lines", "n_bad")
    carry = carried(carry, out)
    inner = [f"carry_{i}" for i in range(len(carry))]
    named = docs.select(*[F.col(f"`{c}`").alias(i) for c, i in zip(carry, inner)], F.col(f"`{text}`").cast("string").alias("text"))
    z = F.lit(model.curve[0])
    for weight, feature in zip(model.curve[1:], FEATURES):
        z = z + weight * F.col(feature)
    z = F.greatest(F.lit(-500.0), F.least(F.lit(500.0), z))
    return _judged(named, model, "text", inner).select(
        *[F.col(i).alias(c) for c, i in zip(carry, inner)], (1 / (1 + F.exp(-z))).alias("score"), "n_lines", "n_bad")


def op12_linequality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    scored = score(docs, fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
    return scored.select("doc_id", F.coalesce(_side("doc_id") == 2, F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= 0.7).cast("int").alias("predicted"), "n_lines", "n_bad")
