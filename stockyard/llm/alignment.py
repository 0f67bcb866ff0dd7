"""Alignment of the tokens of two tokenizers by interval coalescing.

All tokens of both sides are byte intervals of one text.  They are sorted by start together; a running maximum of
their ends tells where nothing reaches across, and there a group ends.  Inside a group every token of one side is linked
with every token of the other.  How many documents of the corpus link a pair of ids is then counted, and every
document's links are weighed by these counts.

The texts are cut once and their pairs of ids written; counts are a Spark table that grows with the corpus.  Tasks get the most
frequent pairs, a fixed number; the others are looked up by a join, so no key of that join is frequent.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockyard.llm import packing
from stockyard.llm.texts import carried, slices
from stockyard.workspace import materialize

#: Pairs that all tasks may hold, 17 bytes each; pairs that a task gathers before it sends their counts; links of a group that are written
#: out one by one, while a larger group is first reduced to its distinct ids.
FREQUENT = 1 << 19
GATHERED = 4_000_000
WIDE_GROUP = 1 << 14

FIELDS = "n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"
MARK = "▁"  # fixed value: the space of sentencepiece vocabularies


class ByteSide:
    """A byte-level BPE file: ids of space + text, and the bytes of every id."""

    def __init__(self, path: str):
        self.coder = packing.encoder(path)
        if self.coder.ranked is None:
            self.coder.plain.encode_special_tokens = True  # their strings are then ordinary text
            names = self.coder.plain.get_vocab(with_added_tokens=False)
            stands = packing._bytes_of_characters()
            size = max(self.coder.plain.get_vocab().values()) + 1
            self.bytes = [b""] * size
            for name, i in names.items():
                self.bytes[i] = bytes(stands[c] for c in name)
        else:
            self.bytes = [b""] * self.coder.ranked.n_vocab
            for piece in self.coder.ranked.token_byte_values():
                self.bytes[self.coder.ranked.encode_single_token(piece)] = piece

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        if self.coder.ranked is not None:
            return [self.coder.ranked.encode_to_numpy(" " + t, allowed_special=set(), disallowed_special=()).astype(np.int64) for t in texts]
        return [np.array(e.ids, np.int64) for e in self.coder.plain.encode_batch([" " + t for t in texts], add_special_tokens=False)]


class PieceSide:
    """A sentencepiece model, which puts the space itself."""

    def __init__(self, path: str):
        self.coder = sentencepiece.SentencePieceProcessor(model_file=path)
        self.bytes = []
        for i in range(self.coder.GetPieceSize()):
            piece = self.coder.IdToPiece(i)
            self.bytes.append(bytes([int(piece[3:5], 16)]) if self.coder.IsByte(i) else piece.replace(MARK, " ").encode())

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(x, np.int64) for x in self.coder.encode(texts, num_threads=1)]


@lru_cache(maxsize=4)
def _side(path: str, kind: type) -> ByteSide | PieceSide:
    """A worker keeps its tokenizers from task to task."""
    return kind(path)


@dataclass(frozen=True)
class Groups:
    """Tokens of one or more texts, end to end, with the number of the group of each."""

    a: np.ndarray
    b: np.ndarray
    count: int


def coalesce(a_sizes: np.ndarray, b_sizes: np.ndarray) -> Groups:
    """Groups of the tokens of both sides, given the bytes of each token; both sides cover the same bytes."""
    a_ends, b_ends = np.cumsum(a_sizes), np.cumsum(b_sizes)
    starts, ends = np.concatenate([a_ends - a_sizes, b_ends - b_sizes]), np.concatenate([a_ends, b_ends])
    order = np.lexsort((ends, starts))
    reach = np.maximum.accumulate(ends[order])
    begins = np.ones(len(order), bool)
    begins[1:] = starts[order][1:] >= reach[:-1]
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(begins) - 1
    return Groups(group[:len(a_sizes)], group[len(a_sizes):], int(begins.sum()))


def _expand(groups: Groups, a: np.ndarray, b: np.ndarray, size_b: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Group, pair (a · size_b + b) and multiplicity of every link; links of a wide group come once for each pair of ids."""
    n_a, n_b = np.bincount(groups.a, minlength=groups.count), np.bincount(groups.b, minlength=groups.count)
    wide = n_a * n_b > WIDE_GROUP
    usual = ~wide[groups.a]
    at_a, times = np.flatnonzero(usual), n_b[groups.a[usual]]
    first_b = np.concatenate([[0], np.cumsum(n_b)])
    rows = np.repeat(at_a, times)
    inner = np.arange(len(rows)) - np.repeat(np.cumsum(times) - times, times)
    parts = [(groups.a[rows], a[rows] * size_b + b[first_b[groups.a[rows]] + inner], np.ones(len(rows), np.int64))]
    for g in np.flatnonzero(wide):
        ua, ca = np.unique(a[np.searchsorted(groups.a, g):np.searchsorted(groups.a, g, "right")], return_counts=True)
        ub, cb = np.unique(b[first_b[g]:first_b[g + 1]], return_counts=True)
        pairs = (ua[:, None] * size_b + ub[None, :]).ravel()
        parts.append((np.full(len(pairs), g), pairs, (ca[:, None] * cb[None, :]).ravel()))
    return tuple(np.concatenate(x) for x in zip(*parts))


class Aligner:
    """What a task needs: both sides, the bytes of their ids, and ids as text with the sign that follows them."""

    def __init__(self, a_path: str, b_path: str):
        self.sides = _side(a_path, ByteSide), _side(b_path, PieceSide)
        self.sizes = [np.array([len(x) for x in s.bytes], np.int64) for s in self.sides]
        self.size_b = len(self.sizes[1])
        numbers = [[str(i) for i in range(len(s))] for s in self.sizes]
        # id + sign in one list: A inside a group, A before B, B inside a group, B before the next group
        self.signs = [n + sign for ids, signs in zip(numbers, (",|", ",;")) for sign in signs for n in ids]
        self.at = [0, len(self.sizes[0]), 2 * len(self.sizes[0]), 2 * len(self.sizes[0]) + self.size_b]

    def align(self, texts: Sequence[bytes | None]) -> dict[str, list]:
        """FIELDS of every text, ``pairs`` (sorted distinct pairs of linked ids) and ``times`` (links of each), as bytes."""
        filled = [i for i, t in enumerate(texts) if t]
        plain = [texts[i].decode() for i in filled]
        ids = [s.ids(plain) for s in self.sides]
        whole = []
        for k, i in enumerate(filled):
            spaced = b" " + texts[i]
            if all(b"".join(map(s.bytes.__getitem__, x[k].tolist())) == spaced for s, x in zip(self.sides, ids)):
                whole.append(k)
        out = {"n_a": [0] * len(texts), "n_b": [0] * len(texts), "n_groups": [0] * len(texts), "n_links": [0] * len(texts),
               "groups_sha256": [""] * len(texts), "pairs": [None] * len(texts), "times": [None] * len(texts)}
        if not whole:
            return out
        a, b = (np.concatenate([x[k] for k in whole]) for x in ids)
        doc_a, doc_b = (np.repeat(np.arange(len(whole)), [len(x[k]) for k in whole]) for x in ids)
        groups = coalesce(self.sizes[0][a], self.sizes[1][b])
        group_doc = np.empty(groups.count, np.int64)
        group_doc[groups.a] = doc_a
        n_a, n_b = np.bincount(groups.a, minlength=groups.count), np.bincount(groups.b, minlength=groups.count)
        counts = {"n_a": np.bincount(doc_a), "n_b": np.bincount(doc_b), "n_groups": np.bincount(group_doc),
                  "n_links": np.add.reduceat(n_a * n_b, np.searchsorted(group_doc, np.arange(len(whole))))}
        # the text of the groups: tokens by group, A before B, each with the sign that follows
        last_a, last_b = (np.append(g[1:] != g[:-1], True) for g in (groups.a, groups.b))
        signed = np.concatenate([a + np.where(last_a, self.at[1], self.at[0]), b + np.where(last_b, self.at[3], self.at[2])])
        # a stable sort by group keeps A before B and both in order
        order = np.argsort(np.concatenate([groups.a, groups.b]), kind="stable")
        signed, ends = signed[order], np.cumsum(counts["n_a"] + counts["n_b"])
        # links by document and pair
        link_group, pair, times = _expand(groups, a, b, self.size_b)
        span = len(self.sizes[0]) * self.size_b
        key = group_doc[link_group] * span + pair
        if (times == 1).all():
            key, times = np.unique(key, return_counts=True)
        else:
            key, at = np.unique(key, return_inverse=True)
            times = np.bincount(at, times).astype(np.int64)
        cuts = np.searchsorted(key, np.arange(len(whole) + 1) * span)
        pair = (key % span).astype("<u4" if span < 2**32 else "<u8")
        for k, end in enumerate(ends.tolist()):
            i, begin = filled[whole[k]], end - int(counts["n_a"][k] + counts["n_b"][k])
            for name, values in counts.items():
                out[name][i] = int(values[k])
            text = "".join(map(self.signs.__getitem__, signed[begin:end].tolist()))
            out["groups_sha256"][i] = hashlib.sha256(text[:-1].encode()).hexdigest()
            out["pairs"][i] = pair[cuts[k]:cuts[k + 1]].tobytes()
            out["times"][i] = times[cuts[k]:cuts[k + 1]].astype("<u4").tobytes()
        return out


@lru_cache(maxsize=4)
def _aligner(a_path: str, b_path: str) -> Aligner:
    return Aligner(a_path, b_path)


def _read(pairs: bytes | None, kind: str) -> np.ndarray:
    return np.frombuffer(pairs or b"", kind).astype(np.int64)


def link_counts(stored: DataFrame, size_b: int, kind: str = "<u4") -> DataFrame:
    """``pair``, ``n`` (documents that hold the pair of ids linked) and ``best`` (no other pair of the same A id has more), over all rows
    of ``pairs``.  A task sends a pair once for many documents."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def counted(found: list[np.ndarray]) -> pa.RecordBatch:
            pairs, n = np.unique(np.concatenate(found), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(pairs), pa.array(n.astype(np.int64))], names=["pair", "n"])

        found, held = [], 0
        for batch in batches:
            for pairs in batch.column(0).to_pylist():
                found.append(_read(pairs, kind))
                held += len(found[-1])
                if held > GATHERED:
                    yield counted(found)
                    found, held = [], 0
        if found:
            yield counted(found)

    counts = stored.where("pairs IS NOT NULL").select("pairs").mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    counts = materialize(counts.withColumn("a_id", F.expr(f"pair div {size_b}")), "pair-counts")
    most = counts.groupBy("a_id").agg(F.max("n").alias("most"))  # one row for each id of the vocabulary
    return counts.join(most, "a_id").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def _split(counts: DataFrame, frequent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, DataFrame | None]:
    """The most frequent pairs, at most ``frequent``, sorted, with their counts and whether they are best; all others as a table."""
    bits = F.length(F.bin("n"))
    # at most 64 rows: how many pairs have a count of so many bits
    sizes = {r["bits"]: r["pairs"] for r in counts.groupBy(bits.alias("bits")).agg(F.count(F.lit(1)).alias("pairs")).collect()}
    least, held = 65, 0
    while least > 1 and held + sizes.get(least - 1, 0) <= frequent:
        least -= 1
        held += sizes.get(least, 0)
    top = counts.where(bits >= least).orderBy("pair").toArrow()  # at most ``frequent`` rows
    known = [top[c].to_numpy() for c in ("pair", "n", "best")]
    return *known, None if held == sum(sizes.values()) else counts.where(bits < least)


def align(docs: DataFrame, a_path: str, b_path: str, text: str = "text", carry: Sequence[str] = ("doc_id",), frequent: int = FREQUENT) -> DataFrame:
    """One row per row of ``docs``: the ``carry`` columns, FIELDS, ``n_best`` (links whose count is the highest of their A id in the whole
    corpus, ties included) and ``count_sum`` (counts summed over links).

    ``a_path`` is a byte-level BPE file, which encodes space + text, ``b_path`` a sentencepiece model, which encodes the text.  A null or empty
    text, or one that either side does not give back byte for byte (say with a U+2581 in it), has no tokens: zeros and ''.
    A repeated row counts as one more document; null ids and further columns make no difference; an empty table gives an empty result.
    Inside a group all tokens are linked, however many; a wide group is counted by its distinct ids.
    ``frequent`` pairs at most are sent to the tasks; it changes no result.
    """
    out = [f.strip().split()[0] for f in FIELDS.split(",")] + ["n_best", "count_sum"]
    carry = carried(carry, out)
    inner = [f"carry_{i}" for i in range(len(carry))]
    named = docs.select(*[F.col(f"`{c}`").alias(i) for c, i in zip(carry, inner)], F.col(f"`{text}`").cast("string").alias("_text"))
    size_a, size_b = (len(s.bytes) for s in (_side(a_path, ByteSide), _side(b_path, PieceSide)))
    kind = "<u4" if size_a * size_b < 2**32 else "<u8"
    added = T._parse_datatype_string(f"{FIELDS}, pairs binary, times binary")
    n = len(inner)
    schema = T.StructType([named.schema[c] for c in inner] + list(added))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(a_path, b_path)
        types = [pa.int64()] * 4 + [pa.string()] + [pa.binary()] * 2
        for batch in batches:
            at = 0
            for texts in slices(batch.column(n)):
                found = aligner.align(texts)
                yield pa.RecordBatch.from_arrays([batch.column(i).slice(at, len(texts)) for i in range(n)]
                                                 + [pa.array(found[c], k) for c, k in zip(added.names, types)], names=schema.names)
                at += len(texts)

    # written once: cutting is dear, and the pairs are read twice
    stored = materialize(named.mapInArrow(cut, schema), "aligned")
    *known, rest = _split(materialize(link_counts(stored, size_b, kind), "links"), frequent)
    shipped = docs.sparkSession.sparkContext.broadcast(known)
    weighed = T.StructType(list(schema)[:-2] + list(T._parse_datatype_string(
        "n_best long, count_sum long, _pairs array<bigint>, _times array<bigint>")))

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, counts, best = shipped.value
        for batch in batches:
            columns: list[list] = [[], [], [], []]
            for keys, times in zip(*(batch.column(i).to_pylist() for i in (len(weighed) - 4, len(weighed) - 3))):
                keys, times = _read(keys, kind), _read(times, "<u4")
                at = np.minimum(np.searchsorted(pairs, keys), max(len(pairs) - 1, 0))
                found = pairs[at] == keys if len(pairs) else np.zeros(len(keys), bool)
                at = at[found]
                columns[0].append(int(times[found][best[at]].sum()))
                columns[1].append(int((times[found] * counts[at]).sum()))
                columns[2].append(None if found.all() else keys[~found])
                columns[3].append(None if found.all() else times[~found])
            kinds = [pa.int64()] * 2 + [pa.list_(pa.int64())] * 2
            yield pa.RecordBatch.from_arrays([batch.column(i) for i in range(len(weighed) - 4)]
                                             + [pa.array(c, k) for c, k in zip(columns, kinds)], names=weighed.names)

    rows = stored.mapInArrow(weigh, weighed)
    if rest is not None:
        rows = materialize(rows.withColumn("_row", F.monotonically_increasing_id()), "weighed")
        late = rows.where("_pairs IS NOT NULL").select("_row", F.explode(F.arrays_zip("_pairs", "_times")).alias("_link"))
        # the rare pairs only: no key of this join is frequent
        found = (late.select("_row", F.col("_link._pairs").alias("pair"), F.col("_link._times").alias("times")).join(rest.hint("merge"), "pair")
                 .groupBy("_row").agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("_best"),
                                      F.sum(F.col("times") * F.col("n")).alias("_sum")))
        rows = rows.join(found, "_row", "left").withColumns({
            "n_best": F.col("n_best") + F.coalesce("_best", F.lit(0)), "count_sum": F.col("count_sum") + F.coalesce("_sum", F.lit(0))})
    return rows.select(*[F.col(i).alias(c) for c, i in zip(carry, inner)], *out)


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return align(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("byte_bpe_50k.json"),
                 public_tokenizers.path("piece_bpe_32k.model")).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
