"""Byte-level BPE encoding and decoding by replaying merges over all distinct words of a block.

The merges of a rank file are applied to a whole vocabulary of words at once, not word by word: an
inverted index leads from each pair of neighbouring tokens to the positions where it stands; a
queue hands out pairs in rank order; a merge rewrites all its positions and re-indexes only the
neighbours it touched.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections import defaultdict
from collections.abc import Iterator, Sequence
from itertools import count

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockyard.llm.texts import carried

_NONE = np.int64(1 << 40)


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as file:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}


class MergeTable:
    """Ranks of token pairs: a pair may merge when the bytes of both, joined, have a rank."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        size = max(ranks.values()) + 1
        self.lengths = np.zeros(size, np.int64)
        pieces = [b""] * size
        pairs: dict[int, int] = {}
        for token, rank in ranks.items():
            pieces[rank] = token
            self.lengths[rank] = len(token)
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    pairs[left << 20 | right] = rank
        self.flat = np.frombuffer(b"".join(pieces), np.uint8)
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)[:-1]]).astype(np.int64)
        self.keys = np.array(sorted(pairs), np.int64)
        self.merged = np.array([pairs[k] for k in self.keys.tolist()], np.int64)
        self.single = np.array([ranks[bytes([b])] for b in range(256)], np.int64)

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        wanted = left << 20 | right
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where(self.keys[at] == wanted, self.merged[at], _NONE)

    def replay(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of all words, one after another, and the number of ids of each word."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(lengths)
        n = int(ends[-1]) if len(words) else 0
        # one sentinel on either side; a word's last token pairs with nothing
        token = np.full(n + 2, -1, np.int64)
        token[1:-1] = self.single[np.frombuffer(b"".join(words), np.uint8)]
        last = np.zeros(n + 2, bool)
        last[0] = last[-1] = True
        last[ends] = True
        after, before = np.arange(1, n + 3), np.arange(-1, n + 1)
        after[-1], before[0] = n + 1, 0
        rank = np.full(n + 2, _NONE, np.int64)
        inner = np.flatnonzero(~last)
        rank[inner] = self.pair_ranks(token[inner], token[inner + 1])
        alive = np.ones(n + 2, bool)
        # the inverted index: merge rank -> arrays of positions whose pair has that rank
        index: dict[int, list[np.ndarray]] = {}
        queue: list[int] = []

        def enter(positions: np.ndarray) -> None:
            ranks = rank[positions]
            mergeable = ranks < _NONE
            positions, ranks = positions[mergeable], ranks[mergeable]
            if not len(positions):
                return
            order = np.argsort(ranks, kind="stable")
            positions, ranks = positions[order], ranks[order]
            cuts = np.flatnonzero(ranks[1:] != ranks[:-1]) + 1
            for r, part in zip(ranks[np.concatenate([[0], cuts])].tolist(), np.split(positions, cuts)):
                if r in index:
                    index[r].append(part)
                else:
                    index[r] = [part]
                    heapq.heappush(queue, r)

        enter(inner)
        while queue:
            now = heapq.heappop(queue)
            parts = index.pop(now)
            at = parts[0] if len(parts) == 1 else np.unique(np.concatenate(parts))
            at = at[alive[at] & (rank[at] == now)]
            if not len(at):
                continue
            at.sort()
            if len(at) > 1:
                chained = after[at[:-1]] == at[1:]
                if chained.any():  # as in "aaa": the left pair takes the shared token
                    runs = np.cumsum(np.concatenate([[True], ~chained])) - 1
                    first = np.flatnonzero(np.concatenate([[True], ~chained]))
                    at = at[(np.arange(len(at)) - first[runs]) % 2 == 0]
            gone = after[at]
            token[at] = now
            alive[gone] = False
            last[at] = last[gone]
            following = after[gone]
            after[at] = following
            before[following] = at
            rank[gone] = _NONE
            rank[at] = _NONE
            open_right = at[~last[at]]
            left = before[at]
            open_left = left[~last[left]]
            touched = np.concatenate([open_left, open_right])
            rank[touched] = self.pair_ranks(token[touched], token[after[touched]])
            enter(np.unique(touched))
        kept = np.flatnonzero(alive[1:-1])
        sizes = np.bincount(np.searchsorted(ends, kept, side="right"), minlength=len(words))
        return token[1:-1][kept], sizes

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes of a sequence of ids."""
        return gather(self.flat, self.starts[ids], self.lengths[ids]).tobytes()


def gather(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The slices ``flat[starts[i]:starts[i] + sizes[i]]``, joined."""
    total = int(sizes.sum())
    shift = np.repeat(starts - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes) if total else np.empty(0, np.int64)
    return flat[np.arange(total) + shift]


_tables: dict[str, MergeTable] = {}


def merge_table(ranks_path: str) -> MergeTable:
    if ranks_path not in _tables:
        _tables[ranks_path] = MergeTable(read_ranks(ranks_path))
    return _tables[ranks_path]


def encode(docs: DataFrame, ranks_path: str, pattern: str, text: str = "text", carry: Sequence[str] = ("doc_id",),
           block_words: int = 4_000_000, digests: bool = False) -> DataFrame:
    """Token ids of every whole text, one row per row of ``docs``: ``n_tokens`` and ``ids`` (binary,
    little-endian unsigned 32-bit), or with ``digests`` their SHA-256 and that of the decoded bytes.

    Each match of ``pattern`` is encoded by itself, without special tokens.  A task cuts its
    Arrow batches into blocks of about ``block_words`` matches (a longer text is a block of its own), keeps
    for each text the numbers of its words, and replays the merges once over the block's distinct words.  Nothing is
    shuffled and no vocabulary of the corpus is held anywhere.  ``ranks_path`` must be readable on
    the executors.

    A null or empty text has no ids.  Null ids, repeated rows and further columns make no
    difference; an empty table gives an empty result.
    """
    added = "n_tokens long, ids_sha256 string, decoded_sha256 string" if digests else "n_tokens long, ids binary"
    fields = T._parse_datatype_string(added)
    carry = carried(carry, fields.names)
    schema = T.StructType([docs.schema[c] for c in carry] + list(fields))
    k = len(carry)

    def block(table: MergeTable, words: list[bytes], rows: list[np.ndarray]) -> list[tuple]:
        ids, sizes = table.replay(words)
        starts = np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64) if len(words) else np.empty(0, np.int64)
        out = []
        for row in rows:
            own = gather(ids, starts[row], sizes[row]) if len(row) else ids[:0]
            packed = own.astype("<u4").tobytes()
            out.append((len(own), hashlib.sha256(packed).hexdigest(), hashlib.sha256(table.decode(own)).hexdigest())
                       if digests else (len(own), packed))
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, cut = merge_table(ranks_path), regex.compile(pattern).findall
        for batch in batches:
            column, done = batch.column(k), 0
            number: dict[str, int] = defaultdict(count().__next__)
            rows, held, out = [], 0, []
            for value in column:
                found = cut(value.as_py() or "")
                rows.append(np.fromiter(map(number.__getitem__, found), np.int64, len(found)))
                held += len(found)
                if held >= block_words:
                    out += block(table, [w.encode("utf-8", "surrogatepass") for w in number], rows)
                    number, rows, held = defaultdict(count().__next__), [], 0
            if rows:
                out += block(table, [w.encode("utf-8", "surrogatepass") for w in number], rows)
            columns = list(zip(*out)) if out else [()] * (3 if digests else 2)
            kinds = [pa.int64(), pa.string(), pa.string()] if digests else [pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays([batch.column(i) for i in range(k)]
                                             + [pa.array(c, t) for c, t in zip(columns, kinds)], names=schema.names)

    return docs.select(*[F.col(f"`{c}`") for c in carry], F.col(f"`{text}`").cast("string").alias("_llm_text")).mapInArrow(run, schema)


def decode(coded: DataFrame, ranks_path: str, ids: str = "ids", carry: Sequence[str] = ("doc_id",)) -> DataFrame:
    """``text`` of every row's ``ids`` (binary, as :func:`encode` gives them); null ids give null.
    Bytes that are not UTF-8, from ids cut inside a character, become the replacement character."""
    carry = carried(carry, ["text"])
    schema = T.StructType([coded.schema[c] for c in carry] + [T.StructField("text", T.StringType())])
    k = len(carry)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = merge_table(ranks_path)
        for batch in batches:
            texts = [None if b is None else table.decode(np.frombuffer(b, "<u4").astype(np.int64)).decode("utf-8", "replace")
                     for b in batch.column(k).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(i) for i in range(k)] + [pa.array(texts, pa.string())],
                                             names=schema.names)

    return coded.select(*[F.col(f"`{c}`") for c in carry], F.col(f"`{ids}`").alias("_llm_ids")).mapInArrow(run, schema)


def op3_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return encode(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
                  public_tokenizers.PATTERN, digests=True)
