"""Mixture-controlled packing of token streams into fixed windows by deficit round-robin.

Every source is a queue of packets, parts of documents of a set size.  In each round a queue earns its target
share of a window as credit, sends the packets its credit pays for, and keeps the rest (its deficit) for the next
round.  The round in which a packet can be paid is a formula of the tokens before it in its queue, so the deficits are known everywhere, and
the packets in order of round and queue are one stream, which is cut into full windows by a distributed running sum.
"""

from __future__ import annotations

import json
from bisect import bisect_right
from collections import defaultdict
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from stockyard.llm.texts import carried
from stockyard.operators.ordering import running_sums
from stockyard.workspace import materialize

# Fixed value: the split pattern that goes with the byte-level pre-tokenizer.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def _bytes_of_characters() -> dict[str, int]:
    """The printable stand-ins that byte-level vocabularies use for bytes."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    shifted = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(shifted)}


class Encoder:
    """Ids as the tokenizer file gives them, without added special tokens.

    A plain byte-level BPE file whose ids follow its merges is run by its ranks, which is several times
    faster and gives the same ids; any other file by its own library.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, cut = spec["model"], spec.get("pre_tokenizer") or {}
        self.ranked = None
        if (model.get("type") == "BPE" and cut.get("type") == "ByteLevel" and not cut.get("add_prefix_space")
                and cut.get("use_regex", True) and not spec.get("normalizer") and not model.get("ignore_merges")):
            added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
            vocabulary = {k: v for k, v in model["vocab"].items() if k not in added}
            made = [vocabulary["".join(m.split(" ") if isinstance(m, str) else m)] for m in model["merges"]]
            plain = not any(t.get(k) for t in spec.get("added_tokens", []) for k in ("lstrip", "rstrip", "single_word", "normalized"))
            if plain and made == sorted(made) and len(made) + 256 == len(vocabulary):
                to_byte = _bytes_of_characters()
                ranks = {bytes(to_byte[c] for c in k): v for k, v in vocabulary.items()}
                self.ranked = tiktoken.Encoding("ranked", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=added)
        if self.ranked is None:
            self.plain = Tokenizer.from_file(path)

    def ids(self, text: str) -> np.ndarray:
        if self.ranked is not None:
            return self.ranked.encode_to_numpy(text, allowed_special="all").astype(np.uint32)
        return np.asarray(self.plain.encode(text, add_special_tokens=False).ids, np.uint32)


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


class Windows:
    """The sequences of a stream of ``total`` tokens: full ones of ``size``, then what is left in powers of two, nothing padded."""

    def __init__(self, total: int, size: int):
        self.size, self.full = size, total // size
        self.tail = [0]  # where the sequences behind the full ones start and end, from the first of them
        for bit in reversed(range((total % size).bit_length())):
            if total % size >> bit & 1:
                self.tail.append(self.tail[-1] + (1 << bit))

    def pieces(self, place: int, length: int) -> Iterator[tuple[int, int, int]]:
        """(length, sequence, offset) of the pieces of the stream's tokens place.. in order."""
        end = place + length
        while place < end:
            window, offset, room = place // self.size, place % self.size, self.size - place % self.size
            if window >= self.full:
                beyond = place - self.full * self.size
                k = bisect_right(self.tail, beyond) - 1
                window, offset, room = self.full + k, beyond - self.tail[k], self.tail[k + 1] - beyond
            yield min(end - place, room), window, offset
            place += room


def tokenize(docs: DataFrame, tokenizer: str, end_id: int, text: str, source: str, carry: Sequence[str]) -> DataFrame:
    """Ids of whole texts plus ``end_id``; with the task that made them, the row's number and the tokens of the same
    source before it in that task.  Ids take two bytes each where all of a text's fit, else four."""
    schema = T.StructType([docs.schema[c] for c in carry] + list(T._parse_datatype_string(
        "_source string, _ids binary, _n long, _task long, _row long, _before long")))
    k = len(carry)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        ids_of, task, seen, rows = encoder(tokenizer).ids, TaskContext.get().partitionId(), defaultdict(int), 0
        for batch in batches:
            sources = [s or "" for s in batch.column(k).to_pylist()]
            packed, sizes, before = [], [], []
            for name, value in zip(sources, batch.column(k + 1)):
                ids = np.append(ids_of(value.as_py() or ""), np.uint32(end_id))
                packed.append(ids.astype("<u2" if ids.max() < 1 << 16 else "<u4").tobytes())
                sizes.append(len(ids))
                before.append(seen[name])
                seen[name] += sizes[-1]
            yield pa.RecordBatch.from_arrays(
                [batch.column(i) for i in range(k)]
                + [pa.array(sources, pa.string()), pa.array(packed, pa.binary()), pa.array(sizes, pa.int64()),
                   pa.array([task] * len(sizes), pa.int64()), pa.array(range(rows, rows + len(sizes)), pa.int64()),
                   pa.array(before, pa.int64())], names=schema.names)
            rows += len(sizes)

    return docs.select(*[F.col(f"`{c}`") for c in carry], F.col(f"`{source}`").cast("string").alias("_llm_source"),
                       F.col(f"`{text}`").cast("string").alias("_llm_text")).mapInArrow(run, schema)


def packets(docs: DataFrame, quantum: int) -> DataFrame:
    """One row for each packet of a document of ``_n`` tokens: ``_start`` and ``_stop`` in it.  A packet has from ``quantum`` to twice as
    many tokens; a shorter document is one."""
    parts = F.greatest(F.expr(f"_n div {quantum}"), F.lit(1))
    cut = docs.withColumn("_parts", parts).withColumn("_part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_parts") - 1)))
    return cut.withColumns({"_start": F.expr("_part * _n div _parts"), "_stop": F.expr("(_part + 1) * _n div _parts")}).drop("_parts", "_part")


def schedule(stored: DataFrame, size: int, quantum: int, weights: dict[str, int] | None, others: int) -> tuple[DataFrame, int]:
    """The place in the stream of every packet (``_task``, ``_row``, ``_start``, ``_stop``, ``_queue``, ``_place``), and the stream's tokens.

    In a round a queue earns its share of ``size`` tokens as credit; it sends its next packet as soon as its credit pays for it
    and keeps the rest, its deficit, for later rounds.  So a packet's round follows from the tokens before it in its queue alone, and
    its place is a running sum over (round, queue).  A queue starts with a part of its first packet's price, by the hash of its name: otherwise all small queues
    would send in one round.
    """
    runs = stored.groupBy("_task", "_source").agg(F.sum("_n").alias("_run"), F.min_by("_n", "_before").alias("_first"))
    sources = materialize(runs.groupBy("_source").agg(F.sum("_run").alias("_total"), F.min_by("_first", "_task").alias("_first")), "sources")
    if weights:
        named = stored.sparkSession.createDataFrame(sorted(weights.items()), "_source string, _weight long")
        sources = sources.join(named, "_source", "left")
    else:
        sources = sources.withColumn("_weight", F.lit(None).cast("long"))
    free = F.col("_weight").isNull()
    sums = sources.agg(F.sum("_total"), F.sum(F.when(free, F.col("_total"))), F.sum("_weight")).first()
    total, rest, earned = (x or 0 for x in sums)
    share = F.coalesce(F.col("_weight").cast("double"), others * F.col("_total") / max(rest, 1)) / (earned + (others if rest else 0))
    price = F.expr(f"(_first div greatest(_first div {quantum}, 1))")
    lead = price * (F.pmod(F.xxhash64("_source"), F.lit(1 << 20)) / (1 << 20))
    queues = running_sums(sources.withColumns({"_all": F.lit(0), "_one": F.lit(1).cast("long")}), ["_all"], ["_source"], {"_number": "_one"})
    queues = queues.select("_source", (F.col("_number") - 1).cast("int").alias("_queue"), (size * share).alias("_credit"), lead.alias("_lead"))
    runs = running_sums(runs, ["_source"], ["_task"], {"_until": "_run"})
    runs = materialize(runs.select("_task", "_source", (F.col("_until") - F.col("_run")).alias("_base")).join(queues, "_source"), "runs")
    sent = packets(stored.select("_task", "_row", "_source", "_n", "_before").join(runs, ["_task", "_source"]), quantum)
    upto = F.col("_base") + F.col("_before") + F.col("_stop")
    sent = sent.select("_task", "_row", "_start", "_stop", "_queue", upto.alias("_upto"), (F.col("_stop") - F.col("_start")).alias("_length"),
                       F.ceil((upto - F.col("_lead")) / F.col("_credit")).alias("_round"), F.lit(0).alias("_all"))
    sent = running_sums(sent, ["_all"], ["_round", "_queue", "_upto"], {"_end": "_length"})
    return sent.select("_task", "_row", "_start", "_stop", "_queue", (F.col("_end") - F.col("_length")).alias("_place")), total


def pack(docs: DataFrame, tokenizer: str, end_id: int, size: int = 2048, weights: dict[str, int] | None = None, others: int | None = None,
         quantum: int | None = None, text: str = "text", source: str = "source", carry: Sequence[str] = ("doc_id",)) -> DataFrame:
    """Sequences of ``size`` tokens that mix the sources in target proportions; one row per piece.

    Columns: ``carry``, ``start`` (the document's tokens before the piece), ``length``, ``ids``
    (binary, little-endian unsigned 32-bit), ``doc_tokens``, ``sequence_id``, ``offset`` (gapless from 0
    in each sequence) and ``queue``, a number for every source.  Without ``weights`` the target is the sources' share of all
    tokens, so all queues end together.  ``weights`` gives positive whole-number proportions of named sources, ``others`` that of all
    unnamed ones together (default 1), of which each has a share by its tokens.  When a queue is empty the others go on in their proportions.

    Queues send packets of ``quantum`` (default an eighth of ``size``) to twice as many tokens, or a shorter document whole, so a document of n
    tokens is cut into n / quantum pieces at most, and where a sequence ends.  At any round a queue is less than two packets from its target.

    A null text or source counts as empty; an empty text is its end token alone.  Repeated rows are packed
    as often as they occur, null ids and further columns make no difference, an empty table gives no
    pieces.  Token ids are written once to the shared folder; a lost executor repeats only its tasks.
    """
    carry = carried(carry, ("start", "length", "ids", "doc_tokens", "sequence_id", "offset", "queue"))
    quantum = quantum or max(1, size // 8)
    if min(size, quantum, *(weights or {}).values(), 1 if others is None else others) < 1:
        raise ValueError("size, quantum and weights must be positive")
    stored = materialize(tokenize(docs, tokenizer, end_id, text, source, carry), "tokens")
    sent, total = schedule(stored, size, quantum, weights, others or 1)
    places = sent.groupBy("_task", "_row").agg(F.first("_queue").alias("_queue"),
                                               F.sort_array(F.collect_list(F.struct("_start", "_stop", "_place"))).alias("_places"))
    # a packet's place is 2 % of its ids: the side to hash
    rows = stored.join(places.hint("shuffle_hash"), ["_task", "_row"]).select(
        *[F.col(f"`{c}`") for c in carry], "_ids", "_n", "_queue", *[F.col(f"_places.{c}").alias(c) for c in ("_start", "_stop", "_place")])
    schema = T.StructType([docs.schema[c] for c in carry] + list(T._parse_datatype_string(
        "start long, length long, ids binary, doc_tokens long, sequence_id long, offset long, queue int")))
    k, windows = len(carry), Windows(total, size)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, out = [], []
            for i, (raw, n, queue, *packets) in enumerate(zip(*(batch.column(k + x).to_pylist() for x in range(6)))):
                raw = np.frombuffer(raw, "<u2" if len(raw) == 2 * n else "<u4").astype("<u4").tobytes()
                joined = []  # packets that follow each other in the stream are one
                for start, stop, place in zip(*packets):
                    if joined and joined[-1][2] + joined[-1][1] - joined[-1][0] == place:
                        joined[-1][1] = stop
                    else:
                        joined.append([start, stop, place])
                for at, stop, place in joined:
                    for length, sequence, offset in windows.pieces(place, stop - at):
                        row.append(i)
                        out.append((at, length, raw[4 * at:4 * (at + length)], n, sequence, offset, queue))
                        at += length
            take = pa.array(row, pa.int64())
            columns = list(zip(*out)) if out else [()] * 7
            yield pa.RecordBatch.from_arrays(
                [batch.column(i).take(take) for i in range(k)]
                + [pa.array(c, t) for c, t in zip(columns, [pa.int64(), pa.int64(), pa.binary(), *[pa.int64()] * 3, pa.int32()])],
                names=schema.names)

    return rows.mapInArrow(cut, schema)


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    pieces = pack(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("byte_bpe_50k.json"), end_id=1)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
