"""Shared plumbing: Arrow batches of texts in, columns out; words and their hashes.

Every operator here reads only the columns it is told to and carries along only those it is told
to, so further columns of the input, whatever their names, neither matter nor clash.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Columns of the documents table.
DOCUMENTS = ("doc_id", "text", "lang", "source", "n_chars")
_TEXT = "_llm_text"
_SPACE = bytes(range(9, 14)) + b" "


#: Bytes of text that a function sees at a time (a longer text comes alone): bounds a task's Python objects.
SLICE_BYTES = 4_000_000


def slices(column: pa.Array) -> Iterator[list[bytes | None]]:
    """The UTF-8 bytes of a column of texts, about SLICE_BYTES at a time."""
    binary = column.cast(pa.binary())
    ends = np.cumsum(pc.fill_null(pc.binary_length(binary), 0).to_numpy(zero_copy_only=False))
    at = 0
    while at < len(binary):
        before = ends[at - 1] if at else 0
        stop = max(at + 1, int(np.searchsorted(ends, before + SLICE_BYTES, side="right")))
        yield binary[at:stop].to_pylist()
        at = stop


def carried(carry: Sequence[str], fields: Sequence[str]) -> list[str]:
    """The carried columns; one that has the name of a result gives way to it."""
    return [c for c in carry if c not in fields]


def map_texts(docs: DataFrame, text: str, carry: Sequence[str], fields: str,
              fn: Callable[[list[bytes | None]], dict[str, Sequence]]) -> DataFrame:
    """One output row per input row: the ``carry`` columns and ``fields`` computed from whole texts.

    ``fn`` gets the UTF-8 bytes of a slice of an Arrow batch of texts and returns one sequence per field.
    Nothing is shuffled, a batch is the most a task holds, and a retried task repeats its rows.
    """
    added = T._parse_datatype_string(fields)
    carry = carried(carry, added.names)
    schema = T.StructType([docs.schema[c] for c in carry] + list(added))
    names, n = list(added.names), len(carry)
    # a text that is carried along anyway is sent once
    sent = isinstance(docs.schema[text].dataType, T.StringType) and text in carry
    place = list(carry).index(text) if sent else n

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = None
        for batch in batches:
            if kinds is None:
                kinds = [arrow_type(f.dataType) for f in added]
            parts = []
            for part in slices(batch.column(place)):
                out = fn(part)
                parts.append([pa.array(out[c], k) for c, k in zip(names, kinds)])
            columns = [pa.concat_arrays(c) for c in zip(*parts)] if parts else [pa.array([], k) for k in kinds]
            yield pa.RecordBatch.from_arrays([batch.column(i) for i in range(n)] + columns, names=schema.names)

    columns = [F.col(f"`{c}`") for c in carry]
    return docs.select(*columns, *([] if sent else [F.col(f"`{text}`").cast("string").alias(_TEXT)])).mapInArrow(run, schema)


def arrow_type(kind: T.DataType) -> pa.DataType:
    if isinstance(kind, T.ArrayType):
        return pa.list_(arrow_type(kind.elementType))
    return {"bigint": pa.int64(), "int": pa.int32(), "double": pa.float64(), "boolean": pa.bool_(),
            "string": pa.string(), "binary": pa.binary()}[kind.simpleString()]


def split_words(text: bytes | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+``; bytes.split() cuts at exactly those six bytes."""
    return text.split() if text else []


def hash_words(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


#: Fixed odd multipliers; the i-th weighs the i-th word of a run.
_rng = np.random.Generator(np.random.PCG64(20240601))
MULTIPLIERS = _rng.integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def hash_runs(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` consecutive words; empty when there are fewer words."""
    n = len(words) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for i in range(size):
        total += words[i:i + n] * MULTIPLIERS[i]
    return mix(total)
