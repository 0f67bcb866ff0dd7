"""Alignment of two tokenizers against brute force, with the tokenizers' own libraries."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from stockyard.llm import alignment, packing
from tests.llm import cases

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
FIELDS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def brute(texts):
    bpe = Tokenizer.from_file(A)
    bpe.encode_special_tokens = True
    piece = sentencepiece.SentencePieceProcessor(model_file=B)
    stands = packing._bytes_of_characters()
    all_links, out = [], []
    for t in texts:
        a = bpe.encode(" " + t, add_special_tokens=False).ids if t else []
        b = piece.encode(t) if t else []
        raw = [[bytes(stands[c] for c in bpe.id_to_token(i)) for i in a],
               [bytes([int(p[3:5], 16)]) if piece.IsByte(i) else p.replace("▁", " ").encode() for i, p in ((i, piece.IdToPiece(i)) for i in b)]]
        if not t or any(b"".join(x) != (" " + t).encode() for x in raw):
            all_links.append([])
            out.append([0, 0, 0, ""])
            continue
        ends = [np.cumsum([len(x) for x in side]).tolist() for side in raw]
        both = sorted(set(ends[0]) & set(ends[1]))
        groups = [([], []) for _ in both]
        for k, ids in enumerate((a, b)):
            for i, end in zip(ids, ends[k]):
                groups[next(g for g, cut in enumerate(both) if end <= cut)][k].append(i)
        all_links.append([(x, y) for g in groups for x in g[0] for y in g[1]])
        said = ";".join(",".join(map(str, g[0])) + "|" + ",".join(map(str, g[1])) for g in groups)
        out.append([len(a), len(b), len(groups), hashlib.sha256(said.encode()).hexdigest()])
    counts = Counter(p for links in all_links for p in set(links))
    most = defaultdict(int)
    for (x, _), n in counts.items():
        most[x] = max(most[x], n)
    return [(n_a, n_b, n_g, len(links), sum(counts[p] == most[p[0]] for p in links), sum(counts[p] for p in links), sha)
            for (n_a, n_b, n_g, sha), links in zip(out, all_links)]


@pytest.mark.parametrize("frequent,wide,gathered", [(1 << 19, 1 << 14, 4_000_000), (20, 3, 50), (0, 0, 1)])
def test_align(spark, frequent, wide, gathered, monkeypatch):
    monkeypatch.setattr(alignment, "WIDE_GROUP", wide)
    monkeypatch.setattr(alignment, "GATHERED", gathered)
    rng = random.Random(8)
    words = ["the", "running", "Übermaß", "日本語", "😀", "naïve", "12345", "<s>", "</s>", "<|endoftext|>", "\n", "  ", "\t", "a\x00b", "été", "aaaa"]
    texts = [None, "", " ", "\n", "x", "▁", "a ▁b", "<0x41>", "<|endoftext|>", "ﬁ Ⅳ", "é", "﻿x", "a" * 3000, "é" * 700, "​" * 50,
             "The cat sat.", "The cat sat.", "".join(chr(rng.randrange(33, 1200)) for _ in range(800))]
    texts += [" ".join(rng.choices(words, k=rng.randrange(1, 40))) for _ in range(25)] + [cases.prose(rng, 3000, 90)]
    df = spark.createDataFrame([cases.row(i if i else None, t) for i, t in enumerate(texts)], cases.SCHEMA).repartition(3)
    got = alignment.align(df, A, B, carry=("doc_id", "text", "n_words", "words"), frequent=frequent)
    assert got.columns == ["doc_id", "text", "n_words", "words", *FIELDS[:4], "groups_sha256", "n_best", "count_sum"]
    found = {r["doc_id"] or 0: tuple(r[c] for c in FIELDS) for r in got.collect()}
    for i, want in enumerate(brute(texts)):
        assert found[i] == want, texts[i]
    assert len(found) == len(texts) and sum(f[0] > 0 for f in found.values()) > 20


def test_align_empty(spark):
    assert alignment.align(cases.empty(spark), A, B).count() == 0
    nothing = alignment.align(cases.empty(spark).union(spark.createDataFrame([cases.row(1, None)], cases.SCHEMA)), A, B).collect()
    assert [tuple(r) for r in nothing] == [(1, 0, 0, 0, 0, "", 0, 0)]


def test_plain_library(spark, tmp_path):
    """A vocabulary that cannot be run by ranks gives the same tokens by its own library."""
    side = alignment.ByteSide(A)
    own = packing.Encoder.__new__(packing.Encoder)
    own.ranked, own.plain = None, Tokenizer.from_file(A)
    packing._encoders["own"] = own
    texts = ["The <|endoftext|> cat", "é\n\n x"]
    other = alignment.ByteSide("own")
    assert [x.tolist() for x in side.ids(texts)] == [x.tolist() for x in other.ids(texts)]
    assert [b"".join(other.bytes[i] for i in x) for x in other.ids(texts)] == [b" " + t.encode() for t in texts]


def test_query(spark, sf):
    """The thin query on the smallest tables."""
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    got = {r["doc_id"]: tuple(r[c] for c in FIELDS) for r in alignment.op13_alignment(spark, sf).collect()}
    assert len(got) == len(rows)
    assert [got[i] for i, _ in rows] == brute([t for _, t in rows])
