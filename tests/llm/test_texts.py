"""Licences, quality rules, tokens, packing and toxicity against brute force."""

import base64
import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from stockyard.llm import licenses, packing, quality, tokens, toxicity
from stockyard.llm.texts import hash_words, mix
from tests.llm import cases

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def test_expressions():
    allowed = frozenset({"mit", "apache-2.0"})
    for text, want in {
        "MIT": True, "GPL-2.0-only": False, "MIT OR GPL-2.0-only": True, "MIT AND GPL-2.0-only": False,
        "MIT OR GPL-2.0-only AND GPL-3.0-only": True, "(MIT OR GPL-2.0-only) AND GPL-3.0-only": False,
        "Apache-2.0 WITH LLVM-exception AND MIT": True, "MIT */": True, "((MIT))": True, "MIT --> GPL-3.0-only": True, "MIT*/": True,
    }.items():
        assert licenses.evaluate(text, allowed)[0] is want, text
    for text in ("", "AND MIT", "MIT OR", "(MIT", ")", "( )", "MIT)", "MIT/GPL-3.0-only", "MIT GPL-3.0-only", "MIT, GPL-3.0-only", "MIT & ISC", "*/"):
        assert licenses.evaluate(text, allowed) is None, text
    assert licenses.evaluate("GPL-2.0 WITH Classpath-exception-2.0 OR MIT", allowed) == (True, ["gpl-2.0 with classpath-exception-2.0", "mit"])


def test_licenses(spark):
    texts = ["The MIT License. MIT license mit-LICENSE", "GNU General Public License, version 3", "mit licenses", None, "", " ",
             "x SPDX-License-Identifier: MIT OR GPL-2.0-only\nend", "SPDX-License-Identifier: (MIT", "All rights reserved.",
             "é mit license", "mit\x7flicense", "w " * 50_000 + "Apache License", "GNU Affero General Public License",
             "SPDX-License-Identifier: MIT\nSPDX-License-Identifier: MIT/GPL-3.0-only"]
    df = spark.createDataFrame([cases.row(i if i else None, t) for i, t in enumerate(texts)], cases.SCHEMA)
    got = {r["doc_id"] or 0: r for r in licenses.scan(df).collect()}
    for i, t in enumerate(texts):
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(cases.LOWER))
        places = [(k, label) for phrase, label in licenses.BASE.items() for k in range(len(w)) if w[k:k + len(phrase.split())] == phrase.split()]
        r, starts = got[i], sorted(k for k, _ in places)
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == (
            len(w), len(places), *((starts[0], starts[-1]) if starts else (None, None)), ",".join(sorted({x for _, x in places})))
        assert set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(",")) and 0 <= r["score"] <= 1
    assert got[6]["permissive"] is True and "spdx:mit" in got[6]["labels"] and got[6]["score"] == 1
    assert got[7]["permissive"] is None and got[8]["labels"] == "all-rights-reserved" and got[12]["labels"] == "agpl,gpl"
    assert got[3]["labels"] == "" and got[3]["score"] == 0
    assert got[13]["permissive"] is None and got[13]["expressions"] == "MIT"
    assert licenses.scan(cases.empty(spark)).count() == 0


def test_quality(spark):
    df, rows = cases.documents(spark)
    got = defaultdict(list)
    for r in quality.clean(df).collect():
        got[r["doc_id"]].append(r)
    assert sum(map(len, got.values())) == len(rows)
    for i, t in rows:
        w = cases.words(t)
        lines = [x for x in (t or "").split("\n") if cases.words(x)]
        repeat = cases.repeated_words(w)
        want = (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t or "")), len(lines) - len(set(lines)), repeat,
                len(w) < 50 or 100 * repeat > 50 * len(w))
        assert want in [tuple(r[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")) for r in got[i]]
    assert all(not r["base_failed"] or not r["kept"] for rs in got.values() for r in rs)
    assert quality.clean(cases.empty(spark)).count() == 0


def test_quality_lines(spark):
    good = "This line is a full sentence of more than eight words."
    text = "\n".join([good, "Home", "A | B | C | D", "#### $$$$ word", "Enable JavaScript to view this.", "", "A SHOUTED LINE OF TEXT HERE!", "short one", good])
    r = quality.clean(spark.createDataFrame([cases.row(1, text), cases.row(2, "\n".join([good] * 9 + ["Menu"]))], cases.SCHEMA)).orderBy("doc_id").collect()
    assert r[0]["clean_text"] == "\n".join([good, "", good])
    assert r[0]["removed"] == ["navigation", "symbols", "symbols", "boilerplate", "capitals", "punctuation"]
    assert r[0]["n_dup_lines"] == 1 and r[0]["lost"] > 0.4 and not r[0]["kept"]
    # a carried column gives way to a result of its name, and a filter on the verdict gives the same answer
    assert quality.clean(cases.documents(spark)[0], carry=("doc_id", "n_words", "id")).columns[:3] == ["doc_id", "id", "n_words"]
    rng = random.Random(1)
    many = spark.createDataFrame([cases.row(1, "\n".join(f"{cases.prose(rng, 12, 5000)}." for _ in range(20)))], cases.SCHEMA)
    assert quality.clean(many).where("kept").count() == 1


def test_quality_one_line(spark):
    """A long line that only mentions a phrase or has a few separators is no boilerplate and no menu."""
    rng = random.Random(2)
    said = ["privacy policy", "terms of use", "powered by", "(c) 2019", "lorem ipsum", "enable javascript", "a / b / c / d", "x > y > z > w"]
    texts = [f"{cases.prose(rng, 150, 5000)} {phrase} {cases.prose(rng, 150, 5000)}." for phrase in said]
    texts.append(cases.prose(rng, 150, 5000) + " ".join(said[:4]) + cases.prose(rng, 150, 5000) + ".")
    short = ["Please see our privacy policy for more.", "Home > Tools > Garden tools > Small shovels for all.",
             "Powered by Blog, all rights reserved, copyright © 2019 us, see terms of use and privacy policy and cookie settings of the site here."]
    df = spark.createDataFrame([cases.row(i, t) for i, t in enumerate(texts + short)], cases.SCHEMA)
    got = {r["doc_id"]: r for r in quality.clean(df).collect()}
    for i, t in enumerate(texts):
        assert got[i]["kept"] and got[i]["removed"] == [] and got[i]["clean_text"] == t, t
    assert [got[len(texts) + i]["removed"] for i in range(3)] == [["boilerplate"], ["navigation"], ["boilerplate"]]


def test_tokens(spark):
    df, rows = cases.documents(spark)
    odd = ["aaaa aaaaa bbbb" * 9, "  \n\n x\t\ty", "日本語 😀😀😀", "<|endoftext|>", "x" * 5000]
    df = df.union(spark.createDataFrame([cases.row(200 + i, t) for i, t in enumerate(odd)], cases.SCHEMA))
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    plain = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    coded = tokens.encode(df, RANKS, public_tokenizers.PATTERN, carry=("doc_id", "text"), block_words=300)
    coded = coded.withColumnRenamed("text", "source_text")
    back = tokens.decode(coded, RANKS, carry=("doc_id", "source_text", "n_tokens", "ids", "text"))
    assert back.columns == ["doc_id", "source_text", "n_tokens", "ids", "text"]
    n = 0
    for _, text, size, ids, decoded in map(tuple, back.collect()):
        assert np.frombuffer(ids, "<u4").tolist() == plain.encode_ordinary(text or "") and decoded == (text or "")
        n += size
    digests = tokens.encode(df, RANKS, public_tokenizers.PATTERN, digests=True)
    assert digests.agg(F.sum("n_tokens")).first()[0] == n
    assert digests.where("doc_id = 151").first()["ids_sha256"] == hashlib.sha256(b"").hexdigest()
    assert tokens.encode(cases.empty(spark), RANKS, public_tokenizers.PATTERN).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 700), max_size=20), st.integers(1, 300))
def test_windows(lengths, size):
    windows, filled, place = packing.Windows(sum(lengths), size), defaultdict(int), 0
    for n in lengths:
        for length, sequence, offset in windows.pieces(place, n):
            assert length > 0 and offset == filled[sequence]
            filled[sequence] += length
            place += length
    assert place == sum(lengths) and sorted(filled) == list(range(len(filled)))
    assert all(n == size if w < windows.full else n < size and n & (n - 1) == 0 for w, n in filled.items())


@pytest.mark.parametrize("weights", [None, {"s1": 3, "s2": 1}])
def test_packing(spark, weights):
    path = public_tokenizers.path("byte_bpe_50k.json")
    df, rows = cases.documents(spark)
    df = df.union(spark.createDataFrame([cases.row(300, "a <|endoftext|> b"), cases.row(301, "  two  spaces \n")], cases.SCHEMA))
    rows = rows + [(300, "a <|endoftext|> b"), (301, "  two  spaces \n")]
    plain = Tokenizer.from_file(path)
    want = Counter((i, tuple(plain.encode(t or "", add_special_tokens=False).ids + [1])) for i, t in rows)
    pieces = packing.pack(df, path, 1, size=512, weights=weights).collect()
    by_sequence, by_doc = defaultdict(list), defaultdict(list)
    for p in pieces:
        assert len(p["ids"]) == 4 * p["length"]
        by_sequence[p["sequence_id"]].append((p["offset"], p["length"]))
        by_doc[p["doc_id"], p["doc_tokens"]].append((p["start"], np.frombuffer(p["ids"], "<u4").tolist()))
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at == 512 or at & (at - 1) == 0
    for (i, n), parts in by_doc.items():
        texts = [ids for (d, ids), k in want.items() for _ in range(k) if d == i and len(ids) == n]
        placed = defaultdict(list)
        for start, ids in parts:
            placed[start].append(ids)
        assert sum(len(ids) for _, ids in parts) == sum(map(len, texts))
        for start, several in placed.items():
            assert all(any(list(t[start:start + len(ids)]) == ids for t in texts) for ids in several)
    assert packing.pack(cases.empty(spark), path, 1).count() == 0


@pytest.mark.parametrize("sources,weights", [(20, None), (200, None), (2000, None), (200, {"hot": 60, "s7": 1, "s8": 3})])
def test_packing_mixture(spark, sources, weights):
    """However many sources: pieces stay whole packets, windows are full and every queue keeps near its target."""
    size, quantum, path = 1024, 64, public_tokenizers.path("byte_bpe_50k.json")
    per = max(1, 2000 // sources)
    names = ["hot"] * 1000 + [f"s{i}" for i in range(sources)] * per
    rows = [cases.row(i, " ".join(["word"] * 199), s) for i, s in enumerate(names)]
    df = spark.createDataFrame(rows, cases.SCHEMA).repartition(5, "doc_id")
    pieces = packing.pack(df, path, 1, size=size, weights=weights, others=20, quantum=quantum, carry=("doc_id", "source")).collect()
    totals, windows, queues = Counter(), defaultdict(Counter), defaultdict(set)
    for p in pieces:
        totals[p["source"]] += p["length"]
        windows[p["sequence_id"]][p["source"]] += p["length"]
        queues[p["source"]].add(p["queue"])
    every, full = sum(totals.values()), [w for w, c in windows.items() if sum(c.values()) == size]
    assert every == 200 * len(rows) and all(len(q) == 1 for q in queues.values()) and len(set.union(*queues.values())) == sources + 1
    assert len(full) == every // size
    assert len(pieces) <= 3 * len(rows) + len(windows)  # three packets a document
    weight = {s: (weights or {}).get(s, 0) for s in totals}
    free = sum(n for s, n in totals.items() if not weight[s])
    earned = sum(weight.values()) + 20
    share = {s: totals[s] / every if not weights else (weight[s] or 20 * totals[s] / free) / earned for s in totals}
    # rounds in which no queue has ended: the scarcest by its share
    last = min(totals[s] / share[s] for s in totals) / size - 4
    sent = Counter()
    for w in sorted(full):
        sent += windows[w]
        if w < last:  # a stray of two packets for itself, and its share of the others' strays, which mostly cancel
            stray = 2 * 2 * quantum + size
            assert abs(sent["hot"] - share["hot"] * (w + 1) * size) <= stray + 4 * quantum * sources ** 0.5, (w, sent["hot"])
            assert all(abs(sent[s] - share[s] * (w + 1) * size) <= stray for s in totals if s != "hot")


def test_toxicity(spark):
    rng = random.Random(3)
    rude = ["ghastly", "vile", "rotten", "dreadful"]
    rows, labels = [], []
    for i in range(1200):
        w = cases.prose(rng, rng.randrange(5, 80), 3000).split()
        toxic = rng.random() < 0.2
        for _ in range(1 + len(w) // 25 if toxic else 0):
            w.insert(rng.randrange(len(w)), rng.choice(rude))
        rows.append(cases.row(i, " ".join(w)))
        labels.append((i, None, int(toxic), "x"))
    rows += [cases.row(None, "vile"), cases.row(5000, None), cases.row(5001, ""), cases.row(5002, "vile " * 20_000), cases.row(7, rows[7][1])]
    labels += [(None, 1, 1, "x"), (3, 1, None, "x"), (5, 1, 0, "x"), (9999, 1, 1, "x")]
    df = spark.createDataFrame(rows, cases.SCHEMA)
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int, text string")
    got = toxicity.score(df, toxicity.fit(df, lab)).collect()
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 for r in got)
    truth = {i: t for i, _, t, _ in labels[:1200]}
    held = [(r["score"], truth[r["doc_id"]]) for r in got
            if r["doc_id"] is not None and r["doc_id"] < 1200 and zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2]
    # a few hundred texts of rare words: most are told apart
    rude_ones, others = [s for s, t in held if t], [s for s, t in held if not t]
    assert sum(a > b for a in rude_ones for b in others) > 0.9 * len(rude_ones) * len(others)
    assert sum((s >= 0.3) == t for s, t in held) > 0.85 * len(held)
    # labels of the held-out rows make no difference
    other = lab.withColumn("toxic", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    again = {r["doc_id"]: r["score"] for r in toxicity.score(df, toxicity.fit(df, other)).collect()}
    assert all(abs(again[r["doc_id"]] - r["score"]) < 1e-9 for r in got)
    none = toxicity.fit(cases.empty(spark), lab.limit(0))
    assert all(r["score"] < 1e-9 for r in toxicity.score(df.limit(3), none).collect())
    assert toxicity.score(cases.empty(spark), none).count() == 0


def test_toxicity_words_apart(spark):
    """Words have counts of their own, whether tasks hold them or the table does."""
    def slot(word):
        return int(mix(hash_words([word.encode()]))[0] & np.uint64((1 << 19) - 1))

    ordinary = {slot(f"w{i}"): f"w{i}" for i in range(3000)}
    pairs = [(f"bad{i}", ordinary[slot(f"bad{i}")]) for i in range(2000) if slot(f"bad{i}") in ordinary][:4]
    rng = random.Random(8)
    rows, labels = [], []
    for i in range(1000):
        w = cases.prose(rng, 40, 3000).split()
        for k in rng.sample(range(40), 8):
            w[k] = rng.choice(pairs)[i % 4 > 0]
        rows.append(cases.row(i, " ".join(w)))
        labels.append((i, int(i % 4 == 0)))
    rows += [cases.row(2000 + k, " ".join([w] * 6)) for k, pair in enumerate(pairs) for w in pair]
    rows += [cases.row(2100 + k, " ".join(pair)) for k, pair in enumerate(pairs)]
    df = spark.createDataFrame(rows, cases.SCHEMA)
    lab = spark.createDataFrame(labels, "doc_id long, toxic int")
    got = {r["text"]: r["score"] for r in toxicity.score(df, toxicity.fit(df, lab), carry=("doc_id", "text")).collect()}
    assert all(got[" ".join([bad] * 6)] > 0.5 > got[" ".join([good] * 6)] for bad, good in pairs)
    more = df.union(spark.createDataFrame([cases.row(None, "bad1 w1"), cases.row(3000, None), cases.row(3001, " "), cases.row(7, rows[7][1])], cases.SCHEMA))
    few = toxicity.fit(more, lab, frequent=50)
    assert few.rest is not None and few.rest.count() > 2000 and len(few.known.words) <= 50
    for carry in (("doc_id", "n_words"), ("doc_id", "text", "a")):
        want, have = [sorted(map(tuple, toxicity.score(more, m, carry=carry).collect()), key=repr) for m in (toxicity.fit(more, lab), few)]
        assert len(want) == len(have) == len(rows) + 4
        assert all(a[:-1] == b[:-1] and abs(a[-1] - b[-1]) < 1e-6 for a, b in zip(want, have))


def test_toxicity_phrases(spark):
    """A fixed phrase and a copied text with words of its own are learned; one text with a rare word is not proof."""
    rng = random.Random(9)
    copied = " ".join(f"own{i}" for i in range(60))
    rows, labels = [], []
    for i in range(1500):
        w = cases.prose(rng, 40, 3000).split()
        at, kind = rng.randrange(36), i % 10
        if kind == 0:
            w[at:at + 3] = "grim gnarled goblin".split()
        rows.append(cases.row(i, copied if kind == 1 else " ".join(w)))
        labels.append((i, int(kind < 2)))
    plain = cases.prose(rng, 40, 3000)
    once = next(i for i in range(4000, 5000) if zlib.crc32(str(i).encode()) % 4 < 2)
    rows += [cases.row(once, plain + " seldom"), cases.row(once + 2000, plain), cases.row(once + 2001, plain + " seldom"),
             cases.row(once + 2002, plain + " grim gnarled goblin"), cases.row(once + 2003, plain + " own5 own6 own7 own8"),
             cases.row(once + 2004, copied)]
    df = spark.createDataFrame(rows, cases.SCHEMA)
    lab = spark.createDataFrame(labels + [(once, 1)], "doc_id long, toxic int")
    got = {r["doc_id"]: r["score"] for r in toxicity.score(df, toxicity.fit(df, lab)).collect()}
    assert max(got[once + 2000], got[once + 2001]) < 0.3
    assert min(got[once + k] for k in (2002, 2003, 2004)) > 0.5
