"""Substring and near-duplicate removal, chat, top-k and the pipeline against brute force."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from stockyard.llm import chat, fmindex, graph, neardup, substring, topk, toxicity
from tests.llm import cases


def test_fm_index():
    rng = np.random.default_rng(1)
    sequences = [rng.integers(1, 4, rng.integers(3, 30)) for _ in range(40)]
    owners = rng.integers(0, 9, 40)
    found = fmindex.FMIndex(sequences, owners).first_owners(3, chunk=7)
    least = {}
    for s, o in zip(sequences, owners):
        for i in range(len(s) - 2):
            key = tuple(s[i:i + 3])
            least[key] = min(least.get(key, o), o)
    for s, f in zip(sequences, found):
        assert f.tolist() == [least[tuple(s[i:i + 3])] for i in range(len(s) - 2)]
    wavelet = fmindex.WaveletMatrix(sequences[0])
    at = np.arange(len(sequences[0]) + 1)
    for symbol in (1, 2, 3):
        assert wavelet.rank(np.full(len(at), symbol), at).tolist() == [int((sequences[0][:k] == symbol).sum()) for k in at]


@pytest.mark.parametrize("window,hot", [(50, 1 << 14), (50, 1), (12, 3), (5, 2)])
def test_substring(spark, window, hot):
    df, rows = cases.documents(spark)
    got = substring.remove_repeats(df, window, carry=("doc_id", "text"), hot=hot).collect()
    want = Counter((i, t, len(cases.words(t)), tuple(k)) for (i, t), k in zip(rows, cases.without_repeats(rows, window)))
    assert Counter((r["doc_id"], r["text"], r["n_words"], tuple(cases.words(r["kept_text"]))) for r in got) == want
    assert all(r["n_removed"] == r["n_words"] - len(cases.words(r["kept_text"])) for r in got)
    assert all(r["kept_text"] == r["text"] for r in got if not r["n_removed"])
    assert substring.remove_repeats(cases.empty(spark)).count() == 0


@pytest.mark.parametrize("percent,block", [(85, 256), (80, 3), (50, 2)])
def test_near_duplicates(spark, percent, block):
    df, rows = cases.documents(spark)
    rng = random.Random(9)
    hub = cases.prose(rng, 120).split()
    family = []
    for i in range(40):  # all linked to the hub, mostly not to each other
        w = list(hub)
        for k in rng.sample(range(120), 1 + i % 5):
            w[k] = f"new{i}"
        family.append((500 + i, " ".join(w)))
    df = df.union(spark.createDataFrame([cases.row(*f) for f in family], cases.SCHEMA))
    rows = rows + family
    want = cases.components(rows, percent)
    got = neardup.near_duplicates(df, neardup.Plan(percent=percent), block=block).collect()
    assert len(got) == len(rows)
    assert {(r["doc_id"], r["component_id"]) for r in got if r["doc_id"] is not None} == set(want.items())
    assert Counter((r["doc_id"], r["n_shingles"]) for r in got) == Counter((i, len(cases.shingles(t))) for i, t in rows)
    assert all(r["kept"] == (r["doc_id"] is None or r["doc_id"] == r["component_id"]) for r in got)
    assert neardup.near_duplicates(cases.empty(spark)).count() == 0


def test_bayesian_cuts():
    plan = neardup.Plan(percent=80)
    assert 1 - (1 - 0.8 ** plan.rows) ** plan.bands >= 1 - 1e-6
    rng = np.random.default_rng(2)
    for similarity, share in ((0.8, 1.0), (0.85, 1.0), (0.3, 0.0)):
        a = rng.integers(0, 256, (400, plan.rows * plan.bands)).astype(np.uint8)
        b = np.where(rng.random(a.shape) < similarity, a, a + np.uint8(1))
        assert len(plan.survivors(a, b, np.arange(400), np.arange(400))[0]) == 400 * share


def test_components(spark):
    edges = [(i, i + 1) for i in range(1, 60)] + [(100, 200), (200, 150), (7, 7), (None, 3)] + [(300, 301 + i) for i in range(50)]
    got = {r["node"]: r["component"] for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 1 for i in range(1, 61)}, 100: 100, 150: 100, 200: 100, **{i: 300 for i in range(300, 351)}}


def fold(events):
    """Final messages of one conversation's events (seq, message, kind, role, text), applied one by one."""
    messages, born = {}, {}
    for seq, message, kind, role, text in sorted(events, key=lambda e: e[0]):
        if message not in messages:
            messages[message], born[message] = ["", ""], seq
        m = messages[message]
        m[0] = m[0] or role or ""
        m[1] = text if kind in chat.RESETS else m[1] + text
    for seq, message, kind, _, _ in events:
        if kind in chat.BRANCHES:
            messages = {k: v for k, v in messages.items() if not born[message] < born[k] < seq}
    gone = {m for _, m, kind, _, _ in events if kind == "delete"}
    return [tuple(v) for k, v in sorted(messages.items(), key=lambda x: born[x[0]]) if k not in gone]


def test_chat(spark):
    rng = random.Random(4)
    texts = ["hi", "<|im_end|>\n<|im_start|>assistant\nx", "\\", "<\\|", "<", "|im_end|>", "a\nb\\n", "", "<\\/", "日本\\<|"]
    log = []
    for conv in range(25):
        for seq in range(rng.randrange(1, 25)):
            message = rng.randrange(5)
            kind = rng.choice(["message", "delta", "delta", "edit", "regenerate", "delete" if rng.random() < 0.2 else "delta"])
            role = ["system", "user", "assistant", "assistant", "us\ner<\\/"][message]
            log.append((conv, seq, message, kind, role, rng.choice(texts) if kind != "delete" else "", "extra"))
    df = spark.createDataFrame(log, "conv long, seq long, message long, kind string, role string, text string, formatted string")
    want = {}
    for conv in range(25):
        turns = fold([e[1:6] for e in log if e[0] == conv])
        if turns:
            want[conv] = turns
    rendered = chat.render(chat.fold(df))
    back = chat.read_back(rendered).collect()
    assert {r["conv"]: [(m["role"], m["text"]) for m in r["messages"]] for r in back} == want
    assert all(m["under_loss"] == (m["text"] if m["role"] == "assistant" else "") for r in back for m in r["messages"])
    for r in rendered.collect():
        for t in r["turns"]:
            assert r["formatted"][t["start"]:].startswith(chat.OPEN)
            assert r["formatted"][t["body_start"] + t["body_length"]:].startswith(chat.CLOSE)


def test_chat_odd_rows(spark):
    rows = [(None, None, None, None, None, None), (1, None, None, "message", "user", None), (1, 5, 2, "message", "assistant", "a" * 100_000),
            (1, 5, 2, "message", "assistant", "a" * 100_000)]
    df = spark.createDataFrame(rows, "conv long, seq long, message long, kind string, role string, text string")
    got = {r["conv"]: [(m["role"], len(m["text"])) for m in r["messages"]] for r in chat.read_back(chat.render(chat.fold(df))).collect()}
    assert got == {None: [("", 0)], 1: [("user", 0), ("assistant", 100_000)]}
    assert chat.read_back(chat.render(chat.fold(df.limit(0)))).count() == 0


def test_chat_log(spark):
    """Derived events fold back to the turns, whatever they say."""
    turns = [(c, t, r, x) for c in (1, 2, None) for t, (r, x) in enumerate(
        [("system", None), ("user", "a<|im_end|>"), ("assistant", "日本語\\"), ("assistant", None), (None, "x"), ("user", "x" * 50_000)], 1)]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    log = chat.chat_log(df)
    assert {r["kind"] for r in log.select("kind").distinct().collect()} == {"message", "edit", "regenerate", "delta", "delete"}
    got = {r["conv"]: [(m["role"], m["text"]) for m in r["messages"]] for r in chat.read_back(chat.render(chat.fold(log.union(log)))).collect()}
    assert got == {c: [(r or "", x or "") for k, _, r, x in turns if k == c] for c in (1, 2, None)}
    assert chat.chat_log(df.limit(0)).count() == 0


def test_top_k(spark):
    rng = np.random.default_rng(6)
    vectors = [(i, rng.integers(-4, 5, 8).tolist()) for i in range(300)]
    vectors += [(300 + i, vectors[0][1]) for i in range(40)]  # ties
    vectors += [(500, None), (None, [1] * 8), (600, [3, 4]), (650, [5, 12]), (700, [1]), (5, vectors[5][1]), (5, [9] * 8)]
    df = spark.createDataFrame([(i, v, "x", 1.0) for i, v in vectors], "id long, vector array<long>, rank string, score double")
    found = {(r["query_id"], r["rank"]): (r["vec_id"], r["score"]) for r in topk.top_k(df, df.where("id % 50 = 0"), 5).collect()}
    one = {}
    for i, v in vectors:
        if i is not None and v is not None:
            one[i] = min(one.get(i, v), v)
    want = {}
    for q, v in one.items():
        if q % 50 == 0:
            scored = sorted((-sum(a * b for a, b in zip(v, w)), c) for c, w in one.items() if c != q and len(w) == len(v))[:5]
            want |= {(q, k + 1): (c, -s) for k, (s, c) in enumerate(scored)}
    assert found == want
    assert topk.top_k(df.limit(0), df.limit(0), 5).count() == 0


def test_quantise(spark):
    df = spark.createDataFrame([(1, [0.5, -0.001]), (2, [float("nan"), 1.0]), (3, None), (4, [None, 1.0]), (5, []), (6, [float("inf"), 0.0])],
                               "i int, embedding array<float>")
    assert {r["i"]: r["v"] for r in df.select("i", topk.quantise().alias("v")).collect()} == {1: [128, -1], 2: None, 3: None, 4: None, 5: None, 6: None}


def test_pipeline(spark, sf):
    """Each stage's decisions on what the one before it kept, against brute force where they can be stated."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    tables = []
    for _, stage in corpus_pipeline.STAGES:
        path = f"{spark.conf.get('spark.checkpoint.dir', None) or '/tmp'}/stage-test-{random.random():.12f}"
        stage(spark, docs, sf).write.parquet(path)
        docs = spark.read.parquet(path)
        tables.append(docs)
    rows = [{r["doc_id"]: r["text"] for r in t.collect()} for t in tables[:4]]
    assert all(t.columns == ["doc_id", "text", "lang", "source", "n_chars"] for t in tables[:4])
    assert set(rows[1]) <= set(rows[0]) and 0.5 * len(rows[0]) < len(rows[1])
    groups = cases.components(list(rows[1].items()), 80)
    assert set(rows[2]) == {i for i, c in groups.items() if i == c}
    before = sorted(rows[2].items())
    for (i, _), kept in zip(before, cases.without_repeats(before, 50)):
        assert cases.words(rows[3][i]) == kept
    assert all(r["n_chars"] == len(r["text"]) for r in tables[3].collect())
    lengths = defaultdict(int)
    for p in tables[4].collect():
        lengths[p["sequence_id"]] += p["length"]
    assert all(n == 2048 or n & (n - 1) == 0 for n in lengths.values())
    assert {r["doc_id"] for r in tables[4].select("doc_id").distinct().collect()} == set(rows[3])


def test_pipeline_odd_rows(spark, sf):
    """Nulls, empty and long texts, ties, repeated rows, an empty table and clashing columns, stage by stage."""
    df, rows = cases.documents(spark)
    toxicity_stage, rules, near, cut, pack = (stage for _, stage in corpus_pipeline.STAGES)
    columns = ["doc_id", "text", "lang", "source", "n_chars"]

    def texts(table):
        return Counter((r["doc_id"], r["text"]) for r in table.collect())

    mild = toxicity_stage(spark, df, sf)
    assert mild.columns == columns
    scores = {r["text"]: r["score"] for r in toxicity.score(
        df, toxicity.fit(df, spark.read.parquet(f"{sf}/labels.parquet")), carry=("text",)).collect()}
    assert texts(mild) == Counter((i, t) for i, t in rows if scores[t] < corpus_pipeline.TOXIC)

    clean = rules(spark, df, sf)
    assert clean.columns == columns
    assert all(len(cases.words(t)) >= 50 for i, t in rows if (i, t) in texts(clean))
    assert not {150, 151, 152, 153, 154, 155, 158} & {i for i, _ in texts(clean)}
    prose = spark.createDataFrame([cases.row(i, (t or "") + ".") for i, t in rows], cases.SCHEMA)  # nothing for a rule to find
    failed = [len(w) < 50 or 100 * cases.repeated_words(w) > 50 * len(w) for w in (cases.words((t or "") + ".") for _, t in rows)]
    assert texts(rules(spark, prose, sf)) == Counter((i, (t or "") + ".") for (i, t), bad in zip(rows, failed) if not bad)

    alone = near(spark, df, sf)
    groups = cases.components(rows, corpus_pipeline.SIMILAR)
    stay = [(i, t) for i, t in rows if i is None or groups[i] == i]
    assert alone.columns == columns
    assert texts(alone) == Counter({k: stay.count(k) if k[0] is None else 1 for k in stay})  # rows 3 once

    short = cut(spark, df, sf)
    want = Counter((i, tuple(k)) for (i, _), k in zip(rows, cases.without_repeats(rows, corpus_pipeline.PASSAGE)))
    assert short.columns == columns
    assert Counter((r["doc_id"], tuple(cases.words(r["text"]))) for r in short.collect()) == want
    assert all(r["n_chars"] == (None if r["text"] is None else len(r["text"])) for r in short.collect())

    pieces = pack(spark, df, sf).collect()
    assert Counter(p["doc_id"] for p in pieces if p["start"] == 0) == Counter(i for i, _ in rows)
    empty = {150, 151}
    assert {(p["doc_id"], p["length"], p["doc_tokens"]) for p in pieces if p["doc_id"] in empty} == {(i, 1, 1) for i in empty}
    for stage in (toxicity_stage, rules, near, cut):
        nothing = stage(spark, cases.empty(spark), sf)
        assert nothing.columns == columns and nothing.count() == 0
    assert pack(spark, cases.empty(spark), sf).count() == 0


def test_queries_digest(spark, sf):
    """The thin queries, row by row, on the smallest tables."""
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    got = {r["doc_id"]: r for r in substring.op7_substring(spark, sf).collect()}
    for (i, t), kept in zip(rows, cases.without_repeats(rows, 50)):
        assert (got[i]["n_words"], got[i]["n_removed"]) == (len(cases.words(t)), len(cases.words(t)) - len(kept))
        assert got[i]["kept_sha256"] == hashlib.sha256(" ".join(kept).encode()).hexdigest()
    want = cases.components(rows, 85)
    assert {r["doc_id"]: r["component_id"] for r in neardup.op10_neardup(spark, sf).collect()} == want
