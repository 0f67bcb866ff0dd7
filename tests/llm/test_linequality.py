"""The line field against enumeration, its gradient against differences, and its verdicts on held-out documents."""

import itertools

import numpy as np
import pytest

from stockyard.llm import linequality
from tests.llm import cases


def test_forward_backward():
    rng = np.random.default_rng(1)
    n_lines = np.array([3, 0, 1, 5, 2, 0])
    odds, change = rng.normal(0, 2, n_lines.sum()), rng.normal(0, 1, (2, 2))
    got, start = linequality.forward_backward(odds, n_lines, change), 0
    for k, n in enumerate(n_lines):
        weights = {}
        for states in itertools.product((0, 1), repeat=int(n)):
            weights[states] = np.exp(sum(o for s, o in zip(states, odds[start:start + n]) if s) + sum(change[i, j] for i, j in zip(states, states[1:])))
        z = sum(weights.values())
        assert got.log_z[k] == pytest.approx(np.log(z) if n else 0)
        for t in range(n):
            assert got.good[start + t] == pytest.approx(sum(w for s, w in weights.items() if s[t]) / z)
            pairs = [sum(w for s, w in weights.items() if t and (s[t - 1], s[t]) == p) / z for p in itertools.product((0, 1), repeat=2)]
            assert got.pairs[start + t].tolist() == pytest.approx(pairs)
        start += n
    assert len(linequality.forward_backward(np.zeros(0), np.zeros(0, int), change).good) == 0


def test_gradient():
    rng = np.random.default_rng(2)
    good, n_lines = np.array([1, 0, 0]), np.array([4, 6, 1])
    measures = rng.normal(0, 1, (11, len(linequality.MEASURES)))
    shift, scale = rng.normal(0, 1, linequality.SIZE), rng.uniform(0.5, 2, linequality.SIZE)
    before = linequality.Field(shift, scale, rng.normal(0, 1, linequality.SIZE), np.zeros((2, 2)))

    def value(x, earlier):
        field = linequality.Field(shift, scale, x[:-4], x[-4:].reshape(2, 2))
        return linequality._value(good, n_lines, measures, field, earlier)

    for earlier in (None, before):
        x = rng.normal(0, 0.3, linequality.SIZE + 4)
        slope = value(x, earlier)[1:]
        for k in range(0, len(x), 7):
            step = np.zeros(len(x))
            step[k] = 1e-5
            assert slope[k] == pytest.approx((value(x + step, earlier)[0] - value(x - step, earlier)[0]) / 2e-5, abs=1e-4)


def test_descend():
    rng = np.random.default_rng(3)
    a = rng.normal(0, 1, (12, 6))
    best = linequality._descend(lambda x: (float(((a @ x - 1) ** 2).sum()), 2 * a.T @ (a @ x - 1)), np.zeros(6), 60)
    assert best.tolist() == pytest.approx(np.linalg.lstsq(a, np.ones(12), rcond=None)[0].tolist(), abs=1e-3)


def test_measure():
    texts = [b"One two two.\n\nONE!! TWO!! x$", None, b"", b" \t", "Été à la mer 12\nÉté à la mer 12".encode(), b"One two two."]
    measures, words, n_lines = linequality.measure(texts)
    at = {m: measures[:, i] for i, m in enumerate(linequality.MEASURES)}
    assert n_lines.tolist() == [3, 0, 0, 1, 2, 1] and words.tolist() == [3, 0, 3, 0, 5, 5, 3]
    assert np.expm1(at["words"]).round(6).tolist() == words.tolist() and at["wordless"].tolist() == [0, 1, 0, 1, 0, 0, 0]
    assert at["copy"].tolist() == [0, 0, 0, 0, 1, 1, 0] and at["ends"].tolist() == [1, 0, 0, 0, 0, 0, 1]
    assert at["starts"].tolist() == [1, 0, 1, 0, 1, 1, 1]
    assert at["shout"][2] == pytest.approx(2 / 3) and at["stranger"][2] == pytest.approx(1 / 3) and at["symbols"][2] == pytest.approx(1 / 12)
    assert at["repeated"].tolist() == [0] * 7 and linequality.measure([b"a b a a"])[0][0, linequality.MEASURES.index("repeated")] == 0.5 and at["again"][4] == pytest.approx(0.8)
    features = linequality.with_neighbours(measures, n_lines)
    k = len(linequality.MEASURES)
    assert features.shape == (7, linequality.SIZE)
    assert features[:, 3 * k].tolist() == [1, 0, 0, 1, 1, 0, 1] and features[:, 3 * k + 1].tolist() == [0, 0, 1, 1, 0, 1, 1]
    assert (features[1, k:2 * k] == measures[0]).all() and not features[0, k:2 * k].any() and not features[3, 2 * k:3 * k].any()
    # a text's measures do not depend on the texts beside it
    for t, n, end in zip(texts, n_lines, np.cumsum(n_lines)):
        assert np.allclose(linequality.measure([t])[0], measures[end - n:end])
    assert linequality.measure([None, b""])[0].shape == (0, k)


def test_scores(spark):
    df, rows = cases.documents(spark)
    labels = spark.createDataFrame([(i, 0 if i is not None and 120 <= i < 130 else 1) for i, _ in rows] + [(3, None), (None, 0)], "doc_id long, quality int")
    model = linequality.fit(df, labels)
    got = linequality.score(df, model, carry=("doc_id", "text", "score", "n_words"))
    assert got.columns == ["doc_id", "text", "n_words", "score", "n_lines", "n_bad"]
    got = got.collect()
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 for r in got)
    assert all(r["n_lines"] == (r["text"].count("\n") + 1 if r["text"] else 0) for r in got)
    same = {}
    for r in got:
        assert same.setdefault(r["text"] or "", r["score"]) == pytest.approx(r["score"])
    assert linequality.score(cases.empty(spark), model).count() == 0


def test_without_labels(spark):
    df, rows = cases.documents(spark)
    for quality, want in ((None, 1.0), (1, 1.0), (0, 0.0)):
        labels = spark.createDataFrame([(i, quality) for i, _ in rows], "doc_id long, quality int")
        model = linequality.fit(df, labels)
        assert {round(r["score"], 6) for r in linequality.score(df, model).collect()} == {want}
    assert linequality.fit(cases.empty(spark), labels.limit(0)).curve[0] == 500.0


def test_sample(spark):
    ids = spark.range(5000)
    few = linequality._sampled(ids, 1000)
    assert linequality._sampled(ids, 5000).count() == 5000 and 850 < few.count() < 1150
    assert sorted(few.collect()) == sorted(linequality._sampled(ids, 1000).collect())


def test_held_out(spark, sf):
    """On labelled documents that the field has not seen bad ones rank below good ones, and hardly any good one is lost."""
    path = sf.replace("0.001", "0.01")
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{path}/labels.parquet").collect()}
    rows = [r for r in linequality.op12_linequality(spark, path).collect()]
    assert len(rows) == spark.read.parquet(f"{path}/documents.parquet").count()
    seen = [(r["score"], labels[r["doc_id"]], r["predicted"]) for r in rows if r["held_out"] and r["doc_id"] in labels]
    good, bad = ([s for s, y, _ in seen if y == k] for k in (1, 0))
    auc = sum((g > b) + (g == b) / 2 for g in good for b in bad) / (len(good) * len(bad))
    assert auc > 0.95 and sum(p for _, y, p in seen if y == 1) >= 0.97 * len(good)
