"""Hard negatives against brute force."""

import numpy as np
import pytest

from stockyard.llm import negatives

SCHEMA = "id long, label int, vector array<long>, rank string, score double, slot string, uppers string"


def brute(rows, anchors, w):
    one = {}
    for i, label, v in rows:
        if None not in (i, label, v):
            one[i] = min(one.get(i, (label, v)), (label, v))
    out = set()
    for a in anchors:
        if a not in one:
            continue
        scored = sorted((-sum(x * y for x, y in zip(one[a][1], v)), i, label == one[a][0])
                        for i, (label, v) in one.items() if i != a and len(v) == len(one[a][1]))
        for down, p, _ in [s for s in scored if s[2]][:w.positives]:
            fit = [(d, n) for d, n, same in scored if not same and -w.low * down <= -100 * d <= -w.high * down]
            out |= {(a, p, k + 1, n, -down, -d) for k, (d, n) in enumerate(fit[:w.negatives])}
    return out


def table(spark, rows):
    return spark.createDataFrame([(*r, "r", 1.0, "s", "u") for r in rows], SCHEMA)


@pytest.mark.parametrize("window,block", [(negatives.Window(), 16_384), (negatives.Window(3, 4, 0, 100), 7), (negatives.Window(2, 1, 50, 60), 40)])
def test_mine(spark, window, block, monkeypatch):
    monkeypatch.setattr(negatives, "CANDIDATE_ROWS", block)
    monkeypatch.setattr(negatives, "AT_ONCE", 5)
    rng = np.random.default_rng(3)
    rows = [(i, int(rng.integers(0, 3)), rng.integers(-6, 7, 6).tolist()) for i in range(240)]
    rows += [(240 + i, i % 2, rows[0][2]) for i in range(40)]  # ties
    rows += [(400 + i, 1, [x + 1 for x in rows[7][2]]) for i in range(30)]  # one label holds many
    rows += [(500, None, [1] * 6), (510, 1, None), (None, 1, [1] * 6), (520, 1, [3, 4]), (530, 2, [2, 3]), (540, 2, [2, 2]), (550, 1, [5, 5]),
             (560, 7, [1, 0, 0, 0, 0, 0]), (570, 0, [0] * 6), (10, rows[10][1], rows[10][2]), (20, 2, [9] * 6), (580, 1, []), (590, 1, [])]
    df = table(spark, rows)
    want = brute(rows, {r[0] for r in rows if r[0] is not None and r[0] % 10 == 0}, window)
    got = negatives.mine(df, df.where("id % 10 = 0"), window)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert {tuple(r) for r in got.collect()} == want and want
    assert got.count() == len(want)


def test_mine_nothing(spark):
    df = table(spark, [(0, 1, [1, 2]), (1, 1, [1, 2])])
    assert negatives.mine(df, df).count() == 0  # no other label
    assert negatives.mine(df.limit(0), df).count() == negatives.mine(df, df.limit(0)).count() == negatives.mine(df.limit(0), df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        negatives.mine(table(spark, [(0, 1, [2**40])]), df)
