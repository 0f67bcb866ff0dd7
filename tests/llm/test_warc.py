"""Revisit resolution against brute force."""

import random

from pyspark.sql import functions as F

from stockyard.llm import warc

SCHEMA = "record_id long, url string, ts long, revisit boolean, headers map<string,string>, payload string, outcome string, _range int"


def test_canonical_urls(spark):
    urls = {"HTTP://WWW.Example.com:80/a/b/?utm_source=x&b=2&a=1#top": "example.com/a/b?a=1&b=2", "https://m.example.com/": "example.com",
            "example.com/A?ref=1": "example.com/A", "x.org/?refs=1": "x.org?refs=1", "": None, None: None}
    df = spark.createDataFrame([(u,) for u in urls], "u string").select("u", warc.canonical_url(F.col("u")).alias("c"))
    assert {r["u"]: r["c"] for r in df.collect()} == urls


def test_revisits(spark):
    rng = random.Random(8)
    rows = []
    for i in range(400):
        page = "hot" if rng.random() < 0.4 else f"p{rng.randrange(30)}"
        headers = {k: f"{k}{rng.randrange(2)}" for k in ("etag", "last-modified", "date", "server") if rng.random() < 0.5}
        if "etag" in headers and rng.random() < 0.3:
            headers["etag"] = "W/" + headers["etag"]
        revisit = rng.random() < 0.5
        rows.append((i, None if rng.random() < 0.03 else f"http://www.{page}.com/#{i}", None if rng.random() < 0.02 else rng.randrange(60),
                     revisit if rng.random() < 0.95 else None, headers if rng.random() < 0.9 else None, None if revisit else f"body{i}", "x", 1))
    got = {r["record_id"]: r for r in warc.resolve_revisits(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert len(got) == len(rows)
    place = lambda r: (-(1 << 62) if r[2] is None else r[2], r[0])
    for r in rows:
        mine, own = got[r[0]], r[4] or {}
        if not r[3]:
            assert (mine["outcome"], mine["headers"], mine["payload"], mine["source_id"]) == ("full", own, r[5], None)
            continue
        earlier = [s for s in rows if not s[3] and r[1] and s[1] and s[1].split("#")[0] == r[1].split("#")[0] and place(s) < place(r)]
        if not earlier:
            assert (mine["outcome"], mine["source_id"], mine["payload"], mine["headers"]) == ("orphan", None, None, own)
            continue
        source = max(earlier, key=place)
        theirs = source[4] or {}
        pair = next(((own[k], theirs[k]) for k in ("etag", "last-modified") if k in own and k in theirs), None)
        outcome = "unverified" if pair is None else "resolved" if pair[0].removeprefix("W/") == pair[1].removeprefix("W/") else "mismatch"
        assert (mine["outcome"], mine["source_id"]) == (outcome, source[0])
        if outcome == "mismatch":
            assert mine["payload"] is None and mine["headers"] == own
        else:
            assert mine["payload"] == source[5]
            assert mine["headers"] == theirs | {k: v for k, v in own.items() if k in warc.PERMITTED}


def test_odd_tables(spark):
    df = spark.createDataFrame([(1, "a.com", 1, False, None, "x" * 100_000, None, None), (1, "a.com", 1, False, None, "x" * 100_000, None, None),
                                (2, "a.com", 1, True, None, None, None, None), (2, "a.com", 1, True, None, None, None, None),
                                (None, None, None, None, None, None, None, None)], SCHEMA)
    got = warc.resolve_revisits(df).collect()
    assert len(got) == 5 and sum(r["outcome"] == "unverified" and r["payload"] == "x" * 100_000 for r in got) == 2
    assert warc.resolve_revisits(df.limit(0)).count() == 0
