"""The weighted draw against a plain computation of its definition."""

import collections
import hashlib
import itertools
import math
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from conftest import SF001
from scrubline.llm import resampling
from scrubline.llm.common import global_rank, table
from scrubline.llm.queries import QUERIES

DOCS = "doc_id long, text string, rank long, score string, k1 string, slice_ int"


def _words(t):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def _buckets(t):
    w = _words(t)
    return [zlib.crc32(x.encode()) % 10_000 for x in w + [f"{a} {b}" for a, b in zip(w, w[1:])]]


def _brute(docs, target, min_words=20, pct=25):
    s, t = (collections.Counter(b for _, x in rows for b in _buckets(x))
            for rows in (docs, [(0, x) for x in target]))
    s_all, t_all = sum(s.values()) + 10_000, sum(t.values()) + 10_000
    gain = [math.floor(1000 * math.log((t[b] + 1) * s_all / ((s[b] + 1) * t_all)))
            for b in range(10_000)]
    rows = []
    for i, x in docs:
        f = _buckets(x)
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([i, len(f), weight, score, None, len(_words(x))])
    able = sorted((r for r in rows if r[5] >= min_words),
                  key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    for k, r in enumerate(able[:pct * len(able) // 100]):
        r[4] = k + 1
    return sorted((tuple(r[:5]) for r in rows), key=str)


def _rows(df):
    return sorted(((r.doc_id, r.n_features, r.weight, r.score, r["rank"]) for r in df.collect()),
                  key=str)


def test_query_equals_its_definition(spark):
    docs = [(r.doc_id, r.text) for r in table(spark, SF001, "documents").collect()]
    target = [r.text for r in table(spark, SF001, "benchmark").collect()]
    assert _rows(QUERIES["op13_importance_resampling"](spark, SF001)) == _brute(docs, target)


@pytest.mark.parametrize("block", [1 << 20, 50, 3])
def test_features_of_any_text(monkeypatch, block):
    monkeypatch.setattr(resampling, "BLOCK", block)
    rng = np.random.default_rng(3)
    texts = [None, "", " ", "one", "a B c d", "É à x" * 3, "w" * 100 + " " + "é" * 70 + " b",
             "x" * 64 + " " + "y" * 65 + " z", " lead", "trail ", "a\x00b~c`d{e", "日本 語"]
    texts += ["".join(rng.choice(list("abAB é1.,-\n"), rng.integers(60))) for _ in range(300)]
    column = pa.array(["skipped", *texts]).slice(1)
    got = [collections.Counter() for _ in texts]
    for row, _, (w, w_of, p, p_of, _) in resampling._blocks(column):
        for b, o in itertools.chain(zip(w, w_of), zip(p, p_of)):
            got[row + o][int(b)] += 1
    assert got == [collections.Counter(_buckets(t)) for t in texts]


def test_edge_cases(spark):
    long = "far away " * 40_000
    docs = [(1, None), (2, ""), (3, long), (None, "w " * 25), (None, "v " * 25), (4, "one"),
            (5, "same text " * 20), (5, "same text " * 20), (5, "same text " * 20),
            *[(10 + i, " ".join(f"w{(i * k) % 17}" for k in range(30))) for i in range(40)]]
    df = spark.createDataFrame([(*r, 0, "s", "k", 1) for r in docs], DOCS)
    target = spark.createDataFrame([("same text here",), (None,), ("w1 w2",)], "text string")
    rows = resampling.scored(df, target)
    assert _rows(resampling.draw(rows)) == _brute(docs, ["same text here", None, "w1 w2"])
    assert _rows(resampling.draw(rows, pct=100)) == _brute(
        docs, ["same text here", None, "w1 w2"], pct=100)
    drawn = resampling.sample(df, target)
    assert drawn.columns == df.columns and drawn.count() >= 46 * 25 // 100
    none = resampling.draw(resampling.scored(df.limit(0), target.limit(0)))
    assert none.count() == 0
    few = resampling.draw(resampling.scored(df.filter("doc_id < 4"), target.limit(0)), 30)
    assert [r["rank"] for r in few.collect()] == [None] * 3


@pytest.mark.parametrize("pivots", [1, 3, 31])
def test_kth_key_with_many_ties(spark, pivots):
    rng = np.random.default_rng(5)
    keys = [(int(a), int(b)) for a, b in zip(rng.integers(0, 6, 500), rng.integers(0, 5, 500))]
    df = spark.createDataFrame(keys, "a long, b int")
    for k in (1, 2, 167, 499, 500):
        assert resampling.kth_key(df, ["a", "b"], k, pivots) == sorted(keys)[k - 1]


def test_rank_over_all_rows(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("v"), F.lit("x").alias("n_"))
    got = global_rank(df, ["v"], "place", "test_rank").collect()
    assert sorted((r.v, r.place) for r in got) == [(i, i + 1) for i in range(1000)]


def test_likeness_raises_the_weight(spark):
    docs = table(spark, SF001, "documents").select("doc_id", "text")
    target = table(spark, SF001, "benchmark")
    near = target.select((F.col("item_id") + 10**6).alias("doc_id"), "text")
    rows = resampling.scored(docs.union(near), target)
    mean = {r.near: r.w for r in rows.groupBy((F.col("doc_id") >= 10**6).alias("near"))
            .agg(F.avg("weight").alias("w")).collect()}
    assert mean[True] > mean[False] + 500
