"""Hard negatives against brute force, the curve and the interval bounds."""

import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF001
from scrubline.llm import hard_negatives as H
from scrubline.llm.common import table
from scrubline.llm.queries import QUERIES


def _brute(rows, is_anchor, positives=5, negatives=10, window=(30, 90), scale=256):
    """rows: (id, label, vector) that take part, in any order."""
    dims = max((len(r[2]) for r in rows), default=0)
    x = [[int(np.floor(scale * np.float64(v))) for v in r[2]] + [0] * (dims - len(r[2]))
         for r in rows]
    out = []
    for a, n in {(r[0], r[1], tuple(x[n])): n for n, r in enumerate(rows) if is_anchor(r[0])}.items():
        score = [sum(p * q for p, q in zip(x[n], v)) for v in x]
        order = sorted(range(len(rows)), key=lambda j: (-score[j], rows[j][0]))
        pos = [j for j in order if rows[j][1] == a[1] and rows[j][0] != a[0]][:positives]
        for p in pos:
            found = [j for j in order if rows[j][1] != a[1]
                     and window[0] * score[p] <= 100 * score[j] <= window[1] * score[p]]
            out += [(a[0], rows[p][0], k + 1, rows[j][0], score[p], score[j])
                    for k, j in enumerate(found[:negatives])]
    return sorted(out)


def _got(df):
    return sorted(tuple(r) for r in df.collect())


def test_query_equals_brute_force(spark):
    rows = [(r.vec_id, (r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label, r.embedding)
            for r in table(spark, SF001, "embeddings").collect()]
    got = QUERIES["op11_hard_negatives"](spark, SF001)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score",
                           "negative_score"]
    assert _got(got) == _brute(rows, lambda i: i % 100 == 0)


@pytest.mark.parametrize(("block", "page", "chunk", "strip"), [(1024, 256, 8192, 256), (7, 3, 5, 2)])
def test_ties_repeats_bad_rows_and_any_block_size(spark, monkeypatch, block, page, chunk, strip):
    for name, v in (("BLOCK_ROWS", block), ("PAGE", page), ("CHUNK", chunk), ("STRIP", strip)):
        monkeypatch.setattr(H, name, v)
    rng = np.random.default_rng(11)
    rows = [(i, int(rng.integers(3)) if i % 3 else 1, [float(v) for v in rng.integers(-2, 3, 4) / 4])
            for i in range(150)]
    rows += [(200 + i, i % 3, rows[0][2]) for i in range(30)]  # many equal vectors
    rows += [rows[10], rows[10], rows[20], (20, 2, [0.5, 0.5, 0.5, 0.5]), (301, 0, [1.0, 2.0]),
             (302, 1, []), (310, 5, [1.0, 1.0, 1.0, 1.0]), (-10, 0, [0.25, -0.5, 1.0, 0.75])]
    bad = [(400, None, [1.0] * 4), (410, 1, None), (420, 1, [1.0, None, 1.0, 1.0]),
           (430, 1, [float("nan")] * 4), (440, 1, [float("inf")] * 4), (None, 1, [1.0] * 4)]
    df = spark.createDataFrame([(*r[:2], r[2], "a", "b", 1) for r in rows + bad],
                               "vec_id long, label int, embedding array<double>, id string, "
                               "values string, anchor int")
    assert _got(H.mine(df, F.col("vec_id") % 10 == 0)) == _brute(rows, lambda i: i % 10 == 0)
    assert _got(H.mine(df, F.col("vec_id") % 10 == 0, 2, 3, (-50, 100))) == _brute(
        rows, lambda i: i % 10 == 0, 2, 3, (-50, 100))
    assert _got(H.mine(df.limit(0), F.lit(True))) == []
    assert _got(H.mine(df, F.col("vec_id") == 12345)) == []


def test_large_components(spark):
    rows = [(i, i % 2, [float(v) for v in np.random.default_rng(i).normal(0, 2.5e5, 3)])
            for i in range(40)]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")
    assert _got(H.mine(df, F.col("vec_id") < 5)) == _brute(rows, lambda i: i < 5)


@pytest.mark.parametrize(("dims", "bits"), [(2, 4), (3, 3), (4, 2), (5, 1)])
def test_hilbert_steps_to_a_neighbour(dims, bits):
    cells = np.array(list(itertools.product(range(1 << bits), repeat=dims)))
    place = H.hilbert(cells, bits)
    assert sorted(place) == list(range(len(cells)))
    path = cells[np.argsort(place)]
    assert (np.abs(np.diff(path, axis=0)).sum(1) == 1).all()


def test_bounds_hold_and_prune(spark):
    rng = np.random.default_rng(2)
    q, x = rng.integers(-50, 50, (9, 6)), rng.integers(-50, 50, (40, 6))
    least, greatest = H.interval_bounds(q.astype(float), x.min(0, keepdims=True).astype(float),
                                        x.max(0, keepdims=True).astype(float))
    score = q @ x.T
    assert (least[:, 0] <= score.min(1)).all() and (greatest[:, 0] >= score.max(1)).all()
    # Well separated groups: an anchor needs few of the blocks for its positives.
    centre = rng.normal(0, 1, (40, 8))
    rows = [(i, i % 2, [float(v) for v in centre[i % 40] * 4 + rng.normal(0, 0.01, 8)])
            for i in range(4000)]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")
    src = df.select(F.col("vec_id").alias("id"), F.col("label").cast("long").alias("label"),
                    F.col("embedding").alias("v"), F.lit(False).alias("anchor"))
    layout = H.Layout(src.select("v"), 256)
    placed = src.mapInArrow(H._placed(layout), "id long, label long, place long, values binary, "
                            "anchor boolean")
    H_rows, H.BLOCK_ROWS = H.BLOCK_ROWS, 50
    try:
        blocks = H.Blocks(placed, layout)
        total = spark.read.parquet(blocks.path).count()
        vec = np.floor(256 * np.array(rows[0][2]))[None]
        s = H._Search(layout, blocks.zones, np.array([0]), np.array([0]), vec, 5, 10, (30, 90))
        s.scan(s.own_label, s.take_own)
        assert total >= 80 and s.read <= total // 8
    finally:
        H.BLOCK_ROWS = H_rows
