"""Exact top-k search (12) against brute force."""

import math
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from oxbow.llm import topk
from tests.llm.conftest import tuples

SCHEMA = "vec_id long, embedding array<double>, label int"


def brute(rows, k=20, every=20, scale=64.0):
    """rows: (vec_id, vector)."""
    ok = []
    for i, v in rows:
        if v is not None and all(x is not None and math.isfinite(x) and math.isfinite(scale * x) for x in v):
            ok.append((i, [int(math.floor(scale * x)) for x in v]))
    out = []
    for n, (i, q) in enumerate(ok):
        if i is not None and i % every == 0:
            best = sorted((-min(max(sum(a * b for a, b in zip(q, x)), -2**63), 2**63 - 1), j is None, j or 0, j)
                          for m, (j, x) in enumerate(ok) if m != n)
            out += [(i, r, b[3], -b[0]) for r, b in enumerate(best[:k], 1)]
    return sorted(out, key=repr)


def run(df, **kw):
    got = topk.top_k(df, F.col("vec_id") % 20 == 0, **kw)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    return tuples(got)


def test_odd_vectors(spark):
    nan, inf, hot = float("nan"), float("inf"), [0.5, -0.25, 1.0]
    rows = [(0, hot), (1, None), (2, []), (3, [1.0, None, 2.0]), (4, [nan, 1.0]), (5, [inf, 0.0, 0.0]),
            (6, [-0.0, 0.0, 0.001]), (7, [-0.001, 5.0]), (20, [1.0] * 9), (20, [1.0] * 9), (20, hot), (40, []),
            (60, [1e200, 1.0, -1e200]), (61, [1e300, 3.0]), (62, [-1e18, 2.0, 7.0]), (80, [1e307]), (100, [1.8e308]),
            (None, hot), (None, [9.0, 9.0, 9.0]), (120, None), (-40, [2.0, 0.5, -3.0])]
    rows += [(1000 + i, hot) for i in range(60)] + [(2000 + i, [0.0, 0.0, 0.0]) for i in range(30)]
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], SCHEMA).repartition(3)
    df = df.select("*", *[F.lit("z").alias(c) for c in ("v", "x", "uid", "qid", "cell", "away", "score", "rank", "ids")])
    assert run(df) == brute(rows)
    assert run(df, k=1, group=1) == brute(rows, k=1)
    assert run(df.where("vec_id = 0")) == []
    assert run(df.limit(0)) == []


@pytest.mark.parametrize("clusters,group,block,part", [(0, 512, 2048, 1 << 16), (0, 3, 2, 50), (12, 4, 2048, 1 << 16),
                                                       (12, 2, 1, 7)])
def test_against_brute_force(spark, monkeypatch, clusters, group, block, part):
    for name, value in (("BLOCK", block), ("PART", part), ("_STEP", 16)):
        monkeypatch.setattr(topk, name, value)
    rng = np.random.default_rng(clusters + group)
    x = rng.normal(size=(700, 6))
    if clusters:
        x = 20 * rng.normal(size=(clusters, 6))[rng.integers(0, clusters, 700)] + 0.2 * x
    x[200:290] = x[7]  # a vector in many rows, queries among them
    rows = [(i, v) for i, v in enumerate(x.tolist())]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], SCHEMA).repartition(4)
    assert run(df, group=group) == brute(rows)


def test_bounds_prune_clusters():
    """On clustered data most vectors are copied to few groups, and none that is needed is left out."""
    rng = np.random.default_rng(2)
    centre = 50 * rng.normal(size=(16, 8))
    x = np.floor(centre[rng.integers(0, 16, 4000)] + rng.normal(size=(4000, 8)))
    pivots = [topk.pack(np.floor(c)) for c in centre]
    cell, away = topk._near(x, topk.unpack(pivots))
    nearest = {j: [*sorted(away[cell == j])[:21], away[cell == j].max()] for j in range(16)}
    every = {j: int((cell == j).sum()) for j in range(16)}
    b = topk.Bounds(pivots, every, {j: nearest[j][-1] for j in nearest}, every, nearest, 20)
    copies = 0
    for i in range(16):
        needed = b.needs(i, cell, away)
        copies += int(needed.sum())
        s = x[cell == i] @ x.T
        best = np.sort(s, axis=1)[:, -21]
        assert needed[(s >= best[:, None]).any(0)].all()
    assert copies < 3 * len(x)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.integers(-2**70, 2**70).map(lambda i: float(i >> random.Random(i).randint(0, 70))), max_size=5),
                min_size=1, max_size=6))
def test_packing_and_scores(rows):
    packed = [topk.pack(np.array(r)) for r in rows]
    x = topk.unpack(packed)
    for to, row in zip(x, rows):
        assert to[:len(row)].tolist() == row and not to[len(row):].any()
    clip = lambda s: min(max(s, -2**63), 2**63 - 1)
    want = [[clip(sum(int(p) * int(q) for p, q in zip(a, b))) for b in rows] for a in rows]
    assert topk.scores(x, x).tolist() == want
