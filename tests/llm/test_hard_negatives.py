import math
from collections import Counter

import numpy as np
import pytest
from llm.brute import no_rows
from pyspark.sql import functions as F

from reviewlake.llm import hard_negatives as hn

SCHEMA = "vec_id long, label int, embedding array<double>, id string, vec string, score int"


def frame(spark, rows):
    return spark.createDataFrame([(i, lab, v, "x", None, n) for n, (i, lab, v) in enumerate(rows)], SCHEMA)


def mined(df, every):
    return Counter(tuple(r) for r in hn.hard_negatives(df, F.col("id") % every == 0).collect())


def brute(rows, every):
    lengths = Counter()
    kept = {}
    for i, lab, v in rows:
        if i is None or lab is None or not v or any(x is None or not math.isfinite(x) for x in v):
            continue
        kept[i] = min(kept.get(i, (lab, v)), (lab, v))
    lengths = Counter(len(v) for _, v in kept.values())
    most = max(lengths, key=lambda d: (lengths[d], d), default=0)
    kept = {i: (lab, [math.floor(256 * x) for x in v]) for i, (lab, v) in kept.items() if len(v) == most}
    out = Counter()
    for a, (lab, v) in kept.items():
        if a % every:
            continue
        scores = sorted(((-sum(x * y for x, y in zip(v, w)), i, m == lab) for i, (m, w) in kept.items() if i != a))
        for s, p, same in [x for x in scores if x[2]][:5]:
            near = [(n, -t) for t, n, alike in scores if not alike and 30 * -s <= 100 * -t <= 90 * -s][:10]
            out.update((a, p, rank, n, -s, t) for rank, (n, t) in enumerate(near, 1))
    return out


def clustered(n, d=8, seed=3):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((7, d))
    return [(i, int(rng.integers(3)), (centres[rng.integers(7)] + 0.3 * rng.standard_normal(d)).tolist()) for i in range(n)]


def test_awkward_rows(spark):
    same = [0.5, 0.25, -0.125, 1.0]
    rows = [(i, i % 2, same) for i in range(40)]
    rows += [(None, 1, same), (100, None, same), (101, 1, None), (102, 1, [0.1, None, 0.2, 0.3]), (104, 1, [0.1, 0.2]),
             (103, 1, [0.1, float("nan"), 0.2, 0.3]), (105, 1, [0.1, float("inf"), 0.2, 0.3]), (106, 0, []),
             (10, 1, [0.2, 0.9, 0.1, 0.4]), (10, 0, [0.9, 0.1, 0.1, 0.4]), (11, 1, same), (11, 1, same),
             (200, 5, [1.0, 1.0, 1.0, 1.0]), (210, 0, [-1e-20, 0.0, -0.0, 0.7]), (220, 1, [0.0, 0.0, 0.0, 0.0])]
    rows += [(300 + i, i % 3, [0.1 * i, 0.4, -0.3, 0.2 * (i % 5)]) for i in range(60)]
    got = mined(frame(spark, rows), 10)
    assert got == brute(rows, 10) and got


def test_values_beyond_exact_doubles(spark):
    rows = [(i, i % 2, [1e6 + i / 7, 3e5 * (i % 4), 2.5e6]) for i in range(30)]
    assert mined(frame(spark, rows), 5) == brute(rows, 5)


@pytest.mark.parametrize("steps", [(16, 4, 2, 5), (64, 3, 1, 20)])
def test_many_shards_and_blocks(spark, monkeypatch, steps):
    for name, value in zip(("SHARD_ROWS", "BLOCK_ANCHORS", "BLOCKS", "STEP_ROWS"), steps):
        monkeypatch.setattr(hn, name, value)
    rows = clustered(400)
    assert mined(frame(spark, rows), 20) == brute(rows, 20)


def test_search_stops_early_and_bounds_hold():
    rows = clustered(4000, d=4)
    vectors = np.floor(256 * np.array([v for _, _, v in rows]))
    rng = np.random.default_rng(1)
    books = [hn.k_means(h, rng) for h in hn.halves(vectors)]
    codes = [hn.nearest(h, b) for h, b in zip(hn.halves(vectors), books)]
    cell = codes[0] * len(books[1]) + codes[1]
    order = np.lexsort((np.arange(4000), cell))
    shard = hn.Shard({"n": 4000, "ids": order.astype(np.int64).tobytes(), "labels": np.zeros(4000, np.int64).tobytes(),
                      "vectors": vectors[order].tobytes(), "cells": cell[order].astype(np.int32).tobytes()}, books)
    query, seen, last = vectors[5], np.zeros(0, int), np.inf
    for places, bound in shard.visited(query):
        assert shard.scores(places, query).max() <= last
        last = bound
        seen = np.append(seen, places)
    assert sorted(seen) == list(range(4000))
    want = hn.Best(5)
    scored = hn.search(shard, query, [want], lambda labels, ids: np.ones(len(ids), bool))
    scores = vectors @ query
    assert want.ids.tolist() == sorted(range(4000), key=lambda i: (-scores[i], i))[:5]
    assert scored < 4000


def test_empty_table(spark):
    assert mined(no_rows(frame(spark, [(1, 1, [0.1, 0.2])])), 10) == Counter()
    assert mined(frame(spark, [(10, 1, [0.1, 0.2])]), 10) == Counter()
