"""Hard negatives: brute force, several shards and groups, odd rows, whole numbers of any size."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from ratecraft.llm import hard_negatives

SF = "/root/testdata/sf0.01"


def brute(rows, scale=256, positives=5, negatives=10, low=30, high=90, every=100):
    valid, seen = [], set()
    for i, label, v in rows:
        if i is None or label is None or not v or any(c is None or not math.isfinite(c) for c in v):
            continue
        if (i, label, tuple(v)) not in seen:
            seen.add((i, label, tuple(v)))
            valid.append((i, label, [math.floor(scale * c) for c in v]))
    out = []
    for i, label, a in valid:
        if i % every:
            continue
        others = [(-sum(p * q for p, q in zip(a, x)), j, m) for j, m, x in valid if j != i and len(x) == len(a)]
        for s, j, _ in sorted(o for o in others if o[2] == label)[:positives]:
            hit = sorted(o for o in others if o[2] != label and low * -s <= 100 * -o[0] <= high * -s)[:negatives]
            out += [(i, j, k, o[1], -s, -o[0]) for k, o in enumerate(hit, 1)]
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame([(i, label, v) for i, label, v in rows], "vec_id long, label int, embedding array<double>")


def mined(df, **options):
    return sorted(map(tuple, hard_negatives.mine(df, **options).collect()))


@pytest.mark.parametrize("dims,shard,group", [(3, 64, 4), (3, 10_000, 100), (24, 100, 5)])
def test_as_brute_force(spark, dims, shard, group):
    rng = np.random.default_rng(dims)
    x = np.round(rng.normal(size=(900, dims)), 2 if dims > 3 else 1)      # many ties
    rows = [(i, int(rng.integers(0, 4)), x[i].tolist()) for i in range(900)]
    want = brute(rows, every=30)
    assert len(want) > 500 and mined(frame(spark, rows), every=30, shard=shard, group=group) == want


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    near = [(i, i % 3, [1.0, i / 40, 0.5]) for i in range(1, 40)]
    rows = [(0, 1, [1.0, 0.5, 0.25]), (0, 1, [1.0, 0.5, 0.25]), (100, 2, [0.0, 0.0, 0.0]), (200, 0, [-1.0, 0.0, 1.0]), (300, None, [1.0, 1.0, 1.0]),
            (400, 1, None), (500, 1, []), (600, 1, [nan, 1.0, 1.0]), (700, 1, [None, 1.0, 1.0]), (800, 1, [inf, 0.0, 0.0]), (None, 1, [1.0, 1.0, 1.0]),
            (900, 1, [1.0, 0.5]), (41, 1, [1.0, 0.25]), (42, 0, [1.0, 0.125]), (7, 2, [1.0, 1.0, 0.9]), (7, 2, [1.0, 1.0, 0.9]), *near, *near]
    df = frame(spark, rows).withColumns({c: F.lit("x") for c in ("key", "score", "rank", "part", "anchor", "dims")})
    want = brute(rows)
    assert want and mined(df) == want and mined(df, shard=8, group=1) == want
    assert mined(df.where("false")) == []


def test_numbers_beyond_doubles(spark):
    """Scores that a double cannot tell apart are still in order."""
    big = 2.0 ** 22
    rows = [(100, 1, [big, 1.0]), (1, 1, [big, 1.0])] + [(i, 2, [big / 2, i / 256]) for i in range(2, 40)]
    assert brute(rows)[0][3:] != brute(rows)[1][3:] and mined(frame(spark, rows)) == brute(rows)
    # held at the ends of a long, not an error
    got = mined(frame(spark, [(100, 1, [1e300, 1.0]), (1, 1, [1e300, 1.0]), (2, 2, [1e-3, 1.0])]))
    assert got == []


def test_search_stops_before_all_rows_are_met():
    """In few dimensions the threshold falls below the k-th score long before the lists end."""
    rng = np.random.default_rng(1)
    x = rng.integers(-500, 500, (5000, 3))
    ids = np.arange(5000)
    part = hard_negatives.Shard(ids, ids, ids % 2, x)
    scored = []

    class Counted(np.ndarray):
        def __matmul__(self, other):
            scored.append(len(self))
            return np.asarray(self) @ other
    part.floats = part.floats.view(Counted)
    held = [[]]
    hard_negatives.search(part, np.array([40, -3, 11]), np.ones(5000, bool), [(-math.inf, math.inf)], 5, held)
    scores = x @ np.array([40, -3, 11])
    assert held[0] == sorted((-int(s), i, i) for i, s in enumerate(scores))[:5]
    assert sum(scored) < 2500
    # and a window below the best scores
    held = [[]]
    hard_negatives.search(part, np.array([40, -3, 11]), ids % 2 == 1, [(2000, 9000)], 10, held)
    assert held[0] == sorted((-int(s), i, i) for i, s in enumerate(scores) if i % 2 and 2000 <= s <= 9000)[:10]
