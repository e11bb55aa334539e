"""Centroid clustering against plain integers."""

import hashlib
import math
import random

import numpy as np
import pytest

from gleaner.llm import centroids


def plain(rows, k=16, rounds=3, dimensions=64):
    """All distances in Python's integers."""
    kept = [(i, [math.floor(64 * x) for x in v]) for i, v in rows if v is not None and len(v) == dimensions and all(x is not None and math.isfinite(x) for x in v)]
    first = sorted(kept, key=lambda r: (hashlib.sha256(f"1:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))[:k]
    cs = [v for _, v in first]
    near = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), j) for j, c in enumerate(cs))
    for _ in range(rounds):
        own = [near(v)[1] for _, v in kept]
        members = [[v for (_, v), j in zip(kept, own, strict=True) if j == k] for k in range(len(cs))]
        cs = [[sum(col) // len(m) for col in zip(*m, strict=True)] if m else c for m, c in zip(members, cs, strict=True)]
    out = [(i, near(v)) for i, v in kept]
    return sorted(((i, j, d if d < 1 << 63 else None) for i, (d, j) in out), key=str), cs


def check(spark, rows, kind="float", **more):
    df = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>")
    found, cs = centroids.cluster(df, **more)
    got = sorted((tuple(r) for r in found.collect()), key=str)
    # what a float column holds is what counts
    held = [(r.vec_id, r.embedding) for r in df.collect()]
    assert (got, cs) == plain(held, **{n: v for n, v in more.items() if n in ("k", "rounds", "dimensions")})


def test_by_hand(spark):
    rng = random.Random(1)
    rows = [(i, [rng.gauss(0, 0.2) for _ in range(64)]) for i in range(300)]
    rows += [(300, None), (301, [0.1] * 63), (302, [0.1] * 65), (303, [0.1] * 63 + [None]), (304, [0.1] * 63 + [float("nan")]), (305, [0.1] * 63 + [float("inf")]), (306, [])]
    rows += [(None, rows[0][1]), (None, rows[1][1]), (7, rows[8][1]), (7, rows[9][1]), (7, rows[7][1])]
    check(spark, rows)


def test_ties_and_copies(spark):
    """Few distinct values: most vectors are equally near to several centroids, and many centroids are equal."""
    rng = random.Random(2)
    rows = [(i, [rng.choice([0.0, 1 / 64, -1 / 64, 0.5]) for _ in range(4)]) for i in range(400)] + [(400 + i, [0.0] * 4) for i in range(200)]
    check(spark, rows, dimensions=4)
    check(spark, rows, dimensions=4, k=40, rounds=1)


def test_very_large_components(spark):
    """Far beyond 64 bits clusters are exact; distances that no long holds are null."""
    rng = random.Random(3)
    rows = [(i, [rng.choice([1, -1, 0, 0.3]) * 10.0 ** rng.choice([0, 0, 1, 7, 18, 30, 37]) for _ in range(5)]) for i in range(120)]
    check(spark, rows, dimensions=5, k=9)
    check(spark, [(i, [x * 1e250 for x in v]) for i, v in rows], "double", dimensions=5, k=9)


def test_few_and_none(spark):
    check(spark, [(1, [1.0] * 64), (2, [2.0] * 64)])
    none = spark.createDataFrame([(1, [float("nan")] * 64), (2, None)], "vec_id long, embedding array<float>")
    assert centroids.cluster(none)[0].count() == 0 and centroids.cluster(none.limit(0))[1] == []


def test_ids_and_columns_that_clash(spark):
    rng = random.Random(4)
    rows = [(f"v{i}", [rng.gauss(0, 1) for _ in range(8)], 1, 2, 3) for i in range(50)]
    df = spark.createDataFrame(rows, "vec_id string, embedding array<double>, x int, cluster int, `order` int")
    found, cs = centroids.cluster(df, dimensions=8, k=4)
    assert sorted(map(tuple, found.collect())) == plain([r[:2] for r in rows], k=4, dimensions=8)[0] and len(cs) == 4


@pytest.mark.parametrize("scale", [1, 1e3, 1e6])
def test_bounds_hold(scale):
    """No exact distance lies outside of its interval, however the product is summed."""
    rng = np.random.default_rng(int(scale))
    x, c = (np.floor(rng.normal(0, scale, (200, 64)) * rng.choice([1, 1, 30], (200, 1))) for _ in range(2))
    low, high = centroids.screen(x, c)
    exact = np.array([[sum(int(b) * int(b) - 2 * int(a) * int(b) for a, b in zip(r, s, strict=True)) for s in c] for r in x[:40]], dtype=object)
    assert ((low[:40] <= exact.astype(float)) & (exact.astype(float) <= high[:40])).all()
    # and they are narrow enough to be of use: nearly all rows are settled by them
    close = low <= high.min(axis=1, keepdims=True)
    assert (close.sum(axis=1) == 1).mean() > 0.95
