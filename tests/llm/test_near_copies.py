"""The pipeline's near-dedup stage against brute force over all pairs."""

import random

import numpy as np

import corpus_pipeline
from gleaner.llm import nearcopies
from gleaner.llm.common import Scratch


def _grams(text):
    t = text.lower().split()
    return {tuple(t[i : i + 5]) for i in range(len(t) - 4)} if len(t) >= 5 else {tuple(t)} if t else set()


def _alike(a, b):
    return not (a or b) or (bool(a & b) and 5 * len(a & b) >= 4 * len(a | b))


def _copy(rng, text, share):
    out = text.split()
    for i in range(len(out)):
        if rng.random() < share:
            out[i] = f"neu{rng.randrange(10**6)}"
    return " ".join(out)


def texts(seed=5):
    rng = random.Random(seed)
    vocab = [f"wort{i}" for i in range(400)]
    # a passage that half of all texts share, and texts without any copy
    common = " ".join(rng.choices(vocab, k=30))
    out = []
    for k in range(60):
        base = " ".join(rng.choices(vocab, k=rng.choice([4, 6, 12, 40, 150, 400])))
        base = f"{base} {common}" if k % 2 else base
        out += [base, *(_copy(rng, base, s) for s in (0.005, 0.02, 0.03, 0.045))]
    return [*out, None, "", " \n", "a b", "A  b"]


def kept_by_brute_force(found):
    sets = [_grams(t or "") for t in found]
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    links = 0
    for i in range(len(sets)):
        for j in range(i):
            if _alike(sets[i], sets[j]):
                links += 1
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i for i in range(len(sets)) if find(i) == i}, links


def test_all_near_copies_go(spark, monkeypatch):
    found = texts()
    want, links = kept_by_brute_force(found)
    docs = spark.createDataFrame(list(enumerate(found)), "doc_id long, text string")
    got = corpus_pipeline.near_dedup(spark, docs, "")
    assert links > 100 and got.columns == docs.columns and {r.doc_id for r in got.collect()} == want


def test_blocks_meet(spark):
    """A group in many blocks has the same components as in one."""
    sets = [nearcopies.shingle_set(t) for t in texts(8)[:120]]
    ids = [nearcopies._set_id(a) for a in sets]
    found = list(dict(zip(ids, texts(8))).items())
    both = spark.createDataFrame([(i, 7, len(nearcopies.shingle_set(t)), k, t) for k, (i, t) in enumerate(found)], "s long, root long, n int, text_hash long, text string")
    want = []
    for block in (1 << 20, 2000):
        edges = nearcopies.checked(both.drop("text"), both.select("text_hash", "text"), 5, 0.8, Scratch(spark, "test"), block).collect()
        root = {i: i for i, _ in found}

        def find(x):
            while root[x] != x:
                x = root[x]
            return x

        for e in edges:
            a, b = find(e.u), find(e.v)
            root[max(a, b)] = min(a, b)
        want.append([find(i) for i, _ in found])
    assert want[0] == want[1] and 40 < len(set(want[0])) < 110


def test_similarity_and_sketch():
    rng = random.Random(2)
    sets = [np.array(sorted(rng.sample(range(40), rng.randrange(1, 40))), np.uint64) for _ in range(60)]
    place = np.arange(60)
    want = [[a is not b and 5 * len({*a} & {*b}) >= 4 * len({*a} | {*b}) for b in sets] for a in sets]
    assert (nearcopies.similar(sets, place, place) == want).all()
    big = np.unique(np.random.default_rng(1).integers(0, 1 << 63, 70_000).astype(np.uint64))
    mixed = np.stack([nearcopies._mixed(big, k) for k in range(4)])
    ones = (mixed[:, :, None] >> np.arange(64, dtype=np.uint64) & np.uint64(1)).sum(axis=1)
    assert nearcopies.sketch(big).tolist() == [sum(1 << b for b in range(64) if 2 * row[b] > len(big)) for row in ones]
    # sets at 0.8 are within the radius, unrelated ones aren't
    apart = []
    for n in (5, 9, 18, 90, 900):
        for k in range(200):
            x = np.random.default_rng(n + 1000 * k).integers(0, 1 << 63, 2 * n).astype(np.uint64)
            a, b = x[:n], x[n // 10 : n + n // 10] if n >= 9 else x[: n - 1]
            apart.append([int(np.bitwise_count(nearcopies.sketch(a) ^ nearcopies.sketch(c)).sum()) for c in (b, x[n:])])
    near, far = np.array(apart).T
    assert np.mean(near <= nearcopies.RADIUS) > 0.995 and (far > nearcopies.RADIUS).all()


def test_threshold(spark):
    words = [f"w{i}" for i in range(22)]
    # 18 shingles; 16 of 20 (0.8) are shared with the second, 15 of 21 with the third
    base, at, below = words, [*words[:20], "x", "y"], [*words[:19], "x", "y", "z"]
    docs = spark.createDataFrame([(1, " ".join(base)), (2, " ".join(at)), (3, " ".join(below[::-1]))], "doc_id long, text string")
    assert _alike(_grams(" ".join(base)), _grams(" ".join(at))) and {r.doc_id for r in nearcopies.keep_one(docs).collect()} == {1, 3}


def test_nulls_and_repeated_ids(spark):
    schema = "doc_id long, text string, shingles string, s long"
    rows = [(1, "a b c d"), (2, "a b c d"), (2, "a b c d"), (3, None), (None, "x y z"), (None, None), (4, ""), (8, "A b  c d")]
    docs = spark.createDataFrame([(*r, "k", 1) for r in rows], schema)
    kept = nearcopies.keep_one(docs)
    assert kept.columns == docs.columns and sorted((r.doc_id or 0) for r in kept.collect()) == [0, 1, 3]
    assert nearcopies.keep_one(docs.limit(0)).count() == 0
