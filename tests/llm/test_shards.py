"""Sharding: cut links, counts, slots and digests against plain Python."""

import random
import zlib
from collections import Counter, defaultdict

import pytest
import xxhash
from pyspark.sql import functions as F

from gleaner.llm import shards
from gleaner.llm.common import Scratch


def _share_cut(rows):
    groups = defaultdict(Counter)
    for r in rows:
        groups[r.text][r.shard] += 1
    pairs = lambda n: n * (n - 1) // 2
    links = sum(pairs(sum(g.values())) for g in groups.values())
    return 1 - sum(pairs(n) for g in groups.values() for n in g.values()) / links


@pytest.mark.parametrize(("size", "linked"), [(2, 1.0), (5, 1.0), (50, 1.0), (5, 0.8), (2, 0.95)])
def test_equal_texts_stay_together(spark, size, linked):
    n = 8000
    text = F.concat(F.lit("t"), F.when(F.col("id") < int(n * linked), F.floor(F.col("id") / size)).otherwise(F.col("id") + n).cast("string"))
    docs = spark.range(n).select(F.col("id").alias("doc_id"), text.alias("text"))
    rows = shards.shard(docs).join(docs, "doc_id").collect()
    counts = Counter(r.shard for r in rows)
    assert len(rows) == n and max(counts.values()) - min(counts.values()) <= 1
    assert _share_cut(rows) < 0.05


def test_a_group_of_a_third_of_all_rows(spark):
    n = 6000
    docs = spark.range(n).select(F.col("id").alias("doc_id"), F.when(F.col("id") < n // 3, "hot é").otherwise(F.floor(F.col("id") / 2).cast("string")).alias("text"))
    rows = shards.shard(docs).join(docs, "doc_id").collect()
    counts = Counter(r.shard for r in rows)
    assert max(counts.values()) - min(counts.values()) <= 1
    assert _share_cut([r for r in rows if r.text != "hot é"]) < 0.05
    for s in range(shards.SHARDS):
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(counts[s]))
    assert all((r.size, r.text_crc32) == (len(r.text.encode()) + 1, zlib.crc32(r.text.encode())) for r in rows)


def _hash(*values):
    """Spark's xxhash64 of longs and, as bytes of four, of numbers marked as integers."""
    h = 42
    for v, width in values:
        h = xxhash.xxh64_intdigest(v.to_bytes(width, "little", signed=True), h)
    return h - (1 << 64) if h >> 63 else h


def plain_rounds(groups, quota):
    """The rounds one group after another: who is drawn where, and whom a shard takes."""
    room, settled, left = list(quota), [], {g: total for g, total, _ in groups}
    labels, totals = {g: own for g, _, own in groups}, {g: total for g, total, _ in groups}
    k = 0
    while True:
        drawn = defaultdict(list)
        for g, n in left.items():
            tie = lambda s: _hash((g, 8), (s, 4), (k, 4))  # noqa: E731, B023
            open_ = [(c, tie(s), s) for s, c in labels[g].items() if room[s] >= n]
            any_ = [(tie(s), s) for s in range(len(room)) if room[s] >= n]
            large = totals[g] > max(quota)
            to = max(open_)[2] if open_ else max(any_)[1] if any_ else max(range(len(room)), key=lambda s: room[s]) if large and max(room) else None
            if to is not None:
                drawn[to].append((g, n, large))
        rest, now = {}, list(room)
        for s, rows in drawn.items():
            place = lambda r: ((63 - (r[1].bit_length() - 1)) * 16 + _hash((r[0], 8)) % 16, r[0])
            start = 0
            for g, n, large in sorted(rows, key=place):
                free = max(0, room[s] - start)
                take = min(n, free) if n <= free or large else 0
                start += n
                if take:
                    settled.append((k, g, s, take))
                    now[s] -= take
                if take < n:
                    rest[g] = n - take
        if now == room:
            return sorted(settled)
        room, left, k = now, rest, k + 1


@pytest.mark.parametrize(("seed", "fill"), [(1, 1.0), (2, 1.0), (3, 0.8), (4, 1.6)])
def test_rounds_by_hand(spark, seed, fill):
    """Which group moves where in which round; shards that are nearly full, groups larger than a shard, and more than fits in all."""
    rng = random.Random(seed)
    sizes = [rng.choice([2, 2, 2, 3, 5, 8, 30, 90]) for _ in range(250)] + [700, 400]
    groups = []
    for total in sizes:
        own = Counter(rng.randrange(8) for _ in range(min(total, 40)))
        own[rng.choice(list(own))] += total - sum(own.values())
        groups.append((rng.randrange(-(1 << 63), 1 << 63), total, dict(own)))
    quota = [int(sum(sizes) / 8 / fill) + (s % 3) for s in range(8)]
    df = spark.createDataFrame([(g, t, [(s, c) for s, c in own.items()]) for g, t, own in groups], "g long, total long, labels array<struct<shard:int,n:long>>")
    tables = shards._propagate(df, quota, Scratch(spark, "rounds"))
    got = sorted((k, r.g, r.shard, r.n) for k, t in enumerate(tables) for r in t.collect())
    assert got == plain_rounds(groups, quota) and len({k for k, *_ in got}) > 2
