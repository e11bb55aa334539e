"""Operators against plain Python, on small tables."""

import hashlib
import random
import re
import struct
import zlib

import numpy as np
import pandas as pd
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from gleaner.llm import bpe, components, licenses, linededup, media, quality, simhash, toxicity, winnow
from gleaner.llm.common import Scratch

SF = "/root/testdata/sf0.001"


def test_fingerprint():
    rng = random.Random(3)
    for n in (0, 1, 2, 3, 50):
        words = [rng.choice("abcdé") * rng.randint(1, 3) for _ in range(n)]
        grams = [" ".join(words[i : i + 3]) for i in range(max(1, n - 2))] if n else []
        hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
        want = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if n else 0
        assert simhash.fingerprint("\n ".join(words).replace("a", "A")) & (1 << 64) - 1 == want


def _union(n, edges):
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


@pytest.mark.parametrize("dense", [False, True])
def test_tiles_keep_components(spark, dense):
    rng = np.random.default_rng(5)
    base = rng.integers(0, 1 << 63, 3 if dense else 200, dtype=np.uint64)
    flips = rng.integers(0, 12 if dense else 64, (400, 3))
    fps = np.unique([base[i % len(base)] ^ np.bitwise_or.reduce(np.uint64(1) << f.astype(np.uint64)) for i, f in enumerate(flips)])
    near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 2
    want = _union(len(fps), zip(*np.nonzero(np.triu(near, 1)), strict=True))
    u, v = simhash.links(fps[:, None], fps[:, None], True, 2)
    assert len(u) < len(fps)
    at = {x: i for i, x in enumerate(fps.tolist())}
    assert _union(len(fps), zip((u % len(fps)).tolist(), (v % len(fps)).tolist(), strict=True)) == want
    half = len(fps) // 2
    u, v = simhash.links(fps[:half, None], fps[half:, None], False, 2)
    across = [(i, j) for i, j in zip(*np.nonzero(np.triu(near, 1)), strict=True) if i < half <= j]
    assert len(u) < len(fps) and _union(len(fps), zip(u.tolist(), v.tolist(), strict=True)) == _union(len(fps), across)
    if dense:
        return
    nodes = spark.createDataFrame(pd.DataFrame({"node": fps.view(np.int64)}))
    nodes = nodes.select("node", F.array("node").alias("fp"), simhash.lane_cell(F.col("node")).alias("cell"))
    edges = simhash.linked(nodes, simhash._offsets(2), Scratch(spark, "test"), 2).toPandas()
    pairs = [(at[a & (1 << 64) - 1], at[b & (1 << 64) - 1]) for a, b in zip(edges.u.tolist(), edges.v.tolist(), strict=True)]
    assert _union(len(fps), pairs) == want


def test_components(spark):
    edges = [(i, i + 1) for i in range(20)] + [(50, 40), (41, 50), (7, 7)]
    df = spark.createDataFrame([*edges, (None, 3)], "u long, v long")
    got = {r.node: r.root for r in components.components(df, Scratch(spark, "test")).collect()}
    assert got == {**{i: 0 for i in range(1, 21)}, 41: 40, 50: 40}


def _distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_lines_within_one_edit(spark):
    rng = random.Random(1)
    lines = ["".join(rng.choice("abé") for _ in range(rng.randint(1, 7))) for _ in range(90)]
    long = "une phrase assez longue pour huit segments"
    lines += [long, long[:20] + long[21:], long[:5] + "X" + long[6:], long + "!", long[1:] + "??"]
    rng.shuffle(lines)
    rows = [(i, "\n".join(lines[i * 5 : i * 5 + 5])) for i in range(19)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    firsts = []
    for i, t in rows:
        for at, x in enumerate(t.split("\n")):
            if x not in [f[2] for f in firsts]:
                firsts.append((i, at, x))
    keep = {(i, at) for k, (i, at, x) in enumerate(firsts) if not any(_distance(x, y) <= 1 for _, _, y in firsts[:k])}
    want = {i: "\n".join(x for at, x in enumerate(t.split("\n")) if (i, at) in keep) for i, t in rows}
    for limit in (linededup.BROADCAST_ROWS, 0):
        assert {r.doc_id: r.text for r in linededup.line_dedup(df, broadcast_rows=limit, near_chars=0).collect()} == want


def test_bpe_like_the_library():
    model, library = bpe.Automaton(), Tokenizer.from_file(bpe.VOCABULARY)
    library.no_truncation()
    library.no_padding()
    rng = random.Random(2)
    texts = ["".join(rng.choice(s) for _ in range(rng.randint(1, 30))) for s in ("ab", "aehint", "eéè ßñ中字", "I'll d1 2!?. ") for _ in range(500)]
    texts += ["a" * n for n in range(40)] + ["a<|endoftext|>b<|startoftext|>", "ΑΣ ΑΣΑ", "\x1c\x85 "]
    for text, want in zip(texts, library.encode_batch(texts, add_special_tokens=False), strict=True):
        ids = model.encode(text)
        assert ids.tolist() == want.ids and model.decode(ids) == library.decode(want.ids, skip_special_tokens=False)


def test_png_round_trip_and_damage(spark, tmp_path):
    data = media.payload("héllo".encode() * 40)
    assert media.decode_png(media.encode_png(data)) == data
    docs = spark.createDataFrame([(i, "x" * i * 50) for i in range(40)], "doc_id long, text string").repartition(3)
    media.write_archives(docs, f"file://{tmp_path}/a")
    rows = media.read_archives(spark, f"file://{tmp_path}/a", range_bytes=500, batch_bytes=200).collect()
    assert sorted((int(r.doc_id), media.decode_png(bytes(r.media))) for r in rows) == [(i, media.payload(b"x" * i * 50)) for i in range(40)]
    archive = sorted((tmp_path / "a").glob("part*"))[0]
    # what a twin of a task has left isn't in the manifest
    (tmp_path / "a" / "part-00000-twin").write_bytes(archive.read_bytes())
    assert media.read_archives(spark, f"file://{tmp_path}/a").count() == 40
    raw = bytearray(archive.read_bytes())
    start = struct.unpack(media._FOOTER, raw[-struct.calcsize(media._FOOTER) :])[0]
    raw[start // 2] ^= 1
    archive.write_bytes(raw)
    reader = media.ArchiveReader(f"file://{tmp_path}/a", 1 << 20, 1 << 20, 2)
    with pytest.raises(OSError, match="offset"):
        for part in reader.partitions():
            list(reader.read(part))


def test_media_columns_by_hand(spark):
    """All columns against plain Python that shares none of the operator's code but zlib."""
    texts = ["", "a", "x" * 64, "é" * 33, "mot " * 5000]
    docs = spark.createDataFrame([(f"id-{i}", t) for i, t in enumerate(texts)], "doc_id string, text string")
    for r in media.media_columns(docs).collect():
        data = texts[int(r.doc_id[3:])].encode()
        padded = data + bytes(-len(data) % 64 or (64 if not data else 0))
        x = list(padded)
        mean = sum(x) / len(x)
        std = (sum((v - mean) ** 2 for v in x) / len(x)) ** 0.5
        step = sum(abs(p - q) for p, q in zip(x, x[1:], strict=False)) / (len(x) - 1)
        feature = f"mean={mean:.4f};std={std:.4f};zeros={x.count(0) / len(x):.6f};step={step:.4f};levels={len(set(x))}"
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32, r.feature) == (len(data), len(padded), hashlib.sha256(padded).hexdigest(), zlib.crc32(padded[-64:]), feature)
        stored = b"".join(b"\0" + padded[k : k + 64] for k in range(0, len(padded), 64))
        chunk = lambda kind, body: struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))
        png = b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", 64, len(padded) // 64, 8, 0, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(stored, 6)) + chunk(b"IEND", b"")
        assert (r.media_bytes, r.media_sha256) == (len(png), hashlib.sha256(png).hexdigest())


def test_decontamination(spark):
    rng = random.Random(4)
    make = lambda n: [rng.choice("abcdefgh") * rng.randint(1, 2) for _ in range(n)]
    items = {i: make(n) for i, n in enumerate([30, 12, 10, 25, 7, 3])}
    docs = {i: make(20) + (items[i % 6][: 9 + i % 5] if i % 2 else []) + make(10) for i in range(30)}
    df = spark.createDataFrame([(i, " ".join(w)) for i, w in docs.items()], "doc_id long, text string")
    bench = spark.createDataFrame([(i, ", ".join(w).upper()) for i, w in items.items()], "item_id long, text string")
    got = {r.doc_id: (r.n_words, r.n_hit, r["items"]) for r in winnow.decontaminate(df, bench).collect()}
    for i, w in docs.items():
        hit, found = set(), set()
        for k, item in items.items():
            n = min(10, len(item))
            windows = {tuple(item[j : j + n]) for j in range(len(item) - n + 1)}
            for j in range(len(w) - n + 1):
                if tuple(w[j : j + n]) in windows:
                    hit.update(range(j, j + n))
                    found.add(str(k))
        assert got[i] == (len(w), len(hit), sorted(found))


def test_licenses(spark):
    mit = f"Copyright. {licenses.SENTENCES['mit-grant']}:\n{licenses.SENTENCES['mit-notice']}.\n{licenses.SENTENCES['mit-warranty']}."
    rows = [(1, mit), (2, "Text. Licensed under CC BY-NC 4.0.\nMore."), (3, "Released under the MIT License.\nLicensed under the Apache License, Version 2.0."), (4, licenses.SENTENCES["mit-warranty"])]
    got = {r.doc_id: r.licenses for r in licenses.license_scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: ["MIT"], 2: ["CC-BY-NC-4.0"], 3: ["MIT", "Apache-2.0"], 4: []}


def test_machine_learns_pairs():
    rng = np.random.default_rng(0)
    x = rng.random((800, 6)) < 0.5
    y = (x[:, 0] & x[:, 1]).astype(float)
    bias, w, v = toxicity.fit_machine([np.nonzero(r)[0] for r in x], y, 6, steps=600, penalty=1e-5)
    z = [bias + w[r].sum() + 0.5 * ((v[r].sum(0) ** 2) - (v[r] ** 2).sum(0)).sum() for r in x]
    assert np.mean((np.array(z) > 0) == y) > 0.97


def test_rules_compile_to_what_they_say(spark):
    model = quality.Ensemble(-0.5, [((("words", True, 2.0), ("bang_rate", False, 0.1)), 1.5), ((("upper_share", True, 0.3),), -2.0)])
    df = spark.createDataFrame([("a b c d",), ("A! B! C!",), ("",), (None,)], "text string")
    from pyspark.sql import functions as F

    stats = df.select(*[c.alias(n) for n, c in quality.statistics(F.col("text")).items()])
    rows = stats.withColumn("score", model.column({c: F.col(c) for c in stats.columns})).collect()
    assert all(abs(r.score - model.score(r.asDict())) < 1e-12 for r in rows)


def test_held_out_accuracy(spark):
    docs, labels = spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    scored = quality.quality(docs, labels).where("held_out").join(labels, "doc_id").toPandas()
    assert (scored.predicted == scored.quality).mean() > 0.97


def test_words_pattern():
    assert re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", "ab-é9 _x") == re.findall(winnow.WORD.replace(r"\x{80}-\x{10FFFF}", "\x80-\U0010ffff"), "ab-é9 _x")
