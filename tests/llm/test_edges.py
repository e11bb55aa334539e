"""Null, empty, long, repeated and tied rows, clashing column names and empty tables, for every operator and stage."""

import hashlib
import random
import zlib
from datetime import date, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from gleaner.llm import bpe, licenses, linededup, media, quality, shards, simhash, toxicity, urlfilter, winnow
from gleaner.shared import shared_dir

SCHEMA = "doc_id long, text string, lang string, n_chars long, fp long, score double, `row` string, kept string"
LONG = "mot " * 30_000
TEXTS = [(1, "a b c d"), (2, "a b c d"), (2, "a b c d"), (3, None), (None, "x y z"), (None, None), (4, ""), (5, "  \n \n"), (6, LONG), (7, "Ünï cödé Σ\x00 end"), (8, "a b c d")]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, None, None, 1, 2.0, "r", "k") for i, t in TEXTS], SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 0, 1), (2, 1, 0), (3, None, None), (None, 1, 1), (1, 0, 1)], "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def bench(spark):
    return spark.createDataFrame([(1, None), (2, ""), (None, "b c"), (3, "b c"), (4, "zz")], "item_id long, text string")


def test_simhash(docs, none):
    rows = simhash.near_duplicates(docs).collect()
    assert len(rows) == len(TEXTS) and simhash.near_duplicates(none).count() == 0
    assert {r.component_id for r in rows if r.doc_id in (1, 2, 8)} == {1}
    assert {r.component_id for r in rows if r.doc_id in (3, 4, 5)} == {3} and all(r.fp == 0 for r in rows if r.doc_id in (3, 4, 5))
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns and sorted((r.doc_id or 0) for r in kept.collect()) == [0, 1, 3, 6, 7]


def test_toxicity_and_quality(docs, none, labels):
    for run in (toxicity.toxicity, quality.quality):
        rows = run(docs, labels).collect()
        assert len(rows) == len(TEXTS) and all(0 <= r.score <= 1 for r in rows)
        assert run(none, labels).count() == 0 and run(docs, labels.limit(0)).count() == len(TEXTS)
    assert toxicity.keep_clean(docs, labels.limit(0)).columns == docs.columns


def test_ties_count_as_label_1(docs, labels, monkeypatch):
    assert {(r.score, r.predicted) for r in quality.quality(docs, labels.limit(0)).collect()} == {(0.5, 1)}
    monkeypatch.setattr(toxicity, "fit", lambda *a: toxicity.Machine(0.0, {}, np.zeros(0), np.zeros((0, toxicity.FACTORS))))
    assert {(r.score, r.predicted) for r in toxicity.toxicity(docs, labels).collect()} == {(0.5, 1)} and toxicity.keep_clean(docs, labels).count() == 0


def test_shards(docs, none):
    rows = shards.shard(docs).collect()
    counts = [sum(r.shard == s for r in rows) for s in range(8)]
    assert sum(counts) == len(TEXTS) and max(counts) - min(counts) <= 1 and shards.shard(none).count() == 0
    for s in range(8):
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(counts[s]))
    assert {r.size for r in rows if r.doc_id == 3} == {1} and {r.text_crc32 for r in rows if r.doc_id == 1} == {zlib.crc32(b"a b c d")}


def test_lines(docs, none):
    rows = linededup.line_dedup(docs).collect()
    got = {(r.doc_id, r.text): (r.n_lines, r.n_dropped) for r in rows}
    assert len(rows) == len(TEXTS) and got[1, "a b c d"] == (1, 0) and got[8, ""] == (1, 1) and got[3, None] == (0, 0) and got[5, "  \n \n"] == (3, 0)
    assert linededup.line_dedup(none).count() == 0


def test_ids_of_any_type(spark):
    """Ids are text, one of them the word null."""
    line = "a long line that two documents share, but for one letter"
    rows = [("b", f"{line}x\none"), ("a", f"{line}\ntwo"), ("null", "one\n1\n2"), (None, "one\n3")]
    docs = spark.createDataFrame(rows, "doc_id string, text string")
    got = {r.doc_id: r.text for r in linededup.line_dedup(docs).collect()}
    # short lines that differ stay, equal ones go; the null id comes first
    assert got == {None: "one\n3", "a": f"{line}\ntwo", "b": "", "null": "1\n2"}
    assert {r.doc_id for r in media.media_columns(docs).collect()} == {"a", "b", "null", None}
    assert {r.doc_id for r in simhash.keep_one(docs.union(docs)).collect()} == {"a", "b", "null", None}
    assert shards.shard(docs).count() == 4


def test_a_cluster_needs_a_shared_folder():
    class Cluster:
        class conf:  # noqa: N801
            get = staticmethod(lambda key, default=None: default)

        class sparkContext:  # noqa: N801
            master = "local-cluster[3,2,1024]"

    with pytest.raises(RuntimeError, match="share"):
        shared_dir(Cluster)


def test_licenses(docs, none):
    rows = licenses.license_scan(docs).collect()
    assert len(rows) == len(TEXTS) and all(r.licenses == [] for r in rows) and licenses.license_scan(none).count() == 0


def test_bpe(docs, none):
    rows = bpe.digests(docs).collect()
    empty = hashlib.sha256(b"").hexdigest()
    assert len(rows) == len(TEXTS) and all((r.n_tokens, r.ids_sha256, r.decoded_sha256) == (0, empty, empty) for r in rows if r.doc_id in (3, 4, 5))
    assert bpe.digests(none).count() == 0


def test_media(docs, none):
    rows = media.media_columns(docs).collect()
    assert len(rows) == len(TEXTS) and media.media_columns(none).count() == 0
    assert {(r.n_bytes, r.payload_bytes, r.payload_sha256) for r in rows if r.doc_id in (3, 4)} == {(0, 64, hashlib.sha256(bytes(64)).hexdigest())}
    assert sum(r.doc_id is None for r in rows) == 2


def test_urls(spark):
    captures = spark.createDataFrame([(1, "https://a.b.c/x/y"), (1, "https://a.b.c/x/y"), (2, None), (3, "nothing"), (None, "http://u:p@B.C:80/")], "id long, url string").withColumn("fetched", F.lit("2024-02-10").cast("date"))
    log = [("b.c", "add", "2024-01-01"), ("b.c", "remove", "2024-02-10"), ("b.c", "add", "2024-02-10"), ("a.b.c/x", "add", "2023-01-01"), ("c", "add", "2024-02-11"), (None, "add", "2024-01-01"), ("a.b.c", None, "2024-01-01")]
    entries = spark.createDataFrame(log, "pattern string, action string, since string").withColumn("since", F.col("since").cast("date"))
    rows = urlfilter.filter_urls(captures, entries).collect()
    assert sorted((r.id or 0, r.listed, r.n_entries, r.entry or "") for r in rows) == [(0, False, 0, ""), (1, True, 1, "a.b.c/x"), (1, True, 1, "a.b.c/x"), (2, False, 0, ""), (3, False, 0, "")]
    assert urlfilter.filter_urls(captures.limit(0), entries).count() == 0 and urlfilter.filter_urls(captures, entries.limit(0)).where("listed").count() == 0


def test_urls_by_hand(spark, monkeypatch):
    """Captures with hot hosts and suffixes, long paths and clashing columns against a plain loop over the list."""
    rng = random.Random(6)
    day = lambda n: date(2024, 1, 1) + timedelta(n)
    hosts = ["a.com", "B.a.com", "c.b.a.com", "hot.org", "hot.org", "hot.org", "x.co.uk"]
    paths = ["", "/", "/en", "/EN", "/en/x?q=/fr", "/en//x/", "/" + "y/" * 3000]
    rows = [(i, f"http{'s' * (i % 2)}://{rng.choice(hosts)}{rng.choice(paths)}", day(rng.randrange(120)), "k", 1) for i in range(300)]
    log = [(rng.choice(["a.com", "com", "b.a.com", "hot.org", "hot.org/en", "hot.org/en/x", "a.com/EN", "org", "nowhere.net"]), rng.choice(["add", "add", "remove"]), day(rng.randrange(-40, 130))) for _ in range(60)]
    want = {}
    for i, url, fetched, *_ in rows:
        host, _, path = url.split("://")[1].partition("/")
        host, parts = host.lower(), [x for x in path.split("?")[0].split("/") if x]
        keys = {".".join(host.split(".")[k:]) for k in range(host.count(".") + 1)} | {"/".join([host, *parts[: k + 1]]) for k in range(len(parts))}
        hits = []
        for pattern in keys:
            before = sorted((since, action) for p, action, since in log if p == pattern and since <= fetched)
            if before and before[-1][1] == "add":
                hits.append(pattern)
        want[i] = (len(hits), min(hits, key=lambda p: (-len(p), p)) if hits else None)
    captures = spark.createDataFrame(rows, "id long, url string, fetched date, pattern string, row int")
    entries = spark.createDataFrame(log, "pattern string, action string, since date")
    for share in (urlfilter.HOT_SHARE, 0.05, 1.0):
        monkeypatch.setattr(urlfilter, "HOT_SHARE", share)
        assert {r.id: (r.n_entries, r.entry) for r in urlfilter.filter_urls(captures, entries).collect()} == want


def test_a_template_of_many_items(spark):
    """Windows that items share are met once by each document; all items are listed."""
    template = "w1 w2 w3 w4 w5 w6 w7 w8 w9 w10 w11 w12 w13 w14"
    bench = spark.range(400).selectExpr("id as item_id", f"concat('{template} ', 'x', id, ' y z')  as text")
    docs = spark.range(60).selectExpr("id as doc_id", f"concat('a b ', '{template}', case when id = 7 then ' x7 y z' else ' c' end) as text")
    for limit in (winnow.BROADCAST_BYTES, 0):
        rows = winnow.decontaminate(docs, bench, broadcast_bytes=limit).collect()
        assert len(rows) == 60 and {(r.n_words, r.n_hit) for r in rows if r.doc_id != 7} == {(17, 14)}
        assert all(r["items"] == sorted(map(str, range(400))) for r in rows) and [r.n_hit for r in rows if r.doc_id == 7] == [17]


def test_decontamination(docs, none, bench):
    for limit in (winnow.BROADCAST_BYTES, 0):
        rows = winnow.decontaminate(docs, bench, broadcast_bytes=limit).collect()
        got = {(r.doc_id, r.n_words, r.n_hit, tuple(r["items"])) for r in rows}
        assert len(rows) == len(TEXTS) and {(1, 4, 2, ("3",)), (8, 4, 2, ("3",)), (3, 0, 0, ()), (6, 30_000, 0, ())} <= got
    assert winnow.decontaminate(none, bench).count() == 0 and winnow.decontaminate(docs, bench.limit(0)).where("n_hit > 0").count() == 0
    assert sorted((r.doc_id or 0) for r in winnow.keep_uncontaminated(docs, bench).collect()) == [0, 0, 3, 4, 5, 6, 7]


def test_stage_columns(docs):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "simhash_near_dedup", "benchmark_decontamination", "bpe"]
    out = corpus_pipeline.dedup_lines(None, docs, "")
    assert out.columns == docs.columns and {r.n_chars for r in out.where("doc_id = 8").collect()} == {0}


def test_clashing_names_of_the_other_tables(spark, docs, labels, bench):
    """Benchmark and labels may hold any other columns, named as the documents' or the operators' own."""
    odd = {c: F.lit("x") for c in ("text_hash", "n", "h", "g", "key", "set", "a", "b", "row", "item", "doc_id", "lang")}
    got = {(r.doc_id, r.n_hit, tuple(r["items"])) for r in winnow.decontaminate(docs, bench.withColumns(odd)).collect()}
    assert got == {(r.doc_id, r.n_hit, tuple(r["items"])) for r in winnow.decontaminate(docs, bench).collect()}
    more = labels.withColumns({c: F.lit("x") for c in ("text", "label", "terms", "row", "score", "lang", "n_chars")})
    for run in (toxicity.toxicity, quality.quality):
        assert sorted(map(str, run(docs, more).collect())) == sorted(map(str, run(docs, labels).collect()))
