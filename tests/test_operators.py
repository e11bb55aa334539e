import random

import pytest
from pyspark.sql import functions as F

from gleaner.operators import dedup, relational as rel


def test_three_tier_counter_example(spark):
    rows = [("d", 1, "r1", "u1", ""), ("d", 2, "r1", "u2", ""), ("d", 3, "r2", "u2", ""), ("e", 1, "A", "x", "c"), ("e", 2, "", "y", "c"), ("e", 3, "", "z", "q"), ("", 9, "r1", "u1", "")]
    df = spark.createDataFrame(rows, "domain string, seq long, ref string, url_key string, content string")
    assert sorted(map(tuple, dedup.three_tier(df).collect())) == [("", 9), ("d", 1), ("d", 3), ("e", 1), ("e", 3)]


def test_error_log_keeps_changes(spark):
    df = spark.createDataFrame([("A ", 1, "f", "x"), ("a", 2, "f", "y"), ("a", 3, "f", "x"), ("a", 4, "f", "x"), (" ", 5, "f", "x")], "domain string, seq long, status string, reason string")
    assert [r.seq for r in rel.error_log(df).orderBy("seq").collect()] == [1, 2, 3]


def test_block_breaker(spark):
    status = [403, None, 403, 200, 429, 403, 404, 401, 200, 200]
    df = spark.createDataFrame([("h", i, s) for i, s in enumerate(status)], "host string, seq long, status int")
    assert [r.seen_status for r in rel.block_breaker(df).orderBy("seq").collect()] == [403, None, 403, 200, 429, 403, 404, 401, 403, 403]


def test_jobs(spark):
    names = "seq long, company_name string, contact_person_last_name string, phone_1 string, postalcode string, city string, website string"
    rows = [(0, "A", None, "null", "1", "x", "a.example.com"), (1, "Longer", "N", "33111", "1", "y", "www.a.example.com"), (2, "B", "", "", "", "", "nan"), (3, None, "", "", "", "", None)]
    df = spark.createDataFrame(rows, names)
    job = rel.load_jobs(df).first()
    assert (job.domain, job.rows_merged, job.phone, job.city, job.agency_name) == ("example.com", 2, "33111", "x", "Longer")
    assert sorted(r[0] for r in rel.no_website(df).collect()) == ["B", "Unknown Agency"]


def test_hub_budget(spark):
    seeds = spark.createDataFrame([("d", f"h{i}", "hub", i) for i in range(4)], "domain string, url string, kind string, seq long")
    edges = spark.createDataFrame([("d", f"h{i}", f"p{i}", "detail", 0) for i in range(4)], "domain string, src string, dst string, kind string, pos int")
    assert sorted(r.url for r in rel.expand_hubs(seeds, edges, 2, 3).collect()) == ["p0", "p1", "p2"]


def test_partitions_do_not_matter(spark):
    rows = spark.range(500).select((F.col("id") % 7).cast("string").alias("domain"), F.col("id").alias("seq"), (F.col("id") % 11).cast("string").alias("ref"), (F.col("id") % 13).cast("string").alias("url_key"), F.lit("").alias("content"))
    assert sorted(map(tuple, dedup.three_tier(rows.repartition(1)).collect())) == sorted(map(tuple, dedup.three_tier(rows.repartition(8, "seq")).collect()))


def test_loader(spark, tmp_path):
    from gleaner.sources import LoaderError, read_agencies, read_completed, read_geocode_cache

    (tmp_path / "bad.csv").write_text("foo,bar\n1,2\n")
    with pytest.raises(LoaderError):
        read_agencies(spark, str(tmp_path / "bad.csv"))
    with pytest.raises(LoaderError):
        read_agencies(spark, str(tmp_path / "none.csv"))
    (tmp_path / "ok.csv").write_text("company_name,contact_person_last_name,siren,siret,phone_1,postalcode,street,city,website\nA,B,1,2,033,06300,s,Nice,a.fr\n", encoding="utf-8-sig")
    assert read_agencies(spark, str(tmp_path / "ok.csv")).first().postalcode == "06300"
    (tmp_path / "cache.json").write_text('{"Nice": "1.0, 2.0", "x": ""}')
    assert {tuple(r) for r in read_geocode_cache(spark, str(tmp_path / "cache.json")).collect()} == {("nice", "1.0, 2.0"), ("x", "")}
    (tmp_path / "done.json").write_text("{broken")
    assert read_completed(spark, str(tmp_path / "done.json")).count() == 0


def test_large_domains_go_by_rounds(spark):
    """A domain beyond the fold's bound gives what the fold gives; keys that many rows share are no matter."""
    rows = spark.range(30_000).select(
        F.when(F.col("id") % 3 > 0, "hot").otherwise((F.col("id") % 50).cast("string")).alias("domain"),
        F.col("id").alias("seq"),
        F.when(F.col("id") % 4 == 0, "").otherwise(F.concat(F.lit("R"), (F.xxhash64("id") % 5000).cast("string"))).alias("ref"),
        F.when(F.col("id") % 7 == 0, None).otherwise((F.xxhash64("id", F.lit(1)) % 6000).cast("string")).alias("url_key"),
        F.when(F.col("id") % 5 == 0, "same").otherwise((F.xxhash64("id", F.lit(2)) % 900).cast("string")).alias("content"),
    )
    want = sorted(map(tuple, dedup.three_tier(rows, fold_rows=10**9).collect()))
    assert 3000 < len(want) < 29_000
    assert sorted(map(tuple, dedup.three_tier(rows, fold_rows=5000).collect())) == want
    assert sorted(map(tuple, dedup.three_tier(rows, fold_rows=0, rounds=3).collect())) == want


def test_registrable_domains(spark):
    names = "seq long, company_name string, contact_person_last_name string, phone_1 string, postalcode string, city string, website string"
    df = spark.createDataFrame([(0, "A", "", "", "", "", "https://www.one.co.uk/x"), (1, "B", "", "", "", "", "two.co.uk"), (2, "C", "", "", "", "", "b.two.co.uk")], names)
    assert {(r.domain, r.rows_merged) for r in rel.load_jobs(df).collect()} == {("one.co.uk", 1), ("two.co.uk", 2)}


def test_hubs_four_deep(spark):
    seeds = spark.createDataFrame([("d", "h0", "hub", 1)], "domain string, url string, kind string, seq long")
    edges = [("d", f"h{i}", f"h{i + 1}", "hub", 200_000) for i in range(6)] + [("d", f"h{i}", f"p{i}", "detail", 150_000 + i) for i in range(7)]
    found = rel.expand_hubs(seeds, spark.createDataFrame(edges, "domain string, src string, dst string, kind string, pos int"), 4, 10).collect()
    assert {(r.url, r.depth) for r in found} == {("p0", 2), ("p1", 3), ("p2", 4), ("p3", 5)}


def test_files_in_order_and_storage_errors(spark, tmp_path):
    from gleaner.sources import mark_completed, read_agencies, read_completed, read_geocode_cache, write_geocode_cache

    head = "company_name,contact_person_last_name,siren,siret,phone_1,postalcode,street,city,website\n"
    for k, n in ((2, 400), (1, 3)):
        (tmp_path / f"in{k}.csv").write_text(head + "".join(f"{k}-{i:03d},,,,,,,,\n" for i in range(n)))
    rows = read_agencies(spark, str(tmp_path / "in*.csv")).orderBy("seq").collect()
    assert [r.company_name for r in rows] == [f"1-{i:03d}" for i in range(3)] + [f"2-{i:03d}" for i in range(400)]
    (tmp_path / "done").mkdir()
    (tmp_path / "done" / "part-0.parquet").write_bytes(b"damaged")
    with pytest.raises(Exception, match="(?i)parquet"):
        read_completed(spark, str(tmp_path / "done")).collect()
    assert read_completed(spark, str(tmp_path / "nothing")).count() == 0
    mark_completed(spark.createDataFrame([("b",), (" A",), ("b",), ("",)], "domain string"), str(tmp_path / "marks"))
    assert [r.domain for r in spark.read.parquet(str(tmp_path / "marks")).collect()] == ["a", "b"]
    cache = str(tmp_path / "cache")
    for value in ("", "1.0, 2.0"):
        write_geocode_cache(spark.createDataFrame([("Nice", value), ("x", None)], "key string, value string"), cache)
        assert {tuple(r) for r in read_geocode_cache(spark, cache).collect()} == {("nice", value), ("x", "")}


def plain_search(seeds, edges, depth, budget):
    """A queue for each domain: hubs are opened first come first served."""
    found = {}
    for domain in {s[0] for s in seeds}:
        queue, seen, spent = [], set(), 0
        for _, url, kind, _ in sorted((s for s in seeds if s[0] == domain), key=lambda s: (s[3], s[2])):
            if url not in seen:
                seen.add(url)
                queue.append((url, kind, 1))
        while queue:
            url, kind, at = queue.pop(0)
            if kind == "detail":
                found[domain, url] = at
            elif at <= depth and spent < budget:
                spent += 1
                for _, _, dst, kind2, _ in sorted((e for e in edges if e[0] == domain and e[1] == url), key=lambda e: (e[4], e[3])):
                    if kind2 != "reject" and dst not in seen:
                        seen.add(dst)
                        queue.append((dst, kind2, at + 1))
    return found


@pytest.mark.parametrize(("depth", "budget", "partitions"), [(1, 3, 4), (2, 6, 4), (4, 100, 4), (4, 5, 200), (6, 0, 4)])
def test_hub_search_by_hand(spark, depth, budget, partitions):
    rng = random.Random(depth * 100 + budget)
    names = [f"h{i}" for i in range(12)] + [f"p{i}" for i in range(30)]
    kind = lambda n: "hub" if n[0] == "h" else "detail" if rng.random() < 0.9 else "reject"
    seeds = [(d, n, "hub" if n[0] == "h" else "detail", i) for d in ("a", "b", "c") for i, n in enumerate(rng.sample(names, 4))]
    edges = [(d, f"h{h}", n, kind(n), i) for d in ("a", "b", "c") for h in range(12) for i, n in enumerate(rng.sample(names, 5))]
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        s = spark.createDataFrame(seeds, "domain string, url string, kind string, seq long")
        e = spark.createDataFrame(edges, "domain string, src string, dst string, kind string, pos int")
        rows = rel.expand_hubs(s, e, depth, budget).collect()
        assert {(r.domain, r.url): r.depth for r in rows} == plain_search(seeds, edges, depth, budget) and len({(r.domain, r.url) for r in rows}) == len(rows)
        assert rel.expand_hubs(s.limit(0), e, depth, budget).count() == 0
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 4)


def test_plans_do_not_grow_with_depth(spark):
    """The rounds are written, so what the search returns is one scan."""
    seeds = spark.createDataFrame([("d", "h0", "hub", 1)], "domain string, url string, kind string, seq long")
    edges = spark.createDataFrame([("d", f"h{i}", f"h{i + 1}", "hub", 0) for i in range(9)] + [("d", "h8", "p", "detail", 1)], "domain string, src string, dst string, kind string, pos int")
    found = rel.expand_hubs(seeds, edges, 9, 20)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Exchange" not in plan and [(r.url, r.depth) for r in found.collect()] == [("p", 10)]


def test_sitemaps_as_they_are_written(spark):
    """Character references, CDATA, attributes, other cases of letters and comments in sitemaps; an index that names itself."""
    from gleaner.operators import discovery

    bodies = [
        ("d", "root", "<SitemapIndex><LOC>root</LOC><loc>maps&#47;a</loc><loc> <![CDATA[b&amp;]]> </loc><!-- <loc>not</loc> --></SitemapIndex>"),
        ("d", "maps/a", "<urlset><loc >x&#38;y&apos;</loc><loc></loc><loc>\n z&eacute; </loc></urlset>"),
        ("d", "b&amp;", "<urlset><loc>w</loc><loc>x&amp;y'</loc></urlset>"),
        ("d", "not", "<urlset><loc>never</loc></urlset>"),
    ]
    maps = spark.createDataFrame(bodies, "domain string, url string, body string")
    rows = discovery.walk_sitemaps(spark.createDataFrame([("d", "root", 1)], "domain string, url string, seq long"), maps, 2).orderBy("order").collect()
    assert [(r.url, r.order.level) for r in rows] == [("x&y'", 1), ("zé", 1), ("w", 1)]
    assert discovery.walk_sitemaps(spark.createDataFrame([], "domain string, url string, seq long"), maps, 2).count() == 0


def test_agencies_in_splits(spark, tmp_path):
    """Files without line ends in fields are read in splits, numbered as they stand; those with them whole."""
    from gleaner.sources import read_agencies, spans_lines

    head = "company_name,contact_person_last_name,siren,siret,phone_1,postalcode,street,city,website\n"
    for k in (1, 2):
        (tmp_path / f"plain{k}.csv").write_text(head + "".join(f'"{k}, ""{i:04d}""",,,,,,,,\n' for i in range(1500)))
    (tmp_path / "lines.csv").write_text(head + '"a\nb",x,,,,,,,\nc,,,,,,,,\n')
    assert not spans_lines(spark, str(tmp_path / "plain*.csv")) and spans_lines(spark, str(tmp_path / "lines.csv"))
    assert [r.company_name for r in read_agencies(spark, str(tmp_path / "lines.csv")).orderBy("seq").collect()] == ["a\nb", "c"]
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        rows = read_agencies(spark, str(tmp_path / "plain*.csv"))
        assert rows.rdd.getNumPartitions() > 8
        assert [r.company_name for r in rows.orderBy("seq").collect()] == [f'{k}, "{i:04d}"' for k in (1, 2) for i in range(1500)]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
