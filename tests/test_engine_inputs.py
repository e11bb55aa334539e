"""Fetched bodies, replaced folders, geocoder's answers, logs, settings, faults and the report's ties."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from gleaner.config import EngineConfig
from gleaner.engine import Engine
from gleaner.operators import extract, relational as rel
from gleaner.plans.report import report_head
from gleaner.sources import fetches, read_geocode_cache, replace_folder, settle, write_geocode_cache


def test_bodies_as_python_decodes_them(spark):
    """Random bytes, most of them broken, in charsets of one and of several bytes a character, known and unknown."""
    import codecs

    rng = random.Random(1)
    names = ["", "utf-8", "UTF8", "latin-1", "ISO-8859-1", "windows-1252", "iso-8859-15", "us-ascii", "koi8-r", "bogus", "utf-16", "gb18030", "shift_jis", "hex", "cp1253"]
    some = [65, 0xC3, 0xA9, 0xE2, 0x82, 0xAC, 0x80, 0xFF, 0xF0, 0x9F, 0x98, 0xED, 0xA0, 0x0A, 0, 0x27, 0x5C]
    rows = [(i, 200, f'text/html; Charset="{n}"' if (n := rng.choice(names)) else "text/html", bytes(rng.choice(some) for _ in range(rng.randint(0, 40)))) for i in range(500)]
    rows += [(500, 301, None, b"\xe9"), (501, 404, "text/html", b"x"), (502, None, None, b"x"), (503, 200, "text/html", None), (504, 200, "text/html; charset=utf-16", None)]
    want = {}
    for i, status, kind, body in rows:
        name = (kind or "").partition("=")[2].strip('"') or "utf-8"
        try:
            codecs.lookup(name)
        except LookupError:
            name = "utf-8"
        try:
            want[i] = body.decode(name, "replace") if body and status and status < 400 else ""
        except LookupError:
            want[i] = ""
    df = spark.createDataFrame(rows, "id long, status int, content_type string, body binary")
    got = fetches.decode_fetches(df)
    assert got.columns == ["id", "status", "content_type", "html"] and {r.id: r.html for r in got.collect()} == want
    # without a charset of several bytes no Python runs
    plan = fetches.decode_fetches(df.where("id >= 500 and id < 504"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan


def test_bodies_are_cut_by_chunks(spark):
    df = spark.createDataFrame([(200, "text/html", ("é" * 40).encode()), (200, "text/html; charset=latin-1", b"\xe9" * 9)], "status int, content_type string, body binary")
    # 21 bytes: the third chunk of seven takes it beyond 20, and cuts a character
    assert [r.html for r in fetches.decode_fetches(df, 20, 7).collect()] == ["é" * 10 + "�", "é" * 9]


@pytest.mark.parametrize("crash", ["write", "after write", "between", "before delete", "no crash"])
def test_a_crash_leaves_whole_data(spark, tmp_path, crash):
    """Whatever step a replacement is killed at, the next reader finds the old or the new data whole."""
    path = str(tmp_path / "cache")
    old, new = spark.createDataFrame([("a", "1"), ("b", "2")], "key string, value string"), spark.createDataFrame([("a", "3")], "key string, value string")
    write_geocode_cache(old, path)
    if crash == "write":
        with pytest.raises(ZeroDivisionError):
            replace_folder(spark, lambda to: ((tmp_path / "cache.new").mkdir(), 1 / 0), path)
    elif crash == "no crash":
        write_geocode_cache(new, path)
    else:  # the steps by hand, up to the one that is never reached
        write_geocode_cache(new, str(tmp_path / "other"))
        (tmp_path / "other").rename(tmp_path / "cache.new")
        if crash != "after write":
            (tmp_path / "cache").rename(tmp_path / "cache.old")
        if crash == "before delete":
            (tmp_path / "cache.new").rename(tmp_path / "cache")
    rows = {tuple(r) for r in read_geocode_cache(spark, path).collect()}
    assert rows == ({("a", "1"), ("b", "2")} if crash in ("write", "after write") else {("a", "3")})
    # and the next replacement goes through
    write_geocode_cache(old, path)
    assert {tuple(r) for r in read_geocode_cache(spark, path).collect()} == {("a", "1"), ("b", "2")}
    assert not (tmp_path / "cache.new").exists() and not (tmp_path / "cache.old").exists()


def test_only_the_old_one_is_left(spark, tmp_path):
    (tmp_path / "x.old").mkdir()
    (tmp_path / "x.old" / "part-0.txt").write_text('{"n":"1"}\n')
    (tmp_path / "x.new").mkdir()  # not written whole: it has no mark
    assert read_geocode_cache(spark, str(tmp_path / "x")).count() == 1
    settle(spark, str(tmp_path / "nothing"))
    assert not (tmp_path / "nothing").exists()


def test_answers_go_to_the_cache_and_the_listings(spark, tmp_path):
    engine, folder, cache = Engine(spark), str(tmp_path / "out"), str(tmp_path / "cache.json")
    (tmp_path / "cache.json").write_text('{"Nice": "1.0, 2.0", "pau": ""}')
    names = engine.run.__globals__["v"].LISTING_FIELDS
    place = ["Nice", "Pau", "Lyon", "Gap", "", "Dax"]
    rows = spark.createDataFrame([(i, p) for i, p in enumerate(place)], "i long, p string")
    listings = rows.select(*[F.col("p").alias(c) if c == "location" else F.when(F.col("p") == "Dax", "9.0, 9.0").otherwise("").alias(c) if c == "coordinates" else F.col("i").cast("string").alias(c) for c in names])
    engine._save(listings.orderBy("reference_id"), f"{folder}/{engine.config.listings_name}", "overwrite")
    assert {r.key for r in engine.missing(folder, read_geocode_cache(spark, cache)).collect()} == {"lyon", "gap"}
    engine.geocoded(folder, cache, spark.createDataFrame([("LYON", "3.0, 4.0"), ("gap", ""), ("pau", "5.0, 6.0"), ("nice", "")], "key string, value string"))
    assert {tuple(r) for r in read_geocode_cache(spark, cache).collect()} == {("nice", "1.0, 2.0"), ("pau", "5.0, 6.0"), ("lyon", "3.0, 4.0"), ("gap", "")}
    got = [(r.location, r.coordinates) for r in engine._read(folder, engine.config.listings_name, names).orderBy("place").collect()]
    assert got == [("Nice", "1.0, 2.0"), ("Pau", "5.0, 6.0"), ("Lyon", "3.0, 4.0"), ("Gap", ""), ("", ""), ("Dax", "9.0, 9.0")]


def test_logs_by_hand(spark):
    """Folded event by event; ties at a moment, events after an interruption, and domains in different spellings."""
    rng, began = random.Random(8), datetime(2024, 1, 1)
    kinds = ["start", "fingerprint", "static", "fetch", "fetch", "timeout", "crash", "end", None]
    rows = [(f" D{rng.randrange(40)}", began + timedelta(milliseconds=rng.randrange(0, 140_000, 250)), rng.choice(kinds), rng.choice(["A", None]), "m") for _ in range(300)] + [("", began, "crash", "", ""), ("late", None, "crash", "", "")]
    want = {}
    for d in {r[0].strip().lower() for r in rows if r[0].strip() and r[1]}:
        own = [r for r in rows if r[0].strip().lower() == d]
        first = min(r[1] for r in own)
        after = lambda r: (r[1] - first).total_seconds()  # noqa: E731, B023
        stops = sorted((after(r), r[2] == "crash", r[2] if r[2] in ("timeout", "crash") else "timeout", r[3] or "") for r in own if r[2] in ("timeout", "crash") or after(r) > 120)
        end = stops[0][0] if stops else max(map(after, own))
        looked, read = (min([after(r) for r in own if r[2] == k], default=None) for k in ("fingerprint", "static"))
        want[d] = (f"{end:.2f}", stops[0][2] if stops else None, looked is not None and looked <= end, 120 - read if read is not None and read <= end else None, stops[0][3] if stops else "")
    got = rel.domain_runs(spark.createDataFrame(rows, "domain string, at timestamp, event string, name string, message string"), 120.0).collect()
    assert {r.domain: (r.duration_seconds, r.interrupted, r.fingerprinted, r.left_seconds, r.name) for r in got} == want


def test_settings_from_the_environment():
    given = {"GLEANER_MAX_LISTING_URLS": "7", "GLEANER_GEOCODING": "no", "GLEANER_KEEP_OUTPUTS": "True", "GLEANER_LIMIT": "3", "GLEANER_DOMAIN_TIME_BUDGET": "60.5", "GLEANER_REPORT_NAME": "r", "OTHER": "x"}
    got = EngineConfig.from_environment(environment=given)
    assert (got.max_listing_urls, got.geocoding, got.keep_outputs, got.limit, got.domain_time_budget, got.report_name) == (7, False, True, 3, 60.5, "r")
    assert EngineConfig.from_environment(environment={"GLEANER_LIMIT": ""}) == EngineConfig()
    with pytest.raises(ValueError):
        EngineConfig.from_environment(environment={"GLEANER_MAX_HUB_PAGES": "many"})


def test_faults_are_told(spark):
    def broken(page):
        raise KeyError(page.url)

    rows = extract.extract_fields(spark.createDataFrame([("https://a.fr/x", "<p>Prix : 170 000 €</p>")], "url string, html string"), {"rooms": broken, "extra": broken}).collect()
    assert (rows[0].price, rows[0].rooms, rows[0].extra, sorted(rows[0].faults)) == ("170000", "", "", ["extra", "rooms"])


def test_ties_go_by_first_appearance(spark):
    summary = spark.createDataFrame([(0, "z", "failed", "b"), (1, "y", "failed", "a"), (2, "x", "failed", "a"), (3, "w", "failed", "b"), (4, "v", "success", " ")], "place long, domain string, status string, reason string")
    listings = spark.createDataFrame([(0, "two"), (1, "one"), (2, "One "), (3, "two"), (4, "a")], "place long, source_domain string")
    head = report_head(listings, summary, summary.limit(0))
    assert head.index("| two | 2 |") < head.index("| one | 2 |") < head.index("| a | 1 |") and head.index("| b | 2 |") < head.index("| a | 2 |")
    plain = report_head(listings.drop("place"), summary.drop("place"), summary.limit(0))
    assert plain.index("| one | 2 |") < plain.index("| two | 2 |") and plain.index("| a | 2 |") < plain.index("| b | 2 |")
