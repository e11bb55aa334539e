"""Faults that the third round's findings name."""

import random
import re

from gleaner import vocabulary as v
from gleaner.functions.dialect import any_of
from gleaner.operators import extract, relational as rel
from gleaner.plans import pages, queries


def test_durations_round_halves_up(spark):
    rows = spark.sql("select 'a' as domain, timestamp '2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, s) as at, 'end' as event, '' as name, '' as message from values (cast(0 as decimal(18,6))), (126093.205) t(s)")
    assert rel.domain_runs(rows, 1e9).first().duration_seconds == "126093.21"


def _with_pages(spark, tmp_path, name, html):
    """The query's values where every supplied page is this one."""
    spark.range(28).selectExpr("id as page_id", "'https://a.example/' as url").crossJoin(spark.createDataFrame([(html,)], "html string")).write.parquet(str(tmp_path / "pages.parquet"))
    return {r.page_id: r[name.removeprefix("extract_")] for r in pages.QUERIES[name](spark, str(tmp_path)).collect()}


def _expected(name):
    cases = pages.CASES[name.removeprefix("extract_")]
    return {k: cases[k % len(cases)][-1] for k in range(28)}


def test_addresses_of_supplied_pages_are_not_the_cases(spark, tmp_path):
    html = "<!DOCTYPE html><html><head><title>Erea emgbr.22@mail7.example.</title></head><body><h1>Erea emgbr.22@mail7.example.</h1></body></html>"
    assert _with_pages(spark, tmp_path, "extract_email", html) == _expected("extract_email")


def test_places_of_supplied_titles_are_not_the_cases(spark, tmp_path):
    html = "<!DOCTYPE html><html><head><title>Eanre au Ouele</title></head><body><h1>Eanre au Ouele</h1></body></html>"
    assert _with_pages(spark, tmp_path, "extract_location", html) == _expected("extract_location")


def test_types_of_supplied_titles_are_not_the_cases(spark, tmp_path):
    html = "<!DOCTYPE html><html><head><title>In fermement</title></head><body><h1>In fermement</h1></body></html>"
    assert _with_pages(spark, tmp_path, "extract_property_type", html) == _expected("extract_property_type")


def test_only_named_fields_are_resolved(spark):
    def broken(page):
        raise AssertionError("not asked for")

    rows = spark.createDataFrame([("https://a.fr/x", "<p>Prix : 170 000 €</p>")], "url string, html string")
    got = extract.extract_fields(rows, {"rooms": broken}, ["price"]).collect()
    assert [r.asDict() for r in got] == [{"url": "https://a.fr/x", "html": "<p>Prix : 170 000 €</p>", "price": "170000", "faults": []}]


def test_synthetic_listings_are_not_written_for_one_read(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(queries.Shared, "table", lambda *_: (_ for _ in ()).throw(AssertionError("written")))
    assert queries.QUERIES["price_labels"](spark, "/root/testdata/sf0.001").columns == ["domain", "seq", "labels"]


def test_words_with_shared_beginnings_match_as_each_alone():
    for words in (v.JUNK_TOKENS, v.NON_LISTING_TERMS):
        fast, plain = re.compile(any_of(words)), re.compile("|".join(map(re.escape, words)))
        rng = random.Random(1)
        for _ in range(2000):
            s = "".join(rng.choice([rng.choice(words)[: rng.randrange(1, 12)], "-", "x", "e"]) for _ in range(4))
            assert bool(fast.search(s)) == bool(plain.search(s))
