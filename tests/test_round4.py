"""Faults that the fourth round's findings name."""

import random

import pyarrow as pa
import pytest

from gleaner.functions.dialect import apply
from gleaner.operators import dedup, extract
from gleaner.plans import pages, queries as plans  # noqa: F401  (pages registers its queries)


def test_addresses_are_found_anywhere_in_a_page():
    """neither spelled-out nor plain addresses are sought in the beginning of a page alone."""
    filler = "<p>lorem ipsum [sic] </p>" * 40_000
    for body, want in (("<p>jean [at] agency [dot] fr</p>", "jean@agency.fr"), ("<p>contact: real@agency.fr</p>", "real@agency.fr"), ("<!-- jean (at) agency (dot) fr -->", "jean@agency.fr"), ("", "")):
        assert extract.resolve(extract.Page("https://a.fr/x", f"<html><body>{filler}{body}</body></html>"), fields=["email"]) == {"email": want, "faults": []}


SF = "/root/testdata/sf0.001"


def test_kept_listings_are_neither_written_nor_shuffled_again(spark, monkeypatch):
    """the window's partitions hold whole domains in order; the written copies of all listings were most of the disk."""
    want = {(r.domain, r.seq) for r in dedup.three_tier(plans.listings(spark, SF)).collect()}
    monkeypatch.setattr(dedup.Shared, "table", lambda *_: (_ for _ in ()).throw(AssertionError("written")))
    found = plans.accepted(spark, SF, "domain", "seq", "price", "email", "source_url")
    assert "RepartitionByExpression" not in found._jdf.queryExecution().optimizedPlan().toString()
    rows = found.collect()
    assert {(r.domain, r.seq) for r in rows} == want and len(rows) == len(want)
    whole = {(r.domain, r.seq): (r.price, r.email, r.source_url) for r in plans.listings(spark, SF).collect()}
    assert all((r.price, r.email, r.source_url) == whole[r.domain, r.seq] for r in rows)


def test_contents_are_resolved_where_keys_leave_rows_open():
    """leaving out rows that surely repeat a key never changes what the ordered dedup accepts."""
    rng, left = random.Random(5), 0
    for n in range(400):
        rows = [("d" + str(k // 12), k, rng.choice(["", "", "a", "b", "c", "d"]), rng.choice(["", "u", "v", "w", "x"]), rng.choice(["", "p", "q", "r"])) for k in range(24)]
        batch = pa.RecordBatch.from_pylist([dict(zip(("domain", "seq", "dedup_ref", "url_key", "content"), r, strict=True)) for r in rows])
        parts = [batch.slice(0, 7), batch.slice(7)]
        want = [x for b in dedup._fold(iter(parts)) for x in b.to_pylist()]
        possible = list(dedup._possible(iter(parts)))
        got = [{"domain": x["domain"], "seq": x["seq"]} for b in dedup._chosen(iter(possible)) for x in b.to_pylist()]
        assert got == want
        left += sum(b.num_rows for b in possible) < 24
    assert left > 300
    with pytest.raises(ValueError, match="not in order"):
        list(dedup._chosen(iter([batch.take(pa.array([3, 1]))])))


def test_steps_share_projections_with_those_as_far_from_the_given_columns(spark):
    """two chains of steps take as many projections as the longer one; a step that replaces a column waits for those before it."""
    df = spark.createDataFrame([(1,)], "x int")
    steps = [("a", "x + 1"), ("b", "a * 2"), ("c", "x + 10"), ("d", "c * 2"), ("x", "x + 100"), ("e", "x + b + d")]
    assert apply(df, steps).first().asDict() == {"x": 101, "a": 2, "b": 4, "c": 11, "d": 22, "e": 127}
    plan = apply(df, steps[:4])._jdf.queryExecution().analyzed().toString()
    assert plan.count("Project [") == 2
