"""Queries of round 3 whose cost grew too fast: what they leave undone, and that results stay."""

from itertools import product

from pyspark.sql import functions as F

from gleaner import vocabulary as v
from gleaner.functions.dialect import SPARK, apply
from gleaner.html import Node, parse
from gleaner.operators import classify as cl, dedup
from gleaner.plans import pages, queries as plans  # noqa: F401  (pages registers its queries)

SF = "/root/testdata/sf0.001"


def test_intra_domain_ranks_nothing_and_keeps_its_rows(spark):
    """the smallest places are aggregated before the shuffle; the only window numbers the listings."""
    found = plans.QUERIES["dedup_intra_domain"](spark, SF)
    assert found._jdf.queryExecution().optimizedPlan().toString().count("Window [") == 1
    want = dedup.intra_domain(plans.listings(spark, SF)).selectExpr("domain", "cast(seq as bigint) as seq")
    assert found.exceptAll(want).isEmpty() and want.exceptAll(found).isEmpty()


def test_publishable_is_decided_with_the_least_fields(spark):
    """for every choice of filled fields the verdict is that of all fields, and decided rows aren't given to later resolvers."""
    fields = v.INFORMATIVE_FIELDS
    rows = [(*("x" if on else "" for on in choice), url) for choice in product([0, 1], repeat=len(fields)) for url in ("https://a.fr/vente/1", "https://a.fr/blog/1")]
    df = spark.createDataFrame(rows, [*(f"in_{f}" for f in fields), "source_url"])
    known = ["location", "reference_id", "property_type"]
    tiers = [([f], lambda x, f=f: [(f"got_{f}", x), (f, f"case when {x} <> '' then in_{f} else '' end")]) for f in ("surface_area", "price", "rooms")]
    lazy = apply(df.selectExpr("*", "'text' as text", *(f"in_{f} as {f}" for f in known)), cl.publishable_steps(SPARK, known, tiers, ["text"]))
    whole = df.selectExpr("*", *(f"in_{f} as {f}" for f in fields)).selectExpr("*", f"{cl.publishable(SPARK)} as whole")
    both = lazy.join(whole.select(*(f"in_{f}" for f in fields), "source_url", "whole"), [*(f"in_{f}" for f in fields), "source_url"])
    assert both.count() == len(rows) and both.where("whole <> publishable").isEmpty()
    assert lazy.where("in_reference_id <> '' and in_property_type <> '' and got_surface_area <> ''").isEmpty()


def test_pages_of_one_row_group_are_dealt_out(spark, tmp_path):
    """F16, F17, F21, F22: a file that is cut into many parts may hold all rows in one of them."""
    path = f"{tmp_path}/pages.parquet"
    spark.range(4000).selectExpr("id as page_id", "'<p>x</p>' as html").coalesce(1).write.parquet(path)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1k")
    try:
        scan = spark.read.parquet(path)
        assert scan.rdd.getNumPartitions() >= 4  # so many parts that the scan was left as it is
        found = plans.QUERIES["extract_price"](spark, str(tmp_path))
        sizes = [r["count"] for r in found.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(sizes) == 4000 and max(sizes) < 1000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_looking_up_elements_equals_going_through_all():
    """F16, F17, F21, F22: the index of a parsed page; the walk for each selector was most of the time."""
    tree = parse('<html><body class="a b"><div id="x" data-lat="1"><p class="b">1<p>2</div><div><a href="/u">u</a><img alt="z"><p class="a">3</p></div></body></html>')
    for selector in ("p", "div p", ".b, p", "[data-lat], #x, .a", "a[href^='/']", "img[alt]", "h1", "div div", "body .b"):
        assert tree.select(selector) == Node.select(tree, selector)
        assert tree.first(selector) is Node.first(tree, selector)
    assert tree.order is not None and ("tag", "p") in tree.held


def test_franchise_pages_are_dealt_out(spark):
    """index pages are parsed in a fixed number of parts, however few their rows were joined in."""
    plan = plans.QUERIES["franchise_hosts"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression [domain#" in plan and f", {4 * spark.sparkContext.defaultParallelism}" in plan
