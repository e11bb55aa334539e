"""Loading, outcome, discovery and enrichment operators over tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from gleaner import vocabulary as v
from gleaner.functions.dialect import SPARK, apply, keep
from gleaner.functions.text import clean
from gleaner.functions.url import url_steps
from gleaner.operators.dedup import first_of
from gleaner.shared import Shared
from gleaner.sources.suffixes import with_domain

CONTACTS = ["agency_name", "agent_name", "phone", "city", "postalcode"]


def clean_agencies(agencies: DataFrame) -> DataFrame:
    """``agencies(seq, company_name, contact_person_last_name, phone_1, postalcode, city, website)`` with clean text and the website's domain."""
    names = {"company_name": "agency_name", "contact_person_last_name": "agent_name", "phone_1": "phone", "city": "city", "postalcode": "postalcode", "website": "website"}
    rows = agencies.select("seq", *[F.expr(clean(SPARK, old)).alias(new) for old, new in names.items()])
    rows = rows.withColumn("agency_name", F.when(F.col("agency_name") == "", "Unknown Agency").otherwise(F.col("agency_name")))
    rows = with_domain(apply(rows, url_steps(SPARK, "website")))
    return rows.select("seq", *CONTACTS, F.col("u_full").alias("url"), "domain")


def load_jobs(agencies: DataFrame) -> DataFrame:
    """One job per domain: the first row's URL, and of each contact the longest value, the earliest of equal ones."""
    rows = keep(clean_agencies(agencies), "domain <> ''")
    best = [F.max_by(c, F.struct(F.length(c), -F.col("seq"))).alias(c) for c in CONTACTS]
    return rows.groupBy("domain").agg(F.min("seq").alias("job_seq"), F.min_by("url", "seq").alias("url"), *best, F.count("*").alias("rows_merged"))


def no_website(agencies: DataFrame) -> DataFrame:
    return keep(clean_agencies(agencies), "domain = ''").select("agency_name")


def pending(jobs: DataFrame, completed: DataFrame, limit: int | None = None) -> DataFrame:
    """Jobs whose domain isn't completed, in input order if limited."""
    left = jobs.join(completed.select(F.lower(F.trim("domain")).alias("domain")).distinct(), "domain", "left_anti")
    return left if limit is None else left.orderBy("job_seq").limit(limit)


def block_breaker(fetches: DataFrame, trip: int = v.BLOCKS_TO_TRIP) -> DataFrame:
    """``fetches(host, seq, status)`` with ``seen_status``: once a host has blocked ``trip`` times since its last good answer, all later fetches are 403.

    Other statuses leave the count as it is. After tripping nothing reaches the host, so nothing resets it.
    """
    order = Window.partitionBy("host").orderBy("seq")
    so_far, earlier = order.rowsBetween(Window.unboundedPreceding, 0), order.rowsBetween(Window.unboundedPreceding, -1)
    ok, blocked = F.col("status").between(200, 399), F.col("status").isin(401, 403, 429)
    rows = fetches.withColumn("_island", F.sum(F.when(ok, 1).otherwise(0)).over(so_far))
    inside = Window.partitionBy("host", "_island").orderBy("seq").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("_blocks", F.sum(F.when(blocked, 1).otherwise(0)).over(inside))
    tripped = F.coalesce(F.max(F.col("_blocks") >= trip).over(earlier), F.lit(False))
    return rows.withColumn("seen_status", F.when(tripped, 403).otherwise(F.col("status"))).drop("_island", "_blocks")


def domain_runs(events: DataFrame, budget: float) -> DataFrame:
    """``events(domain, at, event, name, message)``, a log of each domain's work, folded to a row per domain.

    ``at`` is a time, ``event`` one of start, fingerprint (the site has been looked at), static (its pages have been
    read), timeout, crash, end; others only tell that time has passed. The first timeout or crash interrupts, and so
    does the first event of any kind that lies more than ``budget`` seconds after the first one, as a timeout. What comes later doesn't count.

    ``domain, duration_seconds`` (two decimals, halves away from zero; to the interruption or the last event), ``interrupted`` (timeout, crash
    or null), ``fingerprinted`` (before that), ``left_seconds`` (of the budget, once pages were read; null if they weren't), ``name, message`` of a crash.
    One aggregation after a look at each domain's first event, so a long log is folded before it is shuffled.
    """
    rows = events.select(F.lower(F.trim("domain")).alias("domain"), F.col("at").cast("timestamp").alias("at"), F.lower("event").alias("event"), *[F.coalesce(c, F.lit("")).alias(c) for c in ("name", "message")])
    rows = rows.where("domain <> '' and at is not null")
    began = rows.groupBy("domain").agg(F.min("at").alias("began"))
    # a domain's log is short by nature; the join is one by one of its rows with its beginning
    rows = rows.join(began, "domain").withColumn("after", (F.unix_micros("at") - F.unix_micros("began")) / F.lit(1_000_000.0))
    stop = F.when(F.col("event").isin("timeout", "crash"), F.col("event")).when(F.col("after") > budget, "timeout")
    ended = F.struct("after", F.when(F.col("event") == "crash", 1).otherwise(0).alias("kind"), stop.alias("interrupted"), "name", "message")
    first = rows.withColumn("stop", F.when(stop.isNotNull(), ended)).groupBy("domain").agg(
        F.min("stop").alias("stop"),
        F.max("after").alias("last"),
        F.min(F.when(F.col("event") == "fingerprint", F.col("after"))).alias("fingerprint"),
        F.min(F.when(F.col("event") == "static", F.col("after"))).alias("static"),
    )
    until = F.coalesce("stop.after", "last")
    return first.select(
        "domain",
        F.round(until.cast("decimal(20,6)"), 2).cast("string").alias("duration_seconds"),
        F.col("stop.interrupted").alias("interrupted"),
        F.coalesce(F.col("fingerprint") <= until, F.lit(False)).alias("fingerprinted"),
        F.when(F.col("static") <= until, budget - F.col("static")).alias("left_seconds"),
        F.coalesce("stop.name", F.lit("")).alias("name"),
        F.coalesce("stop.message", F.lit("")).alias("message"),
    )


def error_log(outcomes: DataFrame) -> DataFrame:
    """``outcomes(domain, seq, status, reason)`` without blank domains and without repetitions of the domain's last reason."""
    rows = outcomes.withColumn("domain", F.lower(F.trim("domain"))).where("domain <> ''")
    last = F.lag("reason").over(Window.partitionBy("domain").orderBy("seq"))
    return rows.withColumn("_last", last).where("_last is null or _last <> reason").drop("_last")


def rank_candidates(urls: DataFrame, limit: int) -> DataFrame:
    """``urls(domain, seq, canonical, score)``: first of each canonical URL, accepted ones, best ``limit`` of each domain by score, then URL."""
    unique = first_of(urls, ["domain", "canonical"], ["seq"]).where("score > 0")
    rank = F.row_number().over(Window.partitionBy("domain").orderBy(F.desc("score"), "canonical"))
    return unique.withColumn("rank", rank).where(F.col("rank") <= limit)


def expand_hubs(seeds: DataFrame, anchors: DataFrame | Callable[[DataFrame, int], DataFrame], depth: int, budget: int) -> DataFrame:
    """Bounded breadth-first search: ``seeds(domain, url, kind, seq)`` over ``anchors(domain, src, dst, kind, pos)`` -> details as ``domain, url, depth, seq``.

    ``anchors`` may be a function of the hubs that a round opens, as ``domain, hub, place``, and its number: it returns
    them with their links, ``url, kind, pos``, so that no other page is ever read.

    Details are kept at any depth. A hub is fetched once, up to ``depth``, and at
    most ``budget`` hubs for a domain, first come first served. A round's order is
    that of its hubs and of the anchors in them.

    The state is two tables in the shared folder that grow by a part each round: the
    nodes seen and the hubs opened. A round reads them whole, so its plan has the
    same size at any depth, and a lost executor costs one round's tasks.
    """
    shared = Shared(seeds.sparkSession, "hubs")
    nodes, opened = "domain string, url string, kind string, seq bigint", "domain string, url string, place bigint"
    shared.add(_first_met(seeds, [F.col("seq").cast("bigint").alias("seq")]), "nodes", 1)
    if callable(anchors):
        links = anchors
    else:
        edges = anchors.select("domain", F.col("src").alias("hub"), F.col("dst").alias("url"), "kind", "pos")
        links = lambda hubs, _: hubs.join(edges, ["domain", "hub"])
    for k in range(1, depth + 1):
        hubs = shared.parts("nodes", nodes).where((F.col("part") == k) & (F.col("kind") == "hub")).select("domain", "url", "seq")
        # the window is cut to the budget before it is shuffled; what earlier rounds spent is taken off afterwards
        place = F.row_number().over(Window.partitionBy("domain").orderBy("seq", "url"))
        hubs = hubs.withColumn("place", place.cast("bigint")).where(F.col("place") <= budget)
        if k > 1:
            spent = shared.parts("opened", opened).groupBy("domain").agg(F.count("*").alias("spent"))
            hubs = hubs.join(spent, "domain", "left").where(F.col("place") + F.coalesce("spent", F.lit(0)) <= budget)
        shared.add(hubs.select("domain", "url", "place"), "opened", k)
        hubs = shared.parts("opened", opened).where(F.col("part") == k)
        if hubs.isEmpty():
            break
        out = links(hubs.select("domain", F.col("url").alias("hub"), "place"), k).where("kind <> 'reject'").withColumn("pos", F.col("pos").cast("bigint"))
        fresh = out.join(shared.parts("nodes", nodes).select("domain", "url"), ["domain", "url"], "left_anti")
        shared.add(_first_met(fresh, [F.shiftleft("place", PLACE_BITS).bitwiseOR(F.col("pos")).alias("seq")]), "nodes", k + 1)
    return shared.parts("nodes", nodes).where("kind = 'detail'").select("domain", "url", F.col("part").alias("depth"), "seq")


#: A node's place in its round is its hub's place above this many bits of its position in the hub.
PLACE_BITS = 40


def _first_met(rows: DataFrame, order: list[Column]) -> DataFrame:
    """Of each URL of a domain the first row: ``domain, url, kind, seq``. An aggregate, so rows of a URL that many pages link meet before the shuffle."""
    first = rows.select("domain", "url", "kind", *order).groupBy("domain", "url").agg(F.min(F.struct("seq", "kind")).alias("first"))
    return first.select("domain", "url", "first.kind", "first.seq")


def missing_locations(listings: DataFrame, cache: DataFrame) -> DataFrame:
    """Distinct lower-cased locations of rows without coordinates that the cache doesn't know; a known miss counts as known."""
    lacking = listings.where("trim(coordinates) = '' and trim(location) <> ''").select(F.lower(F.trim("location")).alias("key")).distinct()
    return lacking.join(cache.select("key"), "key", "left_anti")


def fill_coordinates(listings: DataFrame, cache: DataFrame) -> DataFrame:
    known = cache.select("key", F.col("value").alias("_found"))
    rows = listings.withColumn("key", F.lower(F.trim("location"))).join(known, "key", "left").drop("key")
    lacks = (F.trim("coordinates") == "") & (F.trim("location") != "")
    return rows.withColumn("coordinates", F.when(lacks, F.coalesce("_found", "coordinates")).otherwise(F.col("coordinates"))).drop("_found")


def field_completeness(listings: DataFrame) -> DataFrame:
    """Filled rows and fill rate of each listing field, in one pass: ``field, filled, rate``."""
    from gleaner.functions.text import percent

    fields = [f for f in v.LISTING_FIELDS if f in listings.columns]
    counts = listings.agg(F.count("*").alias("total"), *[F.count_if(F.trim(f) != "").alias(f) for f in fields])
    pairs = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("filled")) for f in fields])
    rows = counts.select("total", F.explode(pairs).alias("x")).select("x.field", "x.filled", "total")
    return rows.withColumn("rate", F.expr(percent(SPARK, "filled", "total"))).drop("total")


def counted_first(rows: DataFrame, key: Column, name: str, order: str | None = None) -> DataFrame:
    """``name, n, first``: how often each value of the key occurs, blank ones left out, and its first place.

    Places are those of the column ``order``; without one all are equal. Counts and places are both added up before the shuffle.
    """
    place = F.col(order).cast("bigint") if order else F.lit(0).cast("bigint")
    return rows.select(key.alias(name), place.alias("_place")).where(F.col(name) != "").groupBy(name).agg(F.count("*").alias("n"), F.min("_place").alias("first"))


def most_common(rows: DataFrame, key: Column, name: str, order: str | None = None) -> DataFrame:
    """Values by how often they occur; of equally frequent ones the first to appear comes first, and of equally early ones the least."""
    return counted_first(rows, key, name, order).orderBy(F.desc("n"), "first", name)


def per_domain(listings: DataFrame) -> DataFrame:
    return counted_first(listings, F.lower(F.trim("source_domain")), "domain").select("domain", F.col("n").alias("listings"))


def top_domains(listings: DataFrame, n: int = 25, order: str | None = None) -> DataFrame:
    """The domains with most listings, ties by first appearance in the column ``order``."""
    return most_common(listings, F.lower(F.trim("source_domain")), "domain", order).limit(n).select("domain", F.col("n").alias("listings"))
