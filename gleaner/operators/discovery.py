"""Discovery over stored pages: anchors, sitemaps, hubs, franchises, ranking."""

from __future__ import annotations

from collections.abc import Callable
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from gleaner import vocabulary as v
from gleaner.config import EngineConfig
from gleaner.functions.dialect import SPARK, apply, keep
from gleaner.functions.text import decode_steps
from gleaner.functions.url import under_domain, url_steps
from gleaner.html import parse
from gleaner.operators.classify import classify_steps, family_steps
from gleaner.operators.dedup import first_of
from gleaner.operators.relational import expand_hubs, rank_candidates
from gleaner.shared import Shared


def anchors(pages: DataFrame, also: list[str] | None = None) -> DataFrame:
    """``pages(domain, url, html)`` -> each ``a[href]`` in order: ``domain, src, pos, dst``, made absolute, after the columns ``also``."""

    @F.pandas_udf("array<string>")
    def hrefs(urls: pd.Series, htmls: pd.Series) -> pd.Series:
        def of(url: str, html: str) -> list[str]:
            out = []
            for n in parse(html or "").select("a[href]"):
                try:
                    out.append(urljoin(url, n.attrs["href"].strip()))
                except ValueError:
                    out.append("")
            return out

        return pd.Series([of(u or "", h or "") for u, h in zip(urls, htmls, strict=True)])

    return pages.select(*(also or []), "domain", F.col("url").alias("src"), F.posexplode(hrefs("url", "html")).alias("pos", "dst")).where("dst <> ''")


def classified(links: DataFrame, url: str = "dst") -> DataFrame:
    """Links within their domain, with ``canonical``, ``score`` and ``kind``."""
    rows = apply(links, [*classify_steps(SPARK, url), ("own", under_domain("u_host", "domain"))])
    rows = keep(rows, "own and seed_kind <> 'reject'")
    return rows.withColumn("canonical", F.col("u_canonical")).withColumn("kind", F.col("seed_kind")).select(*links.columns, "canonical", "score", "kind")


def sitemap_locs(bodies: DataFrame) -> DataFrame:
    """``bodies(domain, url, body)`` -> ``domain, src, is_index, pos, loc``: the locations of sitemaps and whether they are indexes.

    Character references and CDATA sections are decoded. Locations that are empty without white space drop out.
    """
    head = F.lower(F.substring("body", 1, 4096))
    maps = bodies.where(head.contains("<urlset") | head.contains("<sitemapindex") | head.contains("<loc>"))
    locs = F.regexp_extract_all(F.regexp_replace("body", "(?s)<!--.*?-->", ""), F.lit(v.SITEMAP_LOC), F.lit(1))
    rows = maps.select("domain", F.col("url").alias("src"), head.contains("<sitemapindex").alias("is_index"), F.posexplode(locs).alias("pos", "raw"))
    return apply(rows, decode_steps("raw", "loc")).where("loc <> ''").select("domain", "src", "is_index", "pos", "loc")


def walk_sitemaps(roots: DataFrame, bodies: DataFrame, depth: int) -> DataFrame:
    """``roots(domain, url, seq)`` over stored sitemaps: page locations in visit order, level by level, ``depth`` levels of indexes.

    Within a level children of indexes with a hint of listings come first, then the
    shorter ones. Rounds follow indexes alone, over a table of visited maps that grows
    by a part each round; the maps' page locations join once, at the end.
    """
    shared = Shared(roots.sparkSession, "sitemaps")
    locs = shared.table(sitemap_locs(bodies), "locs")
    visited, place = "domain string, src string, up bigint", F.min("seq").cast("bigint").alias("up")
    shared.add(roots.groupBy("domain", F.col("url").alias("src")).agg(place), "visited", 0)
    for k in range(depth):
        level = shared.parts("visited", visited).where(F.col("part") == k)
        if level.isEmpty():
            break
        here = level.join(locs.where("is_index"), ["domain", "src"]).select("domain", F.col("loc").alias("src"), "up", "pos")
        rank = Window.partitionBy("domain").orderBy(F.desc(F.col("src").rlike(v.LISTING_HINT)), F.length("src"), "up", "pos")
        fresh = here.withColumn("seq", F.row_number().over(rank)).join(shared.parts("visited", visited).select("domain", "src"), ["domain", "src"], "left_anti")
        shared.add(fresh.groupBy("domain", "src").agg(place), "visited", k + 1)
    found = shared.parts("visited", visited).join(locs.where("not is_index"), ["domain", "src"])
    order = F.struct(F.col("part").alias("level"), "up", "pos")
    return found.groupBy("domain", F.col("loc").alias("url")).agg(F.min(order).alias("order"))


def sitemap_candidates(sites: DataFrame) -> DataFrame:
    """Well-known places of sitemaps of ``sites(domain, url)``: ``domain, seq, url``. With and without www. they are the same places, so one of each stays."""
    rows = apply(sites.select("domain", "url"), url_steps(SPARK, "url"))
    places = F.posexplode(F.array(*[F.lit(p) for p in v.SITEMAP_PATHS])).alias("seq", "path")
    return rows.where("u_host <> ''").select("domain", "u_scheme", "u_host", places).select("domain", F.col("seq").cast("long").alias("seq"), F.concat("u_scheme", F.lit("://www."), "u_host", "path").alias("url"))


def robots_sitemaps(robots: DataFrame) -> DataFrame:
    """Sitemaps that ``robots(domain, url, body)`` names, the first of each canonical URL: ``domain, seq, url``."""
    found = F.posexplode(F.regexp_extract_all("body", F.lit(v.SITEMAP_LINE), F.lit(1))).alias("pos", "found")
    rows = apply(robots.select("domain", F.col("url").alias("src"), found), url_steps(SPARK, "found"))
    rows = first_of(rows.where("u_canonical <> ''").withColumn("url", F.trim("found")), ["domain", "u_canonical"], ["src", "pos"])
    return rows.select("domain", F.row_number().over(Window.partitionBy("domain").orderBy("src", "pos")).cast("long").alias("seq"), "url")


def sitemap_roots(sites: DataFrame, bodies: DataFrame, robots: DataFrame | None = None) -> DataFrame:
    """``domain, url, seq`` of the stored sitemaps to start from: those in robots.txt, then well-known places, matched by canonical URL."""
    wanted = sitemap_candidates(sites).withColumn("seq", F.col("seq") + 1_000_000)
    wanted = wanted if robots is None else robots_sitemaps(robots).unionByName(wanted)
    wanted = apply(wanted, url_steps(SPARK, "url", "w_")).select("domain", "seq", F.col("w_canonical").alias("place"))
    stored = apply(bodies.select("domain", "url"), url_steps(SPARK, "url")).select("domain", "url", F.col("u_canonical").alias("place"))
    return first_of(stored.join(wanted, ["domain", "place"]), ["domain", "url"], ["seq"]).select("domain", "url", "seq")


def franchise_hosts(sites: DataFrame, pages: DataFrame, most: int, known: list | None = None, html: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Branch hosts of franchise sites: ``sites(domain, host, families)``, with index pages among ``pages(domain, canonical, url, html)``.

    The first of a site's families that has index paths counts, of its paths the
    first with a page on the registrable domain, and at most ``most`` other hosts
    that this page links. ``html`` may add that column to chosen pages instead.
    """
    families = v.FAMILIES if known is None else known
    paths = [(name, k, path.rstrip("/")) for name, _, _, _, index in families for k, path in enumerate(index)]
    index = sites.sparkSession.createDataFrame(paths, "family string, k int, path string")
    named = sites.select("domain", F.posexplode(F.split("families", ",")).alias("nth", "family"))
    named = first_of(named.join(F.broadcast(index.select("family").distinct()), "family"), ["domain"], ["nth"])
    wanted = named.join(F.broadcast(index), "family").withColumn("canonical", F.concat(F.lit("https://"), "domain", "path"))
    stored = first_of(wanted.join(pages, ["domain", "canonical"]), ["domain"], ["k", "url"])
    stored = html(stored.select("domain", "url", "page")) if html else stored
    # parsing costs far more than its input's size says, by which parts are joined
    dealt = stored.select("domain", "url", "html").repartition(4 * sites.sparkSession.sparkContext.defaultParallelism, "domain")
    rows = apply(anchors(dealt), url_steps(SPARK, "dst"))
    rows = rows.join(sites.select("domain", "host"), "domain").where(under_domain("u_host", "domain")).where("u_host <> host")
    hosts = rows.groupBy("domain", "u_host").agg(F.min("pos").alias("pos"))
    return hosts.withColumn("rank", F.row_number().over(Window.partitionBy("domain").orderBy("pos"))).where(F.col("rank") <= most).select("domain", F.col("u_host").alias("host"), "rank")


def franchise_candidates(sites: DataFrame, pages: DataFrame, config: EngineConfig, cut: Callable[[DataFrame, str], DataFrame], known: list | None, html: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
    """Ranked candidates from the homepages of franchise branches, for ``sites(domain, host, html_head, families)`` that have none of their own.

    ``pages(domain, canonical, url, page)`` are keys alone; ``html`` writes chosen ones
    and returns them with their html.
    """
    branches = cut(franchise_hosts(sites.where("families <> ''"), pages, config.max_franchise_hosts, known, lambda chosen: html(chosen, "index_pages")), "branches")
    homes = branches.select("domain", "rank", F.concat(F.lit("https://"), "host", F.lit("/")).alias("canonical")).join(pages, ["domain", "canonical"])
    homes = html(first_of(homes, ["domain", "rank"], ["url"]).select("domain", "url", "rank", "page"), "branch_homes")
    links = cut(anchors(homes).join(homes.select("domain", F.col("url").alias("src"), "rank"), ["domain", "src"]), "branch_links")
    rows = apply(links.join(sites.select("domain", "host", "html_head"), "domain"), [*classify_steps(SPARK, "dst"), *family_steps(SPARK, "host", "html_head", "dst", known), ("own", under_domain("u_host", "domain"))])
    rows = keep(rows, "own")
    order = F.row_number().over(Window.partitionBy("domain").orderBy("rank", "pos"))
    boosted = F.when(F.col("score") > 0, F.col("score") + F.col("boost")).otherwise(F.col("score"))
    return rank_candidates(cut(rows.select("domain", order.alias("seq"), F.col("u_canonical").alias("canonical"), boosted.alias("score")), "branch_scored"), config.max_listing_urls)


def discover(
    sites: DataFrame, pages: DataFrame, sitemap_urls: DataFrame, config: EngineConfig, cut: Callable[[DataFrame, str], DataFrame], known: list | None, html: Callable[[DataFrame, str], DataFrame]
) -> DataFrame:
    """Ranked candidate pages of each domain: sitemap locations, then homepage anchors, expanded through hubs.

    ``sites(domain, page, base, host, html_head)``, ``pages(domain, canonical, url, page, base)``, ``sitemap_urls(domain, url, order)``.
    Pages are keys alone: only homepages and the hubs that a round opens are read,
    by ``html``, which writes chosen pages and returns them with their html. ``cut``
    writes a table and reads it again, between the phases.
    """
    home = anchors(html(sites.where("page is not null").select("domain", F.col("base").alias("url"), "page"), "homes"))
    from_map = sitemap_urls.select("domain", F.col("url").alias("dst"), F.row_number().over(Window.partitionBy("domain").orderBy("order")).alias("seq"))
    home = cut(home, "home")
    both = from_map.unionByName(home.select("domain", "dst", (F.col("pos") + 1_000_000).alias("seq")))
    seeds = cut(classified(both).select("domain", F.col("canonical").alias("url"), "kind", "seq"), "seeds")
    stored = first_of(pages, ["domain", "canonical"], ["url"])

    def links(hubs: DataFrame, k: int) -> DataFrame:
        found = hubs.withColumnRenamed("hub", "canonical").join(stored, ["domain", "canonical"])
        opened = html(found.select("domain", "place", F.col("canonical").alias("hub"), F.col("base").alias("url"), "page"), f"hubs-{k}")
        out = cut(anchors(opened, ["place", "hub"]), f"hub-links-{k}")
        return cut(classified(out).select("domain", "hub", "place", F.col("canonical").alias("url"), "kind", "pos"), f"hub-kinds-{k}")

    found = cut(expand_hubs(seeds, links, config.seed_expansion_depth, config.max_hub_pages), "reached")
    scored = apply(found.join(sites.select("domain", "host", "html_head"), "domain"), [*classify_steps(SPARK), *family_steps(SPARK, "host", "html_head", "url", known)])
    order = F.row_number().over(Window.partitionBy("domain").orderBy("depth", "seq"))
    scored = scored.select("domain", order.alias("seq"), F.col("url").alias("canonical"), F.when(F.col("score") > 0, F.col("score") + F.col("boost")).otherwise(F.col("score")).alias("score"))
    return rank_candidates(cut(scored, "scored"), config.max_listing_urls)
