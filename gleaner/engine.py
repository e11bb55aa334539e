"""A run from agencies and stored pages to listings, errors, summary and report."""

from __future__ import annotations

import argparse
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from gleaner import vocabulary as v
from gleaner.config import EngineConfig
from gleaner.functions.dialect import SPARK, apply
from gleaner.functions.text import content_steps
from gleaner.functions.url import url_steps
from gleaner.operators import classify as cl, dedup, discovery, relational as rel
from gleaner.operators.extract import extract_fields, publish
from gleaner.plans.report import report, report_head
from gleaner.shared import Shared, pick, spread
from gleaner.sources import AGENCY_COLUMNS, in_file_order, mark_completed, read_agencies, read_completed, read_geocode_cache, replace_folder, settle, spans_lines, write_geocode_cache
from gleaner.sources.fetches import decode_fetches, final_or_own
from gleaner.sources.suffixes import with_domain


#: Columns that a table of pages may lack, and what stands for them: the answer was good, of no stated kind, where it was asked for, in no known order.
PAGE_DEFAULTS = {"status": "200", "content_type": "''", "final_url": "url", "seq": "cast(null as bigint)"}
KEYS = ["page", "domain", "host", "url", "base", "canonical", "scheme", "www", "status", "usable"]


@dataclass
class Outputs:
    listings: DataFrame
    errors: DataFrame
    summary: DataFrame
    #: ``field, pages``: how many extracted pages each field's resolver failed on.
    faults: DataFrame


class Engine:
    """``resolvers`` and ``families`` add to the vocabulary's: generators of tiers by field, and tuples as in ``vocabulary.FAMILIES``."""

    def __init__(self, spark: SparkSession, config: EngineConfig | None = None, resolvers: dict | None = None, families: list | None = None):
        self.spark, self.config = spark, config or EngineConfig()
        self.resolvers, self.families = resolvers, [*v.FAMILIES, *(families or [])]

    def store(self, pages: DataFrame, jobs: DataFrame, cut, name: str, sign: int = 1) -> tuple[DataFrame, DataFrame]:
        """The jobs' pages as a table of html by ``page``, and one of their keys alone.

        Domains are worked out in place; the jobs are broadcast if they are few, so
        pages are written where they were read. From then on only chosen pages' html is
        read again. With a ``seq`` of fetches a host that blocks too often in a row
        has no more pages: later ones count as 403.
        """
        if "body" in pages.columns:
            made = pages if "content_type" in pages.columns else pages.withColumn("content_type", F.lit(""))
            pages = decode_fetches(made.withColumn("status", F.expr(PAGE_DEFAULTS["status"])) if "status" not in pages.columns else made)
        rows = spread(pages)
        for column, default in PAGE_DEFAULTS.items():
            if column not in rows.columns:
                rows = rows.withColumn(column, F.expr(default))
        rows = with_domain(apply(rows, url_steps(SPARK, "url")))
        html = F.substring("html", 1, self.config.max_html_chars) if "body" not in pages.columns else F.col("html")
        rows = rows.select("domain", F.col("u_host").alias("host"), "url", F.expr(final_or_own()).alias("base"), F.col("u_canonical").alias("canonical"), F.col("u_scheme").alias("scheme"), F.expr("u_netloc like 'www.%'").alias("www"), "status", "content_type", F.col("seq").cast("bigint").alias("seq"), html.alias("html"))
        rows = pick(rows, jobs.select("domain"), "domain")
        rows = rows.withColumn("usable", F.expr(cl.usable_response(SPARK, "status", "content_type", "html"))).withColumn("page", F.monotonically_increasing_id() * sign - int(sign < 0))
        stored = cut(rows, f"{name}-pages")
        keys = stored.select(*KEYS, "seq")
        if "seq" in pages.columns:
            tripped = rel.block_breaker(keys.where("seq is not null").select("host", "seq", "status", "page")).where("seen_status = 403 and not (status <=> 403)").select("page", F.lit(True).alias("tripped"))
            keys = keys.join(tripped, "page", "left").withColumn("status", F.expr("case when tripped then 403 else status end")).withColumn("usable", F.expr("usable and tripped is null"))
        return stored.select("page", "html"), cut(keys.select(*KEYS), f"{name}-keys")

    def sites(self, jobs: DataFrame, keys: DataFrame, stored: DataFrame, cut, name: str = "sites", probes: DataFrame | None = None) -> DataFrame:
        """Each job's homepage with families, failure and suggested strategy; no page counts as no answer.

        The homepage is the first that answers of https before http, www. before bare.
        ``probes(url, status)``, if given, say the same of the first look at a site: a
        failure there comes before the homepage's own.
        """
        place, variant = F.expr("substring(canonical, length(scheme) + 1)"), F.expr("case when scheme = 'https' then 0 else 2 end + case when www then 0 else 1 end")
        parts = apply(jobs, url_steps(SPARK, "url", "j_")).select(*jobs.columns, F.col("j_host").alias("host"), F.expr("substring(j_canonical, length(j_scheme) + 1)").alias("home"))
        homes = keys.select("domain", place.alias("home"), variant.alias("variant"), F.col("status").isNull().alias("silent"), "url", "page", "base", "status", "usable")
        homes = homes.join(parts.select("domain", "home"), ["domain", "home"], "left_semi")
        homes = dedup.first_of(homes, ["domain", "home"], ["silent", "variant", "url"]).select("domain", "home", "page", "base", "status", "usable")
        rows = parts.join(homes, ["domain", "home"], "left")
        failure = cl.status_reason("status")
        if probes is not None:
            asked = with_domain(apply(probes.select("url", "status"), url_steps(SPARK, "url"))).select("domain", F.col("u_canonical").alias("canonical"), F.col("u_scheme").alias("scheme"), F.expr("u_netloc like 'www.%'").alias("www"), "url", "status")
            asked = asked.select("domain", place.alias("home"), F.col("status").isNull().alias("silent"), variant.alias("variant"), "url", F.col("status").alias("probe_status"))
            asked = dedup.first_of(asked, ["domain", "home"], ["silent", "variant", "url"]).select("domain", "home", "probe_status", F.lit(True).alias("asked"))
            rows = rows.join(asked, ["domain", "home"], "left")
            # a site that doesn't answer at the first look isn't asked for its homepage
            first = f"case when asked then {cl.status_reason('probe_status')} end"
            rows = rows.withColumn("page", F.expr(f"case when coalesce({first}, '') = 'site_not_reachable' then null else page end"))
            failure = f"coalesce({first}, {failure})"
        rows = cut(rows.withColumn("failure", F.expr(failure)), f"{name}-homes")
        heads = pick(stored, cut(rows.where("usable and page is not null").select("page"), f"{name}-heads"), "page").select("page", F.substring("html", 1, v.HEAD_CHARS).alias("html"))
        rows = rows.join(heads, "page", "left").withColumn("html", F.coalesce("html", F.lit("")))
        steps = [*cl.dynamic_steps(SPARK, "html"), ("html_head", "d_head"), *cl.family_steps(SPARK, "host", "html_head", "url", self.families)]
        return cut(apply(rows, [*steps, ("strategy", cl.strategy("failure", "looks_dynamic"))]).select(*jobs.columns, "host", "page", "base", "html_head", "families", "failure", "strategy"), name)

    def gather(self, sites: DataFrame, keys: DataFrame, stored: DataFrame, locations: DataFrame, rendered: DataFrame | None, cut) -> DataFrame:
        """Extracted pages of ``sites`` with ``domain, rank``: of the ``keys`` that are usable, and where a detail has none, of at most a few ``rendered`` ones."""

        def html(chosen: DataFrame, name: str) -> DataFrame:
            return pick(stored, cut(chosen, f"{name}-chosen"), "page")

        usable = keys.where("usable")
        read = usable if rendered is None else usable.unionByName(rendered)
        found = discovery.discover(sites.select("domain", "page", "base", "host", "html_head"), read.select("domain", "canonical", "url", "page", "base"), locations, self.config, cut, self.families, html)
        found = cut(found.select("domain", "canonical", "rank"), "candidates")
        lacking = sites.join(found.select("domain").distinct(), "domain", "left_anti")
        lacking = cut(lacking.where("families <> ''"), "lacking")
        if not lacking.isEmpty():
            index = read.select("domain", "canonical", F.col("base").alias("url"), "page")
            branches = discovery.franchise_candidates(lacking, index, self.config, cut, self.families, html)
            found = cut(found.unionByName(branches.select("domain", "canonical", "rank")), "all-candidates")
        details = dedup.first_of(usable.select("domain", "canonical", "url", "page", "base"), ["domain", "canonical"], ["url"])
        chosen = cut(found.join(details, ["domain", "canonical"]).select("domain", "canonical", "rank", "page", F.col("base").alias("url")), "details")
        if rendered is not None:
            more = found.join(chosen.select("domain", "canonical"), ["domain", "canonical"], "left_anti")
            shown = dedup.first_of(rendered.where("usable").select("domain", "canonical", "url", "page", "base"), ["domain", "canonical"], ["url"])
            nth = F.row_number().over(Window.partitionBy("domain").orderBy("rank"))
            more = more.join(shown, ["domain", "canonical"]).withColumn("nth", nth).where(F.col("nth") <= self.config.max_rendered_details)
            chosen = chosen.unionByName(more.select("domain", "canonical", "rank", "page", F.col("base").alias("url")))
        chosen = chosen.join(sites.select("domain", *rel.CONTACTS), "domain").withColumn("_agency", F.coalesce("agency_name", F.lit(""))).withColumn("_domain", F.col("domain"))
        extracted = extract_fields(html(chosen, "extracting").select("domain", "rank", "url", "html", *rel.CONTACTS, "_agency", "_domain"), self.resolvers)
        return cut(extracted.drop("html"), "extracted")

    def run(
        self,
        agencies: DataFrame,
        pages: DataFrame,
        sitemaps: DataFrame | None = None,
        completed: DataFrame | None = None,
        cache: DataFrame | None = None,
        robots: DataFrame | None = None,
        rendered: DataFrame | None = None,
        probes: DataFrame | None = None,
        events: DataFrame | None = None,
    ) -> Outputs:
        """``agencies`` as the loader reads them; ``pages(url, html)``, or ``body`` in place of ``html``, with what else of ``PAGE_DEFAULTS`` there is; ``sitemaps(domain, url, body)``, ``robots(domain, url, body)``.

        ``rendered(url, html)`` are pages as a browser shows them: they are used for
        blocked sites, and for those whose fetched pages yield nothing. ``probes(url, status)`` are
        first looks at sites. ``events``, as in ``relational.domain_runs``, say how long a domain's work took and
        whether it was broken off: such a domain fails, with no listings. Without
        ``robots`` every stored sitemap is a start, else those that it names and the
        well-known ones. Listings and summary come in the order of the jobs.
        """
        shared = Shared(self.spark).table
        jobs = rel.load_jobs(agencies)
        jobs = rel.pending(jobs, completed, self.config.limit) if completed is not None else jobs
        jobs = shared(jobs, "jobs")
        stored, keys = self.store(pages, jobs, shared, "fetched")
        sites = self.sites(jobs, keys, stored, shared, probes=probes)
        if sitemaps is None:
            locations = self.spark.createDataFrame([], "domain string, url string, order struct<level:int,up:bigint,pos:int>")
        else:
            all_ = sitemaps.select("domain", "url", F.row_number().over(Window.partitionBy("domain").orderBy("url")).alias("seq"))
            roots = all_ if robots is None else discovery.sitemap_roots(sites, sitemaps, robots)
            locations = shared(discovery.walk_sitemaps(roots, sitemaps, self.config.max_sitemap_depth), "locations")
        none = "domain string, duration_seconds string, interrupted string, fingerprinted boolean, left_seconds double, name string, message string"
        runs = shared(rel.domain_runs(events, self.config.domain_time_budget) if events is not None else self.spark.createDataFrame([], none), "runs")

        def publishable(extracted: DataFrame, name: str) -> DataFrame:
            rows = publish(extracted, ["domain", "rank"])
            return shared(rows.join(runs.where("interrupted is not null").select("domain"), "domain", "left_anti"), name)

        read = self.gather(sites.where("failure is null"), keys, stored, locations, None, lambda df, name: shared(df, f"static-{name}"))
        found, faults = publishable(read, "static"), read.select("faults")
        counts = found.groupBy("domain").agg(F.count("*").alias("static_found")).withColumn("rendered_found", F.lit(0).cast("bigint"))
        if rendered is not None:
            html, shown = self.store(rendered.withColumn("status", F.lit(200)), jobs, shared, "shown", sign=-1)
            late = runs.where(F.col("left_seconds") <= self.config.fallback_share * self.config.domain_time_budget).select("domain", F.lit("late").alias("late"))
            left = sites.where("failure is null or failure = 'blocked_403'").join(counts.select("domain"), "domain", "left_anti").join(late, "domain", "left").where("late is null or failure = 'blocked_403'").select(jobs.columns)
            both = shown.unionByName(keys.join(shown.select("domain", "canonical").distinct(), ["domain", "canonical"], "left_anti"))
            bodies = stored.unionByName(html)
            left = self.sites(shared(left, "left-jobs"), both, bodies, shared, "left")
            more = self.gather(left, keys, bodies, locations, shown, lambda df, name: shared(df, f"rendered-{name}"))
            second = publishable(more, "second")
            found, faults = found.unionByName(second), faults.unionByName(more.select("faults"))
            counts = counts.unionByName(second.groupBy("domain").agg(F.count("*").alias("rendered_found")).withColumn("static_found", F.lit(0).cast("bigint")))
        keyed = apply(found, [*url_steps(SPARK, "source_url"), *content_steps(SPARK, "location", "property_type", "surface_area", "price")])
        keyed = keyed.select("domain", F.col("rank").alias("seq"), F.col("reference_id").alias("ref"), F.col("u_key").alias("url_key"), "content", *v.LISTING_FIELDS)
        keyed = shared(keyed, "keyed")
        kept = shared(keyed.join(dedup.three_tier(keyed), ["domain", "seq"], "left_semi"), "kept")
        written = kept.groupBy("domain").agg(F.count("*").alias("listing_count"))
        rows = sites.drop("html_head").join(counts, "domain", "left").join(written, "domain", "left").na.fill(0, ["static_found", "rendered_found", "listing_count"]).join(runs, "domain", "left")
        why = cl.empty_reason("failure", "strategy", str(self.config.renderer_available or rendered is not None).lower())
        broken = cl.interrupted_reason(SPARK, "interrupted", "case when fingerprinted then failure is null end", "name", "message")
        rows = rows.withColumn("status", F.when(F.col("listing_count") > 0, "success").otherwise("failed"))
        rows = rows.withColumn("reason", F.expr(f"case when interrupted is not null then {broken} when listing_count > 0 then '' else {why} end"))
        used = cl.used_strategy("failure", "static_found", "rendered_found")
        rows = shared(rows.withColumn("used", F.expr(f"case when interrupted is not null then 'none' else {used} end")), "outcomes")
        summary = rows.select("domain", "status", "listing_count", "reason", F.col("used").alias("strategy"), F.coalesce("duration_seconds", F.lit("0.00")).alias("duration_seconds"), "job_seq").orderBy("job_seq").drop("job_seq")
        nowhere = rel.no_website(agencies).select(F.col("agency_name").alias("domain"), F.lit("failed").alias("status"), F.lit("no_website").alias("reason"))
        outcomes = nowhere.withColumn("seq", F.lit(0).cast("bigint")).unionByName(rows.where("status = 'failed'").select("domain", "status", "reason", (F.col("job_seq") + 1).alias("seq")))
        errors = shared(rel.error_log(outcomes).select("domain", "status", "reason"), "errors")
        listings = kept.join(rows.select("domain", "job_seq"), "domain")
        listings = rel.fill_coordinates(listings, cache) if cache is not None and self.config.geocoding else listings
        faults = faults.select(F.explode("faults").alias("field")).groupBy("field").agg(F.count("*").alias("pages"))
        return Outputs(listings.orderBy("job_seq", "seq").select(*v.LISTING_FIELDS), errors, summary, shared(faults, "faults"))

    def _read(self, folder: str, name: str, columns: list[str]) -> DataFrame:
        """A written table, with ``place`` in the order of its files and rows."""
        settle(self.spark, f"{folder}/{name}")
        schema = ", ".join(f"`{c}` {'bigint' if c == 'listing_count' else 'string'}" for c in columns)
        rows = self.spark.read.schema(schema).option("header", True).option("nullValue", "\0").option("emptyValue", "").option("multiLine", spans_lines(self.spark, f"{folder}/{name}")).option("escape", '"').option("recursiveFileLookup", True)
        return in_file_order(rows.csv(f"{folder}/{name}"), "place").na.fill("")

    def _save(self, df: DataFrame, path: str, mode: str) -> None:
        df.write.mode(mode).option("header", True).option("emptyValue", "").option("escape", '"').csv(path)

    def write(self, out: Outputs, folder: str, batch: int | None = None) -> str:
        """Listings, errors and summary as CSV, and the report in sorted text files; returns the report's head, without the failed domains.

        A ``batch`` has folders of its own in those of the tables, which are replaced
        if it is written again.
        """
        c = self.config
        mode, part = ("append" if c.keep_outputs else "overwrite", "") if batch is None else ("overwrite", f"/batch-{batch:09d}")
        for name, df in ((c.listings_name, out.listings), (c.error_log_name, out.errors), (c.domain_summary_name, out.summary)):
            self._save(df, f"{folder}/{name}{part}", mode)
        return self.report(folder)

    def report(self, folder: str) -> str:
        """Writes the report of what the folder holds, and returns its head."""
        c = self.config
        summary = ["domain", "status", "listing_count", "reason", "strategy", "duration_seconds"]
        held = self._read(folder, c.listings_name, v.LISTING_FIELDS), self._read(folder, c.domain_summary_name, summary), self._read(folder, c.error_log_name, v.ERROR_FIELDS)
        report(*held).orderBy("place").select(F.col("line").alias("value")).write.mode("overwrite").text(f"{folder}/{c.report_name}")
        return report_head(*held)

    def fill_written(self, folder: str, cache: DataFrame) -> None:
        """Rewrites the listings with the coordinates that the cache has by now: a new version is written whole, then takes the old one's place."""
        filled = rel.fill_coordinates(self._read(folder, self.config.listings_name, v.LISTING_FIELDS), cache).orderBy("place").select(*v.LISTING_FIELDS)
        replace_folder(self.spark, lambda new: self._save(filled, new, "overwrite"), f"{folder}/{self.config.listings_name}")

    def missing(self, folder: str, cache: DataFrame) -> DataFrame:
        """``key``: the locations of written listings without coordinates that a geocoder has yet to be asked for."""
        return rel.missing_locations(self._read(folder, self.config.listings_name, v.LISTING_FIELDS), cache)

    def geocoded(self, folder: str, cache_path: str, answers: DataFrame) -> None:
        """Takes a geocoder's ``answers(key, value)`` (an empty value: not found) into the cache, which is replaced, and fills the written listings from it.

        What the cache knows already stays, unless it was a miss and there is an answer now.
        """
        known = read_geocode_cache(self.spark, cache_path)
        new = answers.select(F.lower(F.trim("key")).alias("key"), F.coalesce("value", F.lit("")).alias("value")).where("key <> ''")
        both = known.withColumn("place", F.lit(0)).unionByName(new.withColumn("place", F.lit(1)))
        cache = Shared(self.spark).table(both.groupBy("key").agg(F.min_by("value", F.struct((F.col("value") == "").alias("miss"), "place", "value")).alias("value")), "cache")
        write_geocode_cache(cache, cache_path)
        self.fill_written(folder, cache)

    def stream(self, agencies: str, pages: DataFrame, folder: str, checkpoint: str, **more):
        """Runs over agency files as they arrive, ``max_files_per_trigger`` at a time; returns the streaming query.

        Each batch's outputs are added and its domains marked as completed with its
        number, so a domain is done once, across batches and restarts. A batch that is
        replayed after a crash does its own domains anew and replaces its outputs.
        """
        done = f"{checkpoint.rstrip('/')}-completed"
        rows = self.spark.readStream.schema(", ".join(f"{c} string" for c in AGENCY_COLUMNS)).option("header", True).option("maxFilesPerTrigger", self.config.max_files_per_trigger).csv(agencies)

        def batch(df: DataFrame, number: int) -> None:
            new = Shared(self.spark).table(df.select(F.monotonically_increasing_id().alias("seq"), *AGENCY_COLUMNS), "agencies")
            before = read_completed(self.spark, done, but=f"batch-{number:09d}")
            out = self.run(new, pages, completed=before, **more)
            self.write(out, folder, number)
            mark_completed(out.summary, f"{done}/batch-{number:09d}", reset=True)

        return rows.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def main(args: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(description=__doc__)
    p.add_argument("agencies")
    p.add_argument("pages", help="Parquet with url and html, or body in bytes; status, content_type, final_url and seq where there are any")
    p.add_argument("output")
    p.add_argument("--sitemaps", help="Parquet with domain, url, body")
    p.add_argument("--robots", help="Parquet with domain, url, body")
    p.add_argument("--rendered", help="Parquet with url, html")
    p.add_argument("--probes", help="Parquet with url, status")
    p.add_argument("--events", help="Parquet with domain, at, event, name, message")
    p.add_argument("--geocode-answers", help="Parquet with key, value: taken into the cache, and from there into the listings")
    p.add_argument("--log-level", default="WARN", choices=["DEBUG", "INFO", "WARN", "ERROR"])
    p.add_argument("--checkpoint")
    p.add_argument("--geocode-cache")
    p.add_argument("--limit", type=int)
    p.add_argument("--keep-outputs", action="store_true")
    p.add_argument("--reset-checkpoint", action="store_true")
    a = p.parse_args(args)
    spark = SparkSession.builder.config("spark.sql.codegen.hugeMethodLimit", "8000").getOrCreate()  # longer methods would be interpreted
    spark.sparkContext.setLogLevel(a.log_level)
    base = EngineConfig.from_environment()
    engine = Engine(spark, replace(base, limit=a.limit if a.limit is not None else base.limit, keep_outputs=a.keep_outputs or base.keep_outputs, reset_checkpoint=a.reset_checkpoint or base.reset_checkpoint))
    done = read_completed(spark, a.checkpoint) if a.checkpoint and not engine.config.reset_checkpoint else spark.createDataFrame([], "domain string")
    cache = read_geocode_cache(spark, a.geocode_cache) if a.geocode_cache else None
    sitemaps, robots, rendered, probes, events, answers = (spark.read.parquet(x) if x else None for x in (a.sitemaps, a.robots, a.rendered, a.probes, a.events, a.geocode_answers))
    out = engine.run(read_agencies(spark, a.agencies), spark.read.parquet(a.pages), sitemaps, completed=done, cache=cache, robots=robots, rendered=rendered, probes=probes, events=events)
    print(engine.write(out, a.output))
    if answers is not None and a.geocode_cache:
        engine.geocoded(a.output, a.geocode_cache, answers)
        print(engine.report(a.output))
    if a.checkpoint:
        mark_completed(out.summary, a.checkpoint, engine.config.reset_checkpoint)


if __name__ == "__main__":
    main()
