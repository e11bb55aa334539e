"""URL filters by a temporal list join.

A list is a log of dated entries: a pattern is added or removed on a day. They
become validity intervals, and an as-of join evaluates every capture against the
entries that were active on the day it was fetched. Patterns are domains
(``example.net``, which also covers its subdomains) or a host with a path prefix
(``a.example.net/en``), so each capture offers a bounded number of keys, by the
labels of its host and the segments of its path, and the join is an equality on
pattern and month. Intervals are dealt out to the months they touch; a pair then
meets in one month alone, whatever the history of a pattern.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from gleaner.llm.common import Scratch, table

#: Keys with more than this share of all that captures offer are handled apart; they are fewer than 1 / HOT_SHARE.
HOT_SHARE = 0.001


def _month(day: Column) -> Column:
    return F.year(day) * 12 + F.month(day)


def host_of(url: Column) -> Column:
    """Lower-cased host without user, port and a closing dot; empty if there is none."""
    return F.regexp_extract(F.lower(url), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]*?)\.?(?::[0-9]*)?(?:[/?#]|$)", 1)


def keys_of(url: Column) -> Column:
    """Patterns that cover a URL: the suffixes of its host, and the host with each prefix of its path."""
    host = host_of(url)
    labels = F.split(host, "[.]")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    path = F.filter(F.split(F.regexp_extract(url, r"^[^:]*://[^/?#]*([^?#]*)", 1), "/"), lambda s: s != "")
    prefixes = F.when(F.size(path) > 0, F.transform(F.sequence(F.lit(1), F.size(path)), lambda i: F.concat(host, F.lit("/"), F.array_join(F.slice(path, F.lit(1), i), "/"))))
    return F.when(host != "", F.concat(suffixes, F.coalesce(prefixes, F.array().cast("array<string>")))).otherwise(F.array().cast("array<string>"))


def intervals(entries: DataFrame) -> DataFrame:
    """``entries(pattern, action, since)`` -> ``(pattern, since, until)`` while the pattern is on the list.

    The latest entry up to a day decides; of one day's entries a removal does.
    ``until`` is excluded, and null if no entry follows. Rows with a null are left out.
    """
    window = Window.partitionBy("pattern").orderBy("since", "action")
    known = entries.select("pattern", "action", "since").dropna().withColumn("until", F.lead("since").over(window))
    return known.where("action = 'add' and (until is null or until > since)").select("pattern", "since", "until")


def filter_urls(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """``captures(id, url, fetched)`` -> ``id, listed, n_entries, entry``, a row per capture.

    ``n_entries`` counts the active patterns that cover the URL and ``entry`` is
    the longest (of equal lengths the first in order). Hosts are compared without
    case, paths with it. A null URL or day, or a URL without a host, is never
    listed. Rows that repeat an id each get a row. Other columns are ignored.
    """
    scratch = Scratch(captures.sparkSession, "urls")
    rows = scratch.table(captures.select(F.monotonically_increasing_id().alias("row"), "id", "url", "fetched"), "captures")
    span = rows.agg(F.min("fetched").alias("low"), F.max("fetched").alias("high")).first()
    known = rows.where("fetched is not null and url is not null")
    offered = known.select("row", "fetched", F.explode(F.array_distinct(keys_of(F.col("url")))).alias("pattern")).withColumn("month", _month(F.col("fetched")))
    active = intervals(entries).where(F.col("since") <= F.lit(span.high)).withColumn("first", F.greatest(_month(F.col("since")), _month(F.lit(span.low))))
    active = active.withColumn("last", F.least(_month(F.coalesce(F.date_sub("until", 1), F.lit(span.high))), _month(F.lit(span.high)))).where("first <= last")
    active = scratch.table(active.select("pattern", "since", "until", F.explode(F.sequence("first", "last")).alias("month")), "active")
    # keys that many captures offer, such as a common suffix, are few: what the list has of them is broadcast, the rest goes unseen
    key = ["pattern", "month"]
    counts = scratch.table(offered.groupBy(key).agg(F.count("*").alias("n")), "counts")
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    hot = F.broadcast(counts.where(F.col("n") > max(1, int(total * HOT_SHARE))).select(key))
    joined = offered.join(F.broadcast(active.join(hot, key)), key).unionByName(offered.join(hot, key, "left_anti").join(active, key))
    joined = joined.where("fetched >= since and (until is null or fetched < until)")
    best = F.min(F.struct(-F.char_length("pattern"), F.col("pattern").alias("pattern"))).alias("best")
    each = rows.select("row", "id").join(joined.groupBy("row").agg(F.count("*").alias("n_entries"), best), "row", "left")
    n = F.coalesce("n_entries", F.lit(0))
    return each.select("id", (n > 0).alias("listed"), n.cast("long").alias("n_entries"), F.col("best.pattern").alias("entry"))


def sample_list(pages: DataFrame) -> DataFrame:
    """A dated list over the hosts in ``pages``: added, removed and added again on days given by the host's md5."""
    hosts = pages.select(host_of(F.col("url")).alias("host")).where("host <> ''").distinct()
    hosts = hosts.withColumn("x", F.conv(F.substring(F.md5("host"), 1, 6), 16, 10).cast("long"))
    day = lambda n: F.date_add(F.lit("2023-01-01").cast("date"), (F.col("x") % 600 + n).cast("int"))
    row = lambda pattern, action, n, when: F.when(when, F.struct(pattern.alias("pattern"), F.lit(action).alias("action"), day(n).alias("since")))
    host, x = F.col("host"), F.col("x")
    under = F.concat("host", F.lit("/en"))
    logs = F.array(row(host, "add", 0, x % 2 == 0), row(host, "remove", 90, x % 4 == 0), row(host, "add", 200, x % 8 == 0), row(under, "add", 30, x % 3 == 0), row(under, "remove", 31, x % 9 == 0))
    return hosts.select(F.explode(F.filter(logs, lambda e: e.isNotNull())).alias("e")).select("e.*")


def op8_url_filters(spark, sf_dir: str) -> DataFrame:
    """``filter_urls`` of all ``pages`` against ``sample_list``, fetched on days given by their ids."""
    pages = table(spark, sf_dir, "pages")
    captures = pages.select(F.col("page_id").alias("id"), "url", F.date_add(F.lit("2023-01-01").cast("date"), (F.col("page_id") * 37 % 730).cast("int")).alias("fetched"))
    found = filter_urls(captures, sample_list(pages))
    return found.select(F.col("id").alias("page_id"), "listed", "n_entries", F.coalesce("entry", F.lit("")).alias("entry"))


OP8_SQL = r"""
with p as (
  select page_id, date '2023-01-01' + cast(page_id * 37 % 730 as integer) as fetched,
    regexp_extract(lower(url), '^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]*?)\.?(?::[0-9]*)?(?:[/?#]|$)', 1) as host,
    list_filter(string_split(regexp_extract(url, '^[^:]*://[^/?#]*([^?#]*)', 1), '/'), lambda s: s <> '') as path
  from pages
),
h as (select host, cast('0x' || substr(md5(host), 1, 6) as bigint) as x from (select distinct host from p where host <> '')),
log as (
  select host as pattern, 'add' as action, date '2023-01-01' + cast(x % 600 as integer) as since from h where x % 2 = 0
  union all select host, 'remove', date '2023-01-01' + cast(x % 600 + 90 as integer) from h where x % 4 = 0
  union all select host, 'add', date '2023-01-01' + cast(x % 600 + 200 as integer) from h where x % 8 = 0
  union all select host || '/en', 'add', date '2023-01-01' + cast(x % 600 + 30 as integer) from h where x % 3 = 0
  union all select host || '/en', 'remove', date '2023-01-01' + cast(x % 600 + 31 as integer) from h where x % 9 = 0
),
k as (
  select page_id, fetched, array_to_string(labels[i:], '.') as pattern from (select page_id, fetched, string_split(host, '.') as labels, unnest(range(1, len(string_split(host, '.')) + 1)) as i from p where host <> '')
  union all
  select page_id, fetched, host || '/' || array_to_string(path[1:i], '/') from (select page_id, fetched, host, path, unnest(range(1, len(path) + 1)) as i from p where host <> '')
),
hit as (
  select page_id, pattern from (
    select page_id, k.pattern, action, row_number() over (partition by page_id, k.pattern order by since desc, action desc) as r
    from k join log on k.pattern = log.pattern and since <= fetched
  ) where r = 1 and action = 'add'
)
select p.page_id, count(pattern) > 0 as listed, count(pattern) as n_entries, coalesce(arg_min(pattern, (-length(pattern), pattern)), '') as entry
from p left join hit using (page_id) group by p.page_id
"""
