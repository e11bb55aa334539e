"""Benchmark decontamination by winnowing, with DataFrame functions only.

Both sides hash their words, hash every ``K`` consecutive word hashes, and keep
the least hash of every ``W`` consecutive ones. Any shared span of
``K + W - 1 = 10`` words then shares a kept hash at the same place, so the join
of kept hashes misses no window of ten words. Each hit is extended:
the windows of ten words around it are hashed whole, 128 bits of their word
hashes, and joined with the distinct windows of the benchmark. A window that many
items share, such as a template's, is one row; items come in last, by the sets
of items that windows stand for, so a document meets each set once.

Items of fewer than ten words are one window each; for the lengths that occur
(nine at most) documents also offer all their spans of that many words.
"""

from __future__ import annotations

from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame, functions as F

from gleaner.llm.common import Scratch, ascii_lower, fresh, id_key, table

WINDOW = 10
K = 5
W = WINDOW - K + 1
WORD = r"[0-9a-z\x{80}-\x{10FFFF}]+"
#: Largest fingerprints and windows of a benchmark that are broadcast, in bytes; larger ones are joined by shuffle.
BROADCAST_BYTES = 48 << 20


def words(text: Column) -> Column:
    """Lower-cases A-Z alone and takes the words; null has none."""
    return F.regexp_extract_all(ascii_lower(F.coalesce(text, F.lit(""))), F.lit(WORD), F.lit(0))


def _spans(n: Column, length: int, make, kind: str = "bigint") -> Column:
    """``make(i)`` for each start i of a span of that length among n; none if n is less."""
    return F.when(n >= length, F.transform(F.sequence(F.lit(0), n - length), make)).otherwise(F.array().cast(f"array<{kind}>"))


def _gram(hashes: Column, at: Column, length: int, salt: int | None = None) -> Column:
    return F.xxhash64(*([F.lit(salt)] if salt else []), *[F.get(hashes, at + j) for j in range(length)])


def _hashed(df: DataFrame, text: Column) -> DataFrame:
    """Adds word hashes ``h``, their number ``n``, gram hashes ``g`` and the places ``kept`` of the least of each window.

    Of equal hashes in a window the first is kept, on either side. Whoever explodes
    these arrays takes ``explode_outer``: for ``explode`` the optimizer infers a
    filter on the array and pushes it down with all the arrays that it comes from,
    each computed anew inside the next one's lambda.
    """
    df = df.select("*", words(text).alias("w")).select("*", F.transform("w", lambda x: F.xxhash64(x)).alias("h")).drop("w")
    df = df.select("*", F.size("h").alias("n")).select("*", _spans(F.col("n"), K, lambda i: _gram(F.col("h"), i, K)).alias("g"))
    df = df.select("*", _spans(F.size("g"), W, lambda i: F.least(*[F.get(F.col("g"), i + j) for j in range(W)])).alias("least"))

    def place(least: Column, i: Column) -> Column:
        out = i + (W - 1)
        for j in reversed(range(W - 1)):
            out = F.when(F.get(F.col("g"), i + j) == least, i + j).otherwise(out)
        return out

    return df.select("*", F.array_distinct(F.transform("least", place)).alias("kept")).drop("least")


def _window(words_: Column) -> list[Column]:
    """Two hashes of a window's word hashes."""
    return [F.xxhash64(F.lit(1), words_).alias("a"), F.xxhash64(F.lit(2), words_).alias("b")]


def _benchmark(bench: DataFrame, id_col: str, text_col: str, scratch: Scratch) -> tuple[DataFrame, DataFrame, DataFrame, list[int]]:
    """Kept hashes ``(fp)``; distinct windows ``(a, b, set)``; items of each set ``(set, item)``; and the lengths of short items."""
    items = bench.select(F.col(id_col).cast("string").alias("item"), F.col(text_col).alias("text"))
    items = scratch.table(_hashed(items, F.col("text")).where("n > 0").select("item", "h", "n", "g", "kept"), "items")
    long, short = items.where(F.col("n") >= WINDOW), items.where(F.col("n") < WINDOW)
    prints = long.select(F.explode_outer(F.transform("kept", lambda i: F.get(F.col("g"), i))).alias("fp")).where("fp is not null")
    lengths = sorted(r.n for r in short.select("n").distinct().collect())  # nine at most
    for x in lengths:
        prints = prints.union(short.where(F.col("n") == x).select(_gram(F.col("h"), F.lit(0), x, x).alias("fp")))
    whole = long.select("item", F.explode_outer(_spans(F.col("n"), WINDOW, lambda i: F.slice("h", i + 1, WINDOW), "array<bigint>")).alias("w")).union(short.select("item", "h"))
    windows = scratch.table(whole.select(*_window(F.col("w")), "item").distinct(), "windows")
    # windows of the same items share a set, named after the least of them
    mark = F.coalesce(F.xxhash64("item"), F.lit(0))
    each = windows.groupBy("a", "b").agg(F.count("*").alias("n"), F.bit_xor(mark).alias("x"), F.bit_xor(F.xxhash64(mark)).alias("y"))
    named = scratch.table(each.select("*", F.struct("a", "b").alias("w")).select("w", "n", "x", "y"), "each")
    least = named.groupBy("n", "x", "y").agg(F.min("w").alias("set"))
    named = scratch.table(named.join(least, ["n", "x", "y"]).select("w.*", "set"), "named")
    sets = windows.where("item is not null").join(named.where("a = set.a and b = set.b"), ["a", "b"]).select("set", "item")
    return scratch.table(prints.distinct(), "prints"), named, scratch.table(sets, "sets"), lengths


def _keys(lengths: list[int]) -> Column:
    """Integers for the places that a document offers, after -1 for the document itself: 16 * place + length of a short span."""
    places = [F.array(F.lit(-1)), F.transform("kept", lambda i: i * 16)]

    def short(length: int) -> Column:
        return _spans(F.col("n"), length, lambda i: i * 16 + length, "int")

    places += [short(x) for x in lengths]
    return F.concat(*places).alias("keys")


def _fingerprint(lengths: list[int]) -> Column:
    at = F.shiftright("key", 4)
    out = F.when(F.col("key") % 16 == 0, F.get(F.col("g"), at))
    for x in lengths:
        out = out.when(F.col("key") % 16 == x, _gram(F.col("h"), at, x, x))
    return F.when(F.col("key") >= 0, out)


def _first() -> Column:
    """Where the words start that a window with the kept hash can reach."""
    return F.greatest(F.shiftright("key", 4) - (W - 1), F.lit(0))


def _around() -> Column:
    return F.when(F.col("key") >= 0, F.slice("h", _first() + 1, 2 * WINDOW - K))


def _windows() -> Column:
    """Starts, sizes and hashes of the document's windows around a kept hash."""
    near, place = F.col("near"), F.shiftright("key", 4)

    def window(start: Column, size: Column) -> Column:
        words_ = F.slice(near, start - _first() + 1, size)
        return F.struct(start.alias("start"), size.alias("size"), *_window(words_))

    starts = F.filter(F.sequence(_first(), place), lambda i: i - _first() + WINDOW <= F.size(near))
    long = F.transform(starts, lambda i: window(i, F.lit(WINDOW)))
    return F.when(F.col("key") % 16 == 0, long).when(F.col("key") > 0, F.array(window(place, F.col("key") % 16)))


def decontaminate(
    docs: DataFrame,
    bench: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """One row per document: id, ``text_hash``, ``n_words``, ``n_hit`` and the sorted ``items`` (strings) with occurring windows.

    Null, empty and wordless texts have no words and no hits; such items have no
    window. Rows that repeat an id each get a row. An item without an id hits
    but isn't listed. Items that repeat an id count once. Either table may be empty.
    """
    scratch = Scratch(docs.sparkSession, "winnow")
    prints, known, sets, lengths = _benchmark(bench, item_id_col, item_text_col, scratch)
    small = 16 * prints.count() + 64 * known.count() <= broadcast_bytes
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("text_hash"), F.col(text_col).alias("text"))
    rows = _hashed(rows, F.col("text")).drop("text")
    ids = ["row", "doc_id", "text_hash", "n"]
    met = [F.collect_set(F.when(F.col("set").isNotNull(), F.struct("start", "size"))).alias("windows"), F.collect_set("set").alias("sets")]

    def windows(hits: DataFrame, *columns: str) -> DataFrame:
        hits = hits.select(*columns, "key", _around().alias("near")).select(*columns, "key", F.explode_outer(_windows()).alias("w"))
        return hits.select(*columns, "key", "w.*")

    if small:
        # explode, join, filter and the slice of near words are one generated stage: only rows of a hit are ever made
        keyed = rows.select(*ids, "h", "g", _keys(lengths)).select(*ids, "h", "g", F.explode_outer("keys").alias("key")).withColumn("fp", _fingerprint(lengths))
        hits = keyed.join(F.broadcast(prints.withColumn("print", F.lit(True))), "fp", "left").where("fp is null or print")
        hits = windows(hits, *ids).join(F.broadcast(known), ["a", "b"], "left").where("key < 0 or set is not null")
        each = hits.groupBy("row").agg(*[F.first(c).alias(c) for c in ids[1:]], *met)
    else:
        rows = scratch.table(rows, "words")
        keyed = rows.select("row", "h", "g", _keys(lengths)).select("row", "h", "g", F.explode_outer("keys").alias("key")).select("row", "key", _fingerprint(lengths).alias("fp"))
        matched = keyed.where("fp is not null").join(prints, "fp").select("row", "key")
        hits = windows(rows.select("row", "h").join(matched, "row"), "row").where("a is not null").join(known, ["a", "b"])
        each = rows.select(ids).join(hits.groupBy("row").agg(*met), "row", "left")
    covered = F.array_distinct(F.flatten(F.transform("windows", lambda x: F.sequence(x["start"], x["start"] + x["size"] - 1))))
    n_hit = F.coalesce(F.array_size(covered), F.lit(0)).cast("long")
    each = scratch.table(each.select("row", "doc_id", "text_hash", F.col("n").cast("long").alias("n_words"), n_hit.alias("n_hit"), "sets"), "each")
    listed = each.where("n_hit > 0").select("row", F.explode("sets").alias("set")).join(sets, "set").groupBy("row").agg(F.collect_set("item").alias("items"))
    found = each.join(listed, "row", "left")
    return found.select("doc_id", "text_hash", "n_words", "n_hit", F.sort_array(F.coalesce("items", F.array().cast("array<string>"))).alias("items"))


def op9_benchmark_decontamination(spark, sf_dir: str) -> DataFrame:
    """``decontaminate`` of whole ``documents`` by ``benchmark``, with its lists as digests."""
    found = decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def keep_uncontaminated(docs: DataFrame, bench: DataFrame) -> DataFrame:
    """Documents without a hit, with all their columns; rows without an id too."""
    key, text_hash = fresh(docs, "key", "text_hash")
    hit = decontaminate(docs, bench).where("n_hit > 0").select(id_key("doc_id").alias(key), F.col("text_hash").alias(text_hash)).distinct()
    hit = Scratch(docs.sparkSession, "hit").table(hit, "hit")
    return docs.withColumn(key, id_key("doc_id")).withColumn(text_hash, F.xxhash64("text")).join(hit, [key, text_hash], "left_anti").select(docs.columns)


_WORDS_SQL = f"regexp_extract_all(translate(coalesce(text, ''), '{ascii_uppercase}', '{ascii_lowercase}'), '{WORD}')"

OP9_SQL = f"""
with d as (select doc_id, {_WORDS_SQL} as w from documents),
b as (select item_id, {_WORDS_SQL} as w from benchmark),
bw as (
  select distinct item_id, n, array_to_string(w[i:i + n - 1], ' ') as win
  from (select item_id, w, least(len(w), {WINDOW}) as n, unnest(range(1, greatest(len(w) - {WINDOW - 1}, 1) + 1)) as i from b where len(w) > 0)
),
dw as (
  select doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') as win
  from (select doc_id, w, n, unnest(range(1, len(w) - n + 2)) as i from d, (select distinct n from bw) where len(w) >= n)
),
h as (select doc_id, i, n, item_id from dw join bw using (n, win)),
p as (select doc_id, count(distinct pos) as n_hit from (select doc_id, unnest(range(i, i + n)) as pos from h) group by doc_id),
t as (select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as items from (select distinct doc_id, cast(item_id as varchar) as item from h) group by doc_id)
select d.doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(n_hit, 0) as bigint) as n_hit, cast(coalesce(n_items, 0) as bigint) as n_items,
  sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join p using (doc_id) left join t using (doc_id)
"""
