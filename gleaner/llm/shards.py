"""Sharding by balanced label propagation.

Documents with equal texts are linked. Labels start from hashes of the ids and
are counted for each group and shard, not kept for each document, so a group with
a third of all rows is one row. In every round a group that isn't settled is
drawn to the shard that holds most of its documents among those with room for the
whole of it (of equal ones a hash decides), or to any with room, and a shard
takes what is drawn to it up to its quota, large groups first; who finds no place
there is drawn elsewhere in the next round. Documents in shards that have no room for their group follow their
neighbours in the others: most of those stay where most were, so this is what being drawn
to the most frequent open shard amounts to, and labels need no rewriting. Rounds go on as long as one
settles anything; every round before the last settles a group for good, and in practice most of
those that are left. Groups larger than a shard fill whole
ones. Unlinked documents cost no edge wherever they are: they and the groups that
fit nowhere whole are placed last and fill all shards exactly, so the counts of
rows differ by one at most (law ``rows``).

Quotas need ranks among all rows. They are taken in two levels: sums over a
bounded number of buckets, which are broadcast, and windows within buckets; the
number of buckets grows with the rows.
"""

from __future__ import annotations

from functools import reduce
from itertools import count

from pyspark.sql import Column, DataFrame, Window, functions as F

from gleaner.llm.common import Scratch, table

SHARDS = 8
#: Parts of a group that are ranked apart, and buckets of the two-level sums, by rows: least, most, rows in each.
PARTS, BUCKETS = (64, 4096, 1 << 20), (256, 1 << 15, 1 << 18)


def _number(of: tuple[int, int, int], rows: int) -> int:
    least, most, each = of
    return max(least, min(most, rows // each))


def _before(df: DataFrame, groups: list[str], bucket: str, order: list[str], n: str, name: str) -> DataFrame:
    """Adds the sum of ``n`` over all rows before this one in its group, by (bucket, order).

    Groups times buckets must be bounded: their sums are broadcast.
    """
    sums = df.groupBy(*groups, bucket).agg(F.sum(n).alias("_sum"))
    window = Window.partitionBy(*groups or [F.lit(0)]).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(*groups, bucket, F.coalesce(F.sum("_sum").over(window), F.lit(0)).alias("_start"))
    within = Window.partitionBy(*groups, bucket).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    df = df.join(F.broadcast(sums), [*groups, bucket])
    return df.withColumn(name, F.col("_start") + F.coalesce(F.sum(n).over(within), F.lit(0))).drop("_start")


def _at(values: list[int], shard: Column) -> Column:
    return F.array(*[F.lit(v).cast("long") for v in values])[shard]


def _size_class(n: Column) -> Column:
    """Orders large groups first; 16 hash buckets to a class, 64 classes at most."""
    return ((63 - F.floor(F.log2(n))) * 16 + F.pmod(F.xxhash64("g"), F.lit(16))).cast("int")


def _propagate(groups: DataFrame, quota: list[int], scratch: Scratch) -> list[DataFrame]:
    """``groups(g, total, labels)`` of linked documents, with counts by shard -> tables ``(g, shard, n)`` of what each round settled, within the quotas."""
    room, settled = list(quota), []
    left = groups.withColumn("left", F.col("total"))
    for k in count():
        tie = lambda x: F.xxhash64("g", x, F.lit(k))
        fits = lambda x: _at(room, x) >= F.col("left")
        own = F.array_max(F.transform(F.filter("labels", lambda x: fits(x["shard"])), lambda x: F.struct(x["n"], tie(x["shard"]), x["shard"].alias("to"))))["to"]
        any_ = F.array_max(F.transform(F.filter(F.array(*[F.lit(s) for s in range(len(room))]), fits), lambda x: F.struct(tie(x), x.alias("to"))))["to"]
        large = F.col("total") > max(quota)
        widest = F.lit(max(range(len(room)), key=lambda s: room[s])) if max(room) else F.lit(None).cast("int")
        drawn = left.withColumn("to", F.coalesce(own, any_, F.when(large, widest)).cast("int")).where("to is not null").withColumn("class", _size_class(F.col("left")))
        drawn = _before(drawn, ["to"], "class", ["g"], "left", "start")
        free = F.greatest(F.lit(0), _at(room, F.col("to")) - F.col("start"))
        drawn = drawn.withColumn("take", F.when((F.col("left") <= free) | large, F.least(F.col("left"), free)).otherwise(0))
        drawn = scratch.table(drawn.select("g", "total", "labels", "left", "to", "take"), f"drawn-{k}")
        taken = {r["to"]: r["n"] for r in drawn.groupBy("to").agg(F.sum("take").alias("n")).collect()}  # a number for each shard
        settled.append(drawn.where("take > 0").select("g", F.col("to").alias("shard"), F.col("take").alias("n")))
        room = [r - taken.get(s, 0) for s, r in enumerate(room)]
        if not any(taken.values()):
            return settled
        left = drawn.where("left > take").select("g", "total", "labels", (F.col("left") - F.col("take")).alias("left"))


def shard(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """``doc_id, size, text_crc32, shard, slot``, a row per document.

    Equal texts are kept together as far as propagation finds room. Counts of rows in any two shards differ by one at most, and slots count from
    0 in each shard. A null text counts as an empty one, with size 1. Null and repeated ids are placed like others. An empty table gives an empty result;
    other columns are ignored.
    """
    scratch = Scratch(docs.sparkSession, "shards")
    text = F.coalesce("text", F.lit(""))
    made = docs.select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"), F.xxhash64(text).alias("g"))
    # rows without an id are told apart by their place
    key = F.when(F.col("doc_id").isNull(), F.xxhash64(F.monotonically_increasing_id())).otherwise(F.xxhash64(F.lit(1), "doc_id"))
    made = scratch.table(made.withColumn("key", key), "documents")
    total = made.count()
    parts_of, buckets = _number(PARTS, total), _number(BUCKETS, total)
    made = made.withColumn("part", F.pmod("key", F.lit(parts_of)).cast("int")).drop("key")
    parts = scratch.table(made.groupBy("g", "part").agg(F.count("*").alias("n")), "parts")
    quota = [total // shards + (s < total % shards) for s in range(shards)]
    groups = parts.groupBy("g").agg(F.sum("n").alias("total"))
    labels = parts.groupBy("g", (F.col("part") % shards).alias("shard")).agg(F.sum("n").alias("n"))
    labels = labels.groupBy("g").agg(F.sum("n").alias("total"), F.collect_list(F.struct("shard", "n")).alias("labels"))  # one for each shard at most
    settled = _propagate(scratch.table(labels.where("total > 1"), "linked"), quota, scratch)
    cells = scratch.table(reduce(DataFrame.union, settled).groupBy("g", "shard").agg(F.sum("n").alias("fits")), "settled")
    placed = {r.shard: r.n for r in cells.groupBy("shard").agg(F.sum("fits").alias("n")).collect()}
    room = [quota[s] - placed.get(s, 0) for s in range(shards)]
    ends = [sum(room[: s + 1]) for s in range(shards)]

    own = cells.groupBy("g").agg(F.array_sort(F.collect_list(F.struct("shard", "fits"))).alias("own"))  # one for each shard at most
    plan = groups.join(own, "g", "left").withColumn("own", F.coalesce("own", F.array().cast("array<struct<shard:int,fits:bigint>>")))
    plan = plan.withColumn("held", F.aggregate("own", F.lit(0).cast("long"), lambda a, x: a + x["fits"])).withColumn("bucket", F.pmod(F.xxhash64(F.lit(2), "g"), F.lit(buckets)).cast("int"))
    plan = scratch.table(plan.withColumn("free", F.col("total") - F.col("held")), "plan")
    plan = _before(plan, [], "bucket", ["g"], "free", "free_start").select("g", "own", "held", "free_start")

    window = Window.partitionBy("g").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    ranked = parts.select("g", "part", F.coalesce(F.sum("n").over(window), F.lit(0)).alias("part_start")).join(plan, "g")
    rank = F.col("part_start") + F.row_number().over(Window.partitionBy("g", "part").orderBy("doc_id", "text_crc32")) - 1
    rows = made.join(scratch.table(ranked, "ranked"), ["g", "part"]).withColumn("rank", rank)
    free = F.col("free_start") + F.col("rank") - F.col("held")
    filled = F.lit(shards - 1)
    for s in reversed(range(shards - 1)):
        filled = F.when(free < ends[s], F.lit(s)).otherwise(filled)
    # the group's own shards in turn, each for as many ranks as it holds of the group
    walk = F.aggregate(
        "own",
        F.struct(F.lit(-1).alias("shard"), F.lit(0).cast("long").alias("end")),
        lambda a, x: F.struct(F.when((a["shard"] < 0) & (F.col("rank") < a["end"] + x["fits"]), x["shard"]).otherwise(a["shard"]).alias("shard"), (a["end"] + x["fits"]).alias("end")),
    )["shard"]
    rows = rows.withColumn("shard", F.when(F.col("rank") < F.col("held"), walk).otherwise(filled).cast("int"))
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64("g", "rank"), F.lit(buckets)).cast("int")).withColumn("one", F.lit(1))
    rows = scratch.table(rows.select("doc_id", "size", "text_crc32", "g", "rank", "shard", "bucket", "one"), "rows")
    return _before(rows, ["shard"], "bucket", ["g", "rank"], "one", "slot").select("doc_id", "size", "text_crc32", "shard", "slot")


def op3_sharding(spark, sf_dir: str) -> DataFrame:
    """``shard`` of whole ``documents`` under the law ``rows``."""
    found = shard(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
