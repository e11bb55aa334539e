"""Line deduplication by a deletion-neighbourhood join, within one edit.

Two lines are within one edit iff they are equal, agree once the character at
one common position is deleted from both (a substitution), or one is the other
with a character deleted. So every candidate line emits hashed keys for its
deletion variants: (length, position, variant) for substitutions, and
(length, variant) for deletions, which the shorter line meets with its whole
text. Equal keys are joined, each line with the earliest member of its key
alone, so no group is ever expanded into pairs; pairs are verified by their
edit distance.

Variants are emitted only where a partner can be. A line within one edit of
another shares with it either half, and then all but one of ``SEGMENTS``
segments; both filters are exact, and leave the few lines and the few positions
for which variants are made.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from gleaner.llm.common import Scratch, fresh, id_key, table

SEGMENTS = 8
#: Shorter lines, such as numbers and labels, are replaced by equal ones alone.
NEAR_CHARS = 20
#: Line hashes that are broadcast at most (8 bytes each); more are joined by shuffle.
BROADCAST_ROWS = 1_000_000
_PRIME, _BASE = (1 << 61) - 1, 0x1B873593CC9E2D51


def _lines(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, at, line) of all lines that aren't blank; ``line`` without spaces around it."""
    rows = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), F.posexplode(F.split("text", "\n")).alias("at", "line"))
    return rows.select("doc_id", "text_hash", "at", F.trim("line").alias("line")).where("line <> ''").withColumn("h", F.xxhash64(F.lit(1), "line"))


def _halves(line: Column) -> Column:
    """Keys of both halves, cut as for this line's length and as for a line longer by one."""
    n = F.char_length(line)
    mid, up = F.floor(n / 2).cast("int"), F.floor((n + 1) / 2).cast("int")
    part = lambda level, side, text: F.xxhash64(level, F.lit(side), text)
    return F.array(
        part(n, 1, line.substr(F.lit(1), mid)), part(n, 2, line.substr(mid + 1, n)), part(n + 1, 1, line.substr(F.lit(1), up)), part(n + 1, 2, F.when(n > 0, line.substr(F.greatest(up, F.lit(1)), n)))
    )


def _shared(keyed: DataFrame, *columns: str) -> DataFrame:
    """Rows of ``keyed(key, h, ...)`` whose key has more than one h."""
    several = keyed.groupBy("key").agg(F.min("h").alias("a"), F.max("h").alias("b")).where("a <> b").select("key")
    return keyed.join(several, "key", "left_semi").select("h", *columns)


def _bounds(n: int) -> list[int]:
    return [i * n // SEGMENTS for i in range(SEGMENTS + 1)]


def segment_keys(line: str) -> Iterator[tuple[int, int, int]]:
    """(key, level, segment): all but one segment, for this length (level 0) and one more (level 1)."""
    for level in (0, 1):
        n = len(line) + level
        b = _bounds(n)
        for i in range(SEGMENTS):
            if b[i] < b[i + 1]:
                rest = line[: b[i]] + "\0" + line[b[i + 1] - level :]
                yield xxhash.xxh64_intdigest(f"{n} {i} {rest}".encode("utf-8", "surrogatepass")) - (1 << 63), level, i


def _mix(*parts: int) -> int:
    return xxhash.xxh64_intdigest(repr(parts).encode()) - (1 << 63)


def variant_keys(line: str, places: list[tuple[int, int]]) -> Iterator[tuple[int, int]]:
    """(key, role) of the deletion variants at the (level, segment) places.

    Roles: 0 substitution, 1 a line that loses a character, 2 the line that is left.
    Variants are hashed in constant time each, from the hashes of all prefixes.
    """
    n = len(line)
    prefix, power = array("q", [0]), array("q", [1])
    for c in map(ord, line):
        prefix.append((prefix[-1] * _BASE + c + 1) % _PRIME)
        power.append(power[-1] * _BASE % _PRIME)
    if any(level for level, _ in places):
        yield _mix(1, n + 1, prefix[n]), 2
    b = _bounds(n)
    for level, i in sorted(set(places)):
        if level == 0:
            for p in range(b[i], b[i + 1]):
                rest = (prefix[n] - prefix[p + 1] * power[n - p - 1]) % _PRIME
                variant = (prefix[p] * power[n - p - 1] + rest) % _PRIME
                yield _mix(0, n, p, variant), 0
                yield _mix(1, n, variant), 1


def _emit_segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out: list[tuple[int, int, int, int]] = []
        for h, line in zip(batch["h"].to_pylist(), batch["line"].to_pylist(), strict=True):
            out += [(key, h, level, i) for key, level, i in segment_keys(line)]
        yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out) if out else ((),) * 4, (pa.int64(), pa.int64(), pa.int32(), pa.int32()), strict=True)], ["key", "h", "level", "segment"])


def _emit_variants(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["key", "role", "h", "doc_id", "text_hash", "at"]

    def made(rows: list, kind: pa.DataType) -> pa.RecordBatch:
        kinds = (pa.int64(), pa.int32(), pa.int64(), kind, pa.int64(), pa.int32())
        return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows) if rows else ((),) * 6, kinds, strict=True)], names)

    for batch in batches:
        out: list[tuple] = []
        cols = [batch[c].to_pylist() for c in ("line", "places", "h", "doc_id", "text_hash", "at")]
        for line, places, *own in zip(*cols, strict=True):
            for key, role in variant_keys(line, [divmod(x, SEGMENTS) for x in places]):
                out.append((key, role, *own))
                if len(out) >= 50_000:
                    yield made(out, batch["doc_id"].type)
                    out = []
        yield made(out, batch["doc_id"].type)


def near_earlier(docs: DataFrame, firsts: DataFrame, scratch: Scratch, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """(h) of the distinct lines that an earlier distinct line within one edit replaces.

    ``firsts(h, first, keys)``: each distinct line's first place and half keys.
    """
    halves = firsts.select("h", F.explode("keys").alias("key"))
    chosen = scratch.table(_shared(halves).distinct(), "chosen")
    chosen = F.broadcast(chosen) if chosen.count() <= broadcast_rows else chosen
    texts = _lines(docs).select("h", "line").join(chosen, "h", "left_semi").groupBy("h").agg(F.first("line").alias("line"))
    texts = scratch.table(texts, "texts")
    keyed = texts.mapInArrow(_emit_segments, "key long, h long, level int, segment int")
    places = _shared(scratch.table(keyed, "segments"), "level", "segment").distinct()
    places = places.groupBy("h").agg(F.collect_list(F.col("level") * SEGMENTS + F.col("segment")).alias("places"))  # 16 at most
    lines = scratch.table(texts.join(places, "h").join(firsts.select("h", "first.*"), "h"), "lines")
    variants = scratch.table(lines.repartition("h").mapInArrow(_emit_variants, f"key long, role int, h long, doc_id {dict(lines.dtypes)['doc_id']}, text_hash long, at int"), "variants")
    place = F.struct("doc_id", "text_hash", "at", "h")
    leads = variants.groupBy("key", "role").agg(F.min(place).alias("lead"))
    # a substitution looks to substitutions, the longer line to the shorter one and back
    leads = leads.select("key", F.expr("case role when 1 then 2 when 2 then 1 else 0 end").alias("role"), "lead")
    pairs = variants.join(leads, ["key", "role"]).where(F.col("lead") < place).select("h", F.col("lead.h").alias("other")).where("h <> other").distinct()
    text = lines.select("h", "line")
    pairs = pairs.join(text, "h").join(text.select(F.col("h").alias("other"), F.col("line").alias("other_line")), "other")
    return pairs.where(F.levenshtein("line", "other_line", 1).between(0, 1)).select("h").distinct()


def line_dedup(docs: DataFrame, broadcast_rows: int = BROADCAST_ROWS, near_chars: int = NEAR_CHARS) -> DataFrame:
    """``docs`` with each text less the lines that an earlier one, equal or within one edit, replaces.

    Within one edit counts between lines of ``near_chars`` characters or more.

    Adds ``n_lines`` and ``n_dropped``. A line is compared without the spaces
    around it; it comes earlier by (doc_id, hash of the text, line number), nulls
    first, and goes if an earlier distinct line is within one edit, kept or not.
    Blank lines stay. Rows that repeat an id and a text are one document and come
    out alike. A null text has no lines and stays null. An empty table gives an
    empty result. Other columns pass through, whatever their names.
    """
    scratch = Scratch(docs.sparkSession, "lines")
    base = docs.select("doc_id", "text")
    keys = F.when(F.char_length("line") >= near_chars, _halves(F.col("line"))).otherwise(F.array().cast("array<bigint>"))
    made = _lines(base).withColumn("keys", keys)
    firsts = scratch.table(made.groupBy("h").agg(F.min(F.struct("doc_id", "text_hash", "at")).alias("first"), F.first("keys").alias("keys")), "firsts")
    gone = scratch.table(near_earlier(base, firsts, scratch, broadcast_rows), "gone")
    id_col, hash_col, kept_col, lines_col = fresh(docs, "id", "text_hash", "kept", "lines")
    kept = firsts.select("h", "first.*").join(gone, "h", "left_anti").groupBy("doc_id", "text_hash").agg(F.collect_list("at").alias(kept_col))
    kept = kept.select(id_key("doc_id").alias(id_col), F.col("text_hash").alias(hash_col), kept_col)
    rows = docs.withColumn(id_col, id_key("doc_id")).withColumn(hash_col, F.xxhash64("text")).join(scratch.table(kept, "kept"), [id_col, hash_col], "left")
    rows = rows.withColumn(lines_col, F.split("text", "\n")).withColumn(kept_col, F.coalesce(kept_col, F.array().cast("array<int>")))
    lines = F.col(lines_col)
    blank = F.filter(F.sequence(F.lit(0), F.size(lines) - 1), lambda i: F.trim(lines[i]) == "")
    rows = rows.withColumn(kept_col, F.when(lines.isNotNull(), F.array_sort(F.concat(kept_col, blank))))
    n = F.when(lines.isNull(), 0).otherwise(F.size(lines))
    new = F.when(lines.isNotNull(), F.concat_ws("\n", F.transform(kept_col, lambda i: lines[i])))
    out = [new.alias("text") if c == "text" else F.col(f"`{c}`") for c in docs.columns]
    return rows.select(*out, n.cast("long").alias("n_lines"), (n - F.when(lines.isNull(), 0).otherwise(F.size(kept_col))).cast("long").alias("n_dropped"))


def op4_line_dedup(spark, sf_dir: str) -> DataFrame:
    """``line_dedup`` of whole ``documents``, the texts as digests."""
    found = line_dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"))


OP4_SQL = f"""
with l as (
  select doc_id, i, trim(lines[i]) as line
  from (select doc_id, lines, unnest(range(1, len(lines) + 1)) as i from (select doc_id, string_split(text, chr(10)) as lines from documents where text is not null))
),
f as (select line, length(line) as n, min((doc_id, i)) as first from l where line <> '' group by line),
k as (
  select line, n, first, n as level, 'p' || substring(line, 1, n // 2) as key from f where n >= {NEAR_CHARS}
  union all select line, n, first, n, 's' || substring(line, n // 2 + 1) from f where n >= {NEAR_CHARS}
  union all select line, n, first, n + 1, 'p' || substring(line, 1, (n + 1) // 2) from f where n >= {NEAR_CHARS}
  union all select line, n, first, n + 1, 's' || substring(line, greatest((n + 1) // 2, 1)) from f where n >= {NEAR_CHARS}
),
p as (
  select distinct a.line as line, b.line as other, a.n as n, b.n as m
  from k a join k b using (level, key) where a.line <> b.line and b.first < a.first
),
gone as (
  select distinct line from p where
    (n = m and len(list_filter(range(1, n + 1), lambda i: substring(line, i, 1) <> substring(other, i, 1))) = 1)
    or (n = m + 1 and len(list_filter(range(1, n + 1), lambda i: substring(line, 1, i - 1) || substring(line, i + 1) = other)) > 0)
    or (m = n + 1 and len(list_filter(range(1, m + 1), lambda i: substring(other, 1, i - 1) || substring(other, i + 1) = line)) > 0)
),
keep as (
  select l.doc_id, l.i from l left join f using (line) where l.line = '' or ((l.doc_id, l.i) = f.first and l.line not in (select line from gone))
),
t as (
  select d.doc_id, len(string_split(text, chr(10))) as n_lines, text,
    (select string_agg(string_split(d.text, chr(10))[k.i], chr(10) order by k.i) from keep k where k.doc_id = d.doc_id) as kept,
    (select count(*) from keep k where k.doc_id = d.doc_id) as n_kept
  from documents d
)
select doc_id, cast(coalesce(n_lines, 0) as bigint) as n_lines, cast(coalesce(n_lines, 0) - n_kept as bigint) as n_dropped, sha256(coalesce(kept, '')) as text_sha256 from t
"""
