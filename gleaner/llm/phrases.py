"""Phrase collocations.

All 1- to ``max_n``-grams become rows, are counted per language by hash
aggregation, and phrases that occur often enough are scored by their prefixes
and suffixes, thinned by an anti-join with their one-word extensions, and
ranked in windows.

A phrase cannot occur more often than any part of it. So the rows are made in
passes of growing length, and an n-gram is left out if one of its parts of the
pass before does not reach the least count: such rows could never become
candidates, nor parts of one. Parts are looked up in a bit table of bounded
size, which can only err by letting an n-gram through; whatever passes is
counted exactly.

The extension step needs no more than one word: a longer candidate that
contains the phrase also contains an extension by one word which is at least as
frequent as itself, and so is a candidate that drops the phrase as well.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from string import ascii_lowercase, ascii_uppercase

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from gleaner.llm.common import Scratch, join_counted, table

MAX_N, LEAST, SHARE, TOP = 4, 30, 80, 2000
FACTOR = 2_000_000
#: Characters of text that a task counts at a time, if no single text is longer.
CHUNK = 8 << 20
#: Bits of the table of frequent parts for each of them, and its least and largest size (16 MB) as powers of two.
BITS_EACH, BITS = 64, (20, 27)

#: Lower-cases A-Z, turns a tab into a space and the ends of pieces into a byte that UTF-8 never has.
_END = b"\xff"
_BYTES = bytes.maketrans(ascii_uppercase.encode() + b"\t.,;:!?\n\x0b\x0c\r", ascii_lowercase.encode() + b" " + _END * 10)


def _tokens(texts: list[str]) -> Iterator[bytes]:
    """Words of all pieces in order, with an end between any two pieces."""
    for t in texts:
        # no white space but the space is left, so that alone is what a split goes by
        yield from t.encode("utf-8", "surrogatepass").translate(_BYTES).replace(_END, b" " + _END + b" ").split()
        yield _END


def _joined(names: pa.Array, ids: np.ndarray, starts: np.ndarray, length: int) -> pa.Array:
    """The words from each start on, with spaces between."""
    return pc.binary_join_element_wise(*[names.take(pa.array(ids[starts + j])) for j in range(length)], " ") if length > 1 else names.take(pa.array(ids[starts]))


#: Odd numbers that mix the hashes of words by their places in a part.
_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], np.uint64)


def _word_hashes(lang: str, words: list[bytes]) -> np.ndarray:
    seed = xxhash.xxh64_intdigest(lang.encode("utf-8", "surrogatepass"), 42)
    return np.fromiter((xxhash.xxh64_intdigest(w, seed) for w in words), np.uint64, len(words))


def _mixed(columns: list[np.ndarray]) -> np.ndarray:
    """A hash of the words of each part, from those of the words."""
    out = np.zeros(len(columns[0]), np.uint64)
    for j, c in enumerate(columns):
        out = (out ^ (out >> np.uint64(29))) * _MIX[j % 4] + c
    return out ^ (out >> np.uint64(32))


def _bits(table: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether a bit table may hold the parts with the hashes."""
    h = hashes & np.uint64(len(table) * 64 - 1)
    return (table[(h >> np.uint64(6)).astype(np.int64)] >> (h & np.uint64(63))) & np.uint64(1) > 0


def _codes(ids: np.ndarray, places: np.ndarray, length: int, many: int) -> np.ndarray:
    """A number for the n-gram at each place, equal for equal ones; numbers that would pass 63 bits are counted through anew."""
    code, bound = ids[places], many
    for j in range(1, length):
        if bound * many >= 1 << 63:
            distinct, code = np.unique(code, return_inverse=True)
            bound = len(distinct)
        code, bound = code * many + ids[places + j], bound * many
    return code


def _count(lang: str, texts: list[str], lengths: tuple[int, ...], table: np.ndarray | None) -> Iterator[tuple[int, pa.Array, np.ndarray]]:
    """The distinct n-grams of each of the successive ``lengths`` with their counts: ``(length, phrases, counts)``.

    Of lengths above 1 they are those whose parts of one word less than the first length are all in the table.
    """
    words: dict[bytes, int] = {_END: 0}
    ids = np.fromiter((words.setdefault(w, len(words)) for w in _tokens(texts)), np.int64)
    listed, many = list(words), len(words)
    del words
    names = pa.array([b"", *listed[1:]], pa.binary()).cast(pa.string())
    if lengths[0] == 1:
        n = np.bincount(ids, minlength=many)[1:]
        yield 0, pa.array([""]), np.array([n.sum()])
        yield 1, names.slice(1), n
        return
    size = lengths[0] - 1
    hashes, n_parts = _word_hashes(lang, listed)[ids], max(0, len(ids) - size + 1)
    # parts of ``size`` words by their places: those that lie in a piece and may be frequent
    ok = _bits(table, _mixed([hashes[j : j + n_parts] for j in range(size)]))
    for j in range(size):
        ok &= ids[j : j + n_parts] > 0
    del hashes
    for length in lengths:
        ok = ok[:-1] & ok[1:]  # a gram of one word more is left if both of its parts are
        places = np.flatnonzero(ok)
        _, first, n = np.unique(_codes(ids, places, length, many), return_index=True, return_counts=True)
        yield length, _joined(names, ids, places[first], length), n


def _grams(lengths: tuple[int, ...], table, chunk: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows ``(lang, phrase, len, n)`` from ``(lang, text)``: the n-grams of each chunk of texts of a language. Length 0 has the number of words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = np.frombuffer(table.value, "<u8") if table is not None else None
        held: dict[str, list[str]] = {}
        sizes: dict[str, int] = {}

        def rows(lang: str) -> Iterator[pa.RecordBatch]:
            del sizes[lang]
            for length, phrases, n in _count(lang, held.pop(lang), lengths, known):
                whole = pa.record_batch([pa.array([lang]).take(pa.array(np.zeros(len(n), np.int32))), phrases, pa.array(np.full(len(n), length, np.int32)), pa.array(n, pa.int64())], names=["lang", "phrase", "len", "n"])
                yield from (whole.slice(at, 50_000) for at in range(0, len(n), 50_000))

        for batch in batches:
            for lang, text in zip(batch.column("lang"), batch.column("text"), strict=True):
                lang, text = lang.as_py(), text.as_py()
                held.setdefault(lang, []).append(text)
                sizes[lang] = sizes.get(lang, 0) + len(text)
                if sum(sizes.values()) >= chunk:
                    yield from rows(max(sizes, key=sizes.get))
        for lang in list(held):
            yield from rows(lang)

    return run


def _table(frequent: DataFrame) -> bytes:
    """A bit table of phrases, 64 bits of it a row: at most 2 ** 21 rows whatever the input, as few bits as ``BITS`` allows beyond that."""
    count = frequent.count()
    bits = min(max(BITS[0], (count * BITS_EACH).bit_length()), BITS[1])

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h = []
            for lang, phrase in zip(batch.column("lang").to_pylist(), batch.column("phrase").to_pylist(), strict=True):
                words = _word_hashes(lang, phrase.encode("utf-8", "surrogatepass").split(b" "))
                h.append(int(_mixed([words[j : j + 1] for j in range(len(words))])[0]) & ((1 << bits) - 1))
            yield pa.record_batch([pa.array([x >> 6 for x in h], pa.int64()), pa.array([x & 63 for x in h], pa.int32())], names=["at", "bit"])

    rows = frequent.select("lang", "phrase").mapInArrow(hashed, "at long, bit int")
    rows = rows.groupBy("at").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("word")).toPandas()
    out = np.zeros(1 << (bits - 6), np.uint64)
    out[rows["at"].to_numpy(np.int64)] = rows["word"].to_numpy(np.int64).view(np.uint64)
    return out.tobytes()


COUNTED = "lang string, phrase string, len int, a bigint"


def frequent_phrases(docs: DataFrame, scratch: Scratch, max_n: int = MAX_N, least: int = LEAST, lang_col: str = "lang", text_col: str = "text", chunk: int = CHUNK) -> DataFrame:
    """``lang, phrase, len, a`` of the phrases of up to ``max_n`` words that occur ``least`` times or more; length 0 has the number of all words of a language."""
    texts = docs.select(F.coalesce(lang_col, F.lit("und")).alias("lang"), F.coalesce(text_col, F.lit("")).alias("text"))
    passes = [(1,), (2,), tuple(range(3, max_n + 1))][: min(max_n, 3)]
    known = None
    for k, lengths in enumerate(passes):
        if k:
            parts = scratch.parts("counted", COUNTED).where(f"part = {k - 1} and len > 0")
            known = docs.sparkSession.sparkContext.broadcast(_table(parts))
        found = texts.mapInArrow(_grams(lengths, known, chunk), "lang string, phrase string, len int, n bigint")
        found = found.groupBy("lang", "phrase", "len").agg(F.sum("n").alias("a")).where(f"a >= {least} or len = 0")
        scratch.add(found, "counted", k)
    return scratch.parts("counted", COUNTED).drop("part")


def _part(first: Column | int, length: Column) -> Column:
    return F.array_join(F.slice("words", first, length), " ")


def collocations(docs: DataFrame, max_n: int = MAX_N, least: int = LEAST, share: int = SHARE, top: int = TOP, lang_col: str = "lang", text_col: str = "text", chunk: int = CHUNK) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the best phrases of each language.

    A phrase of 2 to ``max_n`` words that occurs ``least`` times or more is a
    candidate. Its score is floor(2000000 * a / (l + r)) at the cut where that is least, the
    first such cut, with the counts ``l`` and ``r`` of the two sides; in decimals,
    so it is exact at any size. Candidates that lie in a longer one with ``share`` percent of their
    count drop out. Ties go by count, then by phrase in byte order. A null language is
    ``und``; null, empty and wordless texts have no phrases; repeated rows count
    as often as they occur; an empty table gives an empty result. Other columns are ignored.
    """
    scratch = Scratch(docs.sparkSession, "phrases")
    counted = frequent_phrases(docs, scratch, max_n, least, lang_col, text_col, chunk)
    key = lambda phrase: F.struct(F.col("lang"), phrase)
    chosen = counted.where("len > 1").withColumn("words", F.split("phrase", " "))
    cuts = chosen.select("lang", "phrase", "a", "words", F.explode(F.sequence(F.lit(1), F.col("len") - 1)).alias("k"))
    cuts = scratch.table(cuts.select("lang", "phrase", "a", "k", key(_part(1, F.col("k"))).alias("left"), key(_part(F.col("k") + 1, F.size("words") - F.col("k"))).alias("right")), "cuts")
    known = counted.where("len > 0")
    for side, n in (("left", "l"), ("right", "r")):
        # a word begins or ends many phrases: such keys are broadcast, the rest are shuffled
        used = cuts.groupBy(side).agg(F.count("*").alias("used"))
        sizes = known.select(F.struct("lang", "phrase").alias(side), F.col("a").alias(n)).join(used, side)
        cuts = scratch.table(join_counted(cuts, scratch.table(sizes, f"{side}-sizes"), side, "used"), f"{side}-known")
    score = F.expr(f"(cast({FACTOR} as decimal(7,0)) * cast(a as decimal(20,0))) div (cast(l as decimal(20,0)) + cast(r as decimal(20,0)))")
    best = cuts.withColumn("score", score).groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    sides = F.array(_part(1, F.size("words") - 1), _part(2, F.size("words") - 1))
    longer = chosen.where("len > 2").select("lang", "a", F.explode(F.array_distinct(sides)).alias("phrase")).groupBy("lang", "phrase").agg(F.max("a").alias("most"))
    held = (F.col("most").cast("decimal(20,0)") * 100) >= (F.col("a").cast("decimal(20,0)") * share)
    best = best.join(longer.withColumnsRenamed({"lang": "_lang", "phrase": "_phrase"}), (F.col("lang") == F.col("_lang")) & (F.col("phrase") == F.col("_phrase")) & held, "left_anti")
    best = best.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))
    ranked = best.withColumn("rank", rank).where(F.col("rank") <= top)
    totals = counted.where("len = 0").select("lang", F.col("a").alias("n"))
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op13_phrase_collocations(spark, sf_dir: str) -> DataFrame:
    """``collocations`` of whole ``documents`` by ``lang``."""
    return collocations(table(spark, sf_dir, "documents"))


OP13_SQL = f"""
with p as (select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), '{ascii_uppercase}', '{ascii_lowercase}'), '[.,;:!?\x0A-\x0D]')) as piece from documents),
t as (select lang, regexp_extract_all(piece, '[^\x20\x09]+') as w from p),
g as materialized (
  select lang, k, array_to_string(w[i:i + k - 1], ' ') as phrase, count(*) as f
  from (select lang, w, unnest(range(1, len(w) + 1)) as i from t) cross join (select unnest(range(1, {MAX_N + 1})) as k) where i + k - 1 <= len(w) group by all),
c as materialized (select lang, phrase, k, f as a, string_split(phrase, ' ') as w from g where k > 1 and f >= {LEAST}),
cuts as (
  select c.lang, c.phrase, a, j, l.f as l, r.f as r, ({FACTOR}::hugeint * a) // (l.f + r.f) as score
  from (select *, unnest(range(1, k)) as j from c) c
  join g l on l.lang = c.lang and l.phrase = array_to_string(c.w[1:j], ' ') join g r on r.lang = c.lang and r.phrase = array_to_string(c.w[j + 1:c.k], ' ')),
best as (select * from (select *, row_number() over (partition by lang, phrase order by score, j) as nth from cuts) where nth = 1),
held as (select distinct s.lang, s.phrase from c s join c b on s.lang = b.lang and b.k > s.k and 100 * b.a >= {SHARE} * s.a and contains(' ' || b.phrase || ' ', ' ' || s.phrase || ' ')),
ranked as (select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from best anti join held using (lang, phrase))
select lang, rank, phrase, a, l, r, n, cast(score as bigint) as score
from ranked join (select lang, cast(sum(f) as bigint) as n from g where k = 1 group by lang) using (lang) where rank <= {TOP}
"""
