"""Near copies at a least Jaccard similarity of word shingles: SimHash candidates, then an exact check.

A text's distinct shingles make a SimHash wide enough that sets at the least
similarity are all but sure to lie within the radius: ``WORDS_OF_64`` words, of
which two sets at 0.8 differ in 39 bits on average (deviation 6) and unrelated
ones in 128 (deviation 8). Tiles are compared as in ``simhash``; their cells are
the population count in steps and the size of the set in steps of 1.26, for sets
whose sizes differ by more than a quarter can't be similar.

What the candidates connect is checked by the whole sets. Members of a group of
candidates are dealt into blocks of bounded size by set size; blocks in reach
meet, each pair of them in a task of its own, and of the pairs that are similar
only edges enough for their components are emitted. Groups that fit into a block
together share one.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from gleaner.llm.common import Scratch, join_counted
from gleaner.llm.components import components
from gleaner.llm.simhash import forest, keep_least, linked

WORDS, LEAST = 5, 0.8
#: Width of the SimHash, in words of 64 bits, and the bits by which candidates may differ.
WORDS_OF_64, RADIUS = 4, 72
#: Shingles in a block of the exact check, and what a set counts at least, so that a block holds 2,048 sets at most.
BLOCK, LEAST_WEIGHT = 1 << 20, 512
#: Steps of the cells: the ratio of set sizes, and population counts.
_RATIO, _COUNTS = 1.26, 24
_CHUNK = 1 << 15


def shingle_set(text: str | None, words: int = WORDS) -> np.ndarray:
    """Sorted distinct hashes of a text's word shingles; a shorter text is one shingle, one without words has none."""
    tokens = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not tokens:
        return np.empty(0, np.uint64)
    grams = map(b" ".join, zip(*(tokens[i:] for i in range(words)))) if len(tokens) >= words else [b" ".join(tokens)]
    return np.unique(np.fromiter((xxhash.xxh64_intdigest(g) for g in grams), np.uint64))


def _mixed(x: np.ndarray, lane: int) -> np.ndarray:
    """A further hash of 64-bit hashes, another one for each lane."""
    x = x + np.uint64((lane * 0x9E3779B97F4A7C15) & ((1 << 64) - 1))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def sketch(shingles: np.ndarray, lanes: int = WORDS_OF_64) -> np.ndarray:
    """SimHash of a set in ``lanes`` 64-bit words: bits that are 1 in over half of the shingles' hashes."""
    ones = np.zeros(64 * lanes, np.int64)
    for i in range(0, len(shingles), _CHUNK):
        part = shingles[i : i + _CHUNK]
        bits = np.unpackbits(np.stack([_mixed(part, k) for k in range(lanes)], axis=1).view(np.uint8), axis=1, bitorder="little")
        # sums of 255 rows at most fit the bytes they are made of
        ones += np.add.reduceat(bits, np.arange(0, len(bits), 255), axis=0, dtype=np.uint8).sum(axis=0, dtype=np.int64)
    return np.packbits(2 * ones > len(shingles), bitorder="little").view(np.uint64)


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(0, len(batch), 500):
            yield batch.slice(i, 500)


def _set_id(a: np.ndarray) -> int:
    return xxhash.xxh64_intdigest(a.tobytes()) - (1 << 63)


def _lists(arrays: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, arrays)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.empty(0, np.int64), *(a.view(np.int64) for a in arrays)])))


def _sketched(words: int, lanes: int):
    """(doc_id, text_hash, s, n, fp) of each text: identifier, size and SimHash of its set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _parts(batches):
            sets = [shingle_set(t.as_py(), words) for t in part["text"]]
            cols = [part["doc_id"], part["text_hash"], pa.array(map(_set_id, sets), pa.int64()), pa.array(map(len, sets), pa.int32()), _lists([sketch(a, lanes) for a in sets])]
            yield pa.record_batch(cols, ["doc_id", "text_hash", "s", "n", "fp"])

    return run


def _whole(words: int):
    """(s, shingles) of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _parts(batches):
            sets = [shingle_set(t.as_py(), words) for t in part["text"]]
            yield pa.record_batch([pa.array(map(_set_id, sets), pa.int64()), _lists(sets)], ["s", "shingles"])

    return run


def similar(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, least: float = LEAST) -> np.ndarray:
    """Whether each set in ``left`` and each in ``right`` (places in ``sets``) are different ones with that Jaccard similarity."""
    share = Fraction(str(least))
    part, whole = share.numerator, share.denominator
    sizes = np.array([len(a) for a in sets], np.int64)
    flat, owner = np.concatenate([np.empty(0, np.uint64), *sets]), np.repeat(np.arange(len(sets)), sizes)
    _, code, count = np.unique(flat, return_inverse=True, return_counts=True)
    common = count[code] > 1
    kinds, code = np.unique(code[common], return_inverse=True)
    owner, order = owner[common], np.argsort(code, kind="stable")
    code, owner = code[order], owner[order]
    overlap = np.zeros((len(left), len(right)), np.float32)
    width = min(max(1, (1 << 22) // max(1, len(sets))), max(1, len(kinds)))
    for at in range(0, len(kinds), width):
        lo, hi = np.searchsorted(code, [at, at + width])
        held = np.zeros((len(sets), width), np.float32)
        held[owner[lo:hi], code[lo:hi] - at] = 1
        overlap += held[left] @ held[right].T
    found = (part + whole) * overlap.astype(np.int64) >= part * (sizes[left][:, None] + sizes[right][None, :])
    return found & (left[:, None] != right[None, :])


def _meet(least: float):
    """Edges among a meeting's sets: of a block's groups each within itself, or of two blocks of a group with each other."""

    def run(table: pa.Table) -> pa.Table:
        ids, roots, sides = (table[c].to_numpy() for c in ("s", "root", "side"))
        shingles = table["shingles"].combine_chunks()
        ends, values = shingles.offsets.to_numpy(), shingles.values.to_numpy().view(np.uint64)
        u, v = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        order = np.lexsort((ids, roots))
        for group in np.split(order, np.nonzero(np.diff(roots[order]))[0] + 1):
            sets = [values[ends[k] : ends[k + 1]] for k in group]
            place = np.arange(len(group))
            left, right = (place, place) if (sides[group] == 0).all() else (place[sides[group] == 1], place[sides[group] == 2])
            if not len(left) or not len(right) or len(group) < 2:
                continue
            i, j = np.nonzero(similar(sets, left, right, least))
            i, j = forest(left[i], right[j], len(group))
            u.append(ids[group][i])
            v.append(ids[group][j])
        return pa.table({"u": np.concatenate(u), "v": np.concatenate(v)})

    return run


def checked(members: DataFrame, texts: DataFrame, words: int, least: float, scratch: Scratch, block: int = BLOCK) -> DataFrame:
    """``members(s, n, root, text_hash)`` of groups of candidates -> edges ``(u, v)`` with the components of all similar pairs within a group.

    ``texts(text_hash, text)`` holds a text for each member.
    """
    sized = members.withColumn("weight", F.greatest(F.col("n"), F.lit(LEAST_WEIGHT)).cast("long")).withColumn("class", _size_class())
    groups = sized.groupBy("root", "class").agg(F.sum("weight").alias("weight")).withColumn("blocks", F.ceil(F.col("weight") / block).cast("int"))
    # classes are few, whatever the size of a group
    groups = groups.groupBy("root").agg(F.sum("weight").alias("total"), F.map_from_entries(F.collect_list(F.struct("class", "blocks"))).alias("blocks"))
    groups = scratch.table(groups, "groups")
    bins = max(1, math.ceil((groups.where(F.col("total") <= block).agg(F.sum("total")).first()[0] or 0) / block))

    def with_class(step: int):
        """Meetings with the blocks of the class ``step`` above: (class, block, other class, other block, side)."""
        n = F.coalesce(F.try_element_at("blocks", F.col("class") + step), F.lit(0))
        others = F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))

        def meeting(j):
            own, other = [F.col("class"), F.col("salt")], [F.col("class") + step, j]
            first = F.lit(True) if step > 0 else F.lit(False) if step < 0 else F.col("salt") <= j
            ends = [F.when(first, x).otherwise(y).alias(name) for name, x, y in zip(("a", "i", "b", "j"), own + other, other + own, strict=True)]
            side = F.when(F.lit(step == 0) & (F.col("salt") == j), 0).when(first, 1).otherwise(2)
            return F.struct(F.col("root").alias("bin"), *ends, side.alias("side"))

        return F.transform(others, meeting)

    dealt = join_counted(sized, groups.join(sized.groupBy("root").agg(F.count("*").alias("rows")), "root"), "root", "rows")
    own = F.try_element_at("blocks", F.col("class"))
    dealt = dealt.withColumn("salt", F.pmod(F.xxhash64("s"), own).cast("int"))
    alone = F.array(F.struct(F.pmod(F.xxhash64("root"), F.lit(bins)).alias("bin"), *[F.lit(-9).alias(c) for c in ("a", "i", "b", "j")], F.lit(0).alias("side")))
    dealt = dealt.withColumn("meetings", F.when(F.col("total") <= block, alone).otherwise(F.concat(*[with_class(k) for k in (-1, 0, 1)])))
    dealt = scratch.table(dealt.select("s", "root", "text_hash", "meetings"), "dealt")
    chosen = texts.join(dealt.select("text_hash").distinct(), "text_hash", "left_semi").dropDuplicates(["text_hash"]).select("text")
    sets = scratch.table(chosen.mapInArrow(_whole(words), "s long, shingles array<long>"), "sets")
    rows = dealt.join(sets, "s").select("s", "root", "shingles", F.explode("meetings").alias("m")).select("s", "root", "shingles", "m.*")
    return scratch.table(rows.groupBy("bin", "a", "i", "b", "j").applyInArrow(_meet(least), "u long, v long"), "links")


def _size_class():
    """Steps of the size of a set; sizes n and 0.8 n or more are in the same step or the next."""
    return F.when(F.col("n") == 0, -3).otherwise(F.floor(F.log(F.greatest(F.col("n"), F.lit(1)).cast("double")) / math.log(_RATIO))).cast("int")


def near_copies(docs: DataFrame, words: int = WORDS, least: float = LEAST, radius: int = RADIUS, lanes: int = WORDS_OF_64) -> DataFrame:
    """``doc_id, text_hash, component_id``, a row per document; ``component_id`` is the least id that links reach.

    Two texts link if the sets of their word shingles have a Jaccard similarity of
    ``least`` or more (0.8 or more, as the size steps are made for that). Null,
    empty and blank texts are alike. Rows that repeat an id each get a row. Null
    ids are a component's least id only where it has no other: then it is null. An
    empty table gives an empty result; other columns are ignored.
    """
    if least < 0.8:
        raise ValueError("the steps of set sizes are made for a similarity of 0.8 or more")
    scratch = Scratch(docs.sparkSession, "nearcopies")
    kind = dict(docs.dtypes)["doc_id"]
    texts = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    made = scratch.table(texts.mapInArrow(_sketched(words, lanes), f"doc_id {kind}, text_hash long, s long, n int, fp array<long>"), "documents")
    nodes = made.groupBy("s").agg(F.first("n").alias("n"), F.first("fp").alias("fp"), F.min("doc_id").alias("least"), F.min("text_hash").alias("text_hash"), F.count("*").alias("rows"))
    nodes = scratch.table(nodes, "nodes")
    counts = F.aggregate("fp", F.lit(0), lambda a, x: a + F.bit_count(x))
    steps = -(-radius // _COUNTS)
    cell = (_size_class() + 4) * 64 + F.floor(counts / _COUNTS).cast("int") + 16
    offsets = [*range(steps + 1), *range(64 - steps, 64 + steps + 1)]
    edges = linked(nodes.select(F.col("s").alias("node"), "fp", cell.alias("cell")), offsets, scratch, radius, lanes)
    groups = components(edges, scratch, "candidates")
    groups = scratch.table(groups.union(groups.select(F.col("root").alias("node"), "root").distinct()).withColumnRenamed("node", "s"), "candidates")
    members = groups.join(nodes.select("s", "n", "text_hash"), "s")
    found = components(checked(members, texts.select("text_hash", "text"), words, least, scratch), scratch).withColumnRenamed("node", "s")
    roots = scratch.table(nodes.select("s", "rows", "least").join(found, "s", "left").withColumn("root", F.coalesce("root", "s")), "roots")
    least_id = scratch.table(roots.groupBy("root").agg(F.min("least").alias("component_id"), F.count("*").alias("nodes")), "least")
    known = scratch.table(join_counted(roots, least_id, "root", "nodes").select("s", "rows", "component_id"), "known")
    return join_counted(made.select("s", "doc_id", "text_hash"), known, "s", "rows").select("doc_id", "text_hash", "component_id")


def keep_one(docs: DataFrame, words: int = WORDS, least: float = LEAST) -> DataFrame:
    """Of each group of near copies the row with the least ``doc_id`` stays, with all its columns; see ``simhash.keep_least``."""
    return keep_least(docs, near_copies(docs, words, least))
