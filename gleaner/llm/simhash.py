"""SimHash near-duplicates by tiled exact comparison.

Fingerprints are made in Arrow batches. Distinct ones are dealt into tiles by
the population counts of their four 16-bit lanes; two fingerprints within
``radius`` bits differ by at most ``radius`` in the sum of the lanes' count
differences, so all other tile pairs are skipped without a look. The tile pairs
that remain are compared whole with numpy's exclusive-or and bit counts.

Full cells are salted into tiles of bounded size, and each salt is a join key of
its own. Of each tile pair only edges enough to keep
its components are emitted, never all pairs, so a dense ball of near copies
stays linear in its size.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from gleaner.llm.common import Scratch, fresh, id_key, join_counted, table
from gleaner.llm.components import components

#: Fingerprints in a tile: a full cell is dealt out to about eight, within these bounds.
TILE, LARGEST_TILE = 4096, 65536
LANES = 4
_CHUNK = 1 << 16


def fingerprint(text: str | None, words: int = 3, seed: int = 42) -> int:
    """64-bit SimHash of a text's word shingles as a signed integer; 0 for a text without words."""
    tokens = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not tokens:
        return 0
    if len(tokens) < words:
        grams: Iterator[bytes] | list[bytes] = [b" ".join(tokens)]
        n = 1
    else:
        grams = map(b" ".join, zip(*(tokens[i:] for i in range(words))))
        n = len(tokens) - words + 1
    hashes = (xxhash.xxh64_intdigest(g, seed) for g in grams)
    ones, left = np.zeros(64, np.int64), n
    while left:
        take = min(left, _CHUNK)
        part = np.fromiter(hashes, np.uint64, take)
        ones += np.unpackbits(part.view(np.uint8).reshape(take, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        left -= take
    bits = np.packbits(2 * ones > n, bitorder="little")
    return int(bits.view(np.int64)[0])


def fingerprint_column(text, words: int = 3):
    @F.pandas_udf("long")
    def make(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t, words) for t in texts], dtype="int64")

    return make(text)


def _offsets(radius: int) -> list[int]:
    """Packed lane offsets within the radius, half of them: zero and those that are positive."""
    near = (d for d in product(range(-radius, radius + 1), repeat=LANES) if sum(map(abs, d)) <= radius)
    return sorted(x for d in near if (x := sum(v << (5 * i) for i, v in enumerate(d))) >= 0)


def forest(u: np.ndarray, v: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Fewer than ``n`` edges with the components of the edges (u, v) among n nodes: from each node to the least of its component."""
    label = np.arange(n)
    while True:
        low, new = np.minimum(label[u], label[v]), label.copy()
        for x in (u, v, label[u], label[v]):
            np.minimum.at(new, x, low)
        new = new[new]
        if (new == label).all():
            moved = np.nonzero(label != np.arange(n))[0]
            return moved, label[moved]
        label = new


def links(a: np.ndarray, b: np.ndarray, same: bool, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """A forest with the components of all pairs of a and b within the radius, as places in a, then b.

    Both hold a fingerprint to a row, a 64-bit word of it to a column.
    """
    a_words, b_words, n = np.ascontiguousarray(a.T), np.ascontiguousarray(b.T), len(a) + len(b)
    step = max(1, (1 << 18) // max(1, len(b)))
    u = v = np.empty(0, np.int64)
    # the same tile twice is one set of nodes
    shift = 0 if same else len(a)
    for i in range(0, len(a), step):
        apart = np.bitwise_count(a_words[0, i : i + step, None] ^ b_words[0, None, :]).astype(np.uint16)
        for x, y in zip(a_words[1:], b_words[1:], strict=True):
            apart += np.bitwise_count(x[i : i + step, None] ^ y[None, :])
        r, c = np.nonzero(apart <= radius)
        u, v = np.concatenate([u, r + i]), np.concatenate([v, c + shift])
        if len(u) > 4 * n:
            u, v = forest(u, v, n)
    return forest(u, v, n)


def _compare(words: int, radius: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = {n: (batch.column(n).values.to_numpy(), batch.column(n).offsets.to_numpy()) for n in ("a", "b", "fp_a", "fp_b")}
            for k, same in enumerate(batch.column("same").to_pylist()):
                x, y, fx, fy = (v[o[k] : o[k + 1]] for v, o in (flat[n] for n in ("a", "b", "fp_a", "fp_b")))
                i, j = links(fx.view(np.uint64).reshape(-1, words), fy.view(np.uint64).reshape(-1, words), same, radius)
                nodes = np.concatenate([x, y])
                keep = nodes[i] != nodes[j]
                if keep.any():
                    yield pa.record_batch({"u": pa.array(nodes[i][keep]), "v": pa.array(nodes[j][keep])})

    return run


def linked(nodes: DataFrame, offsets: list[int], scratch: Scratch, radius: int, words: int = 1) -> DataFrame:
    """``nodes(node, fp, cell)`` -> edges ``(u, v)`` with the components of all links within the radius.

    ``fp`` is an array of 64-bit words. Fingerprints within the radius must lie in
    cells that differ by one of the ``offsets`` (0 and positive ones; the other
    direction is met from the other side). The number of cells must be bounded.
    """
    size = F.greatest(F.lit(TILE), F.least(F.lit(LARGEST_TILE), F.col("n") / 8))
    cells = scratch.table(nodes.groupBy("cell").agg(F.count("*").alias("n")).select("cell", F.ceil(F.col("n") / size).cast("int").alias("salts")).coalesce(1), "cells")
    salted = nodes.join(F.broadcast(cells), "cell").withColumn("salt", F.pmod(F.xxhash64("node"), F.col("salts")).cast("int"))
    tiles = salted.groupBy("cell", "salt").agg(F.collect_list(F.struct("node", "fp")).alias("m"))
    tiles = scratch.table(tiles.select("cell", "salt", F.col("m.node").alias("ids"), F.flatten("m.fp").alias("fps")), "tiles")
    near = tiles.select("cell", "salt", F.col("ids").alias("a"), F.col("fps").alias("fp_a"), F.explode(F.array(*[F.lit(x) for x in offsets])).alias("off"))
    near = near.withColumn("to", F.col("cell") + F.col("off")).join(F.broadcast(cells.withColumnRenamed("cell", "to")), "to")
    near = near.withColumn("to_salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1))).where("off > 0 or salt <= to_salt")
    other = tiles.select(F.col("cell").alias("to"), F.col("salt").alias("to_salt"), F.col("ids").alias("b"), F.col("fps").alias("fp_b"))
    pairs = near.join(other, ["to", "to_salt"]).select("a", "b", "fp_a", "fp_b", F.expr("off = 0 and salt = to_salt").alias("same"))
    return pairs.mapInArrow(_compare(words, radius), "u long, v long")


def lane_cell(fp: Column) -> Column:
    """The population counts of a fingerprint's four lanes, five bits each; at most 17 ** LANES = 83,521 values."""
    cell = F.lit(0)
    for i in range(LANES):
        cell = cell + F.shiftleft(F.bit_count(F.shiftrightunsigned(fp, 16 * i).bitwiseAND(0xFFFF)), 5 * i)
    return cell


def _grouped(docs: DataFrame, id_col: str, text_col: str, words: int, radius: int) -> DataFrame:
    """(doc_id, text_hash, fp, component_id), a row per document."""
    scratch = Scratch(docs.sparkSession, "simhash")
    text = F.col(text_col)
    made = scratch.table(docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("text_hash"), fingerprint_column(text, words).alias("fp")), "documents")
    nodes = scratch.table(made.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count("*").alias("n")), "nodes")
    edges = linked(nodes.select(F.col("fp").alias("node"), F.array("fp").alias("fp"), lane_cell(F.col("fp")).alias("cell")), _offsets(radius), scratch, radius)
    found = components(edges, scratch).withColumnRenamed("node", "fp")
    # a root isn't a node of `found`; it stands for itself, as fingerprints without links do
    roots = scratch.table(nodes.join(found, "fp", "left").select("fp", "n", "least", F.coalesce("root", "fp").alias("root")), "roots")
    least = scratch.table(roots.groupBy("root").agg(F.min("least").alias("component_id"), F.count("*").alias("nodes")), "least")
    known = scratch.table(join_counted(roots, least, "root", "nodes").select("fp", "n", "component_id"), "known")
    return join_counted(made, known, "fp", "n")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3, radius: int = 2) -> DataFrame:
    """One row per document: id, signed fingerprint ``fp`` and ``component_id``.

    ``component_id`` is the least id that can be reached over links of at most
    ``radius`` differing bits. Null, empty and blank texts have fingerprint 0 and
    link like any other. Rows that repeat an id each get a row. Null ids are
    never a component's least id, unless it has no other: then it is null. An
    empty table gives an empty result; other columns are ignored.
    """
    return _grouped(docs, id_col, text_col, words, radius).select("doc_id", "fp", "component_id")


def op1_simhash_near_dedup(spark, sf_dir: str) -> DataFrame:
    """``near_duplicates`` of whole ``documents`` at three words and two bits, fingerprints in 16 hexadecimal digits."""
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, words: int = 3, radius: int = 2) -> DataFrame:
    """Of each group of linked documents the row with the least ``doc_id`` stays, see ``keep_least``."""
    return keep_least(docs, _grouped(docs, "doc_id", "text", words, radius))


def keep_least(docs: DataFrame, found: DataFrame) -> DataFrame:
    """Of each group in ``found(doc_id, text_hash, component_id)`` the row of ``docs`` with the least ``doc_id``, with all its columns.

    Of rows that repeat this id and its text one stays. A group of which no row
    has an id keeps a row for each of its texts.
    """
    scratch = Scratch(docs.sparkSession, "keep")
    key, text_hash, rank = fresh(docs, "key", "text_hash", "rank")
    kept = found.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(id_key("doc_id").alias(key), F.col("text_hash").alias(text_hash)).distinct()
    rows = docs.withColumn(key, id_key("doc_id")).withColumn(text_hash, F.xxhash64("text"))
    rows = rows.join(scratch.table(kept, "kept"), [key, text_hash], "left_semi")
    # the join has dealt and sorted rows by these columns already
    window = Window.partitionBy(key, text_hash).orderBy(text_hash)
    return rows.withColumn(rank, F.row_number().over(window)).where(F.col(rank) == 1).select(docs.columns)
