"""A bounded sample of labelled documents to fit a classifier on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def held_out(doc_id: Column, folds: int, fold: int) -> Column:
    """Whether crc32 of the id as text falls into the held-out fold; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % folds == fold, F.lit(False))


def training_sample(docs: DataFrame, labels: DataFrame, label_col: str, folds: int, fold: int, rows: int) -> DataFrame:
    """``(text, label)`` of at most ``rows`` labelled documents outside the held-out fold.

    They are those with the least hashes of their ids, so the sample is a fixed
    random one. Null labels and ids are left out; an id that repeats counts once,
    with its largest label and, in ``docs``, one of its rows.
    """
    known = labels.where(F.col(label_col).isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"), folds, fold))
    known = known.groupBy("doc_id").agg(F.max(label_col).cast("int").alias("label"))
    # ``rows`` rows of two numbers: safe to broadcast
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    joined = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    return joined.groupBy("doc_id").agg(F.min("text").alias("text"), F.min("label").alias("label")).select("text", "label")
