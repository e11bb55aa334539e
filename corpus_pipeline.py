"""The corpus pipeline: five stages of training-data operators over ``documents``.

Each stage takes all that its predecessor kept, as a written table. The first
four return the columns of ``documents``; the last returns a row of token
digests per document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from gleaner.llm import bpe, linededup, nearcopies, toxicity, winnow
from gleaner.llm.common import Scratch, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score 0.5 or more go."""
    return toxicity.keep_clean(docs, table(spark, sf_dir, "labels"))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts lose lines that an earlier line replaces; ``n_chars`` follows. Documents stay, if need be with an empty text."""
    out = linededup.line_dedup(docs)
    return out.select(*[F.char_length("text").cast(t).alias(c) if c == "n_chars" else c for c, t in docs.dtypes])


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: SimHash candidates with a Jaccard similarity of 0.8 or more of five-word shingles."""
    return nearcopies.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a window of a benchmark item go."""
    return winnow.keep_uncontaminated(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every text is encoded and decoded: ``doc_id, n_tokens, ids_sha256, decoded_sha256``."""
    return bpe.digests(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", dedup_lines),
    ("simhash_near_dedup", near_dedup),
    ("benchmark_decontamination", drop_contaminated),
    ("bpe", encode),
]

#: The classifier and the tokenizer can't be put in SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = scratch.table(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
