"""Toxicity scores by a factorization machine over hashed terms.

Terms are a text's distinct words (lower-cased A-Z) and the words' prefixes of
four to eight bytes, which carry inflected forms, hashed into ``BUCKETS``. The
machine adds to each term's weight the inner products of term vectors, so pairs
of terms (an insult and whom it is aimed at) count beyond their parts.

Fitting takes a bounded sample; scoring is one Arrow pass over whole texts.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from gleaner.llm.common import Scratch, fresh, table
from gleaner.llm.labelled import held_out, training_sample

BUCKETS = 1 << 24
#: Labelled rows to fit on, at most.
SAMPLE_ROWS = 12_000
#: Terms with a weight, at most: those that most exceed their expected share of label 1 in the sample.
TERMS = 1024
FACTORS = 4
#: Bytes of the word prefixes that count as terms, longest first.
PREFIXES = (8, 7, 6, 5, 4)
FOLDS, FOLD = 5, 0

_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


def terms(text: str | None) -> set[int]:
    """Hashed terms of a whole text; none for a null or wordless one."""
    words = set(_WORD.findall((text or "").encode("utf-8", "surrogatepass").lower()))
    out = {crc32(w) for w in words}
    for n in PREFIXES:
        words = {w[:n] for w in words if len(w) >= n}
        out.update(crc32(w, n) for w in words)
    return {h % BUCKETS for h in out}


@dataclass
class Machine:
    """index: term -> row of ``w`` and ``v``."""

    bias: float
    index: dict[int, int]
    w: np.ndarray
    v: np.ndarray

    def score(self, text: str | None) -> float:
        rows = sorted(i for i in map(self.index.get, terms(text)) if i is not None)
        v = self.v[rows]
        z = self.bias + self.w[rows].sum() + 0.5 * float((v.sum(axis=0) ** 2 - (v**2).sum(axis=0)).sum())
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def fit_machine(rows: list[np.ndarray], label: np.ndarray, n_terms: int, seed: int = 7, steps: int = 250, rate: float = 0.05, penalty: float = 2e-4) -> tuple[float, np.ndarray, np.ndarray]:
    """Full-batch Adam on the logistic loss; rows: each document's term rows."""
    rng = np.random.default_rng(seed)
    doc = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    term = np.concatenate(rows) if len(doc) else np.zeros(0, int)
    theta = np.concatenate([rng.normal(0, 0.01, n_terms * FACTORS), np.zeros(n_terms + 1)])
    theta[-1] = -1.0
    m, s = np.zeros_like(theta), np.zeros_like(theta)
    weight = 0.5 * np.where(label == 1, 1 / label.sum(), 1 / (len(label) - label.sum()))  # both classes count alike
    for t in range(1, steps + 1):
        v, w, b = theta[: n_terms * FACTORS].reshape(n_terms, FACTORS), theta[n_terms * FACTORS : -1], theta[-1]
        x = v[term]
        sums = np.stack([np.bincount(doc, x[:, f], len(rows)) for f in range(FACTORS)], axis=1)
        z = b + np.bincount(doc, w[term], len(rows)) + 0.5 * ((sums**2).sum(axis=1) - np.bincount(doc, (x**2).sum(axis=1), len(rows)))
        g = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - label) * weight
        each = g[doc]
        gv = np.stack([np.bincount(term, each * (sums[doc, f] - x[:, f]), n_terms) for f in range(FACTORS)], axis=1) + penalty * v
        grad = np.concatenate([gv.ravel(), np.bincount(term, each, n_terms) + penalty * w, [g.sum()]])
        m, s = 0.9 * m + 0.1 * grad, 0.999 * s + 0.001 * grad**2
        theta = theta - rate * (m / (1 - 0.9**t)) / (np.sqrt(s / (1 - 0.999**t)) + 1e-8)
    return float(theta[-1]), theta[n_terms * FACTORS : -1], theta[: n_terms * FACTORS].reshape(n_terms, FACTORS)


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", rows: int = SAMPLE_ROWS, n_terms: int = TERMS) -> Machine:
    """Fits on at most ``rows`` labelled rows outside the held-out fold.

    Without both classes in the sample the score is a constant: the smoothed
    share of label 1, and 0 where there are no labels at all.
    """
    scratch = Scratch(docs.sparkSession, "toxicity")

    @F.pandas_udf("array<long>")
    def hashed(texts: pd.Series) -> pd.Series:
        return pd.Series([sorted(terms(t)) for t in texts])

    sample = training_sample(docs, labels, label_col, FOLDS, FOLD, rows)
    sample = scratch.table(sample.select("label", hashed("text").alias("terms")).withColumn("row", F.monotonically_increasing_id()), "sample")
    n, ones = sample.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0))).first()
    if not ones or ones == n:
        share = (ones + 1) / (n + 2) if n else 0.0
        return Machine(float(np.log(max(share, 1e-9) / max(1 - share, 1e-9))), {}, np.zeros(0), np.zeros((0, FACTORS)))
    each = sample.select("label", F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("n"), F.sum("label").alias("ones"))
    expected = F.col("n") * float(ones / n)
    surprise = (F.col("ones") - expected) ** 2 / (expected + 3)
    best = [r.term for r in each.where((F.col("n") > 1) & (F.col("ones") > expected)).orderBy(surprise.desc(), "term").limit(n_terms).select("term").collect()]  # n_terms numbers at most
    index = {t: i for i, t in enumerate(best)}
    chosen = docs.sparkSession.createDataFrame([(t,) for t in best] or [(-1,)], "term long")
    pairs = sample.select("row", F.explode("terms").alias("term")).join(F.broadcast(chosen), "term").groupBy("row").agg(F.collect_list("term").alias("terms"))
    got = sample.select("row", "label").join(pairs, "row", "left").orderBy("row").toPandas()  # SAMPLE_ROWS rows of chosen terms
    found = [np.array(sorted(index[t] for t in x) if x is not None else [], int) for x in got.terms]
    bias, w, v = fit_machine(found, got.label.to_numpy(float), len(best))
    return Machine(bias, index, w, v)


def score_column(model: Machine, text: Column | str) -> Column:
    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series([model.score(t) for t in texts], dtype="float64")

    return score(text)


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted``, a row per document.

    Null and empty texts have the score of no terms; a score of 0.5 counts as
    label 1. Rows that repeat an id each
    get a row; a null id isn't held out. Other columns are ignored.
    """
    model = fit(docs, labels)
    scored = docs.select("doc_id", held_out(F.col("doc_id"), FOLDS, FOLD).alias("held_out"), score_column(model, "text").alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op2_toxicity(spark, sf_dir: str) -> DataFrame:
    """``toxicity`` of whole ``documents``, learnt from ``labels`` outside the held-out fifth."""
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def keep_clean(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Documents with a score below 0.5, with all their columns."""
    (score,) = fresh(docs, "score")
    return docs.withColumn(score, score_column(fit(docs, labels), "text")).where(F.col(score) < 0.5).select(docs.columns)
