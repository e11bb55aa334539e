"""Quality scores by a sparse rule ensemble over text statistics.

Statistics are Spark column expressions. Small regression trees are boosted on
a bounded sample, each path from a root is taken as a conjunctive rule, and a
lasso-penalised logistic regression picks rules and weighs them. What is left
is compiled back into one Spark column expression, so scoring runs in the JVM.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from gleaner.llm.common import table
from gleaner.llm.labelled import held_out, training_sample

#: Labelled rows to fit on, at most.
SAMPLE_ROWS = 12_000
FOLDS, FOLD = 3, 1


def statistics(text: Column) -> dict[str, Column]:
    """Named statistics of a whole text; all 0 for a null or empty one, except ``distinct_*``: 1."""
    text = F.coalesce(text, F.lit(""))
    count = lambda pattern: F.regexp_count(text, F.lit(pattern)).cast("double")
    chars = F.greatest(F.char_length(text), F.lit(1)).cast("double")
    words = F.filter(F.split(text, r"\s+"), lambda w: w != "")
    n_words = F.greatest(F.size(words), F.lit(1)).cast("double")
    lines = F.split(text, "\n")
    return {
        "chars": F.char_length(text).cast("double"),
        "words": F.size(words).cast("double"),
        "word_length": F.char_length(text) / n_words,
        "upper_share": count(r"\p{Lu}") / chars,
        "digit_share": count(r"\d") / chars,
        "symbol_share": count(r"[^\p{L}\p{N}\s.,;:!?'\"()-]") / chars,
        "pipe_rate": count(r"\|") / n_words,
        "bang_rate": count("!") / n_words,
        "stop_rate": count("[.]") / n_words,
        "comma_rate": count(",") / n_words,
        "distinct_words": F.when(F.size(words) > 0, F.size(F.array_distinct(words)) / n_words).otherwise(1.0),
        "distinct_lines": F.size(F.array_distinct(lines)) / F.size(lines),
        "line_length": F.char_length(text) / F.size(lines),
    }


#: (statistic, whether above, threshold)
Condition = tuple[str, bool, float]


@dataclass
class Ensemble:
    bias: float
    rules: list[tuple[tuple[Condition, ...], float]] = field(default_factory=list)

    def score(self, stats: dict[str, float]) -> float:
        z = self.bias + sum(w for rule, w in self.rules if all((stats[s] > t) == above for s, above, t in rule))
        return float(1 / (1 + np.exp(-z)))

    def column(self, stats: dict[str, Column]) -> Column:
        """The score as one expression over columns that hold the statistics."""
        z = F.lit(self.bias)
        for rule, weight in self.rules:
            held = F.lit(True)
            for s, above, t in rule:
                held = held & (stats[s] > t if above else stats[s] <= t)
            z = z + F.when(held, F.lit(weight)).otherwise(F.lit(0.0))
        return 1 / (1 + F.exp(-z))


def _split(x: np.ndarray, grad: np.ndarray, rows: np.ndarray, cuts: list[np.ndarray], least: int) -> tuple[float, int, float] | None:
    """Best (gain, column, threshold) for the squared error of grad."""
    best, total = None, grad[rows].sum()
    base = total**2 / len(rows)
    for j, c in enumerate(cuts):
        if not len(c):
            continue
        at = np.searchsorted(c, x[rows, j], side="left")  # 0: at most the first cut
        n = np.cumsum(np.bincount(at, minlength=len(c) + 1))[:-1]
        s = np.cumsum(np.bincount(at, grad[rows], minlength=len(c) + 1))[:-1]
        ok = (n >= least) & (len(rows) - n >= least)
        if ok.any():
            gain = np.where(ok, s**2 / np.maximum(n, 1) + (total - s) ** 2 / np.maximum(len(rows) - n, 1) - base, -1)
            k = int(gain.argmax())
            if gain[k] > 1e-9 and (best is None or gain[k] > best[0]):
                best = (float(gain[k]), j, float(c[k]))
    return best


def grow_rules(x: np.ndarray, y: np.ndarray, names: list[str], trees: int = 24, depth: int = 3, rate: float = 0.3, bins: int = 48, seed: int = 11) -> list[tuple[Condition, ...]]:
    """Paths of boosted trees, each tree on its own half of the rows."""
    rng = np.random.default_rng(seed)
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 2)[1:-1])) for j in range(x.shape[1])]
    z, rules = np.full(len(y), np.log((y.sum() + 1) / (len(y) - y.sum() + 1))), {}
    for _ in range(trees):
        grad = y - 1 / (1 + np.exp(-z))
        take = rng.random(len(y)) < 0.5
        stack: list[tuple[tuple[Condition, ...], np.ndarray]] = [((), np.ones(len(y), bool))]
        while stack:
            path, inside = stack.pop()
            rows = np.nonzero(inside & take)[0]
            cut = _split(x, grad, rows, cuts, max(3, len(y) // 400)) if len(path) < depth and len(rows) > 6 else None
            if path:
                rules[path] = None
            if cut:
                _, j, t = cut
                for above in (False, True):
                    stack.append(((*path, (names[j], above, t)), inside & ((x[:, j] > t) == above)))
            elif len(rows):
                z[inside] += rate * 4 * grad[rows].mean()
    return list(rules)


def lasso(a: np.ndarray, y: np.ndarray, penalty: float, steps: int = 600) -> tuple[float, np.ndarray]:
    """Logistic regression with an L1 penalty by accelerated proximal steps; the bias is free."""
    n = len(y)
    scale = np.maximum(a.std(axis=0), 0.02)
    b = np.hstack([a / scale, np.ones((n, 1))])
    step = 4 * n / max(np.linalg.norm(b, 2) ** 2, 1e-9)
    w = v = np.zeros(b.shape[1])
    t = 1.0
    for _ in range(steps):
        g = b.T @ (1 / (1 + np.exp(-(b @ v))) - y) / n
        new = v - step * g
        new[:-1] = np.sign(new[:-1]) * np.maximum(np.abs(new[:-1]) - step * penalty, 0)
        t2 = (1 + np.sqrt(1 + 4 * t * t)) / 2
        v, w, t = new + (t - 1) / t2 * (new - w), new, t2
    return float(w[-1]), w[:-1] / scale


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "quality", rows: int = SAMPLE_ROWS, penalty: float = 0.002) -> Ensemble:
    """Fits on at most ``rows`` labelled rows outside the held-out fold.

    Without both classes in the sample the score is a constant: the smoothed
    share of label 1, and 0.5 where there are no labels at all.
    """
    stats = statistics(F.col("text"))
    sample = training_sample(docs, labels, label_col, FOLDS, FOLD, rows).select("label", *[c.alias(n) for n, c in stats.items()]).toPandas()  # SAMPLE_ROWS rows of numbers
    sample = sample.sort_values(list(sample.columns))
    y, names = sample.label.to_numpy(float), list(stats)
    if not len(y) or y.min() == y.max():
        share = (y.sum() + 1) / (len(y) + 2)
        return Ensemble(float(np.log(share / (1 - share))))
    x = sample[names].to_numpy(float)
    rules = grow_rules(x, y, names)
    held = np.stack([np.all([(x[:, names.index(s)] > t) == above for s, above, t in rule], axis=0) for rule in rules], axis=1).astype(float)
    bias, w = lasso(held, y, penalty)
    return Ensemble(bias, [(rule, float(weight)) for rule, weight in zip(rules, w, strict=True) if abs(weight) > 1e-3])


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted``, a row per document.

    Null and empty texts are scored by their statistics, mostly 0; a score of 0.5
    counts as label 1, so without labels all do. Rows that
    repeat an id each get a row; a null id isn't held out. Other columns are
    ignored.
    """
    model = fit(docs, labels)
    used = {s for rule, _ in model.rules for s, _, _ in rule}
    stats = {n: c for n, c in statistics(F.col("text")).items() if n in used}
    measured = docs.select("doc_id", *[c.alias(n) for n, c in stats.items()])
    scored = measured.select("doc_id", held_out(F.col("doc_id"), FOLDS, FOLD).alias("held_out"), model.column({n: F.col(n) for n in stats}).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op10_quality_classifier(spark, sf_dir: str) -> DataFrame:
    """``quality`` of whole ``documents``, learnt from ``labels`` outside the held-out third."""
    return quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
