"""Quality rules by weak supervision.

Each rule looks at counts of a whole text and votes that it is good, that it is
bad, or abstains. No rule decides by itself: for each rule
expectation-maximisation estimates how often it votes good on good and on bad
texts, over the votes of all documents and without labels, and a document is
kept if the posterior probability that it is good is 0.5 or more.

Documents meet the estimation as counts of their vote patterns: one row for
each combination of votes, so a bounded table whatever the number of
documents, and exactly what the estimation needs of them.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from gleaner.llm.common import Scratch, table

#: Words that texts in English, French, German and Spanish can hardly do without.
COMMON = (
    "the of and to in that is was with for "
    "le la les et des une dans pour que est "
    "der die und das ein von mit den zu ist "
    "el los las una del con por en de y"
).split()
SYMBOLS, ENDS = "#*$%&|<>", ".!?"
SPAN = 5

COUNTS = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_lettered", "n_ends", "n_upper", "n_digits", "n_common"]


@dataclass(frozen=True)
class Rule:
    """SQL conditions over the counts, the same in Spark and elsewhere; the rule votes good if the first holds, else bad if the second does."""

    name: str
    good: str
    bad: str


RULES = [
    Rule("length", "n_words >= 50", "n_words < 20"),
    Rule("word_length", "word_chars between 4 * n_words and 7 * n_words", "word_chars < 3 * n_words or word_chars > 10 * n_words"),
    Rule("symbols", "100 * n_symbols <= n_words", "10 * n_symbols > n_words"),
    Rule("letters", "100 * n_lettered >= 95 * n_words", "100 * n_lettered < 80 * n_words"),
    Rule("sentence_ends", "100 * n_ends >= 4 * n_words", "100 * n_ends < 2 * n_words"),
    Rule("upper_case", "10 * n_upper <= word_chars", "10 * n_upper > 3 * word_chars"),
    Rule("digits", "10 * n_digits <= word_chars", "10 * n_digits > 3 * word_chars"),
    Rule("common_words", "20 * n_common >= n_words", "50 * n_common < n_words"),
    Rule("repetition", "20 * n_repeat_words <= n_words", "100 * n_repeat_words > 15 * n_words"),
    Rule("lines", "n_dup_lines = 0", "5 * n_dup_lines > n_lines"),
]
#: Rounds of the estimation. Where it starts, and what every rule counts beforehand: of so many votes on
#: good and as many on bad texts those that say good. A bad text is taken to pass half of the rules.
ROUNDS, AHEAD, ON_GOOD, ON_BAD = 50, 10, 9, 5


def _table(chars: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars)] = True
    return out


_SPACE, _END = _table(b" \t\n\r\x0b\x0c"), _table(ENDS.encode())
#: First bytes of letters: A-Z, a-z, and whatever stands at U+00C0 or above.
_LETTER = _table(bytes([*range(65, 91), *range(97, 123), *range(0xC3, 0x100)]))
_COMMON = {w.encode() for w in COMMON}


def _repeated(ids: np.ndarray, span: int = SPAN) -> int:
    """Words inside windows of ``span`` words that occur twice or more; windows are numbered word by word, so equal numbers are equal windows."""
    n = len(ids) - span + 1
    if n < 2:
        return 0
    code = ids[:n]
    for j in range(1, span):
        code = np.unique(code * (int(ids.max()) + 1) + ids[j : j + n], return_inverse=True)[1]
    hit = np.bincount(code)[code] > 1
    edge = np.zeros(len(ids) + 1, np.int64)
    edge[:n] += hit
    edge[span : span + n] -= hit
    return int((np.cumsum(edge)[:-1] > 0).sum())


def measure(text: str | None) -> tuple[int, ...]:
    """The counts of a text, in the order of ``COUNTS``; all 0 for a null or wordless one."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.split()  # at space and 09 to 0D, no other bytes
    if not words:
        return (0,) * len(COUNTS)
    a = np.frombuffer(raw, np.uint8)
    by = np.bincount(a, minlength=256)
    space = _SPACE[a]
    starts = np.flatnonzero(~space & np.concatenate(([True], space[:-1])))
    ends = np.flatnonzero(~space & np.concatenate((space[1:], [True])))
    lines = [x for x in raw.split(b"\n") if x and not x.isspace()]
    known: dict[bytes, int] = {}
    ids = np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words))
    return (
        len(words),
        int(len(a) - by[0x80:0xC0].sum() - space.sum()),
        int(by[list(SYMBOLS.encode())].sum()),
        len(lines),
        len(lines) - len(set(lines)),
        _repeated(ids),
        int(np.logical_or.reduceat(_LETTER[a], starts).sum()),
        int(_END[a[ends]].sum()),
        int(by[65:91].sum()),
        int(by[48:58].sum()),
        sum(map(_COMMON.__contains__, words)),
    )


def counts(text: Column) -> Column:
    """A struct of the counts of a text."""

    @F.pandas_udf(", ".join(f"{c} long" for c in COUNTS))
    def run(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([measure(t) for t in texts], columns=COUNTS, dtype="int64")

    return run(text)


def vote(rule: Rule) -> Column:
    """1 for good, -1 for bad, 0 for an abstention; all rules abstain on texts without words."""
    return F.expr(f"cast(case when n_words = 0 then 0 when {rule.good} then 1 when {rule.bad} then -1 else 0 end as int)")


@dataclass
class LabelModel:
    """``prior``: the share of good texts. ``on_good``, ``on_bad``: how often each rule that votes at all votes good, on good and on bad texts."""

    prior: float
    on_good: np.ndarray
    on_bad: np.ndarray

    def posterior(self, good: np.ndarray, bad: np.ndarray) -> np.ndarray:
        z = np.log(self.prior / (1 - self.prior)) + good @ np.log(self.on_good / self.on_bad) + bad @ np.log((1 - self.on_good) / (1 - self.on_bad))
        return 1 / (1 + np.exp(-z))

    def column(self, votes: list[Column]) -> Column:
        """The posterior as one expression over the votes."""
        z = F.lit(float(np.log(self.prior / (1 - self.prior))))
        for v, g, b in zip(votes, self.on_good, self.on_bad, strict=True):
            z = z + F.when(v > 0, float(np.log(g / b))).when(v < 0, float(np.log((1 - g) / (1 - b)))).otherwise(0.0)
        return 1 / (1 + F.exp(-z))


def estimate(patterns: np.ndarray, n: np.ndarray, rounds: int = ROUNDS) -> LabelModel:
    """Expectation-maximisation over vote patterns, each of which ``n`` documents have.

    Every rule counts ``AHEAD`` votes of each class beforehand, of which ``ON_GOOD`` and
    ``ON_BAD`` say good, and the first model has those rates and an even prior; so no
    estimate is 0 or 1, and without documents they are what it gives.
    """
    good, bad = (patterns > 0).astype(float), (patterns < 0).astype(float)

    def step(post: np.ndarray) -> LabelModel:
        p, q = n * post, n * (1 - post)
        on_good = (good.T @ p + ON_GOOD) / ((good + bad).T @ p + AHEAD)
        on_bad = (good.T @ q + ON_BAD) / ((good + bad).T @ q + AHEAD)
        return LabelModel(float((p.sum() + 1) / (n.sum() + 2)), on_good, on_bad)

    model = LabelModel(0.5, np.full(patterns.shape[1], ON_GOOD / AHEAD), np.full(patterns.shape[1], ON_BAD / AHEAD))
    for _ in range(rounds):
        model = step(model.posterior(good, bad))
    return model


def quality_rules(docs: DataFrame, rules: list[Rule] = RULES, rounds: int = ROUNDS) -> DataFrame:
    """``doc_id``, the counts, ``votes`` (a struct with a vote for each rule), ``base_failed``, ``quality`` (the posterior) and ``kept``, a row per document.

    A text fails the base rules with fewer than 10 words, or with more than a fifth
    of its words in windows of five words that it repeats; it isn't kept then,
    whatever its posterior. Null, empty and wordless texts have no counts, no votes
    but the prior as posterior, and fail. A posterior of 0.5 is enough. Repeated rows each count and
    each get a row; null ids too. An empty table gives an empty result; other
    columns are ignored.
    """
    scratch = Scratch(docs.sparkSession, "weakrules")
    counted = docs.select("doc_id", counts(F.col("text")).alias("c")).select("doc_id", "c.*")
    counted = scratch.table(counted.select("*", F.struct(*[vote(r).alias(r.name) for r in rules]).alias("votes")), "counted")
    names = [r.name for r in rules]
    seen = counted.groupBy(*[F.col(f"votes.{x}").alias(x) for x in names]).agg(F.count("*").alias("_n")).toPandas()  # three to the power of the rules at most
    model = estimate(seen[names].to_numpy(float).reshape(-1, len(names)), seen["_n"].to_numpy(float), rounds)
    failed = F.expr("n_words < 10 or 100 * n_repeat_words > 20 * n_words")
    scored = counted.withColumn("base_failed", failed).withColumn("quality", model.column([F.col(f"votes.{x}") for x in names]))
    return scored.withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= 0.5))


def op11_quality_rules(spark, sf_dir: str) -> DataFrame:
    """``quality_rules`` of whole ``documents``."""
    found = quality_rules(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def _sql() -> str:
    """The same in DuckDB: lists and windows for the counts, a recursive table of one row a round for the estimation."""
    k = range(len(RULES))
    votes = ", ".join(f"case when n_words = 0 then 0 when {r.good} then 1 when {r.bad} then -1 else 0 end as v{j}" for j, r in enumerate(RULES))
    first = ", ".join(f"cast({ON_GOOD / AHEAD} as double) as g{j}, cast({ON_BAD / AHEAD} as double) as b{j}" for j in k)
    step = ["(sum(n * q) + 1) / (sum(n) + 2) as prior"]
    for j in k:
        step.append(f"(sum(case when v{j} > 0 then n * q else 0 end) + {ON_GOOD}) / (sum(case when v{j} <> 0 then n * q else 0 end) + {AHEAD}) as g{j}")
        step.append(f"(sum(case when v{j} > 0 then n * (1 - q) else 0 end) + {ON_BAD}) / (sum(case when v{j} <> 0 then n * (1 - q) else 0 end) + {AHEAD}) as b{j}")
    z = "ln(prior / (1 - prior)) + " + " + ".join(f"case when v{j} > 0 then ln(g{j} / b{j}) when v{j} < 0 then ln((1 - g{j}) / (1 - b{j})) else 0 end" for j in k)
    return f"""
with recursive d as materialized (select row_number() over () as id, doc_id, coalesce(text, '') as t, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') as w from documents),
win as (select id, i, array_to_string(w[i:i + {SPAN - 1}], ' ') as g from (select id, w, unnest(range(1, len(w) - {SPAN - 2})) as i from d where len(w) > {SPAN})),
rep as (select id, count(distinct p) as n_repeat_words from (select id, unnest(range(i, i + {SPAN})) as p from (select id, i, count(*) over (partition by id, g) as k from win) where k > 1) group by id),
lines as (select id, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) as l from d),
c as materialized (
  select id, doc_id, cast(len(w) as bigint) as n_words, cast(length(array_to_string(w, '')) as bigint) as word_chars,
    cast(case when len(w) = 0 then 0 else len(regexp_extract_all(t, '[{SYMBOLS}]')) end as bigint) as n_symbols, cast(len(l) as bigint) as n_lines,
    cast(len(l) - len(list_distinct(l)) as bigint) as n_dup_lines, cast(coalesce(n_repeat_words, 0) as bigint) as n_repeat_words,
    len(list_filter(w, lambda x: regexp_matches(x, '[A-Za-z\\x{{C0}}-\\x{{10FFFF}}]'))) as n_lettered, len(list_filter(w, lambda x: right(x, 1) in ({', '.join(f"'{e}'" for e in ENDS)}))) as n_ends,
    len(regexp_extract_all(t, '[A-Z]')) as n_upper, len(regexp_extract_all(t, '[0-9]')) as n_digits,
    len(list_filter(w, lambda x: x in ({', '.join(f"'{x}'" for x in COMMON)}))) as n_common
  from d join lines using (id) left join rep using (id)),
v as materialized (select *, {votes} from c),
pat as materialized (select {', '.join(f'v{j}' for j in k)}, cast(count(*) as double) as n from v group by {', '.join(f'v{j}' for j in k)}),
em as (
  select 0 as round, cast(0.5 as double) as prior, {first}
  union all
  select round + 1 as round, {', '.join(step)} from (select pat.*, round, 1 / (1 + exp(-({z}))) as q from pat, em where round < {ROUNDS}) group by round),
last as (select * from em where round = {ROUNDS})
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, not base_failed and {z} >= 0 as kept
from (select *, n_words < 10 or 100 * n_repeat_words > 20 * n_words as base_failed from v), last
"""


OP11_SQL = _sql()
