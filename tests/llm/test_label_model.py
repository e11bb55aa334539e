"""Quality rules against plain loops, label by label and vote by vote."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from gleaner.llm import weakrules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    words = WORD.findall(text or "")
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    inside = {j for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for j in range(i, i + 5)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": len(re.findall(r"[#*$%&|<>]", text or "")),
        "n_lines": len(lines),
        "n_dup_lines": sum(x in lines[:i] for i, x in enumerate(lines)),
        "n_repeat_words": len(inside),
        "n_lettered": sum(bool(re.search("[A-Za-zÀ-\U0010ffff]", w)) for w in words),
        "n_ends": sum(w[-1] in ".!?" for w in words),
        "n_upper": len(re.findall("[A-Z]", "".join(words))),
        "n_digits": len(re.findall("[0-9]", "".join(words))),
        "n_common": sum(w in weakrules.COMMON for w in words),
    }


def texts(seed=3, n=300):
    rng = random.Random(seed)
    words = ["the", "of", "und", "Maison", "été", "12", "a|b", "x#", "end.", "no!", " ", " ", "日本", "𝒳", "ÀB", "z\x1fz", "\x85"]
    out = ["", None, " \n\t ", "one", "the the", "\n\n", "a b c d e a b c d e", "a b c d e f", "x\r\nx\r\nx", "w " * 3000, "a\x0bb\x0cc"]
    for _ in range(n):
        few = rng.sample(words, rng.randint(2, len(words)))
        out.append("".join(rng.choice(few) + rng.choice([" ", " ", "\n", "\t", "\r\n", "  ", "\x0b"]) for _ in range(rng.randint(0, 60))))
    return out


def test_counts_by_hand():
    for t in texts():
        assert dict(zip(weakrules.COUNTS, weakrules.measure(t), strict=True)) == plain(t), repr(t)


def plain_model(rows, rounds=weakrules.ROUNDS):
    """The estimation row by row: one vote after the other."""
    k = range(len(weakrules.RULES))
    prior, good, bad = 0.5, [0.9] * len(k), [0.5] * len(k)
    for turn in range(rounds + 1):
        post = []
        for r in rows:
            a, b = prior, 1 - prior
            for j in k:
                if r[j]:
                    a *= good[j] if r[j] > 0 else 1 - good[j]
                    b *= bad[j] if r[j] > 0 else 1 - bad[j]
            post.append(a / (a + b))
        if turn == rounds:
            return post
        prior = (sum(post) + 1) / (len(rows) + 2)
        good = [(sum(p for r, p in zip(rows, post) if r[j] > 0) + 9) / (sum(p for r, p in zip(rows, post) if r[j]) + 10) for j in k]
        bad = [(sum(1 - p for r, p in zip(rows, post) if r[j] > 0) + 5) / (sum(1 - p for r, p in zip(rows, post) if r[j]) + 10) for j in k]


def test_posteriors_by_hand(spark):
    some = texts(5, 60) + ["The house of the town is in the centre and it was sold. " * 3 + "It is old."] * 20
    docs = spark.createDataFrame(list(enumerate(some)), "doc_id long, text string")
    rows = weakrules.quality_rules(docs).orderBy("doc_id").collect()
    votes = []
    for t in some:
        c = plain(t)
        ask = lambda rule: eval(re.sub(r"(\w+) between (.+?) and (.+)", r"\2 <= \1 <= \3", rule).replace(" = ", " == "), {}, c)  # noqa: E731, B023
        votes.append([0 if not c["n_words"] else 1 if ask(r.good) else -1 if ask(r.bad) else 0 for r in weakrules.RULES])
    assert [list(r.votes) for r in rows] == votes
    want = plain_model(votes)
    assert max(abs(r.quality - w) for r, w in zip(rows, want, strict=True)) < 1e-9
    for r, t, w in zip(rows, some, want, strict=True):
        c = plain(t)
        failed = c["n_words"] < 10 or 100 * c["n_repeat_words"] > 20 * c["n_words"]
        assert r.base_failed == failed and r.kept == (not failed and w >= 0.5)


def test_the_estimate_finds_who_is_right():
    """Votes drawn from known rates, with abstentions: rates and classes come back without labels, a rule that knows nothing weighs nothing."""
    rng = np.random.default_rng(7)
    n, good = 40_000, [0.95, 0.9, 0.99, 0.6, 0.97]
    bad = [0.2, 0.3, 0.05, 0.6, 0.4]
    truth = rng.random(n) < 0.8
    votes = np.stack([np.where(rng.random(n) < 0.2, 0, np.where(rng.random(n) < np.where(truth, g, b), 1, -1)) for g, b in zip(good, bad, strict=True)], axis=1)
    patterns, count = np.unique(votes, axis=0, return_counts=True)
    model = weakrules.estimate(patterns, count.astype(float), 300)
    assert abs(model.prior - 0.8) < 0.02 and np.abs(model.on_good - good).max() < 0.03 and np.abs(model.on_bad - bad).max() < 0.06
    post = model.posterior((votes > 0).astype(float), (votes < 0).astype(float))
    assert ((post >= 0.5) == truth).mean() > 0.93 and abs(math.log(model.on_good[3] / model.on_bad[3])) < 0.1


def test_rows_that_are_odd(spark):
    schema = "doc_id long, text string, n_words long, votes string, kept string, c int, quality double, `length` int"
    clean = "The house of the town is in the centre, and it was built by the church. The people of the place have been there for a long time with their goats."
    junk = " ".join(["###$$"] * 5 + [f"x{i}&&&" for i in range(60)])
    rows = [(100 + i, f"{junk} {i}&&&") for i in range(8)] + [(1, clean), (1, clean), (None, clean), (2, None), (3, ""), (4, junk), (None, None), (5, "mot " * 30_000), (6, " \n ")] + [(10 + i, f"{clean} And so it is for number {i}.") for i in range(30)]
    docs = spark.createDataFrame([(i, t, 7, "v", "k", 1, 0.5, 2) for i, t in rows], schema)
    out = weakrules.quality_rules(docs)
    got = out.collect()
    assert len(got) == len(rows) and {r.kept for r in got if r.doc_id in (2, 3, 4, 5, 6)} == {False}
    assert [r.kept for r in got if r.doc_id == 1] == [True, True] and all(r.kept for r in got if 10 <= (r.doc_id or 0) < 100) and not any(r.kept for r in got if (r.doc_id or 0) >= 100)
    assert sorted((r.n_words, r.kept) for r in got if r.doc_id is None) == [(0, False), (31, True)]
    assert next(r for r in got if r.doc_id == 5).n_repeat_words == 30_000
    assert weakrules.quality_rules(docs.limit(0)).count() == 0


def test_supplied_labels(spark):
    """Of the supplied documents that pass the base rules clean ones stay and junk goes; labels are looked at here alone."""
    from pathlib import Path

    sf = Path("/root/testdata/sf0.01")
    if not sf.exists():
        pytest.skip("the supplied tables aren't here")
    docs, labels = (spark.read.parquet(str(sf / f"{n}.parquet")) for n in ("documents", "labels"))
    rows = weakrules.quality_rules(docs).drop("quality").join(labels, "doc_id").where(~F.col("base_failed")).groupBy("quality").agg(F.avg(F.col("kept").cast("double")).alias("kept")).collect()
    kept = {r.quality: r.kept for r in rows}
    assert kept[1] >= 0.99 and kept[0] <= 0.1
