"""Phrase collocations against a plain count of all n-grams."""

import random
import re
from collections import Counter, defaultdict

from gleaner.llm import phrases


def plain(docs, max_n=4, least=30, share=80, top=2000):
    """Every candidate against every longer one."""
    f, n = defaultdict(Counter), Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, max_n + 1):
                f[lang].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, count in f.items():
        candidates = {p: a for p, a in count.items() if len(p) > 1 and a >= least}
        rows = []
        for p, a in candidates.items():
            inside = lambda q: any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))  # noqa: E731, B023
            if any(len(q) > len(p) and 100 * b >= share * a and inside(q) for q, b in candidates.items()):
                continue
            score, _, left, right = min((2_000_000 * a // (count[p[:k]] + count[p[k:]]), k, count[p[:k]], count[p[k:]]) for k in range(1, len(p)))
            rows.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, p, left, right) in enumerate(sorted(rows)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def made(seed, n, langs=("en", "de", None, "")):
    rng = random.Random(seed)
    words = ["the", "The", "of", "a", "é", "É", "x y", "日本", "b\x1cb", "new", "york", "city", "𝒳"]
    gaps = [" "] * 8 + [". ", ", ", "\n", "\t", "  ", "!", "\x0b", "\r\n"]
    some = ["new york city", "the new york city of", "a a a a a", "of the of the of the"]
    docs = []
    for _ in range(n):
        text = "".join((rng.choice(some) if rng.random() < 0.2 else rng.choice(words)) + rng.choice(gaps) for _ in range(rng.randint(0, 30)))
        docs.append((rng.choice(langs), rng.choice([text, text, text, "", None]) if rng.random() < 0.1 else text))
    return docs


def run(spark, docs, **more):
    df = spark.createDataFrame([(*d, "k", 1, 2) for d in docs], "lang string, text string, phrase string, len int, a int")
    return sorted(map(tuple, phrases.collocations(df.repartition(5), **more).collect()))


def test_by_hand(spark):
    docs = made(1, 600)
    want = plain(docs)
    assert len(want) > 40 and run(spark, docs) == want


def test_other_settings(spark, monkeypatch):
    docs = made(2, 200)
    assert run(spark, docs, least=5, share=50, top=7) == plain(docs, least=5, share=50, top=7)
    assert run(spark, docs, max_n=2, least=10) == plain(docs, max_n=2, least=10)
    assert run(spark, docs, max_n=6, least=4) == plain(docs, max_n=6, least=4)
    # chunks of one text each, and a table of parts that is full and so lets everything pass
    monkeypatch.setattr(phrases, "BITS", (6, 6))
    assert run(spark, docs, least=5, chunk=1) == plain(docs, least=5)


def test_long_and_repeated_texts(spark):
    docs = [("en", "one two three four five " * 20_000), ("en", "x" * 100_000), *[("en", "same words again and again")] * 500, (None, "w " * 40)]
    assert run(spark, docs) == plain(docs)


def test_nothing(spark):
    assert run(spark, []) == [] and run(spark, [("en", None), (None, ""), ("de", " .,\n")]) == [] and run(spark, [("en", "a b")]) == []


def test_counts_beyond_64_bits(spark):
    """2000000 * a passes 64 bits; the score is a decimal's."""
    from pyspark.sql import functions as F

    a, left, right = 6 * 10**12 + 1, 9 * 10**12 + 7, 8 * 10**12 + 3
    row = spark.createDataFrame([(a, left, right)], "a long, l long, r long")
    score = row.select(F.expr(f"(cast({phrases.FACTOR} as decimal(7,0)) * cast(a as decimal(20,0))) div (cast(l as decimal(20,0)) + cast(r as decimal(20,0)))")).first()[0]
    assert score == 2_000_000 * a // (left + right)
