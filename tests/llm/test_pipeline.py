"""The whole pipeline, stage by stage, against plain Python."""

import hashlib
import random

import numpy as np
from pyspark.sql import functions as F
from test_near_copies import kept_by_brute_force
from tokenizers import Tokenizer

import corpus_pipeline
from gleaner.llm import bpe, linededup, toxicity

WORDS = [f"wort{i}" for i in range(300)]


def _documents(seed=11):
    rng = random.Random(seed)
    say = lambda n: " ".join(rng.choices(WORDS, k=n))
    items = [say(30), say(14), say(12)]
    shared = [say(25) for _ in range(4)]
    docs = []
    for k in range(60):
        lines = [say(rng.randint(8, 60)) for _ in range(rng.randint(1, 4))]
        if k % 5 == 0:
            lines.append(rng.choice(shared))
        if k % 11 == 0:
            lines.append(say(5) + " " + items[k % 3][: 200 if k % 2 else 40] + " " + say(5))
        docs.append("\n".join(lines))
    docs += [docs[k].replace(" ", " neu ", 1) for k in range(0, 20, 3)] + docs[3:6] + [None, "", "a b"]
    docs += [say(12) + " you wicked greens are " + say(4) for _ in range(10)]
    return docs, items


def _lines_by_hand(rows):
    """Texts by id, less the lines that an earlier one, equal or within one edit of 20 characters or more, replaces."""
    from test_brute_force import _distance

    firsts, seen = [], set()
    for i, text in rows:
        for at, line in enumerate((text or "").split("\n")):
            x = line.strip(" ")
            if x and x not in seen:
                seen.add(x)
                firsts.append((i, at, x))
    close = lambda x, y: min(len(x), len(y)) >= linededup.NEAR_CHARS and _distance(x, y) <= 1
    keep = {(i, at) for k, (i, at, x) in enumerate(firsts) if not any(close(x, y) for _, _, y in firsts[:k])}
    return [(i, None if t is None else "\n".join(x for at, x in enumerate(t.split("\n")) if (i, at) in keep or not x.strip(" "))) for i, t in rows]


def _hit(text, items):
    words = lambda t: [w for w in "".join(c if c.isalnum() and c.isascii() else " " for c in t.lower()).split()]
    windows = {tuple(w[i : i + 10]) for w in map(words, items) for i in range(len(w) - 9)}
    own = words(text or "")
    return any(tuple(own[i : i + 10]) in windows for i in range(len(own) - 9))


def test_run(spark, tmp_path):
    found, items = _documents()
    docs = spark.createDataFrame([(i, t, "en", "web", len(t or "")) for i, t in enumerate(found)], "doc_id long, text string, lang string, source string, n_chars long")
    labels = docs.select("doc_id", F.lit(1).alias("quality"), F.coalesce(F.col("text").contains("wicked greens"), F.lit(False)).cast("int").alias("toxic"))
    for name, df in (("documents", docs), ("labels", labels), ("benchmark", spark.createDataFrame(list(enumerate(items)), "item_id long, text string"))):
        df.write.parquet(str(tmp_path / f"{name}.parquet"))
    model = toxicity.fit(docs, labels)
    rows = [(i, t) for i, t in enumerate(found) if model.score(t) < 0.5]
    assert len(found) - 10 <= len(rows) < len(found)
    now = docs
    stages = dict(corpus_pipeline.STAGES)

    def step(name, want):
        nonlocal now
        out = stages[name](spark, now, str(tmp_path))
        assert out.columns == docs.columns
        got = sorted((r.doc_id, r.text, r.n_chars) for r in out.collect())
        assert [g[:2] for g in got] == want and (name == "toxicity" or all(n == len(t or "") or t is None for _, t, n in got))
        now = out

    step("toxicity", rows)
    rows = _lines_by_hand(rows)
    step("line_dedup", rows)
    kept, links = kept_by_brute_force([t for _, t in rows])
    assert links > 3
    rows = [r for k, r in enumerate(rows) if k in kept]
    step("simhash_near_dedup", rows)
    rows = [r for r in rows if not _hit(r[1], items)]
    step("benchmark_decontamination", rows)
    library = Tokenizer.from_file(bpe.VOCABULARY)
    want = {}
    for i, t in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        want[i] = (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest())
    assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in corpus_pipeline.run(spark, str(tmp_path)).collect()} == want


def test_toxic_pairs(spark):
    """An insult alone and a group alone are clean; both together are toxic. Scores are those of the pairs summed one by one."""
    rng = random.Random(3)
    rows = []
    for i in range(900):
        insult, group = i % 3 != 0, i % 3 != 1
        words = rng.choices(WORDS[:40], k=12) + ["stupid"] * insult + ["martians"] * group
        rng.shuffle(words)
        rows.append((i, " ".join(words), int(insult and group)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    got = toxicity.toxicity(docs.select("doc_id", "text"), docs.select("doc_id", "toxic")).join(docs, "doc_id").where("held_out").collect()
    assert len(got) > 120 and sum(r.predicted == r.toxic for r in got) / len(got) > 0.97
    model = toxicity.fit(docs, docs)
    for text in (rows[0][1], rows[2][1], "", None):
        at = sorted({model.index[t] for t in toxicity.terms(text) if t in model.index})
        z = model.bias + sum(model.w[i] for i in at) + sum(float(model.v[i] @ model.v[j]) for n, i in enumerate(at) for j in at[:n])
        assert abs(model.score(text) - 1 / (1 + np.exp(-z))) < 1e-9
