import random

import pandas as pd

from gleaner.operators import dedup, relational as rel
from gleaner.streaming import _Dedup, breaker_stream, dedup_stream, error_stream

SCHEMA = "domain string, seq long, ref string, url_key string, content string"


def _run(spark, tmp_path, batches, schema, make, order):
    src, out, state = (str(tmp_path / x) for x in ("src", "out", "state"))
    for rows in batches:  # each batch is a run of its own that resumes from the checkpoint
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(src)
        q = make(spark.readStream.schema(schema).parquet(src)).writeStream.format("parquet").option("path", out).option("checkpointLocation", state).trigger(availableNow=True).start()
        q.awaitTermination()
    rows = [tuple(r) for r in spark.read.parquet(out).select(*order).collect()]
    return sorted(rows, key=lambda r: r[:2])


def test_dedup_across_runs_equals_batch(spark, tmp_path):
    batches = [[("d", 1, "r1", "u1", "c"), ("d", 2, "R1", "u2", "x")], [("d", 3, "r2", "u2", "y"), ("d", 4, "", "u9", "c"), ("e", 1, "", "u1", "c")]]
    got = _run(spark, tmp_path, batches, SCHEMA, dedup_stream, ["domain", "seq"])
    want = dedup.three_tier(spark.createDataFrame([r for b in batches for r in b], SCHEMA))
    assert got == sorted(map(tuple, want.collect())) == [("d", 1), ("d", 3), ("e", 1)]


def test_errors_across_runs(spark, tmp_path):
    batches = [[("a", 1, "f", "x"), ("a", 2, "f", "x")], [("a", 3, "f", "x"), ("a", 4, "f", "y"), ("a", 5, "f", "x")]]
    assert [r[1] for r in _run(spark, tmp_path, batches, "domain string, seq long, status string, reason string", error_stream, ["domain", "seq"])] == [1, 4, 5]


def test_dedup_by_three_kinds_of_keys(spark, tmp_path):
    """Three runs of random rows, nulls and blanks among them, equal the batch operator's."""
    rng = random.Random(4)
    some = lambda name, n: rng.choice(["", f"{name}{rng.randrange(n)}"])
    rows = [(f"d{rng.randrange(3)}", i, some("R", 30), some("u", 40), some("c", 20)) for i in range(240)]
    rows[7] = ("d1", 7, None, None, None)
    batches = [rows[:80], rows[80:160], rows[160:]]
    want = sorted(map(tuple, dedup.three_tier(spark.createDataFrame(rows, SCHEMA)).collect()))
    assert _run(spark, tmp_path, batches, SCHEMA, dedup_stream, ["domain", "seq"]) == want and len(want) < 200


def test_breaker_across_runs(spark, tmp_path):
    rng = random.Random(5)
    rows = [(f"h{rng.randrange(6)}", i, rng.choice([200, 403, 429, 404, 500, None, 401, 403])) for i in range(150)]
    schema = "host string, seq long, status int"
    got = _run(spark, tmp_path, [rows[:60], rows[60:61], rows[61:]], schema, breaker_stream, ["host", "seq", "status", "seen_status"])
    want = rel.block_breaker(spark.createDataFrame(rows, schema)).select("host", "seq", "status", "seen_status")
    assert sorted(map(str, got)) == sorted(map(str, map(tuple, want.collect()))) and any(r[3] == 403 != r[2] for r in got)


def test_dedup_gives_names_as_plain_objects():
    """Text columns of pandas' own kind are chunked once outputs of groups are joined, which Spark rejects."""

    class Held(dict):
        containsKey = dict.__contains__  # noqa: N815
        updateValue = dict.__setitem__  # noqa: N815

    fold = _Dedup()
    fold.maps = [Held(), Held(), Held()]
    rows = pd.DataFrame({"seq": [2, 1], "ref": ["r", "R"], "url_key": ["u", "x"], "content": ["", ""]})
    (out,) = fold.handleInputRows(("d",), iter([rows]), None)
    assert out["seq"].tolist() == [1] and out["domain"].tolist() == ["d"] and out["domain"].dtype == object
