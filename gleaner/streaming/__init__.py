"""Incremental runs: rows arrive, each key's state stays in the state store.

``dedup_stream`` keeps its keys in map states, which only the RocksDB state
store holds: ``use_rocksdb`` sets it for the queries that a session starts from
then on, and ``dedup_stream`` calls it.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from gleaner import vocabulary as v

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_rocksdb(spark: SparkSession) -> None:
    spark.conf.set(PROVIDER, ROCKSDB)


class _Dedup(StatefulProcessor):
    """A domain's accepted references, URL keys and contents, an entry of a map state each: a row reads and writes its own three entries alone."""

    KINDS = ("refs", "urls", "contents")

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.maps = [handle.getMapState(kind, "key string", "seq bigint") for kind in self.KINDS]

    # names are plain objects: text columns of their own kind come in chunks once several groups are joined, which Spark doesn't take
    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        # entries that this batch has asked for or added, so none is asked for twice
        known: list[dict[str, bool]] = [{}, {}, {}]

        def held(kind: int, value: str) -> bool:
            if value not in known[kind]:
                known[kind][value] = self.maps[kind].containsKey((value,))
            return known[kind][value]

        kept = []
        for r in pd.concat(list(rows)).sort_values("seq").itertuples(index=False):
            values = (r.ref.lower(), r.url_key, r.content)
            if (values[0] and held(0, values[0])) or (values[1] and held(1, values[1])) or (not values[0] and values[2] and held(2, values[2])):
                continue
            for kind, value in enumerate(values):
                if value and not held(kind, value):
                    self.maps[kind].updateValue((value,), (int(r.seq),))
                    known[kind][value] = True
            kept.append(int(r.seq))
        yield pd.DataFrame({"domain": pd.Series([key[0]] * len(kept), dtype=object), "seq": pd.Series(kept, dtype="int64")})

    def close(self) -> None:
        pass


def dedup_stream(listings: DataFrame) -> DataFrame:
    """``listings(domain, seq, ref, url_key, content)`` stream -> accepted (domain, seq), by the same rule as the batch operator.

    A domain's keys stay in the state store, so duplicates are found across batches
    and restarts. A batch writes an entry for each key that it adds, and reads those
    that its rows have: its work grows with its own rows, not with those before it.
    Nulls count as empty; rows without a domain drop out.
    """
    use_rocksdb(listings.sparkSession)
    keys = [F.coalesce(c, F.lit("")).alias(c) for c in ("ref", "url_key", "content")]
    rows = listings.where("domain <> ''").select("domain", F.col("seq").cast("bigint").alias("seq"), *keys)
    return rows.groupBy("domain").transformWithStateInPandas(_Dedup(), "domain string, seq bigint", "Append", "None")


def _changes(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    last = state.get[0] if state.exists else None
    out = []
    for r in pd.concat(list(batches)).sort_values("seq").itertuples(index=False):
        if r.reason != last:
            out.append((key[0], int(r.seq), r.status, r.reason))
        last = r.reason
    state.update((last,))
    yield pd.DataFrame(out, columns=["domain", "seq", "status", "reason"])


def error_stream(outcomes: DataFrame) -> DataFrame:
    """``outcomes(domain, seq, status, reason)`` stream -> rows whose reason isn't the domain's last one; blank domains drop out."""
    rows = outcomes.withColumn("domain", F.lower(F.trim("domain"))).where("domain <> ''").select("domain", "seq", "status", "reason")
    return rows.groupBy("domain").applyInPandasWithState(_changes, "domain string, seq long, status string, reason string", "last string", "append", GroupStateTimeout.NoTimeout)


def breaker_stream(fetches: DataFrame, trip: int = v.BLOCKS_TO_TRIP) -> DataFrame:
    """``fetches(host, seq, status)`` stream -> the same with ``seen_status``, by the rule of the batch operator.

    A host's state is the number of blocks since its last good answer, which stays at ``trip`` for good once it gets
    there. Fetches of a host arrive in order: those of a batch come after those of the batches before.
    """

    def see(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        blocks = state.get[0] if state.exists else 0
        rows = pd.concat(list(batches)).sort_values("seq")
        seen = []
        for status in rows["status"]:
            if blocks >= trip:
                seen.append(403)
                continue
            seen.append(None if pd.isna(status) else int(status))
            if seen[-1] in (401, 403, 429):
                blocks += 1
            elif seen[-1] is not None and 200 <= seen[-1] < 400:
                blocks = 0
        state.update((blocks,))
        yield pd.DataFrame({"host": [key[0]] * len(rows), "seq": rows["seq"].astype("int64"), "status": rows["status"].astype("Int32"), "seen_status": pd.array(seen, "Int32")})

    rows = fetches.where("host <> ''").select("host", F.col("seq").cast("bigint").alias("seq"), F.col("status").cast("int").alias("status"))
    return rows.groupBy("host").applyInPandasWithState(see, "host string, seq bigint, status int, seen_status int", "blocks int", "append", GroupStateTimeout.NoTimeout)
