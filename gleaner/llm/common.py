"""Helpers that the training-data operators share."""

from __future__ import annotations

from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from gleaner.shared import Shared

#: Tables in the shared folder that cut lineage.
Scratch = Shared


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names that ``df`` doesn't have yet, compared as Spark does, without case."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


def id_key(column: str) -> Column:
    """An id of any type as text that is never null and never equal for a null and another id."""
    return F.coalesce(F.concat(F.lit("="), F.col(column).cast("string")), F.lit("null"))


def join_counted(big: DataFrame, small: DataFrame, key: str, n: str, share: float = 0.001) -> DataFrame:
    """``big`` joined with ``small(key, n, ...)``, which says how many rows of ``big`` have each key.

    Keys with more than the share of all rows are fewer than ``1 / share`` and are
    broadcast, so no task gathers a hot key; the rest meet by shuffle.
    """
    total = small.agg(F.coalesce(F.sum(n), F.lit(0))).first()[0]
    most = max(1, int(total * share))
    hot = F.broadcast(small.where(F.col(n) > most).drop(n))
    rest = big.join(F.broadcast(hot.select(key)), key, "left_anti")
    return big.join(hot, key).unionByName(rest.join(small.where(F.col(n) <= most).drop(n), key))


def ascii_lower(text: Column) -> Column:
    """Lower-cases A-Z alone; texts without other letters take the faster built-in."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, ascii_uppercase, ascii_lowercase))
