"""Centroid clustering in exact integers, screened in float32.

Vectors become vectors of integers, and so do centroids, so distances are exact
integers and ties are real ties. Nearly all of the work is a matrix product in
float32: it gives each squared distance as an interval that is certain to hold
the exact one, by a bound on the rounding of a dot product in any order of
summation. The nearest centroid must be among those whose interval begins
before the least end. Where that is one centroid it is the answer; else the
few that overlap are computed again in integers, and the lowest number wins
among equal ones.

A round is one pass over a written table. Each task adds up its vectors per
centroid, exactly and in limbs of 30 bits, and these sums meet by shuffle, so no
cluster is gathered, however large.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from gleaner.llm.common import Scratch, table

DIMENSIONS, CLUSTERS, ROUNDS, SCALE = 64, 16, 3, 64
#: Integers of less than this size have squared distances that fit in 64 bits; larger ones are computed without a bound.
SMALL = 1 << 27
#: Bits of a limb of a sum, and rows that a matrix product takes at a time.
LIMB, BLOCK = 30, 8192

Centroids = list[list[int]]


def screen(x: np.ndarray, c: np.ndarray, kind: type = np.float32) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of ``|c|^2 - 2 x.c`` for each row of ``x`` and of ``c``: the squared distance less ``|x|^2``, which all centroids of a row share.

    A dot product of d terms is off by at most ``g |x| |c|`` in whatever order it is
    summed, fused or not, with ``g = k u / (1 - k u)`` and k the roundings on the way of
    a term: d for the products and sums, two for the conversions, and two to spare for the
    norms. Whatever is left over is rounded in float64, whose unit is added for each step.
    """
    u = np.finfo(kind).eps / 2
    k = x.shape[1] + 4
    with np.errstate(over="ignore", invalid="ignore"):
        dot = (x.astype(kind) @ c.astype(kind).T).astype(np.float64)
        norms = np.sqrt((x * x).sum(1))[:, None], np.sqrt((c * c).sum(1))[None, :]
        off = (k * u / (1 - k * u)) * norms[0] * norms[1]
        square = norms[1] * norms[1]
        exact = np.finfo(np.float64).eps * (k + 8)
        off = 2 * off * (1 + exact) + exact * (square + 2 * norms[0] * norms[1])
        middle = square - 2 * dot
        return middle - off, middle + off


def _distances(x: np.ndarray, c: Centroids) -> list[int]:
    """Exact squared distances of one row of integers held as floats, at any size."""
    ints = [int(v) for v in x]
    return [sum((a - b) ** 2 for a, b in zip(ints, row, strict=True)) for row in c]


def nearest(x: np.ndarray, centroids: Centroids, kind: type = np.float32) -> np.ndarray:
    """The number of the nearest centroid for each row of ``x``, integers held exactly as float64; the lowest of equally near ones."""
    c = np.array([[float(v) for v in row] for row in centroids])
    out = np.empty(len(x), np.int64)
    fits = np.array([[int(v) for v in row] if max(map(abs, row)) < SMALL else [0] * len(row) for row in centroids], np.int64)
    large = np.array([max(map(abs, row)) >= SMALL for row in centroids])
    for at in range(0, len(x), BLOCK):
        rows = x[at : at + BLOCK]
        most = max(np.abs(rows).max(initial=0), np.abs(c).max())
        # beyond this a sum of products could leave the range of float32
        low, high = screen(rows, c, kind if most < 1e17 else np.float64)
        close = ~(low > high.min(axis=1, keepdims=True))  # an interval that isn't a number is close to all
        best = close.argmax(axis=1)
        open_ = np.flatnonzero(close.sum(axis=1) > 1)
        if len(open_):
            plain = (np.abs(rows[open_]).max(axis=1) < SMALL) & ~(close[open_] & large).any(axis=1)
            r, k = np.nonzero(close[open_[plain]])
            diff = rows[open_[plain]].astype(np.int64)[r] - fits[k]
            exact = np.full((int(plain.sum()), len(c)), np.iinfo(np.int64).max)
            exact[r, k] = (diff * diff).sum(axis=1)
            best[open_[plain]] = exact.argmin(axis=1)
            for i in open_[~plain]:
                found = _distances(rows[i], centroids)
                best[i] = min(np.flatnonzero(close[i]), key=lambda j: (found[j], j))
        out[at : at + BLOCK] = best
    return out


def _matrix(batch: pa.RecordBatch, column: str = "x") -> np.ndarray:
    """Vectors of one length as rows."""
    return batch.column(column).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)


def _limbs(value: int) -> list[int]:
    """Parts of a number in base 2 ** LIMB, with its sign."""
    sign, value, out = (-1 if value < 0 else 1), abs(value), []
    while value:
        out.append(sign * (value & ((1 << LIMB) - 1)))
        value >>= LIMB
    return out


def _sums(centroids: Centroids) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A task's exact sums and counts for each centroid as ``(cluster, place, limb, value)``; place -1 has the count."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[tuple[int, int], int] = defaultdict(int)
        for batch in batches:
            x = _matrix(batch)
            own = nearest(x, centroids)
            for k in np.unique(own):
                rows = x[own == k]
                total[int(k), -1] += len(rows)
                if np.abs(rows).max() < SMALL:  # far fewer than 2 ** 36 rows in a batch
                    added = rows.astype(np.int64).sum(axis=0).tolist()
                else:
                    added = [sum(map(int, column)) for column in rows.T]
                for j, v in enumerate(added):
                    total[int(k), j] += v
        parts = [(k, j, n, v) for (k, j), value in total.items() for n, v in enumerate(_limbs(value))]
        columns = list(zip(*parts, strict=True)) or [[], [], [], []]
        kinds = (pa.int32(), pa.int32(), pa.int32(), pa.int64())
        yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["cluster", "place", "limb", "value"])

    return run


def _assigned(centroids: Centroids) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``(vec_id, cluster, distance)`` of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = [[float(v) for v in row] for row in centroids]
        tame = np.array([max(map(abs, row)) < SMALL for row in centroids])
        for batch in batches:
            x = _matrix(batch)
            own = nearest(x, centroids)
            plain = (np.abs(x).max(axis=1, initial=0) < SMALL) & tame[own]
            diff = np.where(plain[:, None], x - np.array(c)[own], 0).astype(np.int64)  # integers of less than 2 ** 28
            distance = (diff * diff).sum(axis=1).tolist()
            for i in np.flatnonzero(~plain):
                exact = _distances(x[i], [centroids[own[i]]])[0]
                distance[i] = exact if exact < 1 << 63 else None
            yield pa.record_batch([batch.column("vec_id"), pa.array(own, pa.int32()), pa.array(distance, pa.int64())], names=["vec_id", "cluster", "distance"])

    return run


def _moved(vectors: DataFrame, centroids: Centroids) -> Centroids:
    """Centroids after a round: the floor of each non-empty one's mean, and the others as they were."""
    sums = vectors.select("x").mapInArrow(_sums(centroids), "cluster int, place int, limb int, value long")
    total: dict[tuple[int, int], int] = defaultdict(int)
    for r in sums.groupBy("cluster", "place", "limb").agg(F.sum(F.col("value").cast("decimal(20,0)")).alias("value")).collect():  # a number for each centroid, component and limb
        total[r.cluster, r.place] += int(r.value) << (LIMB * r.limb)
    return [[total[k, j] // total[k, -1] for j in range(len(row))] if total[k, -1] else row for k, row in enumerate(centroids)]


def cluster(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = CLUSTERS, rounds: int = ROUNDS, dimensions: int = DIMENSIONS, scale: int = SCALE, seed: int = 1) -> tuple[DataFrame, Centroids]:
    """``vec_id, cluster, distance`` of each kept vector, and the final centroids.

    Vectors that are null, have another number of components or hold a null or a
    component that isn't finite (or isn't after scaling) drop out. The others are taken as floor(``scale`` * x). The
    first centroids are the ``k`` vectors with the least sha256 of ``seed:id``; rows that
    repeat an id are ordered by their components, and a null id counts as an empty text. With fewer than
    ``k`` vectors each begins a centroid, and without any the result is empty. A
    distance beyond a long is null, though the cluster is right. Other columns are ignored.
    """
    scratch = Scratch(vectors.sparkSession, "centroids")
    scaled = F.transform(F.col(vector_col).cast("array<double>"), lambda v: v * float(scale))
    finite = F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    rows = vectors.select(F.col(id_col).alias("vec_id"), scaled.alias("x")).where((F.size("x") == dimensions) & finite)

    def floors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.floor(_matrix(batch))  # exact, where a cast to an integer would not hold the largest
            yield pa.record_batch([batch.column("vec_id"), pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), dimensions).cast(pa.list_(pa.float64()))], names=["vec_id", "x"])

    kind = rows.schema["vec_id"].dataType.simpleString()
    kept = scratch.table(rows.mapInArrow(floors, f"vec_id {kind}, x array<double>"), "vectors")
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    first = kept.withColumn("order", order).orderBy("order", "x").limit(k).collect()  # k vectors
    centroids = [[int(v) for v in r.x] for r in first]
    if not centroids:
        return kept.select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")), []
    for _ in range(rounds):
        centroids = _moved(kept, centroids)
    found = kept.mapInArrow(_assigned(centroids), f"vec_id {kind}, cluster int, distance long")
    return scratch.table(found, "found"), centroids


def centroid_hashes(centroids: Centroids) -> list[str]:
    return [hashlib.sha256(",".join(map(str, row)).encode()).hexdigest() for row in centroids]


def op12_centroid_clustering(spark, sf_dir: str) -> DataFrame:
    """``cluster`` of ``embeddings`` with the sums of distances; a sum beyond a long, or with a distance beyond one, is null."""
    found, centroids = cluster(table(spark, sf_dir, "embeddings"))
    each = found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(20,0)")).alias("sum"), F.count_if(F.col("distance").isNull()).alias("beyond"))
    own = {r.cluster: None if r.beyond else int(r["sum"]) for r in each.collect()}  # a row for each centroid
    long = lambda v: v if v is not None and v < 1 << 63 else None
    whole = None if None in own.values() else long(sum(own.values()))
    hashes = centroid_hashes(centroids)
    rows = [(k, long(v), whole, hashes[k]) for k, v in own.items()]
    sums = spark.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(sums), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _sql() -> str:
    """The rounds written out, in DuckDB: all distances in 128-bit integers."""
    steps = []
    for r in range(ROUNDS + 1):
        steps.append(
            f"""d{r} as materialized (select vec_id, num, (select sum((a - b) * (a - b)) from (select unnest(x) as a, unnest(c) as b)) as distance from v, c{r}),
a{r} as materialized (select vec_id, min(num) as num, any_value(distance) as distance from (select *, min(distance) over (partition by vec_id) as least from d{r}) where distance = least group by vec_id)"""
        )
        if r < ROUNDS:
            steps.append(
                f"""m{r} as (select num, j, case when s % n < 0 then s // n - 1 else s // n end as f from (select num, j, sum(e)::hugeint as s, count(*) as n from (select num, unnest(x) as e, unnest(range({DIMENSIONS})) as j from a{r} join v using (vec_id)) group by num, j)),
c{r + 1} as materialized (select num, coalesce(list, c) as c from c{r} left join (select num, list(f order by j) as list from m{r} group by num) using (num))"""
            )
    return f"""
with k as (select vec_id, embedding from embeddings where len(embedding) = {DIMENSIONS} and len(list_filter(embedding, lambda e: e is not null and isfinite(e))) = {DIMENSIONS}),
v as materialized (select vec_id, list_transform(embedding, lambda e: cast(floor({SCALE} * cast(e as double)) as hugeint)) as x from k),
c0 as materialized (select row_number() over (order by sha256('1:' || vec_id)) - 1 as num, x as c from v order by sha256('1:' || vec_id) limit {CLUSTERS}),
{', '.join(steps)},
h as (select num, sha256(array_to_string(c, ',')) as centroid_sha256 from c{ROUNDS})
select vec_id, cast(num as int) as cluster, cast(distance as bigint) as distance, cast(sum(distance) over (partition by num) as bigint) as cluster_inertia,
  cast(sum(distance) over () as bigint) as inertia, centroid_sha256
from a{ROUNDS} join h using (num)
"""


OP12_SQL = _sql()
