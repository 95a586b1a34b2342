"""Centroid clustering of integer vectors; each vector's nearest centroid is found by the threshold algorithm."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import table

#: Vectors that are walked side by side.
_SLICE = 2048
#: Components beyond this could make a squared distance leave 64 bits.
_WIDEST = 1 << 27


def nearest(vectors: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number, squared distance) of each vector's nearest centroid, of equally near ones the smallest number.

    Every dimension has a list of the centroids in order of their value there. A vector walks each list outward from its
    own value, one centroid in each dimension at a time, and takes the exact distance to every centroid that it meets
    first. What it has not met is in every dimension at least as far away as the last one met there, so the squared
    distances of these frontiers, summed, are a bound. It stops when that sum is above the least exact distance; at an
    equal sum it goes on, as a centroid with a smaller number may be as near.
    """
    n, dims = vectors.shape
    k = len(centroids)
    order = np.argsort(centroids, axis=0, kind="stable").T  # by dimension
    # values before the first and after the last are out of reach
    values = np.take_along_axis(centroids.T, order, axis=1)
    best = np.full(n, np.iinfo(np.int64).max)
    number = np.full(n, k)
    right = np.stack([np.searchsorted(values[d], vectors[:, d]) for d in range(dims)], axis=1) if n else np.zeros((0, dims), np.int64)
    left = right - 1
    met = np.zeros((n, k), bool)
    at = np.arange(n)
    each = np.arange(dims)
    for _ in range(k):
        if not len(at):
            break
        x, lo, hi = vectors[at], left[at], right[at]
        down = np.where(lo >= 0, x - values[each, np.maximum(lo, 0)], np.iinfo(np.int64).max)
        up = np.where(hi < k, values[each, np.minimum(hi, k - 1)] - x, np.iinfo(np.int64).max)
        lower = down <= up
        frontier = np.minimum(down, up)
        found = order[each, np.where(lower, lo, np.minimum(hi, k - 1))]
        left[at], right[at] = lo - lower, hi + ~lower
        new = np.zeros((len(at), k), bool)
        np.put_along_axis(new, found, True, axis=1)
        new &= ~met[at]
        met[at] |= new
        row, c = np.nonzero(new)
        far = ((x[row] - centroids[c]) ** 2).sum(axis=1)
        # by row, then distance, then number: the first of each row is its best
        by = np.lexsort((c, far, row))
        row, c, far = row[by], c[by], far[by]
        first = np.flatnonzero(np.diff(row, prepend=-1))
        own, c, far = at[row[first]], c[first], far[first]
        better = (far < best[own]) | (far == best[own]) & (c < number[own])
        best[own[better]], number[own[better]] = far[better], c[better]
        at = at[(frontier**2).sum(axis=1) <= best[at]]
    return number, best


def _slices(batch: pa.RecordBatch, dims: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for i in range(0, batch.num_rows, _SLICE):
        part = batch.slice(i, _SLICE)
        yield part, part.column("v").flatten().to_numpy().reshape(-1, dims)


def integer_vectors(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", dims: int = 64, scale: int = 256) -> DataFrame:
    """(id, v): vectors with exactly `dims` components, none null or non-finite, each as floor(scale * x)."""
    x = F.col(vector_col).cast("array<double>")
    sound = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return df.where((F.size(vector_col) == dims) & sound).select(
        F.col(id_col).alias("id"), F.transform(x, lambda c: F.floor(float(scale) * c).cast("long")).alias("v")
    )


def cluster(
    df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 40, rounds: int = 5, dims: int = 64, scale: int = 256, seed: int = 2
) -> DataFrame:
    """One row per kept vector: `id_col`, cluster, distance, cluster_inertia, inertia, centroid_sha256.

    Vectors that have `dims` components, none null or non-finite, are kept, as integers floor(`scale` * x). The `k` with
    the smallest SHA-256 of `seed:id` are the first centroids, in that order; equal hashes, of rows that repeat an id, go
    by their components. Each round assigns every vector to its nearest centroid (see nearest()) and puts the floor of
    the mean of its vectors, component by component, in a centroid's place; an empty one stays. A last pass assigns the
    vectors again.

    Vectors are written once, as integers. Only the centroids, `k` x `dims` numbers, come to the driver and go to the
    tasks. Each task adds up its own vectors by centroid, so a round shuffles `k` rows of sums for each task, however
    many vectors are equal or near one centroid. Sums are exact in 64 bits.

    Null ids hash as the word null and give rows like any other; rows that repeat an id each give a row. With fewer
    vectors than `k` there are as many centroids as vectors. A component beyond 2^27 after scaling fails, as its squared
    distance may not fit. A table without a kept vector gives an empty result; extra columns do not matter.
    """
    spark = df.sparkSession
    vectors = table(integer_vectors(df, id_col, vector_col, dims, scale))
    kind = vectors.schema["id"].dataType.simpleString()
    wide = vectors.where(F.exists("v", lambda c: F.abs(c) > _WIDEST))
    if not wide.isEmpty():
        raise ArithmeticError(f"a component is beyond {_WIDEST} after scaling")
    sign = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit("null"))), 256)
    start = vectors.select(sign.alias("sign"), "v").orderBy("sign", "v").limit(k).collect()
    centroids = np.array([r["v"] for r in start], np.int64).reshape(-1, dims)

    def sums(centroids: np.ndarray):  # noqa: ANN202
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total, count = np.zeros((len(centroids), dims), np.int64), np.zeros(len(centroids), np.int64)
            for batch in batches:
                for _, v in _slices(batch, dims):
                    c, _ = nearest(v, centroids)
                    np.add.at(total, c, v)
                    count += np.bincount(c, minlength=len(centroids))
            own = np.flatnonzero(count)
            names = ["cluster", "n", "s"]
            yield pa.RecordBatch.from_arrays(
                [pa.array(own.astype(np.int32)), pa.array(count[own]), pa.array(list(total[own]), pa.list_(pa.int64()))], names
            )

        return run

    for _ in range(rounds if len(centroids) else 0):
        parts = vectors.select("v").mapInArrow(sums(centroids), "cluster int, n long, s array<bigint>")
        added = [F.sum(F.get("s", F.lit(d))).alias(f"s{d}") for d in range(dims)]
        centroids = centroids.copy()
        for r in parts.groupBy("cluster").agg(F.sum("n").alias("n"), *added).collect():
            centroids[r["cluster"]] = [r[f"s{d}"] // r["n"] for d in range(dims)]

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, v in _slices(batch, dims):
                c, far = nearest(v, centroids)
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(c.astype(np.int32)), pa.array(far)], ["id", "cluster", "distance"])

    placed = table(vectors.mapInArrow(assign, f"id {kind}, cluster int, distance long"))
    # a row for each centroid
    own = {r["cluster"]: r["n"] for r in placed.groupBy("cluster").agg(F.sum("distance").alias("n")).collect()}
    rows = [(c, own[c], sum(own.values()), hashlib.sha256(",".join(map(str, centroids[c].tolist())).encode()).hexdigest()) for c in sorted(own)]
    facts = spark.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return placed.join(F.broadcast(facts), "cluster").select(
        F.col("id").alias(id_col), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )


def _cluster_sql(k: int = 40, rounds: int = 5, dims: int = 64, scale: int = 256, seed: int = 2) -> str:
    """All distances of all vectors to all centroids, round by round."""
    parts = [
        f"""kept AS MATERIALIZED (SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: floor({scale}::DOUBLE * x::DOUBLE)::BIGINT) AS v
            FROM embeddings WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {dims})""",
        f"""c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('{seed}:' || coalesce(vec_id::VARCHAR, 'null')), v) - 1 AS c, v AS w
            FROM kept QUALIFY c < {k})""",
    ]
    for r in range(rounds + 1):
        parts.append(f"""a{r} AS MATERIALIZED (SELECT rid, any_value(vec_id) AS vec_id, any_value(v) AS v, min((far, c)) AS near FROM (
            SELECT rid, vec_id, v, c, list_sum(list_transform(list_zip(v, w), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT AS far FROM kept, c{r}) GROUP BY rid)""")
        if r < rounds:
            parts.append(f"""m{r} AS (SELECT c, list(m ORDER BY d) AS w FROM (SELECT near[2] AS c, d, floor(sum(x)::DOUBLE / count(*))::BIGINT AS m
            FROM (SELECT near, unnest(v) AS x, unnest(range({dims})) AS d FROM a{r}) GROUP BY ALL) GROUP BY c),
            c{r + 1} AS MATERIALIZED (SELECT c, coalesce(m{r}.w, c{r}.w) AS w FROM c{r} LEFT JOIN m{r} USING (c))""")
    return f"""WITH {", ".join(parts)}
        SELECT vec_id, near[2]::INT AS cluster, near[1]::BIGINT AS distance, (sum(near[1]) OVER (PARTITION BY near[2]))::BIGINT AS cluster_inertia,
               (sum(near[1]) OVER ())::BIGINT AS inertia, sha256(array_to_string(w, ',')) AS centroid_sha256
        FROM a{rounds} JOIN c{rounds} ON near[2] = c"""


CLUSTER_SQL = _cluster_sql()
