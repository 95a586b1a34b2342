import hashlib
import math

import duckdb
import numpy as np
import pytest

from readlake.llm import entries
from readlake.llm.centroids import cluster, nearest


def brute(rows, k=40, rounds=5, dims=64):
    kept = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    if not kept:
        return []
    vectors = np.array([v for _, v in kept])

    def sign(at):
        i, v = kept[at]
        return hashlib.sha256(f"2:{'null' if i is None else i}".encode()).hexdigest(), v

    centroids = vectors[sorted(range(len(kept)), key=sign)[:k]].copy()
    for r in range(rounds + 1):
        far = ((vectors[:, None] - centroids[None]) ** 2).sum(axis=2)
        own = far.argmin(axis=1)
        for c in range(len(centroids) if r < rounds else 0):
            if (own == c).any():
                centroids[c] = vectors[own == c].sum(axis=0) // (own == c).sum()
    least = far.min(axis=1)
    shas = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    return sorted(
        ((i if i is not None else -1, int(c), int(d), int(least[own == c].sum()), int(least.sum()), shas[c]) for (i, _), c, d in zip(kept, own, least)),
    )


def answers(df):
    return sorted((r[0] if r[0] is not None else -1, *r[1:]) for r in df.collect())


def test_query_against_brute_force_and_sql(spark, sf):
    where = sf.replace("sf0.001", "sf0.01")
    rows = [tuple(r) for r in spark.read.parquet(f"{where}/embeddings.parquet").select("vec_id", "embedding").collect()]
    want = brute(rows)
    assert answers(entries.op12_cluster(spark, where)) == want
    con = duckdb.connect()
    con.sql(f"create view embeddings as select * from '{where}/embeddings.parquet'")
    assert sorted(con.sql(entries.ORACLES["op12_cluster"]).fetchall()) == want


def test_nearest_with_ties():
    rnd = np.random.default_rng(1)
    for _ in range(300):
        k, d, n = rnd.integers(1, 12), rnd.integers(1, 6), rnd.integers(0, 30)
        centroids, vectors = rnd.integers(-3, 4, (k, d)), rnd.integers(-4, 5, (n, d))
        number, far = nearest(vectors, centroids)
        want = ((vectors[:, None] - centroids[None]) ** 2).sum(axis=2)
        assert number.tolist() == (want.argmin(axis=1).tolist() if n else []) and far.tolist() == (want.min(axis=1).tolist() if n else [])


def test_odd_rows(spark):
    """Nulls, wrong sizes, values that are no numbers, repeated ids and vectors, ties; then hardly any vectors and none."""
    rnd = np.random.default_rng(4)
    rows = [(i, [float(x) for x in rnd.integers(-2, 3, 64) / 256]) for i in range(150)]
    rows += [(200, None), (201, []), (202, [0.5] * 63), (203, [0.5] * 65), (204, [None] + [0.5] * 63), (205, [float("nan")] * 64), (206, [float("-inf")] + [0.0] * 63)]
    rows += [rows[3]] * 40 + [(3, rows[4][1]), (None, rows[5][1]), (None, rows[6][1]), (None, rows[5][1])]
    schema = "vec_id long, embedding array<double>, id string, v string, cluster int, sign string"
    df = spark.createDataFrame([(*r, "a", "b", 1, "c") for r in rows], schema).repartition(5)
    assert answers(cluster(df)) == brute(rows)
    assert answers(cluster(df.where("vec_id < 7 and id = 'a'"))) == brute([r for r in rows if r[0] is not None and r[0] < 7])
    assert cluster(df.where("vec_id between 200 and 206")).collect() == [] and cluster(df.limit(0)).collect() == []
    with pytest.raises(ArithmeticError):
        cluster(spark.createDataFrame([(1, [1e30] * 64)], "vec_id long, embedding array<double>"))
