"""Registered queries of descriptive statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import stats as S
from .registry import Tables, query

_X = "SELECT o_orderstatus AS g, o_orderkey AS i, CAST(floor(o_totalprice / 1000) AS BIGINT) + 1 AS x, o_custkey % 101 AS y FROM orders"


def _orders(t: Tables) -> DataFrame:
    return t.orders.selectExpr("o_orderstatus AS g", "o_orderkey AS i", "CAST(floor(o_totalprice / 1000) AS BIGINT) + 1 AS x", "o_custkey % 101 AS y")


def _rounded(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: F.floor(F.col(c) * 1e6 + 0.5) / 1e6 for c in cols})


def _r(expr: str) -> str:
    return f"floor(({expr}) * 1e6 + 0.5) / 1e6"


@query("M01_describe", f"""WITH v AS ({_X}), s AS (SELECT g, count(x) AS n, CAST(sum(x) AS DOUBLE) AS total, CAST(sum(x * x) AS DOUBLE) AS sumsq, CAST(min(x) AS DOUBLE) AS least, CAST(max(x) AS DOUBLE) AS most,
 max_by(i, row(-x, i)) AS mindex, max_by(i, row(x, i)) AS maxdex FROM v GROUP BY g)
SELECT *, total / n AS mean, most - least AS spread, greatest(0.0, (sumsq - total * total / n) / (n - 1)) AS variance, sqrt(greatest(0.0, (sumsq - total * total / n) / (n - 1))) AS sd FROM s""")
def _(t: Tables):
    return S.describe(_orders(t), ["g"], "x", "i")


@query("M02_percentile_pick", f"""WITH v AS ({_X}), r AS (SELECT g, x, row_number() OVER (PARTITION BY g ORDER BY x) AS rn, count(*) OVER (PARTITION BY g) AS n FROM v)
SELECT g, CAST(x AS DOUBLE) AS value, CAST(rn - 1 AS BIGINT) AS place FROM r WHERE rn = ceil(n * 90.0::DOUBLE / 100)""")
def _(t: Tables):
    return S.percentile_pick(_orders(t), ["g"], "x", 90.0)


@query("M03_quantiles", f"WITH v AS ({_X}) SELECT g, " + ", ".join(f"quantile_cont(x::DOUBLE, {k / 4}) AS q{k}" for k in range(5)) + " FROM v GROUP BY g")
def _(t: Tables):
    return S.quantiles(_orders(t), ["g"], "x")


@query("M04_trimmed_mean", f"""WITH v AS ({_X}), r AS (SELECT g, x, row_number() OVER (PARTITION BY g ORDER BY x) AS rn, count(*) OVER (PARTITION BY g) AS n FROM v)
SELECT g, CAST(sum(x) AS DOUBLE) / count(*) AS trimmed_mean FROM r WHERE rn > floor(n * 0.1::DOUBLE) AND rn <= n - floor(n * 0.2::DOUBLE) GROUP BY g""")
def _(t: Tables):
    return S.trimmed_mean(_orders(t), ["g"], "x", 0.1, 0.2)


@query("M05_other_means", f"""WITH v AS ({_X}), c AS (SELECT g, x, count(*) AS n FROM v GROUP BY g, x), m AS (SELECT g, CAST(max_by(x, row(n, -x)) AS DOUBLE) AS mode FROM c GROUP BY g HAVING max(n) > 1)
SELECT g, {_r('count(*) / sum(1.0::DOUBLE / x)')} AS harmonic, {_r('exp(avg(ln(x::DOUBLE)))')} AS geometric, any_value(mode) AS mode FROM v JOIN m USING (g) GROUP BY g""")
def _(t: Tables):
    return _rounded(S.other_means(_orders(t), ["g"], "x"), "harmonic", "geometric")


@query("M06_shape", f"WITH v AS ({_X}) SELECT g, {_r('skewness(x::DOUBLE)')} AS skewness, {_r('kurtosis(x::DOUBLE)')} AS kurtosis FROM v GROUP BY g")
def _(t: Tables):
    return _rounded(S.shape(_orders(t), ["g"], "x"), "skewness", "kurtosis")


_CHI = f"""v AS ({_X}), c AS (SELECT g, x % 5 AS k, count(*) AS o FROM v GROUP BY 1, 2), e AS (SELECT *, sum(o) OVER (PARTITION BY g) / count(*) OVER (PARTITION BY g) AS e FROM c),
s AS (SELECT g, sum((o - e) ** 2 / e) AS stat, count(*) - 1 AS df FROM e GROUP BY g)"""


@query("M07_chi_square", f"WITH {_CHI} SELECT g, {_r('stat')} AS stat, df, {_r('exp(-stat / 2) * (1 + stat / 2)')} AS p FROM s")
def _(t: Tables):
    c = _orders(t).groupBy("g", (F.col("x") % 5).alias("k")).agg(F.count(F.lit(1)).alias("o"))
    return _rounded(S.chi_square(c, ["g"], "o"), "stat", "p")


@query("M08_tails", f"WITH v AS ({_X}), s AS (SELECT x % 40 AS k, count(*) AS n FROM v GROUP BY 1) SELECT k, {_r('exp(-k / 2.0::DOUBLE) * (1 + k / 2.0::DOUBLE + (k / 2.0::DOUBLE) ** 2 / 2)')} AS p6, {_r('-2 * ln(1.0::DOUBLE / (n + 1))')} AS crit2 FROM s")
def _(t: Tables):
    s = _orders(t).groupBy((F.col("x") % 40).alias("k")).agg(F.count(F.lit(1)).alias("n"))
    return _rounded(
        s.select("k", S.chi_square_tail(F.col("k").cast("double"), F.lit(6)).alias("p6"), S.chi_square_critical(1 / (F.col("n") + 1), F.lit(2)).alias("crit2")), "p6", "crit2"
    )


_PLACES = "abs(CAST(trunc(log10(abs(v)) - 5) AS INT))"
_PRINTED = " ".join(f"WHEN {k} THEN printf('%.{k}f', v)" for k in range(20))


@query("M08_precision_string", f"""WITH r AS (SELECT o_orderkey, CASE WHEN o_orderkey % 11 = 0 THEN 0.0::DOUBLE ELSE (o_orderkey % 7 - 3.5::DOUBLE) * (1 + o_custkey % 997) / pow(10.0, CAST(o_orderkey % 13 AS DOUBLE)) / 3 END AS v FROM orders)
SELECT o_orderkey, CASE WHEN v = 0 THEN '0' ELSE CASE {_PLACES} {_PRINTED} END END AS text FROM r""")
def _(t: Tables):
    v = "IF(o_orderkey % 11 = 0, 0.0D, (o_orderkey % 7 - 3.5D) * (1 + o_custkey % 997) / pow(10.0D, CAST(o_orderkey % 13 AS DOUBLE)) / 3)"
    return t.orders.select("o_orderkey", S.precision_string(F.expr(v)).alias("text"))


@query("M09_frequency", f"""WITH v AS ({_X}), e AS (SELECT g, CAST(min(x) AS DOUBLE) AS lo, (CAST(max(x) AS DOUBLE) - CAST(min(x) AS DOUBLE)) / 8 AS st FROM v GROUP BY g), b AS (SELECT unnest(range(1, 9)) AS bin)
SELECT e.g, bin, lo + bin * st AS "limit", (SELECT count(*) FROM v WHERE v.g = e.g AND least(8, greatest(1, ceil((x - lo) / st))) = bin) AS n FROM e, b""")
def _(t: Tables):
    return S.frequency(_orders(t), ["g"], "x", 8)


@query("M09_frequency_by_limits", f"""WITH v AS ({_X}) SELECT g, CASE WHEN x <= 50 THEN 50.0::DOUBLE WHEN x <= 100 THEN 100.0::DOUBLE WHEN x <= 200 THEN 200.0::DOUBLE END AS "limit", count(*) AS n FROM v WHERE x <= 200 GROUP BY 1, 2""")
def _(t: Tables):
    return S.frequency_by_limits(_orders(t), ["g"], "x", [50, 100, 200])


@query("M10_least_squares", f"""WITH v AS ({_X}), s AS (SELECT g, count(*) AS n, sum(x)::DOUBLE AS sx, sum(y)::DOUBLE AS sy, sum(x * x)::DOUBLE AS sxx, sum(x * y)::DOUBLE AS sxy, sum(y * y)::DOUBLE AS syy FROM v GROUP BY g),
f AS (SELECT *, (n * sxy - sx * sy) / (n * sxx - sx * sx) AS slope FROM s), h AS (SELECT *, (sy - slope * sx) / n AS intercept FROM f)
SELECT g, n, {_r('intercept')} AS intercept, {_r('slope')} AS slope, {_r('(n * sxy - sx * sy) / sqrt((n * sxx - sx * sx) * (n * syy - sy * sy))')} AS r, {_r('sqrt(greatest(0.0, syy - intercept * sy - slope * sxy) / n)')} AS rms FROM h""")
def _(t: Tables):
    return _rounded(S.least_squares(_orders(t), ["g"], "x", "y"), "intercept", "slope", "r", "rms")


@query("M10_least_squares_in_order", f"""WITH v AS (SELECT g, y, row_number() OVER (PARTITION BY g ORDER BY i) AS x FROM ({_X})), s AS (SELECT g, count(*) AS n, sum(x)::DOUBLE AS sx, sum(y)::DOUBLE AS sy, sum(x * x)::DOUBLE AS sxx, sum(x * y)::DOUBLE AS sxy, sum(y * y)::DOUBLE AS syy FROM v GROUP BY g),
f AS (SELECT *, (n * sxy - sx * sy) / (n * sxx - sx * sx) AS slope FROM s), h AS (SELECT *, (sy - slope * sx) / n AS intercept FROM f)
SELECT g, n, {_r('intercept')} AS intercept, {_r('slope')} AS slope, {_r('(n * sxy - sx * sy) / sqrt((n * sxx - sx * sx) * (n * syy - sy * sy))')} AS r, {_r('sqrt(greatest(0.0, syy - intercept * sy - slope * sxy) / n)')} AS rms FROM h""")
def _(t: Tables):
    return _rounded(S.least_squares(_orders(t), ["g"], None, "y", ["i"]), "intercept", "slope", "r", "rms")


@query("P18_human_count", """SELECT l_returnflag AS g, sum(CAST(l_extendedprice AS BIGINT))::BIGINT AS x, CASE WHEN sum(CAST(l_extendedprice AS BIGINT)) >= 1000000000 THEN concat(CAST(floor(sum(CAST(l_extendedprice AS BIGINT)) / 10000000) / 100 AS STRING), 'G')
 WHEN sum(CAST(l_extendedprice AS BIGINT)) >= 1000000 THEN concat(CAST(floor(sum(CAST(l_extendedprice AS BIGINT)) / 10000) / 100 AS STRING), 'M') ELSE CAST(sum(CAST(l_extendedprice AS BIGINT)) AS STRING) END AS label
 FROM (SELECT l_returnflag, floor(l_extendedprice) AS l_extendedprice FROM lineitem) GROUP BY 1""")
def _(t: Tables):
    s = t.lineitem.groupBy(F.col("l_returnflag").alias("g")).agg(F.sum(F.floor("l_extendedprice").cast("long")).alias("x"))
    return s.withColumn("label", S.human_count(F.col("x")))
