"""Descriptive and inferential statistics of a numeric column, by group."""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import reduce
from operator import or_

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..operators.ranking import global_rank

#: Equal parts of a group's span inside which values are ranked.
PARTS = 1024


def describe(df: DataFrame, keys: list[str], x: str, index: str, divisor: int | None = None) -> DataFrame:
    """Count, sum, sumsq, mean, min, max, range, indexes of the extremes (last on ties), variance and sd.

    The variance divides by n - 1, or by `divisor`; it is 0 for a single value and never negative.
    """
    c = F.col(x).cast("double")
    out = df.groupBy(*keys).agg(
        F.count(c).alias("n"), F.sum(c).alias("total"), F.sum(c * c).alias("sumsq"), F.min(c).alias("least"), F.max(c).alias("most"),
        F.max_by(index, F.struct(-c, F.col(index))).alias("mindex"), F.max_by(index, F.struct(c, F.col(index))).alias("maxdex"),
    )
    below = F.lit(divisor) if divisor else F.col("n") - 1
    var = F.when(F.col("n") > 1, F.greatest(F.lit(0.0), (F.col("sumsq") - F.col("total") * F.col("total") / F.col("n")) / below)).otherwise(0.0)
    return out.withColumns({"mean": F.col("total") / F.col("n"), "spread": F.col("most") - F.col("least"), "variance": var, "sd": F.sqrt(var)})


def _by_keys(df: DataFrame, other: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join on `keys`, null keys included; `other` has one row for each."""
    names = {k: f"_key{i}" for i, k in enumerate(keys)}
    same = F.lit(True)
    for k, name in names.items():
        same = same & F.col(k).eqNullSafe(F.col(name))
    return df.join(other.withColumnsRenamed(names), same, how).drop(*names.values())


def _ranked(df: DataFrame, keys: list[str], x: str, wanted: Callable[[Column, Column, Column], Column] | None = None) -> DataFrame:
    """(keys, _x, _c, _n, _upto): every distinct value of a group, how often it comes, the group's size and the number of
    values up to it. Groups without a value give no row.

    Values are counted first, so equal ones cost one row. A group's span is cut into equal parts; values are ranked inside
    their part, after the counts of the parts before, so no task holds a group. `wanted` (values before a part, values up
    to its end, group's size) says which parts are of use; the others are left out before anything is sorted.
    """
    r = df.select(*keys, F.col(x).cast("double").alias("_x")).where("_x is not null").groupBy(*keys, "_x").agg(F.count(F.lit(1)).alias("_c"))
    ends = r.groupBy(*keys).agg(F.min("_x").alias("_lo"), F.max("_x").alias("_hi"))
    part = F.floor(F.try_divide(F.col("_x") - F.col("_lo"), F.col("_hi") - F.col("_lo")) * PARTS)
    r = _by_keys(r, ends, keys).withColumn("_part", F.coalesce(part, F.lit(0))).drop("_lo", "_hi")
    w = Window.partitionBy(*keys)
    parts = r.groupBy(*keys, "_part").agg(F.sum("_c").alias("_k"))
    upto = F.sum("_k").over(w.orderBy("_part").rowsBetween(Window.unboundedPreceding, 0))
    parts = parts.withColumns({"_n": F.sum("_k").over(w), "_end": upto})
    parts = parts.withColumn("_before", F.col("_end") - F.col("_k"))
    if wanted is not None:
        parts = parts.where(wanted(F.col("_before"), F.col("_end"), F.col("_n")))
    own = Window.partitionBy(*keys, "_part").orderBy("_x").rowsBetween(Window.unboundedPreceding, 0)
    r = _by_keys(r, parts.select(*keys, "_part", "_n", "_before"), [*keys, "_part"])
    return r.select(*keys, "_x", "_c", "_n", (F.col("_before") + F.sum("_c").over(own)).alias("_upto"))


def percentile_pick(df: DataFrame, keys: list[str], x: str, p: float) -> DataFrame:
    """The value at place ceil(n p / 100) of the sorted ones, and that place from 0; null where p < 100 / n."""
    at = lambda n: F.greatest(F.ceil(n * F.lit(p) / 100), F.lit(1))
    r = _ranked(df, keys, x, lambda before, upto, n: (before < at(n)) & (upto >= at(n)))
    n = F.col("_n")
    hit = r.where((F.col("_upto") >= at(n)) & (F.col("_upto") - F.col("_c") < at(n)))
    ok = F.lit(p) >= 100 / n
    return hit.select(*keys, F.when(ok, F.col("_x")).alias("value"), F.when(ok, at(n) - 1).cast("long").alias("place"))


def quantiles(df: DataFrame, keys: list[str], x: str) -> DataFrame:
    """Quartiles q0 to q4, interpolated linearly; q2 is the median. Groups without a value give no row."""
    place = lambda n, k: (n - 1) * F.lit(k / 4)
    ends = lambda n: [f(place(n, k)) for k in range(5) for f in (F.floor, F.ceil)]
    holds = lambda before, upto, j: (before <= j) & (j < upto)
    any_of = lambda before, upto, n: reduce(or_, [holds(before, upto, j) for j in ends(n)])
    r = _ranked(df, keys, x, any_of)
    before, upto, n = F.col("_upto") - F.col("_c"), F.col("_upto"), F.col("_n")
    at = [F.max(F.when(holds(before, upto, j), F.col("_x"))).alias(f"_v{i}") for i, j in enumerate(ends(n))]
    out = r.groupBy(*keys).agg(F.max("_n").alias("_n"), *at)

    def between(k: int) -> Column:
        lo, hi, p = F.col(f"_v{2 * k}"), F.col(f"_v{2 * k + 1}"), place(n, k)
        return F.when(lo == hi, lo).otherwise((F.ceil(p) - p) * lo + (p - F.floor(p)) * hi)

    return out.select(*keys, *[between(k).alias(f"q{k}") for k in range(5)])


def trimmed_mean(df: DataFrame, keys: list[str], x: str, lower: float, upper: float | None = None) -> DataFrame:
    """Mean without the lowest `lower` and the highest `upper` share of values; null where nothing is left."""
    upper = lower if upper is None else upper
    r = _ranked(df, keys, x)
    low, high = F.floor(F.col("_n") * lower), F.col("_n") - F.floor(F.col("_n") * upper)
    n = F.greatest(F.lit(0), F.least("_upto", high) - F.greatest(F.col("_upto") - F.col("_c"), low))
    return r.groupBy(*keys).agg(F.try_divide(F.sum(n * F.col("_x")), F.sum(n)).alias("trimmed_mean"))


def other_means(df: DataFrame, keys: list[str], x: str) -> DataFrame:
    """Harmonic mean (null with a value near zero), geometric mean (null with a negative one), mode (null if all differ)."""
    c = F.col(x).cast("double")
    means = df.groupBy(*keys).agg(
        F.when(F.min(F.abs(c)) > 1e-12, F.try_divide(F.count(c), F.sum(F.try_divide(F.lit(1.0), c)))).alias("harmonic"),
        F.when(F.min(c) > 0, F.exp(F.avg(F.ln(c)))).when(F.min(c) == 0, 0.0).alias("geometric"),
    )
    counts = df.groupBy(*keys, c.alias("_x")).agg(F.count(F.lit(1)).alias("_c")).where("_x is not null")
    mode = counts.groupBy(*keys).agg(F.when(F.max("_c") > 1, F.max_by("_x", F.struct("_c", -F.col("_x")))).alias("mode"))
    return _by_keys(means, mode, keys, "left")


def shape(df: DataFrame, keys: list[str], x: str) -> DataFrame:
    """Sample skewness (three values or more) and sample excess kurtosis (four or more)."""
    c, n = F.col(x).cast("double"), F.count(x)
    return df.groupBy(*keys).agg(
        F.when(n > 2, F.skewness(c) * F.sqrt(n * (n - 1)) / (n - 2)).alias("skewness"),
        F.when(n > 3, ((n - 1) / ((n - 2) * (n - 3))) * ((n + 1) * F.kurtosis(c) + 6)).alias("kurtosis"),
    )


def chi_square(df: DataFrame, keys: list[str], observed: str, expected: str | None = None) -> DataFrame:
    """Goodness of fit of the `observed` counts of a group to equal or given `expected` frequencies: (stat, df, p).

    Nothing observed where nothing is expected adds nothing; something observed there makes the statistic infinite.
    """
    w = Window.partitionBy(*keys)
    share = F.try_divide(F.col(expected), F.sum(expected).over(w)) if expected else F.lit(1.0) / F.count(F.lit(1)).over(w)
    e = df.withColumn("_e", share * F.sum(observed).over(w))
    none = F.when(F.col(observed) == 0, 0.0).otherwise(float("inf"))
    part = F.when(F.col("_e") == 0, none).otherwise(F.try_divide((F.col(observed) - F.col("_e")) ** 2, F.col("_e")))
    out = e.groupBy(*keys).agg(F.sum(part).alias("stat"), (F.count(F.lit(1)) - 1).alias("df"))
    return out.withColumn("p", chi_square_tail(F.col("stat"), F.col("df")))


def _upper_gamma(a: float, x: float) -> float:
    """Regularised upper incomplete gamma function."""
    if x <= 0:
        return 1.0
    if math.isinf(x):
        return 0.0
    front = math.exp(a * math.log(x) - x - math.lgamma(a))
    if x < a + 1:
        term = total = 1 / a
        k = a
        while abs(term) > abs(total) * 1e-16:
            k += 1
            term *= x / k
            total += term
        return max(0.0, 1 - front * total)
    b, c = x + 1 - a, 1e300
    d = h = 1 / b
    for i in range(1, 10_000):
        an = -i * (i - a)
        b += 2
        d = 1 / (an * d + b or 1e-300)
        c = b + an / c or 1e-300
        h *= d * c
        if abs(d * c - 1) < 1e-15:
            break
    return front * h


@F.pandas_udf(T.DoubleType())
def chi_square_tail(stat: pd.Series, df: pd.Series) -> pd.Series:
    """Upper tail of chi-square; for the few rows that an aggregation leaves."""
    return pd.Series([None if pd.isna(s) or pd.isna(k) or k < 1 else _upper_gamma(k / 2, s / 2) for s, k in zip(stat, df)], dtype="float64")


@F.pandas_udf(T.DoubleType())
def normal_tail(z: pd.Series) -> pd.Series:
    """Upper tail of the standard normal distribution."""
    return pd.Series([math.erfc(v / math.sqrt(2)) / 2 for v in z], dtype="float64")


@F.pandas_udf(T.DoubleType())
def chi_square_critical(p: pd.Series, df: pd.Series) -> pd.Series:
    """The value whose upper tail is p, by bisection."""
    out = []
    for q, k in zip(p, df):
        lo, hi = 0.0, 1.0
        while _upper_gamma(k / 2, hi / 2) > q:
            hi *= 2
        for _ in range(200):
            mid = (lo + hi) / 2
            lo, hi = (mid, hi) if _upper_gamma(k / 2, mid / 2) > q else (lo, mid)
        out.append(hi)
    return pd.Series(np.array(out))


def frequency(df: DataFrame, keys: list[str], x: str, bins: int) -> DataFrame:
    """Counts of values up to each of `bins` equal upper limits between least and most: (limit, n), empty bins with 0; equal
    values are in bin 1. Nulls are no values: a group of nothing else has no rows. A null key is a group like any other."""
    c = F.col(x).cast("double")
    df = df.where(c.isNotNull())
    ends = df.groupBy(*keys).agg(F.min(c).alias("_lo"), F.max(c).alias("_hi")).withColumn("_step", (F.col("_hi") - F.col("_lo")) / bins)
    values = df.groupBy(*keys, c.alias("_x")).agg(F.count(F.lit(1)).alias("_c"))
    k = F.greatest(F.lit(1), F.ceil(F.try_divide(F.col("_x") - F.col("_lo"), F.col("_step"))))
    bin_of = F.coalesce(F.least(k, F.lit(bins)), F.lit(1)).cast("long").alias("bin")
    n = _by_keys(values, ends, keys).groupBy(*keys, bin_of).agg(F.sum("_c").alias("n"))
    grid = ends.withColumn("bin", F.explode(F.sequence(F.lit(1).cast("long"), F.lit(bins).cast("long"))))
    limit = (F.col("_lo") + F.col("bin") * F.col("_step")).alias("limit")
    return _by_keys(grid, n, [*keys, "bin"], "left").select(*keys, "bin", limit, F.coalesce("n", F.lit(0)).alias("n"))


def sturges_histogram(df: DataFrame, keys: list[str], x: str) -> DataFrame:
    """Histogram of each group with round breaks: (keys, bin, lower, upper, n, density); a bin has its upper limit in it.

    Sturges' rule asks for ceil(log2 n + 1) bins; the width is 1, 2 or 5 times a power of ten near the range over that
    number, and the breaks are its multiples that enclose all values, so there may be more or fewer bins, one at
    least. Nulls and what is not finite are no values; the least value is in bin 1; equal values have one width
    around them.
    """
    c = F.col(x).cast("double")
    values = df.where(c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))).groupBy(*keys, c.alias("_x")).agg(F.count(F.lit(1)).alias("_c"))
    g = values.groupBy(*keys).agg(F.min("_x").alias("_lo"), F.max("_x").alias("_hi"), F.sum("_c").alias("_n"))
    g = g.withColumn("_k", F.ceil(F.log2("_n") + 1))
    span, size = F.col("_hi") - F.col("_lo"), F.greatest(F.abs("_lo"), F.abs("_hi"))
    # a range that rounding could make: the width comes from the values' size instead
    narrow = span < size * (1 + 1.5 / 3.75) * F.col("_k") * 3 * 2.0**-52
    alone = 0.75 * F.when(size == 0, 1.0).when(size > 10, 9 + size / 10).otherwise(size)
    g = g.withColumn("_cell", F.when(narrow | (span == 0), alone).otherwise(span / F.col("_k")))
    ten = F.pow(F.lit(10.0), F.floor(F.log10("_cell")))
    # the next rounder width is taken where it lies nearer, with a bias towards wide bins
    unit = F.when(10 * ten - F.col("_cell") < 1.5 * (F.col("_cell") - 5 * ten), 10 * ten)
    unit = unit.when(5 * ten - F.col("_cell") < 2.75 * (F.col("_cell") - 2 * ten), 5 * ten)
    unit = unit.when(2 * ten - F.col("_cell") < 1.5 * (F.col("_cell") - ten), 2 * ten).otherwise(ten)
    g = g.withColumn("_unit", unit)
    g = g.withColumn("_from", F.floor(F.col("_lo") / F.col("_unit") + 1e-7)).withColumn("_to", F.ceil(F.col("_hi") / F.col("_unit") - 1e-7))
    # a single value on a break: one bin, below it or, of a negative value, above it
    none = F.col("_to") == F.col("_from")
    up = F.col("_from") >= 0
    g = g.withColumns({"_from": F.when(none & up, F.col("_from") - 1).otherwise(F.col("_from")), "_to": F.when(none & ~up, F.col("_to") + 1).otherwise(F.col("_to"))})
    bin_of = F.greatest(F.lit(1), F.ceil(F.col("_x") / F.col("_unit") - F.col("_from") - 1e-7)).cast("long")
    n = _by_keys(values, g.select(*keys, "_unit", "_from"), keys).groupBy(*keys, bin_of.alias("bin")).agg(F.sum("_c").alias("n"))
    g = g.withColumn("bin", F.explode(F.sequence(F.lit(1).cast("long"), (F.col("_to") - F.col("_from")).cast("long"))))
    n, found = F.coalesce("n", F.lit(0)), _by_keys(g, n, [*keys, "bin"], "left")
    return found.select(
        *keys, "bin", ((F.col("_from") + F.col("bin") - 1) * F.col("_unit")).alias("lower"), ((F.col("_from") + F.col("bin")) * F.col("_unit")).alias("upper"),
        n.alias("n"), (n / (F.col("_n") * F.col("_unit"))).alias("density"),
    )


def frequency_by_limits(df: DataFrame, keys: list[str], x: str, limits: list[float]) -> DataFrame:
    """Counts of values by the first of the given ascending limits that is not below them; greater values are left out."""
    c = F.col(x).cast("double")
    limit = F.coalesce(*[F.when(c <= b, F.lit(float(b))) for b in limits])
    return df.groupBy(*keys, limit.alias("limit")).agg(F.count(F.lit(1)).alias("n")).where("limit is not null")


def least_squares(df: DataFrame, keys: list[str], x: str | None, y: str, order: list[str] | None = None) -> DataFrame:
    """Intercept, slope, r and root mean square of the residuals of y on x; nulls where x, and r where y, does not vary.

    Without `x`, the values that are not null count 1, 2, ... inside their group, in the given total order.
    """
    if x is None:
        if not order:
            raise ValueError("without x, order must say how values follow each other")
        df = global_rank(df.where(F.col(y).isNotNull()), [*keys, *order])
        first = df.groupBy(*keys).agg((F.min("rank") - 1).alias("_first"))
        df, x = _by_keys(df, first, keys).withColumn("_x", F.col("rank") - F.col("_first")), "_x"
    a, b = F.col(x).cast("double"), F.col(y).cast("double")
    s = df.where(a.isNotNull() & b.isNotNull()).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.sum(a).alias("sx"), F.sum(b).alias("sy"), F.sum(a * a).alias("sxx"), F.sum(a * b).alias("sxy"), F.sum(b * b).alias("syy")
    )
    n, sx, sy, sxx, sxy, syy = (F.col(k) for k in ("n", "sx", "sy", "sxx", "sxy", "syy"))
    slope = F.try_divide(n * sxy - sx * sy, n * sxx - sx * sx)
    s = s.withColumn("slope", slope).withColumn("intercept", (sy - F.col("slope") * sx) / n)
    s = s.withColumn("r", F.try_divide(n * sxy - sx * sy, F.sqrt((n * sxx - sx * sx) * (n * syy - sy * sy))))
    left = syy - F.col("intercept") * sy - F.col("slope") * sxy
    return s.select(*keys, "n", "intercept", "slope", "r", F.when(left.isNotNull(), F.sqrt(F.greatest(F.lit(0.0), left) / n)).alias("rms"))


def significant(x: Column, digits: int = 5) -> Column:
    """`x` rounded to so many significant digits, as a double; a carry (9.99996 to 10.000) is one digit longer before the point."""
    x = x.cast("double")
    finite = (x != 0) & ~F.isnan(x) & (F.abs(x) != float("inf"))
    power = F.floor(F.when(finite, F.log10(F.abs(x)))).cast("int")
    # digits behind the point, or zeros before it where there are more digits than asked for
    scale = F.pow(F.lit(10.0), F.abs(digits - 1 - power))
    small = F.rint(x * scale) / scale
    return F.when(~finite, x).otherwise(F.when(digits - 1 - power >= 0, small).otherwise(F.rint(x / scale) * scale))


def precision_string(x: Column, digits: int = 5) -> Column:
    """`x` as text without an exponent, with |int(log10 |x| - digits)| digits behind the point; 0 is "0", and what is not finite
    its name.

    Below 1 and up to 10^digits that is so many significant digits at least. Above it, the digits behind the point grow again.
    """
    x = x.cast("double")
    finite = (x != 0) & ~F.isnan(x) & (F.abs(x) != float("inf"))
    places = F.abs(F.when(finite, F.log10(F.abs(x)) - digits).cast("int"))
    text = F.call_function("format_string", F.concat(F.lit("%."), places.cast("string"), F.lit("f")), x)
    return F.when(x == 0, "0").when(finite, text).otherwise(x.cast("string"))


def human_count(x: Column) -> Column:
    """1234567 as 1.23M, by powers of a thousand; below a thousand unchanged."""
    scaled = lambda k, unit: F.concat((F.floor(x / (k / 100)) / 100).cast("string"), F.lit(unit))
    return (
        F.when(x >= 10**15, scaled(10**15, "P")).when(x >= 10**12, scaled(10**12, "T")).when(x >= 10**9, scaled(10**9, "G"))
        .when(x >= 10**6, scaled(10**6, "M")).when(x >= 10**3, scaled(10**3, "K")).otherwise(x.cast("string"))
    )
