"""Statistics: aggregate columns, and special functions in numpy for what SQL lacks."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def summary_columns(x: Column) -> list[Column]:
    """min, max, sum, mean, median, sample standard deviation, standard error and geometric mean (null unless all are over 0)."""
    return [
        F.min(x).alias("min"), F.max(x).alias("max"), F.sum(x).alias("sum"), F.avg(x).alias("mean"), F.median(x).alias("median"),
        F.stddev_samp(x).alias("stdev"), (F.stddev_samp(x) / F.sqrt(F.count(x))).alias("stderr"), F.when(F.min(x) > 0, F.exp(F.avg(F.ln(F.when(x > 0, x))))).alias("geo_mean"),
    ]


def tukey_biweight(df: DataFrame, key: str, x: str, c: float = 5.0, epsilon: float = 1e-4, out: str = "biweight") -> DataFrame:
    """One step of Tukey's biweight mean per key: two grouped aggregations after the median."""
    centre = df.groupBy(key).agg(F.median(x).alias("_m"))
    mad = df.join(centre, key).groupBy(key).agg(F.first("_m").alias("_m"), F.median(F.abs(F.col(x) - F.col("_m"))).alias("_s"))
    u = (F.col(x) - F.col("_m")) / (c * F.col("_s") + epsilon)
    w = F.when(F.abs(u) <= 1, F.pow(1 - u * u, 2)).otherwise(0.0)
    return df.join(mad, key).groupBy(key).agg((F.sum(w * F.col(x)) / F.sum(w)).alias(out))


def log_choose(n: float, k: float) -> float:
    return math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1)


def binomial_probability(k: int, n: int, p: float) -> float:
    if p in (0.0, 1.0):
        return float(k == n * p)
    return math.exp(log_choose(n, k) + k * math.log(p) + (n - k) * math.log1p(-p))


def binomial_tail(k: int, n: int, p: float, upper: bool = True) -> float:
    """Chance of k or more (upper) or of k or fewer of n."""
    return min(1.0, math.fsum(binomial_probability(i, n, p) for i in (range(k, n + 1) if upper else range(k + 1))))


def hypergeometric_tail(k: int, drawn: int, marked: int, total: int) -> float:
    """Chance of k or more marked ones among drawn of total."""
    top = min(drawn, marked)
    terms = (math.exp(log_choose(marked, i) + log_choose(total - marked, drawn - i) - log_choose(total, drawn)) for i in range(max(k, drawn + marked - total, 0), top + 1))
    return min(1.0, math.fsum(terms))


def incomplete_beta(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta function, by Lentz's continued fraction."""
    if x <= 0 or x >= 1:
        return float(x >= 1)
    if x > (a + 1) / (a + b + 2):
        return 1 - incomplete_beta(b, a, 1 - x)
    front = math.exp(a * math.log(x) + b * math.log1p(-x) - (math.lgamma(a) + math.lgamma(b) - math.lgamma(a + b))) / a
    tiny, f, c, d = 1e-300, 1.0, 1.0, 0.0
    for i in range(400):
        m = i // 2
        num = 1.0 if i == 0 else (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)) if i % 2 == 0 else -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)))
        d = 1 + num * d
        d = 1 / (d if abs(d) > tiny else tiny)
        c = 1 + num / c
        c = c if abs(c) > tiny else tiny
        f *= c * d
        if abs(1 - c * d) < 1e-13:
            break
    return front * (f - 1)


def f_test_p(f: float, df1: float, df2: float) -> float:
    if not f > 0:
        return 1.0
    if math.isinf(f):
        return 0.0
    return incomplete_beta(df2 / 2, df1 / 2, df2 / (df2 + df1 * f))


def t_test_p(t: float, df: float) -> float:
    return incomplete_beta(df / 2, 0.5, df / (df + t * t))


def incomplete_gamma(a: float, x: float) -> float:
    """Regularised lower incomplete gamma function."""
    if x <= 0:
        return 0.0
    if x < a + 1:
        term = total = 1 / a
        for n in range(1, 2000):
            term *= x / (a + n)
            total += term
            if term < total * 1e-15:
                break
        return total * math.exp(-x + a * math.log(x) - math.lgamma(a))
    b, c = x + 1 - a, 1e300
    d = 1 / b
    h = d
    for i in range(1, 2000):
        an = -i * (i - a)
        b += 2
        d = 1 / (an * d + b)
        c = b + an / c
        h *= c * d
        if abs(c * d - 1) < 1e-15:
            break
    return 1 - h * math.exp(-x + a * math.log(x) - math.lgamma(a))


def chi_square_quantile(p: float, df: float) -> float:
    lo, hi = 0.0, max(10.0, df * 10)
    while incomplete_gamma(df / 2, hi / 2) < p:
        hi *= 2
    for _ in range(200):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if incomplete_gamma(df / 2, mid / 2) < p else (lo, mid)
    return (lo + hi) / 2


def poisson_interval(count: int, level: float = 0.95) -> tuple[float, float]:
    """Exact limits for the mean of a Poisson count."""
    tail = (1 - level) / 2
    return (0.0 if count == 0 else chi_square_quantile(tail, 2 * count) / 2), chi_square_quantile(1 - tail, 2 * count + 2) / 2


def adjusted(p: np.ndarray, method: str = "holm") -> np.ndarray:
    """p values adjusted by Holm's or by Benjamini and Hochberg's method; NaN stays."""
    p = np.asarray(p, float)
    out, ok = np.full(len(p), np.nan), np.flatnonzero(~np.isnan(p))
    n = len(ok)
    if not n:
        return out
    order = ok[np.argsort(p[ok], kind="stable")]
    rank = np.arange(1, n + 1)
    if method == "holm":
        q = np.maximum.accumulate(p[order] * (n - rank + 1))
    elif method == "bh":
        q = np.minimum.accumulate((p[order] * n / rank)[::-1])[::-1]
    else:
        raise ValueError(f"unknown method {method}")
    out[order] = np.minimum(q, 1)
    return out


def adjusted_column(df: DataFrame, p: str, out: str, method: str = "bh") -> DataFrame:
    """The same for a column of any size: ranks and running extremes come from grouped counts of distinct p values, sorted by range."""
    from pyspark.sql import Window

    n = df.where(F.col(p).isNotNull() & ~F.isnan(p)).count()
    # Distinct p values rounded to 12 digits are few next to the rows; ties share one adjusted value.
    values = df.where(F.col(p).isNotNull() & ~F.isnan(p)).groupBy(p).agg(F.count(F.lit(1)).alias("_c"))
    up = Window.orderBy(p)
    ranked = values.withColumn("_to", F.sum("_c").over(up.rowsBetween(Window.unboundedPreceding, 0)))
    if method == "holm":
        q = F.max(F.col(p) * (n - (F.col("_to") - F.col("_c")))).over(up.rowsBetween(Window.unboundedPreceding, 0))
    elif method == "bh":
        q = F.min(F.col(p) * n / F.col("_to")).over(up.rowsBetween(0, Window.unboundedFollowing))
    else:
        raise ValueError(f"unknown method {method}")
    return df.join(ranked.select(F.col(p).alias("_p"), F.least(q, F.lit(1.0)).alias(out)), F.col(p) == F.col("_p"), "left").drop("_p")
