"""Associations by group, each with its own null distribution."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Fixed value: above so many points Kendall's p is the normal approximation.
KENDALL_EXACT_MAX = 200
#: Rows of a group whose pairs are counted; a larger one is refused by name.
KENDALL_MOST = 5_000_000


def average_ranks(rows: DataFrame, by: list[str], value: str, rank: str) -> DataFrame:
    """rows with the mean rank of ties. Ranks come from counts of distinct values, so repeated values cost nothing."""
    counts = rows.groupBy(*by, value).agg(F.count("*").alias("_c"))
    w = Window.partitionBy(*by).orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    ranks = counts.withColumn(rank, F.sum("_c").over(w) - (F.col("_c") - 1) / 2.0).drop("_c")
    return rows.join(ranks, [*by, value])


def moments(rows: DataFrame, by: list[str], x: str, y: str) -> DataFrame:
    """n, Pearson's r, r squared, slope and its standard error; refused (null) below three points or without variance."""
    cx, cy = F.col(x).cast("double"), F.col(y).cast("double")
    both = rows.where(cx.isNotNull() & cy.isNotNull())
    s = both.groupBy(*by).agg(F.count("*").alias("n"), F.regr_sxx(cy, cx).alias("sxx"), F.regr_syy(cy, cx).alias("syy"), F.regr_sxy(cy, cx).alias("sxy"))
    fine = (F.col("n") >= 3) & (F.col("sxx") > 0) & (F.col("syy") > 0)
    r = F.col("sxy") / F.sqrt(F.col("sxx") * F.col("syy"))
    slope = F.col("sxy") / F.col("sxx")
    se = F.sqrt(F.greatest(F.col("syy") - slope * F.col("sxy"), F.lit(0.0)) / (F.col("n") - 2) / F.col("sxx"))
    return s.select(*by, "n", F.when(fine, r).alias("pearson_r"), F.when(fine, r * r).alias("r_squared"), F.when(fine, slope).alias("slope"), F.when(fine, se).alias("slope_se"))


def spearman(rows: DataFrame, by: list[str], x: str, y: str) -> DataFrame:
    ranked = average_ranks(average_ranks(rows.where(F.col(x).isNotNull() & F.col(y).isNotNull()), by, x, "_rx"), by, y, "_ry")
    return moments(ranked, by, "_rx", "_ry").select(*by, "n", F.col("pearson_r").alias("spearman_rho"))


def inversions(ranks: np.ndarray) -> int:
    """Pairs in falling order, in n log n: bit by bit from the highest, ones before zeros among the values equal so far."""
    n, total = len(ranks), 0
    now = ranks.astype(np.int64)
    for bit in range(int(now.max(initial=0)).bit_length() - 1, -1, -1):
        one = (now >> bit) & 1
        before = np.cumsum(one) - one
        start = np.flatnonzero(np.diff(now >> (bit + 1), prepend=-1))
        base = np.repeat(before[start], np.diff(np.append(start, n)))
        total += int(((before - base) * (1 - one)).sum())
        now = now[np.argsort(now >> bit, kind="stable")]
    return total


def _pairs(*keys: np.ndarray) -> int:
    _, c = np.unique(np.stack(keys, axis=1), axis=0, return_counts=True)
    return int((c * (c - 1) // 2).sum())


def kendall(rows: DataFrame, by: list[str], x: str, y: str, order: str) -> DataFrame:
    """Tau-b of a group, counted in n log n; pairs tied in both count nowhere, and a group where one side is all tied has none (null).

    A group is one task's: one of more than KENDALL_MOST rows raises. Rows with a null take no part; order is not needed to count and stays for callers.
    """
    out = rows.select(*by).schema
    for name in ("concordant", "discordant", "ties_x", "ties_y"):
        out = out.add(name, "long")
    names = [f.name for f in out]

    def count(key, t):
        if t.num_rows > KENDALL_MOST:
            raise ValueError(f"a group of {t.num_rows} rows: Kendall's count is for groups of up to {KENDALL_MOST}")
        rank = lambda c: np.unique(t.column(c).to_numpy(), return_inverse=True)[1].astype(np.int64)
        a, b = rank("_x"), rank("_y")
        at = np.lexsort((b, a))
        n, down = len(a), inversions(b[at])
        tx, ty, both = _pairs(a), _pairs(b), _pairs(a, b)
        found = (n * (n - 1) // 2 - tx - ty + both - down, down, tx - both, ty - both)
        return pa.table([*[pa.array([k.as_py()], type=k.type) for k in key], *[pa.array([v], pa.int64()) for v in found]], names=names)

    both = rows.select(*by, F.col(x).cast("double").alias("_x"), F.col(y).cast("double").alias("_y")).where("_x is not null and _y is not null")
    sums = both.groupBy(*by).applyInArrow(count, out)
    c, d = F.col("concordant"), F.col("discordant")
    return sums.withColumn("tau_b", F.try_divide(c - d, F.sqrt((c + d + F.col("ties_x")).cast("double") * (c + d + F.col("ties_y")))))


def incomplete_beta(a: float, b: float, x: float) -> float:
    """Regularised, by the continued fraction in its modified Lentz form."""
    if x <= 0 or x >= 1:
        return float(x >= 1)
    if x > (a + 1) / (a + b + 2):
        return 1 - incomplete_beta(b, a, 1 - x)
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)) / a
    tiny, c, d, f = 1e-300, 1.0, 0.0, 1.0
    for step in range(600):
        m = step // 2
        term = 1.0 if step == 0 else m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)) if step % 2 == 0 else -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        d = 1 / (1 + term * d if abs(1 + term * d) > tiny else tiny)
        c = 1 + term / c if abs(1 + term / c) > tiny else tiny
        f *= c * d
        if step and abs(c * d - 1) < 1e-15:
            break
    return front * (f - 1)


def t_two_sided(t: float, df: float) -> float:
    return incomplete_beta(df / 2, 0.5, df / (df + t * t))


def f_upper(f: float, df1: float, df2: float) -> float:
    """The chance of an F at least as large."""
    return 0.0 if math.isinf(f) else 1.0 if f <= 0 else incomplete_beta(df2 / 2, df1 / 2, df2 / (df2 + df1 * f))


def kendall_exact_p(n: int, discordant: int) -> float:
    """Two-sided, from the number of permutations by inversions; whole numbers, no rounding before the end."""
    ways = [1]
    for k in range(2, n + 1):
        run, nxt = 0, []
        for i in range(len(ways) + k - 1):
            run += ways[i] if i < len(ways) else 0
            run -= ways[i - k] if i >= k else 0
            nxt.append(run)
        ways = nxt
    low = min(discordant, n * (n - 1) // 2 - discordant)
    return min(1.0, 2 * sum(ways[: low + 1]) / math.factorial(n))


def p_value(kind: str):
    """A pandas UDF: PEARSON or SPEARMAN (r, n), FISHER (r, n), R_SQUARED (r2, n), SLOPE (t, n), F (f, df1, df2), KENDALL (tau, n, discordant, ties)."""

    def of_r(r: pd.Series, n: pd.Series) -> pd.Series:
        def one(a, k):
            if pd.isna(a) or k <= 2:
                return None
            return 0.0 if abs(a) >= 1 else t_two_sided(a * math.sqrt((k - 2) / (1 - a * a)), k - 2)

        return pd.Series([one(a, k) for a, k in zip(r, n, strict=True)], dtype="float64")

    def of_t(t: pd.Series, n: pd.Series) -> pd.Series:
        return pd.Series([None if pd.isna(a) or k <= 2 else t_two_sided(a, k - 2) for a, k in zip(t, n, strict=True)], dtype="float64")

    def of_tau(tau: pd.Series, n: pd.Series, discordant: pd.Series, ties: pd.Series) -> pd.Series:
        def one(a, k, d, ti):
            if ti or pd.isna(a):
                return None
            return kendall_exact_p(int(k), int(d)) if k <= KENDALL_EXACT_MAX else math.erfc(abs(a) * math.sqrt(9 * k * (k - 1) / (2 * (2 * k + 5))) / math.sqrt(2))

        return pd.Series([one(*r) for r in zip(tau, n, discordant, ties, strict=True)], dtype="float64")

    def of_r2(r2: pd.Series, n: pd.Series) -> pd.Series:
        return pd.Series([None if pd.isna(a) or k <= 2 else 0.0 if a >= 1 else f_upper(a / (1 - a) * (k - 2), 1, k - 2) for a, k in zip(r2, n, strict=True)], dtype="float64")

    def of_f(f: pd.Series, df1: pd.Series, df2: pd.Series) -> pd.Series:
        return pd.Series([None if pd.isna(a) or u <= 0 or v <= 0 else f_upper(a, u, v) for a, u, v in zip(f, df1, df2, strict=True)], dtype="float64")

    def of_fisher(r: pd.Series, n: pd.Series) -> pd.Series:
        def one(a, k):
            if pd.isna(a) or k <= 3:
                return None
            return 0.0 if abs(a) >= 1 else math.erfc(abs(math.atanh(a)) * math.sqrt(k - 3) / math.sqrt(2))

        return pd.Series([one(a, k) for a, k in zip(r, n, strict=True)], dtype="float64")

    return F.pandas_udf({"PEARSON": of_r, "SPEARMAN": of_r, "FISHER": of_fisher, "R_SQUARED": of_r2, "F": of_f, "SLOPE": of_t, "KENDALL": of_tau}[kind], "double")


def slope_p(slope: Column, se: Column, n: Column) -> Column:
    """The slope's p; points on a line leave no residual, and p is 0."""
    return F.when((n > 2) & slope.isNotNull() & (se <= 0), 0.0).otherwise(p_value("SLOPE")(F.try_divide(slope, se), n))


def p_method(statistic: Column, n: Column, ties: Column) -> Column:
    """Which test belongs to a statistic; ties in ranks leave only the source's own p."""
    return (
        F.when(statistic == "PEARSON_R", "PEARSON_T_TEST")
        .when(statistic.isin("SPEARMAN_RHO", "KENDALL_TAU") & ties, "SOURCE_P_REQUIRED_TIES")
        .when(statistic == "SPEARMAN_RHO", "SPEARMAN_T_APPROX")
        .when(statistic == "KENDALL_TAU", F.when(n <= KENDALL_EXACT_MAX, "KENDALL_EXACT_PERMUTATION").otherwise("KENDALL_NORMAL_APPROX_N_GT_200"))
        .when(statistic == "R_SQUARED", "R_SQUARED_F_TEST")
        .when(statistic == "SLOPE", "SLOPE_T_TEST")
    )


def two_clusters(rows: DataFrame, by: list[str], value: str) -> DataFrame:
    """The best cut of each group's sorted values: separation = distance of the means over the sum of the deviations.

    Sums over the ordered window give both sides of every cut. A group splits if the index is at least 2 and the smaller side
    holds at least max(2, a quarter); ties go to the lower cut. Sums are of values less the group's mean, for precision.
    """
    g = Window.partitionBy(*by)
    up = g.orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    v = F.col("_v")
    x = rows.where(F.col(value).isNotNull()).withColumn("_v", F.col(value) - F.avg(value).over(g))
    x = x.withColumn("_n", F.count("*").over(g)).withColumn("_k", F.row_number().over(g.orderBy(value)))
    x = x.withColumn("_s", F.sum(v).over(up)).withColumn("_q", F.sum(v * v).over(up)).withColumn("_ts", F.sum(v).over(g)).withColumn("_tq", F.sum(v * v).over(g)).withColumn("_next", F.lead(value).over(g.orderBy(value)))
    k, n = F.col("_k"), F.col("_n")
    m1, m2 = F.col("_s") / k, (F.col("_ts") - F.col("_s")) / (n - k)
    s1, s2 = F.sqrt(F.greatest(F.col("_q") / k - m1 * m1, F.lit(0.0))), F.sqrt(F.greatest((F.col("_tq") - F.col("_q")) / (n - k) - m2 * m2, F.lit(0.0)))
    cut = x.where((k < n) & (F.col(value) < F.col("_next"))).select(*by, n.alias("n"), k.alias("n_low"), ((m2 - m1) / F.greatest(s1 + s2, F.lit(1e-12))).alias("separation"), F.col(value).alias("low_max"))
    best = cut.groupBy(*by).agg(F.max_by(F.struct("n", "n_low", "separation", "low_max"), F.struct("separation", -F.col("n_low"))).alias("_b")).select(*by, "_b.*")
    return best.withColumn("splits", (F.col("separation") >= 2) & (F.least(F.col("n_low"), F.col("n") - F.col("n_low")) >= F.greatest(F.lit(2), F.floor(F.col("n") / 4))))


def calibration(ticks: DataFrame, by: list[str], px: str, value: str) -> DataFrame:
    """Least squares of value on pixel, with the largest residual; null for fewer than two pixels or values."""
    fit = ticks.groupBy(*by).agg(F.regr_slope(value, px).alias("slope"), F.regr_intercept(value, px).alias("intercept"), F.countDistinct(px).alias("_p"), F.countDistinct(value).alias("_v"), F.count("*").alias("points"))
    fit = fit.where("_p >= 2 and _v >= 2").drop("_p", "_v")
    worst = ticks.join(fit, by).groupBy(*by).agg(F.max(F.abs(F.col("slope") * F.col(px) + F.col("intercept") - F.col(value))).alias("max_residual"))
    return fit.join(worst, by)


def ladder(ticks: DataFrame, by: list[str], px: str, value: str, tolerance: float = 0.08) -> DataFrame:
    """Whether labels step evenly: at least three, strictly monotone, value per pixel with a coefficient of variation within tolerance.

    Two labels on one pixel, or labels that do not change on the whole, are no ladder and have no coefficient.
    """
    w = Window.partitionBy(*by).orderBy(px)
    steps = ticks.withColumn("_dv", F.col(value) - F.lag(value).over(w)).withColumn("_dp", F.col(px) - F.lag(px).over(w)).where("_dp is not null")
    rate = F.try_divide("_dv", "_dp")
    s = steps.groupBy(*by).agg((F.count("*") + 1).alias("labels"), (F.min("_dv") > 0).alias("_up"), (F.max("_dv") < 0).alias("_down"), (F.min("_dp") > 0).alias("_apart"), F.stddev_pop(rate).alias("_s"), F.abs(F.avg(rate)).alias("_m"))
    cv = F.when(F.col("_apart"), F.try_divide("_s", "_m"))
    return s.select(*by, "labels", cv.alias("cv"), ((F.col("labels") >= 3) & (F.col("_up") | F.col("_down")) & F.coalesce(cv <= tolerance, F.lit(False))).alias("is_ladder"))
