"""Code histograms, dense-run checks, rates and agreement metrics."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def code_histogram(df: DataFrame, codes: str, domain: int) -> DataFrame:
    """(code, n): counts over a fixed domain, zero where a code is never used."""
    used = df.select(F.explode(codes).alias("code")).groupBy("code").agg(F.count("*").alias("n"))
    return zero_filled(df, used, ["code"], domain)


def zero_filled(df: DataFrame, used: DataFrame, keys: list[str], domain: int) -> DataFrame:
    codes = df.sparkSession.range(domain).select(F.col("id").cast("int").alias("code"))
    return codes.join(used, keys, "left").select("code", F.coalesce("n", F.lit(0)).alias("n"))


def position_histogram(df: DataFrame, codes: str) -> DataFrame:
    return df.select(F.posexplode(codes).alias("position", "code")).groupBy("position", "code").agg(F.count("*").alias("n"))


def collisions(df: DataFrame, keys: list[str], size: str) -> DataFrame:
    """One row: what a build keyed by `keys` keeps when members of a group overwrite each other from their start on."""
    groups = df.groupBy(*keys).agg(F.count("*").alias("n"), F.sum(size).alias("total"), F.max(size).alias("most"))
    return groups.agg(
        F.sum("total").alias("n_expected"),
        F.sum("most").alias("n_unique"),
        (F.sum("total") - F.sum("most")).alias("n_lost"),
        F.count_if(F.col("n") > 1).alias("n_collision_groups"),
    )


def dense_runs(df: DataFrame, keys: list[str], index: str) -> DataFrame:
    """By group: whether the index runs 0, 1, ... without holes or repeats."""
    g = df.groupBy(*keys).agg(F.min(index).alias("first_index"), F.max(index).alias("last_index"), F.count("*").alias("n"), F.count_distinct(index).alias("n_distinct"))
    return g.withColumn("is_dense", (F.col("first_index") == 0) & (F.col("last_index") == F.col("n") - 1) & (F.col("n_distinct") == F.col("n")))


def duplicates(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n"), F.count_distinct(value).alias("n_distinct")).filter("n <> n_distinct")


def rate(n: Column, seconds: Column) -> Column:
    return F.when(seconds > 0, n / seconds).otherwise(0.0)


def mean_of_means(df: DataFrame, keys: list[str], variant: str, value: str) -> DataFrame:
    """Mean over variants of each variant's mean: variants count the same whatever their number of trials."""
    return df.groupBy(*keys, variant).agg(F.avg(value).alias("_m")).groupBy(*keys).agg(F.avg("_m").alias("mean"))


def pearson(df: DataFrame, keys: list[str], sim: str, real: str, eps: float = 1e-8) -> DataFrame:
    """Correlation with eps in the denominator; 1 where the centred vectors are the same.

    Two passes: means by group, then sums of centred products; means are a row for each group.
    """
    means = df.groupBy(*keys).agg(F.avg(sim).alias("_ms"), F.avg(real).alias("_mr"))
    c = df.join(means, keys).select(*keys, (F.col(sim) - F.col("_ms")).alias("_s"), (F.col(real) - F.col("_mr")).alias("_r"))
    sums = c.groupBy(*keys).agg(F.sum(F.col("_s") * F.col("_r")).alias("_sr"), F.sum(F.col("_s") * F.col("_s")).alias("_ss"), F.sum(F.col("_r") * F.col("_r")).alias("_rr"), F.bool_and(F.col("_s") == F.col("_r")).alias("_same"))
    return sums.select(*keys, F.when(F.col("_same"), 1.0).otherwise(F.col("_sr") / (F.sqrt(F.col("_ss") * F.col("_rr")) + eps)).alias("pearson"))


def mean_maximum_rank_violation(df: DataFrame, keys: list[str], policy: str, sim: str, real: str) -> DataFrame:
    from .joins import rank_violations

    (task,) = keys
    return rank_violations(df, task, policy, sim, real).groupBy(task).agg(F.avg("violation").alias("mmrv"))


def expand_trials(n: Column, success: Column) -> Column:
    """n trials, ones first: round-half-even(n * success) of them; no success rate is none."""
    k = F.bround(n * F.coalesce(F.nanvl(success, F.lit(0.0)), F.lit(0.0))).cast("int")
    return F.concat(F.array_repeat(F.lit(1), k), F.array_repeat(F.lit(0), n - k))


def chi_square_tail(h: float, freedom: int) -> float:
    """P(X >= h) for a chi-square variable: the regularized upper incomplete gamma function, by series or continued fraction."""
    a, x = freedom / 2, h / 2
    if x <= 0:
        return 1.0
    scale = math.exp(-x + a * math.log(x) - math.lgamma(a))
    if x < a + 1:
        term = total = 1 / a
        k = a
        while abs(term) > 1e-16 * abs(total):
            k += 1
            term *= x / k
            total += term
        return max(0.0, 1 - total * scale)
    b, c = x + 1 - a, 1e300
    d = 1 / b
    f = d
    for i in range(1, 500):
        an = -i * (i - a)
        b += 2
        d, c = 1 / (an * d + b), b + an / c
        f *= d * c
        if abs(d * c - 1) < 1e-15:
            break
    return f * scale


def kruskal(df: DataFrame, keys: list[str], group: str, value: str) -> DataFrame:
    """(keys, h, p_value): Kruskal-Wallis with tie correction; when all values are equal, p is 1.

    Values are counted by (key, value, group) first, so ranks are sums over distinct values and no group of
    trials meets in one task; only the tail probability is computed in Python, a row for each key.
    """
    from pyspark.sql import Window

    cells = df.groupBy(*keys, value, group).agg(F.count("*").alias("n"))
    ties = cells.groupBy(*keys, value).agg(F.sum("n").alias("t"))
    w = Window.partitionBy(*keys).orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    ranked = ties.withColumn("rank", F.coalesce(F.sum("t").over(w), F.lit(0)) + (F.col("t") + 1) / 2)
    sums = cells.join(ranked, [*keys, value]).groupBy(*keys, group).agg(F.sum(F.col("n") * F.col("rank").cast("double")).alias("r"), F.sum("n").alias("n"))
    totals = sums.groupBy(*keys).agg(F.sum("n").cast("double").alias("all"))
    off = F.col("r") / F.col("n") - (F.col("all") + 1) / 2  # mean ranks from their mean: squares of ranks would cancel out
    h = sums.join(totals, keys).groupBy(*keys).agg(F.sum(F.col("n") * off * off).alias("s"), F.sum("n").alias("n"), F.count("*").alias("groups"))
    tied = ties.groupBy(*keys).agg(F.sum(F.pow(F.col("t").cast("double"), 3) - F.col("t")).alias("c"))
    n = F.col("n").cast("double")
    plain = F.lit(12.0) / (n * (n + 1)) * F.col("s")
    fixed = h.join(tied, keys).withColumn("_d", 1 - F.col("c") / (n * n * n - n)).withColumn("h", F.when(F.col("_d") > 0, plain / F.col("_d")).otherwise(0.0))

    @F.pandas_udf("double")
    def tail(h: pd.Series, groups: pd.Series) -> pd.Series:
        return pd.Series([chi_square_tail(x, int(g) - 1) if g > 1 else 1.0 for x, g in zip(h, groups, strict=True)])

    return fixed.select(*keys, "h", tail("h", F.col("groups")).alias("p_value"))


def oriented_box(df: DataFrame, keys: list[str], x: str, y: str) -> DataFrame:
    """(keys, angle, major, minor): axes of the population covariance of points, distinct after snapping is the caller's."""
    c = df.groupBy(*keys).agg(F.var_pop(x).alias("xx"), F.var_pop(y).alias("yy"), F.covar_pop(x, y).alias("xy"))
    half, gap = (F.col("xx") + F.col("yy")) / 2, (F.col("xx") - F.col("yy")) / 2
    spread = F.sqrt(gap * gap + F.col("xy") * F.col("xy"))
    return c.select(*keys, (0.5 * F.atan2(2 * F.col("xy"), F.col("xx") - F.col("yy"))).alias("angle"), (half + spread).alias("major"), (half - spread).alias("minor"))


def masked_mean(hit: Column, mask: Column) -> Column:
    """sum(hit * mask) / sum(mask), 0 for an empty mask."""
    total = F.sum(F.when(mask, 1).otherwise(0))
    return F.when(total > 0, F.sum(F.when(mask & hit, 1).otherwise(0)) / total).otherwise(0.0)
