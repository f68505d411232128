"""Extreme-forecast indices of an ensemble against climatological quantiles, and the rank significance test.

Members and quantiles meet as arrays of one row a point (some 50 members, 101 quantiles), so the theta comparison of
every member with every quantile never becomes rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from nimbria.functions.columns import NAN, normal_cdf


def efi_coefficients(n: int, eps: float = -1.0) -> tuple[list[float], float]:
    """(alpha_i, beta) with index = sum alpha_i F_i + beta, for F linear between ``n`` even levels (Lalaurette 2003)."""
    p = [i / (n - 1) for i in range(n)]
    alpha, beta = [0.0] * n, 0.0
    for i in range(n - 1):
        dp = p[i + 1] - p[i]
        da = math.acos(math.sqrt(p[i + 1])) - math.acos(math.sqrt(p[i]))
        ds = math.sqrt(p[i + 1] * (1 - p[i + 1])) - math.sqrt(p[i] * (1 - p[i]))
        # segment: (1 - s)(-da - ds) + (s p_i - F_i)(-2 da), s = (F_{i+1} - F_i) / dp
        slope = (da + ds) - 2 * da * p[i]
        beta += -da - ds
        alpha[i + 1] += slope / dp
        alpha[i] += -slope / dp + 2 * da
    return [2 / math.pi * a for a in alpha], 2 / math.pi * beta


def _sides(members: DataFrame, quantiles: DataFrame, keys: list[str]) -> DataFrame:
    m = members.groupBy(*keys).agg(F.sort_array(F.collect_list("value")).alias("m"))
    q = quantiles.groupBy(*keys).agg(F.transform(F.sort_array(F.collect_list(F.struct("quantile", "value"))), lambda x: x["value"]).alias("q"))
    return m.join(q, keys)


def efi(members: DataFrame, quantiles: DataFrame, keys: list[str], n_quantiles: int = 101, eps: float = -1.0) -> DataFrame:
    """(keys, efi): quantiles (keys, quantile 0..n-1, value). With ``eps`` >= 0 members and quantiles at most eps count as
    eps, and quantiles not above it take no part, the rest being rescaled. NaN if a member or quantile is NaN."""
    return _sides(members, quantiles, keys).select(*keys, _efi("m", n_quantiles, eps).alias("efi"))


def _efi(m: str, n: int, eps: float) -> Column:
    """The index of the members in the array column ``m`` against the quantiles in ``q``."""
    alpha, beta = efi_coefficients(n)
    share = F.transform("q", lambda q: F.size(F.filter(m, lambda x: x <= q)) / F.size(m))
    weights = F.array(*[F.lit(a) for a in alpha])
    value = F.aggregate(F.zip_with(share, weights, lambda f, a: f * a), F.lit(beta), lambda acc, x: acc + x)
    if eps >= 0:
        value = _efi_above(share, eps, n)
    bad = F.exists(m, F.isnan) | F.exists("q", F.isnan) | (F.size(m) == 0)
    return F.when(bad | (F.size("q") != n), F.lit(NAN)).otherwise(value)


def indices(members: DataFrame, quantiles: DataFrame, keys: list[str], n_quantiles: int = 101, eps: float = -1.0, control: int | None = None, tails: tuple[int, ...] = (), crossing: bool = False) -> DataFrame:
    """(keys, efi, efi_control, sot10, sot90, cpf as asked for): members and climatology meet once for all indices.

    ``control`` is the number of the control member, whose index alone is ``efi_control`` (NaN without it); ``tails`` are the
    levels of the shift of tails, which needs percentiles (``n_quantiles`` = 101).
    """
    if tails and n_quantiles != 101:
        raise ValueError("the shift of tails needs 101 quantiles")
    alone = members.where(F.col("number") == control).groupBy(*keys).agg(F.collect_list("value").alias("c")) if control is not None else None
    rows = _sides(members, quantiles, keys)
    out = {"efi": _efi("m", n_quantiles, eps)}
    if alone is not None:
        rows = rows.join(alone, keys, "left").withColumn("c", F.coalesce("c", F.array().cast("array<double>")))
        out["efi_control"] = _efi("c", n_quantiles, eps)
    for level in tails:
        out[f"sot{level}"] = _sot(level)
    if crossing:
        rows, out["cpf"] = _cpf(rows, n_quantiles, True)
    return rows.select(*keys, *[c.alias(name) for name, c in out.items()])


def _sot(level: int) -> Column:
    """The shift of tails from the sorted members ``m`` and the percentiles ``q``."""
    if level not in (10, 90):
        raise ValueError("shift of tails is defined at 10 and 90")
    place = (F.size("m") - 1) * (level / 100)
    low, high = F.get("m", F.floor(place).cast("int")), F.get("m", F.ceil(place).cast("int"))
    q0, qc = F.get("q", F.lit(99 if level == 90 else 1)), F.get("q", F.lit(level))
    value = (low + (high - low) * (place - F.floor(place)) - q0) / F.when(q0 == qc, F.lit(None)).otherwise(q0 - qc)
    return F.when(F.exists("m", F.isnan), F.lit(NAN)).otherwise(F.coalesce(value, F.lit(NAN)))


def _efi_above(share: Column, eps: float, n: int) -> Column:
    """The index integrated over the levels whose quantile exceeds eps only, rescaled by that part's own weight."""
    p = [i / (n - 1) for i in range(n)]
    total, weight = F.lit(0.0), F.lit(0.0)
    f = F.filter(F.transform(share, lambda x: x), lambda _: F.lit(True))
    for i in range(n - 1):
        da = math.acos(math.sqrt(p[i + 1])) - math.acos(math.sqrt(p[i]))
        ds = math.sqrt(p[i + 1] * (1 - p[i + 1])) - math.sqrt(p[i] * (1 - p[i]))
        s = (F.get(f, F.lit(i + 1)) - F.get(f, F.lit(i))) * (n - 1)
        part = (1 - s) * (-da - ds) + (s * p[i] - F.get(f, F.lit(i))) * (-2 * da)
        counts = F.get("q", F.lit(i)) > eps
        total = total + F.when(counts, part).otherwise(0.0)
        weight = weight + F.when(counts, F.lit(-da)).otherwise(0.0)
    return F.when(weight > 0, total / F.when(weight > 0, weight).otherwise(F.lit(1.0))).otherwise(F.lit(0.0))


def sot(members: DataFrame, quantiles: DataFrame, keys: list[str], level: int) -> DataFrame:
    """(keys, sot): shift of tails at 90 (against quantile 99) or 10 (against 1); NaN where the tail has no width."""
    if level not in (10, 90):
        raise ValueError("shift of tails is defined at 10 and 90")
    outer = 99 if level == 90 else 1
    m = members.groupBy(*keys).agg(F.percentile("value", F.lit(level / 100)).alias("qf"), F.max(F.isnan("value")).alias("bad"))
    q = quantiles.where(F.col("quantile").isin(level, outer)).groupBy(*keys).agg(F.max(F.when(F.col("quantile") == level, F.col("value"))).alias("qc"), F.max(F.when(F.col("quantile") == outer, F.col("value"))).alias("q0"))
    width = F.col("q0") - F.col("qc")
    value = (F.col("qf") - F.col("q0")) / F.when(width == 0, F.lit(None)).otherwise(width)
    return m.join(q, keys).select(*keys, F.when(F.col("bad"), F.lit(NAN)).otherwise(F.coalesce(value, F.lit(NAN))).alias("sot"))


def cpf(members: DataFrame, quantiles: DataFrame, keys: list[str], n_quantiles: int = 101, symmetric: bool = True) -> DataFrame:
    """(keys, cpf): the climatological level at which forecast and climatological distribution cross (Ben Bouallegue
    2015). The ensemble's function counts members below a quantile; the first level from which it lies below the
    climatological one, interpolated; from above (symmetric) if the forecast lies under the climate throughout."""
    rows, value = _cpf(_sides(members, quantiles, keys), n_quantiles, symmetric)
    return rows.select(*keys, value.alias("cpf"))


def _cpf(rows: DataFrame, n: int, symmetric: bool) -> tuple[DataFrame, Column]:
    """``rows`` (m, q) with the gaps between both distributions, and the level of their crossing."""
    level = F.sequence(F.lit(0), F.lit(n - 1))
    gap = F.transform(level, lambda i: F.size(F.filter("m", lambda m: m <= F.get("q", i))) / F.size("m") - i / (n - 1))
    rows = rows.withColumn("gap", gap)
    crosses = F.filter(F.sequence(F.lit(1), F.lit(n - 1)), lambda i: (F.get("gap", i - 1) > 0) & (F.get("gap", i) <= 0) | (F.get("gap", i - 1) < 0) & (F.get("gap", i) >= 0) if symmetric else (F.get("gap", i - 1) > 0) & (F.get("gap", i) <= 0))
    rows = rows.withColumn("at", F.get(crosses, F.lit(0)))
    before, after = F.get("gap", F.col("at") - 1), F.get("gap", "at")
    value = F.when(F.col("at").isNull(), F.when(F.aggregate("gap", F.lit(0.0), lambda a, x: a + x) > 0, 0.0).otherwise(1.0)).otherwise((F.col("at") - 1 + before / (before - after)) / (n - 1))
    bad = F.exists("m", F.isnan) | F.exists("q", F.isnan) | (F.size("q") != n)
    return rows, F.when(bad, F.lit(NAN)).otherwise(value)


def significance(first: DataFrame, second: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, significance): two-sided Wilcoxon-Mann-Whitney p-value in percent; normal approximation with tie correction
    and no continuity correction; 0 where all values are equal.

    Ranks are window functions over (keys): one shuffle, however many points.
    """
    both = first.select(*keys, "value", F.lit(1).alias("g")).unionByName(second.select(*keys, "value", F.lit(2).alias("g")))
    ties = Window.partitionBy(*keys, "value")
    ranked = both.withColumn("r", F.rank().over(Window.partitionBy(*keys).orderBy("value")) + (F.count("*").over(ties) - 1) / 2.0).withColumn("t", F.count("*").over(ties))
    s = ranked.groupBy(*keys).agg(
        F.sum(F.when(F.col("g") == 1, F.col("r"))).alias("r1"),
        F.count(F.when(F.col("g") == 1, 1)).cast("double").alias("n1"),
        F.count(F.when(F.col("g") == 2, 1)).cast("double").alias("n2"),
        F.sum((F.col("t") * F.col("t") - 1).cast("double")).alias("ties"),
    )
    n = F.col("n1") + F.col("n2")
    u1 = F.col("r1") - F.col("n1") * (F.col("n1") + 1) / 2
    u = F.greatest(u1, F.col("n1") * F.col("n2") - u1)
    variance = F.col("n1") * F.col("n2") / 12 * ((n + 1) - F.col("ties") / (n * (n - 1)))
    s = s.where("n1 > 0 and n2 > 0").withColumn("z", F.when(variance > 0, (u - F.col("n1") * F.col("n2") / 2) / F.sqrt(F.when(variance > 0, variance).otherwise(1.0))))
    p = F.least(F.lit(1.0), 2 * (1 - normal_cdf(F.col("z"))))
    return s.select(*keys, F.when(F.col("z").isNull(), 0.0).otherwise(100 * p).alias("significance"))
