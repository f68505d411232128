"""Reductions across members and against a climatology. All are grouped aggregates: members combine map-side."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nimbria.functions.columns import COMPARE, NAN, any_nan, compare
from nimbria.operators.accumulate import binned, nan_guarded


def mean_std(members: DataFrame, keys: list[str], sample: bool = False) -> DataFrame:
    """(keys, mean, std): over all members of a key; population deviation, or of a sample."""
    std = F.stddev_samp("value") if sample else F.stddev_pop("value")
    return members.groupBy(*keys).agg(F.avg("value").alias("mean"), std.alias("std"))


def quantile_levels(spec: int | list[float]) -> tuple[list[float], list[str]]:
    """Levels and their labels: n gives n + 1 even levels labelled i:n; a list that is not even is labelled in percent."""
    if isinstance(spec, int):
        return [i / spec for i in range(spec + 1)], [f"{i}:{spec}" for i in range(spec + 1)]
    levels = [float(q) for q in spec]
    steps = {round(b - a, 12) for a, b in zip(levels, levels[1:], strict=False)}
    if len(steps) == 1 and levels[0] == 0 and levels[-1] == 1:
        n = len(levels) - 1
        return levels, [f"{i}:{n}" for i in range(n + 1)]
    return levels, [f"{round(q * 100)}:100" for q in levels]


def quantiles(members: DataFrame, keys: list[str], spec: int | list[float]) -> DataFrame:
    """(keys, quantile, level, value): linear interpolation between order statistics; NaN if a member is NaN."""
    levels, labels = quantile_levels(spec)
    made = members.groupBy(*keys).agg(F.percentile("value", F.array(*[F.lit(q) for q in levels])).alias("__q"), any_nan(F.col("value")).alias("__nan"))
    rows = made.select(*keys, "__nan", F.posexplode("__q").alias("__i", "__v"))
    at = lambda values: F.get(F.array(*[F.lit(v) for v in values]), F.col("__i"))
    return rows.select(*keys, at(labels).alias("quantile"), at(levels).alias("level"), F.when(F.col("__nan"), F.lit(NAN)).otherwise(F.col("__v")).alias("value"))


def histogram(members: DataFrame, keys: list[str], bins: list[float], mod: float | None = None, normalise: bool = True, scale_out: float = 1.0) -> DataFrame:
    """(keys, bin from 1, label, value): share (or count) of values over members and any further dimension in each bin."""
    n = len(bins) - 1
    placed = members.withColumn("__bin", binned(F.col("value"), tuple(bins), mod))
    counts = placed.groupBy(*keys).agg(*[F.count(F.when(F.col("__bin") == i, 1)).alias(f"__b{i}") for i in range(n)])
    total = sum((F.col(f"__b{i}") for i in range(n)), F.lit(0))
    shown = [F.when(total == 0, F.lit(NAN)).otherwise(F.col(f"__b{i}") / total) if normalise else F.col(f"__b{i}").cast("double") for i in range(n)]
    rows = counts.select(*keys, F.posexplode(F.array(*[s * scale_out for s in shown])).alias("__i", "value"))
    return rows.select(*keys, (F.col("__i") + 1).alias("bin"), F.concat(F.col("__i") + 1, F.lit(f":{n}")).alias("label"), "value")


def _hit(value: Column, sign: Column, threshold: Column) -> Column:
    out = F.lit(None).cast("boolean")
    for s in COMPARE:
        out = F.when(sign == s, compare(value, s, threshold)).otherwise(out)
    return out


def probability(members: DataFrame, thresholds: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, comparison, threshold, probability in percent): members with window_id joined to ``thresholds`` (window_id,
    comparison, threshold), a job's table. NaN if a member is NaN; a window without a threshold is an error."""
    few = thresholds.limit(10_001).count() <= 10_000
    joined = members.join(F.broadcast(thresholds) if few else thresholds, "window_id")
    share = F.avg(F.when(_hit(F.col("value"), F.col("comparison"), F.col("threshold")), 100.0).otherwise(0.0))
    return joined.groupBy(*keys, "comparison", "threshold").agg(nan_guarded(F.col("value"), share).alias("probability"))


def anomaly(forecast: DataFrame, climatology: DataFrame, on: list[str], standardised: bool = False) -> DataFrame:
    """``forecast`` with value - mean, or (value - mean) / std, of ``climatology`` (on..., mean, std). Where std is 0 the
    result is NaN for a difference of 0 and infinite else, as IEEE division gives."""
    joined = forecast.join(climatology, on)
    delta = F.col("value") - F.col("mean")
    if standardised:
        zero = F.when((delta == 0) | F.isnan(delta), F.lit(NAN)).otherwise(F.when(delta > 0, F.lit(float("inf"))).otherwise(F.lit(float("-inf"))))
        delta = F.when(F.col("std") == 0, zero).otherwise(delta / F.when(F.col("std") == 0, F.lit(1.0)).otherwise(F.col("std")))
    return joined.withColumn("value", delta).drop("mean", "std")


def mean_anomaly(forecast: DataFrame, climatology: DataFrame, keys: list[str], on: list[str]) -> DataFrame:
    """(keys, value): ensemble mean minus the climatological mean."""
    means = forecast.groupBy(*keys).agg(F.avg("value").alias("value"))
    return anomaly(means, climatology, on)


def climatology(samples: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, mean, std) of a climatological sample."""
    return samples.groupBy(*keys).agg(F.avg("value").alias("mean"), F.stddev_pop("value").alias("std"))


def spread_by_priority(spreads: DataFrame, keys: list[str], source_order: list[str]) -> DataFrame:
    """Mean spread over dates and steps, taking for each date the first source of ``source_order`` that has it."""
    rank = F.array_position(F.array(*[F.lit(s) for s in source_order]), F.col("source"))
    first = spreads.where(rank > 0).withColumn("__r", rank)
    best = first.groupBy(*keys, "date", "step").agg(F.min_by("value", "__r").alias("value"))
    return best.groupBy(*keys).agg(F.avg("value").alias("value"))


def statistics(fields: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, n, missing, minimum, maximum, mean, std) without NaN."""
    v = F.when(~F.isnan("value"), F.col("value"))
    return fields.groupBy(*keys).agg(F.count("*").alias("n"), F.count_if(F.isnan("value")).alias("missing"), F.min(v).alias("minimum"), F.max(v).alias("maximum"), F.avg(v).alias("mean"), F.stddev_pop(v).alias("std"))


def same_in_group(fields: DataFrame, keys: list[str], column: str) -> DataFrame:
    """``fields`` themselves; raises if ``column`` (a valid time, a step's length) differs within a key."""
    bad = fields.groupBy(*keys).agg(F.countDistinct(column).alias("n")).where("n > 1").take(1)
    if bad:
        raise ValueError(f"{column} differs within {bad[0].asDict()}")
    return fields
