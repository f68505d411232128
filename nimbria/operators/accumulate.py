"""Windowed accumulations: one scan feeds all windows through a join with the table of windows, then grouped folds.

The table of windows is a job's configuration; it is broadcast if it has at most MOST_ROWS rows and joined otherwise.
Fields hold one value per key and coordinate. A window is returned for a key only when it is complete: all
coordinates, or for sequential windows the last one.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as Over
from pyspark.sql import functions as F

from nimbria.functions.columns import NAN, any_nan, bin_index, floor_mod, least
from nimbria.plans import windows as W

MOST_ROWS, MOST_LITERALS = 100_000, 200


def _members(fields: DataFrame, windows: list[W.Window], dim: str) -> DataFrame:
    table = W.frame(fields.sparkSession, windows).withColumnRenamed("coord", "__coord")
    small = sum(len(w.coords) for w in windows) <= MOST_ROWS
    coords = W.needed_coords(windows)
    needed = fields.where(F.col(dim).between(coords[0], coords[-1]))  # reaches the scan
    if len(coords) <= MOST_LITERALS:
        needed = needed.where(F.col(dim).isin(coords))
    return needed.join(F.broadcast(table) if small else table, F.col(dim) == F.col("__coord")).drop("__coord")


def _complete() -> Column:
    return F.when(F.first("sequential"), F.max("__c") == F.first("last_coord")).otherwise(F.count("*") == F.first("n_needed"))


def _fold(windows: list[W.Window], value: Column, coord: Column) -> Column:
    """The aggregate of the operation that all ``windows`` share."""
    op = windows[0].op
    one = {w.window_id: w for w in windows}
    if op == "sum":
        return F.sum(value)
    if op == "minimum":
        return least(value)
    if op == "maximum":
        return F.max(value)
    if op == "mean":
        return F.avg(value)
    if op == "weighted_mean":
        return F.sum(value * F.col("weight"))
    if op == "integral":
        return F.sum((coord - F.col("__before")) * value)
    if op in ("difference", "difference_rate"):
        delta = F.when(F.first("n_coords") == 1, F.max_by(value, coord)).otherwise(F.max_by(value, coord) - F.min_by(value, coord))
        if op == "difference":
            return delta
        length = F.when(F.first("n_coords") == 1, F.first("last_coord")).otherwise(F.first("last_coord") - F.first("first_coord"))
        return delta / (F.lit(float(next(iter(one.values())).factor)) * length)
    if op == "standard_deviation":
        return F.stddev_pop(value)
    raise ValueError(op)


def accumulate(fields: DataFrame, windows: list[W.Window], keys: list[str], dim: str = "step", value: str = "value") -> DataFrame:
    """(keys, window_id, value; for histograms also bin, for aggregations also the dimension) of all complete windows.

    NaN propagates through every fold. Standard deviations are of the population. Histograms count right-open bins
    (with ``mod``, of the floor remainder, values outside wrapping to the last bin below and the first above); values
    outside are dropped, and a normalised histogram without any count is NaN.
    """
    groups: dict[tuple, list[W.Window]] = {}
    for w in windows:
        groups.setdefault((w.op, w.deaccumulate, w.factor, w.bins, w.mod, w.normalise, w.scale_out), []).append(w)
    parts = []
    for group in groups.values():
        first = group[0]
        rows = _members(fields, group, dim).withColumn("__c", F.col(dim))
        by = ["window_id", *keys]
        dropped = 1 if first.deaccumulate else 0
        if first.deaccumulate:
            order = Over.partitionBy(*by).orderBy("__c")
            rows = rows.withColumn("__v", F.col(value) - F.lag(value).over(order)).withColumn("__n", F.row_number().over(order)).where("__n > 1")
            rows = rows.withColumn(value, F.col("__v")).drop("__v", "__n")
        if first.op == "weighted_mean" and any(w.weights is None for w in group) or first.op == "integral":
            dropped += 1
        rows = rows.withColumn("n_needed", F.col("n_coords") - dropped)
        if first.op == "integral":
            order = Over.partitionBy(*by).orderBy("__c")
            rows = rows.withColumn("__before", F.coalesce(F.lag("__c").over(order), F.col("first_coord"))).withColumn("sequential", F.lit(True))
        if first.op == "aggregation":
            every = Over.partitionBy(*by)
            done = F.when(F.col("sequential"), F.max("__c").over(every) == F.col("last_coord")).otherwise(F.count("*").over(every) == F.col("n_needed"))
            parts.append(rows.withColumn("__done", done).where("__done").select(*by, F.col(dim), F.col(value).alias("value")))
        elif first.op == "histogram":
            parts.append(_histogram(rows, first, by, value))
        else:
            made = rows.groupBy(*by).agg(_fold(group, F.col(value), F.col("__c")).alias("value"), _complete().alias("__done"))
            parts.append(made.where("__done").drop("__done"))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def binned(value: Column, bins: tuple[float, ...], mod: float | None = None) -> Column:
    """The bin of a value, after the optional modulo and wrap."""
    if mod is None:
        return bin_index(value, list(bins))
    v = floor_mod(value, float(mod))
    wrapped = F.when(v < bins[0], len(bins) - 2).when(v >= bins[-1], 0).otherwise(bin_index(v, list(bins)))
    return F.when(F.isnan(value), F.lit(None).cast("int")).otherwise(wrapped)


def _histogram(rows: DataFrame, w: W.Window, by: list[str], value: str) -> DataFrame:
    """Counts of each bin as one row of sums a key, then a row a bin: no join with the bins."""
    n = len(w.bins) - 1
    placed = rows.withColumn("__bin", binned(F.col(value), w.bins, w.mod))
    counts = [F.count(F.when(F.col("__bin") == i, 1)).alias(f"__b{i}") for i in range(n)]
    made = placed.groupBy(*by).agg(*counts, _complete().alias("__done")).where("__done")
    total = reduce(lambda a, b: a + b, [F.col(f"__b{i}") for i in range(n)])
    shown = [F.when(total == 0, F.lit(NAN)).otherwise(F.col(f"__b{i}") / total) if w.normalise else F.col(f"__b{i}").cast("double") for i in range(n)]
    made = made.select(*by, F.posexplode(F.array(*[s * w.scale_out for s in shown])).alias("bin", "value"))
    return made


def accumulate_dims(fields: DataFrame, dims: dict[str, list[W.Window]], keys: list[str], value: str = "value") -> DataFrame:
    """Nested accumulation over several dimensions: the last one folds first. Columns window_<dim> name the windows."""
    out = fields
    names = list(dims)
    done: list[str] = []
    for dim in reversed(names):
        rest = [d for d in names if d != dim and d not in done]
        carried = [f"window_{d}" for d in done]
        out = accumulate(out, dims[dim], [*keys, *rest, *carried], dim, value).withColumnRenamed("window_id", f"window_{dim}")
        if any(w.op == "aggregation" for w in dims[dim]):
            out = out.withColumnRenamed(dim, f"{dim}_coord")
            keys = [*keys, f"{dim}_coord"]
        value = "value"
        done.append(dim)
    return out


def remaining(windows: list[W.Window], done: set[str]) -> list[W.Window]:
    """Windows still to do after a restart."""
    return [w for w in windows if w.window_id not in done]


def check_members(fields: DataFrame, keys: list[str], total: int) -> DataFrame:
    """``fields`` themselves; raises EOFError if some key does not have exactly ``total`` members."""
    bad = fields.groupBy(*keys).agg(F.countDistinct("number").alias("n")).where(F.col("n") != total).take(1)
    if bad:
        raise EOFError(f"expected {total} members, found {bad[0].asDict()}")
    return fields


def nan_guarded(value: Column, result: Column) -> Column:
    """Aggregate result, NaN if any value of the group is NaN."""
    return F.when(any_nan(value), F.lit(NAN)).otherwise(result)
