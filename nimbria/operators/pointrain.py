"""Calibrated point rainfall: grid-box values become a distribution of point values by weather type.

Breakpoints and forecast-error ratios are lookup tables of a calibration, broadcast after a check of their rows. Cells meet
weather types by an equi-join on the bins of the first two predictors, whose edges are those of the types, and each
member's distribution stays one array a cell until it is aggregated.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nimbria.functions.columns import NAN, ratio
from nimbria.operators import intervals

PREDICTORS = 5
MOST_TYPES, MOST_ROWS, BINNED = 20_000, 200_000, 2
DRY_CODE = 99999


def weather_types(cells: DataFrame, breakpoints: DataFrame, predictors: list[str], rain: str = "rain", min_rain: float = 0.04) -> DataFrame:
    """``cells`` with ``wt``: the type whose ranges [inf_i, sup_i) hold all predictors (columns wt, inf_1, sup_1, ...).
    Cells with less rain than ``min_rain`` get DRY_CODE; cells that no type holds get null."""
    if breakpoints.limit(MOST_TYPES + 1).count() > MOST_TYPES:
        raise ValueError(f"more than {MOST_TYPES} weather types")
    table = breakpoints.select(F.col("wt").alias("__wt"), *[c for i in range(1, len(predictors) + 1) for c in (f"inf_{i}", f"sup_{i}")])
    binned, inside = cells, F.lit(True)
    for i, p in enumerate(predictors[:BINNED], 1):
        ends = [c for c in (f"inf_{i}", f"sup_{i}")]
        edges = sorted({float(e) for r in table.select(*ends).distinct().collect() for e in r})  # of at most MOST_TYPES types
        steps, x = F.array(*[F.lit(e) for e in edges]), F.col(p).cast("double")
        if len(edges) <= 64:  # few edges are counted by compiled comparisons
            place = sum((F.when(x >= e, 1).otherwise(0) for e in edges), F.lit(0))
        else:
            place = F.size(F.filter(steps, lambda e, x=x: e <= x))
        binned = binned.withColumn(f"__b{i}", place)
        low, high = (F.array_position(steps, F.col(c).cast("double")) for c in ends)
        table = table.withColumn(f"__t{i}", F.explode(F.when(low < high, F.sequence(low, high - 1)).otherwise(F.array().cast("array<bigint>"))))
        inside = inside & (F.col(f"__b{i}") == F.col(f"__t{i}"))
    for i, p in enumerate(predictors[BINNED:], BINNED + 1):
        inside = inside & (F.col(p) >= F.col(f"inf_{i}")) & (F.col(p) < F.col(f"sup_{i}"))
    few = table.limit(MOST_ROWS + 1).count() <= MOST_ROWS
    joined = binned.join(F.broadcast(table) if few else table, inside, "left")
    dry = (F.col(rain) < min_rain) & ~F.isnan(rain)
    return joined.select(*cells.columns, F.when(dry, F.lit(DRY_CODE)).otherwise(F.col("__wt")).alias("wt"))


def calibrate(cells: DataFrame, ratios: DataFrame, rain: str = "rain") -> DataFrame:
    """``cells`` (with wt) and ``points``: rain * (ratio + 1) for each error ratio of its type (``ratios``: wt, fer
    array<double>), not below 0; and ``grid_scale``, their mean. Dry cells keep their rain as the only value."""
    if ratios.limit(MOST_TYPES + 1).count() > MOST_TYPES:
        raise ValueError(f"more than {MOST_TYPES} weather types")
    joined = cells.join(F.broadcast(ratios.select(F.col("wt").alias("__w"), "fer")), F.col("wt") == F.col("__w"), "left").drop("__w")
    spread = F.transform("fer", lambda r: F.greatest(F.col(rain) * (r + 1), F.lit(0.0)))
    points = F.when(F.isnan(rain), F.array(F.lit(NAN))).when(F.col("fer").isNull(), F.array(F.col(rain))).otherwise(spread)
    out = joined.withColumn("points", points).drop("fer")
    return out.withColumn("grid_scale", F.aggregate("points", F.lit(0.0), lambda a, x: a + x) / F.size("points"))


def point_quantiles(calibrated: DataFrame, keys: list[str], levels: list[float]) -> DataFrame:
    """(keys, level, value): quantiles over members and error ratios together."""
    rows = calibrated.select(*keys, F.explode("points").alias("__p"))
    made = rows.groupBy(*keys).agg(F.percentile("__p", F.array(*[F.lit(q) for q in levels])).alias("__q"))
    named = F.array(*[F.lit(q) for q in levels])
    return made.select(*keys, F.posexplode("__q").alias("__i", "value")).select(*keys, F.get(named, F.col("__i")).alias("level"), "value")


def radiation_window(start: int, end: int) -> tuple[int, int]:
    """The 24-hour radiation predictor looks at the first day when a window ends before it."""
    last = max(end, 24)
    return max(last - 24, 0), last


def dependencies(main_steps: list[int], available: dict[str, list[int]]) -> dict[str, list[int]]:
    """Steps of each predictor strictly inside the main window, its ends included."""
    low, high = min(main_steps), max(main_steps)
    return {p: [s for s in steps if low <= s <= high] for p, steps in available.items()}


#: Parameters of the predictand and the predictors, by role; a configuration may name others.
PARAMS = {"rain": "tp", "convective": "cp", "u": "u", "v": "v", "cape": "mxcape6", "radiation": "cdir"}
PREDICTOR_COLUMNS = ["cpr", "rain", "ws", "cape", "radiation"]


def predictors(fields: DataFrame, windows: list[tuple[int, int]], keys: list[str], params: dict[str, str] | None = None) -> DataFrame:
    """(keys, window_id, rain, cpr, ws, cape, radiation) from fields (keys, param, step, value); keys hold member and point.

    Rain and convective rain are changes over the window (start, end), radiation over the 24 hours that ``radiation_window``
    names. Each wind component is a mean weighted by the time within the window that a step stands for, and the speed is
    of these means; cape is the greatest of the steps that reach into the window. Windows that lack a step, and cells that
    lack a field of any parameter, are left out; the steps of the parameters may differ.
    """
    names = {**PARAMS, **(params or {})}
    spark = fields.sparkSession
    rows = [(f"{a}-{b}", a, b, *radiation_window(a, b)) for a, b in windows]
    table = spark.createDataFrame(rows, "window_id string, start int, end int, sun_start int, sun_end int")
    kept = fields.where(F.col("param").isin(sorted(set(names.values()))))
    changes = {"rain": (names["rain"], ""), "convective": (names["convective"], ""), "radiation": (names["radiation"], "sun_")}
    roles = intervals.roles(kept, table, changes, {"u": names["u"], "v": names["v"]}, greatest={"cape": names["cape"]})
    made = intervals.gather(kept, roles, keys, [*changes, "u", "v"], ["cape"])
    speed = F.sqrt(F.col("u") * F.col("u") + F.col("v") * F.col("v"))
    return made.select(*keys, "window_id", "rain", ratio(F.col("convective"), F.col("rain")).alias("cpr"), speed.alias("ws"), "cape", "radiation")


def from_fields(fields: DataFrame, windows: list[tuple[int, int]], keys: list[str], types: DataFrame, ratios: DataFrame, params: dict[str, str] | None = None, min_rain: float = 0.04) -> DataFrame:
    """Calibrated cells (keys, window_id, wt, grid_scale, points) from fields: predictors, weather types, error ratios.

    Rain below ``min_rain`` is 0, and so is that of a cell that no type holds; a cell with a missing predictor is NaN.
    """
    cells = predictors(fields, windows, keys, params)
    missing = F.lit(False)
    for c in PREDICTOR_COLUMNS:
        missing = missing | F.isnan(c)
    typed = weather_types(cells, types, PREDICTOR_COLUMNS, min_rain=min_rain).withColumn("__missing", missing)
    wt = F.when(F.col("__missing"), NAN).otherwise(F.coalesce(F.col("wt").cast("double"), F.lit(0.0)))
    rain = F.when(F.col("__missing"), NAN).when((F.col("rain") < min_rain) | F.col("wt").isNull(), 0.0).otherwise(F.col("rain"))
    done = calibrate(typed.withColumn("rain", rain), ratios)
    alike = ratios.agg(F.max(F.size("fer"))).first()[0] or 1  # a cell without type has as many points as any other
    points = F.when(F.size("points") == 1, F.array_repeat(F.col("points")[0], int(alike))).otherwise(F.col("points"))
    return done.select(*keys, "window_id", wt.alias("wt"), "grid_scale", points.alias("points"))
