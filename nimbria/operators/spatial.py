"""Spatial operators: regions and weights, regridding by a weights table, strike probability, spectra."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from nimbria.functions.geo import haversine_km, in_box


def region_weights(grid: DataFrame, north: float, west: float, south: float, east: float) -> DataFrame:
    """``grid`` (point_id, lat, lon) with ``weight``: cosine of latitude inside the box, normalised to sum 1, else 0."""
    w = grid.withColumn("__w", F.when(in_box(F.col("lat"), F.col("lon"), north, west, south, east), F.cos(F.radians("lat"))).otherwise(0.0))
    total = w.agg(F.sum("__w")).first()[0]
    return w.withColumn("weight", F.col("__w") / F.lit(float(total or 1.0))).drop("__w")


def regrid(fields: DataFrame, weights: DataFrame, keys: list[str], statistic: str | None = None) -> DataFrame:
    """Fields on the target grid: ``weights`` (in_point, out_point, w). The weighted mean, or with ``statistic`` the
    maximum, minimum or count of the contributing points. Partial sums combine before the shuffle on the target."""
    joined = fields.join(weights, F.col("point_id") == F.col("in_point"))
    by = [*keys, "out_point"]
    if statistic is None:
        value = F.sum(F.col("w") * F.col("value")) / F.sum("w")
    elif statistic in ("maximum", "minimum", "count"):
        value = {"maximum": F.max("value"), "minimum": F.min("value"), "count": F.count("value").cast("double")}[statistic]
    else:
        raise ValueError(f"unknown statistic {statistic!r}")
    return joined.groupBy(*by).agg(value.alias("value")).withColumnRenamed("out_point", "point_id")


def bilinear_weights(grid: DataFrame, target: DataFrame, dlat: float, dlon: float) -> DataFrame:
    """Weights (in_point, out_point, w) between regular grids: each target point meets the four corners of its cell by an
    equi-join on cell indices."""
    cell = lambda x, d: F.floor(F.col(x) / d).cast("long")
    source = grid.select(F.col("point_id").alias("in_point"), F.round(F.col("lat") / dlat).cast("long").alias("i"), F.round(F.col("lon") / dlon).cast("long").alias("j"))
    fy, fx = F.col("lat") / dlat - F.floor(F.col("lat") / dlat), F.col("lon") / dlon - F.floor(F.col("lon") / dlon)
    corner = lambda a, b: F.struct((cell("lat", dlat) + a).alias("i"), (cell("lon", dlon) + b).alias("j"), ((fy if a else 1 - fy) * (fx if b else 1 - fx)).alias("w"))
    wanted = target.select(F.col("point_id").alias("out_point"), F.explode(F.array(*[corner(a, b) for a in (0, 1) for b in (0, 1)])).alias("c")).select("out_point", "c.i", "c.j", "c.w")
    return wanted.where("w > 0").join(source, ["i", "j"]).select("in_point", "out_point", "w")


def nearest_weights(grid: DataFrame, target: DataFrame, dlat: float, dlon: float) -> DataFrame:
    """Weights that give each target point the value of the nearest point of a regular grid, by great-circle distance (ties:
    the smaller number): of the corners of its cell, met by an equi-join on cell indices that wrap at the date line."""
    turn = round(360 / dlon)
    source = grid.select(F.col("point_id").alias("in_point"), F.col("lat").alias("__la"), F.col("lon").alias("__lo"), F.round(F.col("lat") / dlat).cast("long").alias("i"), F.pmod(F.round(F.col("lon") / dlon).cast("long"), F.lit(turn)).alias("j"))
    corner = lambda a, b: F.struct((F.floor(F.col("lat") / dlat) + a).alias("i"), F.pmod(F.floor(F.col("lon") / dlon) + b, F.lit(turn)).alias("j"))
    wanted = target.select(F.col("point_id").alias("out_point"), "lat", "lon", F.explode(F.array(*[corner(a, b) for a in (0, 1) for b in (0, 1)])).alias("c")).select("out_point", "lat", "lon", "c.i", "c.j")
    near = F.min(F.struct(haversine_km(F.col("lat"), F.col("lon"), F.col("__la"), F.col("__lo")), "in_point"))
    return wanted.join(source, ["i", "j"]).groupBy("out_point").agg(near.alias("n")).select("n.in_point", "out_point", F.lit(1.0).alias("w"))


def box_weights(grid: DataFrame, factor: float) -> DataFrame:
    """Grid-box averaging: every source point falls in the target box of ``factor`` degrees."""
    box = F.floor((F.col("lat") + 90) / factor) * F.lit(int(360 / factor)) + F.floor(F.pmod(F.col("lon"), F.lit(360.0)) / factor)
    return grid.select(F.col("point_id").alias("in_point"), box.cast("int").alias("out_point"), F.lit(1.0).alias("w"))


def strike_probability(tracks: DataFrame, grid: DataFrame, radius_km: float, n_members: int, sub_steps: int = 4, min_wind: float | None = None, step_range: tuple[int, int] | None = None) -> DataFrame:
    """(point_id, probability in percent): members with a track point within ``radius_km``, each member once a point.

    Tracks (number, id, step, lat, lon, wind) are interpolated linearly in ``sub_steps`` parts between consecutive
    points. The distance join is an equi-join on latitude-longitude cells as wide as the radius, then the exact
    great-circle distance; the cells of a track point widen towards the poles and wrap at the date line.
    """
    t = tracks
    if min_wind is not None:
        t = t.where(F.col("wind") >= min_wind)
    if step_range is not None:
        t = t.where(F.col("step").between(*step_range))
    order = Window.partitionBy("number", "id").orderBy("step")
    t = t.select("number", "id", "step", "lat", "lon", F.lead("lat").over(order).alias("lat2"), F.lead("lon").over(order).alias("lon2"))
    k = F.explode(F.sequence(F.lit(0), F.when(F.col("lat2").isNull(), 0).otherwise(sub_steps - 1))).alias("k")
    share = F.col("k") / sub_steps
    t = t.select("number", "lat", "lon", "lat2", "lon2", k).select(
        "number", (F.col("lat") + share * (F.coalesce("lat2", "lat") - F.col("lat"))).alias("tlat"), (F.col("lon") + share * (F.coalesce("lon2", "lon") - F.col("lon"))).alias("tlon")
    )
    degrees = math.degrees(radius_km / 6371.0)
    rows = int(180 / degrees) + 1
    columns = max(1, int(360 / degrees))
    row = lambda lat: F.floor((lat + 90) / degrees)
    column = lambda lon: F.floor(F.pmod(lon, F.lit(360.0)) / (360 / columns))
    half = F.least(F.lit(180.0), F.degrees(F.asin(F.least(F.lit(1.0), math.sin(math.radians(degrees)) / F.greatest(F.cos(F.radians(F.abs("tlat"))), F.lit(1e-9))))))
    whole = (F.abs("tlat") + degrees >= 90) | (half >= 180)
    west, east = column(F.col("tlon") - half), column(F.col("tlon") + half)
    every = F.sequence(F.lit(0).cast("long"), F.lit(columns - 1).cast("long"))
    near = F.when(whole, every).when(west <= east, F.sequence(west, east)).otherwise(F.concat(F.sequence(west, F.lit(columns - 1).cast("long")), F.sequence(F.lit(0).cast("long"), east)))
    lows, highs = F.greatest(row(F.col("tlat") - degrees), F.lit(0).cast("long")), F.least(row(F.col("tlat") + degrees), F.lit(rows).cast("long"))
    t = t.select("number", "tlat", "tlon", F.explode(F.sequence(lows, highs)).alias("row"), near.alias("near")).select("number", "tlat", "tlon", "row", F.explode("near").alias("col"))
    g = grid.select("point_id", "lat", "lon", row(F.col("lat")).alias("row"), column(F.col("lon")).alias("col"))
    a = F.pow(F.sin(F.radians(F.col("lat") - F.col("tlat")) / 2), 2) + F.cos(F.radians("lat")) * F.cos(F.radians("tlat")) * F.pow(F.sin(F.radians(F.col("lon") - F.col("tlon")) / 2), 2)
    hits = t.join(g, ["row", "col"]).where(2 * 6371.0 * F.asin(F.sqrt(F.least(a, F.lit(1.0)))) <= radius_km).select("number", "point_id").distinct()
    return hits.groupBy("point_id").agg((100.0 * F.count("*") / n_members).alias("probability"))


def spectrum(coefficients: DataFrame, keys: list[str], kinetic: bool = False, log: bool = True) -> DataFrame:
    """(keys, n, energy): spectral energy by total wavenumber from (keys, n, m, re, im). Zonal terms count half. Vorticity
    and divergence (``kinetic``) weigh 1e6 / (n (n + 1)) and are scaled by n^(5/3)."""
    term = (F.col("re") * F.col("re") + F.col("im") * F.col("im")) * F.when(F.col("m") == 0, 0.5).otherwise(1.0)
    rows = coefficients.where("n > 0") if kinetic else coefficients
    if kinetic:
        term = term * 1e6 / (F.col("n") * (F.col("n") + 1)) * F.pow("n", F.lit(1.6666))
    energy = F.sum(term)
    return rows.groupBy(*keys, "n").agg(F.when(energy > 0, F.log10(energy)).alias("energy") if log else energy.alias("energy"))
