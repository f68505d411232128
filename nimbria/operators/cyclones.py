"""Cyclone verification and annotation tables."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from nimbria.functions.geo import haversine_km
from nimbria.operators.components import components
from nimbria.sources.shared import shared_dir


def track_motion(tracks: DataFrame, keys: list[str], time: str = "step") -> DataFrame:
    """Tracks with dist (km from the previous point), accdist, speed (m/s) and dpdt, null at a track's first point."""
    order = Window.partitionBy(*keys).orderBy(time)
    before = lambda c: F.lag(c).over(order)
    hours = F.col(time) - before(time)
    dist = haversine_km(before("lat"), before("lon"), F.col("lat"), F.col("lon"))
    out = tracks.withColumn("dist", dist).withColumn("speed", F.col("dist") * 1000 / (hours * 3600)).withColumn("dpdt", (F.col("pres") - before("pres")) / hours)
    return out.withColumn("accdist", F.sum(F.coalesce("dist", F.lit(0.0))).over(order.rowsBetween(Window.unboundedPreceding, 0)))


def candidates(observed: DataFrame, predicted: DataFrame, threshold_km: float) -> DataFrame:
    """(step, obs, pred, dist): pairs of one step nearer than the threshold; an equi-join on step and on cells as wide as
    the threshold in latitude and, at the latitude of their band, in longitude, so that only neighbours meet."""
    band = threshold_km / 111.0
    farthest = F.least(F.lit(89.9), (F.abs(F.col("band")) + 2) * band)  # of any point in the band or next to it
    width = F.when(farthest >= 89.9, F.lit(360.0)).otherwise(2 * F.degrees(F.asin(F.least(F.lit(1.0), F.sin(F.lit(threshold_km / 6371.0 / 2)) / F.cos(F.radians(farthest))))))
    cells = F.greatest(F.floor(360.0 / width), F.lit(1))
    cell = F.floor(F.pmod(F.col("lon"), F.lit(360.0)) / (360.0 / cells))
    o = observed.select("step", F.col("id").alias("obs"), "lat", "lon", F.floor(F.col("lat") / band).alias("band"))
    o = o.select("step", "obs", "band", cell.alias("cell"), F.col("lat").alias("olat"), F.col("lon").alias("olon"))
    p = predicted.select("step", F.col("id").alias("pred"), "lat", "lon", F.explode(F.array(*[F.floor(F.col("lat") / band) + d for d in (-1, 0, 1)])).alias("band"))
    near = F.explode(F.array_distinct(F.array(*[F.pmod(cell + d, cells) for d in (-1, 0, 1)])))
    p = p.select("step", "pred", "band", near.alias("cell"), F.col("lat").alias("plat"), F.col("lon").alias("plon"))
    pairs = o.join(p, ["step", "band", "cell"]).withColumn("dist", haversine_km(F.col("olat"), F.col("olon"), F.col("plat"), F.col("plon")))
    return pairs.where(F.col("dist") < threshold_km).select("step", "obs", "pred", "dist")


def match(observed: DataFrame, predicted: DataFrame, threshold_km: float) -> DataFrame:
    """(step, outcome, obs, pred, dist) with outcome TP, FN or FP.

    Each observation takes its nearest prediction (ties: smaller id); observations go in id order, and one whose nearest
    is already taken is missed (it does not try the second nearest). So a prediction's claimant with the smallest id wins.
    """
    nearest = Window.partitionBy("step", "obs").orderBy("dist", "pred")
    first = candidates(observed, predicted, threshold_km).withColumn("r", F.row_number().over(nearest)).where("r = 1")
    claim = Window.partitionBy("step", "pred").orderBy("obs")
    hits = first.withColumn("r", F.row_number().over(claim)).where("r = 1").select("step", F.lit("TP").alias("outcome"), "obs", "pred", "dist")
    o = observed.select("step", F.col("id").alias("obs"))
    p = predicted.select("step", F.col("id").alias("pred"))
    none = F.lit(None)
    missed = o.join(hits, ["step", "obs"], "left_anti").select("step", F.lit("FN").alias("outcome"), "obs", none.cast("long").alias("pred"), none.cast("double").alias("dist"))
    false = p.join(hits, ["step", "pred"], "left_anti").select("step", F.lit("FP").alias("outcome"), none.cast("long").alias("obs"), "pred", none.cast("double").alias("dist"))
    return hits.unionByName(missed).unionByName(false)


def confusion(matched: DataFrame) -> DataFrame:
    """(step, tp, fn, fp, mean_dist)."""
    n = lambda o: F.count(F.when(F.col("outcome") == o, 1)).alias(o.lower())
    return matched.groupBy("step").agg(n("TP"), n("FN"), n("FP"), F.avg("dist").alias("mean_dist"))


def annotate(detected: DataFrame, grid_values: DataFrame, radius: float) -> DataFrame:
    """Each detection (id, step, i, j) with the least pressure and greatest wind (and where) of the grid cells (step, i, j,
    pres, wind) within ``radius`` cells: an equi-join on step and blocks of cells, then the exact distance."""
    size = max(1.0, float(radius))
    block = lambda c, d=0: F.floor(F.col(c) / size) + d
    d = detected.select("id", "step", F.col("i").alias("ci"), F.col("j").alias("cj"))
    d = d.withColumn("bi", F.explode(F.array(*[block("ci", k) for k in (-1, 0, 1)]))).withColumn("bj", F.explode(F.array(*[block("cj", k) for k in (-1, 0, 1)])))
    g = grid_values.withColumn("bi", block("i")).withColumn("bj", block("j"))
    near = d.join(g, ["step", "bi", "bj"]).where((F.col("i") - F.col("ci")) ** 2 + (F.col("j") - F.col("cj")) ** 2 <= radius * radius)
    low = F.min(F.struct("pres", "i", "j"))
    high = F.max(F.struct("wind", (-F.col("i")).alias("i"), (-F.col("j")).alias("j")))
    out = near.groupBy("id", "step").agg(low.alias("low"), high.alias("high"))
    return out.select("id", "step", F.col("low.pres").alias("pres_min"), F.col("low.i").alias("pres_i"), F.col("low.j").alias("pres_j"), F.col("high.wind").alias("wind_max"), (-F.col("high.i")).alias("wind_i"), (-F.col("high.j")).alias("wind_j"))


def best_track(rows: DataFrame, agencies: list[str], missing: float = -999.0) -> DataFrame:
    """Best-track rows with wind and pres from the first agency that reports them (columns <agency>_wind, <agency>_pres)."""
    known = lambda c: F.when(F.col(c) != missing, F.col(c))
    return rows.withColumn("wind", F.coalesce(*[known(f"{a}_wind") for a in agencies])).withColumn("pres", F.coalesce(*[known(f"{a}_pres") for a in agencies]))


def density_clusters(cells: DataFrame, keys: list[str], eps: float, min_weight: float) -> DataFrame:
    """(keys, cluster, i, j, weight): weighted density clustering of each step's cells (i, j, weight) above a detection
    threshold; i and j are weighted centroids.

    A cell whose neighbours within ``eps``, itself included, weigh at least ``min_weight`` is a core; cores within ``eps`` of each
    other are one cluster, numbered by its least core (i, then j); another cell joins the first cluster that has a core
    within ``eps`` of it. Cells meet by an equi-join on blocks as wide as ``eps``, clusters are connected components.
    """
    shared_dir(cells.sparkSession)
    block = lambda c, d=0: F.floor(F.col(c) / eps) + d
    rows = cells.select(*keys, "i", "j", "weight").withColumn("n", F.monotonically_increasing_id()).checkpoint()
    own = rows.withColumn("bi", F.explode(F.array(*[block("i", k) for k in (-1, 0, 1)]))).withColumn("bj", F.explode(F.array(*[block("j", k) for k in (-1, 0, 1)])))
    other = rows.select(*keys, F.col("i").alias("oi"), F.col("j").alias("oj"), F.col("weight").alias("ow"), F.col("n").alias("o"), block("i").alias("bi"), block("j").alias("bj"))
    near = own.join(other, [*keys, "bi", "bj"]).where((F.col("i") - F.col("oi")) ** 2 + (F.col("j") - F.col("oj")) ** 2 <= eps * eps).select("n", "o", "ow").checkpoint()
    core = near.groupBy("n").agg(F.sum("ow").alias("w")).where(F.col("w") >= min_weight).select("n").checkpoint()
    reach = near.join(core.withColumnRenamed("n", "o"), "o").select("n", "o")  # of any cell, the cores near it
    roots = components(reach.join(core, "n").select(F.col("n").alias("a"), F.col("o").alias("b")))
    labelled = core.join(roots.withColumnRenamed("node", "n"), "n", "left").withColumn("root", F.coalesce("root", "n"))
    placed = labelled.join(rows, "n").groupBy("root", *keys).agg(F.min(F.struct("i", "j")).alias("first"))
    numbered = placed.withColumn("cluster", F.row_number().over(Window.partitionBy(*keys).orderBy("first")) - 1).select("root", "cluster")  # a row a cluster
    of = reach.join(labelled.select(F.col("n").alias("o"), "root"), "o").join(numbered, "root").groupBy("n").agg(F.min("cluster").alias("cluster"))
    w = F.sum("weight")
    return rows.join(of, "n").groupBy(*keys, "cluster").agg((F.sum(F.col("i") * F.col("weight")) / w).alias("i"), (F.sum(F.col("j") * F.col("weight")) / w).alias("j"), w.cast("double").alias("weight"))


def joined_predictions(predictions: DataFrame, annotations: DataFrame, keys: list[str]) -> DataFrame:
    """Positional zip of two array columns of each step; unequal lengths are an error row by row."""
    p = predictions.select(*keys, F.posexplode("predictions").alias("pos", "prediction"), F.size("predictions").alias("np"))
    a = annotations.select(*keys, F.posexplode("annotations").alias("pos", "annotation"), F.size("annotations").alias("na"))
    joined = p.join(a, [*keys, "pos"])
    fits = F.when(F.col("np") != F.col("na"), F.raise_error(F.lit("predictions and annotations differ in length"))).otherwise(F.col("pos"))
    return joined.select(*keys, fits.cast("int").alias("pos"), "prediction", "annotation")


def crop_normalise(cells: DataFrame, factors: DataFrame, rows: tuple[int, int], columns: tuple[int, int]) -> DataFrame:
    """Cells (param, i, j, value) of a window of the grid, re-indexed from 0, as (value - shift) / norm with ``factors``
    (param, shift, norm): a row a parameter, broadcast after a count."""
    inside = cells.where(F.col("i").between(rows[0], rows[1] - 1) & F.col("j").between(columns[0], columns[1] - 1))
    few = factors.limit(10_001).count() <= 10_000
    joined = inside.join(F.broadcast(factors) if few else factors, "param")
    out = joined.withColumns({"i": F.col("i") - rows[0], "j": F.col("j") - columns[0], "value": (F.col("value") - F.col("shift")) / F.col("norm")})
    return out.select(*cells.columns)


def detect(packed: DataFrame, model, keys: list[str], values: str = "values") -> DataFrame:
    """(keys, score array<double>) of a user's model over packed input arrays; ``model`` maps a (rows, size) matrix to a
    (rows, n) one and is called once a batch."""
    fields = ", ".join(f"`{k}` {packed.schema[k].dataType.simpleString()}" for k in keys)

    def run(batches):
        for batch in batches:
            if len(batch):
                out = batch[keys].copy()
                out["score"] = [r.tolist() for r in np.asarray(model(np.stack(batch[values].to_numpy())), float)]
                yield out

    return packed.select(*keys, values).mapInPandas(run, f"{fields}, score array<double>")


def snapshot(tracks: DataFrame, time=None, column: str = "time") -> DataFrame:
    """Best-track rows at one time, or all."""
    return tracks if time is None else tracks.where(F.col(column) == F.lit(time))


def summaries(tables: list[DataFrame]) -> DataFrame:
    """Per-file tables of several basins and days as one."""
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t, allowMissingColumns=True)
    return out
