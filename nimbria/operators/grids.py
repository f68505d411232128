"""Gaussian grids, regular (``F``) and octahedral (``O``), and interpolation weights from them.

A grid of number N has 2 N rows of latitude at the roots of the Legendre polynomial of degree 2 N. A regular row has 4 N
points, an octahedral one 16 + 4 k, k counted from the nearer pole; all start at longitude 0. Points are numbered row by row
from the north. Target points meet the two rows around them by an equi-join on bins of latitude, and the points in a row by
arithmetic, so no table of grid points takes part; the table of rows is as long as 2 N and N is checked before it is
broadcast. Classic reduced grids have row lengths from lists of their own; such a list can be passed as ``lengths``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from nimbria.functions.geo import EARTH_KM, haversine_km

MOST_NUMBER, NEWTON = 8000, 6


def _parse(grid: str) -> tuple[str, int]:
    kind, number = grid[:1].upper(), grid[1:]
    if kind not in "FO" or not number.isdigit() or not 0 < int(number) <= MOST_NUMBER:
        raise ValueError(f"grid {grid!r} is not F or O with a number up to {MOST_NUMBER}")
    return kind, int(number)


def _root(k: Column, degree: int) -> tuple[Column, Column]:
    """The k-th root of the Legendre polynomial from 1 downward by Newton's iteration, and its Gaussian weight."""
    sequence = F.sequence(F.lit(2), F.lit(degree))

    def values(x: Column, done) -> Column:  # noqa: ANN001
        """``done`` of (P of the degree, P of the one below) at x."""
        start = F.struct(x.alias("p"), F.lit(1.0).alias("q"))
        step = lambda a, j: F.struct((((2 * j - 1) * x * a["p"] - (j - 1) * a["q"]) / j).alias("p"), a["p"].alias("q"))
        return F.aggregate(sequence, start, step, done)

    newton = lambda x, _: values(x, lambda a: x - a["p"] * (x * x - 1) / (degree * (x * a["p"] - a["q"])))
    first = F.cos(math.pi * (k - 0.25) / (degree + 0.5))
    x = F.aggregate(F.sequence(F.lit(1), F.lit(NEWTON)), first, newton)
    return x, lambda root: values(root, lambda a: 2 * (1 - root * root) / F.pow(degree * a["q"], F.lit(2.0)))


def rows(spark: SparkSession, grid: str, lengths: list[int] | None = None) -> DataFrame:
    """(row int from the north, mu, lat, weight double, n_lon int, first int): sine of latitude, Gaussian weight (their sum is
    2), number of points and the number of the first. ``lengths`` replaces the row lengths, from the north to the south."""
    kind, n = _parse(grid)
    half = F.least(F.col("id") + 1, 2 * n - F.col("id"))
    root, weigh = _root(half, 2 * n)
    table = spark.range(0, 2 * n, 1, min(8, 2 * n)).select(F.col("id").cast("int").alias("row"), half.alias("k"), root.alias("x"))
    table = table.withColumn("weight", weigh(F.col("x"))).withColumn("mu", F.when(F.col("row") < n, F.col("x")).otherwise(-F.col("x")))
    k = F.col("k")
    if lengths is not None:
        if len(lengths) != 2 * n:
            raise ValueError(f"{len(lengths)} row lengths for {2 * n} rows")
        starts = [sum(lengths[:i]) for i in range(2 * n)]
        n_lon, first = (F.get(F.array(*[F.lit(x) for x in xs]), F.col("row")) for xs in (lengths, starts))
    elif kind == "F":
        n_lon, first = F.lit(4 * n), F.col("row") * 4 * n
    else:
        n_lon = 16 + 4 * k
        first = F.when(F.col("row") < n, 16 * (k - 1) + 2 * k * (k - 1)).otherwise(2 * (16 * n + 2 * n * (n + 1)) - 16 * k - 2 * k * (k + 1))
    return table.select("row", "mu", F.degrees(F.asin("mu")).alias("lat"), "weight", n_lon.cast("int").alias("n_lon"), first.cast("int").alias("first"))


def points(spark: SparkSession, grid: str, lengths: list[int] | None = None) -> DataFrame:
    """(point_id int, lat, lon double) of a grid."""
    table = rows(spark, grid, lengths).withColumn("j", F.explode(F.sequence(F.lit(0), F.col("n_lon") - 1)))
    return table.select((F.col("first") + F.col("j")).alias("point_id"), "lat", (F.col("j") * 360.0 / F.col("n_lon")).alias("lon"))


def _bracketed(grid: str, target: DataFrame, lengths: list[int] | None) -> DataFrame:
    """Each target (out_point, lat, lon) with the rows north and south of it, in ``n`` and ``s``; beyond the first or last row
    that row is both. A target at a row's latitude has it to the north."""
    _, number = _parse(grid)
    table = rows(target.sparkSession, grid, lengths).select("row", F.struct("lat", "n_lon", "first").alias("r"))
    last = 2 * number - 1
    north = table.select((F.col("row")).alias("gap"), F.col("r").alias("n")).union(table.where("row = 0").select(F.lit(-1), "r"))
    south = table.select((F.col("row") - 1).alias("gap"), F.col("r").alias("s")).union(table.where(f"row = {last}").select(F.lit(last), "r"))
    width = 180.0 / (2 * number)
    cell = lambda lat: F.floor((90.0 - lat) / width)
    high = F.when(F.col("gap") < 0, 90.0).otherwise(F.col("n.lat"))
    low = F.when(F.col("gap") == last, -90.5).otherwise(F.col("s.lat"))
    gaps = north.join(south, "gap").select("n", "s", high.alias("high"), low.alias("low"))
    gaps = gaps.withColumn("cell", F.explode(F.sequence(cell(F.col("high")), cell(F.col("low")))))
    wanted = target.select(F.col("point_id").alias("out_point"), "lat", "lon", cell(F.col("lat")).alias("cell"))
    inside = (wanted["cell"] == gaps["cell"]) & (F.col("lat") <= F.col("high")) & (F.col("lat") > F.col("low"))
    return wanted.join(F.broadcast(gaps), inside).drop("cell")


def _beside(row: str, lon: Column) -> tuple[Column, Column, Column]:
    """Numbers of the points west and east of a longitude in a row, and how far it is from the one to the other."""
    n = F.col(f"{row}.n_lon")
    x = F.pmod(lon, F.lit(360.0)) * n / 360.0
    j = F.floor(x)
    return F.col(f"{row}.first") + F.pmod(j, n), F.col(f"{row}.first") + F.pmod(j + 1, n), x - j


def _first_within(row: str, lat: Column, lon: Column, km: Column) -> Column:
    """The smallest number of a row's points that lie within a distance of a place, null if none does."""
    n, north = F.col(f"{row}.n_lon"), F.col(f"{row}.lat")
    part = (F.pow(F.sin(km / (2 * EARTH_KM)), 2) - F.pow(F.sin(F.radians(north - lat) / 2), 2)) / (F.cos(F.radians(lat)) * F.cos(F.radians(north)))
    side = F.when(part >= 1, 180.0).when(part >= 0, F.degrees(2 * F.asin(F.sqrt(part))))  # degrees of longitude to either side
    x = F.pmod(lon, F.lit(360.0))
    j = F.when((x - side <= 0) | (x + side >= 360), 0).otherwise(F.ceil((x - side) * n / 360.0))
    return F.when(j * 360.0 / n <= F.greatest(x + side, F.lit(0.0)), F.col(f"{row}.first") + j)


def bilinear_weights(grid: str, target: DataFrame, lengths: list[int] | None = None) -> DataFrame:
    """(in_point, out_point, w) for ``target`` (point_id, lat, lon): linear along both rows around it, then between them.
    Beyond the outermost rows the nearer row alone counts. Targets with null or NaN coordinates have no weights."""
    both = _bracketed(grid, target.where("lat between -90 and 90 and not isnan(lon) and lon is not null"), lengths)
    down = F.when(F.col("n.lat") > F.col("s.lat"), (F.col("n.lat") - F.col("lat")) / (F.col("n.lat") - F.col("s.lat"))).otherwise(0.0)
    corners = []
    for row, share in (("n", 1 - down), ("s", down)):
        west, east, part = _beside(row, F.col("lon"))
        corners += [F.struct(west.cast("int").alias("p"), (share * (1 - part)).alias("w")), F.struct(east.cast("int").alias("p"), (share * part).alias("w"))]
    return both.select("out_point", F.explode(F.array(*corners)).alias("c")).where("c.w > 0").select(F.col("c.p").alias("in_point"), "out_point", F.col("c.w").alias("w"))


def nearest_weights(grid: str, target: DataFrame, lengths: list[int] | None = None) -> DataFrame:
    """(in_point, out_point, w = 1): the nearest point of the two rows around each target by great-circle distance in units of
    a tenth of a millimetre (1e-7 km), ties to the smaller number; so a pole takes the first point of its row."""
    both = _bracketed(grid, target.where("lat between -90 and 90 and not isnan(lon) and lon is not null"), lengths)
    near = []
    for row in ("n", "s"):
        west, east, _ = _beside(row, F.col("lon"))
        for p in (west, east):
            lon = (p - F.col(f"{row}.first")) * 360.0 / F.col(f"{row}.n_lon")
            near.append(F.struct(haversine_km(F.col("lat"), F.col("lon"), F.col(f"{row}.lat"), lon).alias("d"), p.cast("int").alias("p")))
    best = both.withColumn("best", F.array_min(F.array(*near)))
    reach = F.round("best.d", 7) + 5e-8  # what is nearer than this ties with the nearest
    first = [_first_within(row, F.col("lat"), F.col("lon"), reach) for row in ("n", "s")]  # numbers rise from north to south
    return best.select(F.coalesce(*first, F.col("best.p")).cast("int").alias("in_point"), "out_point", F.lit(1.0).alias("w"))
