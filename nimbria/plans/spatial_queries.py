"""Registered queries of thermal indices, point rainfall, space, cyclones, clustering, recovery and requests."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from nimbria.functions import geo, thermal
from nimbria.functions.columns import COMPARE, compare
from nimbria.operators import cluster as K
from nimbria.operators import cyclones as Y
from nimbria.operators import pointrain as R
from nimbria.operators import spatial as S
from nimbria.sources import cubes as C
from nimbria.sources.sinks import keep_latest

WEATHER_SQL = """weather AS (SELECT CAST(l_orderkey AS BIGINT) AS l_orderkey, l_linenumber, 250 + l_quantity AS t, 250 + l_quantity - 10 - l_tax * 50 AS td, l_discount * 100 + 1 AS ws FROM lineitem)"""


def _weather(spark, sf):
    items = C.table(spark, sf, "lineitem")
    return items.select("l_orderkey", "l_linenumber", (250 + F.col("l_quantity")).alias("t"), (250 + F.col("l_quantity") - 10 - F.col("l_tax") * 50).alias("td"), (F.col("l_discount") * 100 + 1).alias("ws"))


THERMAL = ["relative_humidity", "humidex", "wind_chill", "apparent_temperature", "normal_effective_temperature", "wet_bulb"]


def thermal_indices(spark, sf):
    out = thermal.indices(_weather(spark, sf), THERMAL)
    return out.select("l_orderkey", "l_linenumber", *[F.round(n, 5).alias(n) for n in THERMAL])


THERMAL_SQL = f"""WITH {WEATHER_SQL},
h AS (SELECT *, t - 273.15::DOUBLE AS c, 100 * (6.11 * pow(10.0, 7.5 * (td - 273.15) / (237.3 + td - 273.15))) / (6.11 * pow(10.0, 7.5 * (t - 273.15) / (237.3 + t - 273.15))) AS rh FROM weather)
SELECT l_orderkey, l_linenumber, round(rh, 5) AS relative_humidity, round(t + 0.5555 * (6.11 * exp(5417.7530 * (1 / 273.16::DOUBLE - 1 / td)) - 10), 5) AS humidex,
  round(13.12 + 0.6215 * c - 11.37 * pow(ws * 3.6, 0.16) + 0.3965 * c * pow(ws * 3.6, 0.16) + 273.15, 5) AS wind_chill,
  round(t + 0.33 * (rh / 100 * 6.105 * exp(17.27 * c / (237.7 + c))) - 0.7 * ws - 4, 5) AS apparent_temperature,
  round(37 - (37 - c) / (0.68 - 0.0014 * rh + 1 / (1.76 + 1.4 * pow(ws, 0.75))) - 0.29 * c * (1 - 0.01 * rh) + 273.15, 5) AS normal_effective_temperature,
  round(c * atan(0.151977 * sqrt(rh + 8.313659)) + atan(c + rh) - atan(rh - 1.676331) + 0.00391838 * pow(rh, 1.5) * atan(0.023101 * rh) - 4.686035 + 273.15, 5) AS wet_bulb
FROM h"""


def heat_index(spark, sf):
    out = _weather(spark, sf).withColumn("t", F.col("t") + 15).withColumn("td", F.col("td") + 15)
    return out.select("l_orderkey", "l_linenumber", F.round(thermal.heat_index(F.col("t"), F.col("td")), 5).alias("heat_index"))


def radiant_temperature(spark, sf):
    """Mean radiant, globe and wet-bulb globe temperature from fluxes made of prices."""
    items = C.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", (250 + F.col("l_quantity")).alias("t"), (245 + F.col("l_quantity")).alias("td"), (F.col("l_discount") * 100 + 1).alias("ws"), (F.col("l_extendedprice") / 100).alias("ssrd"), (F.col("l_extendedprice") / 130).alias("ssr"), (F.col("l_extendedprice") / 200).alias("fdir"), (F.lit(300.0) + F.col("l_quantity")).alias("strd"), (F.lit(-50.0) - F.col("l_quantity")).alias("strr"), (F.col("l_tax") * 10 + 0.1).alias("cossza"))
    out = thermal.indices(items, ["mean_radiant_temperature"]).withColumn("mrt", F.col("mean_radiant_temperature"))
    return thermal.indices(out, ["globe_temperature", "wet_bulb_globe"]).select("l_orderkey", "l_linenumber", *[F.round(n, 4).alias(n) for n in ("mean_radiant_temperature", "globe_temperature", "wet_bulb_globe")])


RADIANT_SQL = """WITH i AS (SELECT CAST(l_orderkey AS BIGINT) AS l_orderkey, l_linenumber, 250 + l_quantity AS t, 245 + l_quantity AS td, l_discount * 100 + 1 AS ws, l_extendedprice / 100 AS ssrd, l_extendedprice / 130 AS ssr, l_extendedprice / 200 AS fdir, 300.0::DOUBLE + l_quantity AS strd, -50.0::DOUBLE - l_quantity AS strr, l_tax * 10 + 0.1::DOUBLE AS z FROM lineitem),
s AS (SELECT *, degrees(asin(greatest(least(z, 1.0::DOUBLE), -1.0::DOUBLE))) AS gamma, CASE WHEN z > 0.01 THEN fdir / z ELSE 0 END AS sun FROM i),
m AS (SELECT *, pow((0.5 * strd + 0.5 * (strd - strr) + 0.7 / 0.97::DOUBLE * (0.5 * (ssrd - fdir) + 0.5 * (ssrd - ssr) + CASE WHEN z > 0.01 THEN 0.308 * cos(radians(gamma * (0.998 - gamma * gamma / 50000))) * sun ELSE 0 END)) / 5.67e-8, 0.25) AS mrt FROM s),
f AS (SELECT *, 1.1e8 * pow(ws, 0.6) / (0.95 * pow(0.15, 0.4)) AS f, 1.1e8 * pow(ws, 0.6) / (0.95 * pow(0.15, 0.4)) * t + pow(mrt, 4) AS goal FROM m),
g AS (SELECT *, list_reduce(list_concat([greatest(t, mrt)], [1.0::DOUBLE, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12]), lambda a, k: a - (a * a * a * a + f * a - goal) / (4 * a * a * a + f)) AS globe, t - 273.15::DOUBLE AS c,
  100 * pow(10.0, 7.5 * (td - 273.15) / (237.3 + td - 273.15)) / pow(10.0, 7.5 * (t - 273.15) / (237.3 + t - 273.15)) AS rh FROM f)
SELECT l_orderkey, l_linenumber, round(mrt, 4) AS mean_radiant_temperature, round(globe, 4) AS globe_temperature,
  round(0.7 * (c * atan(0.151977 * sqrt(rh + 8.313659)) + atan(c + rh) - atan(rh - 1.676331) + 0.00391838 * pow(rh, 1.5) * atan(0.023101 * rh) - 4.686035 + 273.15) + 0.2 * globe + 0.1 * t, 4) AS wet_bulb_globe FROM g"""


UTCI_SQL = f"""WITH {WEATHER_SQL}
SELECT round(ws, 6) AS ws, CAST(count(*) FILTER (t - 273.15 BETWEEN -70 AND 70 AND ws < 25 AND 0.5 * 6.105 * exp(17.27 * (t - 273.15) / (237.7 + t - 273.15)) <= 50 AND 4 * ws < 150 AND 4 * ws > -30) AS BIGINT) AS valid, CAST(count(*) AS BIGINT) AS n FROM weather GROUP BY ALL"""


def utci_validity(spark, sf):
    w = _weather(spark, sf)
    valid = thermal.utci_valid(F.col("t"), F.col("ws"), F.col("t") + 4 * F.col("ws"), thermal.vapour_pressure(F.col("t"), F.lit(50.0)))
    return w.groupBy("ws").agg(F.count_if(valid).alias("valid"), F.count("*").alias("n")).select(F.round("ws", 6).alias("ws"), "valid", "n").groupBy("ws").agg(F.sum("valid").alias("valid"), F.sum("n").alias("n"))


def _types(spark):
    rows = [(10 * a + b, 20.0 * a, 20.0 * a + 20, 2.5 * b, 2.5 * b + 2.5, -1e9, 1e9, -1e9, 1e9, -1e9, 1e9) for a in range(3) for b in range(4)]
    names = ", ".join(["wt int", *[f"inf_{i} double, sup_{i} double" for i in range(1, 6)]])
    bp = spark.createDataFrame(rows, names)
    fer = spark.createDataFrame([(r[0], [-0.5 + 0.1 * k + 0.01 * r[0] for k in range(5)]) for r in rows], "wt int, fer array<double>")
    return bp, fer


def _rain(spark, sf):
    items = C.table(spark, sf, "lineitem")
    return items.select(C.quarter("l_shipdate").alias("step"), F.col("l_linenumber").cast("int").alias("number"), (F.col("l_suppkey") % 20).cast("int").alias("point_id"), F.col("l_orderkey"), "l_quantity", (F.col("l_discount") * 100).alias("p2"), (F.col("l_quantity") - 3).alias("rain"), F.lit(0.0).alias("p3"), F.lit(0.0).alias("p4"), F.lit(0.0).alias("p5"))


def rain_weather_types(spark, sf):
    bp, _ = _types(spark)
    out = R.weather_types(_rain(spark, sf), bp, ["l_quantity", "p2", "p3", "p4", "p5"])
    return out.groupBy(F.coalesce("wt", F.lit(-1)).alias("wt")).agg(F.count("*").alias("n"), F.sum("rain").alias("rain"))


RAIN_SQL = """bp AS (SELECT CAST(10 * a + b AS INTEGER) AS wt, 20.0::DOUBLE * a AS lo, 20.0::DOUBLE * a + 20 AS hi, 2.5::DOUBLE * b AS lo2, 2.5::DOUBLE * b + 2.5 AS hi2 FROM range(0, 3) s(a), range(0, 4) t(b)),
cells AS (SELECT CAST((year(l_shipdate) - 1995) * 4 + quarter(l_shipdate) - 1 AS INTEGER) AS step, CAST(l_suppkey % 20 AS INTEGER) AS point_id, l_quantity, l_discount * 100 AS p2, l_quantity - 3 AS rain FROM lineitem),
typed AS (SELECT c.*, CASE WHEN rain < 0.04 THEN 99999 ELSE wt END AS wt FROM cells c LEFT JOIN bp ON l_quantity >= lo AND l_quantity < hi AND p2 >= lo2 AND p2 < hi2)"""


def rain_point_quantiles(spark, sf):
    bp, fer = _types(spark)
    typed = R.weather_types(_rain(spark, sf), bp, ["l_quantity", "p2", "p3", "p4", "p5"])
    out = R.point_quantiles(R.calibrate(typed, fer), ["step", "point_id"], [0.1, 0.5, 0.9])
    return out.select("step", "point_id", "level", F.round("value", 5).alias("value"))


def rain_grid_scale(spark, sf):
    bp, fer = _types(spark)
    typed = R.weather_types(_rain(spark, sf), bp, ["l_quantity", "p2", "p3", "p4", "p5"])
    return R.calibrate(typed, fer).groupBy("step", "point_id").agg(F.round(F.avg("grid_scale") + 1e-9, 6).alias("grid_scale"))


POINTS_SQL = f"""WITH {RAIN_SQL},
points AS (SELECT step, point_id, rain, l_quantity, p2, greatest(rain * (-0.5 + 0.1 * k + 0.01 * wt + 1), 0) AS p FROM typed, range(0, 5) t(k) WHERE wt <> 99999
  UNION ALL SELECT step, point_id, rain, l_quantity, p2, rain FROM typed WHERE wt = 99999 OR wt IS NULL)"""


def _grid(spark):
    return spark.range(36 * 18).select(F.col("id").cast("int").alias("point_id"), (F.floor(F.col("id") / 36) * 10 - 85).cast("double").alias("lat"), (F.col("id") % 36 * 10).cast("double").alias("lon"))


GRID_SQL = "grid AS (SELECT CAST(id AS INTEGER) AS point_id, CAST(id // 36 * 10 - 85 AS DOUBLE) AS lat, CAST(id % 36 * 10 AS DOUBLE) AS lon FROM range(0, 648) t(id))"


def region_weights(spark, sf):
    out = S.region_weights(_grid(spark), 65.0, 300.0, 15.0, 40.0)
    return out.select("point_id", F.round("weight", 8).alias("weight"))


def _tracks(spark, sf):
    e = C.table(spark, sf, "events")
    return e.select((F.col("user_id") % 25).cast("int").alias("number"), (F.col("event_id") % 3).cast("int").alias("id"), F.col("event_id").cast("int").alias("step"), ((F.col("event_id") * 7) % 120 - 60).cast("double").alias("lat"), ((F.col("event_id") * 11) % 360).cast("double").alias("lon"), F.col("value").alias("wind"))


def strike_probability(spark, sf):
    out = S.strike_probability(_tracks(spark, sf), _grid(spark), 700.0, 25, sub_steps=1)
    return out.select("point_id", F.round("probability", 6).alias("probability"))


STRIKE_SQL = f"""WITH {GRID_SQL},
t AS (SELECT user_id % 25 AS number, ((event_id * 7) % 120 - 60)::DOUBLE AS tlat, ((event_id * 11) % 360)::DOUBLE AS tlon FROM events),
u AS (SELECT DISTINCT * FROM t),
h AS (SELECT DISTINCT number, point_id FROM u, grid
  WHERE 2 * 6371.0 * asin(sqrt(least(1.0, pow(sin(radians(lat - tlat) / 2), 2) + cos(radians(lat)) * cos(radians(tlat)) * pow(sin(radians(lon - tlon) / 2), 2)))) <= 700)
SELECT point_id, round(100.0::DOUBLE * count(*) / 25, 6) AS probability FROM h GROUP BY ALL"""


def _gridded(spark, sf):
    """Fields of the events: each type is a step, its events' mean value at a point is the field."""
    e = C.table(spark, sf, "events")
    return e.groupBy(F.col("event_type").alias("step"), (F.col("event_id") % 648).cast("int").alias("point_id")).agg(F.avg("value").alias("value"))


GRIDDED_SQL = "fields AS (SELECT event_type AS step, CAST(event_id % 648 AS INTEGER) AS point_id, avg(value) AS value FROM events GROUP BY ALL)"


def regrid_box(spark, sf):
    weights, fields = S.box_weights(_grid(spark), 30.0), _gridded(spark, sf)
    mean = S.regrid(fields, weights, ["step"]).withColumnRenamed("value", "mean")
    top = S.regrid(fields, weights, ["step"], "maximum").withColumnRenamed("value", "top")
    return mean.join(top, ["step", "point_id"]).select("step", "point_id", F.round(F.col("mean") + 1e-9, 6).alias("mean"), F.round("top", 6).alias("top"))


REGRID_BOX_SQL = f"""WITH {GRID_SQL}, {GRIDDED_SQL},
b AS (SELECT point_id, CAST(floor((lat + 90) / 30) * 12 + floor(lon / 30) AS INTEGER) AS box FROM grid)
SELECT step, box AS point_id, round(avg(value) + 1e-9, 6) AS mean, round(max(value), 6) AS top FROM fields JOIN b USING (point_id) GROUP BY ALL"""


def regrid_bilinear(spark, sf):
    target = spark.range(50).select(F.col("id").cast("int").alias("point_id"), (F.col("id") * 2.0 - 51).alias("lat"), (F.col("id") * 5.0 + 3).alias("lon"))
    w = S.bilinear_weights(_grid(spark).withColumn("lat", F.col("lat") + 5), target, 10.0, 10.0)
    fields = C.table(spark, sf, "events").groupBy((F.col("event_id") % 648).cast("int").alias("point_id")).agg(F.avg("value").alias("value"))
    return S.regrid(fields.withColumn("step", F.lit(1)), w, ["step"]).select("point_id", F.round("value", 6).alias("value"))


REGRID_BILINEAR_SQL = """WITH v AS (SELECT event_id % 648 AS p, avg(value) AS v FROM events GROUP BY ALL),
t AS (SELECT id, (id * 2.0::DOUBLE - 51 + 80) / 10 AS y, (id * 5.0::DOUBLE + 3) / 10 AS x FROM range(0, 50) r(id)),
c AS (SELECT id, floor(y) + dy AS r, (floor(x) + dx) % 36 AS k, CASE dy WHEN 0 THEN 1 - (y - floor(y)) ELSE y - floor(y) END * CASE dx WHEN 0 THEN 1 - (x - floor(x)) ELSE x - floor(x) END AS w FROM t, range(0, 2) a(dy), range(0, 2) b(dx))
SELECT CAST(id AS INTEGER) AS point_id, round(sum(w * v), 6) AS value FROM c JOIN v ON p = r * 36 + k GROUP BY ALL"""


def spectrum(spark, sf):
    """Energy by wavenumber of coefficients made from embeddings: n = position div 8, m = position mod 8."""
    e = C.table(spark, sf, "embeddings").select("label", F.posexplode("embedding").alias("p", "re"))
    c = e.select("label", F.floor(F.col("p") / 8).cast("int").alias("n"), (F.col("p") % 8).alias("m"), F.col("re").cast("double").alias("re"), F.lit(0.0).alias("im"))
    return S.spectrum(c, ["label"], log=False).select("label", "n", F.round("energy", 5).alias("energy"))


SPECTRUM_SQL = """SELECT label, CAST(p // 8 AS INTEGER) AS n, round(sum(CAST(embedding[p + 1] AS DOUBLE) * CAST(embedding[p + 1] AS DOUBLE) * CASE WHEN p % 8 = 0 THEN 0.5::DOUBLE ELSE 1.0::DOUBLE END), 5) AS energy
FROM embeddings, range(0, 64) t(p) GROUP BY ALL"""


def _storms(spark, sf):
    """Observed storms from every event, forty a step, and a prediction near each; every third is far off."""
    e = C.table(spark, sf, "events").select((F.floor(F.col("event_id") / 40)).cast("int").alias("step"), F.col("event_id").alias("id"))
    lat, lon = ((F.col("id") * 13) % 700) / 10.0 - 35, ((F.col("id") * 17) % 900) / 10.0
    off = F.when(F.col("id") % 3 == 0, 170.0).otherwise(0.0)
    p = e.select("step", (F.col("id") + 1).alias("id"), (lat + (F.col("id") % 5) * 0.4).alias("lat"), (lon - (F.col("id") % 7) * 0.3 + off).alias("lon"))
    return e.select("step", "id", lat.alias("lat"), lon.alias("lon")), p


STORMS_SQL = """o AS (SELECT CAST(event_id // 40 AS INTEGER) AS step, event_id AS id, ((event_id * 13) % 700) / 10.0::DOUBLE - 35 AS lat, ((event_id * 17) % 900) / 10.0::DOUBLE AS lon FROM events),
p AS (SELECT step, id + 1 AS id, lat + (id % 5) * 0.4::DOUBLE AS lat, lon - (id % 7) * 0.3::DOUBLE + CASE WHEN id % 3 = 0 THEN 170 ELSE 0 END AS lon FROM o),
d AS (SELECT o.step, o.id AS obs, p.id AS pred, 2 * 6371.0::DOUBLE * asin(sqrt(least(1.0, pow(sin(radians(p.lat - o.lat) / 2), 2) + cos(radians(o.lat)) * cos(radians(p.lat)) * pow(sin(radians(p.lon - o.lon) / 2), 2)))) AS dist FROM o JOIN p ON o.step = p.step),
n AS (SELECT * FROM d WHERE dist < 300 QUALIFY row_number() OVER (PARTITION BY step, obs ORDER BY dist, pred) = 1),
hits AS (SELECT * FROM n QUALIFY row_number() OVER (PARTITION BY step, pred ORDER BY obs) = 1)"""


def storm_matching(spark, sf):
    out = Y.match(*_storms(spark, sf), 300.0)
    none = F.lit(-1).cast("long")
    return out.select("step", "outcome", F.coalesce("obs", none).alias("obs"), F.coalesce("pred", none).alias("pred"), F.round("dist", 5).alias("dist"))


def storm_confusion(spark, sf):
    out = Y.confusion(Y.match(*_storms(spark, sf), 300.0))
    return out.select("step", "tp", "fn", "fp", F.round("mean_dist", 5).alias("mean_dist"))


MATCH_SQL = f"""WITH {STORMS_SQL},
m AS (SELECT step, 'TP' AS outcome, obs, pred, dist FROM hits
UNION ALL SELECT step, 'FN', id, NULL, NULL FROM o WHERE NOT EXISTS (SELECT 1 FROM hits h WHERE h.step = o.step AND h.obs = o.id)
UNION ALL SELECT step, 'FP', NULL, id, NULL FROM p WHERE NOT EXISTS (SELECT 1 FROM hits h WHERE h.step = p.step AND h.pred = p.id))"""


def storm_annotation(spark, sf):
    items = C.table(spark, sf, "lineitem")
    cells = items.select((F.col("l_partkey") % 3).cast("int").alias("step"), (F.col("l_suppkey") % 30).cast("int").alias("i"), (F.col("l_partkey") % 31).cast("int").alias("j"), "l_quantity", "l_extendedprice")
    cells = cells.groupBy("step", "i", "j").agg(F.min("l_extendedprice").alias("pres"), F.max("l_quantity").alias("wind"))
    found = spark.range(12).select(F.col("id"), (F.col("id") % 3).cast("int").alias("step"), (F.col("id") * 2.5).alias("i"), (F.col("id") * 2.25).alias("j"))
    return Y.annotate(found, cells, 4.0)


ANNOTATE_SQL = """WITH g AS (SELECT CAST(l_partkey % 3 AS INTEGER) AS step, CAST(l_suppkey % 30 AS INTEGER) AS i, CAST(l_partkey % 31 AS INTEGER) AS j, min(l_extendedprice) AS pres, max(l_quantity) AS wind FROM lineitem GROUP BY ALL),
d AS (SELECT CAST(id AS BIGINT) AS id, CAST(id % 3 AS INTEGER) AS step, id * 2.5::DOUBLE AS ci, id * 2.25::DOUBLE AS cj FROM range(0, 12) t(id)),
n AS (SELECT id, d.step, i, j, pres, wind FROM d JOIN g ON d.step = g.step WHERE pow(i - ci, 2) + pow(j - cj, 2) <= 16),
lo AS (SELECT * FROM n QUALIFY row_number() OVER (PARTITION BY id, step ORDER BY pres, i, j) = 1),
hi AS (SELECT * FROM n QUALIFY row_number() OVER (PARTITION BY id, step ORDER BY wind DESC, i, j) = 1)
SELECT id, step, lo.pres AS pres_min, lo.i AS pres_i, lo.j AS pres_j, hi.wind AS wind_max, hi.i AS wind_i, hi.j AS wind_j FROM lo JOIN hi USING (id, step)"""


def track_motion(spark, sf):
    t = _tracks(spark, sf).withColumn("pres", 1000 - F.col("wind"))
    out = Y.track_motion(t, ["number", "id"])
    return out.select("number", "id", "step", F.round("dist", 4).alias("dist"), F.round("speed", 5).alias("speed"), F.round("accdist", 3).alias("accdist"), F.round("dpdt", 9).alias("dpdt"))


MOTION_SQL = """WITH t AS (SELECT CAST(user_id % 25 AS INTEGER) AS number, CAST(event_id % 3 AS INTEGER) AS id, CAST(event_id AS INTEGER) AS step, ((event_id * 7) % 120 - 60)::DOUBLE AS lat, ((event_id * 11) % 360)::DOUBLE AS lon, 1000 - value AS pres FROM events),
l AS (SELECT *, lag(lat) OVER o AS plat, lag(lon) OVER o AS plon, step - lag(step) OVER o AS h, pres - lag(pres) OVER o AS dp FROM t WINDOW o AS (PARTITION BY number, id ORDER BY step)),
d AS (SELECT *, CASE WHEN plat IS NOT NULL THEN 2 * 6371.0::DOUBLE * asin(sqrt(least(1.0, pow(sin(radians(lat - plat) / 2), 2) + cos(radians(plat)) * cos(radians(lat)) * pow(sin(radians(lon - plon) / 2), 2)))) END AS dist FROM l)
SELECT number, id, step, round(dist, 4) AS dist, round(dist * 1000 / (h * 3600), 5) AS speed, round(coalesce(sum(dist) OVER (PARTITION BY number, id ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0), 3) AS accdist, round(dp / h, 9) AS dpdt FROM d"""


def best_track(spark, sf):
    """First reporting agency, missing coded -999, of suppliers' balances by three agencies."""
    s = C.table(spark, sf, "supplier")
    gone = lambda c, k: F.when(F.col("s_suppkey") % k == 0, -999.0).otherwise(c)
    rows = s.select("s_suppkey", *[x for a, k in (("a", 2), ("b", 3), ("c", 5)) for x in (gone(F.col("s_acctbal") + k, k).alias(f"{a}_wind"), gone(F.col("s_acctbal") - k, k).alias(f"{a}_pres"))])
    return Y.best_track(rows, ["a", "b", "c"]).select("s_suppkey", F.round("wind", 4).alias("wind"), F.round("pres", 4).alias("pres"))


BEST_SQL = """SELECT s_suppkey, round(CASE WHEN s_suppkey % 2 <> 0 THEN s_acctbal + 2 WHEN s_suppkey % 3 <> 0 THEN s_acctbal + 3 WHEN s_suppkey % 5 <> 0 THEN s_acctbal + 5 END, 4) AS wind,
  round(CASE WHEN s_suppkey % 2 <> 0 THEN s_acctbal - 2 WHEN s_suppkey % 3 <> 0 THEN s_acctbal - 3 WHEN s_suppkey % 5 <> 0 THEN s_acctbal - 5 END, 4) AS pres FROM supplier"""


def cluster_gram(spark, sf):
    """Weighted inner products of members' anomalies."""
    weights = spark.range(20).select(F.col("id").cast("int").alias("point_id"), ((F.col("id") + 1) / 210.0).alias("weight"))
    out = K.gram(K.anomalies(C.fields(spark, sf)), weights)
    return out.select("a", "b", F.round("value", 4).alias("value"))


GRAM_SQL = f"""WITH {C.FIELDS_SQL},
a AS (SELECT step, point_id, number, value - avg(value) OVER (PARTITION BY step, point_id) AS v FROM fields)
SELECT x.number AS a, y.number AS b, round(sum((x.point_id + 1) / 210.0::DOUBLE * x.v * y.v), 4) AS value FROM a x JOIN a y ON x.step = y.step AND x.point_id = y.point_id AND x.number <= y.number GROUP BY ALL"""


def _vectors(spark, sf):
    e = C.table(spark, sf, "embeddings")
    return e.select(F.col("vec_id"), "label", F.posexplode("embedding").alias("component", "x")).select("vec_id", "label", "component", F.col("x").cast("double").alias("pc"))


def regime_attribution(spark, sf):
    """Nearest label mean by root mean square distance of each vector."""
    v = _vectors(spark, sf)
    regimes = v.groupBy(F.col("label").alias("regime"), "component").agg(F.avg("pc").alias("pc"))
    out = K.attribute(v.select("vec_id", "component", "pc"), regimes, ["vec_id"])
    return out.select("vec_id", "regime", F.round("rms", 6).alias("rms"))


ATTRIBUTION_SQL = """WITH v AS (SELECT vec_id, label, CAST(p AS INTEGER) AS component, CAST(embedding[p + 1] AS DOUBLE) AS pc FROM embeddings, range(0, 64) t(p)),
r AS (SELECT label AS regime, component, avg(pc) AS pc FROM v GROUP BY ALL),
d AS (SELECT vec_id, regime, sqrt(avg(pow(v.pc - r.pc, 2))) AS rms FROM v JOIN r USING (component) GROUP BY ALL)
SELECT vec_id, regime, round(rms, 6) AS rms FROM d QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY rms, regime) = 1"""


def cluster_representatives(spark, sf):
    """Vectors nearest to their label's mean."""
    v = _vectors(spark, sf)
    out = K.representatives(v.select(F.col("vec_id").alias("number"), "component", "pc"), v.select(F.col("vec_id").alias("number"), F.col("label").alias("cluster")).distinct())
    return out.select("cluster", "number", F.round("rms", 6).alias("rms"))


REPRESENTATIVES_SQL = """WITH v AS (SELECT vec_id, label, p, CAST(embedding[p + 1] AS DOUBLE) AS pc FROM embeddings, range(0, 64) t(p)),
m AS (SELECT label, p, avg(pc) AS mean FROM v GROUP BY ALL),
d AS (SELECT v.label AS cluster, vec_id AS number, sqrt(avg(pow(pc - mean, 2))) AS rms FROM v JOIN m ON v.label = m.label AND v.p = m.p GROUP BY ALL)
SELECT cluster, number, round(rms, 6) AS rms FROM d QUALIFY row_number() OVER (PARTITION BY cluster ORDER BY rms, number) = 1"""


def principal_components(spark, sf):
    """Explained variance of the leading member components (an eigenproblem, so no SQL)."""
    weights = spark.range(20).select(F.col("id").cast("int").alias("point_id"), F.lit(0.05).alias("weight"))
    made = K.components(K.anomalies(C.fields(spark, sf)), weights, 5)
    return spark.createDataFrame([(i, float(v), float(p), float(c)) for i, (v, p, c) in enumerate(zip(made.values, made.var_pct, made.var_cum, strict=True))], "component int, value double, var_pct double, var_cum double")


def ensemble_clusters(spark, sf):
    """Labels of the K-means partition of members in component space, numbered by size (iterative, so no SQL)."""
    weights = spark.range(20).select(F.col("id").cast("int").alias("point_id"), F.lit(0.05).alias("weight"))
    made = K.components(K.anomalies(C.fields(spark, sf)), weights, 3)
    label = K.by_size(K.lloyd(made.pc, 2, 1)[0], 2)
    return spark.createDataFrame([(int(m), int(c)) for m, c in zip(made.members, label, strict=True)], "number int, cluster int")


def cluster_partitions(spark, sf):
    """The best partitions of the members into two to four clusters; SQL tries all there are."""
    weights = spark.range(20).select(F.col("id").cast("int").alias("point_id"), ((F.col("id") + 1) / 210.0).alias("weight"))
    made = K.components(K.anomalies(C.fields(spark, sf)), weights, 7)
    out = K.partitions(spark, made.scaled(7), [2, 3, 4], 200)
    sizes = F.transform(F.sequence(F.lit(0), F.col("k") - 1), lambda c: F.size(F.filter("label", lambda x: x == c)))
    return out.select("k", F.round("within", 3).alias("within"), F.round("between", 3).alias("between"), F.round("ratio", 5).alias("ratio"), F.array_join(sizes, "/").alias("sizes"))


PARTITIONS_SQL = f"""WITH {C.FIELDS_SQL},
a AS (SELECT number, step, point_id, value - avg(value) OVER (PARTITION BY step, point_id) AS a FROM fields),
g AS (SELECT x.number AS i, y.number AS j, sum(x.a * y.a * (point_id + 1) / 210.0::DOUBLE) / (SELECT count(DISTINCT step) FROM fields) AS g FROM a x JOIN a y USING (step, point_id) GROUP BY ALL),
d AS (SELECT p.i, p.j, q.g + r.g - 2 * p.g AS d FROM g p JOIN g q ON q.i = p.i AND q.j = p.i JOIN g r ON r.i = p.j AND r.j = p.j WHERE p.i < p.j),
members AS (SELECT number, row_number() OVER (ORDER BY number) - 1 AS place FROM (SELECT DISTINCT number FROM fields)),
tried AS (SELECT k, code, number, CAST(floor(code / pow(k, place)) AS BIGINT) % k AS c FROM (VALUES (2), (3), (4)) AS t(k), range(0, 16384) AS u(code), members WHERE code < pow(k, 7)),
sizes AS (SELECT k, code, c, count(*) AS n FROM tried GROUP BY ALL),
fit AS (SELECT k, code, list(n ORDER BY n DESC) AS sizes FROM sizes GROUP BY ALL HAVING count(*) = k),
spread AS (SELECT x.k, x.code, sum(d / n) / (SELECT count(*) FROM members) AS within FROM tried x JOIN tried y ON x.k = y.k AND x.code = y.code AND x.c = y.c AND x.number < y.number JOIN d ON d.i = x.number AND d.j = y.number JOIN sizes s ON s.k = x.k AND s.code = x.code AND s.c = x.c GROUP BY ALL),
best AS (SELECT k, min(coalesce(within, 0)) AS within, arg_min(sizes, coalesce(within, 0)) AS sizes FROM fit LEFT JOIN spread USING (k, code) GROUP BY k),
total AS (SELECT sum(d) / pow((SELECT count(*) FROM members), 2) AS t FROM d)
SELECT CAST(k AS INTEGER) AS k, round(within, 3) AS within, round(t - within, 3) AS between, round((t - within) / within, 5) AS ratio, array_to_string(sizes, '/') AS sizes FROM best, total"""


def red_noise(spark, sf):
    """Variance ratios of red-noise surrogates (random, so no SQL)."""
    weights = spark.range(20).select(F.col("id").cast("int").alias("point_id"), F.lit(0.05).alias("weight"))
    made = K.components(K.anomalies(C.fields(spark, sf)), weights, 3)
    return K.surrogate_ratios(spark, made.pc, [2, 3], 10, passes=5)


def season_days(spark, sf):
    days = C.table(spark, sf, "orders").select(F.to_date("o_orderdate").alias("day")).distinct()
    return days.select("day", K.day_of_season(F.col("day"), K.season("10-4")).alias("dos")).where("dos is not null").groupBy("dos").agg(F.count("*").alias("n"))


SEASON_SQL = """WITH d AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS day FROM orders),
s AS (SELECT CASE WHEN month(day) = 2 AND day(day) = 29 THEN day - INTERVAL 1 DAY ELSE day END AS day FROM d WHERE month(day) >= 10 OR month(day) <= 4)
SELECT CAST(CASE WHEN month(day) >= 10 THEN date_diff('day', make_date(2001, 10, 1), make_date(2001, month(day), day(day))) ELSE date_diff('day', make_date(2001, 10, 1), make_date(2002, month(day), day(day))) END + 1 AS INTEGER) AS dos, CAST(count(*) AS BIGINT) AS n FROM s GROUP BY ALL"""


def gaps_and_islands(spark, sf):
    """Runs of consecutive event days of each user."""
    e = C.table(spark, sf, "events").select("user_id", F.date_diff(F.col("ts").cast("date"), F.lit("2024-01-01").cast("date")).alias("d")).distinct()
    run = F.col("d") - F.row_number().over(Window.partitionBy("user_id").orderBy("d"))
    return e.withColumn("run", run).groupBy("user_id", "run").agg(F.min("d").alias("first_day"), F.max("d").alias("last_day"), F.count("*").alias("days")).drop("run")


ISLANDS_SQL = """WITH e AS (SELECT DISTINCT user_id, CAST(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) AS INTEGER) AS d FROM events)
SELECT user_id, min(d) AS first_day, max(d) AS last_day, CAST(count(*) AS BIGINT) AS days FROM (SELECT *, d - row_number() OVER (PARTITION BY user_id ORDER BY d) AS run FROM e) GROUP BY user_id, run"""


def latest_run(spark, sf):
    """Dedup on re-run: the latest order of each customer and status."""
    o = C.table(spark, sf, "orders").withColumn("run", F.struct("o_orderdate", "o_orderkey"))
    return keep_latest(o, ["o_custkey", "o_orderstatus"]).select("o_custkey", "o_orderstatus", "o_orderkey")


def pending_windows(spark, sf):
    """Anti-join of windows with a checkpoint table."""
    windows = C.fields(spark, sf).select("step").distinct()
    done = C.table(spark, sf, "orders").where("o_orderpriority = '1-URGENT' and o_custkey % 40 = 0").select(C.quarter("o_orderdate").alias("step")).distinct()
    return windows.join(done, "step", "left_anti")


def comparisons(spark, sf):
    """Every comparison with NaN on either side."""
    f = C.fields(spark, sf).withColumn("value", F.when(F.col("point_id") == 3, F.lit(float("nan"))).otherwise(F.col("value")))
    return f.groupBy("step").agg(*[F.count_if(compare(F.col("value"), s, F.lit(120.0))).alias(n) for s, n in zip(COMPARE, ("lt", "gt", "le", "ge", "eq", "ne"), strict=True)])


def grid_cells(spark, sf):
    t = _tracks(spark, sf)
    i, j = geo.grid_index(F.col("lat"), F.col("lon"), 90.0, 0.0, 2.5, 2.5)
    return t.select(i.alias("i"), j.alias("j")).groupBy("i", "j").agg(F.count("*").alias("n"))


QUERIES = {
    "thermal_indices": (thermal_indices, THERMAL_SQL),
    "heat_index": (heat_index, f"""WITH {WEATHER_SQL},
h AS (SELECT l_orderkey, l_linenumber, (t + 15 - 273.15) * 1.8::DOUBLE + 32 AS f, 100 * pow(10.0, 7.5 * (td + 15 - 273.15) / (237.3 + td + 15 - 273.15)) / pow(10.0, 7.5 * (t + 15 - 273.15) / (237.3 + t + 15 - 273.15)) AS rh FROM weather),
s AS (SELECT *, 0.5 * (f + 61 + (f - 68) * 1.2 + rh * 0.094) AS simple, -42.379 + 2.04901523 * f + 10.14333127 * rh - 0.22475541 * f * rh - 6.83783e-3 * f * f - 5.481717e-2 * rh * rh + 1.22874e-3 * f * f * rh + 8.5282e-4 * f * rh * rh - 1.99e-6 * f * f * rh * rh AS full_ FROM h),
a AS (SELECT *, CASE WHEN rh < 13 AND f BETWEEN 80 AND 112 THEN full_ - (13 - rh) / 4 * sqrt(greatest((17 - abs(f - 95)) / 17, 0)) WHEN rh > 85 AND f BETWEEN 80 AND 87 THEN full_ + (rh - 85) / 10 * ((87 - f) / 5) ELSE full_ END AS adj FROM s)
SELECT l_orderkey, l_linenumber, round((CASE WHEN (simple + f) / 2 < 80 THEN simple ELSE adj END - 32) / 1.8 + 273.15, 5) AS heat_index FROM a"""),
    "radiant_temperature": (radiant_temperature, RADIANT_SQL),
    "utci_validity": (utci_validity, UTCI_SQL),
    "rain_weather_types": (rain_weather_types, f"WITH {RAIN_SQL}\nSELECT coalesce(wt, -1) AS wt, CAST(count(*) AS BIGINT) AS n, sum(rain) AS rain FROM typed GROUP BY ALL"),
    "rain_point_quantiles": (rain_point_quantiles, f"{POINTS_SQL}\nSELECT step, point_id, [0.1::DOUBLE, 0.5, 0.9][i] AS level, round(q[i], 5) AS value FROM (SELECT step, point_id, quantile_cont(p, [0.1, 0.5, 0.9]) AS q FROM points GROUP BY ALL), range(1, 4) t(i)"),
    "rain_grid_scale": (rain_grid_scale, f"WITH {RAIN_SQL},\ng AS (SELECT step, point_id, CASE WHEN wt = 99999 OR wt IS NULL THEN rain ELSE (SELECT avg(greatest(rain * (-0.5 + 0.1 * k + 0.01 * wt + 1), 0)) FROM range(0, 5) t(k)) END AS g FROM typed)\nSELECT step, point_id, round(avg(g) + 1e-9, 6) AS grid_scale FROM g GROUP BY ALL"),
    "region_weights": (region_weights, f"WITH {GRID_SQL},\nw AS (SELECT point_id, CASE WHEN lat BETWEEN 15 AND 65 AND (lon >= 300 OR lon <= 40) THEN cos(radians(lat)) ELSE 0 END AS w FROM grid)\nSELECT point_id, round(w / (SELECT sum(w) FROM w), 8) AS weight FROM w"),
    "strike_probability": (strike_probability, STRIKE_SQL),
    "regrid_box": (regrid_box, REGRID_BOX_SQL),
    "regrid_bilinear": (regrid_bilinear, REGRID_BILINEAR_SQL),
    "spectrum": (spectrum, SPECTRUM_SQL),
    "storm_matching": (storm_matching, f"{MATCH_SQL}\nSELECT step, outcome, coalesce(obs, -1) AS obs, coalesce(pred, -1) AS pred, round(dist, 5) AS dist FROM m"),
    "storm_confusion": (storm_confusion, f"{MATCH_SQL}\nSELECT step, CAST(count(*) FILTER (outcome = 'TP') AS BIGINT) AS tp, CAST(count(*) FILTER (outcome = 'FN') AS BIGINT) AS fn, CAST(count(*) FILTER (outcome = 'FP') AS BIGINT) AS fp, round(avg(dist), 5) AS mean_dist FROM m GROUP BY ALL"),
    "storm_annotation": (storm_annotation, ANNOTATE_SQL),
    "track_motion": (track_motion, MOTION_SQL),
    "best_track": (best_track, BEST_SQL),
    "cluster_gram": (cluster_gram, GRAM_SQL),
    "principal_components": (principal_components, None),
    "ensemble_clusters": (ensemble_clusters, None),
    "cluster_partitions": (cluster_partitions, PARTITIONS_SQL),
    "red_noise": (red_noise, None),
    "regime_attribution": (regime_attribution, ATTRIBUTION_SQL),
    "cluster_representatives": (cluster_representatives, REPRESENTATIVES_SQL),
    "season_days": (season_days, SEASON_SQL),
    "gaps_and_islands": (gaps_and_islands, ISLANDS_SQL),
    "latest_run": (latest_run, "SELECT o_custkey, o_orderstatus, o_orderkey FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey, o_orderstatus ORDER BY o_orderdate DESC, o_orderkey DESC) = 1"),
    "pending_windows": (pending_windows, f"WITH {C.FIELDS_SQL}\nSELECT DISTINCT step FROM fields WHERE step NOT IN (SELECT CAST((year(o_orderdate) - 1995) * 4 + quarter(o_orderdate) - 1 AS INTEGER) FROM orders WHERE o_orderpriority = '1-URGENT' AND o_custkey % 40 = 0)"),
    "comparisons": (comparisons, f"WITH {C.FIELDS_SQL}\nSELECT step, CAST(count(*) FILTER (point_id <> 3 AND value < 120) AS BIGINT) AS lt, CAST(count(*) FILTER (point_id <> 3 AND value > 120) AS BIGINT) AS gt, CAST(count(*) FILTER (point_id <> 3 AND value <= 120) AS BIGINT) AS le, CAST(count(*) FILTER (point_id <> 3 AND value >= 120) AS BIGINT) AS ge, CAST(count(*) FILTER (point_id <> 3 AND value = 120) AS BIGINT) AS eq, CAST(count(*) FILTER (point_id = 3 OR value <> 120) AS BIGINT) AS ne FROM fields GROUP BY ALL"),
    "grid_cells": (grid_cells, "SELECT CAST(floor((90 - lat) / 2.5) AS BIGINT) AS i, CAST(floor(lon / 2.5) AS BIGINT) AS j, CAST(count(*) AS BIGINT) AS n FROM (SELECT ((event_id * 7) % 120 - 60)::DOUBLE AS lat, ((event_id * 11) % 360)::DOUBLE AS lon FROM events) GROUP BY ALL"),
}
