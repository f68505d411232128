"""Registered queries of joins in time, and of products whose inputs are gathered from steps of several parameters."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from nimbria.functions import thermal
from nimbria.operators import intervals as I
from nimbria.operators import pointrain as R
from nimbria.sources import cubes as C

HOUR = 3600


def _events(spark, sf):
    return C.table(spark, sf, "events").select("event_id", (F.col("user_id") % 100).alias("user"), "event_type", "value", F.unix_timestamp(F.col("ts").cast("timestamp")).alias("t"))


def asof_purchases(spark, sf):
    """Each event with the latest purchase of its group of users at or before it, if that was within two days."""
    e = _events(spark, sf)
    bought = e.where("event_type = 'purchase'").select("user", "t", F.col("event_id").alias("bought"), F.col("value").alias("paid"))
    out = I.asof(e, bought, ["user"], "t", ["bought", "paid"], 12.0 * HOUR, 48.0 * HOUR)
    return out.select("event_id", "bought", F.round("paid", 6).alias("paid"), (F.col("t") - F.col("as_of")).alias("after"))


ASOF_SQL = """WITH e AS (SELECT event_id, user_id % 100 AS u, event_type, value, CAST(floor(epoch(ts)) AS BIGINT) AS t FROM events),
b AS (SELECT u, t, max({'b': event_id, 'v': value}) AS x FROM e WHERE event_type = 'purchase' GROUP BY ALL)
SELECT e.event_id, CASE WHEN e.t - b.t <= 172800 THEN b.x.b END AS bought, CASE WHEN e.t - b.t <= 172800 THEN round(b.x.v, 6) END AS paid, CASE WHEN e.t - b.t <= 172800 THEN e.t - b.t END AS after
FROM e ASOF LEFT JOIN b ON e.u = b.u AND e.t >= b.t"""


def interval_weeks(spark, sf):
    """How many days of each week the users' runs of active days cover."""
    e = C.table(spark, sf, "events").select("user_id", F.date_diff(F.col("ts").cast("date"), F.lit("2024-01-01").cast("date")).alias("d")).distinct()
    run = F.col("d") - F.row_number().over(Window.partitionBy("user_id").orderBy("d"))
    runs = e.withColumn("run", run).groupBy("user_id", "run").agg(F.min("d").alias("begin"), (F.max("d") + 1).alias("finish"))
    weeks = e.select((F.floor(F.col("d") / 7) * 7).alias("start")).distinct().withColumn("end", F.col("start") + 7)
    out = I.overlaps(weeks, runs, [], 7.0)
    return out.groupBy("start").agg(F.count("*").alias("runs"), F.sum("overlap").alias("days"))


WEEKS_SQL = """WITH e AS (SELECT DISTINCT user_id, date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) AS d FROM events),
r AS (SELECT user_id, min(d) AS begin, max(d) + 1 AS finish FROM (SELECT *, d - row_number() OVER (PARTITION BY user_id ORDER BY d) AS run FROM e) GROUP BY user_id, run),
w AS (SELECT DISTINCT CAST(floor(d / 7.0) * 7 AS BIGINT) AS start FROM e)
SELECT start, CAST(count(*) AS BIGINT) AS runs, CAST(sum(least(start + 7, finish) - greatest(start, begin)) AS BIGINT) AS days FROM w JOIN r ON begin < start + 7 AND finish > start GROUP BY ALL"""


def _cells(spark, sf):
    """Steps of six hours to 48 from quarters of shipping, five members, twenty points."""
    items = C.table(spark, sf, "lineitem").select(
        (F.pmod(C.quarter("l_shipdate"), F.lit(9)) * 6).alias("step"), (F.col("l_partkey") % 5).cast("int").alias("number"), (F.col("l_suppkey") % 20).cast("int").alias("point_id"),
        F.col("l_quantity").alias("q"), "l_discount", "l_tax", "l_extendedprice", F.when(F.col("l_linestatus") == "O", 1.0).otherwise(-1.0).alias("s"),
    )
    cells = items.groupBy("step", "number", "point_id").agg(F.avg("q").alias("q"), F.avg(F.col("q") * F.col("l_discount")).alias("d"), F.avg(F.col("l_tax") * F.col("q")).alias("x"), F.avg(F.col("q") * F.col("s")).alias("v"), F.max("l_extendedprice").alias("p"))
    total = lambda c: F.sum(c).over(Window.partitionBy("number", "point_id").orderBy("step"))
    return cells.select("step", "number", "point_id", "q", "v", "p", total("q").alias("tq"), total("d").alias("td"), total("x").alias("tx"))


CELLS_SQL = """items AS (SELECT CAST(((year(l_shipdate) - 1995) * 4 + quarter(l_shipdate) - 1 + 9) % 9 * 6 AS INTEGER) AS step, CAST(l_partkey % 5 AS INTEGER) AS number, CAST(l_suppkey % 20 AS INTEGER) AS point_id, * FROM lineitem),
cells AS (SELECT step, number, point_id, avg(l_quantity) AS q, avg(l_quantity * l_discount) AS d, avg(l_tax * l_quantity) AS x, avg(CASE WHEN l_linestatus = 'O' THEN l_quantity ELSE -l_quantity END) AS v, max(l_extendedprice) AS p FROM items GROUP BY ALL),
summed AS (SELECT *, sum(q) OVER o AS tq, sum(d) OVER o AS td, sum(x) OVER o AS tx FROM cells WINDOW o AS (PARTITION BY number, point_id ORDER BY step))"""

WINDOWS = [(0, 12), (12, 24), (12, 36), (18, 30), (24, 48)]


def _rain_fields(spark, sf):
    """Accumulated rain, convective rain and radiation, wind every twelve hours, cape every six."""
    c = _cells(spark, sf)
    params = F.array(*[F.struct(F.lit(p).alias("param"), x.alias("value")) for p, x in (("tp", F.col("tq") / 4), ("cp", F.col("td") * 2), ("cdir", F.col("tx") * 1000), ("mxcape6", F.col("p") / 1000))])
    wind = F.array(*[F.struct(F.lit(p).alias("param"), x.alias("value")) for p, x in (("u", F.col("q") - 25.5), ("v", F.col("v")))])
    rows = F.explode(F.when(F.col("step") % 12 == 0, F.concat(params, wind)).otherwise(params))
    return c.select("step", "number", "point_id", rows.alias("x")).select("x.param", "step", "number", "point_id", "x.value")


def _rain_types(spark):
    """Eight weather types of a calibration by three of the five predictors, with a gap above 40 units of rain, and four error ratios each."""
    far = 1e12
    rows = [(1 + 4 * a + 2 * b + c, *((0.0, 0.4), (0.4, far))[a], *((0.0, 12.0), (12.0, 40.0))[b], *((0.0, 3.0), (3.0, far))[c], -far, far, -far, far) for a in (0, 1) for b in (0, 1) for c in (0, 1)]
    types = spark.createDataFrame(rows, "wt int, " + ", ".join(f"inf_{i} double, sup_{i} double" for i in range(1, 6)))
    return types, types.select("wt", F.array(*[F.lit(-0.6) + 0.3 * k + F.col("wt") / 20.0 for k in range(4)]).alias("fer"))


def rain_from_fields(spark, sf):
    """Quantiles of point rainfall from fields: five predictors, weather types, error ratios."""
    spread = R.from_fields(_rain_fields(spark, sf), WINDOWS, ["number", "point_id"], *_rain_types(spark))
    out = R.point_quantiles(spread, ["window_id", "point_id"], [0.25, 0.5, 0.9])
    return out.select("window_id", "point_id", "level", F.round(F.col("value") + 1e-9, 5).alias("value"))


def rain_predictors(spark, sf):
    out = R.predictors(_rain_fields(spark, sf), WINDOWS, ["number", "point_id"])
    return out.select("window_id", "number", "point_id", *[F.round(F.col(c) + 1e-9, 5).alias(c) for c in ("rain", "cpr", "ws", "cape", "radiation")])


PREDICTORS_SQL = f"""WITH {CELLS_SQL},
fields AS (SELECT step, number, point_id, unnest([{{'k': 'tp', 'x': tq / 4}}, {{'k': 'cp', 'x': td * 2}}, {{'k': 'cdir', 'x': tx * 1000}}, {{'k': 'mxcape6', 'x': p / 1000}}, {{'k': CASE WHEN step % 12 = 0 THEN 'u' END, 'x': q - 25.5}}, {{'k': CASE WHEN step % 12 = 0 THEN 'v' END, 'x': v}}], recursive := true) FROM summed),
windows AS (SELECT a, b, greatest(b, 24) - 24 AS sa, greatest(b, 24) AS sb FROM (VALUES (0, 12), (12, 24), (12, 36), (18, 30), (24, 48)) AS t(a, b)),
roles AS (
  SELECT a, b, k, r.s AS step, r.w AS w FROM windows, (VALUES ('tp'), ('cp')) AS t(k), unnest([{{'s': a, 'w': -1.0::DOUBLE}}, {{'s': b, 'w': 1.0::DOUBLE}}]) AS u(r)
  UNION ALL SELECT a, b, 'cdir', r.s, r.w FROM windows, unnest([{{'s': sa, 'w': -1.0::DOUBLE}}, {{'s': sb, 'w': 1.0::DOUBLE}}]) AS u(r)
  UNION ALL SELECT a, b, k, s, (least(b, s) - greatest(a, s - 12)) / (b - a)::DOUBLE FROM windows, (VALUES ('u'), ('v')) AS t(k), range(12, 49, 12) AS y(s) WHERE least(b, s) > greatest(a, s - 12)
  UNION ALL SELECT a, b, 'mxcape6', s, 1 FROM windows, range(6, 49, 6) AS y(s) WHERE s > a AND s <= b),
need AS (SELECT a, b, count(*) AS n FROM roles GROUP BY ALL),
met AS (
  SELECT a || '-' || b AS window_id, number, point_id, sum(w * x) FILTER (k = 'tp') AS rain, sum(w * x) FILTER (k = 'cp') AS conv, sum(w * x) FILTER (k = 'cdir') AS radiation, sum(w * x) FILTER (k = 'u') AS u, sum(w * x) FILTER (k = 'v') AS v, max(x) FILTER (k = 'mxcape6') AS cape
  FROM roles JOIN fields USING (k, step) JOIN need USING (a, b) GROUP BY a, b, number, point_id HAVING count(*) = any_value(n)),
predictors AS (SELECT *, CASE WHEN rain = 0 THEN 0 ELSE conv / rain END AS cpr, sqrt(u * u + v * v) AS ws FROM met)"""

RAIN_FIELDS_SQL = f"""{PREDICTORS_SQL},
typed AS (
  SELECT *, CASE WHEN cpr >= 0 AND rain >= 0 AND rain < 40 AND ws >= 0 THEN 1 + 4 * (cpr >= 0.4)::INTEGER + 2 * (rain >= 12)::INTEGER + (ws >= 3)::INTEGER END AS wt FROM predictors),
points AS (SELECT window_id, point_id, CASE WHEN rain < 0.04 OR wt IS NULL THEN 0 ELSE greatest(rain * (-0.6 + 0.3 * k + wt / 20.0::DOUBLE + 1), 0) END AS p FROM typed, range(0, 4) AS t(k))
SELECT window_id, point_id, [0.25::DOUBLE, 0.5, 0.9][i] AS level, round(q[i] + 1e-9, 5) AS value FROM (SELECT window_id, point_id, quantile_cont(p, [0.25, 0.5, 0.9]) AS q FROM points GROUP BY ALL), range(1, 4) AS t(i)"""


def _thermal_fields(spark, sf):
    c = _cells(spark, sf)
    params = {"t": 250 + F.col("q"), "td": 244 + F.col("q"), "u10": (F.col("q") - 25) / 4, "v10": F.col("v") / 4, "ssrd": F.col("tq") * 90000, "ssr": F.col("tq") * 70000, "strd": F.col("tq") * 250000, "strr": F.col("tq") * -40000, "fdir": F.col("tx") * 20000}
    rows = F.explode(F.array(*[F.struct(F.lit(p).alias("param"), x.alias("value")) for p, x in params.items()]))
    return c.select("step", "number", "point_id", rows.alias("x")).select("x.param", "step", "number", "point_id", "x.value")


def thermal_from_fields(spark, sf):
    """Mean radiant and apparent temperature: instants of a range's end meet the mean fluxes of the range and the sun of its hours."""
    grid = C.table(spark, sf, "supplier").select((F.col("s_suppkey") % 20).cast("int").alias("point_id")).distinct().select("point_id", (F.col("point_id") * 8.0 - 80).alias("lat"), (F.col("point_id") * 17.0).alias("lon"))
    windows = [(a, a + 6) for a in range(0, 48, 6)]
    made = thermal.inputs(_thermal_fields(spark, sf), windows, ["number", "point_id"], grid, day=156)
    out = thermal.indices(made, ["mean_radiant_temperature", "apparent_temperature"])
    return out.select("window_id", "number", "point_id", *[F.round(F.col(c) + 1e-9, 4).alias(c) for c in ("cossza", "ssrd", "mean_radiant_temperature", "apparent_temperature")])


THERMAL_FIELDS_SQL = f"""WITH {CELLS_SQL},
met AS (
  SELECT a, b.number, b.point_id, 250 + b.q AS t, 244 + b.q AS td, sqrt(pow((b.q - 25) / 4, 2) + pow(b.v / 4, 2)) AS ws, (b.tq - c.tq) * 90000 / 21600 AS ssrd, (b.tq - c.tq) * 70000 / 21600 AS ssr,
    (b.tq - c.tq) * 250000 / 21600 AS strd, (b.tq - c.tq) * -40000 / 21600 AS strr, (b.tx - c.tx) * 20000 / 21600 AS fdir, b.point_id * 8.0::DOUBLE - 80 AS lat, b.point_id * 17.0::DOUBLE AS lon
  FROM range(0, 48, 6) AS w(a) JOIN summed b ON b.step = a + 6 JOIN summed c ON c.step = a AND c.number = b.number AND c.point_id = b.point_id),
g AS (SELECT *, 2 * 3.141592653589793::DOUBLE * (156 + a // 24 - 1) / 365 AS g FROM met),
dec AS (SELECT *, 0.006918::DOUBLE - 0.399912 * cos(g) + 0.070257 * sin(g) - 0.006758 * cos(2 * g) + 0.000907 * sin(2 * g) - 0.002697 * cos(3 * g) + 0.00148 * sin(3 * g) AS dec FROM g),
sun AS (SELECT *, 0.5 * (SELECT sum(greatest(sin(dec) * sin(radians(lat)) + cos(dec) * cos(radians(lat)) * cos(radians((a % 24 + 3 + k * 3 * 0.5773502691896257::DOUBLE - 12) * 15 + lon)), 0)) FROM (VALUES (-1), (1)) AS v(k)) AS z FROM dec),
beam AS (SELECT *, CASE WHEN z > 0.01 THEN fdir / z ELSE 0 END AS dsrp, degrees(asin(greatest(least(z, 1.0::DOUBLE), -1.0::DOUBLE))) AS gamma,
  100 * pow(10.0, 7.5 * (td - 273.15) / (237.3 + td - 273.15)) / pow(10.0, 7.5 * (t - 273.15) / (237.3 + t - 273.15)) AS rh FROM sun)
SELECT CAST(a AS VARCHAR) || '-' || CAST(a + 6 AS VARCHAR) AS window_id, number, point_id, round(z + 1e-9, 4) AS cossza, round(ssrd + 1e-9, 4) AS ssrd,
  round(pow((0.5 * strd + 0.5 * (strd - strr) + 0.7 / 0.97::DOUBLE * (0.5 * (ssrd - fdir) + 0.5 * (ssrd - ssr) + CASE WHEN z > 0.01 THEN 0.308 * cos(radians(gamma * (0.998 - gamma * gamma / 50000))) * dsrp ELSE 0 END)) / 5.67e-8, 0.25) + 1e-9, 4) AS mean_radiant_temperature,
  round(t + 0.33 * (rh / 100 * 6.105 * exp(17.27 * (t - 273.15) / (237.7 + t - 273.15))) - 0.7 * ws - 4 + 1e-9, 4) AS apparent_temperature FROM beam"""


QUERIES = {
    "asof_purchases": (asof_purchases, ASOF_SQL),
    "interval_weeks": (interval_weeks, WEEKS_SQL),
    "rain_predictors": (rain_predictors, f"{PREDICTORS_SQL}\nSELECT window_id, number, point_id, round(rain + 1e-9, 5) AS rain, round(cpr + 1e-9, 5) AS cpr, round(ws + 1e-9, 5) AS ws, round(cape + 1e-9, 5) AS cape, round(radiation + 1e-9, 5) AS radiation FROM predictors"),
    "rain_from_fields": (rain_from_fields, RAIN_FIELDS_SQL),
    "thermal_from_fields": (thermal_from_fields, THERMAL_FIELDS_SQL),
}
