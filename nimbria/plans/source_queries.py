"""Registered queries of readers, sinks, climatologies, preprocessing, tracks, clusters and jobs over whole tables.

What a query writes on its way, it writes to the shared folder and reads again from there.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from nimbria.functions import geo, thermal
from nimbria.functions.columns import ratio
from nimbria.operators import accumulate as A
from nimbria.operators import cluster as K
from nimbria.operators import cyclones as Y
from nimbria.operators import ensemble as E
from nimbria.operators import preprocess as P
from nimbria.operators import spatial as S
from nimbria.plans import jobs
from nimbria.plans import windows as W
from nimbria.plans.product_queries import EFI_SQL, ENSMS_SQL
from nimbria.plans.spatial_queries import GRID_SQL
from nimbria.sources import cubes as C
from nimbria.sources import readers, sinks
from nimbria.sources.cache import RequestCache
from nimbria.sources.shared import shared_path


def _written_fields(spark, sf) -> str:
    path = shared_path(spark, "fields")
    sinks.sink_for(f"table:{path}", keys=["step"])(C.fields(spark, sf))
    return path


def fields_scan(spark, sf):
    """A request of steps and a member against a partitioned field table; no match would be an error."""
    df = readers.open_source(spark, f"table:{_written_fields(spark, sf)}", {"step": [1, 2, 3], "number": 2})
    return readers.not_empty(df).select("step", "number", "point_id", "value")


def rewritten_fields(spark, sf):
    """Writing the same keys again replaces their partitions; others stay."""
    path = _written_fields(spark, sf)
    again = C.fields(spark, sf).where("step < 4").withColumn("value", -F.col("value"))
    sinks.sink_for(f"table:{path}", keys=["step"])(again)
    return readers.open_source(spark, path).select("step", "number", "point_id", "value")


def fileset_scan(spark, sf):
    """A file set by member, read by a path template; a rerun doubles nothing."""
    path = shared_path(spark, "fileset")
    write = sinks.sink_for(f"fileset:{path}", keys=["number"])
    write(C.fields(spark, sf))
    write(C.fields(spark, sf))
    return readers.open_source(spark, f"fileset:{path}/number={{number}}", {"number": [1, 3], "point_id": [5, 6]}).select("step", "point_id", "value")


def keyed_sink(spark, sf):
    """A sink that sets keys of what it writes, and one that writes nothing."""
    path = shared_path(spark, "keyed")
    sinks.sink_for("null:")(C.fields(spark, sf))
    sinks.with_keys(sinks.sink_for(f"file:{path}"), expver="0001", stream="enfo")(C.fields(spark, sf))
    return readers.open_source(spark, path).groupBy("expver", "stream").agg(F.count("*").alias("n"), F.sum("value").alias("total"))


def union_of_parts(spark, sf):
    """Two requests of one table (control and perturbed members) as one ensemble of a checked number of members."""
    path = shared_path(spark, "parts")
    full = C.fields(spark, sf).join(C.fields(spark, sf).groupBy("step", "point_id").agg(F.countDistinct("number").alias("n")).where("n = 7").drop("n"), ["step", "point_id"])
    sinks.file_sink(path)(full)
    both = A.check_members(readers.open_union(spark, path, [{"number": 1}, {"number": [2, 3, 4, 5, 6, 7]}]), ["step", "point_id"], 7)
    return E.mean_std(both, ["step", "point_id"]).select("step", "point_id", F.round("mean", 6).alias("mean"), F.round("std", 6).alias("std"))


def restart(spark, sf):
    """Windows that a checkpoint table leaves to do, and none of those that it forgot."""
    path = shared_path(spark, "recovery")
    config = {"product": "ensms"}
    windows = C.fields(spark, sf).select(F.concat(F.col("step"), F.lit("-"), F.col("step") + 4).alias("window_id")).distinct()
    done = sinks.Recovery(spark, path, config)
    done.add(["0-4"])
    done.clean()
    done.add(["3-7", "5-9"])
    sinks.Recovery(spark, path, {"product": "other"}).add(["7-11"])
    return done.remaining(windows)


def climatology_pair(spark, sf):
    """Mean and deviation fields of a climatology, read as pairs; forecast steps 20.. map to its steps 0.. by a table."""
    clim = E.climatology(C.fields(spark, sf), ["point_id", "step"])
    typed = clim.select("point_id", "step", F.expr("stack(2, 'em', mean, 'es', std) as (type, value)"))
    pair = readers.climatology_pair(typed, ["point_id"], {20 + i: i for i in range(8)})
    return pair.select("point_id", "step", F.round("mean", 6).alias("mean"), F.round("std", 6).alias("std"))


def climatology_window(spark, sf):
    """A climatology that must have a single window."""
    made = A.accumulate(C.fields(spark, sf), W.default([{"from": 0, "to": 3}], "maximum"), ["number", "point_id"])
    return E.quantiles(readers.single_window(made), ["window_id", "point_id"], 2).select("window_id", "point_id", "quantile", F.round("value", 6).alias("value"))


def packed_fields(spark, sf):
    """Fields packed as arrays in point order and unpacked again."""
    return readers.unpack(readers.pack(C.fields(spark, sf), ["step", "number"])).select("step", "number", F.col("point_id").cast("int").alias("point_id"), "value")


def text_tracks(spark, sf):
    """Fixed-form track text: a category line opens a track, latitudes and longitudes carry their hemisphere."""
    path = shared_path(spark, "tracks")
    e = C.table(spark, sf, "events")
    lat, lon = F.col("event_id") % 120 - 60, F.col("event_id") % 350 - 175
    line = F.concat_ws(" ", (F.col("user_id") % 25).cast("string"), F.concat(F.abs(lat), F.when(lat < 0, "S").otherwise("N")), F.concat(F.abs(lon), F.when(lon < 0, "W").otherwise("E")), F.date_format("ts", "yyyyMMdd"), F.col("event_id").cast("string"), F.col("value").cast("string"), F.lit("99000"))
    lines = e.select(F.explode(F.when(F.col("event_id") % 10 == 0, F.array(F.lit("CATEGORY x"), line)).otherwise(F.array(line))).alias("value"), "event_id")
    lines = lines.withColumn("part", F.floor(F.col("event_id") / 1000))  # a file for each thousand, begun by a category
    lines.repartition("part").sortWithinPartitions("part", "event_id", F.desc("value")).select("value", "part").write.partitionBy("part").text(path)
    return readers.open_source(spark, f"tracks-text:{path}").select("number", "id", "step", "lat", "lon", "date", "wind")


def cached_fields(spark, sf):
    """Fields through the write-through cache: two requests that overlap, then one that both hold together."""
    table = C.fields(spark, sf)
    cache = RequestCache(spark, shared_path(spark, "cache"), lambda r: table.where(F.col("step").isin(r["step"]) & F.col("number").isin(r["number"])), {"step": "int", "number": "int"})
    cache.read({"step": list(range(0, 14)), "number": [1, 2, 3, 4]})
    cache.read({"step": list(range(10, 28)), "number": [1, 2, 3, 4, 5, 6, 7]})
    out = cache.read({"step": list(range(5, 20)), "number": [2, 3]})
    return out.groupBy("step", "number").agg(F.count("*").alias("n"), F.sum("value").alias("value"))


def csv_tracks(spark, sf):
    """Tracks as CSV: steps are hours after each track's first point."""
    path = shared_path(spark, "tracks")
    e = C.table(spark, sf, "events")
    rows = e.select(F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("datetime"), F.concat(F.lit("storm "), F.col("user_id") % 25).alias("name"), (F.col("event_id") % 60).cast("double").alias("lat_p"), (F.col("event_id") % 360).cast("double").alias("lon_p"), F.col("value").alias("wind"))
    rows.write.option("header", True).csv(path)
    out = readers.open_source(spark, f"tracks-csv:{path}")
    return out.groupBy("number").agg(F.count("*").alias("n"), F.max("step").alias("last"), F.sum("step").alias("steps"), F.round(F.sum("wind"), 4).alias("wind"))


def point_tracks(spark, sf):
    """White-space separated points with comments."""
    path = shared_path(spark, "tracks")
    e = C.table(spark, sf, "events")
    line = F.concat_ws("  ", (F.col("user_id") % 25).cast("string"), F.col("event_id").cast("string"), (F.col("event_id") % 60).cast("string"), (F.col("event_id") % 360).cast("string"), F.concat(F.col("value").cast("string"), F.lit(" # seen")))
    e.select(line.alias("value")).write.text(path)
    return readers.open_source(spark, f"tracks-points:{path}")


def tracker_text(spark, sf):
    """Tracker text in fixed columns: a file for every five of 200 groups of users, a cyclone for each of them, ended by a line
    of its own; the last of a file is not ended."""
    path = shared_path(spark, "tracker")
    e = C.table(spark, sf, "events").select((F.col("user_id") % 200).alias("tc"), "event_id", "ts")
    digits = lambda x, n: F.lpad(x.cast("string"), n, "0")
    lat, lon = digits(F.col("event_id") * 7 % 900, 3), digits(F.col("event_id") * 11 % 3600, 4)
    seen, far = digits(F.col("event_id") * 5 % 890 + 3, 3), digits(F.col("event_id") * 11 % 3600 + 7, 4)
    line = F.concat(F.lit("00010 "), F.date_format("ts", "yyyy/MM/dd/HH"), F.lit("*"), lat, lon, F.lit(" "), digits(F.col("event_id") % 130, 3), F.lit(" "), digits(900 + F.col("event_id") % 120, 4), F.lit(" "), seen, far)
    ends = e.where("tc % 5 < 4").groupBy("tc").agg(F.max("ts").alias("ts"), F.max("event_id").alias("event_id")).select("tc", "ts", "event_id", F.lit("00015 END").alias("value"), F.lit(1).alias("o"))
    lines = e.select("tc", "ts", "event_id", line.alias("value"), F.lit(0).alias("o")).unionByName(ends).withColumn("part", F.floor(F.col("tc") / 5))
    lines.repartition("part").sortWithinPartitions("part", "tc", "o", "ts", "event_id").select("value", "part").write.partitionBy("part").text(path)
    out = readers.read_tracker(spark, path, base="2024-01-01", basin="aus")
    far = [F.round(F.max("accdist"), 3).alias("accdist"), F.round(F.avg("speed"), 5).alias("speed"), F.round(F.sum("dpdt"), 6).alias("dpdt"), F.round(F.avg("windrad"), 4).alias("windrad")]
    return out.groupBy("name").agg(F.count("*").alias("n"), F.round(F.avg("lat_p"), 5).alias("lat"), F.round(F.avg("lon_w"), 5).alias("lon"), F.round(F.max("wind"), 5).alias("wind"), F.min("pres").alias("pres"), F.sum("step").alias("steps"), *far)


TRACKER_SQL = """WITH e AS (
  SELECT user_id % 200 AS tc, event_id, ts, date_trunc('hour', ts) AS h, -(event_id * 7 % 900) / 10.0::DOUBLE + 0.05 AS la, (event_id * 11 % 3600) / 10.0::DOUBLE + 0.05 AS lo,
    -(event_id * 5 % 890 + 3) / 10.0::DOUBLE + 0.05 AS wa, (event_id * 11 % 3600 + 7) / 10.0::DOUBLE + 0.05 AS wo, 900.0::DOUBLE + event_id % 120 AS pres
  FROM events WHERE year(ts) = 2024 AND user_id % 200 % 5 < 4),
m AS (
  SELECT *, dense_rank() OVER (PARTITION BY tc // 5 ORDER BY tc) AS k, date_diff('hour', TIMESTAMP '2024-01-01', h) AS step, la - lag(la) OVER o AS da, lo - lag(lo) OVER o AS dl, pres - lag(pres) OVER o AS dp, date_diff('hour', lag(h) OVER o, h) AS dh
  FROM e WINDOW o AS (PARTITION BY tc ORDER BY ts, event_id)),
d AS (
  SELECT *, CASE WHEN da IS NOT NULL THEN 2 * 6371.0::DOUBLE * asin(sqrt(least(1.0, pow(sin(radians(da) / 2), 2) + cos(radians(la)) * cos(radians(la + da)) * pow(sin(radians(dl) / 2), 2)))) END AS d,
    2 * 6371.0::DOUBLE * asin(sqrt(least(1.0, pow(sin(radians(la - wa) / 2), 2) + cos(radians(la)) * cos(radians(la + la - wa)) * pow(sin(radians(lo - wo) / 2), 2)))) AS windrad FROM m),
a AS (SELECT *, sum(d) OVER (PARTITION BY tc) AS accdist FROM d)
SELECT 'unnamed_aus' || k AS name, CAST(count(*) AS BIGINT) AS n, round(avg(la), 5) AS lat, round(avg(wo), 5) AS lon, round(max((event_id % 130) * 0.514444::DOUBLE), 5) AS wind, min(pres) AS pres, CAST(sum(step) AS BIGINT) AS steps,
  round(max(accdist), 3) AS accdist, round(avg(d * 1000 / (nullif(dh, 0) * 3600)), 5) AS speed, round(sum(dp / nullif(dh, 0)), 6) AS dpdt, round(avg(windrad), 4) AS windrad FROM a GROUP BY k"""


def preprocess_reshape(spark, sf):
    """A stacked read taken apart: of each cell's values in order, evens are u and odds v."""
    out = P.from_config([{"operation": "reshape", "inputs": ["u", "v"]}])(C.fields(spark, sf), ["step", "point_id", "number"])
    return out.select("step", "point_id", "param", "number", "value")


def event_ratios(spark, sf):
    """Ratios, 0 where the divisor is 0."""
    return C.table(spark, sf, "events").select("event_id", F.round(ratio(F.col("value"), (F.col("user_id") % 4).cast("double")), 6).alias("ratio"))


def angles(spark, sf):
    a = F.col("o_totalprice") - 100000
    return C.table(spark, sf, "orders").select("o_orderkey", F.round(geo.normalise_angle(a), 4).alias("positive"), F.round(geo.normalise_angle(a, False), 4).alias("signed"))


def crop(spark, sf):
    """A window of a grid, re-indexed and normalised with a shift and a norm a parameter."""
    cells = C.table(spark, sf, "lineitem").groupBy(F.col("l_returnflag").alias("param"), (F.col("l_suppkey") % 30).cast("int").alias("i"), (F.col("l_partkey") % 31).cast("int").alias("j")).agg(F.sum("l_quantity").alias("value"))
    factors = C.table(spark, sf, "lineitem").groupBy(F.col("l_returnflag").alias("param")).agg(F.min("l_quantity").alias("shift"), F.max("l_quantity").alias("norm"))
    out = Y.crop_normalise(cells, factors, (5, 20), (10, 25))
    return out.select("param", "i", "j", F.round("value", 6).alias("value"))


def track_snapshot(spark, sf):
    """Points of all tracks at the latest time."""
    e = C.table(spark, sf, "events")
    return Y.snapshot(e, e.agg(F.max("ts")).first()[0], "ts").select("event_id", "user_id", "value")


def consistent_days(spark, sf):
    """Orders grouped by day after a check that a day has one month."""
    o = C.table(spark, sf, "orders").select(F.to_date("o_orderdate").alias("day"), F.month("o_orderdate").alias("month"), "o_totalprice")
    return E.same_in_group(o, ["day"], "month").groupBy("day", "month").agg(F.count("*").alias("n"))


def filtered_strikes(spark, sf):
    """Strikes of strong points in a range of steps, tracks interpolated half-way between points."""
    e = C.table(spark, sf, "events")
    t = e.select((F.col("user_id") % 25).cast("int").alias("number"), (F.col("event_id") % 3).cast("int").alias("id"), F.col("event_id").cast("int").alias("step"), ((F.col("event_id") * 7) % 120 - 60).cast("double").alias("lat"), ((F.col("event_id") * 11) % 160).cast("double").alias("lon"), F.col("value").alias("wind"))
    grid = spark.range(36 * 18).select(F.col("id").cast("int").alias("point_id"), (F.floor(F.col("id") / 36) * 10 - 85).cast("double").alias("lat"), (F.col("id") % 36 * 10).cast("double").alias("lon"))
    out = S.strike_probability(t, grid, 600.0, 25, sub_steps=2, min_wind=30.0, step_range=(100, 900_000))
    return out.select("point_id", F.round("probability", 6).alias("probability"))


FILTERED_SQL = f"""WITH {GRID_SQL},
t AS (SELECT user_id % 25 AS number, event_id % 3 AS id, event_id AS step, ((event_id * 7) % 120 - 60)::DOUBLE AS lat, ((event_id * 11) % 160)::DOUBLE AS lon FROM events WHERE value >= 30 AND event_id BETWEEN 100 AND 900000),
l AS (SELECT *, lead(lat) OVER o AS lat2, lead(lon) OVER o AS lon2 FROM t WINDOW o AS (PARTITION BY number, id ORDER BY step)),
u AS (SELECT number, lat AS tlat, lon AS tlon FROM l UNION SELECT number, lat + 0.5 * (lat2 - lat), lon + 0.5 * (lon2 - lon) FROM l WHERE lat2 IS NOT NULL),
h AS (SELECT DISTINCT number, point_id FROM u, grid
  WHERE 2 * 6371.0 * asin(sqrt(least(1.0, pow(sin(radians(lat - tlat) / 2), 2) + cos(radians(lat)) * cos(radians(tlat)) * pow(sin(radians(lon - tlon) / 2), 2)))) <= 600)
SELECT point_id, round(100.0::DOUBLE * count(*) / 25, 6) AS probability FROM h GROUP BY ALL"""


def thermal_from_components(spark, sf):
    """Indices that derive wind speed and humidity from other inputs."""
    w = C.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", (250 + F.col("l_quantity")).alias("t"), (245 + F.col("l_quantity") - F.col("l_tax") * 50).alias("td"), (F.col("l_discount") * 60).alias("u10"), (F.col("l_tax") * 90).alias("v10"))
    out = thermal.indices(w, ["apparent_temperature"])
    return out.select("l_orderkey", "l_linenumber", F.round("ws", 6).alias("ws"), F.round("rh", 5).alias("rh"))


def solar(spark, sf):
    """Mean cosine of the zenith angle over three hours, and the direct beam that goes with it."""
    e = C.table(spark, sf, "events").select("event_id", (F.col("event_id") % 120 - 60).cast("double").alias("lat"), (F.col("event_id") % 360).cast("double").alias("lon"), F.dayofyear("ts").alias("day"), F.hour("ts").alias("h"), "value")
    z = thermal.cos_zenith_integrated(F.col("lat"), F.col("lon"), F.col("day"), F.col("h"), F.col("h") + 3)
    out = e.withColumn("z", z)
    return out.select("event_id", F.round("z", 6).alias("cossza"), F.round(thermal.direct_radiation(F.col("value"), F.col("z"), 0.1), 3).alias("direct"))


SOLAR_SQL = """WITH e AS (SELECT event_id, (event_id % 120 - 60)::DOUBLE AS lat, (event_id % 360)::DOUBLE AS lon, 2 * 3.141592653589793::DOUBLE * (dayofyear(ts) - 1) / 365 AS g, hour(ts) AS h, value FROM events),
d AS (SELECT *, 0.006918::DOUBLE - 0.399912 * cos(g) + 0.070257 * sin(g) - 0.006758 * cos(2 * g) + 0.000907 * sin(2 * g) - 0.002697 * cos(3 * g) + 0.00148 * sin(3 * g) AS dec FROM e),
n AS (SELECT event_id, value, avg(greatest(sin(dec) * sin(radians(lat)) + cos(dec) * cos(radians(lat)) * cos(radians((h + 1.5::DOUBLE + k * 1.5 * 0.5773502691896257 - 12) * 15 + lon)), 0)) AS z FROM d, (VALUES (-1), (1)) v(k) GROUP BY ALL)
SELECT event_id, round(z, 6) AS cossza, round(CASE WHEN z > 0.1 THEN value / z ELSE 0 END, 3) AS direct FROM n"""


def cluster_spread(spark, sf):
    """Weighted sum of squared deviations over the points of each step's ensemble."""
    weights = spark.range(20).select(F.col("id").cast("int").alias("point_id"), ((F.col("id") + 1) / 210.0).alias("weight"))
    std = E.mean_std(C.fields(spark, sf), ["step", "point_id"]).select("point_id", F.col("std").alias("value"))
    return spark.createDataFrame([(round(K.mean_spread(std, weights), 3),)], "spread double")


def component_identities(spark, sf):
    """What holds of all member components: their variances add up to the trace, and the covariance maps each component
    to its variance times itself."""
    import numpy as np

    weights = spark.range(20).select(F.col("id").cast("int").alias("point_id"), F.lit(0.05).alias("weight"))
    a = K.anomalies(C.fields(spark, sf)).cache()
    made = K.components(a, weights, 7)
    c = np.zeros((len(made.members),) * 2)
    for r in K.gram(a, weights).collect():  # members squared / 2
        i, j = made.members.index(r.a), made.members.index(r.b)
        c[i, j] = c[j, i] = r.value / a.select("step").distinct().count()
    a.unpersist()
    off = np.abs(c @ made.pc - made.pc * made.values).max() / max(made.total, 1)
    apart = np.abs(made.pc.T @ made.pc / len(made.members) - np.eye(made.pc.shape[1])).max()
    return spark.createDataFrame([(len(made.members), round(float(made.values.sum()), 3), round(float(off), 6), round(float(apart), 6), round(float(made.var_cum[-1]), 6))], "members int, variance double, residual double, overlap double, explained double")


IDENTITIES_SQL = f"""WITH {C.FIELDS_SQL},
a AS (SELECT step, point_id, number, value - avg(value) OVER (PARTITION BY step, point_id) AS v FROM fields)
SELECT CAST(count(DISTINCT number) AS INTEGER) AS members, round(sum(0.05::DOUBLE * v * v) / count(DISTINCT step), 3) AS variance, 0.0::DOUBLE AS residual, 0.0::DOUBLE AS overlap, 100.0::DOUBLE AS explained FROM a"""


def projection(spark, sf):
    """Weighted projection of member fields on two patterns."""
    f = C.fields(spark, sf)
    weights = spark.range(20).select(F.col("id").cast("int").alias("point_id"), ((F.col("id") + 1) / 210.0).alias("weight"))
    eof = f.where("number <= 2").groupBy(F.col("number").alias("component"), "point_id").agg(F.avg("value").alias("value"))
    out = K.project(f.where("number > 2"), eof, weights, ["step", "number"])
    return out.select("step", "number", "component", F.round("pc", 6).alias("pc"))


PROJECTION_SQL = f"""WITH {C.FIELDS_SQL},
e AS (SELECT number AS component, point_id, avg(value) AS e, (point_id + 1) / 210.0::DOUBLE AS w FROM fields WHERE number <= 2 GROUP BY ALL),
n AS (SELECT component, sum(e * e * w) AS norm FROM e GROUP BY ALL)
SELECT step, number, component, round(sum(value * e * w) / any_value(norm), 6) AS pc FROM fields JOIN e USING (point_id) JOIN n USING (component) WHERE number > 2 GROUP BY ALL"""


def regimes(spark, sf):
    """Mean components of winter days by regime."""
    pcs = C.table(spark, sf, "orders").groupBy(F.to_date("o_orderdate").alias("date"), F.month("o_orderdate").alias("component")).agg(F.avg("o_totalprice").alias("pc")).withColumn("component", F.col("component") % 4)
    days = pcs.select("date").distinct().withColumn("regime", F.dayofyear("date") % 4)
    return K.regimes(pcs, days, K.season("10-4")).select("regime", "component", F.round("pc", 4).alias("pc"))


REGIMES_SQL = """WITH p AS (SELECT CAST(o_orderdate AS DATE) AS date, month(o_orderdate) % 4 AS component, avg(o_totalprice) AS pc FROM orders GROUP BY CAST(o_orderdate AS DATE), month(o_orderdate))
SELECT CAST(dayofyear(date) % 4 AS INTEGER) AS regime, CAST(component AS INTEGER) AS component, round(avg(pc), 4) AS pc FROM p WHERE month(date) >= 10 OR month(date) <= 4 GROUP BY ALL"""


def season_climatology(spark, sf):
    """Daily fields with the climatological value of their day of season."""
    o = C.table(spark, sf, "orders").select(F.to_date("o_orderdate").alias("date"), (F.col("o_custkey") % 5).cast("int").alias("point_id"), "o_totalprice")
    daily = o.groupBy("date", "point_id").agg(F.sum("o_totalprice").alias("value"))
    months = K.season("5-9")
    clim = daily.withColumn("dos", K.day_of_season(F.col("date"), months)).where("dos is not null").groupBy("dos", "point_id").agg(F.avg("value").alias("value"))
    return K.climatology_on(daily, clim, months).select("date", "point_id", F.round(F.col("value") - F.col("clim") + 1e-6, 3).alias("anomaly"))


SEASON_CLIM_SQL = """WITH d AS (SELECT CAST(o_orderdate AS DATE) AS date, CAST(o_custkey % 5 AS INTEGER) AS point_id, sum(o_totalprice) AS value FROM orders WHERE month(o_orderdate) BETWEEN 5 AND 9 GROUP BY ALL)
SELECT date, point_id, round(value - avg(value) OVER (PARTITION BY month(date), day(date), point_id) + 1e-6, 3) AS anomaly FROM d"""


def cluster_centroids(spark, sf):
    """Mean field of each cluster of members."""
    labels = C.fields(spark, sf).select("number").distinct().withColumn("cluster", F.col("number") % 3)
    return K.centroids(C.fields(spark, sf), labels).select("cluster", "step", "point_id", F.round("value", 6).alias("value"))


def density_clusters(spark, sf):
    """Clusters of the grid cells that hold far more than a step's mean."""
    items = C.table(spark, sf, "lineitem")
    cells = items.groupBy((F.col("l_partkey") % 3).cast("int").alias("step"), (F.col("l_suppkey") % 30).cast("int").alias("i"), (F.col("l_partkey") % 31).cast("int").alias("j")).agg(F.sum("l_quantity").alias("weight"))
    mean = cells.groupBy("step").agg(F.avg("weight").alias("mean"))
    found = cells.join(mean, "step").where("weight > 1.4 * mean").withColumn("weight", F.col("weight") / F.col("mean"))
    out = Y.density_clusters(found.select("step", "i", "j", "weight"), ["step"], 2.0, 5.0)
    return out.select("step", "cluster", F.round("i", 4).alias("i"), F.round("j", 4).alias("j"), F.round("weight", 5).alias("weight"))


DENSITY_SQL = """WITH RECURSIVE g AS (SELECT CAST(l_partkey % 3 AS INTEGER) AS step, CAST(l_suppkey % 30 AS INTEGER) AS i, CAST(l_partkey % 31 AS INTEGER) AS j, sum(l_quantity) AS weight FROM lineitem GROUP BY ALL),
c AS (SELECT step, i, j, weight / mean AS w, 1000 * i + j AS n FROM g JOIN (SELECT step, avg(weight) AS mean FROM g GROUP BY ALL) USING (step) WHERE weight > 1.4 * mean),
near AS (SELECT a.step, a.n, b.n AS o, b.w FROM c a JOIN c b ON a.step = b.step AND pow(a.i - b.i, 2) + pow(a.j - b.j, 2) <= 4),
core AS (SELECT step, n FROM near GROUP BY ALL HAVING sum(w) >= 5),
e AS (SELECT near.step, near.n, near.o FROM near JOIN core a ON a.step = near.step AND a.n = near.n JOIN core b ON b.step = near.step AND b.n = near.o),
reach AS (SELECT step, n, n AS o FROM core UNION SELECT r.step, r.n, e.o FROM reach r JOIN e ON e.step = r.step AND e.n = r.o),
root AS (SELECT step, n, min(o) AS root FROM reach GROUP BY ALL),
num AS (SELECT step, root, CAST(row_number() OVER (PARTITION BY step ORDER BY root) - 1 AS INTEGER) AS cluster FROM (SELECT DISTINCT step, root FROM root)),
member AS (SELECT near.step, near.n, min(cluster) AS cluster FROM near JOIN root ON root.step = near.step AND root.n = near.o JOIN num ON num.step = root.step AND num.root = root.root GROUP BY ALL)
SELECT step, cluster, round(sum(i * w) / sum(w), 4) AS i, round(sum(j * w) / sum(w), 4) AS j, round(sum(w), 5) AS weight FROM member JOIN c USING (step, n) GROUP BY ALL"""


def detection(spark, sf):
    """A user's model over packed arrays, a batch a call: here the sum and the greatest of the components."""
    e = C.table(spark, sf, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("values"))

    def model(x):
        import numpy as np

        return np.stack([x.sum(axis=1), x.max(axis=1)], axis=1)

    return Y.detect(e, model, ["vec_id"]).select("vec_id", F.round(F.get("score", F.lit(0)), 4).alias("total"), F.round(F.get("score", F.lit(1)), 6).alias("greatest"))


def prediction_pairs(spark, sf):
    """Predictions and annotations of a step, joined by place."""
    c = C.table(spark, sf, "conversations").groupBy("conv_id").agg(F.sort_array(F.collect_list("turn")).alias("predictions"), F.sort_array(F.collect_list(-F.col("turn"))).alias("annotations"))
    return Y.joined_predictions(c.select("conv_id", "predictions"), c.select("conv_id", "annotations"), ["conv_id"])


PAIRS_SQL = """WITH c AS (SELECT conv_id, list_sort(list(turn)) AS p, list_sort(list(-turn)) AS a FROM conversations GROUP BY ALL)
SELECT conv_id, CAST(i - 1 AS INTEGER) AS pos, p[i] AS prediction, a[i] AS annotation FROM c, unnest(range(1, len(p) + 1)) t(i)"""


def table_summaries(spark, sf):
    """Tables of several sources as one, columns that one lacks null."""
    c, s = C.table(spark, sf, "customer"), C.table(spark, sf, "supplier")
    one = c.select(F.col("c_custkey").alias("key"), F.col("c_acctbal").alias("wind"), F.col("c_mktsegment").alias("basin"))
    out = Y.summaries([one, s.select(F.col("s_suppkey").alias("key"), F.col("s_acctbal").alias("wind"))])
    return out.groupBy(F.coalesce("basin", F.lit("none")).alias("basin")).agg(F.count("*").alias("n"), F.round(F.max("wind"), 4).alias("wind"))


def nearest_regrid(spark, sf):
    """Each target point takes the value of the nearest grid point."""
    target = spark.range(50).select(F.col("id").cast("int").alias("point_id"), (F.col("id") * 2.0 - 51.3).alias("lat"), (F.col("id") * 5.0 + 3.7).alias("lon"))
    grid = spark.range(36 * 18).select(F.col("id").cast("int").alias("point_id"), (F.floor(F.col("id") / 36) * 10 - 80).cast("double").alias("lat"), (F.col("id") % 36 * 10).cast("double").alias("lon"))
    fields = C.table(spark, sf, "events").groupBy(F.col("event_type").alias("step"), (F.col("event_id") % 648).cast("int").alias("point_id")).agg(F.max("value").alias("value"))
    return S.regrid(fields, S.nearest_weights(grid, target, 10.0, 10.0), ["step"]).select("step", "point_id", F.round("value", 6).alias("value"))


NEAREST_SQL = """WITH t AS (SELECT id, id * 2.0::DOUBLE - 51.3 AS tlat, id * 5.0::DOUBLE + 3.7 AS tlon FROM range(0, 50) r(id)),
g AS (SELECT p, (p // 36 * 10 - 80)::DOUBLE AS lat, (p % 36 * 10)::DOUBLE AS lon FROM range(0, 648) s(p)),
n AS (SELECT id, p FROM t, g QUALIFY row_number() OVER (PARTITION BY id ORDER BY pow(sin(radians(lat - tlat) / 2), 2) + cos(radians(lat)) * cos(radians(tlat)) * pow(sin(radians(lon - tlon) / 2), 2), p) = 1)
SELECT event_type AS step, CAST(id AS INTEGER) AS point_id, round(max(value), 6) AS value FROM n JOIN events ON event_id % 648 = p GROUP BY ALL"""


def job_ensms(spark, sf):
    """The ensemble mean and deviation as a configured job: table, windows, preprocessing, target."""
    path = shared_path(spark, "job")
    config = {
        "product": "ensms", "source": {"location": f"table:{_written_fields(spark, sf)}"}, "target": f"table:{path}", "recover": shared_path(spark, "done"), "checkpoint_every": 8,
        "windows": [{"type": "ranges", "start": 0, "end": 27, "width": 3, "interval": 1, "operation": "mean"}],
    }
    jobs.run(spark, config)
    return spark.read.parquet(path).select("window_id", "point_id", F.round("mean", 6).alias("mean"), F.round("std", 6).alias("std"))


def job_extreme(spark, sf):
    """The extreme-forecast index as a configured job with a climatology of its own."""
    forecast, climate = shared_path(spark, "forecast"), shared_path(spark, "climate")
    f = C.table(spark, sf, "orders").where(F.col("o_orderdate") >= "2000-01-01")
    sinks.file_sink(forecast)(f.select((F.col("o_custkey") % 12).cast("int").alias("point_id"), F.col("o_orderkey").alias("number"), F.lit(24).alias("step"), F.round("o_totalprice").alias("value")))
    sinks.file_sink(climate)(C.climate_quantiles(spark, sf))
    out = jobs.run(spark, {"product": "extreme", "source": {"location": forecast}, "climatology": {"location": climate}, "windows": [{"coords": [24], "operation": "aggregation"}]})
    return out.select("point_id", F.round("efi", 6).alias("efi"))


QUERIES = {
    "fields_scan": (fields_scan, f"WITH {C.FIELDS_SQL}\nSELECT * FROM fields WHERE step IN (1, 2, 3) AND number = 2"),
    "rewritten_fields": (rewritten_fields, f"WITH {C.FIELDS_SQL}\nSELECT step, number, point_id, CASE WHEN step < 4 THEN -value ELSE value END AS value FROM fields"),
    "fileset_scan": (fileset_scan, f"WITH {C.FIELDS_SQL}\nSELECT step, point_id, value FROM fields WHERE number IN (1, 3) AND point_id IN (5, 6)"),
    "keyed_sink": (keyed_sink, f"WITH {C.FIELDS_SQL}\nSELECT '0001' AS expver, 'enfo' AS stream, CAST(count(*) AS BIGINT) AS n, sum(value) AS total FROM fields"),
    "union_of_parts": (union_of_parts, f"WITH {C.FIELDS_SQL}\nSELECT step, point_id, round(avg(value), 6) AS mean, round(stddev_pop(value), 6) AS std FROM fields GROUP BY ALL HAVING count(*) = 7"),
    "restart": (restart, f"WITH {C.FIELDS_SQL}\nSELECT DISTINCT step || '-' || (step + 4) AS window_id FROM fields WHERE step NOT IN (3, 5)"),
    "climatology_pair": (climatology_pair, f"WITH {C.FIELDS_SQL}\nSELECT point_id, CAST(step + 20 AS INTEGER) AS step, round(avg(value), 6) AS mean, round(stddev_pop(value), 6) AS std FROM fields WHERE step BETWEEN 0 AND 7 GROUP BY ALL"),
    "climatology_window": (climatology_window, f"WITH {C.FIELDS_SQL},\nm AS (SELECT number, point_id, max(value) AS v FROM fields WHERE step BETWEEN 0 AND 3 GROUP BY ALL HAVING count(*) = 4)\nSELECT '0-3' AS window_id, point_id, CAST(i AS VARCHAR) || ':2' AS quantile, round(list_extract(q, i + 1), 6) AS value FROM (SELECT point_id, quantile_cont(v, [0.0, 0.5, 1.0]) AS q FROM m GROUP BY ALL), range(0, 3) t(i)"),
    "packed_fields": (packed_fields, f"WITH {C.FIELDS_SQL}\nSELECT step, number, CAST(row_number() OVER (PARTITION BY step, number ORDER BY point_id) - 1 AS INTEGER) AS point_id, value FROM fields"),
    "cached_fields": (cached_fields, f"WITH {C.FIELDS_SQL}\nSELECT step, number, CAST(count(*) AS BIGINT) AS n, sum(value) AS value FROM fields WHERE step BETWEEN 5 AND 19 AND number IN (2, 3) GROUP BY ALL"),
    "text_tracks": (text_tracks, "SELECT CAST(user_id % 25 AS INTEGER) AS number, CAST(event_id % 1000 // 10 + 1 AS INTEGER) AS id, CAST(event_id AS INTEGER) AS step, CAST(event_id % 120 - 60 AS DOUBLE) AS lat, CAST(event_id % 350 - 175 AS DOUBLE) AS lon, strftime(ts, '%Y%m%d') AS date, value AS wind FROM events"),
    "csv_tracks": (csv_tracks, "WITH t AS (SELECT user_id % 25 AS number, date_trunc('second', ts) AS t, value FROM events), s AS (SELECT number, value, floor(epoch(t - min(t) OVER (PARTITION BY number)) / 3600) AS step FROM t)\nSELECT CAST(number AS INTEGER) AS number, CAST(count(*) AS BIGINT) AS n, CAST(max(step) AS INTEGER) AS last, CAST(sum(step) AS BIGINT) AS steps, round(sum(value), 4) AS wind FROM s GROUP BY ALL"),
    "point_tracks": (point_tracks, "SELECT CAST(user_id % 25 AS INTEGER) AS number, CAST(user_id % 25 AS INTEGER) AS id, CAST(event_id AS INTEGER) AS step, CAST(event_id % 60 AS DOUBLE) AS lat, CAST(event_id % 360 AS DOUBLE) AS lon, value AS wind FROM events"),
    "tracker_text": (tracker_text, TRACKER_SQL),
    "preprocess_reshape": (preprocess_reshape, f"WITH {C.FIELDS_SQL},\nr AS (SELECT *, row_number() OVER (PARTITION BY step, point_id ORDER BY number) - 1 AS r FROM fields)\nSELECT step, point_id, CASE r % 2 WHEN 0 THEN 'u' ELSE 'v' END AS param, CAST(r // 2 AS INTEGER) AS number, value FROM r"),
    "event_ratios": (event_ratios, "SELECT event_id, round(CASE WHEN user_id % 4 = 0 THEN 0 ELSE value / (user_id % 4) END, 6) AS ratio FROM events"),
    "angles": (angles, "WITH a AS (SELECT o_orderkey, (o_totalprice - 100000) - 360 * floor((o_totalprice - 100000) / 360) AS a FROM orders)\nSELECT o_orderkey, round(a, 4) AS positive, round(a - 180, 4) AS signed FROM a"),
    "crop": (crop, "WITH c AS (SELECT l_returnflag AS param, CAST(l_suppkey % 30 AS INTEGER) AS i, CAST(l_partkey % 31 AS INTEGER) AS j, sum(l_quantity) AS value FROM lineitem GROUP BY ALL), f AS (SELECT l_returnflag AS param, min(l_quantity) AS shift, max(l_quantity) AS norm FROM lineitem GROUP BY ALL)\nSELECT param, i - 5 AS i, j - 10 AS j, round((value - shift) / norm, 6) AS value FROM c JOIN f USING (param) WHERE i BETWEEN 5 AND 19 AND j BETWEEN 10 AND 24"),
    "track_snapshot": (track_snapshot, "SELECT event_id, user_id, value FROM events WHERE ts = (SELECT max(ts) FROM events)"),
    "consistent_days": (consistent_days, "SELECT CAST(o_orderdate AS DATE) AS day, CAST(month(o_orderdate) AS INTEGER) AS month, CAST(count(*) AS BIGINT) AS n FROM orders GROUP BY ALL"),
    "filtered_strikes": (filtered_strikes, FILTERED_SQL),
    "thermal_from_components": (thermal_from_components, "WITH w AS (SELECT l_orderkey, l_linenumber, 250 + l_quantity AS t, 245 + l_quantity - l_tax * 50 AS td, l_discount * 60 AS u, l_tax * 90 AS v FROM lineitem)\nSELECT CAST(l_orderkey AS BIGINT) AS l_orderkey, l_linenumber, round(sqrt(u * u + v * v), 6) AS ws, round(100 * pow(10.0, 7.5 * (td - 273.15) / (237.3 + td - 273.15)) / pow(10.0, 7.5 * (t - 273.15) / (237.3 + t - 273.15)), 5) AS rh FROM w"),
    "solar": (solar, SOLAR_SQL),
    "cluster_spread": (cluster_spread, f"WITH {C.FIELDS_SQL},\ns AS (SELECT step, point_id, stddev_pop(value) AS s FROM fields GROUP BY ALL)\nSELECT round(sum(s * s * (point_id + 1) / 210.0::DOUBLE), 3) AS spread FROM s"),
    "component_identities": (component_identities, IDENTITIES_SQL),
    "projection": (projection, PROJECTION_SQL),
    "regimes": (regimes, REGIMES_SQL),
    "season_climatology": (season_climatology, SEASON_CLIM_SQL),
    "cluster_centroids": (cluster_centroids, f"WITH {C.FIELDS_SQL}\nSELECT CAST(number % 3 AS INTEGER) AS cluster, step, point_id, round(avg(value), 6) AS value FROM fields GROUP BY ALL"),
    "density_clusters": (density_clusters, DENSITY_SQL),
    "detection": (detection, "SELECT vec_id, round(list_sum(CAST(embedding AS DOUBLE[])), 4) AS total, round(list_max(CAST(embedding AS DOUBLE[])), 6) AS greatest FROM embeddings"),
    "prediction_pairs": (prediction_pairs, PAIRS_SQL),
    "table_summaries": (table_summaries, "WITH t AS (SELECT c_mktsegment AS basin, c_acctbal AS wind FROM customer UNION ALL SELECT 'none', s_acctbal FROM supplier)\nSELECT basin, CAST(count(*) AS BIGINT) AS n, round(max(wind), 4) AS wind FROM t GROUP BY ALL"),
    "nearest_regrid": (nearest_regrid, NEAREST_SQL),
    "job_ensms": (job_ensms, ENSMS_SQL),
    "job_extreme": (job_extreme, EFI_SQL),
}
