"""Registered queries of request algebra, windows, steps and product rules, with requests taken from whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from nimbria.plans import requests as Q
from nimbria.plans import tables as B
from nimbria.plans import windows as W
from nimbria.sources import cubes as C


def request_expand(spark, sf):
    """One request per combination of the values of two keys; a third stays as it is."""
    cube = B.cube_of({"segment": (C.table(spark, sf, "customer"), "c_mktsegment"), "status": (C.table(spark, sf, "orders"), "o_orderstatus")})
    return B.expand(cube.withColumn("type", F.lit("pf")), ["segment", "status"])


def request_product(spark, sf):
    """The cross product of three keys, counted by the cube and by its rows."""
    o = C.table(spark, sf, "orders")
    cube = B.cube_of({"status": (o, "o_orderstatus"), "priority": (o, "o_orderpriority"), "segment": (C.table(spark, sf, "customer"), "c_mktsegment")})
    counted = cube.withColumn("cells", B.volume(cube, cube.columns))
    return B.expand(counted, ["status", "priority", "segment"]).groupBy("status").agg(F.count("*").alias("n"), F.max("cells").alias("cells"))


def request_squeeze(spark, sf):
    """Requests equal but for the priority as one with the list of its values."""
    rows = C.table(spark, sf, "orders").select(F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("priority"))
    return B.squeeze(rows, ["priority"]).select("status", F.array_join("priority", "/").alias("priority"))


def request_cover(spark, sf):
    """The days, priorities and statuses that no order has, as disjoint hypercubes; SQL counts what they stand for."""
    o = C.table(spark, sf, "orders").select(F.year("o_orderdate").alias("year"), F.dayofyear("o_orderdate").alias("day"), F.col("o_orderpriority").alias("priority"))
    asked = B.cube_of({c: (o, c) for c in o.columns})
    gaps = B.missing(asked, B.cover(o.distinct(), o.columns), o.columns)
    cells = B.expand(gaps, o.columns)
    return cells.groupBy("year", "priority").agg(F.count("*").alias("n"), F.count_distinct("day").alias("days"))


def request_cache(spark, sf):
    """Requests of urgent orders' years that what was read for high ones holds whole: containment of arrays."""
    o = C.table(spark, sf, "orders").select((F.col("o_custkey") % 50).alias("cust"), F.col("o_orderstatus").alias("status"), F.year("o_orderdate").alias("year"), "o_orderpriority")
    written, asked = (B.squeeze(o.where(F.col("o_orderpriority") == p).drop("o_orderpriority"), ["year"]) for p in ("2-HIGH", "1-URGENT"))
    return B.contained(asked, written, ["year"], ["cust", "status"]).select("cust", "status", F.size("year").cast("long").alias("years"))


def request_unique(spark, sf):
    """Requests without repeats."""
    return C.table(spark, sf, "nation").select(F.col("n_regionkey").alias("region"), (F.col("n_nationkey") % 2).cast("int").alias("half")).distinct()


def request_intersection(spark, sf):
    """What is available of required days and statuses: all of it, or nothing if one is missed."""
    o = C.table(spark, sf, "orders").select(F.year("o_orderdate").alias("year"), "o_orderstatus", F.col("o_orderpriority").alias("number"), "o_totalprice")
    required = o.where("number like '1%' or number like '2%'").select("year", "o_orderstatus", "number")
    met = Q.intersect(required, o).groupBy("year", "o_orderstatus").agg(F.count("*").alias("n"))
    missed = Q.intersect(required.union(spark.createDataFrame([(1900, "F", "x")], required.schema)), o).groupBy("year", "o_orderstatus").agg(F.count("*").alias("n"))
    return met.union(missed)


def request_text(spark, sf):
    """Requests as text and back: lists, ranges and dates."""
    n = F.col("n_nationkey")
    rows = C.table(spark, sf, "nation").select(n.cast("int").alias("key"), B.range_text(F.lit(0), n * 6, F.lit(6)).alias("step"), F.date_add(F.lit("2024-01-01").cast("date"), n.cast("int")).alias("date"), F.array(F.lit("cf"), F.lit("pf")).alias("type"))
    text = B.request_text(rows, "retrieve", ["step", "date", "type"])
    back = rows.select("key", *[F.regexp_extract(text, rf"\n  {k}=([^,]*)", 1).alias(k) for k in ("step", "date", "type")])
    total = lambda x: F.aggregate(x, F.lit(0).cast("long"), lambda a, v: a + v)
    return back.select("key", total(B.numbers_of(F.col("step"))).alias("steps"), F.size(B.numbers_of(F.concat(F.lit("0-"), F.col("key")))).cast("long").alias("span"), "date", F.col("type").alias("types"))


def month_windows(spark, sf):
    """Full calendar months after the first order, in hours, and their number as forecast months."""
    first = C.table(spark, sf, "orders").agg(F.min("o_orderdate").alias("date"))
    return B.month_ranges(first, "date", 24, 24 * 400).select("first", "last", "month")


MONTH_SQL = """WITH z AS (SELECT CAST(min(o_orderdate) AS DATE) AS z FROM orders),
m AS (SELECT z, date_trunc('month', z) + to_months(CAST(i AS INTEGER)) AS a, date_trunc('month', z) + to_months(CAST(i + 1 AS INTEGER)) AS b FROM z, range(0, 20) t(i))
SELECT CAST(date_diff('hour', z, a) AS INTEGER) AS first, CAST(date_diff('hour', z, b) AS INTEGER) AS last,
  CAST((year(a) - year(z)) * 12 + month(a) - month(z) + CASE WHEN day(z) = 1 THEN 1 ELSE 0 END AS INTEGER) AS month
FROM m WHERE date_diff('hour', z, a) >= 24 AND date_diff('hour', z, b) <= 9600"""


def model_steps(spark, sf):
    """Events by the model step that their hour of the month belongs to."""
    steps = spark.createDataFrame([(s,) for s in W.model_steps()], "step int")
    e = C.table(spark, sf, "events").select(((F.dayofmonth("ts") - 1) * 24 + F.hour("ts")).alias("step"))
    return e.join(steps, "step").groupBy("step").agg(F.count("*").alias("n"))


def output_ranges(spark, sf):
    """Ranges of four steps at an interval of two that the table's steps can make, and the inputs of each."""
    return B.output_ranges(C.fields(spark, sf), 4, 2)


RANGES_SQL = f"""WITH {C.FIELDS_SQL}, s AS (SELECT DISTINCT step FROM fields), l AS (SELECT min(step) AS a, max(step) AS b FROM s)
SELECT CAST(i AS INTEGER) AS first, CAST(i + 4 AS INTEGER) AS last, CAST((SELECT count(*) FROM s WHERE step > i AND step <= i + 4) AS INTEGER) AS inputs, CAST(i AS INTEGER) AS base
FROM l, range(0, 200) t(i) WHERE i >= a AND i + 4 <= b AND (i - a) % 2 = 0 AND i IN (SELECT step FROM s) AND i + 4 IN (SELECT step FROM s)"""


def climatology_steps(spark, sf):
    """The climatology window nearest by time of day to each hour of events."""
    hours = C.table(spark, sf, "events").select(F.hour("ts").alias("hour")).distinct()
    return hours.select("hour", B.nearest_window(F.col("hour"), [0, 6, 12, 18], 6).alias("first"))


def calendar_dates(spark, sf):
    """Each order's day with the last day of the calendar of urgent orders up to it."""
    o = C.table(spark, sf, "orders")
    calendar = o.where("o_orderpriority = '1-URGENT' and o_custkey % 20 = 0").select(F.to_date("o_orderdate").alias("day")).distinct()
    days = o.select(F.to_date("o_orderdate").alias("date")).distinct()
    out = B.as_of_calendar(days, calendar, "date", "day")
    return out.select(F.date_format("date", "yyyy-MM-dd").alias("date"), F.date_format("calendar_day", "yyyy-MM-dd").alias("day"))


CALENDAR_SQL = """WITH c AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS day FROM orders WHERE o_orderpriority = '1-URGENT' AND o_custkey % 20 = 0), d AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS date FROM orders)
SELECT strftime(date, '%Y-%m-%d') AS date, strftime(c.day, '%Y-%m-%d') AS day FROM d ASOF LEFT JOIN c ON d.date >= c.day"""


CLIM_STEP_SQL = """WITH h AS (SELECT DISTINCT hour(ts) AS h FROM events),
d AS (SELECT h, a, least((a - (h + 6) % 24 + 24) % 24, ((h + 6) % 24 - a + 24) % 24) AS away FROM h, (VALUES (0), (6), (12), (18)) v(a))
SELECT CAST(h AS INTEGER) AS hour, CAST(a AS INTEGER) AS first FROM d QUALIFY row_number() OVER (PARTITION BY h ORDER BY away, a) = 1"""


def gaussian_numbers(spark, sf):
    """Gaussian numbers of truncations and back, for linear, quadratic and cubic grids."""
    rows = C.table(spark, sf, "supplier").select(F.col("s_suppkey").alias("number"), F.explode(F.array(*[F.lit(o) for o in (1, 2, 3)])).alias("grid"))
    return rows.select("number", "grid", B.truncation_to_gaussian(F.col("number"), F.col("grid")).alias("gaussian"), B.gaussian_to_truncation(F.col("number"), F.col("grid")).alias("truncation"))


def circle_overlaps(spark, sf):
    """Root finding: the spacing of two circles whose overlap is a share of one, put back into the area's formula."""
    shares = C.table(spark, sf, "lineitem").select(F.col("l_discount").alias("share")).distinct()
    return shares.select("share", F.round(B.overlap_of(B.overlap_spacing(F.col("share"), 100.0), 100.0), 6).alias("overlap"))


def radiation_windows(spark, sf):
    """The 24 hours whose radiation goes with each window of six steps."""
    steps = C.fields(spark, sf).select("step").distinct()
    first, last = B.radiation_window(F.col("step") + 6)
    return steps.select("step", first.alias("first"), last.alias("last"))


def window_products(spark, sf):
    """Combinations of windows over members and steps, and the cells of the fields that each holds."""
    dims = {"number": W.default([{"to": 3}, {"from": 4, "to": 6}, 7]), "step": W.step_ranges(0, 12, 6, 3)}
    cells = C.fields(spark, sf).select("number", "step").distinct()
    for dim, windows in dims.items():
        table = W.frame(spark, windows).select(F.col("coord").alias(dim), F.concat(F.lit(f"{dim}_"), F.col("window_id")).alias(f"{dim}_window"))
        cells = cells.join(F.broadcast(table), dim)
    return cells.groupBy(F.concat_ws(":", "number_window", "step_window").alias("name")).agg(F.count("*").cast("int").alias("cells"))


def quantile_labels(spark, sf):
    """Levels of quantile labels, and how many fields two requests of members return together."""
    rows = C.table(spark, sf, "region").select(F.col("r_regionkey").alias("key"), F.concat(F.col("r_regionkey"), F.lit(":4")).alias("label"), F.explode(F.array(F.sequence(F.lit(0), F.col("r_regionkey")), F.array(F.lit(0)))).alias("number"))
    return rows.groupBy("key", "label").agg(F.sum(B.volume(rows, ["number"])).cast("int").alias("members")).select("key", B.level_of(F.col("label")).alias("level"), "members")


RULES = {
    "filter:type": {
        "em/es": {"product": "ensms", "filter:param": {"t/u": {"steps": 6}, "*": {"steps": 12}}},
        "pf": {"product": "accumulate", "members": 50},
        "*": {"product": "none"},
    },
    "class": "od",
}


def product_rules(spark, sf):
    """Settings that a tree of rules gives to requests, and how many of its leaves of a request's type lead to its product."""
    params = C.table(spark, sf, "lineitem").select(F.col("l_returnflag").alias("param")).distinct().union(spark.createDataFrame([("t",)], "param string"))
    requests = params.withColumn("type", F.explode(F.array(*[F.lit(t) for t in ("em", "es", "pf", "fc")])))
    keys = {"type": "type", "param": "param"}
    made = requests.select("type", "param", *[F.coalesce(B.settings(RULES, keys, n, k), F.lit(d)).alias(n) for n, k, d in (("product", "string", ""), ("steps", "int", 0), ("members", "int", 0), ("class", "string", ""))])
    leaves = B.rule_leaves(spark, RULES, ["type", "param"], {"product": "string"}).where("type is not null").groupBy("type", "product").agg(F.count("*").cast("int").alias("found"))
    return made.join(F.broadcast(leaves), ["type", "product"], "left").fillna(0, ["found"])


RULES_SQL = """WITH r AS (SELECT type, param FROM (VALUES ('em'), ('es'), ('pf'), ('fc')) t(type), (SELECT DISTINCT l_returnflag AS param FROM lineitem UNION SELECT 't') p)
SELECT type, param, CASE WHEN type IN ('em', 'es') THEN 'ensms' WHEN type = 'pf' THEN 'accumulate' ELSE 'none' END AS product, CAST(CASE WHEN type IN ('em', 'es') THEN CASE WHEN param IN ('t', 'u') THEN 6 ELSE 12 END ELSE 0 END AS INTEGER) AS steps,
  CAST(CASE WHEN type = 'pf' THEN 50 ELSE 0 END AS INTEGER) AS members, 'od' AS class, CAST(CASE WHEN type IN ('em', 'es') THEN 3 WHEN type = 'pf' THEN 1 ELSE 0 END AS INTEGER) AS found FROM r"""

QUERIES = {
    "request_expand": (request_expand, "SELECT segment, status, 'pf' AS type FROM (SELECT DISTINCT c_mktsegment AS segment FROM customer), (SELECT DISTINCT o_orderstatus AS status FROM orders)"),
    "request_squeeze": (request_squeeze, "SELECT o_orderstatus AS status, string_agg(DISTINCT o_orderpriority, '/' ORDER BY o_orderpriority) AS priority FROM orders GROUP BY ALL"),
    "request_unique": (request_unique, "SELECT DISTINCT n_regionkey AS region, CAST(n_nationkey % 2 AS INTEGER) AS half FROM nation"),
    "request_intersection": (request_intersection, "WITH r AS (SELECT DISTINCT year(o_orderdate) AS y, o_orderstatus AS s FROM orders WHERE o_orderpriority LIKE '1%' OR o_orderpriority LIKE '2%')\nSELECT CAST(y AS INTEGER) AS year, o_orderstatus, CAST(count(*) AS BIGINT) AS n FROM orders JOIN r ON y = year(o_orderdate) AND s = o_orderstatus GROUP BY ALL"),
    "request_text": (request_text, "SELECT n_nationkey AS key, CAST(3 * n_nationkey * (n_nationkey + 1) AS BIGINT) AS steps, CAST(n_nationkey + 1 AS BIGINT) AS span, strftime(DATE '2024-01-01' + CAST(n_nationkey AS INTEGER), '%Y%m%d') AS date, 'cf/pf' AS types FROM nation"),
    "month_windows": (month_windows, MONTH_SQL),
    "model_steps": (model_steps, "WITH e AS (SELECT (day(ts) - 1) * 24 + hour(ts) AS step FROM events)\nSELECT CAST(step AS INTEGER) AS step, CAST(count(*) AS BIGINT) AS n FROM e WHERE step <= 90 OR step <= 144 AND step % 3 = 0 OR step <= 246 AND step % 6 = 0 GROUP BY ALL"),
    "output_ranges": (output_ranges, RANGES_SQL),
    "climatology_steps": (climatology_steps, CLIM_STEP_SQL),
    "gaussian_numbers": (gaussian_numbers, "SELECT s_suppkey AS number, CAST(o AS INTEGER) AS grid, CAST((s_suppkey + 1) * (o + 1) // 4 AS BIGINT) AS gaussian, CAST(ceil(4.0::DOUBLE * s_suppkey / (o + 1)) - 1 AS BIGINT) AS truncation FROM supplier, range(1, 4) t(o)"),
    "circle_overlaps": (circle_overlaps, "SELECT DISTINCT l_discount AS share, round(l_discount, 6) AS overlap FROM lineitem"),
    "radiation_windows": (radiation_windows, f"WITH {C.FIELDS_SQL}\nSELECT DISTINCT step, CAST(greatest(greatest(step + 6, 24) - 24, 0) AS INTEGER) AS first, CAST(greatest(step + 6, 24) AS INTEGER) AS last FROM fields"),
    "window_products": (window_products, f"WITH {C.FIELDS_SQL}, c AS (SELECT DISTINCT number, step FROM fields)\nSELECT 'number_' || n || ':step_' || a || '-' || (a + 6) AS name, CAST(count(*) AS INTEGER) AS cells FROM c, (VALUES ('0-3', 0, 3), ('4-6', 4, 6), ('7', 7, 7)) v(n, lo, hi), (VALUES (0), (3), (6)) s(a) WHERE number BETWEEN lo AND hi AND step BETWEEN a AND a + 6 GROUP BY ALL"),
    "request_product": (request_product, "WITH v AS (SELECT DISTINCT o_orderstatus AS status FROM orders), n AS (SELECT (SELECT count(DISTINCT o_orderpriority) FROM orders) * (SELECT count(DISTINCT c_mktsegment) FROM customer) AS n)\nSELECT status, CAST(n AS BIGINT) AS n, CAST(n * (SELECT count(*) FROM v) AS BIGINT) AS cells FROM v, n"),
    "request_cover": (request_cover, """WITH o AS (SELECT DISTINCT year(o_orderdate) AS y, dayofyear(o_orderdate) AS d, o_orderpriority AS p FROM orders)
SELECT CAST(y AS INTEGER) AS year, p AS priority, CAST(count(*) AS BIGINT) AS n, CAST(count(DISTINCT d) AS BIGINT) AS days FROM (SELECT DISTINCT y FROM o), (SELECT DISTINCT d FROM o), (SELECT DISTINCT p FROM o) WHERE (y, d, p) NOT IN (SELECT (y, d, p) FROM o) GROUP BY ALL"""),
    "request_cache": (request_cache, """WITH o AS (SELECT DISTINCT o_custkey % 50 AS cust, o_orderstatus AS status, year(o_orderdate) AS y, o_orderpriority AS p FROM orders),
w AS (SELECT cust, status, list(y) AS held FROM o WHERE p = '2-HIGH' GROUP BY ALL), a AS (SELECT cust, status, list(y) AS asked FROM o WHERE p = '1-URGENT' GROUP BY ALL)
SELECT cust, status, CAST(len(asked) AS BIGINT) AS years FROM a JOIN w USING (cust, status) WHERE list_has_all(held, asked)"""),
    "calendar_dates": (calendar_dates, CALENDAR_SQL),
    "quantile_labels": (quantile_labels, "SELECT r_regionkey AS key, r_regionkey / 4.0::DOUBLE AS level, CAST(r_regionkey + 2 AS INTEGER) AS members FROM region"),
    "product_rules": (product_rules, RULES_SQL),
}
