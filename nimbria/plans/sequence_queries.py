"""Queries of windows over calendars, of clustering steps and of a clustering's records, with their SQL."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from nimbria.operators import cluster as K
from nimbria.plans import dates as D
from nimbria.plans import tables as B
from nimbria.sources import cubes as C

FIRST, LAST = dt.date(1990, 1, 1), dt.date(2030, 12, 31)
DAYS_SQL = f"days AS (SELECT CAST(d AS DATE) AS day FROM range(DATE '{FIRST}', DATE '{LAST}' + INTERVAL 1 DAY, INTERVAL 1 DAY) t(d))"
DAILY_SQL = "daily AS (SELECT CAST(o_orderdate AS DATE) AS day, sum(o_totalprice) AS value FROM orders GROUP BY ALL)"


def _daily(spark, sf):
    return C.table(spark, sf, "orders").groupBy(F.to_date("o_orderdate").alias("day")).agg(F.sum("o_totalprice").alias("value"))


def _text(day):
    return F.date_format(day, "yyyy-MM-dd")


def calendar_brackets(spark, sf):
    """Around each day with orders: the mean daily value of the three Mondays and Thursdays before it, the two after it, and the
    day itself if it is one; Mondays and Thursdays on 29 February or 25 December are left out."""
    daily = _daily(spark, sf)
    days = D.calendar(spark, FIRST, LAST, "weekly", [0, 3], [(2, 29), (12, 25)])
    found = D.brackets(daily.select(F.col("day").alias("date")), days, "date", 3, 2, strict=False)
    means = found.join(daily, "day", "left").groupBy("date").agg(F.min("day").alias("first"), F.max("day").alias("last"), F.count("*").alias("n"), F.round(F.avg("value"), 4).alias("mean"))
    return means.select(_text("date").alias("date"), _text("first").alias("first"), _text("last").alias("last"), "n", "mean")


BRACKETS_SQL = f"""WITH {DAYS_SQL}, {DAILY_SQL},
c AS (SELECT day, row_number() OVER (ORDER BY day) AS at FROM days WHERE isodow(day) IN (1, 4) AND strftime(day, '%m-%d') NOT IN ('02-29', '12-25')),
p AS (SELECT d.day AS date, (SELECT count(*) FROM c WHERE c.day < d.day) AS under, (SELECT count(*) FROM c WHERE c.day <= d.day) AS upto FROM daily d),
w AS (SELECT p.date, c.day FROM p JOIN c ON c.at BETWEEN under - 2 AND upto + 2)
SELECT strftime(date, '%Y-%m-%d') AS date, strftime(min(w.day), '%Y-%m-%d') AS first, strftime(max(w.day), '%Y-%m-%d') AS last, count(*) AS n, round(avg(value), 4) AS mean
FROM w LEFT JOIN daily USING (day) GROUP BY date"""


def calendar_spans(spark, sf):
    """The 1st and 16th of months within each customer's span of orders, its first day left out: windows of such dates."""
    spans = C.table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("customer")).agg(F.to_date(F.min("o_orderdate")).alias("first"), F.to_date(F.max("o_orderdate")).alias("last"))
    found = D.spans(spans, D.calendar(spark, FIRST, LAST, "monthly", [1, 16]), ["customer"], with_first=False)
    return D.labelled(found, ["customer"])


SPANS_SQL = f"""WITH {DAYS_SQL},
s AS (SELECT o_custkey AS customer, CAST(min(o_orderdate) AS DATE) AS first, CAST(max(o_orderdate) AS DATE) AS last FROM orders GROUP BY ALL)
SELECT customer, strftime(min(day), '%Y%m%d') || '-' || strftime(max(day), '%Y%m%d') AS dates, count(*) AS n
FROM s JOIN days ON day > first AND day <= last AND day(day) IN (1, 16) GROUP BY customer"""


def clustering_steps(spark, sf):
    """Steps of clusterings that begin and end at customers' and orders' numbers: how many, the last, and whether monthly."""
    jobs = C.table(spark, sf, "customer").select(F.col("c_custkey").alias("job"), (F.col("c_nationkey") * 6).cast("int").alias("first"), (F.col("c_nationkey") * 6 + F.col("c_custkey") % 9 * 24).cast("int").alias("last"), F.lit(12).alias("every"))
    return B.cluster_steps(jobs).groupBy("job", "monthly").agg(F.count("*").alias("n"), F.max("step").alias("last"))


STEPS_SQL = """WITH j AS (SELECT c_custkey AS job, c_nationkey * 6 AS a, c_nationkey * 6 + c_custkey % 9 * 24 AS b FROM customer),
m AS (SELECT job, a, b, b - a > 120 OR a = b AS monthly FROM j)
SELECT job, monthly, CAST((b - a) // w + 1 AS BIGINT) AS n, CAST(a + (b - a) // w * w AS INTEGER) AS last FROM (SELECT *, CASE WHEN monthly THEN 84 ELSE 12 END AS w FROM m)"""


def cluster_records(spark, sf):
    """Records of clusterings, one for each grid point: members by their mean, above that of all cells or not, each cluster with
    the member of the smallest norm; the control is member 1, the deterministic forecast is where member 2 is; regimes are
    the clusters' own numbers at step 0; at least three clusters."""
    cells = C.fields(spark, sf)
    own = cells.groupBy("point_id", "number").agg(F.avg("value").alias("own"), F.sum(F.col("value") * F.col("value")).alias("square"))
    labels = own.join(cells.groupBy("point_id").agg(F.avg("value").alias("mean")), "point_id").withColumn("cluster", F.when(F.col("own") > F.col("mean"), 1).otherwise(0))
    low = labels.groupBy("point_id").agg(F.min("cluster").alias("low"))  # numbers begin at 0 at every point
    labels = labels.join(low, "point_id").withColumn("cluster", F.col("cluster") - F.col("low")).select("point_id", "number", "cluster", "square")
    chosen = labels.groupBy("point_id", "cluster").agg(F.min_by("number", F.struct("square", "number")).alias("number"))
    regimes = labels.select("point_id", "cluster").distinct().select("*", F.lit(0).alias("first_step"), (F.col("cluster") + 1).alias("regime"))
    out = K.records(labels.select("point_id", "number", "cluster"), chosen, [(0, None), (6, 12)], ["point_id"], 1, labels.where("number = 2").select("point_id", "cluster"), regimes, 3)
    return out.withColumn("members", F.array_join("members", "/")).withColumn("last_step", F.coalesce("last_step", F.lit(-1)))


RECORDS_SQL = f"""WITH {C.FIELDS_SQL},
o AS (SELECT point_id, number, avg(value) AS own, sum(value * value) AS square FROM fields GROUP BY ALL),
l AS (SELECT point_id, number, square, CASE WHEN own > (SELECT avg(value) FROM fields f WHERE f.point_id = o.point_id) THEN 1 ELSE 0 END AS c FROM o),
n AS (SELECT point_id, number, square, c - min(c) OVER (PARTITION BY point_id) AS c FROM l),
g AS (SELECT point_id, c, count(*) AS n_members, string_agg(number, '/' ORDER BY number) AS members, arg_min(number, (square, number)) AS rep FROM n GROUP BY ALL),
p AS (SELECT DISTINCT n.point_id, k, (SELECT max(c) + 1 FROM n m WHERE m.point_id = n.point_id) AS n_clusters, (SELECT max(c) + 1 FROM n m WHERE m.point_id = n.point_id AND number = 1) AS cc, (SELECT max(c) + 1 FROM n m WHERE m.point_id = n.point_id AND number = 2) AS dc FROM n, range(0, 3) t(k))
SELECT p.point_id, CAST(n_clusters AS INTEGER) AS n_clusters, CAST(CASE WHEN rep IS NULL THEN 0 ELSE coalesce(cc, 0) END AS INTEGER) AS control_cluster, CAST(k + 1 AS INTEGER) AS cluster, CAST(coalesce(n_members, 0) AS INTEGER) AS n_members,
  coalesce(members, '') AS members, CAST(CASE WHEN rep IS NULL THEN 0 ELSE coalesce(dc, 0) END AS INTEGER) AS deterministic_cluster, CAST(coalesce(rep, 0) AS INTEGER) AS representative, CAST(a AS INTEGER) AS first_step, CAST(b AS INTEGER) AS last_step,
  CAST(CASE WHEN rep IS NULL OR a > 0 THEN 0 ELSE k + 1 END AS INTEGER) AS regime
FROM p LEFT JOIN g ON g.point_id = p.point_id AND g.c = p.k, (VALUES (0, -1), (6, 12)) s(a, b)"""


def sole_clusters(spark, sf):
    """One cluster of all members at each grid point: its representative and its size."""
    pcs = C.fields(spark, sf).select("point_id", "number", F.col("step").alias("component"), F.col("value").alias("pc"))
    labels, chosen = K.undivided(pcs, ["point_id"])
    return labels.groupBy("point_id").agg(F.count("*").alias("n")).join(chosen.select("point_id", F.col("number").alias("representative")), "point_id")


SOLE_SQL = f"""WITH {C.FIELDS_SQL}, o AS (SELECT point_id, number, sum(value * value) AS square FROM fields GROUP BY ALL)
SELECT point_id, count(*) AS n, arg_min(number, (square, number)) AS representative FROM o GROUP BY point_id"""

QUERIES = {
    "calendar_brackets": (calendar_brackets, BRACKETS_SQL),
    "calendar_spans": (calendar_spans, SPANS_SQL),
    "clustering_steps": (clustering_steps, STEPS_SQL),
    "cluster_records": (cluster_records, RECORDS_SQL),
    "sole_clusters": (sole_clusters, SOLE_SQL),
}
