"""Registered queries of accumulations, windows and ensemble products, each with its SQL."""

from __future__ import annotations

import datetime as dt
import math

from pyspark.sql import functions as F

from nimbria.functions.columns import from_missing, to_missing
from nimbria.operators import accumulate as A
from nimbria.operators import ensemble as E
from nimbria.operators import extremes as X
from nimbria.operators import preprocess as P
from nimbria.plans import windows as W
from nimbria.sources import cubes as C

KEYS = ["number", "point_id"]
SLIDING = [(q, q + 3) for q in range(0, 25)]
SLIDING_SQL = "w AS (SELECT CAST(q AS VARCHAR) || '-' || CAST(q + 3 AS VARCHAR) AS window_id, CAST(c AS INTEGER) AS coord, CAST(q AS INTEGER) AS first_c FROM range(0, 25) t(q), LATERAL (SELECT unnest(range(q, q + 4)) AS c))"
JOINED_SQL = f"WITH {C.FIELDS_SQL},\n{SLIDING_SQL},\nj AS (SELECT window_id, first_c, step, number, point_id, value FROM fields JOIN w ON step = coord)"


def sliding(op: str, **options):
    return W.step_ranges(0, 27, 3, 1, op=op, **options)


def _acc(op: str, **options):
    def run(spark, sf):
        out = A.accumulate(C.fields(spark, sf), sliding(op, **options), KEYS)
        return out.select("window_id", *KEYS, F.round("value", 6).alias("value"))

    return run


def _acc_sql(expr: str, complete: str = "count(*) = 4") -> str:
    return f"{JOINED_SQL}\nSELECT window_id, number, point_id, round({expr}, 6) AS value FROM j GROUP BY ALL HAVING {complete}"


def acc_ends(op: str, factor: float = 1.0):
    def run(spark, sf):
        windows = [W.Window(f"{a}-{a + 4}", (a, a + 4), op, factor=factor) for a in range(0, 24)] + [W.Window("5", (5,), op, factor=factor)]
        return A.accumulate(C.fields(spark, sf), windows, KEYS).select("window_id", *KEYS, F.round("value", 6).alias("value"))

    return run


def _ends_sql(length: str, single: str) -> str:
    return f"""WITH {C.FIELDS_SQL}
SELECT CAST(a.step AS VARCHAR) || '-' || CAST(b.step AS VARCHAR) AS window_id, a.number, a.point_id, round((b.value - a.value) / {length}, 6) AS value
FROM fields a JOIN fields b ON b.step = a.step + 4 AND a.number = b.number AND a.point_id = b.point_id
UNION ALL SELECT '5', number, point_id, round(value / {single}, 6) FROM fields WHERE step = 5"""


def acc_histogram(spark, sf):
    windows = sliding("histogram", bins=(0.0, 100.0, 200.0, 400.0, 800.0))
    return A.accumulate(C.fields(spark, sf), windows, KEYS).select("window_id", *KEYS, "bin", F.round("value", 6).alias("value"))


def acc_histogram_mod(spark, sf):
    windows = sliding("histogram", bins=(2.5, 7.5, 12.5, 17.5), mod=20.0, normalise=False)
    return A.accumulate(C.fields(spark, sf), windows, KEYS).select("window_id", *KEYS, "bin", "value")


ACC_HISTOGRAM_SQL = f"""{JOINED_SQL},
c AS (SELECT window_id, number, point_id, count(*) FILTER (value >= 0 AND value < 100) AS b0, count(*) FILTER (value >= 100 AND value < 200) AS b1,
  count(*) FILTER (value >= 200 AND value < 400) AS b2, count(*) FILTER (value >= 400 AND value < 800) AS b3 FROM j GROUP BY ALL HAVING count(*) = 4)
SELECT window_id, number, point_id, CAST(i AS INTEGER) AS bin, round(CASE WHEN b0 + b1 + b2 + b3 = 0 THEN 'nan'::DOUBLE ELSE [b0, b1, b2, b3][i + 1]::DOUBLE / nullif(b0 + b1 + b2 + b3, 0) END, 6) AS value
FROM c, range(0, 4) t(i)"""

ACC_HISTOGRAM_MOD_SQL = f"""{JOINED_SQL},
m AS (SELECT *, value - floor(value / 20) * 20 AS r FROM j),
c AS (SELECT window_id, number, point_id, count(*) FILTER (r >= 2.5 AND r < 7.5 OR r >= 17.5) AS b0, count(*) FILTER (r >= 7.5 AND r < 12.5) AS b1,
  count(*) FILTER (r >= 12.5 AND r < 17.5 OR r < 2.5) AS b2 FROM m GROUP BY ALL HAVING count(*) = 4)
SELECT window_id, number, point_id, CAST(i AS INTEGER) AS bin, CAST([b0, b1, b2][i + 1] AS DOUBLE) AS value FROM c, range(0, 3) t(i)"""


def acc_aggregation(spark, sf):
    return A.accumulate(C.fields(spark, sf), sliding("aggregation"), KEYS).select("window_id", *KEYS, "step", "value")


def acc_deaccumulate(spark, sf):
    out = A.accumulate(C.fields(spark, sf), sliding("mean", deaccumulate=True), KEYS)
    return out.select("window_id", *KEYS, F.round("value", 6).alias("value"))


def acc_sequential(spark, sf):
    windows, _ = W.legacy({"windows": [{"operation": "mean", "coords": [{"to": 9}, {"from": 5, "to": 14}, [10, 15, 20, 29]]}, {"operation": "mean", "coords": [[3, 7]], "include_start": True}]})
    return A.accumulate(C.event_fields(spark, sf), windows, ["number", "point"]).select("window_id", "number", "point", F.round("value", 6).alias("value"))


def acc_multi_dim(spark, sf):
    dims = {"number": [W.Window("1-4", (1, 2, 3, 4), "sum"), W.Window("2-7", (2, 7), "difference")], "step": [W.Window("0-3", (0, 1, 2, 3), "maximum"), W.Window("4-7", (4, 5, 6, 7), "mean")]}
    return A.accumulate_dims(C.fields(spark, sf), dims, ["point_id"]).select("window_number", "window_step", "point_id", F.round("value", 6).alias("value"))


ACC_MULTI_SQL = f"""WITH {C.FIELDS_SQL},
s AS (SELECT '0-3' AS window_step, number, point_id, max(value) AS value FROM fields WHERE step BETWEEN 0 AND 3 GROUP BY ALL HAVING count(*) = 4
  UNION ALL SELECT '4-7', number, point_id, avg(value) FROM fields WHERE step BETWEEN 4 AND 7 GROUP BY ALL HAVING count(*) = 4)
SELECT '1-4' AS window_number, window_step, point_id, round(sum(value), 6) AS value FROM s WHERE number BETWEEN 1 AND 4 GROUP BY ALL HAVING count(*) = 4
UNION ALL SELECT '2-7', window_step, point_id, round(max_by(value, number) - min_by(value, number), 6) FROM s WHERE number IN (2, 7) GROUP BY ALL HAVING count(*) = 2"""


def monthly_stats(spark, sf):
    """Monthly means of daily values: events from 2024-01-01 in full calendar months."""
    hours = C.event_fields(spark, sf).withColumn("step", (F.col("step") + 1) * 24)
    windows = W.monthly(dt.date(2024, 1, 1), 0, 31 * 24, 24, "mean", sequential=True)
    out = A.accumulate(hours, windows, ["number", "point"])
    return out.select("window_id", "number", "point", F.round("value", 6).alias("value"))


def ensms(spark, sf):
    """Mean and deviation over members of four-quarter means."""
    members = A.accumulate(C.fields(spark, sf), sliding("mean"), KEYS)
    return E.mean_std(members, ["window_id", "point_id"]).select("window_id", "point_id", F.round("mean", 6).alias("mean"), F.round("std", 6).alias("std"))


ENSMS_SQL = f"""{JOINED_SQL},
m AS (SELECT window_id, number, point_id, avg(value) AS value FROM j GROUP BY ALL HAVING count(*) = 4)
SELECT window_id, point_id, round(avg(value), 6) AS mean, round(stddev_pop(value), 6) AS std FROM m GROUP BY ALL"""


def wind_speed(spark, sf):
    speed = P.norm("ws")(C.wind(spark, sf), ["step", "number", "point_id"])
    return E.mean_std(speed, ["step", "point_id"]).select("step", "point_id", F.round("mean", 6).alias("mean"), F.round("std", 6).alias("std"))


def wind_direction(spark, sf):
    d = P.wind_direction("u", "v")(C.wind(spark, sf), ["step", "number", "point_id"])
    return d.select("step", "number", "point_id", F.round("value", 6).alias("value"))


def preprocess_chain(spark, sf):
    """Scale, mask by another parameter, clip, then zero small values."""
    by = ["step", "number", "point_id"]
    chain = P.from_config([{"operation": "scale", "factor": 0.5}, {"operation": "mask", "select": "u", "left": "v", "sign": "<", "right": 0.0, "replacement": -1.0}, {"operation": "clip", "low": -40.0, "high": 60.0}, {"operation": "zero", "epsilon": 2.0}])
    return chain(C.wind(spark, sf), by).select(*by, F.col("value"))


def preprocess_sum(spark, sf):
    return P.total()(C.wind(spark, sf), ["step", "number", "point_id"]).select("step", "number", "point_id", "value")


def quantiles(spark, sf):
    out = E.quantiles(C.fields(spark, sf), ["step", "point_id"], 4)
    return out.select("step", "point_id", "quantile", F.round("value", 6).alias("value"))


def histogram(spark, sf):
    """Shares of the members by value; the outer bins are open, as sums grow with the table."""
    out = E.histogram(C.fields(spark, sf), ["step", "point_id"], [-math.inf, 50.0, 150.0, 400.0, math.inf])
    return out.select("step", "point_id", "label", F.round("value", 6).alias("value"))


def probabilities(spark, sf):
    """Several thresholds a window; operations follow from the comparisons."""
    specs = [{"coords": {"from": q, "to": q + 3}, "thresholds": [{"comparison": ">", "value": 150.0}, {"comparison": "<=", "value": 40.0}]} for q in range(0, 25)]
    windows, thresholds = W.threshold_windows(specs)
    members = A.accumulate(C.fields(spark, sf), windows, KEYS)
    table = spark.createDataFrame(thresholds, "window_id string, comparison string, threshold double")
    out = E.probability(members, table, ["window_id", "point_id"])
    return out.select("window_id", "point_id", "comparison", "threshold", F.round("probability", 6).alias("probability"))


PROB_SQL = f"""{JOINED_SQL},
m AS (SELECT window_id, number, point_id, min(value) AS low, max(value) AS high FROM j GROUP BY ALL HAVING count(*) = 4)
SELECT window_id || '_maximum' AS window_id, point_id, '>' AS comparison, 150.0::DOUBLE AS threshold, round(avg(CASE WHEN high > 150 THEN 100.0::DOUBLE ELSE 0 END), 6) AS probability FROM m GROUP BY ALL
UNION ALL SELECT window_id || '_minimum', point_id, '<=', 40.0::DOUBLE, round(avg(CASE WHEN low <= 40 THEN 100.0::DOUBLE ELSE 0 END), 6) FROM m GROUP BY ALL"""


def _clim(spark, sf):
    """Climatology of each point: mean and deviation over the first twelve quarters."""
    return E.climatology(C.fields(spark, sf).where("step < 12"), ["point_id"])


CLIM_SQL = "clim AS (SELECT point_id, avg(value) AS mean, stddev_pop(value) AS std FROM fields WHERE step < 12 GROUP BY ALL)"


def anomaly(spark, sf):
    out = E.anomaly(C.fields(spark, sf).where("step >= 12"), _clim(spark, sf), ["point_id"])
    return out.select("step", *KEYS, F.round("value", 6).alias("value"))


def mean_anomaly(spark, sf):
    out = E.mean_anomaly(C.fields(spark, sf).where("step >= 12"), _clim(spark, sf), ["step", "point_id"], ["point_id"])
    return out.select("step", "point_id", F.round("value", 6).alias("value"))


def anomaly_probabilities(spark, sf):
    """Anomalies and standardised anomalies before windowing, then threshold probabilities."""
    fields = C.fields(spark, sf).where("step >= 12")
    specs = [{"coords": {"from": q, "to": q + 3}, "thresholds": [{"comparison": ">", "value": 10.0}]} for q in range(12, 25)]
    windows, thresholds = W.threshold_windows(specs + [s | {"std": True, "thresholds": [{"comparison": ">=", "value": 1.0}]} for s in specs])
    plain = A.accumulate(E.anomaly(fields, _clim(spark, sf), ["point_id"]), [w for w in windows if not w.window_id.startswith("std_")], KEYS)
    standard = A.accumulate(E.anomaly(fields, _clim(spark, sf), ["point_id"], True), [w for w in windows if w.window_id.startswith("std_")], KEYS)
    table = spark.createDataFrame(thresholds, "window_id string, comparison string, threshold double")
    out = E.probability(plain.unionByName(standard), table, ["window_id", "point_id"])
    return out.select("window_id", "point_id", F.round("probability", 6).alias("probability"))


ANOMALY_PROB_SQL = f"""WITH {C.FIELDS_SQL}, {CLIM_SQL},
w AS (SELECT CAST(q AS VARCHAR) || '-' || CAST(q + 3 AS VARCHAR) AS window_id, CAST(c AS INTEGER) AS coord FROM range(12, 25) t(q), LATERAL (SELECT unnest(range(q, q + 4)) AS c)),
a AS (SELECT window_id, number, f.point_id, max(value - mean) AS a, max((value - mean) / std) AS s FROM fields f JOIN clim USING (point_id) JOIN w ON step = coord GROUP BY ALL HAVING count(*) = 4)
SELECT window_id || '_maximum' AS window_id, point_id, round(avg(CASE WHEN a > 10 THEN 100.0::DOUBLE ELSE 0 END), 6) AS probability FROM a GROUP BY ALL
UNION ALL SELECT 'std_' || window_id || '_maximum', point_id, round(avg(CASE WHEN s >= 1 THEN 100.0::DOUBLE ELSE 0 END), 6) FROM a GROUP BY ALL"""


def efi(spark, sf):
    out = X.efi(C.forecast(spark, sf), C.climate_quantiles(spark, sf), ["point_id"])
    return out.select("point_id", F.round("efi", 6).alias("efi"))


QUANTILES_SQL = "q AS (SELECT point_id, CAST(i AS INTEGER) AS quantile, list_extract(qs, i + 1) AS value FROM (SELECT point_id, quantile_cont(value, [" + ", ".join(f"{i / 100}" for i in range(101)) + "]) AS qs FROM cl GROUP BY ALL), range(0, 101) t(i))"
EFI_SQL = f"""WITH {C.ORDERS_SQL}, {QUANTILES_SQL},
f AS (SELECT q.point_id, q.quantile, avg(CASE WHEN fc.value <= q.value THEN 1.0::DOUBLE ELSE 0 END) AS f FROM q JOIN fc USING (point_id) GROUP BY ALL),
s AS (SELECT point_id, quantile / 100.0::DOUBLE AS p, f, lead(f) OVER o AS g, (quantile + 1) / 100.0::DOUBLE AS r FROM f WINDOW o AS (PARTITION BY point_id ORDER BY quantile)),
k AS (SELECT point_id, p, f, (g - f) * 100 AS s, acos(sqrt(r)) - acos(sqrt(p)) AS da, sqrt(greatest(r * (1 - r), 0)) - sqrt(greatest(p * (1 - p), 0)) AS ds FROM s WHERE g IS NOT NULL)
SELECT point_id, round(2 / pi() * sum((1 - s) * (-da - ds) + (s * p - f) * (-2 * da)), 6) AS efi FROM k GROUP BY ALL"""


def sot(spark, sf):
    q = C.climate_quantiles(spark, sf)
    high = X.sot(C.forecast(spark, sf), q, ["point_id"], 90).withColumnRenamed("sot", "sot90")
    low = X.sot(C.forecast(spark, sf), q, ["point_id"], 10).withColumnRenamed("sot", "sot10")
    return high.join(low, "point_id").select("point_id", F.round("sot90", 6).alias("sot90"), F.round("sot10", 6).alias("sot10"))


SOT_SQL = f"""WITH {C.ORDERS_SQL}
SELECT point_id, round(-(f90 - q99) / (q90 - q99), 6) AS sot90, round(-(f10 - q1) / (q10 - q1), 6) AS sot10
FROM (SELECT point_id, quantile_cont(value, 0.9) AS f90, quantile_cont(value, 0.1) AS f10 FROM fc GROUP BY ALL)
JOIN (SELECT point_id, quantile_cont(value, 0.9) AS q90, quantile_cont(value, 0.1) AS q10, quantile_cont(value, 0.99) AS q99, quantile_cont(value, 0.01) AS q1 FROM cl GROUP BY ALL) USING (point_id)"""


def cpf(spark, sf):
    return X.cpf(C.forecast(spark, sf), C.climate_quantiles(spark, sf), ["point_id"]).select("point_id", F.round("cpf", 6).alias("cpf"))


CPF_SQL = f"""WITH {C.ORDERS_SQL}, {QUANTILES_SQL},
g AS (SELECT q.point_id, quantile AS i, avg(CASE WHEN fc.value <= q.value THEN 1.0::DOUBLE ELSE 0 END) - quantile / 100.0::DOUBLE AS gap FROM q JOIN fc USING (point_id) GROUP BY q.point_id, quantile),
l AS (SELECT point_id, i, lag(gap) OVER (PARTITION BY point_id ORDER BY i) AS before, gap AS after_, sum(gap) OVER (PARTITION BY point_id) AS total FROM g),
c AS (SELECT point_id, min(i) AS i FROM l WHERE before > 0 AND after_ <= 0 OR before < 0 AND after_ >= 0 GROUP BY ALL)
SELECT t.point_id, round(CASE WHEN c.i IS NULL THEN CASE WHEN t.total > 0 THEN 0.0 ELSE 1.0 END ELSE (c.i - 1 + l.before / (l.before - l.after_)) / 100 END, 6) AS cpf
FROM (SELECT DISTINCT point_id, any_value(total) OVER (PARTITION BY point_id) AS total FROM l) t LEFT JOIN c USING (point_id) LEFT JOIN l ON l.point_id = c.point_id AND l.i = c.i"""


def significance(spark, sf):
    """Two-sided rank test of forecast against climate, as the statistic's parts allow SQL to check: p by erf series."""
    out = X.significance(C.forecast(spark, sf), C.climate(spark, sf), ["point_id"])
    return out.select("point_id", F.round("significance", 4).alias("significance"))


SIGNIFICANCE_SQL = f"""WITH {C.ORDERS_SQL},
b AS (SELECT point_id, value, 1 AS g FROM fc UNION ALL SELECT point_id, value, 2 FROM cl),
r AS (SELECT point_id, g, rank() OVER (PARTITION BY point_id ORDER BY value) + (count(*) OVER (PARTITION BY point_id, value) - 1) / 2.0::DOUBLE AS r, count(*) OVER (PARTITION BY point_id, value) AS t FROM b),
s AS (SELECT point_id, sum(r) FILTER (g = 1) AS r1, CAST(count(*) FILTER (g = 1) AS DOUBLE) AS n1, CAST(count(*) FILTER (g = 2) AS DOUBLE) AS n2, CAST(sum(t * t - 1) AS DOUBLE) AS ties FROM r GROUP BY ALL),
z AS (SELECT point_id, (greatest(r1 - n1 * (n1 + 1) / 2, n1 * n2 - (r1 - n1 * (n1 + 1) / 2)) - n1 * n2 / 2) / sqrt(n1 * n2 / 12 * ((n1 + n2 + 1) - ties / ((n1 + n2) * (n1 + n2 - 1)))) AS z FROM s),
e AS (SELECT point_id, z, (SELECT sum(exp(-pow(z * (i + 0.5) / 20000, 2) / 2)) * z / 20000 FROM range(0, 20000) t(i)) / sqrt(2 * pi()) AS phi FROM z)
SELECT point_id, round(100 * least(1.0, 2 * (0.5 - phi)), 4) AS significance FROM e"""


def missing_round_trip(spark, sf):
    """NaN to the sentinel and back, with a count of missing values."""
    f = C.fields(spark, sf).withColumn("value", F.when(F.col("value") < 60, F.lit(float("nan"))).otherwise(F.col("value")))
    f = f.withColumn("value", from_missing(to_missing(F.col("value"))))
    return E.statistics(f, ["step"]).select("step", "n", "missing", F.round("minimum", 6).alias("minimum"), F.round("maximum", 6).alias("maximum"), F.round("mean", 6).alias("mean"))


def spread(spark, sf):
    """Mean spread by source priority: for each order day the source of the smallest priority number."""
    o = C.table(spark, sf, "orders").select(F.to_date("o_orderdate").alias("date"), F.month("o_orderdate").alias("step"), F.col("o_orderpriority").alias("source"), (F.col("o_custkey") % 5).cast("int").alias("point_id"), F.round("o_totalprice").alias("value"))
    spreads = o.groupBy("date", "step", "source", "point_id").agg(F.max("value").alias("value"))
    out = E.spread_by_priority(spreads, ["point_id"], ["1-URGENT", "2-HIGH", "3-MEDIUM"])
    return out.select("point_id", F.round("value", 4).alias("value"))


SPREAD_SQL = """WITH s AS (SELECT CAST(o_orderdate AS DATE) AS date, month(o_orderdate) AS step, o_orderpriority AS source, CAST(o_custkey % 5 AS INTEGER) AS point_id, max(round(o_totalprice)) AS value FROM orders GROUP BY ALL),
b AS (SELECT *, row_number() OVER (PARTITION BY point_id, date, step ORDER BY source) AS r FROM s WHERE source IN ('1-URGENT', '2-HIGH', '3-MEDIUM'))
SELECT point_id, round(avg(value), 4) AS value FROM b WHERE r = 1 GROUP BY ALL"""

QUERIES = {
    "acc_sum": (_acc("sum"), _acc_sql("sum(value)")),
    "acc_minimum": (_acc("minimum"), _acc_sql("min(value)")),
    "acc_maximum": (_acc("maximum"), _acc_sql("max(value)")),
    "acc_mean": (_acc("mean"), _acc_sql("avg(value)")),
    "acc_standard_deviation": (_acc("standard_deviation"), _acc_sql("stddev_pop(value)")),
    "acc_weighted_mean": (_acc("weighted_mean"), _acc_sql("sum(CASE WHEN step > first_c THEN value / 3 END)", "count(*) FILTER (step > first_c) = 3")),
    "acc_integral": (_acc("integral"), _acc_sql("sum(CASE WHEN step > first_c THEN value * (step - coalesce(prev, first_c)) END)", "max(step) = first_c + 3").replace("point_id, value FROM fields JOIN w ON step = coord)", "point_id, value, lag(step) OVER (PARTITION BY window_id, number, point_id ORDER BY step) AS prev FROM fields JOIN w ON step = coord)")),
    "acc_difference": (acc_ends("difference"), _ends_sql("1", "1")),
    "acc_difference_rate": (acc_ends("difference_rate", 0.5), _ends_sql("(0.5::DOUBLE * 4)", "(0.5::DOUBLE * 5)")),
    "acc_histogram": (acc_histogram, ACC_HISTOGRAM_SQL),
    "acc_histogram_mod": (acc_histogram_mod, ACC_HISTOGRAM_MOD_SQL),
    "acc_aggregation": (acc_aggregation, f"{JOINED_SQL}\nSELECT window_id, number, point_id, step, value FROM j QUALIFY count(*) OVER (PARTITION BY window_id, number, point_id) = 4"),
    "acc_deaccumulate_mean": (acc_deaccumulate, f"{JOINED_SQL},\nd AS (SELECT *, value - lag(value) OVER (PARTITION BY window_id, number, point_id ORDER BY step) AS delta FROM j)\nSELECT window_id, number, point_id, round(avg(delta), 6) AS value FROM d GROUP BY ALL HAVING count(delta) = 3"),
    "acc_sequential_mean": (acc_sequential, f"WITH {C.EVENTS_SQL},\nw AS (SELECT * FROM (VALUES ('0-9_0', range(1, 10), 9), ('5-14_0', range(6, 15), 14), ('10-29_0', [15, 20, 29], 29), ('3-7_1', [3, 7], 7)) v(window_id, coords, b))\nSELECT window_id, number, point, round(avg(value), 6) AS value FROM fields JOIN w ON list_contains(coords, step) GROUP BY window_id, number, point, b HAVING max(step) = b"),
    "acc_multi_dim": (acc_multi_dim, ACC_MULTI_SQL),
    "monthly_stats": (monthly_stats, f"WITH {C.EVENTS_SQL}\nSELECT '0-744' AS window_id, number, point, round(avg(value), 6) AS value FROM fields WHERE step BETWEEN 0 AND 30 GROUP BY ALL HAVING max(step) = 30"),
    "ensms_mean_std": (ensms, ENSMS_SQL),
    "wind_speed": (wind_speed, f"WITH {C.WIND_SQL}\nSELECT step, point_id, round(avg(sqrt(u * u + v * v)), 6) AS mean, round(stddev_pop(sqrt(u * u + v * v)), 6) AS std FROM cells GROUP BY ALL"),
    "wind_direction": (wind_direction, f"WITH {C.WIND_SQL}\nSELECT step, number, point_id, round((CASE WHEN d < 0 THEN d + 360 ELSE d END) + 0.0, 6) AS value FROM (SELECT *, degrees(atan2(-u, -v)) AS d FROM cells)"),
    "preprocess_chain": (preprocess_chain, f"WITH {C.WIND_SQL}\nSELECT step, number, point_id, CASE WHEN abs(x) <= 2 THEN 0.0 ELSE x END AS value FROM (SELECT *, greatest(-40.0::DOUBLE, least(60.0::DOUBLE, CASE WHEN v * 0.5 < 0 THEN -1.0 ELSE u * 0.5 END)) AS x FROM cells)"),
    "preprocess_sum": (preprocess_sum, f"WITH {C.WIND_SQL}\nSELECT step, number, point_id, u + v AS value FROM cells"),
    "quantiles": (quantiles, f"WITH {C.FIELDS_SQL}\nSELECT step, point_id, CAST(i AS VARCHAR) || ':4' AS quantile, round(list_extract(q, i + 1), 6) AS value FROM (SELECT step, point_id, quantile_cont(value, [0.0, 0.25, 0.5, 0.75, 1.0]) AS q FROM fields GROUP BY ALL), range(0, 5) t(i)"),
    "histogram": (histogram, f"WITH {C.FIELDS_SQL},\nc AS (SELECT step, point_id, [count(*) FILTER (value < 50), count(*) FILTER (value >= 50 AND value < 150), count(*) FILTER (value >= 150 AND value < 400), count(*) FILTER (value >= 400)] AS b, count(*) AS n FROM fields GROUP BY ALL)\nSELECT step, point_id, CAST(i AS VARCHAR) || ':4' AS label, round(b[i] / n::DOUBLE, 6) AS value FROM c, range(1, 5) t(i)"),
    "threshold_probability": (probabilities, PROB_SQL),
    "anomaly": (anomaly, f"WITH {C.FIELDS_SQL}, {CLIM_SQL}\nSELECT step, number, point_id, round(value - mean, 6) AS value FROM fields JOIN clim USING (point_id) WHERE step >= 12"),
    "mean_anomaly": (mean_anomaly, f"WITH {C.FIELDS_SQL}, {CLIM_SQL}\nSELECT step, f.point_id, round(avg(value) - any_value(mean), 6) AS value FROM fields f JOIN clim USING (point_id) WHERE step >= 12 GROUP BY ALL"),
    "anomaly_probability": (anomaly_probabilities, ANOMALY_PROB_SQL),
    "efi": (efi, EFI_SQL),
    "sot": (sot, SOT_SQL),
    "cpf": (cpf, CPF_SQL),
    "significance": (significance, SIGNIFICANCE_SQL),
    "field_statistics": (missing_round_trip, f"WITH {C.FIELDS_SQL}\nSELECT step, CAST(count(*) AS BIGINT) AS n, CAST(count(*) FILTER (value < 60) AS BIGINT) AS missing, round(min(value) FILTER (value >= 60), 6) AS minimum, round(max(value) FILTER (value >= 60), 6) AS maximum, round(avg(value) FILTER (value >= 60), 6) AS mean FROM fields GROUP BY ALL"),
    "mean_spread_priority": (spread, SPREAD_SQL),
}
