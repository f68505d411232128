"""Registered queries of Gaussian grids and spectral transforms."""

from __future__ import annotations

from pyspark.sql import functions as F

from nimbria.operators import grids, spectral
from nimbria.operators import spatial as S
from nimbria.sources import cubes as C

#: Rows of an octahedral grid of number 16 and of a regular one of number 8, in SQL: latitudes by bisection.
ROWS_SQL = """bisection(k, i, lo, hi) AS (
  SELECT k, 0, cos(pi() * k / ({d} + 0.5)), cos(pi() * (k - 0.5) / ({d} + 0.5)) FROM range(1, {d} // 2 + 1) AS t(k)
  UNION ALL
  SELECT k, i + 1, CASE WHEN same THEN lo ELSE mid END, CASE WHEN same THEN mid ELSE hi END
  FROM (SELECT *, list_reduce(list_prepend({{'j': 1.0::DOUBLE, 'p': mid, 'q': 1.0::DOUBLE}}, list_transform(range(2, {d} + 1), lambda j: {{'j': j::DOUBLE, 'p': 0.0::DOUBLE, 'q': 0.0::DOUBLE}})),
      lambda a, b: {{'j': b.j, 'p': ((2 * b.j - 1) * mid * a.p - (b.j - 1) * a.q) / b.j, 'q': a.p}}).p * (CASE WHEN k % 2 = 1 THEN 1 ELSE -1 END) > 0 AS same
    FROM (SELECT *, (lo + hi) / 2 AS mid FROM bisection WHERE i < 58))),
rows_ AS MATERIALIZED (
  SELECT CAST(r AS INTEGER) AS r, CASE WHEN r < {d} // 2 THEN x ELSE -x END AS mu, {length} AS n_lon
  FROM range(0, {d}) AS t(r) JOIN (SELECT k, (lo + hi) / 2 AS x FROM bisection WHERE i = 58) b ON k = least(r + 1, {d} - r)),
numbered AS MATERIALIZED (SELECT *, degrees(asin(mu)) AS lat, CAST(sum(n_lon) OVER (ORDER BY r) - n_lon AS INTEGER) AS first FROM rows_)"""

OCTAHEDRAL_SQL = ROWS_SQL.format(d=32, length="16 + 4 * least(r + 1, 32 - r)")
REGULAR_SQL = ROWS_SQL.format(d=16, length="32")

TARGET_SQL = """target AS (SELECT CAST(c_custkey AS INTEGER) AS point_id, ((c_custkey * 7919) % 18001) / 100.0::DOUBLE - 90 AS lat, ((c_custkey * 104729) % 36000) / 100.0::DOUBLE AS lon FROM customer),
fields AS (SELECT event_type AS step, CAST(event_id % 1600 AS INTEGER) AS p, avg(value) AS value FROM events GROUP BY ALL)"""


def _target(spark, sf):
    """Customers as target points over the whole globe, poles included."""
    key = F.col("c_custkey")
    return C.table(spark, sf, "customer").select(key.cast("int").alias("point_id"), ((key * 7919) % 18001 / 100.0 - 90).alias("lat"), ((key * 104729) % 36000 / 100.0).alias("lon"))


def _fields(spark, sf):
    """Events on the 1,600 points of the octahedral grid O16: each type is a step, the mean value at a point the field."""
    return C.table(spark, sf, "events").groupBy(F.col("event_type").alias("step"), (F.col("event_id") % 1600).cast("int").alias("point_id")).agg(F.avg("value").alias("value"))


def reduced_bilinear(spark, sf):
    out = S.regrid(_fields(spark, sf), grids.bilinear_weights("O16", _target(spark, sf)), ["step"])
    return out.select("step", "point_id", F.round(F.col("value") + 1e-9, 6).alias("value"))


REDUCED_BILINEAR_SQL = f"""WITH RECURSIVE {OCTAHEDRAL_SQL}, {TARGET_SQL},
gaps AS (
  SELECT n.lat AS high, coalesce(s.lat, -91) AS low, n.lat AS nlat, coalesce(s.lat, n.lat) AS slat, n.n_lon AS nn, n.first AS nf, coalesce(s.n_lon, n.n_lon) AS sn, coalesce(s.first, n.first) AS sf
  FROM numbered n LEFT JOIN numbered s ON s.r = n.r + 1
  UNION ALL SELECT 91, lat, lat, lat, n_lon, first, n_lon, first FROM numbered WHERE r = 0),
met AS (SELECT point_id, lon, nn, nf, sn, sf, CASE WHEN nlat > slat THEN (nlat - lat) / (nlat - slat) ELSE 0 END AS down FROM target JOIN gaps ON lat <= high AND lat > low),
along AS (SELECT point_id, nn AS n, nf AS f, 1 - down AS share, lon * nn / 360 AS x FROM met UNION ALL SELECT point_id, sn, sf, down, lon * sn / 360 FROM met),
corners AS (
  SELECT point_id, f + CAST(floor(x) AS INTEGER) % n AS p, share * (1 - (x - floor(x))) AS w FROM along
  UNION ALL SELECT point_id, f + CAST(floor(x) + 1 AS INTEGER) % n, share * (x - floor(x)) FROM along)
SELECT step, point_id, round(sum(w * value) / sum(w) + 1e-9, 6) AS value FROM corners JOIN fields USING (p) WHERE w > 0 GROUP BY ALL"""


def reduced_nearest(spark, sf):
    """Each customer's nearest point of the grid; the SQL looks at all 1,600."""
    out = grids.nearest_weights("O16", _target(spark, sf))
    return out.groupBy("in_point").agg(F.count("*").alias("n"), F.min("out_point").alias("first_target"))


REDUCED_NEAREST_SQL = f"""WITH RECURSIVE {OCTAHEDRAL_SQL}, {TARGET_SQL},
grid AS (SELECT first + j AS p, lat AS glat, j * 360.0::DOUBLE / n_lon AS glon FROM numbered, unnest(range(0, n_lon)) AS t(j)),
d AS (SELECT point_id, p, 2 * 6371.0::DOUBLE * asin(sqrt(least(1.0, pow(sin(radians(glat - lat) / 2), 2) + cos(radians(lat)) * cos(radians(glat)) * pow(sin(radians(glon - lon) / 2), 2)))) AS d FROM target, grid),
best AS (SELECT point_id, arg_min(p, {{'d': round(d, 7), 'p': p}}) AS p FROM d GROUP BY point_id)
SELECT CAST(p AS INTEGER) AS in_point, CAST(count(*) AS BIGINT) AS n, min(point_id) AS first_target FROM best GROUP BY p"""


TRUNCATION = 9
#: Coefficients from embeddings: the numbers of all vectors of a label are summed; 55 of them are the terms (n, m) to degree 9.
COEFFICIENT_SQL = """parts AS (SELECT label, p, sum(CAST(embedding[p + 1] AS DOUBLE)) AS a FROM embeddings, range(0, 64) AS t(p) WHERE embedding IS NOT NULL GROUP BY ALL),
terms AS (SELECT n, m, n * (n + 1) // 2 + m AS p FROM range(0, 10) AS t(n), range(0, 10) AS u(m) WHERE m <= n),
coefficients AS (SELECT label, n, m, x.a AS re, CASE WHEN m = 0 THEN 0 ELSE y.a END AS im FROM terms JOIN parts x USING (p) JOIN parts y USING (label) WHERE y.p = (terms.p + 9) % 64)"""


def _coefficients(spark, sf):
    parts = C.table(spark, sf, "embeddings").select("label", F.posexplode("embedding").alias("p", "a")).groupBy("label", "p").agg(F.sum(F.col("a").cast("double")).alias("a"))
    n = F.floor((F.sqrt(8 * F.col("p") + 1.0) - 1) / 2).cast("int")
    real = parts.where("p < 55").select("label", "p", n.alias("n"), (F.col("p") - n * (n + 1) / 2).cast("int").alias("m"), F.col("a").alias("re"))
    other = parts.select("label", ((F.col("p") + 55) % 64).alias("p"), F.col("a").alias("b"))  # the number nine places on
    return real.join(other, ["label", "p"]).select("label", "n", "m", "re", F.when(F.col("m") == 0, 0.0).otherwise(F.col("b")).alias("im"))


LEGENDRE_SQL = """p(r, mu, m, n, p, q) AS (
  SELECT r, mu, m, m, pow(1 - mu * mu, m / 2.0::DOUBLE) * sqrt(list_product(list_transform(range(1, m + 1), lambda k: (2 * k + 1) / (2.0::DOUBLE * k)) || [1.0])), 0.0::DOUBLE FROM numbered, range(0, {top} + 1) AS t(m)
  UNION ALL
  SELECT r, mu, m, n + 1, (mu * p - sqrt((n * n - m * m) / (4.0::DOUBLE * n * n - 1)) * q) / sqrt(((n + 1) * (n + 1) - m * m) / (4.0::DOUBLE * (n + 1) * (n + 1) - 1)), p FROM p WHERE n < {top})"""


def spectral_grid(spark, sf):
    """The fields of the labels' coefficients on the regular grid F8."""
    out = spectral.synthesis(_coefficients(spark, sf), ["label"], "F8", TRUNCATION)
    return out.select("label", "point_id", F.round(F.col("value") + 1e-9, 5).alias("value"))


SPECTRAL_GRID_SQL = f"""WITH RECURSIVE {REGULAR_SQL}, {COEFFICIENT_SQL}, {LEGENDRE_SQL.format(top=9)}
SELECT label, CAST(r * 32 + j AS INTEGER) AS point_id,
  round(sum(p * (CASE WHEN c.m = 0 THEN 1 ELSE 2 END) * (re * cos(2 * pi() * c.m * j / 32) - im * sin(2 * pi() * c.m * j / 32))) + 1e-9, 5) AS value
FROM coefficients c JOIN p ON c.n = p.n AND c.m = p.m, range(0, 32) AS t(j) GROUP BY label, r, j"""


def spectral_round_trip(spark, sf):
    """Coefficients, to the grid F8 and back."""
    grid = spectral.synthesis(_coefficients(spark, sf), ["label"], "F8", TRUNCATION)
    out = spectral.analysis(grid, ["label"], "F8", TRUNCATION)
    return out.select("label", "n", "m", F.round(F.col("re") + 1e-9, 6).alias("re"), F.round(F.col("im") + 1e-9, 6).alias("im"))


SPECTRAL_ROUND_TRIP_SQL = f"""WITH {COEFFICIENT_SQL}
SELECT label, CAST(n AS INTEGER) AS n, CAST(m AS INTEGER) AS m, round(re + 1e-9, 6) AS re, round(im + 1e-9, 6) AS im FROM coefficients"""


def spectral_wind(spark, sf):
    """Wind on the octahedral grid O16: the coefficients are vorticity, those of label + 1 divergence; radius 1."""
    c = _coefficients(spark, sf)
    both = c.select("label", F.lit("vo").alias("param"), "n", "m", "re", "im").unionByName(c.select((F.col("label") - 1).alias("label"), F.lit("d").alias("param"), "n", "m", "re", "im"))
    out = spectral.wind_on_grid(both, ["label"], "O16", TRUNCATION, radius=1.0)
    return out.select("label", "param", "point_id", F.round(F.col("value") + 1e-9, 5).alias("value"))


#: u and v from derivatives: (1 - mu^2) dP/dmu = (n + 1) e(n) P(n - 1) - n e(n + 1) P(n + 1), the factor i m along a row.
SPECTRAL_WIND_SQL = f"""WITH RECURSIVE {OCTAHEDRAL_SQL}, {COEFFICIENT_SQL}, {LEGENDRE_SQL.format(top=10)},
h AS (
  SELECT a.r, a.mu, a.n, a.m, a.p, (a.n + 1) * sqrt((a.n * a.n - a.m * a.m) / (4.0::DOUBLE * a.n * a.n - 1)) * coalesce(b.p, 0)
    - a.n * sqrt(((a.n + 1) * (a.n + 1) - a.m * a.m) / (4.0::DOUBLE * (a.n + 1) * (a.n + 1) - 1)) * c.p AS h
  FROM p a LEFT JOIN p b ON a.r = b.r AND a.m = b.m AND b.n = a.n - 1 JOIN p c ON a.r = c.r AND a.m = c.m AND c.n = a.n + 1),
waves AS (
  SELECT label, r, mu, m, part, sum(-re / (h.n * (h.n + 1)) * p) AS pr, sum(-im / (h.n * (h.n + 1)) * p) AS pi, sum(-re / (h.n * (h.n + 1)) * h) AS hr, sum(-im / (h.n * (h.n + 1)) * h) AS hi
  FROM (SELECT label, 'vo' AS part, n, m, re, im FROM coefficients UNION ALL SELECT label - 1, 'd', n, m, re, im FROM coefficients) JOIN h USING (n, m) WHERE h.n > 0 GROUP BY ALL),
both_ AS (
  SELECT label, r, mu, m, 'u' AS param, -hr AS a, -hi AS b FROM waves WHERE part = 'vo' UNION ALL SELECT label, r, mu, m, 'v', -m * pi, m * pr FROM waves WHERE part = 'vo'
  UNION ALL SELECT label, r, mu, m, 'u', -m * pi, m * pr FROM waves WHERE part = 'd' UNION ALL SELECT label, r, mu, m, 'v', hr, hi FROM waves WHERE part = 'd')
SELECT label, param, first + CAST(j AS INTEGER) AS point_id,
  round(sum((CASE WHEN m = 0 THEN 1 ELSE 2 END) * (a * cos(2 * pi() * m * j / n_lon) - b * sin(2 * pi() * m * j / n_lon))) / sqrt(1 - any_value(numbered.mu) * any_value(numbered.mu)) + 1e-9, 5) AS value
FROM both_ JOIN numbered USING (r), unnest(range(0, n_lon)) AS t(j) GROUP BY label, param, r, first, j"""


QUERIES = {
    "reduced_bilinear": (reduced_bilinear, REDUCED_BILINEAR_SQL),
    "reduced_nearest": (reduced_nearest, REDUCED_NEAREST_SQL),
    "spectral_grid": (spectral_grid, SPECTRAL_GRID_SQL),
    "spectral_round_trip": (spectral_round_trip, SPECTRAL_ROUND_TRIP_SQL),
    "spectral_wind": (spectral_wind, SPECTRAL_WIND_SQL),
}
