"""Gaussian grids, interpolation from them, spherical-harmonic transforms and wind from vorticity and divergence."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from nimbria.operators import grids, spectral
from nimbria.operators.spatial import regrid

TARGET = "point_id int, lat double, lon double"


def test_rows_are_legendre_roots(spark):
    x, w = np.polynomial.legendre.leggauss(96)
    got = grids.rows(spark, "F48").orderBy("row").toPandas()
    np.testing.assert_allclose(got.mu, x[::-1], atol=1e-14)
    np.testing.assert_allclose(got.weight, w[::-1], rtol=1e-11)
    assert (got.n_lon == 192).all() and (got["first"] == got.row * 192).all()


@pytest.mark.parametrize("grid, count", [("O1", 40), ("O16", 1600), ("O40", 7840), ("F8", 512)])
def test_points_are_numbered_row_by_row(spark, grid, count):
    got = grids.points(spark, grid).orderBy("point_id").collect()
    assert [r.point_id for r in got] == list(range(count))
    assert all(a.lat > b.lat or (a.lat == b.lat and a.lon < b.lon) for a, b in zip(got, got[1:], strict=False))


def test_row_lengths_can_be_given(spark):
    got = grids.points(spark, "F2", [4, 8, 8, 4]).groupBy("lat").count().orderBy("lat").collect()
    assert [r["count"] for r in got] == [4, 8, 8, 4]
    with pytest.raises(ValueError):
        grids.rows(spark, "F2", [4, 8])
    for bad in ("N32", "O0", "F", "O9000", "1/1"):
        with pytest.raises(ValueError):
            grids.rows(spark, bad)


def test_bilinear_is_exact_for_linear_fields(spark):
    """A field that is linear in latitude is met exactly between rows; weights of a target sum to one."""
    rng = np.random.default_rng(6)
    rows = [(i, float(a), float(b)) for i, (a, b) in enumerate(zip(rng.uniform(-85, 85, 200), rng.uniform(-360, 720, 200), strict=True))]
    target = spark.createDataFrame(rows, TARGET)
    w = grids.bilinear_weights("O16", target)
    assert w.groupBy("out_point").agg(F.sum("w").alias("s")).where("abs(s - 1) > 1e-12").isEmpty()
    fields = grids.points(spark, "O16").select(F.lit(1).alias("step"), "point_id", (3 * F.col("lat") + 1).alias("value"))
    got = {r.point_id: r.value for r in regrid(fields, w, ["step"]).collect()}
    assert all(got[i] == pytest.approx(3 * lat + 1) for i, lat, _ in rows) and len(got) == 200


def test_targets_at_poles_rows_and_nowhere(spark):
    first = grids.rows(spark, "O16").where("row = 0").first()
    rows = [(0, 90.0, 10.0), (1, -90.0, 0.0), (2, first.lat, 18.0), (3, first.lat, 359.0), (4, float("nan"), 0.0), (5, None, 0.0), (6, 10.0, None), (7, 95.0, 0.0)]
    target = spark.createDataFrame(rows, TARGET)
    by = {}
    for r in grids.bilinear_weights("O16", target).collect():
        by.setdefault(r.out_point, {})[r.in_point] = r.w
    assert by[0] == {0: pytest.approx(1 - 10 / 18), 1: pytest.approx(10 / 18)}
    assert by[1] == {1580: 1.0} and by[2] == {1: 1.0}
    assert by[3] == {19: pytest.approx(1 / 18), 0: pytest.approx(17 / 18)}
    assert set(by) == {0, 1, 2, 3}
    assert set(r.out_point for r in grids.nearest_weights("O16", target).collect()) == {0, 1, 2, 3}
    assert grids.bilinear_weights("O16", target.limit(0)).isEmpty()


def test_nearest_looks_at_all_points(spark):
    rng = np.random.default_rng(8)
    lat, lon = np.degrees(np.arcsin(rng.uniform(-1, 1, 300))), rng.uniform(0, 360, 300)
    target = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(zip(lat, lon, strict=True))], TARGET)
    pts = grids.points(spark, "O8").orderBy("point_id").toPandas()
    unit = lambda a, b: np.stack([np.cos(np.radians(a)) * np.cos(np.radians(b)), np.cos(np.radians(a)) * np.sin(np.radians(b)), np.sin(np.radians(a))], -1)
    want = (unit(lat, lon) @ unit(pts.lat.to_numpy(), pts.lon.to_numpy()).T).argmax(1)
    assert {r.out_point: r.in_point for r in grids.nearest_weights("O8", target).collect()} == dict(enumerate(want))


def coefficients(rng, truncation, fields):
    return [(k, n, m, float(rng.normal()), float(rng.normal()) if m else 0.0) for k in range(fields) for n in range(truncation + 1) for m in range(n + 1)]


SCHEMA = "k int, n int, m int, re double, im double"


def test_legendre_functions_are_orthonormal():
    x, w = np.polynomial.legendre.leggauss(40)
    for m in (0, 1, 5, 20):
        p = spectral.legendre(x, m, 30)
        np.testing.assert_allclose((p * w) @ p.T / 2, np.eye(31 - m), atol=1e-12)
    np.testing.assert_allclose(spectral.legendre(x, 0, 2)[2], math.sqrt(5) * (3 * x * x - 1) / 2)


def test_round_trip_of_random_coefficients(spark, monkeypatch):
    monkeypatch.setattr(spectral, "FIELDS", 3)  # several blocks of fields
    rows = coefficients(np.random.default_rng(7), 21, 8)
    grid = spectral.synthesis(spark.createDataFrame(rows, SCHEMA), ["k"], "F16", 21)
    assert grid.count() == 8 * 32 * 64
    back = {(r.k, r.n, r.m): (r.re, r.im) for r in spectral.analysis(grid, ["k"], "F16", 21).collect()}
    assert len(back) == len(rows)
    assert max(abs(back[k, n, m][0] - a) + abs(back[k, n, m][1] - b) for k, n, m, a, b in rows) < 1e-9


def test_synthesis_on_short_rows_equals_the_sum(spark):
    """Rows with fewer points than waves: the sum at each point of an octahedral grid."""
    rows = coefficients(np.random.default_rng(9), 25, 1)
    got = spectral.synthesis(spark.createDataFrame(rows, SCHEMA), ["k"], "O4", 25).orderBy("point_id").toPandas().value.to_numpy()
    pts = grids.points(spark, "O4").orderBy("point_id").toPandas()
    mu, lon, want = np.sin(np.radians(pts.lat.to_numpy())), np.radians(pts.lon.to_numpy()), 0.0
    for _, n, m, re, im in rows:
        want = want + spectral.legendre(mu, m, n)[n - m] * (2 if m else 1) * (re * np.cos(m * lon) - im * np.sin(m * lon))
    np.testing.assert_allclose(got, want, atol=1e-9)


def test_solid_rotation_has_exact_wind(spark):
    """Vorticity 2 U sin(lat) / a is the wind U cos(lat) along rows."""
    a, top = spectral.EARTH_M, 20.0
    rows = [("x", "vo", 1, 0, 2 * top / (a * math.sqrt(3)), 0.0), ("x", "vo", 0, 0, 5.0, 0.0), ("x", "t", 3, 1, 1.0, 1.0)]
    got = spectral.wind_on_grid(spark.createDataFrame(rows, "k string, param string, n int, m int, re double, im double"), ["k"], "O8", 5)
    lat = grids.points(spark, "O8")
    both = got.groupBy("point_id").pivot("param", ["u", "v"]).agg(F.first("value")).join(lat, "point_id").toPandas()
    np.testing.assert_allclose(both.u, top * np.cos(np.radians(both.lat)), atol=1e-9)
    assert len(both) == 544 and float(np.abs(both.v.fillna(0.0)).max()) < 1e-9


def test_wind_has_its_vorticity_and_divergence(spark):
    """Vorticity of a wind from vorticity alone: by the transform of its derivatives, through potentials in NumPy."""
    rng = np.random.default_rng(10)
    rows = [("vo" if k == 0 else "d", n, m, re, im) for k, n, m, re, im in coefficients(rng, 8, 2) if n]
    df = spark.createDataFrame(rows, "param string, n int, m int, re double, im double")
    got = spectral.wind_on_grid(df, [], "F16", 8, radius=1.0).groupBy("point_id").pivot("param", ["u", "v"]).agg(F.first("value"))
    at = got.join(grids.points(spark, "F16"), "point_id").toPandas()
    lat, lon, h = np.radians(at.lat.to_numpy()), np.radians(at.lon.to_numpy()), 1e-5

    def potential(param, lat, lon):
        out = 0.0
        for p, n, m, re, im in rows:
            if p == param:
                out = out - spectral.legendre(np.sin(lat), m, n)[n - m] / (n * (n + 1)) * (2 if m else 1) * (re * np.cos(m * lon) - im * np.sin(m * lon))
        return out

    slope = lambda p, da, do: (potential(p, lat + da, lon + do) - potential(p, lat - da, lon - do)) / (2 * h)
    np.testing.assert_allclose(at.u, -slope("vo", h, 0) + slope("d", 0, h) / np.cos(lat), atol=1e-6)
    np.testing.assert_allclose(at.v, slope("vo", 0, h) / np.cos(lat) + slope("d", h, 0), atol=1e-6)


def test_empty_fields(spark):
    none = spark.createDataFrame([], SCHEMA)
    grid = spectral.synthesis(none, ["k"], "F4", 3)
    assert grid.isEmpty() and spectral.analysis(grid, ["k"], "F4", 3).isEmpty()
