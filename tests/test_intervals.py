"""Joins in time against brute force, and products gathered from steps of several parameters."""

import random

import pytest
from pyspark.sql import functions as F

from nimbria.functions import thermal
from nimbria.operators import extremes as X
from nimbria.operators import intervals as I
from nimbria.operators import pointrain as R
from nimbria.plans import jobs


@pytest.mark.parametrize("width", [0.5, 7.0, 1000.0])
def test_asof_equals_brute_force(spark, width):
    rng = random.Random(1)
    left = [(i, rng.choice(["a", "b", None]), rng.choice([None, float(rng.randrange(-50, 100))])) for i in range(300)]
    right = [(rng.choice(["a", "b", "c", None]), rng.choice([None, float(rng.randrange(-40, 80))]), rng.randrange(5)) for _ in range(60)]
    l, r = spark.createDataFrame(left, "i int, k string, t double"), spark.createDataFrame(right, "k string, t double, x int")
    for tolerance in (None, 6.0):
        got = {row.i: (row.as_of, row.x) for row in I.asof(l.withColumn("x", F.lit("old")), r, ["k"], "t", ["x"], width, tolerance).collect()}
        for i, k, t in left:
            fit = [(b, x) for a, b, x in right if None not in (k, t, a, b) and a == k and b <= t and (tolerance is None or t - b <= tolerance)]
            assert got[i] == (max(fit) if fit else (None, None))
        assert len(got) == len(left)


@pytest.mark.parametrize("width", [0.75, 5.0, 500.0])
def test_overlaps_equal_brute_force(spark, width):
    rng = random.Random(2)
    make = lambda n: [(i, rng.choice("ab"), a, a + rng.choice([-1, 0, 0, 1, 3, 12])) for i in range(n) for a in [rng.randrange(-20, 20)]]
    left, right = make(80), make(80)
    l, r = spark.createDataFrame(left, "i int, k string, start int, end int"), spark.createDataFrame(right, "j int, k string, begin int, finish int")
    got = sorted((p.i, p.j, p.overlap) for p in I.overlaps(l, r, ["k"], width).collect())
    want = []
    for i, k, a, b in left:
        for j, m, c, d in right:
            if k == m and a <= b and c <= d:
                inside = max(a, c) < min(b, d) or (a == b and (c <= a < d or c == d == a)) or (c == d and (a <= c < b or a == b == c))
                want += [(i, j, min(b, d) - max(a, c))] if inside else []
    assert got == sorted(want)


def test_spans(spark):
    df = spark.createDataFrame([("u", 0), ("u", 12), ("u", 6), ("u", 6), ("v", 24)], "param string, step int")
    assert sorted(tuple(r) for r in I.spans(df, ["param"]).collect()) == [("u", 0, 0, 0), ("u", 6, 0, 6), ("u", 12, 6, 12), ("v", 24, 24, 24)]


def fields(spark, skip=()):
    """One cell whose values are easy to add up: accumulations grow by 2 an hour, wind is its step."""
    rows = []
    for step in range(0, 49, 6):
        rows += [("tp", step, 2.0 * step), ("cp", step, 1.0 * step), ("cdir", step, 10.0 * step), ("mxcape6", step, 100.0 - step)]
        if step % 12 == 0:
            rows += [("u", step, float(step)), ("v", step, 0.0)]
    rows = [("x", 1, 7, *r) for r in rows if (r[0], r[1]) not in skip]
    return spark.createDataFrame(rows, "stream string, number int, point_id int, param string, step int, value double")


def test_predictors_of_one_cell(spark):
    got = {r.window_id: r for r in R.predictors(fields(spark), [(0, 12), (12, 36), (18, 30)], ["stream", "number", "point_id"]).collect()}
    assert (got["0-12"].rain, got["0-12"].cpr, got["0-12"].ws, got["0-12"].cape, got["0-12"].radiation) == (24.0, 0.5, 12.0, 94.0, 240.0)  # the first day's radiation
    assert (got["12-36"].ws, got["12-36"].cape, got["12-36"].radiation) == (30.0, 82.0, 240.0)
    assert got["18-30"].ws == 24 * 0.5 + 36 * 0.5 and got["18-30"].radiation == 240.0


@pytest.mark.parametrize("skip, left", [([("tp", 0), ("cp", 0), ("cdir", 0)], ["0-12", "12-36"]), ([("tp", 12)], []), ([("mxcape6", 48)], ["0-12", "12-36"]), ([("v", 36)], ["0-12", "12-36"]), ([("v", 36), ("v", 48)], ["0-12"])])
def test_windows_that_lack_a_step_are_left_out(spark, skip, left):
    """Accumulations begin with 0 at step 0; a mean needs steps that cover its window."""
    made = R.predictors(fields(spark, skip), [(0, 12), (12, 36)], ["number", "point_id"])
    assert sorted(r.window_id for r in made.collect()) == left


def test_cells_that_lack_a_field_are_left_out(spark):
    more = fields(spark).union(spark.createDataFrame([("x", 2, 7, "tp", 12, 1.0)], "stream string, number int, point_id int, param string, step int, value double"))
    assert [r.number for r in R.predictors(more, [(0, 12)], ["number", "point_id"]).collect()] == [1]


def types(spark):
    far = 1e9
    return spark.createDataFrame([(5, 0.0, far, 20.0, 30.0, *(-far, far) * 3)], "wt int, " + ", ".join(f"inf_{i} double, sup_{i} double" for i in range(1, 6))), spark.createDataFrame([(5, [-0.5, 0.0, 1.0])], "wt int, fer array<double>")


def test_rain_from_fields(spark):
    keys = ["number", "point_id"]
    got = {r.window_id: r for r in R.from_fields(fields(spark), [(0, 12), (12, 36)], keys, *types(spark)).collect()}
    assert (got["0-12"].wt, got["0-12"].points) == (5.0, [12.0, 24.0, 48.0])
    assert (got["12-36"].wt, got["12-36"].points, got["12-36"].grid_scale) == (0.0, [0.0, 0.0, 0.0], 0.0)  # 48 is in no type
    dry = fields(spark).withColumn("value", F.when(F.col("param") == "tp", 0.0).otherwise(F.col("value")))
    assert [(r.wt, r.points) for r in R.from_fields(dry, [(0, 12)], keys, *types(spark)).collect()] == [(99999.0, [0.0] * 3)]
    hole = fields(spark).withColumn("value", F.when(F.col("param") == "u", float("nan")).otherwise(F.col("value")))
    row = R.from_fields(hole, [(0, 12)], keys, *types(spark)).first()
    assert row.wt != row.wt and all(p != p for p in row.points)


def test_field_jobs(spark, tmp_path):
    fields(spark).write.parquet(str(tmp_path / "f"))
    for name, df in zip(("types", "ratios"), types(spark), strict=True):
        df.write.parquet(str(tmp_path / name))
    job = {"product": "point-rainfall-fields", "source": {"location": str(tmp_path / "f")}, "keys": ["stream"], "windows": [{"type": "ranges", "start": 0, "end": 36, "width": 12, "interval": 12, "by": 6}], "types": {"location": str(tmp_path / "types")}, "ratios": {"location": str(tmp_path / "ratios")}, "levels": [0.5]}
    assert {r.window_id: r.value for r in jobs.run(spark, job).collect()} == {"0-12": 24.0, "12-24": 24.0, "24-36": 24.0}
    assert jobs.run(spark, job | {"output": "cells"}).first().grid_scale == 28.0
    assert jobs.run(spark, job | {"output": "predictors"}).count() == 3


def test_thermal_inputs(spark, tmp_path):
    rows = [(1, 0, p, s, v) for s in (0, 1, 3) for p, v in [*((x, 280.0 + s) for x in thermal.INSTANT), *((x, 3600.0 * s * s) for x in thermal.ACCUMULATED)]]
    df = spark.createDataFrame(rows, "number int, point_id int, param string, step int, value double")
    grid = spark.createDataFrame([(0, 10.0, 20.0)], "point_id int, lat double, lon double")
    got = {r.window_id: r for r in thermal.inputs(df, [(0, 1), (1, 3), (0, 2)], ["number", "point_id"], grid, day=80, hour=10).collect()}
    assert set(got) == {"0-1", "1-3"}
    assert (got["0-1"].t, got["0-1"].ssrd) == (281.0, 1.0) and (got["1-3"].td, got["1-3"].fdir) == (283.0, 4.0)
    want = spark.range(1).select(thermal.cos_zenith_integrated(F.lit(10.0), F.lit(20.0), F.lit(80), F.lit(11), F.lit(13)).alias("z")).first().z
    assert got["1-3"].cossza == pytest.approx(want)
    df.write.parquet(str(tmp_path / "f"))
    grid.write.parquet(str(tmp_path / "g"))
    job = {"product": "thermal-fields", "source": {"location": str(tmp_path / "f")}, "grid": {"location": str(tmp_path / "g")}, "day": 80, "windows": [{"type": "ranges", "start": 0, "end": 1, "width": 1, "interval": 1}], "indices": ["mean_radiant_temperature", "apparent_temperature"]}
    assert jobs.run(spark, job).count() == 1


def test_indices_meet_once(spark):
    """All indices from one meeting of members and climatology equal those made one by one."""
    rng = random.Random(3)
    m = spark.createDataFrame([(p, n, float(rng.gauss(p, 3))) for p in range(8) for n in range(11)] + [(8, n, float("nan") if n == 3 else 1.0) for n in range(11)], "point_id int, number int, value double")
    q = spark.createDataFrame([(p, i, float(sorted(rng.gauss(2, 3) for _ in range(101))[i]) if p != 7 else 2.0) for p in range(9) for i in range(101)], "point_id int, quantile int, value double").groupBy("point_id").agg(F.sort_array(F.collect_list("value")).alias("v"))
    q = q.select("point_id", F.posexplode("v").alias("quantile", "value"))
    got = X.indices(m, q, ["point_id"], control=4, tails=(10, 90), crossing=True)
    want = X.efi(m, q, ["point_id"]).join(X.efi(m.where("number = 4"), q, ["point_id"]).withColumnRenamed("efi", "efi_control"), "point_id").join(X.cpf(m, q, ["point_id"]), "point_id")
    for level in (10, 90):
        want = want.join(X.sot(m, q, ["point_id"], level).withColumnRenamed("sot", f"sot{level}"), "point_id")
    plain = lambda df: [[str(None if v != v else round(v, 9)) for v in r] for r in df.select(*sorted(got.columns)).orderBy("point_id").collect()]
    assert plain(got) == plain(want)
    text = got._jdf.queryExecution().executedPlan().toString()
    assert text.count("collect_list") <= 12
