import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from nimbria.functions import columns as C
from nimbria.operators import cluster as K
from nimbria.operators import cyclones as Y
from nimbria.operators import ensemble as E
from nimbria.operators import extremes as X
from nimbria.operators import preprocess as P
from nimbria.operators import spatial as S
from nimbria.plans import windows as W
from nimbria.sources import readers, sinks
from nimbria.streaming.windows import run_once, stream_accumulate


def cells(spark, rows):
    return spark.createDataFrame(rows, "param string, number int, value double")


def values(df, by="number"):
    return [r.value for r in df.orderBy(by).collect()]


def test_direction_norm_sum(spark):
    df = cells(spark, [("u", 0, 0.0), ("u", 1, 1.0), ("v", 0, 1.0), ("v", 1, 0.0)])
    assert values(P.wind_direction("u", "v")(df, ["number"])) == pytest.approx([180, 270])
    df = cells(spark, [("a", 0, 0.0), ("a", 1, 1.0), ("a", 2, 3.0), ("b", 0, 1.0), ("b", 1, 0.0), ("b", 2, 4.0)])
    assert values(P.norm()(df, ["number"])) == [1, 1, 5]
    assert values(P.total()(df, ["number"])) == [1, 1, 7]


def test_mask_reshape(spark):
    df = cells(spark, [("a", 0, 1.0), ("a", 1, math.nan), ("b", 0, 5.0), ("b", 1, 6.0)])
    assert values(P.mask("b", "a", "<=", 2.0, -1.0)(df, ["number"])) == [-1, 6]  # NaN compares false
    stacked = spark.createDataFrame([(r, float(r)) for r in range(6)], "number int, value double")
    got = {(r.param, r.number): r.value for r in P.reshape(["u", "v"])(stacked, ["number"]).collect()}
    assert got == {("u", 0): 0, ("v", 0): 1, ("u", 1): 2, ("v", 1): 3, ("u", 2): 4, ("v", 2): 5}
    with pytest.raises(ValueError):
        P.from_config([{"operation": "nothing"}])


def test_quantiles_nan(spark):
    df = spark.createDataFrame([(0, 1.0), (0, 3.0), (1, 1.0), (1, math.nan)], "point_id int, value double")
    got = {(r.point_id, r.quantile): r.value for r in E.quantiles(df, ["point_id"], 2).collect()}
    assert got[0, "1:2"] == 2 and math.isnan(got[1, "1:2"])
    assert E.quantile_levels([0.1, 0.35, 0.9])[1] == ["10:100", "35:100", "90:100"] and E.quantile_levels([0, 0.5, 1])[1] == ["0:2", "1:2", "2:2"]


def test_probability_nan_and_complement(spark):
    df = spark.createDataFrame([("w", 0, float(v)) for v in range(5)] + [("w", 1, math.nan), ("w", 1, 2.0)], "window_id string, point_id int, value double")
    t = spark.createDataFrame([("w", ">", 2.0), ("w", "<=", 2.0)], "window_id string, comparison string, threshold double")
    got = {(r.point_id, r.comparison): r.probability for r in E.probability(df, t, ["window_id", "point_id"]).collect()}
    assert got[0, ">"] == 40 and got[0, ">"] + got[0, "<="] == 100 and math.isnan(got[1, ">"])


def _quantiles(spark, values):
    return spark.createDataFrame([(0, i, float(v)) for i, v in enumerate(values)], "point_id int, quantile int, value double")


@pytest.mark.parametrize("members,expected", [([1000.0] * 10, 1.0), ([-1000.0] * 10, -1.0), ([float(i) for i in range(101)], 0.0)])
def test_efi_limits(spark, members, expected):
    m = spark.createDataFrame([(0, v) for v in members], "point_id int, value double")
    assert X.efi(m, _quantiles(spark, range(101)), ["point_id"]).first().efi == pytest.approx(expected, abs=0.02)


def test_efi_eps_and_cpf(spark):
    m = spark.createDataFrame([(0, 90.0)] * 5, "point_id int, value double")
    assert 0 < X.efi(m, _quantiles(spark, range(101)), ["point_id"], eps=10.0).first().efi <= 1.001
    assert 0.85 < X.cpf(m, _quantiles(spark, range(101)), ["point_id"]).first().cpf <= 1.0
    assert X.sot(m, _quantiles(spark, range(101)), ["point_id"], 90).first().sot == pytest.approx(-1.0)


def test_significance(spark):
    a = spark.createDataFrame([(0, float(v)) for v in range(20)], "point_id int, value double")
    b = spark.createDataFrame([(0, float(v + 100)) for v in range(20)], "point_id int, value double")
    assert X.significance(a, b, ["point_id"]).first().significance < 1e-3
    assert X.significance(a, a, ["point_id"]).first().significance == pytest.approx(100, abs=1e-6)
    same = spark.createDataFrame([(0, 1.0)] * 5, "point_id int, value double")
    assert X.significance(same, same, ["point_id"]).first().significance == 0


def test_normal_cdf(spark):
    z = [-8.0, -3.5, -3.0, -1.0, 0.0, 0.5, 2.99, 3.01, 6.0]
    got = [r.p for r in spark.createDataFrame([(x,) for x in z], "z double").select(C.normal_cdf(F.col("z")).alias("p")).collect()]
    assert got == pytest.approx([0.5 * math.erfc(-x / math.sqrt(2)) for x in z], abs=1e-10)


def test_clustering(spark):
    rng = np.random.default_rng(0)
    x = np.concatenate([rng.normal(0, 0.1, (20, 2)), rng.normal(5, 0.1, (10, 2))])
    label, _, ratio = K.lloyd(x, 2, 1)
    assert sorted(np.bincount(K.by_size(label, 2)).tolist(), reverse=True) == [20, 10] and (K.by_size(label, 2)[:20] == 0).all() and ratio > 10
    assert K.significance(spark, x, [2], 4, passes=3)[2] == 100.0


def test_principal_components(spark):
    rng = np.random.default_rng(1)
    v = rng.normal(size=(4, 3, 5))  # step, number, point
    df = spark.createDataFrame([(s, n, p, float(v[s, n, p])) for s in range(4) for n in range(3) for p in range(5)], "step int, number int, point_id int, value double")
    w = spark.createDataFrame([(p, 0.2) for p in range(5)], "point_id int, weight double")
    made = K.components(K.anomalies(df), w, 2)
    a = v - v.mean(axis=1, keepdims=True)
    c = sum(0.2 * a[s] @ a[s].T for s in range(4)) / 4
    np.testing.assert_allclose(made.values, np.sort(np.linalg.eigvalsh(c))[::-1][:2])
    assert K.eofs(K.anomalies(df), made).count() == 2 * 4 * 5


def test_matching_greedy(spark):
    o = spark.createDataFrame([(0, 1, 10.0, 10.0), (0, 2, 10.1, 10.0), (0, 3, 50.0, 50.0)], "step int, id long, lat double, lon double")
    p = spark.createDataFrame([(0, 7, 10.05, 10.0), (0, 8, 10.9, 10.0)], "step int, id long, lat double, lon double")
    got = {(r.outcome, r.obs, r.pred) for r in Y.match(o, p, 200.0).collect()}
    assert got == {("TP", 1, 7), ("FN", 2, None), ("FN", 3, None), ("FP", None, 8)}  # 2 does not try its second nearest


def test_density_clusters(spark):
    rows = [(0, 0, 0, 1.0), (0, 0, 1, 1.0), (0, 9, 9, 1.0), (0, 9, 8, 3.0), (0, 20, 20, 0.1)]
    got = Y.density_clusters(spark.createDataFrame(rows, "step int, i int, j int, weight double"), ["step"], 1.5, 1.5).orderBy("cluster").collect()
    assert [(r.i, r.j, r.weight) for r in got] == [(0.0, 0.5, 2.0), (9.0, 8.25, 4.0)]


def test_strike_counts_members_once(spark):
    t = spark.createDataFrame([(1, 1, 0, 0.0, 359.0, 20.0), (1, 1, 6, 0.0, 1.0, 20.0), (2, 1, 0, 80.0, 0.0, 20.0)], "number int, id int, step int, lat double, lon double, wind double")
    g = spark.createDataFrame([(0, 0.0, 0.0), (1, 0.0, 359.5), (2, 81.0, 180.0)], "point_id int, lat double, lon double")
    got = {r.point_id: r.probability for r in S.strike_probability(t, g, 300.0, 2, sub_steps=1).collect()}
    assert got == {0: 50.0, 1: 50.0}


def test_sinks_and_recovery(spark, tmp_path):
    df = spark.createDataFrame([("t", 0, 1.0), ("t", 6, 2.0)], "param string, step int, value double")
    path = str(tmp_path / "table")
    sinks.table_sink(path, ["param", "step"])(df)
    sinks.table_sink(path, ["param", "step"])(df.where("step = 6").withColumn("value", F.lit(9.0)))
    read = readers.open_source(spark, f"table:{path}", {"param": "t", "step": [0, 6]})
    assert sorted((r.step, r.value) for r in read.collect()) == [(0, 1.0), (6, 9.0)]
    assert readers.open_union(spark, path, [{"step": 0}, {"step": 6}]).count() == 2
    with pytest.raises(ValueError):
        readers.open_single(spark, path, [{}, {}])
    with pytest.raises(ValueError):
        readers.not_empty(read.where("step = 99"))
    assert readers.open_source(spark, f"table:{path}", {"paran": "t"}).count() == 0  # no row has that key
    r = sinks.Recovery(spark, str(tmp_path / "done"), {"a": 1})
    w = W.frame(spark, W.default([{"to": 1}, {"to": 2}]))
    assert r.remaining(w).select("window_id").distinct().count() == 2
    r.add(["0-1"])
    assert {x.window_id for x in r.remaining(w).collect()} == {"0-2"}
    assert sinks.Recovery(spark, str(tmp_path / "done"), {"a": 2}).done().count() == 0
    other = sinks.Recovery(spark, str(tmp_path / "done"), {"a": 2})
    other.add(["0-2"])
    r.clean()
    assert r.done().count() == 0 and other.done().count() == 1
    r.add(["0-2"])
    assert r.done().count() == 1


def test_metadata_and_packing(spark):
    df = spark.createDataFrame([({"a": "1", "b": "2"},)], "meta map<string,string>")
    assert df.select(sinks.set_keys("meta", {"a": "MISSING", "c": "3"}).alias("m")).first().m == {"b": "2", "c": "3"}
    packed = spark.createDataFrame([("t", [1.0, 2.0])], "param string, values array<double>")
    assert readers.pack(readers.unpack(packed), ["param"]).first()["values"] == [1.0, 2.0]


def test_track_readers(spark, tmp_path):
    (tmp_path / "a.txt").write_text("Category 1\n 3 10.5N 20.0W 20240101 0 15.0 990\n 3 11.0S 21.0E 20240101 6 16.0 985\nCategory 2\n 4 5.0N 1.0E 20240101 0 20.0 970\n")
    got = readers.read_tracks_text(spark, str(tmp_path / "a.txt")).orderBy("id", "step").collect()
    assert [(r.number, r.id, r.step, r.lat, r.lon, r.wind) for r in got] == [(3, 1, 0, 10.5, -20.0, 15.0), (3, 1, 6, -11.0, 21.0, 16.0), (4, 2, 0, 5.0, 1.0, 20.0)]
    (tmp_path / "b.txt").write_text("# number step lat lon wind\n1 0 10 20 30\n")
    assert readers.read_tracks_points(spark, str(tmp_path / "b.txt")).first().lon == 20.0
    (tmp_path / "c.csv").write_text("datetime,name,lat_p,lon_p,wind\n2024-01-01 00:00:00,m 07,1,2,3\n2024-01-01 06:00:00,m 07,2,3,4\n")
    assert [(r.number, r.step) for r in readers.read_tracks_csv(spark, str(tmp_path / "c.csv")).orderBy("step").collect()] == [(7, 0), (7, 6)]
    raw = b"".join(n.to_bytes(4, "big") + x + n.to_bytes(4, "big") for x in (np.array([1, 2], ">f4").tobytes(),) for n in (len(x),))
    (tmp_path / "d.bin").write_bytes(raw)
    assert readers.read_records(spark, str(tmp_path / "d.bin")).first()["values"] == [1.0, 2.0]


def test_stream_equals_batch(spark, tmp_path):
    from nimbria.operators.accumulate import accumulate

    rows = [(n, s, float(s * n), f"2024-01-01 0{s}:00:00") for n in range(3) for s in range(8)]
    df = spark.createDataFrame(rows, "number int, step int, value double, t string").withColumn("ts", F.to_timestamp("t")).drop("t")
    df.coalesce(1).write.parquet(str(tmp_path / "in"))
    windows = W.step_ranges(0, 7, 3, 2, op="mean") + W.default([{"to": 7}], "maximum", sequential=True)
    key = lambda rows: sorted((r.window_id, r.number, r.value) for r in rows)
    want = key(accumulate(df.drop("ts"), windows, ["number"]).collect())
    stream = lambda: stream_accumulate(spark.readStream.schema(df.schema).parquet(str(tmp_path / "in")), windows, ["number"], "ts", late="2 hours")
    place = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    assert key(run_once(stream(), *place).collect()) == want
    df.withColumn("value", F.lit(99.0)).write.mode("append").parquet(str(tmp_path / "in"))  # the same coordinates again
    assert key(run_once(stream(), *place).collect()) == want  # the query goes on from its checkpoint and drops them
    df.selectExpr("number", "step", "value", "ts + interval 3 days as ts").write.mode("append").parquet(str(tmp_path / "in"))
    run_once(stream(), *place)  # the watermark passes all windows so far
    df.selectExpr("number", "step + 100 as step", "value", "ts + interval 6 days as ts").write.mode("append").parquet(str(tmp_path / "in"))
    query = stream().writeStream.format("parquet").option("path", place[0]).option("checkpointLocation", place[1]).outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination()
    assert query.lastProgress["stateOperators"][0]["numRowsTotal"] == 0  # no state is left


def test_stream_state_can_be_read(spark, tmp_path):
    """After a stop the state holds the coordinates of unfinished windows, and finished ones without theirs."""
    from nimbria.streaming.windows import held_state

    rows = [(0, s, float(s), f"2024-01-01 0{s}:00:00") for s in (0, 1, 2, 5)] + [(1, 1, 7.0, "2024-01-01 01:00:00")]
    df = spark.createDataFrame(rows, "number int, step int, value double, t string").withColumn("ts", F.to_timestamp("t")).drop("t")
    df.write.parquet(str(tmp_path / "in"))
    windows = W.default([{"to": 2}, {"from": 4, "to": 6}], "sum")
    place = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    stream = lambda: stream_accumulate(spark.readStream.schema(df.schema).parquet(str(tmp_path / "in")), windows, ["number"], "ts")
    assert [tuple(r) for r in run_once(stream(), *place).collect()] == [("0-2", 0, 3.0)]
    folds = {(r.key.window_id, r.key.number): (r.value.n, r.value.total, r.value.done) for r in held_state(spark, place[1]).collect()}
    assert folds == {("0-2", 0): (3, 3.0, True), ("4-6", 0): (1, 5.0, False), ("0-2", 1): (1, 7.0, False)}
    held = {(r.key.window_id, r.key.number, r.user_map_key.coord, r.user_map_value.value) for r in held_state(spark, place[1], "coords").collect()}
    assert held == {("4-6", 0, 5, 5.0), ("0-2", 1, 1, 7.0)}
    more = [(0, 4, 4.0, "2024-01-01 04:00:00"), (0, 6, 6.0, "2024-01-01 06:00:00"), (0, 5, 50.0, "2024-01-01 05:00:00")]
    spark.createDataFrame(more, "number int, step int, value double, t string").withColumn("ts", F.to_timestamp("t")).drop("t").write.mode("append").parquet(str(tmp_path / "in"))
    assert sorted(tuple(r) for r in run_once(stream(), *place).collect()) == [("0-2", 0, 3.0), ("4-6", 0, 15.0)]


def test_detection_inputs(spark):
    cells = spark.createDataFrame([("a", 1, 2, 10.0), ("a", 5, 2, 99.0)], "param string, i int, j int, value double")
    factors = spark.createDataFrame([("a", 4.0, 2.0)], "param string, shift double, norm double")
    assert [tuple(r) for r in Y.crop_normalise(cells, factors, (1, 4), (0, 4)).collect()] == [("a", 0, 2, 3.0)]
    packed = spark.createDataFrame([(0, [1.0, 2.0]), (6, [3.0, 4.0])], "step int, values array<double>")
    got = {r.step: r.score for r in Y.detect(packed, lambda x: x.sum(axis=1, keepdims=True), ["step"]).collect()}
    assert got == {0: [3.0], 6: [7.0]}
    assert Y.summaries([packed, packed]).count() == 4 and Y.snapshot(packed, 6, "step").count() == 1
    assert E.same_in_group(cells, ["param"], "j").count() == 2
    with pytest.raises(ValueError):
        E.same_in_group(cells, ["param"], "i")


def test_climatology_by_season_day(spark):
    f = spark.createDataFrame([("2024-02-29", 0, 1.0), ("2024-06-01", 0, 1.0)], "d string, point_id int, value double").withColumn("date", F.to_date("d"))
    clim = spark.createDataFrame([(151, 0, 7.0)], "dos int, point_id int, value double")
    got = K.climatology_on(f, clim, K.season("10-4")).collect()
    assert [(r.d, r.clim) for r in got] == [("2024-02-29", 7.0)]


def test_shared_folder(spark):
    from nimbria.sources import shared

    assert shared.shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    shared.clean_up(spark)
    path = shared.shared_path(spark, "x")
    spark.range(3).write.parquet(path)
    assert spark.read.parquet(path).count() == 3 and shared.clean_up(spark) == 1 and shared.clean_up(spark) == 0
