import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from nimbria.__main__ import main
from nimbria.model import Step
from nimbria.plans import jobs
from nimbria.plans import metadata as M
from nimbria.plans.schema import Schema


@pytest.fixture(scope="module")
def fields(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("fields") / "t")
    rows = [("t", n, s, p, float(10 * p + n + s)) for n in range(5) for s in (0, 6, 12, 18, 24) for p in range(3)]
    spark.createDataFrame(rows, "param string, number int, step int, point_id int, value double").write.partitionBy("param", "step").parquet(path)
    return path


def config(fields, **more):
    return {"source": {"location": fields, "requests": [{"param": "t"}]}, "windows": [{"type": "ranges", "start": 0, "end": 24, "width": 12, "interval": 6, "by": 6, "operation": "mean"}], "keys": ["param"], **more}


@pytest.mark.parametrize("product,options,rows", [("ensms", {}, 9), ("accumulate", {}, 45), ("quantiles", {"quantiles": 4}, 45), ("histogram", {"bins": [0, 10, 50]}, 18), ("probabilities", {"thresholds": [{"comparison": ">", "value": 15}, {"comparison": "<", "value": 5}]}, 18)])
def test_products(spark, fields, product, options, rows):
    assert jobs.run(spark, config(fields, product=product, **options)).count() == rows


def test_relabelled_job(spark, fields):
    out = jobs.run(spark, config(fields, product="accumulate", relabel={"key": "quantile", "values": [10, 30, 50, 70, 90]}))
    assert {(r.number, r.quantile) for r in out.collect()} == {(n, 10 + 20 * n) for n in range(5)}


def test_climatology_products(spark, fields, tmp_path):
    q = [(p, i, float(i)) for p in range(3) for i in range(101)]
    spark.createDataFrame(q, "point_id int, quantile int, value double").write.parquet(str(tmp_path / "q"))
    out = jobs.run(spark, config(fields, product="extreme", climatology={"location": str(tmp_path / "q")}, sot=[10, 90], cpf=True, control=0))
    assert out.count() == 9 and {"efi", "efi_control", "sot10", "sot90", "cpf"} <= set(out.columns)
    spark.createDataFrame([(p, 1.0, 2.0) for p in range(3)], "point_id int, mean double, std double").write.parquet(str(tmp_path / "c"))
    assert jobs.run(spark, config(fields, product="anomaly", climatology={"location": str(tmp_path / "c")}, standardised=True)).count() == 45
    same = jobs.run(spark, config(fields, product="significance", climatology={"location": fields}))
    assert all(r.significance > 99.9 for r in same.collect())


def test_recovery_and_target(spark, fields, tmp_path):
    """A job that is stopped goes on with the windows left, and no run doubles rows."""
    out, rest = str(tmp_path / "out"), {"recover": str(tmp_path / "done"), "checkpoint_every": 1}
    for kind in ("table", "fileset"):
        job = config(fields, product="ensms", target=f"{kind}:{out}-{kind}", **rest)
        stop, made = [], jobs.PRODUCTS["ensms"]

        def stopping(spark, config, found, by, stop=stop, made=made):
            stop.append(1)
            if len(stop) == 3:
                raise RuntimeError("the machine is gone")
            return made(spark, config, found, by)

        jobs.PRODUCTS["ensms"] = stopping
        try:
            with pytest.raises(RuntimeError):
                jobs.run(spark, job)
            assert spark.read.parquet(f"{out}-{kind}").select("window_id").distinct().count() == 2
            jobs.run(spark, job)
            assert len(stop) == 5  # the third window and the result itself
        finally:
            jobs.PRODUCTS["ensms"] = made
        whole = jobs.run(spark, config(fields, product="ensms"))
        assert spark.read.parquet(f"{out}-{kind}").count() == whole.count() == 9
        jobs.run(spark, job)  # after success it starts anew
        assert spark.read.parquet(f"{out}-{kind}").count() == 9
    with pytest.raises(ValueError):
        jobs.run(spark, config(fields, product="nothing"))
    with pytest.raises(EOFError):
        jobs.run(spark, config(fields, product="ensms", total_fields=6))


def test_command_line(fields, tmp_path, capsys):
    (tmp_path / "job.json").write_text(json.dumps(config(fields, product="ensms")))
    main([str(tmp_path / "job.json"), "--list", "--set", "source.requests=[{\"param\": \"u\"}]"])
    got = json.loads(capsys.readouterr().out)
    windows = ["0-12", "6-18", "12-24"]
    assert got == {"inputs": [{"param": "u", "step": [0, 6, 12, 18, 24]}], "windows": windows, "outputs": [{"product": "ensms", "window_id": w, "param": "u"} for w in windows]}


def test_metadata():
    low = M.threshold({"edition": 2}, {"param": 131, "value": 0.25, "comparison": "<=", "scale": 1})
    assert low["probabilityType"] == 4 and low["scaledValueOfUpperLimit"] == 2 and low["scaleFactorOfLowerLimit"] == "MISSING"
    assert M.threshold({"edition": 1}, {"param": 131, "value": 5, "comparison": ">"})["lowerThreshold"] == 5
    with pytest.raises(ValueError):
        M.threshold({"edition": 2}, {"param": 131, "value": 5, "comparison": "=="})
    assert M.quantile({"edition": 1}, 3, 4)["perturbationNumber"] == 3 and M.quantile({"edition": 2}, 3, 4)["productDefinitionTemplateNumber"] == 86
    m = M.monthly({"edition": 1}, dt.date(2023, 1, 1), Step(744, 1416), 6)
    assert (m["forecastMonth"], m["verifyingMonth"], m["step"]) == (2, "202302", 1416)
    assert M.index({"edition": 1}, "sot", 90)["efiOrder"] == 99 and M.index({"edition": 2}, "efi", control=True)["typeOfProcessedData"] == 3
    with pytest.raises(ValueError):
        M.index({}, "sot", 50)
    assert M.against_climate({"edition": 2}, {"edition": 2, "sampleSizeOfReferencePeriod": 9, "other": 1}) == {"edition": 2, "productDefinitionTemplateNumber": 105, "sampleSizeOfReferencePeriod": 9}
    with pytest.raises(ValueError):
        M.against_climate({"edition": 1}, {"edition": 2})
    assert M.inherited({"a": 1, "x": {"b": 2, "y": {"a": 3}}}, "x", "y") == {"a": 3, "b": 2}


def test_parameter_tables(spark):
    names = M.parameter_names(spark.createDataFrame([(131, ["u", "U component"]), (132, ["v"]), (138, ["vo"]), (155, ["d"]), (999, ["U"])], "number int, names array<string>"))
    asked = spark.createDataFrame([(x,) for x in ("U", " v", "131.128", "5.228", "167", "no such")], "param string")
    got = {r.param: r.number for r in M.numbered(asked, "param", names).collect()}
    assert got == {"U": 131, " v": 132, "131.128": 131, "5.228": 228005, "167": 167, "no such": None}
    pairs = M.wind_pairs(spark.createDataFrame([("u", "v", "vo", "d")], "u string, v string, vorticity string, divergence string"), names).first()
    assert (pairs.u_number, pairs.v_number, pairs.vorticity_number, pairs.divergence_number) == (131, 132, 138, 155)


def test_product_headers():
    assert M.ensemble({"type": "em"}, {"stepRange": "0-24", "type": "pf"}) == {"stepRange": "0-24", "type": "em"}
    assert M.wind({"edition": 1, "timeRangeIndicator": 7}, 300) == {"bitsPerValue": 24, "step": 300, "edition": 1, "timeRangeIndicator": 10}
    assert [M.wind({}, s)["timeRangeIndicator"] for s in (0, 24, 255, 256)] == [1, 0, 0, 10]
    mean = M.calibrated({"edition": 2}, "grid-mean", process=153)
    assert (mean["type"], mean["productDefinitionTemplateNumber"], mean["inputProcessIdentifier"]) == ("gbf", 73, 153)
    assert M.calibrated({"edition": 2}, "weather-type", 153)["packingType"] == "grid_ieee"
    point = M.calibrated({"edition": 2}, "point-quantile", 153, 7, 99)
    assert (point["productDefinitionTemplateNumber"], point["quantileValue"], point["totalNumberOfQuantiles"]) == (90, 7, 99)
    assert M.calibrated({"edition": 1}, "point-quantile", 153, 7, 99) == {"edition": 1, "totalNumber": 99, "perturbationNumber": 7}
    with pytest.raises(ValueError):
        M.calibrated({"edition": 3}, "grid-mean")


def test_relabelled_outputs(spark):
    df = spark.createDataFrame([(w, n, 1.0) for w in ("a", "b") for n in (3, 7, 9)], "window_id string, number int, value double")
    assert sorted((r.window_id, r.number, r.level) for r in M.relabelled(df, "level").collect()) == [(w, n, i) for w in "ab" for i, n in enumerate((3, 7, 9))]
    assert sorted({(r.number, r.level) for r in M.relabelled(df, "level", ["x", "y"]).collect()}, key=str) == [(3, "x"), (7, "y"), (9, None)]


def test_table_products(spark, fields, tmp_path):
    """Every product that reads a whole table, as a configured job."""
    put = lambda name, rows, schema: (spark.createDataFrame(rows, schema).write.mode("overwrite").parquet(str(tmp_path / name)), {"location": str(tmp_path / name)})[1]
    job = lambda product, source, **more: jobs.run(spark, {"product": product, "source": source, **more})
    wind = put("wind", [(p, n, s, 0, 3.0 if p == "u" else 4.0) for p in "uv" for n in range(3) for s in (0, 6)], "param string, number int, step int, point_id int, value double")
    out = jobs.run(spark, {"product": "wind", "source": wind, "keys": ["param"], "windows": [{"coords": [6], "operation": "aggregation"}]})
    assert [(r.mean, r["std"]) for r in out.collect()] == [(5.0, 0.0)]
    clim = put("clim", [(p, 1.0, 2.0) for p in range(3)], "point_id int, mean double, std double")
    out = jobs.run(spark, config(fields, product="anomaly-probabilities", climatology=clim, thresholds=[{"comparison": ">", "value": 0}]))
    assert out.count() == 9 and all(0 <= r.probability <= 100 for r in out.collect())
    cells = put("cells", [(0, 300.0, 290.0)], "cell int, t double, td double")
    assert job("thermal-indices", cells, indices=["relative_humidity", "humidex"], keys=["cell"]).columns == ["cell", "relative_humidity", "humidex"]
    rain = put("rain", [(0, 1, 5.0, 10.0), (0, 2, 0.0, 10.0)], "point_id int, number int, rain double, p1 double")
    types = put("types", [(1, 0.0, 20.0), (2, 20.0, 40.0)], "wt int, inf_1 double, sup_1 double")
    ratios = put("ratios", [(1, [-0.5, 0.0, 0.5]), (2, [0.0])], "wt int, fer array<double>")
    got = job("point-rainfall", rain, types=types, ratios=ratios, predictors=["p1"], keys=["point_id"], levels=[0.0, 0.5, 1.0]).orderBy("level").collect()
    assert [r.value for r in got] == [0.0, 3.75, 7.5] and got[0].grid_scale == 2.5  # of 2.5, 5, 7.5 and the dry 0
    tracks = put("tracks", [(n, 1, s, 10.0 * n, 5.0 * s, 30.0) for n in range(4) for s in range(3)], "number int, id int, step int, lat double, lon double, wind double")
    grid = put("grid", [(0, 0.0, 0.0), (1, 0.0, 7.5), (2, -80.0, 0.0)], "point_id int, lat double, lon double")
    assert {r.point_id: r.probability for r in job("strike-probability", tracks, grid=grid, radius_km=100.0, numbers=[0, 1]).collect()} == {0: 50.0, 1: 50.0}
    coefficients = put("coefficients", [(1, 0, 2.0, 0.0), (1, 1, 1.0, 1.0)], "n int, m int, re double, im double")
    assert [r.energy for r in job("spectrum", coefficients, log=False).collect()] == [4.0]
    moving = put("moving", [(1, 1, 0, 0.0, 0.0, 1000.0), (1, 1, 6, 0.0, 1.0, 994.0)], "number int, id int, step int, lat double, lon double, pres double")
    assert [r.dpdt for r in job("track-motion", moving).orderBy("step").collect()] == [None, -1.0]
    seen, told = put("seen", [(0, 1, 10.0, 10.0), (0, 2, 50.0, 359.9)], "step int, id long, lat double, lon double"), put("told", [(0, 7, 10.5, 10.0), (0, 8, 50.0, 0.1)], "step int, id long, lat double, lon double")
    assert sorted((r.obs, r.pred) for r in job("storm-matching", seen, predicted=told, threshold_km=200.0).collect()) == [(1, 7), (2, 8)]  # one across the date line
    assert [(r.tp, r.fn, r.fp) for r in job("storm-matching", seen, predicted=told, threshold_km=200.0, confusion=True).collect()] == [(2, 0, 0)]
    values = put("values", [(0, 5, 5, 990.0, 20.0), (0, 6, 5, 980.0, 10.0)], "step int, i int, j int, pres double, wind double")
    spots = put("spots", [(1, 0, 5.0, 5.0)], "id int, step int, i double, j double")
    assert [(r.pres_min, r.wind_max) for r in job("storm-annotation", spots, cells=values, radius=2.0).collect()] == [(980.0, 20.0)]
    weighed = put("weighed", [(0, 1, 1, 3.0), (0, 1, 2, 3.0), (0, 9, 9, 1.0)], "step int, i int, j int, weight double")
    assert [(r.cluster, r.j, r.weight) for r in job("storm-clusters", weighed, eps=1.5, min_weight=5.0).collect()] == [(0, 1.5, 6.0)]
    agencies = put("agencies", [(1, -999.0, 990.0, 20.0, 980.0)], "id int, a_wind double, a_pres double, b_wind double, b_pres double")
    assert [(r.wind, r.pres) for r in job("best-track", agencies, agencies=["a", "b"]).collect()] == [(20.0, 990.0)]
    members = put("members", [(n, s, p, float((n % 2) * 10 + p + n * 0.01)) for n in range(8) for s in range(2) for p in range(3)], "number int, step int, point_id int, value double")
    weights = put("weights", [(p, 1.0) for p in range(3)], "point_id int, weight double")
    labels = job("clusters", members, weights=weights, components=3, clusters=[2])
    assert len({frozenset(r.number for r in labels.collect() if r.cluster == c) for c in (0, 1)} & {frozenset({0, 2, 4, 6}), frozenset({1, 3, 5, 7})}) == 2
    chosen = job("clusters", members, weights=weights, components=3, clusters=[2, 3], samples=4, significance=101.0)
    assert {r.cluster for r in chosen.collect()} == {0}  # nothing is significant enough
    labels.write.parquet(str(tmp_path / "labels"))
    assert job("cluster-centroids", members, labels={"location": str(tmp_path / "labels")}).count() == 12
    pcs, regimes = put("pcs", [(1, 0, 1.0), (1, 1, 0.0)], "day int, component int, pc double"), put("regimes", [(5, 0, 1.0), (5, 1, 0.1), (6, 0, 9.0), (6, 1, 0.0)], "regime int, component int, pc double")
    assert [r.regime for r in job("regime-attribution", pcs, regimes=regimes, keys=["day"]).collect()] == [5]
    assert jobs.listing({"product": "spectrum", "source": {"location": "x"}})["outputs"] == [{"product": "spectrum"}]


def test_planned_job_runs(spark, tmp_path):
    """From requested outputs to inputs, to a configuration, to results."""
    rows = [("cf" if n == 0 else "pf", n, s, p, float(10 * p + n + s)) for n in range(5) for s in range(0, 25, 6) for p in range(2)]
    spark.createDataFrame(rows, "type string, number int, step int, point_id int, value double").withColumn("param", F.lit("t")).write.parquet(str(tmp_path / "t"))
    rules = {
        "config": {"keys": ["param"], "filter:type": {"em": {"product": "ensms", "operation": "mean"}}},
        "inputs": {"filter:type": {"em": {"sources": [{"type": "cf"}, {"type": "pf"}], "steps": {"available": {"from": 0, "to": 24, "by": 6}}}}},
    }
    planned = Schema(rules).from_outputs([{"type": "em", "param": "t", "step": "0-12"}, {"type": "em", "param": "t", "step": "12-24"}])
    assert len(planned) == 1
    made = planned[0].config(str(tmp_path / "t"))
    assert jobs.listing(made)["windows"] == ["0-12", "12-24"]
    got = {(r.window_id, r.point_id): r.mean for r in jobs.run(spark, made).collect()}
    assert got == {("0-12", p): 10 * p + 2 + 9.0 for p in range(2)} | {("12-24", p): 10 * p + 2 + 21.0 for p in range(2)}
