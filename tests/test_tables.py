"""Request algebra over tables, the write-through cache, and what a job returns."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from nimbria.functions import geo
from nimbria.plans import jobs
from nimbria.plans import requests as Q
from nimbria.plans import schema as N
from nimbria.plans import tables as B
from nimbria.plans import windows as W
from nimbria.sources.cache import RequestCache
from nimbria.sources.sinks import Recovery


def test_expand_and_squeeze_are_inverse(spark):
    cubes = spark.createDataFrame([("a", [1, 2], ["x", "y", "z"]), ("b", [3], ["x"]), ("c", [], ["x"])], "k string, n array<int>, s array<string>")
    rows = B.expand(cubes, ["n", "s"])
    assert rows.count() == 7
    back = {r.k: (r.n, r.s) for r in B.squeeze(rows.union(rows), ["n", "s"]).collect()}
    assert back == {"a": ([1, 2], ["x", "y", "z"]), "b": ([3], ["x"])}
    assert [r.v for r in cubes.select(B.volume(cubes, ["n", "s"]).alias("v")).collect()] == [6, 1, 0]
    nulls = spark.createDataFrame([(None, 1)], "n array<int>, x int")
    assert nulls.select(B.volume(nulls, ["n"]).alias("v")).first().v == 1


def test_cover_holds_exactly_the_requests(spark):
    rng = random.Random(1)
    cells = {(rng.choice("ab"), rng.randrange(5), rng.randrange(5)) for _ in range(30)}
    df = spark.createDataFrame(sorted(cells), "k string, n int, s int")
    cubes = B.cover(df, ["n", "s"])
    rows = [tuple(r) for r in B.expand(cubes, ["n", "s"]).collect()]
    assert sorted(rows) == sorted(cells) and cubes.count() < len(cells)
    whole = B.expand(spark.createDataFrame([("a", [1, 2, 3], [4, 5])], "k string, n array<int>, s array<int>"), ["n", "s"])
    assert B.cover(whole, ["n", "s"]).count() == 1


def test_missing_is_the_difference(spark):
    asked = spark.createDataFrame([([1, 2, 3], [10, 20])], "n array<int>, s array<int>")
    held = spark.createDataFrame([([1, 2], [10]), ([3, 4], [10, 20])], "n array<int>, s array<int>")
    assert [(r.n, r.s) for r in B.missing(asked, held, ["n", "s"]).collect()] == [([1, 2], [20])]
    assert B.missing(asked, asked, ["n", "s"]).isEmpty()
    inside = spark.createDataFrame([("x", [2]), ("y", [2]), ("x", [5])], "k string, n array<int>")
    big = spark.createDataFrame([("x", [1, 2, 3]), ("x", [2])], "k string, n array<int>")
    assert [(r.k, r.n) for r in B.contained(inside, big, ["n"], ["k"]).collect()] == [("x", [2])]


@pytest.mark.parametrize("text", ["1/2/3", "0/to/12/by/6", "4/to/7", "3-5", "1,2,8", "7", "9/0/to/2", "1-3/8"])
def test_numbers_of_text(spark, text):
    got = spark.createDataFrame([(text,)], "t string").select(B.numbers_of(F.col("t")).alias("n")).first().n
    assert got == Q.parse_values(text)


def test_request_text(spark):
    rows = spark.createDataFrame([(1, [1, 2], dt.date(2024, 2, 3), None)], "n int, s array<int>, d date, x string")
    assert rows.select(B.request_text(rows, "list", ["n", "s", "d", "x"]).alias("t")).first().t == "list,\n  n=1,\n  s=1/2,\n  d=20240203"
    assert rows.select(B.range_text(F.lit(0), F.lit(6), F.lit(1)).alias("t")).first().t == "0/to/6"


@pytest.mark.parametrize("day, start, end", [(dt.date(2024, 1, 1), 0, 24 * 200), (dt.date(2023, 11, 15), 30, 24 * 130), (dt.date(2024, 2, 29), 0, 24 * 40), (dt.date(2024, 3, 1), 24, 24 * 31)])
def test_month_ranges(spark, day, start, end):
    rows = B.month_ranges(spark.createDataFrame([(day,)], "d date"), "d", start, end).collect()
    got = sorted((r["first"], r["last"], r["month"]) for r in rows)
    assert got == [(m.start, m.end, W.forecast_month(day, m)) for m in W.month_ranges(day, start, end)]


def test_ranges_and_windows(spark):
    steps = [0, 6, 12, 15, 18, 24, 36]
    got = sorted((r["first"], r["last"], r.inputs) for r in B.output_ranges(spark.createDataFrame([(s,) for s in steps], "step int"), 12, 6).collect())
    assert got == [(s.start, s.end, len(N.input_steps(s, steps))) for s in N.output_steps(steps, "range", 12, 6)]
    hours = spark.range(24).select(F.col("id").cast("int").alias("h"))
    windows = [W.Step(a, a + 12) for a in (0, 6, 12, 18)]
    assert all(r.w == N.climatology_step(W.Step(r.h, r.h + 12), windows, 6).start for r in hours.select("h", B.nearest_window(F.col("h"), [0, 6, 12, 18], 6).alias("w")).collect())
    calendar = spark.createDataFrame([(dt.date(2024, 1, 4),), (dt.date(2024, 1, 1),)], "day date")
    dates = spark.createDataFrame([(dt.date(2023, 12, 31),), (dt.date(2024, 1, 3),), (dt.date(2024, 1, 4),)], "date date")
    got = {r.date: r.calendar_day for r in B.as_of_calendar(dates, calendar, "date", "day").collect()}
    assert list(got.values()).count(None) == 1 and got[dt.date(2024, 1, 3)] == dt.date(2024, 1, 1) and got[dt.date(2024, 1, 4)] == dt.date(2024, 1, 4)


def test_numbers(spark):
    t = spark.createDataFrame([(x, o) for x in (1, 63, 255, 1279) for o in (1, 2, 3)], "t int, o int")
    for r in t.select("t", "o", B.truncation_to_gaussian(F.col("t"), F.col("o")).alias("g"), B.gaussian_to_truncation(F.col("t"), F.col("o")).alias("b")).collect():
        assert (r.g, r.b) == (geo.truncation_to_gaussian(r.t, r.o), geo.gaussian_to_truncation(r.t, r.o))
    shares = spark.createDataFrame([(0.0,), (0.25,), (1.0,)], "s double")
    for r in shares.select("s", B.overlap_spacing(F.col("s"), 5.0).alias("d")).collect():
        assert r.d == pytest.approx(geo.overlap_spacing(5.0, r.s), abs=1e-6)


TREE = {"filter:type": {"em/es": {"p": "a", "filter:param": {"t/u": {"n": 6}, "*": {"n": 12}}}, "pf": {"p": "b", "m": 50}, "*": {"p": "none"}}, "c": "od", "n": 1}


def test_settings_follow_rules(spark):
    requests = [(t, p) for t in ("em", "es", "pf", "fc") for p in ("t", "u", "v")]
    df = spark.createDataFrame(requests, "type string, param string")
    keys = {"type": "type", "param": "param"}
    for r in df.select("*", *[B.settings(TREE, keys, n, k).alias(n) for n, k in (("p", "string"), ("n", "int"), ("m", "int"), ("c", "string"))]).collect():
        want = N.traverse(TREE, {"type": r.type, "param": r.param})
        assert (r.p, r.n, r.m, r.c) == (want.get("p"), want.get("n"), want.get("m"), want.get("c"))
    leaves = B.rule_leaves(spark, TREE, ["type", "param"], {"p": "string", "n": "int"}).collect()
    assert sorted((r.type or "", r.param or "", r.p, r.n) for r in leaves) == sorted((k.get("type", ""), k.get("param", ""), s["p"], s["n"]) for k, s in N.enumerate_outputs(TREE, {}))


def test_cache_reads_the_source_once(spark, tmp_path):
    rows = [(s, n, float(10 * s + n)) for s in range(6) for n in range(4)]
    spark.createDataFrame(rows, "step int, number int, value double").write.parquet(str(tmp_path / "source"))
    asked = []

    def source(request):
        asked.append(request)
        return spark.read.parquet(str(tmp_path / "source")).where(F.col("step").isin(request["step"]) & F.col("number").isin(request["number"]))

    cache = RequestCache(spark, str(tmp_path / "cache"), source, {"step": "int", "number": "int"})
    values = lambda df: sorted(r.value for r in df.collect())
    assert values(cache.read({"step": [0, 1, 2], "number": [0, 1]})) == [0.0, 1.0, 10.0, 11.0, 20.0, 21.0]
    assert asked == [{"step": [0, 1, 2], "number": [0, 1]}]
    again = RequestCache(spark, str(tmp_path / "cache"), source, {"step": "int", "number": "int"}).read({"step": [1, 2], "number": [1]})
    assert values(again) == [11.0, 21.0] and len(asked) == 1  # a smaller request is answered from what was written
    assert all("/cache/data/" in f for f in again.inputFiles())
    assert values(cache.read({"step": [2, 3], "number": [0, 1, 2]})) == [20.0, 21.0, 22.0, 30.0, 31.0, 32.0]
    assert sum(len(a["step"]) * len(a["number"]) for a in asked[1:]) == 4  # only what was lacking
    assert cache.read({"step": [99], "number": [0]}).isEmpty() and not cache.lacking({"step": [99], "number": [0]})
    assert cache.read({"step": [0], "number": [0]}).schema["step"].dataType.simpleString() == "int"


def test_cache_survives_a_stop(spark, tmp_path):
    """Rows whose cube was not noted are read again and replace what was written."""
    made = spark.createDataFrame([(1, 5.0)], "step int, value double")
    cache = RequestCache(spark, str(tmp_path / "c"), lambda r: made, {"step": "int"})
    made.write.partitionBy("step").parquet(str(tmp_path / "c" / "data"))
    assert cache.read({"step": [1]}).count() == 1
    with pytest.raises(ValueError):
        RequestCache(spark, str(tmp_path / "d"), lambda r: made, {"step": "int"}).read({"step": []})


def test_notes_of_writers_with_skewed_clocks(spark, tmp_path, monkeypatch):
    """A writer whose clock runs ahead cleans up; notes that follow count although their clock is behind."""
    import time

    fast, slow = (Recovery(spark, str(tmp_path / "r"), {"a": 1}) for _ in range(2))
    monkeypatch.setattr(time, "time_ns", lambda: 9 * 10**18)
    fast.add(["w1"])
    fast.clean()
    monkeypatch.setattr(time, "time_ns", lambda: 10**18)
    slow.add(["w2"])
    monkeypatch.setattr(time, "time_ns", lambda: 8 * 10**18)
    fast.add(["w3"])
    assert {r.window_id for r in slow.done().collect()} == {"w2", "w3"}
    other = Recovery(spark, str(tmp_path / "r"), {"a": 2})
    other.clean()
    assert {r.window_id for r in fast.done().collect()} == {"w2", "w3"}


def test_a_job_returns_what_its_target_holds(spark, tmp_path):
    """Instants keep their text names, a restart returns all windows, and the result is read, not computed again."""
    rows = [("t", n, s, 0, float(n + s)) for n in range(3) for s in (0, 6, 12)]
    spark.createDataFrame(rows, "param string, number int, step int, point_id int, value double").write.parquet(str(tmp_path / "f"))
    job = {"product": "ensms", "source": {"location": str(tmp_path / "f")}, "windows": [{"coords": s} for s in (0, 6, 12)], "keys": ["param"], "target": f"table:{tmp_path}/out", "recover": str(tmp_path / "done")}
    out = jobs.run(spark, job)
    assert sorted((r.window_id, r["mean"]) for r in out.collect()) == [("0", 1.0), ("12", 13.0), ("6", 7.0)]
    assert all("/out/" in f for f in out.inputFiles())
    Recovery(spark, job["recover"], {k: v for k, v in job.items() if k != "recover"}).add(["0", "6"])
    assert jobs.run(spark, job).count() == 3
