"""Calendars, windows over them and a clustering's records, against plain Python."""

import datetime as dt
import random

import pytest

from nimbria.operators import cluster as K
from nimbria.plans import dates as D
from nimbria.plans import tables as B


def day(n):
    return dt.date(2024, 1, 1) + dt.timedelta(n)


def test_rules(spark):
    days = lambda *a: [r.day for r in D.calendar(spark, dt.date(2023, 12, 30), dt.date(2024, 3, 4), *a).orderBy("day").collect()]
    assert len(days()) == 66
    assert days("weekly", [0, 3])[:3] == [dt.date(2024, 1, 1), dt.date(2024, 1, 4), dt.date(2024, 1, 8)]
    assert days("monthly", [1, 31]) == [dt.date(2023, 12, 31), dt.date(2024, 1, 1), dt.date(2024, 1, 31), dt.date(2024, 2, 1), dt.date(2024, 3, 1)]
    assert days("yearly", [(2, 29), (3, 1)]) == [dt.date(2024, 2, 29), dt.date(2024, 3, 1)]
    assert days("yearly", [(2, 29), (3, 1)], [(2, 29)]) == [dt.date(2024, 3, 1)]
    assert D.calendar(spark, day(1), day(0)).count() == 0
    with pytest.raises(ValueError):
        D.calendar(spark, day(0), day(1), "lunar")


@pytest.mark.parametrize("before, after, strict", [(1, 1, True), (3, 2, False), (0, 4, False), (2, 0, True)])
def test_brackets(spark, before, after, strict):
    rng = random.Random(before)
    held = sorted({rng.randrange(200) for _ in range(60)})
    asked = sorted({rng.randrange(-20, 220) for _ in range(80)})
    calendar = spark.createDataFrame([(day(n),) for n in held * 2] + [(None,)], "day date")
    dates = spark.createDataFrame([(day(n), "x") for n in asked * 2] + [(None, "y")], "date date, at string")
    got = {}
    for r in D.brackets(dates, calendar, "date", before, after, strict).orderBy("date", "ord").collect():
        got.setdefault(r.date, []).append(r.day)
    want = {}
    for n in asked:
        under, over = [h for h in held if h < n], [h for h in held if h > n]
        own = [n] if not strict and n in held else []
        if found := [*under[len(under) - min(before, len(under)) :], *own, *over[:after]]:
            want[day(n)] = [day(h) for h in found]
    assert got == want


@pytest.mark.parametrize("first, last", [(True, True), (False, True), (True, False), (False, False)])
def test_spans(spark, first, last):
    held = [3, 7, 8, 20, 70, 71]
    rows = [(1, day(3), day(8)), (2, day(4), day(6)), (3, day(-5), day(100)), (4, day(9), day(2)), (5, None, day(3)), (6, day(7), day(7))]
    got = D.spans(spark.createDataFrame(rows, "k int, first date, last date"), spark.createDataFrame([(day(n),) for n in held], "day date"), ["k"], with_first=first, with_last=last)
    want = {(k, day(h)) for k, a, b in rows if a and b for h in held if (a < day(h) or first and a == day(h)) and (day(h) < b or last and b == day(h))}
    found = got.collect()
    assert {(r.k, r.day) for r in found} == want and len(found) == len(want)
    labels = {r.k: (r.dates, r.n) for r in D.labelled(got, ["k"]).collect()}
    assert labels[3] == ("20240104-20240312", 6)


def test_calendar_is_bounded(spark, monkeypatch):
    monkeypatch.setattr(D, "MOST_DAYS", 10)
    with pytest.raises(ValueError):
        D.numbered(D.calendar(spark, day(0), day(10)))


def test_cluster_steps(spark):
    jobs = spark.createDataFrame([("a", 0, 120, 12), ("b", 0, 168, 12), ("c", 24, 24, 6), ("d", 10, 5, 6)], "job string, first int, last int, every int")
    got = {}
    for r in B.cluster_steps(jobs).orderBy("step").collect():
        got.setdefault((r.job, r.monthly), []).append(r.step)
    assert got == {("a", False): list(range(0, 121, 12)), ("b", True): [0, 84, 168], ("c", True): [24]}


def test_records(spark):
    labels = spark.createDataFrame([("x", n, c) for n, c in enumerate([1, 0, 0, 1, 0])] + [("y", n, 0) for n in (3, 4)], "run string, number int, cluster int")
    chosen = spark.createDataFrame([("x", 0, 2), ("x", 1, 3), ("y", 0, 4)], "run string, cluster int, number int")
    det = spark.createDataFrame([("x", 1)], "run string, cluster int")
    regime = spark.createDataFrame([("x", 0, 24, 4)], "run string, cluster int, first_step int, regime int")
    rows = {(r.run, r.cluster, r.first_step): r for r in K.records(labels, chosen, [(24, None), (48, 72)], ["run"], 0, det, regime, 3).collect()}
    assert len(rows) == 2 * 3 * 2
    r = rows["x", 1, 24]
    assert (r.n_clusters, r.control_cluster, r.n_members, r.members, r.deterministic_cluster, r.representative, r.last_step, r.regime) == (2, 2, 3, [1, 2, 4], 2, 2, None, 4)
    assert rows["x", 2, 48].members == [0, 3] and rows["x", 2, 48].regime == 0 and rows["x", 2, 48].last_step == 72
    empty = rows["x", 3, 48]
    assert (empty.n_clusters, empty.control_cluster, empty.n_members, empty.members, empty.deterministic_cluster, empty.representative, empty.regime) == (2, 0, 0, [], 0, 0, 0)
    alone = rows["y", 1, 24]
    assert (alone.n_clusters, alone.control_cluster, alone.members, alone.deterministic_cluster, alone.representative) == (1, 0, [3, 4], 0, 4)
    assert K.records(labels.where("false"), chosen, [(0, None)], ["run"]).count() == 0


def test_undivided(spark):
    pcs = spark.createDataFrame([("x", n, p, v) for n, vs in enumerate([(3.0, 4.0), (1.0, -1.0), (-1.0, 1.0)]) for p, v in enumerate(vs)], "run string, number int, component int, pc double")
    labels, chosen = K.undivided(pcs, ["run"])
    assert [tuple(r) for r in chosen.collect()] == [("x", 0, 1)] and {(r.number, r.cluster) for r in labels.collect()} == {(0, 0), (1, 0), (2, 0)}
