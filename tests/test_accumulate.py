import math

import numpy as np
import pytest

from nimbria.operators.accumulate import accumulate, accumulate_dims, check_members, remaining
from nimbria.plans import windows as W

#: Two members at three points; the value at a coordinate is the base and twice the coordinate.
BASE = [[2.0, -3.0, 10.0], [0.5, 6.0, 40.0]]
HIST = (-4.0, 1.0, 9.0, 20.0, 60.0)


def feed(spark, coords):
    rows = [(n, p, c, BASE[n][p] + 2 * c) for n in range(2) for p in range(3) for c in coords]
    return spark.createDataFrame(rows, "number int, point_id int, step int, value double")


def result(spark, window, coords=(0, 2, 3, 4)):
    out = np.full((2, 3), np.nan)
    for r in accumulate(feed(spark, coords), [window], ["number", "point_id"]).collect():
        out[r.number, r.point_id] = r.value
    return out


def full(x):
    return np.full((2, 3), float(x))


def plus(x, times=1):
    """``times`` the base and ``x``: what linear operations make of values that grow by 2."""
    return times * np.array(BASE) + x


CASES = [
    ("sum", (0, 2, 4), {}, plus(12, 3)),  # 0 + 4 + 8
    ("minimum", (2, 3, 4), {}, plus(4)),
    ("maximum", (0, 2, 4), {}, plus(8)),
    ("integral", (0, 3, 4), {}, plus(26, 4)),  # 3 (base + 6) + 1 (base + 8)
    ("integral", (2, 4), {}, plus(16, 2)),
    ("difference", (0, 4), {}, full(8)),
    ("difference", (3,), {}, plus(6)),
    ("difference_rate", (0, 4), {}, full(2)),
    ("difference_rate", (2, 4), {"factor": 0.25}, full(8)),
    ("difference_rate", (4,), {"factor": 0.5}, plus(8) / 2),
    ("mean", (0, 2, 4), {}, plus(4)),
    ("weighted_mean", (0, 3, 4), {}, plus(6.5)),  # 3/4 of base + 6 and 1/4 of base + 8
    ("weighted_mean", (2, 4), {"weights": (0.25, 0.75)}, plus(7)),
    ("mean", (0, 1, 2, 3, 4), {"sequential": True}, plus(4.5)),  # of 0, 4, 6, 8: coordinate 1 is not there
    ("standard_deviation", (0, 2, 4), {}, full(math.sqrt(32 / 3))),  # of 0, 4, 8
    ("mean", (0, 2, 4), {"deaccumulate": True}, full(4)),
    ("sum", (0, 1, 2, 3, 4), {"deaccumulate": True, "sequential": True}, full(8)),
    ("mean", (0, 1, 2), {}, full(np.nan)),  # coordinate 1 is missing: not complete
]


@pytest.mark.parametrize("op,coords,options,expected", CASES)
def test_golden(spark, op, coords, options, expected):
    np.testing.assert_allclose(result(spark, W.Window("w", coords, op, **options)), np.array(expected, float))


def test_nan_propagates(spark):
    df = spark.createDataFrame([(0, 0, 0, 1.0), (0, 0, 1, math.nan), (0, 0, 2, 3.0)], "number int, point_id int, step int, value double")
    for op in ("sum", "minimum", "maximum", "mean"):
        assert math.isnan(accumulate(df, [W.Window("w", (0, 1, 2), op)], ["number", "point_id"]).first().value)


def test_histogram(spark):
    w = W.Window("w", (0, 2, 4), "histogram", bins=HIST, normalise=False)
    rows = {(r.number, r.point_id, r.bin): r.value for r in accumulate(feed(spark, (0, 2, 4)), [w], ["number", "point_id"]).collect()}
    for n in range(2):
        for p in range(3):
            expected = np.histogram([BASE[n][p] + 2 * c for c in (0, 2, 4)], HIST)[0]
            assert [rows[n, p, b] for b in range(4)] == expected.tolist()


def test_empty_histogram_is_nan(spark):
    w = W.Window("w", (0,), "histogram", bins=(100.0, 200.0))
    assert all(math.isnan(r.value) for r in accumulate(feed(spark, (0,)), [w], ["number", "point_id"]).collect())


def test_overlapping_windows_share_a_scan(spark):
    df = spark.createDataFrame([(p, s, float(s + 100 * p)) for p in range(3) for s in range(0, 31, 5)], "point_id int, step int, value double")
    windows = [W.Window(n, tuple(range(a, b + 1, 5)), "mean") for n, a, b in (("0-10", 0, 10), ("5-25", 5, 25), ("20-30", 20, 30))]
    got = {(r.window_id, r.point_id): r.value for r in accumulate(df, windows, ["point_id"]).collect()}
    assert [[got[w.window_id, p] for p in range(3)] for w in windows] == [[m + 100 * p for p in range(3)] for m in (5, 15, 25)]


def test_dims_fold_last_first(spark):
    df = spark.createDataFrame([(s, n, float(s * s * n)) for s in range(4) for n in range(1, 4)], "step int, number int, value double")
    dims = {"number": [W.Window("1-3", (1, 3), "difference")], "step": [W.Window("0-3", (0, 1, 2, 3), "mean")]}
    assert accumulate_dims(df, dims, []).first().value == pytest.approx(3.5 * 2)


def test_members_and_restart(spark):
    df = feed(spark, (0, 2))
    assert check_members(df, ["step"], 2).count() == 12
    with pytest.raises(EOFError):
        check_members(df, ["step"], 3)
    windows = W.default([{"to": 2}, {"to": 4}])
    assert [w.window_id for w in remaining(windows, {"0-2"})] == ["0-4"]
