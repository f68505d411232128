"""Cases that only larger or shifted copies of the tables meet."""

import duckdb
import numpy as np
import pytest

from nimbria.operators import cluster as K
from nimbria.operators import grids
from nimbria.queries import ALL
from tests.compare import connect, same


def remade(sf, folder, table, query):
    """The tables of ``sf``, one of them replaced by what ``query`` makes of it."""
    con = connect(sf)
    con.execute(f"copy ({query}) to '{folder}/{table}.parquet' (format parquet)")
    made = duckdb.connect()
    made.execute(f"create view {table} as select * from '{folder}/{table}.parquet'")
    return made


def test_histogram_has_open_ends(spark, sf, tmp_path):
    con = remade(sf, tmp_path, "lineitem", "select * replace (case when l_linenumber = 1 then -l_quantity when l_linenumber < 5 then 1000 * l_quantity else l_quantity end as l_quantity) from lineitem")
    query, sql = ALL["histogram"]
    same(query(spark, str(tmp_path)), con, sql)


def test_poles_and_middles_take_the_smallest_number(spark, sf, tmp_path):
    # keys whose places are the poles (18001 k, and the key before 7919 k = 1), and a few of the table
    pole = next(k for k in range(18001) if k * 7919 % 18001 == 18000)
    keys = f"select c_custkey from customer where c_custkey < 20 union all select {pole} + 18001 * i from range(12) t(i) union all select 18001 * i from range(1, 12) t(i)"
    con = remade(sf, tmp_path, "customer", keys)
    con.execute(f"create view events as select * from '{sf}/events.parquet'")
    query, sql = ALL["reduced_nearest"]
    same(query(spark, str(tmp_path)), con, sql)


@pytest.mark.parametrize("grid", ["O16", "O3", "F6"])
def test_nearest_ties_as_all_points_do(spark, grid):
    points = grids.points(spark, grid).orderBy("point_id").toPandas()
    row = points.groupby("lat", sort=False).size()
    places = [(lat, lon) for lat in (90.0, -90.0, 90.0 - 1e-10) for lon in (0.0, 100.0, 200.0, 359.0)]
    for lat, n in row.items():  # middles of neighbours, the last and the first among them; the points themselves
        places += [(lat, (j + 0.5) * 360 / n) for j in range(n)] + [(lat, 0.0), (lat, -180.0 / n), (lat, 360.0 + 180.0 / n), (lat, 360.0 * (n - 1) / n)]
    places += [(0.0, lon) for lon in (0.0, 2.25, 180.0, 357.75)]
    target = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(places)], "point_id int, lat double, lon double")
    got = {r.out_point: r.in_point for r in grids.nearest_weights(grid, target).collect()}
    la, lo = np.radians(points.lat.to_numpy()), np.radians(points.lon.to_numpy())
    for i, (a, b) in enumerate(places):
        h = np.sin((la - np.radians(a)) / 2) ** 2 + np.cos(la) * np.cos(np.radians(a)) * np.sin((lo - np.radians(b)) / 2) ** 2
        assert got[i] == int(np.round(2 * 6371.0 * np.arcsin(np.sqrt(np.minimum(h, 1))), 7).argmin()), (a, b)


def test_few_members_get_the_best_of_all_partitions(spark):
    def least(x, k):
        codes = np.arange(k ** len(x))
        label = codes[:, None] // k ** np.arange(len(x)) % k
        best = np.inf
        for one in label:
            if len(np.unique(one)) == k:
                best = min(best, sum(((x[one == c] - x[one == c].mean(0)) ** 2).sum() for c in range(k)) / len(x))
        return best

    missed = 0
    for seed in range(12):  # members that lie far apart from each other: passes stop at many a partition
        x = np.random.default_rng(seed).normal(size=(7, 7))
        x -= x.mean(0)
        got = {r.k: r for r in K.partitions(spark, x, [2, 3], 20).collect()}
        for k in (2, 3):
            want = least(x, k)
            assert got[k].within == pytest.approx(want) and len(set(got[k].label)) == k
            missed += min(K.settle(x, K.sector_seeds(x, k, np.random.default_rng([1, k, p])))[2] for p in range(20)) > want * (1 + 1e-9)
    assert missed  # what the passes alone would not have found


def test_partitions_of_shifted_copies(spark, sf, tmp_path):
    con = remade(sf.replace("sf0.001", "sf0.1"), tmp_path, "lineitem", "select * replace (l_suppkey + 2 * i as l_suppkey) from lineitem, range(6) t(i)")
    query, sql = ALL["cluster_partitions"]
    same(query(spark, str(tmp_path)), con, sql)
