"""Seeds, partitions as tasks and the choice among them."""

import numpy as np
import pytest

from nimbria.operators import cluster as K
from nimbria.plans import jobs


@pytest.fixture(scope="module")
def cloud():
    rng = np.random.default_rng(1)
    centres = np.array([[6.0, 0, 0], [-3, 5, 0], [-3, -5, 1]])
    x = np.concatenate([rng.normal(c, 0.7, (12, 3)) for c in centres])
    return x - x.mean(0)


def test_sector_seeds_are_apart(cloud):
    hits = 0
    for s in range(50):
        seeds = K.sector_seeds(cloud, 3, np.random.default_rng(s))
        assert len(np.unique(seeds, axis=0)) == 3
        unit = (cloud * cloud).sum(1).mean()
        assert (seeds[0] ** 2).sum() <= 1.5**2 * unit
        hits += min(((a - b) ** 2).sum() for i, a in enumerate(seeds) for b in seeds[:i]) > 0.25 * unit
    assert hits >= 49
    flat = np.zeros((5, 1))
    assert K.sector_seeds(flat, 3, np.random.default_rng(0)).shape == (3, 1)  # all alike: still distinct members
    outer = np.array([[100.0, 0], [0, 100.0], [-100.0, 0], [0, -100.0]])
    assert K.sector_seeds(outer, 2, np.random.default_rng(0), reach=0.1).shape == (2, 2)


def test_partitions_are_the_best_of_all_passes(spark, cloud):
    got = {r.k: r for r in K.partitions(spark, cloud, [2, 3, 4], 24).collect()}
    again = {r.k: r for r in K.partitions(spark, cloud, [2, 3, 4], 24).collect()}
    assert got == again  # wherever the passes ran
    truth = np.repeat([0, 1, 2], 12)
    assert all(len({got[3].label[i] for i in np.flatnonzero(truth == c)}) == 1 for c in range(3))
    total = (cloud * cloud).sum(1).mean()
    for k, r in got.items():
        assert r.within + r.between == pytest.approx(total) and r.ratio == pytest.approx(r.between / r.within)
        sizes = np.bincount(r.label, minlength=k)
        assert list(sizes) == sorted(sizes, reverse=True)
    assert K.lloyd(cloud, 3, 1, seeds="sectors")[2] == pytest.approx(got[3].ratio)


@pytest.mark.parametrize(
    "found, more, want",
    [
        ([(2, 5, 1, 90), (3, 5, 1, 99), (4, 5, 1, 99)], {}, 3),
        ([(2, 5, 1, 97), (3, 5, 1, 99), (4, 5, 1, 99)], {"max_sig": 95}, 2),
        ([(2, 1, 1, 97), (3, 5, 1, 99)], {"spread": 2}, 3),
        ([(2, 5, 0.1, 97), (3, 5, 0.1, 99)], {"thresholds": {2: 0.5, 3: 0.2}}, 1),
        ([(2, 5, 1, 80), (3, 5, 1, 85), (4, 5, 1, 99)], {"med_sig": 82}, 3),
        ([(2, 5, 1, 70), (3, 5, 1, 96), (4, 5, 1, 99)], {"min_sig": 90, "tolerance": 4}, 3),
        ([(2, 5, 1, 70), (3, 5, 1, 96), (4, 5, 1, 99)], {"min_sig": 98, "tolerance": 4}, 4),
        ([(2, 5, 1, 0), (3, 5, 1, 0)], {}, 1),
        ([], {}, 1),
    ],
)
def test_choice_under_constraints(found, more, want):
    more = {"spread": 0.0, "thresholds": {}, **more}
    assert K.choose_constrained(found, more.pop("spread"), more.pop("thresholds"), **more) == want


def test_cluster_job_with_constraints(spark, tmp_path):
    rng = np.random.default_rng(2)
    rows = [(n, 0, p, float(rng.normal(10 * (n % 2) * (1 if p < 3 else -1), 1))) for n in range(16) for p in range(6)]
    spark.createDataFrame(rows, "number int, step int, point_id int, value double").write.parquet(str(tmp_path / "f"))
    spark.createDataFrame([(p, 1 / 6) for p in range(6)], "point_id int, weight double").write.parquet(str(tmp_path / "w"))
    job = {"product": "clusters", "source": {"location": str(tmp_path / "f")}, "weights": {"location": str(tmp_path / "w")}, "clusters": [2, 3], "samples": 8, "seeds": "sectors", "scaled": True, "variance": 50.0}
    got = {r.number: r.cluster for r in jobs.run(spark, job | {"constraints": {"max_sig": 50.0}}).collect()}
    assert len({got[n] for n in range(0, 16, 2)}) == 1 and got[0] != got[1]
    none = jobs.run(spark, job | {"constraints": {"spread": 2.0}})
    assert {r.cluster for r in none.collect()} == {0}


def test_components_are_scaled_by_their_deviations(spark):
    rows = [(n, 0, p, float(v)) for n, vs in enumerate([[1, 0, 2], [0, 3, 1], [5, 1, 0], [2, 2, 2]]) for p, v in enumerate(vs)]
    df = spark.createDataFrame(rows, "number int, step int, point_id int, value double")
    w = spark.createDataFrame([(0, 0.5), (1, 0.3), (2, 0.2)], "point_id int, weight double")
    made = K.components(K.anomalies(df), w, 4)
    x, f = made.scaled(4), np.array([[1, 0, 2], [0, 3, 1], [5, 1, 0], [2, 2, 2]], float) * np.sqrt([0.5, 0.3, 0.2])
    apart = lambda m: ((m[:, None] - m[None]) ** 2).sum(-1)
    np.testing.assert_allclose(apart(x), apart(f), atol=1e-9)
