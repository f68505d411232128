"""Track text read in blocks of bytes: one file in many blocks gives the rows of one in one."""

import math
import random

import pytest

from nimbria.sources import readers


@pytest.fixture
def blocks(spark):
    """Sets how many bytes a task reads."""
    kept = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}

    def set_bytes(n):
        spark.conf.set("spark.sql.files.maxPartitionBytes", n)
        spark.conf.set("spark.sql.files.openCostInBytes", 0)

    yield set_bytes
    for k, v in kept.items():
        spark.conf.set(k, v)


def test_track_ids_cross_blocks(spark, tmp_path, blocks):
    rng, want, lines, track = random.Random(4), [], [], 0
    for i in range(900):
        if i % 7 == 0 or rng.random() < 0.02:
            track += 1
            lines += [rng.choice(["TC one", "  Named two", ""]) if track > 1 else "TC", "TC x"][1:]
        lines.append(f" {i % 5}  {i % 80}.5S 17{i % 10}W  20240101 {i} 12.5 99000 ")
        want.append((i, track, -(i % 80) - 0.5, -170.0 - i % 10))
    (tmp_path / "a.txt").write_text("\n".join(lines) + "\n")
    (tmp_path / "b.txt").write_text("TC\n7 1N 2E 20240101 5000 1 2")
    size = (tmp_path / "a.txt").stat().st_size
    for parts in (1, 16):
        blocks(size // parts + 1)
        got = sorted((r.step, r.id, r.lat, r.lon) for r in readers.read_tracks_text(spark, str(tmp_path)).collect())
        assert got == [*want, (5000, 1, 1.0, 2.0)]
    assert readers.numbered_lines(spark, str(tmp_path)).select("file", "block").distinct().count() >= 16


def tracker(name, points, end=True):
    lines = [f"00010 2024/01/{1 + h // 24:02d}/{h % 24:02d}*{la:03d}{lo:04d} {w:03d} {p:04d} {la2:03d}{lo2:04d}" for h, la, lo, w, p, la2, lo2 in points]
    return [*lines, f"00015 {name}"] if end else lines


def test_tracker_columns_and_blocks(spark, tmp_path, blocks):
    rng, lines, cyclones = random.Random(5), ["00000 2023 nothing", "00005 END of none"], []
    for c in range(40):
        points = [(6 * i, rng.randrange(100, 300), rng.randrange(0, 3600), rng.randrange(20, 150), rng.randrange(900, 1010), rng.randrange(100, 300), rng.randrange(0, 3600)) for i in range(rng.randrange(1, 12))]
        cyclones.append(points)
        lines += tracker(f"c{c}", points, end=c < 39)
    (tmp_path / "t.txt").write_text("\n".join(lines) + "\n")
    size, found = (tmp_path / "t.txt").stat().st_size, []
    for parts in (1, 16):
        blocks(size // parts + 1)
        found.append(sorted(readers.read_tracker(spark, str(tmp_path), base="2024-01-01").drop("file").collect(), key=lambda r: (int(r.name.removeprefix("unnamed_nat")), r.step)))
    assert found[0] == found[1] and len(found[0]) == sum(map(len, cyclones[:39]))

    def distance(dla, dlo, la):
        a = math.sin(math.radians(dla) / 2) ** 2 + math.cos(math.radians(la)) * math.cos(math.radians(la + dla)) * math.sin(math.radians(dlo) / 2) ** 2
        return 2 * 6371.0 * math.atan2(math.sqrt(a), math.sqrt(1 - a))

    rows = iter(found[0])
    for number, points in enumerate(cyclones[:39], 1):
        far, before = 0.0, None
        for h, la, lo, w, p, la2, lo2 in points:
            r, la, lo, la2, lo2 = next(rows), la / 10 + 0.05, lo / 10 + 0.05, la2 / 10 + 0.05, lo2 / 10 + 0.05
            assert (r.name, r.step, r.pres) == (f"unnamed_nat{number}", h, p) and r.wind == pytest.approx(w * 0.514444)
            assert r.windrad == pytest.approx(distance(la - la2, lo - lo2, la))
            if before is None:
                assert r.speed is None and r.accdist is None and r.dpdt is None
            else:
                d = distance(la - before[0], lo - before[1], la)
                far += d
                assert (r.speed, r.accdist, r.dpdt) == (pytest.approx(d * 1000 / 6 / 3600), pytest.approx(far), pytest.approx((p - before[2]) / 6))
            before = (la, lo, p)


def test_tracker_points_of_one_hour_have_no_speed(spark, tmp_path):
    (tmp_path / "t.txt").write_text("\n".join(tracker("x", [(6, 100, 200, 50, 990, 100, 200), (6, 110, 200, 50, 980, 100, 200)])))
    rows = readers.read_tracker(spark, str(tmp_path), base="2024-01-01", basin="aus").orderBy("lat_p").collect()
    assert {(r.speed, r.dpdt) for r in rows} == {(None, None)} and {r.lat_p for r in rows} == {-9.95, -10.95}
    assert {r.accdist is None for r in rows} == {True, False}
