"""Round trips of the text, CSV and feature tables."""

import json

import numpy as np
import pytest

from terrapulse.sources import grids, stacks, tables


def test_date_flags(spark):
    epochs = spark.createDataFrame([("20200101",), ("20200113",), ("20200125",), ("20200206",)], "date string")
    flags = spark.createDataFrame([("20200101", " Yes "), ("20200113", "0"), ("20200125", None)], "date string, final_abnormal_flag string")
    assert {r.date: r.abnormal for r in tables.date_flags(epochs, flags).collect()} == {"20200101": True, "20200113": False, "20200125": False, "20200206": False}


def test_baselines(spark, tmp_path):
    (tmp_path / "20200101_20200113.txt").write_text("swath 1\nBperp (average): -12.5\nBpar: 7\nBperp at center: 2.5\n")
    (tmp_path / "20200113_20200125.txt").write_text("nothing\n")
    assert [tuple(r) for r in tables.read_baselines(spark, str(tmp_path)).collect()] == [("20200101_20200113", -5.0)]


def test_points_and_features(spark, tmp_path):
    points = spark.createDataFrame([(i, 103.0 + i, 30.0, None if i == 2 else i / 2) for i in range(5)], "point_id long, lon double, lat double, score double")
    tables.write_points(points, str(tmp_path / "p"), limit=3)
    back = tables.read_csv(spark, str(tmp_path / "p"), points.schema.simpleString()[7:-1].replace(":", " "))
    assert back.count() == 3 and back.exceptAll(points).count() == 0
    tables.write_features(points, str(tmp_path / "f"))
    found = sorted((json.loads(r.value) for r in spark.read.text(str(tmp_path / "f")).collect()), key=lambda f: f["properties"]["point_id"])
    assert found[3] == {"type": "Feature", "geometry": {"type": "Point", "coordinates": [106.0, 30.0]}, "properties": {"point_id": 3, "score": 1.5}}


def test_all_points_are_written(spark, tmp_path):
    """More points than the limit that there was."""
    tables.write_points(spark.range(500_001).withColumnRenamed("id", "point_id"), str(tmp_path / "p"))
    assert spark.read.option("header", True).csv(str(tmp_path / "p")).count() == 500_001


def test_delay_grids(spark, tmp_path):
    """Both directions of both axes, partitions of a few rows, and what is refused."""
    want = {}
    for name, dy, dx in (("20200101", -0.5, 0.25), ("20200113", 0.5, 0.25), ("20200125", -0.5, -0.25)):
        data = np.arange(15, dtype="<f4").reshape(5, 3) + len(want)
        (tmp_path / f"{name}.ztd").write_bytes(data.tobytes())
        y, x = (32.0 if dy < 0 else 30.0), (103.5 if dx < 0 else 103.0)
        (tmp_path / f"{name}.ztd.rsc").write_text(f"WIDTH 3\nFILE_LENGTH 5\nX_FIRST {x}\nY_FIRST {y}\nX_STEP {dx}\nY_STEP {dy}\nUNIT m\n")
        want |= {(name, round((y + i * dy - 30) / 0.5), round((x + j * dx - 103) / 0.25)): (y + i * dy, x + j * dx, float(data[i, j])) for i in range(5) for j in range(3)}
    for part in ("6", "1000"):
        found = grids.read_delay_grids(spark, str(tmp_path), partValues=part)
        assert {(r.date, r.lat_idx, r.lon_idx): (r.lat, r.lon, r.ztd) for r in found.collect()} == want
        assert found.rdd.getNumPartitions() == (9 if part == "6" else 3)
    (tmp_path / "20200206.ztd").write_bytes(b"\0" * 56)
    (tmp_path / "20200206.ztd.rsc").write_text((tmp_path / "20200101.ztd.rsc").read_text())
    with pytest.raises(Exception, match="56 bytes where its header wants 60"):
        grids.read_delay_grids(spark, str(tmp_path)).collect()
    (tmp_path / "20200206.ztd.rsc").write_text("WIDTH 3\nX_FIRST a\n")
    with pytest.raises(Exception, match="the header lacks FILE_LENGTH, X_FIRST"):
        grids.read_delay_grids(spark, str(tmp_path)).collect()


def test_delay_grid_round_trip(spark, tmp_path):
    rows = [("20200101", i, j, 30 + i * 0.5, 103 + j * 0.25, float(i * 10 + j)) for i in range(4) for j in range(6)]
    grid = spark.createDataFrame(rows, "date string, lat_idx int, lon_idx int, lat double, lon double, ztd float")
    for downward in (True, False):
        path = f"file://{tmp_path}/{downward}"
        assert grids.write_files(grids.delay_grid_files(grid, downward=downward), path) == 2
        assert {tuple(r) for r in grids.read_delay_grids(spark, path).collect()} == set(rows)


def test_footprints(spark, tmp_path):
    """Three scenes of two swaths; a broken point, a box that meets one swath of the first scene and one that meets none."""
    def text(lat, lon):
        points = "".join(f"<geolocationGridPoint><azimuthTime>x</azimuthTime><latitude>{lat + a}</latitude><longitude>{lon + b}</longitude></geolocationGridPoint>" for a, b in ((0, 0), (1, 1)))
        return f"<product><a><geolocationGrid><list>{points}<geolocationGridPoint><latitude>n</latitude></geolocationGridPoint></list></geolocationGrid></a></product>"

    rows = [(k, s, text(30 + 0.1 * k, 103 + 2 * s)) for k in range(3) for s in (1, 2)]
    for k in range(3):
        own = spark.createDataFrame([(f"s1a-iw{s}-slc-vv-0{k}.xml", t) for j, s, t in rows if j == k], "name string, content string")
        grids.write_files(own, f"file://{tmp_path}/S{k}.SAFE/annotation")
    found = grids.footprint_points(spark, f"{tmp_path}/*.SAFE/annotation/*.xml")
    assert found.count() == 12 and {r.scene for r in found.collect()} == {"S0", "S1", "S2"}
    assert {r.swath for r in grids.swaths_over(found, 30.5, 30.6, 107.5, 109).collect()} == {2}
    assert {r.swath for r in grids.swaths_over(found, 50, 51, 0, 1).collect()} == {1, 2}
    r = grids.common_bounds(found).first()
    assert (r.south, r.north, r.west, r.east, r.n_dates) == (30.2, 31.0, 105.0, 108.0, 3)
    assert grids.common_bounds(found.where("false")).count() == 0


def test_zone_series(spark):
    profiles = spark.createDataFrame([(1, f"2020010{i}", 1.0, 2.0, float(i * i), 3.0, 40) for i in range(1, 5)], "zone int, date string, p25 double, p50 double, trimmed_mean double, p75 double, n_points long")
    got = [r.smooth for r in tables.zone_series(profiles, spark.createDataFrame([(1, 15.0, 1.0)], "zone int, net_mm double, continuity double")).orderBy("date").collect()]
    assert got == [1.75, 4.5, 9.5, 14.25]


def test_geometry_prefers_its_own_grid(spark):
    own = spark.createDataFrame([(0, 0, 1.0, 2.0)], "row int, col int, latitude double, longitude double")
    full = spark.createDataFrame([(r, c, float(r), float(c), 5.0) for r in range(9) for c in range(9)], "row int, col int, latitude double, longitude double, height double")
    assert [tuple(r) for r in stacks.geometry(own, full).collect()] == [(0, 0, 1.0, 2.0, None)]
    got = {tuple(r) for r in stacks.geometry(own.drop("latitude"), full, shape=(2, 5), offset=(1, 2), stride=(3, 2)).collect()}
    assert got == {(i, j, 1.0 + 3 * i, 2.0 + 2 * j, 5.0) for i in range(2) for j in range(4)}  # the fifth column lies beyond the grid
    assert stacks.geometry(None, full).count() == 81
    with pytest.raises(ValueError, match="no grid"):
        stacks.geometry(None, None)
