"""Operators of products and choices without a DuckDB twin, held against plain versions, and their round trips."""

import itertools
import random
from datetime import date, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from terrapulse.operators import choices, products


def test_spread_dates(spark):
    """Eleven days, five wanted: the ends and the days nearest to the slots; a baseline far off the median costs a day an hour and metre."""
    days = [0, 1, 2, 3, 12, 24, 25, 36, 37, 47, 48]
    rows = [(s, date(2020, 1, 1) + timedelta(d), d * 10 + f, f, (30.0 if s == "b" and d == 24 else 0.0) if s != "n" else None) for s in "abn" for d in days for f in (2, 1)]
    scenes = spark.createDataFrame(rows, "stack string, date date, start_ts int, frame int, baseline double")
    got = {}
    for r in choices.spread_dates(scenes, 5).collect():
        got.setdefault(r.stack, set()).add((r.date - date(2020, 1, 1)).days)
    assert got["a"] == got["n"] == {0, 12, 24, 36, 48}
    assert got["b"] == {0, 12, 25, 36, 48}
    assert choices.spread_dates(scenes, 11).count() == 33
    assert choices.spread_dates(scenes.limit(0), 5).count() == 0


def test_flat_water(spark):
    """A plain of 30 cells with a hole counts, one of 6 does not, and diagonal contact does not join them."""
    h = np.add.outer(np.arange(12) * 50.0, np.arange(10) * 50.0)
    h[0:6, 0:7] = 0.0
    h[7:11, 7:10] = 5.0
    gy, gx = np.gradient(h, 10.0, 20.0)
    flat = np.degrees(np.arctan(np.hypot(gx, gy))) < 1.0
    seen, want = set(), set()
    for cell in zip(*map(list, np.nonzero(flat)), strict=True):
        part, todo = set(), [tuple(map(int, cell))]
        while todo:
            r, c = at = todo.pop()
            if at in part or at in seen or not (0 <= r < 12 and 0 <= c < 10) or not flat[at]:
                continue
            part.add(at)
            todo += [(r + 1, c), (r - 1, c), (r, c + 1), (r, c - 1)]
        seen |= part
        want |= part if len(part) > 8 else set()
    grid = spark.createDataFrame([(i, j, float(h[i, j])) for i in range(12) for j in range(10)], "row int, col int, h double")
    got = {(r.row, r.col) for r in choices.flat_water(grid, "h", 10.0, 20.0, more_than=8).collect()}
    assert got == want and want and seen - want


def test_outlines(spark):
    """A square fills its outline, an L does not; the area is that of the largest polygon over all corner orders of a plain hull."""
    square = [("s", r, c) for r in range(3) for c in range(3)]
    ell = [("l", r, 0) for r in range(3)] + [("l", 2, c) for c in range(1, 3)]
    dot = [("d", 7, 7)]
    got = {r.zone: (r.cells, r.hull_area, round(r.compactness, 6)) for r in choices.outlines(spark.createDataFrame(square + ell + dot, "zone string, row int, col int")).collect()}
    assert got == {"s": (9, 9.0, 1.0), "l": (5, 7.0, round(5 / 7, 6)), "d": (1, 1.0, 1.0)}


def test_series_components(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(40, 6)).cumsum(1)
    series = spark.createDataFrame([(i, [float(v) for v in row]) for i, row in enumerate(x)], "point_id long, values array<double>")
    found, shares = choices.series_components(series)
    y = x - x.mean(1, keepdims=True)
    y = y - y.mean(0)
    u, s, vt = np.linalg.svd(y, full_matrices=False)
    sign = np.sign(vt[range(3), np.abs(vt[:3]).argmax(1)])
    want = (u * s)[:, :3] * sign
    got = np.array([[r.pc1, r.pc2, r.pc3] for r in found.orderBy("point_id").collect()])
    assert np.allclose(got, want) and np.allclose(shares, (s**2 / (s**2).sum())[:3])


def test_zone_raster_of_another_shape(spark):
    points = spark.createDataFrame([(1, 0, 0), (2, 1, 1)], "point_id long, row int, col int")
    cells = spark.createDataFrame([(r, c, r * c) for r, c in itertools.product(range(2), range(2))], "row int, col int, zone int")
    at = lambda h, w, x: {r.point_id: (r.in_zone, r.zone_id, r.status) for r in products.with_zones(points, x, h, w).collect()}
    assert at(2, 2, cells) == {1: (False, "", "loaded"), 2: (True, "Z1", "loaded")}
    assert at(3, 2, cells) == {1: (False, "", "mask_shape_mismatch"), 2: (False, "", "mask_shape_mismatch")}
    assert at(2, 2, cells.limit(0)) == {1: (False, "", "mask_missing"), 2: (False, "", "mask_missing")}


def test_without_masks_or_text(spark):
    cells = spark.createDataFrame([(0, 0), (0, 1)], "row int, col int")
    assert products.land(cells, spark.createDataFrame([], "place int, row int, col int, land boolean")).count() == 2
    broken = spark.createDataFrame([(1, "no json"), (2, None), (3, '{"coordinates": [[[0, 0]]]}')], "polygon_id long, geojson string")
    assert products.polygon_edges(broken).count() == 0


def test_raster_round_trip(spark, tmp_path):
    cells = spark.createDataFrame([(r, c, float(r + c)) for r in range(4) for c in range(4)], "row int, col int, velocity double")
    raster = products.rate_raster(cells, cells["col"] > 0, tile=2)
    products.write_raster(raster, str(tmp_path / "r"))
    back = spark.read.parquet(str(tmp_path / "r")).where("tile_row = 1")
    assert back.count() == 8 and back.where("velocity IS NULL").count() == 2


def test_boxes_meet_once(spark):
    """Boxes over several cells give each pair once before any ``distinct``."""
    from terrapulse.operators import bounds

    spots = [(i, 30.0 + i % 7 * 0.0013, 103.0 - i % 5 * 0.0017) for i in range(60)] + [(60, -0.001, -0.001), (61, 0.0, 0.0)]
    boxes = spark.createDataFrame([(i, y + 0.0021, y, x + 0.0019, x) for i, y, x in spots], "id long, n double, s double, e double, w double")
    rows = [tuple(r) for r in boxes.collect()]
    want = sorted((a[0], b[0]) for a in rows for b in rows if a[2] <= b[1] and b[2] <= a[1] and a[4] <= b[3] and b[4] <= a[3])
    assert sorted(map(tuple, bounds._touching(boxes, boxes, 0.001).collect())) == want
    assert sorted(map(tuple, bounds.intersecting(boxes, boxes, 0.004).collect())) == want
    assert bounds.contiguous(boxes, 0.004, 0.0).first().parts == 2


def plain_parts(rows):
    """Connected sets of boxes by all pairs."""
    root = {r[0]: r[0] for r in rows}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in rows:
        for b in rows:
            if a[2] <= b[1] and b[2] <= a[1] and a[4] <= b[3] and b[4] <= a[3]:
                root[find(a[0])] = find(b[0])
    return len({find(i) for i in root})


@pytest.mark.parametrize("seed,most", [(1, 0.004), (2, 0.0015), (3, 0.012)])
def test_parts_of_boxes(spark, seed, most):
    """Sets by hubs of cells are those by all pairs; boxes are smaller and larger than a cell, some lie beyond a pole (F2)."""
    from terrapulse.operators import bounds

    rng = random.Random(seed)
    rows = []
    for i in range(160):
        y, x = rng.choice((-0.02, 89.98, 94.0)) + rng.random() * 0.04, 179.98 + rng.random() * 0.04
        rows.append((i, y + rng.random() * most, y, x + rng.random() * most, x))
    rows += [(200, 0.1, 0.1, 0.1, 0.1), (201, 0.1, 0.1, 0.1, 0.1), (202, 0.104, 0.1, 0.104, 0.1004), (203, -89.999, -90.5, 0.0, -0.001), (204, -90.5, -91.0, 0.0, -0.001)]
    boxes = spark.createDataFrame(rows, "id long, n double, s double, e double, w double")
    assert 6 < plain_parts(rows)
    for cell in (0.004, 0.001):
        assert bounds.contiguous(boxes, cell, 0.0).first().parts == plain_parts(rows)
    wide = [(i, n + 0.0005, s - 0.0005, e + 0.0005, w - 0.0005) for i, n, s, e, w in rows]
    unnamed = spark.createDataFrame([(None, 0.1, -0.1, 180.1, 179.9)], boxes.schema)
    assert bounds.contiguous(boxes.union(unnamed), 0.004, 0.0005).first().parts == plain_parts(wide)


def test_links_grow_with_boxes(spark, monkeypatch):
    """Boxes upon each other were linked each to each, which filled the disk; now each is linked to its hubs (F2)."""
    from terrapulse.operators import bounds

    boxes = spark.range(400).select("id", *[(F.lit(at) + F.col("id") * 1e-6).alias(c) for c, at in (("n", 30.004), ("s", 30.0), ("e", 103.004), ("w", 103.0))])
    links, components = [], bounds.connected_components
    monkeypatch.setattr(bounds, "connected_components", lambda edges, **k: links.append(edges.count()) or components(edges, **k))
    assert bounds.contiguous(boxes, 0.004, 0.001).first().parts == 1
    assert links[0] <= 400


def test_boxes_are_not_broadcast(spark):
    """Files of points are small, their boxes in cells are not (F2)."""
    from terrapulse.operators import bounds

    boxes = spark.range(9).select("id", *[(F.lit(at) + F.col("id") * 0.001).alias(c) for c, at in (("n", 30.004), ("s", 30.0), ("e", 103.004), ("w", 103.0))])
    for links in (lambda: bounds.intersecting(boxes, boxes, 0.004), lambda: bounds._hub_links(boxes, 0.004)):
        plan = links()._jdf.queryExecution().sparkPlan().toString()
        assert "BroadcastHashJoin" not in plan, plan
