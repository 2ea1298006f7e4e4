"""Labels, holes and propagation against plain flood fills; order statistics against sorted lists."""

import random

import pytest
from pyspark.sql import functions as F

from terrapulse.functions.stats import order_statistic, quantiles
from terrapulse.operators import rasters


def flood(cells, starts, offsets):
    found, todo = set(), [s for s in starts if s in cells]
    while todo:
        r, c = todo.pop()
        if (r, c) in found:
            continue
        found.add((r, c))
        todo += [(r + i, c + j) for i, j in offsets if (r + i, c + j) in cells]
    return found


@pytest.fixture(scope="module")
def picture(spark):
    rng = random.Random(5)
    rows = [(r, c, 1.0 if rng.random() < 0.55 else 0.0) for r in range(9) for c in range(12)]
    return spark.createDataFrame(rows, "row int, col int, v double"), {(r, c) for r, c, v in rows if v}


def cells(df):
    return {(r["row"], r["col"]) for r in df.collect()}


def test_labels(picture):
    grid, on = picture
    got = {(r["row"], r["col"]): r["label"] for r in rasters.labels(grid.where("v = 1")).collect()}
    assert set(got) == on
    for cell in on:
        r, c = min(flood(on, [cell], rasters.EIGHT))
        assert got[cell] == r * 2**31 + c


def test_fill_holes(picture):
    grid, on = picture
    off = {(r, c) for r in range(9) for c in range(12)} - on
    outer = flood(off, [x for x in off if x[0] in (0, 8) or x[1] in (0, 11)], rasters.FOUR)
    assert cells(rasters.fill_holes(grid.where("v = 1"), grid, "v")) == on | (off - outer)


def test_propagate(picture):
    grid, on = picture
    seeds = sorted(on)[::20]
    got = cells(rasters.propagate(grid.where(F.struct("row", "col").isin([F.struct(F.lit(r), F.lit(c)) for r, c in seeds])), grid.where("v = 1")))
    assert got == flood(on, seeds, rasters.EIGHT)


def test_empty_mask(picture):
    grid, _ = picture
    assert cells(rasters.labels(grid.where("v > 2"))) == set()
    assert cells(rasters.opening(grid.where("v > 2"), grid)) == set()


def test_order_statistic(spark):
    rng = random.Random(3)
    rows = [(k, float(rng.choice([0, 0, 0, rng.randint(1, 900)]))) for k in "abc" for _ in range(700)] + [("d", 4.0), ("d", None)]
    df = spark.createDataFrame(rows, "k string, x double")
    got = {r["k"]: r["x"] for r in order_statistic(df, ["k"], "x", F.ceil(F.col("_n") * 0.9), cuts=20).collect()}
    for k in "abcd":
        xs = sorted(x for j, x in rows if j == k and x is not None)
        assert got[k] == xs[-(-len(xs) * 9 // 10) - 1]


def test_tiles_join_whatever_their_size(spark):
    """Parts across many tiles, by layer; a long winding part takes few rounds."""
    rng = random.Random(9)
    rows = [(z, r, c) for z in "ab" for r in range(17) for c in range(23) if rng.random() < (0.5 if z == "a" else 0.62)]
    df = spark.createDataFrame(rows, "layer string, row int, col int")
    for tile, offsets in ((3, rasters.EIGHT), (5, rasters.FOUR), (64, rasters.FOUR)):
        got = {(r["layer"], r["row"], r["col"]): r["label"] for r in rasters.labels(df, offsets, ("layer",), tile).collect()}
        assert set(got) == set(rows)
        for z in "ab":
            on = {(r, c) for k, r, c in rows if k == z}
            for cell in on:
                r, c = min(flood(on, [cell], offsets))
                assert got[(z, *cell)] == r * 2**31 + c
    snake = [(r, c) for r in range(0, 60, 2) for c in range(60)] + [(r, 59 if r % 4 == 1 else 0) for r in range(1, 59, 2)]
    found, rounds = rasters.labelled(spark.createDataFrame(snake, "row int, col int"), tile=8)
    assert {r["label"] for r in found.collect()} == {0} and found.count() == len(snake)
    assert rounds <= 12  # a walk from cell to cell would take 1830, from tile to tile 224


def test_one_tile_takes_no_round(spark):
    assert rasters.labelled(spark.createDataFrame([(0, 0), (1, 1), (5, 5)], "row int, col int"))[1] == 0


def test_layered_morphology(spark):
    """Closing, opening, holes and propagation of two layers at once equal those of each alone."""
    rng = random.Random(2)
    rows = [(z, r, c) for z in (1, 2) for r in range(12) for c in range(14) if rng.random() < 0.6]
    df = spark.createDataFrame(rows, "z int, row int, col int")
    grid = spark.createDataFrame([(r, c) for r in range(12) for c in range(14)], "row int, col int")
    seeds = df.where("row = 5")
    for both, one in (
        (rasters.closing(df, grid, 2, ("z",)), lambda m, s: rasters.closing(m, grid, 2)), (rasters.opening(df, grid, 1, ("z",)), lambda m, s: rasters.opening(m, grid, 1)),
        (rasters.fill_holes(df, by=("z",)), lambda m, s: rasters.fill_holes(m)), (rasters.propagate(seeds, df, ("z",)), lambda m, s: rasters.propagate(s, m)),
    ):
        got = {(r["z"], r["row"], r["col"]) for r in both.collect()}
        assert got == {(z, *c) for z in (1, 2) for c in cells(one(df.where(F.col("z") == z).select("row", "col"), seeds.where(F.col("z") == z).select("row", "col")))}


def test_box_means_in_one_pass(spark):
    rng = random.Random(4)
    grid = spark.createDataFrame([(r, c, rng.random(), None if rng.random() < 0.2 else rng.random()) for r in range(7) for c in range(9) if rng.random() < 0.9], "row int, col int, a double, b double")
    got = {(r["row"], r["col"]): r for r in rasters.box_means(grid, x=("a", 3), y=("a", 5), z=("b", 3)).collect()}
    for name, value, size in (("x", "a", 3), ("y", "a", 5), ("z", "b", 3)):
        alone = {(r["row"], r["col"]): r["mean"] for r in rasters.box_mean(grid, value, size).collect()}
        assert {k for k, r in got.items() if r[name] is not None} == set(alone) and all(abs(got[k][name] - m) < 1e-9 for k, m in alone.items())


def test_quantiles_are_exact(spark):
    """Against sorted lists: small and large groups, ties, few and no values, the extremes."""
    rng = random.Random(3)
    rows = [(g, rng.gauss(0, 1), float(rng.randrange(6)), None if i % 3 else rng.random()) for g, n in (("a", 9000), ("b", 7), ("c", 1)) for i in range(n)] + [("d", None, None, None)]
    df = spark.createDataFrame(rows, "g string, x double, y double, z double").repartition(3)
    wanted = {f"{c}_{k}": (F.col(c), p) for c in "xyz" for k, p in enumerate((0.0, 0.1, 0.5, 0.95, 1.0))}

    def plain(values, p):
        v = sorted(x for x in values if x is not None)
        if not v:
            return None
        at = (len(v) - 1) * p
        return v[int(at)] + (v[min(int(at) + 1, len(v) - 1)] - v[int(at)]) * (at - int(at))

    # the smaller accuracy makes brackets that are narrower than the group
    for accuracy in (4096, 64):
        got = {r.g: r for r in quantiles(df, "g", accuracy=accuracy, **wanted).collect()}
        assert set(got) == set("abcd")
        for g in got:
            for n, (_, p) in wanted.items():
                want = plain([r["gxyz".index(n[0])] for r in rows if r[0] == g], p)
                assert want == got[g][n] or abs(want - got[g][n]) < 1e-12
    assert abs(quantiles(df, m=(F.col("x"), 0.5)).first().m - plain([r[1] for r in rows], 0.5)) < 1e-12
    assert quantiles(df.where("false"), m=(F.col("x"), 0.5)).first().m is None


def test_cells_of_a_raster_are_made_in_many_tasks(spark, monkeypatch):
    """Rows of a raster are few, their cells and those around a mask are not: one task made and sorted them all."""
    monkeypatch.setattr(rasters, "CELLS", 500)
    grid = spark.createDataFrame([(0, 0, 1.0), (99, 49, 2.0)], "row int, col int, v double")
    cells = rasters.lattice(grid, "v")
    assert cells.count() == 5000 and cells.where("v IS NOT NULL").count() == 2
    assert cells.agg(F.max("row"), F.max("col"), F.max("_h"), F.max("_w")).first()[:] == (99, 49, 99, 49)
    assert "splits=Some(10)" in cells._jdf.queryExecution().optimizedPlan().toString()
    edge = [(r, c) for r in range(100) for c in range(50) if r in (0, 99) or c in (0, 49)]
    asked, labels = [], rasters.labels
    monkeypatch.setattr(rasters, "labels", lambda df, *rest: (asked.append(df._jdf.queryExecution().optimizedPlan().toString()), labels(df, *rest))[1])
    filled = rasters.fill_holes(spark.createDataFrame([("a", r, c) for r, c in edge], "k string, row int, col int"), by=("k",))
    assert filled.count() == 5000 and "Repartition" in asked[0] and "], 11" in asked[0]
    assert rasters.lattice(grid.where("false"), "v").count() == 0
