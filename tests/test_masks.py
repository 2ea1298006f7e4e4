"""Region growing, principal parts and growth of zones against plain array versions; the display grid with ties and holes."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from terrapulse.operators import choices, display, masks

H, W = 18, 26


def box(values, valid, size):
    """Mean over the valid cells of a box, border cells repeated."""
    half = size // 2
    v, n = (np.pad(np.where(valid, x, 0.0), half, mode="edge") for x in (values, np.ones(valid.shape)))
    n = np.pad(valid.astype(float), half, mode="edge")
    at = [(i, j) for i in range(size) for j in range(size)]
    total, count = (sum(a[i : i + valid.shape[0], j : j + valid.shape[1]] for i, j in at) for a in (v, n))
    return np.where(valid, total / np.maximum(count, 1), np.nan)


def around(m, fill):
    p = np.pad(m, 1, constant_values=fill)
    return [p[i : i + m.shape[0], j : j + m.shape[1]] for i in range(3) for j in range(3)]


def dilated(m, n=1):
    for _ in range(n):
        m = np.any(around(m, False), 0)
    return m


def eroded(m, n=1):
    for _ in range(n):
        m = np.all(around(m, False), 0)
    return m


def parts(m, eight=True):
    out, seen = [], np.zeros_like(m)
    steps = [(i, j) for i in (-1, 0, 1) for j in (-1, 0, 1) if (i or j) and (eight or not i or not j)]
    for start in zip(*np.nonzero(m), strict=True):
        if seen[start]:
            continue
        todo, part = [start], np.zeros_like(m)
        while todo:
            r, c = todo.pop()
            if 0 <= r < m.shape[0] and 0 <= c < m.shape[1] and m[r, c] and not seen[r, c]:
                seen[r, c] = part[r, c] = True
                todo += [(r + i, c + j) for i, j in steps]
        out.append(part)
    return out


def filled(m):
    out = m.copy()
    for p in parts(~m, eight=False):
        if not (p[0].any() or p[-1].any() or p[:, 0].any() or p[:, -1].any()):
            out |= p
    return out


def spread(seeds, mask):
    out = np.zeros_like(mask)
    for p in parts(mask | seeds):
        if (p & seeds).any():
            out |= p
    return out


def settled(m):
    m = eroded(dilated(m, 2), 2)
    return filled(dilated(eroded(m, 1), 1))


@pytest.fixture(scope="module")
def field(spark):
    rng = np.random.default_rng(6)
    r, c = np.mgrid[0:H, 0:W]
    a = {
        "velocity": 24 * np.sin(r / 4.0) * np.cos(c / 6.0) + rng.normal(size=(H, W)), "tcoh": rng.uniform(0.5, 1.0, (H, W)), "ps_score": rng.uniform(0.2, 1.0, (H, W)),
        "strict": (rng.random((H, W)) < 0.5).astype(float), "relaxed": (rng.random((H, W)) < 0.2).astype(float), "anomaly": rng.uniform(0, 4, (H, W)), "probability": rng.uniform(0.1, 0.9, (H, W)),
    }
    valid = rng.random((H, W)) < 0.95
    valid[0, 0] = valid[-1, -1] = True
    rows = [(int(i), int(j), *[float(x[i, j]) for x in a.values()]) for i, j in zip(*np.nonzero(valid), strict=True)]
    df = spark.createDataFrame(rows, "row int, col int, " + ", ".join(f"{k} double" for k in a))
    return a, valid, df.drop("probability"), df.select("row", "col", "probability")


def test_region_grow(field):
    a, valid, found, probability = field
    support = ((a["strict"] > 0.5) | (a["relaxed"] > 0.5)) & valid
    mean = lambda x, n: box(x, valid, n)
    core, region, back = (mean(a["velocity"], n) for n in (15, 21, 41))
    density, tcoh, ps = mean(support.astype(float), 9), mean(a["tcoh"], 9), mean(a["ps_score"], 9)
    odd = np.abs(region - back)
    lim = {"core": 2.0, "grow": 1.0}
    core_at = max(np.percentile(np.abs(core[support]), 90), 2.0)
    grow_at, odd_at = max(core_at * 0.62, 1.0), max(np.percentile(odd[support], 78), 0.55)
    want = {}
    for sign in (1, -1):
        moving = valid & (region * sign >= grow_at)
        same = sum(x.astype(int) for x in around(support & moving, False))
        seeds = valid & (core * sign >= core_at) & support & (same >= 5) & ((a["probability"] >= 0.52) | (odd >= odd_at))
        allowed = moving & (density >= 0.08) & (tcoh >= 0.48) & ((ps >= 0.32) | (density >= 0.18)) & ((a["probability"] >= 0.32) | (odd >= odd_at * 0.75))
        want[sign] = settled(spread(seeds, allowed)) & valid if seeds.any() and allowed.any() else np.zeros_like(valid)
    got = {(r["sign"], r["row"], r["col"]) for r in masks.region_grow(found, probability, limits=lim).collect()}
    assert got == {(s, int(r), int(c)) for s, m in want.items() for r, c in zip(*np.nonzero(m), strict=True)} and got


def test_settled_bits_equal_single_masks(spark):
    rng = np.random.default_rng(3)
    layers = [rng.random((14, 17)) < p for p in (0.55, 0.7, 0.8)]
    rows = [(i, j, *[bool(m[i, j]) for m in layers]) for i in range(14) for j in range(17)]
    df = spark.createDataFrame(rows, "row int, col int, a boolean, b boolean, c boolean")
    got = {(r["row"], r["col"]): r["bits"] for r in masks.settled(masks.layered(df, [F.col(c) for c in "abc"])).collect()}
    for k, m in enumerate(layers):
        want = dilated(eroded(eroded(dilated(m, 2), 2), 1), 1)
        assert {c for c, b in got.items() if b >> k & 1} == {(int(i), int(j)) for i, j in zip(*np.nonzero(want), strict=True)}


def _profile(series):
    s = np.sort(series, 0)
    cut = int(len(s) * 0.2)
    centre = s[cut : len(s) - cut].mean(0)
    d = np.diff(centre)
    loud, net = d[np.abs(d) > 0.25], centre[-1] - centre[0]
    path = np.abs(loud).sum() if len(loud) else abs(net)
    same = (np.sign(loud) == np.sign(net)).mean() if len(loud) else 1.0
    return net, 0.5 * abs(net) / max(path, 1e-3) + 0.5 * same


@pytest.mark.parametrize("value", ["velocity", "pc1"])
def test_principal_mask(spark, field, value):
    a, valid, found, probability = field
    rng = np.random.default_rng(1)
    t = np.arange(12)
    cube = a["velocity"][..., None] * t / 10 + rng.normal(size=(H, W, 12))
    cube -= cube[..., :1]
    obs = spark.createDataFrame([(int(i * W + j), int(i), int(j), int(k), float(cube[i, j, k])) for i, j in zip(*np.nonzero(valid), strict=True) for k in t], "point_id long, row int, col int, epoch_idx int, value_mm double")
    raster = a["velocity"]
    if value == "pc1":  # the first component of the series in place of the velocity
        packed = obs.groupBy("point_id").agg(F.sort_array(F.collect_list(F.struct("epoch_idx", "value_mm"))).alias("x")).select("point_id", F.transform("x", lambda x: x["value_mm"]).alias("values"))
        scores = choices.series_components(packed, 1)[0]
        found = found.join(scores.select((F.col("point_id") / W).cast("int").alias("row"), (F.col("point_id") % W).cast("int").alias("col"), "pc1"), ["row", "col"])
        raster = np.zeros((H, W))
        for r in found.collect():
            raster[r["row"], r["col"]] = r["pc1"]
    lim = {"base": 2.0, "pixels": 8, "net": 1.0, "continuity": 0.2, "most": 3, "series": 5}
    support = ((a["strict"] > 0.5) | (a["relaxed"] > 0.5)) & valid
    mean = lambda x, n: box(x, valid, n)
    core, density, tcoh, p = mean(raster, 15), mean(support.astype(float), 9), mean(a["tcoh"], 9), mean(a["probability"], 9)
    base = max(np.percentile(np.abs(core[support]), 90), 2.0)
    rated = []
    for sign in (1, -1):
        for level, (share, floor) in enumerate(masks.LEVELS):
            m = settled(valid & (core * sign >= max(base * share, floor)) & (density >= 0.05) & (tcoh >= 0.45) & (p >= 0.18)) & valid
            for part in parts(m):
                if part.sum() < 8 or part.sum() * 0.01 < 0.8 * 0.05:
                    continue
                own = part & support if (part & support).sum() >= 5 else part
                net, continuity = _profile(cube[own])
                if abs(net) >= 1.0 and continuity >= 0.2:
                    score = part.sum() * 0.01 * max(abs(np.median(a["velocity"][part])), 1) * max(abs(net), 1) * max(continuity, 0.05) * max(a["probability"][part].mean(), 0.1)
                    rated.append((score, (0 if sign > 0 else 3) + level, part))
    kept = []
    for score, layer, part in sorted(rated, key=lambda x: -x[0]):
        if all((part & q).sum() / (part | q).sum() <= 0.15 for _, _, q in kept):
            kept.append((score, layer, part))
    kept = kept[:3]
    cells, best = masks.principal_mask(masks.principal_candidates(found, probability, value=value, limits=lim), obs, found.select("row", "col", F.lit(0.01).alias("area_km2")), 0.05, limits=lim)
    want = np.any([q for *_, q in kept], 0)
    assert {(r["row"], r["col"]) for r in cells.collect()} == {(int(i), int(j)) for i, j in zip(*np.nonzero(want), strict=True)} and kept
    assert [round(r["score"], 6) for r in best.orderBy(F.desc("score")).collect()] == [round(float(s), 6) for s, *_ in kept]


def _grown(z, seeds, c, taken):
    """One zone after another, on arrays."""
    net_min, vel_min = max(10.0, 0.4 * abs(z["net_mm"])), max(8.0, 0.5 * z["median_abs_velocity"])
    corr_min, coh_min, peak_min = max(0.90, z["internal_corr"] - 0.08), max(0.45, z["temporal_coherence"] - 0.08), max(10.0, 0.35 * z["activity"])
    centre = z["trace"] - z["trace"].mean()
    d = c["cube"] - c["cube"].mean(-1, keepdims=True)
    corr = (d @ centre) / np.maximum(np.linalg.norm(d, axis=-1) * np.linalg.norm(centre), 1e-12)
    s = -1 if z["zone_type"] == "subsidence" else 1
    signed = lambda n, v: (s * c["net"] >= n) | (s * c["velocity"] >= v)
    free = ~taken
    active = free & signed(net_min, vel_min) & (c["peak"] >= peak_min) & (corr >= corr_min) & (c["coh"] >= coh_min)
    bridge = free & signed(0.75 * net_min, 0.8 * vel_min) & (c["peak"] >= 0.7 * peak_min) & (corr >= max(0.86, corr_min - 0.05)) & (c["coh"] >= max(0.40, coh_min - 0.05))
    grown = spread(seeds, active)
    grown = spread(grown, bridge)
    grown = filled(eroded(dilated(grown, 2), 2)) & free
    if not grown.any():
        grown = seeds & free
    small = z["zone_type"] == "subsidence" and z["area_km2"] < 1.0
    radius, strong_min = (6.0, max(0.97, corr_min + 0.05)) if small else (1.5, max(0.95, corr_min + 0.03))
    strong = free & signed(net_min, vel_min) & (c["peak"] >= 0.8 * peak_min) & (corr >= strong_min) & (c["coh"] >= coh_min) & ~grown
    near = np.array([[np.hypot(c["x"][grown] - c["x"][i, j], c["y"][grown] - c["y"][i, j]).min(initial=np.inf) <= radius for j in range(W)] for i in range(H)])
    return grown | strong & near


def test_grown_zones_compete(spark):
    """Four zones, two of them for the same ground, one of them around another; as if grown one after another."""
    rng = np.random.default_rng(11)
    r, c = np.mgrid[0:H, 0:W]
    t = np.arange(10)
    even, late = t / 9, np.maximum(t - 6, 0) / 3
    one, two, three = 30 * np.exp(-((r - 6) ** 2 + (c - 7) ** 2) / 30), 30 * np.exp(-((r - 9) ** 2 + (c - 14) ** 2) / 26), -34 * np.exp(-((r - 12) ** 2 + (c - 22) ** 2) / 12)
    rate = one + two + three
    cube = (one + three)[..., None] * even + two[..., None] * late + 0.6 * rng.normal(size=(H, W, 10))
    cube -= cube[..., :1]
    lat, lon = 30 + r * 0.004, 103 + c * 0.004
    obs = spark.createDataFrame([(int(i * W + j), int(k), float(cube[i, j, k])) for i in range(H) for j in range(W) for k in t], "point_id long, epoch_idx int, value_mm double")
    grid = spark.createDataFrame([(i, j, i * W + j, float(lat[i, j]), float(lon[i, j]), float(rate[i, j])) for i in range(H) for j in range(W)], "row int, col int, point_id long, lat double, lon double, velocity double")
    cells = masks.growth_cells(grid, obs)
    figures = {(x["row"], x["col"]): x for x in cells.collect()}
    at = {n: np.array([[figures[i, j][k] for j in range(W)] for i in range(H)]) for n, k in (("net", "net"), ("peak", "peak"), ("coh", "temporal_coherence"), ("x", "x_km"), ("y", "y_km"))} | {"velocity": rate, "cube": cube}
    assert np.allclose(at["net"], cube[..., -1]) and np.allclose(at["peak"], np.abs(cube).max(-1))
    starts = {1: [(6, 7), (6, 8)], 2: [(7, 9), (7, 10)], 3: [(9, 14), (8, 14)], 4: [(12, 22)]}
    zones = {z: {"zone_type": "subsidence" if z == 4 else "uplift", "internal_corr": 0.9, "temporal_coherence": 0.5, "activity": 14.0, "net_mm": 12.0, "median_abs_velocity": 8.0, "area_km2": 0.5, "trace": np.mean([cube[p] for p in starts[z]], 0)} for z in starts}
    records = spark.createDataFrame([(z, v["zone_type"], 0.9, 0.5, 14.0, 12.0, 8.0, 0.5, [float(x) for x in v["trace"]]) for z, v in zones.items()], "zone int, zone_type string, internal_corr double, temporal_coherence double, activity double, net_mm double, median_abs_velocity double, area_km2 double, trace array<double>")
    seeds = spark.createDataFrame([(z, *p) for z, ps in starts.items() for p in ps], "zone int, row int, col int")
    got, rounds = masks.expand_zones(records, seeds, cells, grid)
    taken, want = np.zeros((H, W), bool), set()
    for z in sorted(zones):
        own = np.zeros((H, W), bool)
        own[tuple(zip(*starts[z], strict=True))] = True
        m = _grown(zones[z], own, at, taken)
        taken |= m
        want |= {(z, int(i), int(j)) for i, j in zip(*np.nonzero(m), strict=True)}
    assert {tuple(x) for x in got.collect()} == want and len({z for z, *_ in want}) >= 3
    assert 2 <= rounds <= 4


def test_display_grid(spark):
    """Nearest value within three steps; ties to the smaller id; nodes that nothing reaches stay empty."""
    rng = random.Random(4)
    rows = [(i, 103 + rng.randrange(40) * 0.0006, 30 + rng.randrange(30) * 0.0006, float(i), None) for i in range(60)] + [(99, 103.001, 30.001, None, None), (100, None, 30.0, 5.0, None)]
    df = spark.createDataFrame(rows, "point_id long, lon double, lat double, v double, step int")
    f = display.frame(df.where("v IS NOT NULL AND lon IS NOT NULL"), 50).first()
    got = {(r["i"], r["j"]): r["value"] for r in display.display_grid(df, "v", target_cols=50).collect()}
    assert len(got) == f.n_rows * f.n_cols
    for (i, j), v in got.items():
        near = min((round(((x - f.west) / f.step - j) ** 2 + ((f.north - y) / f.step - i) ** 2, 12), k) for k, x, y, val, _ in rows if val is not None and x is not None)
        assert v == (float(near[1]) if near[0] <= 9 else None)
    assert None in got.values() and display.display_grid(df.where("false"), "v").count() == 0


def test_display_points_are_dealt_out_before_their_nodes(spark):
    """A file of points is one task: it may not hold what 29 nodes a point get."""
    df = spark.range(0, 4000, 1, 1).selectExpr("id AS point_id", "103 + (id % 300) * 0.001D AS lon", "30 + (id div 300) * 0.001D AS lat", "id * 1.0D AS v")
    nodes = display.display_grid(df, "v", target_cols=50)
    plan = nodes._jdf.queryExecution().sparkPlan().toString()
    # one exchange deals out the nodes, one the points; the points meet their nodes and are summed above theirs only
    parts = plan.split("REPARTITION_BY_NUM")
    assert len(parts) == 3 and "SortAggregate" in parts[1] and "Aggregate" not in parts[2].split("BroadcastNestedLoopJoin")[0]
    f = display.frame(df, 50).first()
    got = {(r["i"], r["j"]): r["value"] for r in nodes.collect()}
    assert f.n_cols > 3 * display.BLOCK and len(got) == f.n_rows * f.n_cols
    x, y, v = (np.array(c, float) for c in zip(*[((r.lon - f.west) / f.step, (f.north - r.lat) / f.step, r.v) for r in df.collect()], strict=True))
    for (i, j), value in got.items():
        d = np.round((x - j) ** 2 + (y - i) ** 2, 12)
        assert value == (v[d == d.min()].min() if d.min() <= 9 else None)
