"""Fits without a SQL form, against planted series; the largest component of a neighbour graph."""

from datetime import date, timedelta

import numpy as np
from pyspark.sql import functions as F

from terrapulse.operators import fits, series, support

EPOCHS = 40


def series_of(spark, curves):
    days = np.arange(EPOCHS) * 12
    rng = np.random.default_rng(1)
    rows = [(k, i, int(d), float(f(d / 365.25)) + 0.05 * rng.standard_normal()) for k, f in enumerate(curves) for i, d in enumerate(days)]
    return spark.createDataFrame(rows, "point_id long, epoch_idx int, day_offset int, value_mm double")


def test_model_choice(spark):
    at = 12 * 12 / 365.25
    obs = series_of(spark, [lambda t: -20 * t, lambda t: -20 * t + 8 * np.sin(2 * np.pi * t), lambda t: 5 * t - 60 * np.maximum(t - at, 0)])
    got = {r.point_id: r for r in fits.chosen_model(obs).collect()}
    assert [got[k].model for k in range(3)] == ["linear", "linear_annual", "piecewise"] and got[2].break_idx == 12
    assert all(r.model_rms < 0.1 and len(r.fitted) == EPOCHS for r in got.values())
    assert fits.fitted_long(fits.chosen_model(obs)).count() == 3 * EPOCHS


def test_short_series(spark):
    obs = series_of(spark, [lambda t: 3 * t]).where("epoch_idx < 2")
    r = fits.chosen_model(obs).first()
    assert r.model == "linear" and r.break_idx == -1


def test_robust_harmonic(spark):
    spike = lambda t: 10 * t + 4 * np.cos(2 * np.pi * t) + 50 * (abs(t - 12 * 20 / 365.25) < 1e-9)
    rows = {r.epoch_idx: r for r in fits.robust_harmonic(series_of(spark, [spike])).collect()}
    t = np.arange(EPOCHS) * 12 / 365.25
    assert max(abs(rows[i].seasonal - 4 * np.cos(2 * np.pi * t[i])) for i in range(EPOCHS)) < 1.5 and rows[20].residual > 40
    early = fits.robust_harmonic(series_of(spark, [lambda t: 10 * t]), fit_until=30)
    assert abs({r.epoch_idx: r for r in early.collect()}[39].residual) < 1.0


def test_inversion_with_weights(spark):
    true = {"d0": 0.0, "d1": 3.0, "d2": -1.0, "d3": 4.0}
    names = list(true)
    pairs = [(1, a, b, true[b] - true[a], 1.0) for i, a in enumerate(names) for b in names[i + 1 :]]
    pairs += [(1, "d0", "d3", 99.0, 0.0), (1, "d1", "d2", None, 1.0)]
    df = spark.createDataFrame(pairs, "k long, date1 string, date2 string, value double, weight double")
    got = {r.date: r.value for r in fits.inverted(df, "k").collect()}
    assert all(abs(got[d] - v) < 1e-9 for d, v in true.items())
    moved = {r.date: r.value for r in fits.inverted(df, "k", reference="d2").collect()}
    assert all(abs(moved[d] - (v + 1.0)) < 1e-9 for d, v in true.items())


def test_largest_component(spark):
    points = spark.range(1, 8).withColumnRenamed("id", "point_id")
    edges = spark.createDataFrame([(1, 2), (2, 3), (5, 6)], "src long, dst long")
    seen = spark.createDataFrame([(1, 0, 1.0), (2, 0, 1.0)], "point_id long, epoch_idx int, mean_mm double")
    r = support.graph_statistics(edges, points, seen, 1).first()
    assert (r.nodes, round(r.mean_degree, 6), round(r.largest_share, 6), round(r.null_share, 6)) == (7, round(3 / 7, 6), round(3 / 7, 6), round(5 / 7, 6))


def _gappy(points=40, epochs=30):
    """Series with gaps of their own: lines, waves and bends, with and without noise."""
    rng = np.random.default_rng(0)
    rows = []
    for p in range(points):
        keep = np.sort(rng.choice(epochs, rng.integers(1, epochs + 1), replace=False))
        t = keep * 24 / 365.25
        y = 3 * t + (6 * np.sin(2 * np.pi * t) if p % 3 == 1 else 0) + (25 * np.maximum(t - 1, 0) if p % 3 == 2 else 0) + rng.normal(size=len(t)) * (0 if p % 10 == 0 else 0.7) + 100 * (p % 2)
        rows += [(p, int(i), date(2020, 1, 1) + timedelta(days=int(i) * 24), int(i) * 24, float(v)) for i, v in zip(keep, y, strict=True)]
    return rows


def _solved(x, y, w=None):
    root = np.sqrt(np.ones(len(y)) if w is None else w)
    fit = x @ np.linalg.lstsq(x * root[:, None], y * root, rcond=None)[0]
    return fit, ((y - fit) ** 2).sum()


def test_chosen_models_with_gaps_equal_single_fits(spark):
    rows = _gappy()
    df = spark.createDataFrame(rows + [(0, 99, date(2022, 1, 1), 731, None)], "point_id long, epoch_idx int, date date, day_offset int, value_mm double")
    got = {(r.point_id, r.epoch_idx): r for r in fits.model_fits(df).collect()}
    read = {(r.point_id, r.epoch_idx): r.v for r in df.join(fits.models(df), "point_id").select("point_id", "epoch_idx", fits.predicted(F.col("date")).alias("v")).collect()}
    assert len(got) == len(rows)
    for p in range(40):
        own = [r for r in rows if r[0] == p]
        t, y = np.array([r[3] for r in own]) / 365.25, np.array([r[4] for r in own])
        n, one = len(t), np.ones(len(t))
        bic = lambda sse, k, n=n: round(n * np.log(max(sse / n, 1e-6)) + k * np.log(n), 6)
        tried = [(0, -1, np.column_stack([one, t]), 2), (1, -1, np.column_stack([one, t, np.sin(2 * np.pi * t), np.cos(2 * np.pi * t)]), 4)]
        tried += [(2, b, np.column_stack([one, t, np.maximum(t - t[b], 0)]), 3) for b in range(3, max(4, n - 3))] if n >= 5 else []
        found = [(bic(_solved(x, y)[1], k), m, b, _solved(x, y)[0]) for m, b, x, k in tried]
        best = min(found, key=lambda f: f[:3])
        second = sorted(min(f[0] for f in found if f[1] == m) for m in {f[1] for f in found})[1]
        for r, fit in zip(own, best[3], strict=True):
            g = got[p, r[1]]
            assert (g.model, g.break_idx) == (fits.MODELS[best[1]], best[2]) and abs(g.fit - fit) < 1e-6 and abs(read[p, r[1]] - fit) < 1e-6
            assert abs(g.delta_bic - (second - best[0])) < 1e-4 and abs(g.res - (r[4] - fit)) < 1e-6


def test_robust_harmonic_with_gaps(spark):
    rows = [r for r in _gappy(30) if sum(q[0] == r[0] for q in _gappy(30)) > 6]
    df = spark.createDataFrame(rows, "point_id long, epoch_idx int, date date, day_offset int, value_mm double")
    got = {(r.point_id, r.epoch_idx): r for r in fits.robust_harmonic(df).collect()}
    for p in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == p]
        x, y = fits.design([r[3] for r in own]), np.array([r[4] for r in own])
        off = np.abs(y - _solved(x, y)[0])
        scale = np.median(off) if np.median(off) > 1e-3 else 1.0
        fit = _solved(x, y, 1 / np.maximum(1, off / (1.5 * scale)))[0]
        assert all(abs(got[p, r[1]].trend + got[p, r[1]].seasonal - f) < 1e-6 for r, f in zip(own, fit, strict=True))


def test_annual_motion_is_no_anomaly(spark):
    """Strong waves: residuals from a line would flag the dates at their crests; the chosen model leaves only the planted bad date."""
    rows = [(p, i, date(2020, 1, 1) + timedelta(days=24 * i), 24 * i, 40 * float(np.sin(2 * np.pi * 24 * i / 365.25)) + (60.0 if i == 17 else 0.0) + 0.1 * ((p * 7 + i * 3) % 5)) for p in range(12) for i in range(40)]
    df = spark.createDataFrame(rows, "point_id long, epoch_idx int, date date, day_offset int, value_mm double")
    found = series.flag_dates(series.date_quality(df, 28.0), quantile=1.0).where("flagged").collect()
    assert [r.date for r in found] == [date(2020, 1, 1) + timedelta(days=24 * 17)]


def test_least_squares_of_little(spark):
    df = spark.createDataFrame([(1, 0, date(2020, 1, 1), 0, 5.0), (2, 0, date(2020, 1, 1), 0, None)], "point_id long, epoch_idx int, date date, day_offset int, value_mm double")
    r = fits.least_squares(df, annual=True).collect()
    assert len(r) == 1 and r[0].coefficients == [5.0, 0.0, 0.0, 0.0] and r[0].sse == 0.0
    assert fits.model_fits(df).first().model == "linear" and fits.model_fits(df.where("false")).count() == 0


def test_regions_join_to_the_end(spark):
    """Region 2 is near region 1; region 3 only to what both are together; region 4 moves otherwise, region 5 is too far."""
    at = {1: (30.0, 103.0, 1), 2: (30.012, 103.0, 1), 3: (30.022, 103.0, 1), 4: (30.004, 103.0, -1), 5: (30.2, 103.0, 1)}
    points = [(z * 10 + i, lat, lon, s) for z, (lat, lon, s) in at.items() for i in range(4)]
    table = spark.createDataFrame(points, "point_id long, lat double, lon double, s int")
    values = spark.createDataFrame([(p, e, float(s * e + 0.01 * (p % 3))) for p, *_, s in points for e in range(8)], "point_id long, epoch_idx int, v double")
    members = table.select((F.col("point_id") / 10).cast("int").alias("zone"), "point_id")

    def summarise(m):
        records = m.join(table, "point_id").groupBy("zone").agg(F.avg("lat").alias("lat"), F.avg("lon").alias("lon"), F.lit("uplift").alias("zone_type"), (F.count(F.lit(1)) / 10.0).alias("region_score"))
        return records, m.join(values, "point_id").groupBy("zone", "epoch_idx").agg(F.avg("v").alias("v"))

    every = summarise(members)[0]
    kept, found, rounds = support.merged_to_end(every.where("zone = 1"), every.where("zone > 1"), members, summarise)
    groups = {}
    for r in found.collect():
        groups.setdefault(r.zone, set()).add(r.point_id // 10)
    assert groups == {1: {1, 2, 3}, 4: {4}, 5: {5}} and rounds == 2 and [r.zone for r in kept.collect()] == [1]
