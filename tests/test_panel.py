"""Windows, baselines, evaluation and seeds against plain Python."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from terrapulse.operators import feedback, forecasts, panel, seeds, series
from terrapulse.session import materialise

LOOKBACK, HORIZON, N = 6, 2, 40


@pytest.fixture(scope="module")
def planted(spark):
    """Two series of 40 epochs every 30 days, one with a gap; returns rows, frames and windows."""
    rows = []
    for p in (1, 2):
        for e in range(N):
            if (p, e) != (2, 20):
                rows.append((p, e, 30 * e, float(p * 0.02 * 30 * e + 5 * np.sin(2 * np.pi * 30 * e / 365.25) + ((e * 7 + p * 3) % 5) / 10)))
    start = F.to_date(F.lit("2020-01-01"))
    obs = spark.createDataFrame(rows, "point_id long, epoch_idx int, day_offset int, value_mm double").withColumn("date", F.date_add(start, F.col("day_offset")))
    epochs = spark.range(N).select(F.col("id").cast("int").alias("epoch_idx"), (F.col("id") * 30).cast("int").alias("day_offset")).withColumn("date", F.date_add(start, F.col("day_offset")))
    own = panel.own_channels(panel.from_first(obs), epochs, epochs.where("epoch_idx IN (12, 35)"))
    found = materialise(panel.windows(own, series.split_ends(epochs, LOOKBACK, HORIZON), LOOKBACK, HORIZON, ("rel0", "delta")))
    return {(p, e): v for p, e, _, v in rows}, own, found


def test_windows_are_whole_and_in_order(planted):
    values, _, found = planted
    got = {(r.point_id, r.window_end): r for r in found.collect()}
    want = {(p, e) for p in (1, 2) for e in range(LOOKBACK - 1, N - HORIZON) if all((p, x) in values for x in range(e - LOOKBACK + 1, e + HORIZON + 1))}
    assert set(got) == want
    for (p, e), r in got.items():
        assert [h.epoch_idx for h in r.history] == list(range(e - LOOKBACK + 1, e + 1))
        assert np.allclose(r.targets, [values[p, e + h] - values[p, e] for h in (1, 2)])
        assert r.event == any(x in (12, 35) for x in (e + 1, e + 2))


def test_steps_across_a_gap_are_zero(planted):
    got = {r.epoch_idx: r for r in planted[1].where("point_id = 2 AND epoch_idx IN (21, 22, 23)").collect()}
    assert got[21].delta == 0 and got[21].delta2 == 0 and got[22].delta != 0 and got[22].delta2 == 0 and got[22].velocity == 0 and got[23].velocity != 0


def test_baselines_equal_numpy(planted):
    values, _, found = planted
    got = {(r.method, r.point_id, r.window_end, r.h): r.p50 for r in panel.predictions(found).collect()}
    for p, e in {(k[1], k[2]) for k in got}:
        days = 30.0 * np.arange(e - LOOKBACK + 1, e + 1)
        y = np.array([values[p, x] for x in range(e - LOOKBACK + 1, e + 1)])
        line = np.polyfit(days, y, 1)
        row = lambda d: np.stack([np.ones_like(d), d / 365.25, np.sin(2 * np.pi * d / 365.25), np.cos(2 * np.pi * d / 365.25)], 1)
        beta = np.linalg.lstsq(row(days), y - values[p, 0], rcond=None)[0]
        for h in (1, 2):
            day = np.array([30.0 * (e + h)])
            assert got["persistence", p, e, h] == 0
            assert got["linear_trend", p, e, h] == pytest.approx(np.polyval(line, day[0]) - y[-1], abs=1e-6)
            assert got["harmonic_trend", p, e, h] == pytest.approx((row(day) @ beta)[0] - (y[-1] - values[p, 0]), abs=1e-6)


def test_seasonal_needs_a_span(planted):
    """Six epochs of 30 days span 150 days: too few for 180, enough for 100 with a day within 60."""
    found = planted[2]
    assert panel.seasonal_naive(found).isEmpty()
    near = panel.seasonal_naive(found, min_span=100.0, max_distance=61.0)
    assert near.count() == found.count()
    values = planted[0]
    for r in near.collect():
        assert r.p50[0] == pytest.approx(0.0) and r.targets[0] == pytest.approx(values[r.point_id, r.window_end + 1] - values[r.point_id, r.window_end])


def test_subsets_add_up_and_best_is_least(planted):
    predicted = materialise(panel.predictions(planted[2]))
    within = panel.tournament(predicted)
    assert {r.split for r in within.select("split").distinct().collect()} == {"test"}
    rows = within.select("method", "event", "p50", "target").collect()
    scored = {(r.method, r.subset): r.mae for r in panel.evaluation(within).where("h = 0").collect()}
    for (m, s), mae in scored.items():
        err = [abs(r.p50 - r.target) for r in rows if r.method == m and (s == "overall" or r.event == (s == "event_windows"))]
        assert mae == pytest.approx(np.mean(err))
    best = panel.best_method(forecasts.scores(within)).first()
    assert best.mae == min(v for (_, s), v in scored.items() if s == "overall")


def test_crossing_quantiles_cost(spark):
    rows = [("a", 0.0, 1.0, 0.0, 2.0), ("b", 0.0, 0.0, 1.0, 2.0)]
    got = {r.method: r.loss for r in forecasts.quantile_loss(spark.createDataFrame(rows, "method string, target double, p10 double, p50 double, p90 double")).collect()}
    assert got["a"] == pytest.approx((0.9 + 0 + 0.2) / 3 + 0.1) and got["b"] == pytest.approx((0 + 0.5 + 0.2) / 3)


def test_normaliser_handles_constants_and_bad_values(spark):
    df = spark.sql("SELECT array(named_struct('epoch_idx', 0, 'x', 1.0D, 'y', 3.0D), named_struct('epoch_idx', 1, 'x', 1.0D, 'y', double('NaN'))) AS history, array(0.5D) AS targets")
    stats = panel.normaliser(df.select(F.transform("history", lambda h: h.withField("y", F.lit(2.0))).alias("history"), "targets"), ("x", "y"))
    row = panel.normalised(df, stats, ("x", "y")).first()
    assert [(h.x, h.y) for h in row.history] == [(0.0, 1.0), (0.0, 0.0)] and row.targets == [0.5]


def test_empty_tables(spark, planted):
    none = planted[2].where("false")
    assert panel.predictions(none).isEmpty() and panel.evaluation(panel.tournament(panel.predictions(none))).isEmpty()
    points = spark.createDataFrame([], "point_id long, point_class string, windows long, in_zone boolean")
    ends = spark.createDataFrame([(1, "train")], "epoch_idx int, split string")
    row = panel.zone_scope(points, ends).first()
    assert (row.scope, row.reason, row["mode"], row.points) == ("all_high_confidence", "zone_mask_empty", "fallback_baseline_only", 0)


def test_overlap_is_the_lesser_date(spark):
    pairs = spark.createDataFrame([("a", "b"), ("a", "c"), ("c", "d")], "date1 string, date2 string")
    cover = spark.createDataFrame([("a", 0.5), ("b", 0.25)], "date string, coverage double")
    assert {(r.date1, r.date2): r.overlap for r in feedback.with_overlap(pairs, cover).collect()} == {("a", "b"): 0.25, ("a", "c"): 0.5, ("c", "d"): 1.0}


def test_near_any_equals_brute_force(spark):
    cells = [(i, j) for i in range(-7, 8) for j in range(-7, 8)]
    others = [(-6, -6), (0, 3), (5, -2), (0, 3)]
    found = seeds.near_any(spark.createDataFrame(cells, "row int, col int"), spark.createDataFrame(others, "row int, col int"), 3)
    assert {(r.row, r.col) for r in found.collect()} == {c for c in cells if any((c[0] - o[0]) ** 2 + (c[1] - o[1]) ** 2 <= 9 for o in others)}
