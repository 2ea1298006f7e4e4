"""The feedback loop on planted bad dates: accepted, refused, cut off and resumed."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from terrapulse.operators import feedback, fits, passes

DATES = [f"2020{m:02d}{d:02d}" for m in range(1, 11) for d in (1, 16)]


def network(spark, bad, rng, bias=0.0):
    """Pairs of each date with the next three; all pairs of a bad date are off by 60 mm at most points."""
    n = 25
    rate = {p: 2.0 + 0.1 * p for p in range(n)}
    rows, pairs = [], []
    for i, a in enumerate(DATES):
        for j in range(i + 1, min(i + 4, len(DATES))):
            pairs.append((a, DATES[j], *((0.92, 0.1) if {i, j} & bad else (0.05, 0.0))))
            for p in range(n):
                off = 60.0 * ((j in bad) - (i in bad)) * (rng.random() < 0.8) if {i, j} & bad else 0.0
                drift = bias * (j % 2 - i % 2) if p == 0 else 0.0
                rows.append((p, a, DATES[j], float(rate[p] * (j - i) * 15 / 365.25 + off + drift + 0.3 * rng.normal())))
    obs = spark.createDataFrame(rows, "point_id long, date1 string, date2 string, value double")
    metrics = spark.createDataFrame([(a, b, 0.35 if r > 0.5 else 0.05, 0.9, 0.05, 3.0 + r) for a, b, r, _ in pairs], "date1 string, date2 string, bad_ratio double, main_cc_coverage double, unwrap_jump_index double, median_residual double")
    first = feedback.first_round(metrics.select("date1", "date2"), metrics)
    points = spark.createDataFrame([(p, p // 5, p % 5) for p in range(n)], "point_id long, row int, col int")
    patches = spark.createDataFrame([(1, 0), (1, 1), (1, 2), (2, 20), (2, 21), (2, 22)], "rank int, point_id long")
    return obs, first, points, patches


def test_bad_dates_are_left_out(spark, tmp_path):
    obs, first, points, patches = network(spark, {9}, np.random.default_rng(3))
    base = f"file://{tmp_path}/loop"
    assert passes.run(spark, base, obs, first, points, patches, stop_after="pass1") is None
    before = sorted(p.name for p in (tmp_path / "loop" / "pass1").iterdir())
    assert before == ["actions", "figures", "series"] and not (tmp_path / "loop" / "pass2").exists()
    stamp = (tmp_path / "loop" / "pass1" / "series" / "_SUCCESS").stat().st_mtime_ns
    got = {r["pass"]: r for r in passes.run(spark, base, obs, first, points, patches, jump_mm=15.0).collect()}
    assert (tmp_path / "loop" / "pass1" / "series" / "_SUCCESS").stat().st_mtime_ns == stamp  # read, not made again
    quality = spark.read.parquet(f"{base}/pass2/quality")
    cost = {(r.date1, r.date2): r.penalty for r in quality.collect()}
    assert all(cost[k] > min(cost.values()) for k in cost if DATES[9] in k)
    assert got["pass2"].kept_pairs <= got["pass1"].kept_pairs and got["pass1"].rank == 1
    assert got["pass1"].accepted != got["pass2"].accepted
    final = spark.read.parquet(f"{base}/final")
    assert {r.selected_round for r in final.select("selected_round").distinct().collect()} == {"round2" if got["pass2"].accepted else "round1"}
    again = {r["pass"]: r for r in passes.run(spark, base, obs, first, points, patches, jump_mm=15.0).collect()}
    assert again == got


@pytest.mark.parametrize("better", [True, False])
def test_verdict_decides(spark, tmp_path, better):
    """Figures of a second pass that is better or worse in one respect: taken or refused, and the final pairs follow."""
    obs, first, points, patches = network(spark, {4}, np.random.default_rng(5))
    base = f"file://{tmp_path}/loop"
    assert passes.run(spark, base, obs, first, points, patches, stop_after="pass2") is None
    one = spark.read.parquet(f"{base}/pass1/figures").collect()
    kind = spark.read.parquet(f"{base}/pass1/figures").schema
    changed = spark.createDataFrame(one, kind).withColumn("median_rms", F.col("median_rms") * (0.5 if better else 2.0))
    changed.write.mode("overwrite").parquet(f"{base}/pass2/figures")
    got = {r["pass"]: r for r in passes.run(spark, base, obs, first, points, patches).collect()}
    assert got["pass2"].accepted is better and got["pass1"].accepted is not better
    assert got["pass2"].reasons == ("" if better else "median_model_rms_degraded")
    assert {r.selected_round for r in spark.read.parquet(f"{base}/final").collect()} == {"round2" if better else "round1"}


def test_unsteady_reference_is_replaced(spark, tmp_path):
    """A point of candidate 1 swings by 60 mm from date to date: its patch jumps, the scene does not, so pass 2 takes candidate 2."""
    obs, first, points, patches = network(spark, set(), np.random.default_rng(7), bias=60.0)
    got = {r["pass"]: r for r in passes.run(spark, f"file://{tmp_path}/loop", obs, first, points, patches).collect()}
    assert got["pass1"].rank == 1 and got["pass2"].rank == 2 and got["pass2"].rank_reason == "reference_abnormal_fallback"
    series = spark.read.parquet(f"file://{tmp_path}/loop/pass2/series").where("point_id IN (20, 21, 22)")
    assert max(abs(r.m) for r in series.groupBy("epoch_idx").agg(F.avg("value_mm").alias("m")).collect()) < 1e-6


def test_values_are_solved_once_a_pass(spark):
    """The inversion was run for the reference and again for all points."""
    obs, first, _, patches = network(spark, set(), np.random.default_rng(3))
    acted = first.select("date1", "date2", F.col("action_round1").alias("action"), F.col("weight_round1").alias("weight"))
    moved = passes.network_series(obs, acted, patches.where("rank = 1").select("point_id"))
    assert "MapIn" not in moved._jdf.queryExecution().sparkPlan().toString()
    assert moved.count() == 25 * len(DATES)


def test_points_with_other_gaps_are_solved_apart(spark):
    """Keys of a batch that share their pairs are solved as one system, others not, and each gets its own solution."""
    true = {d: 0.5 * k * k for k, d in enumerate(DATES)}
    rows = [(p, DATES[i], DATES[j], (p + 1) * (true[DATES[j]] - true[DATES[i]])) for p in range(40) for i in range(20) for j in range(i + 1, min(i + 3, 20)) if p % 4 or 7 not in (i, j)]
    found = fits.inverted(spark.createDataFrame(rows, "point_id long, date1 string, date2 string, value double"), "point_id").collect()
    assert len(found) == 30 * 20 + 10 * 19
    assert all(abs(r.value - (r.point_id + 1) * true[r.date]) < 1e-8 for r in found)
