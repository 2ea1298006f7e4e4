"""Quantile forecasts: coverage on planted skewed noise, no crossing; neighbours are used where they help."""

import numpy as np
import pytest

from terrapulse.operators import forecasts, quantiles

SCHEMA = "point_id long, window_end int, split string, event boolean, last_rel0 double, targets array<double>, history array<struct<epoch_idx:int,rel0:double>>, s double"


def windows(spark, n, noise, seed=5, extra=None):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        a, s = rng.normal(size=3), float(rng.uniform(0, 2))
        y = [float(3 * a[-1] - a[0] + 2 * s + k + noise(rng, s) + (extra[i] if extra is not None else 0.0)) for k in range(2)]
        rows.append((i, 7, "train" if i < n // 2 else "val", False, float(a[-1]), y, [(j, float(a[j])) for j in range(3)], s))
    return spark.createDataFrame(rows, SCHEMA), rows


def test_coverage_on_skewed_noise(spark):
    """Noise with a long upper tail that widens with s: a mean and a fixed band would miss it."""
    found, rows = windows(spark, 4000, lambda rng, s: (0.5 + s) * rng.exponential(2.0))
    model = quantiles.QuantileForecaster(("rel0",), ("s",)).fit(found.where("split = 'train'"), 2)
    got = {r.point_id: r for r in model.predict(found).collect()}
    for half in (rows[:2000], rows[2000:]):
        for h in range(2):
            y = np.array([r[5][h] for r in half])
            for q, name in ((0.1, "p10"), (0.5, "p50"), (0.9, "p90")):
                share = (y <= np.array([got[r[0]][name][h] for r in half])).mean()
                assert abs(share - q) < (0.02 if half is rows[:2000] else 0.035)
    assert all(r.p10[h] <= r.p50[h] <= r.p90[h] for r in got.values() for h in range(2))
    # the band widens with s, and the middle lies under the mean
    wide = [np.mean([got[r[0]].p90[0] - got[r[0]].p10[0] for r in rows if lo <= r[7] < hi]) for lo, hi in ((0, 0.5), (1.5, 2))]
    assert wide[1] > 1.8 * wide[0]


def test_loss_is_least(spark):
    """No small step in any direction lowers the pinball loss by more than a thousandth."""
    found, rows = windows(spark, 600, lambda rng, s: rng.normal())
    model = quantiles.QuantileForecaster(("rel0",), ("s",), levels=(0.25,)).fit(found, 1)
    x = np.array([[*[v for _, v in r[6]], r[7]] for r in rows])
    y = np.array([r[5][0] for r in rows])
    loss = lambda b, c: np.mean(np.maximum(0.25 * (y - x @ b - c), -0.75 * (y - x @ b - c)))
    b, c = model.slopes[0, 0], model.cuts[0, 0]
    for k in range(5):
        for step in (-0.05, 0.05):
            assert loss(b + step * (np.arange(4) == k), c + step * (k == 4)) > loss(b, c) - 1e-3


def test_no_windows(spark):
    found, _ = windows(spark, 4, lambda rng, s: 0.0)
    with pytest.raises(ValueError, match="no window"):
        quantiles.QuantileForecaster(("rel0",)).fit(found.where("false"), 2)


@pytest.mark.parametrize("helps", [True, False])
def test_neighbours_are_taken_where_they_help(spark, helps):
    """Each point's target follows its neighbour's last value in one case and nothing of it in the other."""
    n = 600
    base, rows = windows(spark, n, lambda rng, s: 0.3 * rng.normal())
    last = [r[4] for r in rows]
    found, rows = windows(spark, n, lambda rng, s: 0.3 * rng.normal(), extra=[4 * last[i ^ 1] if helps else 0.0 for i in range(n)])
    edges = spark.createDataFrame([(i, i ^ 1) for i in range(n)], "src long, dst long")
    near = quantiles.with_neighbours(found, edges).cache()
    assert near.where("point_id = 4").first().near_mean == rows[5][4]
    train, val = near.where("split = 'train'"), near.where("split = 'val'")
    plain = quantiles.QuantileForecaster(("rel0",), ("s",)).fit(train, 2)
    more = quantiles.QuantileForecaster(("rel0",), ("s", *quantiles.NEAR)).fit(train, 2)
    a, b = quantiles.flat(plain.predict(val)), quantiles.flat(more.predict(val))
    r = quantiles.chosen_variant(a, b).first()
    assert r.variant == ("neighbours" if helps else "plain") and (r.near_rmse < 0.5 * r.plain_rmse) == helps
    kept = quantiles.chosen_variant(a, b, "mean_degree_below_threshold").first()
    assert kept.variant == "plain" and kept.reason == "mean_degree_below_threshold"


def test_examples(spark):
    """The two surest points, the smaller id of equals; history, a closed band at its end, and the steps ahead."""
    ahead = spark.createDataFrame([(p, h, 10.0 * p + h - 1, 10.0 * p + h, 10.0 * p + h + 1, c) for p, c in ((1, 0.5), (2, 0.9), (3, 0.5)) for h in (1, 2)], "point_id long, h int, rel0_p10 double, rel0_p50 double, rel0_p90 double, confidence double")
    rel = spark.createDataFrame([(p, e, float(p * e)) for p in (1, 2, 3) for e in range(4)], "point_id long, epoch_idx int, value_mm double")
    got = forecasts.examples(ahead, rel, 2).orderBy("sample", "epoch_idx", "h").collect()
    assert [(r["sample"], r.point_id) for r in got[:7]] == [(1, 2)] * 7 and [r.point_id for r in got[7:]] == [1] * 7
    assert [(r.epoch_idx, r.h, r.value, r.p10, r.p90) for r in got[:7]] == [(0, None, 0.0, None, None), (1, None, 2.0, None, None), (2, None, 4.0, None, None), (3, None, 6.0, None, None), (3, 0, 6.0, 6.0, 6.0), (4, 1, 21.0, 20.0, 22.0), (5, 2, 22.0, 21.0, 23.0)]
