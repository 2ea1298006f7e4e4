"""Fitted models on planted cells and windows."""

import numpy as np

from terrapulse.operators import learned, seeds


def test_forecaster_and_importance(spark):
    """The targets hang on channel a and static s; the fit equals least squares, b and t do not matter."""
    rng = np.random.default_rng(5)
    rows = []
    for i in range(300):
        a, b = rng.normal(size=4), rng.normal(size=4)
        s, t = rng.normal(size=2)
        y = [float(2 * a[-1] - a[0] + 3 * s + 1 + k + rng.normal() * 0.01) for k in range(2)]
        rows.append((i, 7, "train" if i < 200 else "val", False, 0.0, y, [(j, float(a[j]), float(b[j])) for j in range(4)], float(s), float(t)))
    found = spark.createDataFrame(rows, "point_id long, window_end int, split string, event boolean, last_rel0 double, targets array<double>, history array<struct<epoch_idx:int,a:double,b:double>>, s double, t double")
    model = learned.Forecaster("linear", ("a", "b"), ("s", "t")).fit(found.where("split = 'train'"), 2)
    val = found.where("split = 'val'")
    x = np.array([[1.0, *[v for h in r[6] for v in h[1:]], *r[7:]] for r in rows])
    y = np.array([r[5] for r in rows])
    want = x[200:] @ np.linalg.lstsq(x[:200], y[:200], rcond=None)[0]
    got = np.array([r.p50 for r in model.predict(val).orderBy("point_id").collect()])
    assert np.allclose(got, want, atol=1e-3)
    by_group = {r.name: r.importance for r in learned.group_importance(model, val, {"first": ("a",), "second": ("b",)}).collect()}
    zeroed = x[200:].copy()
    zeroed[:, [1, 3, 5, 7]] = 0
    beta = np.linalg.lstsq(x[:200], y[:200], rcond=None)[0]
    rmse = lambda p: float(np.sqrt(((p - y[200:]) ** 2).mean()))
    assert abs(by_group["first"] - (rmse(zeroed @ beta) - rmse(want))) < 1e-2 and by_group["second"] < 0.01
    by_static = {r.name: r.importance for r in learned.static_importance(model, val).collect()}
    assert by_static["s"] > 2 and by_static["t"] < 0.01


def _cells(spark, n):
    """Cells of the upper half move, those of the lower half rest."""
    names = [c for c in learned.FEATURES]
    rows = [(r, c, *[float((r < n // 2) * 3 + ((r * 31 + c * 17 + k * 7) % 10) / 10) for k in range(len(names))]) for r in range(n) for c in range(n)]
    return spark.createDataFrame(rows, "row int, col int, " + ", ".join(f"{c} double" for c in names))


def test_learned_probability(spark):
    found = _cells(spark, 12)
    marked = spark.createDataFrame([(r, c, int(r < 6)) for r in range(12) for c in range(12) if c % 3 == 0], "row int, col int, seed int")
    for rounds in (0, 1):
        got = {(r.row, r.col): r.probability for r in learned.learned_probability(found, marked, rounds=rounds, trees=3, depth=2).collect()}
        assert len(got) == 144 and all((p > 0.5) == (r < 6) for (r, _), p in got.items())
        assert all(got[r, c] >= 0.85 if r < 6 else got[r, c] <= 0.15 for r in range(12) for c in range(0, 12, 3))


def test_few_seeds_fall_back(spark):
    found = _cells(spark, 4)
    marked = spark.createDataFrame([(0, 0, 1), (3, 3, 0)], "row int, col int, seed int")
    rows = lambda df: sorted((r.row, r.col, round(r.probability, 9)) for r in df.collect())
    assert rows(learned.learned_probability(found, marked)) == rows(seeds.probability(found))
