"""Registered queries of the forecast chain, with DuckDB twins where SQL can express them."""

from __future__ import annotations

from pyspark.sql import functions as F

from terrapulse.catalogue import _DELTA, _SCORE, _XY, _scored_points, register
from terrapulse.operators import feedback, fits, forecasts, neighbours, panel, series
from terrapulse.session import materialise

#: Channels that need no fit and no neighbours.
OWN = ("rel0", "delta", "gap_days", "sin_year", "cos_year", "delta2", "velocity", "abnormal")

_CHANNELS = (
    _DELTA
    + """, m AS (SELECT epoch_idx, median(abs(delta)) AS m FROM d WHERE delta IS NOT NULL GROUP BY epoch_idx),
 l AS (SELECT epoch_idx FROM m WHERE m > (SELECT quantile_cont(m, 0.8) FROM m)),
 r AS (SELECT point_id, epoch_idx, date, CAST(day_offset AS DOUBLE) AS day_offset,
  value_mm - first_value(value_mm) OVER (PARTITION BY point_id ORDER BY epoch_idx) AS rel0 FROM obs),
 g AS (SELECT epoch_idx, CAST(coalesce(day_offset - lag(day_offset) OVER (ORDER BY epoch_idx), 0) AS DOUBLE) AS gap_days FROM epoch),
 o AS (SELECT r.point_id, r.epoch_idx, CAST(dayofyear(r.date) AS DOUBLE) AS doy, r.day_offset, r.rel0, r.rel0 - b.rel0 AS step,
  coalesce((r.rel0 - s.rel0) / (r.day_offset - s.day_offset) * 365.25::DOUBLE, 0) AS velocity
  FROM r LEFT JOIN r b ON b.point_id = r.point_id AND b.epoch_idx = r.epoch_idx - 1
  LEFT JOIN r s ON s.point_id = r.point_id AND s.epoch_idx = greatest(r.epoch_idx - 2, 0) AND s.epoch_idx < r.epoch_idx),
 c AS (SELECT o.*, coalesce(o.step, 0) AS delta, coalesce(o.step - b.step, 0) AS delta2, gap_days,
  sin(2 * pi() * o.doy / 365.25::DOUBLE) AS sin_year, cos(2 * pi() * o.doy / 365.25::DOUBLE) AS cos_year,
  CAST(o.epoch_idx IN (SELECT epoch_idx FROM l) AS DOUBLE) AS abnormal
  FROM o LEFT JOIN o b ON b.point_id = o.point_id AND b.epoch_idx = o.epoch_idx - 1 JOIN g ON g.epoch_idx = o.epoch_idx)"""
)
_ENDS = """en AS (SELECT count(*) - 14 AS n, greatest(1, floor((count(*) - 14) * 0.7::DOUBLE)) AS tr, floor((count(*) - 14) * 0.85::DOUBLE) AS va FROM epoch),
 ends AS (SELECT epoch_idx, CASE WHEN epoch_idx - 11 < tr THEN 'train' WHEN epoch_idx - 11 < least(n - 1, greatest(tr + 1, va)) THEN 'val' ELSE 'test' END AS split
  FROM epoch, en WHERE epoch_idx >= 11 AND epoch_idx - 11 < n)"""
_WINDOWS = f"""{_CHANNELS}, {_ENDS},
 w AS (SELECT z.point_id, z.epoch_idx AS window_end, ends.split, z.rel0 AS last_rel0 FROM (SELECT *, count(*) OVER (PARTITION BY point_id
  ORDER BY epoch_idx RANGE BETWEEN 11 PRECEDING AND 3 FOLLOWING) AS n FROM c) z JOIN ends ON ends.epoch_idx = z.epoch_idx WHERE n = 15),
 h AS (SELECT w.*, c.epoch_idx, c.doy, c.day_offset, c.rel0, c.delta FROM w JOIN c ON c.point_id = w.point_id AND c.epoch_idx BETWEEN window_end - 11 AND window_end),
 t AS (SELECT w.*, c.epoch_idx - window_end AS h, c.doy AS to_doy, c.rel0 - last_rel0 AS target, c.abnormal
  FROM w JOIN c ON c.point_id = w.point_id AND c.epoch_idx BETWEEN window_end + 1 AND window_end + 3)"""
_USABLE = f"""{_ENDS}, n AS (SELECT point_id, count(*) OVER (PARTITION BY point_id ORDER BY epoch_idx RANGE BETWEEN 11 PRECEDING AND 3 FOLLOWING) AS n FROM obs),
 v AS (SELECT point_id, count(*) AS windows FROM n WHERE n = 15 GROUP BY point_id), {_SCORE},
 u AS (SELECT s.point_id, windows, ps_score >= 0.75 AS strict, s.col % 2 = 0 AS in_zone FROM s JOIN v ON v.point_id = s.point_id WHERE ps_score >= 0.6),
 k AS (SELECT greatest(1, count(*) FILTER (split = 'train')) AS a, greatest(1, count(*) FILTER (split = 'val')) AS b, greatest(1, count(*) FILTER (split = 'test')) AS c FROM ends)"""


def _counts(where: str) -> str:
    part = lambda kind, f: f"count(*) {f} AS {kind}_points, coalesce(sum(windows) {f}, 0) AS {kind}_windows"
    return f"(SELECT {part('s', 'FILTER (strict)')}, {part('x', 'FILTER (true)')} FROM u WHERE {where})"


def _choice(where: str, points: int, train: int, val: int) -> str:
    share = lambda kind, s: f"CAST(round_even({kind}_windows * {s} / CAST(a + b + c AS DOUBLE), 0) AS BIGINT)"
    enough = lambda kind: f"{kind}_points >= {points} AND {share(kind, 'a')} >= {train} AND {share(kind, 'b')} >= {val}"
    either = lambda x, y: f"CASE WHEN {enough('s')} THEN {x} ELSE {y} END"
    return (
        f"(SELECT CASE WHEN {enough('s')} THEN 'strict_only' WHEN {enough('x')} THEN 'strict_plus_relaxed' ELSE 'fallback_baseline_only' END AS mode, "
        f"{either('s_points', 'x_points')} AS points, {either(share('s', 'a'), share('x', 'a'))} AS train_windows, {either(share('s', 'b'), share('x', 'b'))} AS val_windows FROM {_counts(where)}, k)"
    )


def _own(epochs, obs):
    return panel.own_channels(panel.from_first(obs), epochs, series.loud_epochs(obs))


def _ends(epochs):
    return series.split_ends(epochs, 12, 3)


def _windows(epochs, obs, channels=("rel0", "delta")):
    return panel.windows(_own(epochs, obs), _ends(epochs), 12, 3, channels)


def _usable(points, obs):
    scored = _scored_points(points).select("point_id", "point_class", (F.col("col") % 2 == 0).alias("in_zone"))
    return scored.join(series.complete_windows(obs, 12, 3), "point_id")


@register("fc01_own_channels", ("epoch", "obs"), _CHANNELS + " SELECT point_id, epoch_idx, " + ", ".join(f"round({c}, 4) + 0.0 AS {c}" for c in OWN) + " FROM c")
def fc01_own(epochs, obs):
    return _own(epochs, obs).select("point_id", "epoch_idx", *[(F.round(c, 4) + 0.0).alias(c) for c in OWN])


def _panel(epochs, points, obs):
    rel = panel.from_first(obs)
    flagged = series.loud_epochs(obs)
    near = neighbours.summaries(neighbours.nearest(points, 8, cell=150.0), series.steps(rel))
    return panel.panel(panel.own_channels(rel, epochs, flagged), fits.robust_harmonic(rel), near, series.persistence(obs, flagged))


@register("fc01_panel", ("epoch", "point", "obs"), None, kept=("epoch", "obs"))
def fc01(epochs, points, obs):
    return _panel(epochs, points, obs)


@register("fc02_selection", ("epoch", "point", "obs"), _USABLE + " SELECT * FROM " + _choice("true", 3, 60, 12))
def fc02(epochs, points, obs):
    return panel.selection(_usable(points, obs), _ends(epochs), min_points=3, min_train=60, min_val=12)


@register(
    "fc03_zone_scope",
    ("epoch", "point", "obs"),
    _USABLE
    + f", f AS (SELECT count(*) FILTER (s.col % 2 = 0) AS n_in, (SELECT count(*) FROM u WHERE in_zone) AS n_ok FROM s JOIN (SELECT DISTINCT point_id FROM obs) USING (point_id)), i AS {_choice('in_zone', 3, 60, 12)}, j AS {_choice('true', 3, 60, 12)}, "
    "y AS (SELECT n_ok > 0 AND i.mode <> 'fallback_baseline_only' AS good, n_in, n_ok FROM f, i) SELECT CASE WHEN good THEN 'zone_high_confidence_only' ELSE 'all_high_confidence' END AS scope, "
    "CASE WHEN good THEN '' WHEN n_in = 0 THEN 'zone_mask_empty' WHEN n_ok = 0 THEN 'zone_points_without_complete_windows' ELSE 'zone_points_insufficient_for_training' END AS reason, "
    "q.* FROM y, (SELECT true AS inside, * FROM i UNION ALL SELECT false, * FROM j) z, LATERAL (SELECT z.mode, z.points, z.train_windows, z.val_windows) q WHERE z.inside = good",
)
def fc03(epochs, points, obs):
    return panel.zone_scope(_usable(points, obs), _ends(epochs), min_points=3, min_train=60, min_val=12)


@register(
    "fc04_windows",
    ("epoch", "obs"),
    _WINDOWS + ", hs AS (SELECT point_id, window_end, count(*) AS n, round(sum(rel0), 3) AS total, min(epoch_idx) AS first_epoch FROM h GROUP BY ALL), ts AS (SELECT point_id, window_end, split, round(sum(target * h), 3) AS targets, max(abnormal) > 0.5 AS event FROM t GROUP BY ALL) SELECT * FROM hs JOIN ts USING (point_id, window_end)",
)
def fc04_windows(epochs, obs):
    total = F.aggregate("history", F.lit(0.0), lambda a, x: a + x["rel0"])
    weighted = F.aggregate(F.transform("targets", lambda y, i: y * (i + 1)), F.lit(0.0), lambda a, x: a + x)
    return _windows(epochs, obs).select(
        "point_id", "window_end", F.size("history").cast("long").alias("n"), F.round(total, 3).alias("total"), F.get("history", 0)["epoch_idx"].alias("first_epoch"),
        "split", F.round(weighted, 3).alias("targets"), "event",
    )


@register(
    "fc05_latest_windows",
    ("epoch", "obs"),
    _CHANNELS + " SELECT point_id, CAST(max(epoch_idx) AS INTEGER) AS window_end, round(arg_max(rel0, epoch_idx), 4) AS last_rel0, round(sum(rel0), 3) AS total, CAST(3 AS INTEGER) AS steps FROM c WHERE epoch_idx > (SELECT max(epoch_idx) - 12 FROM epoch) GROUP BY point_id HAVING count(*) = 12",
)
def fc05(epochs, obs):
    found = panel.latest_windows(_own(epochs, obs), epochs, series.future_dates(epochs, 3), 12, ("rel0",))
    total = F.aggregate("history", F.lit(0.0), lambda a, x: a + x["rel0"])
    return found.select("point_id", "window_end", F.round("last_rel0", 4).alias("last_rel0"), F.round(total, 3).alias("total"), F.size("ahead").alias("steps"))


@register(
    "fc06_neighbour_windows",
    ("epoch", "point", "obs"),
    _WINDOWS + ", " + _XY + " SELECT w.point_id, w.window_end, count(*) AS near, round(sum(b.last_rel0), 3) AS near_last FROM w JOIN e ON src = w.point_id AND dist_m <= 230 JOIN w b ON b.point_id = dst AND b.window_end = w.window_end GROUP BY ALL",
)
def fc06(epochs, points, obs):
    found = _windows(epochs, obs)
    met = panel.neighbour_windows(found, neighbours.within_radius(points, 230.0), found)
    return met.groupBy("point_id", "window_end").agg(F.count(F.lit(1)).alias("near"), F.round(F.sum(F.element_at("near_history", -1)["rel0"]), 3).alias("near_last"))


_NORM = "st AS (SELECT avg(rel0) AS mean_rel0, avg(delta) AS mean_delta, stddev_pop(rel0) AS std_rel0, stddev_pop(delta) AS std_delta FROM h WHERE split = 'train'), sc AS (SELECT greatest(1, quantile_cont(abs(target), 0.95)) AS target_scale FROM t WHERE split = 'train')"


@register("fc07_normaliser", ("epoch", "obs"), f"{_WINDOWS}, {_NORM} SELECT round(mean_rel0, 5) AS mean_rel0, round(mean_delta, 5) AS mean_delta, round(std_rel0, 5) AS std_rel0, round(std_delta, 5) AS std_delta, round(target_scale, 5) AS target_scale FROM st, sc")
def fc07(epochs, obs):
    stats = panel.normaliser(_windows(epochs, obs).where("split = 'train'"), ("rel0", "delta"))
    return stats.select(*[F.round(c, 5).alias(c) for c in stats.columns])


@register(
    "fc08_normalised",
    ("epoch", "obs"),
    f"{_WINDOWS}, {_NORM}, a AS (SELECT point_id, window_end, round(sum((rel0 - mean_rel0) / std_rel0), 4) AS total FROM h, st GROUP BY ALL), b AS (SELECT point_id, window_end, round(sum(target / target_scale), 4) AS targets FROM t, sc GROUP BY ALL) SELECT * FROM a JOIN b USING (point_id, window_end)",
)
def fc08(epochs, obs):
    found = _windows(epochs, obs)
    scaled = panel.normalised(found, panel.normaliser(found.where("split = 'train'"), ("rel0", "delta")), ("rel0", "delta"))
    total = F.aggregate("history", F.lit(0.0), lambda a, x: a + x["rel0"])
    return scaled.select("point_id", "window_end", F.round(total, 4).alias("total"), F.round(F.aggregate("targets", F.lit(0.0), lambda a, x: a + x), 4).alias("targets"))


@register(
    "fc11_seasonal_naive",
    ("epoch", "obs"),
    _WINDOWS
    + """, sp AS (SELECT point_id, window_end FROM h GROUP BY ALL HAVING max(day_offset) - min(day_offset) >= 180),
 x AS (SELECT t.point_id, t.window_end, t.h, t.target, least(abs(h.doy - to_doy), 365.25 - abs(h.doy - to_doy)) AS apart, h.epoch_idx, h.rel0 - t.last_rel0 AS p50
  FROM t JOIN sp ON sp.point_id = t.point_id AND sp.window_end = t.window_end JOIN h ON h.point_id = t.point_id AND h.window_end = t.window_end),
 y AS (SELECT * FROM x QUALIFY row_number() OVER (PARTITION BY point_id, window_end, h ORDER BY apart, epoch_idx) = 1)
 SELECT point_id, window_end, CAST(h AS INTEGER) AS h, round(p50, 4) AS p50 FROM (SELECT *, max(apart) OVER (PARTITION BY point_id, window_end) AS far FROM y) WHERE far <= 45""",
)
def fc11(epochs, obs):
    found = panel.seasonal_naive(_windows(epochs, obs))
    return found.select("point_id", "window_end", F.posexplode("p50").alias("i", "p")).select("point_id", "window_end", (F.col("i") + 1).alias("h"), F.round("p", 4).alias("p50"))


def _predicted(epochs, obs):
    return materialise(panel.predictions(materialise(_windows(epochs, obs, ("rel0",)))))


@register("fc12_harmonic", ("epoch", "obs"), None)
def fc12(epochs, obs):
    return panel.harmonic(_windows(epochs, obs, ("rel0",)))


@register("fc14_quantile_loss", ("epoch", "obs"), None, kept=("epoch", "obs"))
def fc14(epochs, obs):
    return forecasts.quantile_loss(panel.tournament(_predicted(epochs, obs)))


@register("fc18_best_method", ("epoch", "obs"), None, kept=("epoch", "obs"))
def fc18(epochs, obs):
    predicted = _predicted(epochs, obs)
    return panel.best_method(forecasts.scores(panel.tournament(predicted, test="val")))


@register("fc23_tournament", ("epoch", "obs"), None, kept=("epoch", "obs"))
def fc23(epochs, obs):
    return panel.tournament(_predicted(epochs, obs))


@register("fc27_forecast", ("epoch", "point", "obs"), None, kept=("epoch", "obs"))
def fc27(epochs, points, obs):
    found = forecasts.bands(_predicted(epochs, obs).where("split = 'val'"))
    future = series.future_dates(epochs, 3)
    latest = materialise(panel.latest_windows(_own(epochs, obs), epochs, future, 12, ("rel0",)))
    exposure = feedback.anomaly_exposure(series.steps(obs), series.loud_epochs(obs)).select("point_id", "exposure")
    sure = _scored_points(points).select("point_id", "ps_score", "jump_risk").join(exposure, "point_id")
    return panel.forecast(panel.predictions(latest), found, future, sure)


@register("fc28_evaluation", ("epoch", "obs"), None, kept=("epoch", "obs"))
def fc28(epochs, obs):
    return panel.evaluation(panel.tournament(_predicted(epochs, obs)))
