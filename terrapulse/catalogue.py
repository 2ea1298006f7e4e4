
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrapulse.adapters import DUCK, view
from terrapulse.functions import scalars, stats
from terrapulse.operators import components, feedback, fits, forecasts, neighbours, pairs, rasters, series, zones
from terrapulse.session import materialise
from terrapulse.twins import MODEL, value_at

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def rounded(df: DataFrame) -> DataFrame:
    """Doubles to six places, so that both engines' sums compare."""
    return df.select(*[F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


def register(name: str, views: tuple[str, ...], sql: str | None, columns: str = "", *, recursive: bool = False, kept: tuple[str, ...] = ()):
    """``sql`` is the final SELECT (or more common table expressions and a SELECT) over the named views.

    The views ``kept`` are written once: a query of many jobs would sum up ``lineitem`` anew in each of them.
    """

    def wrap(f):
        QUERIES[name] = lambda spark, sf_dir: rounded(f(*[materialise(view(spark, sf_dir, v)) if v in kept else view(spark, sf_dir, v) for v in views]))
        if sql:
            needed = dict.fromkeys([*(["epoch"] if "obs" in views else []), *views])
            ORACLE_SQL[name] = ("WITH RECURSIVE " if recursive else "WITH ") + ",\n".join(f"{v} AS ({DUCK[v]})" for v in needed) + (",\n" if " AS (" in sql.split("SELECT")[0] else "\n") + sql
        return f

    return wrap


_OK = "(cc > 0 AND cc < 65535)"
_LOS = "abs(unw * 0.05546576::DOUBLE / (4 * pi()) * 1000)"
_METRICS = f"""m AS (SELECT date1, date2, coalesce(avg(coh) FILTER (coh > 0), 0) AS coh_mean, avg(CAST({_OK} AS INT)) AS valid_conncomp_frac,
 coalesce(quantile_cont({_LOS}, 0.95) FILTER ({_OK}), 0) AS pair_p95_abs_los_mm, coalesce(avg(CAST({_LOS} > 50 AS INT)) FILTER ({_OK}), 0) AS pair_frac_abs_los_gt_50mm FROM pair_pixel GROUP BY ALL),
c AS (SELECT date1, date2, count(*) AS n_conncomp, 1 - max(n) / sum(n) AS closure_risk_proxy FROM (SELECT date1, date2, cc, count(*) AS n FROM pair_pixel WHERE {_OK} GROUP BY ALL) GROUP BY ALL),
pm AS (SELECT m.*, coalesce(n_conncomp, 0) AS n_conncomp, coalesce(closure_risk_proxy, 1) AS closure_risk_proxy FROM m LEFT JOIN c USING (date1, date2)),
n AS (SELECT *, coalesce((n_conncomp - min(n_conncomp) OVER ()) / nullif(max(n_conncomp) OVER () - min(n_conncomp) OVER (), 0), 0) AS ncc, coalesce((pair_p95_abs_los_mm - min(pair_p95_abs_los_mm) OVER ()) / nullif(max(pair_p95_abs_los_mm) OVER () - min(pair_p95_abs_los_mm) OVER (), 0), 0) AS p95 FROM pm),
pr AS (SELECT * EXCLUDE (ncc, p95), 0.25 * (1 - least(1, coh_mean)) + 0.20 * (1 - valid_conncomp_frac) + 0.15 * ncc + 0.20 * p95 + 0.20 * pair_frac_abs_los_gt_50mm AS risk,
 CASE WHEN coh_mean < 0.45 OR valid_conncomp_frac < 0.65 OR pair_frac_abs_los_gt_50mm > 0.15 THEN 'drop' WHEN coh_mean >= 0.55 AND valid_conncomp_frac >= 0.85 AND pair_frac_abs_los_gt_50mm <= 0.05 THEN 'keep' ELSE 'downweight' END AS action FROM n),
p AS (SELECT *, CASE action WHEN 'keep' THEN 1.0 WHEN 'downweight' THEN 0.5 ELSE 0.0 END::DOUBLE AS pair_weight FROM pr)
"""
_PAIR = "date1, date2, n_conncomp, action, round(coh_mean, 6) AS coh_mean, round(valid_conncomp_frac, 6) AS valid_conncomp_frac, round(pair_p95_abs_los_mm, 6) AS pair_p95_abs_los_mm, round(pair_frac_abs_los_gt_50mm, 6) AS pair_frac_abs_los_gt_50mm, round(closure_risk_proxy, 6) AS closure_risk_proxy, round(risk, 6) AS risk, pair_weight"


@register("a01_pair_metrics", ("pair_pixel",), _METRICS + "SELECT date1, date2, n_conncomp, round(coh_mean, 6) AS coh_mean, round(valid_conncomp_frac, 6) AS valid_conncomp_frac, round(pair_p95_abs_los_mm, 6) AS pair_p95_abs_los_mm, round(pair_frac_abs_los_gt_50mm, 6) AS pair_frac_abs_los_gt_50mm, round(closure_risk_proxy, 6) AS closure_risk_proxy FROM pm")
def a01(pixels):
    return pairs.metrics(pixels)


@register("a02_pair_risk", ("pair_pixel",), _METRICS + f"SELECT {_PAIR} FROM p")
def a02(pixels):
    return pairs.scored(pairs.metrics(pixels))


_ENDS = "SELECT unnest([date1, date2]) AS date, risk, action, pair_weight FROM p"


@register("a05_scene_qc", ("pair_pixel",), _METRICS + f"SELECT date, count(*) AS pair_count, round(avg(risk), 6) AS mean_pair_risk, round(max(risk), 6) AS max_pair_risk, round(avg(pair_weight), 6) AS mean_pair_weight, count(*) FILTER (action = 'keep') AS keep_pairs, count(*) FILTER (action = 'downweight') AS downweight_pairs, count(*) FILTER (action = 'drop') AS drop_pairs FROM ({_ENDS}) GROUP BY date")
def a05(pixels):
    return pairs.scenes(pairs.scored(pairs.metrics(pixels)))


@register("a23_risk_summary", ("pair_pixel",), _METRICS + "SELECT count(*) AS pairs, count(*) FILTER (action = 'keep') AS keep_pairs, count(*) FILTER (action = 'downweight') AS downweight_pairs, count(*) FILTER (action = 'drop') AS drop_pairs, round(avg(risk), 6) AS mean_risk, round(quantile_cont(risk, 0.9), 6) AS p90_risk FROM p")
def a23(pixels):
    return pairs.summary(pairs.scored(pairs.metrics(pixels)))


@register("t01_worst_pairs", ("pair_pixel",), _METRICS + f"SELECT {_PAIR} FROM p ORDER BY round(risk, 6) DESC, date1, date2 LIMIT 10")
def t01(pixels):
    return pairs.worst(pairs.scored(pairs.metrics(pixels)))


_MAIN = f"mc AS (SELECT date1, date2, cc AS main_cc FROM (SELECT *, row_number() OVER (PARTITION BY date1, date2 ORDER BY n DESC, cc) AS k FROM (SELECT date1, date2, cc, count(*) AS n FROM pair_pixel WHERE {_OK} GROUP BY ALL)) WHERE k = 1)\n"


@register("a04_main_component", ("pair_pixel",), _MAIN + "SELECT * FROM mc")
def a04(pixels):
    return pairs.main_component(pixels)


@register("a10_point_ratios", ("pair_pixel",), _MAIN + f"SELECT point_id, round(avg(CAST({_OK} AS INT)), 6) AS valid_pair_ratio, round(avg(CAST({_OK} AND coalesce(cc = main_cc, false) AS INT)), 6) AS maincc_ratio, count(*) AS n FROM pair_pixel LEFT JOIN mc USING (date1, date2) GROUP BY point_id")
def a10(pixels):
    return pairs.point_ratios(pixels)


@register("s25_qc_stack", ("pair_pixel",), _METRICS + "SELECT date1, date2, action, count(*) AS pixels, round(sum(coh * CASE action WHEN 'downweight' THEN 0.5 ELSE 1 END), 4) AS coh FROM pair_pixel JOIN p USING (date1, date2) GROUP BY ALL")
def s25(pixels):
    stack = pairs.qc_stack(pixels, pairs.scored(pairs.metrics(pixels)))
    return stack.groupBy("date1", "date2", "action").agg(F.count(F.lit(1)).alias("pixels"), F.round(F.sum("coh"), 4).alias("coh"))


@register("a35_network_degree", ("pair_pixel",), _METRICS + "SELECT date, count(*) AS degree, round(sum(count(*)) OVER () / 2.0 / (count(*) OVER () - 1), 6) AS redundancy FROM (SELECT unnest([date1, date2]) AS date FROM p WHERE action <> 'drop') GROUP BY date")
def a35(pixels):
    return pairs.degree(pairs.scored(pairs.metrics(pixels)))


@register("s02_scene_dates", ("pair_pixel",), "SELECT DISTINCT unnest([date1, date2]) AS date FROM pair_pixel")
def s02(pixels):
    return pixels.select(F.explode(F.array("date1", "date2")).alias("date")).distinct()


@register("f05_los", ("pair_pixel",), "SELECT l_orderkey, l_linenumber, round(unw * 0.05546576::DOUBLE / (4 * pi()) * 1000, 6) AS los_mm FROM pair_pixel")
def f05(pixels):
    return pixels.select("l_orderkey", "l_linenumber", scalars.phase_to_mm(F.col("unw")).alias("los_mm"))


@register("f01_minmax", ("point",), "SELECT point_id, round((height_m - min(height_m) OVER ()) / (max(height_m) OVER () - min(height_m) OVER ()), 6) AS x FROM point")
def f01(points):
    return stats.minmax(points, "height_m", "x").select("point_id", "x")


@register("f02_robust_range", ("point",), "q AS (SELECT quantile_cont(model_rms, 0.05) AS lo, quantile_cont(model_rms, 0.95) AS hi FROM point) SELECT point_id, round(least(1, greatest(0, (model_rms - lo) / (hi - lo))), 6) AS x FROM point, q")
def f02(points):
    return stats.robust_range(points, "model_rms", "x").select("point_id", "x")


@register("f03_robust_z", ("point",), "q AS (SELECT median(height_m) AS med FROM point), r AS (SELECT median(abs(height_m - med)) AS mad FROM point, q) SELECT point_id, round(least(8, greatest(-5, (height_m - med) / greatest(1.4826 * mad, 0.001))), 6) AS x FROM point, q, r")
def f03(points):
    return stats.robust_z(points, "height_m", "x").select("point_id", "x")


_SCORE = "q AS (SELECT quantile_cont(model_rms, 0.05) AS lo, quantile_cont(model_rms, 0.95) AS hi FROM point), s AS (SELECT *, 0.30 * least(1, greatest(0, tcoh)) + 0.20 * valid_pair_ratio + 0.20 * maincc_ratio + 0.15 * (1 - least(1, greatest(0, (model_rms - lo) / (hi - lo)))) + 0.15 * (1 - least(1, greatest(0, jump_risk))) AS ps_score FROM point, q)"


def _scored_points(points):
    df = stats.robust_range(points, "model_rms", "rms_n")
    unit = lambda c: scalars.clip(F.col(c), 0.0, 1.0)
    score = 0.30 * unit("tcoh") + 0.20 * unit("valid_pair_ratio") + 0.20 * unit("maincc_ratio") + 0.15 * (1 - F.col("rms_n")) + 0.15 * (1 - unit("jump_risk"))
    return df.withColumn("ps_score", score).withColumn("point_class", F.when(score >= 0.75, "strict").when(score >= 0.60, "relaxed").otherwise("none")).drop("rms_n")


@register("a12_point_score", ("point",), _SCORE + " SELECT point_id, round(ps_score, 6) AS ps_score, CASE WHEN ps_score >= 0.75 THEN 'strict' WHEN ps_score >= 0.60 THEN 'relaxed' ELSE 'none' END AS point_class FROM s")
def a12(points):
    return _scored_points(points).select("point_id", "ps_score", "point_class")


@register("a26_feature_summary", ("point",), "u AS (UNPIVOT (SELECT tcoh, maincc_ratio, valid_pair_ratio, jump_risk, model_rms, height_m FROM point) ON COLUMNS(*) INTO NAME name VALUE x) SELECT name, round(avg(x), 6) AS mean, round(stddev_pop(x), 6) AS std, round(quantile_cont(x, 0.05), 6) AS p05, round(quantile_cont(x, 0.95), 6) AS p95 FROM u GROUP BY name")
def a26(points):
    names = ["tcoh", "maincc_ratio", "valid_pair_ratio", "jump_risk", "model_rms", "height_m"]
    long = points.select(*names).unpivot([], names, "name", "x")
    return long.groupBy("name").agg(F.avg("x").alias("mean"), F.stddev_pop("x").alias("std"), F.percentile("x", F.lit(0.05)).alias("p05"), F.percentile("x", F.lit(0.95)).alias("p95"))


@register("a31_height_slope", ("point",), "SELECT round(regr_slope(tcoh, height_m) * 1000, 6) AS slope_per_km, round(regr_intercept(tcoh, height_m), 6) AS intercept FROM point")
def a31(points):
    return points.agg((F.regr_slope("tcoh", "height_m") * 1000).alias("slope_per_km"), F.regr_intercept("tcoh", "height_m").alias("intercept"))


@register("a06_bounds", ("point",), "SELECT max(lat) AS n, min(lat) AS s, max(lon) AS e, min(lon) AS w FROM point")
def a06(points):
    return points.agg(F.max("lat").alias("n"), F.min("lat").alias("s"), F.max("lon").alias("e"), F.min("lon").alias("w"))


@register("w01_steps", ("obs",), "d AS (SELECT *, value_mm - lag(value_mm) OVER w AS delta, coalesce(date - lag(date) OVER w, 0) AS gap_days FROM obs WINDOW w AS (PARTITION BY point_id ORDER BY epoch_idx)) SELECT point_id, epoch_idx, CAST(gap_days AS INTEGER) AS gap_days, round(delta, 4) AS delta, round(delta - lag(delta) OVER (PARTITION BY point_id ORDER BY epoch_idx), 4) AS delta2 FROM d")
def w01(obs):
    return series.steps(obs).select("point_id", "epoch_idx", "gap_days", F.round("delta", 4).alias("delta"), F.round("delta2", 4).alias("delta2"))


@register("w04_rolling", ("obs",), "SELECT point_id, epoch_idx, round((value_mm - first(value_mm) OVER f) / nullif(date - first(date) OVER f, 0) * 365.25, 3) AS velocity, round(stddev_pop(value_mm) OVER f, 4) AS deviation, round(0.25 * coalesce(lag(value_mm) OVER w, value_mm) + 0.5 * value_mm + 0.25 * coalesce(lead(value_mm) OVER w, value_mm), 4) AS smooth FROM obs WINDOW w AS (PARTITION BY point_id ORDER BY epoch_idx), f AS (PARTITION BY point_id ORDER BY epoch_idx ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)")
def w04(obs):
    return series.rolling(obs).select("point_id", "epoch_idx", F.round("velocity", 3).alias("velocity"), F.round("deviation", 4).alias("deviation"), F.round("smooth", 4).alias("smooth"))


@register("w14_series_shape", ("obs",), "d AS (SELECT *, value_mm - first(value_mm) OVER w AS rel, value_mm - lag(value_mm) OVER w AS delta FROM obs WINDOW w AS (PARTITION BY point_id ORDER BY epoch_idx)), g AS (SELECT point_id, max_by(rel, epoch_idx) AS net, max(abs(rel)) AS peak, coalesce(sum(abs(delta)) FILTER (abs(delta) > 0.25), 0) AS path, count(*) FILTER (delta > 0.25) AS up, count(*) FILTER (delta < -0.25) AS down FROM d GROUP BY point_id) SELECT point_id, up, down, round(net, 6) AS net, round(peak, 6) AS peak, round(path, 6) AS path, round(greatest(up, down) / greatest(1, up + down), 6) AS sign_consistency, round(abs(net) / greatest(path, 0.000001), 6) AS net_to_path FROM g")
def w14(obs):
    return series.shape(obs)


_FIT = "g AS (SELECT point_id, count(*) AS n, regr_slope(value_mm, day_offset / 365.25::DOUBLE) AS slope, regr_intercept(value_mm, day_offset / 365.25::DOUBLE) AS intercept, greatest(regr_syy(value_mm, day_offset / 365.25::DOUBLE) - regr_slope(value_mm, day_offset / 365.25::DOUBLE) * regr_sxy(value_mm, day_offset / 365.25::DOUBLE), 0) AS sse FROM obs GROUP BY point_id)"


@register("ts06_trend", ("obs",), _FIT + " SELECT point_id, n, round(slope, 6) AS slope, round(intercept, 6) AS intercept, round(sse, 6) AS sse, round(sqrt(sse / n), 6) AS rms, round(n * ln(greatest(sse / n, 1e-6)) + 2 * ln(n), 6) AS bic FROM g")
def ts06(obs):
    return series.trend(obs)


@register("ts04_slope_sensitivity", ("obs",), "s AS (SELECT *, day_offset / 365.25::DOUBLE AS t FROM obs), o AS (SELECT a.point_id, a.epoch_idx, regr_slope(b.value_mm, b.t) AS slope FROM s a JOIN s b ON a.point_id = b.point_id AND a.epoch_idx <> b.epoch_idx WHERE a.epoch_idx > (SELECT min(epoch_idx) FROM s c WHERE c.point_id = a.point_id) GROUP BY ALL), f AS (SELECT point_id, regr_slope(value_mm, t) AS slope FROM s GROUP BY point_id) SELECT o.point_id, round(max(abs(o.slope - f.slope)), 6) AS sensitivity FROM o JOIN f USING (point_id) GROUP BY o.point_id")
def ts04(obs):
    return series.slope_sensitivity(obs)


_DATE = MODEL + ", dq AS (SELECT date, median(abs(res)) AS median_abs, avg(CAST(abs(res) > 10 AS INT)) AS frac, median(res) AS bias FROM r GROUP BY date)"


@register("a18_date_qc", ("obs",), _DATE + " SELECT date, round(median_abs, 6) AS median_abs, round(frac, 6) AS frac, round(bias, 6) AS bias FROM dq")
def a18(obs):
    return series.date_quality(obs)


@register("w10_date_ranks", ("obs",), _DATE + ", k AS (SELECT *, row_number() OVER (ORDER BY round(median_abs, 9) DESC, date) AS rank_by_median_abs, row_number() OVER (ORDER BY round(frac, 9) DESC, date) AS rank_by_frac, ceil(count(*) OVER () * (1 - 0.9::DOUBLE)) AS top FROM dq) SELECT date, rank_by_median_abs, rank_by_frac, rank_by_median_abs <= top OR rank_by_frac <= top AS flagged FROM k")
def w10(obs):
    """Of the rule only the ranks; ``w10_date_flags`` is the whole of it."""
    return series.flag_dates(series.date_quality(obs), frac=None, median_mm=None).select("date", "rank_by_median_abs", "rank_by_frac", "flagged")


@register("f06_calendar", ("epoch",), "SELECT epoch_idx, CAST(dayofyear(date) AS INTEGER) AS doy, round(sin(2 * pi() * dayofyear(date) / 365.25::DOUBLE), 6) AS doy_sin, round(cos(2 * pi() * dayofyear(date) / 365.25::DOUBLE), 6) AS doy_cos FROM epoch")
def f06(epochs):
    a = 2 * F.pi() * F.dayofyear("date") / 365.25
    return epochs.select("epoch_idx", F.dayofyear("date").alias("doy"), F.sin(a).alias("doy_sin"), F.cos(a).alias("doy_cos"))


_XY = "a AS (SELECT avg(lat) AS m FROM point), x AS (SELECT point_id, lon * 111320.0::DOUBLE * cos(radians(m)) AS x, lat * 110540.0::DOUBLE AS y FROM point, a), e AS (SELECT p.point_id AS src, q.point_id AS dst, sqrt((p.x - q.x) ** 2 + (p.y - q.y) ** 2) AS dist_m FROM x p JOIN x q ON p.point_id <> q.point_id AND abs(p.y - q.y) <= 2000)"


@register("j07_radius_neighbours", ("point",), _XY + " SELECT src AS point_id, count(*) AS neighbours, round(avg(dist_m), 5) AS mean_m FROM e WHERE dist_m <= 230 GROUP BY src")
def j07(points):
    return neighbours.within_radius(points, 230.0).groupBy(F.col("src").alias("point_id")).agg(F.count(F.lit(1)).alias("neighbours"), F.round(F.avg("dist_m"), 5).alias("mean_m"))


@register("j06_nearest", ("point",), _XY + " SELECT src, CAST(rank AS INTEGER) AS rank, dst, round(dist_m, 5) AS dist_m FROM (SELECT *, row_number() OVER (PARTITION BY src ORDER BY round(dist_m, 6), dst) AS rank FROM e) WHERE rank <= 8")
def j06(points):
    return neighbours.nearest(points, 8, cell=150.0).withColumn("dist_m", F.round("dist_m", 5))


@register("g05_components", ("point",), None)
def g05(points):
    """Connected sets of strict and relaxed points that lie within 120 m of each other and hold a strict one; a point alone is a set."""
    good = _scored_points(points).where("point_class <> 'none'")
    edges = neighbours.within_radius(good, 120.0).select("src", "dst").union(good.select("point_id", "point_id"))
    return components.holding(components.connected_components(edges), good.where("point_class = 'strict'").select(F.col("point_id").alias("id")))


@register("j12_frame_dates", ("scene",), "SELECT a.path, a.frame AS f1, b.frame AS f2, count(DISTINCT CAST(a.start_ts AS DATE)) AS dates FROM scene a JOIN scene b ON a.path = b.path AND CAST(a.start_ts AS DATE) = CAST(b.start_ts AS DATE) AND a.frame < b.frame GROUP BY ALL")
def j12(scenes):
    """Dates common to two frames of a path: frames are made distinct per date before they meet."""
    per = scenes.select("path", "frame", F.to_date("start_ts").alias("d")).distinct()
    other = per.select("path", F.col("frame").alias("f2"), "d")
    return per.withColumnRenamed("frame", "f1").join(other, ["path", "d"]).where("f1 < f2").groupBy("path", "f1", "f2").agg(F.count(F.lit(1)).alias("dates"))


_LINE = MODEL
_DELTA = "d AS (SELECT *, value_mm - lag(value_mm) OVER (PARTITION BY point_id ORDER BY epoch_idx) AS delta FROM obs)"
_GRID = "g AS (SELECT p.point_id, e.epoch_idx, o.value_mm FROM (SELECT DISTINCT point_id FROM obs) p CROSS JOIN epoch e LEFT JOIN obs o ON o.point_id = p.point_id AND o.epoch_idx = e.epoch_idx)"


@register("w03_ends", ("obs",), "SELECT point_id, round(arg_min(value_mm, epoch_idx), 6) AS first_mm, round(arg_max(value_mm, epoch_idx), 6) AS last_mm, round(arg_max(value_mm, epoch_idx) - arg_min(value_mm, epoch_idx), 6) AS last_rel0 FROM obs GROUP BY point_id")
def w03(obs):
    return series.ends(obs)


@register("w06_persistence", ("obs",), _DELTA + """, m AS (SELECT epoch_idx, median(abs(delta)) AS m FROM d WHERE delta IS NOT NULL GROUP BY epoch_idx), l AS (SELECT epoch_idx FROM m WHERE m > (SELECT quantile_cont(m, 0.8) FROM m)),
 s AS (SELECT point_id, epoch_idx, abs(coalesce(delta, 0)) AS size, CASE WHEN epoch_idx IN (SELECT epoch_idx FROM l) THEN abs(coalesce(delta, 0)) ELSE 0 END AS strength FROM d)
 SELECT s.point_id, epoch_idx, round(least(1, avg(strength) OVER (PARTITION BY s.point_id ORDER BY epoch_idx ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) / greatest(1, q)), 6) AS persistence FROM s JOIN (SELECT point_id, quantile_cont(size, 0.95) AS q FROM s GROUP BY point_id) USING (point_id)""")
def w06(obs):
    return series.persistence(obs, series.loud_epochs(obs))


@register("w08_fill_gaps", ("obs",), _GRID + """, b AS (SELECT *, max(CASE WHEN value_mm IS NOT NULL THEN epoch_idx END) OVER (PARTITION BY point_id ORDER BY epoch_idx) AS e0, min(CASE WHEN value_mm IS NOT NULL THEN epoch_idx END) OVER (PARTITION BY point_id ORDER BY epoch_idx DESC) AS e1 FROM g)
 SELECT b.point_id, b.epoch_idx, b.value_mm IS NULL AS filled, round(CASE WHEN e0 IS NULL THEN y.value_mm WHEN e1 IS NULL OR e0 = e1 THEN x.value_mm ELSE x.value_mm + (y.value_mm - x.value_mm) * (b.epoch_idx - e0) / (e1 - e0) END, 6) AS value_mm
 FROM b LEFT JOIN obs x ON x.point_id = b.point_id AND x.epoch_idx = e0 LEFT JOIN obs y ON y.point_id = b.point_id AND y.epoch_idx = e1""")
def w08(obs):
    return series.fill_gaps(obs)


@register("u03_missing_epochs", ("obs",), "SELECT point_id, epoch_idx FROM (SELECT DISTINCT point_id FROM obs) CROSS JOIN epoch EXCEPT SELECT point_id, epoch_idx FROM obs")
def u03(obs):
    return zones.missing_epochs(series.fill_gaps(obs), obs)


@register("w12_complete_windows", ("obs",), "SELECT point_id, CAST(sum(CAST(n = 18 AS INT)) AS BIGINT) AS windows FROM (SELECT point_id, count(*) OVER (PARTITION BY point_id ORDER BY epoch_idx RANGE BETWEEN 17 PRECEDING AND CURRENT ROW) AS n FROM obs) GROUP BY point_id")
def w12(obs):
    return series.complete_windows(obs)


@register("w13_split_ends", ("epoch",), "u AS (SELECT epoch_idx, epoch_idx - 11 AS k, count(*) OVER () - 17 AS n FROM epoch) SELECT epoch_idx, CASE WHEN k < greatest(1, floor(n * 0.7::DOUBLE)) THEN 'train' WHEN k < least(n - 1, greatest(greatest(1, floor(n * 0.7::DOUBLE)) + 1, floor(n * 0.85::DOUBLE))) THEN 'val' ELSE 'test' END AS split FROM u WHERE k BETWEEN 0 AND n - 1")
def w13(epochs):
    return series.split_ends(epochs)


@register("w15_future_dates", ("epoch",), "q AS (SELECT epoch_idx, date, date - lag(date) OVER (ORDER BY epoch_idx) AS gap FROM epoch), z AS (SELECT greatest(1, CAST(floor(median(gap)) AS INT)) AS step, max(date) AS last FROM q WHERE epoch_idx > (SELECT max(epoch_idx) - 5 FROM epoch)) SELECT CAST(k AS INT) AS k, CAST(last + CAST(k * step AS INT) AS DATE) AS date FROM z, range(1, 7) t(k)")
def w15(epochs):
    return series.future_dates(epochs)


@register("t07_even_epochs", ("epoch",), "n AS (SELECT count(*) AS n FROM epoch) SELECT epoch.* FROM epoch JOIN (SELECT DISTINCT CAST(round_even(i * ((n - 1) / 8.0::DOUBLE), 0) AS INT) AS epoch_idx FROM n, range(0, 9) t(i)) USING (epoch_idx)")
def t07(epochs):
    return series.even_epochs(epochs)


@register("a11_residual_threshold", ("obs",), _LINE + " SELECT round(quantile_cont(abs(res), 0.9), 6) AS p90, round(quantile_cont(abs(res), 0.95), 6) AS p95, round(greatest(28, quantile_cont(abs(res), 0.95)), 6) AS jump_threshold FROM r")
def a11(obs):
    return series.residual_threshold(obs)


@register("a19_concentration", ("obs", "point"), _LINE + """, c AS (SELECT point_id, least(9, floor("row" / ((SELECT max("row") FROM point) + 1)::DOUBLE * 10)) AS rb, least(9, floor(col / ((SELECT max(col) FROM point) + 1)::DOUBLE * 10)) AS cb FROM point),
 n AS (SELECT date, rb, cb, sum(CAST(abs(res) > 10 AS INT)) AS n FROM r JOIN c USING (point_id) GROUP BY ALL)
 SELECT date, CAST(sum(n) AS BIGINT) AS anomalies, round(CASE WHEN sum(n) = 0 THEN 0 ELSE max(n) / CAST(sum(n) AS DOUBLE) END, 6) AS concentration FROM n GROUP BY date""")
def a19(obs, points):
    return series.concentration(obs, points)


@register("t04_exemplars", ("obs", "point"), _DELTA + """, s AS (SELECT point_id, stddev_pop(delta) AS stability, regr_slope(value_mm, day_offset / 365.25::DOUBLE) AS velocity FROM d GROUP BY point_id), k AS (SELECT s.*, tcoh, row_number() OVER (ORDER BY round(stability, 9), point_id) AS a, row_number() OVER (ORDER BY round(abs(velocity), 9) DESC, point_id) AS b, row_number() OVER (ORDER BY tcoh, point_id) AS c FROM s JOIN point USING (point_id))
 SELECT point_id, CASE WHEN a <= 4 THEN 'steady' WHEN b <= 4 THEN 'fast' ELSE 'weak' END AS reason, round(velocity, 6) AS velocity, round(stability, 6) AS stability, round(tcoh, 6) AS tcoh FROM k WHERE a <= 4 OR b <= 4 OR c <= 4""")
def t04(obs, points):
    return series.exemplars(obs, points)


@register("j01_increments", ("obs", "pair_pixel"), "p AS (SELECT DISTINCT date1, date2 FROM pair_pixel) SELECT a.point_id, date1, date2, round(b.value_mm - a.value_mm, 6) AS increment_mm FROM p JOIN obs a ON strftime(a.date, '%Y%m%d') = date1 JOIN obs b ON b.point_id = a.point_id AND strftime(b.date, '%Y%m%d') = date2")
def j01(obs, pixels):
    return series.increments(obs, pixels.select("date1", "date2").distinct())


@register("t09_sample_cap", ("obs",), "SELECT point_id, epoch_idx, round(value_mm, 6) AS value_mm FROM obs ORDER BY md5(concat_ws(':', point_id, epoch_idx, 42)), point_id, epoch_idx LIMIT 500")
def t09(obs):
    return series.sample_cap(obs.select("point_id", "epoch_idx", "value_mm"), 500)


@register("a03_cell_average", ("pair_pixel",), "SELECT point_id, round(least(1, greatest(0, avg(coh))) + 1e-9::DOUBLE, 6) AS coh FROM pair_pixel GROUP BY point_id")
def a03(pixels):
    return zones.cell_average(pixels).withColumn("coh", F.col("coh") + 1e-9)  # coherences have three decimals: means lie on halves of the sixth


@register("a07_outlier_share", ("pair_pixel",), "q AS (SELECT *, median(unw) OVER (PARTITION BY date1, date2) AS med FROM pair_pixel), s AS (SELECT *, median(abs(unw - med)) OVER (PARTITION BY date1, date2) AS mad FROM q) SELECT date1, date2, round(avg(CAST(abs(unw - med) > 5 * greatest(1.4826::DOUBLE * mad, 0.000001) AS INT)), 6) AS outlier_share FROM s GROUP BY ALL")
def a07(pixels):
    return zones.outlier_share(pixels, ["date1", "date2"], "unw")


@register("a27_zone_profile", ("obs",), """o AS (SELECT point_id % 3 AS zone, *, row_number() OVER (PARTITION BY point_id % 3, epoch_idx ORDER BY value_mm, point_id) AS r, count(*) OVER (PARTITION BY point_id % 3, epoch_idx) AS n FROM obs), z AS (SELECT zone FROM o GROUP BY zone HAVING count(DISTINCT point_id) >= 32)
 SELECT zone, epoch_idx, round(quantile_cont(value_mm, 0.25), 6) AS p25, round(quantile_cont(value_mm, 0.5), 6) AS p50, round(quantile_cont(value_mm, 0.75), 6) AS p75, round(avg(value_mm) FILTER (r > floor(n * 0.2::DOUBLE) AND r <= n - floor(n * 0.2::DOUBLE)), 6) AS trimmed_mean, count(*) AS n_points FROM o WHERE zone IN (SELECT zone FROM z) GROUP BY zone, epoch_idx""")
def a27(obs):
    return zones.profile(obs.withColumn("zone", F.col("point_id") % 3))


_V = "v AS (SELECT *, (model_rms - 2) * 10 AS velocity, \"row\" // 10 AS zone FROM point)"


def _moving(points: DataFrame) -> DataFrame:
    return points.withColumns({"velocity": (F.col("model_rms") - 2) * 10, "zone": F.floor(F.col("row") / 10)})


@register("a28_zone_records", ("point",), _V + """ SELECT zone, count(*) AS pixel_count, round(sum(0.001::DOUBLE * 111.32::DOUBLE * cos(radians(lat)) * 0.001::DOUBLE * 110.54::DOUBLE), 6) AS area_km2, round(min(lon), 6) AS west, round(min(lat), 6) AS south, round(max(lon), 6) AS east, round(max(lat), 6) AS north, round(avg(lon), 6) AS centroid_lon, round(avg(lat), 6) AS centroid_lat,
 round(avg(velocity), 6) AS mean_velocity, round(median(velocity), 6) AS median_velocity, round(quantile_cont(abs(velocity), 0.1), 6) AS p10_abs, round(quantile_cont(abs(velocity), 0.9), 6) AS p90_abs, round(max(abs(velocity)), 6) AS max_abs FROM v GROUP BY zone""")
def a28(points):
    return zones.records(_moving(points))


@register("a30_coherence_bins", ("point",), _V + f" SELECT CAST(floor((tcoh - 0.4::DOUBLE) / {(1.0 - 0.4) / 14!r}::DOUBLE) AS BIGINT) AS bin, count(*) AS n, round(avg(velocity), 6) AS mean, round(stddev_pop(velocity), 6) AS deviation FROM v WHERE tcoh >= 0.4::DOUBLE AND tcoh < 1 GROUP BY ALL HAVING count(*) > 10")
def a30(points):
    return zones.bins(_moving(points), "tcoh", "velocity")


@register("a32_histogram", ("point",), "s AS (SELECT count(*) AS n, min(height_m) AS lo, max(height_m) AS hi, least(80, greatest(20, floor(sqrt(count(*)))))::INT AS b FROM point), w AS (SELECT *, (hi - lo) / b AS w FROM s), c AS (SELECT least(b - 1, floor((height_m - lo) / w)::INT) AS bin, count(*) AS n FROM point, w GROUP BY ALL) SELECT CAST(i AS INT) AS bin, round(lo + i * w, 6) AS left_edge, coalesce(c.n, 0) AS n, round(coalesce(c.n, 0) / (w.n * w), 6) AS density FROM w, unnest(range(0, b)) t(i) LEFT JOIN c ON c.bin = i")
def a32(points):
    return zones.histogram(points, "height_m")


@register("a33_spread", ("point",), _V + " SELECT round(avg(velocity), 6) AS mean, round(stddev_pop(velocity), 6) AS deviation, round(median(velocity), 6) AS median, round(greatest(1, quantile_cont(abs(velocity), 0.97)), 6) AS limit FROM v".replace("AS limit", 'AS "limit"'))
def a33(points):
    return zones.spread(_moving(points), "velocity")


@register("j10_bilinear", ("point",), """s AS (SELECT point_id, "row" + 0.25::DOUBLE AS fr, col + (point_id % 4) / 4.0::DOUBLE AS fc FROM point), x AS (SELECT point_id, floor(fr) + i AS r, floor(fc) + j AS c, (CASE i WHEN 1 THEN fr - floor(fr) ELSE 1 - fr + floor(fr) END) * (CASE j WHEN 1 THEN fc - floor(fc) ELSE 1 - fc + floor(fc) END) AS w FROM s, range(0, 2) a(i), range(0, 2) b(j))
 SELECT x.point_id, round(CASE WHEN count(height_m) = count(*) THEN sum(w * height_m) END, 6) AS height_m FROM x LEFT JOIN point ON point."row" = r AND point.col = c WHERE w > 0 GROUP BY x.point_id""")
def j10(points):
    return zones.bilinear(points.select("point_id", (F.col("row") + 0.25).alias("fr"), (F.col("col") + (F.col("point_id") % 4) / 4.0).alias("fc")), points, "height_m")


@register("j18_nearest_to", ("point",), "SELECT round(sqrt(((lon - 103.0213::DOUBLE) * 111320.0::DOUBLE * cos(radians(30.0017::DOUBLE))) ** 2 + ((lat - 30.0017::DOUBLE) * 110540.0::DOUBLE) ** 2), 6) AS distance_m, point_id FROM point ORDER BY 1, 2 LIMIT 1")
def j18(points):
    return zones.nearest_to(points, 30.0017, 103.0213)


@register("t11_reference_pixel", ("point",), 'SELECT "row", col, round(tcoh, 6) AS tcoh FROM point WHERE "row" >= 1 AND col >= 1 AND "row" <= (SELECT max("row") FROM point) - 1 AND col <= (SELECT max(col) FROM point) - 1 ORDER BY tcoh DESC, "row", col LIMIT 1')
def t11(points):
    return zones.reference_pixel(points, border=1)


@register("f10_unit_series", ("obs",), "c AS (SELECT *, value_mm - avg(value_mm) OVER (PARTITION BY point_id) AS x FROM obs) SELECT point_id, epoch_idx, round(x / sqrt(sum(x * x) OVER (PARTITION BY point_id)), 6) AS x FROM c")
def f10(obs):
    packed = obs.groupBy("point_id").agg(F.array_sort(F.collect_list(F.struct("epoch_idx", "value_mm"))).alias("s"))
    unit = packed.select("point_id", F.col("s.epoch_idx").alias("e"), scalars.unit_series(F.col("s.value_mm")).alias("x"))
    return unit.select("point_id", F.inline(F.arrays_zip("e", "x"))).withColumnRenamed("e", "epoch_idx")


@register("f12_point_scalars", ("point",), """SELECT point_id, round(1 / (1 + exp(-jump_risk)), 6) AS risk, round(0.001::DOUBLE * 111.32::DOUBLE * cos(radians(lat)) * 0.001::DOUBLE * 110.54::DOUBLE * 1000, 6) AS area_k, least("row", col, 40 - 1 - "row", 50 - 1 - col) AS edge, round(least(abs(point_id % 366 - 100), 365.25 - abs(point_id % 366 - 100))::DOUBLE, 6) AS days, strftime(make_timestamp((point_id * 137 % 86400) * 1000000), '%H:%M:%S') AS clock FROM point""")
def f12(points):
    """F4, F8, F9, F12 and F14 over points."""
    p = F.col("point_id")
    return points.select("point_id", scalars.sigmoid(F.col("jump_risk")).alias("risk"), F.round(scalars.pixel_area_km2(F.col("lat"), 0.001, 0.001) * 1000, 6).alias("area_k"), scalars.edge_distance(F.col("row"), F.col("col"), F.lit(40), F.lit(50)).alias("edge"), scalars.cyclic_days(p % 366, F.lit(100)).alias("days"), scalars.clock(p * 137).alias("clock"))


_BOX = 'z AS (SELECT max("row") AS h, max(col) AS w FROM point), b AS (SELECT p."row", p.col, q.height_m AS x FROM point p, z, range(-2, 3) i(i), range(-2, 3) j(j) JOIN point q ON q."row" = greatest(0, least(h, p."row" + i)) AND q.col = greatest(0, least(w, p.col + j)))'


@register("r01_box_mean", ("point",), _BOX + ' SELECT "row", col, round(avg(x), 6) AS mean FROM b GROUP BY ALL')
def r01(points):
    return rasters.box_mean(points, "height_m", 5)


@register("r02_box_deviation", ("point",), _BOX + ' SELECT "row", col, round(stddev_pop(x), 4) AS deviation FROM b GROUP BY ALL')
def r02(points):
    return rasters.box_deviation(points, "height_m", 5).withColumn("deviation", F.round("deviation", 4))


_CELLS = 'z AS (SELECT max("row") AS h, max(col) AS w, median(height_m) AS med FROM point), l AS (SELECT CAST(r AS INTEGER) AS "row", CAST(c AS INTEGER) AS col, med FROM (SELECT unnest(range(0, h + 1)) AS r, w, med FROM z), LATERAL (SELECT unnest(range(0, w + 1)) AS c)), x AS (SELECT "row", col, height_m, coalesce(height_m, med) AS x FROM l LEFT JOIN point USING ("row", col))'
_SLOPE = "coalesce((lead(x) OVER {0} - lag(x) OVER {0}) / 2, lead(x) OVER {0} - x, x - lag(x) OVER {0}, 0)"


@register("r03_gradient", ("point",), _CELLS + f', g AS (SELECT *, {_SLOPE.format("a")} AS gx, {_SLOPE.format("b")} AS gy FROM x WINDOW a AS (PARTITION BY "row" ORDER BY col), b AS (PARTITION BY col ORDER BY "row")) SELECT "row", col, round(sqrt(gx * gx + gy * gy), 6) AS gradient FROM g WHERE height_m IS NOT NULL')
def r03(points):
    return rasters.gradient(points, "height_m")


@register("r04_neighbour_count", ("point",), 'p AS (SELECT "row", col, CAST(tcoh >= 0.7 AS INT) AS m FROM point) SELECT a."row", a.col, CAST(sum(b.m) - any_value(a.m) AS BIGINT) AS neighbours FROM p a JOIN p b ON abs(a."row" - b."row") <= 2 AND abs(a.col - b.col) <= 2 GROUP BY ALL')
def r04(points):
    return rasters.neighbour_count(points, F.col("tcoh") >= 0.7, 5)


@register("r06_far_cells", ("point",), 'SELECT "row", col FROM point p WHERE NOT EXISTS (SELECT 1 FROM point s WHERE s.tcoh > 0.95 AND (s."row" - p."row") ** 2 + (s.col - p.col) ** 2 < 16)')
def r06(points):
    return rasters.far_from(points.select("row", "col"), points.where("tcoh > 0.95"), 4)


_NEAR = '(abs(a."row" - b."row") <= 1 AND abs(a.col - b.col) <= 1)'


@register("r07_closing", ("point",), f'd AS (SELECT DISTINCT a."row", a.col FROM point a JOIN point b ON {_NEAR} WHERE b.tcoh >= 0.5) SELECT a."row", a.col FROM d a JOIN d b ON {_NEAR} GROUP BY ALL HAVING count(*) = 9')
def r07(points):
    return rasters.closing(points.where("tcoh >= 0.5"), points)


@register("r07_opening", ("point",), f'm AS (SELECT "row", col FROM point WHERE tcoh >= 0.1), d AS (SELECT a."row", a.col FROM m a JOIN m b ON {_NEAR} GROUP BY ALL HAVING count(*) = 9) SELECT DISTINCT a."row", a.col FROM point a JOIN d b ON {_NEAR}')
def r07_opening(points):
    return rasters.opening(points.where("tcoh >= 0.1"), points)


@register("r08_filled", ("point",), None)
def r08(points):
    return rasters.fill_holes(points.where("tcoh < 0.75"), points, "tcoh")


@register("r09_labels", ("point",), None)
def r09(points):
    return rasters.labels(points.where("tcoh >= 0.6"))


@register("r10_propagated", ("point",), None)
def r10(points):
    return rasters.propagate(points.where("tcoh >= 0.95"), points.where("tcoh >= 0.7"))


_SAMPLES = """w AS (SELECT *, count(*) OVER f AS n, coalesce(regr_slope(value_mm, day_offset) OVER p, 0) AS slope, avg(value_mm) OVER p AS y, avg(day_offset) OVER p AS x FROM obs WINDOW f AS (PARTITION BY point_id ORDER BY epoch_idx RANGE BETWEEN 11 PRECEDING AND 3 FOLLOWING), p AS (PARTITION BY point_id ORDER BY epoch_idx RANGE BETWEEN 11 PRECEDING AND CURRENT ROW)),
 s AS (SELECT w.point_id, w.epoch_idx AS window_end, o.epoch_idx - w.epoch_idx AS h, o.value_mm - w.value_mm AS target, y + slope * (o.day_offset - x) - w.value_mm AS line FROM w JOIN obs o ON o.point_id = w.point_id AND o.epoch_idx BETWEEN w.epoch_idx + 1 AND w.epoch_idx + 3 WHERE n = 15),
 p AS (SELECT point_id, window_end, h, target, 'persistence' AS method, 0.0::DOUBLE AS p50 FROM s UNION ALL SELECT point_id, window_end, h, target, 'linear_trend', line FROM s),
 q AS (SELECT method, h, quantile_cont(target - p50, 0.1) AS q10, quantile_cont(target - p50, 0.9) AS q90 FROM p GROUP BY ALL),
 t AS (SELECT p.* EXCLUDE p50, list_sort([p50 + q10, p50, p50 + q90]) AS v FROM p JOIN q USING (method, h)), b AS (SELECT * EXCLUDE v, v[1] AS p10, v[2] AS p50, v[3] AS p90 FROM t)"""
_SCORES = "round(avg(abs(p50 - target)), 6) AS mae, round(sqrt(avg((p50 - target) ** 2)), 6) AS rmse, round((avg(greatest(0.1 * (target - p10), -0.9 * (target - p10))) + avg(abs(target - p50) / 2) + avg(greatest(0.9 * (target - p90), -0.1 * (target - p90)))) / 3, 6) AS pinball, round(avg(CAST(target BETWEEN p10 AND p90 AS INT)), 6) AS coverage, round(abs(avg(CAST(target BETWEEN p10 AND p90 AS INT)) - 0.8), 6) AS coverage_error, round(avg(p90 - p10), 6) AS width, round(avg(p90 - p10 + 10 * greatest(0, p10 - target) + 10 * greatest(0, target - p90) + abs(p50 - target)), 6) AS wis_ref"


def _banded(obs):
    p = forecasts.baselines(forecasts.samples(obs))
    return forecasts.with_bands(p, forecasts.bands(p))


@register("fc04_samples", ("obs",), _SAMPLES + " SELECT point_id, window_end, CAST(h AS INTEGER) AS h, CAST(target AS DECIMAL(18, 8)) AS target FROM s")
def fc04(obs):
    return forecasts.samples(obs).select("point_id", "window_end", "h", F.col("target").cast("decimal(18,8)").alias("target"))


@register("fc10_baselines", ("obs",), _SAMPLES + " SELECT point_id, window_end, CAST(h AS INTEGER) AS h, method, CAST(target AS DECIMAL(18, 8)) AS target, round(p50, 4) AS p50 FROM p")
def fc10(obs):
    return forecasts.baselines(forecasts.samples(obs)).withColumns({"target": F.col("target").cast("decimal(18,8)"), "p50": F.round("p50", 4)})


@register("fc13_bands", ("obs",), _SAMPLES + " SELECT method, CAST(h AS INTEGER) AS h, round(q10, 6) AS q10, round(q90, 6) AS q90 FROM q")
def fc13(obs):
    return forecasts.bands(forecasts.baselines(forecasts.samples(obs)))


@register("fc16_scores", ("obs",), _SAMPLES + f" SELECT method, CAST(coalesce(h, 0) AS INTEGER) AS h, {_SCORES} FROM b GROUP BY GROUPING SETS ((method, h), (method))")
def fc16(obs):
    return forecasts.scores(_banded(obs))


_CORRECTION = _SAMPLES + """, k AS (SELECT method, h, greatest(p10 - target, target - p90, 0) AS score, row_number() OVER (PARTITION BY method, h ORDER BY greatest(p10 - target, target - p90, 0)) AS k, count(*) OVER (PARTITION BY method, h) AS n FROM b),
 c AS (SELECT method, h, max(score) AS correction FROM k WHERE k = ceil(round((n - 1) * least(1, ceil((n + 1) * 0.8::DOUBLE) / n), 6)) + 1 GROUP BY ALL)"""


@register("fc20_calibration", ("obs",), _CORRECTION + " SELECT method, CAST(h AS INTEGER) AS h, round(correction, 6) AS correction FROM c")
def fc20(obs):
    return forecasts.calibration(_banded(obs))


@register("fc22_calibrated_scores", ("obs",), _CORRECTION + f", e AS (SELECT method, h, target, p50, p10 - correction AS p10, p90 + correction AS p90 FROM b JOIN c USING (method, h)) SELECT method, CAST(coalesce(h, 0) AS INTEGER) AS h, {_SCORES} FROM e GROUP BY GROUPING SETS ((method, h), (method))")
def fc22(obs):
    found = _banded(obs)
    return forecasts.scores(forecasts.calibrated(found, forecasts.calibration(found)))


@register("fc29_calibration_curve", ("obs",), _CORRECTION + " SELECT method, CAST(h AS INTEGER) AS h, round(avg(CAST(target BETWEEN p10 AND p90 AS INT)), 6) AS raw_coverage, round(avg(CAST(target BETWEEN p10 - correction AND p90 + correction AS INT)), 6) AS calibrated_coverage, 0.8::DOUBLE AS target_coverage FROM b JOIN c USING (method, h) GROUP BY ALL")
def fc29_curve(obs):
    found = _banded(obs)
    return forecasts.calibration_curve(found, forecasts.calibration(found))


@register("fc29_horizon_panel", ("obs",), _SAMPLES + ", l AS (SELECT * FROM p WHERE method = 'linear_trend'), x AS (SELECT greatest(quantile_cont(abs(p50), 0.95), 1) AS m FROM l) SELECT point_id, window_end, CAST(h AS INTEGER) AS h, round(greatest(-1, least(1, p50 / m)), 5) AS shade FROM l, x")
def fc29_panel(obs):
    found = forecasts.baselines(forecasts.samples(obs)).where("method = 'linear_trend'")
    return forecasts.horizon_panel(found).select("point_id", "window_end", "h", F.round("shade", 5).alias("shade"))


_DAY1, _DAY2 = (f"CAST(strptime(date{k}, '%Y%m%d') AS DATE)" for k in (1, 2))
_FEED = _MAIN + ", " + MODEL + ", " + _SCORE + f""", x AS (SELECT date1, date2, {_OK} AS ok, {_OK} AND coalesce(cc = main_cc, false) AS main, abs(unw * 0.05546576::DOUBLE / (4 * pi()) * 1000 - ({value_at(_DAY2)} - {value_at(_DAY1)})) AS res
 FROM pair_pixel JOIN s USING (point_id) JOIN mp USING (point_id) LEFT JOIN mc USING (date1, date2), og WHERE ps_score >= 0.6),
 m AS (SELECT date1, date2, 1 - avg(CAST(ok AS INT)) AS bad_ratio, avg(CAST(main AS INT)) AS main_cc_coverage, coalesce(avg(CAST(res > 28 AS INT)) FILTER (ok), 1) AS unwrap_jump_index, median(res) FILTER (ok) AS median_residual FROM x GROUP BY ALL)"""
_ROUND1 = _FEED + """, lim AS (SELECT quantile_cont(median_residual, 0.05) AS a, quantile_cont(median_residual, 0.95) AS b FROM m), k AS (SELECT m.*, CASE WHEN median_residual IS NULL THEN 0 ELSE 1 - CASE WHEN b > a THEN least(1, greatest(0, (median_residual - a) / (b - a))) ELSE 0 END END AS consistency FROM m, lim),
 r1 AS (SELECT date1, date2, coalesce(consistency, 0) AS consistency, coalesce(0.30 * (1 - bad_ratio) + 0.25 * main_cc_coverage + 0.20 * (1 - unwrap_jump_index) + 0.15 * consistency + 0.10, 0) AS q1 FROM (SELECT DISTINCT date1, date2 FROM pair_pixel) LEFT JOIN k USING (date1, date2))"""
_ACT = "CASE WHEN {0} >= 0.75 THEN 'keep' WHEN {0} >= 0.5 THEN 'downweight' ELSE 'drop' END"


def _pair_residuals(pixels, obs, points):
    good = _scored_points(points).where("point_class <> 'none'").select("point_id")
    return feedback.pair_residuals(pixels, fits.models(obs.drop("res")).join(good, "point_id", "left_semi"))


def _pair_metrics(pixels, obs, points):
    return feedback.pair_metrics(_pair_residuals(pixels, obs, points))


@register("a13_trusted_pair_metrics", ("pair_pixel", "obs", "point"), _FEED + " SELECT date1, date2, round(bad_ratio, 6) AS bad_ratio, round(main_cc_coverage, 6) AS main_cc_coverage, round(unwrap_jump_index, 6) AS unwrap_jump_index, round(median_residual, 6) AS median_residual FROM m")
def a13(pixels, obs, points):
    """Over strict and relaxed points, as the test tables have series of few points."""
    return _pair_metrics(pixels, obs, points)


@register("a14_first_round", ("pair_pixel", "obs", "point"), _ROUND1 + f" SELECT date1, date2, round(consistency, 6) AS consistency, round(q1, 6) AS q_round1, {_ACT.format('q1')} AS action_round1 FROM r1")
def a14(pixels, obs, points):
    return feedback.first_round(pixels.select("date1", "date2").distinct(), _pair_metrics(pixels, obs, points)).select("date1", "date2", "consistency", "q_round1", "action_round1")


_FLAGS = """, dq AS (SELECT date, median(abs(res)) AS a, avg(CAST(abs(res) > 10 AS INT)) AS f FROM r GROUP BY date),
 fl AS (SELECT date FROM (SELECT date, row_number() OVER (ORDER BY round(a, 9) DESC, date) AS ra, row_number() OVER (ORDER BY round(f, 9) DESC, date) AS rf, ceil(count(*) OVER () * (1 - 0.9::DOUBLE)) AS top FROM dq) WHERE ra <= top OR rf <= top),
 ce AS (SELECT point_id, least(9, floor("row" / ((SELECT max("row") FROM point) + 1)::DOUBLE * 10)) AS rb, least(9, floor(col / ((SELECT max(col) FROM point) + 1)::DOUBLE * 10)) AS cb FROM point),
 cn AS (SELECT date, rb, cb, sum(CAST(abs(res) > 10 AS INT)) AS n FROM r JOIN ce USING (point_id) GROUP BY ALL),
 sc AS (SELECT strftime(date, '%Y%m%d') AS date, CASE WHEN c <= 0.2 THEN 'global' WHEN c <= 0.4 THEN 'mixed' ELSE 'local' END AS scope FROM (SELECT date, CASE WHEN sum(n) = 0 THEN 0 ELSE max(n) / CAST(sum(n) AS DOUBLE) END AS c FROM cn GROUP BY date) JOIN fl USING (date))"""


@register("a20_second_round", ("pair_pixel", "obs", "point"), _ROUND1 + _FLAGS + f""", pe AS (SELECT r1.*, least(0.2, coalesce(CASE a.scope WHEN 'global' THEN 0.1 WHEN 'mixed' THEN 0.05 WHEN 'local' THEN 0.025 END, 0) + coalesce(CASE b.scope WHEN 'global' THEN 0.1 WHEN 'mixed' THEN 0.05 WHEN 'local' THEN 0.025 END, 0) + CASE WHEN consistency < 0.5 THEN 0.1 ELSE 0 END)::DOUBLE AS penalty FROM r1 LEFT JOIN sc a ON date1 = a.date LEFT JOIN sc b ON date2 = b.date)
 SELECT date1, date2, round(penalty, 6) AS penalty, round(greatest(0, q1 - penalty), 6) AS q_round2, {_ACT.format("greatest(0, q1 - penalty)")} AS action FROM pe""")
def a20(pixels, obs, points):
    """Both rounds, dates flagged by rank only; ``a20_second_round_flags`` has the whole rule.  What is returned is the final choice."""
    obs = materialise(series.residuals(obs))
    return _second_round(pixels, obs, points, series.flag_dates(series.date_quality(obs), frac=None, median_mm=None), series.concentration(obs, points))


def _second_round(pixels, obs, points, dates, concentration):
    one = feedback.first_round(pixels.select("date1", "date2").distinct(), _pair_metrics(pixels, obs, points))
    flagged = dates.where("flagged").select("date").join(concentration, "date")
    two = feedback.second_round(one, flagged.select(F.date_format("date", "yyyyMMdd").alias("date"), feedback.scope(F.col("concentration")).alias("scope")))
    return two.select("date1", "date2", "penalty", "q_round2").join(feedback.final(two).select("date1", "date2", "action"), ["date1", "date2"])


_RES = "abs(res)"
_JUMP = f", th AS (SELECT greatest(28, quantile_cont({_RES}, 0.95)) AS th FROM r)"
_WHOLE_FLAGS = f""", dq AS (SELECT date, median({_RES}) AS a, avg(CAST({_RES} > th AS INT)) AS f FROM r, th GROUP BY date),
 rk AS (SELECT *, row_number() OVER (ORDER BY round(a, 9) DESC, date) AS ra, row_number() OVER (ORDER BY round(f, 9) DESC, date) AS rf, ceil(count(*) OVER () * (1 - 0.9::DOUBLE)) AS top FROM dq),
 wf AS (SELECT date, ra, rf, ra <= top OR rf <= top OR coalesce(round(f, 9) >= 0.20::DOUBLE OR round(a, 9) >= 20, false) AS flagged FROM rk)"""


@register("w10_date_flags", ("obs",), MODEL + _JUMP + _WHOLE_FLAGS + " SELECT date, ra AS rank_by_median_abs, rf AS rank_by_frac, flagged FROM wf")
def w10_flags(obs):
    """The top tenth of either rank, or a fifth of the points over the jump threshold (A11), or a median residual of 20 mm."""
    obs = materialise(series.residuals(obs))
    return series.flag_dates(series.date_quality(obs, series.residual_threshold(obs))).select("date", "rank_by_median_abs", "rank_by_frac", "flagged")


@register("a20_second_round_flags", ("pair_pixel", "obs", "point"), _ROUND1 + _JUMP + _WHOLE_FLAGS + f""",
 ce AS (SELECT point_id, least(9, floor("row" / ((SELECT max("row") FROM point) + 1)::DOUBLE * 10)) AS rb, least(9, floor(col / ((SELECT max(col) FROM point) + 1)::DOUBLE * 10)) AS cb FROM point),
 cn AS (SELECT date, rb, cb, sum(CAST({_RES} > th AS INT)) AS n FROM r JOIN ce USING (point_id), th GROUP BY ALL),
 sc AS (SELECT strftime(date, '%Y%m%d') AS date, CASE WHEN c <= 0.2 THEN 'global' WHEN c <= 0.4 THEN 'mixed' ELSE 'local' END AS scope FROM (SELECT date, CASE WHEN sum(n) = 0 THEN 0 ELSE max(n) / CAST(sum(n) AS DOUBLE) END AS c FROM cn GROUP BY date) JOIN wf USING (date) WHERE flagged),
 pe AS (SELECT r1.*, least(0.2, coalesce(CASE a.scope WHEN 'global' THEN 0.1 WHEN 'mixed' THEN 0.05 WHEN 'local' THEN 0.025 END, 0) + coalesce(CASE b.scope WHEN 'global' THEN 0.1 WHEN 'mixed' THEN 0.05 WHEN 'local' THEN 0.025 END, 0) + CASE WHEN consistency < 0.5 THEN 0.1 ELSE 0 END)::DOUBLE AS penalty FROM r1 LEFT JOIN sc a ON date1 = a.date LEFT JOIN sc b ON date2 = b.date)
 SELECT date1, date2, round(penalty, 6) AS penalty, round(greatest(0, q1 - penalty), 6) AS q_round2, {_ACT.format("greatest(0, q1 - penalty)")} AS action FROM pe""")
def a20_flags(pixels, obs, points):
    """Both rounds with the whole date rule and the jump threshold of A11."""
    obs = materialise(series.residuals(obs))
    jump = series.residual_threshold(obs)
    return _second_round(pixels, obs, points, series.flag_dates(series.date_quality(obs, jump)), series.concentration(obs, points, jump))


@register("p15_coverage_warnings", ("point",), _SCORE + ", n AS (SELECT count(*) FILTER (ps_score >= 0.75) AS strict, count(*) FILTER (ps_score >= 0.6 AND ps_score < 0.75) AS relaxed, greatest(1, count(*)) AS n FROM s) SELECT strict, relaxed, concat_ws(',', CASE WHEN strict / n < 0.005 OR strict < 2000 THEN 'too_sparse' END, CASE WHEN strict / n > 0.2 THEN 'strict_too_loose' END, CASE WHEN (strict + relaxed) / n > 0.4 THEN 'strict_relaxed_too_loose' END) AS reasons FROM n")
def p15(points):
    return feedback.coverage_warnings(_scored_points(points))


@register("p16_zone_type", ("obs", "point"), _FIT + ", z AS (SELECT col % 10 AS zone, slope FROM g JOIN point USING (point_id)) SELECT zone, CASE WHEN avg(CAST(slope > 0 AS INT)) > 0.25 AND avg(CAST(slope < 0 AS INT)) > 0.25 THEN 'mixed' WHEN median(slope) < -1 THEN 'subsidence' WHEN median(slope) > 1 THEN 'uplift' ELSE 'mixed' END AS zone_type FROM z GROUP BY zone")
def p16(obs, points):
    return feedback.zone_type(series.trend(obs).join(points, "point_id").select((F.col("col") % 10).alias("zone"), F.col("slope").alias("velocity")))


@register("ts08_anomaly_exposure", ("obs",), _DELTA + ", m AS (SELECT epoch_idx, median(abs(delta)) AS m FROM d WHERE delta IS NOT NULL GROUP BY epoch_idx), e AS (SELECT point_id, avg(abs(delta)) FILTER (epoch_idx IN (SELECT epoch_idx FROM m WHERE m > (SELECT quantile_cont(m, 0.8) FROM m))) AS x FROM d GROUP BY point_id), l AS (SELECT quantile_cont(x, 0.05) AS a, quantile_cont(x, 0.95) AS b FROM e) SELECT point_id, round(CASE WHEN x IS NULL OR b <= a THEN 0 ELSE least(1, greatest(0, (x - a) / (b - a))) END, 6) AS exposure FROM e, l")
def ts08(obs):
    return feedback.anomaly_exposure(series.steps(obs), series.loud_epochs(obs))


@register("ts11_without_height", ("obs", "point"), "r AS (SELECT obs.*, height_m FROM obs JOIN point USING (point_id)), f AS (SELECT epoch_idx, coalesce(regr_slope(value_mm, height_m), 0) AS b, avg(height_m) AS h, avg(value_mm) AS v FROM r GROUP BY epoch_idx) SELECT point_id, epoch_idx, round(value_mm - v - b * (height_m - h), 4) AS value_mm FROM r JOIN f USING (epoch_idx)")
def ts11(obs, points):
    return feedback.without_height(obs, points).withColumn("value_mm", F.round("value_mm", 4))


@register("ts12_without_ramp", ("obs", "point"), """r AS (SELECT obs.*, "row" AS y, col AS x FROM obs JOIN point USING (point_id)), f AS (SELECT epoch_idx, var_pop(y) AS yy, covar_pop(x, y) AS xy, var_pop(x) AS xx, covar_pop(value_mm, y) AS yv, covar_pop(value_mm, x) AS xv, avg(y) AS y0, avg(x) AS x0, avg(value_mm) AS v0 FROM r GROUP BY epoch_idx)
 SELECT point_id, epoch_idx, round(value_mm - v0 - CASE WHEN yy * xx - xy * xy > 1e-9 THEN ((yv * xx - xv * xy) * (y - y0) + (xv * yy - yv * xy) * (x - x0)) / (yy * xx - xy * xy) ELSE 0 END, 4) AS value_mm FROM r JOIN f USING (epoch_idx)""")
def ts12(obs, points):
    return feedback.without_ramp(obs, points).withColumn("value_mm", F.round("value_mm", 4))


@register("g14_neighbour_summaries", ("point", "obs"), _XY + ", k AS (SELECT src, dst FROM (SELECT *, row_number() OVER (PARTITION BY src ORDER BY round(dist_m, 6), dst) AS rank FROM e) WHERE rank <= 8), " + _DELTA + " SELECT src AS point_id, epoch_idx, round(avg(value_mm), 4) AS mean_mm, round(avg(delta), 4) AS mean_delta, round(stddev_pop(delta), 4) AS deviation_delta FROM k JOIN d ON d.point_id = dst GROUP BY src, epoch_idx")
def g14(points, obs):
    found = neighbours.summaries(neighbours.nearest(points, 8, cell=150.0), series.steps(obs))
    return found.select("point_id", "epoch_idx", *[F.round(c, 4).alias(c) for c in ("mean_mm", "mean_delta", "deviation_delta")])


@register("j16_boundary", ("point",), _XY + ", " + _SCORE + " SELECT DISTINCT dst AS point_id FROM e JOIN s ON src = s.point_id AND ps_score >= 0.75 WHERE dist_m <= 120 AND dst NOT IN (SELECT point_id FROM s WHERE ps_score >= 0.75)")
def j16(points):
    return neighbours.boundary(neighbours.within_radius(points, 120.0), _scored_points(points).where("point_class = 'strict'"))


@register("f13_buffer_radius", ("point",), 'a AS (SELECT median(abs(q.lon - p.lon)) AS x FROM point p JOIN point q ON p."row" = q."row" AND q.col = p.col + 1 WHERE q.lon <> p.lon), b AS (SELECT median(abs(q.lat - p.lat)) AS y FROM point p JOIN point q ON p.col = q.col AND q."row" = p."row" + 1 WHERE q.lat <> p.lat) SELECT round(0.62 * greatest(coalesce(x, 0), coalesce(y, 0), 3e-4), 6) AS radius FROM a, b')
def f13(points):
    return rasters.buffer_radius(points)
