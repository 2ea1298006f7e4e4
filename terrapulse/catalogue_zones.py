"""Registered queries over the support graph and regions, with their DuckDB twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from terrapulse.catalogue import _SCORE, _XY, _scored_points, register
from terrapulse.operators import series, support
from terrapulse.operators.neighbours import summaries

_TRACES = """tr AS (SELECT *, value_mm - first_value(value_mm) OVER w AS v, value_mm - lag(value_mm) OVER w AS d FROM obs WINDOW w AS (PARTITION BY point_id ORDER BY epoch_idx)),
sh AS (SELECT point_id, max_by(v, epoch_idx) AS net, max(abs(v)) AS peak, coalesce(sum(abs(d)) FILTER (abs(d) > 0.25), 0) AS path, count(*) FILTER (d > 0.25) AS up, count(*) FILTER (d < -0.25) AS down,
 regr_slope(value_mm, day_offset / 365.25::DOUBLE) AS trend FROM tr GROUP BY point_id),
f0 AS (SELECT *, least(1, greatest(0, 0.5 * CASE WHEN path > 0 THEN abs(net) / greatest(path, 0.001) ELSE 0 END + 0.5 * greatest(up, down) / greatest(1, up + down))) AS temporal_coherence,
 CAST(CASE WHEN abs(net) < 1 THEN sign(trend) ELSE sign(net) END AS INTEGER) AS sgn FROM sh)
"""


@register("w14_temporal_coherence", ("obs",), _TRACES + "SELECT point_id, round(temporal_coherence, 6) AS temporal_coherence FROM f0")
def w14(obs):
    return support.coherence(series.shape(obs)).select("point_id", "temporal_coherence")


@register("p17_main_sign", ("obs",), _TRACES + "SELECT point_id, sgn AS sign FROM f0")
def p17(obs):
    both = series.shape(obs).join(series.trend(obs).select("point_id", "slope"), "point_id")
    return both.select("point_id", support.main_sign(F.col("net"), F.col("slope")).alias("sign"))


_PAIRS = "pr AS (SELECT a.point_id AS src, b.point_id AS dst FROM (SELECT DISTINCT point_id FROM obs) a JOIN (SELECT DISTINCT point_id FROM obs) b ON b.point_id = a.point_id + 1)"


@register("f11_trace_correlation", ("obs",), _TRACES + f", {_PAIRS} SELECT src, dst, round(corr(a.v, b.v), 6) AS corr FROM pr JOIN tr a ON a.point_id = src JOIN tr b ON b.point_id = dst AND a.epoch_idx = b.epoch_idx GROUP BY ALL")
def f11(obs):
    ids = obs.select(F.col("point_id").alias("src")).distinct()
    pairs = ids.join(ids.select((F.col("src") - 1).alias("k"), F.col("src").alias("dst")), F.col("src") == F.col("k")).select("src", "dst")
    t = support.traces(obs)
    return support.correlations(pairs, t.withColumnRenamed("point_id", "src"), t.withColumnRenamed("point_id", "dst"))


_GRAPH = (
    _SCORE
    + ", sp AS (SELECT * FROM s WHERE point_id IN (SELECT point_id FROM obs)), "
    + _XY.replace("FROM point", "FROM sp")
    + ", kn AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY src ORDER BY round(dist_m, 6), dst) AS rank FROM e) WHERE rank <= 4), "
    + _TRACES
    + """, nb AS (SELECT src, epoch_idx, avg(v) AS b FROM kn JOIN tr ON tr.point_id = dst GROUP BY ALL),
tc AS (SELECT nb.src AS point_id, corr(v, b) AS trace_corr FROM nb JOIN tr ON tr.point_id = nb.src AND tr.epoch_idx = nb.epoch_idx GROUP BY ALL),
nr AS (SELECT src AS point_id, avg(net) AS n, avg(peak) AS p, avg(dist_m) / 1000 AS four, min(dist_m) / 1000 AS one FROM kn JOIN f0 ON f0.point_id = dst GROUP BY src),
f1 AS (SELECT f0.*, coalesce(trace_corr, 0) AS trace_corr, coalesce(abs(net - n), 0) AS contrast_net, coalesce(abs(peak - p), 0) AS contrast_peak, abs(net) AS anet, abs(trend) AS atrend, (SELECT median(one) FROM nr) AS edge_km,
 coalesce(greatest((SELECT median(one) FROM nr), 0.001) / greatest(four, 0.001), 0) AS dens, sp.ps_score, sp.tcoh, sp.valid_pair_ratio, sp.maincc_ratio, sp.lat, sp.lon FROM f0 JOIN sp USING (point_id) LEFT JOIN nr USING (point_id) LEFT JOIN tc USING (point_id))
"""
)


def _z(c: str) -> str:
    med = f"(SELECT median({c}) FROM f1)"
    return f"least(8, greatest(-5, ({c} - {med}) / greatest(1.4826 * (SELECT median(abs({c} - {med})) FROM f1), 0.001)))"


_SALIENT = f"""f2 AS (SELECT *, 1 / (1 + exp(-{_z('dens')})) AS density, least(1, greatest(0, 0.35 * ps_score + 0.25 * tcoh + 0.20 * valid_pair_ratio + 0.20 * maincc_ratio)) AS qc_support,
 0.45 * {_z('peak')} + 0.35 * {_z('anet')} + 0.20 * {_z('atrend')} AS al, 0.60 * {_z('contrast_peak')} + 0.40 * {_z('contrast_net')} AS cl FROM f1),
f3 AS (SELECT *, 1 / (1 + exp(-al)) AS activity, 1 / (1 + exp(-(0.42 * al + 0.24 * cl + 1.10 * (temporal_coherence - 0.45) + 0.55 * (trace_corr - 0.35) + 0.35 * (density - 0.45) + 0.25 * (qc_support - 0.55)))) AS saliency FROM f2),
th AS (SELECT greatest(0.5, quantile_cont(saliency, 0.8)) AS ta, greatest(0.62, quantile_cont(saliency, 0.92)) AS tcore, quantile_cont(activity, 0.75) AS tv FROM f3),
f4 AS (SELECT *, sgn <> 0 AND saliency >= 0.3 * ta AND temporal_coherence >= 0.2 AND qc_support >= 0.3 AS loose, sgn <> 0 AND saliency >= ta AND temporal_coherence >= 0.48 AND qc_support >= 0.5 AS active,
 sgn <> 0 AND saliency >= ta AND temporal_coherence >= 0.55 AND qc_support >= 0.5 AND saliency >= tcore AND activity >= tv AS core FROM f3, th)
"""


def _points_with_series(points, obs):
    return _scored_points(points).join(obs.select("point_id").distinct(), "point_id", "left_semi")


def _features(points, obs):
    good = _points_with_series(points, obs)
    edges = support.neighbourhood(good, 4, 150.0)
    return support.features(obs, good, edges), edges


@register(
    "g01_support_features",
    ("point", "obs"),
    _GRAPH + f"SELECT point_id, round(trace_corr, 5) AS trace_corr, round(contrast_net, 4) AS contrast_net, round(contrast_peak, 4) AS contrast_peak, round(1 / (1 + exp(-{_z('dens')})), 5) AS density FROM f1",
)
def g01(points, obs):
    df, _ = _features(points, obs)
    return df.select("point_id", F.round("trace_corr", 5).alias("trace_corr"), F.round("contrast_net", 4).alias("contrast_net"), F.round("contrast_peak", 4).alias("contrast_peak"), F.round("density", 5).alias("density"))


@register("g02_saliency", ("point", "obs"), _GRAPH + ", " + _SALIENT + "SELECT point_id, round(qc_support, 5) AS qc_support, round(activity, 5) AS activity, round(saliency, 5) AS saliency FROM f3", kept=("obs",))
def g02(points, obs):
    df, _ = _features(points, obs)
    return support.saliency(df).select("point_id", *[F.round(c, 5).alias(c) for c in ("qc_support", "activity", "saliency")])


@register("g03_active_and_core", ("point", "obs"), _GRAPH + ", " + _SALIENT + "SELECT point_id, active, core FROM f4", kept=("obs",))
def g03(points, obs):
    df, _ = _features(points, obs)
    return support.flagged(support.saliency(df)).select("point_id", "active", "core")


_EDGES = """ge AS (SELECT kn.src, kn.dst, corr(a.v, b.v) AS corr FROM kn JOIN f3 x ON x.point_id = src JOIN f3 y ON y.point_id = dst JOIN tr a ON a.point_id = src JOIN tr b ON b.point_id = dst AND a.epoch_idx = b.epoch_idx
 WHERE x.sgn = y.sgn AND x.qc_support >= 0.3 AND y.qc_support >= 0.3 AND dist_m / 1000 <= greatest(4.5 * x.edge_km, 0.10) GROUP BY ALL)
"""


@register("g04_graph_edges", ("point", "obs"), _GRAPH + ", " + _SALIENT + ", " + _EDGES + "SELECT src, dst, round(corr, 5) AS corr FROM ge WHERE corr >= 0.05", kept=("obs",))
def g04(points, obs):
    """With looser limits than usual, as the test series are nearly independent."""
    df, edges = _features(points, obs)
    loose = support.saliency(df).withColumn("active", F.col("qc_support") >= 0.3)
    return support.graph_edges(loose, edges, obs, least=0.05).withColumn("corr", F.round("corr", 5))


@register("g05_regions", ("point", "obs"), None, kept=("obs",))
def g05_regions(points, obs):
    df, edges = _features(points, obs)
    df = support.flagged(support.saliency(df)).withColumn("active", F.col("qc_support") >= 0.3)
    return support.regions(df, support.graph_edges(df, edges, obs, least=0.05))


_ZONES = """mb AS (SELECT point_id % 3 AS zone, point_id FROM sp), ce AS (SELECT zone, epoch_idx, avg(v) AS c FROM mb JOIN tr USING (point_id) GROUP BY ALL),
cc AS (SELECT zone, point_id, corr(v, c) AS k FROM mb JOIN tr USING (point_id) JOIN ce USING (zone, epoch_idx) GROUP BY ALL),
md AS (SELECT zone, point_id AS medoid FROM (SELECT *, row_number() OVER (PARTITION BY zone ORDER BY round(k, 9) DESC, point_id) AS i FROM cc) WHERE i = 1),
ic AS (SELECT mb.zone, mb.point_id, medoid, corr(a.v, b.v) AS k FROM mb JOIN md USING (zone) JOIN tr a ON a.point_id = mb.point_id JOIN tr b ON b.point_id = medoid AND a.epoch_idx = b.epoch_idx GROUP BY ALL),
im AS (SELECT zone, medoid, median(k) AS internal_corr FROM ic GROUP BY ALL),
nx AS (SELECT DISTINCT zone, dst AS point_id FROM mb JOIN kn ON kn.src = mb.point_id WHERE dst % 3 <> zone),
si AS (SELECT zone, 0.6 * median(abs(net)) + 0.4 * median(peak) AS inside FROM mb JOIN f0 USING (point_id) GROUP BY zone), so AS (SELECT zone, 0.6 * median(abs(net)) + 0.4 * median(peak) AS outside FROM nx JOIN f0 USING (point_id) GROUP BY zone),
bc AS (SELECT zone, inside, coalesce(outside, 0) AS outside, least(1.5, greatest(0, (inside - coalesce(outside, 0)) / greatest(inside, 1))) AS boundary_contrast FROM si LEFT JOIN so USING (zone))
"""


def _members(df):
    return df.select((F.col("point_id") % 3).alias("zone"), "point_id")


def _centre(members, obs):
    return members.join(support.traces(obs), "point_id").groupBy("zone", "epoch_idx").agg(F.avg("v").alias("v"))


@register("g09_medoids", ("point", "obs"), _GRAPH + ", " + _ZONES + "SELECT zone, medoid, round(internal_corr, 6) AS internal_corr FROM im", kept=("obs",))
def g09(points, obs):
    members = _members(_points_with_series(points, obs))
    return support.medoids(members, obs, _centre(members, obs))


@register("a29_boundary_contrast", ("point", "obs"), _GRAPH + ", " + _ZONES + "SELECT zone, round(inside, 4) AS inside, round(outside, 4) AS outside, round(boundary_contrast, 6) AS boundary_contrast FROM bc", kept=("obs",))
def a29(points, obs):
    df, edges = _features(points, obs)
    out = support.contrasts(_members(df), df, edges)
    return out.withColumns({c: F.round(c, 4) for c in ("inside", "outside")})


_SUMMARY = """ar AS (SELECT point_id, 0.01 AS km2 FROM sp),
zs AS (SELECT zone, count(*) AS points, count(*) FILTER (core) AS core_points, 0.01 * count(*) AS area_km2, median(temporal_coherence) AS temporal_coherence, median(peak) AS activity, avg(saliency) AS probability, avg(lon) AS lon, avg(lat) AS lat,
 median(trend) AS median_velocity, quantile_cont(trend, 0.1) AS p10_velocity, quantile_cont(trend, 0.9) AS p90_velocity, max(abs(trend)) AS max_velocity, 0.01 * count(*) / (SELECT 0.01 * count(*) FROM sp) AS area_share FROM mb JOIN f4 USING (point_id) GROUP BY zone),
zz AS (SELECT zs.*, medoid, internal_corr, inside, outside, boundary_contrast, sqrt(greatest(area_share, 1e-8)) * greatest(internal_corr, 0) * greatest(temporal_coherence, 0) * greatest(boundary_contrast, 0.05) * ln(1 + greatest(activity, 0)) AS region_score
 FROM zs JOIN im USING (zone) JOIN bc USING (zone))
"""
_ALL = _GRAPH + ", " + _SALIENT + ", " + _ZONES + ", " + _SUMMARY


def _summaries(points, obs):
    df, edges = _features(points, obs)
    df = support.flagged(support.saliency(df)).withColumns({"area_km2": F.lit(0.01), "velocity": F.col("trend")})
    members = _members(df)
    return support.summaries(members, df, edges, obs, _centre(members, obs))


_FIGURES = ("area_km2", "temporal_coherence", "activity", "probability", "median_velocity", "p10_velocity", "p90_velocity", "max_velocity", "area_share", "internal_corr", "boundary_contrast", "region_score")


@register("a28_region_summaries", ("point", "obs"), _ALL + "SELECT zone, points, core_points, medoid, " + ", ".join(f"round({c}, 4) AS {c}" for c in _FIGURES) + " FROM zz", kept=("obs",))
def a28(points, obs):
    return _summaries(points, obs).select("zone", "points", "core_points", "medoid", *[F.round(c, 4).alias(c) for c in _FIGURES])


@register(
    "g10_retained_regions",
    ("point", "obs"),
    _ALL
    + """, l AS (SELECT max(area_share) AS ma, max(region_score) AS ms, quantile_cont(activity, 0.8) AS qa FROM zz), r AS (SELECT zz.*, 0.15 + 0.1 * zone AS compactness, l.* FROM zz, l),
w AS (SELECT *, list_filter([CASE WHEN area_share < greatest(0.0008, 0.25 * ma) THEN 'area_fraction_below_threshold' END, CASE WHEN points < 256 THEN 'support_point_count_below_threshold' END, CASE WHEN internal_corr < 0.6 THEN 'internal_trace_corr_below_threshold' END,
 CASE WHEN temporal_coherence < 0.55 THEN 'temporal_coherence_below_threshold' END, CASE WHEN compactness < 0.2 THEN 'compactness_below_threshold' END, CASE WHEN region_score < 0.35 * ms THEN 'region_score_below_threshold' END], lambda x: x IS NOT NULL) AS why FROM r)
SELECT zone, CASE WHEN len(why) = 0 THEN 'regional_main' END AS mode, array_to_string(why, ',') AS reasons FROM w""",
    kept=("obs",),
)
def g10(points, obs):
    df = _summaries(points, obs).withColumn("compactness", 0.15 + 0.1 * F.col("zone"))
    n = obs.select("point_id").distinct().count()
    return support.retained(df, n).select("zone", "mode", "reasons")


_KM = "sqrt(((k.lon - r.lon) * 111320.0 * cos(radians((k.lat + r.lat) / 2))) ** 2 + ((k.lat - r.lat) * 110540.0) ** 2) / 1000"


@register(
    "g11_joining_regions",
    ("point", "obs"),
    _ALL
    + f""", k AS (SELECT * FROM zz WHERE zone = 0), r AS (SELECT * FROM zz WHERE zone > 0), c AS (SELECT r.zone, k.zone AS into_, k.region_score, {_KM} AS km, corr(a.c, b.c) AS x FROM r, k JOIN ce b ON b.zone = k.zone JOIN ce a ON a.zone = r.zone AND a.epoch_idx = b.epoch_idx
 WHERE r.region_score >= greatest(0.002, 0.2 * k.region_score) GROUP BY ALL) SELECT zone, into_ AS "into" FROM c WHERE km <= 2 AND x >= 0.95""".replace("FROM r, k JOIN", "FROM r CROSS JOIN k JOIN"),
    kept=("obs",),
)
def g11(points, obs):
    df = _summaries(points, obs).withColumn("zone_type", F.lit("subsidence"))
    members = _members(_points_with_series(points, obs))
    return support.joining(df.where("zone = 0"), df.where("zone > 0"), _centre(members, obs))


@register("u04_merged_members", ("point",), "SELECT DISTINCT CASE WHEN point_id % 4 = 3 THEN 1 ELSE point_id % 4 END AS zone, point_id % 90 AS point_id FROM point")
def u04(points):
    members = points.select((F.col("point_id") % 4).alias("zone"), (F.col("point_id") % 90).alias("point_id"))
    joins = points.sparkSession.createDataFrame([(3, 1)], "zone long, into long")
    return support.merged_members(members, joins)


_CLAIMS = 'cl AS (SELECT point_id % 5 AS z, "row", col // 3 AS col FROM point)'


@register("u05_exclusive_cells", ("point",), _CLAIMS + 'SELECT "row", col, min(z) AS zone_order FROM cl GROUP BY ALL')
def u05(points):
    return support.exclusive(points.select((F.col("point_id") % 5).alias("zone_order"), "row", F.expr("col div 3").alias("col")))


_MASKS = _CLAIMS + ', mk AS (SELECT DISTINCT z AS mask, "row", col FROM cl), sz AS (SELECT mask, count(*) AS n FROM mk GROUP BY mask), io AS (SELECT a.mask AS a, b.mask AS b, count(*) AS i FROM mk a JOIN mk b ON a."row" = b."row" AND a.col = b.col AND a.mask < b.mask GROUP BY ALL), iu AS (SELECT a, b, i / (x.n + y.n - i) AS iou FROM io JOIN sz x ON x.mask = a JOIN sz y ON y.mask = b)'


def _masks(points):
    return points.select((F.col("point_id") % 5).alias("mask"), "row", F.expr("col div 3").alias("col")).distinct()


@register("j17_mask_overlaps", ("point",), _MASKS + " SELECT a, b, round(iou, 6) AS iou FROM iu")
def j17(points):
    return support.overlaps(_masks(points))


@register(
    "j17_suppressed_masks",
    ("point",),
    _MASKS
    + """, o AS (SELECT mask, row_number() OVER (ORDER BY (mask * 7) % 5 DESC, mask) AS k FROM sz), walk(k, kept) AS (SELECT CAST(0 AS BIGINT), CAST([] AS BIGINT[]) UNION ALL
 SELECT o.k, CASE WHEN (SELECT count(*) FROM iu WHERE iou > 0.15 AND ((a = o.mask AND list_contains(kept, b)) OR (b = o.mask AND list_contains(kept, a)))) = 0 THEN list_append(kept, o.mask) ELSE kept END FROM walk JOIN o ON o.k = walk.k + 1)
 SELECT unnest(kept) AS mask FROM (SELECT kept FROM walk ORDER BY k DESC LIMIT 1)""",
    recursive=True,
)
def j17b(points):
    masks = _masks(points)
    scores = masks.select("mask").distinct().withColumn("score", (F.col("mask") * 7 % 5).cast("double"))
    return support.suppressed(scores, support.overlaps(masks))


_RECORDS = "zr AS (SELECT point_id % 11 AS zone, 0.01 * count(*) AS area_km2, median(tcoh) AS median_velocity, round(avg(maincc_ratio), 9) AS continuity FROM point GROUP BY zone)"


def _zone_records(points):
    zone = (F.col("point_id") % 11).alias("zone")
    return points.groupBy(zone).agg((F.count(F.lit(1)) * 0.01).alias("area_km2"), F.median("tcoh").alias("median_velocity"), F.round(F.avg("maincc_ratio"), 9).alias("continuity"))


@register("t06_largest_zones", ("point",), _RECORDS + " SELECT zone, round(area_km2, 6) AS area_km2, round(median_velocity, 6) AS median_velocity, round(continuity, 6) AS continuity FROM zr ORDER BY round(area_km2, 6) DESC, abs(median_velocity) DESC, continuity DESC, zone LIMIT 6")
def t06(points):
    return support.largest(_zone_records(points).withColumn("area_km2", F.round("area_km2", 6)))


@register("f18_public_records", ("point",), _RECORDS + " SELECT zone, round(area_km2, 6) AS area_km2, round(continuity, 6) AS continuity FROM zr")
def f18(points):
    df = _zone_records(points).drop("median_velocity").withColumns({"trace": F.array(F.lit(1.0)), "box": F.struct(F.lit(0.0).alias("w"))})
    return support.public(df)


@register(
    "g12_graph_statistics",
    ("point", "obs"),
    _GRAPH
    + """, n AS (SELECT count(*) AS nodes FROM sp), dl AS (SELECT point_id, epoch_idx, d AS delta FROM tr), sm AS (SELECT DISTINCT src, epoch_idx FROM kn JOIN tr ON tr.point_id = dst)
SELECT nodes, round((SELECT count(*) FROM kn) / nodes, 6) AS mean_degree, round(1 - (SELECT count(*) FROM sm) / (nodes * 83.0), 6) AS null_share FROM n""",
)
def g12(points, obs):
    """Without the share of the largest component, which a test holds against a plain search."""
    good = _points_with_series(points, obs)
    edges = support.neighbourhood(good, 4, 150.0)
    return support.graph_statistics(edges, good, summaries(edges, series.steps(obs)), 83).drop("largest_share")

