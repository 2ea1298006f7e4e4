"""Registered queries of raster features, seeds and completed pair rules, with their DuckDB twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from terrapulse.catalogue import _FEED, _METRICS, _ROUND1, _SCORE, _ACT, _pair_residuals, _scored_points, register
from terrapulse.operators import feedback, pairs, seeds

_CELLS = (
    _SCORE
    + """, pt AS (SELECT s.*, (height_m - 1400.0::DOUBLE) / 25 AS v, ps_score >= 0.75 AS strict, ps_score >= 0.6 AS good FROM s),
 z AS (SELECT max("row") AS h, max(col) AS w, median(v) AS med FROM pt),
 b1 AS (SELECT p."row", p.col, avg(y.v) AS mean FROM pt p, z, range(-5, 6) i(i), range(-5, 6) j(j)
  JOIN pt y ON y."row" = greatest(0, least(h, p."row" + i)) AND y.col = greatest(0, least(w, p.col + j)) GROUP BY ALL),
 b2 AS (SELECT p."row", p.col, stddev_pop(y.v) AS deviation FROM pt p, z, range(-2, 3) i(i), range(-2, 3) j(j)
  JOIN pt y ON y."row" = greatest(0, least(h, p."row" + i)) AND y.col = greatest(0, least(w, p.col + j)) GROUP BY ALL),
 la AS (SELECT CAST(r AS INTEGER) AS "row", CAST(c AS INTEGER) AS col, med FROM (SELECT unnest(range(0, h + 1)) AS r, w, med FROM z), LATERAL (SELECT unnest(range(0, w + 1)) AS c)),
 xx AS (SELECT "row", col, coalesce(v, med) AS x FROM la LEFT JOIN pt USING ("row", col)),
 gr AS (SELECT "row", col, coalesce((lead(x) OVER a - lag(x) OVER a) / 2, lead(x) OVER a - x, x - lag(x) OVER a, 0) AS gx,
  coalesce((lead(x) OVER b - lag(x) OVER b) / 2, lead(x) OVER b - x, x - lag(x) OVER b, 0) AS gy
  FROM xx WINDOW a AS (PARTITION BY "row" ORDER BY col), b AS (PARTITION BY col ORDER BY "row")),
 ft AS (SELECT pt.*, abs(v) AS speed, mean, abs(v - mean) AS anomaly, sqrt(gx * gx + gy * gy) AS gradient, deviation
  FROM pt JOIN b1 USING ("row", col) JOIN b2 USING ("row", col) JOIN gr USING ("row", col))"""
)
_RANGES = ", rg AS (SELECT " + ", ".join(f"quantile_cont({c}, 0.05) AS {c}_lo, quantile_cont({c}, 0.95) AS {c}_hi" for c in seeds.SPREAD_WEIGHTS) + " FROM ft)"
_SUM = " + ".join(
    [f"{w} * coalesce(least(1, greatest(0, ({c} - {c}_lo) / nullif({c}_hi - {c}_lo, 0))), 0)" for c, w in seeds.SPREAD_WEIGHTS.items()]
    + [f"{w} * least(1, greatest(0, {c}))" for c, w in seeds.UNIT_WEIGHTS.items()]
    + [f"{seeds.STRICT_WEIGHT} * CAST(strict AS INT)"]
)
_PROBABILITY = f'{_RANGES}, pb AS (SELECT "row", col, least(1, greatest(0, {_SUM})) AS probability FROM ft, rg)'


def _features(points):
    grid = _scored_points(points).withColumns({"velocity": (F.col("height_m") - 1400.0) / 25, "exposure": F.lit(0.0)})
    return seeds.features(grid)


@register("m01_features", ("point",), _CELLS + ' SELECT "row", col, round(speed, 4) AS speed, CAST(sign(v) AS DOUBLE) AS sign, round(mean, 4) AS local_mean, round(anomaly, 4) AS anomaly, round(gradient, 4) AS gradient, round(deviation, 3) AS deviation, CAST(strict AS DOUBLE) AS strict, CAST(good AND NOT strict AS DOUBLE) AS relaxed FROM ft')
def m01(points):
    measured = [F.round(c, 4).alias(c) for c in ("speed", "local_mean", "anomaly", "gradient")]
    return _features(points).select("row", "col", "sign", *measured, F.round("deviation", 3).alias("deviation"), "strict", "relaxed")


@register(
    "m03_weak_seeds",
    ("point",),
    _CELLS
    + """, th AS (SELECT greatest(5, quantile_cont(speed, 0.95)) AS fast, greatest(3, quantile_cont(anomaly, 0.94)) AS odd, greatest(1.5, quantile_cont(speed, 0.4)) AS slow,
  greatest(1.2, quantile_cont(anomaly, 0.45)) AS even, greatest(0.5, quantile_cont(gradient, 0.45)) AS flat, greatest(0.75, quantile_cont(deviation, 0.45)) AS calm FROM ft),
 sp AS (SELECT a."row", a.col FROM ft a JOIN ft b ON abs(a."row" - b."row") <= 1 AND abs(a.col - b.col) <= 1, th WHERE b.speed >= greatest(3, fast * 0.6)
  GROUP BY ALL HAVING count(*) FILTER (b.v > 0) >= 4 OR count(*) FILTER (b.v < 0) >= 4),
 mv AS (SELECT "row", col FROM ft, th WHERE (tcoh >= 0.65 OR ps_score >= 0.5 OR good) AND speed >= fast AND anomaly >= odd AND ("row", col) IN (SELECT ("row", col) FROM sp)),
 st AS (SELECT "row", col FROM ft, th WHERE speed <= slow AND anomaly <= even AND gradient <= flat AND deviation <= calm AND tcoh >= 0.7)
 SELECT "row", col, 1 AS seed FROM mv UNION ALL SELECT "row", col, 0 FROM st WHERE NOT EXISTS (SELECT 1 FROM mv WHERE (mv."row" - st."row") ** 2 + (mv.col - st.col) ** 2 < 16)""",
)
def m03(points):
    return seeds.weak_seeds(_features(points))


@register("m04_probability", ("point",), _CELLS + _PROBABILITY + ' SELECT "row", col, round(probability, 5) AS probability FROM pb')
def m04(points):
    return seeds.probability(_features(points)).withColumn("probability", F.round("probability", 5))


@register(
    "m07_fused",
    ("point",),
    _CELLS
    + _PROBABILITY
    + ', f7 AS (SELECT p."row", p.col, p.probability AS own, avg(y.probability) AS mean FROM pb p, z, range(-3, 4) i(i), range(-3, 4) j(j) JOIN pb y ON y."row" = greatest(0, least(h, p."row" + i)) AND y.col = greatest(0, least(w, p.col + j)) GROUP BY ALL) SELECT "row", col, round(0.68 * own + 0.32 * mean, 4) AS probability FROM f7',
)
def m07(points):
    return seeds.fused(seeds.probability(_features(points))).withColumn("probability", F.round("probability", 4))


@register("r05_same_sign", ("point",), 'c AS (SELECT "row", col, (height_m - 1400.0::DOUBLE) / 25 AS v FROM point) SELECT a."row", a.col, count(*) FILTER (b.v >= 3) AS up, count(*) FILTER (b.v <= -3) AS down FROM c a JOIN c b ON abs(a."row" - b."row") <= 1 AND abs(a.col - b.col) <= 1 GROUP BY ALL')
def r05(points):
    moving = points.withColumn("velocity", (F.col("height_m") - 1400.0) / 25)
    return seeds.same_sign(moving.withColumns({"speed": F.abs("velocity"), "sign": F.signum("velocity")}), F.lit(3.0))


@register(
    "f20_hillshade",
    ("point",),
    """z AS (SELECT max("row") AS h, max(col) AS w, avg(height_m) AS m FROM point),
 la AS (SELECT CAST(r AS INTEGER) AS "row", CAST(c AS INTEGER) AS col, m FROM (SELECT unnest(range(0, h + 1)) AS r, w, m FROM z), LATERAL (SELECT unnest(range(0, w + 1)) AS c)),
 xx AS (SELECT "row", col, 2 * coalesce(height_m, m) AS x FROM la LEFT JOIN point USING ("row", col)),
 gr AS (SELECT "row", col, coalesce((lead(x) OVER a - lag(x) OVER a) / 2, lead(x) OVER a - x, x - lag(x) OVER a, 0) / 111.0::DOUBLE AS gx,
  coalesce((lead(x) OVER b - lag(x) OVER b) / 2, lead(x) OVER b - x, x - lag(x) OVER b, 0) / 111.0::DOUBLE AS gy
  FROM xx WINDOW a AS (PARTITION BY "row" ORDER BY col), b AS (PARTITION BY col ORDER BY "row"))
 SELECT "row", col, round(least(1, greatest(0, sin(radians(45)) * cos(atan(sqrt(gx * gx + gy * gy))) + cos(radians(45)) * sin(atan(sqrt(gx * gx + gy * gy))) * cos(radians(315) - atan2(-gx, gy)))), 5) AS shade FROM gr""",
)
def f20(points):
    return seeds.hillshade(points, "height_m", 0.001).withColumn("shade", F.round("shade", 5))


@register("j08_near_any", ("point",), 'SELECT point_id FROM point p WHERE EXISTS (SELECT 1 FROM point s WHERE s.tcoh > 0.95 AND (s."row" - p."row") ** 2 + (s.col - p.col) ** 2 <= 4)')
def j08(points):
    return seeds.near_any(points, points.where("tcoh > 0.95"), 2).select("point_id")


@register("a10_jump_risk", ("pair_pixel", "obs", "point"), _FEED.replace("x AS (SELECT date1", "x AS (SELECT point_id, date1") + " SELECT point_id, round(avg(CAST(ok AS INT)), 6) AS valid_pair_ratio, round(avg(CAST(main AS INT)), 6) AS maincc_ratio, round(count(*) FILTER (ok AND res > 28) / greatest(1, count(*) FILTER (ok)), 6) AS jump_risk FROM x GROUP BY point_id")
def a10_jumps(pixels, obs, points):
    return feedback.point_jumps(_pair_residuals(pixels, obs, points), 28.0)


_COVER = ", dc AS (SELECT strftime(date, '%Y%m%d') AS d, (epoch_idx % 5) / 4.0::DOUBLE AS coverage FROM epoch), ov AS (SELECT date1, date2, least(coalesce(a.coverage, 1), coalesce(b.coverage, 1)) AS overlap FROM (SELECT DISTINCT date1, date2 FROM pair_pixel) LEFT JOIN dc a ON a.d = date1 LEFT JOIN dc b ON b.d = date2)"


@register(
    "a14_first_round_overlap",
    ("epoch", "pair_pixel", "obs", "point"),
    _ROUND1 + _COVER + f", r2 AS (SELECT date1, date2, overlap, CASE WHEN k.date1 IS NULL THEN 0 ELSE q1 - 0.10 + 0.10 * overlap END AS q FROM r1 JOIN ov USING (date1, date2) LEFT JOIN k USING (date1, date2)) SELECT date1, date2, round(overlap, 6) AS overlap, round(q, 6) AS q_round1, {_ACT.format('q')} AS action_round1 FROM r2",
)
def a14_overlap(epochs, pixels, obs, points):
    cover = epochs.select(F.date_format("date", "yyyyMMdd").alias("date"), ((F.col("epoch_idx") % 5) / 4.0).alias("coverage"))
    known = feedback.pair_metrics(_pair_residuals(pixels, obs, points))
    every = feedback.with_overlap(pixels.select("date1", "date2").distinct(), cover)
    return feedback.first_round(every, known).select("date1", "date2", "overlap", "q_round1", "action_round1")


@register("a35_network", ("pair_pixel",), _METRICS + "SELECT date1, date2, round(coh_mean, 6) AS coherence, action <> 'drop' AS kept FROM p")
def a35_pairs(pixels):
    return pairs.network(pairs.scored(pairs.metrics(pixels)))


@register("a36_redundancy", ("pair_pixel",), _METRICS + "SELECT count(*) // 2 AS pairs, count(DISTINCT date) AS dates, round(count(*) / 2.0::DOUBLE / (count(DISTINCT date) - 1), 6) AS redundancy, count(*) / 2.0::DOUBLE > 1.5 * (count(DISTINCT date) - 1) AS enough FROM (SELECT unnest([date1, date2]) AS date FROM p WHERE action <> 'drop')")
def a36(pixels):
    return pairs.redundancy(pairs.scored(pairs.metrics(pixels)))
