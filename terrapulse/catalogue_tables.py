"""Registered queries of small table shapes, with their DuckDB twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from terrapulse.catalogue import _METRICS, register
from terrapulse.operators import pairs, tables


@register("a38_pair_matrix", ("pair_pixel",), _METRICS + "SELECT date1, max(CASE action WHEN 'keep' THEN 2 WHEN 'downweight' THEN 1 ELSE 0 END) FILTER (date2 = '19930101') AS d19930101, max(CASE action WHEN 'keep' THEN 2 WHEN 'downweight' THEN 1 ELSE 0 END) FILTER (date2 = '19930201') AS d19930201 FROM p GROUP BY date1")
def a38(pixels):
    found = tables.pair_matrix(pairs.scored(pairs.metrics(pixels)), ["19930101", "19930201"], tables.action_code(F.col("action")))
    return found.select("date1", F.col("19930101").alias("d19930101"), F.col("19930201").alias("d19930201"))


@register(
    "j05_increment_audit",
    ("pair_pixel", "obs"),
    "k AS (SELECT DISTINCT date1, date2 FROM pair_pixel), o AS (SELECT point_id, strftime(date, '%Y%m%d') AS d, value_mm FROM obs), m AS (SELECT date1, date2, abs(b.value_mm - a.value_mm) AS s FROM k JOIN o a ON a.d = date1 JOIN o b ON b.d = date2 AND a.point_id = b.point_id), "
    "g AS (SELECT date1, date2, count(s) AS n, avg(CAST(s > 28 AS INT)) AS x, median(s) AS y FROM m GROUP BY ALL) SELECT date1, date2, n, round(x, 6) AS jump_share, round(y, 3) AS median_mm FROM k LEFT JOIN g USING (date1, date2)",
)
def j05(pixels, obs):
    return tables.increment_audit(pixels.select("date1", "date2").distinct(), obs).withColumn("median_mm", F.round("median_mm", 3))


@register("a09_window_choice", ("point",), "w AS (SELECT col % 3 AS place, 20 - 10 * (col % 3) AS pad, avg(CASE WHEN col % 3 > 0 OR col > 5 THEN 1.0 ELSE 0.0 END) AS coverage FROM point GROUP BY ALL), f AS (SELECT coverage AS c, pad AS p FROM w WHERE place = 0), g AS (SELECT min_by(pad, place) AS fp FROM w WHERE coverage >= 0.95) SELECT CASE WHEN c >= 0.95 THEN p ELSE coalesce(fp, p) END AS pad, CASE WHEN fp IS NOT NULL THEN 'delay_grid' ELSE 'height_correlation' END AS method, CASE WHEN c >= 0.99 THEN 'ok' WHEN c >= 0.95 THEN 'warn_continue' WHEN fp IS NOT NULL THEN 'auto_shrink_padding' ELSE 'fallback_height_correlation' END AS status FROM f, g")
def a09(points):
    good = F.when((F.col("col") % 3 > 0) | (F.col("col") > 5), 1.0).otherwise(0.0)
    windows = points.groupBy((F.col("col") % 3).alias("place")).agg(F.avg(good).alias("coverage")).withColumn("pad", 20 - 10 * F.col("place"))
    return tables.window_choice(windows)


@register("t08_top_of_array", ("point",), "a AS (SELECT \"row\", list(tcoh ORDER BY col) AS x FROM point GROUP BY \"row\"), u AS (SELECT \"row\", unnest(x) AS value, generate_subscripts(x, 1) - 1 AS i FROM a) SELECT \"row\", CAST(i AS INTEGER) AS i, value FROM (SELECT *, row_number() OVER (PARTITION BY \"row\" ORDER BY value DESC, i) AS k FROM u) WHERE k <= 3")
def t08(points):
    arrays = points.groupBy("row").agg(F.transform(F.sort_array(F.collect_list(F.struct("col", "tcoh"))), lambda s: s["tcoh"]).alias("x"))
    return arrays.select("row", F.inline(tables.top_of_array(F.col("x"), 3)))


@register("f07_design_rows", ("epoch",), "SELECT epoch_idx, round(day_offset / 365.25, 6) AS t, round(sin(2 * pi() * day_offset / 365.25), 6) + 0.0 AS s, round(cos(2 * pi() * day_offset / 365.25), 6) + 0.0 AS c FROM epoch")
def f07(epochs):
    x = tables.design_row(F.col("day_offset"))
    return epochs.select("epoch_idx", F.get(x, 1).alias("t"), F.get(x, 2).alias("s"), F.get(x, 3).alias("c"))


@register("f15_date_strings", ("epoch",), "SELECT epoch_idx, strftime(date, '%Y%m%d') AS iso, strftime(date, '%Y%m%d') AS compact, CAST(NULL AS VARCHAR) AS other FROM epoch")
def f15(epochs):
    iso = F.concat(F.date_format("date", "yyyy-MM-dd"), F.lit("T01:02:03"))
    compact = F.concat(F.date_format("date", "yyyyMMdd"), F.lit("_x"))
    named = {"iso": iso, "compact": compact, "other": F.lit("none")}
    return epochs.select("epoch_idx", *[tables.date_string(c).alias(n) for n, c in named.items()])


@register("f16_period_label", ("epoch",), "SELECT strftime(min(date), '%Y-%m-%d') || ' to ' || strftime(max(date), '%Y-%m-%d') AS label FROM epoch")
def f16(epochs):
    return epochs.agg(tables.period_label(F.min("date"), F.max("date")).alias("label"))


@register("t13_best_points", ("point",), "SELECT point_id, round(tcoh, 6) AS tcoh FROM point ORDER BY round(tcoh, 9) DESC, point_id LIMIT 6")
def t13(points):
    return tables.best_points(points, "tcoh").select("point_id", "tcoh")
