"""Registered queries of file names, window reads and wide point tables, with their DuckDB twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from terrapulse.catalogue import _FIT, register
from terrapulse.operators import series
from terrapulse.sources import stacks


def _files(pixels):
    """Names of the files that the pairs would come from, one velocity file among them."""
    tail = F.when(F.col("date2").endswith("0201"), "_velocity.tif").otherwise(".unw.tif")
    return pixels.select("date1", F.concat(F.lit("/stack/a_1/"), "date1", F.lit("_"), "date2", tail).alias("path"))


@register("s01_pairs_of_files", ("pair_pixel",), "SELECT DISTINCT date1, date2 FROM pair_pixel")
def s01(pixels):
    return stacks.pairs_of_files(_files(pixels))


@register("s04_reference_series", ("pair_pixel",), "f AS (SELECT DISTINCT date1, date2 FROM pair_pixel WHERE right(date2, 4) <> '0201') SELECT date1 AS reference, date2 AS date FROM f WHERE date1 = (SELECT min(date1) FROM f)")
def s04(pixels):
    return stacks.reference_series(_files(pixels).distinct()).select("reference", "date")


@register("s03_window", ("pair_pixel", "point"), "SELECT date1, date2, \"row\" - 1 AS \"row\", col - 10 AS col, count(*) AS n, round(sum(coh), 4) AS coh FROM pair_pixel JOIN point USING (point_id) WHERE \"row\" >= 1 AND \"row\" < 3 AND col >= 10 AND col < 20 GROUP BY ALL")
def s03(pixels, points):
    inside = stacks.read_window(points.select("point_id", "row", "col"), 1, 3, 10, 20)
    return pixels.join(inside, "point_id").groupBy("date1", "date2", "row", "col").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("coh"), 4).alias("coh"))


@register("s06_first_available", ("pair_pixel",), "SELECT min(CASE WHEN right(date1, 4) IN ('0301', '0401') THEN right(date1, 4) END) AS product FROM pair_pixel")
def s06(pixels):
    return stacks.first_available(pixels.select(F.substring("date1", 5, 4).alias("product")), ["0301", "0401"])


@register(
    "s12_validated",
    ("epoch", "pair_pixel"),
    "f AS (SELECT date1 AS date, count(*) AS n FROM pair_pixel WHERE right(date1, 4) <> '0501' GROUP BY date1), x AS (SELECT strftime(e.date, '%Y%m%d') AS date, n FROM epoch e LEFT JOIN f ON f.date = strftime(e.date, '%Y%m%d')), "
    "y AS (SELECT date, CASE WHEN n IS NULL THEN 'missing_data' WHEN right(date, 4) = '0601' THEN 'missing_header' WHEN right(date, 4) = '0701' THEN 'size_mismatch' ELSE '' END AS error FROM x) SELECT date, error = '' AS usable, error FROM y",
)
def s12(epochs, pixels):
    day = F.substring("date", 5, 4)
    files = pixels.where("date1 NOT LIKE '%0501'").groupBy(F.col("date1").alias("date")).agg(F.count(F.lit(1)).alias("width"))
    files = files.select("date", F.lit(True).alias("has_data"), (day != "0601").alias("has_header"), "width", F.lit(1).alias("length"), (F.col("width") * 4 - (day == "0701").cast("int")).alias("size"))
    return stacks.validated(epochs.select(F.date_format("date", "yyyyMMdd").alias("date")), files)


@register("s17_wide_points", ("point", "obs"), _FIT + ", v AS (SELECT point_id, max(value_mm) FILTER (date = DATE '1993-01-01') AS a, max(value_mm) FILTER (date = DATE '1995-06-01') AS b FROM obs GROUP BY point_id) SELECT point_id AS uid, round(lon, 6) AS lon, round(lat, 6) AS lat, round(tcoh, 3) AS coherence, round(slope, 2) AS rate, round(a, 2) AS d19930101, round(b, 2) AS d19950601 FROM point JOIN g USING (point_id) JOIN v USING (point_id)")
def s17(points, obs):
    rated = points.join(series.trend(obs).select("point_id", F.col("slope").alias("rate")), "point_id")
    return stacks.wide_points(rated, obs, ["19930101", "19950601"])
