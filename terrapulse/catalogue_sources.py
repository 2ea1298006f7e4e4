"""Registered queries of files: each writes what the tables give and reads it back, so the twins are plain SELECTs."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from terrapulse.catalogue import _SCORE, _scored_points, register
from terrapulse.session import materialise, shared_dir
from terrapulse.sources import grids, stacks, tables


def _folder(df) -> str:
    return f"{shared_dir(df.sparkSession)}/files/{uuid.uuid4().hex}"


@register("s08_quality_scan", ("point",), "SELECT point_id, round(model_rms, 6) AS model_rms, round(valid_pair_ratio, 6) AS valid_pair_ratio, round(maincc_ratio, 6) AS maincc_ratio, round(jump_risk, 6) AS jump_risk FROM point")
def s08(points):
    path = _folder(points)
    points.write.parquet(path)
    return tables.read_metrics(points.sparkSession, path)


@register("s09_date_flags", ("epoch",), "SELECT epoch_idx, date, epoch_idx % 3 = 1 AS abnormal FROM epoch")
def s09(epochs):
    path = _folder(epochs)
    texts = F.when(F.col("epoch_idx") % 3 == 1, F.element_at(F.array(*map(F.lit, ("1", " TRUE", "Yes "))), F.pmod("epoch_idx", F.lit(3)).cast("int"))).when(F.col("epoch_idx") % 3 == 0, F.lit("no"))
    tables.write_csv(epochs.where("epoch_idx % 3 <> 2").select("date", texts.alias("final_abnormal_flag")), path)
    return tables.date_flags(epochs, tables.read_csv(epochs.sparkSession, path, "date date, final_abnormal_flag string")).select("epoch_idx", "date", "abnormal")


@register("s10_delay_grids", ("point",), """SELECT CASE WHEN k = 0 THEN '20200101' ELSE '20200113' END AS date, "row" AS lat_idx, col AS lon_idx, round(30 + "row" * 0.001::DOUBLE, 6) AS lat, round(103 + col * 0.001::DOUBLE, 6) AS lon, round(CAST(height_m AS FLOAT)::DOUBLE + k, 3) AS ztd
 FROM point, range(0, 2) t(k) WHERE "row" < (SELECT max("row") FROM point)""")
def s10(points):
    """The heights of all whole rows of the raster as delay grids of two dates, written north first."""
    top = points.agg(F.max("row").alias("_h"))
    whole = points.join(F.broadcast(top)).where("row < _h").select("row", "col", "height_m")
    two = whole.select(F.explode(F.array(F.lit(0), F.lit(1))).alias("k"), "*")
    grid = two.select(F.when(F.col("k") == 0, "20200101").otherwise("20200113").alias("date"), F.col("row").alias("lat_idx"), F.col("col").alias("lon_idx"), (30 + F.col("row") * 0.001).alias("lat"), (103 + F.col("col") * 0.001).alias("lon"), (F.col("height_m").cast("float").cast("double") + F.col("k")).alias("ztd"))
    path = _folder(points)
    grids.write_files(grids.delay_grid_files(grid), path)
    back = grids.read_delay_grids(points.sparkSession, path, partValues="700")
    return back.withColumn("ztd", F.round(F.col("ztd").cast("double"), 3))


@register("s13_footprints", ("scene",), """s AS (SELECT path, frame, 30 + path * 0.1::DOUBLE AS lat, 103 + frame * 0.2::DOUBLE AS lon FROM (SELECT DISTINCT path, frame FROM scene)), b AS (SELECT path, min(lat) AS s, max(lat) + 1 AS n, min(lon) AS w, max(lon) + 1 AS e FROM s GROUP BY path)
 SELECT round(max(s), 6) AS south, round(min(n), 6) AS north, round(max(w), 6) AS west, round(min(e), 6) AS east, count(*) AS n_dates FROM b""")
def s13(scenes):
    """Each path as a scene, each frame as a swath with the corners of its box, as annotation files."""
    point = lambda dy, dx: F.format_string("<geolocationGridPoint><line>0</line><latitude>%.8f</latitude><longitude>%.8f</longitude></geolocationGridPoint>", F.col("lat") + dy, F.col("lon") + dx)
    boxes = scenes.select("path", "frame").distinct().withColumns({"lat": 30 + F.col("path") * 0.1, "lon": 103 + F.col("frame") * 0.2})
    text = F.concat(F.lit("<product><geolocationGrid><list>"), point(0.0, 0.0), point(1.0, 1.0), F.lit("</list></geolocationGrid></product>"))
    path = _folder(scenes)
    for r in boxes.select("path").distinct().orderBy("path").collect():  # five regions
        own = boxes.where(F.col("path") == r.path)
        grids.write_files(own.select(F.format_string("s1a-iw%d-slc-vv-x.xml", "frame").alias("name"), text.alias("content")), f"{path}/P{r.path}.SAFE/annotation")
    return grids.common_bounds(grids.footprint_points(scenes.sparkSession, f"{path}/*.SAFE/annotation/*.xml"))


@register("s14_baselines", ("pair_pixel",), "SELECT date1 || '_' || date2 AS pair, round(avg(v), 4) AS bperp FROM (SELECT date1, date2, round(avg(unw), 2) AS v FROM pair_pixel GROUP BY date1, date2 UNION ALL SELECT DISTINCT date1, date2, 2.5 FROM pair_pixel) GROUP BY ALL")
def s14(pixels):
    found = pixels.groupBy("date1", "date2").agg(F.round(F.avg("unw"), 2).alias("v"))
    text = F.concat(F.lit("swath 1\nBperp (average): "), F.format_string("%.2f", "v"), F.lit("\nBpar: 7\nBperp at center: 2.50\n"))
    path = _folder(pixels)
    grids.write_files(found.select(F.concat_ws("_", "date1", "date2").alias("_p"), text.alias("content")).select(F.concat("_p", F.lit(".txt")).alias("name"), "content"), path)
    return tables.read_baselines(pixels.sparkSession, path).withColumn("bperp", F.round("bperp", 4))


_STYLED = _SCORE + """, hc AS (SELECT row_number() OVER (ORDER BY "row", col) AS uid, round(lon, 6) AS longitude, round(lat, 6) AS latitude, round(tcoh, 3) AS tcoh, round((height_m - 1400.0::DOUBLE) / 25, 3) AS los_mm_yr, round(model_rms, 3) AS velocity_std_mm_yr FROM s WHERE ps_score >= 0.6)"""


def _confident(points):
    df = _scored_points(points).withColumns({"velocity": (F.col("height_m") - 1400.0) / 25, "deviation": F.col("model_rms")})
    return tables.high_confidence(df.withColumn("point_class", F.when(F.col("point_class") != "none", "strict")))


@register("s18_confident_points", ("point",), _STYLED + " SELECT * FROM hc")
def s18(points):
    """Strict and relaxed points count as strict, as the test tables have few."""
    path = _folder(points)
    tables.write_csv(_confident(points), path)
    return tables.read_csv(points.sparkSession, path, "uid long, longitude double, latitude double, tcoh double, los_mm_yr double, velocity_std_mm_yr double")


@register(
    "s18_styled_points",
    ("point",),
    _STYLED + """, c AS (SELECT greatest(quantile_cont(abs(los_mm_yr), 0.95), 1) AS m FROM hc), x AS (SELECT hc.*, greatest(-1, least(1, los_mm_yr / m)) AS x FROM hc, c WHERE uid <= 40)
 SELECT uid, CAST(CASE WHEN x < 0 THEN 255 ELSE floor(255 * (1 - x)) END AS INTEGER) AS red, CAST(CASE WHEN x < 0 THEN floor(255 * (1 + x)) ELSE floor(255 * (1 - x)) END AS INTEGER) AS green, CAST(CASE WHEN x < 0 THEN floor(255 * (1 + x)) ELSE 255 END AS INTEGER) AS blue FROM x""",
)
def s18_styled(points):
    return tables.styled(materialise(_confident(points)), most=40).select("uid", "red", "green", "blue")


@register("s20_written_points", ("point",), "SELECT point_id, round(lon, 6) AS lon, round(lat, 6) AS lat, round(tcoh, 6) AS tcoh FROM point")
def s20(points):
    """All points, without a limit."""
    path = _folder(points)
    tables.write_points(points.select("point_id", "lon", "lat", "tcoh"), path)
    return tables.read_csv(points.sparkSession, path, "point_id long, lon double, lat double, tcoh double")


@register("s21_features", ("point",), "SELECT point_id, round(lon, 6) AS lon, round(lat, 6) AS lat, round(tcoh, 6) AS tcoh, 'Point' AS kind FROM point")
def s21(points):
    path = _folder(points)
    tables.write_features(points.select("point_id", "lon", "lat", "tcoh"), path)
    parsed = F.from_json("value", "geometry struct<type:string,coordinates:array<double>>, properties struct<point_id:bigint,tcoh:double>").alias("f")
    back = points.sparkSession.read.text(path).select(parsed)
    return back.select("f.properties.point_id", F.get("f.geometry.coordinates", 0).alias("lon"), F.get("f.geometry.coordinates", 1).alias("lat"), "f.properties.tcoh", F.col("f.geometry.type").alias("kind"))


@register("s22_zone_table", ("point",), """SELECT CAST(point_id % 7 AS VARCHAR) AS zone, printf('%.6f', round(sum(height_m), 2)) AS area_km2, printf('%.8f', count(*) / 100000.0::DOUBLE) AS area_share, '[' || CAST(min(point_id) AS VARCHAR) || ',' || CAST(max(point_id) AS VARCHAR) || ']' AS box FROM point GROUP BY point_id % 7""")
def s22(points):
    records = points.groupBy((F.col("point_id") % 7).alias("zone")).agg(F.round(F.sum("height_m"), 2).alias("area_km2"), (F.count(F.lit(1)) / 100000.0).alias("area_share"), F.array(F.min("point_id"), F.max("point_id")).alias("box"))
    path = _folder(points)
    tables.zone_table(records).write.option("header", True).option("quoteAll", True).csv(path)
    return tables.read_csv(points.sparkSession, path, "zone string, area_km2 string, area_share string, box string")


@register("s30_typed_table", ("point",), "SELECT point_id, CAST(\"row\" AS INTEGER) AS \"row\", CASE WHEN point_id % 5 = 0 THEN NULL ELSE round(tcoh, 6) END AS tcoh FROM point")
def s30(points):
    path = _folder(points)
    tables.write_csv(points.select("point_id", "row", F.when(F.col("point_id") % 5 != 0, F.col("tcoh")).alias("tcoh")), path)
    return tables.read_csv(points.sparkSession, path, "point_id long, row int, tcoh double")


@register("s27_cropped_geometry", ("point",), 'SELECT CAST(("row" - 1) // 2 AS INTEGER) AS "row", CAST((col - 4) // 3 AS INTEGER) AS col, round(CAST(lat AS FLOAT)::DOUBLE, 4) AS latitude, round(CAST(lon AS FLOAT)::DOUBLE, 4) AS longitude, round(CAST(height_m AS FLOAT)::DOUBLE, 2) AS height FROM point WHERE "row" BETWEEN 1 AND 10 AND ("row" - 1) % 2 = 0 AND col BETWEEN 4 AND 33 AND (col - 4) % 3 = 0')
def s27(points):
    """The crop has no grid of its own: five by ten cells of the full one, every second row and third column."""
    full = points.select("row", "col", F.col("lat").alias("latitude"), F.col("lon").alias("longitude"), F.col("height_m").alias("height"))
    found = stacks.geometry(None, full, shape=(5, 10), offset=(1, 4), stride=(2, 3))
    return found.select("row", "col", *[F.round(F.col(c).cast("double"), n).alias(c) for c, n in (("latitude", 4), ("longitude", 4), ("height", 2))])
