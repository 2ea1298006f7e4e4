"""Registered queries over bounds, windows, masks and scenes, with their DuckDB twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from terrapulse.catalogue import register
from terrapulse.operators import bounds

#: An area of interest within the point grid: south, north, west, east.
AREA = (30.0005, 30.0025, 103.0095, 103.0305)
_IN = "lat BETWEEN 30.0005 AND 30.0025 AND lon BETWEEN 103.0095 AND 103.0305"
#: A rate in mm a year for points of the grid, which have no series of their own.
RATE_SQL = "((model_rms - 2.013::DOUBLE) * 5.0::DOUBLE + (tcoh - 0.5::DOUBLE) * 20.0::DOUBLE)"


def rate():
    return (F.col("model_rms") - 2.013) * 5.0 + (F.col("tcoh") - 0.5) * 20.0


@register("p02_placed_points", ("point",), "SELECT point_id FROM point WHERE lat > 0.1 AND isfinite(lat) AND isfinite(lon)")
def p02(points):
    return points.where(bounds.has_place(F.col("lat"), F.col("lon"))).select("point_id")


@register("p03_candidate_points", ("point",), 'SELECT point_id FROM point WHERE tcoh >= 0.6 AND lat > 0.1 AND ("row" + col) % 3 <> 0')
def p03(points):
    land = points.where("(row + col) % 3 <> 0").select("row", "col")
    return bounds.candidates(points, F.col("tcoh") >= 0.6, land).select("point_id")


@register("p04_area_points", ("point",), f"SELECT point_id FROM point WHERE {_IN}")
def p04(points):
    s, n, w, e = AREA
    box = F.struct(F.lit(n).alias("n"), F.lit(s).alias("s"), F.lit(e).alias("e"), F.lit(w).alias("w"))
    return points.where(bounds.inside(F.col("lat"), F.col("lon"), box)).select("point_id")


@register(
    "p05_displayed_points",
    ("point",),
    f"SELECT point_id, round({RATE_SQL}, 6) AS velocity FROM point WHERE {RATE_SQL} <> 0 AND tcoh >= 0.4 AND jump_risk * 100 < 80 AND col % 7 <> 0",
)
def p05(points):
    df = points.withColumns({"velocity": rate(), "deviation": F.col("jump_risk") * 100, "land": F.col("col") % 7 != 0})
    return bounds.displayed(df, 0.4).select("point_id", "velocity")


_RING = [(103.005, 30.0), (103.03, 30.0), (103.045, 30.002), (103.02, 30.0035), (103.012, 30.0012)]
_CROSS = " + ".join(
    f"CAST((({y1}::DOUBLE > lat) <> ({y2}::DOUBLE > lat)) AND lon < {x1}::DOUBLE + (lat - {y1}::DOUBLE) * ({x2 - x1}::DOUBLE / {y2 - y1}::DOUBLE) AS INT)"
    for (x1, y1), (x2, y2) in zip(_RING, _RING[1:] + _RING[:1], strict=True)
    if y1 != y2
)


@register("p06_in_polygon", ("point",), f"SELECT point_id FROM point WHERE ({_CROSS}) % 2 = 1")
def p06(points):
    return points.where(bounds.in_polygon(points, _RING)).select("point_id")


@register("p07_safe_flags", ("point",), f"SELECT point_id, CAST({_IN} AS INT) AS safe FROM point")
def p07(points):
    s, n, w, e = AREA
    box = F.struct(F.lit(n).alias("n"), F.lit(s).alias("s"), F.lit(e).alias("e"), F.lit(w).alias("w"))
    return points.select("point_id", bounds.inside(F.col("lat"), F.col("lon"), box).cast("int").alias("safe"))


_ROWB = 'SELECT "row" % 5 AS g, max(lat) AS n, min(lat) AS s, max(lon) AS e, min(lon) AS w FROM point GROUP BY g'


def _boxes(points):
    return bounds.bounds_of(points.withColumn("g", F.col("row") % 5), "g")


@register(
    "p08_cover_tests",
    ("point",),
    f"b AS ({_ROWB}), w AS (SELECT max(n) AS n2, min(s) AS s2, max(e) AS e2, min(w) AS w2 FROM b) SELECT g, "
    "n >= n2 - 0.02 AND e >= e2 - 0.02 AND s <= s2 + 0.02 AND w <= w2 + 0.02 AS covers, n >= n2 - 0.001 AND e >= e2 - 0.001 AND s <= s2 + 0.001 AND w <= w2 + 0.001 AS covers_tight FROM b, w",
)
def p08(points):
    boxes = _boxes(points)
    df = boxes.select("g", F.struct("n", "s", "e", "w").alias("b")).join(F.broadcast(bounds.union_bounds(boxes).select(F.struct("n", "s", "e", "w").alias("all"))))
    return df.select("g", bounds.covers(F.col("b"), F.col("all"), 0.02).alias("covers"), bounds.covers(F.col("b"), F.col("all"), 0.001).alias("covers_tight"))


@register(
    "p09_expanded_bounds",
    ("point",),
    f"b AS ({_ROWB}) SELECT g, round(n + 0.005, 6) AS n, round(s - 0.005, 6) AS s, round(e + 0.005, 6) AS e, round(w - 0.005, 6) AS w, round(n + greatest(0.06, 0.2 * (n - s)), 6) AS n2, round(w - greatest(0.06, 0.2 * (e - w)), 6) AS w2 FROM b",
)
def p09(points):
    df = _boxes(points).select("g", F.struct("n", "s", "e", "w").alias("b"))
    df = df.select("g", bounds.expanded(F.col("b")).alias("x"), bounds.expanded(F.col("b"), ratio=0.2, least=0.06).alias("y"))
    return df.select("g", "x.*", F.col("y.n").alias("n2"), F.col("y.w").alias("w2"))


@register(
    "p10_coverage_gaps",
    ("point",),
    f"b AS ({_ROWB}), a AS (SELECT max(n) AS n2, min(s) AS s2, max(e) AS e2, min(w) AS w2 FROM b) SELECT g, round(greatest(0, n2 - n), 6) AS n, round(greatest(0, s - s2), 6) AS s, round(greatest(0, e2 - e), 6) AS e, round(greatest(0, w - w2), 6) AS w FROM b, a",
)
def p10(points):
    boxes = _boxes(points)
    whole = bounds.union_bounds(boxes).select(F.struct("n", "s", "e", "w").alias("all"))
    return boxes.select("g", F.struct("n", "s", "e", "w").alias("b")).join(F.broadcast(whole)).select("g", bounds.gaps(F.col("all"), F.col("b")).alias("x")).select("g", "x.*")


@register("p11_strided", ("point",), 'SELECT point_id, CAST(("row" - 1) // 2 AS INTEGER) AS "row", CAST((col - 2) // 3 AS INTEGER) AS col FROM point WHERE "row" >= 1 AND col >= 2 AND ("row" - 1) % 2 = 0 AND (col - 2) % 3 = 0')
def p11(points):
    return bounds.strided(points.select("point_id", "row", "col"), 2, 3, 1, 2)


@register("p20_scopes", ("scene",), "SELECT DISTINCT path, CASE path WHEN 0 THEN 'zone_high_confidence_only' WHEN 1 THEN 'scene_high_confidence' WHEN 2 THEN 'zone_high_confidence_only' ELSE 'scene_high_confidence' END AS scope FROM scene")
def p20(scenes):
    names = F.array(*[F.lit(x) for x in (" Zone", "all", "zone_high_confidence_only", "other", "")])
    return scenes.select("path").distinct().select("path", bounds.scope(F.get(names, F.col("path").cast("int"))).alias("scope"))


@register("p21_corrected_rate", ("point",), f'SELECT point_id, round({RATE_SQL} - 0.01 * "row", 6) AS velocity FROM point WHERE col % 2 = 0 UNION ALL SELECT point_id, NULL FROM point WHERE col % 2 = 1')
def p21(points):
    field = points.where("col % 2 = 0").select("row", "col", (F.col("row") * 0.01).alias("motion"))
    return bounds.corrected_rate(points.withColumn("velocity", rate()), field, ["row", "col"]).select("point_id", "velocity")


@register("p22_slant_range", ("point",), "SELECT point_id, round(800000.0::DOUBLE + col * 3 * 2.33::DOUBLE, 6) AS slant_range FROM point")
def p22(points):
    return points.select("point_id", bounds.slant_range(F.col("col"), 800000.0, 2.33).alias("slant_range"))


_PADS = "(VALUES (20, 4, 7), (10, 2, 4), (0, 0, 0)) AS p(pad, dy, dx)"


@register(
    "p23_crop_windows",
    ("point",),
    f"""x AS (SELECT min("row") FILTER ({_IN}) AS r0, max("row") FILTER ({_IN}) AS r1, min(col) FILTER ({_IN}) AS c0, max(col) FILTER ({_IN}) AS c1, max("row") + 1 AS h, max(col) + 1 AS w FROM point),
y AS (SELECT pad, greatest(0, r0 - dy) AS y0, least(h, r1 + dy + 1) AS y1, greatest(0, c0 - dx) AS x0, least(w, c1 + dx + 1) AS x1 FROM x, {_PADS})
SELECT pad, y0, y1, x0, x1, max(lat) AS n, min(lat) AS s, max(lon) AS e, min(lon) AS w FROM y JOIN point ON "row" >= y0 AND "row" < y1 AND col >= x0 AND col < x1 GROUP BY ALL""",
)
def p23(points):
    return bounds.windows(points, AREA, [20, 10, 0])


@register("s29_geocoded_window", ("point",), f'x AS (SELECT min("row") AS r0, max("row") AS r1, min(col) AS c0, max(col) AS c1 FROM point WHERE {_IN}), y AS (SELECT *, greatest(1, (c1 - c0 + 1) // 8) AS k FROM x) SELECT point_id FROM point, y WHERE "row" BETWEEN r0 AND r1 AND col BETWEEN c0 AND c1 AND ("row" - r0) % k = 0 AND (col - c0) % k = 0')
def s29(points):
    return bounds.geocoded_window(points, AREA, 8).select("point_id")


@register("j11_nearest_cell", ("point",), 'g AS (SELECT "row" AS i, col AS j, height_m FROM point WHERE (point_id % 3) > 0), k AS (SELECT point_id, CAST(round_even((lat - 30.0004) / 0.001, 0) AS INTEGER) AS i, CAST(round_even((lon - 103.0003) / 0.001, 0) AS INTEGER) AS j FROM point) SELECT point_id, height_m AS value FROM k LEFT JOIN g USING (i, j)')
def j11(points):
    grid = points.where("point_id % 3 > 0").select(F.col("row").alias("i"), F.col("col").alias("j"), F.col("height_m").alias("value"))
    return bounds.nearest_cell(points, grid, origin=(30.0004, 103.0003), step=(0.001, 0.001), value="value").select("point_id", "value")


_BOX = 'SELECT point_id AS id, lat + 0.0012 AS n, lat - 0.0012 AS s, lon + 0.0009 AS e, lon - 0.0009 AS w FROM point'


def _footprints(points):
    y, x = F.col("lat"), F.col("lon")
    return points.select(F.col("point_id").alias("id"), (y + 0.0012).alias("n"), (y - 0.0012).alias("s"), (x + 0.0009).alias("e"), (x - 0.0009).alias("w"))


@register("j13_intersecting_boxes", ("point",), f"b AS ({_BOX}) SELECT a.id AS a_id, b.id AS b_id FROM b a JOIN b ON a.s <= b.n AND b.s <= a.n AND a.w <= b.e AND b.w <= a.e WHERE a.id % 10 = 0")
def j13(points):
    boxes = _footprints(points)
    return bounds.intersecting(boxes.where("id % 10 = 0"), boxes, 0.002)


@register("j19_contiguous_area", ("point",), f"b AS ({_BOX}) SELECT CAST(1 AS BIGINT) AS parts, round(max(n), 6) AS n, round(min(s), 6) AS s, round(max(e), 6) AS e, round(min(w), 6) AS w FROM b")
def j19(points):
    return bounds.contiguous(_footprints(points), 0.004, 0.001)


@register("a06_union_and_overlap", ("point",), f"b AS ({_ROWB}) SELECT 'union' AS kind, max(n) AS n, min(s) AS s, max(e) AS e, min(w) AS w FROM b UNION ALL SELECT 'overlap', min(n), max(s), min(e), max(w) FROM b HAVING min(n) > max(s) AND min(e) > max(w)")
def a06(points):
    boxes = _boxes(points)
    kind = lambda df, k: df.select(F.lit(k).alias("kind"), "n", "s", "e", "w")
    return kind(bounds.union_bounds(boxes), "union").union(kind(bounds.overlap_bounds(boxes), "overlap"))


_COMBOS = """d AS (SELECT path, frame, CAST(start_ts AS DATE) AS d, count(*) AS n FROM scene GROUP BY ALL),
c AS (SELECT path, d, [frame] AS frames, n FROM d UNION ALL SELECT a.path, a.d, [a.frame, b.frame], a.n + b.n FROM d a JOIN d b ON a.path = b.path AND a.d = b.d AND a.frame < b.frame
 UNION ALL SELECT a.path, a.d, [a.frame, b.frame, c.frame], a.n + b.n + c.n FROM d a JOIN d b ON a.path = b.path AND a.d = b.d AND a.frame < b.frame JOIN d c ON a.path = c.path AND a.d = c.d AND b.frame < c.frame),
g AS (SELECT path, frames, count(*) AS dates, CAST(sum(n) AS BIGINT) AS scenes FROM c GROUP BY ALL) """


@register("j12_frame_combinations", ("scene",), _COMBOS + "SELECT path, array_to_string(frames, ',') AS frames, dates, scenes FROM g")
def j12(scenes):
    return bounds.frame_combinations(scenes).withColumn("frames", F.array_join(F.transform("frames", lambda x: x.cast("string")), ","))


@register("t03_best_frames", ("scene",), _COMBOS + "SELECT path, array_to_string(frames, ',') AS frames, dates, scenes FROM g ORDER BY list_contains(frames, 3) DESC, dates DESC, len(frames), scenes DESC, path, frames LIMIT 1")
def t03(scenes):
    found = bounds.frame_combinations(scenes).withColumn("covers", F.array_contains("frames", 3))
    return bounds.best_combination(found).select("path", F.array_join(F.transform("frames", lambda x: x.cast("string")), ",").alias("frames"), "dates", "scenes")


@register("u01_labelled_union", ("point",), "SELECT point_id, CASE WHEN tcoh >= 0.7 THEN 'strict' ELSE 'relaxed' END AS label FROM point WHERE tcoh >= 0.5")
def u01(points):
    return bounds.labelled_union(points.where("tcoh >= 0.7"), points.where("tcoh >= 0.5"))


@register("s11_header_bounds", ("point",), "h AS (SELECT col % 3 AS g, count(*) AS width, 1 + max(point_id) AS length, min(lon) AS x, max(lat) AS y FROM point GROUP BY g) SELECT g, round(y, 6) AS n, round(y - 0.001::DOUBLE * (length - 1), 6) AS s, round(x + 0.002::DOUBLE * (width - 1), 6) AS e, round(x, 6) AS w FROM h")
def s11(points):
    header = points.groupBy((F.col("col") % 3).alias("g")).agg(
        F.count(F.lit(1)).alias("width"), (F.max("point_id") + 1).alias("length"), F.min("lon").alias("x_first"), F.max("lat").alias("y_first"), F.lit(0.002).alias("x_step"), F.lit(-0.001).alias("y_step")
    )
    return bounds.header_bounds(header)


@register("a37_geometry_check", ("point",), 'a AS (SELECT max("row") + 1 AS a_rows, max(col) + 1 AS a_cols FROM point) SELECT a_rows, a_cols, a_rows AS b_rows, a_cols AS b_cols, CAST(3 AS BIGINT) AS probes, CAST(2 AS BIGINT) AS matching, false AS ok FROM a')
def a37(points):
    moved = points.withColumn("lon", F.when((F.col("row") == 1) & (F.col("col") == 7), F.col("lon") + 0.01).otherwise(F.col("lon")))
    return bounds.geometry_check(points, moved, [(0, 5), (1, 7), (2, 9)])
