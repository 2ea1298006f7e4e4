"""Bounds, windows and masks of grids and footprints."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrapulse.functions.stats import with_stats
from terrapulse.operators.components import connected_components
from terrapulse.session import materialise

#: Looks of a grid cell in rows and columns.
STRIDE_ROW, STRIDE_COL = 6, 3
#: Names of the scopes of a forecast, and the one that others fall back to.
SCOPES = {"all": "scene_high_confidence", "scene": "scene_high_confidence", "zone": "zone_high_confidence_only", "zone_only": "zone_high_confidence_only"}
DEFAULT_SCOPE = "scene_high_confidence"
_BOX = ("id", "n", "s", "e", "w")


def has_place(lat: Column, lon: Column, *, zero_is_missing: bool = True) -> Column:
    """Finite coordinates; with ``zero_is_missing`` latitudes up to 0.1 are unfilled cells, which leaves out the south."""
    known = lat.isNotNull() & lon.isNotNull() & ~F.isnan(lat) & ~F.isnan(lon)
    return known & (lat > 0.1) if zero_is_missing else known


def inside(lat: Column, lon: Column, b: Column) -> Column:
    """Within bounds ``struct<n, s, e, w>``, edges included."""
    return lat.between(b["s"], b["n"]) & lon.between(b["w"], b["e"])


def covers(outer: Column, inner: Column, tolerance: float) -> Column:
    """``outer`` reaches ``inner`` on all sides but for the tolerance."""
    north_east = (outer["n"] >= inner["n"] - tolerance) & (outer["e"] >= inner["e"] - tolerance)
    return north_east & (outer["s"] <= inner["s"] + tolerance) & (outer["w"] <= inner["w"] + tolerance)


def expanded(b: Column, *, ratio: float = 0.0, least: float = 0.005) -> Column:
    """Bounds wider by ``ratio`` of their extent, by ``least`` degrees at least, on each side, held on the globe."""
    dy, dx = F.greatest(F.lit(least), (b["n"] - b["s"]) * ratio), F.greatest(F.lit(least), (b["e"] - b["w"]) * ratio)
    return F.struct(
        F.least(F.lit(90.0), b["n"] + dy).alias("n"),
        F.greatest(F.lit(-90.0), b["s"] - dy).alias("s"),
        F.least(F.lit(180.0), b["e"] + dx).alias("e"),
        F.greatest(F.lit(-180.0), b["w"] - dx).alias("w"),
    )


def gaps(required: Column, current: Column) -> Column:
    """Degrees that ``current`` lacks on each side (P10)."""
    lack = lambda x: F.greatest(F.lit(0.0), x)
    return F.struct(
        lack(required["n"] - current["n"]).alias("n"),
        lack(current["s"] - required["s"]).alias("s"),
        lack(required["e"] - current["e"]).alias("e"),
        lack(current["w"] - required["w"]).alias("w"),
    )


def bounds_of(df: DataFrame, *keys: str, lat: str = "lat", lon: str = "lon") -> DataFrame:
    """Bounds of points, by ``keys`` if given."""
    return df.groupBy(*keys).agg(F.max(lat).alias("n"), F.min(lat).alias("s"), F.max(lon).alias("e"), F.min(lon).alias("w"))


def union_bounds(boxes: DataFrame, *keys: str) -> DataFrame:
    """Bounds of all footprints together."""
    return boxes.groupBy(*keys).agg(F.max("n").alias("n"), F.min("s").alias("s"), F.max("e").alias("e"), F.min("w").alias("w"))


def overlap_bounds(boxes: DataFrame, *keys: str) -> DataFrame:
    """What all footprints share; none where they do not."""
    out = boxes.groupBy(*keys).agg(F.min("n").alias("n"), F.max("s").alias("s"), F.min("e").alias("e"), F.max("w").alias("w"))
    return out.where("n > s AND e > w")


def _spread(boxes: DataFrame, cell: float) -> DataFrame:
    """A row ``cx, cy, id, n, s, e, w`` for each cell that a box covers or touches."""
    cells = lambda lo, hi: F.sequence(F.floor(F.col(lo) / cell), F.floor(F.col(hi) / cell))
    df = boxes.withColumn("cy", F.explode(cells("s", "n"))).withColumn("cx", F.explode(cells("w", "e")))
    return df.select("cx", "cy", *_BOX)


def _touch(a, b) -> Column:
    """Boxes share a point, edges included; ``a`` and ``b`` give the column of a side."""
    return (a("s") <= b("n")) & (b("s") <= a("n")) & (a("w") <= b("e")) & (b("w") <= a("e"))


def _met(a: DataFrame, b: DataFrame, cell: float) -> DataFrame:
    """Pairs ``(a_id, b_id)`` of boxes of one cell that touch, each from the cell that holds the south-west corner of what they share.

    The join is merged: files of boxes are small enough to be broadcast long after their rows in cells are not.
    """
    a, b = (df.select("cx", "cy", *[F.col(c).alias(f"{p}_{c}") for c in _BOX]) for df, p in ((a, "a"), (b, "b")))
    corner = (F.col("cy") == F.floor(F.greatest("a_s", "b_s") / cell)) & (F.col("cx") == F.floor(F.greatest("a_w", "b_w") / cell))
    return a.join(b.hint("merge"), ["cx", "cy"]).where(_touch(lambda c: F.col(f"a_{c}"), lambda c: F.col(f"b_{c}")) & corner).select("a_id", "b_id")


def _touching(a: DataFrame, b: DataFrame, cell: float) -> DataFrame:
    """Pairs ``(a_id, b_id)`` of boxes that touch, each once for boxes with ids of their own."""
    return _met(_spread(a, cell), _spread(b, cell), cell)


def intersecting(a: DataFrame, b: DataFrame, cell: float) -> DataFrame:
    """Pairs ``(a_id, b_id)`` of boxes ``id, n, s, e, w`` that touch: an equi-join on the cells that boxes cover.

    ``cell`` is about the size of a box; a much larger box covers many cells.
    """
    return _touching(a, b, cell).distinct()


def _hub_links(boxes: DataFrame, cell: float) -> DataFrame:
    """Edges ``(src, dst)`` between a few of the boxes, with as many connected parts as the boxes that touch have.

    Of the boxes that meet in a cell the one that covers most of it is the hub, and those that touch it are linked to it alone: a row a
    box and cell, however many boxes lie upon each other.  Only boxes that do not touch the hub are held against all of their cell.
    So boxes are linked to hubs and to such boxes; a box links these to the least of them, and is a vertex itself only if it is one of them.
    """
    met = _spread(boxes, cell)
    extent = lambda at, lo, hi: F.least(F.col(hi), (F.col(at) + 1) * cell) - F.greatest(F.col(lo), F.col(at) * cell)
    share = extent("cy", "s", "n") * extent("cx", "w", "e")
    hub = F.max(F.struct(share.alias("share"), *_BOX)).over(Window.partitionBy("cx", "cy"))
    near = _touch(F.col, lambda c: F.col("hub")[c])
    seen = met.withColumn("hub", hub).select("id", F.when(near, F.col("hub.id")).alias("node"), F.when(~near, F.struct("cx", "cy", *_BOX)).alias("rest"))
    seen = materialise(seen)
    links, rest = seen.where("rest IS NULL").select("id", "node"), seen.where("rest IS NOT NULL").select("rest.*")
    if not rest.isEmpty():
        pairs = materialise(_met(rest, met, cell))
        links = links.union(pairs.select("b_id", "a_id")).union(pairs.select("a_id", "a_id"))
    least = F.min("node").over(Window.partitionBy("id"))
    return links.select(least.alias("src"), F.col("node").alias("dst")).distinct()


def contiguous(boxes: DataFrame, cell: float, buffer: float = 0.005) -> DataFrame:
    """Number of connected parts of boxes widened by ``buffer``, and their common bounds; one part is one area.

    As in the reference, the buffer is not held on the globe: a box beyond a pole would be turned over and cover all cells up to it.
    """
    wide = boxes.where("id IS NOT NULL").select("id", *[(F.col(c) + d).alias(c) for c, d in (("n", buffer), ("s", -buffer), ("e", buffer), ("w", -buffer))])
    edges = materialise(_hub_links(wide, cell))
    parts = connected_components(edges).agg(F.count_distinct("component").alias("parts"))
    return parts.join(union_bounds(boxes))


def in_polygon(points: DataFrame, ring: list[tuple[float, float]], lat: str = "lat", lon: str = "lon") -> Column:
    """Even-odd rule over the edges of a closed ring of (lon, lat); the ring is a constant of a few hundred corners."""
    y, x = F.col(lat), F.col(lon)
    crossings = F.lit(0)
    for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1], strict=True):
        if y1 != y2:
            at = F.lit(x1) + (y - F.lit(y1)) * F.lit((x2 - x1) / (y2 - y1))
            crossings = crossings + (((F.lit(y1) > y) != (F.lit(y2) > y)) & (x < at)).cast("int")
    return crossings % 2 == 1


def strided(pixels: DataFrame, row_step: int = STRIDE_ROW, col_step: int = STRIDE_COL, row_off: int = 0, col_off: int = 0) -> DataFrame:
    """Every ``row_step``-th row and ``col_step``-th column from the offset on, numbered anew."""
    r, c = F.col("row") - row_off, F.col("col") - col_off
    kept = pixels.where((r >= 0) & (c >= 0) & (r % row_step == 0) & (c % col_step == 0))
    return kept.withColumns({"row": F.floor(r / row_step).cast("int"), "col": F.floor(c / col_step).cast("int")})


def slant_range(col: Column, start: float, pixel: float, stride: int = STRIDE_COL) -> Column:
    """Range to a column of a strided grid."""
    return F.lit(start) + col * F.lit(float(stride) * pixel)


def corrected_rate(rates: DataFrame, field: DataFrame, keys: list[str], rate: str = "velocity", by: str = "motion") -> DataFrame:
    """Rates less a field joined by ``keys``; where the field has no value the rate is unknown."""
    return rates.join(field.select(*keys, by), keys, "left").withColumn(rate, F.col(rate) - F.col(by)).drop(by)


def windows(pixels: DataFrame, area: tuple[float, float, float, float], pads: list[int]) -> DataFrame:
    """For each padding the half-open window of rows and columns around ``area`` (s, n, w, e), and its bounds.

    One scan finds the extent of grid and area; a second one the bounds of all windows at once, each window a conditional
    aggregate, so pixels are not multiplied by the paddings.
    """
    s, n, w, e = area
    ok = has_place(F.col("lat"), F.col("lon"))
    here = ok & F.col("lat").between(s, n) & F.col("lon").between(w, e)
    pick = lambda f, c: f(F.when(here, F.col(c)))
    extent = pixels.agg(
        pick(F.min, "row").alias("r0"), pick(F.max, "row").alias("r1"), pick(F.min, "col").alias("c0"), pick(F.max, "col").alias("c1"),
        (F.max("row") + 1).alias("h"), (F.max("col") + 1).alias("w"),
    ).where("r0 IS NOT NULL")

    def edges(pad: int) -> tuple[Column, Column, Column, Column]:
        dy, dx = math.ceil(pad / STRIDE_ROW), math.ceil(pad / STRIDE_COL)
        low = lambda c, d: F.greatest(F.lit(0), F.col(c) - d)
        return low("r0", dy), F.least(F.col("h"), F.col("r1") + dy + 1), low("c0", dx), F.least(F.col("w"), F.col("c1") + dx + 1)

    met = pixels.where(ok).select("row", "col", "lat", "lon").join(F.broadcast(extent))
    rows = []
    for pad in pads:
        y0, y1, x0, x1 = edges(pad)
        within = (F.col("row") >= y0) & (F.col("row") < y1) & (F.col("col") >= x0) & (F.col("col") < x1)
        side = lambda f, c, within=within: f(F.when(within, F.col(c)))
        rows.append(F.struct(
            F.lit(pad).alias("pad"), *[F.first(x).alias(k) for x, k in ((y0, "y0"), (y1, "y1"), (x0, "x0"), (x1, "x1"))],
            side(F.max, "lat").alias("n"), side(F.min, "lat").alias("s"), side(F.max, "lon").alias("e"), side(F.min, "lon").alias("w"),
        ))
    return met.agg(F.array(*rows).alias("x")).select(F.inline("x")).where("y0 IS NOT NULL")


def displayed(points: DataFrame, coherence: float, most_deviation: float = 80.0) -> DataFrame:
    """Points worth showing: a rate that is finite and not zero, coherent, steady, on land (P5).  Missing ``land`` counts as land."""
    v = F.col("velocity")
    steady = F.col("deviation").isNull() | (F.col("deviation") < most_deviation)
    return points.where(v.isNotNull() & ~F.isnan(v) & (v != 0) & (F.col("tcoh") >= coherence) & steady & F.coalesce("land", F.lit(True)))


def candidates(points: DataFrame, ps_flag: Column, land: DataFrame | None = None) -> DataFrame:
    """Points with the flag, a place and, where a mask of cells ``row, col`` is given, on land."""
    kept = points.where(ps_flag & has_place(F.col("lat"), F.col("lon")))
    return kept if land is None else kept.join(land.select("row", "col"), ["row", "col"], "left_semi")


def geocoded_window(points: DataFrame, area: tuple[float, float, float, float], columns: int) -> DataFrame:
    """Cells of the rows and columns that hold ``area`` (s, n, w, e), thinned to about ``columns`` columns."""
    s, n, w, e = area
    here = points.where(F.col("lat").between(s, n) & F.col("lon").between(w, e))
    box = here.agg(F.min("row").alias("_r0"), F.max("row").alias("_r1"), F.min("col").alias("_c0"), F.max("col").alias("_c1"))
    step = F.greatest(F.lit(1), F.floor((F.col("_c1") - F.col("_c0") + 1) / columns)).alias("_step")
    df = points.join(F.broadcast(box.select("*", step))).where("row BETWEEN _r0 AND _r1 AND col BETWEEN _c0 AND _c1")
    return df.where("(row - _r0) % _step = 0 AND (col - _c0) % _step = 0").drop("_r0", "_r1", "_c0", "_c1", "_step")


def nearest_cell(points: DataFrame, grid: DataFrame, *, origin: tuple[float, float], step: tuple[float, float], value: str) -> DataFrame:
    """``value`` of the grid cell (``i`` north, ``j`` east of the origin) whose centre is nearest to a point; null outside."""
    at = lambda c, o, d: F.bround((F.col(c) - o) / d).cast("int")
    keyed = points.withColumns({"i": at("lat", origin[0], step[0]), "j": at("lon", origin[1], step[1])})
    return keyed.join(grid.select("i", "j", value), ["i", "j"], "left").drop("i", "j")


def scope(name: Column) -> Column:
    """The forecast scope that a name stands for (P20)."""
    low = F.lower(F.trim(name))
    return F.coalesce(*[F.when(low == k, F.lit(v)) for k, v in SCOPES.items()], F.when(low.isin(*set(SCOPES.values())), low), F.lit(DEFAULT_SCOPE))


def frame_combinations(scenes: DataFrame, most: int = 3) -> DataFrame:
    """``path, frames, dates, scenes``: of each path all sets of up to ``most`` frames that share dates.

    Scenes become one row a date and path with its sorted frames, which are few; the sets are made there, so no scene meets
    another.
    """
    per = scenes.groupBy("path", F.to_date("start_ts").alias("d"), "frame").agg(F.count(F.lit(1)).alias("n"))
    days = per.groupBy("path", "d").agg(F.sort_array(F.collect_list(F.struct("frame", "n"))).alias("x"))

    def longer(held: Column) -> Column:
        """A set with each frame after its last one."""
        later = F.filter("x", lambda f: f["frame"] > F.element_at(held, -1)["frame"])
        return F.transform(later, lambda g: F.array_append(held, g))

    level = F.transform("x", lambda a: F.array(a))
    sets = level
    for _ in range(most - 1):
        level = F.flatten(F.transform(level, longer))
        sets = F.concat(sets, level)
    out = days.select("path", "d", F.explode(sets).alias("c"))
    out = out.select("path", "d", F.transform("c", lambda y: y["frame"]).alias("frames"), F.aggregate("c", F.lit(0).cast("long"), lambda a, y: a + y["n"]).alias("n"))
    return out.groupBy("path", "frames").agg(F.count(F.lit(1)).alias("dates"), F.sum("n").alias("scenes"))


def best_combination(found: DataFrame) -> DataFrame:
    """The set that covers the area, then with most dates, fewest frames, most scenes; ties to the smaller path and frames."""
    return found.orderBy(F.desc("covers"), F.desc("dates"), F.size("frames"), F.desc("scenes"), "path", "frames").limit(1)


def labelled_union(strict: DataFrame, relaxed: DataFrame) -> DataFrame:
    """Points of both sets, each once, ``strict`` where it is in the first."""
    both = strict.select("point_id", F.lit(0).alias("_k")).union(relaxed.select("point_id", F.lit(1)))
    return both.groupBy("point_id").agg(F.when(F.min("_k") == 0, "strict").otherwise("relaxed").alias("label"))


def header_bounds(header: DataFrame) -> DataFrame:
    """Bounds of a grid from its header ``width, length, x_first, y_first, x_step, y_step``, whatever the steps' signs."""
    x2, y2 = F.col("x_first") + F.col("x_step") * (F.col("width") - 1), F.col("y_first") + F.col("y_step") * (F.col("length") - 1)
    return header.select(
        *[c for c in header.columns if c not in ("width", "length", "x_first", "y_first", "x_step", "y_step")],
        F.greatest("y_first", y2).alias("n"), F.least("y_first", y2).alias("s"), F.greatest("x_first", x2).alias("e"), F.least("x_first", x2).alias("w"),
    )


def geometry_check(a: DataFrame, b: DataFrame, probes: list[tuple[int, int]], tolerance: float = 1e-4) -> DataFrame:
    """Shapes of two geometries and whether the probe cells lie at the same place."""
    size = lambda df, p: df.agg((F.max("row") + 1).alias(f"{p}_rows"), (F.max("col") + 1).alias(f"{p}_cols"))
    wanted = a.sparkSession.createDataFrame(probes, "row int, col int")
    met = wanted.join(a.select("row", "col", F.col("lat").alias("_y"), F.col("lon").alias("_x")), ["row", "col"]).join(b.select("row", "col", "lat", "lon"), ["row", "col"])
    near = (F.abs(F.col("_y") - F.col("lat")) <= tolerance) & (F.abs(F.col("_x") - F.col("lon")) <= tolerance)
    seen = met.agg(F.count(F.lit(1)).alias("probes"), F.count_if(near).alias("matching"))
    out = size(a, "a").join(size(b, "b")).join(seen)
    return out.withColumn("ok", F.expr("a_rows = b_rows AND a_cols = b_cols AND probes = matching"))


def with_grid_share(points: DataFrame) -> DataFrame:
    """Points with the size of their grid, ``_h`` and ``_w``."""
    return with_stats(points, _h=F.max("row") + 1, _w=F.max("col") + 1)
