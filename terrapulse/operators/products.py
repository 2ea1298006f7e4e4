"""Series, masks, heights, delay coverage and request texts around a stack."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrapulse.operators.zones import cell_average, outlier_share


def candidate_series(series: DataFrame, points: DataFrame) -> DataFrame:
    """``point_id, date, value`` of the wanted points; the reference date of each series is an epoch of value 0."""
    wanted = series.join(points.select("point_id"), "point_id", "left_semi")
    first = wanted.groupBy("point_id").agg(F.min("reference").alias("date")).withColumn("value", F.lit(0.0))
    return wanted.select("point_id", "date", "value").union(first)


def in_mm(df: DataFrame, *metres: str) -> DataFrame:
    """Columns in metres as millimetres; nothing else is changed."""
    return df.withColumns({c: F.col(c) * 1000 for c in metres})


def coherence(average: DataFrame, stack: DataFrame, key: str = "point_id", value: str = "coh") -> DataFrame:
    """The stored average if there is one, else the average of the stack."""
    stored = average.limit(1).select(F.lit(True).alias("_stored"))
    mean = cell_average(stack, key, value).join(F.broadcast(stored), F.col("_stored"), "left_anti")
    return average.select(key, value).union(mean.select(key, value))


def zone_status(cells: DataFrame, height: int, width: int) -> DataFrame:
    """One row ``status, n_zones``: whether the zone raster is there and has the expected shape."""
    same = (F.max("row") + 1 == height) & (F.max("col") + 1 == width)
    status = F.when(F.count(F.lit(1)) == 0, "mask_missing").when(same, "loaded").otherwise("mask_shape_mismatch")
    return cells.agg(status.alias("status"), F.count_distinct(F.when(F.col("zone") > 0, F.col("zone"))).alias("n_zones"))


def with_zones(points: DataFrame, cells: DataFrame, height: int, width: int) -> DataFrame:
    """Points with ``in_zone``, ``zone_id`` (Z and number, empty outside) and the ``status`` of the raster.

    A raster of another shape marks no point.
    """
    status = F.broadcast(zone_status(cells, height, width).select("status"))
    met = points.join(cells.where("zone > 0").select("row", "col", F.col("zone").alias("_z")), ["row", "col"], "left").join(status)
    inside = (F.col("status") == "loaded") & F.col("_z").isNotNull()
    return met.withColumns({"in_zone": inside, "zone_id": F.when(inside, F.concat(F.lit("Z"), F.col("_z"))).otherwise("")}).drop("_z")


def rate_raster(cells: DataFrame, mask: Column, tile: int = 256) -> DataFrame:
    """``velocity`` where ``mask`` holds, null elsewhere, with the tile of each cell."""
    at = lambda c: F.floor(F.col(c) / tile).cast("int")
    return cells.select("row", "col", F.when(mask, F.col("velocity")).alias("velocity"), at("row").alias("tile_row"), at("col").alias("tile_col"))


def write_raster(raster: DataFrame, path: str) -> None:
    """Parquet partitioned by tile, so that a window read touches its tiles only."""
    raster.write.partitionBy("tile_row", "tile_col").parquet(path)


def forecast_summary(predicted: DataFrame, keys: list[str], steps: int) -> DataFrame:
    """One row a point with ``rel0_p50_h<i>`` and ``offset_p50_h<i>`` of each step from 1 (S23); missing steps are null."""
    pick = lambda c, h: F.max(F.when(F.col("step") == h, F.col(c))).alias(f"{c}_h{h}")
    return predicted.groupBy(*keys).agg(*[pick(c, h) for h in range(1, steps + 1) for c in ("rel0_p50", "offset_p50")])


def summary_json(df: DataFrame) -> DataFrame:
    """Each row as one JSON text ``value``."""
    return df.select(F.to_json(F.struct(*df.columns)).alias("value"))


def land(cells: DataFrame, masks: DataFrame) -> DataFrame:
    """Cells of ``cells`` that the first of the masks calls land.

    ``masks`` have ``place`` (0 is looked up first), ``row, col, land``; without a mask everything is land, and so is a
    cell that the mask leaves out.
    """
    first = F.broadcast(masks.agg(F.min("place").alias("place")).where("place IS NOT NULL"))
    water = masks.where(~F.col("land")).join(first, "place", "left_semi")
    return cells.join(water, ["row", "col"], "left_anti")


def heights(points: DataFrame, terrain: DataFrame, least: float = 10.0) -> DataFrame:
    """``height_m`` of the points, or that of the terrain if the points' own heights are not to be trusted.

    They are if the mean size of those that are finite and not 0 is at least ``least``.  Cells without terrain get 0.
    """
    h = F.col("height_m")
    trusted = F.avg(F.when(h.isNotNull() & ~F.isnan(h) & (h != 0), F.abs(h)))
    own = F.broadcast(points.agg((F.coalesce(trusted, F.lit(0.0)) >= least).alias("_own")))
    met = points.join(own).join(terrain.select("point_id", F.col("height_m").alias("_t")), "point_id", "left")
    return met.withColumn("height_m", F.when(F.col("_own"), h).otherwise(F.coalesce("_t", F.lit(0.0)))).drop("_own", "_t")


def with_calibration(predicted: DataFrame, factors: DataFrame, default: float = 1.0) -> DataFrame:
    """Predictions with the ``reliability`` of their model; a model without one gets that of the null model, else ``default``."""
    common = F.broadcast(factors.agg(F.max(F.when(F.col("method").isNull(), F.col("reliability"))).alias("_common")))
    own = F.broadcast(factors.where("method IS NOT NULL").select("method", F.col("reliability").alias("_own")))
    met = predicted.join(own, "method", "left").join(common)
    return met.withColumn("reliability", F.coalesce("_own", "_common", F.lit(default))).drop("_own", "_common")


def _bounds_lines(title: str, b: str) -> Column:
    sides = [F.format_string(f"{name}: %.4f", F.col(f"{b}.{k}")) for name, k in (("North", "n"), ("South", "s"), ("West", "w"), ("East", "e"))]
    return F.when(F.col(b).isNotNull(), F.concat_ws("\n", F.lit(title), *sides))


def request_text(dates: DataFrame, bounds: DataFrame) -> DataFrame:
    """One text that asks for delay grids: bounds, time of day, wanted dates and those that are missing.

    ``dates`` have ``date, present``; ``bounds`` is one row of ``required, recommended`` (n, s, w, e) and ``clock``; what
    is null is left out.
    """
    listed = dates.agg(F.array_sort(F.collect_set("date")).alias("_d"), F.array_sort(F.collect_set(F.when(~F.col("present"), F.col("date")))).alias("_m"))
    met = bounds.join(listed)
    wanted = F.concat_ws("\n", F.format_string("Dates (%d):", F.size("_d")), F.concat_ws("\n", "_d"))
    missing = F.when(F.size("_m") > 0, F.concat(F.format_string("Missing (%d): ", F.size("_m")), F.concat_ws(", ", "_m")))
    clock = F.concat(F.lit("UTC time: "), F.col("clock"))
    return met.select(F.concat_ws("\n", clock, _bounds_lines("Required", "required"), _bounds_lines("Recommended", "recommended"), wanted, missing).alias("value"))


def polygon_edges(polygons: DataFrame) -> DataFrame:
    """``polygon_id, ring, edge, x1, y1, x2, y2`` of GeoJSON polygons in ``geojson`` (S33); broken texts give no rows."""
    shape = F.from_json("geojson", "type string, coordinates array<array<array<double>>>")
    rings = polygons.select("polygon_id", F.posexplode(shape["coordinates"]).alias("ring", "_v"))
    ends = F.transform(F.slice("_v", 1, F.greatest(F.size("_v") - 1, F.lit(0))), lambda p, i: F.struct(p.alias("a"), F.get("_v", i + 1).alias("b")))
    found = rings.select("polygon_id", "ring", F.posexplode(ends).alias("edge", "_e"))
    at = lambda e, i: F.col("_e")[e][i]
    return found.select("polygon_id", "ring", "edge", at("a", 0).alias("x1"), at("a", 1).alias("y1"), at("b", 0).alias("x2"), at("b", 1).alias("y2"))


def delay_coverage(cells: DataFrame, delays: DataFrame, dates: DataFrame) -> DataFrame:
    """Shares of valid, zero and extreme delays of each window and date.

    ``cells`` are the ``pad, point_id`` of the windows, ``delays`` have ``point_id, date, value``.  A date without a valid
    value has valid share 0 and the other shares 1.
    """
    size = cells.groupBy("pad").agg(F.count(F.lit(1)).alias("_cells"))
    x = F.col("value")
    met = cells.join(delays.where(x.isNotNull() & ~F.isnan(x)), "point_id").join(F.broadcast(dates), "date", "left_semi")
    per = met.groupBy("pad", "date").agg(F.count(F.lit(1)).alias("_n"), F.avg((F.abs(x) <= 1e-8).cast("double")).alias("zero_share"))
    odd = outlier_share(met, ["pad", "date"], "value")
    every = size.join(F.broadcast(dates.select("date")))
    df = every.join(per, ["pad", "date"], "left").join(odd, ["pad", "date"], "left")
    shares = [F.coalesce(c, F.lit(1.0)).alias(n) for c, n in (("zero_share", "zero_share"), ("outlier_share", "extreme_share"))]
    return df.select("pad", "date", (F.coalesce("_n", F.lit(0)) / F.col("_cells")).alias("valid_share"), *shares)


def window_coverage(per_date: DataFrame) -> DataFrame:
    """Least and mean valid share of each window and whether it is the best one: the largest least share, ties to the smaller padding."""
    per = per_date.groupBy("pad").agg(F.min("valid_share").alias("least"), F.avg("valid_share").alias("mean"))
    best = F.broadcast(per.agg(F.max_by("pad", F.struct("least", -F.col("pad"))).alias("_best")))
    return per.join(best).select("pad", "least", "mean", (F.col("pad") == F.col("_best")).alias("best"))


def address(name: Column, a: Column) -> Column:
    """Province, city and district of an address record as a list without the name itself and without repeats.

    The district is the first of four levels that is not empty; a city that repeats it or the name gives way to the state
    district, if that does not repeat them either.
    """
    have = lambda c: F.nullif(F.trim(a[c]), F.lit(""))
    district = F.coalesce(*[have(c) for c in ("city_district", "county", "suburb", "district")])
    other = lambda c: F.when(~c.eqNullSafe(district) & ~c.eqNullSafe(name), c)
    city = F.coalesce(other(have("city")), other(have("state_district")))
    return F.filter(F.array_compact(F.array(F.coalesce(have("state"), have("province")), city, district)), lambda x: x != name)
