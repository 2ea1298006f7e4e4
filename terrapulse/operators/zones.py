"""Statistics of zones, cells, bins and grids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrapulse.functions.scalars import clip, distance_m, edge_distance, pixel_area_km2
from terrapulse.functions.stats import quantiles, with_stats


def cell_average(pixels: DataFrame, key: str = "point_id", value: str = "coh") -> DataFrame:
    """Mean of the finite values of each cell over all rasters, held in [0, 1] (A3)."""
    finite = F.when(~F.isnan(value), F.col(value))
    return pixels.groupBy(key).agg(clip(F.avg(finite), 0.0, 1.0).alias(value))


def outlier_share(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Share of values further than five scaled median deviations from their group's median."""
    x = F.col(value)
    df = df.where(x.isNotNull() & ~F.isnan(x)).select(*keys, value)
    df = df.join(quantiles(df, *keys, _med=(x, 0.5)), keys).withColumn("_d", F.abs(x - F.col("_med")))
    scale = quantiles(df, *keys, _scale=(F.col("_d"), 0.5)).withColumn("_scale", F.greatest(1.4826 * F.col("_scale"), F.lit(1e-6)))
    return df.join(scale, keys).groupBy(*keys).agg(F.avg((F.col("_d") > 5 * F.col("_scale")).cast("double")).alias("outlier_share"))


def profile(obs: DataFrame, least: int = 32, trim: float = 0.2) -> DataFrame:
    """Quartiles, trimmed mean and count by ``zone`` and epoch, of zones with at least ``least`` points."""
    keys = ["zone", "epoch_idx"]
    whole = Window.partitionBy(*keys)
    df = obs.where("value_mm IS NOT NULL").withColumn("_r", F.row_number().over(whole.orderBy("value_mm", "point_id"))).withColumn("_n", F.count(F.lit(1)).over(whole))
    cut = F.floor(F.col("_n") * trim)
    inner = F.when((F.col("_r") > cut) & (F.col("_r") <= F.col("_n") - cut), F.col("value_mm"))
    q = lambda p: F.percentile("value_mm", F.lit(p))
    out = df.groupBy(*keys).agg(q(0.25).alias("p25"), q(0.5).alias("p50"), q(0.75).alias("p75"), F.avg(inner).alias("trimmed_mean"), F.count(F.lit(1)).alias("n_points"))
    sizes = obs.groupBy("zone").agg(F.count_distinct("point_id").alias("_size")).where(F.col("_size") >= least)
    return out.join(sizes.select("zone"), "zone", "left_semi")


def records(points: DataFrame, step: float = 0.001) -> DataFrame:
    """Area, extent, centroid and velocity figures of each ``zone``."""
    v = F.abs("velocity")
    q = lambda p: F.percentile(v, F.lit(p))
    return points.groupBy("zone").agg(
        F.count(F.lit(1)).alias("pixel_count"), F.sum(pixel_area_km2(F.col("lat"), step, step)).alias("area_km2"),
        F.min("lon").alias("west"), F.min("lat").alias("south"), F.max("lon").alias("east"), F.max("lat").alias("north"), F.avg("lon").alias("centroid_lon"), F.avg("lat").alias("centroid_lat"),
        F.avg("velocity").alias("mean_velocity"), F.median("velocity").alias("median_velocity"), q(0.1).alias("p10_abs"), q(0.9).alias("p90_abs"), F.max(v).alias("max_abs"),
    )


def bins(points: DataFrame, x: str, y: str, low: float = 0.4, n: int = 14, more_than: int = 10) -> DataFrame:
    """Mean and population deviation of ``y`` in ``n`` equal bins of ``x`` from ``low`` to 1, of bins with more than ``more_than`` rows."""
    width = (1.0 - low) / n
    df = points.where((F.col(x) >= low) & (F.col(x) < 1.0)).withColumn("bin", F.floor((F.col(x) - low) / width))
    return df.groupBy("bin").agg(F.count(F.lit(1)).alias("n"), F.avg(y).alias("mean"), F.stddev_pop(y).alias("deviation")).where(F.col("n") > more_than)


def histogram(df: DataFrame, value: str) -> DataFrame:
    """Density in sqrt(n) equal bins, 20 to 80, empty ones included; the last bin holds the maximum."""
    x = F.col(value)
    s = df.agg(F.count(x).alias("_n"), F.min(x).alias("_lo"), F.max(x).alias("_hi")).where("_n > 0").withColumn("_b", F.least(F.lit(80), F.greatest(F.lit(20), F.floor(F.sqrt("_n")))).cast("int"))
    s = s.withColumn("_w", (F.col("_hi") - F.col("_lo")) / F.col("_b"))
    at = F.least(F.col("_b") - 1, F.floor(F.coalesce(F.try_divide(x - F.col("_lo"), F.col("_w")), F.lit(0.0)))).cast("int")
    counts = df.where(x.isNotNull()).join(F.broadcast(s)).groupBy(at.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    every = s.select(F.explode(F.sequence(F.lit(0), F.col("_b") - 1)).alias("bin"), "_n", "_lo", "_w")
    n = F.coalesce("n", F.lit(0))
    return every.join(counts, "bin", "left").select("bin", (F.col("_lo") + F.col("bin") * F.col("_w")).alias("left_edge"), n.alias("n"), F.coalesce(F.try_divide(n, F.col("_n") * F.col("_w")), F.lit(0.0)).alias("density"))


def spread(df: DataFrame, value: str) -> DataFrame:
    """Mean, population deviation, median, and the symmetric colour limit: 97th percentile of absolute values, 1 at least."""
    x = F.col(value)
    ranks = quantiles(df, median=(x, 0.5), limit=(F.abs(x), 0.97)).select("median", F.greatest(F.lit(1.0), F.col("limit")).alias("limit"))
    return df.agg(F.avg(x).alias("mean"), F.stddev_pop(x).alias("deviation")).join(ranks)


def bilinear(at: DataFrame, grid: DataFrame, value: str) -> DataFrame:
    """``value`` of ``grid`` (row, col) at fractional positions (fr, fc); null where a cell that counts is absent.

    Each position meets its up to four cells by an equi-join on (row, col).
    """
    r, c = F.floor("fr"), F.floor("fc")
    a, b = F.col("fr") - r, F.col("fc") - c
    corner = lambda i, j, w: F.struct((r + i).cast("int").alias("row"), (c + j).cast("int").alias("col"), w.alias("w"))
    corners = F.array(corner(0, 0, (1 - a) * (1 - b)), corner(0, 1, (1 - a) * b), corner(1, 0, a * (1 - b)), corner(1, 1, a * b))
    met = at.select("point_id", F.inline(F.filter(corners, lambda x: x["w"] > 0))).join(grid.select("row", "col", value), ["row", "col"], "left")
    return met.groupBy("point_id").agg(F.when(F.count(value) == F.count(F.lit(1)), F.sum(F.col("w") * F.col(value))).alias(value))


def nearest_to(points: DataFrame, lat: float, lon: float) -> DataFrame:
    """The point nearest to a coordinate, ties to the smaller id."""
    d = F.round(distance_m(F.col("lat"), F.col("lon"), F.lit(lat), F.lit(lon), F.lit(lat)), 6)
    return points.agg(F.min(F.struct(d.alias("distance_m"), F.col("point_id"))).alias("best")).where("best IS NOT NULL").select("best.*")


def reference_pixel(points: DataFrame, border: int = 100, value: str = "tcoh") -> DataFrame:
    """The pixel of largest ``value`` at least ``border`` pixels inside the grid, ties to the smaller row and column."""
    df = with_stats(points, _h=F.max("row") + 1, _w=F.max("col") + 1)
    inside = df.where(edge_distance(F.col("row"), F.col("col"), F.col("_h"), F.col("_w")) >= border)
    best: Column = F.max(F.struct(value, (-F.col("row")).alias("r"), (-F.col("col")).alias("c")))
    return inside.agg(best.alias("best")).where("best IS NOT NULL").select((-F.col("best.r")).alias("row"), (-F.col("best.c")).alias("col"), F.col(f"best.{value}").alias(value))


def missing_epochs(filled: DataFrame, obs: DataFrame) -> DataFrame:
    """Expected but absent epochs of each point."""
    return filled.join(obs, ["point_id", "epoch_idx"], "left_anti").select("point_id", "epoch_idx")
