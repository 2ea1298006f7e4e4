"""Registered queries of masks, growth and the display grid.

The test points have no smooth motion, so a wave over rows and columns is laid over their heights; their series are its rate
and the steps of the given series.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from terrapulse.catalogue import _scored_points, register
from terrapulse.operators import display, masks, seeds
from terrapulse.session import materialise


def _moving(points):
    """Features of all cells, with a smooth rate."""
    rate = 22.0 * F.sin(F.col("row") / 6.0) * F.cos((F.col("col") - 12) / 9.0) + (F.col("height_m") - 1400.0) / 200
    return materialise(seeds.features(_scored_points(points).withColumns({"velocity": rate, "exposure": F.lit(0.0)})))


def _cell_series(points, obs):
    """Every fourth epoch of each cell: its rate, and a hundredth of the series of one of the given points."""
    few = obs.where("epoch_idx % 4 = 0").groupBy(F.expr("CAST(epoch_idx div 4 AS INT)").alias("epoch_idx")).pivot("point_id", [1, 2, 3, 4, 5]).agg(F.first("value_mm"))
    noise = F.coalesce(F.element_at(F.array(*[F.coalesce(F.col(str(k)), F.lit(0.0)) for k in range(1, 6)]), F.pmod("point_id", F.lit(5)).cast("int") + 1), F.lit(0.0))
    met = points.select("point_id", "row", "col", "velocity").join(F.broadcast(few))
    return materialise(met.select("point_id", "row", "col", "epoch_idx", (F.col("velocity") * F.col("epoch_idx") / 3.0 + noise / 100).alias("value_mm")))


_LIMITS = {"core": 6.0, "grow": 4.0, "density": 0.02, "dense": 0.04, "tcoh": 0.3, "ps": 0.2, "same_sign": 2}


@register("m09_region_grow", ("point",), None)
def m09(points):
    """With lower limits of support, as few of the test points are strict or relaxed."""
    found = _moving(points)
    return masks.region_grow(found, seeds.probability(found), limits=_LIMITS)


@register("m08_principal_mask", ("point", "obs"), None, kept=("obs",))
def m08(points, obs):
    """With lower limits of support and area; one row a kept part."""
    found = _moving(points)
    lim = {"base": 6.0, "density": 0.02, "tcoh": 0.3, "probability": 0.05, "pixels": 20, "most": 3}
    found_parts = masks.principal_candidates(found, seeds.probability(found), limits=lim)
    area = points.select("row", "col", F.lit(0.01).alias("area_km2"))
    _, best = masks.principal_mask(found_parts, _cell_series(found, obs), area, 0.1, limits=lim)
    return best.select("layer", "pixel_count", "median_velocity", "net_mm", "continuity", "score")


@register("r11_grown_zones", ("point", "obs"), None, kept=("obs",))
def r11(points, obs):
    """Zones that start from the four fastest cells of each half of the raster, growing over the rest."""
    found = _moving(points)
    cells = masks.growth_cells(found.select("row", "col", "point_id", "lat", "lon", "velocity"), _cell_series(found, obs))
    half = F.when(F.col("col") < 25, 1).otherwise(2) + F.when(F.col("velocity") < 0, 2).otherwise(0)
    w = F.row_number().over(masks.Window.partitionBy("zone").orderBy(F.desc(F.abs("velocity")), "point_id"))
    picked = materialise(cells.withColumn("zone", half).withColumn("_k", w).where("_k <= 4"))
    records = picked.groupBy("zone").agg(
        F.max(F.struct(F.abs("velocity"), "trace"))["trace"].alias("trace"), F.avg("net").alias("net_mm"), F.median("peak").alias("activity"),
        F.median(F.abs("velocity")).alias("median_abs_velocity"), F.median("temporal_coherence").alias("temporal_coherence"),
    )
    records = records.withColumns({"zone_type": F.when(F.col("net_mm") < 0, "subsidence").otherwise("uplift"), "internal_corr": F.lit(0.95), "area_km2": F.lit(2.0)})
    return masks.expand_zones(records, picked, cells, found.select("row", "col", "lat", "lon"))[0]


@register(
    "r13_display_grid",
    ("point",),
    """f AS (SELECT min(lon) AS w, max(lon) AS e, min(lat) AS s, max(lat) AS n, least(0.0012::DOUBLE, greatest(0.00035::DOUBLE, greatest(max(lon) - min(lon), 1e-4) / 60, greatest(max(lat) - min(lat), 1e-4) / 60)) AS step FROM point WHERE tcoh >= 0.3),
 g AS (SELECT CAST(i AS INTEGER) AS i, CAST(j AS INTEGER) AS j, w, n, step FROM (SELECT *, unnest(range(0, CAST(ceil((e - w) / step + 0.5) AS BIGINT))) AS j FROM (SELECT *, unnest(range(0, CAST(ceil((n - s) / step + 0.5) AS BIGINT))) AS i FROM f))),
 d AS (SELECT i, j, tcoh, row_number() OVER (PARTITION BY i, j ORDER BY round(((lon - w) / step - j) ** 2 + ((n - lat) / step - i) ** 2, 12), point_id) AS k FROM g, point WHERE tcoh >= 0.3 AND round(((lon - w) / step - j) ** 2 + ((n - lat) / step - i) ** 2, 12) <= 9)
 SELECT i, j, round(w + j * step, 6) AS lon, round(n - i * step, 6) AS lat, tcoh AS value FROM g LEFT JOIN (SELECT * FROM d WHERE k = 1) USING (i, j)""",
)
def r13(points):
    return display.display_grid(points.where("tcoh >= 0.3"), "tcoh", target_cols=60)
