"""Exact neighbour joins over points, by grid cells."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from terrapulse.functions.scalars import METRES_LAT, METRES_LON
from terrapulse.session import materialise


def projected(points: DataFrame) -> DataFrame:
    """Local metres, with the longitude scale at the mean latitude."""
    mean = points.agg(F.avg("lat").alias("_lat"))
    return points.join(F.broadcast(mean)).withColumns({"x": F.col("lon") * METRES_LON * F.cos(F.radians("_lat")), "y": F.col("lat") * METRES_LAT}).drop("_lat")


def _cells(df: DataFrame, size: float) -> DataFrame:
    return df.withColumns({"cx": F.floor(F.col("x") / size), "cy": F.floor(F.col("y") / size)})


def _around(df: DataFrame, ring: int) -> DataFrame:
    off = F.array(*[F.lit(i) for i in range(-ring, ring + 1)])
    return df.withColumn("dx", F.explode(off)).withColumn("dy", F.explode(off)).withColumns({"cx": F.col("cx") + F.col("dx"), "cy": F.col("cy") + F.col("dy")}).drop("dx", "dy")


def within_radius(points: DataFrame, radius: float) -> DataFrame:
    """Pairs (src, dst, dist_m) of different points within ``radius`` metres: an equi-join on cells of that size."""
    p = _cells(projected(points).select(F.col("point_id").alias("id"), "x", "y"), radius)
    a = _around(p, 1).select(F.col("id").alias("src"), F.col("x").alias("x1"), F.col("y").alias("y1"), "cx", "cy")
    dist = F.sqrt((F.col("x1") - F.col("x")) ** 2 + (F.col("y1") - F.col("y")) ** 2)
    return a.join(p.hint("merge"), ["cx", "cy"]).where("src <> id").withColumn("dist_m", dist).where(F.col("dist_m") <= radius).select("src", F.col("id").alias("dst"), "dist_m")


def nearest(points: DataFrame, k: int, *, cell: float, max_rounds: int = 12) -> DataFrame:
    """The ``k`` nearest other points of each point: src, rank, dst, dist_m; ties go to the smaller id.

    Points look into the cells around theirs; a point is done when its k-th distance lies within what these are
    sure to cover, the others look again with cells twice as wide.  Joins are merged, as files of points are small enough to be
    broadcast long after their rows are not.
    """
    p = materialise(projected(points).select(F.col("point_id").alias("id"), "x", "y"))
    open_, done = p, []
    total = p.count()
    for _ in range(max_rounds):
        grid = _cells(p, cell)
        a = _around(_cells(open_, cell), 1).select(F.col("id").alias("src"), F.col("x").alias("x1"), F.col("y").alias("y1"), "cx", "cy")
        dist = F.sqrt((F.col("x1") - F.col("x")) ** 2 + (F.col("y1") - F.col("y")) ** 2)
        met = a.join(grid.hint("merge"), ["cx", "cy"]).where("src <> id").withColumn("dist_m", dist)
        best = met.withColumn("rank", F.row_number().over(Window.partitionBy("src").orderBy(F.round("dist_m", 6), "id"))).where(F.col("rank") <= k)
        last = F.max(F.when((F.col("rank") == min(k, total - 1)) & (F.col("dist_m") <= cell), True)).over(Window.partitionBy("src"))
        best = materialise(best.select("src", "rank", F.col("id").alias("dst"), "dist_m", last.alias("_sure")))
        done.append(best.where("_sure").drop("_sure"))
        sure = best.where("_sure AND rank = 1").select(F.col("src").alias("id"))
        open_ = materialise(open_.join(sure.hint("merge"), "id", "left_anti"))
        if open_.isEmpty() or total < 2:
            break
        cell *= 2
    else:
        raise RuntimeError("the cells are far too small for these points")
    out = done[0]
    for d in done[1:]:
        out = out.union(d)
    return out


def summaries(edges: DataFrame, steps: DataFrame) -> DataFrame:
    """By ``src`` and epoch the mean displacement, mean step and population deviation of steps of its neighbours."""
    met = edges.select("src", F.col("dst").alias("point_id")).join(steps.hint("merge"), "point_id")
    return met.groupBy(F.col("src").alias("point_id"), "epoch_idx").agg(F.avg("value_mm").alias("mean_mm"), F.avg("delta").alias("mean_delta"), F.stddev_pop("delta").alias("deviation_delta"))


def boundary(edges: DataFrame, members: DataFrame) -> DataFrame:
    """Points outside the set ``members`` (point_id) next to one of it."""
    out = edges.join(members.select(F.col("point_id").alias("src")), "src", "left_semi").select(F.col("dst").alias("point_id")).distinct()
    return out.join(members.select("point_id"), "point_id", "left_anti")
