"""Values on a regular display grid."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The widest and narrowest grid step in degrees, the least number of columns, and how far a value reaches, in steps.
FINEST, COARSEST, LEAST_COLS, REACH = 0.00035, 0.0012, 50, 3
#: Columns of a block of a row of nodes, and points whose blocks a task takes on average.
BLOCK, AT_ONCE = 64, 50_000


def frame(points: DataFrame, target_cols: int = 720) -> DataFrame:
    """One row: ``west, north, step, n_cols, n_rows`` of the grid over all ``points`` (``lon, lat``)."""
    span = points.agg(F.min("lon").alias("west"), F.max("lon").alias("_e"), F.min("lat").alias("_s"), F.max("lat").alias("north")).where("west IS NOT NULL")
    wide = lambda a, b: F.greatest(F.col(a) - F.col(b), F.lit(1e-4)) / max(target_cols, LEAST_COLS)
    step = F.least(F.lit(COARSEST), F.greatest(F.lit(FINEST), wide("_e", "west"), wide("north", "_s")))
    n = lambda a, b: F.ceil((F.col(a) - F.col(b)) / F.col("step") + 0.5).cast("int")
    return span.withColumn("step", step).select("west", "north", "step", n("_e", "west").alias("n_cols"), n("north", "_s").alias("n_rows"))


def display_grid(points: DataFrame, value: str, *, target_cols: int = 720) -> DataFrame:
    """``i, j, lon, lat, value``: every node of the grid with the value of the nearest point within three steps, else null.

    Points (``point_id, lon, lat`` and the value) without a value or a place are left out; distances are in degrees, as
    the grid is; of points equally near (to 1e-12 of a step squared) the smaller id counts.  Each point passes its value out to
    the nodes that it can reach, about 29, whatever the size of the grid; a node keeps the best of what reaches it.  Points are
    sent to blocks of a row of nodes, dealt over as many tasks as they need, and meet the single nodes only there.
    """
    known = points.where(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double")) & F.col("lon").isNotNull() & F.col("lat").isNotNull())
    grid = frame(known, target_cols)
    at = known.select("point_id", F.col(value).alias("value"), "lon", "lat").join(F.broadcast(grid))
    x, y = (F.col("lon") - F.col("west")) / F.col("step"), (F.col("north") - F.col("lat")) / F.col("step")
    at = at.withColumns({"_x": x, "_y": y})
    reach = lambda c: F.sequence(F.ceil(F.col(c) - REACH).cast("int"), F.floor(F.col(c) + REACH).cast("int"))
    within = lambda c, n: F.col(c).between(0, F.col(n) - 1)
    block = lambda c: F.floor(c / BLOCK).cast("int")
    # files of points are small, so they come in few tasks, and each is some eight rows from here on
    tasks = max(int(points.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-known.count() // AT_ONCE))
    sent = at.withColumn("i", F.explode(reach("_y"))).where(within("i", "n_rows"))
    sent = sent.withColumn("_b", F.explode(F.sequence(block(F.ceil(F.col("_x") - REACH)), block(F.floor(F.col("_x") + REACH))))).repartition(tasks, "i", "_b")
    sent = sent.withColumn("j", F.explode(reach("_x"))).where(within("j", "n_cols") & (block(F.col("j")) == F.col("_b")))
    apart = (F.col("_x") - F.col("j")) ** 2 + (F.col("_y") - F.col("i")) ** 2
    sent = sent.withColumn("_d", F.round(apart, 12)).where(F.col("_d") <= REACH * REACH)
    best = sent.groupBy("i", "_b", "j").agg(F.min(F.struct("_d", "point_id", "value")).alias("_best")).drop("_b")
    rows = grid.select("*", F.explode(F.sequence(F.lit(0), F.col("n_rows") - 1)).alias("i")).repartition(tasks, "i")
    nodes = rows.withColumn("j", F.explode(F.sequence(F.lit(0), F.col("n_cols") - 1)))
    nodes = nodes.select("i", "j", (F.col("west") + F.col("j") * F.col("step")).alias("lon"), (F.col("north") - F.col("i") * F.col("step")).alias("lat"))
    return nodes.join(best, ["i", "j"], "left").select("i", "j", "lon", "lat", F.col("_best.value").alias("value"))
