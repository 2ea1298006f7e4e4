"""Features of raster cells, weak seeds and the probability of motion made from them."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrapulse.functions.scalars import clip
from terrapulse.functions.stats import quantiles, robust_range, with_stats
from terrapulse.operators.rasters import CELL, box, box_deviation, box_mean, far_from, gradient, lattice
from terrapulse.session import materialise

NEEDED = ("velocity", "tcoh", "ps_score", "valid_pair_ratio", "maincc_ratio", "jump_risk", "exposure")
#: Weights of the features in the probability; they add up to 1.12, so the sum is held within [0, 1].
SPREAD_WEIGHTS = {"speed": 0.24, "anomaly": 0.28, "gradient": 0.12, "deviation": 0.10}
UNIT_WEIGHTS = {"ps_score": 0.12, "tcoh": 0.10, "valid_pair_ratio": 0.07, "maincc_ratio": 0.05}
STRICT_WEIGHT = 0.04


def features(grid: DataFrame) -> DataFrame:
    """The valid cells with speed, sign, local mean and anomaly, gradient and local deviation (M1).

    A cell is valid if all of ``NEEDED`` are numbers; ``point_class`` gives the strict and relaxed flags.
    """
    known = [F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double")) for c in NEEDED]
    valid = grid.where(_all(known))
    around = box_mean(valid, "velocity", 11).withColumnRenamed("mean", "local_mean")
    df = valid.join(around, CELL).join(gradient(valid, "velocity"), CELL).join(box_deviation(valid, "velocity", 5), CELL)
    flags = {n: (F.col("point_class") == n).cast("double") for n in ("strict", "relaxed")}
    return df.withColumns({"speed": F.abs("velocity"), "sign": F.signum("velocity"), "anomaly": F.abs(F.col("velocity") - F.col("local_mean")), **flags})


def _all(conditions: list[Column]) -> Column:
    """All of the conditions."""
    out = F.lit(True)
    for c in conditions:
        out = out & c
    return out


def with_floors(df: DataFrame, **wanted: tuple[Column, float, float]) -> DataFrame:
    """``df`` with ``out=(column, quantile, floor)``: a quantile of all rows, ``floor`` at least and where there are none (M2)."""
    found = quantiles(df, **{n: (c, q) for n, (c, q, _) in wanted.items()})
    return df.join(F.broadcast(found.select(*[F.greatest(n, F.lit(floor)).alias(n) for n, (_, _, floor) in wanted.items()])))


def same_sign(found: DataFrame, level: Column) -> DataFrame:
    """``up, down``: cells of the 3 x 3 box, with the cell itself, that move up or down by at least ``level``."""
    part = lambda s: ((F.col("sign") == s) & (F.col("speed") >= level)).cast("double")
    marked = found.withColumns({"_up": part(1), "_down": part(-1)})
    count = lambda c, n: box(marked, c, 3, replicate=False).select(*CELL, F.col("total").cast("long").alias(n))
    return count("_up", "up").join(count("_down", "down"), CELL)


def weak_seeds(found: DataFrame) -> DataFrame:
    """``seed`` 1 for cells that surely move and 0 for cells that surely rest; other cells have no row (M3).

    The features and the moving cells are read several times, so both are written once.
    """
    found = materialise(found)
    at = lambda c, q, floor: (F.col(c), q, floor)
    df = with_floors(
        found,
        _fast=at("speed", 0.95, 5.0), _odd=at("anomaly", 0.94, 3.0), _slow=at("speed", 0.40, 1.5),
        _even=at("anomaly", 0.45, 1.2), _flat=at("gradient", 0.45, 0.5), _calm=at("deviation", 0.45, 0.75),
    )
    trusted = (F.col("tcoh") >= 0.65) | (F.col("ps_score") >= 0.50) | (F.col("strict") + F.col("relaxed") > 0)
    moving = df.where(trusted & (F.col("speed") >= F.col("_fast")) & (F.col("anomaly") >= F.col("_odd")))
    support = same_sign(df, F.greatest(F.col("_fast") * 0.60, F.lit(3.0))).where((F.col("up") >= 4) | (F.col("down") >= 4))
    moving = materialise(moving.join(support.select(*CELL), CELL, "left_semi").select(*CELL))
    still = df.where(
        (F.col("speed") <= F.col("_slow")) & (F.col("anomaly") <= F.col("_even")) & (F.col("gradient") <= F.col("_flat"))
        & (F.col("deviation") <= F.col("_calm")) & (F.col("tcoh") >= 0.70)
    )
    still = far_from(still.select(*CELL), moving, 4)
    return moving.withColumn("seed", F.lit(1)).union(still.select(*CELL).withColumn("seed", F.lit(0)))


def probability(found: DataFrame) -> DataFrame:
    """Probability of motion as the weighted sum of the features (M4)."""
    df = robust_range(found, **{f"_{c}": c for c in SPREAD_WEIGHTS})
    score = STRICT_WEIGHT * F.col("strict")
    for c, w in SPREAD_WEIGHTS.items():
        score = score + w * F.col(f"_{c}")
    for c, w in UNIT_WEIGHTS.items():
        score = score + w * clip(F.col(c), 0.0, 1.0)
    return df.select(*CELL, clip(score, 0.0, 1.0).alias("probability"))


def fused(found: DataFrame) -> DataFrame:
    """The probability and its mean over the 7 x 7 box, at 0.68 to 0.32 (M7)."""
    found = materialise(found)
    mean = box_mean(found, "probability", 7)
    return found.join(mean, CELL).select(*CELL, (0.68 * F.col("probability") + 0.32 * F.col("mean")).alias("probability"))


def hillshade(grid: DataFrame, height: str, cell_deg: float, *, azimuth: float = 315.0, altitude: float = 45.0) -> DataFrame:
    """Brightness of every cell of the raster under a sun, heights doubled; a missing height is the mean."""
    df = with_stats(lattice(grid, height), _fill=F.avg(height))
    df = df.withColumn("_x", 2.0 * F.coalesce(F.col(height).cast("double"), F.col("_fill"), F.lit(0.0)))

    def slope(along: str, across: str) -> Column:
        w = Window.partitionBy(across).orderBy(along)
        before, after, x = F.lag("_x").over(w), F.lead("_x").over(w), F.col("_x")
        return F.coalesce((after - before) / 2, after - x, x - before, F.lit(0.0)) / (cell_deg * 111000)

    df = df.withColumns({"_dx": slope("col", "row"), "_dy": slope("row", "col")})
    steep = F.atan(F.sqrt(F.col("_dx") ** 2 + F.col("_dy") ** 2))
    sun, up = math.radians(azimuth), math.radians(altitude)
    light = math.sin(up) * F.cos(steep) + math.cos(up) * F.sin(steep) * F.cos(sun - F.atan2(-F.col("_dx"), F.col("_dy")))
    return df.select(*CELL, clip(light, 0.0, 1.0).alias("shade"))


def near_any(cells: DataFrame, others: DataFrame, reach: int) -> DataFrame:
    """The cells with one of ``others`` within ``reach`` cells, by buckets of that size and their neighbours."""
    bucket = lambda c: F.floor(F.col(c) / reach).cast("int")
    mine = cells.withColumns({"_r": bucket("row"), "_c": bucket("col")})
    spread = F.array(*[F.struct((bucket("row") + i).alias("_r"), (bucket("col") + j).alias("_c")) for i in (-1, 0, 1) for j in (-1, 0, 1)])
    theirs = others.select(F.col("row").alias("_row"), F.col("col").alias("_col"), F.inline(spread))
    apart = (F.col("row") - F.col("_row")) ** 2 + (F.col("col") - F.col("_col")) ** 2
    same = (mine["_r"] == theirs["_r"]) & (mine["_c"] == theirs["_c"])
    return mine.join(theirs, same & (apart <= reach * reach), "left_semi").drop("_r", "_c")
