"""Representative points, dates spread over time, gates, zone acceptance, flat water, outlines and components of series."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrapulse.functions.scalars import pixel_area_km2
from terrapulse.functions.stats import with_stats
from terrapulse.operators.rasters import CELL, FOUR, labels, lattice

#: The acceptance limits of a zone.
LIMITS = {
    "pixel_count": 25, "support_count": 32, "fill_ratio": 0.12, "support_ratio": 0.15, "sign_ratio": 0.75,
    "median_abs_velocity": 8.0, "net_mm": 10.0, "continuity": 0.55, "aoi_share": 1.2e-4,
}


def representative(points: DataFrame, *, coherent: float = 0.6) -> DataFrame:
    """``label, point_id`` of a sinking, a rising, a stable and the most coherent point (T5).

    ``points`` have ``velocity, deviation, tcoh``; reliable are those of enough coherence and a deviation under the 85th
    percentile, or all if none is.  The sinking and the rising point are the most coherent ones between 0.8 and 1.2 times the
    5th and 95th percentile, or the extreme ones if there is none; the fourth row is left out if it repeats the first or
    third.  Ties go to the smaller id.
    """
    v = F.col("velocity")
    df = with_stats(points, _d=F.percentile("deviation", F.lit(0.85)), _s=F.stddev_pop("velocity"))
    df = df.withColumn("_ok", F.coalesce((F.col("deviation") < F.col("_d")) & (F.col("tcoh") >= coherent), F.lit(False)))
    df = with_stats(df, _any=F.max("_ok")).where("_ok OR NOT _any")
    df = with_stats(df, _lo=F.percentile("velocity", F.lit(0.05)), _hi=F.percentile("velocity", F.lit(0.95)))

    def best(score: Column, where: Column | None = None) -> Column:
        key = F.struct(score, -F.col("point_id"))
        return F.max_by("point_id", key if where is None else F.when(where, key))

    around = lambda p: v.between(F.col(p) * 0.8, F.col(p) * 1.2)
    tcoh = F.col("tcoh")
    found = df.agg(
        F.coalesce(best(tcoh, around("_lo")), best(-v)).alias("a"), F.coalesce(best(tcoh, around("_hi")), best(v)).alias("b"),
        best(tcoh - 0.2 * F.abs(v) / F.greatest(F.col("_s"), F.lit(1.0))).alias("c"), best(tcoh).alias("d"),
    )
    row = lambda label, c: F.struct(F.lit(label).alias("label"), F.col(c).alias("point_id"))
    rows = found.select(F.inline(F.array(row("subsidence", "a"), row("uplift", "b"), row("stable", "c"), row("coherent", "d"))), "a", "c")
    return rows.where("point_id IS NOT NULL AND (label <> 'coherent' OR point_id <> a AND point_id <> c)").select("label", "point_id")


def _pick(dates: pd.DataFrame, n: int) -> pd.DataFrame:
    dates = dates.sort_values("day").reset_index(drop=True)
    if len(dates) <= n:
        return dates
    day, base = dates["day"].to_numpy(float), dates["baseline"].fillna(0.0).to_numpy()
    off = np.abs(base - np.sort(base)[len(base) // 2]) * 3600 if dates["baseline"].notna().any() else 0.0
    free = np.ones(len(day), bool)
    free[[0, -1]] = False
    for i in range(1, n - 1):
        cost = np.abs(day - (day[0] + (day[-1] - day[0]) * i / (n - 1))) * 86400 + off
        cost[~free] = np.inf
        free[np.argmin(cost)] = False
    return dates[~free]


def spread_dates(scenes: DataFrame, n: int) -> DataFrame:
    """At most ``n`` (3 at least) dates of each ``stack``, evenly spread, first and last included.

    ``scenes`` have ``stack, date, start_ts, frame, baseline``; a date counts by its first scene.  Each slot takes the free date
    nearest to its time, a metre of baseline off the median counting as an hour.  A stack's dates, not its scenes, meet in
    one task.
    """
    first = F.min_by("baseline", F.struct("start_ts", "frame"))
    dates = scenes.groupBy("stack", "date").agg(first.cast("double").alias("baseline")).withColumn("day", F.datediff("date", F.lit("1970-01-01")))
    picked = dates.groupBy("stack").applyInPandas(lambda g: _pick(g, n), dates.schema)
    return picked.select("stack", "date")


def gate(stats: DataFrame, k: int = 8) -> DataFrame:
    """``reasons`` against the model of neighbours, comma-joined.

    ``stats`` have ``nodes, mean_degree, largest_share, hazard_windows, windows, gap_share``.
    """
    low = F.array(
        F.when(F.col("nodes") < max(64, 4 * k), "effective_nodes_below_threshold"), F.when(F.col("mean_degree") < 3.0, "mean_degree_below_threshold"),
        F.when(F.col("largest_share") < 0.60, "largest_component_too_small"),
        F.when(F.col("hazard_windows") < F.bround(F.col("windows") * 0.5), "hazard_train_samples_too_small"),
        F.when(F.col("gap_share") > 0.20, "neighbor_feature_nan_ratio_too_high"),
    )
    return stats.withColumn("reasons", F.concat_ws(",", F.array_compact(low)))


def zone_figures(cells: DataFrame, aoi_km2: float, step: float = 0.001) -> DataFrame:
    """What acceptance asks of each ``zone``, with mean probability, support counts and the share of the whole area.

    ``cells`` have ``row, col, lat, velocity, anomaly, probability, strict, relaxed``.
    """
    n = F.count(F.lit(1))
    share = lambda c: F.avg(c.cast("double"))
    box = (F.max("row") - F.min("row") + 1) * (F.max("col") - F.min("col") + 1)
    support = F.count_if(F.col("strict") | F.col("relaxed"))
    area = F.sum(pixel_area_km2(F.col("lat"), step, step))
    return cells.groupBy("zone").agg(
        n.alias("pixel_count"), area.alias("area_km2"), (area / aoi_km2).alias("aoi_share"), F.count_if("strict").alias("strict_count"),
        F.count_if("relaxed").alias("relaxed_count"), support.alias("support_count"), (n / box).alias("fill_ratio"), (support / n).alias("support_ratio"),
        F.greatest(share(F.col("velocity") > 0), share(F.col("velocity") < 0)).alias("sign_ratio"), F.median(F.abs("velocity")).alias("median_abs_velocity"),
        F.median("anomaly").alias("median_anomaly"), F.avg("probability").alias("mean_probability"),
    )


def accepted(figures: DataFrame, *, fast: float, odd: float, limits: dict[str, float] | None = None) -> DataFrame:
    """The zones that pass every limit, renumbered from 1 in order of ``zone``.

    ``figures`` also have ``net_mm`` and ``continuity``; ``fast`` and ``odd`` are the speed and anomaly thresholds of the seeds.  A
    large zone needs less anomaly: its limit falls with its area, but not under 1.25.
    """
    lim = LIMITS | (limits or {})
    least_area = F.col("area_km2") / F.col("aoi_share") * lim["aoi_share"]
    wanted = F.greatest(F.lit(1.25), max(3.5, 0.85 * odd) * F.least(F.lit(1.0), least_area / F.col("area_km2")))
    ok = (F.abs("net_mm") >= lim["net_mm"]) & (F.col("median_anomaly") >= wanted) & (F.col("median_abs_velocity") >= max(lim["median_abs_velocity"], 0.30 * fast))
    for c in ("pixel_count", "support_count", "fill_ratio", "support_ratio", "sign_ratio", "continuity", "aoi_share"):
        ok = ok & (F.col(c) >= lim[c])
    kept = figures.where(ok).withColumn("required_anomaly", wanted)
    # zones are few: one row a zone
    return kept.withColumn("zone_id", F.concat(F.lit("Z"), F.row_number().over(Window.orderBy("zone"))))


def flat_water(grid: DataFrame, height: str, dy: float, dx: float, *, flattest: float = 1.0, more_than: int = 500) -> DataFrame:
    """Cells of flat ground: slope under ``flattest`` degrees, in a four-connected part of more than ``more_than`` cells.

    ``dy`` and ``dx`` are the sizes of a cell in metres; the raster must be whole.
    """
    df = lattice(grid, height)

    def slope(along: str, across: str, cell: float) -> Column:
        w = Window.partitionBy(across).orderBy(along)
        x, before, after = F.col(height), F.lag(height).over(w), F.lead(height).over(w)
        return F.coalesce((after - before) / (2 * cell), (after - x) / cell, (x - before) / cell, F.lit(0.0))

    df = df.withColumn("_x", slope("col", "row", dx)).withColumn("_y", slope("row", "col", dy))
    flat = df.where(F.degrees(F.atan(F.sqrt(F.col("_x") ** 2 + F.col("_y") ** 2))) < flattest).select(*CELL)
    parts = labels(flat, FOUR)
    large = parts.groupBy("label").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > more_than)
    return parts.join(large, "label", "left_semi").select(*CELL)


def _hull(xy: np.ndarray) -> np.ndarray:
    xy = np.unique(xy, axis=0)

    def half(at: np.ndarray) -> list[np.ndarray]:
        out: list[np.ndarray] = []
        for p in at:
            while len(out) > 1 and (out[-1][0] - out[-2][0]) * (p[1] - out[-2][1]) - (out[-1][1] - out[-2][1]) * (p[0] - out[-2][0]) <= 0:
                out.pop()
            out.append(p)
        return out[:-1]

    return np.array(half(xy) + half(xy[::-1])) if len(xy) > 2 else xy


def outlines(cells: DataFrame) -> DataFrame:
    """``zone, cells, hull_area, compactness`` of the convex outline of each zone's cells, in cell units.

    Only the outermost cells of a row can be corners, so a zone sends two rows of numbers a raster row to its task.
    """
    rows = cells.groupBy("zone", "row").agg(F.min("col").alias("first"), F.max("col").alias("last"), F.count(F.lit(1)).alias("n"))

    def outline(g: pd.DataFrame) -> pd.DataFrame:
        r, a, b = (g[c].to_numpy(float) for c in ("row", "first", "last"))
        xy = _hull(np.concatenate([np.column_stack([c + i, r + j]) for c, i in ((a, 0), (b, 1)) for j in (0, 1)]))
        x, y = xy.T
        area = abs(float(np.dot(x, np.roll(y, -1)) - np.dot(y, np.roll(x, -1)))) / 2
        n = int(g["n"].sum())
        return pd.DataFrame({"zone": g["zone"].iloc[:1], "cells": [n], "hull_area": [area], "compactness": [min(1.0, n / max(area, n))]})

    kind = cells.schema["zone"].dataType.simpleString()
    return rows.groupBy("zone").applyInPandas(outline, f"zone {kind}, cells long, hull_area double, compactness double")


def series_components(series: DataFrame, k: int = 3) -> tuple[DataFrame, list[float]]:
    """``point_id, pc1..pck`` of the demeaned ``values`` and the explained shares.

    The largest loading of each component is positive.  Covariance is summed over the tasks; only an epochs by epochs matrix
    reaches the driver.
    """
    mean = F.aggregate("values", F.lit(0.0), lambda s, x: s + x) / F.size("values")
    own = series.withColumn("_m", mean).select("point_id", F.transform("values", lambda x: x - F.col("_m")).alias("v"))

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x = np.stack(batch["v"].to_numpy()).astype(float)
            yield pd.DataFrame({"n": [len(x)], "total": [x.sum(0).tolist()], "squares": [(x.T @ x).ravel().tolist()]})

    part = own.mapInPandas(sums, "n long, total array<double>, squares array<double>")
    added = part.select("n", F.posexplode(F.concat("total", "squares")).alias("i", "x")).groupBy("i").agg(F.sum("n").alias("n"), F.sum("x").alias("x")).orderBy("i").toPandas()
    if added.empty:
        return own.select("point_id"), []
    n, x = int(added["n"].iloc[0]), added["x"].to_numpy()
    t = int(round((np.sqrt(1 + 4 * len(x)) - 1) / 2))
    centre = x[:t] / n
    value, vector = np.linalg.eigh(x[t:].reshape(t, t) / n - np.outer(centre, centre))
    k = min(k, t, n)
    value, vector = value[::-1], vector[:, ::-1][:, :k]
    vector = vector * np.sign(vector[np.abs(vector).argmax(0), np.arange(k)])
    at = lambda j: F.aggregate(F.zip_with("v", F.lit(vector[:, j].tolist()), lambda a, b: a * b), F.lit(-float(centre @ vector[:, j])), lambda s, y: s + y)
    total = float(value.clip(0).sum())
    return own.select("point_id", *[at(j).alias(f"pc{j + 1}") for j in range(k)]), [float(v) / total if total else 0.0 for v in value[:k]]
