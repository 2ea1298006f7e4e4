"""Panel of channels, choice of points, windows with their history, and the forecasts made from them
(SURVEY FC1-FC8, FC11, FC12, FC18, FC23, FC26-FC28).

A window is one row with its history as an array of structs; everything that a method needs is in that row, so the methods
are projections, and the panel is dealt out by point once.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrapulse.functions.scalars import clip
from terrapulse.functions.stats import quantiles, robust_range
from terrapulse.operators.fits import design
from terrapulse.operators.forecasts import bands, scores, with_bands

#: The channels of the panel by group, in order.
GROUPS = {
    "raw": ("rel0", "delta", "gap_days", "sin_year", "cos_year"),
    "decomposition": ("trend", "seasonal", "residual", "delta2", "velocity", "residual_std"),
    "neighborhood": ("near_rel0", "near_delta", "near_delta_std"),
    "event": ("persistence", "abnormal"),
}
CHANNELS = tuple(c for group in GROUPS.values() for c in group)
#: The baselines in the order in which ties are settled.
METHODS = ("persistence", "linear_trend", "seasonal_naive", "harmonic_trend")


def _by_point() -> Window:
    return Window.partitionBy("point_id").orderBy("epoch_idx")


def from_first(obs: DataFrame) -> DataFrame:
    """Series with their first value taken off."""
    return obs.withColumn("value_mm", F.col("value_mm") - F.first("value_mm").over(_by_point()))


def own_channels(rel: DataFrame, epochs: DataFrame, flagged: DataFrame) -> DataFrame:
    """The channels that a series and its dates give; a step or rate that starts at a missing epoch is 0.

    ``rel`` is a result of :func:`from_first`; ``flagged`` are the abnormal epochs.
    """
    w = _by_point()
    back = lambda k, c: F.first(c).over(w.rangeBetween(-k, -k))
    start = lambda c: F.when(F.col("epoch_idx") > 1, back(2, c)).otherwise(back(1, c))
    df = rel.withColumn("_step", F.col("value_mm") - back(1, "value_mm"))
    df = df.withColumn("_twice", F.col("_step") - back(1, "_step"))
    days = F.col("day_offset") - start("day_offset")
    df = df.withColumn("_rate", F.when(days > 0, (F.col("value_mm") - start("value_mm")) / days * 365.25))
    before = F.lag("day_offset").over(Window.orderBy("epoch_idx"))
    axis = epochs.select("epoch_idx", F.coalesce(F.col("day_offset") - before, F.lit(0)).cast("double").alias("gap_days"))
    flags = flagged.select("epoch_idx", F.lit(1.0).alias("abnormal"))
    doy = F.dayofyear("date").cast("double")
    angle = 2 * math.pi * doy / 365.25
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    return df.join(axis, "epoch_idx").join(flags, "epoch_idx", "left").select(
        "point_id", "epoch_idx", F.col("day_offset").cast("double").alias("day_offset"), doy.alias("doy"), F.col("value_mm").alias("rel0"),
        zero(F.col("_step")).alias("delta"), "gap_days", F.sin(angle).alias("sin_year"), F.cos(angle).alias("cos_year"),
        zero(F.col("_twice")).alias("delta2"), zero(F.col("_rate")).alias("velocity"), zero(F.col("abnormal")).alias("abnormal"),
    )


def panel(own: DataFrame, parts: DataFrame, near: DataFrame, persistence: DataFrame) -> DataFrame:
    """All channels, one row a point and epoch (FC1).

    ``parts`` come from ``fits.robust_harmonic``, ``near`` from ``neighbours.summaries`` and ``persistence`` from
    ``series.persistence``.  All are dealt out by point and epoch; missing neighbour values and deviations are 0.
    """
    key = ["point_id", "epoch_idx"]
    spread = F.stddev_pop("residual").over(_by_point().rangeBetween(-2, 0))
    df = own.join(parts.select(*key, "trend", "seasonal", "residual"), key, "left").withColumn("residual_std", spread)
    around = near.select(*key, F.col("mean_mm").alias("near_rel0"), F.col("mean_delta").alias("near_delta"), F.col("deviation_delta").alias("near_delta_std"))
    df = df.join(around, key, "left").join(persistence.select(*key, "persistence"), key, "left")
    return df.fillna(0.0, ["residual_std", "near_rel0", "near_delta", "near_delta_std", "persistence"]).select(*key, "day_offset", "doy", *CHANNELS)


def selection(points: DataFrame, ends: DataFrame, *, min_points: int = 200, min_train: int = 500, min_val: int = 100) -> DataFrame:
    """One row: which points a model may be trained on (FC2).

    ``points`` have ``point_class`` and ``windows``, ``ends`` have ``split``.  Windows fall to the splits in the ratio of
    their ends; strict points are taken alone if they give enough, else with the relaxed ones, else only baselines run.
    """
    n_end = lambda s: F.greatest(F.lit(1), F.count_if(F.col("split") == s))
    split = ends.agg(*[n_end(s).alias(f"_{s}") for s in ("train", "val", "test")])
    usable = points.where((F.col("windows") > 0) & F.col("point_class").isin("strict", "relaxed"))
    strict = F.when(F.col("point_class") == "strict", F.col("windows"))
    sums = usable.agg(
        F.count(strict).alias("strict_points"), F.coalesce(F.sum(strict), F.lit(0)).alias("strict_windows"),
        F.count(F.lit(1)).alias("all_points"), F.coalesce(F.sum("windows"), F.lit(0)).alias("all_windows"),
    )
    whole = F.col("_train") + F.col("_val") + F.col("_test")
    share = lambda kind, s: F.rint(F.col(f"{kind}_windows") * F.col(f"_{s}") / whole).cast("long")
    enough = lambda kind: (F.col(f"{kind}_points") >= min_points) & (share(kind, "train") >= min_train) & (share(kind, "val") >= min_val)
    mode = F.when(enough("strict"), "strict_only").when(enough("all"), "strict_plus_relaxed").otherwise("fallback_baseline_only")
    df = sums.join(F.broadcast(split)).withColumn("mode", mode)
    pick = lambda f: F.when(F.col("mode") == "strict_only", f("strict")).otherwise(f("all"))
    return df.select("mode", pick(lambda k: F.col(f"{k}_points")).alias("points"), *[pick(lambda k, s=s: share(k, s)).alias(f"{s}_windows") for s in ("train", "val")])


def selected(points: DataFrame, choice: DataFrame) -> DataFrame:
    """The points of a :func:`selection`."""
    usable = points.where((F.col("windows") > 0) & F.col("point_class").isin("strict", "relaxed"))
    met = usable.join(F.broadcast(choice.select("mode")))
    return met.where((F.col("mode") != "strict_only") | (F.col("point_class") == "strict")).drop("mode")


def zone_scope(points: DataFrame, ends: DataFrame, **limits: int) -> DataFrame:
    """One row: the selection within zones (``in_zone``) if it suffices, else that of all points and why (FC3)."""
    inside = selection(points.where("in_zone"), ends, **limits)
    outside = selection(points, ends, **limits)
    usable = (F.col("windows") > 0) & F.col("point_class").isin("strict", "relaxed")
    facts = points.agg(F.count_if("in_zone").alias("_in"), F.count_if(F.col("in_zone") & usable).alias("_usable"))
    met = facts.join(F.broadcast(inside.select(F.struct("*").alias("z")))).join(F.broadcast(outside.select(F.struct("*").alias("a"))))
    good = (F.col("_usable") > 0) & (F.col("z.mode") != "fallback_baseline_only")
    why = F.when(good, "").when(F.col("_in") == 0, "zone_mask_empty").when(F.col("_usable") == 0, "zone_points_without_complete_windows").otherwise("zone_points_insufficient_for_training")
    scope = F.when(good, "zone_high_confidence_only").otherwise("all_high_confidence")
    return met.select(scope.alias("scope"), why.alias("reason"), F.inline(F.array(F.when(good, F.col("z")).otherwise(F.col("a")))))


def windows(found: DataFrame, ends: DataFrame, lookback: int = 12, horizon: int = 3, channels: tuple[str, ...] = CHANNELS) -> DataFrame:
    """One row for each point and complete window that ends at one of ``ends`` (``epoch_idx, split``) (FC4).

    ``history`` holds the epochs with their channels, ``ahead`` the days of the steps, ``targets`` the displacement from
    the last value; ``event`` says that a step ahead is abnormal.
    """
    w = _by_point()
    time = ["epoch_idx", "day_offset", "doy"]
    length = F.count(F.lit(1)).over(w.rangeBetween(1 - lookback, horizon))
    history = F.collect_list(F.struct(*time, *channels)).over(w.rangeBetween(1 - lookback, 0))
    if horizon:
        later = F.collect_list(F.struct(*time, "rel0", "abnormal")).over(w.rangeBetween(1, horizon))
    else:
        later = F.slice(F.array(F.struct(*time, "rel0", "abnormal")), 1, 0)
    df = found.select("point_id", F.col("epoch_idx").alias("window_end"), F.col("rel0").alias("last_rel0"), length.alias("_n"), history.alias("history"), later.alias("_later"))
    df = df.where(F.col("_n") == lookback + horizon).join(ends.select(F.col("epoch_idx").alias("window_end"), "split"), "window_end")
    return df.select(
        "point_id", "window_end", "split", "last_rel0", "history",
        F.transform("_later", lambda x: F.struct(x["day_offset"].alias("day_offset"), x["doy"].alias("doy"))).alias("ahead"),
        F.transform("_later", lambda x: x["rel0"] - F.col("last_rel0")).alias("targets"),
        F.exists("_later", lambda x: x["abnormal"] > 0.5).alias("event"),
    )


def latest_windows(found: DataFrame, epochs: DataFrame, future: DataFrame, lookback: int = 12, channels: tuple[str, ...] = CHANNELS) -> DataFrame:
    """Windows that end at the last epoch, with the days of ``future`` (``k, date``) ahead and no targets (FC5)."""
    last = epochs.agg(F.max("epoch_idx").alias("epoch_idx"), F.max_by(F.struct("date", "day_offset"), "epoch_idx").alias("_last")).withColumn("split", F.lit("latest"))
    ahead = future.join(F.broadcast(last)).select("k", (F.datediff("date", "_last.date") + F.col("_last.day_offset")).cast("double").alias("day_offset"), F.dayofyear("date").cast("double").alias("doy"))
    ahead = ahead.agg(F.transform(F.sort_array(F.collect_list(F.struct("k", "day_offset", "doy"))), lambda x: F.struct(x["day_offset"].alias("day_offset"), x["doy"].alias("doy"))).alias("ahead"))
    return windows(found, last, lookback, 0, channels).drop("ahead").join(F.broadcast(ahead))


def neighbour_windows(found: DataFrame, edges: DataFrame, pool: DataFrame) -> DataFrame:
    """For each window the histories of its point's neighbours that are complete at the same end (FC6)."""
    other = pool.select(F.col("point_id").alias("dst"), "window_end", F.col("history").alias("near_history")).distinct()
    met = found.select("point_id", "window_end").join(edges.select(F.col("src").alias("point_id"), "dst"), "point_id")
    return met.join(other, ["dst", "window_end"])


def normaliser(found: DataFrame, channels: tuple[str, ...] = CHANNELS) -> DataFrame:
    """One row of ``mean_<channel>`` and ``std_<channel>`` over the histories, and ``target_scale`` (FC7).

    A deviation under 1e-6 becomes 1; the scale is the 95th percentile of the target sizes, 1 at least.  Give it the
    windows of the training split.
    """
    flat = found.select(F.inline("history"))
    spread = lambda c: F.when(F.stddev_pop(c) < 1e-6, 1.0).otherwise(F.stddev_pop(c))
    stats = flat.agg(*[F.avg(c).alias(f"mean_{c}") for c in channels], *[spread(c).alias(f"std_{c}") for c in channels])
    size = quantiles(found.select(F.explode("targets").alias("y")), y=(F.abs("y"), 0.95)).select(F.greatest(F.lit(1.0), F.coalesce("y", F.lit(1.0))).alias("target_scale"))
    return stats.join(F.broadcast(size))


def normalised(found: DataFrame, stats: DataFrame, channels: tuple[str, ...] = CHANNELS) -> DataFrame:
    """Windows with scaled channels and targets; a value that is no number becomes 0 (FC8)."""
    finite = lambda c: F.when(c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")), c).otherwise(0.0)
    scaled = lambda x: F.struct(x["epoch_idx"].alias("epoch_idx"), *[finite((x[c] - F.col(f"mean_{c}")) / F.col(f"std_{c}")).alias(c) for c in channels])
    df = found.join(F.broadcast(stats))
    df = df.withColumns({"history": F.transform("history", scaled), "targets": F.transform("targets", lambda y: finite(y / F.col("target_scale")))})
    return df.drop(*stats.columns)


def _mean(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, x: a + x) / F.size(values)


_KEPT = ["point_id", "window_end", "split", "event", "last_rel0", "targets"]


def _with_method(df: DataFrame, method: str, p50: Column) -> DataFrame:
    return df.select(*_KEPT, F.lit(method).alias("method"), p50.alias("p50"))


def still(found: DataFrame) -> DataFrame:
    """No further displacement (FC9)."""
    return _with_method(found, "persistence", F.transform("ahead", lambda _: F.lit(0.0)))


def line(found: DataFrame) -> DataFrame:
    """The least-squares line of the history (FC10)."""
    df = found.withColumns({"_x": _mean(F.col("history.day_offset")), "_y": _mean(F.col("history.rel0"))})
    sums = lambda f: F.aggregate("history", F.lit(0.0), lambda a, r: a + f(r))
    off = lambda r: r["day_offset"] - F.col("_x")
    slope = F.coalesce(F.try_divide(sums(lambda r: off(r) * (r["rel0"] - F.col("_y"))), sums(lambda r: off(r) * off(r))), F.lit(0.0))
    df = df.withColumn("_b", slope)
    return _with_method(df, "linear_trend", F.transform("ahead", lambda a: F.col("_y") + F.col("_b") * (a["day_offset"] - F.col("_x")) - F.col("last_rel0")))


def seasonal_naive(found: DataFrame, *, min_span: float = 180.0, max_distance: float = 45.0) -> DataFrame:
    """The value of the history's nearest day of the year, the earlier one of two (FC11).

    Only windows that span ``min_span`` days and have a day within ``max_distance`` of every step ahead.
    """
    span = F.element_at("history", -1)["day_offset"] - F.get("history", 0)["day_offset"]

    def nearest(a: Column) -> Column:
        apart = lambda r: F.abs(r["doy"] - a["doy"])
        return F.array_min(F.transform("history", lambda r: F.struct(F.least(apart(r), 365.25 - apart(r)).alias("apart"), r["epoch_idx"].alias("epoch_idx"), r["rel0"].alias("rel0"))))

    df = found.where(span >= min_span).withColumn("_near", F.transform("ahead", nearest))
    df = df.where(F.forall("_near", lambda n: n["apart"] <= max_distance))
    return _with_method(df, "seasonal_naive", F.transform("_near", lambda n: n["rel0"] - F.col("last_rel0")))


def harmonic(found: DataFrame) -> DataFrame:
    """A line with an annual wave, the fit of least norm where a history does not settle it (FC12).

    Windows with the same days share one small pseudo-inverse, and all of a batch that do are one matrix product.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            size = {c: pc.list_value_length(batch.column(c)).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("_x", "_a")}
            first = {c: np.cumsum(n) - n for c, n in size.items()}
            flat = {c: batch.column(c).flatten().to_numpy(zero_copy_only=False).astype(float) for c in ("_x", "_a", "_y")}
            last, out = batch.column("last_rel0").to_numpy(zero_copy_only=False), np.empty(len(flat["_a"]))
            for n, m in np.unique(np.column_stack([size["_x"], size["_a"]]), axis=0):
                rows = np.flatnonzero((size["_x"] == n) & (size["_a"] == m))
                past, ahead = first["_x"][rows][:, None] + np.arange(n), first["_a"][rows][:, None] + np.arange(m)
                kinds, which = np.unique(np.hstack([flat["_x"][past], flat["_a"][ahead]]), axis=0, return_inverse=True)
                for k, days in enumerate(kinds):
                    own = which.ravel() == k
                    x, a = design(days[:n]), design(days[n:])
                    beta = flat["_y"][past[own]] @ np.linalg.pinv(x, rcond=np.finfo(float).eps * max(x.shape)).T
                    out[ahead[own]] = beta @ a.T - last[rows[own]][:, None]
            p50 = pa.ListArray.from_arrays(pa.array(np.append(first["_a"], len(out)), pa.int32()), pa.array(out))
            method = pa.array(["harmonic_trend"] * batch.num_rows, pa.string())
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in _KEPT], method, p50], names=[*_KEPT, "method", "p50"])

    df = found.select(*_KEPT, F.col("history.day_offset").alias("_x"), F.col("ahead.day_offset").alias("_a"), F.col("history.rel0").alias("_y"))
    kept = ", ".join(f"{c} {df.schema[c].dataType.simpleString()}" for c in _KEPT)
    return df.mapInArrow(run, f"{kept}, method string, p50 array<double>")


def predictions(found: DataFrame) -> DataFrame:
    """All baselines, one row a window, method and step ahead; give it materialised windows, as each method reads them (FC23)."""
    every = still(found).unionByName(line(found)).unionByName(seasonal_naive(found)).unionByName(harmonic(found))
    flat = every.select("point_id", "window_end", "split", "event", "last_rel0", "method", F.posexplode(F.arrays_zip("targets", "p50")).alias("i", "s"))
    return flat.select(*[c for c in flat.columns if c not in ("i", "s")], (F.col("i") + 1).alias("h"), F.col("s.targets").alias("target"), F.col("s.p50").alias("p50"))


def tournament(predicted: DataFrame, *, fit: str = "val", test: str = "test") -> DataFrame:
    """Predictions of the ``test`` windows within the bands that ``fit`` windows give (FC23)."""
    return with_bands(predicted.where(F.col("split") == test), bands(predicted.where(F.col("split") == fit)))


def evaluation(predicted: DataFrame) -> DataFrame:
    """Scores of all windows, of those with an abnormal step and of the others, by method and step (FC28, A34)."""
    subsets = F.array(F.lit("overall"), F.when(F.col("event"), "event_windows").otherwise("stable_windows"))
    return scores(predicted.withColumn("subset", F.explode(subsets)), by=("method", "subset"))


def best_method(scored: DataFrame, order: tuple[str, ...] = METHODS) -> DataFrame:
    """The method with the least mean error over all steps, the earlier in ``order`` of equal ones (FC18)."""
    rank = F.array_position(F.lit(list(order)), F.col("method"))
    return scored.where("h = 0").agg(F.min_by("method", F.struct("mae", rank)).alias("method"), F.min("mae").alias("mae"))


def forecast(predicted: DataFrame, found: DataFrame, future: DataFrame, points: DataFrame, reliability: float = 1.0) -> DataFrame:
    """Displacements of the steps ahead with bands, dates, mean width and confidence (FC26, FC27).

    ``found`` are bands, ``future`` the dates by ``k``, ``points`` have ``ps_score, jump_risk, exposure``.
    """
    df = with_bands(predicted, found).join(F.broadcast(future.select(F.col("k").alias("h"), "date")), "h")
    whole = df.groupBy("point_id", "method").agg(F.avg(F.col("p90") - F.col("p10")).alias("width"))
    sure = robust_range(whole, "width", "_w").join(points.select("point_id", "ps_score", "jump_risk", "exposure"), "point_id")
    unit = lambda c: clip(F.col(c), 0.0, 1.0)
    score = 0.60 * (1 - F.col("_w")) + 0.20 * unit("ps_score") + 0.10 * (1 - unit("jump_risk")) + 0.10 * (1 - unit("exposure"))
    sure = sure.select("point_id", "method", "width", clip(score * reliability, 0.0, 1.0).alias("confidence"))
    rel0 = [(F.col("last_rel0") + F.col(q)).alias(f"rel0_{q}") for q in ("p10", "p50", "p90")]
    return df.join(sure, ["point_id", "method"]).select("point_id", "method", "h", "date", "p10", "p50", "p90", *rel0, "width", "confidence")
