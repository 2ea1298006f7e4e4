"""Window samples, baselines, bands, conformal calibration and scores of forecasts, in long form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrapulse.functions.stats import order_statistic, quantiles


def samples(obs: DataFrame, lookback: int = 12, horizon: int = 3) -> DataFrame:
    """One row for each point, complete window end and step ahead: ``target`` is the displacement from the last value of the window.

    ``slope`` and ``cut`` are the line through the window over ``day_offset``.  A window counts if all its epochs and the
    ``horizon`` epochs after it are there.
    """
    w = Window.partitionBy("point_id").orderBy("epoch_idx")
    past, whole = w.rangeBetween(1 - lookback, 0), w.rangeBetween(1 - lookback, horizon)
    ahead = F.array(*[F.struct(F.lit(h).alias("h"), (F.lead("value_mm", h).over(w) - F.col("value_mm")).alias("target"), F.lead("day_offset", h).over(w).alias("day")) for h in range(1, horizon + 1)])
    slope = F.coalesce(F.regr_slope("value_mm", "day_offset").over(past), F.lit(0.0))
    df = obs.select("point_id", "epoch_idx", "value_mm", F.count("value_mm").over(whole).alias("_n"), slope.alias("slope"), F.avg("value_mm").over(past).alias("_y"), F.avg("day_offset").over(past).alias("_x"), ahead.alias("_a"))
    df = df.where(F.col("_n") == lookback + horizon)
    return df.select("point_id", F.col("epoch_idx").alias("window_end"), F.col("value_mm").alias("last_mm"), "slope", (F.col("_y") - F.col("slope") * F.col("_x")).alias("cut"), F.inline("_a"))


def baselines(found: DataFrame) -> DataFrame:
    """Predicted displacement of each sample by ``persistence`` (none) and ``linear_trend`` (the line of the window)."""
    line = F.col("cut") + F.col("slope") * F.col("day") - F.col("last_mm")
    ways = F.array(*[F.struct(F.lit(n).alias("method"), p.alias("p50")) for n, p in (("persistence", F.lit(0.0)), ("linear_trend", line))])
    return found.select("point_id", "window_end", "h", "target", F.inline(ways))


def bands(predicted: DataFrame, low: float = 0.1, high: float = 0.9) -> DataFrame:
    """Quantiles of what is left over, by method and step ahead (FC13)."""
    left = F.col("target") - F.col("p50")
    return quantiles(predicted, "method", "h", q10=(left, low), q90=(left, high))


def with_bands(predicted: DataFrame, found: DataFrame) -> DataFrame:
    """Predictions with the bands around them, in ascending order."""
    df = predicted.join(F.broadcast(found), ["method", "h"]).withColumns({"p10": F.col("p50") + F.col("q10"), "p90": F.col("p50") + F.col("q90")})
    return monotonic(df).drop("q10", "q90")


def monotonic(df: DataFrame) -> DataFrame:
    """``p10 <= p50 <= p90`` by sorting the three."""
    three = F.array_sort(F.array("p10", "p50", "p90"))
    return df.withColumn("_s", three).withColumns({n: F.get("_s", i) for i, n in enumerate(("p10", "p50", "p90"))}).drop("_s")


def pinball(pred: Column, target: Column, quantile: float) -> Column:
    """Loss of one quantile (FC14)."""
    e = target - pred
    return F.greatest(quantile * e, (quantile - 1) * e)


def interval_score(alpha: float = 0.2) -> Column:
    """Width, penalties of misses, and the unweighted error of the median (FC15)."""
    y, lo, mid, hi = (F.col(c) for c in ("target", "p10", "p50", "p90"))
    return hi - lo + 2 / alpha * F.greatest(lo - y, F.lit(0.0)) + 2 / alpha * F.greatest(y - hi, F.lit(0.0)) + F.abs(mid - y)


def quantile_loss(predicted: DataFrame, penalty: float = 0.1) -> DataFrame:
    """Mean pinball loss of the three quantiles, and ``penalty`` times how far they cross, by method (FC14)."""
    y, lo, mid, hi = (F.col(c) for c in ("target", "p10", "p50", "p90"))
    base = sum(F.avg(pinball(p, y, q)) for p, q in ((lo, 0.1), (mid, 0.5), (hi, 0.9))) / 3
    crossed = F.avg(F.greatest(F.lit(0.0), lo - mid)) + F.avg(F.greatest(F.lit(0.0), mid - hi))
    return predicted.groupBy("method").agg((base + penalty * crossed).alias("loss"))


def scores(predicted: DataFrame, target_coverage: float = 0.8, by: tuple[str, ...] = ("method",)) -> DataFrame:
    """Metrics by ``by`` and step ahead, and over all steps as step 0 (FC16, A34)."""
    y = F.col("target")
    diff = F.col("p50") - y
    mean_pinball = sum(F.avg(pinball(F.col(c), y, q)) for c, q in (("p10", 0.1), ("p50", 0.5), ("p90", 0.9))) / 3
    cover = F.avg(y.between(F.col("p10"), F.col("p90")).cast("double"))
    group = [F.col(c) for c in by]
    steps = predicted.groupingSets([[*group, F.col("h")], group], *group, F.col("h"))
    return steps.agg(
        F.avg(F.abs(diff)).alias("mae"), F.sqrt(F.avg(diff * diff)).alias("rmse"), mean_pinball.alias("pinball"), cover.alias("coverage"),
        F.abs(cover - target_coverage).alias("coverage_error"), F.avg(F.col("p90") - F.col("p10")).alias("width"), F.avg(interval_score()).alias("wis_ref"),
    ).withColumn("h", F.coalesce("h", F.lit(0)))


def calibration(predicted: DataFrame, target_coverage: float = 0.8) -> DataFrame:
    """``method, h, correction``: by how much an interval grows on both sides to cover the wanted share (FC20).

    The scores are how far a target lies outside its interval, 0 inside; the correction is the order statistic at the
    level ceil((n + 1) coverage) / n, the higher one between two.
    """
    score = F.greatest(F.col("p10") - F.col("target"), F.col("target") - F.col("p90"), F.lit(0.0))
    n = F.col("_n").cast("double")
    level = F.least(F.lit(1.0), F.ceil((n + 1) * target_coverage) / n)
    at = F.ceil(F.round((n - 1) * level, 6)) + 1
    return order_statistic(predicted.select("method", "h", score.alias("score")), ["method", "h"], "score", at).withColumnRenamed("score", "correction")


def calibrated(predicted: DataFrame, corrections: DataFrame) -> DataFrame:
    """Intervals widened by their correction, in ascending order (FC21)."""
    df = predicted.join(F.broadcast(corrections), ["method", "h"]).withColumns({"p10": F.col("p10") - F.col("correction"), "p90": F.col("p90") + F.col("correction")})
    return monotonic(df).drop("correction")


def reliability(scored: DataFrame, target_coverage: float = 0.8) -> DataFrame:
    """1 less the mean coverage error of the steps over the wanted coverage, within [0, 1], of each method."""
    return scored.where("h > 0").groupBy("method").agg(F.greatest(F.lit(0.0), F.least(F.lit(1.0), 1 - F.avg("coverage_error") / target_coverage)).alias("reliability"))


def calibration_curve(predicted: DataFrame, corrections: DataFrame, target_coverage: float = 0.8) -> DataFrame:
    """``method, h, raw_coverage, calibrated_coverage, target_coverage``: the share of targets within the bands, before and after (FC29)."""
    inside = lambda c: F.avg(F.col("target").between(F.col("p10") - c, F.col("p90") + c).cast("double"))
    met = predicted.join(F.broadcast(corrections.select("method", "h", "correction")), ["method", "h"])
    return met.groupBy("method", "h").agg(inside(F.lit(0.0)).alias("raw_coverage"), inside(F.col("correction")).alias("calibrated_coverage")).withColumn("target_coverage", F.lit(target_coverage))


def horizon_panel(predicted: DataFrame, value: str = "p50") -> DataFrame:
    """Predictions of each step with ``shade`` in [-1, 1]: over the 95th percentile of their sizes at all steps, which counts as 1 at least (FC29)."""
    limit = quantiles(predicted, _limit=(F.abs(value), 0.95)).select(F.greatest("_limit", F.lit(1.0)).alias("_limit"))
    shade = F.greatest(F.lit(-1.0), F.least(F.lit(1.0), F.col(value) / F.col("_limit")))
    return predicted.join(F.broadcast(limit)).withColumn("shade", shade).drop("_limit")


def examples(forecast: DataFrame, rel: DataFrame, n: int = 6) -> DataFrame:
    """``sample, point_id, confidence, epoch_idx, h, value, p10, p90``: history and forecast of the ``n`` surest points, one row a step (FC29).

    ``forecast`` has ``point_id, h, rel0_p10, rel0_p50, rel0_p90, confidence`` of one method, ``rel`` the series since their first value. Ties go to the smaller id; the forecast starts at
    the last value of the history, where its band is closed (``h`` 0).
    """
    order = Window.orderBy(F.desc(F.round("confidence", 9)), "point_id")
    best = forecast.groupBy("point_id").agg(F.first("confidence").alias("confidence")).orderBy(F.desc(F.round("confidence", 9)), "point_id").limit(n)
    best = best.withColumn("sample", F.row_number().over(order))
    none = F.lit(None).cast("double")
    past = rel.join(best, "point_id").select("sample", "point_id", "confidence", "epoch_idx", none.cast("int").alias("h"), F.col("value_mm").alias("value"), none.alias("p10"), none.alias("p90"))
    last = past.groupBy("sample", "point_id", "confidence").agg(F.max("epoch_idx").alias("epoch_idx"), F.max_by("value", "epoch_idx").alias("value"))
    joint = last.select("sample", "point_id", "confidence", "epoch_idx", F.lit(0).alias("h"), "value", F.col("value").alias("p10"), F.col("value").alias("p90"))
    ahead = forecast.drop("confidence").join(last.select("sample", "point_id", "confidence", "epoch_idx"), "point_id")
    ahead = ahead.select("sample", "point_id", "confidence", (F.col("epoch_idx") + F.col("h")).alias("epoch_idx"), "h", F.col("rel0_p50").alias("value"), F.col("rel0_p10").alias("p10"), F.col("rel0_p90").alias("p90"))
    return past.union(joint).union(ahead)
