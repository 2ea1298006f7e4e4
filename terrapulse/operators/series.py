"""Displacement series in long form: windows over epochs and fits per point."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from terrapulse.functions.stats import quantiles, with_stats
from terrapulse.operators import fits


def by_point():
    return Window.partitionBy("point_id").orderBy("epoch_idx")



def steps(obs: DataFrame) -> DataFrame:
    """First and second differences along the series, and the gap in days (0 at the start)."""
    df = obs.withColumn("delta", F.col("value_mm") - F.lag("value_mm").over(by_point()))
    df = df.withColumn("delta2", F.col("delta") - F.lag("delta").over(by_point()))
    return df.withColumn("gap_days", F.coalesce(F.datediff("date", F.lag("date").over(by_point())), F.lit(0)))


def rolling(obs: DataFrame, epochs: int = 3) -> DataFrame:
    """Velocity over up to ``epochs`` epochs in mm a year, population deviation and 3-tap smoothing."""
    frame = by_point().rowsBetween(1 - epochs, 0)
    first = lambda c: F.first(c).over(frame)
    days = F.datediff("date", first("date"))
    velocity = F.when(days > 0, (F.col("value_mm") - first("value_mm")) / days * 365.25)
    before, after = (F.coalesce(f("value_mm").over(by_point()), F.col("value_mm")) for f in (F.lag, F.lead))
    return obs.withColumns({"velocity": velocity, "deviation": F.stddev_pop("value_mm").over(frame), "smooth": 0.25 * before + 0.5 * F.col("value_mm") + 0.25 * after})


def shape(obs: DataFrame, quiet: float = 0.25) -> DataFrame:
    """Net and peak displacement, path length, signs of steps, and their agreement, of each point."""
    rel = F.col("value_mm") - F.first("value_mm").over(by_point())
    df = obs.withColumn("rel", rel).withColumn("delta", F.col("value_mm") - F.lag("value_mm").over(by_point()))
    loud = F.when(F.abs("delta") > quiet, F.col("delta"))
    out = df.groupBy("point_id").agg(
        F.max_by("rel", "epoch_idx").alias("net"),
        F.max(F.abs("rel")).alias("peak"),
        F.coalesce(F.sum(F.abs(loud)), F.lit(0.0)).alias("path"),
        F.count_if(loud > 0).alias("up"),
        F.count_if(loud < 0).alias("down"),
    )
    most = F.greatest("up", "down") / F.greatest(F.lit(1), F.col("up") + F.col("down"))
    return out.withColumn("sign_consistency", most).withColumn("net_to_path", F.abs("net") / F.greatest("path", F.lit(1e-6)))


def trend(obs: DataFrame) -> DataFrame:
    """Least-squares line of each point in years: slope, residual sum of squares, RMS and BIC."""
    t = F.col("day_offset") / 365.25
    out = obs.groupBy("point_id").agg(
        F.count(F.lit(1)).alias("n"), F.regr_slope("value_mm", t).alias("slope"), F.regr_intercept("value_mm", t).alias("intercept"), F.regr_syy("value_mm", t).alias("syy"), F.regr_sxy("value_mm", t).alias("sxy")
    )
    sse = F.greatest(F.col("syy") - F.coalesce(F.col("slope") * F.col("sxy"), F.lit(0.0)), F.lit(0.0))
    out = out.withColumn("sse", sse).withColumn("rms", F.sqrt(F.col("sse") / F.col("n")))
    return out.withColumn("bic", fits.bic(F.col("sse"), F.col("n"), 2)).drop("syy", "sxy")


def slope_sensitivity(obs: DataFrame) -> DataFrame:
    """Largest change of the slope when one epoch, not the first, is left out: a closed form of the sums (TS4)."""
    t, y = F.col("day_offset") / 365.25, F.col("value_mm")
    whole = Window.partitionBy("point_id")
    df = obs.withColumns({"t": t, "y": y})
    s = {"n": F.count(F.lit(1)), "st": F.sum("t"), "sy": F.sum("y"), "stt": F.sum(F.col("t") * F.col("t")), "sty": F.sum(F.col("t") * F.col("y"))}
    df = df.withColumns({k: v.over(whole) for k, v in s.items()}).withColumn("first", F.min("epoch_idx").over(whole))
    slope = lambda n, st, sy, stt, sty: F.try_divide(n * sty - st * sy, n * stt - st * st)
    full = slope(F.col("n"), F.col("st"), F.col("sy"), F.col("stt"), F.col("sty"))
    less = slope(F.col("n") - 1, F.col("st") - F.col("t"), F.col("sy") - F.col("y"), F.col("stt") - F.col("t") * F.col("t"), F.col("sty") - F.col("t") * F.col("y"))
    return df.where(F.col("epoch_idx") > F.col("first")).groupBy("point_id").agg(F.max(F.abs(less - full)).alias("sensitivity"))


def _odd(res: DataFrame, threshold: float | DataFrame) -> DataFrame:
    """Residuals with ``odd``: above a number, or above the ``jump_threshold`` of :func:`residual_threshold`."""
    if isinstance(threshold, DataFrame):
        return res.crossJoin(F.broadcast(threshold.select("jump_threshold"))).withColumn("odd", F.abs("res") > F.col("jump_threshold")).drop("jump_threshold")
    return res.withColumn("odd", F.abs("res") > threshold)


def date_quality(obs: DataFrame, threshold: float | DataFrame = 10.0) -> DataFrame:
    """Residuals from each point's chosen model, by date: median, share above a threshold, signed bias."""
    res = _odd(residuals(obs), threshold)
    return res.groupBy("date").agg(F.median(F.abs("res")).alias("median_abs"), F.avg(F.col("odd").cast("double")).alias("frac"), F.median("res").alias("bias"))


def flag_dates(dates: DataFrame, quantile: float = 0.9, frac: float | None = 0.20, median_mm: float | None = 20.0) -> DataFrame:
    """Ranks by both criteria; flagged are the top share of either and, where limits are given, dates that reach one (W10).  One row per date: a small table."""
    a, b = Window.orderBy(F.desc(F.round("median_abs", 9)), "date"), Window.orderBy(F.desc(F.round("frac", 9)), "date")
    top = F.ceil(F.count(F.lit(1)).over(Window.partitionBy()) * (1 - quantile))
    df = dates.withColumns({"rank_by_median_abs": F.row_number().over(a), "rank_by_frac": F.row_number().over(b), "top": top})
    flagged = (F.col("rank_by_median_abs") <= F.col("top")) | (F.col("rank_by_frac") <= F.col("top"))
    for name, limit in (("frac", frac), ("median_abs", median_mm)):
        if limit is not None:
            flagged = flagged | F.coalesce(F.round(name, 9) >= limit, F.lit(False))
    return df.withColumn("flagged", flagged).drop("top")


def ends(obs: DataFrame) -> DataFrame:
    """First and last value of each point, and the last one relative to the first."""
    out = obs.groupBy("point_id").agg(F.min_by("value_mm", "epoch_idx").alias("first_mm"), F.max_by("value_mm", "epoch_idx").alias("last_mm"))
    return out.withColumn("last_rel0", F.col("last_mm") - F.col("first_mm"))


def fill_gaps(obs: DataFrame) -> DataFrame:
    """One row per point and epoch, gaps bridged linearly by epoch index, flat before the first and after the last value.

    Each value is spread over the epochs up to the next one, so no grid of points and epochs is joined.
    """
    df = with_stats(obs.select("point_id", "epoch_idx", "value_mm"), _last=F.max("epoch_idx"))
    at, v = F.col("epoch_idx"), F.col("value_mm")
    df = df.withColumns({"_n": F.lead(at).over(by_point()), "_nv": F.lead(v).over(by_point()), "_from": F.when(F.lag(at).over(by_point()).isNull(), 0).otherwise(at)})
    df = df.withColumn("e", F.explode(F.sequence("_from", F.coalesce(F.col("_n") - 1, F.col("_last")))))
    share = (F.col("e") - at) / (F.col("_n") - at)
    value = F.when((F.col("e") <= at) | F.col("_n").isNull(), v).otherwise(v + (F.col("_nv") - v) * share)
    return df.select("point_id", F.col("e").alias("epoch_idx"), value.alias("value_mm"), (F.col("e") != at).alias("filled"))


def loud_epochs(obs: DataFrame, quantile: float = 0.8) -> DataFrame:
    """Epochs whose median absolute step is above that quantile of all epochs: one row per epoch, a small table."""
    by = steps(obs).where("delta IS NOT NULL").groupBy("epoch_idx").agg(F.median(F.abs("delta")).alias("m"))
    return with_stats(by, _q=F.percentile("m", F.lit(quantile))).where("m > _q").select("epoch_idx")


def persistence(obs: DataFrame, flagged: DataFrame) -> DataFrame:
    """Mean absolute step over three epochs, counted at ``flagged`` epochs only, over the point's 95th percentile (1 at least), held in [0, 1]."""
    df = steps(obs).withColumn("size", F.coalesce(F.abs("delta"), F.lit(0.0)))
    df = df.join(flagged.select("epoch_idx", F.lit(True).alias("_flag")), "epoch_idx", "left")
    strength = F.when(F.col("_flag"), F.col("size")).otherwise(0.0)
    df = df.withColumn("strength", F.avg(strength).over(by_point().rowsBetween(-2, 0)))
    scale = F.greatest(F.lit(1.0), F.percentile("size", F.lit(0.95)).over(Window.partitionBy("point_id")))
    return df.select("point_id", "epoch_idx", F.least(F.lit(1.0), F.col("strength") / scale).alias("persistence"))


def complete_windows(obs: DataFrame, lookback: int = 12, horizon: int = 6) -> DataFrame:
    """Windows of ``lookback`` + ``horizon`` epochs without a gap, per point: a run of n epochs holds n - length + 1."""
    runs = obs.where("value_mm IS NOT NULL").withColumn("run", F.col("epoch_idx") - F.row_number().over(by_point()))
    runs = runs.groupBy("point_id", "run").agg(F.count(F.lit(1)).alias("n"))
    return runs.groupBy("point_id").agg(F.sum(F.greatest(F.lit(0), F.col("n") - (lookback + horizon - 1))).alias("windows"))


def split_ends(epochs: DataFrame, lookback: int = 12, horizon: int = 6) -> DataFrame:
    """Window ends by time: 70 % train, 15 % validation, the rest test; with one or two ends the last serves both."""
    df = with_stats(epochs.select("epoch_idx"), _n=F.count(F.lit(1)) - (lookback + horizon - 1)).withColumn("_k", F.col("epoch_idx") - (lookback - 1))
    n, k = F.col("_n"), F.col("_k")
    train = F.greatest(F.lit(1), F.floor(n * 0.7))
    val = F.least(n - 1, F.greatest(train + 1, F.floor(n * 0.85)))
    usual = F.array(F.when(k < train, "train").when(k < val, "val").otherwise("test"))
    few = F.filter(F.array(F.when(k == 0, "train"), F.when(k == n - 1, "val"), F.when(k == n - 1, "test")), lambda x: x.isNotNull())
    return df.where((k >= 0) & (k < n)).select("epoch_idx", F.explode(F.when(n <= 2, few).otherwise(usual)).alias("split"))


def future_dates(epochs: DataFrame, horizon: int = 6) -> DataFrame:
    """Dates after the last epoch, spaced by the whole days of the median of the last five gaps, one at least."""
    gaps = epochs.withColumn("gap", F.datediff("date", F.lag("date").over(Window.orderBy("epoch_idx"))))
    gaps = with_stats(gaps, _last=F.max("epoch_idx"), _date=F.max("date")).where(F.col("epoch_idx") > F.col("_last") - 5)
    gaps = gaps.agg(F.median("gap").cast("int").alias("gap"), F.max("_date").alias("last"))
    step = F.greatest(F.lit(1), F.col("gap"))
    return gaps.select(F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("k"), "last", step.alias("step")).select("k", F.date_add("last", (F.col("k") * F.col("step")).cast("int")).alias("date"))


def even_epochs(epochs: DataFrame, k: int = 9) -> DataFrame:
    """``k`` epochs spread evenly from first to last, halves to the even index."""
    n = epochs.agg(F.count(F.lit(1)).alias("n")).withColumn("k", F.least(F.lit(k), F.col("n")).cast("int"))
    i = F.explode(F.sequence(F.lit(0), F.col("k") - 1)).alias("i")
    at = F.when(F.col("k") == 1, F.lit(0.0)).otherwise(F.col("i") * ((F.col("n") - 1) / F.greatest(F.lit(1), F.col("k") - 1)))
    return n.where("n > 0").select("n", "k", i).select(F.bround(at).cast("int").alias("epoch_idx")).distinct().join(epochs, "epoch_idx")


def residual_threshold(obs: DataFrame, floor_mm: float = 28.0, scale: float = 1.0) -> DataFrame:
    """90th and 95th percentile of the absolute residuals of all points, and the jump threshold they give."""
    out = quantiles(residuals(obs), p90=(F.abs("res"), 0.9), p95=(F.abs("res"), 0.95))
    return out.withColumn("jump_threshold", F.greatest(F.lit(floor_mm), F.col("p95") * scale))


def residuals(obs: DataFrame) -> DataFrame:
    """Observations with the residual ``res`` from their point's chosen model (TS3): annual motion and a change of rate are no noise.

    Observations that have ``res`` already are given back, so that a chain of rules can share one fit.
    """
    if "res" in obs.columns:
        return obs
    return fits.model_fits(obs).select(*obs.columns, "res")


def concentration(obs: DataFrame, points: DataFrame, threshold: float | DataFrame = 10.0, cells: int = 10) -> DataFrame:
    """By date: anomalies and the largest share of them in one of ``cells`` x ``cells`` parts of the grid, 0 without any."""
    at = with_stats(points.select("point_id", "row", "col"), _h=F.max("row") + 1, _w=F.max("col") + 1)
    part = lambda x, n: F.least(F.lit(cells - 1), F.floor(F.col(x) / F.col(n) * cells))
    at = at.select("point_id", part("row", "_h").alias("_rb"), part("col", "_w").alias("_cb"))
    by_cell = _odd(residuals(obs), threshold).join(at, "point_id").groupBy("date", "_rb", "_cb").agg(F.sum(F.col("odd").cast("int")).alias("n"))
    return by_cell.groupBy("date").agg(F.sum("n").alias("anomalies"), F.coalesce(F.try_divide(F.max("n"), F.sum("n")), F.lit(0.0)).alias("concentration"))


def exemplars(obs: DataFrame, points: DataFrame, each: int = 4) -> DataFrame:
    """The steadiest, fastest and lowest-scored points, each once, under the first reason that names it (T4)."""
    steady = steps(obs).groupBy("point_id").agg(F.stddev_pop("delta").alias("stability"))
    df = trend(obs).select("point_id", F.col("slope").alias("velocity")).join(steady, "point_id").join(points.select("point_id", "tcoh"), "point_id")
    best = lambda name, place, by: df.orderBy(by, "point_id").limit(each).withColumns({"reason": F.lit(name), "_place": F.lit(place)})
    chosen = best("steady", 0, F.round("stability", 9)).union(best("fast", 1, F.desc(F.round(F.abs("velocity"), 9)))).union(best("weak", 2, F.col("tcoh")))
    return chosen.groupBy("point_id").agg(F.min_by("reason", "_place").alias("reason"), *[F.first(c).alias(c) for c in ("velocity", "stability", "tcoh")])


def increments(obs: DataFrame, pairs: DataFrame) -> DataFrame:
    """Displacement between the two dates of every pair at every point that has both."""
    d = lambda end: F.date_format("date", "yyyyMMdd").alias(end)
    a = obs.select("point_id", d("date1"), F.col("value_mm").alias("_a"))
    b = obs.select("point_id", d("date2"), F.col("value_mm").alias("_b"))
    return a.join(pairs.select("date1", "date2"), "date1").join(b, ["point_id", "date2"]).select("point_id", "date1", "date2", (F.col("_b") - F.col("_a")).alias("increment_mm"))


def sample_cap(obs: DataFrame, limit: int, seed: int = 42) -> DataFrame:
    """``limit`` rows in an order fixed by a hash of point, epoch and seed; reruns draw the same rows."""
    order = F.md5(F.concat_ws(":", "point_id", "epoch_idx", F.lit(seed)))
    return obs.orderBy(order, "point_id", "epoch_idx").limit(limit)
