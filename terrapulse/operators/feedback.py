"""Feedback from series to pairs: residuals, pair quality, penalties of flagged dates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrapulse.functions.scalars import phase_to_mm
from terrapulse.functions.stats import robust_range
from terrapulse.operators import fits
from terrapulse.operators.pairs import WEIGHT, is_valid, main_component
from terrapulse.session import materialise

PAIR = ["date1", "date2"]
# What a flagged date costs a pair by the scope of its anomaly, what low consistency adds, and the most in all.
PENALTY = {"global": 0.10, "mixed": 0.05, "local": 0.025}
LOW_CONSISTENCY, MOST = 0.10, 0.20


def pair_residuals(pixels: DataFrame, models: DataFrame) -> DataFrame:
    """Pixels with ``ok``, ``main`` and ``residual``, the difference between what a pair shows and what its point's model says of its two dates (J2, TS5).

    ``models`` are those of ``fits.models``, read at both dates whether the point has an epoch there or not.  Pixels of points
    without a model are left out.
    """
    ok = is_valid(F.col("cc"), F.col("unw"))
    at = lambda d: fits.predicted(F.to_date(d, "yyyyMMdd"))
    df = pixels.join(models, "point_id").join(main_component(pixels), PAIR, "left")
    return df.select(*PAIR, "point_id", ok.alias("ok"), F.coalesce(ok & (F.col("cc") == F.col("main_cc")), F.lit(False)).alias("main"), F.abs(phase_to_mm(F.col("unw")) - (at("date2") - at("date1"))).alias("residual"))


def pair_metrics(residuals: DataFrame, jump_threshold: float = 28.0) -> DataFrame:
    """Of each pair the share of bad pixels, cover by the main component, share of jumps and median residual; no valid pixel counts as all jumps."""
    good = F.when(F.col("ok"), F.col("residual"))
    return residuals.groupBy(*PAIR).agg(
        (1 - F.avg(F.col("ok").cast("double"))).alias("bad_ratio"), F.avg(F.col("main").cast("double")).alias("main_cc_coverage"),
        F.coalesce(F.avg((good > jump_threshold).cast("double")), F.lit(1.0)).alias("unwrap_jump_index"), F.median(good).alias("median_residual"),
    )


def point_jumps(residuals: DataFrame, jump_threshold: float = 28.0) -> DataFrame:
    """Of each point the shares of valid and of main-component pixels, and of jumps among the valid ones (A10)."""
    jump = (F.col("ok") & (F.col("residual") > jump_threshold)).cast("long")
    return residuals.groupBy("point_id").agg(
        F.avg(F.col("ok").cast("double")).alias("valid_pair_ratio"), F.avg(F.col("main").cast("double")).alias("maincc_ratio"),
        (F.sum(jump) / F.greatest(F.lit(1), F.count_if("ok"))).alias("jump_risk"),
    )


def with_overlap(pairs: DataFrame, coverage: DataFrame) -> DataFrame:
    """Pairs with ``overlap``, the lesser ``coverage`` of their two dates; an unknown date is covered."""
    end = lambda d, n: coverage.select(F.col("date").alias(d), F.col("coverage").alias(n))
    met = pairs.join(end("date1", "_a"), "date1", "left").join(end("date2", "_b"), "date2", "left")
    return met.withColumn("overlap", F.least(F.coalesce("_a", F.lit(1.0)), F.coalesce("_b", F.lit(1.0)))).drop("_a", "_b")


def by_quality(quality: Column) -> Column:
    """Action by pair quality."""
    return F.when(quality >= 0.75, "keep").when(quality >= 0.50, "downweight").otherwise("drop")


def weight_of(action: Column) -> Column:
    return F.coalesce(*[F.when(action == a, F.lit(w)) for a, w in WEIGHT.items()])


def first_round(pairs: DataFrame, metrics: DataFrame) -> DataFrame:
    """Quality, action and weight of every pair; a pair without metrics has the worst values and quality 0.

    ``pairs`` may have ``overlap`` (:func:`with_overlap`), which counts as 1 where it is not there.
    """
    # a row a pair, summed up from all pixels: written once, as its range is read beside it
    known = robust_range(materialise(metrics).withColumn("_known", F.lit(True)), "median_residual", "_m").withColumn("consistency", F.when(F.col("median_residual").isNotNull(), 1 - F.col("_m")).otherwise(0.0)).drop("_m")
    df = pairs.join(known, PAIR, "left")
    df = df.withColumns({c: F.coalesce(c, F.lit(v)) for c, v in (("bad_ratio", 1.0), ("main_cc_coverage", 0.0), ("unwrap_jump_index", 1.0), ("consistency", 0.0))})
    q = 0.30 * (1 - F.col("bad_ratio")) + 0.25 * F.col("main_cc_coverage") + 0.20 * (1 - F.col("unwrap_jump_index")) + 0.15 * F.col("consistency") + 0.10 * (F.col("overlap") if "overlap" in pairs.columns else F.lit(1.0))
    df = df.withColumn("q_round1", F.when(F.col("_known"), q).otherwise(0.0)).drop("_known")
    return df.withColumn("action_round1", by_quality(F.col("q_round1"))).withColumn("weight_round1", weight_of(F.col("action_round1")))


def scope(concentration: Column) -> Column:
    """How far an anomaly reaches, by the largest share of it in one part of the grid."""
    return F.when(concentration <= 0.20, "global").when(concentration <= 0.40, "mixed").otherwise("local")


def second_round(first: DataFrame, flagged: DataFrame) -> DataFrame:
    """Quality less the penalties of the flagged dates (``date`` as in the pairs, ``scope``) at both ends and of low consistency."""
    cost = F.coalesce(*[F.when(F.col("scope") == s, F.lit(p)) for s, p in PENALTY.items()])
    ends = first.select(*PAIR, F.explode(F.array(*PAIR)).alias("date")).join(flagged.select("date", cost.alias("_cost")), "date")
    paid = ends.groupBy(*PAIR).agg(F.sum("_cost").alias("_paid"))
    df = first.join(paid, PAIR, "left")
    penalty = F.least(F.lit(MOST), F.coalesce("_paid", F.lit(0.0)) + F.when(F.col("consistency") < 0.5, LOW_CONSISTENCY).otherwise(0.0))
    df = df.withColumn("penalty", penalty).withColumn("q_round2", F.greatest(F.lit(0.0), F.col("q_round1") - F.col("penalty"))).drop("_paid")
    return df.withColumn("action_round2", by_quality(F.col("q_round2"))).withColumn("weight_round2", weight_of(F.col("action_round2")))


def final(pairs: DataFrame) -> DataFrame:
    """The second round where there is one, else the first."""
    return pairs.select(*PAIR, F.coalesce("action_round2", "action_round1").alias("action"), F.coalesce("weight_round2", "weight_round1").alias("pair_weight"), F.when(F.col("action_round2").isNotNull(), "round2").otherwise("round1").alias("selected_round"))


def coverage_warnings(classes: DataFrame) -> DataFrame:
    """Point counts by class and what speaks against them."""
    n = F.greatest(F.count(F.lit(1)), F.lit(1))
    out = classes.agg(F.count_if(F.col("point_class") == "strict").alias("strict"), F.count_if(F.col("point_class") == "relaxed").alias("relaxed"), n.alias("_n"))
    s, r = F.col("strict") / F.col("_n"), F.col("relaxed") / F.col("_n")
    reasons = F.array_compact(F.array(F.when((s < 0.005) | (F.col("strict") < 2000), "too_sparse"), F.when(s > 0.20, "strict_too_loose"), F.when(s + r > 0.40, "strict_relaxed_too_loose")))
    return out.select("strict", "relaxed", F.array_join(reasons, ",").alias("reasons"))


def anomaly_exposure(steps: DataFrame, flagged: DataFrame) -> DataFrame:
    """Mean size of a point's steps into flagged epochs, over its 5th to 95th percentile; 0 for points without one (TS8)."""
    hit = steps.join(F.broadcast(flagged.select("epoch_idx").distinct()), "epoch_idx", "left_semi")
    per = hit.groupBy("point_id").agg(F.avg(F.abs("delta")).alias("_raw"))
    return robust_range(steps.select("point_id").distinct().join(per, "point_id", "left"), "_raw", "exposure").select("point_id", "exposure")


def without_height(obs: DataFrame, points: DataFrame) -> DataFrame:
    """Values less each epoch's line over height (TS11)."""
    df = obs.join(points.select("point_id", "height_m"), "point_id")
    fit = df.groupBy("epoch_idx").agg(F.coalesce(F.regr_slope("value_mm", "height_m"), F.lit(0.0)).alias("_b"), F.avg("height_m").alias("_h"), F.avg("value_mm").alias("_v"))
    return df.join(F.broadcast(fit), "epoch_idx").select("point_id", "epoch_idx", (F.col("value_mm") - F.col("_v") - F.col("_b") * (F.col("height_m") - F.col("_h"))).alias("value_mm"))


def without_ramp(obs: DataFrame, points: DataFrame) -> DataFrame:
    """Values less each epoch's plane over row and column, by the moments of both; without one (too few points) less their mean (TS12)."""
    df = obs.join(points.select("point_id", "row", "col"), "point_id")
    cov = lambda a, b: F.covar_pop(a, b)
    m = df.groupBy("epoch_idx").agg(
        cov("row", "row").alias("rr"), cov("row", "col").alias("rc"), cov("col", "col").alias("cc"), cov("row", "value_mm").alias("rv"), cov("col", "value_mm").alias("cv"),
        F.avg("row").alias("r0"), F.avg("col").alias("c0"), F.avg("value_mm").alias("v0"),
    )
    det = F.col("rr") * F.col("cc") - F.col("rc") * F.col("rc")
    solve = lambda num: F.when(det > 1e-9, num / det).otherwise(0.0)
    m = m.select("epoch_idx", "r0", "c0", "v0", solve(F.col("rv") * F.col("cc") - F.col("cv") * F.col("rc")).alias("a"), solve(F.col("cv") * F.col("rr") - F.col("rv") * F.col("rc")).alias("b"))
    plane = F.col("v0") + F.col("a") * (F.col("row") - F.col("r0")) + F.col("b") * (F.col("col") - F.col("c0"))
    return df.join(F.broadcast(m), "epoch_idx").select("point_id", "epoch_idx", (F.col("value_mm") - plane).alias("value_mm"))


def zone_type(points: DataFrame, zone: str = "zone", rate: str = "velocity") -> DataFrame:
    """``mixed`` if over a quarter rises and over a quarter sinks, else by the median, which must pass 1 mm a year."""
    v = F.col(rate)
    share = lambda c: F.avg(c.cast("double"))
    kind = F.when((share(v > 0) > 0.25) & (share(v < 0) > 0.25), "mixed").when(F.median(v) < -1, "subsidence").when(F.median(v) > 1, "uplift").otherwise("mixed")
    return points.groupBy(zone).agg(kind.alias("zone_type"))
