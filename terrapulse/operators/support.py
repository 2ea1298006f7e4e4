"""The support graph of a zone search, in long form.

Traces stay one row a point and epoch: the correlation of two traces is ``corr`` over the epochs they share, so no series is
collected into one row.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrapulse.functions.scalars import clip, distance_m, sigmoid
from terrapulse.functions.stats import robust_z, with_quantiles, with_stats
from terrapulse.operators import series
from terrapulse.operators.components import connected_components
from terrapulse.operators.neighbours import nearest
from terrapulse.session import materialise

# Limits of the graph, of regions that are kept, and of regions that join others.
K, EDGE_CORR, RADIUS_TIMES, RADIUS_KM = 12, 0.58, 4.5, 0.10
ACTIVE_SALIENCY, CORE_SALIENCY, ACTIVE_COHERENCE, CORE_COHERENCE, QC_SUPPORT = 0.50, 0.62, 0.48, 0.55, 0.50
AREA_SHARE, POINT_SHARE, LEAST_POINTS, TRACE_CORR, COHERENCE, COMPACT, SCORE_RATIO = 8.0e-4, 0.003, 256, 0.60, 0.55, 0.20, 0.35
SALIENT_SHARE, SALIENT_POINTS, SALIENT_SCORE, SALIENT_COHERENCE, SALIENT_CONTRAST, SALIENT_ACTIVITY = 0.0015, 96, 0.75, 0.60, 0.25, 0.80
MERGE_CORR, MERGE_KM, MERGE_RATIO, MERGE_FLOOR = 0.95, 2.0, 0.20, 0.002


def coherence(shape: DataFrame) -> DataFrame:
    """``temporal_coherence`` of traces from their shape: half the agreement of steps, half net over path."""
    ratio = F.when(F.col("path") > 0, F.abs("net") / F.greatest("path", F.lit(1e-3))).otherwise(0.0)
    return shape.withColumn("temporal_coherence", clip(0.5 * ratio + 0.5 * F.col("sign_consistency"), 0.0, 1.0))


def main_sign(net: Column, trend: Column) -> Column:
    """Sign of the net displacement, or of the trend where that is under 1 mm."""
    return F.when(F.abs(net) < 1.0, F.signum(trend)).otherwise(F.signum(net)).cast("int")


def traces(obs: DataFrame) -> DataFrame:
    """``point_id, epoch_idx, v``: displacement since the point's first epoch."""
    return obs.select("point_id", "epoch_idx", (F.col("value_mm") - F.first("value_mm").over(series.by_point())).alias("v"))


def correlations(pairs: DataFrame, a: DataFrame, b: DataFrame) -> DataFrame:
    """``corr`` of the traces of each (src, dst) over common epochs; a constant trace gives 0.

    ``a`` and ``b`` have ``src`` or ``dst``, ``epoch_idx, v``.
    """
    met = pairs.select("src", "dst").join(a.withColumnRenamed("v", "_a"), "src").join(b.withColumnRenamed("v", "_b"), ["dst", "epoch_idx"])
    flat = (F.stddev_pop("_a") <= 1e-9) | (F.stddev_pop("_b") <= 1e-9)
    value = F.when(flat | F.isnan(F.corr("_a", "_b")), 0.0).otherwise(F.corr("_a", "_b"))
    return met.groupBy("src", "dst").agg(F.coalesce(value, F.lit(0.0)).alias("corr"))


def features(obs: DataFrame, points: DataFrame, edges: DataFrame) -> DataFrame:
    """What a point and its neighbours do (G1).

    ``edges`` are the nearest neighbours (src, rank, dst, dist_m).  Trace correlation is that of a point with the mean trace of
    its neighbours; contrasts are differences from the neighbours' mean; density is the median distance to the first neighbour
    over the mean of a point's first four.  A point without neighbours has 0 in all of these.
    """
    own = coherence(series.shape(obs)).join(series.trend(obs).select("point_id", F.col("slope").alias("trend")), "point_id")
    own = materialise(own.withColumn("sign", main_sign(F.col("net"), F.col("trend"))))
    t = traces(obs)
    around = edges.join(t.select(F.col("point_id").alias("dst"), "epoch_idx", "v"), "dst").groupBy("src", "epoch_idx").agg(F.avg("v").alias("_b"))
    met = around.join(t.select(F.col("point_id").alias("src"), "epoch_idx", F.col("v").alias("_a")), ["src", "epoch_idx"])
    corr = F.when((F.stddev_pop("_a") > 1e-9) & (F.stddev_pop("_b") > 1e-9), F.corr("_a", "_b")).otherwise(0.0)
    trace = met.groupBy(F.col("src").alias("point_id")).agg(corr.alias("trace_corr"))
    near = edges.join(own.select(F.col("point_id").alias("dst"), F.col("net").alias("_n"), F.col("peak").alias("_p")), "dst")
    near = near.groupBy(F.col("src").alias("point_id")).agg(
        F.avg("_n").alias("_n"), F.avg("_p").alias("_p"), (F.avg(F.when(F.col("rank") <= 4, F.col("dist_m"))) / 1000).alias("_four"), (F.min("dist_m") / 1000).alias("_one"),
    )
    df = own.join(near, "point_id", "left").join(trace, "point_id", "left")
    df = with_quantiles(materialise(df), _edge=(F.col("_one"), 0.5))
    density = F.greatest(F.col("_edge"), F.lit(1e-3)) / F.greatest(F.col("_four"), F.lit(1e-3))
    zero = lambda x: F.coalesce(x, F.lit(0.0))
    df = df.withColumns({
        "trace_corr": zero(F.col("trace_corr")), "contrast_net": zero(F.abs(F.col("net") - F.col("_n"))), "contrast_peak": zero(F.abs(F.col("peak") - F.col("_p"))),
        "density": zero(density), "median_edge_km": zero(F.col("_edge")),
    })
    df = df.drop("_n", "_p", "_four", "_one", "_edge").join(points.select("point_id", "lat", "lon", "ps_score", "tcoh", "valid_pair_ratio", "maincc_ratio"), "point_id")
    df = robust_z(df, "density", "_d")
    return materialise(df.withColumn("density", sigmoid(F.col("_d"))).drop("_d"))


def saliency(df: DataFrame) -> DataFrame:
    """``qc_support, activity, saliency`` from the features."""
    df = df.withColumns({"_net": F.abs("net"), "_trend": F.abs("trend")})
    df = robust_z(df, **{f"z{c}": c for c in ("peak", "_net", "_trend", "contrast_peak", "contrast_net")})
    qc = 0.35 * F.col("ps_score") + 0.25 * F.col("tcoh") + 0.20 * F.col("valid_pair_ratio") + 0.20 * F.col("maincc_ratio")
    active = 0.45 * F.col("zpeak") + 0.35 * F.col("z_net") + 0.20 * F.col("z_trend")
    contrast = 0.60 * F.col("zcontrast_peak") + 0.40 * F.col("zcontrast_net")
    df = df.withColumns({"qc_support": clip(qc, 0.0, 1.0), "_active": active, "_contrast": contrast})
    logit = 0.42 * F.col("_active") + 0.24 * F.col("_contrast") + 1.10 * (F.col("temporal_coherence") - 0.45) + 0.55 * (F.col("trace_corr") - 0.35)
    logit = logit + 0.35 * (F.col("density") - 0.45) + 0.25 * (F.col("qc_support") - 0.55)
    df = df.withColumns({"activity": sigmoid(F.col("_active")), "saliency": sigmoid(logit)})
    return materialise(df.drop("_net", "_trend", "_active", "_contrast", *[f"z{c}" for c in ("peak", "_net", "_trend", "contrast_peak", "contrast_net")]))


def flagged(df: DataFrame) -> DataFrame:
    """``active`` and ``core`` points, by percentiles with floors."""
    df = with_quantiles(df, _a=(F.col("saliency"), 0.80), _c=(F.col("saliency"), 0.92), _v=(F.col("activity"), 0.75))
    active = (F.col("sign") != 0) & (F.col("saliency") >= F.greatest(F.lit(ACTIVE_SALIENCY), F.col("_a"))) & (F.col("temporal_coherence") >= ACTIVE_COHERENCE) & (F.col("qc_support") >= QC_SUPPORT)
    core = (F.col("saliency") >= F.greatest(F.lit(CORE_SALIENCY), F.col("_c"))) & (F.col("activity") >= F.col("_v")) & (F.col("temporal_coherence") >= CORE_COHERENCE)
    return df.withColumn("active", active).withColumn("core", active & core).drop("_a", "_c", "_v")


def graph_edges(df: DataFrame, edges: DataFrame, obs: DataFrame, least: float = EDGE_CORR) -> DataFrame:
    """``src, dst, corr``: neighbours that are both active, of one sign, near enough and move alike."""
    side = lambda n: df.where("active").select(F.col("point_id").alias(n), F.col("sign").alias(f"{n}_s"), F.col("median_edge_km").alias(f"{n}_e"))
    met = edges.join(side("src"), "src").join(side("dst"), "dst").where("src_s = dst_s")
    met = met.where(F.col("dist_m") / 1000 <= F.greatest(RADIUS_TIMES * F.col("src_e"), F.lit(RADIUS_KM)))
    t = traces(obs)
    found = correlations(met, t.withColumnRenamed("point_id", "src"), t.withColumnRenamed("point_id", "dst"))
    return found.where(F.col("corr") >= least)


def regions(df: DataFrame, edges: DataFrame) -> DataFrame:
    """``point_id, zone``: connected active points that hold a core point."""
    alone = df.where("active").select(F.col("point_id").alias("src"), F.col("point_id").alias("dst"))
    found = connected_components(edges.select("src", "dst").union(alone))
    core = df.where("core").select(F.col("point_id").alias("id"))
    kept = found.join(core, "id", "left_semi").select("component").distinct()
    return found.join(kept, "component", "left_semi").select(F.col("id").alias("point_id"), F.col("component").alias("zone"))


def medoids(members: DataFrame, obs: DataFrame, centre: DataFrame) -> DataFrame:
    """``zone, medoid, internal_corr``: the member nearest to the centre trace, and the median correlation with it.

    ``members`` are ``zone, point_id``, ``centre`` is ``zone, epoch_idx, v``; ties go to the smaller id.
    """
    t = traces(obs)
    pairs = members.select(F.col("zone").alias("dst"), F.col("point_id").alias("src"))
    to_centre = correlations(pairs, t.withColumnRenamed("point_id", "src"), centre.withColumnRenamed("zone", "dst"))
    best = to_centre.groupBy(F.col("dst").alias("zone")).agg(F.max_by("src", F.struct(F.round("corr", 9), -F.col("src"))).alias("medoid"))
    best = materialise(best)
    with_medoid = members.join(best, "zone").select("zone", "medoid", F.col("point_id").alias("src"), F.col("medoid").alias("dst"))
    alike = correlations(with_medoid, t.withColumnRenamed("point_id", "src"), t.withColumnRenamed("point_id", "dst"))
    return with_medoid.join(alike, ["src", "dst"]).groupBy("zone", "medoid").agg(F.median("corr").alias("internal_corr"))


def contrasts(members: DataFrame, df: DataFrame, edges: DataFrame) -> DataFrame:
    """``zone, inside, outside, boundary_contrast``: how a region differs from the points next to it."""
    level = 0.60 * F.median(F.abs("net")) + 0.40 * F.median("peak")
    own = members.join(df.select("point_id", "net", "peak"), "point_id").groupBy("zone").agg(level.alias("inside"))
    near = edges.select(F.col("src").alias("point_id"), "dst").join(members, "point_id").select("zone", F.col("dst").alias("point_id")).distinct()
    near = near.join(members, ["zone", "point_id"], "left_anti").join(df.select("point_id", "net", "peak"), "point_id")
    out = own.join(near.groupBy("zone").agg(level.alias("outside")), "zone", "left").withColumn("outside", F.coalesce("outside", F.lit(0.0)))
    return out.withColumn("boundary_contrast", clip((F.col("inside") - F.col("outside")) / F.greatest(F.col("inside"), F.lit(1.0)), 0.0, 1.5))


def region_score(area_share: Column, internal: Column, temporal: Column, contrast: Column, activity: Column) -> Column:
    """How much a region stands out."""
    up = lambda x, lo: F.greatest(x, F.lit(lo))
    return F.sqrt(up(area_share, 1e-8)) * up(internal, 0.0) * up(temporal, 0.0) * up(contrast, 0.05) * F.log1p(up(activity, 0.0))


def summaries(members: DataFrame, df: DataFrame, edges: DataFrame, obs: DataFrame, centre: DataFrame) -> DataFrame:
    """One row a region with all figures that decide on it (A28, A29, G9).  ``df`` has ``area_km2`` and ``velocity`` beside the features."""
    met = members.join(df, "point_id")
    whole = df.agg(F.sum("area_km2").alias("_all"))
    v = F.col("velocity")
    out = met.groupBy("zone").agg(
        F.count(F.lit(1)).alias("points"), F.count_if("core").alias("core_points"), F.sum("area_km2").alias("area_km2"), F.median("temporal_coherence").alias("temporal_coherence"),
        F.median("peak").alias("activity"), F.avg("saliency").alias("probability"), F.avg("lon").alias("lon"), F.avg("lat").alias("lat"),
        F.median(v).alias("median_velocity"), F.percentile(v, F.lit(0.1)).alias("p10_velocity"), F.percentile(v, F.lit(0.9)).alias("p90_velocity"), F.max(F.abs(v)).alias("max_velocity"),
    )
    out = out.join(F.broadcast(whole)).withColumn("area_share", F.col("area_km2") / F.greatest("_all", F.lit(1e-6))).drop("_all")
    out = out.join(medoids(members, obs, centre), "zone").join(contrasts(members, df, edges), "zone")
    score = region_score(F.col("area_share"), F.col("internal_corr"), F.col("temporal_coherence"), F.col("boundary_contrast"), F.col("activity"))
    return out.withColumn("region_score", score)


def retained(zones: DataFrame, n_points: int) -> DataFrame:
    """Regions with ``mode`` (null: not kept) and ``reasons`` against them.

    Kept are regions that pass all six limits, salient ones that pass six others, and, if none does, the best one if it is
    large and coherent enough.  One row a region: a small table.
    """
    whole = Window.partitionBy()
    ceil = lambda s: -int(-s * max(n_points, 1) // 1)
    least, salient = max(LEAST_POINTS, ceil(POINT_SHARE)), max(SALIENT_POINTS, ceil(SALIENT_SHARE))
    df = with_stats(zones, _area=F.max("area_share"), _score=F.max("region_score"), _act=F.percentile("activity", F.lit(SALIENT_ACTIVITY)))
    limits = [
        (F.col("area_share") < F.greatest(F.lit(AREA_SHARE), 0.25 * F.col("_area")), "area_fraction_below_threshold"),
        (F.col("points") < least, "support_point_count_below_threshold"),
        (F.col("internal_corr") < TRACE_CORR, "internal_trace_corr_below_threshold"),
        (F.col("temporal_coherence") < COHERENCE, "temporal_coherence_below_threshold"),
        (F.col("compactness") < COMPACT, "compactness_below_threshold"),
        (F.col("region_score") < SCORE_RATIO * F.col("_score"), "region_score_below_threshold"),
    ]
    reasons = F.array_compact(F.array(*[F.when(bad, F.lit(name)) for bad, name in limits]))
    exception = (F.col("region_score") >= SALIENT_SCORE * F.col("_score")) & (F.col("points") >= salient) & (F.col("internal_corr") >= TRACE_CORR)
    exception = exception & (F.col("temporal_coherence") >= SALIENT_COHERENCE) & (F.col("boundary_contrast") >= SALIENT_CONTRAST) & (F.col("activity") >= F.col("_act"))
    df = df.withColumn("_why", reasons).withColumn("mode", F.when(exception, "salient_exception").when(F.size("_why") == 0, "regional_main"))
    df = df.withColumn("_any", F.max(F.col("mode").isNotNull()).over(whole)).withColumn("_k", F.row_number().over(Window.orderBy(F.desc("region_score"), "zone")))
    best = ~F.col("_any") & (F.col("_k") == 1) & (F.col("points") >= least) & (F.col("internal_corr") >= 0.55) & (F.col("temporal_coherence") >= 0.50)
    df = df.withColumn("mode", F.coalesce("mode", F.when(best, "fallback_best")))
    return df.withColumn("reasons", F.when(F.col("mode").isNull(), F.array_join("_why", ",")).otherwise("")).drop("_area", "_score", "_act", "_why", "_any", "_k")


def joining(kept: DataFrame, rejected: DataFrame, centres: DataFrame) -> DataFrame:
    """``zone, into``: rejected regions that belong to a kept one: same type, near, alike and not negligible (one round of G11).

    A region joins the kept one with the highest score.  The tables have a row a region; traces meet by pair and epoch.
    """
    cols = ["zone", "zone_type", "region_score", "lat", "lon"]
    a = kept.select(*[F.col(c).alias(f"k_{c}") for c in cols])
    b = rejected.select(*[F.col(c).alias(f"r_{c}") for c in cols])
    mid = (F.col("k_lat") + F.col("r_lat")) / 2
    km = distance_m(F.col("k_lat"), F.col("k_lon"), F.col("r_lat"), F.col("r_lon"), mid) / 1000
    met = b.join(a, F.col("k_zone_type") == F.col("r_zone_type")).where(km <= MERGE_KM)
    met = met.where(F.col("r_region_score") >= F.greatest(F.lit(MERGE_FLOOR), MERGE_RATIO * F.col("k_region_score")))
    pairs = met.select(F.col("r_zone").alias("src"), F.col("k_zone").alias("dst"), F.col("k_region_score").alias("score"))
    alike = correlations(pairs, centres.withColumnRenamed("zone", "src"), centres.withColumnRenamed("zone", "dst")).where(F.col("corr") >= MERGE_CORR)
    best = pairs.join(alike, ["src", "dst"]).groupBy("src").agg(F.max_by("dst", F.struct(F.round("score", 9), -F.col("dst"))).alias("into"))
    return best.withColumnRenamed("src", "zone")


def merged_members(members: DataFrame, joins: DataFrame) -> DataFrame:
    """Members under the region that theirs joined; a point in both counts once (U4)."""
    return members.join(joins, "zone", "left").select(F.coalesce("into", "zone").alias("zone"), "point_id").distinct()


def merged_to_end(kept: DataFrame, rejected: DataFrame, members: DataFrame, summarise: Callable[[DataFrame], tuple[DataFrame, DataFrame]], *, max_rounds: int = 50) -> tuple[DataFrame, DataFrame, int]:
    """Kept regions, all members, and the number of rounds, when no rejected region joins a kept one any more.

    ``summarise`` gives the records and the centre traces (``zone, epoch_idx, v``) of members (``zone, point_id``); a region that others have
    joined is judged anew by its new members. Within a round all candidates are judged by the regions as they stand.
    """
    kept, rejected, members = materialise(kept), materialise(rejected), materialise(members)
    for rounds in range(max_rounds):
        both = members.join(kept.select("zone").union(rejected.select("zone")), "zone", "left_semi")
        joins = materialise(joining(kept, rejected, summarise(both)[1]))
        if joins.isEmpty():
            return kept, members, rounds
        members = materialise(merged_members(members, joins))
        kept = materialise(summarise(members.join(kept.select("zone"), "zone", "left_semi"))[0])
        rejected = materialise(rejected.join(joins.select("zone"), "zone", "left_anti"))
    raise RuntimeError("the regions did not settle")


def exclusive(cells: DataFrame) -> DataFrame:
    """Cells ``zone_order, row, col`` that several zones claim go to the first."""
    return cells.groupBy("row", "col").agg(F.min("zone_order").alias("zone_order"))


def overlaps(cells: DataFrame) -> DataFrame:
    """``a, b, iou`` of all candidate masks (``mask, row, col``) that share a cell, a < b."""
    size = cells.groupBy("mask").agg(F.count(F.lit(1)).alias("n"))
    other = cells.select(F.col("mask").alias("b"), "row", "col")
    met = cells.withColumnRenamed("mask", "a").join(other, ["row", "col"]).where("a < b").groupBy("a", "b").agg(F.count(F.lit(1)).alias("both"))
    met = met.join(size.select(F.col("mask").alias("a"), F.col("n").alias("na")), "a").join(size.select(F.col("mask").alias("b"), F.col("n").alias("nb")), "b")
    return met.select("a", "b", (F.col("both") / (F.col("na") + F.col("nb") - F.col("both"))).alias("iou"))


def suppressed(scores: DataFrame, pairs: DataFrame, limit: float = 0.15, max_rounds: int = 100) -> DataFrame:
    """Masks that a walk by falling ``score`` keeps if they overlap no kept one by more than ``limit``.

    Rounds as for the sparse network: an open mask without a better open one in its way is kept, those it overlaps go.
    """
    place = scores.select("mask", F.struct((-F.col("score")).alias("s"), "mask").alias("place"))
    over = pairs.where(F.col("iou") > limit)
    both = over.select("a", "b").union(over.select("b", "a"))
    edges = both.join(place.select(F.col("mask").alias("a"), F.col("place").alias("pa")), "a").join(place.select(F.col("mask").alias("b"), F.col("place").alias("pb")), "b")
    edges = materialise(edges.where("pa < pb").select("a", "b"))
    open_, kept = scores.select("mask"), None
    for _ in range(max_rounds):
        now = materialise(open_.join(edges.select(F.col("b").alias("mask")).distinct(), "mask", "left_anti"))
        kept = now if kept is None else kept.union(now)
        gone = edges.join(now.withColumnRenamed("mask", "a"), "a", "left_semi").select(F.col("b").alias("mask")).distinct()
        open_ = materialise(open_.join(now, "mask", "left_anti").join(gone, "mask", "left_anti"))
        if open_.isEmpty():
            return kept
        alive = lambda c: open_.withColumnRenamed("mask", c)  # noqa: B023, E731
        edges = materialise(edges.join(alive("a"), "a", "left_semi").join(alive("b"), "b", "left_semi"))
    raise RuntimeError("the suppression did not settle")


def largest(zones: DataFrame, n: int = 6) -> DataFrame:
    """The zones to show, by area, size of the rate, continuity."""
    return zones.orderBy(F.desc("area_km2"), F.desc(F.abs("median_velocity")), F.desc("continuity"), "zone").limit(n)


def public(records: DataFrame) -> DataFrame:
    """Records without series and geometry: no arrays, maps or structs."""
    return records.select(*[f.name for f in records.schema if f.dataType.typeName() not in ("array", "map", "struct")])


def graph_statistics(edges: DataFrame, points: DataFrame, summaries: DataFrame, epochs: int) -> DataFrame:
    """``nodes, mean_degree, largest_share, null_share`` of a neighbour graph."""
    n = points.agg(F.count(F.lit(1)).alias("nodes"))
    degree = edges.agg(F.count(F.lit(1)).alias("_e"))
    sizes = connected_components(edges.select("src", "dst").union(points.select("point_id", "point_id"))).groupBy("component").agg(F.count(F.lit(1)).alias("n"))
    top = sizes.agg(F.max("n").alias("_top"))
    known = summaries.where("mean_mm IS NOT NULL").agg(F.count(F.lit(1)).alias("_known"))
    out = n.join(degree).join(top).join(known)
    return out.select("nodes", (F.col("_e") / F.col("nodes")).alias("mean_degree"), (F.col("_top") / F.col("nodes")).alias("largest_share"), (1 - F.col("_known") / (F.col("nodes") * epochs)).alias("null_share"))


def neighbourhood(points: DataFrame, k: int, cell: float) -> DataFrame:
    """The k-nearest-neighbour edges that the other functions take, written once."""
    return materialise(nearest(points, k, cell=cell))


