"""Choice and audit of reference points, evaluation of passes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrapulse.functions.scalars import METRES_LAT, METRES_LON, clip
from terrapulse.functions.stats import quantiles, robust_range, with_stats
from terrapulse.operators.neighbours import within_radius
from terrapulse.session import materialise

# Limits of a good reference point.
MIN_TCOH, MIN_VALID, MIN_MAINCC, MIN_EDGE, MIN_NEIGHBOURS = 0.70, 0.80, 0.80, 100.0, 3.0
GRADIENT_QUANTILE, NETWORK_METRES, PATCH_RADIUS, TOP = 0.90, 400.0, 2, 20
NEUTRAL_BASE, NEUTRAL_QUANTILE, IQR_QUANTILE, LAST_RANK = 5.0, 0.25, 0.70, 3
PATCH = ("ps_score", "tcoh", "maincc_ratio", "model_rms", "jump_risk", "valid_pair_ratio")


def constrained(points: DataFrame, *, min_edge: float = MIN_EDGE, min_neighbours: float = MIN_NEIGHBOURS) -> DataFrame:
    """Points at the strictest level that any point reaches, and that ``level``: 0 all limits, 1 those of place, 2 none.

    Needs ``edge, neighbours, gradient, safe`` beside the qualities.
    """
    df = with_stats(points, _g=F.percentile("gradient", F.lit(GRADIENT_QUANTILE)))
    place = (F.col("edge") >= min_edge) & (F.col("neighbours") >= min_neighbours) & F.col("safe")
    place = place & (F.col("_g").isNull() | (F.col("gradient") <= F.col("_g")))
    good = (F.col("tcoh") >= MIN_TCOH) & (F.col("valid_pair_ratio") >= MIN_VALID) & (F.col("maincc_ratio") >= MIN_MAINCC)
    df = df.withColumn("level", F.when(place & good, 0).when(place, 1).otherwise(2)).drop("_g")
    df = with_stats(df, _best=F.min("level"))
    return df.where("_best = 2 OR level <= _best").withColumn("level", F.col("_best")).drop("_best")


def scored(points: DataFrame) -> DataFrame:
    """``ref_score`` and ``network_quality`` of points."""
    unit = lambda c: clip(F.col(c), 0.0, 1.0)
    df = robust_range(points, _m="model_rms", _n="neighbours")
    score = 0.35 * unit("tcoh") + 0.25 * unit("maincc_ratio") + 0.20 * (1 - F.col("_m")) + 0.10 * unit("valid_pair_ratio") + 0.10 * F.col("_n")
    df = df.withColumn("ref_score", score).drop("_m", "_n")
    return df.withColumn("network_quality", 0.70 * F.col("ref_score") + 0.20 * unit("ps_score") + 0.10 * (1 - unit("jump_risk")))


def sparse_network(points: DataFrame, metres: float = NETWORK_METRES, max_rounds: int = 200) -> DataFrame:
    """Points that a walk by falling quality keeps if they are ``metres`` away from all kept before.

    Done in rounds, with the same result: an open point without an open neighbour of higher rank is kept, its neighbours
    go.  Distances use the latitude of the lower-ranked point; ties in quality go to the smaller row and column; points
    without coordinates are left out.
    """
    known = points.where("lat IS NOT NULL AND lon IS NOT NULL")
    if metres <= 0:
        return known.select("point_id")
    # a struct of (-quality, row, col, id) orders points like the walk does, without a global rank
    place = F.struct((-F.col("network_quality")).alias("q"), "row", "col", "point_id").alias("place")
    p = materialise(known.select("point_id", "lat", "lon", place))
    # within_radius uses one latitude for all: the wider net is cut by the exact distance below
    near = within_radius(p, metres * 1.05).select("src", "dst")
    side = lambda n: p.select(F.col("point_id").alias(n), *[F.col(c).alias(f"{n}_{c}") for c in ("lat", "lon", "place")])
    met = near.join(side("src"), "src").join(side("dst"), "dst").where("src_place < dst_place")
    dx = (F.col("src_lon") - F.col("dst_lon")) * METRES_LON * F.cos(F.radians("dst_lat"))
    dy = (F.col("src_lat") - F.col("dst_lat")) * METRES_LAT
    edges = materialise(met.where(F.sqrt(dx * dx + dy * dy) < metres).select("src", "dst"))
    open_, kept = p.select("point_id"), []
    for _ in range(max_rounds):
        blocked = edges.select(F.col("dst").alias("point_id")).distinct()
        now = materialise(open_.join(blocked, "point_id", "left_anti"))
        kept.append(now)
        gone = edges.join(now.withColumnRenamed("point_id", "src"), "src", "left_semi").select(F.col("dst").alias("point_id")).distinct()
        open_ = materialise(open_.join(now, "point_id", "left_anti").join(gone, "point_id", "left_anti"))
        if open_.isEmpty():
            break
        alive = lambda c: open_.withColumnRenamed("point_id", c)  # noqa: B023, E731
        edges = materialise(edges.join(alive("src"), "src", "left_semi").join(alive("dst"), "dst", "left_semi"))
    else:
        raise RuntimeError("the network did not settle")
    out = kept[0]
    for k in kept[1:]:
        out = out.union(k)
    return out


def ranked(network: DataFrame) -> DataFrame:
    """``network_rank`` by falling quality, ties to the smaller row and column (W11).  Networks are sparse, so one task ranks them."""
    return network.withColumn("network_rank", F.row_number().over(Window.orderBy(F.desc(F.round("network_quality", 9)), "row", "col")))


def patches(candidates: DataFrame, pixels: DataFrame, radius: int = PATCH_RADIUS) -> DataFrame:
    """Of each candidate ``point_id, row, col`` what lies within ``radius`` cells.

    ``patch_count`` and medians of the qualities over strict cells, and median, median size and quartile range of their
    velocity; where no strict cell has one, all cells count for the velocity.  A patch without cells has nulls and count 0.
    """
    off = F.sequence(F.lit(-radius), F.lit(radius))
    around = candidates.select("point_id", F.col("row").alias("_r"), F.col("col").alias("_c")).withColumn("dy", F.explode(off)).withColumn("dx", F.explode(off))
    around = around.select("point_id", (F.col("_r") + F.col("dy")).alias("row"), (F.col("_c") + F.col("dx")).alias("col"))
    cells = pixels.select("row", "col", "strict", "velocity", *PATCH)
    strict = F.col("strict")
    own = lambda c: F.when(strict, F.col(c))
    fast, any_ = own("velocity"), F.col("velocity")

    def figures(v: Column, p: str) -> list[Column]:
        return [F.median(v).alias(f"{p}_v"), F.median(F.abs(v)).alias(f"{p}_a"), (F.percentile(v, F.lit(0.75)) - F.percentile(v, F.lit(0.25))).alias(f"{p}_i")]

    out = around.join(cells, ["row", "col"]).groupBy("point_id").agg(
        F.count_if(strict).alias("patch_count"), *[F.median(own(c)).alias(f"patch_{c}") for c in PATCH], *figures(fast, "_s"), *figures(any_, "_x"),
    )
    named = {"patch_velocity": "v", "patch_abs_velocity": "a", "patch_velocity_iqr": "i"}
    out = out.select("point_id", "patch_count", *[f"patch_{c}" for c in PATCH], *[F.coalesce(f"_s_{k}", f"_x_{k}").alias(n) for n, k in named.items()])
    return candidates.select("point_id").distinct().join(out, "point_id", "left").withColumn("patch_count", F.coalesce("patch_count", F.lit(0).cast("long")))


def thresholds(patched: DataFrame) -> tuple[dict[str, Column], list[str]]:
    """Neutrality and spread limits over all candidates, as one-row statistics."""
    stats = {"_q": F.percentile("patch_abs_velocity", F.lit(NEUTRAL_QUANTILE)), "_iqr": F.percentile("patch_velocity_iqr", F.lit(IQR_QUANTILE))}
    return stats, list(stats)


def neutral(candidates: DataFrame) -> DataFrame:
    """Network points with neighbours and little motion of their own.

    If no point is neutral those with neighbours stay, if none has neighbours (or there are three or fewer points) all do.
    """
    stats, names = thresholds(candidates)
    df = with_stats(candidates, **stats, _n=F.count(F.lit(1)), _any=F.max("network_neighbours"))
    joined = (F.col("_n") <= 3) | (F.col("_any") <= 0) | (F.col("network_neighbours") > 0)
    limit = F.greatest(F.lit(NEUTRAL_BASE), F.coalesce("_q", F.lit(NEUTRAL_BASE)))
    calm = F.coalesce((F.col("patch_abs_velocity") <= limit) & (F.col("patch_velocity_iqr") <= F.coalesce("_iqr", F.lit(float("inf")))), F.lit(False))
    df = df.where(joined).withColumn("neutral", calm)
    df = with_stats(df, _calm=F.max("neutral"))
    return df.where(F.col("neutral") | ~F.col("_calm")).drop("_n", "_any", "_calm", *names)


def ordered(candidates: DataFrame, n: int = TOP) -> DataFrame:
    """The first ``n`` candidates in the order of nine criteria, missing values last, with ``rank``."""
    up = lambda c: F.round(c, 9).asc_nulls_last()
    down = lambda c: F.round(c, 9).desc_nulls_last()
    keys = [up("patch_abs_velocity"), up("patch_velocity_iqr"), down("patch_ps_score"), down("edge"), down("network_neighbours"), down("neighbours"), up("gradient"), up("patch_model_rms"), up("patch_jump_risk")]
    best = candidates.orderBy(*keys, "row", "col").limit(n)
    return best.withColumn("rank", F.row_number().over(Window.orderBy(*keys, "row", "col")))


def locked(candidates: DataFrame, rank: int | None) -> DataFrame:
    """The candidate of that rank, or else the first."""
    first = F.lit(0) if rank is None else (F.col("rank") != rank).cast("int")
    return candidates.orderBy(first, "rank").limit(1)


def bias_audit(candidates: DataFrame, scene: DataFrame, rank: int | None, top: int = TOP) -> DataFrame:
    """Whether the chosen candidate moves more than a reference should, and which one to take instead.

    ``candidates`` have ``rank`` and patch velocities, ``scene`` the ``velocity`` of strict points.  One row.
    """
    pool = candidates.where(F.col("rank") <= top)
    stats, names = thresholds(pool)
    df = with_stats(pool, **stats).withColumn("threshold", F.greatest(F.lit(NEUTRAL_BASE), F.coalesce("_q", F.lit(NEUTRAL_BASE))))
    calm = (F.col("patch_abs_velocity") <= F.col("threshold")) & (F.col("patch_velocity_iqr") <= F.coalesce("_iqr", F.lit(float("inf"))))
    df = df.withColumn("neutral", F.coalesce(calm, F.lit(False)))
    place = F.struct(F.coalesce("patch_abs_velocity", F.lit(float("inf"))), F.coalesce("patch_velocity_iqr", F.lit(float("inf"))), "rank")
    wanted = F.lit(0) if rank is None else (F.col("rank") != rank).cast("int")
    out = df.agg(
        F.max("threshold").alias("threshold"), F.max("_iqr").alias("iqr_threshold"),
        F.min_by(F.struct("rank", "patch_velocity", "patch_abs_velocity", "patch_velocity_iqr"), F.struct(wanted, "rank")).alias("s"),
        F.coalesce(F.min_by("rank", F.when(F.col("neutral"), place)), F.min_by("rank", place)).alias("best"),
    )
    out = out.withColumn("biased", F.coalesce(F.col("s.patch_abs_velocity") > F.col("threshold"), F.lit(False)))
    seen = scene.agg(F.median("velocity").alias("scene_velocity"))
    return out.join(seen).select(
        F.col("s.rank").alias("selected_rank"), F.col("s.patch_velocity").alias("patch_velocity"), F.col("s.patch_abs_velocity").alias("patch_abs_velocity"),
        "threshold", "iqr_threshold", "scene_velocity", "biased", F.when(F.col("biased"), F.col("best")).alias("recommended_rank"),
    )


def evaluation(obs: DataFrame, fitted: DataFrame, models: DataFrame, rates: DataFrame, jump: float, *, patch: DataFrame | None = None, rank: int | None = None) -> DataFrame:
    """How well a pass went: share of jumps from epoch to epoch, median RMS, complete series, scene rate, and its reference.

    ``fitted`` has ``point_id, epoch_idx, fit``, ``models`` ``point_id, model_rms``, ``rates`` ``point_id, velocity``; ``patch``
    names the points of the reference's patch.  The reference is abnormal if its residuals are over 1.5 times the scene's
    median (1 mm at least) or its jumps over 1.5 times the scene's (0.15 at least); then the next rank is suggested, up to 3.
    """
    w = Window.partitionBy("point_id").orderBy("epoch_idx")
    df = obs.join(fitted, ["point_id", "epoch_idx"]).withColumn("res", F.col("value_mm") - F.col("fit"))
    df = df.withColumn("jump", F.abs(F.col("res") - F.lag("res").over(w)) > jump)
    mine = F.lit(False)
    if patch is not None:
        df = df.join(F.broadcast(patch.select("point_id", F.lit(True).alias("_own"))), "point_id", "left")
        mine = F.coalesce("_own", F.lit(False))
    share = lambda c: F.avg(c.cast("double"))
    out = df.agg(
        share(F.col("jump")).alias("jump_ratio"), F.count_distinct("epoch_idx").alias("_epochs"),
        F.avg(F.when(mine, F.abs("res"))).alias("patch_residual"), share(F.when(mine, F.col("jump"))).alias("patch_jumps"),
    )
    out = out.join(F.broadcast(quantiles(df, _median=(F.abs("res"), 0.5))))
    n = obs.where("value_mm IS NOT NULL").groupBy("point_id").agg(F.count_distinct("epoch_idx").alias("_n"))
    whole = n.join(F.broadcast(out.select("_epochs"))).agg(F.count_if(F.col("_n") == F.col("_epochs")).alias("retained"))
    out = out.join(whole).join(models.agg(F.median("model_rms").alias("median_rms"))).join(rates.agg(F.median("velocity").alias("scene_velocity")))
    odd = (F.col("patch_residual") > F.greatest(F.col("_median") * 1.5, F.lit(1.0))) | (F.col("patch_jumps") > F.greatest(F.col("jump_ratio") * 1.5, F.lit(0.15)))
    out = out.withColumn("abnormal", F.coalesce(odd, F.lit(False)))
    next_rank = F.when(F.col("abnormal") & (F.lit(rank) < LAST_RANK), F.lit(rank) + 1) if rank is not None else F.lit(None)
    return out.withColumn("next_rank", next_rank.cast("int")).drop("_median", "_epochs")


def accepted(first: DataFrame, second: DataFrame) -> DataFrame:
    """Whether the second pass is taken, and why not (A21).  One-row tables ``jump_ratio, median_rms, retained, scene_velocity, patch_abs_velocity``."""
    names = ("jump_ratio", "median_rms", "retained", "scene_velocity", "patch_abs_velocity")
    a = first.select(*[F.col(c).alias(f"a_{c}") for c in names])
    b = second.select(*[F.col(c).alias(f"b_{c}") for c in names])
    worst = F.lit(float("inf"))
    x = lambda p, c: F.coalesce(F.abs(F.col(f"{p}_{c}").cast("double")), F.lit(0.0) if c == "retained" else worst)
    checks = [
        (x("b", "jump_ratio") <= x("a", "jump_ratio"), "adjacent_jump_ratio_not_improved"),
        (x("b", "median_rms") <= 1.05 * x("a", "median_rms"), "median_model_rms_degraded"),
        (x("b", "retained") >= 0.85 * x("a", "retained"), "retained_count_collapsed"),
        (x("b", "scene_velocity") <= x("a", "scene_velocity"), "strict_ps_scene_median_velocity_not_improved"),
        (x("b", "patch_abs_velocity") <= x("a", "patch_abs_velocity"), "reference_bias_not_improved"),
    ]
    reasons = F.array_compact(F.array(*[F.when(~ok, F.lit(name)) for ok, name in checks]))
    return a.join(b).select(F.when(F.size(reasons) == 0, "pass2").otherwise("pass1").alias("accepted_pass"), F.array_join(reasons, ",").alias("reasons"))


def kept_reference(state: DataFrame) -> DataFrame:
    """The reference ``ref_row, ref_col`` goes if the pair network changed, unless it is locked."""
    stale = F.coalesce("network_changed", F.lit(False)) & ~F.coalesce("locked", F.lit(False))
    return state.withColumns({c: F.when(~stale, F.col(c)) for c in ("ref_row", "ref_col")})


def inversion_metrics(pair_qc: DataFrame, rates: DataFrame, obs: DataFrame, *keys: str, jump: float = 28.0) -> DataFrame:
    """Mean coherence and component share of pairs, median deviation of rates, and the mean over epochs of the share of jumps (A24, by ``keys`` A25)."""
    w = Window.partitionBy(*keys, "point_id").orderBy("epoch_idx")
    steps = obs.withColumn("d", F.abs(F.col("value_mm") - F.lag("value_mm").over(w)))
    per = steps.groupBy(*keys, "epoch_idx").agg(F.avg((F.col("d") > jump).cast("double")).alias("share"), F.min("epoch_idx").alias("_e"))
    shares = per.where("share IS NOT NULL").groupBy(*keys).agg(F.avg("share").alias("jump_share"))
    pairs = pair_qc.groupBy(*keys).agg(F.avg("coh_mean").alias("coherence"), F.avg("valid_conncomp_frac").alias("component_share"))
    spread = rates.groupBy(*keys).agg(F.median("deviation").alias("deviation"))
    on = list(keys)
    return pairs.join(spread, on).join(shares, on) if on else pairs.join(spread).join(shares)
