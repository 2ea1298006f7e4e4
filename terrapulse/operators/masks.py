"""Masks of moving ground: region growing, principal components of a mask, outward growth of zones.

Masks of several signs, thresholds or zones are layers of one table, so that each step of morphology is one job for all
of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrapulse.functions.stats import quantiles, with_stats
from terrapulse.operators import series, support, zones
from terrapulse.operators.rasters import CELL, box_means, closing, fill_holes, labels, lattice, neighbour_count, opening, propagate
from terrapulse.session import materialise

# Limits of region growing.
GROW = {"core": 9.0, "grow_share": 0.62, "grow": 6.0, "anomaly": 0.55, "same_sign": 5, "core_probability": 0.52, "density": 0.08, "tcoh": 0.48, "ps": 0.32, "dense": 0.18, "probability": 0.32, "anomaly_share": 0.75}
# Shares of the base threshold with their floors, and limits of principal components.
LEVELS = ((0.60, 7.0), (0.75, 9.0), (0.90, 11.0))
PRINCIPAL = {"base": 10.0, "density": 0.05, "tcoh": 0.45, "probability": 0.18, "pixels": 120, "area_share": 0.80, "net": 6.0, "continuity": 0.40, "overlap": 0.15, "most": 1, "series": 32}
# Limits of growth, and how near strong cells are taken in, in km.
GROWTH = {"corr": 0.90, "peak": 10.0, "net": 10.0, "velocity": 8.0, "coherence": 0.45}
ABSORB_KM, SMALL_ABSORB_KM = 1.5, 6.0
#: Zones that are sent to the cells at a time; a zone is a row of a few numbers and its trace.
ZONES_AT_ONCE = 256


def _whole(grid: DataFrame) -> DataFrame:
    """All cells of the raster."""
    return lattice(grid, grid.columns[-1]).select(*CELL)


def region_grow(found: DataFrame, probability: DataFrame, *, limits: dict[str, float] | None = None) -> DataFrame:
    """``sign, row, col`` of the cells that a core of fast, supported cells grows over (M9).

    ``found`` are the features of the valid cells (``seeds.features``), ``probability`` that of their motion.  Both signs are
    layers of one propagation, closing, opening and filling; cells outside ``found`` are left out at the end.
    """
    lim = GROW | (limits or {})
    df = found.join(probability, CELL, "left").withColumns({"support": F.greatest("strict", "relaxed"), "probability": F.coalesce("probability", F.lit(0.0))})
    df = materialise(df.select(*CELL, "velocity", "tcoh", "ps_score", "support", "probability"))
    around = box_means(df, density=("support", 9), core=("velocity", 15), region=("velocity", 21), background=("velocity", 41), tcoh_region=("tcoh", 9), ps_region=("ps_score", 9))
    df = materialise(df.join(around, CELL).withColumn("anomaly", F.abs(F.col("region") - F.col("background"))))
    held = quantiles(df.where("support > 0.5"), _core=(F.abs("core"), 0.90), _odd=(F.col("anomaly"), 0.78))
    held = held.select(F.greatest("_core", F.lit(lim["core"])).alias("_core"), F.greatest("_odd", F.lit(lim["anomaly"])).alias("_odd"))
    df = df.join(F.broadcast(held)).withColumn("_grow", F.greatest(F.col("_core") * lim["grow_share"], F.lit(lim["grow"])))
    layers = []
    for sign in (1, -1):
        moving = F.col("region") * sign >= F.col("_grow")
        alike = neighbour_count(df, (F.col("support") > 0.5) & moving, 3).withColumnRenamed("neighbours", "_n")
        own = df.join(alike, CELL).withColumn("_same", F.col("_n") + ((F.col("support") > 0.5) & moving).cast("long"))
        likely = lambda p, share: (F.col("probability") >= p) | (F.col("anomaly") >= F.col("_odd") * share)
        core = (F.col("core") * sign >= F.col("_core")) & (F.col("support") > 0.5) & (F.col("_same") >= lim["same_sign"]) & likely(lim["core_probability"], 1.0)
        allowed = moving & (F.col("density") >= lim["density"]) & (F.col("tcoh_region") >= lim["tcoh"]) & ((F.col("ps_region") >= lim["ps"]) | (F.col("density") >= lim["dense"])) & likely(lim["probability"], lim["anomaly_share"])
        layers.append(own.select(F.lit(sign).alias("sign"), *CELL, core.alias("core"), allowed.alias("allowed")))
    both = materialise(layers[0].union(layers[1]))
    # without an allowed cell of a sign there is nothing of it
    signs = both.where("allowed").select("sign").distinct()
    cores = both.where("core").select("sign", *CELL).join(signs, "sign", "left_semi")
    every, by = materialise(_whole(df.select(*CELL, "velocity"))), ("sign",)
    grown = propagate(cores, both.where("allowed").select("sign", *CELL), by)
    grown = fill_holes(opening(materialise(closing(grown, every, 2, by)), every, 1, by), by=by)
    return grown.join(df.select(*CELL), CELL, "left_semi").select("sign", *CELL)


def layered(df: DataFrame, masks: list[Column]) -> DataFrame:
    """Cells with ``bits``: bit k is set where mask k holds."""
    bits = F.lit(0)
    for k, m in enumerate(masks):
        bits = bits + F.when(m, F.lit(1 << k)).otherwise(0)
    return df.select(*CELL, bits.cast("int").alias("bits"))


def settled(cells: DataFrame) -> DataFrame:
    """All masks of ``bits`` closed twice and opened once, by windows over rows and columns of the whole raster.

    Two dilations are one over five cells, two erosions and the next one over seven; what lies outside the raster belongs to
    no mask.  Steps along the same axis share a sort, so the six windows take four shuffles, whatever the number of masks.
    """
    df = lattice(cells, "bits").select(*CELL, F.coalesce("bits", F.lit(0)).alias("bits"))

    def step(d: DataFrame, along: str, half: int, shrink: bool) -> DataFrame:
        frame = Window.partitionBy("col" if along == "row" else "row").orderBy(along).rangeBetween(-half, half)
        inner = F.when(F.count(F.lit(1)).over(frame) == 2 * half + 1, F.bit_and("bits").over(frame)).otherwise(0)
        return d.withColumn("bits", inner if shrink else F.bit_or("bits").over(frame))

    for along, half, shrink in (("col", 2, False), ("row", 2, False), ("row", 3, True), ("col", 3, True), ("col", 1, False), ("row", 1, False)):
        df = step(df, along, half, shrink)
    return df.where("bits <> 0")


def motion(centre: DataFrame, key: str = "zone", quiet: float = 0.25) -> DataFrame:
    """``net_mm, continuity`` of each zone's centre trace (``epoch_idx, v``): half net over path, half agreement of its steps with the net."""
    w = Window.partitionBy(key).orderBy("epoch_idx")
    df = centre.withColumn("_d", F.col("v") - F.lag("v").over(w))
    ends = centre.groupBy(key).agg((F.max_by("v", "epoch_idx") - F.min_by("v", "epoch_idx")).alias("net_mm"))
    loud = F.when(F.abs("_d") > quiet, F.col("_d"))
    still = F.abs("net_mm") <= 1e-8
    df = df.join(ends, key).groupBy(key).agg(
        F.first("net_mm").alias("net_mm"), F.sum(F.abs(loud)).alias("_path"), F.avg(F.when(loud.isNotNull(), (F.signum(loud) == F.signum("net_mm")).cast("double"))).alias("_same"),
    )
    path = F.coalesce("_path", F.abs("net_mm"))
    same = F.when(still, 0.0).otherwise(F.coalesce("_same", F.lit(1.0)))
    return df.select(key, "net_mm", (0.5 * F.abs("net_mm") / F.greatest(path, F.lit(1e-3)) + 0.5 * same).alias("continuity"))


def centres(members: DataFrame, obs: DataFrame, *, least: int = 32) -> DataFrame:
    """``zone, epoch_idx, v``: trimmed mean trace of each zone with at least ``least`` cells that have one, gaps bridged.

    ``members`` are ``zone, row, col, support``, ``obs`` are ``row, col, point_id, epoch_idx, value_mm``.  The supported cells speak for a
    zone that has enough of them.
    """
    n = members.groupBy("zone").agg(F.count_if("support").alias("_s"), F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= least)
    own = members.join(n, "zone").where(F.col("support") | (F.col("_s") < least)).select("zone", *CELL)
    found = zones.profile(own.join(obs, CELL), least)
    epochs = obs.agg(F.count_distinct("epoch_idx").alias("_e"))
    enough = found.groupBy("zone").agg(F.count("trimmed_mean").alias("_k")).join(F.broadcast(epochs)).where(F.col("_k") >= F.greatest(F.lit(6), F.least(F.lit(8), F.col("_e"))))
    kept = found.join(enough.select("zone"), "zone", "left_semi").select(F.col("zone").alias("point_id"), "epoch_idx", F.col("trimmed_mean").alias("value_mm"))
    return series.fill_gaps(kept).select(F.col("point_id").alias("zone"), "epoch_idx", F.col("value_mm").alias("v"))


def principal_candidates(found: DataFrame, probability: DataFrame, *, value: str = "velocity", limits: dict[str, float] | None = None) -> DataFrame:
    """``layer, label, row, col, support, velocity, anomaly, probability``: parts of the masks of two signs and three thresholds (M8).

    ``value`` is the raster that is smoothed and cut: the velocity, or any other column, such as a component of the series (G15).
    """
    lim = PRINCIPAL | (limits or {})
    df = found.join(probability, CELL, "left").withColumns({"support": F.greatest("strict", "relaxed"), "probability": F.coalesce("probability", F.lit(0.0)), "_value": F.col(value)})
    df = materialise(df.select(*CELL, "_value", "velocity", "anomaly", "tcoh", "support", "probability"))
    around = materialise(df.join(box_means(df, core=("_value", 15), density=("support", 9), tcoh_region=("tcoh", 9), p_region=("probability", 9)), CELL))
    base = quantiles(around.where("support > 0.5"), _base=(F.abs("core"), 0.90)).where("_base IS NOT NULL").select(F.greatest("_base", F.lit(lim["base"])).alias("_base"))
    at = around.join(F.broadcast(base))
    steady = (F.col("density") >= lim["density"]) & (F.col("tcoh_region") >= lim["tcoh"]) & (F.col("p_region") >= lim["probability"])
    masks = [steady & (F.col("core") * s >= F.greatest(F.col("_base") * share, F.lit(floor))) for s in (1, -1) for share, floor in LEVELS]
    done = materialise(settled(layered(at, masks)))
    cells = done.select(F.explode(F.sequence(F.lit(0), F.lit(len(masks) - 1))).alias("layer"), *CELL, "bits").where(F.expr("getbit(bits, layer) = 1")).select("layer", *CELL)
    filled = fill_holes(cells, by=("layer",)).join(df.select(*CELL), CELL, "left_semi").select("layer", *CELL)
    parts = labels(filled, by=("layer",))
    return materialise(parts.join(df.select(*CELL, (F.col("support") > 0.5).alias("support"), "velocity", "anomaly", "probability", "_value"), CELL))


def principal_mask(candidates: DataFrame, obs: DataFrame, area: DataFrame, least_area_km2: float, *, limits: dict[str, float] | None = None) -> tuple[DataFrame, DataFrame]:
    """The best parts that overlap no better one, as ``row, col`` and one row each with their figures (M8).

    ``area`` is ``row, col, area_km2``; a part needs enough cells, area, net motion and continuity.  Equal thresholds give equal parts,
    of which the overlap rule keeps one.
    """
    lim = PRINCIPAL | (limits or {})
    name = F.concat_ws(":", "layer", "label")
    cells = candidates.join(area, CELL).withColumn("zone", name)
    figures = cells.groupBy("zone", "layer").agg(
        F.count(F.lit(1)).alias("pixel_count"), F.sum("area_km2").alias("area_km2"), F.median("velocity").alias("median_velocity"),
        F.median("anomaly").alias("median_anomaly"), F.avg("probability").alias("mean_probability"),
    )
    figures = figures.where((F.col("pixel_count") >= lim["pixels"]) & (F.col("area_km2") >= least_area_km2 * lim["area_share"]))
    members = materialise(cells.join(figures.select("zone"), "zone", "left_semi").select("zone", *CELL, "support"))
    moved = motion(centres(members, obs, least=int(lim["series"])))
    rated = figures.join(moved, "zone").where((F.abs("net_mm") >= lim["net"]) & (F.col("continuity") >= lim["continuity"]))
    up = lambda c, lo: F.greatest(c, F.lit(lo))
    score = F.col("area_km2") * up(F.abs("median_velocity"), 1.0) * up(F.abs("net_mm"), 1.0) * up(F.col("continuity"), 0.05) * up(F.col("mean_probability"), 0.10)
    rated = materialise(rated.withColumn("score", score))
    if rated.isEmpty():
        return members.select(*CELL).limit(0), rated
    masks = members.join(rated.select("zone"), "zone", "left_semi").select(F.col("zone").alias("mask"), *CELL)
    kept = support.suppressed(rated.select(F.col("zone").alias("mask"), "score"), support.overlaps(masks), lim["overlap"])
    # a row a part: the walk keeps the best ones
    best = materialise(rated.join(kept.select(F.col("mask").alias("zone")), "zone", "left_semi").orderBy(F.desc("score"), "zone").limit(int(lim["most"])))
    return masks.join(best.select(F.col("zone").alias("mask")), "mask", "left_semi").select(*CELL).distinct(), best


def growth_cells(grid: DataFrame, obs: DataFrame) -> DataFrame:
    """Cells that have a whole series, with ``net, peak, temporal_coherence`` and their series as an array.

    ``grid`` has ``row, col, point_id, lat, lon, velocity``; ``obs`` are the points' values.
    """
    epochs = obs.agg(F.count_distinct("epoch_idx").alias("_e"))
    known = obs.where(F.col("value_mm").isNotNull() & ~F.isnan("value_mm"))
    whole = known.groupBy("point_id").agg(F.count(F.lit(1)).alias("_n"), F.transform(F.sort_array(F.collect_list(F.struct("epoch_idx", "value_mm"))), lambda x: x["value_mm"]).alias("_v"))
    whole = whole.join(F.broadcast(epochs)).where("_n = _e").select("point_id", F.transform("_v", lambda x: x - F.get("_v", 0)).alias("trace"))
    shape = support.coherence(series.shape(known)).select("point_id", "net", "peak", "temporal_coherence")
    df = with_stats(grid, _lat=F.avg("lat"))
    km = {"x_km": F.col("lon") * 111.320 * F.cos(F.radians("_lat")), "y_km": F.col("lat") * 110.540}
    return materialise(df.withColumns(km).drop("_lat").join(whole, "point_id").join(shape, "point_id"))


def _correlation(a: Column, b: Column) -> Column:
    """Of two arrays of the same length, 0 if one is constant."""
    mean = lambda x: F.aggregate(x, F.lit(0.0), lambda s, v: s + v) / F.size(x)
    dot = lambda x, y, mx, my: F.aggregate(F.zip_with(x, y, lambda u, v: (u - mx) * (v - my)), F.lit(0.0), lambda s, v: s + v)
    ma, mb = mean(a), mean(b)
    size = F.sqrt(dot(a, a, ma, ma)) * F.sqrt(dot(b, b, mb, mb))
    return F.when(size > 1e-12, dot(a, b, ma, mb) / size).otherwise(0.0)


def _rules(records: DataFrame) -> DataFrame:
    """What a zone asks of cells, from its own figures."""
    lim = GROWTH
    top = lambda floor, c: F.greatest(F.lit(floor), c)
    df = records.withColumns({
        "corr_min": top(lim["corr"], F.col("internal_corr") - 0.08), "coh_min": top(lim["coherence"], F.col("temporal_coherence") - 0.08),
        "peak_min": top(lim["peak"], 0.35 * F.greatest("activity", F.lit(0.0))), "net_min": top(lim["net"], 0.40 * F.abs("net_mm")),
        "vel_min": top(lim["velocity"], 0.50 * F.greatest("median_abs_velocity", F.lit(0.0))),
    })
    small = (F.col("zone_type") == "subsidence") & (F.col("area_km2") < 1.0)
    return df.withColumns({"radius_km": F.when(small, SMALL_ABSORB_KM).otherwise(ABSORB_KM), "strong_min": F.when(small, top(0.97, F.col("corr_min") + 0.05)).otherwise(top(0.95, F.col("corr_min") + 0.03))})


def admitted(cells: DataFrame, records: DataFrame) -> DataFrame:
    """``zone, row, col, x_km, y_km, radius_km, active, bridge, strong``: the cells that each zone may grow over or take in.

    Zones meet all cells in blocks of ``ZONES_AT_ONCE``; the trace is compared only where sign and size already pass the
    weakest of the rules.
    """
    rules = _rules(records).select("zone", "zone_type", "trace", "corr_min", "coh_min", "peak_min", "net_min", "vel_min", "radius_km", "strong_min")
    rules = materialise(rules.withColumnRenamed("trace", "_centre"))
    blocks, out = max(1, -(-rules.count() // ZONES_AT_ONCE)), None
    net, v = F.col("net"), F.col("velocity")

    def signed(share_net: float, share_v: float) -> Column:
        n, lo = share_net * F.col("net_min"), share_v * F.col("vel_min")
        return F.when(F.col("zone_type") == "subsidence", (net <= -n) | (v <= -lo)).when(F.col("zone_type") == "uplift", (net >= n) | (v >= lo)).otherwise(F.abs(net) >= n)

    for b in range(blocks):
        some = rules if blocks == 1 else rules.where(F.pmod(F.xxhash64("zone"), F.lit(blocks)) == b)
        met = cells.drop("point_id").join(F.broadcast(some), signed(0.75, 0.80) & (F.col("peak") >= 0.70 * F.col("peak_min")))
        met = met.withColumn("_corr", _correlation(F.col("trace"), F.col("_centre")))
        corr, coh, peak = F.col("_corr"), F.col("temporal_coherence"), F.col("peak")
        active = signed(1.0, 1.0) & (peak >= F.col("peak_min")) & (corr >= F.col("corr_min")) & (coh >= F.col("coh_min"))
        bridge = (corr >= F.greatest(F.lit(0.86), F.col("corr_min") - 0.05)) & (coh >= F.greatest(F.lit(0.40), F.col("coh_min") - 0.05))
        strong = signed(1.0, 1.0) & (peak >= 0.80 * F.col("peak_min")) & (corr >= F.col("strong_min")) & (coh >= F.col("coh_min"))
        met = met.select("zone", *CELL, "x_km", "y_km", "radius_km", active.alias("active"), bridge.alias("bridge"), strong.alias("strong")).where("active OR bridge OR strong")
        out = met if out is None else out.union(met)
    return materialise(out)


def _near(strong: DataFrame, grown: DataFrame) -> DataFrame:
    """Strong cells within their zone's radius of one of its grown cells, by buckets of that size."""
    at = lambda c: F.floor(F.col(c) / F.col("radius_km")).cast("long")
    mine = strong.withColumns({"_bx": at("x_km"), "_by": at("y_km")})
    around = F.array(*[F.struct((at("x_km") + i).alias("_bx"), (at("y_km") + j).alias("_by")) for i in (-1, 0, 1) for j in (-1, 0, 1)])
    theirs = grown.select("zone", F.col("x_km").alias("_x"), F.col("y_km").alias("_y"), F.inline(around))
    apart = (F.col("x_km") - F.col("_x")) ** 2 + (F.col("y_km") - F.col("_y")) ** 2
    same = (mine["zone"] == theirs["zone"]) & (mine["_bx"] == theirs["_bx"]) & (mine["_by"] == theirs["_by"])
    return mine.join(theirs, same & (apart <= F.col("radius_km") ** 2), "left_semi").select("zone", *CELL)


def _grown(open_: DataFrame, seeds: DataFrame, places: DataFrame, every: DataFrame, taken: DataFrame) -> DataFrame:
    """One growth of all zones at once, none into ``taken`` cells."""
    by, keys = ("zone",), ["zone", *CELL]
    free = lambda d: d.join(taken, CELL, "left_anti")
    allowed = materialise(free(open_))
    grown = propagate(seeds, allowed.where("active").select(*keys), by)
    grown = materialise(propagate(materialise(grown), allowed.where("bridge").select(*keys), by))
    grown = materialise(free(fill_holes(materialise(closing(grown, every, 2, by)), by=by)).select(*keys))
    lost = seeds.join(grown.select("zone").distinct(), "zone", "left_anti")
    grown = grown.union(free(lost).select(*keys))
    at = grown.join(places, CELL).join(open_.select("zone", "radius_km").distinct(), "zone")
    strong = allowed.where("strong").join(grown, keys, "left_anti")
    return materialise(grown.union(_near(strong, at).select(*keys)).distinct())


def expand_zones(records: DataFrame, seeds: DataFrame, cells: DataFrame, grid: DataFrame, *, max_rounds: int = 100) -> tuple[DataFrame, int]:
    """``zone, row, col`` of zones grown over the raster, and the number of rounds.

    ``records`` has a row a zone: ``zone`` (its place in the order), ``zone_type, internal_corr, temporal_coherence, activity, net_mm,
    median_abs_velocity, area_km2`` and ``trace``; ``seeds`` are ``zone, row, col``; ``cells`` come from :func:`growth_cells`; ``grid`` has
    ``row, col, lat, lon`` of the raster.  A zone grows from its seeds over active cells, then over bridging ones, is closed and filled, and takes in
    strong cells near it.  Cells go to the first zone in the order that claims them, and a later zone grows around them, as if zones
    were grown one after another.

    All open zones grow at once.  A zone is done if no open zone before it claims a cell of it: growing over fewer cells never claims
    more, so its result cannot change.  The others grow again around what is taken.  Rounds follow the longest chain of zones
    that touch, not their number.
    """
    seeds = materialise(seeds.select("zone", *CELL))
    every = materialise(_whole(grid.select(*CELL, "lat")))
    df = with_stats(grid, _lat=F.avg("lat"))
    places = materialise(df.select(*CELL, (F.col("lon") * 111.320 * F.cos(F.radians("_lat"))).alias("x_km"), (F.col("lat") * 110.540).alias("y_km")))
    allowed, waiting = admitted(cells, records), materialise(records.select("zone"))
    done = seeds.limit(0)
    for rounds in range(1, max_rounds + 1):
        open_ = allowed.join(waiting, "zone", "left_semi")
        grown = _grown(open_, seeds.join(waiting, "zone", "left_semi"), places, every, done.select(*CELL))
        claims = grown.union(seeds.join(waiting, "zone", "left_semi")).distinct()
        first = claims.groupBy(*CELL).agg(F.min("zone").alias("_first"))
        beaten = claims.join(first, CELL).where(F.col("zone") > F.col("_first")).select("zone").distinct()
        settled_ = materialise(waiting.join(beaten, "zone", "left_anti"))
        done = materialise(done.union(grown.join(settled_, "zone", "left_semi")))
        waiting = materialise(waiting.join(settled_, "zone", "left_anti"))
        if waiting.isEmpty():
            return done, rounds
    raise RuntimeError("the zones did not settle")
