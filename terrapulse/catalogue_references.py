"""Registered queries over fits, reference points and passes, with their DuckDB twins."""

from __future__ import annotations

import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from terrapulse.catalogue import _METRICS, _pair_metrics, _scored_points, register
from terrapulse.catalogue_grids import RATE_SQL, rate
from terrapulse.operators import feedback, fits, pairs, passes, references, series
from terrapulse.session import materialise, shared_dir
from terrapulse.twins import MODEL

_T = "(day_offset / 365.25::DOUBLE)"


@register(
    "ts01_least_squares",
    ("obs",),
    f"SELECT point_id, CAST(count(*) AS INTEGER) AS n, round(regr_intercept(value_mm, {_T}), 4) AS cut, round(regr_slope(value_mm, {_T}), 4) AS slope, "
    f"round(regr_syy(value_mm, {_T}) - regr_slope(value_mm, {_T}) * regr_sxy(value_mm, {_T}), 2) AS sse FROM obs GROUP BY point_id",
)
def ts01(obs):
    x = fits.least_squares(obs)
    return x.select("point_id", "n", F.round(F.get("coefficients", 0), 4).alias("cut"), F.round(F.get("coefficients", 1), 4).alias("slope"), F.round("sse", 2).alias("sse"))


@register("ts03_chosen_model", ("obs",), MODEL + " SELECT point_id, first(model) AS model, first(break_idx) AS break_idx, round(first(delta_bic), 4) AS delta_bic, round(first(model_rms), 6) AS model_rms FROM r GROUP BY point_id")
def ts03(obs):
    return fits.chosen_model(obs).drop("epochs", "fitted").withColumn("delta_bic", F.round("delta_bic", 4))


@register("ts05_model_residuals", ("obs",), MODEL + " SELECT point_id, epoch_idx, round(fit, 5) AS fit, round(res, 5) AS res FROM r")
def ts05(obs):
    return fits.model_fits(obs).select("point_id", "epoch_idx", F.round("fit", 5).alias("fit"), F.round("res", 5).alias("res"))


def _weighted(n: int, source: str, weight: str) -> str:
    """One weighted fit of a line and a wave, over the columns ``t, y, s, c`` and a weight (DuckDB)."""
    p = "OVER (PARTITION BY point_id)"
    dot = lambda a, b: f"sum(w * {a} * {b}) {p}"
    return f"""a{n} AS (SELECT * EXCLUDE (w), {weight} AS w FROM {source}), b{n} AS (SELECT *, sum(w * t) {p} / sum(w) {p} AS mt, sum(w * y) {p} / sum(w) {p} AS my, sum(w * s) {p} / sum(w) {p} AS ms, sum(w * c) {p} / sum(w) {p} AS mc FROM a{n}),
 c{n} AS (SELECT *, {dot("(t - mt)", "(t - mt)")} AS tt, {dot("(t - mt)", "(y - my)")} AS ty, {dot("(t - mt)", "(s - ms)")} AS ts, {dot("(t - mt)", "(c - mc)")} AS tc FROM b{n}),
 d{n} AS (SELECT *, y - my - ty / tt * (t - mt) AS r, s - ms - ts / tt * (t - mt) AS s1, c - mc - tc / tt * (t - mt) AS c1 FROM c{n}),
 e{n} AS (SELECT *, {dot("s1", "r")} / {dot("s1", "s1")} AS al, {dot("s1", "c1")} / {dot("s1", "s1")} AS rho FROM d{n}),
 f{n} AS (SELECT *, {dot("(c1 - rho * s1)", "r")} / {dot("(c1 - rho * s1)", "(c1 - rho * s1)")} AS be FROM e{n}),
 g{n} AS (SELECT point_id, epoch_idx, t, y, s, c, w, (al - be * rho) * s + be * c AS seasonal, my + ty / tt * (t - mt) + al * s1 + be * (c1 - rho * s1) AS fit FROM f{n})"""


_HARMONIC = f"""z AS (SELECT point_id, epoch_idx, value_mm AS y, day_offset / 365.25::DOUBLE AS t, sin(2 * pi() * day_offset / 365.25::DOUBLE) AS s, cos(2 * pi() * day_offset / 365.25::DOUBLE) AS c, 1.0::DOUBLE AS w FROM obs),
 {_weighted(1, "z", "1.0::DOUBLE")}, h AS (SELECT *, abs(y - fit) AS off, median(abs(y - fit)) OVER (PARTITION BY point_id) AS scale FROM g1),
 {_weighted(2, "h", "1 / greatest(1, off / (1.5 * CASE WHEN scale > 1e-3 THEN scale ELSE 1 END))")}"""


@register("ts07_robust_harmonic", ("obs",), _HARMONIC + " SELECT point_id, epoch_idx, round(fit - seasonal, 5) AS trend, round(seasonal, 5) AS seasonal, round(y - fit, 5) AS residual FROM g2")
def ts07(obs):
    return fits.robust_harmonic(obs).select("point_id", "epoch_idx", *[F.round(c, 5).alias(c) for c in ("trend", "seasonal", "residual")])


@register(
    "ts09_inverted_network",
    ("obs",),
    "SELECT point_id, strftime(date, '%Y%m%d') AS date, round(value_mm - first_value(value_mm) OVER (PARTITION BY point_id ORDER BY epoch_idx), 2) AS value FROM obs",
)
def ts09(obs):
    """Every epoch paired with the two before it: a redundant, consistent network gives the series back."""
    w = Window.partitionBy("point_id").orderBy("epoch_idx")
    day = F.date_format("date", "yyyyMMdd")
    back = F.array(*[F.struct(F.lag(day, k).over(w).alias("date1"), day.alias("date2"), (F.col("value_mm") - F.lag("value_mm", k).over(w)).alias("value")) for k in (1, 2)])
    network = obs.select("point_id", back.alias("x")).select("point_id", F.inline("x")).where("date1 IS NOT NULL")
    return fits.inverted(network, "point_id").withColumn("value", F.round("value", 2))


_REF = f"""q AS (SELECT quantile_cont(model_rms, 0.05) AS lo, quantile_cont(model_rms, 0.95) AS hi FROM point), s0 AS (SELECT *, 0.30 * least(1, greatest(0, tcoh)) + 0.20 * valid_pair_ratio + 0.20 * maincc_ratio
 + 0.15 * (1 - least(1, greatest(0, (model_rms - lo) / (hi - lo)))) + 0.15 * (1 - least(1, greatest(0, jump_risk))) AS ps_score FROM point, q),
r0 AS (SELECT * EXCLUDE (lo, hi), point_id % 7 AS neighbours, least("row", col, max("row") OVER () - "row", max(col) OVER () - col) AS edge, jump_risk * 10 AS gradient, col % 9 <> 0 AS safe,
 {RATE_SQL} AS velocity, ps_score >= 0.75 AS strict FROM s0),
"""


def _reference_points(points):
    df = _scored_points(points)
    whole = Window.partitionBy()
    edge = F.least("row", "col", F.max("row").over(whole) - F.col("row"), F.max("col").over(whole) - F.col("col"))
    return df.withColumns({
        "neighbours": F.col("point_id") % 7, "edge": edge, "gradient": F.col("jump_risk") * 10, "safe": F.col("col") % 9 != 0, "velocity": rate(), "strict": F.col("ps_score") >= 0.75,
    })


_CONSTRAINED = """g AS (SELECT quantile_cont(gradient, 0.9) AS g FROM r0), l0 AS (SELECT *, CASE WHEN edge >= 1 AND neighbours >= 3 AND safe AND gradient <= g
 THEN CASE WHEN tcoh >= 0.7 AND valid_pair_ratio >= 0.8 AND maincc_ratio >= 0.8 THEN 0 ELSE 1 END ELSE 2 END AS own FROM r0, g),
cn AS (SELECT * EXCLUDE (own, g), (SELECT min(own) FROM l0) AS level FROM l0 WHERE own <= (SELECT min(own) FROM l0))
"""


@register("p19_constrained", ("point",), _REF + _CONSTRAINED + "SELECT point_id, CAST(level AS INTEGER) AS level FROM cn")
def p19(points):
    return references.constrained(_reference_points(points), min_edge=1.0).select("point_id", "level")


_QUALITY = """nq AS (SELECT quantile_cont(model_rms, 0.05) AS a, quantile_cont(model_rms, 0.95) AS b, quantile_cont(neighbours, 0.05) AS c, quantile_cont(neighbours, 0.95) AS d FROM r0),
rs AS (SELECT *, 0.35 * least(1, greatest(0, tcoh)) + 0.25 * maincc_ratio + 0.20 * (1 - least(1, greatest(0, (model_rms - a) / (b - a)))) + 0.10 * valid_pair_ratio + 0.10 * least(1, greatest(0, (neighbours - c) / (d - c))) AS ref_score FROM r0, nq),
ng AS (SELECT * EXCLUDE (a, b, c, d), 0.70 * ref_score + 0.20 * ps_score + 0.10 * (1 - least(1, greatest(0, jump_risk))) AS network_quality FROM rs)
"""


@register("g07_reference_scores", ("point",), _REF + _QUALITY + "SELECT point_id, round(ref_score, 6) AS ref_score, round(network_quality, 6) AS network_quality FROM ng")
def g07(points):
    return references.scored(_reference_points(points)).select("point_id", "ref_score", "network_quality")


#: The walk itself, point by point.
_WALK = """, o AS (SELECT point_id, "row", col, lat, lon, network_quality, row_number() OVER (ORDER BY round(network_quality, 9) DESC, "row", col) AS k FROM ng WHERE ps_score >= 0.60),
walk(k, kept) AS (SELECT CAST(0 AS BIGINT), CAST([] AS STRUCT(id BIGINT, y DOUBLE, x DOUBLE)[]) UNION ALL
 SELECT o.k, CASE WHEN len(list_filter(kept, lambda p: sqrt(((p.x - o.lon) * 111320.0::DOUBLE * cos(radians(o.lat))) ** 2 + ((p.y - o.lat) * 110540.0::DOUBLE) ** 2) < 400)) = 0
 THEN list_append(kept, {'id': CAST(o.point_id AS BIGINT), 'y': o.lat, 'x': o.lon}) ELSE kept END FROM walk JOIN o ON o.k = walk.k + 1),
net AS (SELECT unnest(kept).id AS point_id FROM (SELECT kept FROM walk ORDER BY k DESC LIMIT 1))
"""
_NET = _REF + _QUALITY + _WALK


def _good_points(points):
    df = references.scored(_reference_points(points)).where("ps_score >= 0.60")
    return df.withColumn("network_quality", F.round("network_quality", 9))


@register("g06_sparse_network", ("point",), _NET + "SELECT point_id, row_number() OVER (ORDER BY round(network_quality, 9) DESC, \"row\", col) AS network_rank FROM net JOIN ng USING (point_id)", recursive=True)
def g06(points):
    good = _good_points(points)
    return references.ranked(good.join(references.sparse_network(good), "point_id")).select("point_id", F.col("network_rank").cast("long").alias("network_rank"))


_MED = ", ".join(f"median({c}) FILTER (c.strict) AS patch_{c}" for c in references.PATCH)
_PATCHES = f"""pt AS (SELECT a.point_id, count(*) FILTER (c.strict) AS patch_count, {_MED.replace('median(', 'median(c.')},
 coalesce(median(c.velocity) FILTER (c.strict), median(c.velocity)) AS patch_velocity, coalesce(median(abs(c.velocity)) FILTER (c.strict), median(abs(c.velocity))) AS patch_abs_velocity,
 coalesce(quantile_cont(c.velocity, 0.75) FILTER (c.strict) - quantile_cont(c.velocity, 0.25) FILTER (c.strict), quantile_cont(c.velocity, 0.75) - quantile_cont(c.velocity, 0.25)) AS patch_velocity_iqr
 FROM ng a JOIN r0 c ON abs(a."row" - c."row") <= 2 AND abs(a.col - c.col) <= 2 WHERE a.point_id % 5 = 0 GROUP BY a.point_id)
"""


def _patched(points):
    df = references.scored(_reference_points(points))
    some = df.where("point_id % 5 = 0")
    return some.join(references.patches(some, df), "point_id")


@register(
    "a15_patch_statistics",
    ("point",),
    _REF + _QUALITY + ", " + _PATCHES + "SELECT point_id, patch_count, " + ", ".join(f"round(patch_{c}, 6) AS patch_{c}" for c in (*references.PATCH, "velocity", "abs_velocity", "velocity_iqr")) + " FROM pt",
)
def a15(points):
    return _patched(points).select("point_id", "patch_count", *[f"patch_{c}" for c in (*references.PATCH, "velocity", "abs_velocity", "velocity_iqr")])


_CAND = """ca AS (SELECT ng.*, pt.* EXCLUDE (point_id), ng.point_id % 4 AS network_neighbours FROM ng JOIN pt USING (point_id)),
th AS (SELECT greatest(5, quantile_cont(patch_abs_velocity, 0.25)) AS lim, quantile_cont(patch_velocity_iqr, 0.7) AS iq FROM ca),
nt AS (SELECT ca.*, patch_abs_velocity <= lim AND patch_velocity_iqr <= iq AS calm FROM ca, th WHERE network_neighbours > 0),
ne AS (SELECT * FROM nt WHERE calm OR NOT (SELECT max(calm) FROM nt)),
rk AS (SELECT *, row_number() OVER (ORDER BY round(patch_abs_velocity, 9), round(patch_velocity_iqr, 9), round(patch_ps_score, 9) DESC NULLS LAST, edge DESC, network_neighbours DESC, neighbours DESC, round(gradient, 9),
 round(patch_model_rms, 9) NULLS LAST, round(patch_jump_risk, 9) NULLS LAST, "row", col) AS rank FROM ne)
"""
_CHAIN = _REF + _QUALITY + ", " + _PATCHES + ", " + _CAND


def _candidates(points):
    return _patched(points).withColumn("network_neighbours", F.col("point_id") % 4)


@register("g08_neutral_candidates", ("point",), _CHAIN + "SELECT point_id, calm AS neutral FROM ne")
def g08(points):
    return references.neutral(_candidates(points)).select("point_id", "neutral")


@register("t02_ordered_candidates", ("point",), _CHAIN + "SELECT point_id, CAST(rank AS INTEGER) AS rank FROM rk WHERE rank <= 20")
def t02(points):
    return references.ordered(references.neutral(_candidates(points))).select("point_id", "rank")


@register("t12_locked_candidate", ("point",), _CHAIN + "SELECT point_id, CAST(rank AS INTEGER) AS rank FROM rk WHERE rank <= 20 ORDER BY CAST(rank <> 2 AS INT), rank LIMIT 1")
def t12(points):
    return references.locked(references.ordered(references.neutral(_candidates(points))), 2).select("point_id", "rank")


@register(
    "a16_bias_audit",
    ("point",),
    _CHAIN
    + """, c2 AS (SELECT *, row_number() OVER (ORDER BY point_id DESC) AS place FROM ca), c3 AS (SELECT * FROM c2 WHERE place <= 20),
t2 AS (SELECT greatest(5, quantile_cont(patch_abs_velocity, 0.25)) AS threshold, quantile_cont(patch_velocity_iqr, 0.7) AS iqr_threshold FROM c3), sel AS (SELECT * FROM c3 WHERE place = 3),
b AS (SELECT place FROM c3, t2 ORDER BY NOT (patch_abs_velocity <= threshold AND patch_velocity_iqr <= iqr_threshold), patch_abs_velocity, patch_velocity_iqr, place LIMIT 1)
SELECT CAST(sel.place AS INTEGER) AS selected_rank, round(patch_velocity, 6) AS patch_velocity, round(patch_abs_velocity, 6) AS patch_abs_velocity, round(threshold, 6) AS threshold, round(iqr_threshold, 6) AS iqr_threshold,
 round((SELECT median(velocity) FROM r0 WHERE strict), 6) AS scene_velocity, patch_abs_velocity > threshold AS biased, CASE WHEN patch_abs_velocity > threshold THEN CAST((SELECT place FROM b) AS INTEGER) END AS recommended_rank FROM sel, t2""",
)
def a16(points):
    df = _candidates(points).withColumn("rank", F.row_number().over(Window.orderBy(F.desc("point_id"))))
    return references.bias_audit(df, _reference_points(points).where("strict"), 3)


_FIT = f"f AS (SELECT point_id, regr_slope(value_mm, {_T}) AS b, regr_intercept(value_mm, {_T}) AS a, sqrt((regr_syy(value_mm, {_T}) - regr_slope(value_mm, {_T}) * regr_sxy(value_mm, {_T})) / count(*)) AS rms FROM obs GROUP BY point_id), "
_EVAL = (
    _FIT
    + f"""e AS (SELECT obs.*, value_mm - a - b * {_T} AS res FROM obs JOIN f USING (point_id)), j AS (SELECT *, abs(res - lag(res) OVER (PARTITION BY point_id ORDER BY epoch_idx)) > 10 AS jump FROM e),
n AS (SELECT point_id, count(*) AS n FROM obs GROUP BY point_id), o AS (SELECT avg(CAST(jump AS INT)) AS jump_ratio, median(abs(res)) AS med, count(DISTINCT epoch_idx) AS epochs,
 avg(abs(res)) FILTER (point_id IN (1, 2)) AS patch_residual, avg(CAST(jump AS INT)) FILTER (point_id IN (1, 2)) AS patch_jumps FROM j),
ev AS (SELECT *, (SELECT count(*) FROM n WHERE n = epochs) AS retained, (SELECT median(rms) FROM f) AS median_rms, (SELECT median(b) FROM f) AS scene_velocity,
 coalesce(patch_residual > greatest(med * 1.5, 1) OR patch_jumps > greatest(jump_ratio * 1.5, 0.15), false) AS abnormal FROM o)
"""
)


def _evaluated(obs):
    line = series.trend(obs)
    fitted = obs.join(line, "point_id").select("point_id", "epoch_idx", (F.col("intercept") + F.col("slope") * F.col("day_offset") / 365.25).alias("fit"))
    models = line.select("point_id", F.col("rms").alias("model_rms"))
    patch = obs.where("point_id IN (1, 2)").select("point_id").distinct()
    return references.evaluation(obs, fitted, models, line.select("point_id", F.col("slope").alias("velocity")), 10.0, patch=patch, rank=1)


@register(
    "a17_pass_evaluation",
    ("obs",),
    _EVAL
    + "SELECT round(jump_ratio, 6) AS jump_ratio, round(patch_residual, 4) AS patch_residual, round(patch_jumps, 6) AS patch_jumps, retained, round(median_rms, 4) AS median_rms, round(scene_velocity, 4) AS scene_velocity, abnormal, CASE WHEN abnormal THEN 2 END AS next_rank FROM ev",
)
def a17(obs):
    out = _evaluated(obs)
    return out.withColumns({c: F.round(c, 4) for c in ("patch_residual", "median_rms", "scene_velocity")})


@register(
    "a21_accepted_pass",
    ("obs",),
    _EVAL
    + """, a AS (SELECT jump_ratio, median_rms, retained, abs(scene_velocity) AS v, 4.0 AS p FROM ev), b AS (SELECT jump_ratio * 0.9 AS jump_ratio, median_rms * 1.2 AS median_rms, retained, v, 5.0 AS p FROM a),
r AS (SELECT list_filter([CASE WHEN NOT b.jump_ratio <= a.jump_ratio THEN 'adjacent_jump_ratio_not_improved' END, CASE WHEN NOT b.median_rms <= 1.05 * a.median_rms THEN 'median_model_rms_degraded' END,
 CASE WHEN NOT b.retained >= 0.85 * a.retained THEN 'retained_count_collapsed' END, CASE WHEN NOT b.v <= a.v THEN 'strict_ps_scene_median_velocity_not_improved' END, CASE WHEN NOT b.p <= a.p THEN 'reference_bias_not_improved' END], lambda x: x IS NOT NULL) AS x FROM a, b)
SELECT CASE WHEN len(x) = 0 THEN 'pass2' ELSE 'pass1' END AS accepted_pass, array_to_string(x, ',') AS reasons FROM r""",
)
def a21(obs):
    first = _evaluated(obs).withColumn("patch_abs_velocity", F.lit(4.0))
    second = first.withColumns({"jump_ratio": F.col("jump_ratio") * 0.9, "median_rms": F.col("median_rms") * 1.2, "patch_abs_velocity": F.lit(5.0)})
    return references.accepted(first, second)


@register("p24_kept_reference", ("scene",), "SELECT path, CASE WHEN path % 2 = 0 OR path = 1 THEN path * 10 END AS ref_row, CASE WHEN path % 2 = 0 OR path = 1 THEN path * 20 END AS ref_col FROM (SELECT DISTINCT path FROM scene)")
def p24(scenes):
    state = scenes.select("path").distinct().withColumns({"ref_row": F.col("path") * 10, "ref_col": F.col("path") * 20, "network_changed": F.col("path") % 2 == 1, "locked": F.col("path") == 1})
    return references.kept_reference(state).select("path", "ref_row", "ref_col")


_JUMPS = "d AS (SELECT point_id % 2 AS v, epoch_idx, abs(value_mm - lag(value_mm) OVER (PARTITION BY point_id ORDER BY epoch_idx)) AS d FROM obs), sh AS (SELECT v, epoch_idx, avg(CAST(d > 10 AS INT)) AS s FROM d GROUP BY ALL)"


@register(
    "a25_variant_table",
    ("pair_pixel", "obs", "point"),
    _METRICS
    + ", "
    + _JUMPS
    + """SELECT v AS variant, round((SELECT avg(coh_mean) FROM pm WHERE CAST(date1 AS INT) // 100 % 2 = v), 6) AS coherence, round((SELECT avg(valid_conncomp_frac) FROM pm WHERE CAST(date1 AS INT) // 100 % 2 = v), 6) AS component_share,
 round((SELECT median(model_rms) FROM point WHERE point_id % 2 = v), 6) AS deviation, round(avg(s), 6) AS jump_share FROM sh WHERE s IS NOT NULL GROUP BY v""",
)
def a25(pixels, obs, points):
    """Two variants: odd and even months of pairs, odd and even points."""
    variant = lambda df, c: df.withColumn("variant", c.cast("long"))
    qc = variant(pairs.metrics(pixels), F.expr("CAST(date1 AS INT) div 100 % 2"))
    rates = variant(points, F.col("point_id") % 2).withColumn("deviation", F.col("model_rms"))
    return references.inversion_metrics(qc, rates, variant(obs, F.col("point_id") % 2), "variant", jump=10.0)


@register("ts13_passes", ("pair_pixel", "obs", "point"), None, kept=("obs",))
def ts13(pixels, obs, points):
    """Both passes over a network of each epoch with the next two; pair quality from the pixels, candidates from the first points with series."""
    order = Window.partitionBy("point_id").orderBy("epoch_idx")
    day = F.date_format("date", "yyyyMMdd")
    ahead = F.array(*[F.struct(F.lead(day, k).over(order).alias("date2"), (F.lead("value_mm", k).over(order) - F.col("value_mm")).alias("value")) for k in (1, 2)])
    observations = materialise(obs.select("point_id", day.alias("date1"), ahead.alias("x")).select("point_id", "date1", F.inline("x")).where("date2 IS NOT NULL"))
    metrics = _pair_metrics(pixels, obs, points)
    first = materialise(feedback.first_round(observations.select("date1", "date2").distinct(), metrics))
    # the test tables rate few pairs; one without a rating keeps half its weight
    first = first.withColumns({"action_round1": F.when(F.col("q_round1") > 0, F.col("action_round1")).otherwise("downweight"), "weight_round1": F.when(F.col("q_round1") > 0, F.col("weight_round1")).otherwise(0.5)})
    first = first.withColumn("q_round1", F.when(F.col("q_round1") > 0, F.col("q_round1")).otherwise(0.6))
    places = points.join(obs.select("point_id").distinct(), "point_id", "left_semi").select("point_id", "row", "col")
    patches = obs.select("point_id").distinct().where("point_id <= 9").select((F.floor((F.col("point_id") - 1) / 3) + 1).cast("int").alias("rank"), "point_id")
    spark = obs.sparkSession
    return passes.run(spark, f"{shared_dir(spark)}/passes/{uuid.uuid4().hex}", observations, first, places, patches, jump_mm=10.0)
