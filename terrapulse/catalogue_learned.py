"""Registered queries of fitted models; SQL cannot express them, tests hold them against plain fits."""

from __future__ import annotations

from pyspark.sql import functions as F

from terrapulse.catalogue import _scored_points, register
from terrapulse.catalogue_forecasts import _windows
from terrapulse.catalogue_seeds import _features
from terrapulse.operators import choices, learned, neighbours, panel, quantiles, seeds, series, support
from terrapulse.session import materialise

_CHANNELS = ("rel0", "delta", "sin_year", "cos_year")


@register("m05_learned_probability", ("point",), None)
def m05(points):
    found = materialise(_features(points))
    return learned.learned_probability(found, seeds.weak_seeds(found), trees=10)


@register("m06_self_trained", ("point",), None)
def m06(points):
    found = materialise(_features(points))
    return learned.learned_probability(found, seeds.weak_seeds(found), rounds=2, trees=10)


def _fitted(epochs, obs, points, kind="linear"):
    score = _scored_points(points).select("point_id", "ps_score", "height_m")
    found = materialise(_windows(epochs, obs, _CHANNELS).join(score, "point_id"))
    model = learned.Forecaster(kind, _CHANNELS, ("ps_score", "height_m")).fit(found.where("split = 'train'"), 3)
    return model, found.where("split = 'val'")


@register("fc17_learned", ("epoch", "obs", "point"), None, kept=("epoch", "obs"))
def fc17(epochs, obs, points):
    model, found = _fitted(epochs, obs, points)
    return model.predict(found).select("point_id", "window_end", "method", F.posexplode("p50").alias("h", "p50"))


@register("fc17_quantiles", ("epoch", "obs", "point"), None, kept=("epoch", "obs"))
def fc17_quantiles(epochs, obs, points):
    """Quantiles of the validation windows, one row a window and step."""
    score = _scored_points(points).select("point_id", "ps_score", "height_m")
    found = materialise(_windows(epochs, obs, ("rel0", "delta")).join(score, "point_id"))
    model = quantiles.QuantileForecaster(("rel0", "delta"), ("ps_score", "height_m"), rounds=20).fit(found.where("split = 'train'"), 3)
    return quantiles.flat(model.predict(found.where("split = 'val'"))).select("point_id", "window_end", "h", "p10", "p50", "p90")


@register("fc19_variant", ("epoch", "obs", "point"), None, kept=("epoch", "obs"))
def fc19(epochs, obs, points):
    """Whether neighbours are used: the gate (G13) on the graph of the points with series, then the validation error of both variants."""
    score = materialise(_scored_points(points).join(obs.select("point_id").distinct(), "point_id", "left_semi"))
    edges = materialise(neighbours.nearest(score, 8, cell=150.0).select("src", "dst"))
    found = materialise(quantiles.with_neighbours(_windows(epochs, obs, ("rel0", "delta")).join(score.select("point_id", "ps_score"), "point_id"), edges))
    train, val = found.where("split = 'train'"), found.where("split = 'val'")
    summary = neighbours.summaries(edges, series.steps(obs))
    stats = support.graph_statistics(edges, score, summary, epochs.count()).select("nodes", "mean_degree", "largest_share", F.col("null_share").alias("gap_share"))
    counts = train.agg(F.count_if(F.col("near_count") > 0).alias("hazard_windows"), F.count(F.lit(1)).alias("windows"))
    reasons = choices.gate(stats.join(counts)).first().reasons
    make = lambda statics: quantiles.QuantileForecaster(("rel0", "delta"), statics, rounds=15).fit(train, 3)
    plain, near = make(("ps_score",)), make(("ps_score", *quantiles.NEAR))
    return quantiles.chosen_variant(quantiles.flat(plain.predict(val)), quantiles.flat(near.predict(val)), reasons)


@register("fc24_group_importance", ("epoch", "obs", "point"), None, kept=("epoch", "obs"))
def fc24(epochs, obs, points):
    model, found = _fitted(epochs, obs, points)
    return learned.group_importance(model, found, {k: tuple(c for c in v if c in _CHANNELS) for k, v in panel.GROUPS.items()} | {"season": ("sin_year", "cos_year")})


@register("fc25_static_importance", ("epoch", "obs", "point"), None, kept=("epoch", "obs"))
def fc25(epochs, obs, points):
    return learned.static_importance(*_fitted(epochs, obs, points))
