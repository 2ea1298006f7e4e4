"""Measurement pairs: quality metrics, risk, action, and what follows for scenes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrapulse.functions.scalars import phase_to_mm
from terrapulse.functions.stats import minmax

WEIGHT = {"keep": 1.0, "downweight": 0.5, "drop": 0.0}


def is_valid(cc: Column, value: Column) -> Column:
    return cc.between(1, 65534) & value.isNotNull() & ~F.isnan(value)


def metrics(pixels: DataFrame) -> DataFrame:
    """One row per pair; the largest component's share comes from counts per (pair, component), so nothing is gathered."""
    ok = is_valid(F.col("cc"), F.col("unw"))
    los = F.abs(phase_to_mm(F.col("unw")))
    pair = pixels.groupBy("date1", "date2").agg(
        F.coalesce(F.avg(F.when(F.col("coh") > 0, F.col("coh"))), F.lit(0.0)).alias("coh_mean"),
        F.avg(ok.cast("double")).alias("valid_conncomp_frac"),
        F.coalesce(F.percentile(F.when(ok, los), F.lit(0.95)), F.lit(0.0)).alias("pair_p95_abs_los_mm"),
        F.coalesce(F.avg(F.when(ok, (los > 50.0).cast("double"))), F.lit(0.0)).alias("pair_frac_abs_los_gt_50mm"),
    )
    parts = pixels.where(ok).groupBy("date1", "date2", "cc").agg(F.count(F.lit(1)).alias("n"))
    parts = parts.groupBy("date1", "date2").agg(F.count(F.lit(1)).alias("n_conncomp"), (1.0 - F.max("n") / F.sum("n")).alias("closure_risk_proxy"))
    return pair.join(parts, ["date1", "date2"], "left").withColumns({"n_conncomp": F.coalesce("n_conncomp", F.lit(0)), "closure_risk_proxy": F.coalesce("closure_risk_proxy", F.lit(1.0))})


def scored(pair: DataFrame) -> DataFrame:
    """Risk, action and weight of each pair."""
    pair = minmax(pair, ncc="n_conncomp", p95="pair_p95_abs_los_mm")
    coh, valid, large = F.col("coh_mean"), F.col("valid_conncomp_frac"), F.col("pair_frac_abs_los_gt_50mm")
    risk = 0.25 * (1 - F.least(F.lit(1.0), coh)) + 0.20 * (1 - valid) + 0.15 * F.col("ncc") + 0.20 * F.col("p95") + 0.20 * large
    action = F.when((coh < 0.45) | (valid < 0.65) | (large > 0.15), "drop").when((coh >= 0.55) & (valid >= 0.85) & (large <= 0.05), "keep").otherwise("downweight")
    pair = pair.withColumn("risk", risk).withColumn("action", action).drop("ncc", "p95")
    weight = F.lit(None).cast("double")
    for a, w in WEIGHT.items():
        weight = F.when(F.col("action") == a, w).otherwise(weight)
    return pair.withColumn("pair_weight", weight)


def scenes(pair: DataFrame) -> DataFrame:
    """Quality of each date over the pairs it is part of."""
    ends = pair.withColumn("date", F.explode(F.array("date1", "date2")))
    n = lambda a: F.count_if(F.col("action") == a).alias(f"{a}_pairs")
    return ends.groupBy("date").agg(F.count(F.lit(1)).alias("pair_count"), F.avg("risk").alias("mean_pair_risk"), F.max("risk").alias("max_pair_risk"), F.avg("pair_weight").alias("mean_pair_weight"), n("keep"), n("downweight"), n("drop"))


def summary(pair: DataFrame) -> DataFrame:
    n = lambda a: F.count_if(F.col("action") == a).alias(f"{a}_pairs")
    return pair.agg(F.count(F.lit(1)).alias("pairs"), n("keep"), n("downweight"), n("drop"), F.avg("risk").alias("mean_risk"), F.percentile("risk", F.lit(0.9)).alias("p90_risk"))


def worst(pair: DataFrame, n: int = 10) -> DataFrame:
    return pair.orderBy(F.desc(F.round("risk", 6)), "date1", "date2").limit(n)


def main_component(pixels: DataFrame) -> DataFrame:
    """The largest component of each pair; of equal ones the smallest label (A4)."""
    n = pixels.where(is_valid(F.col("cc"), F.col("unw"))).groupBy("date1", "date2", "cc").agg(F.count(F.lit(1)).alias("n"))
    return n.groupBy("date1", "date2").agg(F.max_by("cc", F.struct("n", -F.col("cc"))).alias("main_cc"))


def point_ratios(pixels: DataFrame) -> DataFrame:
    """Of each point the shares of its pixels that are valid and that lie in the pair's main component (A10)."""
    ok = is_valid(F.col("cc"), F.col("unw"))
    joined = pixels.join(F.broadcast(main_component(pixels)), ["date1", "date2"], "left")
    return joined.groupBy("point_id").agg(F.avg(ok.cast("double")).alias("valid_pair_ratio"), F.avg((ok & (F.col("cc") == F.col("main_cc"))).cast("double")).alias("maincc_ratio"), F.count(F.lit(1)).alias("n"))


def qc_stack(pixels: DataFrame, pair: DataFrame) -> DataFrame:
    """Pixels with their pair's action; coherence of downweighted pairs is halved; an unknown pair is kept."""
    act = F.coalesce("action", F.lit("keep"))
    joined = pixels.join(F.broadcast(pair.select("date1", "date2", "action")), ["date1", "date2"], "left")
    return joined.withColumn("action", act).withColumn("coh", F.col("coh") * F.when(F.col("action") == "downweight", 0.5).otherwise(1.0))


def degree(pair: DataFrame) -> DataFrame:
    """Kept pairs of each date and the network's redundancy."""
    kept = pair.where("action <> 'drop'").withColumn("date", F.explode(F.array("date1", "date2")))
    per = kept.groupBy("date").agg(F.count(F.lit(1)).alias("degree"))
    whole = Window.partitionBy()
    return per.withColumn("redundancy", F.sum("degree").over(whole) / 2.0 / (F.count(F.lit(1)).over(whole) - 1))


def network(pair: DataFrame) -> DataFrame:
    """Mean coherence of each pair and whether the network keeps it."""
    return pair.select("date1", "date2", F.col("coh_mean").alias("coherence"), (F.col("action") != "drop").alias("kept"))


def redundancy(pair: DataFrame, least: float = 1.5) -> DataFrame:
    """One row: kept pairs, their dates, pairs to a chain's links, and whether that is over ``least``."""
    ends = pair.where("action <> 'drop'").select(F.explode(F.array("date1", "date2")).alias("date"))
    out = ends.groupBy("date").agg(F.count(F.lit(1)).alias("n")).agg((F.sum("n") / 2).cast("long").alias("pairs"), F.count(F.lit(1)).alias("dates"))
    links = F.col("dates") - 1
    return out.withColumns({"redundancy": F.try_divide(F.col("pairs"), links), "enough": F.col("pairs") > least * links})
