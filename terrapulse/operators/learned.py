"""Models that are fitted with Spark ML: probability of motion from seeds, and forecasts with their importance figures."""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from terrapulse.operators.panel import _KEPT
from terrapulse.operators.rasters import CELL
from terrapulse.operators.seeds import SPREAD_WEIGHTS, UNIT_WEIGHTS, probability
from terrapulse.session import materialise

FEATURES = (*SPREAD_WEIGHTS, *UNIT_WEIGHTS, "local_mean", "sign", "strict", "relaxed")


def _finite(c):
    c = c.cast("double")
    return F.when(c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")), c).otherwise(0.0)


def learned_probability(found: DataFrame, seeds: DataFrame, *, rounds: int = 0, per_class: int = 50_000, least: int = 16, sure: float = 0.85, trees: int = 40, depth: int = 4) -> DataFrame:
    """``row, col, probability`` by boosted trees on as many moving as resting seeds (M5).

    At most ``per_class`` seeds a class are learned from, drawn by a hash of their place; fewer than ``least`` of a class
    give the weighted sum of the features.  Seeds keep at least ``sure`` or at most its complement.  Each of ``rounds`` adds the
    cells beyond these two as seeds and fits again (M6).
    """
    found = materialise(found.select(*CELL, *[_finite(F.col(c)).alias(c) for c in FEATURES]).withColumn("x", array_to_vector(F.array(*FEATURES))))
    seeds = materialise(seeds.select(*CELL, F.col("seed").cast("int").alias("seed")))
    given = seeds
    for last in [False] * rounds + [True]:
        counts = {r.seed: r.n for r in seeds.join(found, CELL).groupBy("seed").agg(F.count(F.lit(1)).alias("n")).collect()}
        n = min(counts.get(0, 0), counts.get(1, 0), per_class)
        if n < least:
            return probability(found)
        key = [F.xxhash64(*CELL, F.lit(42)), *CELL]
        drawn = [seeds.join(found, CELL).where(F.col("seed") == s).orderBy(*key).limit(n) for s in (0, 1)]
        model = GBTClassifier(featuresCol="x", labelCol="seed", maxIter=trees, maxDepth=depth, seed=42).fit(materialise(drawn[0].union(drawn[1]).select("x", "seed")))
        scored = model.transform(found).select(*CELL, vector_to_array("probability")[1].alias("p"))
        if last:
            break
        more = scored.where((F.col("p") >= sure) | (F.col("p") <= 1 - sure)).join(given, CELL, "left_anti")
        seeds = materialise(given.union(more.select(*CELL, (F.col("p") >= sure).cast("int"))))
    held = F.when(F.col("seed") == 1, F.greatest("p", F.lit(sure))).when(F.col("seed") == 0, F.least("p", F.lit(1 - sure))).otherwise(F.col("p"))
    return scored.join(given, CELL, "left").select(*CELL, held.alias("probability"))


def _vector(channels: tuple[str, ...], statics: tuple[str, ...]):
    history = F.flatten(F.transform("history", lambda x: F.array(*[_finite(x[c]) for c in channels])))
    return array_to_vector(F.concat(history, F.array(*[_finite(F.col(c)) for c in statics])) if statics else history)


class Forecaster:
    """One regression for each step ahead on the flattened history and the ``statics`` of a window (FC17).

    ``kind`` is "linear" or "trees".  Windows come from ``panel.windows``, normalised or not; ``statics`` are further columns
    of theirs.  The variant with neighbours (FC19) is the same with means of the neighbours as channels or statics.
    """

    def __init__(self, kind: str, channels: tuple[str, ...], statics: tuple[str, ...] = ()):
        self.kind, self.channels, self.statics, self.models = kind, channels, statics, []

    def fit(self, train: DataFrame, horizon: int) -> Forecaster:
        data = materialise(train.select(_vector(self.channels, self.statics).alias("x"), "targets"))
        for h in range(horizon):
            make = LinearRegression(regParam=1e-6) if self.kind == "linear" else GBTRegressor(maxIter=20, maxDepth=4, seed=42)
            self.models.append(make.setFeaturesCol("x").setLabelCol("y").setPredictionCol(f"_p{h}").fit(data.select("x", F.get("targets", F.lit(h)).alias("y"))))
        return self

    def predict(self, found: DataFrame) -> DataFrame:
        """Windows with ``method`` and ``p50``, as the baselines give them."""
        df = found.withColumn("x", _vector(self.channels, self.statics))
        for model in self.models:
            df = model.transform(df)
        kept = [c for c in (*_KEPT, "copy") if c in df.columns]
        return df.select(*kept, F.lit(f"learned_{self.kind}").alias("method"), F.array(*[f"_p{h}" for h in range(len(self.models))]).alias("p50"))


def _sampled(found: DataFrame, most: int) -> DataFrame:
    """At most ``most`` windows, drawn by a hash of point and end."""
    return materialise(found.orderBy(F.xxhash64("point_id", "window_end", F.lit(42)), "point_id", "window_end").limit(most))


def _added_error(model: Forecaster, copies: DataFrame) -> DataFrame:
    gap = F.aggregate(F.zip_with("p50", "targets", lambda p, y: (p - y) * (p - y)), F.lit(0.0), lambda s, x: s + x)
    error = model.predict(copies).groupBy("copy").agg(F.sqrt(F.sum(gap) / F.sum(F.size("targets"))).alias("rmse"))
    base = F.broadcast(error.where("copy = ''").select(F.col("rmse").alias("_base")))
    return error.where("copy <> ''").join(base).select(F.col("copy").alias("name"), F.greatest(F.col("rmse") - F.col("_base"), F.lit(0.0)).alias("importance"))


def group_importance(model: Forecaster, found: DataFrame, groups: dict[str, tuple[str, ...]], most: int = 4096) -> DataFrame:
    """``name, importance``: by how much the error grows if a group of channels is 0 (FC24); one pass scores all copies."""
    sample = _sampled(found, most)

    def without(gone: tuple[str, ...]):
        return F.transform("history", lambda x: F.struct(*[(F.lit(0.0) if c in gone else x[c].cast("double")).alias(c) for c in model.channels]))

    copies = sample.withColumns({"history": without(()), "copy": F.lit("")})
    for name, channels in groups.items():
        copies = copies.unionByName(sample.withColumns({"history": without(channels), "copy": F.lit(name)}))
    return _added_error(model, copies)


def static_importance(model: Forecaster, found: DataFrame, most: int = 4096) -> DataFrame:
    """``name, importance``: by how much the error grows if a static column is dealt out anew among the sampled windows (FC25)."""
    sample = _sampled(found, most)
    # the sample is bounded by ``most``, so numbering it in one task is
    numbered = materialise(sample.withColumn("_i", F.row_number().over(Window.orderBy("point_id", "window_end"))))
    copies = sample.withColumn("copy", F.lit(""))
    for name in model.statics:
        other = numbered.withColumn("_i", F.row_number().over(Window.orderBy(F.xxhash64("point_id", "window_end", F.lit(name)), "_i"))).select("_i", F.col(name).alias("_v"))
        copies = copies.unionByName(numbered.join(other, "_i").withColumns({name: F.col("_v"), "copy": F.lit(name)}).drop("_i", "_v"))
    return _added_error(model, copies)
