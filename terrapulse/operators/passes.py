"""The two-pass feedback loop from pairs to series and back, over tables that are written once.

Each pass has its actions, series, evaluation and audit in a folder of its own.  A run that finds a finished table reads it, so a loop
that was cut off goes on where it stopped.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from terrapulse.operators import feedback, fits, references, series
from terrapulse.session import materialise

PAIR = ["date1", "date2"]


class Store:
    """Tables by name under a folder that all machines share."""

    def __init__(self, spark: SparkSession, base: str):
        self.spark, self.base = spark, base.rstrip("/")

    def done(self, name: str) -> bool:
        """Whether the table was written to its end."""
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(f"{self.base}/{name}/_SUCCESS")
        return path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(path)

    def once(self, name: str, make: Callable[[], DataFrame]) -> DataFrame:
        if not self.done(name):
            make().write.mode("overwrite").parquet(f"{self.base}/{name}")
        return self.spark.read.parquet(f"{self.base}/{name}")


def network_series(observations: DataFrame, actions: DataFrame, reference: DataFrame) -> DataFrame:
    """``point_id, epoch_idx, date, day_offset, value_mm`` from the kept pairs, by weight, relative to the mean of the reference's points.

    ``observations`` are ``point_id, date1, date2, value``, dates as yyyyMMdd; ``actions`` are ``date1, date2, action, weight``; dropped pairs are
    left out.  Epochs are numbered over the dates of all pairs, so that passes compare.
    """
    day = F.to_date("day", "yyyyMMdd")
    dates = observations.select(F.explode(F.array(*PAIR)).alias("day")).distinct()
    # a stack's dates: a small table
    axis = dates.select("day", (F.row_number().over(Window.orderBy("day")) - 1).alias("epoch_idx"), day.alias("date"), F.datediff(day, F.min(day).over(Window.partitionBy())).alias("day_offset"))
    used = observations.join(actions.where("action <> 'drop'").select(*PAIR, "weight"), PAIR)
    # read twice: for the reference and for all points
    values = materialise(fits.inverted(used, "point_id").withColumnRenamed("date", "day"))
    base = values.join(reference.select("point_id").distinct(), "point_id", "left_semi").groupBy("day").agg(F.avg("value").alias("_ref"))
    moved = values.join(F.broadcast(base), "day", "left").select("point_id", "day", (F.col("value") - F.coalesce("_ref", F.lit(0.0))).alias("value_mm"))
    # a row a date each: the files of the values are small too, and joined to them they would all come in one task
    return moved.join(F.broadcast(axis), "day").select("point_id", "epoch_idx", "date", "day_offset", "value_mm")


def _patch_velocities(rates: DataFrame, candidates: DataFrame) -> DataFrame:
    """Velocity figures of each candidate's patch in this pass, one row a rank."""
    v = F.col("velocity")
    q = lambda p: F.percentile(v, F.lit(p))
    return candidates.join(rates, "point_id").groupBy("rank").agg(F.median(v).alias("patch_velocity"), F.median(F.abs(v)).alias("patch_abs_velocity"), (q(0.75) - q(0.25)).alias("patch_velocity_iqr"))


def _one_pass(store: Store, name: str, observations: DataFrame, actions: DataFrame, candidates: DataFrame, rank: int, jump_mm: float) -> tuple[DataFrame, dict]:
    """Series with residuals, and the figures of the pass (one row, read by the controller)."""
    acted = store.once(f"{name}/actions", lambda: actions.select(*PAIR, "action", "weight"))
    patch = candidates.where(F.col("rank") == rank).select("point_id")
    obs = store.once(f"{name}/series", lambda: fits.model_fits(network_series(observations, acted, patch)))

    def figures() -> DataFrame:
        rates = series.trend(obs.select("point_id", "epoch_idx", "day_offset", "value_mm")).select("point_id", F.col("slope").alias("velocity"))
        found = references.evaluation(obs.drop("fit", "res"), obs.select("point_id", "epoch_idx", "fit"), obs.groupBy("point_id").agg(F.first("model_rms").alias("model_rms")), rates, jump_mm, patch=patch, rank=rank)
        velocities = _patch_velocities(rates, candidates)
        audit = references.bias_audit(velocities, rates, rank).select("patch_abs_velocity", "biased", "recommended_rank")
        kept = acted.agg(F.count_if(F.col("action") != "drop").alias("kept_pairs"), F.count(F.lit(1)).alias("pairs"))
        return found.join(audit).join(kept)

    return obs, store.once(f"{name}/figures", figures).first().asDict()


def run(
    spark: SparkSession, base: str, observations: DataFrame, first: DataFrame, points: DataFrame, candidates: DataFrame, *, jump_mm: float = 28.0, quantile: float = 0.9, stop_after: str | None = None
) -> DataFrame | None:
    """Both passes, the choice between them, and the final pairs (TS13).

    ``first`` are the pairs of the first round (``feedback.first_round``), ``points`` have ``point_id, row, col``, ``candidates`` are ``rank,
    point_id``: the points of each reference candidate's patch.  Pass 1 takes the first round's actions and candidate 1.  Its residuals
    from the chosen models flag dates, which take quality off their pairs; its evaluation and its audit may name
    another candidate.  Pass 2 runs with both and is taken if none of the five comparisons speaks against it.

    Returns a row a pass: ``pass, rank, rank_reason, kept_pairs, pairs, jump_ratio, median_rms, retained, scene_velocity, patch_abs_velocity, accepted,
    reasons``; ``base`` also gets ``pass1`` and ``pass2`` (``actions``, ``series``, ``figures``) and ``final`` (``date1, date2, action, pair_weight,
    selected_round``).  ``stop_after`` ("pass1" or "pass2") ends early and gives nothing; another run goes on from there.  Only one row a
    pass reaches the driver.
    """
    store = Store(spark, base)
    one = first.select(*PAIR, F.col("action_round1").alias("action"), F.col("weight_round1").alias("weight"))
    obs, a = _one_pass(store, "pass1", observations, one, candidates, 1, jump_mm)
    if stop_after == "pass1":
        return None

    def second() -> DataFrame:
        jump = series.residual_threshold(obs, floor_mm=jump_mm)
        dates = series.flag_dates(series.date_quality(obs, jump), quantile)
        flagged = dates.where("flagged").select("date").join(series.concentration(obs, points, jump), "date")
        return feedback.second_round(first, flagged.select(F.date_format("date", "yyyyMMdd").alias("date"), feedback.scope(F.col("concentration")).alias("scope")))

    two = store.once("pass2/quality", second)
    rank, why = 1, "keep_pass1_reference"
    if a["next_rank"] is not None:
        rank, why = a["next_rank"], "reference_abnormal_fallback"
    elif a["biased"] and a["recommended_rank"] is not None:
        rank, why = a["recommended_rank"], "reference_bias_audit"
    there = {r["rank"] for r in candidates.select("rank").distinct().orderBy("rank").limit(100).collect()}
    rank = rank if rank in there else 1
    _, b = _one_pass(store, "pass2", observations, two.select(*PAIR, F.col("action_round2").alias("action"), F.col("weight_round2").alias("weight")), candidates, rank, jump_mm)
    if stop_after == "pass2":
        return None
    keep = ("jump_ratio", "median_rms", "retained", "scene_velocity", "patch_abs_velocity")
    kind = "jump_ratio double, median_rms double, retained long, scene_velocity double, patch_abs_velocity double"
    row = lambda d: spark.createDataFrame([tuple(d[c] for c in keep)], kind)
    verdict = store.once("verdict", lambda: references.accepted(row(a), row(b))).first()
    taken = verdict.accepted_pass == "pass2"
    chosen = two if taken else two.withColumns({c: F.lit(None).cast(t) for c, t in (("action_round2", "string"), ("weight_round2", "double"))})
    store.once("final", lambda: feedback.final(chosen))
    rows = [("pass1", 1, "first_candidate", a, not taken, ""), ("pass2", rank, why, b, taken, verdict.reasons)]
    flat = [(n, r, w, int(d["kept_pairs"]), int(d["pairs"]), *[d[c] for c in keep], ok, no) for n, r, w, d, ok, no in rows]
    return spark.createDataFrame(flat, f"pass string, rank int, rank_reason string, kept_pairs long, pairs long, {kind}, accepted boolean, reasons string")
