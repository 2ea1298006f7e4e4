"""Quantile forecasts fitted by distributed sums, and the choice between two variants."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrapulse.operators.learned import _finite
from terrapulse.operators.panel import _KEPT
from terrapulse.session import materialise

LEVELS = (0.1, 0.5, 0.9)
# How much worse the coverage of the variant with neighbours may be, and how much better its error must be.
WORSE_COVERAGE, BETTER_ERROR = 0.05, 0.98
TARGET_COVERAGE = 0.8


def inputs(channels: tuple[str, ...], statics: tuple[str, ...]) -> Column:
    """The flattened history and the static columns of a window as one array; what is no number counts as 0."""
    history = F.flatten(F.transform("history", lambda x: F.array(*[_finite(x[c]) for c in channels]))) if channels else F.array().cast("array<double>")
    return F.concat(history, F.array(*[_finite(F.col(c)) for c in statics])) if statics else history


def _added(df: DataFrame, make) -> np.ndarray:
    """Sum over all rows of what ``make(x, y)`` gives for a batch: one array, whose size depends on the model only."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                x, y = (np.asarray(batch.column(c).flatten(), float).reshape(batch.num_rows, -1) for c in ("x", "y"))
                part = make(x, y)
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], ["i", "v"])

    summed = df.mapInArrow(run, "i long, v double").groupBy("i").agg(F.sum("v").alias("v")).toArrow()
    out = np.zeros(summed.num_rows)
    out[summed.column("i").to_numpy()] = summed.column("v").to_numpy()
    return out


class QuantileForecaster:
    """For each level and step ahead a linear function of a window that has this share of the targets below it (FC17).

    The pinball loss is fitted by a majorising square: |r| lies under r^2 / 2(e + |r0|) + const, so each round is a weighted least
    squares fit, whose normal equations are sums over the windows.  A round is one pass over them; only those sums, whose
    size follows the inputs, levels and steps, reach the driver.  All windows are learned from.  Inputs are centred and scaled first; e
    falls by half each round.  ``channels`` are fields of the history, ``statics`` further columns.
    """

    def __init__(self, channels: tuple[str, ...], statics: tuple[str, ...] = (), *, levels: tuple[float, ...] = LEVELS, rounds: int = 30, ridge: float = 1e-6):
        self.channels, self.statics, self.levels, self.rounds, self.ridge = channels, statics, levels, rounds, ridge

    def fit(self, train: DataFrame, horizon: int) -> QuantileForecaster:
        data = materialise(train.select(inputs(self.channels, self.statics).alias("x"), F.transform(F.slice("targets", 1, horizon), lambda y: y.cast("double")).alias("y")).where(F.forall("y", lambda y: y.isNotNull() & ~F.isnan(y))))
        m = _added(data, lambda x, y: np.concatenate([[len(x)], x.sum(0), (x * x).sum(0), y.sum(0), (y * y).sum(0)]))
        if not len(m):
            raise ValueError("no window to learn from")
        n, rest = m[0], m[1:]
        p = (len(rest) - 2 * horizon) // 2
        mean, y_mean = rest[:p] / n, rest[2 * p : 2 * p + horizon] / n
        spread = lambda squares, centre: np.sqrt(np.maximum(squares / n - centre * centre, 0.0))
        scale, y_scale = spread(rest[p : 2 * p], mean), np.maximum(spread(rest[2 * p + horizon :], y_mean), 1e-9)
        scale = np.where(scale > 1e-9, scale, 1.0)
        levels = np.array(self.levels)
        beta = np.zeros((len(levels), horizon, p + 1))
        low = np.tril_indices(p + 1)

        def sums(beta: np.ndarray, e: float | None):
            def make(x: np.ndarray, y: np.ndarray) -> np.ndarray:
                x, y = np.column_stack([np.ones(len(x)), (x - mean) / scale]), (y - y_mean) / y_scale
                out = [x.sum(0)]
                for q in range(len(levels)):
                    for h in range(horizon):
                        w = np.full(len(x), 0.5) if e is None else 0.5 / (e + np.abs(y[:, h] - x @ beta[q, h]))
                        wx = x * w[:, None]
                        out += [(x.T @ wx)[low], wx.T @ y[:, h]]
                return np.concatenate(out)

            return make

        for k in range(self.rounds):
            got = _added(data, sums(beta, None if k == 0 else max(1e-4, 0.5**k)))
            ones, at = got[: p + 1], p + 1
            for q in range(len(levels)):
                for h in range(horizon):
                    a = np.zeros((p + 1, p + 1))
                    a[low] = got[at : at + len(low[0])]
                    a = a + a.T - np.diag(np.diag(a))
                    at += len(low[0])
                    b = got[at : at + p + 1] + (levels[q] - 0.5) * ones
                    at += p + 1
                    beta[q, h] = np.linalg.solve(a + self.ridge * n * np.eye(p + 1), b)
        slope = beta[:, :, 1:] * y_scale[None, :, None] / scale
        self.slopes, self.cuts = slope, beta[:, :, 0] * y_scale + y_mean - slope @ mean
        return self

    def predict(self, found: DataFrame) -> DataFrame:
        """Windows with ``method`` and ``p10, p50, p90``, sorted so that they do not cross."""
        dot = lambda b, c: F.aggregate(F.zip_with("_x", F.array(*[F.lit(float(v)) for v in b]), lambda u, v: u * v), F.lit(float(c)), lambda s, v: s + v)
        steps = [F.array_sort(F.array(*[dot(self.slopes[q, h], self.cuts[q, h]) for q in range(len(self.levels))])) for h in range(self.slopes.shape[1])]
        kept = [c for c in _KEPT if c in found.columns]
        df = found.withColumn("_x", inputs(self.channels, self.statics)).withColumn("_q", F.array(*steps))
        of = lambda q: F.transform("_q", lambda x: F.get(x, F.lit(q)))
        return df.select(*kept, F.lit("learned_quantiles").alias("method"), *[of(q).alias(f"p{round(100 * level)}") for q, level in enumerate(self.levels)])


def flat(predicted: DataFrame) -> DataFrame:
    """One row a window and step ahead, as the scores and the calibration take them."""
    rows = predicted.select("point_id", "window_end", "split", "event", "last_rel0", "method", F.posexplode(F.arrays_zip("targets", "p10", "p50", "p90")).alias("i", "s"))
    return rows.select(*[c for c in rows.columns if c not in ("i", "s")], (F.col("i") + 1).alias("h"), F.col("s.targets").alias("target"), *[F.col(f"s.{q}").alias(q) for q in ("p10", "p50", "p90")])


def with_neighbours(found: DataFrame, edges: DataFrame, *, value: str = "rel0") -> DataFrame:
    """Windows with ``near_mean, near_slope, near_count``: what the neighbours' histories (FC6) do, read at the same window end.

    ``edges`` are ``src, dst``; a window without a complete neighbour gets zeros.
    """
    pool = found.select(F.col("point_id").alias("dst"), "window_end", (F.element_at("history", -1)[value] - F.get("history", 0)[value]).alias("_rise"), "last_rel0").distinct()
    near = edges.select(F.col("src").alias("point_id"), "dst").join(pool, "dst").groupBy("point_id", "window_end")
    near = near.agg(F.avg("last_rel0").alias("near_mean"), F.avg("_rise").alias("near_slope"), F.count(F.lit(1)).cast("double").alias("near_count"))
    df = found.join(near, ["point_id", "window_end"], "left")
    return df.withColumns({c: F.coalesce(c, F.lit(0.0)) for c in ("near_mean", "near_slope", "near_count")})


NEAR = ("near_mean", "near_slope", "near_count")


def chosen_variant(plain: DataFrame, near: DataFrame, reasons: str = "") -> DataFrame:
    """``variant, reason, plain_rmse, near_rmse, plain_coverage_error, near_coverage_error`` (FC19): one row.

    ``plain`` and ``near`` are :func:`flat` predictions of the same validation windows; ``reasons`` are those of the gate (G13), any of which
    keeps the plain variant.  The variant with neighbours is taken if its error is 2 % less and its share of targets
    within the band is not further from 0.8 by more than 0.05.
    """

    def figures(df: DataFrame, name: str) -> DataFrame:
        inside = F.avg(F.col("target").between(F.col("p10"), F.col("p90")).cast("double"))
        gap = F.col("p50") - F.col("target")
        return df.agg(F.sqrt(F.avg(gap * gap)).alias(f"{name}_rmse"), F.abs(inside - TARGET_COVERAGE).alias(f"{name}_coverage_error"))

    both = figures(plain, "plain").join(figures(near, "near"))
    worse = F.col("near_coverage_error") > F.col("plain_coverage_error") + WORSE_COVERAGE
    better = F.col("near_rmse") <= F.col("plain_rmse") * BETTER_ERROR
    why = F.when(F.lit(bool(reasons)), F.lit(reasons)).when(F.coalesce(worse, F.lit(True)), "coverage_error_worse").when(better, "validation_error_improved_by_2pct").otherwise("validation_error_more_stable")
    taken = F.lit(not reasons) & F.coalesce(~worse & better, F.lit(False))
    return both.select(F.when(taken, "neighbours").otherwise("plain").alias("variant"), why.alias("reason"), "plain_rmse", "near_rmse", "plain_coverage_error", "near_coverage_error")
