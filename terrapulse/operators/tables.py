"""Small table shapes: pair matrix, increment audit, fallback by window, labels of dates."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Codes of the actions in a matrix.
CODES = {"keep": 2, "downweight": 1, "drop": 0}


def pair_matrix(pairs: DataFrame, dates: list[str], value: Column) -> DataFrame:
    """One row a first date, one column a second date of ``dates`` (A38).  The columns are given, so no job looks for them."""
    return pairs.groupBy("date1").pivot("date2", dates).agg(F.first(value))


def action_code(action: Column) -> Column:
    return F.coalesce(*[F.when(action == a, F.lit(c)) for a, c in CODES.items()])


def increment_audit(pairs: DataFrame, obs: DataFrame, jump: float = 28.0) -> DataFrame:
    """Of each pair the points with both ends and the share of increments over ``jump``; null where a date is absent."""
    day = F.date_format("date", "yyyyMMdd")
    end = lambda n, v: obs.select("point_id", day.alias(n), F.col("value_mm").alias(v))
    met = pairs.select("date1", "date2").join(end("date1", "_a"), "date1").join(end("date2", "_b"), ["point_id", "date2"])
    size = F.abs(F.col("_b") - F.col("_a"))
    per = met.groupBy("date1", "date2").agg(F.count(size).alias("n"), F.avg((size > jump).cast("double")).alias("jump_share"), F.median(size).alias("median_mm"))
    return pairs.select("date1", "date2").join(per, ["date1", "date2"], "left")


def window_choice(windows: DataFrame, *, ok: float = 0.99, warn: float = 0.95, fallback: str = "height_correlation") -> DataFrame:
    """The window and method that coverage allows (A9): the first if it is good or fair, else the first fair one, else the first by another method.

    ``windows`` have ``place`` (0 first), ``pad, coverage``; one row.
    """
    w = windows.withColumn("_fair", F.col("coverage") >= warn)
    first = F.min_by(F.struct("pad", "coverage"), "place")
    fair = F.min_by("pad", F.when(F.col("_fair"), F.col("place")))
    out = w.agg(first.alias("f"), fair.alias("fair"))
    share = F.col("f.coverage")
    status = F.when(share >= ok, "ok").when(share >= warn, "warn_continue").when(F.col("fair").isNotNull(), "auto_shrink_padding").otherwise(f"fallback_{fallback}")
    method = F.when(F.col("fair").isNotNull(), "delay_grid").otherwise(fallback)
    return out.select(F.when(share >= warn, F.col("f.pad")).otherwise(F.coalesce("fair", "f.pad")).alias("pad"), method.alias("method"), status.alias("status"))


def top_of_array(values: Column, k: int) -> Column:
    """The ``k`` largest values of an array with their places, ties to the earlier place."""
    placed = F.transform(values, lambda x, i: F.struct((-x).alias("n"), i.alias("i"), x.alias("value")))
    return F.transform(F.slice(F.array_sort(placed), 1, k), lambda y: F.struct(y["i"].alias("i"), y["value"].alias("value")))


def design_row(day: Column) -> Column:
    """1, t, sin and cos of the year, t in years."""
    t = day / 365.25
    return F.array(F.lit(1.0), t, F.sin(2 * math.pi * t), F.cos(2 * math.pi * t))


def date_string(text: Column) -> Column:
    """YYYYMMDD of an ISO or a compact date at the head of ``text``; null where there is none."""
    digits = F.regexp_replace(F.regexp_extract(text, r"^\s*(\d{4}-?\d{2}-?\d{2})", 1), "-", "")
    return F.when(F.length(digits) == 8, digits)


def period_label(first: Column, last: Column) -> Column:
    """From and to as text, once if they are equal (F16)."""
    label = lambda d: F.date_format(d, "yyyy-MM-dd")
    return F.when(first == last, label(first)).otherwise(F.concat(label(first), F.lit(" to "), label(last)))


def best_points(points: DataFrame, by: str, n: int = 6) -> DataFrame:
    """The ``n`` points with the highest confidence, ties to the smaller id."""
    return points.orderBy(F.desc(F.round(by, 9)), "point_id").limit(n)
