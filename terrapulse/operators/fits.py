"""Least-squares fits of series, as windows over a point's epochs, and network inversion (TS9).

Columns of a model are made orthogonal one after another (constant, line, then what is left of a wave or a hinge), so a
fit is a few sums over the point and needs no solver.  A hinge at any epoch is judged from running sums of the line's
residuals, all breaks of a point at once.  Points with different gaps are nothing special.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

YEAR = 365.25
#: The models in the order in which ties are settled, their numbers of parameters, and the least mean square in BIC.
MODELS = ("linear", "linear_annual", "piecewise")
PARAMETERS = (2, 4, 3)
FLOOR = 1e-6
#: A column of which less than this share is left is taken as a sum of the ones before it.
NOTHING = 1e-12


def design(days: np.ndarray) -> np.ndarray:
    """One row a day: 1, t, and sine and cosine of the year, with t in years."""
    turn = np.asarray(days, float) / YEAR
    return np.column_stack([turn**0, turn, np.sin(2 * np.pi * turn), np.cos(2 * np.pi * turn)])


def bic(sse: Column, n: Column, k: int) -> Column:
    """Bayesian information criterion; the mean square counts as ``FLOOR`` at least (TS2)."""
    return n * F.log(F.greatest(sse / n, F.lit(FLOOR))) + k * F.log(n)


def _over(top: str, bottom: str, whole: str | None = None) -> Column:
    """``top / bottom``, or 0 where next to nothing of ``whole`` is left in ``bottom``."""
    least = F.lit(0.0) if whole is None else NOTHING * F.col(whole)
    return F.when(F.col(bottom) > least, F.col(top) / F.col(bottom)).otherwise(0.0)


def known(obs: DataFrame) -> DataFrame:
    """Observations that have a value, with ``_t`` in years and the annual wave ``_s, _c``."""
    t = F.col("day_offset") / YEAR
    df = obs.where(F.col("value_mm").isNotNull() & ~F.isnan("value_mm"))
    return df.withColumns({"_t": t, "_s": F.sin(2 * F.pi() * t), "_c": F.cos(2 * F.pi() * t), "_y": F.col("value_mm").cast("double")})


def _orthogonal(df: DataFrame, weight: Column) -> DataFrame:
    """Adds, of each point, the line's residual ``_r`` and what is left of the wave after constant and line, with their sums."""
    w = Window.partitionBy("point_id")
    total = lambda x: F.sum(weight * x).over(w)
    df = df.withColumn("_w", total(F.lit(1.0)))
    df = df.withColumns({f"_m{c}": total(F.col(f"_{c}")) / F.col("_w") for c in "tysc"})
    df = df.withColumns({f"_d{c}": F.col(f"_{c}") - F.col(f"_m{c}") for c in "tysc"})
    dot = lambda a, b: total(F.col(a) * F.col(b))
    df = df.withColumns({"_tt": dot("_dt", "_dt"), "_ty": dot("_dt", "_dy"), "_ts": dot("_dt", "_ds"), "_tc": dot("_dt", "_dc"), "_s0": dot("_ds", "_ds"), "_c0": dot("_dc", "_dc")})
    df = df.withColumns({"_b": _over("_ty", "_tt"), "_ks": _over("_ts", "_tt"), "_kc": _over("_tc", "_tt")})
    df = df.withColumns({"_r": F.col("_dy") - F.col("_b") * F.col("_dt"), "_s1": F.col("_ds") - F.col("_ks") * F.col("_dt"), "_c1": F.col("_dc") - F.col("_kc") * F.col("_dt")})
    df = df.withColumns({"_line": dot("_r", "_r"), "_ss": dot("_s1", "_s1"), "_sr": dot("_s1", "_r"), "_sc": dot("_s1", "_c1")})
    df = df.withColumns({"_alpha": _over("_sr", "_ss", "_s0"), "_rho": _over("_sc", "_ss", "_s0")})
    df = df.withColumn("_c2", F.col("_c1") - F.col("_rho") * F.col("_s1"))
    df = df.withColumns({"_cc": dot("_c2", "_c2"), "_cr": dot("_c2", "_r")})
    return df.withColumn("_beta", _over("_cr", "_cc", "_c0"))


def _coefficients() -> tuple[Column, Column, Column, Column]:
    """Value at the mean time and slope of the line beside the wave, and those of sine and cosine."""
    sine, cosine = F.col("_alpha") - F.col("_beta") * F.col("_rho"), F.col("_beta")
    return F.col("_my") - sine * F.col("_ms") - cosine * F.col("_mc"), F.col("_b") - sine * F.col("_ks") - cosine * F.col("_kc"), sine, cosine


def least_squares(obs: DataFrame, *, annual: bool = False) -> DataFrame:
    """``point_id, n, coefficients, sse`` of the same model for every point (TS1).

    Coefficients are of 1, t and, if ``annual``, sine and cosine of the year, with t in years (F7).  A column that the
    earlier ones already hold (a point with one epoch has no slope) gets 0.
    """
    df = _orthogonal(known(obs), F.lit(1.0))
    if annual:
        level, slope, sine, cosine = _coefficients()
        values = F.array(level - slope * F.col("_mt"), slope, sine, cosine)
        sse = F.col("_line") - F.col("_alpha") * F.col("_sr") - F.col("_beta") * F.col("_cr")
    else:
        values, sse = F.array(F.col("_my") - F.col("_b") * F.col("_mt"), F.col("_b")), F.col("_line")
    return df.groupBy("point_id").agg(F.count(F.lit(1)).cast("int").alias("n"), F.first(values).alias("coefficients"), F.greatest(F.first(sse), F.lit(0.0)).alias("sse"))


def _chosen(obs: DataFrame) -> DataFrame:
    """Observations with the sums of their point and ``_best`` (1, 2 or 3), ``delta_bic`` and ``_break``."""
    whole = Window.partitionBy("point_id")
    order = whole.orderBy("epoch_idx")
    behind = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    df = _orthogonal(known(obs), F.lit(1.0)).withColumns({"_n": F.count(F.lit(1)).over(whole), "_i": F.row_number().over(order) - 1})
    # sums over the epochs from a break on; a hinge there is h = t - t_break, and 0 before it
    df = df.withColumns({
        "_qn": F.count(F.lit(1)).over(behind), "_qt": F.sum("_dt").over(behind), "_qtt": F.sum(F.col("_dt") * F.col("_dt")).over(behind),
        "_qr": F.sum("_r").over(behind), "_qrt": F.sum(F.col("_r") * F.col("_dt")).over(behind),
    })
    d, n = F.col("_dt"), F.col("_n")
    df = df.withColumns({
        "_hr": F.col("_qrt") - d * F.col("_qr"), "_h": F.col("_qt") - d * F.col("_qn"), "_ht": F.col("_qtt") - d * F.col("_qt"),
        "_h0": F.col("_qtt") - 2 * d * F.col("_qt") + d * d * F.col("_qn"),
    })
    rest = F.col("_h0") - F.col("_h") * F.col("_h") / n - F.when(F.col("_tt") > 0, F.col("_ht") * F.col("_ht") / F.col("_tt")).otherwise(0.0)
    df = df.withColumns({"_eta": _over("_ht", "_tt"), "_hh": rest}).withColumn("_delta", _over("_hr", "_hh", "_h0"))
    left = F.greatest(F.col("_line") - F.col("_delta") * F.col("_hr"), F.lit(0.0))
    tried = (n >= 5) & (F.col("_i") >= 3) & (F.col("_i") < F.greatest(F.lit(4), n - 3))
    at = F.struct(F.round(bic(left, n, PARAMETERS[2]), 6).alias("bic"), F.col("_i").alias("i"), d.alias("d"), F.col("_delta").alias("delta"), (F.col("_h") / n).alias("mean"), F.col("_eta").alias("eta"))
    df = df.withColumn("_break", F.min(F.when(tried, at)).over(whole))
    wave = F.greatest(F.col("_line") - F.col("_alpha") * F.col("_sr") - F.col("_beta") * F.col("_cr"), F.lit(0.0))
    df = df.withColumn("_bics", F.array(F.round(bic(F.col("_line"), n, PARAMETERS[0]), 6), F.round(bic(wave, n, PARAMETERS[1]), 6), F.col("_break.bic")))
    ranked = F.array_sort(F.array_compact("_bics"))
    return df.withColumns({"_best": F.array_position("_bics", F.array_min("_bics")).cast("int"), "delta_bic": F.get(ranked, 1) - F.get(ranked, 0)})


def _named() -> dict[str, Column]:
    three = F.col("_best") == 3
    return {"model": F.get(F.array(*map(F.lit, MODELS)), F.col("_best") - 1), "break_idx": F.when(three, F.col("_break.i")).otherwise(-1).cast("int")}


def model_fits(obs: DataFrame) -> DataFrame:
    """Observations with ``fit, res, model, break_idx, delta_bic, model_rms`` of their point's best model (TS3).

    Of a line, a line with an annual wave and two lines that meet, the one with the least BIC; ``delta_bic`` is how far the
    next one is.  Breaks are tried from the fourth epoch to the fourth from the end, at the fourth at least; ties (to six
    places) go to the simpler model and the earlier break.  Points with fewer than five epochs have no break and only
    the first two models.  ``break_idx`` counts the epochs that have a value, from 0; it is -1 for the other models.
    Rows without a value are left out.  One shuffle by point; a point's epochs, not the points, meet in one task.
    """
    df, d = _chosen(obs), F.col("_dt")
    line = F.col("_my") + F.col("_b") * d
    hinge = F.greatest(d - F.col("_break.d"), F.lit(0.0)) - F.col("_break.mean") - F.col("_break.eta") * d
    fits = F.array(line, line + F.col("_alpha") * F.col("_s1") + F.col("_beta") * F.col("_c2"), line + F.col("_break.delta") * hinge)
    df = df.withColumn("fit", F.get(fits, F.col("_best") - 1)).withColumns({"res": F.col("_y") - F.col("fit"), **_named()})
    df = df.withColumn("model_rms", F.sqrt(F.avg(F.col("res") * F.col("res")).over(Window.partitionBy("point_id"))))
    return df.select(*obs.columns, "fit", "res", "model", "break_idx", "delta_bic", "model_rms")


def models(obs: DataFrame) -> DataFrame:
    """One row a point: ``model, origin, cut, slope, sine, cosine, hinge, hinge_at``, to be read at any date by :func:`predicted`."""
    df = _chosen(obs).withColumns(_named())
    level, slope, sine, cosine = _coefficients()
    wave, bent = F.col("_best") == 2, F.col("_best") == 3
    none = F.lit(0.0)
    bend = F.when(bent, F.col("_break.delta")).otherwise(none)
    rate = F.when(wave, slope).otherwise(F.col("_b") - F.coalesce(bend * F.col("_break.eta"), none))
    mean = F.when(wave, level).otherwise(F.col("_my") - F.coalesce(bend * F.col("_break.mean"), none))
    found = {
        "model": F.col("model"), "origin": F.date_sub("date", F.col("day_offset").cast("int")), "cut": mean - rate * F.col("_mt"), "slope": rate, "sine": F.when(wave, sine).otherwise(none),
        "cosine": F.when(wave, cosine).otherwise(none), "hinge": bend, "hinge_at": F.coalesce(F.col("_break.d") + F.col("_mt"), none),
    }
    return df.groupBy("point_id").agg(*[F.first(c).alias(n) for n, c in found.items()])


def predicted(day: Column) -> Column:
    """Value of a model of :func:`models` at a date."""
    t = F.datediff(day, F.col("origin")) / YEAR
    wave = F.col("sine") * F.sin(2 * F.pi() * t) + F.col("cosine") * F.cos(2 * F.pi() * t)
    return F.col("cut") + F.col("slope") * t + wave + F.col("hinge") * F.greatest(t - F.col("hinge_at"), F.lit(0.0))


def chosen_model(obs: DataFrame) -> DataFrame:
    """``point_id, model, break_idx, delta_bic, model_rms, epochs, fitted`` of the models of :func:`model_fits` (TS3)."""
    pair = F.sort_array(F.collect_list(F.struct("epoch_idx", "fit")))
    out = model_fits(obs).groupBy("point_id").agg(*[F.first(c).alias(c) for c in ("model", "break_idx", "delta_bic", "model_rms")], pair.alias("_x"))
    return out.withColumns({"epochs": F.transform("_x", lambda x: x["epoch_idx"]), "fitted": F.transform("_x", lambda x: x["fit"])}).drop("_x")


def fitted_long(models: DataFrame) -> DataFrame:
    """``point_id, epoch_idx, fit`` of the chosen models."""
    return models.select("point_id", F.inline(F.arrays_zip(F.col("epochs").alias("epoch_idx"), F.col("fitted").alias("fit"))))


def robust_harmonic(obs: DataFrame, *, fit_until: int | None = None) -> DataFrame:
    """``point_id, epoch_idx, trend, seasonal, residual``: a line and an annual wave, fitted twice (TS7).

    In the second fit, residuals beyond 1.5 times their median size weigh as much less as they are larger; a median of under
    0.001 mm counts as 1.  With ``fit_until`` only epochs up to that index are fitted and the later ones extrapolated, so
    that a forecast does not see its future.  A point without an epoch to fit gets nulls.
    """
    seen = F.lit(1.0) if fit_until is None else (F.col("epoch_idx") <= fit_until).cast("double")
    whole = Window.partitionBy("point_id")
    df = known(obs).select("point_id", "epoch_idx", "_t", "_y", "_s", "_c", seen.alias("_seen"))
    first = _orthogonal(df, F.col("_seen"))
    off = F.abs(F.col("_r") - F.col("_alpha") * F.col("_s1") - F.col("_beta") * F.col("_c2"))
    first = first.select(*df.columns, off.alias("_off")).withColumn("_scale", F.median(F.when(F.col("_seen") > 0, F.col("_off"))).over(whole))
    limit = 1.5 * F.when(F.col("_scale") > 1e-3, F.col("_scale")).otherwise(1.0)
    again = first.withColumn("_weight", F.col("_seen") / F.greatest(F.lit(1.0), F.col("_off") / limit))
    again = _orthogonal(again, F.col("_weight"))
    level, slope, sine, cosine = _coefficients()
    trend, seasonal = level + slope * F.col("_dt"), sine * F.col("_s") + cosine * F.col("_c")
    out = again.select("point_id", "epoch_idx", trend.alias("trend"), seasonal.alias("seasonal"), "_y")
    return out.select("point_id", "epoch_idx", "trend", "seasonal", (F.col("_y") - F.col("trend") - F.col("seasonal")).alias("residual"))


def inverted(pairs: DataFrame, key: str, *, reference: str | None = None) -> DataFrame:
    """``key, date, value``: values of dates from differences of pairs, the reference date at 0 (TS9).

    ``pairs`` has the key, ``date1, date2, value`` and may have ``weight``; a pair without a value or with weight 0 is left
    out.  The reference is the given date, or the key's first.  Dates that no chain of pairs joins to it get the solution
    of least norm.  The pairs of a key are one row of arrays; keys of a
    batch that have the same pairs and weights are solved together, as so many right-hand sides of one system.
    """
    weight = F.col("weight") if "weight" in pairs.columns else F.lit(1.0)
    known = pairs.where(F.col("value").isNotNull() & (weight > 0))
    rows = known.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("date1", "date2", F.col("value").cast("double").alias("v"), weight.cast("double").alias("w")))).alias("x"))
    part = lambda c: F.transform("x", lambda r: r[c]).alias(c)
    kind = pairs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            size = pc.list_value_length(batch.column("date1")).to_numpy(zero_copy_only=False).astype(np.int64)
            first = np.cumsum(size) - size
            ends = [batch.column(c).flatten() for c in ("date1", "date2")]
            coded = pa.concat_arrays(ends).dictionary_encode()
            names, code = np.unique(np.array(coded.dictionary.to_pylist(), object), return_inverse=True)
            one, two = np.split(code[coded.indices.to_numpy()], 2)
            value, root = batch.column("v").flatten().to_numpy(), np.sqrt(batch.column("w").flatten().to_numpy())
            alike: dict[tuple[bytes, ...], list[int]] = {}
            for i in range(batch.num_rows):
                own = slice(first[i], first[i] + size[i])
                alike.setdefault((one[own].tobytes(), two[own].tobytes(), root[own].tobytes()), []).append(i)
            for members in alike.values():
                n, own = size[members[0]], slice(first[members[0]], first[members[0]] + size[members[0]])
                days, at = np.unique(np.concatenate([one[own], two[own]]), return_inverse=True)
                a = np.zeros((n, len(days)))
                a[np.arange(n), at[n:]] += 1.0
                a[np.arange(n), at[:n]] -= 1.0
                dates = names[days]
                fixed = int(np.flatnonzero(dates == reference)[0]) if reference in dates else 0
                free = np.arange(len(days)) != fixed
                wanted = value[first[members][:, None] + np.arange(n)] * root[own]
                values = np.zeros((len(members), len(days)))
                values[:, free] = np.linalg.lstsq(a[:, free] * root[own][:, None], wanted.T, rcond=None)[0].T
                keys = batch.column(key).take(pa.array(np.repeat(members, len(days))))
                yield pa.RecordBatch.from_arrays([keys, pa.array(np.tile(dates, len(members)), pa.string()), pa.array(values.ravel())], names=[key, "date", "value"])

    return rows.select(key, *[part(c) for c in ("date1", "date2", "v", "w")]).mapInArrow(run, f"{key} {kind}, date string, value double")
