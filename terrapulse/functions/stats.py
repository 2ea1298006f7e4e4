"""Statistics over all rows that every row needs, as one-row aggregates joined back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrapulse.functions.scalars import clip


def with_stats(df: DataFrame, **stats) -> DataFrame:
    """``df`` with one-row aggregates as columns; the row is broadcast, ``df`` is not shuffled."""
    return df.join(F.broadcast(df.agg(*[e.alias(n) for n, e in stats.items()])))


def minmax(df: DataFrame, *cols: str, **named: str) -> DataFrame:
    """Columns over their range, in [0, 1]; a constant or missing value gives 0.

    ``minmax(df, "x", "out")`` or ``minmax(df, out="x", out2="y")``: the statistics of all columns are one aggregate, so ``df``
    is read twice however many columns there are.
    """
    return _scaled(df, _named(cols, named), lambda x: (F.min(x), F.max(x)))


def robust_range(df: DataFrame, *cols: str, low: float = 0.05, high: float = 0.95, **named: str) -> DataFrame:
    """Columns over the range of their 5th and 95th percentile, in [0, 1]; a missing value gives 0.  Called like :func:`minmax`."""
    named = _named(cols, named)
    ends = {f"_{k}_{out}": (F.col(c), p) for out, c in named.items() for k, p in (("lo", low), ("hi", high))}
    return _shares(with_quantiles(df, **ends), named)


def _named(cols: tuple[str, ...], named: dict[str, str]) -> dict[str, str]:
    return {cols[1]: cols[0]} if cols else named


def _scaled(df: DataFrame, named: dict[str, str], ends) -> DataFrame:
    pairs = {out: ends(F.col(c)) for out, c in named.items()}
    return _shares(with_stats(df, **{f"_{k}_{out}": e for out, p in pairs.items() for k, e in zip(("lo", "hi"), p, strict=True)}), named)


def _shares(df: DataFrame, named: dict[str, str]) -> DataFrame:
    share = lambda out, c: F.try_divide(F.col(c) - F.col(f"_lo_{out}"), F.col(f"_hi_{out}") - F.col(f"_lo_{out}"))
    df = df.withColumns({out: F.coalesce(clip(share(out, c), 0.0, 1.0), F.lit(0.0)) for out, c in named.items()})
    return df.drop(*[f"_{k}_{out}" for out in named for k in ("lo", "hi")])


def robust_z(df: DataFrame, *cols: str, **named: str) -> DataFrame:
    """Deviations from the median in scaled median deviations, held within [-5, 8]; a missing value gives 0.  Called like :func:`minmax`."""
    named = _named(cols, named)
    df = with_quantiles(df, **{f"_med_{out}": (F.col(c), 0.5) for out, c in named.items()})
    df = with_quantiles(df, **{f"_mad_{out}": (F.abs(F.col(c) - F.col(f"_med_{out}")), 0.5) for out, c in named.items()})
    z = lambda out, c: (F.col(c) - F.col(f"_med_{out}")) / F.greatest(1.4826 * F.col(f"_mad_{out}"), F.lit(1e-3))
    df = df.withColumns({out: F.coalesce(clip(z(out, c), -5.0, 8.0), F.lit(0.0)) for out, c in named.items()})
    return df.drop(*[f"_{k}_{out}" for out in named for k in ("med", "mad")])


def quantiles(df: DataFrame, *keys: str, accuracy: int = 4096, **wanted: tuple[Column, float]) -> DataFrame:
    """Exact quantiles ``out=(column, share)`` of each group, interpolated between neighbours, as ``percentile`` gives them.

    A sketch of bounded size brackets each of them by two values; it is off by no more than a share 1 / ``accuracy`` of the rows, and the
    bracket is twice as wide.  Of the second pass only values inside their bracket are dealt out, equal ones as one row with
    their count; all below it are one count a task.  So ``df`` is read twice, whatever the number of quantiles, and no buffer holds
    more than the sketch.  A group without values gives null; without keys there is one row.
    """
    keys, names = list(keys), list(wanted)
    df = df.select(*keys, *[c.cast("double").alias(n) for n, (c, _) in wanted.items()])
    off = 2.0 / accuracy
    near = lambda n, p: F.percentile_approx(n, [max(0.0, p - off), min(1.0, p + off)], accuracy)
    ends = df.groupBy(*keys).agg(*[near(n, p).alias(f"_e_{n}") for n, (_, p) in wanted.items()], *[F.count(n).alias(f"_n_{n}") for n in names])
    # ends are open where the bracket reaches the first or the last value, and in groups in which a bracket may hold less than two values
    few = lambda n: F.col(f"_n_{n}") <= 16 * accuracy
    low = lambda n: F.lit(float("-inf")) if wanted[n][1] - off <= 0 else F.when(few(n), float("-inf")).otherwise(F.get(f"_e_{n}", F.lit(0)))
    high = lambda n: F.lit(float("nan")) if wanted[n][1] + off >= 1 else F.when(few(n), float("nan")).otherwise(F.get(f"_e_{n}", F.lit(1)))
    ends = ends.select(*keys, F.explode(F.array(*[F.struct(F.lit(k).alias("q"), F.col(f"_n_{n}").alias("n"), low(n).alias("lo"), high(n).alias("hi"), F.lit(wanted[n][1]).alias("p")) for k, n in enumerate(names)])).alias("_end")).select(*keys, "_end.*")
    flat = df.select(*keys, F.posexplode(F.array(*names)).alias("q", "v")).where("v IS NOT NULL")
    met = flat.join(F.broadcast(ends) if not keys else ends, [*keys, "q"])
    met = met.where(F.col("v") <= F.col("hi")).withColumn("v", F.when(F.col("v") >= F.col("lo"), F.col("v")))
    counts = met.groupBy(*keys, "q", "n", "p", "v").agg(F.count(F.lit(1)).alias("_c"))
    order = Window.partitionBy(*keys, "q").orderBy(F.col("v").asc_nulls_first())
    ranked = counts.withColumn("_end", F.sum("_c").over(order))
    at = (F.col("n") - 1) * F.col("p")
    place = lambda k: F.min(F.when((F.col("_end") > k) & F.col("v").isNotNull(), F.col("v")))
    picked = ranked.groupBy(*keys, "q").agg(place(F.floor(at)).alias("_a"), place(F.least(F.floor(at) + 1, F.col("n") - 1)).alias("_b"), F.first(at - F.floor(at)).alias("_f"))
    value = F.col("_a") + F.when(F.col("_f") > 0, (F.col("_b") - F.col("_a")) * F.col("_f")).otherwise(0.0)
    out = picked.groupBy(*keys).agg(*[F.max(F.when(F.col("q") == k, value)).alias(n) for k, n in enumerate(names)])
    return df.select(*keys).distinct().join(out, keys, "left") if keys else out


def with_quantiles(df: DataFrame, **wanted: tuple[Column, float]) -> DataFrame:
    """``df`` with exact :func:`quantiles` of all rows as columns; the row is broadcast, ``df`` is not shuffled."""
    return df.join(F.broadcast(quantiles(df, **wanted)))


def order_statistic(df: DataFrame, keys: list[str], value: str, position, cuts: int = 200) -> DataFrame:
    """The ``position``-th smallest ``value`` (from 1; an expression of the group's row count ``_n``) of each of a few groups.

    Equal values are counted first, so a value that most rows share is one row.  Approximate cuts deal the values of a
    group into buckets, whose counts tell which bucket holds the position; only that one is ranked.
    """
    counts = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_c"))
    cut = counts.groupBy(*keys).agg(F.percentile_approx(value, [i / cuts for i in range(1, cuts)]).alias("_cuts"), F.sum("_c").alias("_n"))
    placed = counts.join(cut, keys).withColumn("_at", position).withColumn("_b", F.size(F.filter("_cuts", lambda c: c < F.col(value)))).drop("_cuts")
    sizes = placed.groupBy(*keys, "_at", "_b").agg(F.sum("_c").alias("_size"))
    sizes = sizes.withColumn("_end", F.sum("_size").over(Window.partitionBy(*keys).orderBy("_b")))
    hit = sizes.where((F.col("_at") <= F.col("_end")) & (F.col("_at") > F.col("_end") - F.col("_size"))).select(*keys, "_b", (F.col("_end") - F.col("_size")).alias("_before"))
    inside = placed.join(hit, [*keys, "_b"])
    rank = F.col("_before") + F.sum("_c").over(Window.partitionBy(*keys).orderBy(value))
    return inside.withColumn("_r", rank).where(F.col("_r") >= F.col("_at")).groupBy(*keys).agg(F.min(value).alias(value))
