"""Neighbourhood operators on pixel tables (row, col): window sums, gradients, morphology, labels."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrapulse.functions.stats import quantiles
from terrapulse.operators.components import contracted
from terrapulse.session import materialise

CELL = ["row", "col"]
#: Rows and columns of a tile: the cells that a task labels at once.
TILE = 256
#: Cells that a task makes: the rows that they are made of are few, and would come in one task.
CELLS = 200_000
EIGHT = [(i, j) for i in (-1, 0, 1) for j in (-1, 0, 1) if i or j]
FOUR = [(i, j) for i, j in EIGHT if not i or not j]


def lattice(grid: DataFrame, value: str) -> DataFrame:
    """Every cell from (0, 0) to the largest row and column, with ``value`` null where ``grid`` has no such cell; ``_h`` and ``_w`` are these two."""
    spark, kinds = grid.sparkSession, dict(grid.dtypes)
    high, wide = grid.agg(F.max("row"), F.max("col")).first()
    n = 0 if high is None or wide is None else (high + 1) * (wide + 1)
    at = spark.range(0, n, 1, max(1, -(-n // CELLS)))
    cells = at.select(F.expr(f"id div {(wide or 0) + 1}").cast(kinds["row"]).alias("row"), (F.col("id") % ((wide or 0) + 1)).cast(kinds["col"]).alias("col"))
    cells = cells.withColumns({"_h": F.lit(high).cast(kinds["row"]), "_w": F.lit(wide).cast(kinds["col"])})
    return cells.join(grid.select(*CELL, value), CELL, "left")


def _sums(df: DataFrame, names: list[str], along: str, across: str, last: str, half: int, replicate: bool) -> DataFrame:
    """Sums of ``names`` over ``half`` cells to both sides; border cells stand in for those beyond it if ``replicate``."""
    if replicate:
        at = F.col(along)
        copies = F.sequence(F.when(at == 0, F.lit(-half)).otherwise(at), F.when(at == F.col(last), at + half).otherwise(at))
        df = df.withColumn(along, F.explode(copies))
    frame = Window.partitionBy(across).orderBy(along).rangeBetween(-half, half)
    df = df.withColumns({n: F.sum(n).over(frame) for n in names})
    return df.where(F.col(along).between(F.lit(0), F.col(last)))


def box(grid: DataFrame, value: str, size: int, *, replicate: bool = True) -> DataFrame:
    """``n, total, squares`` of the valid values in the ``size`` x ``size`` box around each cell of ``grid``, by sums along rows, then columns."""
    x = F.when(~F.isnan(F.col(value).cast("double")), F.col(value).cast("double"))
    cells = lattice(grid.withColumn(value, x), value)
    df = cells.withColumns({"n": F.col(value).isNotNull().cast("long"), "total": F.coalesce(value, F.lit(0.0)), "squares": F.coalesce(F.col(value) * F.col(value), F.lit(0.0))})
    names = ["n", "total", "squares"]
    df = _sums(df, names, "col", "row", "_w", size // 2, replicate)
    df = _sums(df, names, "row", "col", "_h", size // 2, replicate)
    return df.where(F.col(value).isNotNull()).select(*CELL, value, *names)


def box_mean(grid: DataFrame, value: str, size: int = 11) -> DataFrame:
    """Mean over the valid cells of the box."""
    return box(grid, value, size).select(*CELL, (F.col("total") / F.col("n")).alias("mean"))


def box_deviation(grid: DataFrame, value: str, size: int = 5) -> DataFrame:
    """Population deviation over the valid cells of the box (R2)."""
    mean = F.col("total") / F.col("n")
    return box(grid, value, size).select(*CELL, F.sqrt(F.greatest(F.lit(0.0), F.col("squares") / F.col("n") - mean * mean)).alias("deviation"))


def box_means(grid: DataFrame, **wanted: tuple[str, int]) -> DataFrame:
    """Means over boxes of several columns and sizes in one pass: ``out=(value, size)``.

    Cells without a value give null in the columns made of it.  All sums share the two shuffles, along rows and along
    columns.
    """
    values = dict.fromkeys(v for v, _ in wanted.values())
    number = {v: F.when(~F.isnan(F.col(v).cast("double")), F.col(v).cast("double")) for v in values}
    df = lattice(grid.select(*CELL, F.struct(*[number[v].alias(v) for v in values]).alias("_all")), "_all")
    half = max(n for _, n in wanted.values()) // 2
    sums = {f"_{k}_{o}": (F.col(f"_all.{v}").isNotNull().cast("double") if k == "n" else F.coalesce(F.col(f"_all.{v}"), F.lit(0.0))) for o, (v, _) in wanted.items() for k in "nt"}
    df = df.withColumns(sums)
    for along, across, last in (("col", "row", "_w"), ("row", "col", "_h")):
        at = F.col(along)
        df = df.withColumn(along, F.explode(F.sequence(F.when(at == 0, F.lit(-half)).otherwise(at), F.when(at == F.col(last), at + half).otherwise(at))))
        order = Window.partitionBy(across).orderBy(along)
        df = df.withColumns({f"_{k}_{o}": F.sum(f"_{k}_{o}").over(order.rangeBetween(-(n // 2), n // 2)) for o, (_, n) in wanted.items() for k in "nt"})
        df = df.where(F.col(along).between(F.lit(0), F.col(last)))
    mean = {o: F.when(F.col(f"_all.{v}").isNotNull(), F.col(f"_t_{o}") / F.col(f"_n_{o}")) for o, (v, _) in wanted.items()}
    return df.where(F.col("_all").isNotNull()).select(*CELL, *[m.alias(o) for o, m in mean.items()])


def gradient(grid: DataFrame, value: str, fill: Column | None = None) -> DataFrame:
    """Size of the gradient by central differences, one-sided at the border (R3); gaps count as ``fill``, the median by default."""
    df = lattice(grid, value)
    df = df.join(F.broadcast(quantiles(grid, _fill=(F.col(value), 0.5)))) if fill is None else df.withColumn("_fill", fill)
    df = df.withColumn("_x", F.coalesce(F.col(value), "_fill"))

    def slope(along: str, across: str) -> Column:
        w = Window.partitionBy(across).orderBy(along)
        before, after = F.lag("_x").over(w), F.lead("_x").over(w)
        x = F.col("_x")
        return F.coalesce((after - before) / 2, after - x, x - before, F.lit(0.0))

    df = df.withColumn("_gx", slope("col", "row")).withColumn("_gy", slope("row", "col"))
    return df.where(F.col(value).isNotNull()).select(*CELL, F.sqrt(F.col("_gx") ** 2 + F.col("_gy") ** 2).alias("gradient"))


def neighbour_count(grid: DataFrame, mask: Column, size: int = 5) -> DataFrame:
    """Cells of the box that fulfil ``mask``, without the cell itself; none beyond the border."""
    df = box(grid.withColumn("_m", F.coalesce(mask, F.lit(False)).cast("double")), "_m", size, replicate=False)
    return df.select(*CELL, (F.col("total") - F.col("_m")).cast("long").alias("neighbours"))


def shifted(cells: DataFrame, offsets: list[tuple[int, int]], by: tuple[str, ...] = ()) -> DataFrame:
    """Every cell once for each offset, moved by it; ``by`` are columns that stay."""
    moved = F.array(*[F.struct((F.col("row") + i).alias("row"), (F.col("col") + j).alias("col")) for i, j in offsets])
    return cells.select(*by, F.inline(moved))


def far_from(cells: DataFrame, seeds: DataFrame, distance: int = 4) -> DataFrame:
    """Cells at least ``distance`` away from every seed."""
    reach = range(1 - distance, distance)
    near = [(i, j) for i in reach for j in reach if i * i + j * j < distance * distance]
    return cells.join(shifted(seeds, near).distinct(), CELL, "left_anti")


def dilate(mask: DataFrame, grid: DataFrame, times: int = 1, by: tuple[str, ...] = ()) -> DataFrame:
    """The mask and its eight neighbours within ``grid`` (R7); masks of several layers are told apart by the columns ``by``."""
    for _ in range(times):
        mask = shifted(mask, [(0, 0), *EIGHT], by).distinct().join(grid.select(*CELL), CELL, "left_semi")
    return mask


def erode(mask: DataFrame, times: int = 1, by: tuple[str, ...] = ()) -> DataFrame:
    """Cells whose eight neighbours all belong to the mask; what lies outside the raster does not."""
    for _ in range(times):
        mask = shifted(mask, [(0, 0), *EIGHT], by).groupBy(*by, *CELL).agg(F.count(F.lit(1)).alias("_n")).where("_n = 9").select(*by, *CELL)
    return mask


def opening(mask: DataFrame, grid: DataFrame, times: int = 1, by: tuple[str, ...] = ()) -> DataFrame:
    return dilate(erode(mask, times, by), grid, times, by)


def closing(mask: DataFrame, grid: DataFrame, times: int = 1, by: tuple[str, ...] = ()) -> DataFrame:
    return erode(dilate(mask, grid, times, by), times, by)


def _joined(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest member of each of ``n`` numbers' sets, when ``a[i]`` and ``b[i]`` belong together."""
    root = np.arange(n)
    while True:
        x, y = root[a], root[b]
        if (x == y).all():
            return root
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while (root != root[root]).any():
            root = root[root]


def _tile_parts(row: np.ndarray, col: np.ndarray, reach: int) -> np.ndarray:
    """For cells of a tile in order of row and column: where in the list the first cell of each one's part is.

    Runs of neighbouring cells of a row are joined to the runs that they touch in the next row.
    """
    wide = np.int64(1 << 32)
    first = np.flatnonzero(np.append(True, (row[1:] != row[:-1]) | (col[1:] != col[:-1] + 1)))
    last = np.append(first[1:], len(row)) - 1
    at, begin, end = row[first].astype(np.int64), col[first].astype(np.int64) + 2, col[last].astype(np.int64) + 2
    low = np.searchsorted(at * wide + end, (at + 1) * wide + begin - reach, "left")
    high = np.searchsorted(at * wide + begin, (at + 1) * wide + end + reach, "right")
    met = np.maximum(high - low, 0)
    below = np.arange(int(met.sum())) - np.repeat(np.cumsum(met) - met - low, met)
    root = _joined(len(first), np.repeat(np.arange(len(first)), met), below)
    return np.repeat(first[root], last - first + 1)


def labels(mask: DataFrame, offsets: list[tuple[int, int]] = EIGHT, by: tuple[str, ...] = (), tile: int = TILE) -> DataFrame:
    """``row, col, label`` of connected cells; a label is the smallest cell number, row * 2^31 + col.

    Cells are labelled within tiles of ``tile`` x ``tile`` first, by runs; only the parts of tiles, where border cells touch,
    are vertices of a graph.  So a tile is the most a task holds, and rounds follow the number of tiles that a part crosses.
    """
    return labelled(mask, offsets, by, tile)[0]


def labelled(mask: DataFrame, offsets: list[tuple[int, int]] = EIGHT, by: tuple[str, ...] = (), tile: int = TILE) -> tuple[DataFrame, int]:
    """:func:`labels`, and the number of rounds that it took to join the parts of tiles."""
    reach = 1 if (1, 1) in offsets else 0
    by = list(by)
    cells = mask.select(*by, *[F.col(c).cast("int").alias(c) for c in CELL]).distinct().withColumns({"_tr": F.floor(F.col("row") / tile), "_tc": F.floor(F.col("col") / tile)})

    def part(found: pd.DataFrame) -> pd.DataFrame:
        found = found.sort_values(CELL)
        row, col = found["row"].to_numpy(), found["col"].to_numpy()
        head = _tile_parts(row, col, reach)
        return found.assign(_local=row[head].astype("int64") * (1 << 31) + col[head])[[*by, *CELL, "_local"]]

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in cells.select(*by, *CELL).schema)
    parts = materialise(cells.groupBy(*by, "_tr", "_tc").applyInPandas(part, f"{kinds}, _local long"))
    edge = lambda c: (F.pmod(F.col(c), F.lit(tile)) == 0) | (F.pmod(F.col(c), F.lit(tile)) == tile - 1)
    border = parts.where(edge("row") | edge("col"))
    name = F.struct(*by, "_local")
    half = [o for o in offsets if o > (0, 0)]
    out = F.array(*[F.struct((F.col("row") + i).alias("row"), (F.col("col") + j).alias("col"), (F.floor((F.col("row") + i) / tile) != F.floor(F.col("row") / tile)).alias("_v"), (F.floor((F.col("col") + j) / tile) != F.floor(F.col("col") / tile)).alias("_u")) for i, j in half])
    moved = border.select(*by, name.alias("src"), F.inline(out)).where("_v OR _u").select(*by, *CELL, "src")
    links = moved.join(border.select(*by, *CELL, name.alias("dst")), [*by, *CELL]).select("src", "dst").distinct()
    found, rounds = contracted(links)
    whole = found.select("id.*", F.col("component._local").alias("_whole"))
    done = parts.join(whole, [*by, "_local"], "left")
    return done.select(*by, *CELL, F.coalesce("_whole", "_local").alias("label")), rounds


def fill_holes(mask: DataFrame, grid: DataFrame | None = None, value: str | None = None, by: tuple[str, ...] = ()) -> DataFrame:
    """The mask with those cells that it cuts off from the border of the raster, by four neighbours.

    Only cells of the box around a mask can be holes; a ring of open cells around it stands for all that lies outside,
    so neither the raster nor the rest of its cells (``grid``, ``value``) are needed.
    """
    by, own = list(by), mask.select(*by, *CELL).distinct()
    ends = [F.min("row").alias("_r0"), F.max("row").alias("_r1"), F.min("col").alias("_c0"), F.max("col").alias("_c1")]
    box_ = materialise((own.groupBy(*by).agg(*ends) if by else own.agg(*ends)).where("_r0 IS NOT NULL"))
    n = box_.agg(F.sum((F.col("_r1") - F.col("_r0") + 3).cast("long") * (F.col("_c1") - F.col("_c0") + 3))).first()[0] or 0
    rows = box_.select(*by, F.explode(F.sequence(F.col("_r0") - 1, F.col("_r1") + 1)).alias("row"), "_r0", "_r1", "_c0", "_c1").repartition(max(1, -(-n // CELLS)), *by, "row")
    ring = (F.col("row") < F.col("_r0")) | (F.col("row") > F.col("_r1")) | (F.col("col") < F.col("_c0")) | (F.col("col") > F.col("_c1"))
    cells = rows.withColumn("col", F.explode(F.sequence(F.col("_c0") - 1, F.col("_c1") + 1))).select(*by, *CELL, ring.alias("_out"))
    open_ = cells.join(own, [*by, *CELL], "left_anti")
    parts = labels(open_, FOUR, tuple(by)).join(open_, [*by, *CELL])
    outer = parts.where("_out").select(*by, "label").distinct()
    return own.union(parts.join(outer, [*by, "label"], "left_anti").select(*by, *CELL))


def propagate(seeds: DataFrame, mask: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Cells of the mask that a path of its cells joins to a seed, and the seeds."""
    keys = [*by, *CELL]
    parts = labels(mask.select(*keys).union(seeds.select(*keys)), by=by)
    return parts.join(parts.join(seeds.select(*keys), keys, "left_semi").select(*by, "label").distinct(), [*by, "label"], "left_semi").select(*keys)


def buffer_radius(points: DataFrame, least: float = 3e-4) -> DataFrame:
    """0.62 of the larger median step between neighbouring cells in longitude and latitude, which counts as ``least`` at least."""
    along = Window.partitionBy("row").orderBy("col")
    down = Window.partitionBy("col").orderBy("row")
    step = lambda c, axis, w: F.when(F.lead(axis).over(w) == F.col(axis) + 1, F.abs(F.lead(c).over(w) - F.col(c)))
    df = points.select(step("lon", "col", along).alias("a"), step("lat", "row", down).alias("b"))
    known = lambda c: F.when(F.col(c) > 0, F.col(c))
    found = quantiles(df, a=(known("a"), 0.5), b=(known("b"), 0.5))
    return found.select((0.62 * F.greatest(F.coalesce("a", F.lit(0.0)), F.coalesce("b", F.lit(0.0)), F.lit(least))).alias("radius"))
