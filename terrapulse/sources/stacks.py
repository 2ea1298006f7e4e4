"""What file names and file facts tell about a stack, window reads of it, and wide point tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _part(path: Column, group: int) -> Column:
    return F.regexp_extract(path, r"(?:^|/)(\d{8})_(\d{8})[^/]*$", group)


def pairs_of_files(files: DataFrame) -> DataFrame:
    """``date1, date2`` of the ``path`` names that begin with two dates, each pair once."""
    found = files.select(_part(F.col("path"), 1).alias("date1"), _part(F.col("path"), 2).alias("date2"))
    return found.where("date1 <> ''").distinct()


def reference_series(files: DataFrame) -> DataFrame:
    """``path, reference, date`` of the series files that share the earliest first date; residual and velocity files are no series."""
    name = F.lower(F.regexp_extract("path", r"([^/]*)$", 1))
    found = files.select("path", _part(F.col("path"), 1).alias("reference"), _part(F.col("path"), 2).alias("date"))
    found = found.where((F.col("reference") != "") & ~name.contains("residual") & ~name.contains("velocity"))
    return found.join(F.broadcast(found.agg(F.min("reference").alias("reference"))), "reference").select("path", "reference", "date")


def read_window(pixels: DataFrame, first_row: int, last_row: int, first_col: int, last_col: int) -> DataFrame:
    """Cells of a half-open window, counted from its corner (S3); the bounds reach the scan as filters."""
    inside = (F.col("row") >= first_row) & (F.col("row") < last_row) & (F.col("col") >= first_col) & (F.col("col") < last_col)
    return pixels.where(inside).withColumns({"row": F.col("row") - first_row, "col": F.col("col") - first_col})


def first_available(products: DataFrame, priority: list[str]) -> DataFrame:
    """One row: the ``product`` that comes first in ``priority`` among the rows; null if none does."""
    rank = F.array_position(F.lit(priority), F.col("product"))
    return products.agg(F.min_by("product", F.when(rank > 0, rank)).alias("product"))


def validated(expected: DataFrame, files: DataFrame) -> DataFrame:
    """For each expected ``date`` whether its files are ``usable`` and why not.

    ``files`` have ``date, has_data, has_header, size, width, length``; a data file holds four bytes a cell.
    """
    df = expected.select("date").distinct().join(files, "date", "left")
    cells = F.col("width").cast("long") * F.col("length") * 4
    error = (
        F.when(~F.coalesce("has_data", F.lit(False)), "missing_data").when(~F.coalesce("has_header", F.lit(False)), "missing_header")
        .when(F.coalesce(cells, F.lit(0)) <= 0, "bad_header").when(F.coalesce("size", F.lit(-1)) != cells, "size_mismatch")
    )
    return df.select("date", error.isNull().alias("usable"), F.coalesce(error, F.lit("")).alias("error"))


def wide_points(points: DataFrame, obs: DataFrame, dates: list[str]) -> DataFrame:
    """One row a point with its place, coherence, rate and a column for each of ``dates``.

    Places are rounded to 6 digits, coherence to 3, rates and values to 2; points without one of the dates have null there.
    """
    wide = obs.withColumn("_d", F.date_format("date", "yyyyMMdd")).groupBy("point_id").pivot("_d", dates).agg(F.first("value_mm"))
    met = points.join(wide, "point_id")
    place = [F.round("lon", 6).alias("lon"), F.round("lat", 6).alias("lat"), F.round("tcoh", 3).alias("coherence"), F.round("rate", 2).alias("rate")]
    return met.select(F.col("point_id").alias("uid"), *place, *[F.round(F.col(f"`{d}`"), 2).alias(f"d{d}") for d in dates])


def geometry(own: DataFrame | None, full: DataFrame | None = None, *, shape: tuple[int, int] | None = None, offset: tuple[int, int] | None = None, stride: tuple[int, int] = (1, 1)) -> DataFrame:
    """``row, col, latitude, longitude, height`` of a crop.

    ``own``, the crop's own grid, is taken if it has both coordinates. Else the full-resolution grid is cut: with ``shape`` and ``offset`` to every
    ``stride``-th cell from the offset on, renumbered, as many as ``shape`` has; without them it is taken whole. A grid without heights gives nulls; cells that the full
    grid does not reach have no row; without either grid it is an error. Only the wanted rows and columns are read.
    """
    names = ["latitude", "longitude", "height"]

    def columns(grid: DataFrame) -> list:
        return [F.col(c).cast("float").alias(c) if c in grid.columns else F.lit(None).cast("float").alias(c) for c in names]

    if own is not None and {"latitude", "longitude"} <= set(own.columns):
        return own.select("row", "col", *columns(own))
    if full is None or not {"latitude", "longitude"} <= set(full.columns):
        raise ValueError("there is no grid with latitude and longitude")
    if shape is None or offset is None:
        return full.select("row", "col", *columns(full))
    for axis, n, first, step in zip(("row", "col"), shape, offset, stride, strict=True):
        full = full.where(F.col(axis).between(first, first + n * step - 1) & ((F.col(axis) - first) % step == 0))
    at = [((F.col(axis) - first) / step).cast("int").alias(axis) for axis, first, step in zip(("row", "col"), offset, stride, strict=True)]
    return full.select(*at, *columns(full))
