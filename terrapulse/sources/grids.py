"""Files with a name of their own, delay grids, and footprints.

Files are opened through the file system of their URI (``file:``, ``hdfs:``, ``s3:`` ...), on whichever machine a task runs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

#: The header's keys that a grid cannot do without.
REQUIRED = ("WIDTH", "FILE_LENGTH", "X_FIRST", "Y_FIRST", "X_STEP", "Y_STEP")
#: Values that one partition of a grid holds at most.
PART_VALUES = 1 << 20


def opened(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")


def write_files(rows: DataFrame, path: str) -> int:
    """Writes one file for each row (``name, content``; text or bytes) into the folder ``path``; how many.  A task that runs again writes the same files."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                system, base = opened(path)
                system.create_dir(base, recursive=True)
                with system.open_output_stream(f"{base}/{name}") as out:
                    out.write(content.encode() if isinstance(content, str) else bytes(content))
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], ["n"])

    return rows.select("name", "content").mapInArrow(run, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def header(text: str) -> dict[str, float]:
    """The numbers of a header, by key; an error names the keys that are missing."""
    found: dict[str, float] = {}
    for line in text.splitlines():
        words = line.split()
        if len(words) > 1:
            try:
                found[words[0]] = float(words[1])
            except ValueError:
                pass
    missing = [k for k in REQUIRED if k not in found]
    if missing:
        raise ValueError(f"the header lacks {', '.join(missing)}")
    return found


class _Rows(InputPartition):
    def __init__(self, path: str, name: str, head: dict[str, float], first: int, n: int):
        super().__init__((path, first))
        self.path, self.name, self.head, self.first, self.n = path, name, head, first, n


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.path = options["path"]
        self.part_values = int(options.get("partValues", PART_VALUES))

    def partitions(self) -> list[InputPartition]:
        system, base = opened(self.path)
        files = {f.path: f.size for f in system.get_file_info(fs.FileSelector(base)) if f.is_file}
        out: list[InputPartition] = []
        for p in sorted(x for x in files if x.endswith(".ztd")):
            if f"{p}.rsc" not in files:
                raise ValueError(f"{p} has no header")
            with system.open_input_stream(f"{p}.rsc") as f:
                head = header(f.read().decode(errors="replace"))
            wide, long = int(head["WIDTH"]), int(head["FILE_LENGTH"])
            if files[p] != 4 * wide * long:
                raise ValueError(f"{p} has {files[p]} bytes where its header wants {4 * wide * long}")
            rows = max(1, self.part_values // max(1, wide))
            name = p.rsplit("/", 1)[-1][: -len(".ztd")]
            out += [_Rows(p, name, head, a, min(rows, long - a)) for a in range(0, long, rows)]
        return out

    def read(self, part: _Rows) -> Iterator[pa.RecordBatch]:
        system, _ = opened(self.path)
        wide, long = int(part.head["WIDTH"]), int(part.head["FILE_LENGTH"])
        with system.open_input_file(part.path) as f:
            f.seek(4 * wide * part.first)
            data = np.frombuffer(f.read(4 * wide * part.n), "<f4")
        row, col = part.first + np.repeat(np.arange(part.n), wide), np.tile(np.arange(wide), part.n)
        lat, lon = part.head["Y_FIRST"] + row * part.head["Y_STEP"], part.head["X_FIRST"] + col * part.head["X_STEP"]
        # axes count upward, whichever way the file runs
        i, j = (long - 1 - row if part.head["Y_STEP"] < 0 else row), (wide - 1 - col if part.head["X_STEP"] < 0 else col)
        yield pa.RecordBatch.from_arrays([pa.array([part.name] * len(data)), *[pa.array(x.astype(np.int32)) for x in (i, j)], pa.array(lat), pa.array(lon), pa.array(data)], ["date", "lat_idx", "lon_idx", "lat", "lon", "ztd"])


class DelayGridSource(DataSource):
    """``spark.read.format("delay_grid").load(folder)``: all ``<date>.ztd`` of a folder with their ``.ztd.rsc`` headers.

    ``date, lat_idx, lon_idx, lat, lon, ztd``, both axes ascending.  Headers and sizes are checked before anything is read: a
    grid without a header, with a header that lacks a key, or of another size than its header says is refused.  A partition is a
    range of bytes, some rows of one file (option ``partValues``).  An empty folder gives no rows.
    """

    @classmethod
    def name(cls) -> str:
        return "delay_grid"

    def schema(self) -> str:
        return "date string, lat_idx int, lon_idx int, lat double, lon double, ztd float"

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options)


def read_delay_grids(spark: SparkSession, path: str, **options: str) -> DataFrame:
    spark.dataSource.register(DelayGridSource)
    return spark.read.format("delay_grid").options(**options).load(path)


def delay_grid_files(grid: DataFrame, *, downward: bool = True) -> DataFrame:
    """``name, content`` of the two files of each date, from ``date, lat_idx, lon_idx, lat, lon, ztd`` of whole grids; ``downward``: north first."""
    order = F.struct((-F.col("lat_idx") if downward else F.col("lat_idx")).alias("i"), F.col("lon_idx").alias("j"), F.col("ztd").cast("float").alias("v"))
    packed = grid.groupBy("date").agg(
        F.transform(F.sort_array(F.collect_list(order)), lambda x: x["v"]).alias("v"), (F.max("lon_idx") + 1).alias("w"), (F.max("lat_idx") + 1).alias("h"),
        F.min("lon").alias("x0"), F.max("lon").alias("x1"), F.min("lat").alias("y0"), F.max("lat").alias("y1"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                dy = (r["y1"] - r["y0"]) / max(1, r["h"] - 1)
                head = {"WIDTH": r["w"], "FILE_LENGTH": r["h"], "X_FIRST": r["x0"], "Y_FIRST": r["y1"] if downward else r["y0"], "X_STEP": (r["x1"] - r["x0"]) / max(1, r["w"] - 1), "Y_STEP": -dy if downward else dy}
                text = "".join(f"{k} {v!r}\n" for k, v in head.items()).encode()
                yield pa.RecordBatch.from_arrays([pa.array([f"{r['date']}.ztd", f"{r['date']}.ztd.rsc"]), pa.array([np.asarray(r["v"], "<f4").tobytes(), text], pa.binary())], ["name", "content"])

    return packed.mapInArrow(run, "name string, content binary")


def footprint_points(spark: SparkSession, path: str) -> DataFrame:
    """``scene, swath, lat, lon`` of all grid points of the annotation files that match ``path``.

    The engine's XML reader takes every ``geolocationGridPoint`` element, however deep.  The swath is the number after ``iw`` in the
    file's name, the scene the folder that ends in ``.SAFE``; a point without a place is left out.
    """
    rows = spark.read.format("xml").option("rowTag", "geolocationGridPoint").schema("latitude double, longitude double").load(path).select("latitude", "longitude", F.col("_metadata.file_path").alias("_file"))
    found = rows.select(F.regexp_extract("_file", r"([^/]+)\.SAFE/", 1).alias("scene"), F.regexp_extract("_file", r"-iw([0-9])-[^/]*$", 1).cast("int").alias("swath"), F.col("latitude").alias("lat"), F.col("longitude").alias("lon"))
    return found.where("lat IS NOT NULL AND lon IS NOT NULL")


def swaths_over(points: DataFrame, south: float, north: float, west: float, east: float) -> DataFrame:
    """``swath``: those of the first scene whose bounds meet the box, borders included; all of them where none does."""
    first = points.agg(F.min("scene").alias("_first"))
    box = points.join(F.broadcast(first), F.col("scene") == F.col("_first")).groupBy("swath").agg(F.min("lat").alias("s"), F.max("lat").alias("n"), F.min("lon").alias("w"), F.max("lon").alias("e"))
    meets: Column = (F.col("s") <= north) & (F.col("n") >= south) & (F.col("w") <= east) & (F.col("e") >= west)
    # a scene has a few swaths
    marked = box.withColumn("_meets", meets).join(F.broadcast(box.agg(F.max(meets).alias("_any"))))
    return marked.where("_meets OR NOT _any").select("swath")


def common_bounds(points: DataFrame) -> DataFrame:
    """``south, north, west, east, n_dates``: the box that the bounds of all scenes share."""
    per = points.groupBy("scene").agg(F.min("lat").alias("s"), F.max("lat").alias("n"), F.min("lon").alias("w"), F.max("lon").alias("e"))
    return per.agg(F.max("s").alias("south"), F.min("n").alias("north"), F.max("w").alias("west"), F.min("e").alias("east"), F.count(F.lit(1)).alias("n_dates")).where("n_dates > 0")
