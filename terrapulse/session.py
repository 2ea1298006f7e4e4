"""Session helpers: where intermediate tables live and how lineage is cut."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share.

    Read from ``spark.checkpoint.dir`` (or the context's checkpoint folder).  Only a local master, where
    driver and executors are one machine, gets a temporary folder when nothing is set.
    """
    sc = spark.sparkContext
    found = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if found:
        return found.rstrip("/")
    if not sc.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    own = "file://" + tempfile.mkdtemp(prefix="spark-")
    sc.setCheckpointDir(own)
    return (sc.getCheckpointDir() or own).rstrip("/")


def materialise(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    Cuts the lineage like ``checkpoint()`` and survives the loss of executors, but is compressed and columnar.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/tables/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
