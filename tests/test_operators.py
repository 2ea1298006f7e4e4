"""Every registered query with a DuckDB twin is held against it; components against a plain union-find."""

import time

import duckdb
import pytest
from pyspark.sql import functions as F

from terrapulse import catalogue as registry
from terrapulse import queries as catalogue
from terrapulse.functions import scalars, stats
from terrapulse.operators import neighbours
from terrapulse.operators.components import connected_components

DATA = "/root/testdata/sf0.001"


def plain(v):
    return float(f"{v:.7g}") if isinstance(v, float) else v


@pytest.mark.parametrize("name", sorted(catalogue.ORACLE_SQL))
def test_twin(spark, name):
    con = duckdb.connect()
    for t in ("part", "lineitem", "orders", "customer", "nation"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    df = catalogue.QUERIES[name](spark, DATA)
    cols = sorted(df.columns)
    got = sorted(tuple(str(plain(r[c])) for c in cols) for r in df.collect())
    want = con.sql(catalogue.ORACLE_SQL[name])
    at = [want.columns.index(c) for c in cols]
    assert got == sorted(tuple(str(plain(r[i])) for i in at) for r in want.fetchall())


def test_components(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, 105), (105, 101), (7, 7), (200, 200)]
    got = {r.id: r.component for r in connected_components(spark.createDataFrame(edges, "src long, dst long")).collect()}
    assert got == {**{i: 1 for i in range(1, 41)}, 100: 100, 101: 100, 105: 100, 200: 200}


def test_no_edges(spark):
    assert connected_components(spark.createDataFrame([], "src long, dst long")).count() == 0


def test_quantiles_of_an_aliased_source(spark):
    """The names inside must not meet a caller's alias."""
    df = spark.createDataFrame([(1, 2.0), (1, 4.0), (2, 5.0)], "k int, v double").alias("e")
    got = {r.k: r.m for r in stats.quantiles(df, "k", m=(F.col("v"), 0.5)).collect()}
    assert got == {1: 3.0, 2: 5.0}


def test_unit_series_grows_with_its_length(spark):
    """Ten times the epochs would have taken a thousand times as long."""
    df = spark.range(1).select(F.transform(F.sequence(F.lit(1), F.lit(3000)), lambda i: i.cast("double")).alias("v"))
    began = time.monotonic()
    x = df.select(scalars.unit_series(F.col("v")).alias("x")).first().x
    assert time.monotonic() - began < 60
    assert abs(sum(x)) < 1e-9 and abs(sum(v * v for v in x) - 1) < 1e-9
    assert spark.createDataFrame([([2.0, 2.0],)], "v array<double>").select(scalars.unit_series(F.col("v")).alias("x")).first().x == [0.0, 0.0]


def test_points_are_not_broadcast(spark):
    """Files of points are small, their rows are not: neither rounds of the search nor summaries may collect them (F1, F2)."""
    points = spark.createDataFrame([(i, 30.0 + i // 10 * 0.001, 103.0 + i % 10 * 0.001) for i in range(100)], "point_id long, lat double, lon double")
    steps = points.select("point_id", F.lit(1).alias("epoch_idx"), F.lit(1.0).alias("value_mm"), F.lit(1.0).alias("delta"))
    edges = neighbours.nearest(points, 8, cell=150.0)
    for df in (edges, neighbours.summaries(edges, steps), neighbours.within_radius(points, 230.0).select("src", "dst")):
        plan = df._jdf.queryExecution().sparkPlan().toString()
        assert "BroadcastHashJoin" not in plan, plan
    assert edges.count() == 800


@pytest.mark.parametrize("name", ["ts13_passes", "fc27_forecast", "m08_principal_mask", "r11_grown_zones", "g05_regions", "fc17_quantiles", "fc19_variant", "g11_joining_regions", "g10_retained_regions", "fc28_evaluation"])
def test_series_are_written_before_many_jobs_read_them(spark, monkeypatch, name):
    """Each job of these queries summed up all of lineitem anew."""

    def written(df):
        if "value_mm" in df.columns:
            raise InterruptedError
        return df

    monkeypatch.setattr(registry, "materialise", written)
    with pytest.raises(InterruptedError):
        catalogue.QUERIES[name](spark, DATA)
