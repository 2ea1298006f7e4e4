"""Connected components of an undirected graph given as an edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrapulse.session import materialise


def connected_components(edges: DataFrame, *, src: str = "src", dst: str = "dst", max_rounds: int = 60) -> DataFrame:
    """``(id, component)`` of every vertex that has an edge; a component is named by its smallest id (see :func:`contracted`)."""
    return contracted(edges, src=src, dst=dst, max_rounds=max_rounds)[0]


def contracted(edges: DataFrame, *, src: str = "src", dst: str = "dst", max_rounds: int = 60) -> tuple[DataFrame, int]:
    """``(id, component)`` of every vertex that has an edge, and the number of rounds that it took.

    Alternates two star contractions until nothing changes: every vertex links its larger neighbours to the smallest
    id around it (large star), then its smaller neighbours and itself (small star).  Each round is a grouped minimum
    and a join on the vertex, so no neighbourhood is gathered into one row; the number of rounds grows with the
    logarithm of a component's diameter.  Self loops only declare a vertex.
    """
    both = edges.select(F.col(src).alias("a"), F.col(dst).alias("b")).where(F.col("a").isNotNull() & F.col("b").isNotNull())
    vertices = both.select(F.col("a").alias("id")).union(both.select(F.col("b").alias("id"))).distinct()
    links = materialise(both.where("a <> b").select(F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi")).distinct())
    if links.isEmpty():
        return vertices.select("id", F.col("id").alias("component")), 0
    before = None
    for rounds in range(1, max_rounds + 1):
        pairs = links.select(F.col("lo").alias("a"), F.col("hi").alias("b")).union(links.select(F.col("hi").alias("a"), F.col("lo").alias("b")))
        least = pairs.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = pairs.where("b > a").join(least, "a").select(F.col("m").alias("lo"), F.col("b").alias("hi")).where("lo <> hi").distinct()
        down = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(down, "hi").select(F.col("m").alias("lo"), F.col("lo").alias("hi")).where("lo <> hi").union(down.select(F.col("m").alias("lo"), "hi"))
        links = materialise(small.distinct())
        now = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("lo", "hi").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError("components did not settle")
    return vertices.join(links.select(F.col("hi").alias("id"), "lo"), "id", "left").select("id", F.coalesce("lo", "id").alias("component")), rounds


def holding(found: DataFrame, core: DataFrame) -> DataFrame:
    """The components that hold at least one ``id`` of ``core``, whole."""
    kept = found.join(core.select("id"), "id", "left_semi").select("component").distinct()
    return found.join(kept, "component", "left_semi").select("id", "component")
