"""Domain views over the test tables: epochs, observations, points, pair pixels, scenes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

_SPARK = {
    "epoch": """SELECT CAST(row_number() OVER (ORDER BY month) - 1 AS INT) AS epoch_idx, CAST(month AS DATE) AS date,
        datediff(month, (SELECT min(date_trunc('month', l_shipdate)) FROM lineitem)) AS day_offset
        FROM (SELECT DISTINCT date_trunc('month', l_shipdate) AS month FROM lineitem)""",
    "obs": """SELECT l.l_suppkey AS point_id, e.epoch_idx, e.date, e.day_offset, sum(l_extendedprice * (1 - l_discount)) / 10000.0D AS value_mm
        FROM lineitem l JOIN epoch e ON CAST(date_trunc('month', l.l_shipdate) AS DATE) = e.date GROUP BY ALL""",
    "point": """SELECT p_partkey AS point_id, CAST(p_partkey div 50 AS INT) AS `row`, CAST(p_partkey % 50 AS INT) AS col,
        30.0D + (p_partkey div 50) * 0.001D AS lat, 103.0D + (p_partkey % 50) * 0.001D + (p_size - 25) * 0.000001D AS lon,
        CAST(p_retailprice AS DOUBLE) AS height_m, p_size / 50.0D AS tcoh, ((p_partkey * 37) % 101) / 100.0D AS maincc_ratio,
        ((p_partkey * 53) % 103) / 102.0D AS valid_pair_ratio, ((p_partkey * 17) % 31) / 31.0D AS jump_risk, ((p_partkey * 29) % 41) / 10.0D AS model_rms
        FROM part""",
    "pair_pixel": """SELECT date_format(date_trunc('month', l_shipdate), 'yyyyMMdd') AS date1,
        date_format(add_months(date_trunc('month', l_shipdate), 1), 'yyyyMMdd') AS date2, l_orderkey, l_linenumber, l_partkey AS point_id,
        (l_extendedprice - 50000.0D) / (3500.0D + 400.0D * month(l_shipdate)) AS unw,
        1.0D - 0.01D * month(l_shipdate) - l_discount * (4 + month(l_shipdate) / 2.0D) AS coh,
        CASE WHEN l_returnflag = 'N' AND l_linenumber = 1 THEN 0 ELSE CAST(l_linenumber AS INT) END AS cc FROM lineitem""",
    "scene": """SELECT o_orderkey AS scene_id, o_orderdate AS start_ts, n.n_regionkey AS path, CAST(substr(o_orderpriority, 1, 1) AS INT) AS frame
        FROM orders o JOIN customer c ON o_custkey = c_custkey JOIN nation n ON c_nationkey = n_nationkey""",
}

#: The same views for DuckDB, as common table expressions.
DUCK = {
    "epoch": """SELECT CAST(row_number() OVER (ORDER BY month) - 1 AS INTEGER) AS epoch_idx, CAST(month AS DATE) AS date,
        CAST(datediff('day', (SELECT min(date_trunc('month', l_shipdate)) FROM lineitem), month) AS INTEGER) AS day_offset
        FROM (SELECT DISTINCT date_trunc('month', l_shipdate) AS month FROM lineitem)""",
    "obs": """SELECT l.l_suppkey AS point_id, e.epoch_idx, e.date, e.day_offset, CAST(sum(l_extendedprice * (1 - l_discount)) AS DOUBLE) / 10000.0::DOUBLE AS value_mm
        FROM lineitem l JOIN epoch e ON CAST(date_trunc('month', l.l_shipdate) AS DATE) = e.date GROUP BY ALL""",
    "point": """SELECT p_partkey AS point_id, CAST(p_partkey // 50 AS INTEGER) AS "row", CAST(p_partkey % 50 AS INTEGER) AS col,
        30.0::DOUBLE + (p_partkey // 50) * 0.001::DOUBLE AS lat, 103.0::DOUBLE + (p_partkey % 50) * 0.001::DOUBLE + (p_size - 25) * 0.000001::DOUBLE AS lon,
        CAST(p_retailprice AS DOUBLE) AS height_m, p_size / 50.0::DOUBLE AS tcoh, ((p_partkey * 37) % 101) / 100.0::DOUBLE AS maincc_ratio,
        ((p_partkey * 53) % 103) / 102.0::DOUBLE AS valid_pair_ratio, ((p_partkey * 17) % 31) / 31.0::DOUBLE AS jump_risk, ((p_partkey * 29) % 41) / 10.0::DOUBLE AS model_rms
        FROM part""",
    "pair_pixel": """SELECT strftime(date_trunc('month', l_shipdate), '%Y%m%d') AS date1,
        strftime(date_trunc('month', l_shipdate) + INTERVAL 1 MONTH, '%Y%m%d') AS date2, l_orderkey, l_linenumber, l_partkey AS point_id,
        (l_extendedprice - 50000.0::DOUBLE) / (3500.0::DOUBLE + 400.0::DOUBLE * month(l_shipdate)) AS unw,
        1.0::DOUBLE - 0.01::DOUBLE * month(l_shipdate) - l_discount * (4 + month(l_shipdate) / 2.0::DOUBLE) AS coh,
        CASE WHEN l_returnflag = 'N' AND l_linenumber = 1 THEN 0 ELSE CAST(l_linenumber AS INTEGER) END AS cc FROM lineitem""",
    "scene": """SELECT o_orderkey AS scene_id, o_orderdate AS start_ts, n.n_regionkey AS path, CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS frame
        FROM orders o JOIN customer c ON o_custkey = c_custkey JOIN nation n ON c_nationkey = n_nationkey""",
}


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the domain views as a DataFrame."""
    inputs = {"epoch": ("lineitem",), "obs": ("lineitem",), "point": ("part",), "pair_pixel": ("lineitem",), "scene": ("orders", "customer", "nation")}
    frames = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in inputs[name]}
    text = _SPARK[name]
    for t in sorted(frames, key=len, reverse=True):
        text = _named(text, t)
    if name == "obs":
        frames["epoch"] = view(spark, sf_dir, "epoch")
        text = text.replace("JOIN epoch", "JOIN {epoch}")
    return spark.sql(text, **frames)


def _named(text: str, table: str) -> str:
    return text.replace(f"FROM {table}", "FROM {" + table + "}").replace(f"JOIN {table}", "JOIN {" + table + "}")


def duck(names: tuple[str, ...], body: str) -> str:
    """``body`` with the named views as common table expressions, in order of need."""
    wanted = [n for n in ("epoch", *names) if n in names or (n == "epoch" and "obs" in names)]
    wanted = list(dict.fromkeys(wanted))
    head = ", ".join(f"{n} AS ({DUCK[n]})" for n in wanted)
    return f"WITH {head}{',' if body.lstrip().startswith('+') else ''} {body.lstrip().lstrip('+')}"
