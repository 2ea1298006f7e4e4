"""Rules of the reference that the twins of the first queries leave out."""

from terrapulse import catalogue
from terrapulse.operators import series


def test_all_bad_dates_are_flagged(spark):
    """Half of the dates are bad: more than the top tenth of either rank."""
    rows = [(f"2020-01-{i:02d}", 25.0 if i in (1, 2, 3) else 1.0, 0.2 if i in (4, 5) else 0.0) for i in range(1, 11)]
    dates = spark.createDataFrame(rows, "date string, median_abs double, frac double")
    assert {r.date[-2:] for r in series.flag_dates(dates).where("flagged").collect()} == {"01", "02", "03", "04", "05"}


def test_lone_points_and_core(spark):
    """A strict point without a neighbour is a set; a set of relaxed points alone is none."""
    #: 1 strict, alone; 2 strict with 3 relaxed; 4 and 5 relaxed; 6 relaxed, alone
    at = {1: (30.00, 0.9), 2: (30.10, 0.9), 3: (30.1005, 0.35), 4: (30.20, 0.35), 5: (30.2005, 0.35), 6: (30.30, 0.35)}
    rows = [(i, lat, 103.0, t, 1.0, 1.0, 0.0, 1.0) for i, (lat, t) in at.items()]
    points = spark.createDataFrame(rows, "point_id long, lat double, lon double, tcoh double, valid_pair_ratio double, maincc_ratio double, jump_risk double, model_rms double")
    points = points.withColumn("valid_pair_ratio", (points.tcoh > 0.5).cast("double") * 0.5 + 0.5)
    classes = {r.point_id: r.point_class for r in catalogue._scored_points(points).collect()}
    assert classes == {1: "strict", 2: "strict", 3: "relaxed", 4: "relaxed", 5: "relaxed", 6: "relaxed"}
    assert {(r.id, r.component) for r in catalogue.g05(points).collect()} == {(1, 1), (2, 2), (3, 2)}
