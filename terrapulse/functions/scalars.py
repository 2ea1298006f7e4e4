"""Column expressions shared by the operators."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Metres a degree of latitude, and of longitude at the equator.
METRES_LAT, METRES_LON = 110540.0, 111320.0


def clip(x: Column, lo: float, hi: float) -> Column:
    """x held within [lo, hi]; null stays null."""
    return F.when(x.isNotNull(), F.least(F.lit(hi), F.greatest(F.lit(lo), x)))


def sigmoid(x: Column) -> Column:
    return 1.0 / (1.0 + F.exp(-x))


def phase_to_mm(phase: Column, wavelength: float = 0.05546576) -> Column:
    """Line-of-sight millimetres of a phase in radians."""
    return phase * F.lit(wavelength / (4.0 * math.pi) * 1000.0)


def distance_m(lat1: Column, lon1: Column, lat2: Column, lon2: Column, at_lat: Column) -> Column:
    """Local equirectangular distance, with the longitude scale at ``at_lat``."""
    dx = (lon1 - lon2) * METRES_LON * F.cos(F.radians(at_lat))
    dy = (lat1 - lat2) * METRES_LAT
    return F.sqrt(dx * dx + dy * dy)


def pixel_area_km2(lat: Column, lon_step: float, lat_step: float) -> Column:
    return F.lit(abs(lon_step) * METRES_LON / 1000.0) * F.cos(F.radians(lat)) * F.lit(abs(lat_step) * METRES_LAT / 1000.0)


def cyclic_days(a: Column, b: Column) -> Column:
    """Distance of two days of the year."""
    d = F.abs(a - b)
    return F.least(d, F.lit(365.25) - d)


def edge_distance(row: Column, col: Column, height: Column, width: Column) -> Column:
    return F.least(row, col, height - 1 - row, width - 1 - col)


def clock(seconds: Column) -> Column:
    """Seconds of the day as HH:MM:SS."""
    part = lambda x: F.lpad(x.cast("string"), 2, "0")
    s = seconds.cast("long") % 86400
    return F.concat_ws(":", part(F.floor(s / 3600)), part(F.floor(s % 3600 / 60)), part(s % 60))


def _once(value: Column, use) -> Column:
    """``use(value)`` with ``value`` worked out once a row, also where ``use`` takes it within a lambda."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def unit_series(values: Column) -> Column:
    """An array less its mean, at length one; a constant array stays zero."""
    mean = F.aggregate(values, F.lit(0.0), lambda a, x: a + x) / F.size(values).cast("double")
    centred = _once(mean, lambda m: F.transform(values, lambda x: x - m))
    norm = lambda c: F.sqrt(F.aggregate(c, F.lit(0.0), lambda a, x: a + x * x))
    return _once(centred, lambda c: _once(norm(c), lambda n: F.transform(c, lambda x: F.when(n > 0, x / n).otherwise(0.0))))
