"""Distance on the sphere."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_KM = 6371.0


def _half_chord(angle: Column) -> Column:
    half = F.sin(angle / 2.0)
    return half * half


def haversine_km(lat_a: str, lng_a: str, lat_b: str, lng_b: str) -> Column:
    """Great-circle distance in km, two decimals; NULL if a coordinate is missing.

    The argument of asin is held at 1, where rounding would make antipodal points NaN.
    """
    phi_a, phi_b = F.radians(lat_a), F.radians(lat_b)
    turn = F.radians(lng_b) - F.radians(lng_a)
    chord = _half_chord(phi_b - phi_a) + F.cos(phi_a) * F.cos(phi_b) * _half_chord(turn)
    km = F.lit(2 * EARTH_RADIUS_KM) * F.asin(F.sqrt(F.least(F.lit(1.0), chord)))
    # least() skips NULL and would turn a missing coordinate into half the globe.
    return F.when(chord.isNotNull(), F.round(km, 2))
