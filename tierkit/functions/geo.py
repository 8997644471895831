"""Great-circle distance."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tierkit.functions._columns import as_column

# Earth radius in miles, and kilometres per mile.
EARTH_RADIUS_MI = 3961
UNIT_FACTOR = {"mi": 1.0, "km": 1.60934}


def haversine_distance(lat1, lon1, lat2, lon2, unit: str = "mi") -> Column:
    if unit not in UNIT_FACTOR:
        raise ValueError(f"unit must be one of {sorted(UNIT_FACTOR)}, got {unit!r}")
    lat1, lon1, lat2, lon2 = map(as_column, (lat1, lon1, lat2, lon2))

    def half_chord(a: Column, b: Column) -> Column:
        s = F.sin(F.radians(b - a) / 2)
        return s * s

    chord = half_chord(lat1, lat2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half_chord(lon1, lon2)
    # rounding can push antipodal points a hair above 1, where asin is NaN
    return F.asin(F.sqrt(F.least(chord, F.lit(1.0)))) * (2 * EARTH_RADIUS_MI * UNIT_FACTOR[unit])
