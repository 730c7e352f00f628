"""Column functions on coordinates in degrees."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: Earth radius, kilometres per degree, smallest cosine ----------
EARTH_KM = 6371.0
KM_PER_DEGREE = 111.0
MIN_COSINE = 0.01


def distance_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance by the haversine formula."""
    up = F.sin(F.radians(lat2 - lat1) / 2)
    across = F.sin(F.radians(lon2 - lon1) / 2)
    chord = up * up + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * across * across
    # rounding can lift the chord of points that face each other just over 1
    return F.lit(2 * EARTH_KM) * F.atan2(F.sqrt(chord), F.sqrt(F.greatest(F.lit(0.0), 1 - chord)))


def bounding_box(lat: Column, lon: Column, radius_km: Column) -> Column:
    """Struct lat_min, lon_min, lat_max, lon_max around a point."""
    half_lat = radius_km / KM_PER_DEGREE
    half_lon = radius_km / (KM_PER_DEGREE * F.greatest(F.lit(MIN_COSINE), F.cos(F.radians(lat))))
    return F.struct(
        (lat - half_lat).alias("lat_min"),
        (lon - half_lon).alias("lon_min"),
        (lat + half_lat).alias("lat_max"),
        (lon + half_lon).alias("lon_max"),
    )


def in_box(lat: Column, lon: Column, box: Column) -> Column:
    return lat.between(box["lat_min"], box["lat_max"]) & lon.between(
        box["lon_min"], box["lon_max"]
    )


def box_distance_bound_km(
    lat: Column, lon: Column, lat_min: Column, lat_max: Column, lon_min: Column, lon_max: Column
) -> Column:
    """A distance no point of the box can be nearer than.

    Two bounds hold at once: the gap in latitude, and the distance to the nearest
    meridian of the box, asin(cos(lat) * sin(gap)) for gaps up to a quarter turn.
    """
    zero = F.lit(0.0)
    lat_gap = F.greatest(zero, lat_min - lat, lat - lat_max)
    east = F.greatest(zero, lon_min - lon, lon - lon_max)
    around = F.greatest(
        zero, F.least(F.abs(lon_min + 360 - lon), F.abs(lon + 360 - lon_max))
    )
    lon_gap = F.least(F.lit(90.0), east, around)
    meridian = F.asin(F.cos(F.radians(lat)) * F.sin(F.radians(lon_gap)))
    return F.lit(EARTH_KM) * F.greatest(F.radians(lat_gap), meridian)


def inside_ring(lat: Column, lon: Column, ring: Column) -> Column:
    """True when a point lies inside a closed ring ``array<struct<lon,lat>>``.

    Counts the edges that a ray towards the east crosses; an odd number means inside.
    """
    edges = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size(ring) - 1))

    def crossing(count: Column, i: Column) -> Column:
        a, b = F.get(ring, i - 1), F.get(ring, i)
        spans = (a["lat"] > lat) != (b["lat"] > lat)
        at = a["lon"] + (lat - a["lat"]) * F.try_divide(b["lon"] - a["lon"], b["lat"] - a["lat"])
        return count + F.when(spans & (lon < at), 1).otherwise(0)

    return F.aggregate(edges, F.lit(0), crossing) % 2 == 1
