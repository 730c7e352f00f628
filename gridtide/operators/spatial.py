"""Nearest station, stations around a point and region of a point, without cross joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geo
from . import ringindex

# Cell sizes in degrees, each an eighth of the one before; the first covers the globe
# with 23 x 12 cells, the last is about 7 m wide.
LEVELS = (16.0, 2.0, 0.25, 0.03125, 0.00390625, 0.00048828125, 0.00006103515625)
_SLACK_KM = 1e-4


def _cell(lat: Column, lon: Column, size: float) -> Column:
    return F.struct(
        F.floor((lat + 90) / size).alias("y"), F.floor((lon + 180) / size).alias("x")
    )


def _summaries(points: DataFrame) -> list[DataFrame]:
    """Per level the occupied cells: their parent, tight box and one station in them."""
    levels = []
    source = points.select(
        "lat",
        "lon",
        F.col("lat").alias("lat_min"),
        F.col("lat").alias("lat_max"),
        F.col("lon").alias("lon_min"),
        F.col("lon").alias("lon_max"),
    )
    for size, parent in reversed(list(zip(LEVELS, (None, *LEVELS[:-1])))):
        keys = [_cell(F.col("lat"), F.col("lon"), size).alias("cell")]
        if parent:
            keys.append(_cell(F.col("lat"), F.col("lon"), parent).alias("parent"))
        # any station of the cell may stand for it: the pair of the smallest one does
        one = F.min(F.struct("lat", "lon"))
        source = (
            source.groupBy(*keys)
            .agg(
                one.alias("_one"),
                F.min("lat_min").alias("lat_min"),
                F.max("lat_max").alias("lat_max"),
                F.min("lon_min").alias("lon_min"),
                F.max("lon_max").alias("lon_max"),
            )
            .select("*", "_one.lat", "_one.lon")
            .drop("_one")
        )
        levels.insert(0, source)
    return levels


def _prune(candidates: DataFrame) -> DataFrame:
    """Keep the cells of each site that may hold its nearest station."""
    reach = geo.distance_km(F.col("s_lat"), F.col("s_lon"), F.col("lat"), F.col("lon"))
    bound = geo.box_distance_bound_km(
        F.col("s_lat"), F.col("s_lon"),
        F.col("lat_min"), F.col("lat_max"), F.col("lon_min"), F.col("lon_max"),
    )
    best = F.min("_reach").over(Window.partitionBy("s_lat", "s_lon"))
    return (
        candidates.select("s_lat", "s_lon", "cell", reach.alias("_reach"), bound.alias("_bound"))
        .withColumn("_best", best)
        .where(F.col("_bound") <= F.col("_best") + _SLACK_KM)
        .select("s_lat", "s_lon", "cell")
    )


#: False for NULL, NaN and anything outside the globe, so the root level stays bounded.
ON_GLOBE = "coalesce(lat BETWEEN -90 AND 90 AND lon BETWEEN -180 AND 180, false)"


def nearest_station(sites: DataFrame, stations: DataFrame) -> DataFrame:
    """Nearest station of every site, ties by smallest station id; exact at any distance.

    ``sites`` has site_id, lat, lon; ``stations`` has station_id, lat, lon.  Coordinates
    are reduced to distinct points first, so many copies of a place count once.  Each site
    then descends through ever smaller cells.  A cell's tight box gives a lower bound of
    the distance and one of its stations an upper bound; cells that cannot win are dropped
    at every level.  A site carries a few cells, and each splits into at most 64, however
    many stations a cell holds.

    Stations without coordinates on the globe take no part; sites without them, and all
    sites if there is no station, stay with NULL station and distance.
    """
    points = stations.where(ON_GLOBE).groupBy("lat", "lon").agg(
        F.min("station_id").alias("station_id")
    )
    places = (
        sites.where(ON_GLOBE)
        .select(F.col("lat").alias("s_lat"), F.col("lon").alias("s_lon"))
        .distinct()
    )
    levels = _summaries(points)
    # the first level has at most 276 cells by construction: one constant array
    root = levels[0].agg(F.collect_list(F.struct(*levels[0].columns)).alias("a")).scalar()
    candidates = _prune(places.withColumn("_c", F.explode(root)).select("s_lat", "s_lon", "_c.*"))
    for cells in levels[1:]:
        children = candidates.withColumnRenamed("cell", "parent").join(cells, "parent")
        candidates = _prune(children)

    last = points.withColumn("cell", _cell(F.col("lat"), F.col("lon"), LEVELS[-1]))
    away = geo.distance_km(F.col("s_lat"), F.col("s_lon"), F.col("lat"), F.col("lon"))
    # distances are compared to the millimetre, so equal ones tie in every run
    found = (
        candidates.join(last, "cell")
        .groupBy("s_lat", "s_lon")
        .agg(F.min(F.struct(F.round(away, 6).alias("km"), "station_id")).alias("_n"))
        .select(
            F.col("s_lat").alias("lat"),
            F.col("s_lon").alias("lon"),
            F.col("_n.station_id").alias("station_id"),
            F.col("_n.km").alias("distance_km"),
        )
    )
    return sites.join(found, ["lat", "lon"], "left").select("site_id", "station_id", "distance_km")


def stations_near(
    stations: DataFrame, lat: float, lon: float, radius_km: float = 50, limit: int = 25
) -> DataFrame:
    """Stations in the bounding box of a point, nearest first, at most ``limit``."""
    here_lat, here_lon = F.lit(float(lat)), F.lit(float(lon))
    box = geo.bounding_box(here_lat, here_lon, F.lit(float(radius_km)))
    away = geo.distance_km(here_lat, here_lon, F.col("lat"), F.col("lon"))
    return (
        stations.where(geo.in_box(F.col("lat"), F.col("lon"), box))
        .withColumn("distance_km", F.round(away, 6))
        .orderBy("distance_km", "station_id")
        .limit(limit)
    )


def region_of_point(points: DataFrame, regions: DataFrame, cell_degrees: float = 1.0):
    """Regions whose boundary ring contains each point.

    ``points`` has point_id, lat, lon; ``regions`` has region_id and ring (closed,
    ``array<struct<lon,lat>>``).
    """
    return ringindex.points_in(points, ringindex.ring_index(regions, cell_degrees), cell_degrees)
