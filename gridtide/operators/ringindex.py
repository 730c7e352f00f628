"""Areas cut into grid cells, so that a point is tested against a few edges only.

A cell wholly inside an area needs no test.  A border cell holds the edges that touch it and
whether its south-east corner is inside.  From the corner, the way north along the cell's east
side and then west to the point crosses the area's boundary only at those edges, so the number
of crossings tells whether the point is inside too.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Edges are listed in cells this much farther than they reach (degrees), against rounding.
MARGIN = 1e-9
EDGES = "array<struct<a:struct<lon:double,lat:double>,b:struct<lon:double,lat:double>>>"


def crossing_lon(edge: Column, lat: Column) -> Column:
    """Where an edge crosses a latitude; of use only where it spans it."""
    a, b = edge["a"], edge["b"]
    return a["lon"] + (lat - a["lat"]) * F.try_divide(b["lon"] - a["lon"], b["lat"] - a["lat"])


def spans(edge: Column, lat: Column) -> Column:
    return (edge["a"]["lat"] > lat) != (edge["b"]["lat"] > lat)


def east_of(edge: Column, lon: Column, lat: Column) -> Column:
    """Whether an edge, at a latitude or at its end nearest to it, is east of a meridian."""
    a, b = edge["a"], edge["b"]
    low_is_a = a["lat"] <= b["lat"]
    low, high = F.when(low_is_a, a).otherwise(b), F.when(low_is_a, b).otherwise(a)
    return (
        F.when(spans(edge, lat), crossing_lon(edge, lat) > lon)
        .when(lat < low["lat"], low["lon"] > lon)
        .otherwise(high["lon"] > lon)
    )


def ring_edges(regions: DataFrame) -> DataFrame:
    """``region_id, edge`` of every boundary ring; a repeated corner makes no edge."""
    corners = F.transform("ring", lambda p: F.struct(p["lon"].cast("double").alias("lon"), p["lat"].cast("double").alias("lat")))
    pairs = F.arrays_zip(
        F.slice(corners, 1, F.greatest(F.size("ring") - 1, F.lit(0))).alias("a"),
        F.slice(corners, 2, F.greatest(F.size("ring") - 1, F.lit(0))).alias("b"),
    )
    found = regions.where(F.size("ring") > 1).select("region_id", F.explode(pairs).alias("edge"))
    return found.where(F.col("edge.a") != F.col("edge.b"))


def ring_index(regions: DataFrame, cell_degrees: float = 1.0) -> DataFrame:
    """``region_id, x, y, corner_inside, edges`` of every cell an area touches.

    ``regions`` has region_id and ring (closed, ``array<struct<lon,lat>>``); rings may be
    concave.  Cells wholly inside have no edges.
    """
    size = F.lit(float(cell_degrees))
    edge = F.col("edge")
    low_lat = F.least(edge["a"]["lat"], edge["b"]["lat"])
    high_lat = F.greatest(edge["a"]["lat"], edge["b"]["lat"])

    def lon_at(lat: Column) -> Column:
        """On the edge, as far towards a latitude as it goes."""
        inside = F.greatest(low_lat, F.least(high_lat, lat))
        return F.coalesce(crossing_lon(edge, inside), edge["a"]["lon"])

    rows = ring_edges(regions).withColumn(
        "y",
        F.explode(F.sequence(F.floor((low_lat - MARGIN) / size), F.floor((high_lat + MARGIN) / size))),
    )
    south, north = F.col("y") * size, (F.col("y") + 1) * size
    level = low_lat == high_lat
    ends = [
        F.when(level, edge[end]["lon"]).otherwise(lon_at(lat)) for end, lat in (("a", south), ("b", north))
    ]
    columns = F.sequence(
        F.floor((F.least(*ends) - MARGIN) / size), F.floor((F.greatest(*ends) + MARGIN) / size)
    )
    touched = rows.select("region_id", "y", "edge", F.explode(columns).alias("x"))
    border = touched.groupBy("region_id", "x", "y").agg(F.collect_list("edge").alias("edges"))

    # where the south side of each row of cells crosses the boundary
    crossings = rows.where(spans(edge, south)).select("region_id", "y", crossing_lon(edge, south).alias("at"))
    marks = crossings.select(
        "region_id", "y", "at", F.lit(None).cast("bigint").alias("x"), F.lit(None).cast(EDGES).alias("edges")
    ).unionByName(border.select("region_id", "y", ((F.col("x") + 1) * size).alias("at"), "x", "edges"))
    # a crossing at the corner itself is not east of it
    east = Window.partitionBy("region_id", "y").orderBy(F.desc("at"), F.col("x").asc_nulls_last())
    passed = F.sum(F.when(F.col("x").isNull(), 1).otherwise(0)).over(
        east.rowsBetween(Window.unboundedPreceding, -1)
    )
    border = marks.withColumn("passed", F.coalesce(passed, F.lit(0))).where(F.col("x").isNotNull()).select(
        "region_id", "x", "y", (F.col("passed") % 2 == 1).alias("corner_inside"), "edges"
    )

    # between an odd and the next crossing, counted from the east, all corners are inside
    by_lon = Window.partitionBy("region_id", "y").orderBy("at")
    runs = crossings.select(
        "region_id", "y", "at", F.lead("at").over(by_lon).alias("to"),
        (F.count("*").over(Window.partitionBy("region_id", "y")) - F.row_number().over(by_lon)).alias("east"),
    ).where(F.col("east") % 2 == 1)
    runs = runs.withColumn("x", F.explode(F.sequence(F.floor(F.col("at") / size) - 1, F.floor(F.col("to") / size) + 1)))
    corner = (F.col("x") + 1) * size
    within = runs.where((corner >= F.col("at")) & (corner < F.col("to"))).select("region_id", "x", "y")
    whole = within.join(border.select("region_id", "x", "y"), ["region_id", "x", "y"], "left_anti")
    return border.unionByName(
        whole.select("region_id", "x", "y", F.lit(True).alias("corner_inside"), F.array().cast(EDGES).alias("edges"))
    )


def inside_cell(lat: Column, lon: Column, east: Column, south: Column, corner_inside: Column, edges: Column) -> Column:
    """Whether a point of a cell is inside an area, by the edges that touch the cell."""

    def changes(inside: Column, edge: Column) -> Column:
        at, meets = crossing_lon(edge, lat), spans(edge, lat)
        # on the way west, and on the way north
        west = meets & ((at > lon) != (at > east))
        north = east_of(edge, east, lat) != east_of(edge, east, south)
        return inside != (F.coalesce(west, F.lit(False)) != F.coalesce(north, F.lit(False)))

    return F.aggregate(edges, corner_inside, changes)


def points_in(points: DataFrame, index: DataFrame, cell_degrees: float = 1.0) -> DataFrame:
    """``point_id, region_id``: the areas of ``ring_index`` that each point lies in.

    A point meets the areas of its own cell, each with the edges there and no others; cells
    with many points are split by adaptive execution, as the index side is small.
    """
    size = F.lit(float(cell_degrees))
    placed = points.withColumns({"x": F.floor(F.col("lon") / size), "y": F.floor(F.col("lat") / size)})
    found = placed.join(index, ["x", "y"])
    inside = inside_cell(
        F.col("lat"), F.col("lon"), (F.col("x") + 1) * size, F.col("y") * size,
        F.col("corner_inside"), F.col("edges"),
    )
    return found.where(inside).select("point_id", "region_id")
