"""Polygon functions over ring arrays.

A geometry is ``array<array<array<array<double>>>>``: polygons, rings, vertices and
the two coordinates. The first ring of a polygon is its shell, the rest are holes;
rings are closed. Everything is a Column expression on one row, so no geometry
operator here needs a shuffle.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from verdure.functions import projection
from verdure.functions.projection import let

GEOM_TYPE = "array<array<array<array<double>>>>"


def map_vertices(geom: Column, fn: Callable[[Column, Column], Column]) -> Column:
    """Apply ``fn(x, y) -> array(x, y)`` to every vertex."""
    return F.transform(
        geom,
        lambda poly: F.transform(poly, lambda ring: F.transform(ring, lambda p: fn(p[0], p[1]))),
    )


def project_metres(geom: Column) -> Column:
    """EPSG:4326 geometry to EPSG:3035 metres."""
    return map_vertices(geom, projection.laea_forward)


def normalize_crs(geom: Column, crs: Column) -> Column:
    """Geometry in degrees whatever its CRS name; a missing name is taken as EPSG:4326."""
    epsg = projection.crs_epsg(crs)
    return F.when(epsg == 4326, geom).otherwise(
        map_vertices(geom, lambda x, y: projection.to_lonlat(x, y, epsg))
    )


def bounds(geom: Column) -> Column:
    """struct(xmin, ymin, xmax, ymax) over all vertices."""
    vertices = F.flatten(F.flatten(geom))
    return let(
        F.struct(
            F.transform(vertices, lambda p: p[0]).alias("xs"),
            F.transform(vertices, lambda p: p[1]).alias("ys"),
        ),
        lambda v: F.struct(
            F.array_min(v["xs"]).alias("xmin"),
            F.array_min(v["ys"]).alias("ymin"),
            F.array_max(v["xs"]).alias("xmax"),
            F.array_max(v["ys"]).alias("ymax"),
        ),
    )


def ring_edges(ring: Column) -> Column:
    """array of struct(x1, y1, x2, y2) along a closed ring."""
    steps = F.greatest(F.size(ring) - 1, F.lit(0))
    return F.zip_with(
        F.slice(ring, F.lit(1), steps),
        F.slice(ring, F.lit(2), steps),
        lambda a, b: F.struct(
            a[0].alias("x1"), a[1].alias("y1"), b[0].alias("x2"), b[1].alias("y2")
        ),
    )


def edges(geom: Column) -> Column:
    """Edges of all rings, holes included, as one array."""
    return F.flatten(F.transform(F.flatten(geom), ring_edges))


def _sum(items: Column, fn: Callable[[Column], Column]) -> Column:
    return F.aggregate(items, F.lit(0.0), lambda acc, e: acc + fn(e))


def centroid(geom: Column) -> Column:
    """struct(x, y): area-weighted planar centroid; holes subtract.

    Vertices are shifted to the first one before multiplying, which keeps the
    digits that large map coordinates would otherwise cancel. A geometry without
    area falls back to its length-weighted outline, a single point to itself.
    """

    def cross(e: Column) -> Column:
        return e["x1"] * e["y2"] - e["x2"] * e["y1"]

    def ring_moments(ring: Column, index: Column) -> Column:
        return let(
            ring_edges(ring),
            lambda es: let(
                F.struct(
                    _sum(es, cross).alias("a"),
                    _sum(es, lambda e: (e["x1"] + e["x2"]) * cross(e)).alias("mx"),
                    _sum(es, lambda e: (e["y1"] + e["y2"]) * cross(e)).alias("my"),
                ),
                lambda m: let(
                    # a shell counts positive and a hole negative, whichever way it winds
                    F.signum(m["a"]) * F.when(index == 0, 1.0).otherwise(-1.0),
                    lambda sign: F.struct(
                        (sign * m["a"]).alias("a"),
                        (sign * m["mx"]).alias("mx"),
                        (sign * m["my"]).alias("my"),
                    ),
                ),
            ),
        )

    def by_area(moments: Column) -> Column:
        return F.struct(
            _sum(moments, lambda m: m["a"]).alias("w"),
            (_sum(moments, lambda m: m["mx"]) / 3).alias("sx"),
            (_sum(moments, lambda m: m["my"]) / 3).alias("sy"),
        )

    def by_length(shifted: Column) -> Column:
        def length(e: Column) -> Column:
            return F.hypot(e["x2"] - e["x1"], e["y2"] - e["y1"])

        return let(
            edges(shifted),
            lambda es: F.struct(
                _sum(es, length).alias("w"),
                _sum(es, lambda e: length(e) * (e["x1"] + e["x2"]) / 2).alias("sx"),
                _sum(es, lambda e: length(e) * (e["y1"] + e["y2"]) / 2).alias("sy"),
            ),
        )

    def point(origin: Column, s: Column) -> Column:
        return F.struct(
            (origin[0] + s["sx"] / s["w"]).alias("x"), (origin[1] + s["sy"] / s["w"]).alias("y")
        )

    def from_shifted(origin: Column, shifted: Column) -> Column:
        moments = F.flatten(F.transform(shifted, lambda poly: F.transform(poly, ring_moments)))
        return let(
            by_area(moments),
            lambda s: F.when(s["w"] != 0, point(origin, s)).otherwise(
                let(
                    by_length(shifted),
                    lambda line: F.when(line["w"] != 0, point(origin, line)).otherwise(
                        F.struct(origin[0].alias("x"), origin[1].alias("y"))
                    ),
                )
            ),
        )

    return let(
        geom[0][0][0],
        lambda o: let(
            map_vertices(geom, lambda x, y: F.array(x - o[0], y - o[1])),
            lambda shifted: from_shifted(o, shifted),
        ),
    )


def padded_lonlat_box(b: Column, padding: float) -> Column:
    """Degrees box around the four corners of a metre box widened by ``padding``.

    Only the corners are projected back; the box sides are not densified.
    """
    west, south = b["xmin"] - padding, b["ymin"] - padding
    east, north = b["xmax"] + padding, b["ymax"] + padding
    corners = F.array(
        *(projection.laea_inverse(x, y) for x in (west, east) for y in (south, north))
    )
    return let(
        corners,
        lambda c: F.array(
            F.array_min(F.transform(c, lambda p: p[0])),
            F.array_min(F.transform(c, lambda p: p[1])),
            F.array_max(F.transform(c, lambda p: p[0])),
            F.array_max(F.transform(c, lambda p: p[1])),
        ),
    )


def from_geojson(kind: Column, coordinates: Column) -> Column:
    """GeoJSON geometry type and coordinate text to the ring-array form."""
    return (
        F.when(kind == "MultiPolygon", F.from_json(coordinates, GEOM_TYPE))
        .when(kind == "Polygon", F.array(F.from_json(coordinates, "array<array<array<double>>>")))
        .otherwise(
            F.raise_error(F.concat(F.lit("unsupported geometry type: "), kind)).cast(GEOM_TYPE)
        )
    )


def to_geojson(geom: Column) -> Column:
    """GeoJSON geometry text; one polygon is written as Polygon."""
    return F.when(
        F.size(geom) == 1,
        F.to_json(F.struct(F.lit("Polygon").alias("type"), geom[0].alias("coordinates"))),
    ).otherwise(F.to_json(F.struct(F.lit("MultiPolygon").alias("type"), geom.alias("coordinates"))))
