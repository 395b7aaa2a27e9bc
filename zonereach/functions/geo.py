"""Planar geometry on rings: a ring is ``array<struct<x:double,y:double>>``, closed (last vertex = first).

A polygon is an ``array`` of rings; shells run counter-clockwise and holes clockwise, so signed sums
subtract the holes. Several parts are several shells, each followed by its holes.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_M = 6378137.0
RING = "array<struct<x:double,y:double>>"


def mercator_x(lon: Column) -> Column:
    return F.radians(lon) * EARTH_RADIUS_M


def mercator_y(lat: Column) -> Column:
    return F.log(F.tan(F.radians(lat) / 2 + math.pi / 4)) * EARTH_RADIUS_M


def lon_of(x: Column) -> Column:
    return F.degrees(x / EARTH_RADIUS_M)


def lat_of(y: Column) -> Column:
    return F.degrees(F.atan(F.exp(y / EARTH_RADIUS_M)) * 2 - math.pi / 2)


def point(x: Column, y: Column) -> Column:
    return F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))


def ring_to_mercator(ring: Column) -> Column:
    return F.transform(ring, lambda p: point(mercator_x(p["x"]), mercator_y(p["y"])))


def polygon_to_mercator(rings: Column) -> Column:
    return F.transform(rings, ring_to_mercator)


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def ring_edges(ring: Column) -> Column:
    """Consecutive vertex pairs as ``array<struct<a,b>>``."""
    n = F.size(ring)
    return F.zip_with(
        F.slice(ring, F.lit(1), n - 1), F.slice(ring, F.lit(2), n - 1), lambda a, b: F.struct(a.alias("a"), b.alias("b"))
    )


def polygon_edges(rings: Column) -> Column:
    return F.flatten(F.transform(rings, ring_edges))


def _moved_edges(rings: Column) -> Column:
    """Edges as struct(ax, ay, bx, by) seen from the polygon's first vertex, which keeps cross products small."""

    def moved(r: Column, o: Column) -> Column:
        return F.transform(
            polygon_edges(r),
            lambda e: F.struct(
                (e["a"]["x"] - o["x"]).alias("ax"),
                (e["a"]["y"] - o["y"]).alias("ay"),
                (e["b"]["x"] - o["x"]).alias("bx"),
                (e["b"]["y"] - o["y"]).alias("by"),
            ),
        )

    return let(rings, lambda r: let(r[0][0], lambda o: moved(r, o)))


def _cross(e: Column) -> Column:
    return e["ax"] * e["by"] - e["bx"] * e["ay"]


def signed_area(rings: Column) -> Column:
    """Shoelace area; counter-clockwise rings are positive."""
    return F.aggregate(_moved_edges(rings), F.lit(0.0), lambda acc, e: acc + _cross(e)) / 2


def area(rings: Column) -> Column:
    return F.abs(signed_area(rings))


def centroid(rings: Column) -> Column:
    """Area centroid as struct(x, y); NULL for a polygon without area."""

    def of(r: Column) -> Column:
        sums = F.aggregate(
            _moved_edges(r),
            F.struct(F.lit(0.0).alias("s"), F.lit(0.0).alias("cx"), F.lit(0.0).alias("cy")),
            lambda acc, e: F.struct(
                (acc["s"] + _cross(e)).alias("s"),
                (acc["cx"] + (e["ax"] + e["bx"]) * _cross(e)).alias("cx"),
                (acc["cy"] + (e["ay"] + e["by"]) * _cross(e)).alias("cy"),
            ),
        )
        return let(
            sums,
            lambda t: point(
                r[0][0]["x"] + F.try_divide(t["cx"], 3 * t["s"]), r[0][0]["y"] + F.try_divide(t["cy"], 3 * t["s"])
            ),
        )

    return let(rings, of)


def centroid_lonlat(rings: Column) -> Column:
    """Centroid computed in Web Mercator and returned in degrees."""
    return let(centroid(polygon_to_mercator(rings)), lambda p: point(lon_of(p["x"]), lat_of(p["y"])))


def bounds(rings: Column) -> Column:
    def ends(pts: Column) -> Column:
        xs, ys = F.transform(pts, lambda p: p["x"]), F.transform(pts, lambda p: p["y"])
        return F.struct(
            F.array_min(xs).alias("minx"),
            F.array_min(ys).alias("miny"),
            F.array_max(xs).alias("maxx"),
            F.array_max(ys).alias("maxy"),
        )

    return let(F.flatten(rings), ends)


def box(minx: Column, miny: Column, maxx: Column, maxy: Column) -> Column:
    """Closed rectangular polygon from four numbers."""
    return F.array(
        F.array(point(minx, miny), point(maxx, miny), point(maxx, maxy), point(minx, maxy), point(minx, miny))
    )


def square_around(minx: Column, miny: Column, maxx: Column, maxy: Column) -> Column:
    """Square with the centre of the box and half-width max(width, height) / 2."""
    cx, cy = (minx + maxx) / 2, (miny + maxy) / 2
    d = F.greatest(maxx - minx, maxy - miny) / 2
    return F.struct(
        cx.alias("cx"),
        cy.alias("cy"),
        (cx - d).alias("minx"),
        (cy - d).alias("miny"),
        (cx + d).alias("maxx"),
        (cy + d).alias("maxy"),
    )


def crossings(edges: Column, x: Column, y: Column) -> Column:
    """Edges met by the ray from (x, y) towards +x."""
    return F.aggregate(
        edges,
        F.lit(0),
        lambda acc, e: acc
        + F.when(
            ((e["a"]["y"] > y) != (e["b"]["y"] > y))
            & (
                x
                < e["a"]["x"]
                + F.try_divide((y - e["a"]["y"]) * (e["b"]["x"] - e["a"]["x"]), e["b"]["y"] - e["a"]["y"])
            ),
            1,
        ).otherwise(0),
    )


def on_boundary(edges: Column, x: Column, y: Column, eps: float = 1e-12) -> Column:
    return F.exists(
        edges,
        lambda e: (
            F.abs((e["b"]["x"] - e["a"]["x"]) * (y - e["a"]["y"]) - (e["b"]["y"] - e["a"]["y"]) * (x - e["a"]["x"]))
            <= eps
        )
        & x.between(F.least(e["a"]["x"], e["b"]["x"]) - eps, F.greatest(e["a"]["x"], e["b"]["x"]) + eps)
        & y.between(F.least(e["a"]["y"], e["b"]["y"]) - eps, F.greatest(e["a"]["y"], e["b"]["y"]) + eps),
    )


def contains(edges: Column, x: Column, y: Column, boundary: bool = False) -> Column:
    """Point in polygon by its ``polygon_edges``; ``boundary`` says whether points on an edge count."""
    inside = crossings(edges, x, y) % 2 == 1
    edge = on_boundary(edges, x, y)
    return (inside | edge) if boundary else (inside & ~edge)


def crossed(edges: Column, x: Column, y: Column, rx: Column, ry: Column) -> Column:
    """Edges that the segment from (x, y) to (rx, ry) crosses; a vertex on its line counts to one side throughout."""

    def left(ax: Column, ay: Column, bx: Column, by: Column, px: Column, py: Column) -> Column:
        return (bx - ax) * (py - ay) - (by - ay) * (px - ax) > 0

    def meets(e: Column) -> Column:
        ends = [(e[v]["x"], e[v]["y"]) for v in ("a", "b")]
        sides = [left(x, y, rx, ry, *p) for p in ends]
        return (sides[0] != sides[1]) & (left(*ends[0], *ends[1], x, y) != left(*ends[0], *ends[1], rx, ry))

    return F.size(F.filter(edges, meets))


def _ring_area(ring: Column) -> Column:
    """Signed shoelace sum of one ring, seen from its first vertex."""
    return F.aggregate(
        ring_edges(ring),
        F.lit(0.0),
        lambda acc, e: acc
        + (e["a"]["x"] - ring[0]["x"]) * (e["b"]["y"] - ring[0]["y"])
        - (e["b"]["x"] - ring[0]["x"]) * (e["a"]["y"] - ring[0]["y"]),
    )


def parse_wkt(wkt: Column) -> Column:
    """``POLYGON`` or ``MULTIPOLYGON`` text to rings; NULL for an empty one.

    Shells are turned counter-clockwise and holes clockwise, whatever the text has, so the rings of all parts stand
    in one array: a shell opens a part and its holes follow. Sums, bounds and containment need no more than that.
    """
    body = F.regexp_replace(wkt, r"(?i)^\s*(multipolygon\s*\(|polygon)\s*\(\s*\(", "")
    body = F.regexp_replace(body, r"\)\s*\)(\s*\))?\s*$", "")

    def ring_of(text: Column) -> Column:
        return F.transform(
            F.split(text, r"\s*,\s*"),
            lambda v: let(F.split(F.trim(v), r"\s+"), lambda n: point(n[0].cast("double"), n[1].cast("double"))),
        )

    def turned(ring: Column, hole: Column) -> Column:
        return F.when((_ring_area(ring) < 0) != hole, F.reverse(ring)).otherwise(ring)

    parts = F.transform(
        F.split(body, r"\)\s*\)\s*,\s*\(\s*\("),
        lambda part: F.transform(
            F.split(part, r"\)\s*,\s*\("), lambda text, i: let(ring_of(text), lambda ring: turned(ring, i > 0))
        ),
    )
    return F.when(~F.lower(wkt).rlike(r"empty\s*$"), F.flatten(parts))


def polygon_parts(rings: Column) -> Column:
    """Rings grouped by part: every shell with its holes."""
    shells = F.filter(F.transform(rings, lambda r, i: F.when(_ring_area(r) > 0, i)), lambda i: i.isNotNull())
    return F.transform(
        shells,
        lambda at, k: F.slice(rings, at + 1, F.coalesce(F.get(shells, k + 1), F.size(rings)) - at),
    )


def to_wkt(rings: Column) -> Column:
    def text(part: Column) -> Column:
        ring_text = F.transform(
            part,
            lambda ring: F.concat(
                F.lit("("),
                F.array_join(
                    F.transform(ring, lambda p: F.concat_ws(" ", p["x"].cast("string"), p["y"].cast("string"))), ", "
                ),
                F.lit(")"),
            ),
        )
        return F.concat(F.lit("("), F.array_join(ring_text, ", "), F.lit(")"))

    return let(
        F.transform(polygon_parts(rings), text),
        lambda parts: F.when(F.size(parts) > 1, F.concat(F.lit("MULTIPOLYGON ("), F.array_join(parts, ", "), F.lit(")"))).otherwise(
            F.concat(F.lit("POLYGON "), F.get(parts, F.lit(0)))
        ),
    )
