"""Adaptive cover of zones by grid cells, and points found through it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geo
from ..session import Scratch
from .spatial import REFERENCE, cells_of_box

# A cell with more edges is cut into four; none is smaller than two to this power.
MOST_EDGES = 24
LEAST_EXPONENT, MOST_EXPONENT = -24, 40
EPS = 1e-9


def _size(exponent: Column) -> Column:
    """Cell sizes are powers of two, so that cells lie in their parents exactly."""
    return F.pow(F.lit(2.0), exponent)


def _touching(edges: Column, cx: Column, cy: Column, size: Column) -> Column:
    def touches(e: Column) -> Column:
        (ax, ay), (bx, by) = ((e[v]["x"], e[v]["y"]) for v in ("a", "b"))
        return (
            (F.least(ax, bx) <= (cx + 1) * size + EPS) & (F.greatest(ax, bx) >= cx * size - EPS)
            & (F.least(ay, by) <= (cy + 1) * size + EPS) & (F.greatest(ay, by) >= cy * size - EPS)
        )

    return F.filter(edges, touches)


def _reference(cx: Column, cy: Column, size: Column) -> tuple[Column, Column]:
    return (cx + REFERENCE[0]) * size, (cy + REFERENCE[1]) * size


def _first_cells(zones: DataFrame) -> DataFrame:
    """At most four cells a zone, no smaller than its box."""
    rest = [c for c in zones.columns if c != "geometry"]
    extent = F.greatest(F.col("_b.maxx") - F.col("_b.minx"), F.col("_b.maxy") - F.col("_b.miny"))
    exponent = F.ceil(F.log2(F.when(extent > 0, extent)))
    out = (
        zones.select(*rest, geo.polygon_edges(F.col("geometry")).alias("_all"), geo.bounds(F.col("geometry")).alias("_b"))
        .withColumn("_e", F.least(F.lit(MOST_EXPONENT), F.greatest(F.lit(LEAST_EXPONENT), exponent)).cast("int"))
        .withColumn("_s", _size(F.col("_e")))
        .withColumn("_c", F.explode(cells_of_box(F.col("_b.minx"), F.col("_b.miny"), F.col("_b.maxx"), F.col("_b.maxy"), F.col("_s"))))
        .withColumns({"_cx": F.col("_c.cx"), "_cy": F.col("_c.cy")})
    )
    x, y = _reference(F.col("_cx"), F.col("_cy"), F.col("_s"))
    return out.select(
        *rest, "_b", "_e", "_cx", "_cy", (geo.crossings(F.col("_all"), x, y) % 2 == 1).alias("_inside"),
        _touching(F.col("_all"), F.col("_cx"), F.col("_cy"), F.col("_s")).alias("_edges"),
    ).where(F.col("_inside") | (F.size("_edges") > 0))


def _quarters(cells: DataFrame) -> DataFrame:
    """The four cells of each cell with the edges that touch them; where there are none, only those that lie inside.

    A cell's reference point is inside if the way from its parent's crosses the parent's edges an even number of times
    and the parent's is inside, or an odd number and it is not.
    """
    half = _size(F.col("_e") - 1)
    px, py = _reference(F.col("_cx"), F.col("_cy"), _size(F.col("_e")))

    def quarter(i: int, j: int) -> Column:
        cx, cy = F.col("_cx") * 2 + i, F.col("_cy") * 2 + j
        odd = geo.crossed(F.col("_edges"), px, py, *_reference(cx, cy, half)) % 2 == 1
        return F.struct(cx.alias("_cx"), cy.alias("_cy"), (F.col("_inside") != odd).alias("_inside"), _touching(F.col("_edges"), cx, cy, half).alias("_edges"))

    rest = [c for c in cells.columns if c not in ("_e", "_cx", "_cy", "_inside", "_edges")]
    out = cells.withColumn("_q", F.explode(F.array(*[quarter(i, j) for i in (0, 1) for j in (0, 1)])))
    return out.select(*rest, (F.col("_e") - 1).alias("_e"), "_q.*").where(F.col("_inside") | (F.size("_edges") > 0))


def adaptive_cover(zones: DataFrame, most_edges: int = MOST_EDGES) -> DataFrame:
    """Cells of each zone: its other columns, box _b, exponent _e, place _cx and _cy, _inside and _edges.

    The cover is built from the edges down: a zone begins with the few cells of its own size, and a cell is cut into four
    only while it has more than ``most_edges`` edges. Cells without edges lie wholly inside and stay as large as they
    are. So the work follows the edges, whatever the extent of a zone, and a cell carries few of them, whatever the
    number of its zone's vertices. No round shuffles anything.
    """
    scratch = Scratch(zones.sparkSession, "cover")
    crowded = (F.size("_edges") > most_edges) & (F.col("_e") > LEAST_EXPONENT)
    cells = scratch.table(_first_cells(zones), "cells")
    done = cells.where(~crowded)
    while cells.where(crowded).limit(1).count():
        cells = scratch.table(_quarters(cells.where(crowded)), "cells")
        done = done.unionByName(cells.where(~crowded))
    return done


def points_in_zones(points: DataFrame, zones: DataFrame, boundary: bool = False, most_edges: int = MOST_EDGES) -> DataFrame:
    """Points joined to the zones that hold them, one row per (point, zone).

    ``points``: any key columns, lon, lat. ``zones``: geometry (dropped) and further columns, which pass through.
    ``boundary=True`` also takes points on a zone's edge. Zones of any sizes may be mixed.

    A point meets the cells around it, one a size. Which sizes there are is looked up by the point's cell of a middle
    size; the few sizes above the middle are tried everywhere. A hot cell is split by the adaptive skew join.
    """
    cover = adaptive_cover(zones, most_edges)
    sizes = cover.agg(F.percentile_approx("_e", 0.5).alias("middle"), F.collect_set("_e").alias("all")).first()
    middle = sizes.middle
    if middle is None:
        middle, large = 0, []
    else:
        large = sorted(e for e in sizes.all if e > middle)
    # The prefix of a cell's place is that of the cell it lies in.
    up = F.pow(F.lit(2.0), F.lit(middle) - F.col("_e")).cast("long")
    prefix = lambda c: F.floor(F.col(c) / up)
    near = (
        cover.where(F.col("_e") <= middle).groupBy(prefix("_cx").alias("_px"), prefix("_cy").alias("_py")).agg(F.collect_set("_e").alias("_small"))
    )
    s = _size(F.lit(middle))
    few = F.array(*[F.lit(e) for e in large]).cast("array<int>")
    placed = (
        points.withColumns({"_px": F.floor(F.col("lon") / s), "_py": F.floor(F.col("lat") / s)})
        .join(near, ["_px", "_py"], "left")
        .withColumn("_e", F.explode(F.concat(few, F.coalesce("_small", F.array().cast("array<int>")))))
        .drop("_px", "_py", "_small")
    )
    own = _size(F.col("_e"))
    placed = placed.withColumns({"_cx": F.floor(F.col("lon") / own), "_cy": F.floor(F.col("lat") / own)})
    x, y = F.col("lon"), F.col("lat")
    joined = placed.join(cover, ["_e", "_cx", "_cy"]).where(
        x.between(F.col("_b.minx"), F.col("_b.maxx")) & y.between(F.col("_b.miny"), F.col("_b.maxy"))
    )
    odd = geo.crossed(F.col("_edges"), x, y, *_reference(F.col("_cx"), F.col("_cy"), own)) % 2 == 1
    inside, on_edge = odd != F.col("_inside"), geo.on_boundary(F.col("_edges"), x, y)
    return joined.where((inside | on_edge) if boundary else (inside & ~on_edge)).drop("_e", "_cx", "_cy", "_edges", "_inside", "_b")
