"""Spatial joins by grid cells: no pair is formed outside a shared cell, and hot cells are salted."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geo

# A cell with more points than this is spread over several tasks.
HOT_ROWS = 1_000_000


def cells_of_box(minx: Column, miny: Column, maxx: Column, maxy: Column, size: Column) -> Column:
    """Array of (cx, cy) grid cells that a box touches."""
    return F.flatten(
        F.transform(
            F.sequence(F.floor(minx / size), F.floor(maxx / size)),
            lambda cx: F.transform(
                F.sequence(F.floor(miny / size), F.floor(maxy / size)),
                lambda cy: F.struct(cx.alias("cx"), cy.alias("cy")),
            ),
        )
    )


def salted_join(
    many: DataFrame, few: DataFrame, on: Sequence[str], salt_from: Sequence[str], hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Inner join in which the keys that are hot in ``many`` are split over several tasks.

    Every key with more than ``hot_rows`` rows is split into parts of about that size. The list of such keys is joined
    without a hint, as its length grows with the data. The salt is a hash of ``salt_from``, so a recomputed task gives
    the same rows; ``few`` is repeated only for hot keys.
    """
    on = list(on)
    hot = (
        many.groupBy(*on)
        .agg(F.count("*").alias("_n"))
        .where(F.col("_n") > hot_rows)
        .select(*on, F.ceil(F.col("_n") / hot_rows).cast("int").alias("_salts"))
    )
    salts = F.coalesce(F.col("_salts"), F.lit(1))
    left = many.join(hot, on, "left").withColumn("_salt", F.pmod(F.xxhash64(*salt_from), salts).cast("int"))
    right = few.join(hot, on, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), salts - 1)))
    return left.drop("_salts").join(right.drop("_salts"), [*on, "_salt"]).drop("_salt")


# Where a cell's reference point lies in it: off the corners, centre lines and diagonals that borders tend to follow.
REFERENCE = (0.512345, 0.487123)


def clipped_cells(zones: DataFrame, size: Column) -> DataFrame:
    """Grid cells of each zone that it reaches into: the zone's other columns, its box _b, _cx, _cy, _inside and _edges.

    A cell carries only the edges that touch it, and whether its reference point is in the zone. Cells without edges
    are wholly in or wholly out; those out are left. What a cell carries is bounded by its own edges, however many
    vertices the zone has.
    """

    def cell(c: Column, edges: Column, s: Column) -> Column:
        x, y = (c["cx"] + REFERENCE[0]) * s, (c["cy"] + REFERENCE[1]) * s
        eps = 1e-9

        def touches(e: Column) -> Column:
            (ax, ay), (bx, by) = ((e[v]["x"], e[v]["y"]) for v in ("a", "b"))
            return (
                (F.least(ax, bx) <= (c["cx"] + 1) * s + eps) & (F.greatest(ax, bx) >= c["cx"] * s - eps)
                & (F.least(ay, by) <= (c["cy"] + 1) * s + eps) & (F.greatest(ay, by) >= c["cy"] * s - eps)
            )

        return F.struct(
            c["cx"].alias("_cx"), c["cy"].alias("_cy"), (geo.crossings(edges, x, y) % 2 == 1).alias("_inside"),
            F.filter(edges, touches).alias("_edges"),
        )

    rest = [c for c in zones.columns if c != "geometry"]
    out = (
        zones.withColumns({"_size": size, "_all": geo.polygon_edges(F.col("geometry")), "_b": geo.bounds(F.col("geometry"))})
        .withColumn("_cells", cells_of_box(F.col("_b.minx"), F.col("_b.miny"), F.col("_b.maxx"), F.col("_b.maxy"), F.col("_size")))
        .select(*rest, "_b", F.explode(F.transform("_cells", lambda c: cell(c, F.col("_all"), F.col("_size")))).alias("_cell"))
    )
    return out.select(*rest, "_b", "_cell.*").where(F.col("_inside") | (F.size("_edges") > 0))


def points_in_polygons(
    points: DataFrame, zones: DataFrame, cell: dict[str, float], boundary: bool = False
) -> DataFrame:
    """Points joined to the zones that hold them, one row per (point, zone).

    ``points``: any key columns, lon, lat. ``zones``: geoid, level, geometry (dropped), further columns pass through.
    ``cell`` gives a grid size in degrees per level, about the extent of one zone, so a zone covers few cells; a level
    without a size is an error. ``boundary=True`` also takes points on a zone's edge.

    A point is in the zone if the segment to its cell's reference point crosses the cell's edges an even number of
    times and that point is in, or an odd number and it is out. The points are read once; a hot cell is split by the
    adaptive skew join on its measured size.
    """
    size = F.create_map(*[F.lit(x) for kv in cell.items() for x in kv])
    unknown = F.raise_error(F.concat(F.lit("no cell size for level "), F.coalesce("level", F.lit("null")))).cast("double")
    tiles = clipped_cells(zones, F.coalesce(size[F.col("level")], unknown))
    levels = F.array(*[F.struct(F.lit(k).alias("level"), F.lit(float(v)).alias("size")) for k, v in cell.items()])
    placed = (
        points.withColumn("_lv", F.explode(levels))
        .withColumns({
            "level": F.col("_lv.level"),
            "_cx": F.floor(F.col("lon") / F.col("_lv.size")),
            "_cy": F.floor(F.col("lat") / F.col("_lv.size")),
            "_rx": (F.floor(F.col("lon") / F.col("_lv.size")) + REFERENCE[0]) * F.col("_lv.size"),
            "_ry": (F.floor(F.col("lat") / F.col("_lv.size")) + REFERENCE[1]) * F.col("_lv.size"),
        })
        .drop("_lv")
    )
    x, y = F.col("lon"), F.col("lat")
    odd = geo.crossed(F.col("_edges"), x, y, F.col("_rx"), F.col("_ry")) % 2 == 1
    on_edge = geo.on_boundary(F.col("_edges"), x, y)
    inside = odd != F.col("_inside")
    near = x.between(F.col("_b.minx"), F.col("_b.maxx")) & y.between(F.col("_b.miny"), F.col("_b.maxy"))
    joined = placed.join(tiles, ["level", "_cx", "_cy"]).where(near)
    return joined.where((inside | on_edge) if boundary else (inside & ~on_edge)).drop(
        "_cx", "_cy", "_rx", "_ry", "_edges", "_inside", "_b"
    )


def boxes_overlap(a: DataFrame, b: DataFrame, cell: float, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Rows of ``a`` (minx, miny, maxx, maxy, ...) joined to the rows of ``b`` whose box they touch.

    Both boxes are cut into grid cells. A pair sharing several cells is kept only in the cell that holds the
    lower-left corner of the overlap, so no pair repeats and nothing has to be made distinct.
    """

    def tiled(df: DataFrame, tag: str) -> DataFrame:
        names = {c: f"_{tag}_{c}" for c in ("minx", "miny", "maxx", "maxy")}
        df = df.where(F.col("minx").isNotNull() & F.col("miny").isNotNull() & F.col("maxx").isNotNull()
                      & F.col("maxy").isNotNull()).withColumnsRenamed(names)
        box = [F.col(f"_{tag}_{c}") for c in ("minx", "miny", "maxx", "maxy")]
        return (
            df.withColumn("_cell", F.explode(cells_of_box(*box, F.lit(cell))))
            .withColumns({"_cx": F.col("_cell.cx"), "_cy": F.col("_cell.cy")})
            .drop("_cell")
        )

    joined = salted_join(tiled(a, "a"), tiled(b, "b"), ["_cx", "_cy"], ["_a_minx", "_a_miny", "_a_maxx", "_a_maxy"],
                         hot_rows)
    left, low = F.greatest("_a_minx", "_b_minx"), F.greatest("_a_miny", "_b_miny")
    meets = (left <= F.least("_a_maxx", "_b_maxx")) & (low <= F.least("_a_maxy", "_b_maxy"))
    first = (F.col("_cx") == F.floor(left / cell)) & (F.col("_cy") == F.floor(low / cell))
    out = joined.where(meets & first).drop("_cx", "_cy", *[f"_b_{c}" for c in ("minx", "miny", "maxx", "maxy")])
    return out.withColumnsRenamed({f"_a_{c}": c for c in ("minx", "miny", "maxx", "maxy")})


def clip_points(points: DataFrame, boxes: DataFrame, cell: float) -> DataFrame:
    """Points inside each box (edges included), one row per (point, box). The points are read once."""
    tiles = (
        boxes.withColumn("_cell", F.explode(cells_of_box(F.col("minx"), F.col("miny"), F.col("maxx"), F.col("maxy"),
                                                         F.lit(cell))))
        .withColumns({"_cx": F.col("_cell.cx"), "_cy": F.col("_cell.cy")})
        .drop("_cell")
    )
    placed = points.withColumns({"_cx": F.floor(F.col("lon") / cell), "_cy": F.floor(F.col("lat") / cell)})
    inside = F.col("lon").between(F.col("minx"), F.col("maxx")) & F.col("lat").between(F.col("miny"), F.col("maxy"))
    return placed.join(tiles, ["_cx", "_cy"]).where(inside).drop(
        "_cx", "_cy", "minx", "miny", "maxx", "maxy"
    )
