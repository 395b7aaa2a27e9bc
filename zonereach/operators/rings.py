"""Polygons of a dissolved coverage: noded boundary, rings by list ranking, nesting of rings.

Coordinates are whole numbers on the grid of ``noding``. Shells run counter-clockwise and holes clockwise, with the inside
on the left of every edge.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import Scratch
from .noding import GRID, POINTS, boundary

def cycle_order(scratch: Scratch, links: DataFrame) -> DataFrame:
    """Cycles of a successor relation: id, ring (smallest id of the cycle), steps (from here on to it).

    ``links`` has id and next, both ids once. Pointers double: after k rounds a node knows the smallest id among the 2^k
    nodes from it on, and how far it is. When a round changes nothing, every node knows the smallest of its cycle.
    """
    state = scratch.table(links.select("id", F.col("next").alias("jump"), F.col("id").alias("ring"), F.lit(0).cast("long").alias("steps")), "pointers")
    stride = 1
    while True:
        there = state.select(F.col("id").alias("_id"), F.col("jump").alias("_jump"), F.col("ring").alias("_ring"), F.col("steps").alias("_steps"))
        lower = F.col("_ring") < F.col("ring")
        moved = state.join(there, F.col("jump") == F.col("_id")).select(
            "id", F.col("_jump").alias("jump"), F.least("ring", "_ring").alias("ring"),
            F.when(lower, F.col("_steps") + stride).otherwise(F.col("steps")).alias("steps"), lower.alias("moved"),
        )
        after = scratch.table(moved, "pointers")
        scratch.drop(state)
        state, stride = after.drop("moved"), stride * 2
        state._zonereach_path = after._zonereach_path
        if not after.where("moved").limit(1).count():
            return state.select("id", "ring", "steps")


def ring_edges(scratch: Scratch, edges: DataFrame, by: Sequence[str]) -> DataFrame:
    """Boundary edges in rings: by..., ring, at (place in the ring from 0), x1, y1, x2, y2.

    Where several rings pass a vertex, an edge is followed by the one that bounds the same corner of the inside, so that
    parts that only touch in a point are rings of their own. A ring that passes a vertex more than once is then cut
    there: a hole that touches its shell in a point becomes a ring too, and every ring is simple.
    """
    by = list(by)
    edges = scratch.table(edges.withColumn("id", F.monotonically_increasing_id()), "edges")
    out = edges.select(*by, F.col("x1").alias("x2"), F.col("y1").alias("y2"), F.col("id").alias("next"), (F.col("x2") - F.col("x1")).alias("_ox"), (F.col("y2") - F.col("y1")).alias("_oy"))
    back_x, back_y = F.col("x1") - F.col("x2"), F.col("y1") - F.col("y2")
    cross, dot = back_x * F.col("_oy") - back_y * F.col("_ox"), back_x * F.col("_ox") + back_y * F.col("_oy")
    # Clockwise from the way back; the way back itself comes last.
    turn = F.atan2((-cross).cast("double"), dot.cast("double"))
    clockwise = F.when(turn <= 0, turn + 6.283185307179586).otherwise(turn)
    keys = [*by, "x2", "y2"]
    # An edge that bounds two copies of a corner goes on with one of them, and each copy follows one edge.
    choice = edges.join(out, keys).select("id", "next", F.round(clockwise, 12).alias("turn"), *keys, F.col("x1").alias("fx"), F.col("y1").alias("fy"))
    best = choice.groupBy("id", *keys, "fx", "fy").agg(F.min(F.struct("turn", "next")).alias("_b"))
    links = best.select("id", F.col("_b.next").alias("next"))
    twice = links.groupBy("next").count().where("count > 1").limit(1)
    links = scratch.table(links, "links")
    if twice.count():
        raise ValueError("zones overlap: an edge of the boundary runs twice")
    order = scratch.table(cycle_order(scratch, links), "order")
    placed = _placed(edges, order, by)
    visits = Window.partitionBy("ring", "x1", "y1")
    again = scratch.table(
        placed.withColumn("_n", F.count("*").over(visits)).where("_n > 1")
        .withColumn("_before", F.lag("id").over(visits.orderBy("at")))
        .withColumn("_last", F.last("id").over(visits.orderBy("at").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
        .select("id", "ring", F.coalesce("_before", "_last").alias("instead")),
        "again",
    )
    if again.limit(1).count():
        touched = again.select("ring").distinct()
        own = order.join(touched, "ring", "left_semi").select("id")
        cut = (
            links.join(own, "id", "left_semi")
            .join(again.select(F.col("id").alias("next"), "instead"), "next", "left")
            .select("id", F.coalesce("instead", "next").alias("next"))
        )
        order = scratch.table(order.join(touched, "ring", "left_anti").select("id", "ring", "steps").unionByName(cycle_order(scratch, cut)), "order")
        placed = _placed(edges, order, by)
    return placed.select(*by, "ring", "at", *POINTS)


def _placed(edges: DataFrame, order: DataFrame, by: list[str]) -> DataFrame:
    sizes = order.groupBy("ring").agg(F.count("*").alias("_n"))
    at = F.when(F.col("steps") == 0, F.lit(0)).otherwise(F.col("_n") - F.col("steps"))
    return edges.join(order, "id").join(sizes, "ring").select(*by, "id", "ring", at.cast("long").alias("at"), *POINTS)


def _twice_area() -> Column:
    d = lambda c: F.col(c).cast("decimal(19,0)")
    return F.sum((d("x1") * d("y2") - d("x2") * d("y1")).cast("decimal(38,0)"))


def rings(edges: DataFrame, by: Sequence[str]) -> DataFrame:
    """Rings of ``ring_edges``: by..., ring, n (vertices), area (signed, square degrees), points (closed)."""
    spot = F.struct("at", (F.col("x1") / GRID).alias("x"), (F.col("y1") / GRID).alias("y"))
    points = F.transform(F.array_sort(F.collect_list(spot)), lambda p: F.struct(p["x"].alias("x"), p["y"].alias("y")))
    out = edges.groupBy(*by, "ring").agg(F.count("*").alias("n"), (_twice_area().cast("double") / (2.0 * GRID * GRID)).alias("area"), points.alias("_p"))
    return out.select(*by, "ring", "n", "area", F.concat("_p", F.slice("_p", 1, 1)).alias("points"))


def containing(scratch: Scratch, edges: DataFrame, by: Sequence[str]) -> DataFrame:
    """Which rings lie in which: by..., ring, outer, for rings of one group.

    A ring is looked up by the middle of one of its edges, which lies on no other ring. The edges of a group are cut into
    strips, about the square root of their number, and the crossings to the right of the point are counted.
    """
    by = list(by)
    sizes = edges.groupBy(*by).agg(F.min("y1").alias("_low"), F.max("y1").alias("_high"), F.count("*").alias("_n")).select(
        *by, "_low", F.greatest(F.lit(1), F.ceil((F.col("_high") - F.col("_low") + 1) / F.ceil(F.sqrt("_n")))).cast("long").alias("_h")
    )
    strip = lambda y: F.floor((y - F.col("_low")) / F.col("_h")).cast("long")
    sized = edges.join(sizes, by) if by else edges.join(F.broadcast(sizes))  # without groups it is a single row
    middles = sized.where("at = 0").select(
        *by, "ring", (F.col("x1") + F.col("x2")).alias("px"), (F.col("y1") + F.col("y2")).alias("py"), strip((F.col("y1") + F.col("y2")) / 2).alias("strip")
    )
    spans = sized.where("y1 <> y2").select(
        *by, F.col("ring").alias("outer"), *POINTS, F.explode(F.sequence(strip(F.least("y1", "y2")), strip(F.greatest("y1", "y2")))).alias("strip")
    )
    # In doubled coordinates the middle is whole too; an edge holds its lower end and not its upper one.
    low_x, low_y = F.when(F.col("y1") < F.col("y2"), 2 * F.col("x1")).otherwise(2 * F.col("x2")), 2 * F.least("y1", "y2")
    high_x, high_y = F.when(F.col("y1") < F.col("y2"), 2 * F.col("x2")).otherwise(2 * F.col("x1")), 2 * F.greatest("y1", "y2")
    d = lambda c: c.cast("decimal(19,0)")
    left_of = d(high_x - low_x) * d(F.col("py") - low_y) > d(F.col("px") - low_x) * d(high_y - low_y)
    hits = middles.join(spans, [*by, "strip"]).where((F.col("ring") != F.col("outer")) & (low_y <= F.col("py")) & (F.col("py") < high_y) & left_of)
    return scratch.table(hits.groupBy(*by, "ring", "outer").agg(F.count("*").alias("_n")).where("_n % 2 = 1").select(*by, "ring", "outer"), "containing")


def nesting(scratch: Scratch, edges: DataFrame, by: Sequence[str]) -> DataFrame:
    """The forest of rings: by..., ring, shell, parent, depth. The parent is the smallest ring around one: of a hole its
    shell, of a shell the hole it is an island in, or null. Depth counts the rings around."""
    by = list(by)
    area = edges.groupBy(*by, "ring").agg(_twice_area().alias("_a"))
    around = containing(scratch, edges, by).join(area.select(*by, F.col("ring").alias("outer"), F.abs("_a").alias("_size")), [*by, "outer"])
    # Of a shell and a hole of equal extent (a part that fills a hole) the rings would have cancelled.
    parent = around.groupBy(*by, "ring").agg(F.min_by("outer", F.struct("_size", "outer")).alias("parent"), F.count("*").alias("depth"))
    return area.join(parent, [*by, "ring"], "left").select(
        *by, "ring", (F.col("_a") > 0).alias("shell"), "parent", F.coalesce("depth", F.lit(0)).alias("depth")
    )


def dissolve_rings(zones: DataFrame, by: Sequence[str]) -> DataFrame:
    """Rings of the dissolved groups: by..., ring, shell, parent, depth, n, area, points."""
    scratch = Scratch(zones.sparkSession, "rings")
    edges = scratch.table(ring_edges(scratch, boundary(zones, by), by), "rings")
    return rings(edges, by).join(nesting(scratch, edges, by), [*by, "ring"])


def dissolve_polygons(zones: DataFrame, by: Sequence[str]) -> DataFrame:
    """Polygons of the dissolved groups, one row each: by..., part (the shell's ring), n_holes, area, geometry.

    The geometry is the shell followed by its holes. The parts of a group are rows of their own, so no row is larger
    than one connected outline.
    """
    by = list(by)
    found = dissolve_rings(zones, by)
    part = F.when(F.col("shell"), F.col("ring")).otherwise(F.col("parent"))
    one = F.struct(F.when(F.col("shell"), 0).otherwise(1).alias("o"), "ring", "points")
    return (
        found.groupBy(*by, part.alias("part"))
        .agg(F.count_if(~F.col("shell")).alias("n_holes"), F.sum("area").alias("area"), F.array_sort(F.collect_list(one)).alias("_r"))
        .select(*by, "part", "n_holes", "area", F.transform("_r", lambda r: r["points"]).alias("geometry"))
    )


def outer_rings(zones: DataFrame, by: Sequence[str]) -> DataFrame:
    """The outer ring of each group that is one connected part, holes and islands in them filled: by..., n, area, points.

    All rings of such a part but one are holes, and that one is the only ring that runs counter-clockwise.
    """
    scratch = Scratch(zones.sparkSession, "rings")
    edges = scratch.table(ring_edges(scratch, boundary(zones, by), by), "rings")
    return rings(edges, by).where("area > 0").drop("ring")
