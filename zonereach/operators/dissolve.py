"""Dissolving a zone coverage: outlines by segment cancellation, contiguity by connected components."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import geo
from ..session import Scratch
from .noding import LINE, boundary, directed_edges, noded_segments, on_lines


def outline(zones: DataFrame, by: Sequence[str]) -> DataFrame:
    """Outer segments of each dissolved group, smaller end first: by..., x1, y1, x2, y2.

    Neighbours need not have the same vertices, see ``noding.boundary``.
    """
    first, last = "struct(x1 as x, y1 as y)", "struct(x2 as x, y2 as y)"
    lines = boundary(zones, by).selectExpr(*by, f"least({first}, {last}) as _a", f"greatest({first}, {last}) as _b")
    return lines.selectExpr(*by, "_a.x as x1", "_a.y as y1", "_b.x as x2", "_b.y as y2")


def dissolve_attributes(zones: DataFrame, by: Sequence[str], sums: Sequence[str]) -> DataFrame:
    return zones.groupBy(*by).agg(
        *[F.sum(c).alias(c) for c in sums], F.sum(geo.area(F.col("geometry"))).alias("area")
    )


def zone_links(zones: DataFrame) -> DataFrame:
    """Adjacent zones of one level as (a, b), a < b, linked by a stretch of border, whether or not their vertices match.

    Along each line of borders a window follows which zone lies on either side. In a clean coverage that is one zone a
    side at most; on lines where it is not, the zones on a segment are linked as a chain to the smallest of them, so an
    irregular coverage with many zones on one segment gives no pair product.
    """
    lines = on_lines(directed_edges(zones.select("geoid", "level", "geometry")))
    key = ["level", *LINE]
    both = F.array(*[F.struct(F.col(t).alias("t"), F.lit(d).alias("d")) for t, d in (("lo", 1), ("hi", -1))])
    ends = lines.select(*key, "geoid", "sign", F.explode(both).alias("e")).select(*key, "geoid", "sign", "e.t", "e.d")
    sums = [
        agg
        for side, sign in (("left", 1), ("right", -1))
        for agg in (
            F.sum(F.when(F.col("sign") == sign, F.col("d")).otherwise(0)).alias(f"d_{side}"),
            F.max(F.when((F.col("sign") == sign) & (F.col("d") > 0), F.col("geoid"))).alias(f"z_{side}"),
        )
    ]
    along = Window.partitionBy(*key).orderBy("t")
    scratch = Scratch(zones.sparkSession, "links")
    swept = scratch.table(
        ends.groupBy(*key, "t").agg(*sums).select(
            *key,
            *[F.sum(f"d_{s}").over(along).alias(f"n_{s}") for s in ("left", "right")],
            *[F.last(f"z_{s}", ignorenulls=True).over(along).alias(s) for s in ("left", "right")],
        ).where("n_left > 0 and n_right > 0 or n_left > 1 or n_right > 1"),
        "borders",
    )
    crowded = swept.where("n_left > 1 or n_right > 1").select(*key).distinct()
    pair = [F.least("left", "right").alias("a"), F.greatest("left", "right").alias("b")]
    if not crowded.limit(1).count():
        return swept.where("left <> right").select("level", *pair).distinct()
    clean = swept.join(crowded, key, "left_anti").where("left <> right").select("level", *pair)
    seg = noded_segments(lines.join(crowded, key, "left_semi").drop("sign"), ["level"])
    piece = ["x1", "y1", "x2", "y2"]
    low = seg.groupBy("level", *piece).agg(F.min("geoid").alias("a"), F.count("*").alias("_n")).where("_n > 1")
    chained = seg.join(low, ["level", *piece]).where("geoid > a").select("level", "a", F.col("geoid").alias("b"))
    return clean.unionByName(chained).distinct()


def connected_components(edges: DataFrame, within: Sequence[str] = (), place: tuple | None = None) -> DataFrame:
    """Nodes of an edge list (a, b) with the smallest node of their component: within..., node, component.

    Alternates two steps until the edges stop changing: every node sends its larger neighbours to its smallest
    neighbour, then its smaller ones. Each step is a min aggregate and a join, the number of rounds grows with
    the logarithm of the node count. Each round's edges are a table in the shared folder, which the next round removes.
    Nodes are the same only where the columns ``within`` are. With ``place`` (a number of buckets, then some of these
    columns) the tables are bucketed, and edges that lie so are not moved in any round.
    """
    within = list(within)
    scratch = Scratch(edges.sparkSession, "components")
    keep = (lambda df: scratch.placed(df, "edges", place[0], place[1:])) if place else (lambda df: scratch.table(df, "edges"))
    u = [*within, "u"]
    edges = keep(edges.where("a <> b").select(*within, F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())

    def signature(df: DataFrame):
        # Two independent order-free sums; each hash is widened so that the sums cannot overflow.
        h = F.xxhash64(*within, "u", "v").cast("decimal(20,0)")
        g = F.xxhash64(*within, "v", "u").cast("decimal(20,0)")
        return df.agg(F.count("*"), F.sum(h), F.sum(g)).first()

    def large_star(e: DataFrame) -> DataFrame:
        both = e.selectExpr(*within, "inline(array(struct(u, v), struct(v as u, u as v)))")
        m = both.groupBy(*u).agg(F.min("v").alias("_m")).select(*u, F.least("u", "_m").alias("m"))
        # Every larger neighbour v of u is sent to m(u).
        return both.where("v > u").join(m, u).select(*within, F.col("v").alias("u"), F.col("m").alias("v")).distinct()

    def small_star(e: DataFrame) -> DataFrame:
        # Here u > v, so all neighbours of u in this orientation are smaller.
        m = e.groupBy(*u).agg(F.min("v").alias("m"))
        own = "struct(u, m as v)"
        return e.join(m, u).selectExpr(*within, f"inline(if(v = m, array({own}), array(struct(v as u, m as v), {own})))").distinct()

    before = None
    after = signature(edges)
    while after != before:
        before = after
        moved = keep(small_star(large_star(edges)))
        scratch.drop(edges)
        edges = moved
        after = signature(edges)
    return edges.selectExpr(*within, "inline(array(struct(u as node, v as component), struct(v as node, v as component)))").distinct()


# Members of catchments that one task should hold.
BLOCK_MEMBERS = 2_000_000


def contiguous_catchments(members: DataFrame, zones: DataFrame, by: Sequence[str], place: tuple | None = None) -> DataFrame:
    """Largest contiguous part of every catchment: by..., geoid, part, part_area.

    ``members``: by..., geoid; ``zones``: geoid, level, geometry. Catchments of all destinations are solved
    together: a node is a zone in a catchment, and an edge needs both zones in the catchment. The part with the
    largest area in Web Mercator (square metres) wins, ties go to the smallest part label.

    ``place`` tells how the members lie already: a number of buckets, then some columns of ``by``. Without it they are
    dealt out once, by blocks of catchments. What a block has to know of its zones comes to it, one row per zone, and
    all that follows is done where the members lie.
    """
    by = list(by)
    scratch = Scratch(zones.sparkSession, "catchments")
    if place:
        key = by
    else:
        members = scratch.table(members.select(*by, "geoid"), "members")
        place = (max(8, -(-members.count() // BLOCK_MEMBERS)), "_block")
        members = members.withColumn("_block", F.pmod(F.xxhash64(*by), F.lit(place[0]))).repartition(*place)
        key = [*by, "_block"]
    base = scratch.placed(members.select(*key, "geoid").distinct(), "members", *_split(place))
    area = geo.area(geo.polygon_to_mercator(F.col("geometry")))
    near = zone_links(zones).groupBy(F.col("a").alias("geoid")).agg(F.collect_list("b").alias("_near"))
    facts = zones.select("geoid", area.alias("_area")).join(near, "geoid", "left")
    own = scratch.placed(zones_of(base, facts, place), "zones", *_split(place))
    edges = (
        base.join(own.where("_near is not null"), [*place[1:], "geoid"])
        .select(*key, F.col("geoid").alias("a"), F.explode("_near").alias("b"))
        .join(base.withColumnRenamed("geoid", "b"), [*key, "b"])
    )
    parts = connected_components(edges, key, place).withColumnRenamed("node", "geoid")
    # A component is named by its smallest zone, which is the label of the part.
    sized = (
        base.join(parts, [*key, "geoid"], "left")
        .withColumn("part", F.coalesce("component", "geoid"))
        .join(own.select(*place[1:], "geoid", "_area"), [*place[1:], "geoid"])
        .select(*key, "geoid", "part", "_area")
    )
    totals = sized.groupBy(*key, "part").agg(F.sum("_area").alias("part_area"))
    best = totals.groupBy(*key).agg(
        F.min(F.struct((-F.round("part_area")).alias("neg"), "part", "part_area")).alias("_best")
    ).select(*key, F.col("_best.part").alias("part"), F.col("_best.part_area").alias("part_area"))
    return sized.drop("_area").join(best, [*key, "part"]).select(*by, "geoid", "part", "part_area")


def _split(place: tuple) -> tuple[int, list[str]]:
    return place[0], list(place[1:])


def zones_of(rows: DataFrame, facts: DataFrame, place: tuple) -> DataFrame:
    """``facts`` (geoid, more) of the zones that each place of ``rows`` has, dealt out to where these rows lie."""
    return rows.select(*place[1:], "geoid").distinct().join(facts, "geoid").repartition(*place)
