"""Edges of a coverage cut where they meet: intervals on common lines.

Coordinates are whole numbers on a grid, so that all comparisons are exact.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import geo

# Coordinates are compared on this grid (micro-degrees), so equal vertices get equal keys.
GRID = 1_000_000
POINTS = ["x1", "y1", "x2", "y2"]
LINE = ["ux", "uy", "c"]
# Steps that Euclid's algorithm takes at most for numbers below 2^31.
GCD_STEPS = 48


def directed_edges(zones: DataFrame, geometry: str = "geometry") -> DataFrame:
    """Ring edges in their direction as grid points (x1, y1, x2, y2); other columns pass through."""
    rest = [c for c in zones.columns if c != geometry]
    grid = lambda c: F.round(c * GRID).cast("long")
    e = zones.select(*rest, F.explode(geo.polygon_edges(F.col(geometry))).alias("_e"))
    out = e.select(
        *rest, grid(F.col("_e.a.x")).alias("x1"), grid(F.col("_e.a.y")).alias("y1"), grid(F.col("_e.b.x")).alias("x2"), grid(F.col("_e.b.y")).alias("y2")
    )
    return out.where("x1 <> x2 or y1 <> y2")


def _gcd(a: str, b: str) -> str:
    step = "(s, i) -> if(s.b = 0, s, struct(s.b as a, s.a % s.b as b))"
    euclid = f"aggregate(sequence(1, {GCD_STEPS}), struct({a} as a, {b} as b), {step}).a"
    return f"case when {a} = 0 then {b} when {b} = 0 then {a} else {euclid} end"


def on_lines(edges: DataFrame) -> DataFrame:
    """Edges as intervals on their line: other columns, ux, uy, c (the line), lo, hi, sign (1 along the line, -1 against).

    A line has the direction (ux, uy), in lowest terms and to the right or straight up, and c = ux y - uy x. The place
    on it is x, or y on an upright line. Edges that overlap lie on one line, whatever their vertices.
    """
    rest = [c for c in edges.columns if c not in POINTS]
    right = "x2 > x1 or (x2 = x1 and y2 > y1)"
    return (
        edges.selectExpr(*rest, *POINTS, f"({right}) as _r", f"{_gcd('abs(x2 - x1)', 'abs(y2 - y1)')} as _g")
        .selectExpr(*rest, *POINTS, "if(_r, 1, -1) as sign", "if(_r, x2 - x1, x1 - x2) div _g as ux", "if(_r, y2 - y1, y1 - y2) div _g as uy")
        .selectExpr(
            *rest, "ux", "uy", "ux * y1 - uy * x1 as c", "if(ux = 0, least(y1, y2), least(x1, x2)) as lo",
            "if(ux = 0, greatest(y1, y2), greatest(x1, x2)) as hi", "sign",
        )
    )


def _x(t: str) -> str:
    return f"if(ux = 0, -c, {t})"


def _y(t: str) -> str:
    return f"if(ux = 0, {t}, (c + uy * {t}) div ux)"


def boundary(zones: DataFrame, by: Sequence[str]) -> DataFrame:
    """Directed boundary of each dissolved group: by..., x1, y1, x2, y2, the inside on the left.

    The vertices of neighbours need not match: an edge is cut wherever another one on its line begins or ends, and what
    runs both ways cancels. Along a line this is a running sum of the edges that begin and end; a line holds the few
    zones that lie along it.
    """
    by = list(by)
    lines = on_lines(directed_edges(zones.select(*by, "geometry")))
    ends = F.explode(F.array(F.struct(F.col("lo").alias("t"), F.col("sign").alias("d")), F.struct(F.col("hi").alias("t"), (-F.col("sign")).alias("d"))))
    events = lines.select(*by, *LINE, ends.alias("_e")).groupBy(*by, *LINE, F.col("_e.t").alias("t")).agg(F.sum("_e.d").alias("d"))
    along = Window.partitionBy(*by, *LINE).orderBy("t")
    cut = events.select(*by, *LINE, "t", F.sum("d").over(along).alias("net"), F.lead("t").over(along).alias("u")).where("net <> 0")
    turned = {"x1": f"if(net > 0, {_x('t')}, {_x('u')})", "y1": f"if(net > 0, {_y('t')}, {_y('u')})",
              "x2": f"if(net > 0, {_x('u')}, {_x('t')})", "y2": f"if(net > 0, {_y('u')}, {_y('t')})"}
    # Where zones overlap along a line the boundary runs there several times.
    copies = F.explode(F.sequence(F.lit(1), F.abs("net").cast("int")))
    return cut.selectExpr(*by, "net", *[f"{e} as {n}" for n, e in turned.items()]).withColumn("_k", copies).select(*by, *POINTS)


def noded_segments(lines: DataFrame, within: Sequence[str]) -> DataFrame:
    """Edges of ``on_lines`` cut at every vertex that lies on them, smaller end first: other columns, x1, y1, x2, y2.

    ``within`` are the columns inside which zones meet, the level for one. Vertices get their number along the line, an
    edge takes the numbers of its ends, and its pieces are those in between: joins on equal keys only.
    """
    within = list(within)
    rest = [c for c in lines.columns if c not in (*LINE, "lo", "hi")]
    place = F.row_number().over(Window.partitionBy(*within, *LINE).orderBy("t"))
    spots = (
        lines.select(*within, *LINE, F.explode(F.array("lo", "hi")).alias("t")).distinct().withColumn("k", place)
    )
    key = [*within, *LINE]
    first = spots.select(*key, F.col("t").alias("lo"), F.col("k").alias("_a"))
    last = spots.select(*key, F.col("t").alias("hi"), F.col("k").alias("_b"))
    begin = spots.select(*key, F.col("t").alias("t"), F.col("k"))
    end = spots.select(*key, F.col("t").alias("u"), (F.col("k") - 1).alias("k"))
    pieces = (
        lines.join(first, [*key, "lo"]).join(last, [*key, "hi"])
        .select(*rest, *[c for c in LINE], F.explode(F.sequence("_a", F.col("_b") - 1)).alias("k"))
        .join(begin, [*key, "k"]).join(end, [*key, "k"])
    )
    return pieces.selectExpr(*rest, f"{_x('t')} as x1", f"{_y('t')} as y1", f"{_x('u')} as x2", f"{_y('u')} as y2")
