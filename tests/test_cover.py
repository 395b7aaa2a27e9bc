import math
import random

import pytest
from pyspark.sql import functions as F

from zonereach.functions import geo
from zonereach.operators import cover

SCHEMA = f"geoid string, geometry array<{geo.RING}>"


def ring(spots):
    return [{"x": float(a), "y": float(b)} for a, b in [*spots, spots[0]]]


def star(rnd, x, y, r, n):
    """A wavy outline whose edges are short, as borders have them."""
    turn, noise = rnd.uniform(0, 6), 0.5 / n
    angles = [2 * math.pi * k / n for k in range(n)]
    return ring([(x + r * d * math.cos(a), y + r * d * math.sin(a)) for a in angles for d in [0.8 + 0.2 * math.sin(7 * a + turn) + rnd.uniform(-noise, noise)]])


def shapes(rnd):
    out = [("large", [star(rnd, 0, 0, 40, 3000), star(rnd, 3, 2, 9, 400)[::-1]])]
    out += [(f"small{k}", [star(rnd, rnd.uniform(-40, 40), rnd.uniform(-40, 40), 0.04, rnd.choice([3, 9, 60]))]) for k in range(40)]
    out += [(f"mid{k}", [star(rnd, 10 * k - 20, 5, 3, 100), star(rnd, 10 * k - 20, 12, 0.5, 30)]) for k in range(5)]
    return out


@pytest.mark.parametrize("most_edges", [6, 24, 10_000])
def test_zones_a_thousand_times_apart(spark, most_edges):
    rnd = random.Random(3)
    found = shapes(rnd)
    zones = spark.createDataFrame(found, SCHEMA)
    spots = [(rnd.uniform(-45, 45), rnd.uniform(-45, 45)) for _ in range(1500)]
    spots += [(r[0]["x"] + rnd.uniform(-0.08, 0.02), r[0]["y"] + rnd.uniform(-0.05, 0.05)) for n, (r, *_) in found if n != "large" for _ in range(15)]
    points = spark.createDataFrame([(i, *s) for i, s in enumerate(spots)], "id int, lon double, lat double").repartition(3)

    def inside(rings, x, y):
        odd = False
        for r in rings:
            for a, b in zip(r, r[1:]):
                if (a["y"] > y) != (b["y"] > y) and x < a["x"] + (y - a["y"]) * (b["x"] - a["x"]) / (b["y"] - a["y"]):
                    odd = not odd
        return odd

    want = sorted((i, n) for i, (x, y) in enumerate(spots) for n, rings in found if inside(rings, x, y))
    got = cover.points_in_zones(points, zones, most_edges=most_edges).select("id", "geoid")
    assert sorted(tuple(r) for r in got.collect()) == want
    assert {n[:3] for _, n in want} == {"lar", "sma", "mid"}


def test_the_cover_follows_the_edges(spark):
    rnd = random.Random(4)
    zones = spark.createDataFrame(shapes(rnd), SCHEMA)
    cells = cover.adaptive_cover(zones, 8)
    own = {r.geoid: r for r in cells.groupBy("geoid").agg(F.count("*").alias("n"), F.sum(F.size("_edges")).alias("edges"), F.max(F.size("_edges")).alias("most"), F.min("_e").alias("low"), F.max("_e").alias("high")).collect()}
    assert all(r.most <= 8 for r in own.values())
    # Cells and the edges they carry are in proportion to the zone's edges, not to its extent.
    edges = {r.geoid: r.n for r in zones.select("geoid", F.size(geo.polygon_edges("geometry")).alias("n")).collect()}
    assert all(own[g].n <= 2 * n + 8 and own[g].edges <= 4 * n + 16 for g, n in edges.items())
    # Whole inner cells stay coarse.
    inner = cells.where("geoid = 'large' and _inside and size(_edges) = 0")
    assert inner.agg(F.max("_e") - F.min("_e")).first()[0] >= 3
    # The cells of a zone are apart and make up its area, but for the part of border cells that is outside.
    area = inner.agg(F.sum(F.pow(F.lit(2.0), 2 * F.col("_e")))).first()[0]
    whole = cells.where("geoid = 'large'").agg(F.sum(F.pow(F.lit(2.0), 2 * F.col("_e")))).first()[0]
    true = zones.where("geoid = 'large'").select(geo.area("geometry")).first()[0]
    assert area < true < whole and whole - area < 0.5 * true


def test_edges_and_empty_inputs(spark):
    square = [[*ring([(0, 0), (1, 0), (1, 1), (0, 1)])]]
    beside = [[*ring([(1, 0), (2, 0), (2, 1), (1, 1)])]]
    zones = spark.createDataFrame([("a", square), ("b", beside), ("none", None), ("point", [ring([(5, 5), (5, 5)])])], SCHEMA)
    points = spark.createDataFrame([(1, 1.0, 0.5), (2, 0.25, 0.25), (3, None, 1.0), (4, 9.0, 9.0)], "id int, lon double, lat double")
    rows = lambda df: sorted((r.id, r.geoid) for r in df.collect())
    assert rows(cover.points_in_zones(points, zones)) == [(2, "a")]
    assert rows(cover.points_in_zones(points, zones, boundary=True)) == [(1, "a"), (1, "b"), (2, "a")]
    assert rows(cover.points_in_zones(points, zones.where("false"))) == []
    assert rows(cover.points_in_zones(points.where("false"), zones)) == []
