import math
import random

import pytest
from pyspark.sql import functions as F

from zonereach.functions import geo, text, units
from zonereach.functions.impedance import IMPEDANCE, modes_without_weights, with_weights


def test_slug_and_back(spark):
    df = spark.createDataFrame([("St. Louis",), ("New York",)], "c string")
    rows = df.select(text.slug(F.col("c")).alias("s")).select("s", text.title_from_slug(F.col("s")).alias("t")).collect()
    assert [tuple(r) for r in rows] == [("st-louis", "St Louis"), ("new-york", "New York")]


@pytest.mark.parametrize(
    "name, city",
    [("Dallas--Fort Worth, TX", "Dallas"), ("Nashville-Davidson, TN", "Nashville"), ("Louisville/Jefferson, KY", "Louisville"),
     ("Tampa, FL", "Tampa")],
)
def test_principal_city(spark, name, city):
    assert spark.range(1).select(text.principal_city(F.lit(name))).first()[0] == city


def test_zero_pad_keeps_long_values(spark):
    df = spark.createDataFrame([(7,), (12345678,)], "n long")
    assert [r[0] for r in df.select(text.zero_pad(F.col("n"), 5)).collect()] == ["00007", "12345678"]


def test_labels_and_stamps(spark):
    r = spark.range(1).select(
        text.minutes_label(F.lit(30)), text.minutes_from_label(F.lit("45 min")),
        text.unit_name(F.lit("St. Paul"), F.lit("Drive"), F.lit("2023-11-23 08:30:00").cast("timestamp")),
    ).first()
    assert tuple(r) == ("30 min", 45, "st-paul_drive_20231123-083000")


def test_units_invert(spark):
    c = F.lit(12.5)
    pairs = [
        units.ft_to_m(units.m_to_ft(c)), units.m_to_mi(units.mi_to_m(c)), units.km_to_mi(units.mi_to_km(c)),
        units.sqm_to_sqmi(units.sqmi_to_sqm(c)), units.mph_to_mps(units.mps_to_mph(c)),
    ]
    assert all(abs(v - 12.5) < 1e-12 for v in spark.range(1).select(*pairs).first())


def test_weights(spark):
    od = spark.createDataFrame([("Drive", 0.0), ("Bike", 20.0), ("Hover", 5.0)], "mode string, time_min double")
    rows = {r["mode"]: r for r in with_weights(od).collect()}
    assert rows["Hover"]["w_work"] is None and rows["Hover"]["w_non"] is None
    assert [tuple(r) for r in modes_without_weights(od).collect()] == [("Hover", 1)]
    assert rows["Drive"]["w_work"] == rows["Drive"]["w_non"] == 1.0
    a, b = next((a, b) for m, p, a, b in IMPEDANCE if (m, p) == ("Bike", "Non-work"))
    assert rows["Bike"]["w_non"] == pytest.approx(math.exp(a * 20.0**b), rel=1e-14)


def ring(points):
    return [{"x": float(x), "y": float(y)} for x, y in [*points, points[0]]]


def inside_brute(rings, x, y):
    odd = False
    for r in rings:
        for p, q in zip(r, r[1:]):
            if (p["y"] > y) != (q["y"] > y) and x < p["x"] + (y - p["y"]) * (q["x"] - p["x"]) / (q["y"] - p["y"]):
                odd = not odd
    return odd


def test_contains_with_hole(spark):
    shell = ring([(0, 0), (10, 0), (12, 7), (4, 11), (-2, 5)])
    hole = ring([(3, 3), (3, 6), (6, 6), (6, 3)])
    rnd = random.Random(5)
    pts = [(i, rnd.uniform(-3, 13), rnd.uniform(-1, 12)) for i in range(400)]
    df = spark.createDataFrame(pts, "id int, x double, y double").crossJoin(
        spark.createDataFrame([([shell, hole],)], f"g array<{geo.RING}>")
    )
    edges = geo.polygon_edges(F.col("g"))
    got = {r["id"]: r["in"] for r in df.select("id", geo.contains(edges, F.col("x"), F.col("y")).alias("in")).collect()}
    assert got == {i: inside_brute([shell, hole], x, y) for i, x, y in pts}
    assert 0 < sum(got.values()) < 400


def test_boundary_points(spark):
    square = [ring([(0, 0), (4, 0), (4, 4), (0, 4)])]
    df = spark.createDataFrame([(square,)], f"g array<{geo.RING}>")
    e = geo.polygon_edges(F.col("g"))
    for x, y in ((0, 2), (4, 4), (2, 0), (0, 0)):
        r = df.select(geo.contains(e, F.lit(float(x)), F.lit(float(y))), geo.contains(e, F.lit(float(x)), F.lit(float(y)), True)).first()
        assert tuple(r) == (False, True)


def test_area_centroid_bounds_with_hole(spark):
    rings = [ring([(0, 0), (6, 0), (6, 4), (0, 4)]), ring([(1, 1), (1, 3), (3, 3), (3, 1)])]
    df = spark.createDataFrame([(rings,)], f"g array<{geo.RING}>")
    g = F.col("g")
    a, c, b = df.select(geo.area(g), geo.centroid(g), geo.bounds(g)).first()
    assert a == 20
    assert (c["x"], c["y"]) == pytest.approx(((24 * 3 - 4 * 2) / 20, 2.0))
    assert tuple(b) == (0, 0, 6, 4)


def test_mercator_inverse(spark):
    df = spark.createDataFrame([(-120.5, 47.25), (0.0, 0.0), (179.0, -80.0)], "x double, y double")
    back = df.select(
        geo.lon_of(geo.mercator_x(F.col("x"))).alias("x"), geo.lat_of(geo.mercator_y(F.col("y"))).alias("y")
    ).collect()
    for r, (x, y) in zip(back, [(-120.5, 47.25), (0, 0), (179, -80)]):
        assert (r["x"], r["y"]) == pytest.approx((x, y), abs=1e-9)


def test_wkt_round_trip(spark):
    wkt = "POLYGON ((0.5 0.0, 6.0 0.0, 6.0 4.0, 0.5 0.0), (1.0 1.0, 1.0 2.0, 2.0 2.0, 1.0 1.0))"
    df = spark.createDataFrame([(wkt,)], "w string").select(geo.parse_wkt(F.col("w")).alias("g"))
    assert df.select(F.size("g")).first()[0] == 2
    assert df.select(geo.to_wkt(F.col("g"))).first()[0] == wkt


def test_square_and_box(spark):
    r = spark.range(1).select(
        geo.square_around(*[F.lit(v) for v in (0.0, 0.0, 10.0, 4.0)]).alias("s"),
        geo.box(*[F.lit(v) for v in (0.0, 1.0, 2.0, 5.0)]).alias("b"),
    ).select("s", geo.area(F.col("b")).alias("a")).first()
    assert tuple(r["s"]) == (5, 2, 0, -3, 10, 7) and r["a"] == 8
