import math
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from zonereach.conformance import QUERIES
from zonereach.functions.impedance import IMPEDANCE
from zonereach.plans import access as acc
from zonereach.plans import export
from zonereach.sources.fixtures import Inputs

PARAMS = {(m, p): (a, b) for m, p, a, b in IMPEDANCE}
ZONES = {"z1": (100, 40), "z2": (50, 30), "z3": (0, 20), "z4": (10, 0), "z5": (70, 35)}
TIMES = {("z1", "z1"): 0.0, ("z1", "z2"): 12.0, ("z2", "z1"): 15.0, ("z2", "z2"): 0.0, ("z1", "z3"): 20.0,
         ("z3", "z3"): 0.0, ("z4", "z4"): 0.0, ("z2", "z4"): 33.0, ("z5", "z2"): 59.9, ("z5", "z1"): 90.0,
         ("z4", "z1"): 90.1, ("z3", "z2"): 45.0}
OPPORT = {("z1", "Jobs: All"): 10, ("z2", "Jobs: All"): 25, ("z3", "Jobs: All"): 99, ("z4", "POIs: All"): 4,
          ("z2", "POIs: All"): 6, ("z1", "EVCI: Stations"): 1}


@pytest.fixture(scope="module")
def tables(spark):
    od = spark.createDataFrame(
        [("c", "Walk", "BG", s, t, m) for (s, t), m in TIMES.items()],
        "city string, mode string, level string, src string, trg string, time_min double",
    )
    opport = spark.createDataFrame([(g, "BG", k, n) for (g, k), n in OPPORT.items()], "geoid string, level string, kind string, opport long")
    zones = spark.createDataFrame([(g, p, w) for g, (p, w) in ZONES.items()], "geoid string, popu long, labor long")
    return od, opport, zones


def brute(demand="destination", keep_zero=False):
    def w(purpose, t):
        a, b = PARAMS[("Walk", purpose)]
        return math.exp(a * t**b)

    out = defaultdict(float)
    for top in acc.THRESHOLDS:
        near = {p: t for p, t in TIMES.items() if t <= top}
        total = defaultdict(lambda: {"Work": 0.0, "Non-work": 0.0})
        for (s, t), m in near.items():
            who = ZONES[t if demand == "destination" else s]
            total[t]["Non-work"] += who[0] * w("Non-work", m)
            total[t]["Work"] += who[1] * w("Work", m)
        for (s, t), m in near.items():
            for (g, kind), o in OPPORT.items():
                if g != t:
                    continue
                purpose = "Work" if kind.startswith("Jobs") else "Non-work"
                served = min(total[t].values()) > 0
                if served or keep_zero:
                    out["Contour", kind, top, s] += o
                    out["Gravity", kind, top, s] += o * w(purpose, m)
                if served:
                    out["E2SFCA", kind, top, s] += o / total[t][purpose]
                    out["M2SFCA", kind, top, s] += o * w(purpose, m) / total[t][purpose]
    return {k: v for k, v in out.items() if v > 0}


@pytest.mark.parametrize("options", [{}, {"demand": "origin"}, {"keep_zero_demand": True}])
def test_access_against_brute_force(tables, options):
    rows = acc.access(*tables, **options).collect()
    got = {(r.measure, r.kind, r.thresh, r.geoid): r.access for r in rows}
    want = brute(options.get("demand", "destination"), options.get("keep_zero_demand", False))
    assert got.keys() == want.keys()
    assert all(got[k] == pytest.approx(want[k], rel=1e-12) for k in want)


def test_zero_demand_destination_is_dropped(tables):
    rows = acc.access(*tables).where("geoid = 'z3' and kind = 'Jobs: All' and measure = 'Contour'").collect()
    # z3 has no population, so its own 99 jobs are not reachable; z2 is 45 minutes away.
    assert {r.thresh: r.access for r in rows} == {45: 25, 60: 25, 90: 25}


def test_unknown_demand(tables):
    with pytest.raises(ValueError):
        acc.access(*tables, demand="both")


def test_invariants_on_the_data(spark):
    i = Inputs(spark, "/root/testdata/sf0.001")
    wide = acc.access(i.od, i.opport_bg, i.zones, wide=True).collect()
    assert wide
    for r in wide:
        for a, b in zip(acc.THRESHOLDS, acc.THRESHOLDS[1:]):
            assert (r[f"Contour_{a}"] or 0) <= (r[f"Contour_{b}"] or 0)
        for t in acc.THRESHOLDS:
            if r[f"Contour_{t}"]:
                assert r[f"Gravity_{t}"] <= r[f"Contour_{t}"] * (1 + 1e-12)
                assert r[f"M2SFCA_{t}"] <= r[f"E2SFCA_{t}"] * (1 + 1e-12)


def test_catalog(spark):
    rows = export.metric_catalog(spark).collect()
    assert len(rows) == len({r.field for r in rows}) == 600
    assert Counter(r.measure for r in rows) == dict.fromkeys(acc.MEASURES, 150)
    assert Counter(r["mode"] for r in rows) == {"Drive": 240, "Bike": 180, "Walk": 180}
    assert {n for k, n in Counter(r.kind for r in rows).items() if k.startswith("EVCI")} == {20}
    assert {n for k, n in Counter(r.kind for r in rows).items() if not k.startswith("EVCI")} == {60}
    assert rows[0].field == "Co_jobTot_Dr_15" and rows[5].field == "Co_jobTot_Bi_15"
    assert all(r["mode"] == "Drive" for r in rows if r.kind.startswith("EVCI"))


def test_wide_export_fills_zero(tables, spark):
    od, opport, zones = tables
    rows = acc.access(od, opport, zones, wide=True)
    wide = export.access_wide(rows, zones.select("geoid"), ["Co_jobTot_Wa_15", "Co_poiTot_Wa_90"]).collect()
    got = {r.geoid: (r.Co_jobTot_Wa_15, r.Co_poiTot_Wa_90) for r in wide}
    assert got["z1"] == (35.0, 6.0) and got["z5"] == (0.0, 6.0)


def test_wide_export_keeps_every_zone_on_request(tables, spark):
    od, opport, zones = tables
    rows = acc.access(od, opport, zones, wide=True)
    wide = export.access_wide(rows, zones.select("geoid"), ["Co_jobTot_Wa_15"], every=True).collect()
    want = brute()
    reached = {s for _, kind, _, s in want if not kind.startswith("EVCI")}
    assert {r.geoid: r.Co_jobTot_Wa_15 for r in wide} == {s: want.get(("Contour", "Jobs: All", 15, s), 0.0) for s in reached}
    assert 0.0 in {r.Co_jobTot_Wa_15 for r in wide}


def test_dashboard_extract_keeps_zones_reached_otherwise(spark):
    i = Inputs(spark, "/root/testdata/sf0.001")
    i.od = i.od.where("mode = 'Bike'")
    rows = QUERIES["dashboard_extract"](i).collect()
    reached = acc.access(i.od, i.opport_bg, i.zones).where("city in ('ASIA', 'EUROPE')").select("geoid").distinct().collect()
    assert reached and {r.geoid for r in rows} == {r.geoid for r in reached}
    assert all(v == 0 for r in rows for k, v in r.asDict().items() if k[:3] in ("Co_", "Gr_", "E2_", "M2_"))


def test_unknown_layer(tables, spark):
    with pytest.raises(ValueError):
        export.map_layer(None, None, "c", "BG", "Contour", "EVCI: Stations", "Walk", 15)


def test_plan_has_no_pair_product(spark):
    """The access plan joins on keys only and reads only the columns it needs."""
    i = Inputs(spark, "/root/testdata/sf0.001")
    plan = acc.access(i.od, i.opport_bg, i.zones)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "l_extendedprice" not in plan
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_pairs_of_one_level_are_shuffled_once(spark, tables):
    """A level that is a constant is no key of the joins, so pairs dealt by it would be dealt again; weights do not travel."""
    od, opport, zones = tables
    one = acc.access(od.withColumn("level", F.lit("BG")), opport, zones)
    plan = one._sc._jvm.PythonSQLUtils.explainString(one._jdf.queryExecution(), "simple")
    keys = [line.split("hashpartitioning(")[1].split(")")[0] for line in plan.splitlines() if "Exchange hashpartitioning(" in line]
    assert any("block#" in k for k in keys) and not any("block#" in k and "trg#" in k for k in keys)
    dealt = acc.spread_pairs(od)
    optimized = dealt._jdf.queryExecution().optimizedPlan().toString()
    assert optimized.index("w_work") < optimized.index("RepartitionByExpression")
    below = optimized[optimized.index("RepartitionByExpression"):]
    assert "w_work" not in below
    flat = lambda df: sorted((*r[:-1], round(r[-1], 9)) for r in df.collect())
    assert flat(one) == flat(acc.access(od, opport, zones))
