import itertools
import random

import pytest
from pyspark.sql import functions as F

from zonereach.conformance import ORACLES, QUERIES, bind
from zonereach.conformance import products
from zonereach.conformance.products import access_slice, access_units, travel_times
from zonereach.plans import access as acc
from zonereach.plans.travel import compact_codes, compare_routers
from zonereach.plans.travel_table import TravelTable
from zonereach.session import local_session
from zonereach.sources.fixtures import Inputs
from zonereach.sources.unit_store import fingerprints

FOLDER = "/root/testdata/sf0.001"


def above(df, leaf):
    """For each scan line that holds ``leaf``, the operators above it up to the root, nearest first."""
    lines = df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "simple").splitlines()
    found = []
    for at, line in enumerate(lines):
        if "FileScan" not in line or leaf not in line:
            continue
        depth, path = len(line) - len(line.lstrip(" :+-")), []
        for other in reversed(lines[:at]):
            d = len(other) - len(other.lstrip(" :+-"))
            if other.strip() and d < depth:
                depth = d
                path.append(other.lstrip(" :+-"))
        found.append(path)
    return found


def until(path, *names):
    return list(itertools.takewhile(lambda op: not op.startswith(names), path))


@pytest.fixture(scope="module")
def data(spark):
    rng = random.Random(8)
    zones = [f"01001{i:06d}1" for i in range(60)]
    od = {(c, m, s, t): float(rng.randint(0, 110)) for c in ("a", "b") for m in ("Drive", "Walk") for s in zones for t in rng.sample(zones, 25)}
    od = spark.createDataFrame([(c, m, "BG", s, t, x) for (c, m, s, t), x in od.items()], "city string, mode string, level string, src string, trg string, time_min double")
    opport = spark.createDataFrame([(z, "BG", k, rng.randint(0, 9)) for z in zones for k in ("Jobs: All", "POIs: All")], "geoid string, level string, kind string, opport long")
    sizes = spark.createDataFrame([(z, rng.randint(0, 90), rng.randint(0, 50)) for z in zones], "geoid string, popu long, labor long")
    return od, opport, sizes


def rows(df):
    return sorted(tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in df.collect())


def test_landed_times_give_the_same_results(spark, data, tmp_path):
    od, opport, sizes = data
    table = TravelTable.write(od, str(tmp_path / "t"), block_pairs=300, least_buckets=4)
    assert table.buckets == 20 and table.rows().count() == od.count()
    assert {r.blocks for r in table.blocks.collect()} == {10}
    # All pairs of a destination and a place lie together.
    assert table.rows().groupBy("city", "level", "trg").agg(F.countDistinct("block").alias("n")).where("n > 1").count() == 0
    assert rows(table.access(opport, sizes)) == rows(acc.access(od, opport, sizes))
    assert rows(table.access(opport, sizes, demand="origin")) == rows(acc.access(od, opport, sizes, demand="origin"))
    assert rows(table.cross_modal_access(opport, sizes)) == rows(acc.cross_modal_access(od, opport, sizes))
    jobs = opport.where("kind = 'Jobs: All'").select("geoid", F.col("opport").alias("njobs"))
    assert rows(table.contour_jobs(jobs)) == rows(acc.contour_jobs(od, jobs))
    assert rows(table.compact_codes()) == rows(compact_codes(od))
    units = {(r.city, r["mode"]): (r.pairs, r.fingerprint) for r in table.units.collect()}
    assert {k: n for k, (n, _) in units.items()} == {(c, m): 1500 for c in "ab" for m in ("Drive", "Walk")}
    # One changed time changes the fingerprint of its unit alone.
    first = od.where("city = 'a' and mode = 'Walk'").first()
    changed = od.withColumn("time_min", F.when((F.col("city") == "a") & (F.col("mode") == "Walk") & (F.col("src") == first.src) & (F.col("trg") == first.trg), 7.25).otherwise(F.col("time_min")))
    other = TravelTable.write(changed, str(tmp_path / "u"), like=table)
    again = {(r.city, r["mode"]): (r.pairs, r.fingerprint) for r in other.units.collect()}
    assert {k for k in units if units[k] != again[k]} == {("a", "Walk")}
    assert rows(table.compare(other, "x", "y")) == rows(compare_routers(od, changed, "x", "y"))


def test_pairs_stay_where_they_lie(spark, data, tmp_path):
    od, opport, sizes = data
    table = TravelTable.write(od, str(tmp_path / "t"), block_pairs=300, least_buckets=4)
    other = TravelTable.write(od.where("mode = 'Walk'"), str(tmp_path / "u"), like=table)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for df in (table.access(opport, sizes), table.cross_modal_access(opport, sizes)):
            scans = above(df, "travel_times")
            assert len(scans) == 2
            for path in scans:
                # Up to the join with the supply, and up to the sums by destination, nothing is exchanged.
                own = until(path, "SortMergeJoin", "ShuffledHashJoin", "HashAggregate", "ObjectHashAggregate", "SortAggregate")
                assert not any("Exchange" in op for op in own), path
            demand = max(scans, key=len)
            sums = [i for i, op in enumerate(demand) if op.startswith(("HashAggregate", "SortAggregate")) and "trg" in op]
            # Every sum down to the destination is made without an exchange between its two steps.
            assert len(sums) >= 2 and not any("Exchange" in op for op in demand[: sums[-1]]), demand
        routers = above(table.compare(other, "x", "y"), "travel_times")
        assert len(routers) == 2
        for path in routers:
            assert not any("Exchange" in op for op in path), path
        codes = above(table.compact_codes(), "travel_times")
        assert len(codes) == 1 and not any("Exchange" in op for op in codes[0]), codes
        pruned = table.access(opport, sizes, thresholds=(15,), where=F.col("city") == "a")
        plan = pruned._jdf.queryExecution().executedPlan().toString()
        assert "Bucketed: true" in plan and "LessThanOrEqual(time_min,15.0)" in plan and "EqualTo(city,a)" in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_table_opens_again_by_its_path(spark, data, tmp_path):
    od, opport, sizes = data
    table = TravelTable.write(od, str(tmp_path / "t"), block_pairs=300)
    want = rows(table.access(opport, sizes))
    table.close()
    assert not spark.catalog.tableExists(table.name)
    again = TravelTable(spark, str(tmp_path / "t"))
    assert rows(again.access(opport, sizes)) == want
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        scans = above(again.compare(again, "x", "y"), "travel_times")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(scans) == 2 and not any("Exchange" in op for path in scans for op in path)


def test_no_times(spark, data, tmp_path):
    od, opport, sizes = data
    table = TravelTable.write(od.where("false"), str(tmp_path / "t"))
    assert table.access(opport, sizes).count() == 0 and table.units.count() == 0


def test_slices_read_their_folders_only(spark):
    i = Inputs(local_session(), FOLDER)
    one = access_slice(i, measure="Gravity", kind="Jobs: All", mode="Drive", thresh=30)
    plan = one._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters:")[1].split("PushedFilters:")[0]
    assert all(c in filters for c in ("measure", "mode", "thresh")) and "kind" in plan.split("PushedFilters:")[1]
    assert "Exchange" not in plan
    # Landed once, and read by all.
    assert travel_times(i) is travel_times(Inputs(i.spark, FOLDER))


@pytest.mark.parametrize("name", ["access_from_table", "xmfca_from_table", "router_compare_from_table", "access_saved", "access_unit_commits"])
def test_landed_queries_match_sql(spark, name):
    from zonereach.compare import compare, connect

    ok, text = compare(spark, connect(FOLDER), name, bind(QUERIES[name]), ORACLES[name], FOLDER)
    assert ok, text


def test_pairs_with_their_modes_in_an_array_land_as_rows(spark, data, tmp_path):
    """Half the rows move, and the landed table, its units and fingerprints are the same."""
    od, opport, sizes = data
    packed = od.groupBy("city", "level", "src", "trg").agg(F.collect_list(F.struct("mode", "time_min")).alias("times"))
    one = TravelTable.write(od, str(tmp_path / "one"), block_pairs=300, least_buckets=4)
    two = TravelTable.write(packed, str(tmp_path / "two"), block_pairs=300, least_buckets=4, each="times")
    assert two.rows().columns == one.rows().columns and rows(two.rows()) == rows(one.rows())
    assert rows(two.units) == rows(one.units) and two.buckets == one.buckets
    assert rows(two.access(opport, sizes)) == rows(acc.access(od, opport, sizes))


def test_landed_times_are_those_of_all_levels(spark):
    i = Inputs(spark, FOLDER)
    names = ["city", "mode", "level", "src", "trg", "time_min"]
    assert rows(travel_times(i).rows().select(*names)) == rows(i.od_levels.select(*names))
    assert i.times_levels.count() * 3 == i.od_levels.count()


def test_times_made_of_other_columns_land_as_rows(spark, tmp_path):
    """Only the columns that the times are made of are written down and dealt out."""
    pairs = spark.createDataFrame([("c", "BG", str(s), str(t), 7 * s + t) for s in range(6) for t in range(5)], "city string, level string, src string, trg string, base long")
    times = "array(struct('Walk' as mode, base / 10 as time_min), struct('Bike' as mode, base / 20 as time_min))"
    one = TravelTable.write(pairs.select("city", "level", "src", "trg", F.inline(F.expr(times))), str(tmp_path / "one"))
    two = TravelTable.write(pairs, str(tmp_path / "two"), each=times, of=["base"])
    assert two.rows().columns == one.rows().columns and rows(two.rows()) == rows(one.rows())
    assert rows(two.units) == rows(one.units)


def test_pairs_of_tracts_are_summed_where_the_pairs_lie(spark):
    """Coarser pairs are the means of their child pairs, and only pairs of counties are shuffled for it."""
    i = Inputs(spark, FOLDER)
    plan = i.pairs_levels._sc._jvm.PythonSQLUtils.explainString(i.pairs_levels._jdf.queryExecution(), "simple")
    assert not [line for line in plan.splitlines() if "Exchange hashpartitioning(city#" in line and ("src" in line or "level" in line)]
    want = {}
    for r in i.pairs.collect():
        for level, n in (("BG", 12), ("Tract", 11), ("County", 5)):
            want.setdefault((r.city, level, r.src[:n], r.trg[:n]), []).append((r.base, r.dist))
    want = {(*k, sum(b for b, _ in v) // len(v), min(d for _, d in v)) for k, v in want.items()}
    got = [(r.city, r.level, r.src, r.trg, r.base, r.dist) for r in i.pairs_levels.collect()]
    assert len(got) == len(want) and set(got) == want


def test_pairs_are_dealt_out_by_numbers_alone(spark):
    i = Inputs(spark, FOLDER)
    assert {t for _, t in i.pair_numbers.dtypes} <= {"int", "bigint"}
    # Each region has its city, and the pairs of all three levels carry it.
    cities = {r.rk: r.city for r in i.counties.select("rk", "city").distinct().collect()}
    got = {(r.s, r.city) for r in i.pairs_levels.select(F.substring("src", 1, 2).cast("int").alias("s"), "city").distinct().collect()}
    assert got == {(rk + 1, city) for rk, city in cities.items()}


def test_opportunities_are_made_once(spark):
    i = Inputs(spark, FOLDER)
    found = products.opportunities(i)
    assert products.opportunities(Inputs(spark, FOLDER)) is found
    assert rows(found.select("geoid", "level", "kind", "opport")) == rows(i.opport.select("geoid", "level", "kind", "opport"))
    assert "lineitem" not in access_units(i)._jdf.queryExecution().executedPlan().toString()


def test_fingerprints_are_exact_sums(spark):
    df = spark.range(5000).selectExpr("id % 3 as city", "id * 7919 as x", "if(id % 5 = 0, null, cast(id as string)) as y")
    plan = fingerprints(df, ["city"])
    want = {r.city: (r.n, r.s) for r in df.groupBy("city").agg(
        F.count("*").alias("n"), F.sum(F.xxhash64("x", "y").cast("decimal(38,0)")).cast("string").alias("s")).collect()}
    assert {r.city: (r.pairs, r.fingerprint) for r in plan.collect()} == want
    # No row is summed as a decimal.
    below = plan._jdf.queryExecution().executedPlan().toString().split("Exchange", 1)[1]
    assert "partial_sum" in below and "decimal" not in below
