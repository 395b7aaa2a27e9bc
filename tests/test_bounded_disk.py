"""What jobs hold on disk: shuffles go with their job, sums meet few blocks, samples and answers are not shuffled whole."""

import random

import pytest
from pyspark.sql import functions as F

from zonereach.conformance import QUERIES, bind, zone_queries
from zonereach.conformance.products import access_store
from zonereach.operators.relational import joined_head, shuffled_head
from zonereach.plans import access as acc
from zonereach.plans import travel
from zonereach.plans.travel_table import TravelTable
from zonereach.sources.fixtures import Inputs
from zonereach.sources.unit_store import UnitStore

FOLDER = "/root/testdata/sf0.001"


def rows(df):
    return sorted((tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in df.collect()), key=str)


def lines(df):
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "simple").splitlines()


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return sum(files.apply(n).getName().endswith(".data") for n in range(files.size()))


def test_shuffles_go_with_their_job(spark):
    df = bind(QUERIES["population_rollup"])(spark, FOLDER)
    before = shuffle_files(spark)
    want = rows(df)
    assert shuffle_files(spark) <= before
    assert rows(df) == want  # once more, shuffled again


@pytest.fixture(scope="module")
def near(spark):
    """Zones in two counties, each of which reaches the twelve that follow it in its county."""
    rng, pairs = random.Random(3), []
    for county in ("01001", "01003"):
        ids = [f"{county}{n:06d}1" for n in range(400)]
        pairs += [("c", m, "BG", s, t, float(rng.randint(1, 100))) for at, s in enumerate(ids) for t in ids[at : at + 12] for m in ("Drive", "Walk")]
    return spark.createDataFrame(pairs, "city string, mode string, level string, src string, trg string, time_min double")


def test_blocks_are_neighbourhoods(spark, near, tmp_path):
    table = TravelTable.write(near, str(tmp_path / "t"), block_pairs=1500)
    total, landed = near.count(), table.rows()
    wanted = -(-total // 1500)
    assert rows(landed.select(*near.columns)) == rows(near)
    per = landed.groupBy("block").agg(F.count("*").alias("n"), F.min("trg").alias("a"), F.max("trg").alias("z")).orderBy("a").collect()
    assert len(per) == wanted and max(r.n for r in per) <= 1500 * 1.3
    # Blocks follow each other in the order of the ids, so a target has one block and a source two at most.
    assert [r.block for r in per] == list(range(wanted)) and all(x.z < y.a for x, y in zip(per, per[1:]))
    assert landed.groupBy("src").agg(F.countDistinct("block").alias("n")).agg(F.max("n")).first()[0] <= 2
    # Another table takes the same blocks, also for targets of its own before, between and after the others.
    own = [("c", "Walk", "BG", "010010000001", t, 5.0) for t in ("000000000001", "010010001001", "010020000001", "999999999991")]
    other = TravelTable.write(near.union(spark.createDataFrame(own, near.schema)), str(tmp_path / "u"), like=table)
    assert rows(table.compare(other, "a", "b")) == rows(travel.compare_routers(near, near, "a", "b"))
    sizes = near.selectExpr("src as geoid").distinct().selectExpr("geoid", "7 as popu", "3 as labor")
    opport = sizes.selectExpr("geoid", "'BG' as level", "'Jobs: All' as kind", "2L as opport")
    assert rows(table.access(opport, sizes)) == rows(acc.access(near, opport, sizes))


def test_units_are_computed_in_bounded_runs(spark, tmp_path):
    store = UnitStore(spark, str(tmp_path / "s"), by=("city", "mode"), slices=("measure",), sort=("kind",), dealt=True)
    asked = []

    def compute(todo):
        asked.append([tuple(r) for r in todo.collect()])
        return todo.selectExpr("city", "mode", "explode(array('x', 'y')) as measure", "'a' as kind")

    units = [("a", "D", 6, "1"), ("a", "W", 6, "1"), ("b", "D", 30, "1"), ("b", "W", 1, "1"), (None, "W", 1, None)]
    units = spark.createDataFrame(units, "city string, mode string, pairs long, fingerprint string")
    assert store.update(units, compute, run_pairs=10) == 5
    assert [len(x) for x in asked] == [3, 1, 1] and sorted(sum(asked, []), key=str) == sorted([(r.city, r["mode"]) for r in units.collect()], key=str)
    assert store.rows().count() == 10 and len(list((tmp_path / "s" / "commits").glob("run=*"))) == 3
    assert store.update(units, compute, run_pairs=10) == 0 and len(asked) == 3


def test_saved_access_is_not_dealt_out_as_long_rows(spark):
    assert access_store(Inputs(spark, FOLDER), "store-of-a-test").dealt


def test_sample_of_a_join_is_that_of_the_whole_join(spark):
    rng = random.Random(5)
    side = [(rng.choice(["a", "b", None]), f"s{n % 211}", f"t{n}") for n in range(3000)]
    left = spark.createDataFrame([(*k, n) for n, k in enumerate(side)], "mode string, src string, trg string, x int")
    # Few of the rows of b have a partner, and some have two.
    kept = [k for k in side if k[0] != "b" or int(k[2][1:]) % 97 == 0]
    right = spark.createDataFrame([(*k, n) for n, k in enumerate([*kept, *kept[:100]])], "mode string, src string, trg string, y int")
    keys, seen = ["mode", "src", "trg"], []

    def join(only):
        one, other = only(left), only(right)
        seen.append(one.count() + other.count())
        return one.join(other, keys)

    for by in ([], ["mode"]):
        sizes = (left.groupBy(*by) if by else left).agg(F.count("*").alias("_size"))
        got = joined_head(join, sizes, keys, 9, 20, by)
        want = shuffled_head(left.join(right, keys), keys, 9, 20, by)
        assert got.columns == want.columns
        assert rows(got.select(*keys)) == rows(want.select(*keys)) and got.count() >= 20
    assert seen[0] < 400  # of 5,000
    assert joined_head(lambda only: only(left.limit(0)).join(only(right), keys), left.limit(0).agg(F.count("*").alias("_size")), keys, 9, 20).count() == 0


def test_samples_join_candidates_only(spark):
    for name in ("pair_sample", "pair_sample_by_mode"):
        df = bind(QUERIES[name])(spark, FOLDER)
        assert not any("Join" in line for line in lines(df)), name  # candidates were written down


def test_counted_requests_are_as_many_as_the_listed_ones(spark):
    index = spark.createDataFrame([(c, "BG", f"{c}{n:03d}", n) for c, k in (("a", 9), ("b", 4), ("d", 1)) for n in range(k)], "city string, level string, geoid string, idx long")
    modes = spark.createDataFrame([("Walk",), ("Bike",)], "mode string")
    come = [("a", "Walk", 0, 0), ("a", "Walk", 0, 0), ("a", "Walk", 0, 2), ("a", "Walk", 1, 0), ("a", "Walk", 2, 40), ("a", "Bike", 4, 3), ("b", "Bike", 0, 0), ("b", "Bike", 0, 2)]
    come = spark.createDataFrame([(c, m, "BG", s, t, "empty") for c, m, s, t in come], "city string, mode string, level string, src_off long, trg_off long, reason string")
    for answered in (None, come):
        listed = travel.requests(index, modes, 2, answered)
        counted = travel.requests(index, modes, 2, answered, counted=True)
        key = ["city", "mode", "level", "src_off"]
        assert rows(counted.select(*key, "n")) == rows(listed.groupBy(*key).agg(F.count("*").alias("n")))
    one = travel.failed_units(travel.matrix_rejects(come, unanswered=travel.requests(index, modes, 2, come)))
    two = travel.failed_units(travel.matrix_rejects(come, unanswered=travel.requests(index, modes, 2, come, counted=True)))
    assert rows(one) == rows(two) and one.dtypes == two.dtypes


def test_responses_are_not_shuffled(spark):
    i = Inputs(spark, FOLDER)
    plan = lines(zone_queries.checked_run(i, zone_queries.bg_index(i)))
    made = next(at for at, line in enumerate(plan) if "Generate stack(3, Drive" in line)
    depth = len(plan[made]) - len(plan[made].lstrip(" :+-"))
    for line in reversed(plan[:made]):
        d = len(line) - len(line.lstrip(" :+-"))
        if d < depth and line.strip():
            depth = d
            assert "Exchange" not in line, line


def test_pairs_are_dealt_out_by_their_ends_and_lines_counted_by_numbers(spark):
    plan = lines(Inputs(spark, FOLDER).pair_numbers)
    dealt = next(at for at, line in enumerate(plan) if "REPARTITION_BY_NUM" in line)
    assert not any("% 1200" in line for line in plan[dealt:])
    plan = lines(Inputs(spark, FOLDER).wac)
    first = max(at for at, line in enumerate(plan) if "partial_count" in line)
    assert not any("lpad" in line and "l_linenumber" in line for line in plan[first:])
