import gzip

import pytest
from pyspark.sql import functions as F

from zonereach.plans import travel
from zonereach.sources import readers, writers


def test_pipe_text_with_bad_bytes(spark, tmp_path):
    f = tmp_path / "blocks.txt"
    f.write_bytes(b"STATE|GEOID|NAME|UACE\n1|10010201001000|Ca\xf1on City, CO|37\n1|10010201001001|Plain, AL|58600\n")
    df = readers.urban_area_blocks(
        spark, str(f), "STATE string, GEOID string, NAME string, UACE string",
        {"GEOID": "geoid", "NAME": "name", "UACE": "code"},
    )
    assert df.columns == ["geoid", "name", "code"]
    rows = [tuple(r) for r in df.orderBy("geoid").collect()]
    assert rows == [("010010201001000", "Cañon City, CO", "00037"), ("010010201001001", "Plain, AL", "58600")]


def test_gzip_csv(spark, tmp_path):
    for state in ("al", "ga"):
        with gzip.open(tmp_path / f"{state}_wac_2022.csv.gz", "wt") as f:
            f.write("w_geocode,C000,CE01\n10010201001000,5,2\n")
    df = readers.delimited(spark, str(tmp_path / "*.csv.gz"), "w_geocode long, C000 long, CE01 long", {"w_geocode": "geoid", "C000": "All"})
    assert [tuple(r) for r in df.collect()] == [(10010201001000, 5)] * 2


def test_path_parts_and_glob(spark, tmp_path):
    for city, mode in (("new-york", "drive"), ("st-louis", "walk")):
        spark.range(2).coalesce(1).write.parquet(str(tmp_path / "x" / f"{city}_{mode}_bg.parquet"))
    files = [str(p) for p in sorted((tmp_path / "x").glob("*"))]
    df = readers.parquet(spark, files, ["id", F.regexp_extract("_metadata.file_path", r"/([^/_]+)_[^/]*\.parquet/", 1).alias("city")])
    assert {r.city for r in df.collect()} == {"new-york", "st-louis"}
    flat = tmp_path / "flat"
    flat.mkdir()
    (flat / "new-york_drive_bg.csv").write_text("1\n2\n")
    got = readers.with_path_parts(spark.read.csv(str(flat), schema="a int"), r"([^_/]+)_([^_/]+)_([^_/.]+)[.]", ["city", "mode", "level"])
    assert {tuple(r) for r in got.collect()} == {(1, "new-york", "drive", "bg"), (2, "new-york", "drive", "bg")}


def test_pushed_filter_and_pruning(spark, tmp_path):
    spark.range(100).selectExpr("id", "id % 3 as level", "'x' as pad").write.parquet(str(tmp_path / "t"))
    df = readers.parquet(spark, str(tmp_path / "t"), ["id"], (F.col("level") != 1) & (F.col("id") <= 50))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "LessThanOrEqual(id,50)" in plan and "pad" not in plan
    assert df.count() == 34


def test_header_first_json(spark):
    body = '[["B1","state","county","tract","block group","B2"],["12","01","001","020100","1","7"],["3","01","001","020100","2",null]]'
    df = spark.createDataFrame([(body,)], "body string")
    rows = readers.census_population(df, "body", {"B1": "popu", "B2": "labor"}).orderBy("geoid").collect()
    assert [tuple(r) for r in rows] == [("010010201001", 12, 7), ("010010201002", 3, None)]


def test_one_file_per_level(spark):
    files = spark.createDataFrame([("AL", "b_block_group.csv"), ("AL", "a_block_group.csv"), ("AL", "x_county.csv")], "state string, name string")
    got = readers.one_file_per_level(files, ["block_group", "county", "census_tract"], ["state"]).collect()
    assert {(r.level, r.name) for r in got} == {("block_group", "a_block_group.csv"), ("county", "x_county.csv")}


def test_year_fallback(spark):
    rows = spark.createDataFrame([("MI", 2021, 1), ("MI", 2019, 2), ("AL", 2022, 3), ("MS", 2023, 4)], "state string, year int, n int")
    got = {tuple(r) for r in readers.latest_year_per_source(rows, "state", 2022).select("state", "year", "n").collect()}
    assert got == {("MI", 2021, 1), ("AL", 2022, 3)}
    wanted = spark.createDataFrame([("MI",), ("MS",)], "state string")
    assert [r.state for r in readers.absent_sources(wanted, rows, "state", 2022).collect()] == ["MS"]


def test_wkt_reader(spark):
    df = spark.createDataFrame([("a", "POLYGON((0 0,1 0,1 1,0 0))")], "id string, wkt string")
    assert readers.with_geometry(df).select(F.size(F.col("geometry")[0])).first()[0] == 4


def test_csv_sink_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("01", 1.5), ("02", None)], "geoid string, v double")
    writers.csv(df, str(tmp_path / "out"), gzip=True)
    assert all(p.name.endswith(".csv.gz") for p in (tmp_path / "out").glob("part-*"))
    back = readers.delimited(spark, str(tmp_path / "out"), "geoid string, v double").orderBy("geoid")
    assert [tuple(r) for r in back.collect()] == [("01", 1.5), ("02", None)]


def test_partitioned_sink_spreads_a_hot_key(spark, tmp_path):
    df = spark.range(1000).selectExpr("id", "if(id % 10 < 9, 'hot', 'cold') as city")
    # Tiny partitions would be merged again by the adaptive planner, which is right but hides the spread.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        writers.parquet(df, str(tmp_path / "t"), ["city"], files_per_key=4)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(list((tmp_path / "t" / "city=hot").glob("*.parquet"))) > 1
    assert spark.read.parquet(str(tmp_path / "t")).count() == 1000


def test_incremental_computes_only_absent_units(spark, tmp_path):
    path = str(tmp_path / "units")
    units = spark.createDataFrame([("a", "Drive"), ("a", "Walk"), ("b", "Drive")], "city string, mode string")
    asked = []

    def compute(stamp):
        def run(todo):
            asked.append({tuple(r) for r in todo.collect()})
            return todo.withColumn("v", F.lit(stamp))

        return run

    writers.incremental(units.where("city = 'a'"), compute(1), path)
    out = writers.incremental(units, compute(2), path)
    assert asked == [{("a", "Drive"), ("a", "Walk")}, {("b", "Drive")}]
    assert {(r.city, r["mode"]): r.v for r in out.collect()} == {("a", "Drive"): 1, ("a", "Walk"): 1, ("b", "Drive"): 2}
    out = writers.incremental(units.where("mode = 'Walk'"), compute(3), path, overwrite=True)
    assert {(r.city, r["mode"]): r.v for r in out.collect()} == {("a", "Drive"): 1, ("a", "Walk"): 3, ("b", "Drive"): 2}


def test_unit_checks(spark):
    travel.check_unit("walk", "bg")
    travel.check_unit("transit", "tract", travel.R5_MODES)
    for mode, level in (("transit", "bg"), ("walk", "block")):
        with pytest.raises(ValueError):
            travel.check_unit(mode, level)
    df = spark.createDataFrame([("Walk", "BG"), ("Fly", "BG")], "mode string, level string")
    assert travel.known_units(df).count() == 1


def test_matrix_ingest(spark):
    index = spark.createDataFrame([("c", "BG", i, f"z{i}") for i in range(4)], "city string, level string, idx long, geoid string")
    body = '{"distances": [[0, 10, 3], [5, 7]], "durations": [[0, 600, 1], [5400, 5401]]}'
    other = '{"distances": [[4], [1]], "durations": [[120, 60], [null]]}'
    m = spark.createDataFrame([("c", "Walk", "BG", 2, 0, body), ("c", "Walk", "BG", 2, 2, other)], "city string, mode string, level string, src_off long, trg_off long, response string")
    got = {(r.src, r.trg): (r.dist, r.time_min) for r in travel.od_from_matrices(m, travel.id_blocks(index, 2)).collect()}
    assert got == {("z2", "z0"): (0.0, 0.0), ("z2", "z1"): (10.0, 10.0), ("z3", "z0"): (5.0, 90.0), ("z2", "z2"): (4.0, 2.0), ("z2", "z3"): (None, 1.0)}


def test_request_blocks(spark):
    index = spark.createDataFrame([("c", "BG", i) for i in range(7)] + [("one", "BG", 0)], "city string, level string, idx long")
    got = sorted(tuple(r) for r in travel.request_blocks(index, 3).collect())
    assert got == [("c", "BG", 0, 0, 2, 3, 3), ("c", "BG", 1, 3, 5, 3, 3), ("c", "BG", 2, 6, 6, 1, 3)]


def test_state_filter(spark):
    df = spark.createDataFrame([("181", "182"), ("181", "171"), ("171", "172")], "src string, trg string")
    assert df.where(travel.both_ends_in_state("18")).count() == 1
    assert df.where(travel.both_ends_in_state()).count() == 2


def test_compact_codes(spark):
    rows = [("c", "Walk", "BG", s, t, m) for s, t, m in (("010010000021", "010010000011", 3.9), ("010010000011", "010030000011", 90.0),
                                                         ("010010000021", "010030000011", 0.0))]
    od = spark.createDataFrame(rows, "city string, mode string, level string, src string, trg string, time_min double")
    got = sorted((r.from_id, r.to_id, r.time) for r in travel.compact_codes(od).collect())
    assert got == [(0, 1, 90), (1, 0, 3), (1, 1, 0)]


REQUESTS = "city string, mode string, level string, src_off long, trg_off long, response string"


def test_bad_responses_are_not_lost(spark):
    index = spark.createDataFrame([("c", "BG", i, f"z{i}") for i in range(5)] + [("one", "BG", 0, "y")], "city string, level string, idx long, geoid string")
    blocks = travel.id_blocks(index, 2)
    whole = '{"distances": [[0, 1], [2, 3]], "durations": [[0, 60], [120, null]]}'
    rows = [
        (0, 0, whole), (0, 2, whole[: len(whole) // 2]), (2, 0, None), (2, 2, '{"code": "TooBig"}'), (0, 4, whole), (4, 4, '{"distances": [[9]], "durations": [[60]]}'),
        (6, 0, whole), (2, 4, '{"distances": [[1], [2]], "durations": [[1]]}'), (4, 0, whole[:-1]), (4, 2, '{"distances": [[1, 2]], "durations": [[60, 60]]}'),
        (4, 2, '{"distances": [[1, 2]], "durations": [[60, 60]]}'), (0, 6, "[]"),
    ]
    m = spark.createDataFrame([("c", "Walk", "BG", *r) for r in rows] + [("d", "Walk", "BG", 0, 0, whole)], REQUESTS).repartition(3)
    checked = travel.checked_matrices(m, blocks)
    assert checked.count() == m.count()
    wanted = travel.requests(index, spark.createDataFrame([("Walk",), ("Bike",)], "mode string"), 2)
    assert wanted.count() == 18
    rejects = travel.matrix_rejects(checked, wanted)
    got = sorted((r.city, r["mode"], r.src_off, r.trg_off, r.reason) for r in rejects.collect())
    walk = {(0, 2): "not JSON", (2, 0): "empty", (2, 2): "no matrix", (0, 4): "surplus cells", (6, 0): "not requested", (2, 4): "wrong shape",
            (4, 0): "not JSON", (0, 6): "not JSON"}
    want = [("c", "Walk", *k, v) for k, v in walk.items()] + [("c", "Walk", 4, 2, "repeated")] * 2 + [("d", "Walk", 0, 0, "not requested")]
    want += [("c", "Bike", a, b, "no response") for a in (0, 2, 4) for b in (0, 2, 4)]
    assert got == sorted(want)
    cells = {(r.src, r.trg): (r.dist, r.time_min) for r in travel.matrix_cells(checked).collect()}
    assert cells == {("z0", "z0"): (0.0, 0.0), ("z0", "z1"): (1.0, 1.0), ("z1", "z0"): (2.0, 2.0), ("z4", "z4"): (9.0, 1.0)}
    failed = {(r.city, r["mode"]): (r.rejects, r.reasons) for r in travel.failed_units(rejects).collect()}
    assert failed["c", "Bike"] == (9, ["no response"]) and failed["c", "Walk"][0] == 10 and failed["d", "Walk"] == (1, ["not requested"])
    with pytest.raises(Exception, match="response to c Walk BG"):
        travel.od_from_matrices(m, blocks).collect()
    skipped = travel.od_from_matrices(m, blocks, on_bad="skip").collect()
    assert {(r.src, r.trg) for r in skipped} >= set(cells)
    with pytest.raises(ValueError):
        travel.od_from_matrices(m, blocks, on_bad="ignore")


def test_bad_answers_are_not_lost(spark):
    good = '[["a","b"],["1","2"],["3","4"]]'
    rows = [("ok", good), ("cut", good[:-4]), ("none", None), ("blank", ""), ("bare", "[]"), ("field", '[["a","c"],["1","2"]]'),
            ("row", '[["a","b"],["1"]]'), ("header", '[["b","a"]]'), ("object", '{"error": "unknown variable"}')]
    df = spark.createDataFrame(rows, "id string, body string")
    checked = readers.checked_header_first(df, "body", ["a", "b"], ["id"])
    reasons = {r.id: r.reason for r in checked.collect()}
    assert reasons == {"ok": None, "cut": "not JSON", "none": "empty", "blank": "not JSON", "bare": "no header", "field": "missing field",
                       "row": "wrong shape", "header": None, "object": "not JSON"}
    got = readers.header_first_rows(df, "body", ["b", "a"], ["id"], on_bad="skip").collect()
    assert sorted(tuple(r) for r in got) == [("ok", "2", "1"), ("ok", "4", "3")]
    with pytest.raises(Exception, match="cannot be read"):
        readers.header_first_rows(df, "body", ["a"], ["id"]).collect()


def test_bad_lines_are_not_lost(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x,n\np,1\nq,one\nr\ns,2,3\n,\nt,4\n")
    (tmp_path / "b.csv").write_text("x,n\nu,5\n")
    rows, rejects = readers.checked_delimited(spark, str(tmp_path), "x string, n int")
    assert sorted(tuple(r) for r in rows.collect() if r.x) == [("p", 1), ("t", 4), ("u", 5)]
    assert sorted(r.x for r in rows.select("x").collect() if r.x) == ["p", "t", "u"] and rows.select("n").where("n > 0").count() == 3
    assert sorted(r.line for r in rejects.collect()) == ["q,one", "r", "s,2,3"]
    assert {r.file.rsplit("/")[-1] for r in rejects.collect()} == {"a.csv"}


def test_a_response_is_read_once(spark):
    """The matrix is a value in the plan that conditions refer to, not an expression that each of them reads again."""
    index = spark.createDataFrame([("c", "BG", i, f"z{i}") for i in range(3)], "city string, level string, idx long, geoid string")
    m = spark.createDataFrame([("c", "Walk", "BG", 0, 0, None)], REQUESTS)
    out = travel.od_from_matrices(m, travel.id_blocks(index, 2))
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


def test_unanswered_requests_are_listed_per_block(spark):
    """The same as the requests without the answered ones, which are not joined to them."""
    index = spark.createDataFrame([("c", "BG", i, f"z{i}") for i in range(7)] + [("d", "BG", i, f"y{i}") for i in range(2)], "city string, level string, idx long, geoid string")
    modes = spark.createDataFrame([("Walk",), ("Bike",)], "mode string")
    rows = [("c", "Walk", "BG", 0, 0), ("c", "Walk", "BG", 0, 0), ("c", "Walk", "BG", 1, 2), ("c", "Walk", "BG", 2, 3), ("c", "Bike", "BG", 6, 6),
            ("d", None, "BG", 0, 0), ("d", "Walk", "BG", 0, 0), ("c", "Bike", "BG", 0, None), ("c", "Bike", "BG", 0, 40)]
    checked = spark.createDataFrame([(*r, None) for r in rows], "city string, mode string, level string, src_off long, trg_off long, reason string")
    everything = travel.requests(index, modes, 2)
    want = sorted(tuple(r) for r in travel.matrix_rejects(checked, everything).collect())
    some = travel.requests(index, modes, 2, answered=checked)
    assert sorted(tuple(r) for r in travel.matrix_rejects(checked, unanswered=some).collect()) == want
    assert len(want) == 2 * 16 + 2 - 3
    # The answers move, the requests do not.
    assert "LeftAnti" not in some._jdf.queryExecution().optimizedPlan().toString()


def test_responses_of_unknown_requests_do_not_count_as_repeated(spark):
    index = spark.createDataFrame([("c", "BG", i, f"z{i}") for i in range(2)], "city string, level string, idx long, geoid string")
    cell = '{"distances": [[0, 1], [2, 3]], "durations": [[0, 60], [120, 60]]}'
    m = spark.createDataFrame([("c", None, "BG", 0, 0, cell)] * 2 + [("c", "Walk", "BG", 0, 0, cell)] * 2, REQUESTS)
    got = sorted((r["mode"] or "", r.reason or "") for r in travel.checked_matrices(m, travel.id_blocks(index, 2)).collect())
    assert got == [("", ""), ("", ""), ("Walk", "repeated"), ("Walk", "repeated")]


def test_pairs_are_dealt_out_by_the_lines(spark, tmp_path, monkeypatch):
    """Tasks follow the rows and not the bytes of the shuffle before the modes are told apart."""
    from zonereach.sources import fixtures

    spark.createDataFrame([(0, "N0", 0), (5, "N5", 0)], "n_nationkey int, n_name string, n_regionkey int").write.parquet(str(tmp_path / "nation.parquet"))
    spark.createDataFrame([(0, "R0")], "r_regionkey int, r_name string").write.parquet(str(tmp_path / "region.parquet"))
    spark.range(40).selectExpr("id as s_suppkey").write.parquet(str(tmp_path / "supplier.parquet"))
    lines = spark.range(4000).selectExpr("id % 400 as l_partkey", "id % 40 as l_suppkey")
    lines.write.parquet(str(tmp_path / "lineitem.parquet"))
    monkeypatch.setattr(fixtures, "TASK_LINES", 250)
    few = fixtures.Inputs(spark, str(tmp_path)).od
    assert few.rdd.getNumPartitions() == 16
    monkeypatch.setattr(fixtures, "TASK_LINES", 1_000_000)
    many = fixtures.Inputs(spark, str(tmp_path)).od
    assert sorted(map(tuple, few.collect())) == sorted(map(tuple, many.collect()))
