import hashlib
import random

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from zonereach.conformance import QUERIES
from zonereach.conformance import validation_queries as vq
from zonereach.functions import geo
from zonereach.operators import dissolve, ranking, relational, rollup, spatial, stats
from zonereach.plans import validation as val
from zonereach.sources.fixtures import Inputs


def skewed(n=3000, seed=1):
    """Values with ties in groups of which one holds most of the rows."""
    rnd = random.Random(seed)
    return pd.DataFrame(
        [("big" if rnd.random() < 0.7 else rnd.choice("abc"), float(rnd.randint(0, 900)) / 8) for _ in range(n)],
        columns=["g", "v"],
    )


def test_average_rank_is_the_same_split_or_whole(spark):
    pdf = skewed()
    got = ranking.with_average_rank(spark.createDataFrame(pdf), "v", ["g"], ascending=False).toPandas()
    want = pdf.assign(rank=pdf.groupby("g").v.rank(ascending=False))
    key = ["g", "v", "rank"]
    pd.testing.assert_frame_equal(
        got[key].sort_values(key).reset_index(drop=True), want[key].sort_values(key).reset_index(drop=True)
    )


def test_percentile_rank_without_groups(spark):
    pdf = skewed(800)
    got = ranking.with_average_rank(spark.createDataFrame(pdf), "v", pct=True).toPandas()
    want = (pdf.v.rank(pct=True) * 100).sort_values().to_numpy()
    np.testing.assert_allclose(got["rank"].sort_values().to_numpy(), want)


def test_box_stats(spark):
    pdf = skewed()
    pdf.loc[:20, "v"] = 5000.0  # outliers
    got = ranking.box_stats(spark.createDataFrame(pdf), "v", ["g"], mean=True).toPandas().set_index("g")
    for g, s in pdf.groupby("g").v:
        q1, q2, q3 = s.quantile([0.25, 0.5, 0.75])
        lo, hi = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
        kept = s[(s >= lo) & (s <= hi)]
        r = got.loc[g]
        assert (r.q1, r["median"], r.q3) == pytest.approx((q1, q2, q3))
        assert (r.whisker_lo, r.whisker_hi, r.outliers) == (kept.min(), kept.max(), len(s) - len(kept))
        assert r["mean"] == pytest.approx(s.mean()) and r.n == len(s)


def test_id_positions(spark):
    rnd = random.Random(3)
    ids = {(c, f"{rnd.randint(1, 3):02d}{rnd.randint(0, 4):03d}{rnd.randint(0, 30):06d}{rnd.randint(1, 3)}") for c in "xy" for _ in range(300)}
    df = spark.createDataFrame([*ids, *list(ids)[:50]], "city string, geoid string")
    got = {(r.city, r.geoid): r.idx for r in ranking.id_positions(df, ["city"]).collect()}
    want = {(c, g): i for c in "xy" for i, g in enumerate(sorted(g for k, g in ids if k == c))}
    assert got == want


def test_factor_codes(spark):
    df = spark.createDataFrame([(1, "b"), (2, "a"), (3, "b"), (4, "c"), (5, None)], "i int, v string")
    assert {r.v: r.code for r in ranking.factor_codes(df, "v", "i").collect()} == {"b": 0, "a": 1, "c": 2}


def test_batches_and_positions(spark):
    df = spark.createDataFrame([(f"c{i}", i * 7 % 10) for i in range(10)], "city string, popu int")
    out = ranking.batches(ranking.positional_rank(df, [F.desc("popu"), F.col("city")]), [F.col("rank")], 2).collect()
    assert sorted((r["rank"], r["batch"]) for r in out) == [(i + 1, 1 if i < 5 else 2) for i in range(10)]


def test_majority_breaks_ties_by_choice(spark):
    df = spark.createDataFrame([("z", "b"), ("z", "a"), ("y", "b"), ("y", "b"), ("y", "a")], "k string, c string")
    assert {(r.k, r.c, r.n) for r in rollup.majority(df, ["k"], ["c"]).collect()} == {("z", "a", 1), ("y", "b", 2)}


def test_first_per_key(spark):
    df = spark.createDataFrame([("k", 2, "x"), ("k", 1, "y"), ("j", 5, "z")], "k string, o int, v string")
    assert {tuple(r) for r in rollup.first_per_key(df, ["k"], ["o"]).collect()} == {("k", 1, "y"), ("j", 5, "z")}


def test_rollup_keeps_totals(spark):
    df = spark.createDataFrame([(f"0100{i % 3}00000{i % 4}{i % 2}", i) for i in range(40)], "geoid string, n int")
    out = rollup.prefix_rollup(df, ["n"], ("BG", "Tract", "County")).toPandas()
    assert set(out.groupby("level").n.sum()) == {sum(range(40))}
    assert set(out[out.level == "County"].geoid.str.len()) == {5}


def test_salted_join_equals_plain_join(spark):
    many = spark.range(2000).selectExpr("id", "if(id % 3 = 0, 0, id % 40) as k")
    few = spark.range(60).selectExpr("id % 40 as k", "id as w")
    want = sorted(tuple(r) for r in many.join(few, "k").select("id", "k", "w").collect())
    got = spatial.salted_join(many, few, ["k"], ["id"], hot_rows=30).select("id", "k", "w").collect()
    assert sorted(tuple(r) for r in got) == want


def boxes(n, seed):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        x, y = rnd.uniform(-5, 5), rnd.uniform(-5, 5)
        out.append((i, x, y, x + rnd.uniform(0, 3), y + rnd.uniform(0, 2)))
    return out


def test_boxes_overlap_brute_force(spark):
    a, b = boxes(60, 1), boxes(50, 2)
    cols = "{} int, minx double, miny double, maxx double, maxy double"
    for hot in (5, 10**6):
        got = spatial.boxes_overlap(
            spark.createDataFrame(a, cols.format("i")), spark.createDataFrame(b, cols.format("j")), 0.7, hot_rows=hot
        ).select("i", "j").collect()
        want = [(p[0], q[0]) for p in a for q in b if p[1] <= q[3] and p[3] >= q[1] and p[2] <= q[4] and p[4] >= q[2]]
        assert sorted(tuple(r) for r in got) == sorted(want)


def square(x, y, w=1.0):
    pts = [(x, y), (x + w, y), (x + w, y + w), (x, y + w), (x, y)]
    return [[{"x": float(a), "y": float(b)} for a, b in pts]]


def grid(spark, cells, level="BG"):
    rows = [(f"{x:02d}{y:02d}", level, "even" if x % 2 == 0 else "odd", square(x, y)) for x, y in cells]
    return spark.createDataFrame(rows, f"geoid string, level string, grp string, geometry array<{geo.RING}>")


def test_points_in_polygons_with_hot_cells(spark):
    cells = [(x, y) for x in range(4) for y in range(4) if (x, y) != (1, 1)]
    rnd = random.Random(9)
    pts = [(i, *((0.5, 0.5) if i % 3 == 0 else (rnd.uniform(-1, 5), rnd.uniform(-1, 5)))) for i in range(600)]
    points = spark.createDataFrame(pts, "id int, lon double, lat double")
    want = sorted((i, f"{int(x):02d}{int(y):02d}") for i, x, y in pts if x > 0 and y > 0 and (int(x), int(y)) in cells)
    for size in (0.3, 0.8, 7.0):
        got = spatial.points_in_polygons(points, grid(spark, cells), {"BG": size}).select("id", "geoid")
        assert sorted(tuple(r) for r in got.collect()) == want


def test_points_in_irregular_shapes(spark):
    """Stars with holes, on grids finer and coarser than they are, against the ray through all edges."""
    rnd = random.Random(4)

    def star(x, y, r, n):
        ends = [(x + r * rnd.uniform(0.3, 1) * math.cos(2 * math.pi * k / n), y + r * rnd.uniform(0.3, 1) * math.sin(2 * math.pi * k / n)) for k in range(n)]
        return [{"x": a, "y": b} for a, b in [*ends, ends[0]]]

    shapes = [(f"s{k}", "A", [star(k, k % 3, 1.4, 17), star(k, k % 3, 0.3, 5)[::-1], star(k + 9, 1, 0.8, 9)]) for k in range(6)]
    zones = spark.createDataFrame(shapes, f"geoid string, level string, geometry array<{geo.RING}>")
    points = spark.createDataFrame([(i, rnd.uniform(-2, 16), rnd.uniform(-2, 5)) for i in range(1500)], "id int, lon double, lat double")
    x, y = F.col("lon"), F.col("lat")
    want = points.crossJoin(zones).where(geo.contains(geo.polygon_edges(F.col("geometry")), x, y)).select("id", "geoid").collect()
    for size in (0.15, 1.0, 30.0):
        got = spatial.points_in_polygons(points, zones, {"A": size}).select("id", "geoid").collect()
        assert sorted(map(tuple, got)) == sorted(map(tuple, want)) and len(got) > 100


def test_levels_without_a_size_are_an_error(spark):
    points = spark.createDataFrame([(1, 1.0, 0.5)], "id int, lon double, lat double")
    with pytest.raises(Exception, match="no cell size for level BG"):
        spatial.points_in_polygons(points, grid(spark, [(0, 0)]), {"Tract": 1.0}).collect()


def test_edge_points_belong_to_both_or_none(spark):
    points = spark.createDataFrame([(1, 1.0, 0.5)], "id int, lon double, lat double")
    zones = grid(spark, [(0, 0), (1, 0)])
    assert spatial.points_in_polygons(points, zones, {"BG": 1.0}, boundary=False).count() == 0
    assert spatial.points_in_polygons(points, zones, {"BG": 1.0}, boundary=True).count() == 2


def test_clip_points(spark):
    points = spark.createDataFrame([(i, i / 10, 1.0) for i in range(50)], "id int, lon double, lat double")
    box = spark.createDataFrame([("c", 1.0, 0.0, 2.0, 1.0)], "city string, minx double, miny double, maxx double, maxy double")
    assert sorted(r.id for r in spatial.clip_points(points, box, 0.3).collect()) == list(range(10, 21))


def test_outline_of_a_block_is_its_border(spark):
    lines = dissolve.outline(grid(spark, [(x, y) for x in range(3) for y in range(3)]).withColumn("all", F.lit(1)), ["all"])
    assert lines.count() == 12


def test_dissolved_area_is_the_sum(spark):
    out = dissolve.dissolve_attributes(grid(spark, [(x, y) for x in range(3) for y in range(2)]).withColumn("p", F.lit(2)), ["grp"], ["p"])
    assert {(r.grp, r.p, r.area) for r in out.collect()} == {("even", 8, 4.0), ("odd", 4, 2.0)}


def test_components_match_union_find(spark):
    rnd = random.Random(11)
    nodes = 150
    edges = [(rnd.randrange(nodes), rnd.randrange(nodes)) for _ in range(110)] + [(0, i) for i in range(100, 140)]
    chain = [(1000 + i, 1001 + i) for i in range(60)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in [*edges, *chain]:
        if a != b:
            ra, rb = find(a), find(b)
            parent[max(ra, rb)] = min(ra, rb)
    got = {r.node: r.component for r in dissolve.connected_components(
        spark.createDataFrame([*edges, *chain], "a int, b int")).collect()}
    assert got == {x: find(x) for x in parent}


def test_contiguous_catchment_takes_the_largest_part(spark):
    zones = grid(spark, [(0, 0), (0, 1), (0, 2), (5, 5), (5, 6), (9, 9)])
    members = spark.createDataFrame(
        [("t1", g) for g in ("0000", "0001", "0002", "0505", "0506")] + [("t2", "0909")], "trg string, geoid string"
    )
    out = dissolve.contiguous_catchments(members, zones, ["trg"]).collect()
    assert {(r.trg, r.geoid, r.part) for r in out} == {
        ("t1", "0000", "0000"), ("t1", "0001", "0000"), ("t1", "0002", "0000"), ("t2", "0909", "0909")
    }
    # Square metres of Web Mercator: a degree of longitude times the stretched degrees of latitude.
    up = lambda lat: 6378137.0 * math.log(math.tan(math.pi / 4 + math.radians(lat) / 2))
    areas = {r.trg: r.part_area for r in out}
    box = zones.where("geoid = '0909'").first().geometry[0]
    ys = sorted({p.y for p in box})
    xs = sorted({p.x for p in box})
    assert areas["t2"] == pytest.approx(6378137.0 * math.radians(xs[1] - xs[0]) * (up(ys[1]) - up(ys[0])))


def test_catchments_are_solved_where_their_members_lie(spark, tmp_path):
    rng = random.Random(4)
    cells = [(i, j) for i in range(7) for j in range(7)]
    zones = grid(spark, cells)
    rows = [(f"c{t % 2}", t % 3, f"t{t}", f"{i:02d}{j:02d}") for t in range(20) for i, j in rng.sample(cells, 25)]
    members = spark.createDataFrame(rows + rows[:30], "city string, block int, trg string, geoid string")
    by, place = ["city", "block", "trg"], (4, "city", "block")
    members.repartition(*place).write.format("parquet").option("path", str(tmp_path / "m")).bucketBy(4, "city", "block").saveAsTable("members_in_place")
    kept = {c: spark.conf.get(c) for c in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    try:
        for c, v in zip(kept, ("-1", "false")):
            spark.conf.set(c, v)
        placed = dissolve.contiguous_catchments(spark.table("members_in_place"), zones, by, place)
        assert "Exchange" not in placed._jdf.queryExecution().executedPlan().toString()
        got = {(r.trg, r.geoid, r.part) for r in placed.collect()}
    finally:
        for c, v in kept.items():
            spark.conf.set(c, v)
        spark.sql("drop table members_in_place")
    for t in {r[2] for r in rows}:
        left, parts = {(int(r[3][:2]), int(r[3][2:])) for r in rows if r[2] == t}, []
        while left:
            part, todo = set(), [left.pop()]
            while todo:
                x, y = todo.pop()
                part.add((x, y))
                near = {(x + 1, y), (x - 1, y), (x, y + 1), (x, y - 1)} & left
                left -= near
                todo += near
            parts.append(part)
        sizes = {min(f"{x:02d}{y:02d}" for x, y in p): p for p in parts}
        mine = {part for trg, _, part in got if trg == t}
        assert len(mine) == 1 and mine <= set(sizes)
        assert {g for trg, g, _ in got if trg == t} == {f"{x:02d}{y:02d}" for x, y in sizes[next(iter(mine))]}
    plain = dissolve.contiguous_catchments(members, zones, by).collect()
    assert {(r.trg, r.geoid, r.part) for r in plain} == got and len(plain) == len(got)


def test_relational_helpers(spark):
    a = spark.createDataFrame([(1, "x", 2.0), (2, None, None), (3, "y", float("inf"))], "k int, s string, v double")
    assert [r.k for r in a.where(relational.not_in(F.col("s"), ["x"])).collect()] == [2, 3]
    assert [r.k for r in a.where(relational.finite(F.col("v"))).collect()] == [1]
    assert relational.keyword_filter(a, s="x", k=1).columns == ["v"]
    assert relational.numeric_columns(a) == ["k", "v"]
    b = spark.createDataFrame([(1, 7), (4, 9)], "k int, w int")
    assert {tuple(r) for r in relational.zero_filled_left_join(a.select("k"), b, ["k"]).collect()} == {(1, 7), (2, 0), (3, 0)}
    full = relational.zero_filled_outer_join(a.select("k", F.lit(1).alias("u")), b, ["k"])
    assert {tuple(r) for r in full.collect()} == {(1, 1, 7), (2, 1, 0), (3, 1, 0), (4, 0, 9)}
    assert relational.natural_join(a, b).count() == 1
    with pytest.raises(ValueError):
        relational.natural_join(a.select("s"), b)
    assert relational.nonzero_rows(b.withColumn("z", F.col("k") - 1), ["z", "w"]).count() == 1
    assert relational.lower_names(b.toDF("K", "W")).columns == ["k", "w"]
    assert relational.strip_name_prefix(b.toDF("p.k", "p.w"), "p.").columns == ["k", "w"]
    assert relational.cast_table(b, {"w": "double"}).dtypes == [("w", "double")]


def test_normalize_bounds(spark):
    df = spark.createDataFrame([("a", 2.0), ("a", 6.0), ("b", 5.0)], "g string, v double")
    assert {(r.g, r.v): r.norm for r in relational.minmax_normalize(df, "v", ["g"]).collect()} == {
        ("a", 2.0): 0.0, ("a", 6.0): 1.0, ("b", 5.0): None
    }
    assert [r.norm for r in relational.minmax_normalize(df, "v", vmin=0, vmax=10).orderBy("v").collect()] == [0.2, 0.5, 0.6]


def test_samples_by_group_are_exact_and_bounded(spark):
    rows = [(i, ("big", "big", "big", "mid", None)[i % 5] if i < 9000 else "small") for i in range(9007)]
    df = spark.createDataFrame(rows, "id long, g string").repartition(6)
    digest = lambda i: hashlib.md5(f"7|{i}".encode()).hexdigest()
    groups = {}
    for i, g in rows:
        groups.setdefault(g, []).append(i)
    want = {(g, i) for g, ids in groups.items() for i in sorted(ids, key=digest)[:50]}
    got = relational.shuffled_head(df, ["id"], 7, 50, by=["g"]).collect()
    assert {(r.g, r.id) for r in got} == want and len(got) == len(want) == 157
    # What comes together to be put in order is little more than the sample.
    near = relational.sample_candidates(df, ["id"], 7, 50, by=["g"]).groupBy("g").count().collect()
    assert {r.g for r in near} == set(groups) and all(r["count"] <= 50 + 12 * 50**0.5 + 40 for r in near)
    assert relational.sample_candidates(df, ["id"], 7, 400).count() <= 400 + 12 * 20 + 40
    assert relational.shuffled_head(df.where("false"), ["id"], 7, 5).count() == relational.shuffled_head(df.where("false"), ["id"], 7, 5, ["g"]).count() == 0


def test_a_sample_with_an_unlucky_threshold_is_whole(spark):
    # Few rows: thresholds above one take all of them. Equal hashes lie on one side of any threshold.
    df = spark.createDataFrame([("a", i % 3) for i in range(900)] + [("b", 5)] * 40, "g string, k int")
    got = relational.shuffled_head(df, ["k"], 1, 100, by=["g"])
    assert sorted((r.g, r["count"]) for r in got.groupBy("g").count().collect()) == [("a", 100), ("b", 40)]


def test_shuffled_head_is_repeatable(spark):
    df = spark.range(1000)
    one = [r.id for r in relational.shuffled_head(df, ["id"], 7, 20).collect()]
    two = [r.id for r in relational.shuffled_head(df.repartition(5), ["id"], 7, 20).collect()]
    assert one == two and len(set(one)) == 20
    assert one != [r.id for r in relational.shuffled_head(df, ["id"], 8, 20).collect()]


def test_through_origin_fit_and_line(spark):
    rng = np.random.default_rng(2)
    pdf = pd.DataFrame({"g": rng.choice(["a", "b"], 200), "x": rng.random(200) * 50})
    pdf["y"] = 1.3 * pdf.x + rng.normal(size=200)
    fits = stats.through_origin_fit(spark.createDataFrame(pdf), "x", "y", ["g"])
    for r in fits.collect():
        s = pdf[pdf.g == r.g]
        slope = (s.x * s.y).sum() / (s.x**2).sum()
        r2 = 1 - ((s.y - slope * s.x) ** 2).sum() / (s.y**2).sum()
        assert (r.slope, r.r2, r.n) == pytest.approx((slope, r2, len(s)))
    line = stats.fitted_line(fits, F.lit(90.0), 4).where("g = 'a'").orderBy("step").collect()
    assert [r.x for r in line] == [0, 30, 60, 90]


def test_regression_table(spark):
    rng = np.random.default_rng(4)
    x = rng.random((80, 3))
    y = 2 + x @ [1.0, -3.0, 0.5] + rng.normal(size=80) * 0.1
    df = spark.createDataFrame(pd.DataFrame(x, columns=["a", "b", "c"]).assign(y=y))
    for intercept in (True, False):
        m = np.column_stack([x, np.ones(80)]) if intercept else x
        coef, *_ = np.linalg.lstsq(m, y, rcond=None)
        res = y - m @ coef
        se = np.sqrt(np.diag(np.linalg.inv(m.T @ m)) * (res @ res) / (80 - m.shape[1]))
        out = stats.regression_table(df, ["a", "b", "c"], "y", intercept).collect()
        np.testing.assert_allclose([r.coefficient for r in out], coef, rtol=1e-8)
        np.testing.assert_allclose([r.std_error for r in out], se, rtol=1e-6)


@pytest.mark.parametrize("folder", ["sf0.001", "sf0.01"])
def test_county_summaries_fit_all_features(spark, folder):
    """Also on so few counties that the fit is singular, which the SQL leaves out."""
    i = Inputs(spark, f"/root/testdata/{folder}")
    data = val.county_access_ses(vq.gravity_slice(i), i.bg, i.ses, vq.FEATURES).toPandas().dropna()
    for name, features in (("multi_ols_summary", vq.FEATURES), ("multi_ols_population", [*vq.FEATURES, "popu"])):
        x, y = data[features].to_numpy(float), data.access.to_numpy(float)
        scale = np.sqrt((x**2).sum(axis=0))
        scale[scale == 0] = 1
        coef, _, rank, _ = np.linalg.lstsq(x / scale, y, rcond=1e-7)
        coef = coef / scale
        freedom, res = len(y) - len(features), y - x @ coef
        rows = QUERIES[name](i).collect()
        assert [r.term for r in rows] == features
        np.testing.assert_allclose([r.coefficient for r in rows], coef, rtol=1e-5, atol=1e-8)
        np.testing.assert_allclose([r.r2 for r in rows], 1 - res @ res / (y @ y), atol=2e-6)
        if rank < len(features) or freedom <= 0:
            assert all(r.std_error is None and r.t is None and r.p is None for r in rows)
            continue
        se = np.sqrt(np.diag(np.linalg.inv((x / scale).T @ (x / scale))) * (res @ res) / freedom) / scale
        np.testing.assert_allclose([r.std_error for r in rows], se, rtol=1e-4, atol=1e-9)
        for r, t in zip(rows, coef / se):
            turn = lambda a: np.trapezoid(np.cos(z := np.linspace(a, np.pi / 2, 200_001)) ** (freedom - 1), z)
            assert r.t == pytest.approx(t, rel=1e-5) and r.p == pytest.approx(turn(np.arctan(abs(t) / np.sqrt(freedom))) / turn(0), abs=2e-6)


def test_correlation_and_rmse(spark):
    rng = np.random.default_rng(6)
    pdf = pd.DataFrame(rng.random((50, 2)), columns=["p", "q"]).assign(g="x")
    df = spark.createDataFrame(pdf)
    got = {(r.row_var, r.col_var): r.value for r in stats.correlation_matrix(df, ["q", "p"]).collect()}
    assert got[("p", "q")] == got[("q", "p")] == pytest.approx(pdf.p.corr(pdf.q)) and got[("p", "p")] == 1
    norm = (pdf[["p", "q"]] - pdf[["p", "q"]].min()) / (pdf[["p", "q"]].max() - pdf[["p", "q"]].min())
    want = float(((norm.p - norm.q) ** 2).mean() ** 0.5)
    assert stats.normalized_rmse(df, "p", "q", ["g"]).first().rmse == pytest.approx(want)


def test_profile(spark):
    df = spark.createDataFrame([(1, "a"), (1, None), (2, "b")], "n int, s string")
    got = {r["column"]: (r.dtype, r.rows, r.nulls, r.distinct) for r in stats.table_profile(df).collect()}
    assert got == {"n": ("int", 3, 0, 2), "s": ("string", 3, 1, 2)}


def test_columns_by_position(spark):
    df = spark.createDataFrame([("a", 1, 2.0, "b", 3)], "s string, i int, d double, t string, l long")
    assert relational.columns_from(df, 1) == ["d", "l"] and relational.columns_from(df, -1) == ["l"]
    assert relational.columns_from(df, 1, 3, numeric=False) == ["i", "d"]
