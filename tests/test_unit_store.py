import pytest
from pyspark.sql import functions as F

from zonereach.sources.unit_store import UnitStore, fingerprints

UNITS = "city string, mode string, fingerprint string"


def store(spark, tmp_path):
    return UnitStore(spark, str(tmp_path / "s"), by=("city", "mode"), slices=("measure", "thresh"), sort=("kind",))


def compute(stamp, asked, empty=()):
    def run(todo):
        asked.append(sorted(tuple(r) for r in todo.collect()))
        cells = F.explode(F.array(*[F.struct(F.lit(m).alias("measure"), F.lit(t).alias("thresh"), F.lit(k).alias("kind")) for m in ("x", "y") for t in (15, 30) for k in ("a", "b")]))
        rows = todo.withColumn("_c", cells).select("city", "mode", "_c.*", F.lit(stamp).alias("v"))
        return rows.where(~F.col("city").isin(list(empty)) if empty else F.lit(True))

    return run


def content(s):
    return {(r.city, r["mode"]): (r.v, r.n) for r in s.rows().groupBy("city", "mode").agg(F.max("v").alias("v"), F.min("v").alias("w"), F.count("*").alias("n")).where("v = w").collect()}


def test_absent_and_changed_units_are_done(spark, tmp_path):
    s, asked = store(spark, tmp_path), []
    units = lambda *rows: spark.createDataFrame(rows, UNITS)
    assert s.units() is None
    with pytest.raises(ValueError):
        s.rows()
    assert s.update(units(("a", "D", "1"), ("b", "D", "1"), ("b", "D", "1")), compute(1, asked)) == 2
    assert s.update(units(("a", "D", "1"), ("b", "D", "1"), (None, "W", None)), compute(2, asked)) == 1
    # The input of b has changed.
    assert s.update(units(("a", "D", "1"), ("b", "D", "2"), (None, "W", None)), compute(3, asked)) == 1
    assert s.update(units(("a", "D", "1"), ("b", "D", "2")), compute(4, asked)) == 0
    assert asked == [[("a", "D"), ("b", "D")], [(None, "W")], [("b", "D")]]
    assert content(s) == {("a", "D"): (1, 8), ("b", "D"): (3, 8), (None, "W"): (2, 8)}
    assert {(r.city, r.rows) for r in s.units().collect()} == {("a", 8), ("b", 8), (None, 8)}
    assert s.update(units(("a", "D", "1")), compute(5, asked), overwrite=True) == 1
    assert content(s)["a", "D"] == (5, 8) and s.rows().count() == 24


def test_units_without_rows_are_done_too(spark, tmp_path):
    s, asked = store(spark, tmp_path), []
    units = spark.createDataFrame([("a", "D", "1"), ("b", "D", "1")], UNITS)
    s.update(units.where("city = 'a'"), compute(1, asked, empty=("a",)))
    assert s.rows().count() == 0 and [r.rows for r in s.units().collect()] == [0]
    s.update(units, compute(2, asked, empty=("a",)))
    assert asked == [[("a", "D")], [("b", "D")]] and content(s) == {("b", "D"): (2, 8)}


def test_a_run_that_ended_before_its_commit_is_done_again(spark, tmp_path, monkeypatch):
    s, asked = store(spark, tmp_path), []
    units = spark.createDataFrame([("a", "D", "1"), ("b", "D", "1")], UNITS)
    s.update(units.where("city = 'a'"), compute(1, asked))

    def lost(*_):
        raise RuntimeError("driver lost")

    # The rows of b and of a changed a are written, their commit is not.
    with monkeypatch.context() as m, pytest.raises(RuntimeError):
        m.setattr(UnitStore, "_commit", lost)
        s.update(units.withColumn("fingerprint", F.lit("2")), compute(2, asked))
    assert len(list((tmp_path / "s" / "data").glob("run=*"))) == 2
    again = store(spark, tmp_path)
    assert content(again) == {("a", "D"): (1, 8)}
    assert again.update(units, compute(3, asked)) == 1
    assert asked[-1] == [("b", "D")] and content(again) == {("a", "D"): (1, 8), ("b", "D"): (3, 8)}


def test_listing_reads_no_rows(spark, tmp_path):
    s, asked = store(spark, tmp_path), []
    s.update(spark.createDataFrame([("a", "D", "1"), ("b", "D", "1")], UNITS), compute(1, asked))
    plan = s.units()._jdf.queryExecution().executedPlan().toString()
    assert "/commits" in plan and "/data" not in plan
    todo = s.stale(spark.createDataFrame([("c", "D", "1")], UNITS))
    assert "/data" not in todo._jdf.queryExecution().executedPlan().toString()
    one = s.rows((F.col("measure") == "x") & (F.col("thresh") == 15) & (F.col("kind") == "a"))
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "(measure" in plan.split("PartitionFilters")[1].split("PushedFilters")[0] and "EqualTo(kind,a)" in plan
    assert one.count() == 2
    # A run whose units are all current needs no join, also beside others.
    assert "Join" not in plan


def test_fingerprints(spark):
    a = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", 1, None)], "city string, n int, s string")
    got = {r.city: (r.pairs, r.fingerprint) for r in fingerprints(a, ["city"]).collect()}
    same = fingerprints(a.orderBy(F.desc("n")).select("s", "city", "n"), ["city"]).collect()
    assert {r.city: (r.pairs, r.fingerprint) for r in same} == got and got["a"][0] == 2
    twice = {r.city: r.fingerprint for r in fingerprints(a.union(a.where("n = 2")), ["city"]).collect()}
    assert twice["a"] != got["a"][1] and twice["b"] == got["b"][1]
