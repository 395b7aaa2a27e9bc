"""Access measures: contour, gravity, E2SFCA, M2SFCA (and the cross-modal variant) for all zones at once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.impedance import with_weights

THRESHOLDS = (15, 30, 45, 60, 90)
MEASURES = ("Contour", "Gravity", "E2SFCA", "M2SFCA")
UNIT = ("city", "mode", "level")


def _sum_within(t: int, value: str, name: str, agg: str = "sum") -> Column:
    return F.expr(f"{agg}(if(time_min <= {t}, {value}, null)) as {name}")


# Travel-time pairs of one unit that one task should hold.
BLOCK_PAIRS = 2_000_000


def dealt_by(by: Sequence[str] = UNIT) -> list[str]:
    """How ``spread_pairs`` deals out its rows."""
    return [*[c for c in by if c != "level"], "block"]


def spread_pairs(
    od: DataFrame, params: DataFrame | None = None, block_pairs: int = BLOCK_PAIRS, by: Sequence[str] = UNIT
) -> DataFrame:
    """Weighted pairs, dealt out by (city, mode, level, block of targets), or by the columns of ``by`` and the block.

    A unit's targets are cut into as many blocks as its pairs need, so a task holds many targets of one unit: sums
    by destination need no further shuffle, and sums by source combine many targets before they are shuffled. The
    weights are computed where the pairs then lie, so they are not shuffled. The list of units that is broadcast has a
    row per city, mode and level: at most 100,000 five-digit cities times four modes times three levels.
    """
    units = od.groupBy(*by).agg(F.ceil(F.count("*") / block_pairs).alias("_blocks"))
    dealt = (
        od.join(F.broadcast(units), list(by))
        # The level is in the block and not dealt by itself: as a constant it would be no key of the joins by unit and block.
        .withColumn("block", F.xxhash64("level", F.pmod(F.xxhash64("trg"), F.col("_blocks"))))
        .select(*UNIT, "block", "src", "trg", "time_min")
        .repartition(*dealt_by(by))
    )
    return with_weights(dealt, params).select(*UNIT, "block", "src", "trg", "time_min", "w_work", "w_non")


def demand_potential(
    od: DataFrame,
    zones: DataFrame,
    thresholds: Sequence[int] = THRESHOLDS,
    demand: str = "destination",
    params: DataFrame | None = None,
) -> DataFrame:
    """Weighted demand around every destination, one row per (city, mode, level, trg).

    Columns ``work_T`` and ``non_T``: demand from labor and from population within T minutes. With
    ``demand='destination'`` the destination's own size scales the sum of weights, so the sum needs no join;
    with ``'origin'`` every origin brings its own size. Modes without weights have no demand (NULL).
    """
    return _demand(spread_pairs(od, params), zones, thresholds, demand).drop("block")


def _demand(pairs: DataFrame, zones: DataFrame, thresholds: Sequence[int], demand: str) -> DataFrame:
    if demand not in ("destination", "origin"):
        raise ValueError(f"demand must be 'destination' or 'origin', not {demand!r}")
    size = zones.select("geoid", "popu", "labor")
    if demand == "origin":
        pairs = pairs.join(size.withColumnRenamed("geoid", "src"), "src")
        work, non = "w_work * labor", "w_non * popu"
    else:
        work, non = "w_work", "w_non"
    sums = [_sum_within(t, v, f"{tag}_{t}") for tag, v in (("work", work), ("non", non)) for t in thresholds]
    out = pairs.groupBy(*UNIT, "block", "trg").agg(*sums)
    if demand == "origin":
        return out
    out = out.join(size.withColumnRenamed("geoid", "trg"), "trg")
    return _scaled(out, thresholds)


def _scaled(sums: DataFrame, thresholds: Sequence[int]) -> DataFrame:
    """Weight sums times the destination's labor (work) and population (other purposes)."""
    done = [f"{tag}_{t} * {size} as {tag}_{t}" for tag, size in (("work", "labor"), ("non", "popu")) for t in thresholds]
    replaced = {f"{tag}_{t}" for tag in ("work", "non") for t in thresholds}
    return sums.selectExpr(*[c for c in sums.columns if c not in replaced | {"popu", "labor"}], *done)


def _supply(demand: DataFrame, opport: DataFrame, thresholds: Sequence[int]) -> DataFrame:
    """One row per destination with ``kinds``, an array over the kinds it has: opportunities ``o`` and, per threshold,
    ``r_T`` = o / demand.

    ``r_T`` is NULL where either purpose has no demand within T.
    """
    side = opport.where("opport > 0").groupBy(F.col("geoid").alias("trg"), "level").agg(
        F.collect_list(F.struct("kind", F.col("opport").cast("double").alias("o"), F.col("kind").startswith("Jobs").alias("for_work"))).alias("_side")
    )
    ratios = ", ".join(
        f"if(work_{t} > 0 and non_{t} > 0, x.o / if(x.for_work, work_{t}, non_{t}), null) as r_{t}" for t in thresholds
    )
    unit = [c for c in (*UNIT, "block") if c in demand.columns]
    return demand.join(side, ["trg", "level"]).selectExpr(
        *unit, "trg", f"transform(_side, x -> struct(x.kind as kind, x.o as o, x.for_work as for_work, {ratios})) as kinds"
    )


def _access_rows(
    pairs: DataFrame, opport: DataFrame, demand: DataFrame, thresholds: Sequence[int], keep_zero_demand: bool, place: Sequence
) -> DataFrame:
    """One row per (city, mode, level, geoid, kind) with a column per measure and threshold.

    A pair meets one supply row; the kinds are taken apart after that join and summed in the same task. A mode without
    weights has a contour only. ``place`` is how the pairs are dealt out, as ``repartition`` takes it.
    """
    supply = _supply(demand, opport, thresholds).repartition(*place)  # to where the pairs lie, not the pairs to it
    on = [c for c in (*UNIT, "block", "trg") if c in supply.columns]
    joined = pairs.join(supply, on).selectExpr(*UNIT, "src as geoid", "time_min", "w_work", "w_non", "inline(kinds)")
    joined = joined.withColumn("w", F.expr("if(for_work, w_work, w_non)"))
    sums = []
    for t in thresholds:
        reach = "o" if keep_zero_demand else f"if(r_{t} is not null or w is null, o, null)"
        sums += [
            _sum_within(t, reach, f"Contour_{t}"),
            _sum_within(t, f"{reach} * w", f"Gravity_{t}"),
            _sum_within(t, f"r_{t}", f"E2SFCA_{t}"),
            _sum_within(t, f"r_{t} * w", f"M2SFCA_{t}"),
        ]
    return joined.groupBy(*UNIT, "geoid", "kind").agg(*sums)


def to_long(
    wide: DataFrame, thresholds: Sequence[int] = THRESHOLDS, measures: Sequence[str] = MEASURES
) -> DataFrame:
    """measure, thresh and access rows; only positive access is kept."""
    keys = [*UNIT, "geoid", "kind"]
    cells = ", ".join(f"'{m}', {t}, {m}_{t}" for m in measures for t in thresholds)
    return (
        wide.selectExpr(*keys, f"stack({len(measures) * len(thresholds)}, {cells}) as (measure, thresh, access)")
        .select("measure", "kind", "mode", "thresh", "level", "city", "geoid", "access")
        .where("access > 0")
    )


def access(
    od: DataFrame,
    opport: DataFrame,
    zones: DataFrame,
    thresholds: Sequence[int] = THRESHOLDS,
    demand: str = "destination",
    keep_zero_demand: bool = False,
    params: DataFrame | None = None,
    wide: bool = False,
    measures: Sequence[str] = MEASURES,
) -> DataFrame:
    """Access of every zone for all modes, levels, kinds, thresholds and measures in one plan.

    ``od``: city, mode, level, src, trg, time_min. ``opport``: geoid, level, kind, opport. ``zones``: geoid,
    popu, labor. The pairs are shuffled once, by unit and block of targets (``spread_pairs``); the demand is summed
    where they lie, and the destinations' supply comes to them as one row per destination. Every threshold is a
    conditional sum in the same pass. With ``wide`` the rows keep a column per measure and threshold.
    """
    od = od.where(F.col("time_min") <= max(thresholds))
    pairs = spread_pairs(od, params)
    return placed_access(pairs, dealt_by(), opport, zones, thresholds, demand, keep_zero_demand, wide, measures)


def placed_access(
    pairs: DataFrame,
    place: Sequence,
    opport: DataFrame,
    zones: DataFrame,
    thresholds: Sequence[int] = THRESHOLDS,
    demand: str = "destination",
    keep_zero_demand: bool = False,
    wide: bool = False,
    measures: Sequence[str] = MEASURES,
) -> DataFrame:
    """``access`` over weighted pairs that are dealt out by ``place`` (columns, before them maybe a number), which keeps
    the pairs of a destination together."""
    rows = _access_rows(pairs, opport, _demand(pairs, zones, thresholds, demand), thresholds, keep_zero_demand, place)
    return rows if wide else to_long(rows, thresholds, measures)


def cross_modal_access(
    od: DataFrame, opport: DataFrame, zones: DataFrame, thresholds: Sequence[int] = THRESHOLDS,
    params: DataFrame | None = None,
) -> DataFrame:
    """Floating catchment whose demand takes, per origin, the largest weight over all modes within T.

    The pairs of all modes are dealt out once by (city, level, block of targets).
    """
    od = od.where(F.col("time_min") <= max(thresholds))
    pairs = spread_pairs(od, params, by=("city", "level"))
    return placed_cross_modal(pairs, dealt_by(("city", "level")), opport, zones, thresholds)


def placed_cross_modal(
    pairs: DataFrame, place: Sequence, opport: DataFrame, zones: DataFrame, thresholds: Sequence[int] = THRESHOLDS
) -> DataFrame:
    """``cross_modal_access`` over weighted pairs dealt out by ``place``, which keeps all modes of a destination together."""
    names = [f"{tag}_{t}" for tag in ("work", "non") for t in thresholds]
    best = pairs.groupBy("city", "level", "block", "src", "trg").agg(
        *[_sum_within(t, f"w_{tag}", f"{tag}_{t}", "max") for tag in ("work", "non") for t in thresholds]
    )
    total = best.groupBy("city", "level", "block", "trg").agg(*[F.expr(f"sum({c}) as {c}") for c in names])
    size = zones.select(F.col("geoid").alias("trg"), "popu", "labor")
    demand = _scaled(total.join(size, "trg"), thresholds)
    return to_long(_access_rows(pairs, opport, demand, thresholds, False, place), thresholds, ("M2SFCA",)).withColumn(
        "measure", F.lit("XMFCA")
    )


def contour_jobs(od: DataFrame, jobs: DataFrame, thresholds: Sequence[int] = THRESHOLDS) -> DataFrame:
    """Jobs within each threshold from whole-minute travel times of another router.

    ``od``: city, mode, src, trg, time_min; ``jobs``: geoid, njobs.
    """
    joined = od.where(F.col("time_min") <= max(thresholds)).join(jobs.withColumnRenamed("geoid", "trg"), "trg")
    return contour_sums(joined, thresholds)


def contour_sums(joined: DataFrame, thresholds: Sequence[int]) -> DataFrame:
    """Pairs with the jobs of their destination (``njobs``) to the jobs of each origin and threshold."""
    wide = joined.groupBy("city", "mode", F.col("src").alias("geoid")).agg(
        *[_sum_within(t, "njobs", f"c_{t}") for t in thresholds]
    )
    cells = ", ".join(f"{t}, c_{t}" for t in thresholds)
    return wide.selectExpr(
        "city", "mode", "geoid", f"stack({len(thresholds)}, {cells}) as (thresh, own)"
    ).where("own is not null")


def catchment_sets(od: DataFrame, minutes: int) -> DataFrame:
    """Origins that reach each destination within ``minutes``: city, mode, level, trg, src."""
    return od.where(F.col("time_min") <= minutes).select(*UNIT, "trg", "src").distinct()
