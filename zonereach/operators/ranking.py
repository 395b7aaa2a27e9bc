"""Ranks, codes, quantiles and box statistics that never sort a whole group in one task.

``ordered_counts`` is the shared core: distinct values per group with the number of rows below each. Ranks,
percentile ranks and exact interpolated quantiles read off it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import LEVEL_WIDTH
from ..session import cut_lineage


def ordered_counts(df: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """Rows (by..., value, cnt, below, n): rows with the value, rows under it, rows in the group.

    Counting per distinct value first makes every hot value one row. The distinct values of all groups are then dealt
    by range over (group, value), so a group of any size lies in as many ranges as its part of the data needs; each
    task orders its own ranges and adds the counts of the group's ranges before. The ranges are fixed by writing them
    to the checkpoint folder, so a lost executor cannot shift them.
    """
    by = list(by)
    keys = by or ["_all"]
    base = df.where(F.col(value).isNotNull())
    if not by:
        base = base.withColumn("_all", F.lit(0))
    counts = base.groupBy(*keys, value).agg(F.count("*").alias("cnt"))
    ranged = cut_lineage(counts.repartitionByRange(*keys, value).withColumn("_range", F.spark_partition_id()))
    # One row per group and range it lies in; a group has at most as many as there are partitions.
    per_range = ranged.groupBy(*keys, "_range").agg(F.sum("cnt").alias("_c"))
    w = Window.partitionBy(*keys)
    offsets = per_range.select(
        *keys,
        "_range",
        (F.sum("_c").over(w.orderBy("_range").rowsBetween(Window.unboundedPreceding, 0)) - F.col("_c")).alias("_off"),
        F.sum("_c").over(w).alias("n"),
    )
    in_range = Window.partitionBy(*keys, "_range").orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    return ranged.join(offsets, [*keys, "_range"]).select(
        *by,
        value,
        "cnt",
        (F.sum("cnt").over(in_range) - F.col("cnt") + F.col("_off")).alias("below"),
        "n",
    )


def average_rank(oc: DataFrame, ascending: bool = True) -> Column:
    """Average rank of tied rows, 1-based, from ``ordered_counts`` columns."""
    if ascending:
        return F.col("below") + (F.col("cnt") + 1) / 2
    return F.col("n") - F.col("below") - F.col("cnt") + (F.col("cnt") + 1) / 2


def with_average_rank(
    df: DataFrame, value: str, by: Sequence[str] = (), ascending: bool = True, name: str = "rank", pct: bool = False
) -> DataFrame:
    """Attach the average rank (or, with ``pct``, average rank / rows x 100) of ``value``; NULL stays NULL."""
    df = cut_lineage(df)  # passes twice: for the counts and for the rows
    oc = ordered_counts(df, value, by)
    rank = average_rank(oc, ascending)
    rank = rank / F.col("n") * 100 if pct else rank
    ranks = oc.select(*by, value, rank.alias(name))
    return df.join(ranks, [*by, value], "left").select(*df.columns, name)


def quantiles(
    df: DataFrame, value: str, by: Sequence[str], probs: dict[str, float], oc: DataFrame | None = None
) -> DataFrame:
    """Exact linearly interpolated quantiles per group: by..., n and one column per named probability."""
    oc = ordered_counts(df, value, by) if oc is None else oc
    n, below, cnt = F.col("n"), F.col("below"), F.col("cnt")
    aggs = []
    for name, q in probs.items():
        pos = (n - 1) * q
        for tag, at in (("lo", F.floor(pos)), ("hi", F.ceil(pos))):
            hit = (below <= at) & (at < below + cnt)
            aggs.append(F.max(F.when(hit, F.col(value))).alias(f"_{name}_{tag}"))
    out = oc.groupBy(*by).agg(F.max("n").alias("n"), *aggs)
    cols = []
    for name, q in probs.items():
        frac = (n - 1) * q - F.floor((n - 1) * q)
        lo, hi = F.col(f"_{name}_lo"), F.col(f"_{name}_hi")
        cols.append((lo + (hi - lo) * frac).alias(name))
    return out.select(*by, "n", *cols)


def box_stats(df: DataFrame, value: str, by: Sequence[str], mean: bool = False) -> DataFrame:
    """q1, median, q3, whisker ends inside 1.5 IQR and outlier count per group (plus ``mean``)."""
    oc = ordered_counts(df, value, by)
    q = quantiles(df, value, by, {"q1": 0.25, "median": 0.5, "q3": 0.75}, oc=oc)
    v, cnt = F.col(value), F.col("cnt")
    spread = 1.5 * (F.col("q3") - F.col("q1"))
    inside = v.between(F.col("q1") - spread, F.col("q3") + spread)
    aggs = [
        F.min(F.when(inside, v)).alias("whisker_lo"),
        F.max(F.when(inside, v)).alias("whisker_hi"),
        F.sum(F.when(~inside, cnt).otherwise(0)).cast("long").alias("outliers"),
    ]
    if mean:
        aggs.append((F.sum(v * cnt) / F.sum(cnt)).alias("mean"))
    joined = oc.drop("n").join(q, list(by))
    return joined.groupBy(*by, "n", "q1", "median", "q3").agg(*aggs)


def id_positions(ids: DataFrame, by: Sequence[str], key: str = "geoid", name: str = "idx") -> DataFrame:
    """0-based position of each distinct id in the sorted ids of its group.

    Ids are prefix codes of fixed width, so the position is a sum of three offsets: counties before, tracts
    before inside the county, ids before inside the tract. The windows see at most the codes of one level:
    10^5 counties per group, 10^6 tracts per county, 10^4 blocks per tract.
    """
    by = list(by)
    cw, tw = LEVEL_WIDTH["County"], LEVEL_WIDTH["Tract"]
    ids = ids.select(*by, key).distinct().withColumns(
        {"_c": F.substring(key, 1, cw), "_t": F.substring(key, 1, tw)}
    )
    tracts = ids.groupBy(*by, "_c", "_t").agg(F.count("*").alias("_nt"))
    counties = tracts.groupBy(*by, "_c").agg(F.sum("_nt").alias("_nc"))

    def before(col: str, parts: list[str], order: str) -> Column:
        w = Window.partitionBy(*parts).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
        return F.sum(col).over(w) - F.col(col)

    offsets = (
        tracts.join(counties.withColumn("_oc", before("_nc", by, "_c")), [*by, "_c"])
        .withColumn("_ot", before("_nt", [*by, "_c"], "_t"))
        .select(*by, "_c", "_t", (F.col("_oc") + F.col("_ot")).alias("_off"))
    )
    within = F.row_number().over(Window.partitionBy(*by, "_c", "_t").orderBy(key)) - 1
    return ids.join(offsets, [*by, "_c", "_t"]).select(
        *by, key, (F.col("_off") + within).cast("long").alias(name)
    )


def positional_rank(df: DataFrame, order: Sequence[Column], name: str = "rank") -> DataFrame:
    """1..n by ``order``. For tables with one row per city: urban-area codes have five digits, so n <= 10^5."""
    return df.withColumn(name, F.row_number().over(Window.orderBy(*order)))


def batches(df: DataFrame, order: Sequence[Column], k: int, name: str = "batch") -> DataFrame:
    """Split a ranked city list into k consecutive batches (same bound as ``positional_rank``)."""
    return df.withColumn(name, F.ntile(k).over(Window.orderBy(*order)))


def factor_codes(df: DataFrame, value: str, order: str, name: str = "code") -> DataFrame:
    """Ordinal of every distinct value by first appearance in ``order``: value, first, code.

    The distinct values of a factor are its labels; ranking them goes through ``ordered_counts`` so that even
    a long label list is not sorted in one task.
    """
    first = df.where(F.col(value).isNotNull()).groupBy(value).agg(F.min(order).alias("first"))
    oc = ordered_counts(first, "first")
    return first.join(oc, "first").select(value, "first", F.col("below").cast("long").alias(name))
