"""Helpers of the operators: running positions, connected components, names."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import Scratch

# A word: anything between blanks, as Java, RE2 and Python read it alike.
WORD = r"[^\x20\x09-\x0D]+"


def running(
    scratch: Scratch, df: DataFrame, within: list[str], by: list[str], amount: Column | None = None, name: str = "position"
) -> DataFrame:
    """Add ``name``: the sum of ``amount`` (default 1) over the rows before, in the order of ``by`` inside ``within``.

    Rows are dealt by range, so a group of any size spreads over tasks; each range sums its own rows and adds the
    totals of the ranges before, of which there are as many as partitions.
    """
    amount = F.lit(1).cast("long") if amount is None else amount.cast("long")
    dealt = (
        df.withColumn("_amount", amount)
        .repartitionByRange(*[F.col(c).asc_nulls_last() for c in [*within, *by]])
        .sortWithinPartitions(*[F.col(c).asc_nulls_last() for c in [*within, *by]])
        .withColumn("_range", F.spark_partition_id())
        .withColumn("_row", F.monotonically_increasing_id())
    )
    t = scratch.table(dealt, "ranges")
    keys = [*within, "_range"]
    totals = t.groupBy(*keys).agg(F.sum("_amount").alias("_total"))
    before = Window.partitionBy(*within).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(
        *[F.col(c).alias(f"_k_{c}") for c in keys], F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_before")
    )
    here = Window.partitionBy(*keys).orderBy("_row").rowsBetween(Window.unboundedPreceding, -1)
    local = t.withColumn("_local", F.coalesce(F.sum("_amount").over(here), F.lit(0)))
    same = None
    for c in keys:
        one = F.col(c).eqNullSafe(F.col(f"_k_{c}"))
        same = one if same is None else same & one
    return (
        local.join(starts, same)
        .withColumn(name, F.col("_before") + F.col("_local"))
        .select(*df.columns, name)
    )


def components(scratch: Scratch, edges: DataFrame) -> DataFrame:
    """Smallest node reachable from each node that has an edge: (node, root). ``edges`` has a and b, both long.

    Large-star and small-star steps alternate until nothing changes; every step is a grouped minimum and a join on a
    node, and the links stay in tables of the shared folder. Rows never exceed the number of edges plus nodes.
    """
    cur = scratch.table(
        edges.where(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        "edges",
    )

    def mark(t: DataFrame) -> tuple:
        return tuple(t.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    seen = mark(cur)
    while seen[0]:
        both = cur.union(cur.select("b", "a"))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select(
            F.col("a").alias("n"), F.least("a", "m").alias("m")
        )
        # Large star: each neighbour above a node moves to the node's smallest neighbour.
        large = cur.join(low, cur.b == low.n).select("a", F.col("m").alias("b")).distinct()
        # Small star: each neighbour below a node, and the node, move to its smallest neighbour.
        small = large.groupBy("a").agg(F.min("b").alias("m"), F.max("b").alias("x"))
        centre = small.select(F.col("a").alias("n"), "m", "x")
        moved = large.join(centre.where(F.col("m") < F.col("x")), F.col("a") == F.col("n")).select(
            F.col("b").alias("a"), F.col("m").alias("b")
        )
        nxt = scratch.table(
            moved.where(F.col("a") != F.col("b")).union(small.select("a", F.col("m").alias("b"))).distinct(), "edges"
        )
        now = mark(nxt)
        scratch.drop(cur)
        cur = nxt
        if now == seen:
            break
        seen = now
    roots = cur.select("b").distinct()
    return cur.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        roots.select(F.col("b").alias("node"), F.col("b").alias("root"))
    )


def least_by_hash(df: DataFrame, key: str, rows: int) -> DataFrame:
    """At most ``rows`` rows of ``df``, those with the smallest hashes of ``key``. A threshold from the number of rows
    leaves little more than these to be put in order, however many partitions there are."""
    n = df.count()
    h = F.xxhash64(key)
    if n > 2 * rows:
        share = (rows + 6 * math.sqrt(rows) + 16) / n
        df = df.where(h < F.lit(int(-(1 << 63) + share * (1 << 64))))
    return df.orderBy(h, key).limit(rows)


def unused(df: DataFrame, name: str) -> str:
    """``name``, or one like it that no column of ``df`` has."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
