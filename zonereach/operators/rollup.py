"""Hierarchy operators: prefix rollups, majority assignment, dissolve of attributes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import LEVEL_WIDTH


def level_rows(df: DataFrame, levels: Sequence[str], key: str = "geoid") -> DataFrame:
    """Repeat every row once per level with its id cut to that level's width."""
    widths = F.array(
        *[F.struct(F.lit(lv).alias("level"), F.lit(LEVEL_WIDTH[lv]).alias("width")) for lv in levels]
    )
    rest = [c for c in df.columns if c not in (key, "level")]
    return df.withColumn("_lv", F.explode(widths)).select(
        F.expr(f"substring({key}, 1, _lv.width)").alias(key), F.col("_lv.level").alias("level"), *rest
    )


def prefix_rollup(
    df: DataFrame, sums: Sequence[str], levels: Sequence[str], by: Sequence[str] = (), key: str = "geoid"
) -> DataFrame:
    """Sums at every level of the id hierarchy in one grouped pass."""
    return (
        level_rows(df, levels, key).groupBy(key, "level", *by).agg(*[F.sum(c).cast("long").alias(c) for c in sums])
    )


def majority(df: DataFrame, keys: Sequence[str], choice: Sequence[str], count: str = "n") -> DataFrame:
    """Per key the choice with the most rows; ties go to the smallest choice.

    Two map-side-combined aggregates: counts per (key, choice), then the best count. Negated counts make the
    smallest struct the winner, so no window has to sort a key's rows.
    """
    counted = df.groupBy(*keys, *choice).agg(F.count("*").alias(count))
    best = F.min(F.struct((-F.col(count)).alias("neg"), *choice)).alias("_best")
    return (
        counted.groupBy(*keys)
        .agg(best)
        .select(*keys, *[F.col(f"_best.{c}").alias(c) for c in choice], (-F.col("_best.neg")).alias(count))
    )


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Keep one whole row per key: the smallest by ``order``, further columns breaking ties."""
    rest = [c for c in df.columns if c not in keys and c not in order]
    row = F.min(F.struct(*order, *rest)).alias("_row")
    return df.groupBy(*keys).agg(row).select(*keys, "_row.*").select(*df.columns)
