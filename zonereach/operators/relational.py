"""Small relational helpers: keyword filter, natural joins, null-safe exclusions, fills and reshapes."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import Scratch


def keyword_filter(df: DataFrame, **equal) -> DataFrame:
    """Rows where every named column equals its value; the named columns are dropped."""
    cond = reduce(lambda a, b: a & b, [F.col(k) == v for k, v in equal.items()], F.lit(True))
    return df.where(cond).drop(*equal)


def not_in(c: Column, values: Sequence) -> Column:
    """``NOT IN`` that keeps NULL."""
    return c.isNull() | ~c.isin(list(values))


def finite(c: Column) -> Column:
    return c.isNotNull() & ~F.isnan(c) & (F.abs(c) != math.inf)


def natural_join(a: DataFrame, b: DataFrame, how: str = "inner") -> DataFrame:
    shared = [c for c in a.columns if c in b.columns]
    if not shared:
        raise ValueError("no shared columns to join on")
    return a.join(b, shared, how)


def zero_filled_left_join(a: DataFrame, b: DataFrame, on: Sequence[str]) -> DataFrame:
    new = [c for c in b.columns if c not in on]
    return a.join(b, list(on), "left").fillna(0, subset=new)


def zero_filled_outer_join(a: DataFrame, b: DataFrame, on: Sequence[str]) -> DataFrame:
    new = [c for c in [*a.columns, *b.columns] if c not in on]
    return a.join(b, list(on), "full").fillna(0, subset=new)


def nonzero_rows(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.where(reduce(lambda a, b: a & b, [F.col(c) != 0 for c in cols]))


def numeric_columns(df: DataFrame) -> list[str]:
    kinds = ("tinyint", "smallint", "int", "bigint", "float", "double")
    return [c for c, t in df.dtypes if t in kinds or t.startswith("decimal")]


def columns_from(df: DataFrame, start: int, stop: int | None = None, numeric: bool = True) -> list[str]:
    """Columns by position, counted among the numeric ones (or all): ``columns_from(df, 3)`` is all but the first three."""
    return (numeric_columns(df) if numeric else df.columns)[start:stop]


def lower_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lower() for c in df.columns])


def strip_name_prefix(df: DataFrame, prefix: str) -> DataFrame:
    return df.toDF(*[c.removeprefix(prefix) for c in df.columns])


def cast_table(df: DataFrame, types: dict[str, str]) -> DataFrame:
    return df.withColumns({c: F.col(c).cast(t) for c, t in types.items()}).select(*types)


def code_labels(c: Column, labels: dict) -> Column:
    """Label of a code from a literal dictionary; unknown codes give NULL."""
    return F.create_map(*[F.lit(x) for kv in labels.items() for x in kv])[c]


def one_hot(df: DataFrame, col: str, values: Sequence[str]) -> DataFrame:
    return df.withColumns({v: F.coalesce(F.col(col) == v, F.lit(False)) for v in values})


def minmax_normalize(
    df: DataFrame, value: str, by: Sequence[str] = (), vmin: float | None = None, vmax: float | None = None,
    name: str = "norm",
) -> DataFrame:
    """(x - min) / (max - min) per group; explicit bounds (also 0) win, a constant group gives NULL."""
    v = F.col(value)
    if not by:
        ends = df.agg(F.min(v).alias("_lo"), F.max(v).alias("_hi"))
        out = df.join(F.broadcast(ends))  # a single row
    else:
        ends = df.groupBy(*by).agg(F.min(v).alias("_lo"), F.max(v).alias("_hi"))
        out = df.join(ends, list(by))
    lo = F.col("_lo") if vmin is None else F.lit(float(vmin))
    hi = F.col("_hi") if vmax is None else F.lit(float(vmax))
    return out.withColumn(name, F.try_divide((v - lo).cast("double"), (hi - lo).cast("double"))).drop("_lo", "_hi")


def _sample_hash(keys: Sequence[str], seed: int) -> Column:
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *keys))


# The first digits of the hash as a number below 1.
SAMPLE_DIGITS = 12


def sample_candidates(df: DataFrame, keys: Sequence[str], seed: int, n: int, by: Sequence[str] = ()) -> DataFrame:
    """Rows that hold the n smallest hashes of each group (all rows of a smaller one) and few more, with ``_hash``.

    The number of rows of a group gives a threshold on the hash below which n rows and some to spare are expected. Where
    fewer lie below it, that group's threshold is raised until enough do, so the result never depends on luck.
    """
    by, scratch = list(by), Scratch(df.sparkSession, "sample")
    part = F.conv(F.substring("_hash", 1, SAMPLE_DIGITS), 16, 10).cast("double") / float(16**SAMPLE_DIGITS)
    hashed = df.withColumn("_hash", _sample_hash(keys, seed))
    sizes = (df.groupBy(*by) if by else df).agg(F.count("*").alias("_size"))
    wanted = n + 6 * math.sqrt(n) + 16
    limits = scratch.table(sizes.withColumn("_limit", wanted / F.col("_size")).where("_size > 0"), "limits")

    while True:
        found = scratch.table(_with_limit(hashed, limits, by).where(part < F.col("_limit")).drop("_limit"), "candidates")
        have = _with_limit(limits, (found.groupBy(*by) if by else found).agg(F.count("*").alias("_have")), by)
        enough = F.col("_have") >= F.least(F.lit(n), F.col("_size"))
        short = limits.count() - have.where(enough).count()
        if not short:
            return found.drop("_size")
        # Groups with nothing below their threshold are not in ``have``; raising all of them is as right.
        limits = scratch.table(limits.withColumn("_limit", F.col("_limit") * 4), "limits")


def _with_limit(rows: DataFrame, table: DataFrame, by: Sequence[str]) -> DataFrame:
    table = table.withColumnsRenamed({c: f"_of_{c}" for c in by})
    same = [rows[c].eqNullSafe(table[f"_of_{c}"]) for c in by]
    # Without groups the table is a single row.
    return (rows.join(table, same) if by else rows.join(F.broadcast(table))).drop(*[f"_of_{c}" for c in by])


def joined_head(
    join: Callable[[Callable[[DataFrame], DataFrame]], DataFrame], sizes: DataFrame, keys: Sequence[str], seed: int, n: int,
    by: Sequence[str] = (),
) -> DataFrame:
    """``shuffled_head`` of a join on ``keys`` (and maybe more columns), without joining all of it.

    ``join`` makes it and applies what it is given to each side first. A row has the hash of its keys on either side, so rows
    above the threshold leave before the join, and both sides shuffle little more than the sample. ``sizes`` (by...,
    ``_size``) are the rows of the groups on one side. Where fewer than n rows come out for a group, its threshold is raised
    until enough do or the whole group was joined, so the result is that of the whole join.
    """
    by = list(by)
    scratch = Scratch(sizes.sparkSession, "sample")
    part = F.conv(F.substring(_sample_hash(keys, seed), 1, SAMPLE_DIGITS), 16, 10).cast("double") / float(16**SAMPLE_DIGITS)
    wanted = n + 6 * math.sqrt(n) + 16
    limits = scratch.table(sizes.where("_size > 0").select(*by, (wanted / F.col("_size")).alias("_limit")), "limits")
    while True:
        only = lambda side: _with_limit(side, limits, by).where(part < F.col("_limit")).drop("_limit")  # noqa: E731, B023
        found = scratch.table(join(only), "candidates")
        have = (found.groupBy(*by) if by else found).agg(F.count("*").alias("_have")).withColumnsRenamed({c: f"_of_{c}" for c in by})
        same = [limits[c].eqNullSafe(have[f"_of_{c}"]) for c in by]
        told = limits.join(have, same, "left") if by else limits.join(F.broadcast(have))
        short = (F.coalesce("_have", F.lit(0)) < n) & (F.col("_limit") < 1)
        if told.where(short).isEmpty():
            return _first_by_hash(found.withColumn("_hash", _sample_hash(keys, seed)), keys, n, by).select(*found.columns)
        limits = scratch.table(told.select(*by, F.when(short, F.col("_limit") * 4).otherwise(F.col("_limit")).alias("_limit")), "limits")


def _first_by_hash(found: DataFrame, keys: Sequence[str], n: int, by: Sequence[str]) -> DataFrame:
    if not by:
        return found.orderBy("_hash", *keys).limit(n)
    order = Window.partitionBy(*by).orderBy("_hash", *keys)
    return found.withColumn("_place", F.row_number().over(order)).where(F.col("_place") <= n)


def shuffled_head(df: DataFrame, keys: Sequence[str], seed: int, n: int, by: Sequence[str] = ()) -> DataFrame:
    """Repeatable sample of n rows, of each group of ``by`` if given: the n smallest seeded MD5 sums of the keys, the same
    in every engine. Only rows near a threshold, a little over n of a group, come together to be put in order."""
    return _first_by_hash(sample_candidates(df, keys, seed, n, by), keys, n, by).select(*df.columns)


def triangle_merge(upper: DataFrame, lower: DataFrame, names: Sequence[str]) -> DataFrame:
    """Long matrix (row_var, col_var, value): above the diagonal from ``upper``, below from ``lower``.

    The matrix has one row per pair of columns of a table, so it is as small as the schema.
    """
    order = {n: i for i, n in enumerate(names)}
    i, j = code_labels(F.col("row_var"), order), code_labels(F.col("col_var"), order)
    a = upper.where(i < j).select("row_var", "col_var", "value")
    b = lower.where(i > j).select("row_var", "col_var", "value")
    diagonal = upper.where(i == j).select("row_var", "col_var", F.lit(None).cast("double").alias("value"))
    return a.unionByName(b).unionByName(diagonal)
