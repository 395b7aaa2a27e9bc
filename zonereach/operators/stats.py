"""Grouped statistics as algebraic aggregates."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage


def through_origin_fit(df: DataFrame, x: str, y: str, by: Sequence[str]) -> DataFrame:
    """Least squares without intercept per group: n, slope, uncentred R2 and the largest x."""
    xs, ys = F.col(x).cast("double"), F.col(y).cast("double")
    sums = (
        df.where(xs.isNotNull() & ys.isNotNull())
        .groupBy(*by)
        .agg(
            F.count("*").alias("n"),
            F.sum(xs * ys).alias("_xy"),
            F.sum(xs * xs).alias("_xx"),
            F.sum(ys * ys).alias("_yy"),
            F.max(xs).alias("x_max"),
        )
    )
    return sums.select(
        *by,
        "n",
        F.try_divide(F.col("_xy"), F.col("_xx")).alias("slope"),
        F.try_divide(F.col("_xy") * F.col("_xy"), F.col("_xx") * F.col("_yy")).alias("r2"),
        "x_max",
    )


def fitted_line(fits: DataFrame, top: Column, steps: int) -> DataFrame:
    """Points (x, y = slope x) on an even grid from 0 to ``top`` (such as the group's ``x_max``)."""
    grid = F.explode(F.sequence(F.lit(0), F.lit(steps - 1)))
    return (
        fits.withColumn("_top", top)
        .withColumn("step", grid)
        .withColumn("x", F.col("_top") * F.col("step") / (steps - 1))
        .withColumn("y", F.col("slope") * F.col("x"))
        .drop("_top")
    )


def weighted_means(df: DataFrame, values: Sequence[str], weight: str, by: Sequence[str]) -> DataFrame:
    """Sum(value x weight) / sum(weight) per group, plus the weight total."""
    w = F.col(weight).cast("double")
    return df.groupBy(*by).agg(
        F.sum(weight).alias(weight),
        *[F.try_divide(F.sum(F.col(v) * w), F.sum(w)).alias(v) for v in values],
    )


def ratio_of_sums(df: DataFrame, num: str, den: str, by: Sequence[str], name: str) -> DataFrame:
    return df.groupBy(*by).agg(
        F.sum(den).alias(den), F.try_divide(F.sum(num).cast("double"), F.sum(den).cast("double")).alias(name)
    )


def correlation_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pearson correlation of every column pair, long: row_var, col_var, value. One pass, one row of aggregates."""
    pairs = [(a, b) for a in cols for b in cols]
    wide = df.agg(
        *[F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"{a}|{b}") for a, b in pairs if a < b]
    )
    cells = []
    for a, b in pairs:
        value = F.lit(1.0) if a == b else F.col(f"`{min(a, b)}|{max(a, b)}`")
        cells.append(F.struct(F.lit(a).alias("row_var"), F.lit(b).alias("col_var"), value.alias("value")))
    return wide.select(F.explode(F.array(*cells)).alias("c")).select("c.*")


def normalized_rmse(df: DataFrame, a: str, b: str, by: Sequence[str]) -> DataFrame:
    """Root mean square difference of the min-max normalised columns per group.

    The rows pass twice, once for the ends of each group and once for the differences, so they are cut first. The
    one-pass form by sums of squares is avoided: it cancels badly where values lie far from zero.
    """
    df = cut_lineage(df)
    ends = df.groupBy(*by).agg(
        F.min(a).alias("_a0"), F.max(a).alias("_a1"), F.min(b).alias("_b0"), F.max(b).alias("_b1")
    )
    na = F.try_divide(F.col(a) - F.col("_a0"), F.col("_a1") - F.col("_a0"))
    nb = F.try_divide(F.col(b) - F.col("_b0"), F.col("_b1") - F.col("_b0"))
    return (
        df.join(ends, list(by))
        .groupBy(*by)
        .agg(F.count("*").alias("n"), F.sqrt(F.avg((na - nb) * (na - nb))).alias("rmse"))
    )


def _student_p(t: float, freedom: int) -> float:
    """Two-sided p of Student's t: the incomplete beta function by its continued fraction."""
    x, a, b = freedom / (freedom + t * t), freedom / 2, 0.5
    if x in (0.0, 1.0):
        return x
    flip = x >= (a + 1) / (a + b + 2)
    if flip:
        x, a, b = 1 - x, b, a
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)) / a
    tiny = 1e-300
    c, d = 1.0, 1 / max(1 - (a + b) * x / (a + 1), tiny)
    value = d
    for m in range(1, 300):
        for step in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d = 1 / ((1 + step * d) or tiny)
            c = (1 + step / c) or tiny
            value *= c * d
        if abs(c * d - 1) < 1e-15:
            break
    return 1 - front * value if flip else front * value


def regression_table(df: DataFrame, features: Sequence[str], target: str, intercept: bool = True) -> DataFrame:
    """Least squares, one row per coefficient: term, coefficient, std_error, t, p and the model's R2.

    One pass of the rows gives counts, means and covariances; the driver solves a system as large as the number of
    features. Without intercept the moments are taken around zero and R2 is uncentred. Collinear features or too few
    rows give coefficients (of the smallest norm) but no errors. Rows with a null are left out.
    """
    import numpy as np

    names = [*features, target]
    rows = df.select(*[F.col(c).cast("double").alias(c) for c in names]).dropna()
    pairs = [(a, b) for i, a in enumerate(names) for b in names[i:]]
    got = rows.agg(
        F.count("*").alias("n"),
        *[F.avg(c).alias(f"mean|{c}") for c in names],
        *[F.covar_pop(a, b).alias(f"{a}|{b}") for a, b in pairs],
    ).first()
    n, k = got["n"], len(features)
    schema = "term string, coefficient double, std_error double, t double, p double, r2 double"
    terms = [*features, *(["(intercept)"] if intercept else [])]
    if not n:
        return df.sparkSession.createDataFrame([(t, *[None] * 5) for t in terms], schema)
    mean = np.array([got[f"mean|{c}"] for c in names])
    moments = np.zeros((k + 1, k + 1))
    for a, b in pairs:
        i, j = names.index(a), names.index(b)
        moments[i, j] = moments[j, i] = got[f"{a}|{b}"] + (0.0 if intercept else mean[i] * mean[j])
    xx, xy, yy = moments[:k, :k], moments[:k, k], moments[k, k]
    # Features may differ by orders of magnitude; scaled ones keep the system well conditioned.
    scale = np.sqrt(np.diag(xx))
    scale[scale == 0] = 1.0
    scaled = xx / np.outer(scale, scale)
    inverse = np.linalg.pinv(scaled, hermitian=True) / np.outer(scale, scale)
    beta = inverse @ xy
    freedom = n - k - intercept
    r2 = float(beta @ xy / yy) if yy > 0 else None
    errors = np.full(len(terms), np.nan)
    if freedom > 0 and np.linalg.matrix_rank(scaled, hermitian=True) == k:
        variance = max(0.0, float(yy - beta @ xy)) * n / freedom
        errors[:k] = np.sqrt(variance * np.diag(inverse) / n)
        if intercept:
            errors[k] = np.sqrt(variance * (1 / n + mean[:k] @ inverse @ mean[:k] / n))
    coefficients = [*beta, *([mean[k] - beta @ mean[:k]] if intercept else [])]
    table = []
    for term, c, e in zip(terms, map(float, coefficients), map(float, errors)):
        known = e > 0
        t = c / e if known else None
        table.append((term, c, e if known else None, t, _student_p(t, freedom) if known else None, r2))
    return df.sparkSession.createDataFrame(table, schema)


def histogram(df: DataFrame, value: str, by: Sequence[str], lo: float, hi: float, bins: int) -> DataFrame:
    """Rows per bin and group; values outside [lo, hi) go to bins 0 and bins + 1."""
    return (
        df.where(F.col(value).isNotNull())
        .withColumn("bin", F.width_bucket(F.col(value), F.lit(float(lo)), F.lit(float(hi)), F.lit(bins)))
        .groupBy(*by, "bin")
        .agg(F.count("*").alias("n"))
    )


def table_profile(df: DataFrame) -> DataFrame:
    """column, dtype, rows, nulls, distinct values; distinct values are counted through a keyed aggregate."""
    types = dict(df.dtypes)
    cells = F.array(
        *[F.struct(F.lit(c).alias("column"), F.lit(t).alias("dtype"), F.col(f"`{c}`").cast("string").alias("v"))
          for c, t in types.items()]
    )
    per_value = (
        df.select(F.explode(cells).alias("c")).select("c.*").groupBy("column", "dtype", "v").agg(F.count("*").alias("n"))
    )
    return per_value.groupBy("column", "dtype").agg(
        F.sum("n").alias("rows"),
        F.sum(F.when(F.col("v").isNull(), F.col("n")).otherwise(0)).alias("nulls"),
        F.count("v").alias("distinct"),
    )
