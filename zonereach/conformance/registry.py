"""Registry of checked queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import configure, without_old_shuffles
from ..sources.fixtures import Inputs
from .oracle_views import with_views

Query = Callable[[Inputs], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None, views: dict[str, str] | None = None):
    """Register a query over the derived inputs and the SQL it must agree with."""

    def add(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name!r} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = with_views(sql, views)
        return fn

    return add


def bind(fn: Query) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(Inputs(without_old_shuffles(configure(spark)), sf_dir))

    return run


def rounded(df: DataFrame, digits: int = 6, **per_column: int) -> DataFrame:
    """Round the floating-point columns, the form in which results are compared."""
    cols = {
        c: F.round(F.col(f"`{c}`"), per_column.get(c, digits)) for c, t in df.dtypes if t in ("double", "float")
    }
    return df.withColumns(cols)


def access_rounded() -> Column:
    """Access to 6 digits for the ratio measures, 4 for counts and weighted counts."""
    return F.when(F.col("measure").isin("Contour", "Gravity"), F.round("access", 4)).otherwise(F.round("access", 6))


ACCESS_SQL = "case when measure in ('Contour','Gravity') then round(access,4) else round(access,6) end as access"
