"""Transit feeds that serve each city."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.relational import not_in
from ..operators.spatial import boxes_overlap

MAX_EXTENT = 3.0


def usable_feeds(catalog: DataFrame) -> DataFrame:
    """Active US zip feeds with a bounding box of at most three degrees each way."""
    return (
        catalog.where(F.col("country_code") == "US")
        .where(F.col("url").endswith(".zip"))
        .where(not_in(F.col("status"), ["inactive", "deprecated"]))
        .dropna(subset=["minx", "miny", "maxx", "maxy"])
        .where(F.col("maxx") - F.col("minx") <= MAX_EXTENT)
        .where(F.col("maxy") - F.col("miny") <= MAX_EXTENT)
        .select("mdb_id", "url", "minx", "miny", "maxx", "maxy")
    )


def city_feeds(catalog: DataFrame, extents: DataFrame, cell: float = 1.0) -> DataFrame:
    """One row per feed with the sorted list of the cities whose extent boxes it touches.

    ``extents``: city and box (minx, miny, maxx, maxy), several boxes per city allowed. A feed's list is at most
    the list of all cities (five-digit codes).
    """
    hits = boxes_overlap(usable_feeds(catalog), extents.select("city", "minx", "miny", "maxx", "maxy"), cell)
    return (
        hits.select("mdb_id", "url", "minx", "miny", "maxx", "maxy", "city")
        .distinct()
        .groupBy("mdb_id", "url", "minx", "miny", "maxx", "maxy")
        .agg(F.sort_array(F.collect_list("city")).alias("city"))
    )
