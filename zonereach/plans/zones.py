"""Zone hierarchy products: states, population, urban areas, largest cities, zones, centroids, regions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geo, text, units
from ..operators import ranking, relational, rollup

# Census region and division labels.
REGIONS = {1: "Northeast", 2: "Midwest", 3: "South", 4: "West"}
DIVISIONS = {
    1: "1. New England",
    2: "2. Middle Atlantic",
    3: "3. East North Central",
    4: "4. West North Central",
    5: "5. South Atlantic",
    6: "6. East South Central",
    7: "7. West South Central",
    8: "8. Mountain",
    9: "9. Pacific",
}
EXCLUDED_STATES = ("Alaska", "Hawaii")
ZONE_LEVELS = ("County", "Tract", "BG")


def states(raw: DataFrame, abbreviations: DataFrame, excluded=EXCLUDED_STATES) -> DataFrame:
    """``raw``: geoid, name, region, division (codes), ...; ``abbreviations``: name, code."""
    rest = [c for c in raw.columns if c not in ("geoid", "name", "region", "division")]
    return (
        raw.join(abbreviations.select("name", "code"), "name")
        .where(relational.not_in(F.col("name"), excluded))
        .select(
            "geoid",
            "code",
            "name",
            relational.code_labels(F.col("region").cast("int"), REGIONS).alias("region"),
            relational.code_labels(F.col("division").cast("int"), DIVISIONS).alias("division"),
            *rest,
        )
    )


def population(bg: DataFrame) -> DataFrame:
    """popu and labor of block groups, tracts and counties from block-group rows."""
    return rollup.prefix_rollup(bg.select("geoid", "popu", "labor"), ["popu", "labor"], ("BG", "Tract", "County"))


def urban_zones(blocks: DataFrame) -> DataFrame:
    """Urban area of every zone by majority of its blocks: code, name, level, geoid."""
    rows = rollup.level_rows(blocks.select("geoid", "code", "name"), ZONE_LEVELS)
    return rollup.majority(rows, ["level", "geoid"], ["code", "name"]).select("code", "name", "level", "geoid")


def largest_cities(n: int, urban: DataFrame, popu: DataFrame, rank_level: str | None = None) -> DataFrame:
    """Zones of the ``n`` most populous urban areas: geoid, level, ua_code, urba, city.

    ``rank_level`` restricts the ranking to one level; without it the population of all levels is summed.
    """
    z = urban.select("geoid", "level", F.col("code").alias("ua_code"), F.col("name").alias("urba"))
    sized = z.join(popu.select("geoid", "popu"), "geoid")
    if rank_level:
        sized = sized.where(F.col("level") == rank_level)
    top = sized.groupBy("urba").agg(F.sum("popu").alias("popu")).orderBy(F.desc("popu"), "urba").limit(n)
    top = top.select("urba", text.principal_city(F.col("urba")).alias("city"))
    return z.join(top, "urba").select("geoid", "level", "ua_code", "urba", "city")


def zones(shapes: DataFrame, counties: DataFrame, top: DataFrame, popu: DataFrame) -> DataFrame:
    """All zones of the selected cities.

    ``shapes``: geoid, aland, awater (square metres), geometry of block groups and tracts; ``counties``: geoid,
    county, aland, awater, geometry. Water-only block groups and tracts are removed, counties stay.
    """
    miles = {c: units.sqm_to_sqmi(F.col(c)) for c in ("aland", "awater")}
    names = counties.select(F.col("geoid").alias("county_id"), "county")
    fine = (
        shapes.where(F.col("aland") > 0)
        .withColumn("county_id", text.prefix(F.col("geoid"), "County"))
        .join(names, "county_id")
        .drop("county_id")
    )
    return (
        counties.select(*fine.columns)
        .unionByName(fine)
        .withColumns(miles)
        .join(top.select("geoid", "level", "ua_code", "city"), "geoid")
        .join(popu.select("geoid", "popu", "labor"), "geoid")
        .select("geoid", "level", "county", "ua_code", "city", "aland", "awater", "popu", "labor", "geometry")
    )


def centroids(zones: DataFrame) -> DataFrame:
    c = geo.centroid_lonlat(F.col("geometry"))
    return zones.select(
        "geoid", F.lower("level").alias("level"), text.slug(F.col("city")).alias("city"), c.alias("c")
    ).select("geoid", "level", "city", F.col("c.x").alias("x"), F.col("c.y").alias("y"))


def group_bounds(zones: DataFrame, by: list[str]) -> DataFrame:
    b = geo.bounds(F.col("geometry"))
    return (
        zones.withColumn("_b", b)
        .groupBy(*by)
        .agg(
            F.min("_b.minx").alias("minx"),
            F.min("_b.miny").alias("miny"),
            F.max("_b.maxx").alias("maxx"),
            F.max("_b.maxy").alias("maxy"),
        )
    )


def city_region(zones: DataFrame, states: DataFrame, bbox_level: str | None = None) -> DataFrame:
    """Region slug of the state holding most of a city's block groups, and the city's bounding box."""
    home = rollup.majority(
        zones.where("level = 'BG'").select("city", F.substring("geoid", 1, 2).alias("state")), ["city"], ["state"]
    )
    boxed = zones if bbox_level is None else zones.where(F.col("level") == bbox_level)
    ends = group_bounds(boxed, ["city"])
    return (
        home.join(states.select(F.col("geoid").alias("state"), "region"), "state")
        .join(ends, "city")
        .select(
            text.slug(F.col("city")).alias("city"),
            text.slug(F.col("region")).alias("region"),
            *[F.round(c, 6).alias(c) for c in ("minx", "miny", "maxx", "maxy")],
        )
    )


def city_ranks(zones: DataFrame, level: str = "BG") -> DataFrame:
    """city, popu, rank (1..n by position) and avg_rank (average rank of ties, cut to int)."""
    sums = zones.where(F.col("level") == level).groupBy("city").agg(F.sum("popu").alias("popu"))
    ranked = ranking.positional_rank(sums, [F.desc("popu"), F.col("city")])
    return ranked.withColumn("avg_rank", descending_rank(F.col("popu")))


def descending_rank(value: Column) -> Column:
    """Average rank over a city table, largest first, cut to int (one row per city: at most 10^5 rows)."""
    return (
        F.rank().over(Window.orderBy(value.desc())) + (F.count("*").over(Window.partitionBy(value)) - 1) / 2
    ).cast("int")


def labels_in_box(zones: DataFrame, level: str = "County") -> DataFrame:
    """Zones of ``level`` whose Mercator centroid lies in the padded square around their city."""
    flat = zones.withColumn("geometry", geo.polygon_to_mercator(F.col("geometry")))
    squares = group_bounds(flat.where("level = 'BG'"), ["city"]).select(
        "city", geo.square_around(F.col("minx"), F.col("miny"), F.col("maxx"), F.col("maxy")).alias("sq")
    )
    points = flat.where(F.col("level") == level).withColumn("c", geo.centroid(F.col("geometry")))
    return (
        points.join(squares, "city")
        .where(F.col("c.x").between(F.col("sq.minx"), F.col("sq.maxx")))
        .where(F.col("c.y").between(F.col("sq.miny"), F.col("sq.maxy")))
        .select("city", "geoid", "county", F.col("c.x").alias("x"), F.col("c.y").alias("y"))
    )
