"""Opportunities: jobs, points of interest, charging stations, their union and the city summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import cover, relational, rollup
from .zones import descending_rank

JOB_LEVELS = ("Block", "BG", "Tract", "County")
POI_CLASSES = ("Groceries", "Education", "Medical", "Social Support")

# Map tags that mark a point of interest.
ALLOWED_TAGS = (
    "amenity",
    "clothes",
    "craft",
    "fast_food",
    "healthcare",
    "second_hand",
    "shop",
    "social_facility:for",
    "social_facility",
)

# Fixed values: (class, tag) and the tag values that belong to the class.
CLASS_TAGS = {
    ("Groceries", "shop"): (
        "convenience",
        "department_store",
        "greengrocer",
        "grocery",
        "health_food",
        "supermarket",
    ),
    ("Education", "amenity"): (
        "college",
        "dance_school",
        "kindergarten",
        "language_school",
        "music_school",
        "preschool",
        "school",
        "university",
    ),
    ("Medical", "amenity"): (
        "childcare",
        "dentist",
        "doctors",
        "hospital",
    ),
    ("Medical", "healthcare"): (
        "audiologist",
        "blood_bank",
        "blood_donation",
        "dentist",
        "doctor",
        "hospital",
        "laboratory",
        "occupational_therapist",
        "physiotherapist",
        "podiatrist",
        "psychotherapist",
        "speech_therapist",
    ),
    ("Medical", "healthcare:speciality"): (
        "chiropractic",
    ),
    ("Social Support", "social_facility"): (
        "ambulatory_care",
        "assisted_living",
        "dairy_kitchen",
        "food_bank",
        "group_home",
        "nursing_home",
        "outreach",
        "shelter",
        "soup_kitchen",
    ),
    ("Social Support", "social_facility:for"): (
        "drug_addicted",
    ),
}


def job_counts(wac: DataFrame, levels=JOB_LEVELS) -> DataFrame:
    """geoid, level, kind, njobs from block rows (geoid, c000, ce01, cr01, cd01, cd02); positive counts only."""
    kinds = wac.select(
        "geoid",
        F.col("c000").alias("All"),
        F.col("ce01").alias("Low wage"),
        (F.col("cd01") + F.col("cd02")).alias("Low edu"),
        (F.col("c000") - F.col("cr01")).alias("POC"),
    )
    names = ["All", "Low wage", "Low edu", "POC"]
    wide = rollup.prefix_rollup(kinds, names, levels)
    return wide.unpivot(["geoid", "level"], names, "kind", "njobs").where("njobs > 0")


def poi_tag_classes(raw: DataFrame) -> DataFrame:
    """naics, description, tag, value and one flag per class, from ``tag=value OR tag=value`` lists."""
    spark = raw.sparkSession
    classes = spark.createDataFrame(
        [(cls, tag, v) for (cls, tag), values in CLASS_TAGS.items() for v in values],
        "col string, tag string, value string",
    )
    pairs = (
        raw.where("osm is not null")
        .withColumn("pair", F.explode(F.split("osm", "OR")))
        .withColumn("pair", F.split(F.trim("pair"), "="))
        .select("naics", "description", F.col("pair")[0].alias("tag"), F.col("pair")[1].alias("value"))
        .where(F.col("tag").isin(list(ALLOWED_TAGS)))
    )
    matched = pairs.join(F.broadcast(classes), ["tag", "value"], "left")  # 43 literal rows
    return relational.one_hot(matched, "col", POI_CLASSES).select(
        "naics", "description", "tag", "value", *POI_CLASSES
    )


def poi_counts(points: DataFrame, block_groups: DataFrame, tags: DataFrame, distinct_poi: bool = False):
    """geoid, level, kind, npois: all points of interest per zone and, per class, the flag sums of their tags.

    A point's (tag, value) counts once per matching industry code, or once at all with ``distinct_poi``. The
    industry codes are summed per (tag, value) first, so points never fan out over a long code list. A point of
    interest has at least one tag of the list; its first such tag carries the count of the point itself.
    """
    agg = F.max if distinct_poi else F.sum
    per_value = tags.groupBy("tag", "value").agg(*[agg(F.col(c).cast("long")).alias(c) for c in POI_CLASSES])
    # One row with at most the nine allowed tags.
    names = tags.where(F.col("tag").isin(list(ALLOWED_TAGS))).agg(F.collect_set("tag").alias("_names"))
    listed = points.join(F.broadcast(names)).select(
        "id", "lon", "lat", F.map_filter("tags", lambda k, v: F.array_contains("_names", k) & v.isNotNull()).alias("tags")
    ).where(F.size("tags") > 0)
    placed = cover.points_in_zones(listed, block_groups.where("level = 'BG'").select("geoid", "geometry"), boundary=True)
    tagged = placed.select("geoid", F.posexplode(F.map_entries("tags")).alias("pos", "e")).selectExpr(
        "geoid", "if(pos = 0, 1L, 0L) as `All`", "e.key as tag", "e.value as value"
    )
    columns = ["All", *POI_CLASSES]
    # Counting per (zone, tag, value) before the classes are looked up keeps a hot tag to one row per zone.
    per_tag = tagged.groupBy("geoid", "tag", "value").agg(F.sum("All").alias("All"), F.count("*").alias("_n"))
    classed = per_tag.join(per_value, ["tag", "value"], "left").select(
        "geoid", "All", *[(F.coalesce(F.col(c), F.lit(0)) * F.col("_n")).alias(c) for c in POI_CLASSES]
    )
    wide = rollup.prefix_rollup(classed, columns, ("BG", "Tract", "County"))
    return wide.unpivot(["geoid", "level"], columns, "kind", "npois")


def ev_counts(stations: DataFrame, zones: DataFrame, asof: str) -> DataFrame:
    """geoid, level, kind, opport: stations, level-2 ports and fast ports opened by ``asof``, at every level."""
    opened = stations.where(F.col("open_date") <= F.to_date(F.lit(asof))).fillna(0, subset=["l2", "fdc"])
    placed = cover.points_in_zones(opened, zones.select("geoid", "level", "geometry"))
    wide = placed.groupBy("geoid", "level").agg(
        F.count("l2").alias("Stations"), F.sum("l2").cast("long").alias("Level 2"), F.sum("fdc").cast("long").alias("Fast DC")
    )
    return wide.unpivot(["geoid", "level"], ["Stations", "Level 2", "Fast DC"], "kind", "opport")


def opportunities(jobs: DataFrame, pois: DataFrame, evci: DataFrame) -> DataFrame:
    """One table of geoid, level, kind, opport with the kinds prefixed by their source."""

    def part(df: DataFrame, prefix: str, count: str) -> DataFrame:
        return df.select(
            "geoid", "level", F.concat(F.lit(prefix), "kind").alias("kind"), F.col(count).cast("long").alias("opport")
        )

    return (
        part(jobs, "Jobs: ", "njobs").unionByName(part(pois, "POIs: ", "npois")).unionByName(part(evci, "EVCI: ", "opport"))
    )


def kind_totals(opport: DataFrame, level: str = "BG") -> DataFrame:
    """One row with the total of every kind (transposed report)."""
    kinds = ["Jobs: All", "Jobs: Low edu", "Jobs: Low wage", "Jobs: POC", "POIs: All"] + [
        f"POIs: {c}" for c in POI_CLASSES
    ]
    totals = opport.where((F.col("level") == level) & ~F.col("kind").startswith("EVCI"))
    return totals.groupBy("level").pivot("kind", kinds).agg(F.sum("opport")).fillna(0)


def city_summary(zones: DataFrame, urban: DataFrame, jobs: DataFrame, pois: DataFrame, evci: DataFrame) -> DataFrame:
    """One row per urban area with zone counts, county list, areas, population, density and opportunities."""

    def at_bg(df: DataFrame, kind: str, count: str, name: str) -> DataFrame:
        return relational.keyword_filter(df, level="BG", kind=kind).select("geoid", F.col(count).alias(name))

    bg = relational.keyword_filter(zones, level="BG").select(
        "geoid", "county", "ua_code", "city", "aland", "awater", "popu"
    )
    bg = bg.join(urban.where("level = 'BG'").select("geoid", "name"), "geoid")
    for side in (
        at_bg(jobs, "All", "njobs", "njobs"),
        at_bg(pois, "All", "npois", "npois"),
        at_bg(evci, "Stations", "opport", "nevcs"),
    ):
        bg = relational.zero_filled_left_join(bg, side, ["geoid"])
    key = ["ua_code", "name", "city"]
    sums = bg.groupBy(*key).agg(
        F.count("geoid").alias("nBG"),
        F.array_join(F.sort_array(F.collect_set("county")), ", ").alias("county"),
        F.countDistinct("county").alias("nCounty"),
        *[F.sum(c).alias(c) for c in ("aland", "awater", "popu", "njobs", "npois", "nevcs")],
    )
    tracts = bg.groupBy("city").agg(F.countDistinct(F.substring("geoid", 1, 11)).alias("nTract"))
    df = sums.join(tracts, "city").withColumn("rank", descending_rank(F.col("popu")))
    return (
        df.where("nBG > 1")
        .withColumn("popdens", F.try_divide(F.col("popu").cast("double"), F.col("aland")))
        .withColumns({c: F.col(c) / 1000 for c in ("popu", "njobs", "npois")})
        .select("rank", "ua_code", "name", "city", "county", "nBG", "nTract", "nCounty", "popu", "aland", "awater",
                "popdens", "njobs", "npois", "nevcs")
    )


def city_counties(summary: DataFrame) -> DataFrame:
    """Rank, urban area, chief city and its counties."""
    return summary.select(
        "rank",
        F.col("ua_code").alias("area_code"),
        F.col("name").alias("area_name"),
        F.col("city").alias("chief_city"),
        F.col("county").alias("constituent_counties"),
    )


def source_difference(a: DataFrame, b: DataFrame, name_a: str, name_b: str) -> DataFrame:
    """Totals per kind of two point sources, their difference and percent difference of ``b``."""
    left = a.groupBy("kind").agg(F.sum("npois").alias(name_a))
    right = b.groupBy("kind").agg(F.sum("npois").alias(name_b))
    both = relational.zero_filled_outer_join(left, right, ["kind"])
    diff = F.col(name_b) - F.col(name_a)
    return both.withColumn("diff", diff).withColumn(
        "pct_diff", F.try_divide(diff.cast("double"), F.col(name_b)) * 100
    )
