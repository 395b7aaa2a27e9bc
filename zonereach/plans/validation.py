"""Comparisons with other data, cross-scale consistency, and city and socio-economic summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text
from ..operators import ranking, relational, stats
from ..operators.ranking import with_average_rank
from ..session import cut_lineage

RURAL_CODES = (0, 99998, 99999)


def external_tidy(raw: DataFrame, value: str, block_groups: DataFrame, thresholds=(15, 30, 45, 60)) -> DataFrame:
    """External access rows (id, threshold, mode, value) as mode, thresh, city, geoid, ext."""
    return (
        raw.where(F.col("threshold").isin(list(thresholds)))
        .select(
            F.initcap("mode").alias("mode"),
            F.col("threshold").alias("thresh"),
            text.zero_pad(F.col("id"), 12).alias("geoid"),
            F.col(value).alias("ext"),
        )
        .join(block_groups.select("geoid", "city"), "geoid")
        .select("mode", "thresh", "city", "geoid", "ext")
    )


def external_ratio(own: DataFrame, ext: DataFrame) -> DataFrame:
    """Own and external access of the same zone, mode and threshold with their ratio."""
    return (
        own.join(ext, ["geoid", "city", "mode", "thresh"])
        .where("ext > 0")
        .withColumn("ratio", F.try_divide(F.col("own").cast("double"), F.col("ext").cast("double")))
    )


def exclude_mode_cities(df: DataFrame, mode: str, cities: Sequence[str]) -> DataFrame:
    return df.where(~((F.col("mode") == mode) & F.col("city").isin(list(cities))))


def mode_cohorts(ratios: DataFrame, mode: str = "Drive") -> DataFrame:
    """Rows tagged by whether their city has data for ``mode``."""
    ratios = cut_lineage(ratios)  # passes twice
    having = ratios.where(F.col("mode") == mode).select("city").distinct().withColumn("_has", F.lit(True))
    return ratios.join(having, "city", "left").withColumn(
        "cohort", F.when(F.col("_has"), F.lit(f"with {mode}")).otherwise(F.lit(f"without {mode}"))
    ).drop("_has")


def scale_pairs(
    access: DataFrame,
    kinds: Sequence[str] = ("Jobs: All", "POIs: All"),
    thresholds: Sequence[int] = (15, 30, 60),
) -> DataFrame:
    """Parent access next to the mean and median of its children, for County/Tract and Tract/BG.

    A parent has at most 10^6 children by its id width, so the exact median per parent fits a task.
    """
    key = ["measure", "kind", "mode", "thresh"]
    xs = access.where(F.col("kind").isin(list(kinds)) & F.col("thresh").isin(list(thresholds))).withColumn(
        "kind", F.split("kind", ":")[0]
    )
    # A row is the parent of one scale and the child of another; both roles meet in one grouping, so the access
    # table passes once and nothing is joined.
    scales = (("County", "Tract"), ("Tract", "BG"))
    roles = ", ".join(
        f"struct('{big}' as lbig, '{small}' as lsmall, level = '{big}' as parent,"
        f" substring(geoid, 1, {text.LEVEL_WIDTH[big]}) as geoid)"
        for big, small in scales
    )
    role = (
        xs.selectExpr(*key, "level", "access", f"explode(array({roles})) as r")
        .where("level = r.lbig or level = r.lsmall")
        .selectExpr(*key, "access", "r.*")
    )
    both = role.groupBy(*key, "lbig", "lsmall", "geoid").agg(
        F.expr("max(if(parent, access, null)) as xsbig"),
        F.expr("avg(if(parent, null, access)) as Mean"),
        F.expr("median(if(parent, null, access)) as Median"),
    )
    return (
        both.where("xsbig is not null and Mean is not null")
        .unpivot([*key, "lbig", "lsmall", "geoid", "xsbig"], ["Mean", "Median"], "aggfunc", "xssmall")
        .select(*key, "aggfunc", "lbig", "lsmall", "geoid", "xsbig", "xssmall")
    )


FACTORS = ["measure", "kind", "mode", "thresh", "aggfunc", "lbig", "lsmall"]


def scale_rmse(pairs: DataFrame) -> DataFrame:
    return stats.normalized_rmse(pairs, "xssmall", "xsbig", FACTORS)


def rmse_by_factor(rmse: DataFrame) -> DataFrame:
    """Box statistics of the RMSE per factor value (rows are factor combinations, a fixed enumeration)."""
    long = rmse.withColumn("thresh", text.minutes_label(F.col("thresh"))).unpivot(
        ["aggfunc", "lbig", "lsmall", "rmse"], ["measure", "kind", "mode", "thresh"], "factor", "value"
    )
    return ranking.box_stats(long, "rmse", ["lbig", "lsmall", "factor", "value", "aggfunc"])


def access_disadvantage(access: DataFrame, zones: DataFrame, **slice_) -> DataFrame:
    """Percentile of population per unit of access inside one slice, with density and access in millions."""
    one = relational.keyword_filter(access, **slice_).select("geoid", "access")
    joined = zones.select("geoid", "county", "popu", "aland").join(one, "geoid").withColumn(
        "burden", F.try_divide(F.col("popu").cast("double"), F.col("access") / 1e6)
    )
    ranked = with_average_rank(joined, "burden", pct=True, name="rank")
    return ranked.withColumns(
        {
            "access": F.col("access") / 1e6,
            "pop_density": F.try_divide(F.col("popu").cast("double"), F.col("aland")) / 1000,
        }
    )


def road_segments(hpms: DataFrame, zones: DataFrame) -> DataFrame:
    """Road segments in urban areas with their city; rural codes are left out."""
    codes = zones.select("city", F.col("ua_code").cast("int").alias("urban_code")).distinct()
    return hpms.where(~F.col("urban_code").isin(list(RURAL_CODES))).join(codes, "urban_code")


def norm_gravity(access: DataFrame, popu: DataFrame) -> DataFrame:
    """Access rows plus gravity per person as a measure of its own."""
    sized = access.join(popu.select("geoid", "popu"), "geoid")
    # Gravity rows come out twice, so the access table passes once.
    both = (
        "explode(if(measure = 'Gravity', array(struct(measure, access), struct('Norm Gravity' as measure,"
        " try_divide(access, cast(popu as double)) as access)), array(struct(measure, access)))) as _m"
    )
    rest = [c for c in sized.columns if c not in ("measure", "access")]
    return sized.selectExpr(*rest, both).select("_m.measure", "_m.access", *rest)


def per_capita(df: DataFrame, value: str, totals: DataFrame, by: Sequence[str], total: str) -> DataFrame:
    """``value`` per 1000 persons of the group total."""
    return df.join(totals, list(by)).withColumn(
        value, F.try_divide(F.col(value), F.col(total).cast("double") / 1000)
    )


def city_access_boxes(access: DataFrame, popu: DataFrame) -> DataFrame:
    """Access distribution of every city next to its population and population rank."""
    sized = cut_lineage(access.join(popu.select("geoid", "popu"), "geoid"))  # passes twice below
    boxes = ranking.box_stats(sized, "access", ["city"], mean=True)
    totals = sized.groupBy("city").agg(F.sum("popu").alias("popu"))
    return ranking.positional_rank(boxes.join(totals, "city"), [F.desc("popu"), F.col("city")])


def weighted_city_access(access: DataFrame, popu: DataFrame) -> DataFrame:
    """Population-weighted mean access by city."""
    sized = access.where(relational.finite(F.col("access"))).join(popu.select("geoid", "popu"), "geoid")
    return stats.weighted_means(sized, ["access"], "popu", ["city"]).where("access is not null")


def correlation_triangles(bg: DataFrame, features: Sequence[str], weight: str = "popu") -> DataFrame:
    """Correlations of the weighted means: counties above the diagonal, cities below."""
    county = stats.weighted_means(bg.withColumn("county_id", F.substring("geoid", 1, 5)), features, weight, ["county_id"])
    city = stats.weighted_means(bg, features, weight, ["city"])
    names = [weight, *features]
    return relational.triangle_merge(
        stats.correlation_matrix(county, names), stats.correlation_matrix(city, names), names
    )


def county_access_ses(access: DataFrame, popu: DataFrame, ses: DataFrame, features: Sequence[str]) -> DataFrame:
    """Access per person of every county with its population-weighted socio-economic means."""
    sized = access.join(popu.select("geoid", "popu"), "geoid").withColumn("county_id", F.substring("geoid", 1, 5))
    per_person = stats.ratio_of_sums(sized, "access", "popu", ["county_id"], "access").drop("popu")
    means = stats.weighted_means(ses.withColumn("county_id", F.substring("geoid", 1, 5)), features, "popu", ["county_id"])
    return per_person.join(means, "county_id")


def city_density(zones: DataFrame) -> DataFrame:
    return (
        zones.groupBy("city")
        .agg(F.sum("popu").alias("popu"), F.sum("aland").alias("aland"))
        .withColumn("pop_density", F.try_divide(F.col("popu").cast("double"), F.col("aland")))
    )
