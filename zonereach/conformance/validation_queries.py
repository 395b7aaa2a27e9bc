"""Queries on router, dataset and scale comparisons, and on city and socio-economic summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import ranking, relational, stats
from ..operators.relational import keyword_filter
from ..plans import travel, validation as val
from ..session import cut_lineage
from ..sources.fixtures import Inputs
from .products import access_slice, r5_times, second_router, travel_times
from .registry import query, rounded
from ..plans import access as acc

# Router comparisons -------------------------------------------------------------------------------------------

_ROUTERS = """select o.city, o.mode, o.level, o.src, o.trg, o.time_min as osrm, cast(travel_time as double) as r5
 from fx_od o join fx_od_r5 r on r.city=o.city and r.mode=o.mode and r.level=o.level and r.src=o.src and r.trg=o.trg
 where travel_time is not null"""
_R = {"vw_routers": _ROUTERS}


def routers(i: Inputs, where=None) -> DataFrame:
    return travel.compare_routers(i.od, r5_times(i), "osrm", "r5", where)


@query("router_compare", "select city, mode, level, src, trg, round(osrm,6) as osrm, r5 from vw_routers", _R)
def router_compare(i: Inputs) -> DataFrame:
    return rounded(routers(i))


@query("router_compare_from_table", "select city, mode, level, src, trg, round(osrm,6) as osrm, r5 from vw_routers", _R)
def router_compare_from_table(i: Inputs) -> DataFrame:
    """Both routers' landed times, joined bucket by bucket."""
    return rounded(travel_times(i).compare(second_router(i), "osrm", "r5", F.col("level") == "BG"))


@query(
    "router_compare_state",
    """select substr(src,1,2) as state, city, mode, src, trg, round(osrm,6) as osrm, r5 from vw_routers
 where substr(src,1,2)=substr(trg,1,2)""",
    _R,
)
def router_compare_state(i: Inputs) -> DataFrame:
    return rounded(routers(i, travel.both_ends_in_state()).drop("level").withColumn("state", F.substring("src", 1, 2)))


_FITS = """select city, mode, count(*) as n, sum(r5*osrm)/sum(r5*r5) as slope, sum(r5*osrm)*sum(r5*osrm)/(sum(r5*r5)*sum(osrm*osrm)) as r2
 from vw_routers where city not in ('EUROPE') group by 1,2"""


def fits(i: Inputs) -> DataFrame:
    kept = routers(i).where(relational.not_in(F.col("city"), ["EUROPE"]))
    return stats.through_origin_fit(kept, "r5", "osrm", ["city", "mode"])


@query("origin_ols", "select city, mode, n, round(slope,6) as slope, round(r2,6) as r2 from vw_fits", _R | {"vw_fits": _FITS})
def origin_ols(i: Inputs) -> DataFrame:
    return rounded(fits(i).drop("x_max"))


@query(
    "fitted_lines",
    """select f.city, f.mode, cast(g as int) as step, round(top*g/99,4) as x, round(slope*(top*g/99),4) as y
 from vw_fits f join (select city, mode, max(r5) as top from vw_routers group by 1,2) m on m.city=f.city and m.mode=f.mode, range(100) r(g)""",
    _R | {"vw_fits": _FITS},
)
def fitted_lines(i: Inputs) -> DataFrame:
    lines = stats.fitted_line(fits(i), F.col("x_max"), 100)
    return rounded(lines.select("city", "mode", "step", "x", "y"), 4)


@query(
    "router_means",
    """select mode, city, round(avg(osrm),6) as osrm, round(avg(r5),6) as r5 from vw_routers group by 1,2
 union all select mode, 'all cities', round(avg(osrm),6), round(avg(r5),6) from vw_routers group by 1""",
    _R,
)
def router_means(i: Inputs) -> DataFrame:
    sums = routers(i).groupBy("mode", "city").agg(
        F.sum("osrm").alias("a"), F.sum("r5").alias("b"), F.count("*").alias("n")
    )
    both = sums.withColumn("city", F.explode(F.array("city", F.lit("all cities"))))
    out = both.groupBy("mode", "city").agg(
        (F.sum("a") / F.sum("n")).alias("osrm"), (F.sum("b") / F.sum("n")).alias("r5")
    )
    return rounded(out)


@query(
    "pair_sample",
    """select city, mode, src, trg, round(osrm,6) as osrm, r5 from vw_routers
 order by md5('1234|'||mode||'|'||src||'|'||trg), mode, src, trg limit 500""",
    _R,
)
def pair_sample(i: Inputs) -> DataFrame:
    def compared(only):
        return travel.compare_routers(i.od, r5_times(i), "osrm", "r5", only=only).drop("level")

    return rounded(relational.joined_head(compared, i.od.agg(F.count("*").alias("_size")), ["mode", "src", "trg"], 1234, 500))


@query(
    "pair_sample_by_mode",
    """select city, mode, src, trg, round(osrm,6) as osrm, r5 from vw_routers
 qualify row_number() over (partition by mode order by md5('1234|'||mode||'|'||src||'|'||trg), mode, src, trg)<=200""",
    _R,
)
def pair_sample_by_mode(i: Inputs) -> DataFrame:
    """As many pairs of each mode, which the joint plots show."""
    # From the landed tables, whose units know their pairs.
    first, second, fine = travel_times(i), second_router(i), F.col("level") == "BG"

    def compared(only):
        return first.compare(second, "osrm", "r5", fine, only).drop("level")

    sizes = first.units.where(fine).groupBy("mode").agg(F.sum("pairs").alias("_size"))
    return rounded(relational.joined_head(compared, sizes, ["mode", "src", "trg"], 1234, 200, by=["mode"]))


@query(
    "joint_histogram",
    """select mode, city, router, case when t<0 then 0 when t>=90 then 19 else cast(floor(t/5) as int)+1 end as bin, count(*) as n
 from (select mode, city, 'osrm' as router, osrm as t from vw_routers union all select mode, city, 'r5', r5 from vw_routers) a group by 1,2,3,4""",
    _R,
)
def joint_histogram(i: Inputs) -> DataFrame:
    long = routers(i).unpivot(["mode", "city"], ["osrm", "r5"], "router", "t")
    return stats.histogram(long, "t", ["mode", "city", "router"], 0, 90, 18)


# External data ------------------------------------------------------------------------------------------------

_OWN = """select city, mode, src as geoid, thresh, cast(sum(opport) as bigint) as own
 from fx_od_r5 join fx_opport_bg on geoid=trg and kind='Jobs: All' join fx_t on travel_time<=thresh group by 1,2,3,4"""
_EXT = """select o.mode, thresh, o.city, src as geoid, cast(sum(case when b.k%31=0 then 0 else opport end) as double) as ext
 from fx_od o join fx_opport_bg p on p.geoid=trg and kind='Jobs: All' join fx_t on time_min<=thresh join fx_bg b on b.geoid=src
 where thresh<=60 and not (mode='Drive' and o.city in ('ASIA')) group by 1,2,3,4"""
_RATIO = """select s.geoid, s.city, s.mode, s.thresh, own, ext, own/ext as ratio from vw_own s join vw_ext a
 on a.geoid=s.geoid and a.city=s.city and a.mode=s.mode and a.thresh=s.thresh where ext>0"""
_X = {"vw_own": _OWN, "vw_ext": _EXT, "vw_ratio": _RATIO}


def own_contour(i: Inputs) -> DataFrame:
    jobs = keyword_filter(i.opport_bg, kind="Jobs: All", level="BG").select("geoid", F.col("opport").alias("njobs"))
    return acc.contour_jobs(r5_times(i), jobs)


def external(i: Inputs) -> DataFrame:
    """A published table by another router, with its own quirks: ids as numbers, lower-case modes, a 90-minute row to be
    left out, zones it has no value for."""
    jobs = keyword_filter(i.opport_bg, kind="Jobs: All", level="BG").select("geoid", F.col("opport").alias("njobs"))
    raw = acc.contour_jobs(i.od, jobs).join(i.bg.select("geoid", "k"), "geoid").selectExpr(
        "cast(geoid as bigint) as id", "thresh as threshold", "lower(mode) as mode",
        "if(k % 31 = 0, 0D, cast(own as double)) as total_jobs", "city",
    )
    raw = raw.where("not (mode = 'drive' and city in ('ASIA'))").drop("city")
    return val.external_tidy(raw, "total_jobs", i.bg)


def ratios(i: Inputs) -> DataFrame:
    return val.external_ratio(own_contour(i), external(i))


@query("external_ratio", "select geoid, city, mode, thresh, own, ext, round(ratio,6) as ratio from vw_ratio", _X)
def external_ratio(i: Inputs) -> DataFrame:
    return rounded(ratios(i))


def _box_sql(source: str, value: str, by: str, extra: str = "") -> str:
    on = " and ".join(f"s.{c}=q.{c}" for c in by.split(","))
    keys = ", ".join(f"q.{c}" for c in by.split(","))
    return f"""select {keys}, max(q.n) as n, round(max(q1),6) as q1, round(max(med),6) as median, round(max(q3),6) as q3,
  round(min(case when {value} between q1-1.5*(q3-q1) and q3+1.5*(q3-q1) then {value} end),6) as whisker_lo,
  round(max(case when {value} between q1-1.5*(q3-q1) and q3+1.5*(q3-q1) then {value} end),6) as whisker_hi,
  count(*) filter (not {value} between q1-1.5*(q3-q1) and q3+1.5*(q3-q1)) as outliers{extra}
 from {source} s join (select {by}, count(*) as n, quantile_cont({value},0.25) as q1, quantile_cont({value},0.5) as med,
   quantile_cont({value},0.75) as q3 from {source} group by {by}) q on {on} group by {keys}"""


@query("ratio_box_stats", _box_sql("vw_r30", "ratio", "city,mode"), _X | {"vw_r30": "select * from vw_ratio where thresh=30"})
def ratio_box_stats(i: Inputs) -> DataFrame:
    return rounded(ranking.box_stats(keyword_filter(ratios(i), thresh=30), "ratio", ["city", "mode"]))


@query(
    "mode_cohorts",
    """select cohort, mode, n, round(median,6) as median from (
  select cohort, mode, count(*) as n, quantile_cont(ratio,0.5) as median from (
   select *, case when city in (select city from vw_r where mode='Drive') then 'with Drive' else 'without Drive' end as cohort from vw_r) a
  group by 1,2) b""",
    _X | {"vw_r": "select * from vw_ratio where thresh=30 and not (mode='Drive' and city in ('AFRICA'))"},
)
def mode_cohorts(i: Inputs) -> DataFrame:
    kept = val.exclude_mode_cities(keyword_filter(ratios(i), thresh=30), "Drive", ["AFRICA"])
    tagged = val.mode_cohorts(kept)
    return rounded(ranking.quantiles(tagged, "ratio", ["cohort", "mode"], {"median": 0.5}))


@query(
    "external_slopes",
    """select city, mode, count(*) as n, round(sum(own*ext)/sum(own*own),6) as slope, round(sum(own*ext)*sum(own*ext)/(sum(own*own)*sum(ext*ext)),6) as r2
 from (select city, mode, cast(own as double) as own, ext from vw_ratio where thresh=30) a group by 1,2""",
    _X,
)
def external_slopes(i: Inputs) -> DataFrame:
    fit = stats.through_origin_fit(keyword_filter(ratios(i), thresh=30), "own", "ext", ["city", "mode"])
    return rounded(fit.drop("x_max"))


@query(
    "zone_lookup",
    """select r.geoid, r.city, r.mode, round(own/1e6,9) as own_m, round(ext/1e6,9) as ext_m, popu from vw_ratio r join fx_bg b on b.geoid=r.geoid
 where thresh=30""",
    _X,
)
def zone_lookup(i: Inputs) -> DataFrame:
    one = keyword_filter(ratios(i), thresh=30).join(i.bg.select("geoid", "popu"), "geoid")
    out = one.select("geoid", "city", "mode", (F.col("own") / 1e6).alias("own_m"), (F.col("ext") / 1e6).alias("ext_m"), "popu")
    return rounded(out, 9)


# Cross-scale consistency --------------------------------------------------------------------------------------

_PAIRS = """select b.measure, split_part(b.kind,':',1) as kind, b.mode, b.thresh, aggfunc, lbig, lsmall, b.geoid, b.access as xsbig, xssmall
 from vw_access_levels b join (select measure, kind, mode, thresh, lbig, lsmall, geoid, unnest(['Mean','Median']) as aggfunc, unnest([mean,med]) as xssmall
   from (select measure, kind, mode, thresh, lbig, lsmall, substr(geoid,1,n) as geoid, avg(access) as mean, quantile_cont(access,0.5) as med
    from vw_access_levels join (values ('County','Tract',5),('Tract','BG',11)) v(lbig,lsmall,n) on level=lsmall group by 1,2,3,4,5,6,7) s) c
  on c.measure=b.measure and c.kind=b.kind and c.mode=b.mode and c.thresh=b.thresh and c.lbig=b.level and c.geoid=b.geoid
 where b.kind in ('Jobs: All','POIs: All') and b.thresh in (15,30,60)"""
_P = {"vw_pairs": _PAIRS}


def pairs(i: Inputs) -> DataFrame:
    return val.scale_pairs(access_slice(i, None))


@query(
    "scale_pairs",
    "select measure, kind, mode, thresh, aggfunc, lbig, lsmall, geoid, round(xsbig,4) as xsbig, round(xssmall,4) as xssmall from vw_pairs",
    _P,
)
def scale_pairs(i: Inputs) -> DataFrame:
    return rounded(pairs(i), 4)


_RMSE = """select measure, kind, mode, thresh, aggfunc, lbig, lsmall, count(*) as n, sqrt(avg(pow(a-b,2))) as rmse from (
  select measure, kind, mode, thresh, aggfunc, lbig, lsmall,
   (xssmall-min(xssmall) over w)/nullif(max(xssmall) over w-min(xssmall) over w,0) as a,
   (xsbig-min(xsbig) over w)/nullif(max(xsbig) over w-min(xsbig) over w,0) as b
  from vw_pairs window w as (partition by measure, kind, mode, thresh, aggfunc, lbig, lsmall)) p group by 1,2,3,4,5,6,7"""


@query(
    "scale_rmse",
    "select measure, kind, mode, thresh, aggfunc, lbig, lsmall, n, round(rmse,6) as rmse from vw_rmse",
    _P | {"vw_rmse": _RMSE},
)
def scale_rmse(i: Inputs) -> DataFrame:
    return rounded(val.scale_rmse(pairs(i)))


@query(
    "rmse_by_factor",
    _box_sql("vw_f", "rmse", "lbig,lsmall,factor,value,aggfunc"),
    _P
    | {
        "vw_rmse": _RMSE,
        "vw_f": """select lbig, lsmall, aggfunc, rmse, unnest(['measure','kind','mode','thresh']) as factor,
  unnest([measure,kind,mode,thresh||' min']) as value from vw_rmse where rmse is not null""",
    },
)
def rmse_by_factor(i: Inputs) -> DataFrame:
    return rounded(val.rmse_by_factor(val.scale_rmse(pairs(i))))


# City and socio-economic summaries ----------------------------------------------------------------------------


@query(
    "access_disadvantage",
    """select geoid, county, popu, round(aland,6) as aland, round(x,9) as access, round(popu/x,4) as burden,
  round((rank() over (order by popu/x)+(count(*) over (partition by popu/x)-1)/2)/count(*) over ()*100,6) as rank, round(popu/nullif(aland,0)/1000,6) as pop_density
 from (select z.geoid, county, popu, aland, access/1e6 as x from vw_zones z join vw_access a on a.geoid=z.geoid
  where measure='Gravity' and kind='Jobs: All' and mode='Drive' and thresh=30 and z.level='BG') s""",
)
def access_disadvantage(i: Inputs) -> DataFrame:
    out = val.access_disadvantage(
        access_slice(i), i.zones, level="BG", measure="Gravity", kind="Jobs: All", mode="Drive", thresh=30
    )
    return rounded(out, access=9, burden=4)


@query(
    "road_segments",
    """select urban_code, seg_id, aadt, f_system, speed_limit, city from fx_roads join (
  select distinct city, cast(ua_code as int) as code from fx_bg) c on code=urban_code where urban_code not in (0,99998,99999)""",
)
def road_segments(i: Inputs) -> DataFrame:
    return val.road_segments(i.roads, i.zones)


FEATURES = ["p_poc", "m_income", "p_pov", "p_renter", "p_noveh"]


def _means_sql(key: str, source: str) -> str:
    cols = ", ".join(f"sum({f}*cast(popu as double))/nullif(sum(popu),0) as {f}" for f in FEATURES)
    return f"select {key}, cast(sum(popu) as bigint) as popu, {cols} from {source} group by 1"


def _round_sql(cols, digits=6) -> str:
    return ", ".join(f"round({c},{digits}) as {c}" for c in cols)


_SES = {
    "vw_ses": "select s.*, substr(s.geoid,1,5) as county_id, b.city from fx_ses s join fx_bg b on b.geoid=s.geoid",
    "vw_county": _means_sql("county_id", "vw_ses"),
    "vw_city": _means_sql("city", "vw_ses"),
}


def ses_with_city(i: Inputs) -> DataFrame:
    return i.ses.join(i.bg.select("geoid", "city"), "geoid")


@query("weighted_means", f"select county_id, popu, {_round_sql(FEATURES)} from vw_county", _SES)
def weighted_means(i: Inputs) -> DataFrame:
    ses = i.ses.withColumn("county_id", F.substring("geoid", 1, 5))
    return rounded(stats.weighted_means(ses, FEATURES, "popu", ["county_id"]))


@query("means_by_position", f"select county_id, popu, {_round_sql(FEATURES)} from vw_county", _SES)
def means_by_position(i: Inputs) -> DataFrame:
    """Weighted means of all numeric columns but the first three, whatever they are called."""
    wide = i.bg.select("geoid", "county_id", "aland", "labor", "popu").join(i.ses.drop("popu"), "geoid")
    return rounded(stats.weighted_means(wide, relational.columns_from(wide, 3), "popu", ["county_id"]))


def _corr_sql() -> str:
    names = ["popu", *FEATURES]
    parts = []
    for a, r in enumerate(names):
        for b, c in enumerate(names):
            value = "cast(null as double)" if a == b else f"round(corr(cast({r} as double),cast({c} as double)),6)"
            source = "vw_county" if a <= b else "vw_city"
            parts.append(f"select '{r}' as row_var, '{c}' as col_var, {value} as value from {source}{' limit 1' if a == b else ''}")
    return "select * from (" + ") union all select * from (".join(parts) + ")"


@query("corr_matrix", _corr_sql(), _SES)
def corr_matrix(i: Inputs) -> DataFrame:
    return rounded(val.correlation_triangles(ses_with_city(i), FEATURES))


_SLICE = "measure='Gravity' and kind='Jobs: All' and mode='Drive' and thresh=45"
_XS = {"vw_xs": f"select a.city, a.geoid, access, popu, labor, county_id, county from vw_access a join fx_bg b on b.geoid=a.geoid where {_SLICE}"}


def gravity_slice(i: Inputs) -> DataFrame:
    """One metric of the saved access."""
    return access_slice(i, measure="Gravity", kind="Jobs: All", mode="Drive", thresh=45).select("city", "geoid", "access")


@query(
    "city_access_boxes",
    f"""select b.*, s.popu, row_number() over (order by s.popu desc, b.city) as rank from ({_box_sql(
        "vw_xs", "access", "city", ", round(avg(access),6) as mean")}) b
 join (select city, cast(sum(popu) as bigint) as popu from vw_xs group by 1) s on s.city=b.city""",
    _XS,
)
def city_access_boxes(i: Inputs) -> DataFrame:
    return rounded(val.city_access_boxes(gravity_slice(i), i.bg))


@query(
    "city_access_boxes_per_capita",
    _box_sql("vw_pc", "access", "city"),
    _XS | {"vw_pc": """select x.city, access/(p/1000) as access from vw_xs x join (
  select city, cast(sum(popu) as double) as p from vw_xs group by 1) s on s.city=x.city"""},
)
def city_access_boxes_per_capita(i: Inputs) -> DataFrame:
    sized = cut_lineage(gravity_slice(i).join(i.bg.select("geoid", "popu"), "geoid"))  # passes twice
    totals = sized.groupBy("city").agg(F.sum("popu").alias("city_popu"))
    return rounded(ranking.box_stats(val.per_capita(sized, "access", totals, ["city"], "city_popu"), "access", ["city"]))


@query(
    "city_access_weighted",
    """select measure, city, popu, round(access,6) as access from (
  select measure, a.city, cast(sum(popu) as bigint) as popu, sum(access*popu)/nullif(sum(popu),0) as access from vw_access a join fx_bg b on b.geoid=a.geoid
  where measure in ('M2SFCA','Gravity') and kind='Jobs: All' and mode='Drive' and thresh=45 group by 1,2) s""",
)
def city_access_weighted(i: Inputs) -> DataFrame:
    xs = access_slice(i, where=F.col("measure").isin("M2SFCA", "Gravity"), kind="Jobs: All", mode="Drive", thresh=45)
    sized = xs.where(relational.finite(F.col("access"))).join(i.bg.select("geoid", "popu"), "geoid")
    return rounded(stats.weighted_means(sized, ["access"], "popu", ["measure", "city"]))


@query(
    "norm_gravity",
    """select measure, geoid, round(access,6) as access, popu from (select 'Gravity' as measure, geoid, access, popu from vw_xs
  union all select 'Norm Gravity', geoid, access/nullif(popu,0), popu from vw_xs) a""",
    _XS,
)
def norm_gravity(i: Inputs) -> DataFrame:
    xs = gravity_slice(i).withColumn("measure", F.lit("Gravity"))
    return rounded(val.norm_gravity(xs, i.bg).select("measure", "geoid", "access", "popu"))


@query(
    "city_county_access",
    """select city, county, cast(sum(popu) as bigint) as popu, round(sum(access)/nullif(sum(popu),0),6) as access from vw_xs group by 1,2""",
    _XS,
)
def city_county_access(i: Inputs) -> DataFrame:
    sized = gravity_slice(i).join(i.bg.select("geoid", "county", "popu"), "geoid")
    return rounded(stats.ratio_of_sums(sized, "access", "popu", ["city", "county"], "access"))


@query(
    "county_access_ses",
    f"""select c.county_id, round(a.access,6) as access, c.popu, {", ".join(f"round(c.{f},6) as {f}" for f in FEATURES)} from vw_county c join (
  select county_id, sum(access)/nullif(sum(popu),0) as access from vw_xs group by 1) a on a.county_id=c.county_id""",
    _SES | _XS,
)
def county_access_ses(i: Inputs) -> DataFrame:
    return rounded(val.county_access_ses(gravity_slice(i), i.bg, i.ses, FEATURES))


@query(
    "city_density",
    """select city, cast(sum(popu) as bigint) as popu, round(sum(aland),6) as aland, round(sum(popu)/sum(aland),6) as pop_density
 from vw_zones where level='BG' group by 1""",
)
def city_density(i: Inputs) -> DataFrame:
    return rounded(val.city_density(i.zones.where("level = 'BG'")).orderBy("pop_density"))


_TWO = ["p_poc", "p_pov"]


@query(
    "multi_ols",
    """select term, round(coefficient,4) as coefficient from (select unnest(['p_poc','p_pov','(intercept)']) as term, unnest([b1,b2,ym-b1*xm-b2*zm]) as coefficient from (
  select (syx*szz-syz*sxz)/(sxx*szz-sxz*sxz) as b1, (syz*sxx-syx*sxz)/(sxx*szz-sxz*sxz) as b2, ym, xm, zm from (
   select covar_pop(y,x) as syx, covar_pop(y,z) as syz, covar_pop(x,z) as sxz, var_pop(x) as sxx, var_pop(z) as szz, avg(y) as ym, avg(x) as xm, avg(z) as zm
   from (select access as y, p_poc as x, p_pov as z from vw_xs join fx_ses using (geoid)) d) e) f) g""",
    _XS,
)
def multi_ols(i: Inputs) -> DataFrame:
    data = gravity_slice(i).join(i.ses, "geoid")
    return rounded(stats.regression_table(data, _TWO, "access").select("term", "coefficient"), 4)


@query(
    "multi_ols_no_intercept",
    """select term, round(coefficient,4) as coefficient, round(r2,6) as r2 from (select unnest(['p_poc','p_pov']) as term, unnest([b1,b2]) as coefficient, (b1*syx+b2*syz)/syy as r2 from (
  select (syx*szz-syz*sxz)/(sxx*szz-sxz*sxz) as b1, (syz*sxx-syx*sxz)/(sxx*szz-sxz*sxz) as b2, syx, syz, syy from (
   select sum(y*x) as syx, sum(y*z) as syz, sum(x*z) as sxz, sum(x*x) as sxx, sum(z*z) as szz, sum(y*y) as syy
   from (select access as y, p_poc as x, p_pov as z from vw_xs join fx_ses using (geoid)) d) e) f) g""",
    _XS,
)
def multi_ols_no_intercept(i: Inputs) -> DataFrame:
    data = gravity_slice(i).join(i.ses, "geoid")
    table = stats.regression_table(data, _TWO, "access", intercept=False)
    return rounded(table.select("term", "coefficient", "r2"), coefficient=4)


def _summary_sql(y: str, x: str, z: str, source: str) -> str:
    """Coefficients, errors, t and R2 of a fit without intercept on two features, by the normal equations."""
    return f"""select term, round(coefficient,9) as coefficient, round(std_error,9) as std_error, round(coefficient/std_error,6) as t, round(r2,6) as r2
 from (select unnest(['{x}','{z}']) as term, unnest([b1,b2]) as coefficient, unnest([sqrt(s2*szz/det),sqrt(s2*sxx/det)]) as std_error, (b1*syx+b2*syz)/syy as r2
  from (select *, (syx*szz-syz*sxz)/det as b1, (syz*sxx-syx*sxz)/det as b2, (syy-((syx*szz-syz*sxz)*syx+(syz*sxx-syx*sxz)*syz)/det)/(n-2) as s2
   from (select *, sxx*szz-sxz*sxz as det from (
    select count(*) as n, sum({y}*{x}) as syx, sum({y}*{z}) as syz, sum({x}*{z}) as sxz, sum({x}*{x}) as sxx, sum({z}*{z}) as szz, sum({y}*{y}) as syy
    from {source}) m) d) e) f"""


_COUNTY_XS = """select c.*, cast(c.popu as double) as popu_d, a.access from vw_county c join (
  select county_id, sum(access)/nullif(sum(popu),0) as access from vw_xs group by 1) a on a.county_id=c.county_id"""


def _full_summary_sql(y: str, features: list[str], source: str) -> str:
    """The same table on any number of features, with p: the scaled moments are inverted by one sweep per feature, and
    Student's t has whole degrees of freedom, for which its distribution is a finite sum."""
    k = range(len(features))
    cells = [(i, j) for i in k for j in k]
    moments = ", ".join([f"sum({f}*{y}) as v{i}, sqrt(sum({f}*{f})) as d{i}" for i, f in enumerate(features)])
    moments += ", " + ", ".join(f"sum({features[i]}*{features[j]}) as a{i}_{j}" for i, j in cells)
    kept = "n, syy, " + ", ".join(f"v{i}, d{i}" for i in k)
    sql = f"select {kept}, " + ", ".join(f"a{i}_{j}/(d{i}*d{j}) as a{i}_{j}" for i, j in cells)
    sql += f" from (select count(*) as n, sum({y}*{y}) as syy, {moments} from {source}) s"

    def swept(i: int, j: int, p: int) -> str:
        if i == p:
            return f"1/a{p}_{p}" if j == p else f"a{p}_{j}/a{p}_{p}"
        return f"-a{i}_{p}/a{p}_{p}" if j == p else f"a{i}_{j}-a{i}_{p}*a{p}_{j}/a{p}_{p}"

    for p in k:
        sql = f"select {kept}, " + ", ".join(f"{swept(i, j, p)} as a{i}_{j}" for i, j in cells) + f"\n from ({sql}) s"
    beta = ", ".join("(" + "+".join(f"a{i}_{j}*v{j}/d{j}" for j in k) + f")/d{i} as b{i}" for i in k)
    explained = "+".join(f"b{i}*v{i}" for i in k)
    terms = ",".join(f"'{f}'" for f in features)
    errors = ",".join(f"sqrt(s2*a{i}_{i})/d{i}" for i in k)
    odd = "sqrt(pi())/2*list_sum([exp(lgamma(j+1)-lgamma(j+1.5))*pow(x,j) for j in range((f-1)//2)])"
    even = "list_sum([exp(lgamma(j+0.5)-lgamma(j+1))*pow(x,j) for j in range(f//2)])/sqrt(pi())"
    return f"""select term, round(c,9) as coefficient, round(e,9) as std_error, round(t,6) as t,
  round(1-case when f%2=0 then sqrt(1-x)*{even} else 2/pi()*(atan(abs(t)/sqrt(f))+sqrt(1-x)*sqrt(x)*coalesce({odd},0)) end,6) as p, round(r2,6) as r2
 from (select *, c/e as t, f/(f+c/e*c/e) as x from (
  select unnest([{terms}]) as term, unnest([{",".join(f"b{i}" for i in k)}]) as c, unnest([{errors}]) as e, f, r2 from (
   select *, ({explained})/syy as r2, (syy-({explained}))/f as s2 from (select *, n-{len(features)} as f, {beta} from (
{sql}) s) s) s) s) s"""


_COUNTIES = _SES | _XS | {"vw_cxs": _COUNTY_XS}


def county_summary(i: Inputs, features: list[str]) -> DataFrame:
    data = val.county_access_ses(gravity_slice(i), i.bg, i.ses, FEATURES)
    return rounded(stats.regression_table(data, features, "access", intercept=False), coefficient=9, std_error=9)


@query("multi_ols_summary", _full_summary_sql("access", FEATURES, "vw_cxs"), _COUNTIES)
def multi_ols_summary(i: Inputs) -> DataFrame:
    return county_summary(i, FEATURES)


@query(
    "multi_ols_population",
    _full_summary_sql("access", [*FEATURES, "popu_d"], "vw_cxs").replace("'popu_d'", "'popu'"),
    _COUNTIES,
)
def multi_ols_population(i: Inputs) -> DataFrame:
    """The variant that keeps the population among the features."""
    return county_summary(i, [*FEATURES, "popu"])


@query("multi_ols_summary_two", _summary_sql("access", "p_poc", "m_income", "vw_cxs"), _COUNTIES)
def multi_ols_summary_two(i: Inputs) -> DataFrame:
    """Two of the features, against the closed form."""
    return county_summary(i, ["p_poc", "m_income"]).drop("p")


@query(
    "multi_ols_population_two",
    _summary_sql("access", "p_poc", "popu", "(select access, p_poc, popu_d as popu from vw_cxs)"),
    _COUNTIES,
)
def multi_ols_population_two(i: Inputs) -> DataFrame:
    return county_summary(i, ["p_poc", "popu"]).drop("p")
