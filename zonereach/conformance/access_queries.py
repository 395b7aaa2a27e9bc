"""Queries on the access measures."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.impedance import impedance_table, weight
from ..functions.text import purpose_of
from ..plans import access as acc
from ..plans import export
from ..operators.relational import keyword_filter
from ..sources.fixtures import Inputs
from ..sources.unit_store import UNIT
from .products import access_slice, access_store, access_units, compute_access, r5_times, run_pairs, saved_access, travel_times
from .registry import ACCESS_SQL, access_rounded, query, rounded

LONG = "measure, kind, mode, thresh, level, city, geoid"


def _show(df: DataFrame) -> DataFrame:
    return df.withColumn("access", access_rounded())


def base_access(i: Inputs, **options) -> DataFrame:
    return acc.access(i.od, i.opport_bg, i.zones, **options)


def level_access(i: Inputs, **options) -> DataFrame:
    return acc.access(i.od_levels, i.opport, i.zones, **options)


@query("access_core", f"select {LONG}, {ACCESS_SQL} from vw_access")
def access_core(i: Inputs) -> DataFrame:
    return _show(base_access(i))


@query("access_all_levels", f"select {LONG}, {ACCESS_SQL} from vw_access_levels")
def access_all_levels(i: Inputs) -> DataFrame:
    return _show(level_access(i))


@query("access_origin_demand", f"select {LONG}, {ACCESS_SQL} from vw_access_origin")
def access_origin_demand(i: Inputs) -> DataFrame:
    return _show(base_access(i, demand="origin"))


@query("access_keep_zero_demand", f"select {LONG}, {ACCESS_SQL} from vw_access_zero")
def access_keep_zero_demand(i: Inputs) -> DataFrame:
    return _show(base_access(i, keep_zero_demand=True))


_XMFCA = """select 'XMFCA' as measure, kind, w.mode, d.thresh, w.level, w.city, w.src as geoid,
  round(sum(opport*case when kind like 'Jobs%' then w_work/(labor*bw) else w_non/(popu*bn) end),6) as access
 from vw_w w join fx_opport o on o.geoid=w.trg and o.level=w.level
 join (select city, level, trg, thresh, sum(bw) as bw, sum(bn) as bn from (
        select city, level, src, trg, thresh, max(w_work) as bw, max(w_non) as bn
        from vw_w join fx_t on time_min<=thresh group by 1,2,3,4,5) m group by 1,2,3,4) d
  on d.city=w.city and d.level=w.level and d.trg=w.trg and time_min<=d.thresh
 join fx_size z on z.geoid=w.trg and z.level=w.level
 where labor>0 and popu>0 group by 1,2,3,4,5,6,7 having sum(opport*case when kind like 'Jobs%' then w_work else w_non end)>0"""


@query("xmfca", _XMFCA)
def xmfca(i: Inputs) -> DataFrame:
    return rounded(acc.cross_modal_access(i.od, i.opport_bg, i.zones))


@query(
    "impedance_weights",
    """select city, o.mode, purpose, count(*) as n, round(sum(w),6) as sum_w, round(min(w),9) as min_w, round(max(w),9) as max_w
 from (select city, o.mode, purpose, exp(alpha*pow(time_min,beta)) as w from fx_od o join fx_imp i on i.mode=o.mode
  where time_min<=90) o group by 1,2,3""",
)
def impedance_weights(i: Inputs) -> DataFrame:
    params = F.broadcast(impedance_table(i.spark))  # six literal rows
    w = i.od.where("time_min <= 90").join(params, "mode").withColumn(
        "w", weight(F.col("time_min"), F.col("alpha"), F.col("beta"))
    )
    out = w.groupBy("city", "mode", "purpose").agg(
        F.count("*").alias("n"), F.sum("w").alias("sum_w"), F.min("w").alias("min_w"), F.max("w").alias("max_w")
    )
    return rounded(out, min_w=9, max_w=9)


_DEMAND_COLS = ", ".join(
    f"round(max(case when thresh={t} then d_{tag} end),4) as {tag}_{t}" for tag in ("work", "non") for t in acc.THRESHOLDS
)


@query("demand_potential", f"select city, mode, level, trg, {_DEMAND_COLS} from vw_d group by 1,2,3,4")
def demand_potential(i: Inputs) -> DataFrame:
    return rounded(acc.demand_potential(i.od.where("time_min <= 90"), i.zones), 4)


@query(
    "contour_jobs_r5",
    """select city, mode, src as geoid, thresh, cast(sum(opport) as bigint) as own
 from fx_od_r5 join fx_opport_bg on geoid=trg and kind='Jobs: All' join fx_t on travel_time<=thresh group by 1,2,3,4""",
)
def contour_jobs_r5(i: Inputs) -> DataFrame:
    jobs = keyword_filter(i.opport_bg, kind="Jobs: All", level="BG").select("geoid", F.col("opport").alias("njobs"))
    return acc.contour_jobs(r5_times(i), jobs)


@query("catchment_set", "select distinct city, mode, level, trg, src from fx_od where time_min<=30")
def catchment_set(i: Inputs) -> DataFrame:
    return acc.catchment_sets(i.od, 30)


@query(
    "purpose_totals",
    """select case when kind like 'Jobs%' then 'Work' else 'Non-work' end as purpose, mode, thresh, count(*) as n,
  round(sum(case when measure='Contour' then access end),2) as contour from vw_access group by 1,2,3""",
)
def purpose_totals(i: Inputs) -> DataFrame:
    contour = F.when(F.col("measure") == "Contour", F.col("access"))
    out = access_slice(i).groupBy(purpose_of(F.col("kind")).alias("purpose"), "mode", "thresh").agg(
        F.count("*").alias("n"), F.sum(contour).alias("contour")
    )
    return rounded(out, 2)


@query("access_from_table", f"select {LONG}, {ACCESS_SQL} from vw_access")
def access_from_table(i: Inputs) -> DataFrame:
    """Access over landed travel times, whose pairs stay where they lie."""
    return _show(travel_times(i).access(i.opport_bg, i.zones, F.col("level") == "BG"))


@query("xmfca_from_table", _XMFCA)
def xmfca_from_table(i: Inputs) -> DataFrame:
    """All modes of a destination lie in one bucket."""
    return rounded(travel_times(i).cross_modal_access(i.opport_bg, i.zones, F.col("level") == "BG"))


@query("access_saved", f"select {LONG}, {ACCESS_SQL} from vw_access_levels")
def access_saved(i: Inputs) -> DataFrame:
    """Access of all levels, saved and read back."""
    return _show(saved_access(i).rows())


@query("access_unit_commits", "select city, mode, level, count(*) as n from vw_access_levels group by 1,2,3")
def access_unit_commits(i: Inputs) -> DataFrame:
    """The units of the saved access with their rows, from the commit records alone."""
    return saved_access(i).units().where("rows > 0").select(*UNIT, F.col("rows").alias("n"))


@query(
    "access_incremental",
    "select city, mode, level, count(*) as n, round(sum(access),2) as total from vw_access_levels where measure='Contour' group by 1,2,3",
)
def access_incremental(i: Inputs) -> DataFrame:
    """Save the driving units, then ask for all units: only the absent ones are computed and added. Then the input of
    the walking units has changed: they are computed again, and their first rows are no longer read."""
    store, units = access_store(i, "access-units"), access_units(i)
    stale = F.when(F.col("mode") == "Walk", F.lit("before")).otherwise(F.col("fingerprint"))
    most = run_pairs(i)
    store.update(units.where("mode = 'Drive'"), compute_access(i), run_pairs=most)
    store.update(units.withColumn("fingerprint", stale), compute_access(i), run_pairs=most)
    store.update(units, compute_access(i), run_pairs=most)
    out = store.rows(F.col("measure") == "Contour").groupBy("city", "mode", "level").agg(
        F.count("*").alias("n"), F.sum("access").alias("total")
    )
    return rounded(out, 2)


def _wide_sql(rows, digits=None) -> str:
    return ",\n ".join(
        f"coalesce(max(case when measure='{m}' and kind='{k}' and mode='{md}' and thresh={t} then"
        f" round(access,{4 if m in ('Contour', 'Gravity') else 6}) end),0.0) as {f}"
        for f, m, k, md, t in rows
    )


_INFO_SQL = """select z.geoid, z.level, z.county, round(lat,6) as lat, round(lon,6) as lon, popu, labor,
  coalesce(nj,0) as njobs, coalesce(np,0) as npois, coalesce(ne,0) as nevcs
 from vw_zones z join vw_centroid using (geoid, level) left join (select geoid, level, max(case when kind='Jobs: All' then opport end) as nj,
  max(case when kind='POIs: All' then opport end) as np, max(case when kind='EVCI: Stations' then opport end) as ne
  from fx_opport group by 1,2) o on o.geoid=z.geoid and o.level=z.level"""

CENTROID_VIEW = {
    "vw_centroid": """
 select geoid, level, (x1+x2+x3+x4)/4e6 as lon,
  degrees(2*atan(exp((ln(tan(pi()/4+radians(y1/1e6)/2))+ln(tan(pi()/4+radians(y3/1e6)/2)))/2))-pi()/2) as lat from vw_corner"""
}


def info_zones(i: Inputs) -> DataFrame:
    return export.zone_info(export.with_centroid(i.zone_shapes), i.opport)


@query("zone_info", _INFO_SQL, CENTROID_VIEW)
def zone_info(i: Inputs) -> DataFrame:
    return rounded(info_zones(i))


def wide_table(i: Inputs) -> DataFrame:
    return export.access_wide(base_access(i, wide=True), info_zones(i))


def _wide_rounded(df: DataFrame) -> DataFrame:
    digits = {f: 4 if f[:2] in ("Co", "Gr") else 6 for f, *_ in export.catalog_rows()}
    return df.selectExpr(
        *[f"round({c}, {digits.get(c, 6)}) as {c}" if t in ("double", "float") else c for c, t in df.dtypes]
    )


@query(
    "access_wide",
    f"""select i.*, a.* exclude (geoid) from ({_INFO_SQL}) i join (
 select geoid, {_wide_sql(export.catalog_rows())} from vw_access group by geoid) a on a.geoid=i.geoid""",
    CENTROID_VIEW,
)
def access_wide(i: Inputs) -> DataFrame:
    return _wide_rounded(wide_table(i))


@query(
    "map_layer",
    """select a.geoid, round(access,6) as value, cx, cy from vw_access a, (
  select round((min(minx)+max(maxx))/2,6) as cx, round((min(miny)+max(maxy))/2,6) as cy
  from vw_box join vw_zones z using (geoid, level) where level='BG' and city='MIDDLE EAST') b
 where measure='M2SFCA' and kind='Jobs: All' and mode='Drive' and thresh=30 and a.city='MIDDLE EAST' and level='BG'""",
)
def map_layer(i: Inputs) -> DataFrame:
    # Only the shown metric is pivoted, so the layer needs one column of the wide table.
    field = [r[0] for r in export.catalog_rows() if r[1:] == ("M2SFCA", "Jobs: All", "Drive", 30)]
    slim = base_access(i, wide=True, thresholds=(30,))
    wide = export.access_wide(slim, i.zones.select("geoid"), field)
    return rounded(export.map_layer(wide, i.zone_shapes, "MIDDLE EAST", "BG", "M2SFCA", "Jobs: All", "Drive", 30))


@query(
    "map_layers_all_cities",
    """select a.city, a.level, a.geoid, round(access,4) as value, cx, cy from vw_access_levels a join (
  select city, level, round((min(minx)+max(maxx))/2,6) as cx, round((min(miny)+max(maxy))/2,6) as cy
  from vw_box join vw_zones z using (geoid, level) group by 1,2) b on a.city=b.city and a.level=b.level
 where measure='Gravity' and kind='POIs: All' and mode='Walk' and thresh=45""",
)
def map_layers_all_cities(i: Inputs) -> DataFrame:
    out = export.city_layers(access_slice(i, None), i.zone_shapes, "Gravity", "POIs: All", "Walk", 45)
    return rounded(out, value=4)


_DASH = [r for r in export.catalog_rows() if r[2] in ("Jobs: All", "POIs: Medical") and r[3] in ("Drive", "Walk") and r[4] in (30, 60)]


@query(
    "dashboard_extract",
    f"""select z.city, z.level, x1/1e6 as first_x, y1/1e6 as first_y, a.* from vw_zones z join vw_corner using (geoid, level) join (
 select geoid, {", ".join(
        f"cast(round(cast(coalesce(max(case when measure='{m}' and kind='{k}' and mode='{md}' and thresh={t} then access end),0) as float),3) as double) as {f}"
        for f, m, k, md, t in _DASH)} from vw_access group by geoid) a on a.geoid=z.geoid
 where z.city in ('ASIA','EUROPE')""",
)
def dashboard_extract(i: Inputs) -> DataFrame:
    fields = [r[0] for r in _DASH]
    wide = export.access_wide(base_access(i, wide=True), i.zones.select("geoid"), fields, every=True)
    out = export.dashboard_extract(
        wide, i.zone_shapes, ("ASIA", "EUROPE"), ("Jobs: All", "POIs: Medical"), ("Drive", "Walk"), (30, 60)
    )
    first = F.col("geometry")[0][0]
    return out.select(
        "city", "level", first["x"].alias("first_x"), first["y"].alias("first_y"), "geoid",
        *[F.round(f, 3).cast("double").alias(f) for f in fields],
    )
