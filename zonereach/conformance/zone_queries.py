"""Queries on the zone hierarchy, opportunities and geometry."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import geo, text, units
from ..operators import cover, dissolve, ranking, relational, rings, rollup, spatial, stats
from ..plans import feeds, opportunities as opp, travel, zones as zn
from ..plans.travel_table import PLACE
from ..session import cut_lineage
from ..sources import readers
from ..sources.fixtures import Inputs, with_geometry
from .access_queries import CENTROID_VIEW
from .products import travel_times
from .registry import query, rounded

# Grid sizes in degrees: about one zone per cell.
CELL = {"County": 4.0, "Tract": 0.01, "BG": 0.01}


@query("population_rollup", "select * from fx_size")
def population_rollup(i: Inputs) -> DataFrame:
    return zn.population(i.bg)


_UA = """select code, name, level, geoid from (
  select *, row_number() over (partition by level, geoid order by n desc, code, name) as rn from (
   select code, name, level, substr(geoid,1,width) as geoid, count(*) as n from fx_ua_blocks, fx_level group by 1,2,3,4) c) d
 where rn=1"""


@query("urban_zone_argmax", _UA)
def urban_zone_argmax(i: Inputs) -> DataFrame:
    return zn.urban_zones(i.ua_blocks)


_TOP = """select z.geoid, z.level, z.code as ua_code, z.name as urba, t.city from vw_ua z join (
  select name, regexp_extract(name,'^[^,/-]*') as city from (
   select name, sum(popu) as popu from vw_ua u join fx_size s on s.geoid=u.geoid group by 1) p
  order by popu desc, name limit 3) t on t.name=z.name"""


@query("largest_cities", _TOP, {"vw_ua": _UA})
def largest_cities(i: Inputs) -> DataFrame:
    return zn.largest_cities(3, zn.urban_zones(i.ua_blocks), zn.population(i.bg))


@query(
    "largest_cities_by_tract",
    _TOP.replace("on s.geoid=u.geoid", "on s.geoid=u.geoid and u.level='Tract'"),
    {"vw_ua": _UA},
)
def largest_cities_by_tract(i: Inputs) -> DataFrame:
    return zn.largest_cities(3, zn.urban_zones(i.ua_blocks), zn.population(i.bg), rank_level="Tract")


@query(
    "states_labels",
    """select lpad(cast(r_regionkey+1 as varchar),2,'0') as geoid, upper(substr(r_name,1,2)) as code, r_name as name,
  case r_regionkey+1 when 1 then 'Northeast' when 2 then 'Midwest' when 3 then 'South' when 4 then 'West' end as region,
  case r_regionkey+1 when 1 then '1. New England' when 2 then '2. Middle Atlantic' when 3 then '3. East North Central'
   when 4 then '4. West North Central' when 5 then '5. South Atlantic' end as division, aland
 from region join (select substr(geoid,1,2) as st, cast(sum(aland) as bigint) as aland from fx_bg group by 1) b
  on st=lpad(cast(r_regionkey+1 as varchar),2,'0') where r_name not in ('ASIA')""",
)
def states_labels(i: Inputs) -> DataFrame:
    regions = i.table("region")
    land = i.bg.groupBy(F.substring("geoid", 1, 2).alias("geoid")).agg(F.sum("aland").alias("aland"))
    raw = land.join(
        regions.select(
            F.lpad((F.col("r_regionkey") + 1).cast("string"), 2, "0").alias("geoid"),
            F.col("r_name").alias("name"),
            (F.col("r_regionkey") + 1).alias("region"),
            (F.col("r_regionkey") + 1).cast("string").alias("division"),
        ),
        "geoid",
    )
    abbr = regions.select(F.col("r_name").alias("name"), F.upper(F.substring("r_name", 1, 2)).alias("code"))
    return zn.states(raw, abbr, excluded=("ASIA",))


def full_zones(i: Inputs) -> DataFrame:
    """Zones built the long way: majority urban areas, top cities, shapes, population."""
    popu = zn.population(i.bg)
    top = zn.largest_cities(4, zn.urban_zones(i.ua_blocks), popu)
    land = rollup.prefix_rollup(i.bg, ["aland", "awater"], ("BG", "Tract", "County"))
    shapes = with_geometry(land)
    names = i.counties.select(F.col("county_id").alias("geoid"), "county")
    counties = shapes.where("level = 'County'").join(names, "geoid")
    return zn.zones(shapes.where("level <> 'County'").drop("level"), counties.drop("level"), top, popu)


@query(
    "zones_table",
    """select z.geoid, z.level, z.county, t.ua_code, t.city, round(z.aland,6) as aland, round(z.awater,6) as awater, z.popu, z.labor
 from vw_zones z join vw_top t on t.geoid=z.geoid where z.level='County' or z.aland>0""",
    {"vw_ua": _UA, "vw_top": _TOP.replace("limit 3", "limit 4")},
)
def zones_table(i: Inputs) -> DataFrame:
    return rounded(full_zones(i).drop("geometry"))


@query(
    "zone_centroids",
    """select geoid, lower(level) as level, replace(replace(lower(city),' ','-'),'.','') as city, round(lon,6) as x, round(lat,6) as y
 from vw_zones join vw_centroid using (geoid, level)""",
    CENTROID_VIEW,
)
def zone_centroids(i: Inputs) -> DataFrame:
    return rounded(zn.centroids(i.zone_shapes))


@query(
    "city_region",
    """select replace(lower(city),' ','-') as city, lower(region) as region, round(min(minx),6) as minx, round(min(miny),6) as miny,
  round(max(maxx),6) as maxx, round(max(maxy),6) as maxy
 from vw_zones z join vw_box using (geoid, level) join (
   select city as c, st from (select city, substr(geoid,1,2) as st, row_number() over (partition by city order by count(*) desc, substr(geoid,1,2)) as rn
     from fx_bg group by 1,2) a where rn=1) h on h.c=z.city
  join (values ('01','Northeast'),('02','Midwest'),('03','South'),('04','West'),('05','Far-West')) r(st,region) on r.st=h.st
 group by 1,2""",
)
def city_region(i: Inputs) -> DataFrame:
    labels = {1: "Northeast", 2: "Midwest", 3: "South", 4: "West", 5: "Far West"}
    states = i.table("region").select(
        F.lpad((F.col("r_regionkey") + 1).cast("string"), 2, "0").alias("geoid"),
        relational.code_labels(F.col("r_regionkey") + 1, labels).alias("region"),
    )
    return zn.city_region(i.zone_shapes, states)


@query(
    "city_ranks",
    """select city, popu, row_number() over (order by popu desc, city) as rank,
  cast(floor(rank() over (order by popu desc)+(count(*) over (partition by popu)-1)/2) as int) as avg_rank
 from (select city, cast(sum(popu) as bigint) as popu from fx_bg group by 1) c""",
)
def city_ranks(i: Inputs) -> DataFrame:
    return zn.city_ranks(i.zones)


@query(
    "rank_batches",
    """select city, popu, ntile(2) over (order by popu desc, city) as batch
 from (select city, cast(sum(popu) as bigint) as popu from fx_bg group by 1) c""",
)
def rank_batches(i: Inputs) -> DataFrame:
    sums = i.bg.groupBy("city").agg(F.sum("popu").alias("popu"))
    return ranking.batches(sums, [F.desc("popu"), F.col("city")], 2)


_MERC = """
 select geoid, level, {r}*radians((x1+x2+x3+x4)/4e6) as cx,
  {r}*(ln(tan(pi()/4+radians(y1/1e6)/2))+ln(tan(pi()/4+radians(y3/1e6)/2)))/2 as cy,
  {r}*radians(least(x1,x4)/1e6) as bx0, {r}*radians(greatest(x2,x3)/1e6) as bx1,
  {r}*ln(tan(pi()/4+radians(y1/1e6)/2)) as by0, {r}*ln(tan(pi()/4+radians(y3/1e6)/2)) as by1 from vw_corner""".format(r="6378137.0")


@query(
    "labels_in_city_square",
    """select z.city, z.geoid, z.county, round(cx,3) as x, round(cy,3) as y from vw_zones z join vw_merc m using (geoid, level) join (
  select city, (min(bx0)+max(bx1))/2 as mx, (min(by0)+max(by1))/2 as my, greatest(max(bx1)-min(bx0),max(by1)-min(by0))/2 as d
  from vw_zones join vw_merc using (geoid, level) where level='BG' group by 1) s on s.city=z.city
 where level='County' and cx between mx-d and mx+d and cy between my-d and my+d""",
    {"vw_merc": _MERC},
)
def labels_in_city_square(i: Inputs) -> DataFrame:
    return rounded(zn.labels_in_box(i.zone_shapes), 3)


_JOBS = """select substr(geoid,1,w) as geoid, level, kind, cast(sum(v) as bigint) as njobs from (
  select geoid, 'All' as kind, c000 as v from fx_wac union all select geoid, 'Low wage', ce01 from fx_wac
  union all select geoid, 'Low edu', cd01+cd02 from fx_wac union all select geoid, 'POC', c000-cr01 from fx_wac) k,
 (values ('Block',15),('BG',12),('Tract',11),('County',5)) l(level,w) group by 1,2,3 having sum(v)>0"""


@query("jobs_by_level_kind", _JOBS)
def jobs_by_level_kind(i: Inputs) -> DataFrame:
    return opp.job_counts(i.wac)


_TAGS = """select naics, description, tag, value,
  tag='shop' and value in ('convenience','department_store','greengrocer','grocery','health_food','supermarket') as Groceries,
  tag='amenity' and value in ('school','kindergarten') as Education,
  (tag='amenity' and value='hospital') or (tag='healthcare' and value in ('doctor','hospital')) as Medical,
  tag='social_facility' and value='food_bank' as "Social Support"
 from (select naics, description, split_part(trim(p),'=',1) as tag, split_part(trim(p),'=',2) as value
  from (select naics, description, unnest(string_split(osm,'OR')) as p from fx_tag_list where osm is not null) a) b
 where tag in ('amenity','clothes','craft','fast_food','healthcare','second_hand','shop','social_facility:for','social_facility')"""


@query("poi_tag_classes", _TAGS)
def poi_tag_classes(i: Inputs) -> DataFrame:
    return opp.poi_tag_classes(i.tag_list)


_CLASSES = ("Groceries", "Education", "Medical", "Social Support")


def _poi_sql(agg: str) -> str:
    per = ", ".join(f'{agg}(case when "{c}" then 1 else 0 end) as "{c}"' for c in _CLASSES)
    total = ", ".join(f'sum(coalesce("{c}",0)) as "{c}"' for c in _CLASSES)
    lists = "unnest(['All','" + "','".join(_CLASSES) + "']) as kind"
    vals = 'unnest(["All",' + ",".join(f'"{c}"' for c in _CLASSES) + "]) as v"
    return f"""select geoid, level, kind, cast(sum(v) as bigint) as npois from (
  select substr(geoid,1,width) as geoid, level, {lists}, {vals} from (
   select p.geoid, count(distinct p.id) as "All", {total} from (
     select id, geoid, tag, value from vw_points_at union all
     select id, geoid, 'healthcare', 'doctor' from vw_points_at where two_tags) p
    left join (select tag, value, {per} from vw_tags group by 1,2) t on t.tag=p.tag and t.value=p.value
   where p.tag in (select tag from vw_tags) and p.geoid in (select geoid from fx_bg) group by 1) a, fx_level) b
 group by 1,2,3"""


def class_tags(i: Inputs) -> DataFrame:
    return opp.poi_tag_classes(i.tag_list)


@query("poi_counts", _poi_sql("sum"), {"vw_tags": _TAGS})
def poi_counts(i: Inputs) -> DataFrame:
    return opp.poi_counts(i.points, i.zone_shapes, class_tags(i))


@query("poi_counts_distinct", _poi_sql("max"), {"vw_tags": _TAGS})
def poi_counts_distinct(i: Inputs) -> DataFrame:
    return opp.poi_counts(i.points, i.zone_shapes, class_tags(i), distinct_poi=True)


_EV = """select geoid, level, kind, cast(sum(v) as bigint) as opport from (
  select z.geoid, z.level, unnest(['Stations','Level 2','Fast DC']) as kind, unnest([1,coalesce(l2,0),coalesce(fdc,0)]) as v
  from vw_ev_at e join vw_zones z on z.geoid=substr(e.geoid,1,length(z.geoid)) where open_date<=date '1999-12-31') a group by 1,2,3"""


@query("ev_counts", _EV)
def ev_counts(i: Inputs) -> DataFrame:
    return opp.ev_counts(i.ev_stations, i.zone_shapes, "1999-12-31")


_UNION = """select geoid, level, 'Jobs: '||kind as kind, njobs as opport from vw_jobs where level<>'Block'
 union all select geoid, level, 'POIs: '||kind, npois from vw_pois union all select geoid, level, 'EVCI: '||kind, opport from vw_evc"""
_UNION_VIEWS = {"vw_jobs": _JOBS, "vw_tags": _TAGS, "vw_pois": _poi_sql("sum"), "vw_evc": _EV, "vw_all": _UNION}


def all_opportunities(i: Inputs) -> DataFrame:
    return opp.opportunities(opp.job_counts(i.wac, ("BG", "Tract", "County")), poi_counts(i), ev_counts(i))


@query("opportunities_union", _UNION, _UNION_VIEWS)
def opportunities_union(i: Inputs) -> DataFrame:
    return all_opportunities(i)


_KINDS = ["Jobs: All", "Jobs: Low edu", "Jobs: Low wage", "Jobs: POC", "POIs: All"] + [f"POIs: {c}" for c in _CLASSES]


@query(
    "kind_totals",
    "select 'BG' as level, "
    + ", ".join(f"cast(coalesce(sum(case when kind='{k}' then opport end),0) as bigint) as \"{k}\"" for k in _KINDS)
    + " from vw_all where level='BG'",
    _UNION_VIEWS,
)
def kind_totals(i: Inputs) -> DataFrame:
    return opp.kind_totals(all_opportunities(i))


_SUMMARY = """select cast(floor(rank() over (order by p desc)+(count(*) over (partition by p)-1)/2) as int) as rank, ua_code, name, city, county,
  "nBG", "nTract", "nCounty", p/1000 as popu, aland, awater, p/aland as popdens, j/1000 as njobs, o/1000 as npois, e as nevcs from (
 select z.ua_code, u.name, z.city, array_to_string(list_sort(list(distinct county)),', ') as county, count(*) as "nBG",
  count(distinct substr(z.geoid,1,11)) as "nTract", count(distinct county) as "nCounty", sum(popu) as p, sum(aland) as aland, sum(awater) as awater,
  sum(coalesce(nj,0)) as j, sum(coalesce(np,0)) as o, cast(sum(coalesce(ne,0)) as bigint) as e
 from vw_zones z join vw_ua u on u.geoid=z.geoid and u.level='BG'
 left join (select geoid, max(case when kind='Jobs: All' then opport end) as nj, max(case when kind='POIs: All' then opport end) as np,
   max(case when kind='EVCI: Stations' then opport end) as ne from vw_all where level='BG' group by 1) a on a.geoid=z.geoid
 where z.level='BG' group by 1,2,3) s"""
_SUMMARY_SQL = """select rank, ua_code, name, city, county, "nBG", "nTract", "nCounty", round(popu,6) as popu, round(aland,6) as aland,
 round(awater,6) as awater, round(popdens,6) as popdens, round(njobs,6) as njobs, round(npois,6) as npois, nevcs from vw_sum where "nBG">1"""
_SUMMARY_VIEWS = _UNION_VIEWS | {"vw_ua": _UA, "vw_sum": _SUMMARY}


def summary(i: Inputs) -> DataFrame:
    jobs = opp.job_counts(i.wac, ("BG",))
    return opp.city_summary(i.zones, zn.urban_zones(i.ua_blocks), jobs, poi_counts(i), ev_counts(i))


@query("city_summary", _SUMMARY_SQL, _SUMMARY_VIEWS)
def city_summary(i: Inputs) -> DataFrame:
    return rounded(summary(i))


@query(
    "city_counties",
    """select rank, ua_code as area_code, name as area_name, city as chief_city, county as constituent_counties from vw_sum where "nBG">1""",
    _SUMMARY_VIEWS,
)
def city_counties(i: Inputs) -> DataFrame:
    return opp.city_counties(summary(i))


@query(
    "poi_source_delta",
    """select kind, osm, other, other-osm as diff, round((other-osm)/nullif(other,0)*100,6) as pct_diff from (
  select kind, cast(sum(v) as bigint) as osm, cast(sum(w) as bigint) as other from (
   select kind, npois as v, 0 as w from vw_pois where level='BG' union all
   select replace(kind,'POIs: ',''), 0, opport from fx_opport_bg where kind like 'POIs%') a group by 1) b""",
    {"vw_tags": _TAGS, "vw_pois": _poi_sql("sum")},
)
def poi_source_delta(i: Inputs) -> DataFrame:
    mine = poi_counts(i).where("level = 'BG'")
    other = i.opport_bg.where(F.col("kind").startswith("POIs")).select(
        F.regexp_replace("kind", "^POIs: ", "").alias("kind"), F.col("opport").alias("npois")
    )
    return rounded(opp.source_difference(mine, other, "osm", "other"))


@query(
    "mercator_roundtrip",
    """select id, round(6378137.0*radians(lon),3) as mx, round(6378137.0*ln(tan(pi()/4+radians(lat)/2)),3) as my,
  round(lon,8) as lon_back, round(lat,8) as lat_back from fx_points""",
)
def mercator_roundtrip(i: Inputs) -> DataFrame:
    # lon has seven digits, the last one a 5, so eight digits have no ties.
    p = i.points.select("id", geo.mercator_x(F.col("lon")).alias("mx"), geo.mercator_y(F.col("lat")).alias("my"))
    back = p.withColumns({"lon_back": geo.lon_of(F.col("mx")), "lat_back": geo.lat_of(F.col("my"))})
    return rounded(back, 8, mx=3, my=3)


@query(
    "polygon_area_bounds",
    """select geoid, level, minx, miny, maxx, maxy, round((w/1e6)*(h/1e6),9) as area_deg,
  round((bx1m-bx0m)*(by1-by0)/2.59e6,6) as area_sqmi from vw_lattice join vw_box using (geoid, level) join vw_merc using (geoid, level)
  join (select geoid, level, 6378137.0*radians(x1/1e6) as bx0m, 6378137.0*radians(x2/1e6) as bx1m from vw_corner) q using (geoid, level)""",
    {"vw_merc": _MERC},
)
def polygon_area_bounds(i: Inputs) -> DataFrame:
    flat = geo.polygon_to_mercator(F.col("geometry"))
    out = i.zone_shapes.select(
        "geoid", "level", geo.bounds(F.col("geometry")).alias("b"), geo.area(F.col("geometry")).alias("area_deg"),
        units.sqm_to_sqmi(geo.area(flat)).alias("area_sqmi"),
    )
    return rounded(out.select("geoid", "level", "b.*", "area_deg", "area_sqmi"), area_deg=9)


@query(
    "wkt_rings",
    """select geoid, level, 1 as n_rings, 5 as n_vertices, x1/1e6 as x1, y1/1e6 as y1, x3/1e6 as x3, y3/1e6 as y3 from vw_corner""",
)
def wkt_rings(i: Inputs) -> DataFrame:
    texts = i.zone_shapes.select("geoid", "level", geo.to_wkt(F.col("geometry")).alias("wkt"))
    g = F.col("geometry")
    return rounded(
        readers.with_geometry(texts).select(
            "geoid", "level", F.size(g).alias("n_rings"), F.size(g[0]).alias("n_vertices"),
            g[0][0]["x"].alias("x1"), g[0][0]["y"].alias("y1"), g[0][2]["x"].alias("x3"), g[0][2]["y"].alias("y3"),
        )
    )


@query(
    "point_in_polygon",
    """select p.id, z.level, z.geoid from vw_points_at p join vw_zones z on z.geoid=substr(p.geoid,1,length(z.geoid))""",
)
def point_in_polygon(i: Inputs) -> DataFrame:
    zones = i.zone_shapes.select("geoid", "level", "geometry")
    return cover.points_in_zones(i.points.select("id", "lon", "lat"), zones).select("id", "level", "geoid")


@query(
    "point_in_polygon_grid",
    """select p.id, z.level, z.geoid from vw_points_at p join vw_zones z on z.geoid=substr(p.geoid,1,length(z.geoid))""",
)
def point_in_polygon_grid(i: Inputs) -> DataFrame:
    """The same on a grid of one cell size a level."""
    zones = i.zone_shapes.select("geoid", "level", "geometry")
    return spatial.points_in_polygons(i.points.select("id", "lon", "lat"), zones, CELL).select("id", "level", "geoid")


_COUNTY_BOX = "select geoid, minx, miny, maxx, maxy from vw_box where level='County'"


@query(
    "bbox_overlap",
    """select mdb_id, geoid from fx_feeds f join vw_cbox b on f.minx<=b.maxx and f.maxx>=b.minx and f.miny<=b.maxy and f.maxy>=b.miny""",
    {"vw_cbox": _COUNTY_BOX},
)
def bbox_overlap(i: Inputs) -> DataFrame:
    b = geo.bounds(F.col("geometry"))
    boxes = i.zone_shapes.where("level = 'County'").select("geoid", b.alias("b")).select("geoid", "b.*")
    return spatial.boxes_overlap(i.feeds, boxes, 4.0).select("mdb_id", "geoid")


@query(
    "clip_points",
    """select p.id, b.city from fx_points p join (select city, min(minx) as minx, min(miny) as miny, max(maxx) as maxx, max(maxy) as maxy
  from vw_zones join vw_box using (geoid, level) where level='County' group by 1) b
 on lon between minx and maxx and lat between miny and maxy""",
)
def clip_points(i: Inputs) -> DataFrame:
    boxes = zn.group_bounds(i.zone_shapes.where("level = 'County'"), ["city"])
    return spatial.clip_points(i.points.select("id", "lon", "lat"), boxes, 4.0).select("id", "city")


@query(
    "city_squares",
    """select city, round((a+c)/2,3) as cx, round((b+d)/2,3) as cy, round((a+c)/2-greatest(c-a,d-b)/2,3) as minx,
  round((b+d)/2-greatest(c-a,d-b)/2,3) as miny, round((a+c)/2+greatest(c-a,d-b)/2,3) as maxx, round((b+d)/2+greatest(c-a,d-b)/2,3) as maxy
 from (select city, min(bx0) as a, min(by0) as b, max(bx1) as c, max(by1) as d from vw_zones join vw_merc using (geoid, level)
  where level='BG' group by 1) s""",
    {"vw_merc": _MERC},
)
def city_squares(i: Inputs) -> DataFrame:
    flat = i.zone_shapes.where("level = 'BG'").withColumn("geometry", geo.polygon_to_mercator(F.col("geometry")))
    ends = zn.group_bounds(flat, ["city"])
    return rounded(
        ends.select("city", geo.square_around(*[F.col(c) for c in ("minx", "miny", "maxx", "maxy")]).alias("s")).select(
            "city", "s.*"
        ),
        3,
    )


@query(
    "dissolve_attributes",
    """select city, level, popu, labor, round(aland,6) as aland, round(area,9) as area from (
  select city, level, cast(sum(popu) as bigint) as popu, cast(sum(labor) as bigint) as labor, sum(aland) as aland, sum((w/1e6)*(h/1e6)) as area
  from vw_zones join vw_lattice using (geoid, level) group by 1,2) a""",
)
def dissolve_attributes(i: Inputs) -> DataFrame:
    return rounded(dissolve.dissolve_attributes(i.zone_shapes, ["city", "level"], ["popu", "labor", "aland"]), area=9)


@query(
    "dissolve_outline",
    """select city, level, x1, y1, x2, y2 from (
  select city, level, case when swap then x2 else x1 end as x1, case when swap then y2 else y1 end as y1,
   case when swap then x1 else x2 end as x2, case when swap then y1 else y2 end as y2
  from (select city, e.*, x2<x1 or (x2=x1 and y2<y1) as swap from vw_edge e join vw_zones z using (geoid, level)) a) b
 group by 1,2,3,4,5,6 having count(*)=1""",
)
def dissolve_outline(i: Inputs) -> DataFrame:
    return dissolve.outline(i.zone_shapes, ["city", "level"])


_CONTIGUOUS = """, vw_member as materialized (select distinct city, mode, trg, src as geoid from fx_od where time_min<=30),
 vw_link as materialized (select a.geoid as a, b.geoid as b from vw_lattice a join vw_lattice b on a.level='BG' and b.level='BG'
   and a.county_id=b.county_id and abs((a.cc*2+a.half)-(b.cc*2+b.half))+abs(a.rr-b.rr)=1),
 vw_reach as (select mode, trg, geoid as a, geoid as b from vw_member union
  select r.mode, r.trg, r.a, l.b from vw_reach r join vw_link l on l.a=r.b join vw_member m on m.mode=r.mode and m.trg=r.trg and m.geoid=l.b),
 vw_part as materialized (select mode, trg, a as geoid, min(b) as part from vw_reach group by 1,2,3),
 vw_size as materialized (select mode, trg, part, sum(6378137.0*radians(w/1e6)*(by1-by0)) as part_area
   from vw_part join vw_lattice using (geoid) join vw_merc using (geoid, level) where level='BG' group by 1,2,3),
 vw_best as materialized (select *, row_number() over (partition by mode, trg order by round(part_area) desc, part) as rn from vw_size)
"""


@query(
    "contiguous_catchment",
    _CONTIGUOUS + """select p.mode, p.trg, p.geoid, p.part, round(b.part_area) as part_area from vw_part p
 join vw_best b on b.mode=p.mode and b.trg=p.trg and b.part=p.part where rn=1""",
    {"vw_merc": _MERC},
)
def contiguous_catchment(i: Inputs) -> DataFrame:
    return rounded(largest_parts(i).select("mode", "trg", "geoid", "part", "part_area"), 0)


CATCHMENT = [*PLACE, "mode", "trg"]


def largest_parts(i: Inputs) -> DataFrame:
    """The largest parts, lying as the travel times lie: city, level, block, mode, trg, geoid, part, part_area."""
    times = travel_times(i)
    members = times.rows().where("level = 'BG' and time_min <= 30").select(*CATCHMENT, F.col("src").alias("geoid"))
    return dissolve.contiguous_catchments(members, i.zone_shapes.where("level = 'BG'"), CATCHMENT, (times.buckets, *PLACE))


@query(
    "contiguous_outline",
    _CONTIGUOUS + """select mode, trg, count(*) as n_segments, cast(sum(x1) as bigint) as sum_x, cast(sum(y1) as bigint) as sum_y from (
  select mode, trg, case when swap then x2 else x1 end as x1, case when swap then y2 else y1 end as y1,
   case when swap then x1 else x2 end as x2, case when swap then y1 else y2 end as y2
  from (select p.mode, p.trg, e.*, x2<x1 or (x2=x1 and y2<y1) as swap from vw_part p
    join vw_best b on b.mode=p.mode and b.trg=p.trg and b.part=p.part and rn=1 join vw_edge e on e.geoid=p.geoid and e.level='BG') a
  group by 1,2,3,4,5,6 having count(*)=1) s group by 1,2""",
    {"vw_merc": _MERC},
)
def contiguous_outline(i: Inputs) -> DataFrame:
    """Outline of the largest contiguous part of every catchment."""
    parts = largest_parts(i).select(*CATCHMENT, "geoid")
    shapes = dissolve.zones_of(parts, i.zone_shapes.where("level = 'BG'").select("geoid", "geometry"), (travel_times(i).buckets, *PLACE))
    lines = dissolve.outline(parts.join(shapes, [*PLACE, "geoid"]), CATCHMENT)
    sums = lines.groupBy(*CATCHMENT).agg(F.count("*").alias("n_segments"), F.sum("x1").alias("sum_x"), F.sum("y1").alias("sum_y"))
    return sums.select("mode", "trg", "n_segments", "sum_x", "sum_y")


@query(
    "contiguous_shell",
    _CONTIGUOUS + """, vw_spot as materialized (select mode, trg, cc*2+half as c, rr as r from vw_part join vw_best b using (mode, trg, part)
   join vw_lattice using (geoid) where rn=1 and level='BG'),
 vw_frame as materialized (select mode, trg, min(c)-1 as c0, max(c)+1 as c1, min(r)-1 as r0, max(r)+1 as r1 from vw_spot group by 1,2),
 vw_flood as (select mode, trg, c0 as c, r0 as r from vw_frame union
  select f.mode, f.trg, f.c+dx, f.r+dy from vw_flood f join vw_frame b on b.mode=f.mode and b.trg=f.trg,
   (values (1,0),(-1,0),(0,1),(0,-1)) s(dx,dy)
  where f.c+dx between c0 and c1 and f.r+dy between r0 and r1
   and not exists (select 1 from vw_spot p where p.mode=f.mode and p.trg=f.trg and p.c=f.c+dx and p.r=f.r+dy))
 select b.mode, b.trg, n, round(((c1-c0+1)*(r1-r0+1)-flooded)*(5000*4000/1e12),9) as area from vw_frame b
 join (select mode, trg, count(*) as flooded from vw_flood group by 1,2) f on f.mode=b.mode and f.trg=b.trg
 join (select f.mode, f.trg, count(*) as n from vw_flood f, vw_frame b, (values (1,0),(-1,0),(0,1),(0,-1)) s(dx,dy)
   where b.mode=f.mode and b.trg=f.trg and f.c+dx between c0 and c1 and f.r+dy between r0 and r1
    and not exists (select 1 from vw_flood g where g.mode=f.mode and g.trg=f.trg and g.c=f.c+dx and g.r=f.r+dy) group by 1,2) e
  on e.mode=b.mode and e.trg=b.trg""",
    {"vw_merc": _MERC},
)
def contiguous_shell(i: Inputs) -> DataFrame:
    """Outer ring of the largest contiguous part of every catchment, its holes filled."""
    parts = largest_parts(i).select("mode", "trg", "geoid")
    shapes = parts.join(i.zone_shapes.where("level = 'BG'").select("geoid", "geometry"), "geoid")
    return rounded(rings.outer_rings(shapes, ["mode", "trg"]).select("mode", "trg", "n", "area"), 9)


@query(
    "dissolve_rings",
    """select city, level, n_points, round(area,9) as area, 0 as bad from (
  select city, level, cast(sum(1) as bigint) as n_points from (
   select city, level, x1, y1, x2, y2 from (
    select city, level, case when swap then x2 else x1 end as x1, case when swap then y2 else y1 end as y1,
     case when swap then x1 else x2 end as x2, case when swap then y1 else y2 end as y2
    from (select city, e.*, x2<x1 or (x2=x1 and y2<y1) as swap from vw_edge e join vw_zones z using (geoid, level)) a) b
   group by 1,2,3,4,5,6 having count(*)=1) o group by 1,2) p
 join (select city, level, sum((w/1e6)*(h/1e6)) as area from vw_zones join vw_lattice using (geoid, level) group by 1,2) q using (city, level)""",
)
def dissolve_rings(i: Inputs) -> DataFrame:
    """Polygons of the dissolved cities: their vertices and area, and how many are not closed or wind the wrong way."""
    found = rings.dissolve_rings(i.zone_shapes, ["city", "level"])
    wrong = (F.col("points")[0] != F.element_at("points", -1)) | ((F.col("area") > 0) != F.col("shell"))
    out = found.groupBy("city", "level").agg(
        F.sum("n").alias("n_points"), F.sum("area").alias("area"), F.count_if(wrong).cast("int").alias("bad")
    )
    return rounded(out, 9)


@query(
    "catchment_outline",
    """select mode, trg, count(*) as n_segments, cast(sum(x1) as bigint) as sum_x from (
  select mode, trg, least(x1,x2) as x1, least(y1,y2) as y1, greatest(x1,x2) as x2, greatest(y1,y2) as y2, case when y1<y2 then x1 else x2 end as k
  from (select distinct mode, trg, src as geoid from fx_od where time_min<=30) m join vw_edge e using (geoid) where level='BG'
  group by 1,2,3,4,5,6,7 having count(*)=1) a group by 1,2""",
)
def catchment_outline(i: Inputs) -> DataFrame:
    members = i.od.where("time_min <= 30").select("mode", "trg", F.col("src").alias("geoid")).distinct()
    shapes = members.join(i.zone_shapes.where("level = 'BG'").select("geoid", "geometry"), "geoid")
    lines = dissolve.outline(shapes, ["mode", "trg"])
    return lines.groupBy("mode", "trg").agg(F.count("*").alias("n_segments"), F.sum("x1").alias("sum_x"))


@query(
    "city_feeds",
    """select mdb_id, url, f.minx, f.miny, f.maxx, f.maxy, list_sort(list(distinct city)) as city from fx_feeds f
  join (select city, b.* from vw_zones join vw_box b using (geoid, level) where level='Tract') b
   on f.minx<=b.maxx and f.maxx>=b.minx and f.miny<=b.maxy and f.maxy>=b.miny
 where country_code='US' and url like '%.zip' and (status is null or status not in ('inactive','deprecated'))
  and f.maxx-f.minx<=3 and f.maxy-f.miny<=3 group by 1,2,3,4,5,6""",
)
def city_feeds(i: Inputs) -> DataFrame:
    b = geo.bounds(F.col("geometry"))
    extents = i.zone_shapes.where("level = 'Tract'").select("city", b.alias("b")).select("city", "b.*")
    return feeds.city_feeds(i.feeds, extents)


# Travel-time ingest -------------------------------------------------------------------------------------------


BATCH = 4


def matrices(i: Inputs, index: DataFrame) -> DataFrame:
    """Router responses of the requested blocks of four sources and four targets, in seconds; unknown pairs are null."""
    at = index.select("city", "level", F.col("geoid").alias("id"), "idx")
    pairs = (
        # The level comes with the source's position: as a constant it would vanish from the keys below, and rows that lie by
        # their block already would be moved again.
        i.pairs.join(at.withColumnsRenamed({"id": "src", "idx": "si"}), ["city", "src"])
        .join(at.withColumnsRenamed({"id": "trg", "idx": "ti"}), ["city", "level", "trg"])
        .select(
            "city", "level", F.expr(f"si div {BATCH} * {BATCH}").alias("src_off"), F.expr(f"ti div {BATCH} * {BATCH}").alias("trg_off"),
            F.expr(f"si % {BATCH} * {BATCH} + ti % {BATCH}").alias("at"), "base", "dist",
        )
    )

    def matrix(value):
        def cell(a, b):
            return F.max(F.when(F.col("at") == a * BATCH + b, F.col(value)))

        return F.array(*[F.array(*[cell(a, b) for b in range(BATCH)]) for a in range(BATCH)]).alias(value)

    # The pairs come to their block as they are, and the cells of a block are gathered where they lie; the modes differ by
    # a factor, so they are told apart as whole responses. Blocks with the same targets lie together, and so do the responses
    # to one request, also those that name a wrong block of sources.
    place = ["city", "level", "src_off", "trg_off"]
    blocks = pairs.repartition(i.pair_tasks, "city", "level", "trg_off").groupBy(*place).agg(matrix("dist"), matrix("base"))
    sizes = index.groupBy("city", "level").agg(F.count("*").alias("n"))  # a row per city, as many as there are area codes
    cut = f"slice(%s, 1, int(least({BATCH}, n - src_off)))"
    # The last blocks have fewer sources and targets.
    row = f"slice(r, 1, int(least({BATCH}, n - trg_off)))"
    return (
        blocks.join(F.broadcast(sizes), ["city", "level"])
        .selectExpr(
            *place, f"transform({cut % 'dist'}, r -> transform({row}, x -> double(x))) as distances", f"{cut % 'base'} as base",
            "n", "stack(3, 'Drive', 1, 'Bike', 2, 'Walk', 3) as (mode, f)",
        )
        .selectExpr(
            "city", "mode", "level", "src_off", "trg_off", "distances",
            f"transform(base, r -> transform({row}, x -> double(x * f * 6))) as durations",
        )
        .select(
            "city", "mode", "level", "src_off", "trg_off",
            F.to_json(F.struct("distances", "durations"), {"ignoreNullFields": "false"}).alias("response"),
        )
    )


def bg_index(i: Inputs) -> DataFrame:
    """Positions of the block groups, written down: responses, blocks and requests all look them up."""
    return cut_lineage(travel.zone_index(i.zones.where("level = 'BG'")))


@query(
    "od_matrix_ingest",
    """select city, mode, level, src, trg, cast(dist as double) as dist, round(tenths*6/60.0,6) as time_min from fx_od where tenths*6/60.0<=90
  and src in (select geoid from fx_bg) and trg in (select geoid from fx_bg)""",
)
def od_matrix_ingest(i: Inputs) -> DataFrame:
    index = bg_index(i)
    return rounded(travel.od_from_matrices(matrices(i, index), travel.id_blocks(index, BATCH)))


# Every 23rd request in some order meets with each of six mishaps, told apart by the remainder.
_MISHAP = "(src_off//4*7+trg_off//4*3+length(mode))%23"
_REQUESTS = {
    "vw_at": "select city, geoid, row_number() over (partition by city order by geoid)-1 as idx, count(*) over (partition by city) as n from fx_bg",
    "vw_requests": """select distinct a.city, mode, 'BG' as level, a.idx//4*4 as src_off, b.idx//4*4 as trg_off
 from vw_at a join vw_at b on a.city=b.city and a.n>1, fx_mode""",
    "vw_responses": f"""select *, {_MISHAP} as h from (select distinct o.city, o.mode, o.level, a.idx//4*4 as src_off, b.idx//4*4 as trg_off
 from fx_od o join vw_at a on a.city=o.city and a.geoid=o.src join vw_at b on b.city=o.city and b.geoid=o.trg) r""",
    "vw_rejects": """select city, mode, level, src_off, trg_off, case h when 0 then 'not JSON' when 1 then 'empty' when 2 then 'no matrix'
  when 3 then 'wrong shape' else 'repeated' end as reason from vw_responses, range(2) x(i)
 where h=5 or (h<4 and i=0)
 union all select city, mode, level, src_off+1, trg_off, 'not requested' from vw_responses where h=4
 union all select r.*, 'no response' from vw_requests r left join (select * from vw_responses where h<>4) p
  on p.city=r.city and p.mode=r.mode and p.src_off=r.src_off and p.trg_off=r.trg_off where p.h is null""",
}


def mishaps(good: DataFrame) -> DataFrame:
    """Responses as they come from a real router run: some cut off, empty, refused, short of a row, misplaced or twice."""
    h = F.expr("(src_off div 4 * 7 + trg_off div 4 * 3 + length(mode)) % 23")
    short = F.lit('{"distances": [], "durations": []}')
    response = (
        F.when(h == 0, F.expr("left(response, length(response) div 2)"))
        .when(h == 1, F.lit(None).cast("string"))
        .when(h == 2, F.lit('{"code": "TooBig", "message": "Too many table coordinates"}'))
        .when(h == 3, short)
        .otherwise(F.col("response"))
    )
    moved = F.when(h == 4, F.col("src_off") + 1).otherwise(F.col("src_off"))
    times = F.explode(F.sequence(F.lit(1), F.when(h == 5, 2).otherwise(1)))
    return good.select("city", "mode", "level", moved.alias("src_off"), "trg_off", response.alias("response"), times.alias("_t")).drop("_t")


def checked_run(i: Inputs, index: DataFrame) -> DataFrame:
    """The looked-at responses of a run with mishaps."""
    return travel.checked_matrices(mishaps(matrices(i, index)), travel.id_blocks(index, BATCH))


def run_rejects(i: Inputs, counted: bool = False) -> DataFrame:
    """What was not taken of the same run, with its requests without any response."""
    index = bg_index(i)
    # All responses are looked at once; what is read twice after that is which requests they answer and how.
    checked = cut_lineage(checked_run(i, index).select(*travel.REQUEST, "reason"))
    modes = i.spark.createDataFrame([(m,) for m in ("Drive", "Bike", "Walk")], "mode string")
    return travel.matrix_rejects(checked, unanswered=travel.requests(index, modes, BATCH, checked, counted))


@query("od_ingest_rejects", "select * from vw_rejects", _REQUESTS)
def od_ingest_rejects(i: Inputs) -> DataFrame:
    """Every response that could not be taken and every request without one, with the reason."""
    return run_rejects(i)


@query(
    "od_failed_units",
    "select city, mode, level, count(*) as rejects, array_to_string(list_sort(list(distinct reason)), ', ') as reasons from vw_rejects group by 1,2,3",
    _REQUESTS,
)
def od_failed_units(i: Inputs) -> DataFrame:
    return travel.failed_units(run_rejects(i, counted=True)).withColumn("reasons", F.array_join("reasons", ", "))


@query(
    "od_ingest_partial",
    """select o.city, o.mode, o.level, src, trg, cast(dist as double) as dist, round(tenths*6/60.0,6) as time_min from fx_od o
  join vw_at a on a.city=o.city and a.geoid=o.src join vw_at b on b.city=o.city and b.geoid=o.trg
  join (select * from vw_responses where h>5) r on r.city=o.city and r.mode=o.mode and r.src_off=a.idx//4*4 and r.trg_off=b.idx//4*4
 where tenths*6/60.0<=90""",
    _REQUESTS,
)
def od_ingest_partial(i: Inputs) -> DataFrame:
    """The times of the good responses of the same run."""
    return rounded(travel.matrix_cells(checked_run(i, bg_index(i))))


@query(
    "zone_index",
    "select city, level, geoid, row_number() over (partition by city, level order by geoid)-1 as idx from vw_zones",
)
def zone_index(i: Inputs) -> DataFrame:
    return travel.zone_index(i.zones)


@query(
    "od_request_blocks",
    """select city, level, idx//4 as block, min(idx) as first, max(idx) as last, count(*) as n_zones, (max(n)+3)//4 as n_target_blocks
 from (select city, level, row_number() over (partition by city, level order by geoid)-1 as idx, count(*) over (partition by city, level) as n
  from vw_zones) a where n>1 group by 1,2,3""",
)
def od_request_blocks(i: Inputs) -> DataFrame:
    return travel.request_blocks(travel.zone_index(i.zones), 4)


@query(
    "od_r5_ingest",
    """select city, mode, level, src, trg, cast(travel_time as double) as time_min, 'r5' as source from fx_od_r5 where travel_time is not null""",
)
def od_r5_ingest(i: Inputs) -> DataFrame:
    return travel.od_from_r5(i.od_r5.withColumnsRenamed({"src": "from_id", "trg": "to_id"}))


@query(
    "od_compact_codes",
    """select city, mode, level, dense_rank() over (partition by city, mode, level order by src)-1 as from_id,
  dense_rank() over (partition by city, mode, level order by trg)-1 as to_id, cast(floor(time_min) as int) as time from fx_od where time_min<=90""",
)
def od_compact_codes(i: Inputs) -> DataFrame:
    return travel_times(i).compact_codes(F.expr("level = 'BG' and time_min <= 90"))


@query(
    "od_compact_codes_unlanded",
    """select city, mode, level, dense_rank() over (partition by city, mode, level order by src)-1 as from_id,
  dense_rank() over (partition by city, mode, level order by trg)-1 as to_id, cast(floor(time_min) as int) as time from fx_od where time_min<=90""",
)
def od_compact_codes_unlanded(i: Inputs) -> DataFrame:
    return travel.compact_codes(i.od.where("time_min <= 90"))


@query(
    "od_missing_units",
    """select distinct city, mode, level from fx_od where (length(city)+length(mode))%3=0""",
)
def od_missing_units(i: Inputs) -> DataFrame:
    wanted = travel.known_units(i.od).select("city", "mode", "level").distinct()
    return travel.missing_units(wanted, i.od_r5.where("(length(city) + length(mode)) % 3 <> 0"))


@query(
    "acs_json_ingest",
    """select substr(geoid,1,width) as geoid, level, cast(sum(popu) as bigint) as popu, cast(sum(labor) as bigint) as labor
 from fx_bg, fx_level group by 1,2""",
)
def acs_json_ingest(i: Inputs) -> DataFrame:
    """One census answer per tract (at most ten block groups), header row first."""
    rows = readers.census_population(census_answers(i), "body", {"B01001_001E": "popu", "B23025_002E": "labor"})
    return zn.population(rows)


def census_answers(i: Inputs) -> DataFrame:
    """One census answer per tract, header row first: t, body."""
    parts = i.bg.select(
        F.substring("geoid", 1, 11).alias("t"),
        F.array(
            F.col("popu").cast("string"), F.col("labor").cast("string"), F.substring("geoid", 1, 2),
            F.substring("geoid", 3, 3), F.substring("geoid", 6, 6), F.substring("geoid", 12, 1),
        ).alias("row"),
    )
    header = F.array(*[F.lit(c) for c in CENSUS_HEADER])
    return parts.groupBy("t").agg(F.collect_list("row").alias("rows")).select("t", F.to_json(F.concat(F.array(header), "rows")).alias("body"))


CENSUS_HEADER = ("B01001_001E", "B23025_002E", "state", "county", "tract", "block group")


@query(
    "acs_json_rejects",
    """select t, case when h=0 then 'empty' when h=1 then 'not JSON' when h=2 then 'missing field' else 'wrong shape' end as reason
 from (select distinct substr(geoid,1,11) as t, cast(substr(geoid,6,6) as int)%11 as h from fx_bg) a where h<4""",
)
def acs_json_rejects(i: Inputs) -> DataFrame:
    """Census answers that are missing, cut off, without a field or with rows that do not fit their header."""
    h = F.substring("t", 6, 6).cast("int") % 11
    body = (
        F.when(h == 0, F.lit(None).cast("string"))
        .when(h == 1, F.expr("left(body, length(body) - 3)"))
        .when(h == 2, F.replace("body", F.lit("B23025_002E"), F.lit("B23025_001E")))
        .when(h == 3, F.replace("body", F.lit('"]]'), F.lit('","1"]]')))
        .otherwise(F.col("body"))
    )
    checked = readers.checked_header_first(census_answers(i).withColumn("body", body), "body", list(CENSUS_HEADER), ["t"])
    return checked.where("reason is not null").select("t", "reason")


@query(
    "source_fallback_year",
    """select state, year, cast(sum(c000) as bigint) as njobs from (select substr(geoid,1,2) as state, 2018+cast(substr(geoid,15,1) as int) as year, c000 from fx_wac) a
 join (select substr(geoid,1,2) as state, max(2018+cast(substr(geoid,15,1) as int)) as year from fx_wac
  where 2018+cast(substr(geoid,15,1) as int)<=2022 group by 1) b using (state, year) group by 1,2""",
)
def source_fallback_year(i: Inputs) -> DataFrame:
    rows = i.wac.select(
        F.substring("geoid", 1, 2).alias("state"), (F.substring("geoid", 15, 1).cast("int") + 2018).alias("year"), "c000"
    )
    best = readers.latest_year_per_source(rows, "state", 2022)
    return best.groupBy("state", "year").agg(F.sum("c000").alias("njobs"))


@query(
    "source_years_absent",
    """select distinct substr(geoid,1,5) as county_id from fx_bg where substr(geoid,1,5) not in (
  select substr(geoid,1,5) from fx_wac where substr(geoid,15,1)='1' and cast(substr(geoid,5,1) as int)%3<>1)""",
)
def source_years_absent(i: Inputs) -> DataFrame:
    # Counties whose number ends in 1, 4 or 7 have published no first year.
    rows = i.wac.where("cast(substring(geoid, 5, 1) as int) % 3 <> 1").select(
        F.substring("geoid", 1, 5).alias("county_id"), F.substring("geoid", 15, 1).cast("int").alias("year")
    )
    wanted = i.bg.select("county_id").distinct()
    return readers.absent_sources(wanted, rows, "county_id", 1)


@query(
    "unit_conversions",
    """select speed_limit, round(speed_limit/2.2369363,6) as mps, round(speed_limit/2.2369363*2.2369363,6) as mph,
  round(avg(aadt*3.28084),3) as ft, round(avg(aadt/1609.34),6) as mi, round(avg(aadt*1.60934),3) as km, round(avg(aadt/2.59e6),9) as sqmi
 from fx_roads group by 1""",
)
def unit_conversions(i: Inputs) -> DataFrame:
    mps = units.mph_to_mps(F.col("speed_limit"))
    a = F.col("aadt")
    out = i.roads.groupBy("speed_limit").agg(
        F.avg(units.m_to_ft(a)).alias("ft"), F.avg(units.m_to_mi(a)).alias("mi"), F.avg(units.mi_to_km(a)).alias("km"),
        F.avg(units.sqm_to_sqmi(a)).alias("sqmi"),
    ).withColumns({"mps": mps, "mph": units.mps_to_mph(mps)})
    return rounded(out, ft=3, km=3, sqmi=9)


@query(
    "keyword_filter",
    "select geoid, opport from fx_opport where level='Tract' and kind='Jobs: POC'",
)
def keyword_filter(i: Inputs) -> DataFrame:
    return relational.keyword_filter(i.opport, level="Tract", kind="Jobs: POC")


@query(
    "minmax_normalize",
    """select geoid, city, round((popu-lo)/nullif(hi-lo,0),6) as norm from (
  select geoid, city, popu, min(popu) over (partition by city) as lo, max(popu) over (partition by city) as hi from fx_bg) a""",
)
def minmax_normalize(i: Inputs) -> DataFrame:
    return rounded(relational.minmax_normalize(i.bg.select("geoid", "city", "popu"), "popu", ["city"]).drop("popu"))


@query(
    "factor_codes",
    """select user_id, first, row_number() over (order by first)-1 as code from (select user_id, min(event_id) as first from events group by 1) a""",
)
def factor_codes(i: Inputs) -> DataFrame:
    return ranking.factor_codes(i.table("events"), "user_id", "event_id")


@query(
    "label_top_n",
    """select k.city, k.kind, k.n, row_number() over (order by p desc, k.city) as city_rank from (
  select city, kind, cast(sum(opport) as bigint) as n from fx_opport_bg join fx_bg using (geoid) group by 1,2) k
 join (select city, sum(popu) as p from fx_bg group by 1) c on c.city=k.city where kind='Jobs: All'""",
)
def label_top_n(i: Inputs) -> DataFrame:
    totals = (
        i.opport_bg.where("kind = 'Jobs: All'").join(i.bg.select("geoid", "city"), "geoid")
        .groupBy("city", "kind").agg(F.sum("opport").alias("n"))
    )
    order = ranking.positional_rank(
        i.bg.groupBy("city").agg(F.sum("popu").alias("p")), [F.desc("p"), F.col("city")], "city_rank"
    )
    return totals.join(order.drop("p"), "city").orderBy("city_rank")


@query(
    "top_zones_by_jobs",
    """select geoid, opport from fx_opport_bg where kind='Jobs: All' order by opport desc, geoid limit 20""",
)
def top_zones_by_jobs(i: Inputs) -> DataFrame:
    return relational.keyword_filter(i.opport_bg, kind="Jobs: All", level="BG").select("geoid", "opport").orderBy(
        F.desc("opport"), "geoid"
    ).limit(20)


@query(
    "keys_missing_in_source",
    """select distinct substr(geoid,1,12) as geoid from fx_bg where geoid not in (select geoid from fx_opport_bg where kind='EVCI: Stations')""",
)
def keys_missing_in_source(i: Inputs) -> DataFrame:
    have = relational.keyword_filter(i.opport_bg, kind="EVCI: Stations").select("geoid")
    return i.bg.select("geoid").join(have, "geoid", "left_anti").distinct()


@query(
    "table_profile",
    """select unnest(['l_returnflag','l_quantity','l_shipdate','l_suppkey']) as column, unnest(['string','double','timestamp_ntz','bigint']) as dtype,
  count(*) as rows, unnest([count(*)-count(l_returnflag),count(*)-count(l_quantity),count(*)-count(l_shipdate),count(*)-count(l_suppkey)]) as nulls,
  unnest([count(distinct l_returnflag),count(distinct l_quantity),count(distinct l_shipdate),count(distinct l_suppkey)]) as distinct from lineitem""",
)
def table_profile(i: Inputs) -> DataFrame:
    return stats.table_profile(i.table("lineitem").select("l_returnflag", "l_quantity", "l_shipdate", "l_suppkey"))
