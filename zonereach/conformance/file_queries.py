"""Queries that write files and read them back, the chain from opportunities to access, and small table operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import geo, text
from ..operators import dissolve, relational, rollup, spatial
from ..plans import access as acc
from ..plans import export
from ..plans import opportunities as opp
from ..sources import readers, writers
from ..sources.fixtures import Inputs
from .access_queries import CENTROID_VIEW, _INFO_SQL, _wide_rounded, _wide_sql, info_zones, base_access
from .oracle_views import _access
from .products import folder
from .registry import access_rounded, query, rounded
from .zone_queries import _JOBS, _UNION_VIEWS, all_opportunities


# From opportunities to access ---------------------------------------------------------------------------------

_PIPE = _UNION_VIEWS | {"vw_access_pipe": f"select * from ({_access('vw_w', 'vw_d', opport='vw_all')}) a where access>0"}


def pipeline_access(i: Inputs) -> DataFrame:
    """Jobs, points of interest and charging stations counted per zone, then access to all twelve kinds."""
    return acc.access(i.od, all_opportunities(i).where("level = 'BG'"), i.zones)


@query(
    "access_pipeline",
    """select measure, kind, mode, thresh, level, city, geoid,
  case when measure in ('Contour','Gravity') then round(access,4) else round(access,6) end as access from vw_access_pipe""",
    _PIPE,
)
def access_pipeline(i: Inputs) -> DataFrame:
    return pipeline_access(i).withColumn("access", access_rounded())


@query(
    "catalog_coverage",
    """select field, measure, c.kind, c.mode, thresh, coalesce(n,0) as n_zones, m as max_access from (
  select ms.c||'_'||k.c||'_'||md.c||'_'||t.thresh as field, ms.n as measure, k.n as kind, md.n as mode, t.thresh||' min' as thresh,
   t.thresh as t
  from (values ('Co','Contour'),('Gr','Gravity'),('E2','E2SFCA'),('M2','M2SFCA')) ms(c,n),
   (values ('jobTot','Jobs: All'),('jobEdu','Jobs: Low edu'),('jobWag','Jobs: Low wage'),('jobPOC','Jobs: POC'),
    ('poiTot','POIs: All'),('poiEdu','POIs: Education'),('poiGro','POIs: Groceries'),('poiMed','POIs: Medical'),
    ('poiSoc','POIs: Social Support'),('evStat','EVCI: Stations'),('evseL2','EVCI: Level 2'),('evseDC','EVCI: Fast DC')) k(c,n),
   (values ('Dr','Drive'),('Bi','Bike'),('Wa','Walk')) md(c,n), fx_t t where k.n not like 'EVCI%' or md.n='Drive') c
 left join (select measure as ms, kind, mode, thresh as th, count(*) as n, round(max(access),4) as m from vw_access_pipe group by 1,2,3,4) a
  on a.ms=c.measure and a.kind=c.kind and a.mode=c.mode and a.th=c.t""",
    _PIPE,
)
def catalog_coverage(i: Inputs) -> DataFrame:
    return rounded(export.catalog_coverage(pipeline_access(i)), 4)

# Files --------------------------------------------------------------------------------------------------------


@query(
    "city_csv_export",
    f"""select city, i.*, a.* exclude (geoid) from ({_INFO_SQL}) i join (
 select geoid, {_wide_sql(export.catalog_rows())} from vw_access group by geoid) a on a.geoid=i.geoid join fx_bg b on b.geoid=i.geoid""",
    CENTROID_VIEW,
)
def city_csv_export(i: Inputs) -> DataFrame:
    """The wide table, all catalog fields, as a gzip text folder per city, read back."""
    wide = export.access_wide(base_access(i, wide=True), info_zones(i))
    path = folder(i, "city-csv")
    writers.csv(wide.join(i.bg.select("geoid", "city"), "geoid"), path, ["city"], gzip=True)
    back = readers.delimited(i.spark, path, wide._jdf.schema().toDDL()).select(
        *wide.columns, F.url_decode(F.regexp_extract("_metadata.file_path", "city=([^/]+)/", 1)).alias("city")
    )
    return _wide_rounded(back)


@query(
    "od_unit_files",
    """select city, mode, level, count(*) as n, round(sum(time_min),3) as minutes from fx_od where time_min<=60 group by 1,2,3""",
)
def od_unit_files(i: Inputs) -> DataFrame:
    """A Parquet folder per unit, named by city, mode and level; one scan reads them all, with filter and columns."""
    path = folder(i, "od-units")
    unit = F.concat_ws("_", text.slug(F.col("city")), F.lower("mode"), F.lower("level"))
    writers.parquet(i.od.withColumn("unit", unit), path, ["unit"])
    rows = readers.parquet(i.spark, f"{path}/*", ["time_min", "_metadata"], F.col("time_min") <= 60)
    rows = readers.with_path_parts(rows, "unit=([^_/]+)_([^_/]+)_([^_/]+)/", ["city", "mode", "level"])
    out = rows.groupBy("city", "mode", "level").agg(F.count("*").alias("n"), F.sum("time_min").alias("minutes"))
    named = out.withColumns({"city": F.upper(text.title_from_slug(F.col("city"))), "mode": F.initcap("mode"), "level": F.upper("level")})
    return rounded(named, 3)


@query("text_block_list", "select geoid, code, name||' Cañon' as name from fx_ua_blocks")
def text_block_list(i: Inputs) -> DataFrame:
    """A pipe-delimited list in a one-byte encoding, ids without their leading zeros."""
    path = folder(i, "blocks")
    raw = i.ua_blocks.select(
        F.lit("1").alias("STATE"), F.col("geoid").cast("bigint").alias("GEOID"), F.concat("name", F.lit(" Cañon")).alias("NAME"),
        F.col("code").cast("int").alias("UACE"),
    )
    writers.csv(raw, path, sep="|", encoding="ISO-8859-1")
    return readers.urban_area_blocks(
        i.spark, path, "STATE string, GEOID string, NAME string, UACE string", {"GEOID": "geoid", "UACE": "code", "NAME": "name"}
    )


@query(
    "text_rejects",
    """select geoid, case h when 1 then geoid||',1' else geoid||',1,2,3' end as line from (
  select geoid, cast(substr(geoid,6,6) as int)%7 as h from fx_wac) a where h in (1,2)
 union all select geoid, geoid||',many,2' from (select geoid, cast(substr(geoid,6,6) as int)%7 as h from fx_wac) a where h=0""",
)
def text_rejects(i: Inputs) -> DataFrame:
    """Lines with a word for a number, a field too few or one too many; the others are read."""
    h = F.substring("geoid", 6, 6).cast("int") % 7
    line = F.when(h == 0, F.concat("geoid", F.lit(",many,2"))).when(h == 1, F.concat("geoid", F.lit(",1"))).when(
        h == 2, F.concat("geoid", F.lit(",1,2,3"))
    ).otherwise(F.concat("geoid", F.lit(",1,2")))
    path = folder(i, "lines")
    i.wac.select(line.alias("value")).write.text(path)
    rows, rejects = readers.checked_delimited(i.spark, path, "geoid string, c000 bigint, ce01 bigint", header=False)
    lost = rejects.select(F.substring_index("line", ",", 1).alias("geoid"), "line")
    # Lines in both tables or in none would show as rows here.
    return lost.unionByName(rows.join(lost, "geoid").select("geoid", F.lit("in both").alias("line")))


@query("gz_job_files", _JOBS)
def gz_job_files(i: Inputs) -> DataFrame:
    """Job counts from gzip text files per state, columns picked and renamed by a dictionary."""
    path = folder(i, "jobs")
    names = {"w_geocode": "geoid", "C000": "c000", "CE01": "ce01", "CR01": "cr01", "CD01": "cd01", "CD02": "cd02"}
    raw = i.wac.withColumnsRenamed({v: k for k, v in names.items()}).withColumn("state", F.substring("w_geocode", 1, 2))
    writers.csv(raw, path, ["state"], gzip=True)
    schema = ", ".join(f"{c} {'string' if c == 'w_geocode' else 'bigint'}" for c in raw.columns if c != "state")
    return opp.job_counts(readers.delimited(i.spark, f"{path}/*", schema, names))


@query(
    "level_file_bundle",
    "select geoid, level, kind, opport from fx_opport where cast(substr(geoid,5,1) as int)%2=0",
)
def level_file_bundle(i: Inputs) -> DataFrame:
    """A bundle with two files a level, of which the first by name counts."""
    path = folder(i, "bundle")
    half = F.when(F.substring("geoid", 5, 1).cast("int") % 2 == 0, "a_").otherwise("b_")
    writers.parquet(i.opport.withColumn("file", F.concat(half, "level")), path, ["file"])
    rows = readers.with_path_parts(readers.parquet(i.spark, f"{path}/*", ["*", "_metadata"]), "file=([^/]+)/", ["name"])
    names = rows.select("name").distinct().select(F.lit("all").alias("bundle"), "name")
    # One row a level.
    first = readers.one_file_per_level(names, ["BG", "County", "Tract"], ["bundle"]).select("name")
    return rows.join(first, "name", "left_semi").select("geoid", "level", "kind", "opport")


# Small operators ----------------------------------------------------------------------------------------------


@query(
    "renamed_tables",
    """select cast(r_regionkey as int) as id, cast(r_regionkey as varchar) as code, lower(r_name) as name from region""",
)
def renamed_tables(i: Inputs) -> DataFrame:
    """Upper-case prefixed names to plain ones, then types by dictionary."""
    upper = i.table("region").selectExpr("r_regionkey as R_ID", "r_regionkey as R_CODE", "lower(r_name) as R_NAME")
    plain = relational.strip_name_prefix(relational.lower_names(upper), "r_")
    return relational.cast_table(plain, {"id": "int", "code": "string", "name": "string"})


@query(
    "numeric_totals",
    """select county_id, cast(sum(k) as bigint) as k, cast(sum(popu) as bigint) as popu, cast(sum(labor) as bigint) as labor,
  cast(sum(aland) as bigint) as aland, cast(sum(awater) as bigint) as awater from fx_bg group by 1""",
)
def numeric_totals(i: Inputs) -> DataFrame:
    """All numeric columns, whatever they are, summed per county."""
    return i.bg.groupBy("county_id").agg(*[F.sum(c).cast("long").alias(c) for c in relational.numeric_columns(i.bg)])


@query("nonzero_zones", "select geoid, popu, labor, aland from fx_bg where popu<>0 and labor<>0 and aland<>0")
def nonzero_zones(i: Inputs) -> DataFrame:
    return relational.nonzero_rows(i.bg.select("geoid", "popu", "labor", "aland"), ["popu", "labor", "aland"])


@query("natural_join", "select o.geoid, o.level, kind, opport, county, popu from fx_opport o join vw_zones z on z.geoid=o.geoid and z.level=o.level")
def natural_join(i: Inputs) -> DataFrame:
    """Joined on all shared columns: geoid and level."""
    return relational.natural_join(i.opport, i.zones.select("geoid", "level", "county", "popu"))


@query(
    "first_station_per_county",
    """select county_id, id, open_date from (select substr(geoid,1,5) as county_id, id, open_date,
  row_number() over (partition by substr(geoid,1,5) order by open_date, id) as rn from vw_ev_at where open_date is not null) a where rn=1""",
)
def first_station_per_county(i: Inputs) -> DataFrame:
    """The station that opened first in each county cell."""
    x, y = "cast(round(lon * 2000000) as bigint)", "cast(round(lat * 1000000) as bigint) - 25000000"
    cell = i.ev_stations.where("open_date is not null").selectExpr(
        "id", "open_date", f"cast(({y}) div 4000000 * 5 + ({x} - ({y}) + 240000000) div 20000000 as int) as nk"
    )
    placed = cell.join(i.counties.select("nk", "county_id"), "nk")
    return rollup.first_per_key(placed, ["county_id"], ["open_date", "id"]).select("county_id", "id", "open_date")


@query(
    "unit_names",
    """select city, mode, replace(replace(lower(city),' ','-'),'.','')||'_'||lower(mode)||'_'||strftime(max(o_orderdate),'%Y%m%d-%H%M%S') as unit
 from (select distinct city, mode from fx_od) u, (select max(o_orderdate) as o_orderdate from orders) d group by 1,2""",
)
def unit_names(i: Inputs) -> DataFrame:
    """Name of each routed unit with the stamp of the last date."""
    last = i.table("orders").agg(F.max(F.col("o_orderdate").cast("timestamp")).alias("departure"))
    units = i.od.select("city", "mode").distinct().join(F.broadcast(last))  # a single row
    return units.select("city", "mode", text.unit_name(F.col("city"), F.col("mode"), F.col("departure")).alias("unit"))


@query(
    "zone_boxes",
    "select geoid, level, round((maxx-minx)*(maxy-miny),9) as area, round((minx+maxx)/2,6) as cx, round((miny+maxy)/2,6) as cy from vw_box",
)
def zone_boxes(i: Inputs) -> DataFrame:
    """The bounding box of each zone as a polygon of its own."""
    b = i.zone_shapes.select("geoid", "level", geo.bounds(F.col("geometry")).alias("b")).select("geoid", "level", "b.*")
    box = b.select("geoid", "level", geo.box(*[F.col(c) for c in ("minx", "miny", "maxx", "maxy")]).alias("box"))
    out = box.select("geoid", "level", geo.area(F.col("box")).alias("area"), geo.centroid(F.col("box")).alias("c"))
    return rounded(out.select("geoid", "level", "area", F.col("c.x").alias("cx"), F.col("c.y").alias("cy")), area=9)


# Shapes of several parts --------------------------------------------------------------------------------------


def lots(i: Inputs) -> DataFrame:
    return readers.with_geometry(i.lot_shapes)


@query(
    "multipolygon_measures",
    """select distinct lot, 3 as n_rings, 2 as n_parts, round((8000*3000-2000*1000+900*900)/1e12,12) as area,
  round(x/1e6,6) as minx, round(y/1e6,6) as miny, round((x+9900)/1e6,6) as maxx, round((y+3000)/1e6,6) as maxy,
  round((x+(24e6*4000-2e6*3000+81e4*9450)/(24e6-2e6+81e4))/1e6,6) as cx,
  round((y+(24e6*1500-2e6*1500+81e4*450)/(24e6-2e6+81e4))/1e6,6) as cy, true as same from fx_lots""",
)
def multipolygon_measures(i: Inputs) -> DataFrame:
    """Rings, parts, area, box and centroid of shapes with a hole and two parts, and whether their text reads back."""
    g = F.col("geometry")
    out = lots(i).select(
        "lot", F.size(g).alias("n_rings"), F.size(geo.polygon_parts(g)).alias("n_parts"), geo.area(g).alias("area"),
        geo.bounds(g).alias("b"), geo.centroid(g).alias("c"), (geo.parse_wkt(geo.to_wkt(g)) == g).alias("same"),
    )
    return rounded(
        out.select("lot", "n_rings", "n_parts", "area", "b.*", F.col("c.x").alias("cx"), F.col("c.y").alias("cy"), "same"), area=12
    )


@query(
    "points_in_multipolygons",
    """select id, lot from fx_lots where (dx<8000 and dy<3000 and not (dx>2000 and dx<4000 and dy>1000 and dy<2000))
  or (dx>9000 and dx<9900 and dy<900)""",
)
def points_in_multipolygons(i: Inputs) -> DataFrame:
    """Points in the parts and not in the hole, on a grid finer than the shapes."""
    zones = lots(i).select(F.col("lot"), F.lit("Lot").alias("level"), "geometry")
    return spatial.points_in_polygons(i.lot_points, zones, {"Lot": 0.0017}).select("id", "lot")


@query(
    "multipolygon_outline",
    """select nk, 12*count(*) as n_segments, sum(8000*2+3000*2+2000*2+1000*2+900*4)::bigint as length from (select distinct nk, lot from fx_lots) a group by 1""",
)
def multipolygon_outline(i: Inputs) -> DataFrame:
    """Outer and inner outline segments of all parts per county number, with their total length."""
    lines = dissolve.outline(lots(i).select("nk", "geometry"), ["nk"])
    length = F.sum(F.abs(F.col("x2") - F.col("x1")) + F.abs(F.col("y2") - F.col("y1")))
    return lines.groupBy("nk").agg(F.count("*").alias("n_segments"), length.alias("length"))
