"""SQL definitions of the derived inputs, as common table expressions for the checking engine."""

from __future__ import annotations

import re


def _geoid(k: str, rk: str) -> str:
    return (
        f"lpad(cast({rk}+1 as varchar),2,'0')||lpad(cast((({k})//2)%25 as varchar),3,'0')"
        f"||lpad(cast(((({k})//2)//25)%1000000 as varchar),6,'0')||cast(({k})%2+1 as varchar)"
    )


def _origin(nk: str) -> tuple[str, str]:
    return f"(-120000000+({nk})%5*10000000)", f"(25000000+({nk})//5*4000000)"


def _cell(i: str) -> tuple[str, str]:
    d = [f"((({i})//{10**p})%10)" for p in range(6)]
    return f"({d[0]}+10*{d[2]}+100*{d[4]})", f"({d[1]}+10*{d[3]}+100*{d[5]})"


_X0, _Y0 = _origin("nk")
_COL, _ROW = _cell("ti")

VIEWS: dict[str, str] = {
    "fx_county": """
 select n_nationkey as nk, n_regionkey as rk, n_name as county, r_name as city,
  lpad(cast(n_regionkey+1 as varchar),2,'0')||lpad(cast(n_nationkey as varchar),3,'0') as county_id,
  lpad(cast(n_regionkey*1111+1 as varchar),5,'0') as ua_code
 from nation join region on n_regionkey=r_regionkey""",
    "fx_bg": f"""
 select {_geoid('k', 'rk')} as geoid, county_id, county, city, ua_code, min(k) as k,
  cast(sum(popu) as bigint) as popu, cast(sum(labor) as bigint) as labor,
  cast(sum(aland) as bigint) as aland, cast(sum(awater) as bigint) as awater
 from (select s_suppkey as k, (s_suppkey//2)%25 as nk,
   case when s_suppkey%13=0 then 0 else 100+s_suppkey%700 end as popu,
   case when s_suppkey%17=0 then 0 else 50+s_suppkey%300 end as labor,
   case when s_suppkey%19=0 then 0 else (1000+s_suppkey%90*10)*2590 end as aland,
   s_suppkey%50*2590 as awater from supplier) s join fx_county using (nk)
 group by 1,2,3,4,5""",
    "fx_wac": f"""
 select {_geoid('l_suppkey', 'rk')}||lpad(cast(l_linenumber as varchar),3,'0') as geoid, count(*) as c000,
  count(*) filter (l_returnflag='R') as ce01, count(*) filter (l_linestatus='F') as cr01,
  count(*) filter (l_quantity<10) as cd01, count(*) filter (l_quantity>=10 and l_quantity<20) as cd02
 from lineitem join fx_county on nk=(l_suppkey//2)%25 group by 1""",
    "fx_ua_blocks": """
 select geoid, lpad(cast(ua*1111+1 as varchar),5,'0') as code, r_name||'-Twin/Side, ST' as name
 from (select geoid, (cast(substr(geoid,1,2) as int)-1+case when substr(geoid,13,3) in ('003','006') then 1 else 0 end)%5
        as ua from fx_wac) join region on r_regionkey=ua""",
    "fx_pairs": f"""
 select city, src, trg, min(base) as base, min(dist) as dist from (
  select city, {_geoid('a', 'rk')} as src, {_geoid('b', 'rk')} as trg,
    case when a=b then 0 else (a*31+b*17)%1200 end as base, (a*13+b*7)%5000*10 as dist
  from (select a, rk, city, (c//50*25+nk_t)*2+c%2 as b from (
     select l_partkey//20 as a, l_suppkey as c, s.rk, s.city, (l_suppkey//2)%25%s.m as pos
     from lineitem join (select *, count(*) over (partition by rk) as m from fx_county) s on s.nk=(l_partkey//20//2)%25) l
    join (select nk as nk_t, rk as rk_t, row_number() over (partition by rk order by nk)-1 as pos_t from fx_county) t
     on rk_t=rk and pos_t=pos) ca
  union all select city, geoid, geoid, 0, k*20%5000*10 from fx_bg) p
 group by 1,2,3""",
    "fx_mode": """
 select * from (values ('Drive',1),('Bike',2),('Walk',3)) m(mode,f)""",
    "fx_od": """
 select city, mode, 'BG' as level, src, trg, dist, base*f as tenths, base*f/10 as time_min from fx_pairs, fx_mode""",
    "fx_od_levels": """
 select city, mode, level, src, trg, dist, base*f/10 as time_min from (
  select city, 'BG' as level, src, trg, base, dist from fx_pairs
  union all select city, level, substr(src,1,n), substr(trg,1,n), cast(sum(base)//count(*) as bigint), min(dist)
   from fx_pairs, (values ('Tract',11),('County',5)) v(level,n) group by 1,2,3,4) q, fx_mode""",
    "fx_od_r5": """
 select city, mode, level, src, trg,
  case when (dist//10)%23=0 then null else cast(tenths*105//1000 as int) end as travel_time from fx_od""",
    "fx_opport_bg": """
 select geoid, 'BG' as level, kind, cast(sum(v) as bigint) as opport from (
  select substr(geoid,1,12) as geoid, 'Jobs: All' as kind, c000 as v from fx_wac
  union all select substr(geoid,1,12), 'Jobs: Low wage', ce01 from fx_wac
  union all select substr(geoid,1,12), 'Jobs: Low edu', cd01+cd02 from fx_wac
  union all select substr(geoid,1,12), 'Jobs: POC', c000-cr01 from fx_wac
  union all select geoid, 'POIs: All', 5+k%11 from fx_bg
  union all select geoid, 'POIs: Medical', k%4 from fx_bg
  union all select geoid, 'EVCI: Stations', case when k%6=0 then 1+k%3 else 0 end from fx_bg) t
 group by 1,2,3 having sum(v)>0""",
    "fx_level": """
 select * from (values ('BG',12),('Tract',11),('County',5)) l(level,width)""",
    "fx_opport": """
 select substr(o.geoid,1,width) as geoid, l.level, kind, cast(sum(opport) as bigint) as opport
 from fx_opport_bg o, fx_level l group by 1,2,3""",
    "fx_size": """
 select substr(geoid,1,width) as geoid, level, cast(sum(popu) as bigint) as popu, cast(sum(labor) as bigint) as labor
 from fx_bg, fx_level group by 1,2""",
    "fx_points": f"""
 select id, nk, ti, fx, fy, (x+(y-25000000)/2)/1000000 as lon, y/1000000 as lat, tag, value, two_tags from (
  select *, {_X0}+{_COL}*10000+fx*2+1 as x, {_Y0}+{_ROW}*4000+fy*2+1 as y from (
   select c_custkey as id, c_nationkey as nk, (c_custkey//750)%1000000 as ti,
    130+c_custkey*7919%9700 as fx, 110+c_custkey*10473%2900 as fy,
    case c_custkey%4 when 0 then 'amenity' when 1 then 'shop' when 2 then 'healthcare'
     else case when c_custkey%8=7 then 'social_facility' else 'craft' end end as tag,
    case c_custkey%4 when 0 then case when c_custkey%12=0 then 'school' else 'hospital' end
     when 1 then case when c_custkey%5=0 then 'supermarket' else 'books' end
     when 2 then 'doctor' else case when c_custkey%8=7 then 'food_bank' else 'bakery' end end as value,
    c_custkey%12=4 as two_tags from customer) c) d""",
    "fx_lots": f"""
 select id, nk||'-'||ti as lot, nk, {_X0}+{_COL}*10000 as x, {_Y0}+{_ROW}*4000 as y, id*7919%9999+0.5 as dx, id*10473%3999+0.5 as dy
 from (select c_custkey as id, c_nationkey as nk, (c_custkey//750)%1000000 as ti from customer) c""",
    "fx_ev": f"""
 select id, nk, ti, fx, fy, (x+(y-25000000)/2)/1000000 as lon, y/1000000 as lat, open_date, l2, fdc from (
  select *, {_X0}+{_COL}*10000+fx*2+1 as x, {_Y0}+{_ROW}*4000+fy*2+1 as y from (
   select o_orderkey as id, o_orderkey%25 as nk, (o_orderkey//7500)%1000000 as ti,
    130+o_orderkey*7919%4800 as fx, 110+o_orderkey*10473%2300 as fy,
    case when o_orderkey%19=0 then null else cast(o_orderdate as date) end as open_date,
    case when o_orderkey%3=0 then null else o_orderkey%7 end as l2,
    case when o_orderkey%5=0 then null else o_orderkey%3 end as fdc from orders) c) d""",
    "fx_tag_list": """
 select p_partkey as naics, p_name as description,
  case p_partkey%7 when 0 then 'amenity=school OR amenity=kindergarten' when 1 then 'amenity=hospital OR healthcare=doctor'
   when 2 then 'healthcare=doctor' when 3 then 'shop=supermarket' when 4 then 'shop=books OR office=company'
   when 5 then 'healthcare:speciality=chiropractic' else case when p_partkey%2=0 then 'social_facility=food_bank' end end as osm from part""",
    "fx_feeds": """
 select p_partkey as mdb_id, case when p_partkey%4=0 then 'CA' else 'US' end as country_code,
  case p_partkey%5 when 0 then 'inactive' when 1 then 'deprecated' when 2 then 'active' else null end as status,
  'http://feed.example.com/'||cast(p_partkey as varchar)||case when p_partkey%7=0 then '.php' else '.zip' end as url,
  case when p_partkey%41=0 then null else (p_partkey*7919%50000)/1000-121 end as minx,
  (p_partkey*10473%20000)/1000+24 as miny,
  (p_partkey*7919%50000)/1000-121+p_size/10 as maxx, (p_partkey*10473%20000)/1000+24+p_size/20 as maxy from part""",
    "fx_ses": """
 select geoid, popu, (k*37%9000)/100 as p_poc, 20000+k*811%90000 as m_income, (k*53%4000)/100 as p_pov,
  (k*71%7000)/100 as p_renter, (k*29%2500)/100 as p_noveh from fx_bg""",
    "fx_roads": """
 select l_orderkey*10+l_linenumber as seg_id, cast(floor(l_extendedprice) as bigint) as aadt, l_linenumber as f_system,
  cast(floor(l_quantity) as int)%5*10+25 as speed_limit,
  cast(case when l_suppkey%9=0 then 99999 when l_suppkey%9=1 then 99998 when l_suppkey%9=2 then 0
   else l_suppkey%5*1111+1 end as int) as urban_code from lineitem""",
    "fx_imp": """
 select * from (values ('Drive','Work',-0.007127::double,1.501453::double),('Drive','Non-work',-0.020097,1.361630),
  ('Walk','Work',-0.053588,1.085346),('Walk','Non-work',-0.058269,1.007449),('Bike','Work',-0.007653,1.591415),
  ('Bike','Non-work',-0.028080,1.145222)) i(mode,purpose,alpha,beta)""",
    "fx_t": """
 select * from (values (15),(30),(45),(60),(90)) t(thresh)""",
}


def located(view: str) -> str:
    """Rows of a point view with the block group that holds them, by lattice arithmetic on lon/lat."""
    x = "(cast(round(lon*2000000) as bigint)-(cast(round(lat*1000000) as bigint)-25000000))"  # doubled
    return f"""
 select p.*, county_id||lpad(cast(c%10+10*(r%10)+100*(c//10%10)+1000*(r//10%10)+10000*(c//100)+100000*(r//100)
   as varchar),6,'0')||cast(h+1 as varchar) as geoid
 from (select *, (yy//4000000)*5+xx//20000000 as cell, xx%20000000//20000 as c, yy%4000000//4000 as r,
        xx%20000//10000 as h
       from (select *, {x}+240000000 as xx, cast(round(lat*1000000) as bigint)-25000000 as yy from {view}) a) p
 join fx_county q on q.nk=p.cell"""


def _weighted(od: str) -> str:
    return f"""
 select o.city, o.mode, o.level, src, trg, time_min, exp(a.alpha*pow(time_min,a.beta)) as w_work,
  exp(b.alpha*pow(time_min,b.beta)) as w_non
 from {od} o join fx_imp a on a.mode=o.mode and a.purpose='Work' join fx_imp b on b.mode=o.mode and b.purpose='Non-work'
 where time_min<=90"""


def _demand(w: str, demand: str = "destination") -> str:
    end = "trg" if demand == "destination" else "src"
    return f"""
 select city, mode, w.level, trg, thresh, sum(labor*w_work) as d_work, sum(popu*w_non) as d_non
 from {w} w join fx_t on time_min<=thresh join fx_size z on z.geoid={end} and z.level=w.level group by 1,2,3,4,5"""


def _access(w: str, d: str, zero: bool = False, opport: str = "fx_opport") -> str:
    served = "d_work>0 and d_non>0"
    keep = "" if zero else f"and {served}"
    return f"""
 select unnest(['Contour','Gravity','E2SFCA','M2SFCA']) as measure, kind, mode, thresh, level, city, geoid,
  unnest([co,gr,e2,m2]) as access from (
  select kind, w.mode, d.thresh, w.level, w.city, src as geoid, cast(sum(opport) as double) as co, sum(opport*wt) as gr,
   sum(case when {served} then opport/dd end) as e2, sum(case when {served} then opport*wt/dd end) as m2
  from (select *, case when kind like 'Jobs%' then w_work else w_non end as wt from {w} w
        join {opport} o on o.geoid=w.trg and o.level=w.level) w
  join (select d.*, p.purpose, case when purpose='Work' then d_work else d_non end as dd
        from {d} d, (values ('Work'),('Non-work')) p(purpose)) d
   on d.trg=w.trg and d.mode=w.mode and d.level=w.level and d.thresh>=time_min {keep}
   and d.purpose=case when kind like 'Jobs%' then 'Work' else 'Non-work' end
  group by 1,2,3,4,5,6) s"""


VIEWS |= {
    "vw_w": _weighted("fx_od"),
    "vw_wl": _weighted("fx_od_levels"),
    "vw_d": _demand("vw_w"),
    "vw_dl": _demand("vw_wl"),
    "vw_do": _demand("vw_w", "origin"),
    "vw_access": f"select * from ({_access('vw_w', 'vw_d')}) a where access>0",
    "vw_access_levels": f"select * from ({_access('vw_wl', 'vw_dl')}) a where access>0",
    "vw_access_origin": f"select * from ({_access('vw_w', 'vw_do')}) a where access>0",
    "vw_access_zero": f"select * from ({_access('vw_w', 'vw_d', zero=True)}) a where access>0",
    "vw_zones": """
 select substr(geoid,1,width) as geoid, level, county, ua_code, city, sum(aland)/2.59e6 as aland,
  sum(awater)/2.59e6 as awater, cast(sum(popu) as bigint) as popu, cast(sum(labor) as bigint) as labor
 from fx_bg, fx_level group by 1,2,3,4,5""",
    "vw_lattice": f"""
 select geoid, level, {_origin("cast(substr(geoid,3,3) as int)")[0]}+case when level='County' then 0 else cc*10000 end
   +case when level='BG' then half*5000 else 0 end as x,
  {_origin("cast(substr(geoid,3,3) as int)")[1]}+case when level='County' then 0 else rr*4000 end as y,
  case level when 'County' then 10000000 when 'Tract' then 10000 else 5000 end as w,
  case level when 'County' then 4000000 else 4000 end as h, cc, rr, half, substr(geoid,1,5) as county_id
 from (select *, {_cell("ti")[0]} as cc, {_cell("ti")[1]} as rr from (
   select geoid, level, coalesce(try_cast(substr(geoid,6,6) as int),0) as ti,
    coalesce(try_cast(substr(geoid,12,1) as int),1)-1 as half from vw_zones) a) b""",
    "vw_corner": """
 select geoid, level, x+(y-25000000)//2 as x1, y as y1, x+w+(y-25000000)//2 as x2, y as y2,
  x+w+(y+h-25000000)//2 as x3, y+h as y3, x+(y+h-25000000)//2 as x4, y+h as y4 from vw_lattice""",
    "vw_box": """
 select geoid, level, least(x1,x4)/1e6 as minx, y1/1e6 as miny, greatest(x2,x3)/1e6 as maxx, y3/1e6 as maxy
 from vw_corner""",
    "vw_edge": """
 select geoid, level, x1, y1, x2, y2 from vw_corner
 union all select geoid, level, x2, y2, x3, y3 from vw_corner
 union all select geoid, level, x4, y4, x3, y3 from vw_corner
 union all select geoid, level, x1, y1, x4, y4 from vw_corner""",
    "vw_points_at": located("fx_points"),
    "vw_ev_at": located("fx_ev"),
}


def with_views(sql: str, extra: dict[str, str] | None = None) -> str:
    """Prefix ``sql`` with the views it names, in dependency order."""
    views = VIEWS | (extra or {})
    order: list[str] = []

    def visit(text: str) -> None:
        for name in re.findall(r"\b(?:fx|vw)_\w+", text):
            if name in views and name not in order:
                visit(views[name])
                order.append(name)

    visit(sql)
    if not order:
        return sql
    ctes = ",\n".join(f"{n} as materialized ({views[n]})" for n in order)
    # A text that opens with a comma brings further (recursive) tables of its own.
    return f"with recursive {ctes}\n{sql}"
