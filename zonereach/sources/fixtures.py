"""Pipeline inputs derived from the star-schema tables.

Zones come from ``supplier`` (two block groups per tract, tracts dealt out over the counties of ``nation``),
block-level jobs and road segments from ``lineitem``, travel times from the (part, supplier) pairs of
``lineitem``, points from ``customer`` and ``orders``, feeds and tag lists from ``part``. Every view is a
projection or a keyed aggregate, so it grows with its table and holds no pair product.

Zone ids have the fixed width of the census codes, so ids repeat beyond the code space and the zone table
is an aggregate per id.

Geometry is a sheared lattice in integer micro-degrees: a county is a 10 x 4 degree cell, its tract codes
fill a 1000 x 1000 sub-lattice in blocks of 10 x 10, and the two block groups are halves of a tract.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window


TRACT_CODES = 1_000_000
# Lines whose pairs one task should hold: with three modes to a pair, some hundred megabytes to be sorted for a writer.
TASK_LINES = 250_000


def _geoid(k: str, rk: str) -> str:
    """SQL text of the block-group id of zone number ``k`` in region ``rk``."""
    return (
        f"concat(lpad(cast({rk} + 1 as string), 2, '0'), lpad(cast(({k} div 2) % 25 as string), 3, '0'),"
        f" lpad(cast((({k} div 2) div 25) % {TRACT_CODES} as string), 6, '0'), cast({k} % 2 + 1 as string))"
    )


def tract_cell(i: str) -> tuple[str, str]:
    """SQL of column and row of a tract code: even decimal digits give the column, odd ones the row."""
    d = [f"({i} div {10**p}) % 10" for p in range(6)]
    return f"{d[0]} + {d[2]} * 10 + {d[4]} * 100", f"{d[1]} + {d[3]} * 10 + {d[5]} * 100"


def with_geometry(zones: DataFrame) -> DataFrame:
    """Add ``geometry`` (rings) from ``geoid``: county, tract or block group by its width.

    The corner and size of the cell are integer micro-degrees; the shear adds half the northing.
    """
    col, row = tract_cell("_ti")
    corners = [("_x", "_y"), ("_x + _w", "_y"), ("_x + _w", "_y + _h"), ("_x", "_y + _h"), ("_x", "_y")]
    ring = ", ".join(
        f"struct(({x} + ({y} - 25000000) div 2) / 1000000 as x, ({y}) / 1000000 as y)" for x, y in corners
    )
    return (
        zones.selectExpr(
            "*",
            "cast(substring(geoid, 3, 3) as int) as _nk",
            "if(length(geoid) >= 11, cast(substring(geoid, 6, 6) as int), 0) as _ti",
            "if(length(geoid) = 12, cast(substring(geoid, 12, 1) as int) - 1, 0) as _half",
            "case length(geoid) when 5 then 10000000 when 11 then 10000 else 5000 end as _w",
            "case length(geoid) when 5 then 4000000 else 4000 end as _h",
        )
        .selectExpr(
            "*",
            f"-120000000 + _nk % 5 * 10000000 + ({col}) * 10000 + _half * 5000 as _x",
            f"25000000 + _nk div 5 * 4000000 + ({row}) * 4000 as _y",
        )
        .selectExpr(*zones.columns, f"array(array({ring})) as geometry")
    )


# Schemas already read, by path, so that a file's footer is read once per process.
_SCHEMAS: dict[str, object] = {}


class Inputs:
    """Lazy pipeline inputs over one data folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def table(self, name: str) -> DataFrame:
        path = f"{self.folder}/{name}.parquet"
        if path not in _SCHEMAS:
            _SCHEMAS[path] = self.spark.read.parquet(path).schema
        return self.spark.read.schema(_SCHEMAS[path]).parquet(path)

    @cached_property
    def counties(self) -> DataFrame:
        """25 counties: county_id, county, city, ua_code, rk, nk."""
        nation, region = self.table("nation"), self.table("region")
        return nation.join(region, nation.n_regionkey == region.r_regionkey).selectExpr(
            "n_nationkey as nk",
            "n_regionkey as rk",
            "n_name as county",
            "r_name as city",
            "concat(lpad(cast(n_regionkey + 1 as string), 2, '0'), lpad(cast(n_nationkey as string), 3, '0')) as county_id",
            "lpad(cast(n_regionkey * 1111 + 1 as string), 5, '0') as ua_code",
        )

    @cached_property
    def bg(self) -> DataFrame:
        """Block groups: geoid, county_id, county, city, ua_code, k, popu, labor, aland, awater (square metres)."""
        z = self.table("supplier").selectExpr(
            "s_suppkey as k",
            "cast((s_suppkey div 2) % 25 as int) as nk",
            "case when s_suppkey % 13 = 0 then 0 else 100 + s_suppkey % 700 end as popu",
            "case when s_suppkey % 17 = 0 then 0 else 50 + s_suppkey % 300 end as labor",
            "case when s_suppkey % 19 = 0 then 0 else (1000 + s_suppkey % 90 * 10) * 2590 end as aland",
            "s_suppkey % 50 * 2590 as awater",
        )
        return (
            z.join(self.counties, "nk")
            .withColumn("geoid", F.expr(_geoid("k", "rk")))
            .groupBy("geoid", "county_id", "county", "city", "ua_code")
            .agg(
                F.min("k").alias("k"),
                *[F.sum(c).cast("long").alias(c) for c in ("popu", "labor", "aland", "awater")],
            )
        )

    @cached_property
    def zones(self) -> DataFrame:
        """Zones at three levels: geoid, level, county, ua_code, city, aland, awater (sq mi), popu, labor."""
        from ..functions.units import sqm_to_sqmi
        from ..operators.rollup import prefix_rollup

        sums = ["aland", "awater", "popu", "labor"]
        flat = prefix_rollup(self.bg, sums, ("BG", "Tract", "County"), by=("county", "ua_code", "city"))
        miles = {c: sqm_to_sqmi(F.col(c)) for c in ("aland", "awater")}
        return flat.withColumns(miles).select("geoid", "level", "county", "ua_code", "city", *sums)

    @cached_property
    def zone_shapes(self) -> DataFrame:
        """``zones`` with their polygons."""
        return with_geometry(self.zones)

    @cached_property
    def wac(self) -> DataFrame:
        """Workplace blocks: geoid (15), c000, ce01, cr01, cd01, cd02. Lines are counted by numbers, and the ids spelt out then."""
        li = self.table("lineitem").selectExpr(
            "l_suppkey as k", "cast((l_suppkey div 2) % 25 as int) as nk", "l_linenumber", "l_returnflag",
            "l_linestatus", "l_quantity",
        )
        counts = (
            li.join(self.counties.select("nk", "rk"), "nk")
            .groupBy("rk", "k", "l_linenumber")
            .agg(
                F.count("*").alias("c000"),
                F.count_if(F.col("l_returnflag") == "R").alias("ce01"),
                F.count_if(F.col("l_linestatus") == "F").alias("cr01"),
                F.count_if(F.col("l_quantity") < 10).alias("cd01"),
                F.count_if((F.col("l_quantity") >= 10) & (F.col("l_quantity") < 20)).alias("cd02"),
            )
        )
        block = F.concat(F.expr(_geoid("k", "rk")), F.lpad(F.col("l_linenumber").cast("string"), 3, "0"))
        return counts.groupBy(block.alias("geoid")).agg(*[F.sum(c).alias(c) for c in ("c000", "ce01", "cr01", "cd01", "cd02")])

    @cached_property
    def ua_blocks(self) -> DataFrame:
        """Urban-area blocks: geoid, code, name; two line numbers belong to the neighbouring area."""
        names = self.table("region").selectExpr("r_regionkey as ua", "concat(r_name, '-Twin/Side, ST') as name")
        blocks = self.wac.selectExpr(
            "geoid",
            "(cast(substring(geoid, 1, 2) as int) - 1"
            " + case when substring(geoid, 13, 3) in ('003', '006') then 1 else 0 end) % 5 as ua",
        )
        return blocks.join(names, "ua").selectExpr(
            "geoid", "lpad(cast(ua * 1111 + 1 as string), 5, '0') as code", "name"
        )

    @cached_property
    def pair_tasks(self) -> int:
        """Tasks that the pairs are dealt out to, by the number of lines (which Parquet keeps in its footers).

        Rows multiply after that shuffle (modes, responses, text), so its bytes do not tell what a task will hold.
        """
        return max(self.spark.sparkContext.defaultParallelism, -(-self.table("lineitem").count() // TASK_LINES))

    def _with_city(self, pairs: DataFrame) -> DataFrame:
        """The city of each ``rk_s``; pairs are shuffled and grouped by numbers alone."""
        cities = self.counties.select(F.col("rk").alias("rk_s"), "city").distinct()
        return pairs.join(F.broadcast(cities), "rk_s")  # a row per region

    @cached_property
    def pair_numbers(self) -> DataFrame:
        """Distinct block-group pairs inside a region by their numbers: rk_s, ta, tb, za, zb, base, dist.

        ``ta`` and ``tb`` are the tracts of the block groups ``za`` and ``zb``. Pairs are dealt out by them, so those of a
        pair of tracts lie together. Only the two ends are dealt out; minutes and metres are made of them after that.
        """
        # Zone numbers repeat with the id space, so pairs are made distinct on two numbers before ids are spelt out.
        space = 50 * TRACT_CODES
        # 25 counties. The second end moves to the county of the first end's city that its own county number names.
        own_city = Window.partitionBy("rk")
        placed = self.counties.select(
            "nk", "rk", (F.row_number().over(own_city.orderBy("nk")) - 1).alias("pos"), F.count("*").over(own_city).alias("m")
        )
        near = placed.select(F.col("nk").alias("nk_s"), F.col("rk").alias("rk_s"), "m")
        far = placed.select(F.col("nk").alias("nk_t"), F.col("rk").alias("rk_t"), F.col("pos").alias("pos_t"))
        seen = (
            self.table("lineitem")
            .selectExpr("l_partkey div 20 as a", "l_suppkey as c")
            .selectExpr("a", "c", "cast((a div 2) % 25 as int) as nk_s")
            .join(near, "nk_s")
            .withColumn("pos", F.expr("(c div 2) % 25 % m"))
            .join(far, F.expr("rk_s = rk_t and pos = pos_t"))
            .selectExpr("rk_s", "a", "(c div 50 * 25 + nk_t) * 2 + c % 2 as b")
        )
        own = (
            self.table("supplier")
            .selectExpr("s_suppkey as a", "s_suppkey as b", "cast((s_suppkey div 2) % 25 as int) as nk_s")
            .join(near, "nk_s")
            .select("rk_s", "a", "b")
        )
        zones = F.expr(f"a % {space}"), F.expr(f"b % {space}")
        tracts = F.expr(f"a % {space} div 2"), F.expr(f"b % {space} div 2")
        return (
            seen.unionByName(own)
            .repartition(self.pair_tasks, "rk_s", *tracts)
            .groupBy("rk_s", tracts[0].alias("ta"), tracts[1].alias("tb"), zones[0].alias("za"), zones[1].alias("zb"))
            .agg(
                F.min(F.expr("if(a = b, 0L, (a * 31 + b * 17) % 1200)")).alias("base"),
                F.min(F.expr("(a * 13 + b * 7) % 5000 * 10")).alias("dist"),
            )
        )

    @cached_property
    def pairs(self) -> DataFrame:
        """Distinct (src, trg) block-group pairs inside a city: base tenth-minutes and metres."""
        return self._with_city(self.pair_numbers).selectExpr("city", f"{_geoid('za', 'rk_s')} as src", f"{_geoid('zb', 'rk_s')} as trg", "base", "dist")

    def _modes(self, pairs: DataFrame) -> DataFrame:
        return pairs.selectExpr(
            "city", "level", "src", "trg", "dist", "base", "stack(3, 'Drive', 1, 'Bike', 2, 'Walk', 3) as (mode, f)"
        ).selectExpr("city", "mode", "level", "src", "trg", "dist", "base * f as tenths")

    @cached_property
    def od_tenths(self) -> DataFrame:
        return self._modes(self.pairs.withColumn("level", F.lit("BG")))

    @cached_property
    def od(self) -> DataFrame:
        """Block-group travel times: city, mode, level, src, trg, dist, time_min (all durations)."""
        return self.od_tenths.withColumn("time_min", F.col("tenths") / 10).drop("tenths")

    @cached_property
    def pairs_levels(self) -> DataFrame:
        """Pairs at the three levels; a coarser pair has the whole mean of its child pairs: city, level, src, trg, base, dist."""
        fine = self.pairs.withColumn("level", F.lit("BG"))
        # Tracts are summed where their pairs lie, counties from a row per pair of tracts.
        tracts = self.pair_numbers.groupBy("rk_s", "ta", "tb").agg(
            F.sum("base").alias("base"), F.count("*").alias("n"), F.min("dist").alias("dist")
        )
        counties = tracts.groupBy("rk_s", F.expr("ta % 25").alias("ta"), F.expr("tb % 25").alias("tb")).agg(
            F.sum("base").alias("base"), F.sum("n").alias("n"), F.min("dist").alias("dist")
        )

        def spelt(sums: DataFrame, level: str, width: int) -> DataFrame:
            src, trg = (f"substring({_geoid(f'({t} * 2)', 'rk_s')}, 1, {width})" for t in ("ta", "tb"))
            return self._with_city(sums).selectExpr("city", f"'{level}' as level", f"{src} as src", f"{trg} as trg", "base div n as base", "dist")

        coarse = spelt(tracts, "Tract", 11).unionByName(spelt(counties, "County", 5))
        return fine.unionByName(coarse)

    @cached_property
    def od_levels(self) -> DataFrame:
        """Travel times at the three levels."""
        return self._modes(self.pairs_levels).withColumn("time_min", F.col("tenths") / 10).drop("tenths")

    # The times of a pair by mode, from its ``base``.
    TIMES = "array(%s)" % ", ".join(
        f"struct('{mode}' as mode, base * {f} / 10 as time_min)" for mode, f in (("Drive", 1), ("Bike", 2), ("Walk", 3))
    )

    @cached_property
    def base_levels(self) -> DataFrame:
        """The pairs of ``od_levels``, a row each: city, level, src, trg, base; ``TIMES`` makes their times of it."""
        return self.pairs_levels.select("city", "level", "src", "trg", "base")

    @cached_property
    def times_levels(self) -> DataFrame:
        """The times of ``od_levels`` with a row per pair: city, level, src, trg, times (an array of mode and time_min)."""
        return self.base_levels.selectExpr("city", "level", "src", "trg", f"{self.TIMES} as times")

    @cached_property
    def od_r5(self) -> DataFrame:
        """Second router: city, mode, level, src, trg, travel_time (whole minutes, NULL = unreachable)."""
        return self.od_tenths.selectExpr(
            "city", "mode", "level", "src", "trg",
            "case when (dist div 10) % 23 = 0 then null else cast(tenths * 105 div 1000 as int) end as travel_time",
        )

    @cached_property
    def opport_bg(self) -> DataFrame:
        """Opportunities per block group, positive counts only: geoid, level, kind, opport."""
        jobs = self.wac.selectExpr(
            "substring(geoid, 1, 12) as geoid",
            "stack(4, 'Jobs: All', c000, 'Jobs: Low wage', ce01, 'Jobs: Low edu', cd01 + cd02,"
            " 'Jobs: POC', c000 - cr01) as (kind, opport)",
        )
        places = self.bg.selectExpr(
            "geoid",
            "stack(3, 'POIs: All', 5 + k % 11, 'POIs: Medical', k % 4,"
            " 'EVCI: Stations', case when k % 6 = 0 then 1 + k % 3 else 0 end) as (kind, opport)",
        )
        return (
            jobs.unionByName(places)
            .groupBy("geoid", "kind")
            .agg(F.sum("opport").cast("long").alias("opport"))
            .where("opport > 0")
            .withColumn("level", F.lit("BG"))
        )

    @cached_property
    def opport(self) -> DataFrame:
        """Opportunities at block group, tract and county level."""
        from ..operators.rollup import prefix_rollup

        return prefix_rollup(self.opport_bg, ["opport"], ("BG", "Tract", "County"), by=("kind",))

    @cached_property
    def points(self) -> DataFrame:
        """Features with tags: id, lon, lat, tags (map). Some lie in gaps between zones."""
        key = "c_custkey"
        f = self.table("customer").selectExpr(
            f"{key} as id",
            "c_nationkey as nk",
            f"({key} div 750) % {TRACT_CODES} as ti",
            f"130 + {key} * 7919 % 9700 as fx",
            f"110 + {key} * 10473 % 2900 as fy",
            f"case {key} % 4 when 0 then 'amenity' when 1 then 'shop' when 2 then 'healthcare'"
            f" else if({key} % 8 = 7, 'social_facility', 'craft') end as tag",
            f"case {key} % 4 when 0 then case when {key} % 12 = 0 then 'school' else 'hospital' end"
            f" when 1 then case when {key} % 5 = 0 then 'supermarket' else 'books' end"
            " when 2 then 'doctor'"
            f" else if({key} % 8 = 7, 'food_bank', 'bakery') end as value",
            f"{key} % 12 = 4 as two_tags",
        )
        return self._place(f).select(
            "id", "lon", "lat",
            F.when(F.col("two_tags"), F.create_map("tag", "value", F.lit("healthcare"), F.lit("doctor")))
            .otherwise(F.create_map("tag", "value")).alias("tags"),
        )

    def _place(self, f: DataFrame) -> DataFrame:
        """Turn (nk, ti, fx, fy) into lon/lat at odd micro-degree offsets from the tract corner (never on an edge)."""
        col, row = tract_cell("ti")
        return f.selectExpr(
            "*",
            f"-120000000 + nk % 5 * 10000000 + ({col}) * 10000 + fx * 2 + 1 as x",
            f"25000000 + nk div 5 * 4000000 + ({row}) * 4000 + fy * 2 + 1 as y",
        ).selectExpr("*", "(x + (y - 25000000) / 2) / 1000000 as lon", "y / 1000000 as lat")

    def _tract_lots(self, columns: list[str]) -> DataFrame:
        """Customers with the corner (x, y) of their unsheared tract cell in micro-degrees."""
        col, row = tract_cell("ti")
        lots = self.table("customer").selectExpr(
            "c_custkey as id", "c_nationkey as nk", f"(c_custkey div 750) % {TRACT_CODES} as ti"
        )
        return lots.selectExpr(
            "id", "concat(nk, '-', ti) as lot", "nk",
            f"-120000000 + nk % 5 * 10000000 + ({col}) * 10000 as x", f"25000000 + nk div 5 * 4000000 + ({row}) * 4000 as y",
        ).selectExpr(*columns)

    @cached_property
    def lot_shapes(self) -> DataFrame:
        """Two-part shapes as text, one per tract lot: a rectangle with a hole, and a square apart from it.

        The shell of the first part and the hole are written clockwise, the second part counter-clockwise.
        """

        def ring(*corners: tuple[int, int]) -> str:
            spots = [f"concat((x + {dx}) / 1000000, ' ', (y + {dy}) / 1000000)" for dx, dy in (*corners, corners[0])]
            return "concat('(', " + ", ', ', ".join(spots) + ", ')')"

        shell = ring((0, 0), (0, 3000), (8000, 3000), (8000, 0))
        hole = ring((2000, 1000), (2000, 2000), (4000, 2000), (4000, 1000))
        apart = ring((9000, 0), (9900, 0), (9900, 900), (9000, 900))
        lots = self._tract_lots(["lot", "nk", "x", "y"]).distinct()
        return lots.selectExpr("lot", "nk", f"concat('MULTIPOLYGON ((', {shell}, ', ', {hole}, '), (', {apart}, '))') as wkt")

    @cached_property
    def lot_points(self) -> DataFrame:
        """A point per customer in its tract lot, half a micro-degree off the edges: id, lon, lat."""
        return self._tract_lots(
            ["id", "(x + id * 7919 % 9999 + 0.5D) / 1000000 as lon", "(y + id * 10473 % 3999 + 0.5D) / 1000000 as lat"]
        )

    @cached_property
    def ev_stations(self) -> DataFrame:
        """Charging stations: id, lon, lat, open_date, l2, fdc."""
        key = "o_orderkey"
        f = self.table("orders").selectExpr(
            f"{key} as id",
            f"cast({key} % 25 as int) as nk",
            f"({key} div 7500) % {TRACT_CODES} as ti",
            f"130 + {key} * 7919 % 4800 as fx",
            f"110 + {key} * 10473 % 2300 as fy",
            f"case when {key} % 19 = 0 then null else cast(o_orderdate as date) end as open_date",
            f"case when {key} % 3 = 0 then null else {key} % 7 end as l2",
            f"case when {key} % 5 = 0 then null else {key} % 3 end as fdc",
        )
        return self._place(f).select("id", "lon", "lat", "open_date", "l2", "fdc")

    @cached_property
    def tag_list(self) -> DataFrame:
        """Industry code list with ``tag=value OR tag=value`` text: naics, description, osm."""
        return self.table("part").selectExpr(
            "p_partkey as naics",
            "p_name as description",
            "case p_partkey % 7 when 0 then 'amenity=school OR amenity=kindergarten'"
            " when 1 then 'amenity=hospital OR healthcare=doctor' when 2 then 'healthcare=doctor'"
            " when 3 then 'shop=supermarket' when 4 then 'shop=books OR office=company'"
            " when 5 then 'healthcare:speciality=chiropractic'"
            " else if(p_partkey % 2 = 0, 'social_facility=food_bank', null) end as osm",
        )

    @cached_property
    def feeds(self) -> DataFrame:
        """Transit feed catalog: mdb_id, country_code, status, url, minx, miny, maxx, maxy."""
        key = "p_partkey"
        return self.table("part").selectExpr(
            f"{key} as mdb_id",
            f"case when {key} % 4 = 0 then 'CA' else 'US' end as country_code",
            f"case {key} % 5 when 0 then 'inactive' when 1 then 'deprecated' when 2 then 'active' else null end as status",
            f"concat('http://feed.example.com/', {key}, case when {key} % 7 = 0 then '.php' else '.zip' end) as url",
            f"case when {key} % 41 = 0 then null else ({key} * 7919 % 50000) / 1000 - 121 end as minx",
            f"({key} * 10473 % 20000) / 1000 + 24 as miny",
            f"({key} * 7919 % 50000) / 1000 - 121 + p_size / 10 as maxx",
            f"({key} * 10473 % 20000) / 1000 + 24 + p_size / 20 as maxy",
        )

    @cached_property
    def ses(self) -> DataFrame:
        """Socio-economic columns per block group."""
        return self.bg.selectExpr(
            "geoid", "popu", "(k * 37 % 9000) / 100 as p_poc", "20000 + k * 811 % 90000 as m_income",
            "(k * 53 % 4000) / 100 as p_pov", "(k * 71 % 7000) / 100 as p_renter", "(k * 29 % 2500) / 100 as p_noveh",
        )

    @cached_property
    def roads(self) -> DataFrame:
        """Road segments: seg_id, aadt, f_system, speed_limit, urban_code (integer)."""
        return self.table("lineitem").selectExpr(
            "l_orderkey * 10 + l_linenumber as seg_id",
            "cast(floor(l_extendedprice) as bigint) as aadt",
            "l_linenumber as f_system",
            "cast(floor(l_quantity) as int) % 5 * 10 + 25 as speed_limit",
            "cast(case when l_suppkey % 9 = 0 then 99999 when l_suppkey % 9 = 1 then 99998 when l_suppkey % 9 = 2 then 0"
            " else l_suppkey % 5 * 1111 + 1 end as int) as urban_code",
        )
