"""Travel times landed where later joins need them."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.impedance import with_weights
from ..functions.text import LEVEL_WIDTH
from ..operators.ranking import id_positions
from ..session import Scratch
from ..sources.unit_store import fingerprints
from . import access as acc

PLACE = ["city", "level", "block"]
UNIT = list(acc.UNIT)
# Groups of near targets that a block has at least, so that blocks come out of a size.
GROUPS = 8


def with_bounds(od: DataFrame, blocks: DataFrame, scratch: Scratch) -> DataFrame:
    """``blocks`` (city, level, blocks) with ``bounds``: where in the order of the targets' ids the next block begins.

    Ids are prefix codes, so targets that follow each other are neighbours, which the same sources reach. Blocks of whole
    neighbourhoods give a source partial sums in few blocks, not in all of them. Pairs are counted by a beginning of the
    target's id, the shortest whose groups are below a ``GROUPS``-th of a block; those counts are what is put in order.
    NULL where there is none, since too many pairs have one target.
    """
    cut, found = blocks.where("blocks > 1"), []
    for width in range(LEVEL_WIDTH["County"], LEVEL_WIDTH["BG"]):
        if cut.isEmpty():
            break
        cut = cut.withColumnsRenamed({"city": "_city", "level": "_level"})
        same = od["city"].eqNullSafe(cut["_city"]) & od["level"].eqNullSafe(cut["_level"])
        near = od.join(F.broadcast(cut), same)  # a row per city and level
        near = near.groupBy("city", "level", "blocks", F.substring("trg", 1, width).alias("near"))
        near = scratch.table(near.agg(F.count("*").alias("n")), f"near-{width}")
        sizes = near.groupBy("city", "level", "blocks").agg(F.max("n").alias("most"), F.sum("n").alias("all"), F.count("*").alias("groups"))
        fine = F.col("most") * GROUPS * F.col("blocks") <= F.col("all")
        own = Window.partitionBy("city", "level")
        up_to = F.sum("n").over(own.orderBy("near").rowsBetween(Window.unboundedPreceding, 0))
        placed = near.join(F.broadcast(sizes.where(fine)), ["city", "level", "blocks"]).withColumn(
            "block", F.floor((up_to - F.col("n")) * F.col("blocks") / F.col("all"))
        )
        starts = placed.groupBy("city", "level", "block").agg(F.min("near").alias("start"))
        starts = starts.withColumn("start", F.when(F.col("block") > 0, F.col("start")))
        found.append(starts.groupBy("city", "level").agg(F.array_sort(F.collect_list("start")).alias("bounds")))
        # Where most groups are small by now and one is not, a longer beginning only adds groups.
        cut = sizes.where(~fine & (F.col("groups") < 64 * GROUPS * F.col("blocks"))).select("city", "level", "blocks")
    if not found:
        return blocks.withColumn("bounds", F.lit(None).cast("array<string>"))
    return blocks.join(reduce(DataFrame.unionByName, found), ["city", "level"], "left")


# The number of bounds up to the target's id, found by halving.
_FOUND = """aggregate(sequence(1, int(ceil(log2(size(bounds) + 1)))), struct(0 as lo, size(bounds) as hi), (s, _) -> if(s.lo >= s.hi, s,
 if(bounds[int((s.lo + s.hi) div 2)] <= trg, struct(int((s.lo + s.hi) div 2) + 1 as lo, s.hi as hi), struct(s.lo as lo, int((s.lo + s.hi) div 2) as hi))), s -> s.lo)"""


def block_of_target() -> Column:
    """Block of ``trg`` by the ``blocks`` and ``bounds`` of its city and level; by a hash where there are no bounds."""
    by_hash = F.pmod(F.xxhash64("trg"), F.coalesce("blocks", F.lit(1))).cast("int")
    return F.when(F.col("bounds").isNull() | F.col("trg").isNull(), by_hash).when(F.size("bounds") == 0, F.lit(0)).otherwise(F.expr(_FOUND))


class TravelTable:
    """Travel times in a table bucketed by city, level and block of targets.

    The targets of a (city, level) are cut into as many blocks as its pairs need, so a bucket holds few millions of
    pairs whatever the size of a city, and a target's pairs of all modes lie in one bucket. A block has whole
    neighbourhoods (``with_bounds``), so a source has partial sums in few of them. Sums by destination, joins
    with one row per destination and joins of two such tables then move no pairs. ``units`` keeps the number of pairs and
    a fingerprint of each unit. The table outlasts the session: open it again by its path.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self.name = f"travel_times_{hashlib.md5(path.encode()).hexdigest()[:16]}"
        if not spark.catalog.tableExists(self.name):
            shape = spark.read.parquet(f"{path}/shape").first()
            spark.sql(
                f"create table {self.name} ({shape.columns}) using parquet clustered by ({', '.join(PLACE)})"
                f" into {shape.buckets} buckets location '{path}/pairs'"
            )

    @classmethod
    def write(
        cls, od: DataFrame, path: str, like: TravelTable | None = None, block_pairs: int = acc.BLOCK_PAIRS, least_buckets: int = 8,
        each: str | None = None, of: Sequence[str] | None = None,
    ) -> TravelTable:
        """Land ``od`` (city, mode, level, src, trg, time_min, more); with ``like``, in the blocks and buckets of that table.

        ``each`` is an array of structs whose fields are columns too (mode and time_min, for one): a pair is then written
        down and dealt out as one row, and its array becomes rows after that. It is a column of ``od`` or an expression, of
        columns ``of`` that do not land themselves.
        """
        spark = od.sparkSession
        scratch = Scratch(spark, "landing")
        od = scratch.table(od, "od")  # for counting and for dealing out

        def rows(df: DataFrame) -> DataFrame:
            return df if each is None else df.select(*[c for c in df.columns if c not in (of or [each])], F.inline(F.expr(each)))

        columns = rows(od).columns
        first = [c for c in (*UNIT, "src", "trg", "time_min") if c in columns]
        columns = [*first, *[c for c in columns if c not in first]]
        scratch.table(fingerprints(rows(od).select(*columns)), "units").write.parquet(f"{path}/units")
        units = spark.read.parquet(f"{path}/units")
        if like is None:
            total = units.agg(F.sum("pairs")).first()[0] or 0
            buckets = max(least_buckets, -(-total // block_pairs))
            sizes = units.groupBy("city", "level").agg(F.sum("pairs").alias("n"))
            blocks = sizes.select("city", "level", F.ceil(F.col("n") / block_pairs).alias("blocks"))
            blocks = with_bounds(od, scratch.table(blocks, "blocks"), scratch)
            blocks.coalesce(1).write.parquet(f"{path}/blocks")
            blocks = spark.read.parquet(f"{path}/blocks")
        else:
            buckets, blocks = like.buckets, like.blocks
            blocks.coalesce(1).write.parquet(f"{path}/blocks")
        dealt = (
            od.join(blocks, ["city", "level"], "left")
            .withColumn("block", block_of_target())
            .select(*od.columns, "block")
            # A task a bucket, so a bucket is one file.
            .repartition(buckets, *PLACE)
        )
        # Pairs are put in order before their array becomes rows; a bucket's file keeps that order.
        dealt = rows(dealt.sortWithinPartitions(*PLACE)).select(*columns, "block")
        shape = ", ".join(f"`{c}` {t}" for c, t in dealt.dtypes)
        spark.createDataFrame([(shape, buckets)], "columns string, buckets int").coalesce(1).write.parquet(f"{path}/shape")
        table = cls(spark, path)
        (
            dealt.write.format("parquet")
            .mode("append")
            .bucketBy(buckets, *PLACE)
            .saveAsTable(table.name)
        )
        scratch.drop(od)
        return table

    @property
    def buckets(self) -> int:
        return self.spark.read.parquet(f"{self.path}/shape").first().buckets

    @property
    def blocks(self) -> DataFrame:
        blocks = self.spark.read.parquet(f"{self.path}/blocks")
        # Tables of before had blocks by the whole id.
        return blocks if "bounds" in blocks.columns else blocks.withColumn("bounds", F.lit(None).cast("array<string>"))

    @property
    def units(self) -> DataFrame:
        """city, mode, level, pairs, fingerprint."""
        return self.spark.read.parquet(f"{self.path}/units")

    def rows(self) -> DataFrame:
        return self.spark.table(self.name)

    def close(self) -> None:
        """Forget the table's name; its files stay."""
        if self.spark.sparkContext._jsc is not None:
            self.spark.sql(f"drop table if exists {self.name}")

    def pairs(self, where: Column | None = None, max_time: float | None = None, params: DataFrame | None = None) -> DataFrame:
        """Weighted pairs as they lie: city, mode, level, block, src, trg, time_min, w_work, w_non."""
        rows = self.rows()
        rows = rows if max_time is None else rows.where(F.col("time_min") <= max_time)
        rows = rows if where is None else rows.where(where)
        return with_weights(rows, params).select(*UNIT, "block", "src", "trg", "time_min", "w_work", "w_non")

    def access(self, opport: DataFrame, zones: DataFrame, where: Column | None = None, **options) -> DataFrame:
        """``plans.access.access`` over the pairs of ``where``, without moving them."""
        thresholds = options.get("thresholds", acc.THRESHOLDS)
        return self.access_of(self.pairs(where, max(thresholds), options.pop("params", None)), opport, zones, **options)

    def access_of(self, pairs: DataFrame, opport: DataFrame, zones: DataFrame, **options) -> DataFrame:
        """The same over some of ``pairs()``, still lying as they lay."""
        return acc.placed_access(pairs, (self.buckets, *PLACE), opport, zones, **options)

    def cross_modal_access(self, opport: DataFrame, zones: DataFrame, where: Column | None = None, **options) -> DataFrame:
        """``plans.access.cross_modal_access``; all modes of a target lie together."""
        thresholds = options.get("thresholds", acc.THRESHOLDS)
        pairs = self.pairs(where, max(thresholds), options.pop("params", None))
        return acc.placed_cross_modal(pairs, (self.buckets, *PLACE), opport, zones, **options)

    def contour_jobs(self, jobs: DataFrame, thresholds=acc.THRESHOLDS) -> DataFrame:
        """``plans.access.contour_jobs``: the jobs come to the pairs, one row per destination and mode."""
        od = self.rows().where(F.col("time_min") <= max(thresholds))
        ends = od.select(*UNIT, "block", "trg").distinct().join(jobs.withColumnRenamed("geoid", "trg"), "trg")
        ends = ends.repartition(self.buckets, *PLACE)
        return acc.contour_sums(od.join(ends, [*UNIT, "block", "trg"]), thresholds)

    def compact_codes(self, where: Column | None = None) -> DataFrame:
        """city, mode, level, from_id, to_id, time: ids as dense codes per unit and side, minutes cut to int.

        The codes of the ids come to the blocks that have them, so the pairs are joined where they lie.
        """
        scratch = Scratch(self.spark, "codes")
        rows = self.rows() if where is None else self.rows().where(where)

        def coded(end: str, name: str) -> DataFrame:
            # The ids of each block are found in place; only these are ranked and sent back.
            own = scratch.table(rows.select(*UNIT, "block", F.col(end).alias("id")).distinct(), end)
            codes = id_positions(own.select(*UNIT, "id"), UNIT, "id", name)
            out = own.join(codes, [*UNIT, "id"]).withColumnRenamed("id", end)
            return out.repartition(self.buckets, *PLACE)

        return (
            rows.join(coded("src", "from_id"), [*UNIT, "block", "src"])
            .join(coded("trg", "to_id"), [*UNIT, "block", "trg"])
            .select(*UNIT, "from_id", "to_id", F.col("time_min").cast("int").alias("time"))
        )

    def compare(
        self, other: TravelTable, name: str, other_name: str, where: Column | None = None,
        only: Callable[[DataFrame], DataFrame] | None = None,
    ) -> DataFrame:
        """Times of the pairs that both tables have, joined bucket by bucket; ``other`` was written like this one. ``only``
        picks pairs by their keys, on both sides alike."""
        keys = [*UNIT, "src", "trg"]
        left = self.rows() if where is None else self.rows().where(where)
        one = left.select(*keys, "block", F.col("time_min").alias(name))
        two = other.rows().select(*keys, "block", F.col("time_min").alias(other_name))
        if only is not None:
            one, two = only(one), only(two)
        return one.join(two, [*keys, "block"]).select(*keys, name, other_name)
