"""A table that is computed unit by unit, with a commit record for each unit."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import cut_lineage

UNIT = ("city", "mode", "level")


def fingerprints(rows: DataFrame, by: Sequence[str] = UNIT) -> DataFrame:
    """by..., pairs, fingerprint: the number of rows of each unit, and a sum over them that tells any change.

    The sum does not depend on the order of the rows; equal rows count as often as they come.
    """
    h = F.xxhash64(*[F.col(c) for c in sorted(rows.columns) if c not in by])
    # Summed in halves, which are whole numbers of 64 bits for two billion rows and more.
    halves = rows.select(*by, F.shiftright(h, 32).alias("_high"), h.bitwiseAND(F.lit(0xFFFFFFFF)).alias("_low"))
    sums = halves.groupBy(*by).agg(F.count("*").alias("pairs"), F.sum("_high").alias("_high"), F.sum("_low").alias("_low"))
    total = F.expr("cast(_high as decimal(20,0)) * 4294967296BD + _low")
    return sums.select(*by, "pairs", total.cast("decimal(38,0)").cast("string").alias("fingerprint"))


class UnitStore:
    """Rows of many units under one path, written run by run.

    ``data/run=...`` holds what a run wrote, partitioned by ``slices`` and sorted by ``sort`` inside a file, so that a
    reader takes only the folders and row groups of its slice. ``commits/run=...`` has a row per unit the run finished:
    the unit, its number of rows and the fingerprint of its input. A unit's rows are those of its last commit. Rows of a
    run that ended before its commit belong to no unit, so they are never read, and its units are computed again, as is
    a unit whose input has another fingerprint now. Which units exist is read from the commits alone.
    """

    def __init__(self, spark: SparkSession, path: str, by: Sequence[str] = UNIT, slices: Sequence[str] | None = None,
                 sort: Sequence[str] = (), dealt: bool = False):
        """``dealt``: the rows to be written lie in fair parts, each with rows of all slices, and are not dealt out again."""
        self.spark, self.path, self.dealt = spark, path, dealt
        self.by, self.slices, self.sort = list(by), list(by if slices is None else slices), list(sort)

    def _read(self, part: str) -> DataFrame | None:
        try:
            return self.spark.read.parquet(f"{self.path}/{part}")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    def units(self) -> DataFrame | None:
        """The last commit of each unit: by..., run, rows, fingerprint; None where nothing was ever committed."""
        commits = self._read("commits")
        if commits is None:
            return None
        last = F.max_by(F.struct("run", "rows", "fingerprint"), "run").alias("_last")
        return commits.groupBy(*self.by).agg(last).select(*self.by, "_last.*")

    def stale(self, wanted: DataFrame) -> DataFrame:
        """The wanted units (by..., fingerprint) without a commit for this fingerprint."""
        done = self.units()
        if done is None:
            return wanted
        have = done.select(*self.by, F.col("fingerprint").alias("_have"))
        same = [wanted[c].eqNullSafe(have[c]) for c in self.by] + [wanted["fingerprint"].eqNullSafe(have["_have"])]
        return wanted.join(have, same, "left_anti")

    def update(
        self, wanted: DataFrame, compute: Callable[[DataFrame], DataFrame], overwrite: bool = False, run_pairs: int | None = None
    ) -> int:
        """Compute and commit the wanted units that are absent or whose fingerprint changed; all of them with ``overwrite``.

        ``wanted`` has by... and maybe ``fingerprint`` and ``pairs``; ``compute`` gets the units to do and gives their rows.
        All of them run as one job; with ``run_pairs`` as one job after the other, each for units that begin within as many
        pairs, so what a job shuffles stays bounded and a finished one is never repeated. Returns the number of units done.
        """
        if "fingerprint" not in wanted.columns:
            wanted = wanted.withColumn("fingerprint", F.lit(None).cast("string"))
        run = F.lit(0).cast("long")
        if run_pairs is not None:
            # A row per unit.
            before = Window.orderBy(*self.by, "fingerprint").rowsBetween(Window.unboundedPreceding, -1)
            run = F.floor(F.coalesce(F.sum("pairs").over(before), F.lit(0)) / run_pairs)
            wanted = wanted.select(*self.by, "fingerprint", "pairs")
        else:
            wanted = wanted.select(*self.by, "fingerprint")
        wanted = wanted.distinct()
        # A row per unit, written down, since the commits below are about the same units whatever the input does meanwhile.
        todo = cut_lineage((wanted if overwrite else self.stale(wanted)).withColumn("_run", run))
        runs = [r["_run"] for r in todo.select("_run").distinct().orderBy("_run").collect()]
        return sum(self._run(todo.where(F.col("_run") == n).select(*self.by, "fingerprint"), compute) for n in runs)

    def _run(self, todo: DataFrame, compute: Callable[[DataFrame], DataFrame]) -> int:
        count = todo.count()
        before = self._read("commits")
        number = 1 if before is None else int(before.agg(F.max("run")).first()[0].split("-")[0]) + 1
        run = f"{number:08d}-{uuid.uuid4().hex[:8]}"
        out = compute(todo.select(*self.by))
        if self._read("schema") is None:
            out.limit(0).coalesce(1).write.mode("ignore").parquet(f"{self.path}/schema")
        dealt = (out if self.dealt else out.hint("rebalance", *self.slices)).sortWithinPartitions(*self.slices, *self.sort)
        data = f"{self.path}/data/run={run}"
        dealt.write.partitionBy(*self.slices).parquet(data)
        self._commit(run, todo, self._count(data, out))
        return count

    def _count(self, data: str, like: DataFrame) -> DataFrame:
        """Rows of each unit as they lie in the files."""
        return self.spark.read.schema(like.schema).parquet(data).groupBy(*self.by).agg(F.count("*").alias("rows"))

    def _commit(self, run: str, units: DataFrame, counts: DataFrame) -> None:
        renamed = counts.withColumnsRenamed({c: f"_{c}" for c in self.by})
        same = [units[c].eqNullSafe(renamed[f"_{c}"]) for c in self.by]
        record = units.join(renamed, same, "left").select(*self.by, F.coalesce("rows", F.lit(0)).alias("rows"), "fingerprint")
        # A single file, so that the commit is there whole or not at all.
        record.coalesce(1).write.parquet(f"{self.path}/commits/run={run}")

    def rows(self, where: Column | None = None) -> DataFrame:
        """The rows of all units. A condition on the slices reaches the folders, one on other columns the row groups."""
        commits, last = self._read("commits"), self.units()
        if commits is None:
            raise ValueError(f"nothing was committed under {self.path}")
        # A row per run.
        runs = (
            commits.groupBy("run").agg(F.count("*").alias("n"))
            .join(last.groupBy("run").agg(F.count("*").alias("kept"), F.sum("rows").alias("rows")), "run")
            .collect()
        )
        some = [r for r in runs if r.rows]
        paths = [f"{self.path}/data/run={r.run}" for r in (some or runs)]
        schema = self._read("schema").schema.add("run", "string")
        out = self.spark.read.schema(schema).option("basePath", f"{self.path}/data").parquet(*paths)
        out = out if where is None else out.where(where)
        if any(r.n != r.kept for r in some):
            now = last.select(*[F.col(c).alias(f"_{c}") for c in (*self.by, "run")])
            out = out.join(now, [out[c].eqNullSafe(now[f"_{c}"]) for c in (*self.by, "run")], "left_semi")
        return out.drop("run")
