"""Writers."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .unit_store import UnitStore


def parquet(df: DataFrame, path: str, by: Sequence[str] = (), mode: str = "overwrite", compression: str = "snappy",
            files_per_key: int | None = None) -> None:
    """Partitioned Parquet; rows of a partition folder are spread over ``files_per_key`` tasks.

    The spread hashes whole rows, so a city that holds a third of the data is still written by many tasks.
    """
    if by and files_per_key:
        # abs of a hash keeps the split repeatable when a task is run again.
        part = F.pmod(F.xxhash64(*[c for c in df.columns if c not in by]), F.lit(files_per_key))
        df = df.withColumn("_part", part).repartition(*by, "_part").drop("_part")
    writer = df.write.mode(mode).option("compression", compression).option("partitionOverwriteMode", "dynamic")
    (writer.partitionBy(*by) if by else writer).parquet(path)


def csv(df: DataFrame, path: str, by: Sequence[str] = (), gzip: bool = False, mode: str = "overwrite", **options) -> None:
    """Text table with a header; with ``by`` a folder per value, each written by one task unless it is large.

    The rebalancing hint gathers a folder's rows in one task and splits it where they exceed the advisory size.
    """
    if by:
        df = df.hint("rebalance", *by)
    writer = df.write.mode(mode)
    writer = writer.partitionBy(*by) if by else writer
    writer.csv(path, header=True, compression="gzip" if gzip else "none", **options)


def incremental(
    units: DataFrame, compute: Callable[[DataFrame], DataFrame], path: str, overwrite: bool = False
) -> DataFrame:
    """Compute and write the units that are not there yet; ``compute`` gets the units to do, and all rows are returned.

    All of them run as one job, whose rows are gathered by unit (large ones split by size), so a unit gets few files.
    With a column ``fingerprint`` in ``units``, a unit whose input has changed is computed again too.
    """
    by = [c for c in units.columns if c != "fingerprint"]
    store = UnitStore(units.sparkSession, path, by)
    store.update(units, compute, overwrite)
    return store.rows()
