"""Tables that several queries read: landed once for a data folder, and again when its files change."""

from __future__ import annotations

import atexit
import uuid
from collections.abc import Callable
from typing import TypeVar

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans import access as acc
from ..plans import travel
from ..plans.travel_table import TravelTable
from ..session import cut_lineage, remove, shared_dir
from ..sources.fixtures import Inputs
from ..sources.unit_store import UNIT, UnitStore

T = TypeVar("T")

# What this driver has landed, by session, folder and product, with the state of the files it came from.
_LANDED: dict[tuple[str, str, str], tuple[str, object]] = {}
MOST_CITIES = 100
SOURCES = ("lineitem", "supplier", "nation", "region")


def folder(i: Inputs, name: str) -> str:
    """A folder of its own in the shared folder, removed when the driver ends."""
    path = f"{shared_dir(i.spark)}/{name}-{uuid.uuid4().hex[:12]}"
    atexit.register(remove, i.spark, path)
    return path


def files_state(i: Inputs, tables=SOURCES) -> str:
    """Names, sizes and times of the tables' files, as one sum; no file is opened."""
    files = i.spark.read.format("binaryFile").option("recursiveFileLookup", "true").load([f"{i.folder}/{t}.parquet" for t in tables])
    h = F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)")
    return "/".join(map(str, files.agg(F.count("*"), F.sum(h)).first()))


def landed(i: Inputs, name: str, make: Callable[[], T]) -> T:
    key, state = (i.spark.sparkContext.applicationId, i.folder, name), files_state(i)
    if key not in _LANDED or _LANDED[key][0] != state:
        _LANDED[key] = (state, make())
    return _LANDED[key][1]


def own_table(od: DataFrame, path: str, like: TravelTable | None = None, **each) -> TravelTable:
    table = TravelTable.write(od, path, like, **each)
    atexit.register(table.close)
    return table


def travel_times(i: Inputs) -> TravelTable:
    """Travel times at all levels."""
    return landed(i, "times", lambda: own_table(i.base_levels, folder(i, "travel-times"), each=i.TIMES, of=["base"]))


def r5_times(i: Inputs) -> DataFrame:
    return travel.od_from_r5(i.od_r5.withColumnsRenamed({"src": "from_id", "trg": "to_id"}))


def second_router(i: Inputs) -> TravelTable:
    """The other router's times, in the blocks of the first one's."""
    first = travel_times(i)
    return landed(i, "second", lambda: own_table(r5_times(i), folder(i, "second-router"), first))


def opportunities(i: Inputs) -> DataFrame:
    """Opportunities at all levels, for the fingerprints and for the access itself."""
    return landed(i, "opportunities", lambda: cut_lineage(i.opport))


def access_units(i: Inputs) -> DataFrame:
    """Units to compute access for, with a fingerprint of their pairs and of all opportunities and zones."""
    total = lambda df: df.agg(F.sum(F.xxhash64(*sorted(df.columns)).cast("decimal(38,0)")).cast("string").alias("h"))
    rest = total(opportunities(i)).union(total(i.zones)).agg(F.concat_ws("/", F.array_sort(F.collect_list("h"))).alias("_rest"))
    units = travel_times(i).units.select(*UNIT, "pairs", "fingerprint").join(F.broadcast(rest))  # a single row
    return units.select(*UNIT, "pairs", F.concat_ws("/", "fingerprint", "_rest").alias("fingerprint"))


def access_store(i: Inputs, name: str = "access") -> UnitStore:
    """A store of access rows, by measure, mode and threshold, in the order of kind and city."""
    # Access comes summed by zone and kind, a column per measure and threshold: as rows of each it is written where it lies.
    # Units of a city and level follow each other, since their pairs lie together.
    by, slices = ("city", "level", "mode"), ("measure", "mode", "thresh")
    return UnitStore(i.spark, folder(i, name), by, slices, sort=("kind", "city"), dealt=True)


# Blocks of pairs for each core that the units of a run have, so that a run keeps all cores busy.
RUN_BLOCKS = 8


def run_pairs(i: Inputs) -> int:
    """Pairs of a run of the saved access: its partial sums are on disk at one time."""
    return acc.BLOCK_PAIRS * RUN_BLOCKS * i.spark.sparkContext.defaultParallelism


def compute_access(i: Inputs) -> Callable[[DataFrame], DataFrame]:
    def compute(todo: DataFrame) -> DataFrame:
        table = travel_times(i)
        # Where they are few, their cities are named to the scan, which passes over the files of others.
        cities = [r.city for r in todo.select("city").distinct().limit(MOST_CITIES + 1).collect()]
        where = F.col("city").isin(cities) if len(cities) <= MOST_CITIES and None not in cities else None
        # The units to do come to the pairs.
        pairs = table.pairs(where, max_time=90).join(F.broadcast(todo), list(UNIT), "left_semi")
        return table.access_of(pairs, opportunities(i), i.zones)

    return compute


def saved_access(i: Inputs) -> UnitStore:
    """Access of all zones, modes and levels, computed once."""

    def make() -> UnitStore:
        store = access_store(i)
        store.update(access_units(i), compute_access(i), run_pairs=run_pairs(i))
        return store

    return landed(i, "access", make)


def access_slice(i: Inputs, level: str | None = "BG", where: Column | None = None, **equal) -> DataFrame:
    """Rows of the saved access with the given values; measure, mode and threshold name folders, the kind row groups."""
    for column, value in (equal | ({"level": level} if level else {})).items():
        one = F.col(column) == value
        where = one if where is None else where & one
    return saved_access(i).rows(where)
