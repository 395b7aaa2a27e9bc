"""Travel-time tables: ingest of router output, request blocks, compact codes and incremental runs."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import units
from ..operators.ranking import id_positions
from ..session import cut_lineage

OSRM_MODES = ("bike", "drive", "walk")
R5_MODES = ("bike", "drive", "transit", "walk")
LEVELS = ("bg", "county", "tract")
UNIT = ["city", "mode", "level"]


def check_unit(mode: str, level: str, modes=OSRM_MODES) -> None:
    if mode not in modes:
        raise ValueError(f"unknown mode {mode!r}; one of {', '.join(modes)}")
    if level not in LEVELS:
        raise ValueError(f"unknown level {level!r}; one of {', '.join(LEVELS)}")


def known_units(df: DataFrame, modes=OSRM_MODES) -> DataFrame:
    """Rows of known modes and levels (any case)."""
    return df.where(F.lower("mode").isin(list(modes)) & F.lower("level").isin(list(LEVELS)))


def zone_index(zones: DataFrame) -> DataFrame:
    """0-based position of each zone in its (city, level), the index that router matrices use."""
    return id_positions(zones, ["city", "level"], "geoid", "idx")


def request_blocks(index: DataFrame, batch_size: int = 3000) -> DataFrame:
    """Router requests per source block: city, level, block, first, last, n_zones, n_target_blocks.

    Cities with a single zone have nothing to route and drop out. The targets of a block are the blocks
    0 .. n_target_blocks - 1; the pairs themselves are not listed.
    """
    blocks = (
        index.withColumn("block", F.floor(F.col("idx") / batch_size))
        .groupBy("city", "level", "block")
        .agg(F.min("idx").alias("first"), F.max("idx").alias("last"), F.count("*").alias("n_zones"))
    )
    sizes = index.groupBy("city", "level").agg(F.count("*").alias("n")).where("n > 1")
    return blocks.join(sizes, ["city", "level"]).select(
        "city", "level", "block", "first", "last", "n_zones", F.ceil(F.col("n") / batch_size).alias("n_target_blocks")
    )


def id_blocks(index: DataFrame, batch_size: int = 3000) -> DataFrame:
    """The ids of each request block in index order: city, level, off (index of the first), ids (at most a batch)."""
    block = F.floor(F.col("idx") / batch_size) * batch_size
    ids = F.sort_array(F.collect_list(F.struct("idx", "geoid")))["geoid"]
    return index.groupBy("city", "level", block.alias("off")).agg(ids.alias("ids"))


def requests(
    index: DataFrame, modes: DataFrame, batch_size: int = 3000, answered: DataFrame | None = None, counted: bool = False
) -> DataFrame:
    """A row per router request: city, mode, level, src_off, trg_off. ``modes`` has one column, mode.

    With ``answered`` (rows of requests, as they come) only those that are not among them. The answers come to the block of
    sources as a list of targets, at most one per block of the city, and the other requests are listed there: their
    number grows with the square of a city's zones, and they are never shuffled. With ``counted`` they are not listed
    either: a row per block of sources, whose trg_off is NULL, with their number, ``n``.
    """
    blocks = request_blocks(index, batch_size)
    block = (
        blocks.join(F.broadcast(modes))  # a handful of names
        .select(*UNIT, (F.col("block") * batch_size).alias("src_off"), "n_target_blocks")
    )
    t, n = F.sequence(F.lit(0).cast("long"), F.col("n_target_blocks") - 1), F.col("n_target_blocks")
    if answered is not None:
        key = REQUEST[:-1]
        have = answered.where(F.col("trg_off") % batch_size == 0).groupBy(*key).agg(
            F.collect_set((F.col("trg_off") / batch_size).cast("long")).alias("_have")
        )
        block = block.join(have, key, "left")
        have = F.coalesce("_have", F.array().cast("array<bigint>"))
        t, n = F.array_except(t, have), n - F.size(F.filter(have, lambda x: (x >= 0) & (x < F.col("n_target_blocks"))))
    if counted:
        return block.select(*UNIT, "src_off", F.lit(None).cast("long").alias("trg_off"), n.cast("long").alias("n")).where("n > 0")
    return block.select(*UNIT, "src_off", F.explode(t).alias("t")).select(*UNIT, "src_off", (F.col("t") * batch_size).alias("trg_off"))


MATRIX = "distances array<array<double>>, durations array<array<double>>"
REQUEST = [*UNIT, "src_off", "trg_off"]


def checked_matrices(matrices: DataFrame, blocks: DataFrame) -> DataFrame:
    """Responses read and looked at: the request's columns, src_ids, trg_ids, r (the matrices) and ``reason``.

    ``reason`` is null for a good response, and otherwise what is wrong with it: ``empty``, ``not JSON`` (cut off, for
    one), ``no matrix`` (the router's own message), ``not requested`` (no such block of sources or targets),
    ``wrong shape`` (not a cell for each source and target), ``surplus cells`` (all of them and more) or ``repeated``
    (several responses to one request, of which none is taken). Every response keeps its row.
    """
    src = blocks.withColumnsRenamed({"off": "src_off", "ids": "src_ids"})
    trg = blocks.withColumnsRenamed({"off": "trg_off", "ids": "trg_ids"})
    # Counted beside the responses, so that these are made once; those that lie by their request are not moved for it.
    times = F.count("*").over(Window.partitionBy(*REQUEST))
    whole = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in REQUEST])
    read = F.from_json("response", f"{MATRIX}, _bad string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"})
    rows = (
        matrices.withColumn("_n", F.when(whole, times))
        .join(src, ["city", "level", "src_off"], "left")
        .join(trg, ["city", "level", "trg_off"], "left")
        # As a row of its own the matrix is read once; a plain column would be read again by each condition on it.
        .select(*REQUEST, "_n", "src_ids", "trg_ids", F.col("response").isNull().alias("_null"), F.explode_outer(F.array(read)).alias("r"))
    )

    def misfit(name: str, sign: str) -> str:
        return f"size(r.{name}) {sign} size(src_ids) or exists(r.{name}, x -> x is null or size(x) {sign} size(trg_ids))"

    reason = F.expr(
        "case when _null then 'empty' when r is null or r._bad is not null then 'not JSON'"
        " when r.durations is null or r.distances is null then 'no matrix'"
        " when src_ids is null or trg_ids is null then 'not requested' when _n > 1 then 'repeated'"
        f" when {misfit('durations', '<')} or {misfit('distances', '<')} then 'wrong shape'"
        f" when {misfit('durations', '>')} or {misfit('distances', '>')} then 'surplus cells' end"
    )
    return rows.select(*REQUEST, "src_ids", "trg_ids", "r", reason.alias("reason"))


def matrix_cells(checked: DataFrame, max_time: float = 90, to_minutes=units.seconds_to_minutes) -> DataFrame:
    """Travel-time rows of the good responses; both id lists lie beside the matrix, so nothing is shuffled."""
    rows = (
        checked.where("reason is null")
        .select(*UNIT, "src_ids", "trg_ids", F.posexplode(F.arrays_zip("r.distances", "r.durations")).alias("i", "row"))
        .select(
            *UNIT, F.get("src_ids", F.col("i")).alias("src"), "trg_ids",
            F.posexplode(F.arrays_zip("row.distances", "row.durations")).alias("j", "cell"),
        )
    )
    return rows.select(
        *UNIT, "src", F.get("trg_ids", F.col("j")).alias("trg"),
        F.col("cell.distances").alias("dist"), to_minutes(F.col("cell.durations")).alias("time_min"),
    ).where(F.col("time_min").between(0, max_time) & F.col("src").isNotNull() & F.col("trg").isNotNull())


def matrix_rejects(checked: DataFrame, requested: DataFrame | None = None, unanswered: DataFrame | None = None) -> DataFrame:
    """What was not taken: the request's columns and the reason. With ``requested`` (see ``requests``), a request that
    has no response at all is ``no response``; ``unanswered`` has just these (``requests`` with ``answered``), which
    spares the comparison. Where it has them ``counted``, all rows have ``n``, which is 1 for a response."""
    bad = checked.where("reason is not null").select(*REQUEST, "reason")
    if requested is None and unanswered is None:
        return bad
    if unanswered is None:
        unanswered = requested.select(*REQUEST).join(checked.select(*REQUEST), REQUEST, "left_anti")
    if "n" in unanswered.columns:
        bad = bad.withColumn("n", F.lit(1).cast("long"))
    return bad.unionByName(unanswered.select(*[c for c in bad.columns if c != "reason"], F.lit("no response").alias("reason")))


def failed_units(rejects: DataFrame) -> DataFrame:
    """Units with anything rejected, which should not count as done: city, mode, level, rejects, reasons (sorted). A row of
    ``rejects`` may stand for ``n`` of them."""
    # Counted by reason first: a plain sum over the many rows.
    number = F.sum("n") if "n" in rejects.columns else F.count("*")
    counts = rejects.groupBy(*UNIT, "reason").agg(number.alias("_n"))
    return counts.groupBy(*UNIT).agg(F.sum("_n").alias("rejects"), F.array_sort(F.collect_set("reason")).alias("reasons"))


def od_from_matrices(
    matrices: DataFrame, blocks: DataFrame, max_time: float = 90, to_minutes=units.seconds_to_minutes, on_bad: str = "fail"
) -> DataFrame:
    """Router matrices to travel-time rows.

    ``matrices``: city, mode, level, src_off, trg_off, response (JSON with ``distances`` and ``durations``); a
    response covers one block of sources and targets, so its size is bounded by the request. ``blocks``: the ids of the
    requested blocks (``id_blocks``). Both id lists come to the matrix as arrays, one row each, so the cells are taken
    apart after the last shuffle. A response that cannot be taken ends the job; with ``on_bad="skip"`` it is left to
    ``matrix_rejects``. Of one with too few or surplus cells, those asked for are taken; ``checked_matrices`` tells them.
    """
    if on_bad not in ("fail", "skip"):
        raise ValueError(f"on_bad must be 'fail' or 'skip', not {on_bad!r}")
    checked = checked_matrices(matrices, blocks).replace(["wrong shape", "surplus cells"], None, "reason")
    if on_bad == "fail":
        place = F.concat_ws(" ", *REQUEST)
        error = F.raise_error(F.concat(F.lit("response to "), place, F.lit(": "), F.col("reason")))
        checked = checked.withColumn("reason", F.when(F.col("reason").isNull(), F.lit(None).cast("string")).otherwise(error.cast("string")))
    return matrix_cells(checked, max_time, to_minutes)


def od_from_r5(raw: DataFrame) -> DataFrame:
    """Second router's matrix (from_id, to_id, travel_time) to travel-time rows; unreachable pairs drop out."""
    return (
        raw.where("travel_time is not null")
        .withColumnsRenamed({"from_id": "src", "to_id": "trg", "travel_time": "time_min"})
        .select(*UNIT, "src", "trg", F.col("time_min").cast("double").alias("time_min"))
        .withColumn("source", F.lit("r5"))
    )


def compact_codes(od: DataFrame) -> DataFrame:
    """city, mode, level, from_id, to_id, time: ids as dense codes per unit and side, minutes cut to int."""
    ids = od.selectExpr(*UNIT, "stack(2, 'src', src, 'trg', trg) as (side, id)")
    # One pass finds the ids of both sides; the finished dictionary is small next to the pairs and used twice.
    codes = cut_lineage(id_positions(ids, [*UNIT, "side"], "id", "code"))
    src = codes.where("side = 'src'").selectExpr(*UNIT, "id as src", "code as from_id")
    trg = codes.where("side = 'trg'").selectExpr(*UNIT, "id as trg", "code as to_id")
    return (
        od.join(src, [*UNIT, "src"])
        .join(trg, [*UNIT, "trg"])
        .select(*UNIT, "from_id", "to_id", F.col("time_min").cast("int").alias("time"))
    )


def missing_units(wanted: DataFrame, present: DataFrame, overwrite: bool = False) -> DataFrame:
    """Units still to be computed; with ``overwrite`` all of them."""
    return wanted if overwrite else wanted.join(present.select(*wanted.columns).distinct(), wanted.columns, "left_anti")


def compare_routers(
    a: DataFrame, b: DataFrame, name_a: str, name_b: str, where: Column | None = None, only: Callable[[DataFrame], DataFrame] | None = None
) -> DataFrame:
    """Times of the pairs that both routers have: city, mode, level, src, trg, name_a, name_b. ``only`` picks pairs by their
    keys, on both sides alike."""
    left = a if where is None else a.where(where)
    keys = [*UNIT, "src", "trg"]
    one, other = left.select(*keys, F.col("time_min").alias(name_a)), b.select(*keys, F.col("time_min").alias(name_b))
    return one.join(other, keys) if only is None else only(one).join(only(other), keys)


def both_ends_in_state(state: str | None = None) -> Column:
    """Both ends in the named state, or in the same state whichever it is."""
    if state is None:
        return F.substring("src", 1, 2) == F.substring("trg", 1, 2)
    return F.col("src").startswith(state) & F.col("trg").startswith(state)
