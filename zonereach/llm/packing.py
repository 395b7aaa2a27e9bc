"""Best-fit packing of token sequences by hierarchical residual packing."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import Scratch
from .tokens import encoded, slices

PIECE_SCHEMA = "doc_id long, piece int, start long, length long, ids binary"


def token_pieces(
    docs: DataFrame, tokenizer: str, end: int | None = 2, capacity: int = 1024, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Token pieces of each document: doc_id, piece, start, length, ids (little-endian unsigned 32-bit).

    A document is its ids and the end id. Only one longer than ``capacity`` is cut, into pieces of ``capacity``; its
    first piece is the remainder. Null texts are empty: the end id alone, and without an end id no piece. Texts of any
    length are encoded whole; repeated rows give pieces of their own; other columns are not read.
    """

    def cut(batches):
        for batch in batches:
            for a, b in slices(batch.column(1)):
                rows = []
                own = batch.column(0).slice(a, b - a).to_pylist()
                for key, ids in zip(own, encoded(tokenizer, batch.column(1).slice(a, b - a).to_pylist(), end)):
                    first = len(ids) % capacity or min(len(ids), capacity)
                    cuts = [0, *range(first, len(ids) + 1, capacity)] if len(ids) else [0]
                    data = ids.astype("<u4").tobytes()
                    rows += [(key, i, s, e - s, data[4 * s : 4 * e]) for i, (s, e) in enumerate(zip(cuts, cuts[1:]))]
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary()))],
                        ["doc_id", "piece", "start", "length", "ids"],
                    )

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(cut, PIECE_SCHEMA)


def best_fit(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """Bin of each size: largest first, each into the fullest bin that still holds it.

    Open bins stand in stacks by their free room, and a bit for each stack that is not empty finds the tightest one.
    """
    bins = np.empty(len(sizes), np.int64)
    rooms: list[list[int]] = [[] for _ in range(capacity + 1)]
    filled, count = 0, 0
    for i in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[i])
        fits = filled >> size
        if fits:
            room = size + (fits & -fits).bit_length() - 1
            at = rooms[room].pop()
            if not rooms[room]:
                filled ^= 1 << room
        else:
            room, at = capacity, count
            count += 1
        bins[i] = at
        left = room - size
        rooms[left].append(at)
        filled |= 1 << left
    return bins


def _round(number: int, capacity: int, slack: int, last: bool):
    """Pack the bins of one partition; members move to the bin they end up in."""

    def run(batches):
        got = [b for b in batches if b.num_rows]
        if not got:
            return
        table = pa.Table.from_batches(got).combine_chunks()
        fill = table.column("fill").to_numpy()
        members = table.column("members").combine_chunks()
        if isinstance(members, pa.ChunkedArray):
            members = members.chunk(0)
        counts = np.diff(members.offsets.to_numpy())
        flat, first = members.values, members.offsets.to_numpy()[:-1].astype(np.int64)
        bins = best_fit(fill, capacity)
        # Bins that were fuller come first in their new bin.
        order = np.lexsort((np.arange(len(bins)), -fill, bins))
        sorted_bins, sorted_fill = bins[order], fill[order].astype(np.int64)
        begins = np.flatnonzero(np.append(True, sorted_bins[1:] != sorted_bins[:-1]))
        total = np.add.reduceat(sorted_fill, begins)
        before = np.cumsum(sorted_fill) - sorted_fill
        offset = before - np.repeat(before[begins], np.diff(np.append(begins, len(order))))
        n = counts[order].astype(np.int64)
        at = np.cumsum(n) - n
        take = np.arange(int(n.sum())) + np.repeat(first[order] - at, n)
        moved = flat.take(pa.array(take))
        columns = {f.name: moved.field(i) for i, f in enumerate(flat.type)}
        columns["offset"] = pa.array(columns["offset"].to_numpy() + np.repeat(offset, n), pa.int64())
        moved = pa.StructArray.from_arrays(list(columns.values()), names=list(columns))
        sizes = np.add.reduceat(n, begins)
        offsets = pa.array(np.append(0, np.cumsum(sizes)), pa.int32())
        ids = (number << 56) | (TaskContext.get().partitionId() << 32) | np.arange(len(begins))
        whole = np.full(len(begins), True) if last else total >= capacity - slack
        out = pa.Table.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(total, pa.int64()), pa.array(whole), pa.ListArray.from_arrays(offsets, moved)],
            names=["bin", "fill", "whole", "members"],
        )
        yield from out.to_batches(max_chunksize=20_000)

    return run


def pack(
    items: DataFrame,
    scratch: Scratch,
    capacity: int = 1024,
    length: str = "length",
    task_bins: int = 40_000,
    fan_in: int = 8,
    slack: int = 8,
) -> DataFrame:
    """Place items into sequences of at most ``capacity``: the items' columns, sequence_id and offset.

    Each partition packs its items best-fit and emits the bins with at most ``slack`` free; the underfull ones go on
    as items, and ``fan_in`` partitions meet in one for the next round. A partition gets about ``task_bins`` bins, so
    a task's memory does not grow with the input; merging ends with one partition, or when as many bins as before go
    on in as many partitions (they no longer fit together). Items of exactly ``capacity`` are sequences at once. The
    unit of a later round is a bin with its members, at most ``capacity`` of them.

    Lengths must be 1 .. capacity and no column may be called offset or sequence_id (an error otherwise); rows without
    length are not placed. Equal items are placed
    each by itself. No items, no rows. Sequence ids are arbitrary but distinct; offsets in a sequence have no gaps.
    """
    wrong = items.where((F.col(length) < 1) | (F.col(length) > capacity)).limit(1).count()
    if wrong:
        raise ValueError(f"{length} must lie in 1 .. {capacity}")
    names = items.columns
    if {"offset", "sequence_id"} & set(names):
        raise ValueError("items may not have columns offset or sequence_id")
    rest = items.where(F.col(length) < capacity).select(
        F.col(length).cast("long").alias("fill"),
        F.array(F.struct(*names, F.lit(0).cast("long").alias("offset"))).alias("members"),
    )
    full = items.where(F.col(length) == capacity).select(
        *names, (F.lit(-1) - F.monotonically_increasing_id()).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    member = rest.schema["members"].dataType.simpleString()
    left = items.where(F.col(length) < capacity).count()
    parts, number, done = max(1, -(-left // task_bins)), 0, []
    stuck = False
    while left:
        last = parts == 1 or stuck
        dealt = rest.select("fill", "members").repartition(parts, F.xxhash64(F.element_at("members", 1), F.lit(number)))
        out = scratch.table(
            dealt.mapInArrow(_round(number, capacity, slack, last), f"bin long, fill long, whole boolean, members {member}"), "bins"
        )
        done.append(out.where("whole"))
        if last:
            break
        rest = out.where("not whole")
        more = rest.count()
        merged = max(-(-parts // fan_in), -(-more // task_bins), 1)
        stuck = merged >= parts and more >= 0.99 * left
        parts, left, number = min(parts, merged) if more < left else merged, more, number + 1
    for bins in done:
        placed = bins.select(F.col("bin").alias("sequence_id"), F.explode("members").alias("m"))
        full = full.union(placed.select(*[F.col(f"m.`{c}`").alias(c) for c in names], "sequence_id", "m.offset"))
    return full


def pack_documents(docs: DataFrame, scratch: Scratch, tokenizer: str, end: int | None = 2, capacity: int = 1024, **names) -> DataFrame:
    """Encode, cut and pack whole documents: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Only lengths and checksums go through the packing; ``sequences`` joins the ids to their places. A null text is empty:
    the end id alone. Texts of any length are encoded whole, repeated rows and rows with a null id are packed each by
    itself, other columns are not read whatever their names. An empty table gives no rows.
    """
    pieces = token_pieces(docs, tokenizer, end, capacity, **names)
    narrow = scratch.table(pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")), "pieces")
    return pack(narrow, scratch, capacity)


def sequences(pieces: DataFrame, placed: DataFrame) -> DataFrame:
    """The packed ids: sequence_id, ids, one row a sequence of at most its capacity."""
    where = placed.select("doc_id", "piece", "ids_crc32", "sequence_id", "offset").distinct()
    own = pieces.withColumn("ids_crc32", F.crc32("ids")).join(where, ["doc_id", "piece", "ids_crc32"])
    parts = own.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
    joined = F.aggregate("parts", F.lit(b""), lambda a, x: F.concat(a, x.ids))
    return parts.select("sequence_id", joined.alias("ids"))
