"""Sharding by a k-d tree: weighted medians along the widest metadata dimension until leaves reach the target bytes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import Scratch, running, unused

DIMENSIONS = ("length", "source", "lang")
# A group of equal texts above this part of a shard's bytes is cut into pieces of about that size.
PIECE = 0.01
STEP_BITS = 12
KEY_BITS = 60
TIE_BITS = 40


def _spread(c: F.Column) -> F.Column:
    """A category's place in [0, 1): the same for the same value on every run; null lies at 0."""
    return F.coalesce(F.crc32(c.cast("string").cast("binary")) / F.lit(float(1 << 32)), F.lit(0.0))


def metadata(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """One narrow row per document: id, size, checksum, group (hash of the text) and the split dimensions."""
    t = F.coalesce(F.col(text), F.lit(""))
    size = F.octet_length(t).cast("long") + 8
    return docs.select(
        F.col(doc_id).alias("doc_id"),
        size.alias("size"),
        F.crc32(t.cast("binary")).alias("text_crc32"),
        F.xxhash64(t).alias("group"),
        F.least(F.log2(size.cast("double")) / 48, F.lit(1.0)).alias("length"),
        _spread(F.col(source)).alias("source"),
        _spread(F.col(lang)).alias("lang"),
    )


def _units(meta: DataFrame, total: int, shards: int) -> tuple[DataFrame, DataFrame]:
    """Groups of equal texts as weighted points, large ones in pieces; and the documents with their unit.

    A group that is cut has more than PIECE of a shard's bytes, so at most shards / PIECE groups are, which bounds
    the list that is broadcast.
    """
    piece = max(1.0, PIECE * total / shards)
    hot = (
        meta.groupBy("group").agg(F.sum("size").alias("bytes")).where(F.col("bytes") > piece)
        .select("group", F.ceil(F.col("bytes") / piece).alias("pieces"))
    )
    rows = meta.join(F.broadcast(hot), "group", "left").withColumn(
        "part", F.coalesce(F.pmod(F.xxhash64("doc_id"), F.col("pieces")), F.lit(0)).cast("long")
    )
    units = rows.groupBy("group", "part").agg(
        F.sum("size").alias("bytes"), F.min(F.struct("doc_id", *DIMENSIONS)).alias("first")
    )
    tie = F.xxhash64("group", "part").bitwiseAND(F.lit((1 << TIE_BITS) - 1))
    return rows, units.select("group", "part", "bytes", *[F.col(f"first.{d}").alias(d) for d in DIMENSIONS], tie.alias("tie"))


def _pick(values: list, node: str) -> F.Column:
    """values[node], null where there is none."""
    return F.get(F.array(*[F.lit(v) for v in values]), F.col(node))


def _medians(points: DataFrame, want: dict[int, float], precise: float) -> dict[int, int]:
    """For each node the cut below which its keys weigh about ``want`` bytes, for all nodes in the same passes.

    Each pass sums the bytes in 4096 equal bins of the interval that holds the cut, and goes on with the bin that
    crosses it, until what the bin weighs is below ``precise`` or a bin is one key. The driver sees bins, never points.
    """
    size = max(want) + 1
    low, left, cut, bits = dict.fromkeys(want, 0), dict(want), {}, KEY_BITS
    while len(cut) < len(want) and bits > 0:
        bits -= STEP_BITS
        lows = [low[n] if n in want and n not in cut else None for n in range(size)]
        at = F.floor((F.col("key") - _pick([None if x is None else x for x in lows], "node")) / F.lit(1 << bits))
        bins: dict[int, list] = {n: [] for n in want}
        found = (
            points.withColumn("bin", at.cast("long")).where(F.col("bin").between(0, (1 << STEP_BITS) - 1))
            .groupBy("node", "bin").agg(F.sum("bytes").alias("bytes"))
        )
        for r in found.collect():
            bins[r.node].append((r.bin, r.bytes))
        for n in want:
            if n in cut:
                continue
            below, edge = 0, low[n]
            for b, w in sorted(bins[n]):
                if below + w > left[n]:
                    near = low[n] + (b << bits), low[n] + ((b + 1) << bits)
                    if w <= precise or bits == 0:
                        cut[n] = near[0] if left[n] - below < w / 2 else near[1]
                    else:
                        low[n], left[n] = near[0], left[n] - below
                    break
                below, edge = below + w, low[n] + ((b + 1) << bits)
            else:
                cut[n] = edge
    return cut


def kd_shards(
    docs: DataFrame,
    scratch: Scratch,
    shards: int | None = None,
    target_bytes: int | None = None,
    precise: float = 0.0005,
    **names,
) -> DataFrame:
    """Shard and slot of every document: doc_id, size, text_crc32, shard, slot.

    Give the number of shards or the bytes a leaf should have. A node with k leaves is split along its widest
    dimension (spans are parts of the whole range) at the weighted quantile floor(k/2)/k, so leaves come out nearly
    equal in bytes. Points are groups of equal texts, placed where their smallest document lies: copies share a shard
    unless their group alone has more than PIECE of a shard's bytes; such a group is dealt in pieces by a hash of
    doc_id. Equal coordinates are ordered by a hash of the text. slot numbers a shard's documents from 0 by doc_id,
    without gaps.

    size: UTF-8 bytes of the text (null: none) plus 8. Null lang, source and text are values of their own (0). Empty
    input gives no rows; repeated rows are documents of their own. Other columns are not read.
    """
    meta = scratch.table(metadata(docs, **names), "meta")
    total = meta.agg(F.sum("size")).first()[0] or 0
    if shards is None:
        shards = max(1, round(total / target_bytes))
    rows, units = _units(meta, total, shards)
    # Leaves of a node are the shards first .. first + k - 1; a node is named by its first shard.
    nodes = {0: shards}
    points = scratch.table(units.withColumn("node", F.lit(0)), "points")
    while any(k > 1 for k in nodes.values()):
        spans = points.groupBy("node").agg(
            F.sum("bytes").alias("bytes"), *[(F.max(d) - F.min(d)).alias(d) for d in DIMENSIONS]
        ).collect()
        spans = {r.node: r for r in spans if nodes[r.node] > 1}
        if not spans:
            break
        if 0 in nodes and nodes[0] == shards:
            whole = {d: max(spans[0][d], 1e-12) for d in DIMENSIONS}
        size = max(spans) + 1
        widest = [
            max(range(len(DIMENSIONS)), key=lambda i, r=spans.get(n): (r[DIMENSIONS[i]] / whole[DIMENSIONS[i]], -i)) if n in spans else None
            for n in range(size)
        ]
        along = F.get(F.array(*DIMENSIONS), _pick([w if w is not None else 0 for w in widest], "node"))
        steps = 1 << (KEY_BITS - TIE_BITS)
        key = F.least(F.floor(along * steps), F.lit(steps - 1)).cast("long") * F.lit(1 << TIE_BITS) + F.col("tie")
        keyed = scratch.table(points.withColumn("key", F.when(F.col("node") < size, key)), "points")
        want = {n: r.bytes * (nodes[n] // 2) / nodes[n] for n, r in spans.items()}
        cuts = _medians(keyed.where(F.col("node").isin(list(want))), want, precise * total / shards)
        up = _pick([cuts.get(n) for n in range(size)], "node")
        over = _pick([nodes[n] // 2 if n in spans else 0 for n in range(size)], "node")
        node = F.col("node") + F.when(F.col("key") >= up, over).otherwise(0)
        nxt = scratch.table(keyed.withColumn("node", F.coalesce(node, F.col("node")).cast("int")).drop("key"), "points")
        scratch.drop(points, keyed)
        points = nxt
        nodes = {m: c for n, k in nodes.items() for m, c in (((n, k // 2), (n + k // 2, k - k // 2)) if n in spans else ((n, k),))}
    placed = rows.join(points.select("group", "part", F.col("node").alias("shard")), ["group", "part"]).select(
        "doc_id", "size", "text_crc32", "shard"
    )
    return running(scratch, placed, ["shard"], ["doc_id", "text_crc32"], name="slot")


def write_shards(docs: DataFrame, placed: DataFrame, path: str, doc_id: str = "doc_id") -> None:
    """Write the documents as Parquet, a folder per shard, in slot order."""
    shard, slot = unused(docs, "shard"), unused(docs, "slot")
    out = docs.join(placed, docs[doc_id] == placed["doc_id"]).select(
        *[docs[c] for c in docs.columns], placed["shard"].alias(shard), placed["slot"].alias(slot)
    )
    out.sortWithinPartitions(shard, slot).write.partitionBy(shard).parquet(path)
