"""Token ids in files of directly addressable codes.

An id is cut into chunks of eight bits, lowest first. Level 0 holds the first chunk of every id, level 1 the second
chunk of the ids that have one, and so on. A bitmap for each level but the last says which ids go on, and a directory
holds the number of ones before each 512 bits, so the place of any id on the next level is one look and the count of
ones in a few words: a token is read without decoding what stands before it.
"""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .tokens import encoded, slices

MAGIC = b"DAC1"
CHUNK_BITS = 8
RANK_BITS = 512


def pack(ids: np.ndarray) -> bytes:
    """The codes of a run of ids: magic, count of levels, then each level's size, chunks, bitmap and directory."""
    rest = np.asarray(ids, np.uint32)
    out, levels = [], 0
    while True:
        more = rest >> CHUNK_BITS
        goes_on = more > 0
        out.append(struct.pack("<QB", len(rest), bool(goes_on.any())))
        out.append((rest & 0xFF).astype(np.uint8).tobytes())
        levels += 1
        if not goes_on.any():
            break
        bits = np.packbits(goes_on, bitorder="little")
        bits = np.append(bits, np.zeros(-len(bits) % (RANK_BITS // 8), np.uint8))
        ones = np.bitwise_count(bits.reshape(-1, RANK_BITS // 8)).sum(axis=1, dtype=np.uint64)
        out += [bits.tobytes(), (np.cumsum(ones) - ones).astype("<u8").tobytes()]
        rest = more[goes_on]
    return MAGIC + struct.pack("<B", levels) + b"".join(out)


class Codes:
    """Random access to packed ids; nothing is decoded but what is asked for."""

    def __init__(self, data: bytes):
        if data[:4] != MAGIC:
            raise ValueError("no directly addressable codes")
        self.levels = []
        at = 5
        for _ in range(data[4]):
            size, more = struct.unpack_from("<QB", data, at)
            at += 9
            chunks = np.frombuffer(data, np.uint8, size, at)
            at += size
            bits = ranks = None
            if more:
                blocks = -(-size // RANK_BITS)
                bits = np.frombuffer(data, np.uint8, blocks * RANK_BITS // 8, at)
                at += len(bits)
                ranks = np.frombuffer(data, "<u8", blocks, at)
                at += 8 * blocks
            self.levels.append((chunks, bits, ranks))

    def __len__(self) -> int:
        return len(self.levels[0][0])

    @staticmethod
    def _ones(bits: np.ndarray, ranks: np.ndarray, i: int) -> int:
        """Ones before position i."""
        if i // RANK_BITS == len(ranks):  # past the last full block
            block = len(ranks) - 1
            return int(ranks[block]) + int(np.bitwise_count(bits[block * RANK_BITS // 8 :]).sum()) if len(ranks) else 0
        from_byte = i // RANK_BITS * RANK_BITS // 8
        n = int(ranks[i // RANK_BITS]) + int(np.bitwise_count(bits[from_byte : i // 8]).sum(dtype=np.int64))
        return n + (int(bits[i // 8]) & ((1 << i % 8) - 1)).bit_count() if i % 8 else n

    def token(self, i: int) -> int:
        value = shift = 0
        for chunks, bits, ranks in self.levels:
            value |= int(chunks[i]) << shift
            if bits is None or not bits[i // 8] >> (i % 8) & 1:
                return value
            i, shift = self._ones(bits, ranks, i), shift + CHUNK_BITS
        return value

    def tokens(self, start: int, end: int) -> np.ndarray:
        """Ids start .. end - 1."""
        return self._from(0, start, end)

    def _from(self, level: int, start: int, end: int) -> np.ndarray:
        chunks, bits, ranks = self.levels[level]
        out = chunks[start:end].astype(np.uint32)
        if bits is not None and end > start:
            first = start // 8
            on = np.unpackbits(bits[first : -(-end // 8)], bitorder="little")[start - 8 * first : end - 8 * first].astype(bool)
            n = int(np.count_nonzero(on))
            if n:
                at = self._ones(bits, ranks, start)
                out[on] |= self._from(level + 1, at, at + n) << np.uint32(CHUNK_BITS)
        return out


FILE_SCHEMA = "part int, block int, start long, doc_ids array<bigint>, sizes array<bigint>, codes binary"


class TokenFiles:
    """Documents as ids on disk: Parquet files whose rows are blocks of whole documents in ascending doc_id order.

    A row has its part (a range of doc_ids), its number in the part, the ids before it in the part, the documents'
    ids and token counts, and the codes. Null texts are empty; a document without ids has size 0 (1 with an end id);
    repeated rows are written as often as they come; null doc_ids come last; no documents give no rows. Columns other
    than the id and the text are not read.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def write(
        self,
        docs: DataFrame,
        tokenizer: str,
        end: int | None,
        doc_id: str = "doc_id",
        text: str = "text",
        block_tokens: int = 500_000,
    ) -> TokenFiles:
        """Encode and write. ``block_tokens``: a block ends with the document that reaches it."""

        def blocks(batches):
            part, block, start = TaskContext.get().partitionId(), 0, 0
            ids, keys, held = [], [], 0

            def row():
                sizes = [len(x) for x in ids]
                codes = pack(np.concatenate(ids))
                return pa.RecordBatch.from_pydict(
                    {
                        "part": pa.array([part], pa.int32()),
                        "block": pa.array([block], pa.int32()),
                        "start": pa.array([start], pa.int64()),
                        "doc_ids": pa.array([keys], pa.list_(pa.int64())),
                        "sizes": pa.array([sizes], pa.list_(pa.int64())),
                        "codes": pa.array([codes], pa.binary()),
                    }
                )

            for batch in batches:
                for a, b in slices(batch.column(1)):
                    own = batch.column(0).slice(a, b - a).to_pylist()
                    for key, x in zip(own, encoded(tokenizer, batch.column(1).slice(a, b - a).to_pylist(), end)):
                        keys.append(key)
                        ids.append(x)
                        held += len(x)
                        if held >= block_tokens:
                            yield row()
                            block, start, ids, keys, held = block + 1, start + held, [], [], 0
            if keys:
                yield row()

        rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
        order = F.col("doc_id").asc_nulls_last()
        dealt = rows.repartitionByRange(order).sortWithinPartitions(order)
        dealt.mapInArrow(blocks, FILE_SCHEMA).write.parquet(self.path)
        return self

    def blocks(self) -> DataFrame:
        """The files' rows, with ``first``: the ids before the block in all documents.

        What lies before a part is added up over one row a part, which is what the broadcast holds: as many rows as
        the writing job had partitions.
        """
        rows = self.spark.read.schema(FILE_SCHEMA).parquet(self.path)
        size = F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x)
        parts = rows.groupBy("part").agg(F.sum(size).alias("n"))
        before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
        offsets = parts.select(F.col("part").alias("_part"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_before"))
        return (
            rows.join(F.broadcast(offsets), F.col("part") == F.col("_part"))
            .withColumn("first", F.col("_before") + F.col("start"))
            .drop("_part", "_before")
        )

    def documents(self) -> DataFrame:
        """Every document read back: doc_id, start (ids of all documents before it), n_tokens, ids (little-endian)."""

        def read(batches):
            for batch in batches:
                for key, sizes, codes, first in zip(*(batch.column(i) for i in range(4))):
                    codes, sizes = Codes(codes.as_py()), np.array(sizes.as_py(), np.int64)
                    ends = np.cumsum(sizes)
                    step = max(1, 4_000_000 // max(1, int(ends[-1] // len(ends))))
                    for a in range(0, len(sizes), step):
                        b = min(a + step, len(sizes))
                        ids = [codes.tokens(int(e - n), int(e)).astype("<u4").tobytes() for e, n in zip(ends[a:b], sizes[a:b])]
                        yield pa.RecordBatch.from_arrays(
                            [
                                key.values.slice(a, b - a),
                                pa.array(first.as_py() + ends[a:b] - sizes[a:b], pa.int64()),
                                pa.array(sizes[a:b], pa.int64()),
                                pa.array(ids, pa.binary()),
                            ],
                            ["doc_id", "start", "n_tokens", "ids"],
                        )

        return self.blocks().select("doc_ids", "sizes", "codes", "first").mapInArrow(
            read, "doc_id long, start long, n_tokens long, ids binary"
        )

    def tokens_at(self, places: DataFrame, place: str = "place") -> DataFrame:
        """The id at each place of the whole corpus (places from 0): place, token. Places outside give no row.

        Each place finds its block by range and reads one code there.
        """

        def look(batches):
            for batch in batches:
                places, tokens = [], []
                for asked, first, codes in zip(*(batch.column(i) for i in range(3))):
                    own = asked.as_py()
                    codes, first = Codes(codes.as_py()), first.as_py()
                    places += own
                    tokens += [codes.token(x - first) for x in own]
                yield pa.RecordBatch.from_arrays([pa.array(places, pa.int64()), pa.array(tokens, pa.int64())], ["place", "token"])

        size = F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x)
        blocks = self.blocks().select("part", "block", "first", (F.col("first") + size).alias("last"))
        asked = places.select(F.col(place).cast("long").alias("place")).where(F.col("place").isNotNull()).distinct()
        # Blocks and places meet in cells as wide as a block usually is; a block lies in the cells it touches.
        wide = 500_000
        cells = blocks.withColumn(
            "cell", F.explode(F.sequence(F.floor(F.col("first") / wide), F.floor((F.col("last") - 1) / wide)))
        )
        found = (
            asked.withColumn("cell", F.floor(F.col("place") / wide)).join(cells, "cell")
            .where((F.col("place") >= F.col("first")) & (F.col("place") < F.col("last")))
            .groupBy("part", "block", (F.col("place") % 64).alias("share")).agg(F.collect_list("place").alias("places"), F.first("first").alias("first"))
        )
        rows = self.spark.read.schema(FILE_SCHEMA).parquet(self.path).select("part", "block", "codes")
        return found.join(rows, ["part", "block"]).select("places", "first", "codes").mapInArrow(look, "place long, token long")
