"""Exact deduplication against a persistent digest index, bucketed and sorted by hash."""

from __future__ import annotations

import atexit
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import Scratch, remove, shared_dir
from .base import unused


BUCKET_ROWS = 1_000_000
LEAST_BUCKETS = 64
# Copies of one id and text are written out in runs of this many.
COPY_RUN = 4096


def buckets_for(rows: int) -> int:
    """Buckets of about BUCKET_ROWS entries each."""
    return max(LEAST_BUCKETS, -(-rows // BUCKET_ROWS))


class DigestIndex:
    """Digests of all texts seen so far, one row per distinct text, in a table bucketed and sorted by digest.

    ``add`` takes a batch, finds its new digests by a sort-merge anti-join and appends them; a digest that is there already
    keeps its first entry. The index is not shuffled for that; its buckets are sorted again as they are read, since a
    bucket has a file for each batch. The table lives in the shared folder and outlasts the session: open it again with
    the same name and path. ``rebuilt`` makes one file of each bucket, and more buckets where the index has grown.
    """

    def __init__(self, spark: SparkSession, name: str, path: str | None = None, buckets: int = 64):
        self.spark, self.name, self.buckets = spark, name, buckets
        self.path = path or f"{shared_dir(spark)}/{name}"
        if not spark.catalog.tableExists(name):
            spark.sql(
                f"create table {name} (digest binary, keep_id bigint, group_size bigint) using parquet "
                f"clustered by (digest) sorted by (digest) into {buckets} buckets location '{self.path}'"
            )

    @classmethod
    def temporary(cls, spark: SparkSession, buckets: int | None = None, expected: int = 0) -> DigestIndex:
        """An empty index for one run, with buckets for the ``expected`` rows; its table goes when the driver ends."""
        index = cls(spark, f"digest_index_{uuid.uuid4().hex[:12]}", buckets=buckets or buckets_for(expected))
        atexit.register(remove, spark, index.path)
        atexit.register(index.drop)
        return index

    def entries(self) -> DataFrame:
        return self.spark.table(self.name)

    def rebuilt(self, name: str, path: str | None = None, buckets: int | None = None) -> DigestIndex:
        """The same entries in a new index with ``buckets`` (default: as many as its entries need), a file each."""
        index = DigestIndex(self.spark, name, path, buckets or buckets_for(self.entries().count()))
        index._append(self.entries())
        return index

    def drop(self) -> None:
        if self.spark.sparkContext._jsc is not None:
            self.spark.sql(f"drop table if exists {self.name}")

    def add(self, groups: DataFrame) -> None:
        """Append the groups (digest, keep_id, group_size) whose digest is new."""
        known = self.entries().select("digest").hint("merge")
        self._append(groups.join(known, "digest", "left_anti").select("digest", "keep_id", "group_size"))

    def _append(self, entries: DataFrame) -> None:
        (
            entries.repartition(self.buckets, "digest")
            .write.mode("append")
            .format("parquet")
            .bucketBy(self.buckets, "digest")
            .sortBy("digest")
            .saveAsTable(self.name)
        )


def digest(text: F.Column) -> F.Column:
    """SHA-256 of the whole text in UTF-8, as 32 bytes; null counts as the empty text."""
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256))


def resolve(index: DigestIndex, docs: DataFrame, scratch: Scratch, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Add a batch to the index and say for each of its rows which document stays.

    Returns doc_id, keep_id, group_size, kept, digest, a row for every row of ``docs``. Within a batch the largest
    doc_id of equal texts stays (null ids last); a text the index knew before keeps the document it came with, so all
    copies in the batch go. group_size counts the rows of the batch that brought the digest in. Null texts are equal
    to empty ones. A row repeated with the same id and text is kept once. An empty batch gives no rows. Other columns
    are not read, whatever their names.

    Hot groups are counted before the shuffle; the way back to the rows is a sort-merge join that the adaptive plan
    splits by size.
    """
    rows = scratch.table(docs.select(F.col(doc_id).cast("long").alias("doc_id"), digest(F.col(text)).alias("digest")), "digests")
    groups = rows.groupBy("digest").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
    index.add(groups)
    # What the index holds for each digest of the batch; its own file, so that both sides below may be split.
    held = scratch.table(
        rows.select("digest").distinct().join(index.entries().hint("merge"), "digest"), "held"
    )
    copies = rows.groupBy("digest", "doc_id").agg(F.count("*").alias("copies"))
    found = copies.join(held.hint("merge"), "digest")
    return found.select(
        "doc_id",
        "keep_id",
        "group_size",
        "copies",
        F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(copies - 1) div {COPY_RUN}"))).alias("run"),
        "digest",
    ).select(
        "doc_id",
        "keep_id",
        "group_size",
        F.explode(F.expr(f"sequence(run * {COPY_RUN} + 1, least(copies, (run + 1) * {COPY_RUN}))")).alias("copy"),
        "digest",
    ).select(
        "doc_id",
        "keep_id",
        "group_size",
        (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)).alias("kept"),
        "digest",
    )


def exact_dedup(index: DigestIndex, docs: DataFrame, scratch: Scratch, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns; cases as in ``resolve``.

    Rows leave by an anti-join with the ids of which no row stays; these are usually few, and then the texts are not
    shuffled. Only where an id has rows that stay and rows that go, a second anti-join also looks at the digest.
    """
    verdicts = scratch.table(resolve(index, docs, scratch, doc_id, text), "verdicts")
    texts = verdicts.groupBy("doc_id", "digest").agg(F.max("kept").alias("kept"))
    ids = texts.groupBy("doc_id").agg(F.max("kept").alias("some"), F.min("kept").alias("all"))
    ids = scratch.table(ids.withColumnRenamed("doc_id", "id"), "ids")
    gone = scratch.table(ids.where("not some").select("id"), "gone")
    out = docs.join(gone, docs[doc_id].cast("long").eqNullSafe(gone["id"]), "left_anti")
    if ids.where("some and not all").limit(1).count():
        partly = texts.where("not kept").join(ids.where("some"), F.col("doc_id").eqNullSafe(F.col("id"))).select("id", "digest")
        partly = scratch.table(partly, "partly")
        same = out[doc_id].cast("long").eqNullSafe(partly["id"]) & (digest(out[text]) == partly["digest"])
        out = out.join(partly, same, "left_anti")
    repeated = verdicts.groupBy("doc_id", "digest").count().where("count > 1").limit(1).count()
    if not repeated:
        return out
    own = unused(docs, "digest")
    return out.withColumn(own, digest(F.col(text))).dropDuplicates([doc_id, own]).drop(own)
