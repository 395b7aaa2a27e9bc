"""Quality by importance resampling: hashed n-gram models of target and raw text, documents drawn by Gumbel top-k."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .base import Scratch, least_by_hash, running
from .exact_dedup import DigestIndex, exact_dedup
from .mixing import uniform
from .text_arrays import Words, mixed
from .tokens import slices

BUCKETS = 1 << 16
# Bounds of the labelled sample: rows of each label, and the longest text in it.
SAMPLE_ROWS = 4_000
SAMPLE_BYTES = 20_000
# Part of the good texts of the calibration sample that may lie below the level from which documents count as wanted.
LOSS = 0.002
# The level lies so much below that quantile that the noise of the draw hardly ever takes a good text under it.
MARGIN = 4.0
PARTIAL_SUMS = 32


class Grams:
    """Buckets of the n-grams of a run of texts: words, word pairs, and runs of three word shapes.

    A shape is lower, capital, upper or one letter for words, the signs themselves for other runs, and whether a word
    repeats the one before; what marks junk (shouting, tables, signs, stutter) shows in it for words never seen.
    """

    def __init__(self, column: pa.Array):
        words = Words(column, lower=False, runs=True)
        n = len(words.starts)
        h = words.hashes() if n else np.empty(0, np.uint64)
        text = np.repeat(np.arange(len(column)), np.diff(words.first))
        start, size = words.data[words.starts], words.ends - words.starts
        upper = ((words.data >= ord("A")) & (words.data <= ord("Z"))).cumsum()
        capitals = upper[words.ends - 1] - upper[words.starts] + ((start >= ord("A")) & (start <= ord("Z")))
        case = np.where(capitals == 0, 0, np.where((capitals == 1) & (start <= ord("Z")), np.where(size == 1, 2, 1), 3))
        again = np.zeros(n, bool)
        again[1:] = (h[1:] == h[:-1]) & (text[1:] == text[:-1]) & (words.kind[1:] == 1)
        shape = np.where(words.kind == 3, h, mixed((case + 8 * words.kind + 64 * again).astype(np.uint64)))
        one = text[1:] == text[:-1]
        two = one[1:] & one[:-1]
        k = [np.uint64(x) for x in (3, 5, 7)]
        grams = [
            (mixed(h + k[0]), text),
            (mixed(h[:-1] * k[1] + h[1:])[one], text[1:][one]),
            (mixed(shape[:-2] * k[2] + shape[1:-1] * k[1] + shape[2:])[two], text[2:][two]),
        ]
        self.bucket = np.concatenate([(g % np.uint64(BUCKETS)).astype(np.int64) for g, _ in grams])
        self.text = np.concatenate([t for _, t in grams])
        self.texts = len(column)

    def counts(self) -> np.ndarray:
        return np.bincount(self.bucket, minlength=BUCKETS)

    def sums(self, weights: np.ndarray) -> np.ndarray:
        return np.bincount(self.text, weights=weights[self.bucket], minlength=self.texts)


def _texts(docs: DataFrame, text: str) -> F.Column:
    return F.coalesce(F.col(text), F.lit("")).alias("text")


def corpus_counts(docs: DataFrame, text: str = "text") -> np.ndarray:
    """How often each bucket's n-grams stand in all texts. Tasks add up their own, 32 streams of tasks again, and one
    task these, so the driver gets one vector of fixed length whatever the input."""

    def count(batches):
        total = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for a, b in slices(batch.column(0)):
                total += Grams(batch.column(0).slice(a, b - a)).counts()
        yield pa.RecordBatch.from_pydict({"stream": [TaskContext.get().partitionId() % PARTIAL_SUMS], "counts": [total.tobytes()]})

    def add(batches):
        total = None
        for batch in batches:
            for x in batch.column(1):
                own = np.frombuffer(x.as_py(), np.int64)
                total = own.copy() if total is None else total + own
        if total is not None:  # an empty partition has nothing to send
            yield pa.RecordBatch.from_pydict({"stream": [0], "counts": [total.tobytes()]})

    schema = "stream long, counts binary"
    parts = docs.select(_texts(docs, text)).mapInArrow(count, schema)
    sums = parts.repartition(PARTIAL_SUMS, "stream").mapInArrow(add, schema).repartition(1).mapInArrow(add, schema)
    return sum((np.frombuffer(r.counts, np.int64) for r in sums.collect()), np.zeros(BUCKETS, np.int64))


def distinct_texts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Each text of ``docs`` once; null counts as the empty text. Digests and ids are shuffled, not the texts, unless copies
    stand under one id."""
    spark = docs.sparkSession
    index = DigestIndex.temporary(spark, expected=docs.count())
    return exact_dedup(index, docs.select(doc_id, text), Scratch(spark, "distinct"), doc_id, text).select(text)


def labelled(docs: DataFrame, labels: DataFrame, rows: int, most_bytes: int, scratch: Scratch) -> DataFrame:
    """A bounded sample of labelled texts: at most ``rows`` of each label by a hash of the id, none over ``most_bytes``.

    text, y and place, the row's place among those of its label in the order of doc_id. The texts stay with the executors.
    """
    known = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull()).select("doc_id", F.col("quality").alias("y"))
    picked = [least_by_hash(known.where(F.col("y") == y), "doc_id", rows) for y in (0, 1)]
    got = (
        docs.select("doc_id", _texts(docs, "text")).where(F.octet_length("text") <= most_bytes)
        .join(F.broadcast(picked[0].union(picked[1])), "doc_id").orderBy("doc_id", "y").limit(2 * rows)
    )
    place = F.row_number().over(Window.partitionBy("y").orderBy("doc_id")) - 1  # of a bounded sample
    return scratch.table(got.withColumn("place", place).select("text", "y", "place"), "sample")


def text_sums(texts: DataFrame, weights: np.ndarray) -> DataFrame:
    """The sum of the weights of each text's n-grams: total."""
    shared = texts.sparkSession.sparkContext.broadcast(weights)

    def run(batches):
        for batch in batches:
            for a, b in slices(batch.column(0)):
                yield pa.RecordBatch.from_pydict({"total": Grams(batch.column(0).slice(a, b - a)).sums(shared.value)})

    return texts.mapInArrow(run, "total double")


class Weights:
    """log p(n-gram | target) - log p(n-gram | raw) by bucket, and the level that wanted documents reach."""

    def __init__(self, ratio: np.ndarray, level: float):
        self.ratio, self.level = ratio, level


def learn(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, most_bytes: int = SAMPLE_BYTES, loss: float = LOSS) -> Weights:
    """Target: labelled good texts of a bounded sample; raw: every distinct text of ``docs``, once, since the sample need
    not hold the copies of a text in proportion.

    Three quarters of the sample make the target model; the rest set the level: the ``loss`` quantile of the good texts'
    weights, less MARGIN. Without good labels the ratio is 0 and every document is wanted.
    """
    good = labelled(docs, labels, rows, most_bytes, Scratch(docs.sparkSession, "sample")).where("y = 1")
    model, held = good.where("place % 4 != 0").select("text"), good.where("place % 4 = 0").select("text")
    if model.isEmpty():
        return Weights(np.zeros(BUCKETS), -np.inf)
    target = corpus_counts(model)
    raw = corpus_counts(distinct_texts(docs))
    # The target's own texts are in the raw counts too; smoothing in proportion to them keeps rare buckets near 0.
    blended = (target + 8.0 * raw / raw.sum() * BUCKETS) / (target.sum() + 8.0 * BUCKETS)
    ratio = np.log(np.maximum(blended, 1e-300)) - np.log(np.maximum(raw / raw.sum(), 1e-300))
    ratio[raw == 0] = 0.0
    held_weights = np.array([r.total for r in text_sums(held, ratio).collect()] or [0.0])
    return Weights(ratio, min(0.0, float(np.quantile(held_weights, loss))) - MARGIN)


def resample(docs: DataFrame, scratch: Scratch, weights: Weights, doc_id: str = "doc_id", text: str = "text", seed: int = 11) -> DataFrame:
    """Draw documents without replacement: doc_id, log_weight, key, rank, kept.

    log_weight adds the log ratios of all n-grams of the whole text. The k largest keys log_weight + Gumbel noise are
    drawn, with k the number of documents whose weight reaches the level; equal keys by doc_id. The noise comes from
    a hash of the id, so reruns agree. Null and empty texts weigh 0 and are drawn like others. Repeated rows are
    drawn each by itself. No rows in, no rows out; other columns are not read. Ranks come from ranges of keys, so the
    draw is exact and no task sees more than its range.
    """
    shared = docs.sparkSession.sparkContext.broadcast(weights.ratio)

    def run(batches):
        ratio = shared.value
        for batch in batches:
            for a, b in slices(batch.column(1)):
                found = Grams(batch.column(1).slice(a, b - a)).sums(ratio)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(found)], ["doc_id", "log_weight"])

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), _texts(docs, text)).mapInArrow(run, "doc_id long, log_weight double")
    noise = -F.log(-F.log(uniform(F.col("doc_id"), seed)))
    keyed = scratch.table(rows.withColumn("key", F.col("log_weight") + noise).withColumn("_down", -F.col("key")), "keys")
    wanted = keyed.where(F.col("log_weight") >= F.lit(weights.level)).count()
    ranked = running(scratch, keyed, [], ["_down", "doc_id"], name="rank")
    return ranked.select("doc_id", "log_weight", "key", "rank", (F.col("rank") < wanted).alias("kept"))


def keep_good(spark: SparkSession, docs: DataFrame, labels: DataFrame, scratch: Scratch, doc_id: str = "doc_id", **bounds) -> DataFrame:
    """The drawn rows of ``docs``, with all columns. A document stays if any of its repeated rows is drawn; rows with a
    null id stay if one of them is. Null and empty texts weigh 0 and are drawn like others; texts of any length are weighed
    whole. Without good labels every document stays; an empty table gives an empty one."""
    drawn = scratch.table(resample(docs, scratch, learn(docs, labels, **bounds)), "drawn")
    # The ids of a partition are little beside its texts: hashing them saves sorting the texts.
    kept = drawn.where("kept").select(F.col("doc_id").alias("kept_id")).distinct().hint("shuffle_hash")
    return docs.join(kept, docs[doc_id].cast("long").eqNullSafe(kept["kept_id"]), "left_semi")
