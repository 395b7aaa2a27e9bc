"""Mixing sources to target weights by Efraimidis-Spirakis sampling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .base import WORD, Scratch, running, unused

WEIGHTS = (5, 2, 1)
BUDGET_SHARE = 1.5
MAX_EPOCHS = 2


def words(text: str) -> Column:
    """Number of words of the whole text; null has none."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def quality_weight(text: Column) -> Column:
    """Share of the characters that are no digits or symbols; a text with nothing else keeps a small weight."""
    plain = F.length(F.translate(text, "0123456789!#$%&*|{}<>=\\^~_+", ""))
    return F.coalesce((plain + F.lit(1)) / (F.length(text) + F.lit(1)), F.lit(1.0))


def uniform(doc_id: Column, seed: int) -> Column:
    """A number in (0, 1) from the first 52 bits of an MD5 of seed and id: the same in every run and engine."""
    head = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))), 1, 13)
    return (F.conv(head, 16, 10).cast("long") + F.lit(0.5)) / F.lit(float(1 << 52))


def key(doc_id: Column, text: Column, seed: int) -> Column:
    """The exponential key of Efraimidis and Spirakis: small keys are taken first, heavy documents tend to have them."""
    return -F.log(uniform(doc_id, seed)) / quality_weight(text)


def targets(
    sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = BUDGET_SHARE, most: float = MAX_EPOCHS
) -> DataFrame:
    """Target of each source: (source, source_size, target) from (source, source_size), one row per source.

    Sources in code-point order, null last, take the weights in turn. The budget is ``share`` of all sizes; a target
    stops at ``most`` times its source and the excess goes to the others by weight, until none is above. That is the
    level at which the sum of min(most * size, level * weight) meets the budget; each pass adds two numbers on the
    executors and settles at least one more source, usually many, so few passes are needed.
    """
    order = Window.orderBy(F.col("source").isNull(), F.col("source"))  # one row per source
    weighted = sizes.withColumn(
        "weight",
        F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.row_number().over(order) - 1) % len(weights) + 1),
    )
    total = weighted.agg(F.sum("source_size")).first()[0] or 0
    budget, level = share * total, 0.0
    if total:
        capped = None
        while True:
            full = F.col("source_size") * most <= F.col("weight") * level if capped is not None else F.lit(False)
            r = weighted.agg(
                F.count_if(full).alias("n"),
                F.coalesce(F.sum(F.when(full, F.col("source_size") * most)), F.lit(0.0)).alias("held"),
                F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0.0)).alias("open"),
            ).first()
            if r.n == capped or not r.open:
                break
            capped, level = r.n, (budget - r.held) / r.open
    return weighted.select(
        "source",
        "source_size",
        F.round(F.least(F.col("source_size") * F.lit(float(most)), F.col("weight") * F.lit(level)), 6).alias("target"),
    )


def mix(
    docs: DataFrame,
    scratch: Scratch,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    seed: int = 42,
    **policy,
) -> DataFrame:
    """How often the mix takes each document: doc_id, source, size, source_size, target, taken, epochs (whole ones: whole).

    A source with target t and size s gives floor(t / s) complete epochs. For the rest its documents are ordered by
    -ln(u) / weight, the exponential keys of Efraimidis and Spirakis with the document's quality as weight; a
    document whose prefix sum stays within the rest is taken once more, and so is the one that crosses it if more than
    half of it fits. Equal keys are ordered by doc_id, so reruns agree. Only a size above zero can be taken, so empty
    and null texts have taken 0 (and epochs as often as their source's complete epochs). Repeated rows are separate
    documents with the same key. Null sources form one source, the last. No rows in, no rows out; other columns are
    not read.

    Documents are dealt by range over (source, key): a source that holds a third of all rows is many ranges.
    """
    rows = scratch.table(
        docs.select(
            F.col(doc_id).alias("doc_id"),
            F.col(source).alias("source"),
            words(text).alias("size"),
            key(F.col(doc_id), F.col(text), seed).alias("key"),
        ),
        "sizes",
    )
    sizes = scratch.table(rows.groupBy("source").agg(F.sum("size").alias("source_size")), "sources")
    aims = scratch.table(targets(sizes, **policy), "targets")
    placed = running(scratch, rows, ["source"], ["key", "doc_id"], F.col("size"), "before")
    aims = aims.withColumnRenamed("source", "_source")
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    rest = F.col("target") - F.col("whole") * F.col("source_size")
    more = (F.col("size") > 0) & (F.col("before") + F.col("size") / 2 < rest)
    return (
        placed.join(aims, F.col("source").eqNullSafe(F.col("_source")))
        .withColumn("whole", whole)
        .withColumn("epochs", (F.col("whole") + F.when(more, 1).otherwise(0)).cast("long"))
        .select(
            "doc_id", "source", "size", "source_size", "target", (F.col("epochs") * F.col("size")).alias("taken"), "epochs", "whole", "key"
        )
    )


def mixed(
    docs: DataFrame, scratch: Scratch, doc_id: str = "doc_id", text: str = "text", source: str = "source", seed: int = 42, **policy
) -> DataFrame:
    """The mix itself: each row of ``docs`` as often as its epochs say, with all columns.

    What a source takes beyond its complete epochs is a prefix of its keys, so the last taken key of each source, one
    row a source, says it all: the documents compute their key again and are not shuffled. Rows with the same key and
    id, or without an id, are taken alike where the last taken one is among them.
    """
    rows = mix(docs, scratch, doc_id, text, source, seed, **policy)
    last = F.max(F.when(F.col("epochs") > F.col("whole"), F.struct("key", "doc_id")))
    cuts = rows.groupBy("source").agg(F.max("whole").cast("long").alias("whole"), last.alias("last"))
    cuts = scratch.table(cuts.withColumnRenamed("source", "cut_source"), "cuts")
    met = docs.join(cuts, docs[source].eqNullSafe(cuts["cut_source"]))
    here = F.struct(key(docs[doc_id], docs[text], seed).alias("key"), docs[doc_id].alias("doc_id"))
    more = F.coalesce((here <= cuts["last"]) & docs[text].rlike(WORD), F.lit(False))
    epochs = cuts["whole"] + F.when(more, 1).otherwise(0)
    # sequence would count down from 1 to 0.
    times = F.explode(F.when(epochs > 0, F.sequence(F.lit(1).cast("long"), epochs)).otherwise(F.array().cast("array<bigint>")))
    own = unused(docs, "epoch")
    return met.select(*[docs[c] for c in docs.columns], times.alias(own)).drop(own)
