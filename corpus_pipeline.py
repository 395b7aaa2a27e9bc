"""Training corpus from raw documents: quality, exact and near duplicates, mixing, packing.

In every stage a null text counts as the empty text, texts are taken whole whatever their length, further columns pass
through (packing alone has columns of its own), and an empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from zonereach.llm.base import Scratch, documents
from zonereach.llm.exact_dedup import DigestIndex
from zonereach.llm.exact_dedup import exact_dedup as drop_copies
from zonereach.llm.importance import keep_good
from zonereach.llm.mixing import mixed
from zonereach.llm.packing import pack_documents
from zonereach.llm.queries import END, RADIUS, SHINGLE, TOKENIZER
from zonereach.llm.simhash import near_dedup as drop_near_copies
from zonereach.session import configure


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: documents that the draw leaves out go. Rows of one id stay or go together; empty texts weigh 0 and are
    drawn like others; labels that are null or have no document do not count."""
    labels = configure(spark).read.parquet(f"{sf_dir}/labels.parquet")
    return keep_good(spark, docs, labels, Scratch(spark, "quality"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: of equal texts the one with the largest doc_id stays, one with a null id only if no other has it. A row
    that comes twice with its id and text stays once."""
    configure(spark)
    return drop_copies(DigestIndex.temporary(spark, expected=docs.count()), docs, Scratch(spark, "dedup"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: one document of each group of near-duplicates stays, the one with the smallest doc_id. Texts without
    words are one group. Rows of one id with different texts are judged each by its own group."""
    return drop_near_copies(docs, Scratch(configure(spark), "near"), SHINGLE, RADIUS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: a row for each time the mix takes a document, none where it takes none of it. Documents without a source
    are a source of their own; texts without words come as often as their source's complete epochs."""
    return mixed(docs, Scratch(configure(spark), "mix"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: the token pieces and their places in sequences of 1024. An empty text is its end token; rows that the
    mix took several times are packed each by itself."""
    return pack_documents(docs, Scratch(configure(spark), "pack"), TOKENIZER, END, 1024)


STAGES = [
    ("quality_classifier", quality),
    ("exact_dedup", exact_dedup),
    ("simhash_near_dedup", near_dedup),
    ("source_mixing", mix_sources),
    ("best_fit_packing", pack_sequences),
]
# Random numbers, hashes and a tokenizer decide; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each result is written as Parquet and read again as the next one's input."""
    scratch = Scratch(spark, "pipeline")
    docs = documents(configure(spark), sf_dir)
    for name, stage in STAGES:
        docs = scratch.table(stage(spark, docs, sf_dir), name)
    return docs
