"""SimHash near-duplicates: BK-trees of fingerprints, children keyed by integer Hamming distance to the parent."""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from .base import Scratch, components, unused
from .text_arrays import Words
from .tokens import slices
from .unions import stars

BITS = 64
SEED = 42
SHINGLES_AT_ONCE = 200_000
# Fingerprints of one tree; a larger shard is several trees.
TREE = 1024
# A partition's trees are grown and searched together, about so many fingerprints at a time.
FOREST = 32_768


def text_fingerprints(column: pa.Array, shingle: int) -> np.ndarray:
    """Fingerprint of each text of a pyarrow column."""
    from xxhash import xxh64_intdigest

    words = Words(column, lower=True)
    counts = np.diff(words.first)
    # The words of all texts with single blanks between them: a shingle is then one run of bytes.
    lengths = words.ends - words.starts + 1
    at = np.cumsum(lengths) - lengths
    take = np.arange(int(lengths.sum())) + np.repeat(words.starts - at, lengths)
    joined = words.data[take]
    joined[at + lengths - 1] = 0x20
    view = memoryview(joined)
    n = np.where(counts >= shingle, counts - shingle + 1, np.minimum(counts, 1))
    text = np.repeat(np.arange(len(counts)), n)
    begin = np.arange(len(text)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(words.first[:-1], n)
    last = np.minimum(begin + shingle, words.first[1:][text]) - 1
    start, end = at[begin], at[last] + lengths[last] - 1
    ones = np.zeros((len(counts), BITS), np.int64)
    for a in range(0, len(text), SHINGLES_AT_ONCE):
        b = min(a + SHINGLES_AT_ONCE, len(text))
        h = np.array([xxh64_intdigest(view[s:e], SEED) for s, e in zip(start[a:b].tolist(), end[a:b].tolist())], np.uint64)
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        own = text[a:b]
        cuts = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
        ones[own[cuts]] += np.add.reduceat(bits, cuts, axis=0, dtype=np.int64)
    majority = (2 * ones > n[:, None]).astype(np.uint8)
    return np.packbits(majority, axis=1, bitorder="little").view(np.uint64).ravel()


def fingerprints(docs: DataFrame, shingle: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and fingerprint (long, the bits of the unsigned number) of every row; null and empty texts give 0."""

    def run(batches):
        for batch in batches:
            for a, b in slices(batch.column(1)):
                found = text_fingerprints(batch.column(1).slice(a, b - a), shingle)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(found.view(np.int64))], ["doc_id", "fingerprint"])

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return rows.mapInArrow(run, "doc_id long, fingerprint long")


class Forest:
    """BK-trees of many shards, grown together: the same trees as by inserting each shard's values one by one.

    In every step the first value of each group becomes a node, and the others of the group fall into its children by
    their distance to it; the next step takes the children as groups.
    """

    def __init__(self, values: np.ndarray, tree: np.ndarray):
        """``tree``: the tree of each value, from 0, ascending."""
        self.values = values
        n = len(values)
        self.root = np.full(int(tree[-1]) + 1 if n else 0, -1)
        group, rest = tree.astype(np.int64), np.arange(n)
        parents, edges, nodes = [], [], []
        parent = edge = None
        while len(rest):
            head = np.append(True, group[1:] != group[:-1])
            pivot = rest[head]
            which = np.cumsum(head) - 1
            if parent is None:
                self.root[group[head]] = pivot
            else:
                parents.append(parent[head])
                edges.append(edge[head])
                nodes.append(pivot)
            keep = ~head
            rest, own = rest[keep], pivot[which[keep]]
            distance = np.bitwise_count(values[rest] ^ values[own]).astype(np.int64)
            group = own * (BITS + 1) + distance
            order = np.argsort(group, kind="stable")
            rest, group, parent, edge = rest[order], group[order], own[order], distance[order]
        if nodes:
            keys = np.concatenate(parents) * (BITS + 1) + np.concatenate(edges)
            order = np.argsort(keys)
            self.keys, self.nodes = keys[order], np.concatenate(nodes)[order]
        else:
            self.keys, self.nodes = np.empty(0, np.int64), np.empty(0, np.int64)

    def search(self, queries: np.ndarray, tree: np.ndarray, radius: int):
        """Pairs (query, value) within the radius, in runs; only edges within the radius are followed."""
        query = np.flatnonzero(self.root[tree] >= 0)
        node = self.root[tree[query]]
        while len(query):
            ahead = []
            for a in range(0, len(query), 1 << 20):
                q, v = query[a : a + (1 << 20)], node[a : a + (1 << 20)]
                distance = np.bitwise_count(queries[q] ^ self.values[v]).astype(np.int64)
                near = distance <= radius
                if near.any():
                    yield q[near], v[near]
                base = v * (BITS + 1)
                low = np.searchsorted(self.keys, base + np.maximum(distance - radius, 0))
                high = np.searchsorted(self.keys, base + np.minimum(distance + radius, BITS), side="right")
                n = high - low
                at = np.arange(int(n.sum())) + np.repeat(low - (np.cumsum(n) - n), n)
                ahead.append((np.repeat(q, n), self.nodes[at]))
            query = np.concatenate([x for x, _ in ahead])
            node = np.concatenate([x for _, x in ahead])


def _links(radius: int):
    """For partitions of (shard key, tile, node, query, fingerprint, node_id): links as stars inside each forest."""

    def forest(tile, is_node, is_query, values, ids):
        # The same node may stand in several tiles; its links are told by its id.
        own, at = np.unique(ids, return_inverse=True)
        label = np.arange(len(own))
        nodes, queries = np.flatnonzero(is_node), np.flatnonzero(is_query)
        trees = Forest(values[nodes], tile[nodes])
        for q, v in trees.search(values[queries], tile[queries], radius):
            label = stars(at[queries[q]], at[nodes[v]], label)
        linked = label != np.arange(len(own))
        return pa.RecordBatch.from_arrays([pa.array(own[linked]), pa.array(own[label[linked]])], ["a", "b"])

    def run(batches):
        held, size = [], 0

        def cut(rows: pa.Table, all_of_it: bool):
            tiles = [rows.column(i).to_numpy() for i in range(4)]
            change = np.zeros(len(rows), bool)
            change[0] = True
            for c in tiles:
                change[1:] |= c[1:] != c[:-1]
            if not all_of_it:
                end = int(np.flatnonzero(change)[-1])
                if end == 0:
                    return None, rows
            else:
                end = len(rows)
            is_node, is_query, values, ids = (rows.column(i).to_numpy()[:end] for i in range(4, 8))
            return forest(np.cumsum(change[:end]) - 1, is_node, is_query, values.view(np.uint64), ids), rows.slice(end)

        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size >= FOREST:
                found, rest = cut(pa.Table.from_batches(held).combine_chunks(), False)
                if found is not None:
                    yield found
                held, size = rest.to_batches(), len(rest)
        if size:
            yield cut(pa.Table.from_batches(held).combine_chunks(), True)[0]

    return run


def blocks(count: int, radius: int, load: int = 4) -> int:
    """Into how many blocks to cut a fingerprint. Two that differ in at most ``radius`` bits agree on all blocks but
    ``radius``; the fewest blocks for which chance puts at most ``load`` of ``count`` into one shard."""
    b = radius + 1
    while b < BITS // 2 and count > load * 2 ** (BITS * (b - radius) // b):
        b += 1
    return b


def links(prints: DataFrame, scratch: Scratch, radius: int, tree: int = TREE) -> DataFrame:
    """Links (a, b) between node ids that connect the same fingerprints as all pairs within ``radius`` bits do.

    ``prints``: fingerprint, node, distinct in both. Trees are sharded by the bits that near fingerprints share: each
    fingerprint is in a shard for every choice of blocks, and a pair within the radius meets in at least one. A shard
    of more than ``tree`` fingerprints is cut into trees of about that size, and each tree is sent to the searches of
    the whole shard, tree by tree, so no task holds more than two trees' worth of one shard. Links go out as stars.
    """
    b = blocks(prints.count(), radius)
    edges = [BITS * i // b for i in range(b + 1)]
    masks = []
    for chosen in itertools.combinations(range(b), b - radius):
        m = sum(((1 << (edges[i + 1] - edges[i])) - 1) << edges[i] for i in chosen)
        masks.append(m - (1 << BITS) if m >> (BITS - 1) else m)
    keyed = prints.select(
        "fingerprint",
        "node",
        F.posexplode(F.array(*[F.col("fingerprint").bitwiseAND(F.lit(m)) for m in masks])).alias("choice", "key"),
    )
    shards = keyed.groupBy("choice", "key").agg(F.count("*").alias("n")).where("n > 1")
    cut = shards.select(F.col("choice").alias("_c"), F.col("key").alias("_k"), F.ceil(F.col("n") / tree).cast("int").alias("trees"))
    own = F.pmod(F.xxhash64("fingerprint"), F.col("trees")).cast("int")
    met = keyed.join(cut, (F.col("choice") == F.col("_c")) & (F.col("key") == F.col("_k"))).select(
        "choice", "key", "fingerprint", "node", own.alias("own"), F.explode(F.sequence(F.lit(0), F.col("trees") - 1)).alias("other")
    )
    # Tile (i, j), i <= j: the tree of part i, searched by part j.
    tiles = met.select(
        F.col("choice").cast("int").alias("choice"),
        "key",
        F.least("own", "other").alias("i"),
        F.greatest("own", "other").alias("j"),
        (F.col("own") <= F.col("other")).alias("is_node"),
        (F.col("own") >= F.col("other")).alias("is_query"),
        "fingerprint",
        "node",
    )
    where = ["choice", "key", "i", "j"]
    dealt = tiles.repartition(F.xxhash64(*where)).sortWithinPartitions(*where)
    return scratch.table(dealt.mapInArrow(_links(radius), "a long, b long"), "links")


def _grouped(docs: DataFrame, scratch: Scratch, shingle: int, radius: int, doc_id: str, text: str) -> DataFrame:
    """doc_id, fingerprint, component_id and root of every row. The root is the component's own even where the smallest
    doc_id of several components is the same, as ids that stand at different texts are no link."""
    rows = scratch.table(fingerprints(docs, shingle, doc_id, text), "fingerprints")
    firsts = rows.groupBy("fingerprint").agg(F.min("doc_id").alias("node")).where("node is not null")
    firsts = scratch.table(firsts, "nodes")
    # The smallest id of a fingerprint names its node, unless it names another one too.
    unique = not firsts.groupBy("node").count().where("count > 1").limit(1).count()
    nodes = firsts if unique else scratch.table(firsts.select("fingerprint", F.col("fingerprint").alias("node")), "nodes")
    found = components(scratch, links(nodes, scratch, radius)).withColumnRenamed("node", "_node")
    named = nodes.join(found, nodes.node == F.col("_node"), "left").select(
        F.col("fingerprint").alias("_fingerprint"), F.coalesce("root", "node").alias("root")
    )
    named = scratch.table(named, "named")
    if unique:
        named = named.withColumn("component_id", F.col("root"))
    else:
        least = firsts.join(named, firsts.fingerprint == F.col("_fingerprint")).groupBy("root").agg(F.min("node").alias("component_id"))
        named = scratch.table(named.join(least, "root"), "named")
    found = rows.join(named, rows.fingerprint == F.col("_fingerprint"), "left")
    return found.select("doc_id", "fingerprint", "component_id", "root")


def near_groups(
    docs: DataFrame, scratch: Scratch, shingle: int, radius: int, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """doc_id, fingerprint, component_id of every row.

    Fingerprints at ``radius`` or fewer differing bits are linked; component_id is the smallest doc_id reachable by
    links, the row's own included. Equal fingerprints are one node, so copies cost one row however many they are.
    Null and empty texts have fingerprint 0 and are linked like any other. Rows with a null doc_id get the component of
    their fingerprint, null if no row with an id is in it. Repeated rows are reported as often as they come. An empty
    table gives no rows. Texts of any length are read whole; other columns are not read.
    """
    return _grouped(docs, scratch, shingle, radius, doc_id, text).drop("root")


def with_fingerprint(docs: DataFrame, shingle: int, text: str, name: str) -> DataFrame:
    """``docs`` with all columns and the fingerprint of each row's text as ``name``."""
    at = docs.columns.index(text)

    def run(batches):
        for batch in batches:
            texts = batch.column(at).fill_null("")
            prints = [text_fingerprints(texts.slice(a, b - a), shingle).view(np.int64) for a, b in slices(texts)]
            found = pa.array(np.concatenate(prints) if prints else np.empty(0, np.int64))
            yield pa.RecordBatch.from_arrays([*batch.columns, found], [*batch.schema.names, name])

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField(name, LongType())]))


def near_dedup(docs: DataFrame, scratch: Scratch, shingle: int, radius: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all columns: of each component the document with the smallest doc_id.

    Rows with a null doc_id stay, as nothing tells them apart; of a component's rows that repeat the kept id one stays.
    Rows of one id with texts of different components are judged each by its own. Rows leave by an anti-join with the
    ids that go, which are usually few: then the texts are not shuffled. Only rows of an id that stays and comes several
    times are held against their fingerprints.
    """
    groups = scratch.table(_grouped(docs, scratch, shingle, radius, doc_id, text).where("doc_id is not null"), "groups")
    ids = groups.groupBy("doc_id").agg(F.max(F.col("doc_id") == F.col("component_id")).alias("kept"), F.count("*").alias("rows"))
    ids = scratch.table(ids, "ids")
    gone = scratch.table(ids.where("not kept").select(F.col("doc_id").alias("gone_id")), "gone")
    out = docs.join(gone, docs[doc_id].cast("long") == gone["gone_id"], "left_anti")
    many = ids.where("kept and rows > 1").select(F.col("doc_id").alias("many_id"))
    if not many.limit(1).count():
        return out
    many = scratch.table(many, "many")
    repeats = out[doc_id].cast("long") == many["many_id"]
    stay = (
        groups.join(many, F.col("doc_id") == F.col("many_id"), "left_semi").where("doc_id = component_id")
        .groupBy("doc_id", "root").agg(F.min("fingerprint").alias("stay_print")).select(F.col("doc_id").alias("stay_id"), "stay_print")
    )
    stay = scratch.table(stay, "stay")
    own = unused(docs, "_print")
    judged = with_fingerprint(out.join(many, repeats, "left_semi"), shingle, text, own)
    judged = judged.join(stay, (judged[doc_id].cast("long") == stay["stay_id"]) & (judged[own] == stay["stay_print"]), "left_semi")
    return out.join(many, repeats, "left_anti").union(judged.dropDuplicates([doc_id, own]).drop(own))


def hex_digits(fingerprint: str = "fingerprint") -> F.Column:
    return F.lpad(F.lower(F.hex(fingerprint)), 16, "0")
