"""Exact similarity links of embeddings by dual traversal of cover trees.

A cover tree has nested levels: the centres of a level stay centres below, and the radius halves from level to level.
Two trees are traversed together from the top; a pair of nodes is left when their centres are further apart than the
threshold plus what their covering radii reach, so every pair of vectors within the threshold is found.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import Scratch, components
from .unions import stars

# Vectors of one tree in a task.
BLOCK = 1024
# Vectors of a label that a top-level node should hold, and how many such nodes all labels may have together.
NODE = 2048
TOP_NODES = 1024
MOST_CENTRES = 8192
# Vectors per top-level node that the net is chosen from.
NET_SAMPLE = 4
# Levels end here; below it the vectors themselves are compared.
LEAST_RADIUS = 0.1


class CoverTree:
    """Levels of centres over unit vectors: for each level the centres, the parents of the centres among the level
    above, and the covering radii (the largest distance of a centre to a vector below it)."""

    def __init__(self, x: np.ndarray):
        self.x = x
        near, who = self._distances(0), np.zeros(len(x), np.int64)
        chosen = [0]
        nets, owners = [np.array([0])], [who.copy()]
        radius = 1.0
        while len(chosen) < len(x) and radius >= LEAST_RADIUS:
            while True:
                far = np.flatnonzero(near > radius)
                if not len(far):
                    break
                c = int(far[0])
                d = self._distances(c)
                closer = d < near
                near[closer], who[closer] = d[closer], len(chosen)
                near[c], who[c] = 0.0, len(chosen)
                chosen.append(c)
            if len(chosen) > len(nets[-1]):
                nets.append(np.array(chosen))
                owners.append(who.copy())
            radius /= 2
        # The last level is the vectors themselves.
        nets.append(np.arange(len(x)))
        self.centres, self.parents, self.radii = nets, [None], []
        for above, centres in zip(owners, nets[1:]):
            self.parents.append(above[centres])
        # Radii of what really lies below: go up from the vectors through the parents.
        at = np.arange(len(x))
        radii = [np.zeros(len(x))]
        for level in range(len(nets) - 1, 0, -1):
            at = self.parents[level][at]
            d = np.sqrt(np.maximum(((x - x[nets[level - 1][at]]) ** 2).sum(axis=1), 0))
            reach = np.zeros(len(nets[level - 1]))
            np.maximum.at(reach, at, d)
            radii.append(reach)
        self.radii = radii[::-1]

    def _distances(self, i: int) -> np.ndarray:
        return np.sqrt(np.maximum(2 - 2 * (self.x @ self.x[i]), 0))

    def level(self, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Centres, parents and radii of a level; below the last one every vector goes on as its own child."""
        if k < len(self.centres):
            return self.centres[k], self.parents[k], self.radii[k]
        return self.centres[-1], np.arange(len(self.x)), self.radii[-1]


def links(a: CoverTree, b: CoverTree, cosine: float) -> np.ndarray:
    """Pairs (row of a, row of b) with at least that cosine, as a matrix of booleans."""
    reach = np.sqrt(2 - 2 * cosine) + 1e-9
    depth = max(len(a.centres), len(b.centres))
    alive = np.ones((1, 1), bool)
    for k in range(depth):
        ca, pa_, ra = a.level(k)
        cb, pb, rb = b.level(k)
        if k:
            alive = alive[pa_][:, pb]
        rows, columns = np.flatnonzero(alive.any(axis=1)), np.flatnonzero(alive.any(axis=0))
        if not len(rows):
            return np.zeros((len(a.x), len(b.x)), bool)
        dots = a.x[ca[rows]] @ b.x[cb[columns]].T
        last = k == depth - 1
        if last:
            near = dots >= cosine
        else:
            near = np.sqrt(np.maximum(2 - 2 * dots, 0)) <= reach + ra[rows][:, None] + rb[columns][None]
        kept = np.zeros_like(alive)
        kept[np.ix_(rows, columns)] = near
        alive &= kept
    out = np.zeros((len(a.x), len(b.x)), bool)
    out[np.ix_(a.level(depth - 1)[0], b.level(depth - 1)[0])] = alive
    return out


def unit(vectors: np.ndarray) -> np.ndarray:
    v = vectors.astype(np.float64)
    v /= np.abs(v).max(axis=1, keepdims=True)  # large and tiny components neither overflow nor vanish
    return v / np.sqrt((v * v).sum(axis=1, keepdims=True))


def _matrix(column: pa.Array) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(len(column), -1)


def _pairs_in_tiles(cosine: float):
    """Rows (tile, side, node, copies, vector), sorted by tile: links of each vector, as counts and as stars."""

    def tile(side, node, copies, vectors):
        x = unit(vectors)
        left, right = np.flatnonzero(side <= 0), np.flatnonzero(side >= 0)  # side 0 is both
        alone = len(left) == len(side) == len(right)
        first = CoverTree(x[left])
        found = links(first, first if alone else CoverTree(x[right]), cosine)
        if alone:
            np.fill_diagonal(found, False)
        counts = np.zeros(len(side), np.int64)
        counts[left] += found @ copies[right]
        if not alone:
            counts[right] += found.T @ copies[left]
        i, j = np.nonzero(found)
        order = np.argsort(node)
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        label = stars(rank[left[i]], rank[right[j]], np.arange(len(order)))
        linked = counts > 0
        return pa.RecordBatch.from_arrays(
            [pa.array(node[linked]), pa.array(counts[linked]), pa.array(node[order][label[rank]][linked])], ["node", "links", "root"]
        )

    def tiles(table: pa.Table, cuts: list[int]):
        for a, b in zip(cuts, cuts[1:]):
            if b - a > 1:
                own = table.slice(a, b - a).combine_chunks()
                side, node, copies = (own.column(c).to_numpy() for c in ("side", "node", "copies"))
                if (side > 0).all() or (side < 0).all():
                    continue  # the other block is empty
                yield tile(side, node, copies, _matrix(own.column("vector").combine_chunks()))

    def run(batches):
        rest: list = []
        for batch in batches:
            table = pa.Table.from_batches([*rest, batch])
            keys = table.column("tile").to_numpy()
            cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist()]
            # The last tile waits for the next batch.
            yield from tiles(table, cuts)
            rest = table.slice(cuts[-1]).to_batches()
        if rest:
            table = pa.Table.from_batches(rest)
            yield from tiles(table, [0, len(table)])

    return run


def _net(sample: list, nodes: dict) -> list[tuple]:
    """Centres for the labels in ``nodes`` (label: how many): each next one is the vector furthest from those so far,
    so the first centres of a label are a net of a large radius, and more of them nest in nets of smaller ones."""
    out = []
    by: dict = {}
    for label, size, vector in sample:
        by.setdefault((label, size), []).append(vector)
    for (label, size), vectors in sorted(by.items()):
        x = unit(np.array(vectors))
        near, chosen = np.full(len(x), np.inf), []
        while len(chosen) < nodes[label, size] and near.max() > 0:
            c = int(near.argmax())
            chosen.append(c)
            near = np.minimum(near, np.sqrt(np.maximum(2 - 2 * x @ x[c], 0)))
            near[c] = 0
        out += [(label, size, x[c]) for c in chosen]
    return out


def _assign(centres: list[tuple]):
    """Top node of each vector and the distance to its centre; labels without a net are one node, -1."""
    by: dict = {}
    for i, (label, size, x) in enumerate(centres):
        by.setdefault((label, size), []).append((i, x))
    nets = {k: (np.array([i for i, _ in v]), np.array([x for _, x in v])) for k, v in by.items()}

    def run(batches):
        for batch in batches:
            labels, sizes = (batch.column(batch.schema.get_field_index(c)).to_numpy(zero_copy_only=False) for c in ("label", "size"))
            top, distance = np.full(len(labels), -1, np.int64), np.zeros(len(labels))
            vectors = batch.column(batch.schema.get_field_index("vector"))
            for key, (ids, net) in nets.items():
                own = np.flatnonzero((labels == key[0]) & (sizes == key[1]))
                if len(own):
                    d = 2 - 2 * unit(_matrix(vectors.take(pa.array(own)))) @ net.T
                    best = d.argmin(axis=1)
                    top[own], distance[own] = ids[best], np.sqrt(np.maximum(d[np.arange(len(own)), best], 0))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in range(batch.num_columns)), pa.array(top), pa.array(distance)], [*batch.schema.names, "top", "distance"]
            )

    return run


def similarity_links(
    vectors: DataFrame, scratch: Scratch, cosine: float, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label"
) -> DataFrame:
    """vec_id, n_links, component_id, kept of every row.

    Vectors of one label and one dimension are linked when their cosine in double precision is at least ``cosine``
    (above 0). Null labels, null ids, and vectors that are null, empty, zero or hold null or non-finite components
    link with nothing: n_links 0, component_id their own id. Rows of one id with different vectors are linked each by its
    own vector. component_id is the smallest id reachable by links, kept
    says whether that is the row's own. Equal vectors are one point with a count, so copies never become pairs; a row
    repeated with the same id counts as one more copy. No rows in, no rows out; other columns are not read.

    The top levels of the trees are a net of centres for each label, at most TOP_NODES squared pairs of them and
    MOST_CENTRES in all, chosen from a sample of about NET_SAMPLE vectors a centre; every vector then goes to its nearest centre, and pairs of nodes beyond the covering radii are left there.
    Nodes are cut into blocks of BLOCK vectors, and a task gets the vectors of two blocks. All pairs of nodes that are
    near enough are compared, so where the dimension is so high that no node is left out, work is the square of a
    label's distinct vectors; memory is not.
    """
    v = F.col(embedding).cast("array<double>")
    scalar = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))
    usable = (
        F.col(label).isNotNull() & F.col(vec_id).isNotNull() & v.isNotNull() & (F.size(v) > 0) & ~F.exists(v, scalar) & F.exists(v, lambda x: x != 0)
    )
    rows = scratch.table(
        vectors.select(
            F.col(vec_id).cast("long").alias("vec_id"),
            F.col(label).cast("string").alias("label"),
            F.when(F.coalesce(usable, F.lit(False)), F.transform(v, lambda x: x + F.lit(0.0))).alias("vector"),
        ).withColumn("point", F.when(F.col("vector").isNotNull(), F.xxhash64("label", "vector"))),
        "rows",
    )
    # Points that share a hash are told apart by the vector itself.
    points = (
        rows.where("vector is not null").groupBy("label", "point", "vector")
        .agg(F.min("vec_id").alias("first"), F.count("*").alias("copies"))
        .withColumn("size", F.size("vector"))
        .withColumn("number", F.monotonically_increasing_id())
    )
    points = scratch.table(points, "points")
    # The smallest id of a point names its node, unless an id stands at several vectors.
    unique = not points.groupBy("first").count().where("count > 1").limit(1).count()
    points = points.withColumn("node", F.col("first") if unique else F.col("number")).drop("number")
    sizes = points.groupBy("label", "size").agg(F.count("*").alias("n"))
    large = sizes.where(F.col("n") > NODE).withColumn("wanted", F.ceil(F.col("n") / NODE))
    total = large.agg(F.sum("wanted").alias("nodes"), F.sum(F.col("wanted") * F.col("wanted")).alias("pairs")).first()
    # Both the centres and the pairs of centres of one label are bounded.
    shrink = min(1.0, TOP_NODES / np.sqrt(float(total.pairs)), MOST_CENTRES / float(total.nodes)) if total.nodes else 1.0
    netted = large.withColumn("wanted", F.floor(F.col("wanted") * shrink)).where("wanted > 1")
    wanted = {(r.label, r.size): (int(r.wanted), r.n) for r in netted.collect()}
    drawn = points.join(F.broadcast(netted.select("label", "size", "wanted", "n")), ["label", "size"]).where(
        F.pmod(F.xxhash64("node"), F.lit(1 << 30)) < F.lit(float(NET_SAMPLE << 30)) * F.col("wanted") / F.col("n")
    )
    sample = [tuple(r) for r in drawn.orderBy("label", "node").select("label", "size", "vector").collect()] if wanted else []
    centres = _net(sample, {k: w for k, (w, _) in wanted.items()})
    kind = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in points.schema)
    placed = scratch.table(points.mapInArrow(_assign(centres), f"{kind}, top long, distance double"), "placed")
    nodes = placed.groupBy("label", "size", "top").agg(F.max("distance").alias("radius"), F.count("*").alias("n"))
    nodes = nodes.withColumn("blocks", F.ceil(F.col("n") / BLOCK).cast("int"))
    # Dual traversal of the nets: the pairs of all labels together are at most TOP_NODES squared.
    tops = {r.top: r for r in nodes.where("top >= 0").collect()}
    of_label: dict = {}
    for i in sorted(tops):
        of_label.setdefault(centres[i][:2], []).append(i)
    reach = np.sqrt(2 - 2 * cosine) + 1e-9
    near = []
    for keys in of_label.values():
        radius = np.array([tops[i].radius for i in keys])
        x = np.array([centres[i][2] for i in keys])
        for n, i in enumerate(keys):
            d = np.sqrt(np.maximum(2 - 2 * x[n:] @ x[n], 0))
            for m in np.flatnonzero(d <= reach + radius[n:] + radius[n]).tolist():
                j = keys[n + m]
                near.append((i, j, tops[i].blocks, tops[j].blocks))
    spark = vectors.sparkSession
    both = {(i, j, bi, bj, True) for i, j, bi, bj in near} | {(j, i, bj, bi, False) for i, j, bi, bj in near if i != j}
    pairs = spark.createDataFrame(sorted(both), "a long, b long, own int, others int, low boolean")
    block = lambda n: F.pmod(F.xxhash64("node"), n).cast("int")
    columns = ["label", "size", "node", "copies", "vector"]
    with_net = (
        placed.where("top >= 0").join(F.broadcast(pairs), F.col("top") == F.col("a"))
        .select(*columns, "a", "b", "low", block(F.col("own")).alias("mine"), F.explode(F.sequence(F.lit(0), F.col("others") - 1)).alias("other"))
    )
    # Labels without a net: one node; only those of more than one block need a list of blocks, at most NODE rows apart.
    alone = nodes.where("top < 0").select(F.col("label").alias("_l"), F.col("size").alias("_s"), "blocks")
    without = (
        placed.where("top < 0").join(alone, (F.col("label") == F.col("_l")) & (F.col("size") == F.col("_s")))
        .select(
            *columns, F.lit(-1).cast("long").alias("a"), F.lit(-1).cast("long").alias("b"), F.lit(True).alias("low"),
            block(F.col("blocks")).alias("mine"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"),
        )
    )
    tiles = with_net.union(without)
    same = F.col("a") == F.col("b")
    before = F.when(same, F.col("mine") <= F.col("other")).otherwise(F.col("low"))
    tile = F.xxhash64(
        "label", "size", F.least("a", "b"), F.greatest("a", "b"),
        F.when(before, F.col("mine")).otherwise(F.col("other")), F.when(before, F.col("other")).otherwise(F.col("mine")),
    )
    side = F.when(same & (F.col("mine") == F.col("other")), 0).when(before, -1).otherwise(1)
    dealt = tiles.select(tile.alias("tile"), side.alias("side"), "node", "copies", "vector").repartition("tile").sortWithinPartitions("tile")
    found = scratch.table(dealt.mapInArrow(_pairs_in_tiles(cosine), "node long, links long, root long"), "links")
    groups = components(scratch, found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    degrees = found.groupBy("node").agg(F.sum("links").alias("links"))
    named = (
        points.join(degrees, "node", "left").join(groups, "node", "left")
        .select(
            F.col("label").alias("_label"), F.col("point").alias("_point"), F.col("vector").alias("_vector"), "first",
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("root", "node").alias("component_id"),
        )
    )
    named = scratch.table(named, "named")
    if not unique:
        least = named.groupBy(F.col("component_id").alias("_root")).agg(F.min("first").alias("_least"))
        named = named.join(least, F.col("component_id") == F.col("_root")).withColumn("component_id", F.col("_least")).drop("_root", "_least")
    named = named.drop("first")
    out = rows.join(
        named, (rows.label == F.col("_label")) & (rows.point == F.col("_point")) & (rows.vector == F.col("_vector")), "left"
    )
    component = F.coalesce("component_id", "vec_id")
    return out.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        component.eqNullSafe(F.col("vec_id")).alias("kept"),
    )
