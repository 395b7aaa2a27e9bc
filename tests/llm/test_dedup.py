import hashlib
import itertools
import random
from collections import defaultdict

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import functions as F

from zonereach.llm import exact_dedup as exact_dedup_module
from zonereach.llm.base import components
from zonereach.llm.exact_dedup import DigestIndex, exact_dedup, resolve
from zonereach.llm.simhash import Forest, blocks, hex_digits, links, near_dedup, near_groups, text_fingerprints

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
BLANKS = " \t\n\x0b\x0c\r"


def words(text):
    out, now = [], ""
    for c in (text or "").translate(LOWER) + " ":
        if c in BLANKS:
            if now:
                out.append(now)
            now = ""
        else:
            now += c
    return out


def fingerprint(text, k=3):
    w = words(text)
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(" ".join(w[i : i + k]).encode(), 42) for i in range(max(1, len(w) - k + 1))]
    return sum((2 * sum(x >> b & 1 for x in h) > len(h)) << b for b in range(64))


def roots(nodes, pairs):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_an_index_is_rebuilt_with_more_buckets(spark, scratch):
    index = DigestIndex.temporary(spark, 4)
    for low in (0, 40, 80):
        resolve(index, spark.range(low, low + 60).selectExpr("id as doc_id", "concat('t', id) as text"), scratch)
    name = f"rebuilt_{index.name}"
    again = index.rebuilt(name, scratch.path("rebuilt"), 16)
    try:
        rows = lambda x: sorted((bytes(r.digest), r.keep_id, r.group_size) for r in x.entries().collect())
        assert rows(again) == rows(index) and len(rows(index)) == 140
        assert len(again.entries().inputFiles()) <= 16 < len(index.entries().inputFiles()) + 8
        more = spark.createDataFrame([(500, "t3"), (501, "new")], "doc_id long, text string")
        assert sorted((r.doc_id, r.kept) for r in resolve(again, more, scratch).collect()) == [(500, False), (501, True)]
    finally:
        again.drop()
    assert exact_dedup_module.buckets_for(0) == 64 and exact_dedup_module.buckets_for(10**11) == 100_000


def test_many_copies_of_one_row(spark, scratch, monkeypatch):
    monkeypatch.setattr(exact_dedup_module, "COPY_RUN", 7)
    rows = [(1, "a")] * 50 + [(2, "a")] * 7 + [(None, None)] * 15 + [(3, "")]
    got = resolve(DigestIndex.temporary(spark, 4), spark.createDataFrame(rows, "doc_id long, text string"), scratch).collect()
    assert len(got) == len(rows)
    assert sorted((r.doc_id or 0, r.keep_id, r.group_size, r.kept) for r in got) == sorted(
        [(1, 2, 57, False)] * 50 + [(2, 2, 57, i == 0) for i in range(7)] + [(0, 3, 16, False)] * 15 + [(3, 3, 16, True)]
    )


def test_exact_groups(spark, cases, scratch):
    rows = cases.select("doc_id", "text").collect()
    by = defaultdict(list)
    for r in rows:
        by[r.text or ""].append(r.doc_id)
    index = DigestIndex.temporary(spark, 4)
    got = resolve(index, cases, scratch).collect()
    assert len(got) == len(rows)
    want = defaultdict(int)
    for text, ids in by.items():
        known = [i for i in ids if i is not None]
        top = max(known) if known else None
        digest = hashlib.sha256(text.encode()).digest()
        for n, i in enumerate(sorted(ids, key=lambda i: (i is None, i or 0))):
            kept = i == top and i not in sorted(ids, key=lambda i: (i is None, i or 0))[:n]
            want[i, top, len(ids), kept, digest] += 1
    seen = defaultdict(int)
    for r in got:
        seen[r.doc_id, r.keep_id, r.group_size, r.kept, bytes(r.digest)] += 1
    assert seen == want
    assert index.entries().count() == len(by)
    kept = exact_dedup(DigestIndex.temporary(spark, 4), cases, scratch)
    assert kept.columns == cases.columns
    assert sorted(r.text or "" for r in kept.collect()) == sorted(by)
    # An id whose texts partly stay.
    twice = spark.createDataFrame([(1, "a"), (1, "b"), (2, "a"), (2, "c"), (None, "c"), (3, "b"), (3, "b")], "doc_id long, text string")
    kept = exact_dedup(DigestIndex.temporary(spark, 4), twice, scratch).collect()
    assert sorted((r.doc_id, r.text) for r in kept) == [(2, "a"), (2, "c"), (3, "b")]


def test_index_remembers(spark, cases, empty, scratch):
    index = DigestIndex.temporary(spark, 4)
    first = cases.where("doc_id < 50")
    resolve(index, first, scratch).collect()
    again = resolve(index, first.withColumn("doc_id", first.doc_id + 1000), scratch)
    assert again.where("kept").count() == 0 and again.where("keep_id >= 1000").count() == 0
    before = index.entries().count()
    assert resolve(index, empty, scratch).count() == 0 and index.entries().count() == before
    files = spark.sql(f"describe extended {index.name}").where("col_name like 'Bucket%' or col_name like 'Sort%'").collect()
    assert any("digest" in r.data_type for r in files)


def test_index_outlives_its_session(spark, cases, scratch):
    path = scratch.path("index")
    resolve(DigestIndex(spark, "kept_index", path, buckets=4), cases, scratch).collect()
    spark.sql("drop table kept_index")  # as a new session would not know it; the files stay
    index = DigestIndex(spark, "kept_index", path, buckets=4)
    assert index.entries().count() == cases.select(F.coalesce("text", F.lit(""))).distinct().count()
    assert resolve(index, cases.withColumn("doc_id", F.col("doc_id") + 5000), scratch).where("kept").count() == 0
    index.drop()


def test_exact_main_path_is_native(spark, cases, scratch):
    plan = resolve(DigestIndex.temporary(spark, 4), cases, scratch)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_fingerprints_are_the_definition():
    rng = random.Random(3)
    texts = [" ".join(rng.choices(["Aa", "b", "ç", "dd d", "EÉ", "f,"], k=n)) for n in [0, 1, 2, 3, 4, 5, 50, 400]]
    texts += ["\t\nA  b\r\nC \x0b", "", " "]
    got = text_fingerprints(pa.array(texts), 3)
    assert got.tolist() == [fingerprint(t) for t in texts]


def test_trees_follow_only_near_edges_and_find_all():
    rng = np.random.default_rng(1)
    centre = rng.integers(0, 1 << 63, 30, dtype=np.uint64)
    values = np.unique(np.concatenate([centre] + [centre ^ (np.uint64(1) << rng.integers(0, 64, 30, dtype=np.uint64)) for _ in range(20)]))
    tree = np.sort(rng.integers(0, 3, len(values)))
    forest = Forest(values, tree)
    parents = {int(n): divmod(int(k), 65) for k, n in zip(forest.keys, forest.nodes)}
    for node, (parent, edge) in parents.items():
        assert int(values[node] ^ values[parent]).bit_count() == edge and tree[node] == tree[parent]
    got = {(int(q), int(v)) for a, b in forest.search(values, tree, 2) for q, v in zip(a, b)}
    want = {
        (i, j) for i in range(len(values)) for j in range(len(values)) if tree[i] == tree[j] and int(values[i] ^ values[j]).bit_count() <= 2
    }
    assert got == want


def test_near_groups_match_brute_force(spark, cases, scratch):
    rows = cases.select("doc_id", "text").collect()
    prints = {(r.doc_id, r.text): fingerprint(r.text) for r in rows}
    nodes = {}
    for (i, _), p in prints.items():
        if i is not None:
            nodes[p] = min(nodes.get(p, i), i)
    near = [(nodes[a], nodes[b]) for a, b in itertools.combinations(nodes, 2) if (a ^ b).bit_count() <= 2]
    root = roots(nodes.values(), near)
    want = sorted((str(r.doc_id), f"{prints[r.doc_id, r.text]:016x}", root[nodes[prints[r.doc_id, r.text]]]) for r in rows)
    got = near_groups(cases, scratch, 3, 2).select("doc_id", hex_digits().alias("f"), "component_id").collect()
    assert sorted((str(r.doc_id), r.f, r.component_id) for r in got) == want
    kept = near_dedup(cases, scratch, 3, 2)
    assert kept.columns == cases.columns
    ids = [r.doc_id for r in kept.select("doc_id").collect()]
    assert sorted(i for i in ids if i is not None) == sorted(set(root.values())) and ids.count(None) == 2


def test_an_id_with_different_texts_keeps_each(spark, scratch):
    rng = random.Random(3)
    a, b, c = (" ".join(f"w{rng.randrange(10**6)}" for _ in range(300)) for _ in range(3))
    rows = [(5, a), (5, b), (5, a), (7, a), (3, c), (6, c), (6, b + " "), (4, c), (4, a + " "), (8, None), (8, ""), (None, a)]
    assert len({fingerprint(t) for t in (a, b, c)}) == 3
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, fingerprint string").repartition(3)
    kept = near_dedup(docs, scratch, 3, 2)
    assert kept.columns == docs.columns
    got = sorted((str(r.doc_id), (r.text or "").strip()) for r in kept.collect())
    assert got == sorted([("3", c), ("4", a), ("5", b), ("8", ""), ("None", a)])


def test_no_documents(spark, empty, scratch):
    assert near_groups(empty, scratch, 3, 2).count() == 0
    assert near_dedup(empty, scratch, 3, 2).count() == 0
    assert exact_dedup(DigestIndex.temporary(spark, 4), empty, scratch).count() == 0


def test_small_trees_lose_no_link(spark, scratch):
    rng = random.Random(9)
    values = {rng.getrandbits(64) for _ in range(40)}
    for v in list(values):
        for _ in range(12):
            v ^= 1 << rng.randrange(40)
            values.add(v)
    signed = [(v - (1 << 64) if v >> 63 else v, i) for i, v in enumerate(sorted(values))]
    prints = spark.createDataFrame(signed, "fingerprint long, node long")
    got = {r.node: r.root for r in components(scratch, links(prints, scratch, 2, tree=16)).collect()}
    order = sorted(values)
    near = [(i, j) for i, j in itertools.combinations(range(len(order)), 2) if (order[i] ^ order[j]).bit_count() <= 2]
    want = roots(range(len(order)), near)
    assert got == {n: r for n, r in want.items() if any(n in p for p in near)}


def test_blocks_grow_with_the_count():
    assert blocks(10, 2) == 3 and blocks(10**8, 2) == 4 and blocks(10**11, 2) > 4


def test_components_of_long_chains(spark, scratch):
    chain = [(i, i + 1) for i in range(0, 200)] + [(500 - i, 501 - i) for i in range(50)] + [(7, 7)]
    got = {r.node: r.root for r in components(scratch, spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(201)}, **{i: 451 for i in range(451, 502)}}
