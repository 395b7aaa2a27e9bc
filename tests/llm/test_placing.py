import math
import zlib
from collections import defaultdict

import numpy as np
import pyarrow.parquet  # noqa: F401

from zonereach.llm.cover_tree import CoverTree, links, similarity_links, unit
from zonereach.llm.kd_shards import kd_shards, write_shards
from zonereach.llm.mixing import mix, mixed, targets
from zonereach.llm.queries import ORACLES, QUERIES


def test_shards_of_near_equal_bytes(spark, cases, empty, scratch):
    copies = spark.range(3000).selectExpr(
        "id as doc_id", "case when id % 3 = 0 then 'hot' else concat('text ', repeat('w ', cast(id % 50 as int)), id) end as text",
        "case id % 4 when 0 then 'en' when 1 then 'de' else null end as lang", "concat('s', id % 5) as source",
    )
    rows = kd_shards(copies, scratch, shards=12).collect()
    assert len(rows) == 3000
    size, slots, shards = defaultdict(int), defaultdict(set), defaultdict(set)
    texts = {r.doc_id: r.text for r in copies.collect()}
    for r in rows:
        t = texts[r.doc_id].encode()
        assert r.size == len(t) + 8 and r.text_crc32 == zlib.crc32(t)
        size[r.shard] += r.size
        slots[r.shard].add(r.slot)
        shards[texts[r.doc_id]].add(r.shard)
    assert set(size) == set(range(12)) and max(size.values()) < 1.03 * min(size.values())
    assert all(s == set(range(len(s))) for s in slots.values())
    assert all(len(s) == 1 for t, s in shards.items() if t != "hot") and len(shards["hot"]) > 1
    got = kd_shards(cases, scratch, target_bytes=20_000).collect()
    assert len(got) == cases.count() and sum(r.size == 8 for r in got) == 3
    assert kd_shards(empty, scratch, shards=4).count() == 0
    path = scratch.path("shards")
    write_shards(cases.where("doc_id < 100"), kd_shards(cases.where("doc_id < 100"), scratch, shards=3), path)
    back = spark.read.parquet(path)
    assert back.count() == 80 and set(cases.columns) < set(back.columns)


def test_targets_fill_up_to_the_cap(spark):
    sizes = {"a": 100, "b": 5000, "c": 70, "é": 900, "z": 10, None: 400}
    rows = targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long")).collect()
    got = {r.source: r.target for r in rows}
    weight = dict(zip(["a", "b", "c", "z", "é", None], [5, 2, 1, 5, 2, 1]))
    left, open_, want = 1.5 * sum(sizes.values()), set(sizes), {}
    while True:
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = {s for s in open_ if share[s] >= 2 * sizes[s]}
        if not over:
            want |= share
            break
        want |= {s: 2 * sizes[s] for s in over}
        left -= sum(2 * sizes[s] for s in over)
        open_ -= over
    assert all(abs(got[s] - want[s]) < 1e-5 for s in sizes)


def test_mix_takes_near_the_targets(spark, cases, empty, scratch):
    rows = mix(cases, scratch).collect()
    assert len(rows) == cases.count()
    by = defaultdict(list)
    for r in rows:
        by[r.source].append(r)
        assert r.taken in (r.size * k for k in range(3)) and r.taken <= 2 * r.size
    for own in by.values():
        assert {r.source_size for r in own} == {sum(r.size for r in own)}
        assert abs(sum(r.taken for r in own) - own[0].target) <= max(r.size for r in own) / 2 + 1
        whole = math.floor(own[0].target / own[0].source_size) if own[0].source_size else 0
        assert all(r.epochs >= whole for r in own)
        # The fractional selection is a prefix of the keys.
        extra = [r.epochs > whole for r in sorted(own, key=lambda r: (r.key, r.doc_id or 1 << 62)) if r.size]
        assert extra == sorted(extra, reverse=True)
    again = sorted((str(r.doc_id), r.taken) for r in mix(cases.repartition(3), scratch).collect())
    assert again == sorted((str(r.doc_id), r.taken) for r in rows)
    assert mix(empty, scratch).count() == 0 and mixed(empty, scratch).count() == 0
    out = mixed(cases, scratch)
    assert out.columns == cases.columns
    counts = defaultdict(int)
    for r in out.select("doc_id").collect():
        counts[r.doc_id] += 1
    assert all(counts[r.doc_id] == r.epochs for r in rows if r.doc_id is not None and r.doc_id != 101)


def test_cover_tree_bounds_hold():
    rng = np.random.default_rng(3)
    x = unit(np.vstack([rng.normal(size=(60, 8)), np.repeat(rng.normal(size=(5, 8)), 20, axis=0) + rng.normal(size=(100, 8)) * 0.03]))
    tree = CoverTree(x)
    at = np.arange(len(x))
    for k in range(len(tree.centres) - 1, 0, -1):
        assert set(tree.centres[k - 1]) <= set(tree.centres[k])
        at = tree.parents[k][at]
        d = np.linalg.norm(x - x[tree.centres[k - 1][at]], axis=1)
        assert (d <= tree.radii[k - 1][at] + 1e-9).all()
    other = CoverTree(x[::3])
    assert (links(tree, other, 0.93) == (x @ x[::3].T >= 0.93)).all()
    assert (links(tree, tree, 0.93) == (x @ x.T >= 0.93)).all()


def brute(rows, cosine):
    good = {}
    for n, r in enumerate(rows):
        v = r.embedding
        if None in (r.label, r.vec_id, v) or not v or any(x is None or not math.isfinite(x) for x in v) or not any(v):
            continue
        good[n] = unit(np.array([v]))[0]
    near = {n: [m for m in good if m != n and rows[n].label == rows[m].label and len(good[n]) == len(good[m]) and good[n] @ good[m] >= cosine] for n in good}
    out = []
    for n, r in enumerate(rows):
        seen, todo = {n}, [n]
        while todo:
            for m in near.get(todo.pop(), []):
                if m not in seen:
                    seen.add(m)
                    todo.append(m)
        ids = [rows[m].vec_id for m in seen]
        low = min(ids) if None not in ids else None
        out.append((str(r.vec_id), len(near.get(n, [])), low, low == r.vec_id))
    return sorted(out, key=str)


def test_similarity_links(spark, scratch, monkeypatch):
    import zonereach.llm.cover_tree as module

    rng = np.random.default_rng(4)
    base = rng.normal(size=(40, 6))
    vectors = np.vstack([base, base[:20] + rng.normal(size=(20, 6)) * 0.1, np.repeat(base[:1], 30, axis=0), base[1:2] * 1e-30, base[2:3] * 1e30])
    rows = [(i, v.tolist(), int(i % 3) if i < 60 else 0, "extra", 1.0, 7) for i, v in enumerate(vectors)]
    nan, inf = float("nan"), float("inf")
    rows += [(900 + i, v, l, None, None, None) for i, (v, l) in enumerate([(None, 1), ([], 1), ([0.0] * 6, 1), ([nan] + [1.0] * 5, 1), ([inf] + [1.0] * 5, 1), ([None] + [1.0] * 5, 1), (base[0].tolist(), None), ([1.0, 2.0], 0), ([2.0, 4.0], 0), ([-0.0, 1.0], 0), ([0.0, 1.0], 0)])]
    rows += [rows[0], (None, base[0].tolist(), 0, None, None, None)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int, node string, links double, root int")
    want = brute(df.collect(), 0.93)
    for node, block in ((module.NODE, module.BLOCK), (12, 8)):
        monkeypatch.setattr(module, "NODE", node)
        monkeypatch.setattr(module, "BLOCK", block)
        got = similarity_links(df, scratch, 0.93).collect()
        assert sorted([(str(r.vec_id), r.n_links, r.component_id, r.kept) for r in got], key=str) == want
    assert similarity_links(df.limit(0), scratch, 0.93).count() == 0


def test_medians_against_sorted_sums(spark):
    from zonereach.llm.kd_shards import KEY_BITS, _medians

    rng = np.random.default_rng(12)
    rows = [(int(n), int(k), int(b)) for n, k, b in zip(rng.integers(0, 3, 4000), rng.integers(0, 1 << KEY_BITS, 4000), rng.integers(1, 900, 4000))]
    rows += [(1, 5, 400)] * 300 + [(2, (1 << KEY_BITS) - 1, 10)] * 50
    points = spark.createDataFrame(rows, "node int, key long, bytes long").repartition(4)
    total = {n: sum(b for m, _, b in rows if m == n) for n in range(3)}
    want = {0: total[0] * 1 / 3, 1: total[1] / 2, 2: total[2] * 23 / 24}
    cuts = _medians(points, want, 200.0)
    for n, w in want.items():
        own = sorted((k, b) for m, k, b in rows if m == n)
        below = sum(b for k, b in own if k < cuts[n])
        weight = {}
        for k, b in own:
            weight[k] = weight.get(k, 0) + b
        # No cut between two keys comes nearer by more than the precision, or the key that no cut can part.
        best = min(abs(sum(b for k, b in own if k < c) - w) for c in [0, *weight, 1 << KEY_BITS])
        assert abs(below - w) <= best + 200


def row_links(rows, cosine):
    """Links of rows, each by its own vector; the component's smallest id over the rows it has."""
    x = [np.array(v) / np.linalg.norm(v) for _, v, _ in rows]
    near = [[j for j in range(len(rows)) if j != i and rows[i][2] == rows[j][2] and x[i] @ x[j] >= cosine] for i in range(len(rows))]
    seen = {}
    for i in range(len(rows)):
        if i not in seen:
            todo, own = [i], {i}
            while todo:
                for j in near[todo.pop()]:
                    if j not in own:
                        own.add(j)
                        todo.append(j)
            seen |= dict.fromkeys(own, min(rows[j][0] for j in own))
    return sorted((r[0], len(near[i]), seen[i], seen[i] == r[0]) for i, r in enumerate(rows))


def test_ids_that_stand_at_several_vectors(spark, scratch):
    plain = [(1, [1.0, 0.0], 0), (1, [0.0, 1.0], 0), (2, [1.0, 0.01], 0), (3, [0.01, 1.0], 0), (3, [-1.0, 0.0], 0)]
    rng = np.random.default_rng(8)
    base = rng.normal(size=(12, 5))
    mixed_up = [(int(rng.integers(0, 25)), (base[i % 12] + rng.normal(size=5) * 0.05).tolist(), int(i % 2)) for i in range(60)]
    for rows in (plain, mixed_up):
        df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(3)
        got = sorted(tuple(r) for r in similarity_links(df, scratch, 0.93).collect())
        assert got == row_links(rows, 0.93)
    assert {(r.vec_id, r.n_links) for r in similarity_links(spark.createDataFrame(plain, "vec_id long, embedding array<double>, label int"), scratch, 0.93).collect()} == {(1, 1), (2, 1), (3, 1), (3, 0)}


def test_many_labels_keep_their_nets(spark, scratch, monkeypatch):
    import zonereach.llm.cover_tree as module

    monkeypatch.setattr(module, "NODE", 8)
    monkeypatch.setattr(module, "BLOCK", 8)
    monkeypatch.setattr(module, "TOP_NODES", 40)
    seen = []
    assign = module._assign
    monkeypatch.setattr(module, "_assign", lambda centres: seen.append(centres) or assign(centres))
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=3).tolist(), i % 50) for i in range(1600)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = sorted(tuple(r) for r in similarity_links(df, scratch, 0.99).collect())
    assert got == row_links(rows, 0.99)
    assert len({c[0] for c in seen[0]}) == 50


def test_queries_with_sql_agree(spark):
    from zonereach.compare import compare, connect

    folder = "/root/testdata/sf0.001"
    con = connect(folder)
    for name, sql in ORACLES.items():
        ok, text = compare(spark, con, name, QUERIES[name], sql, folder)
        assert ok, text
