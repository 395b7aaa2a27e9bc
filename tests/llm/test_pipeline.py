import zlib

import corpus_pipeline
import pytest

from zonereach.llm.simhash import fingerprints

SF = "/root/testdata/sf0.01"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark):
    from zonereach.llm.base import Scratch

    scratch = Scratch(spark, "test-pipeline")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs.collect()]
    for name, stage in corpus_pipeline.STAGES:
        docs = scratch.table(stage(spark, docs, SF), name)
        out.append(docs.collect())
        assert docs.columns == COLUMNS or name == "best_fit_packing"
    return out


def test_each_stage_does_its_work(spark, stages):
    raw, good, exact, near, mixed, packed = stages
    junk = {r.doc_id for r in spark.read.parquet(f"{SF}/labels.parquet").where("quality = 0").collect()}
    clean = {r.doc_id for r in spark.read.parquet(f"{SF}/labels.parquet").where("quality = 1").collect()}
    ids = lambda rows: {r.doc_id for r in rows}
    assert len(ids(good) & junk) < 0.5 * len(junk) and len(ids(good) & clean) > 0.9 * len(clean)
    last = {}
    for r in good:
        last[r.text] = max(last.get(r.text, -1), r.doc_id)
    assert ids(exact) == set(last.values()) and len(exact) == len(last)
    prints = {r.doc_id: r.fingerprint % (1 << 64) for r in fingerprints(spark.createDataFrame(exact), 3).collect()}
    group = {i: i for i in prints}
    changed = True
    while changed:
        changed = False
        for a in prints:
            for b in prints:
                if (prints[a] ^ prints[b]).bit_count() <= 2 and group[b] > group[a]:
                    group[b], changed = group[a], True
    assert ids(near) == {i for i, g in group.items() if i == g}
    assert ids(mixed) <= ids(near) and len(mixed) > len(near) * 0.5
    by = {r.doc_id: r for r in near}
    assert all(tuple(r) == tuple(by[r.doc_id]) for r in mixed)
    assert {r.doc_id for r in packed} == ids(mixed)
    ends, total = {}, {}
    for r in packed:
        ends[r.sequence_id] = max(ends.get(r.sequence_id, 0), r.offset + r.length)
        total[r.sequence_id] = total.get(r.sequence_id, 0) + r.length
    assert ends == total and max(ends.values()) <= 1024


def test_reruns_agree(spark, stages):
    again = corpus_pipeline.run(spark, SF).collect()
    mark = lambda rows: sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows)
    assert zlib.crc32(repr(mark(again)).encode()) == zlib.crc32(repr(mark(stages[-1])).encode())


def test_registered():
    import __spark_entry__

    names = __spark_entry__.queries()
    assert "pipeline" in names and sorted(int(n[2 : n.index("_")]) for n in names if n.startswith("op") and n[2].isdigit()) == list(range(1, 14))


@pytest.fixture
def folder(spark, tmp_path):
    """A data folder with labels for some of the cases: null and missing ids, null labels."""
    labels = [(i, int(i % 7 != 0), 0) for i in range(60)] + [(None, 1, 0), (61, None, 1), (99999, 1, 0)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    return str(tmp_path)


def chain(spark, docs, folder, scratch):
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        docs = scratch.table(stage(spark, docs, folder), name)
        out.append(docs)
    return out


def test_the_chain_on_nulls_ties_and_long_texts(spark, cases, folder, scratch):
    raw, good, exact, near, mixed, packed = chain(spark, cases, folder, scratch)
    assert all(df.columns == cases.columns for df in (good, exact, near, mixed))
    texts = lambda df: [r.text or "" for r in df.select("text").collect()]
    kept = texts(good)
    # Every distinct text that is left stays once through exact dedup, and no stage brings in a new one.
    assert sorted(texts(exact)) == sorted(set(kept)) and set(texts(near)) <= set(kept) and set(texts(mixed)) <= set(texts(near))
    assert "A" * 3000 in kept and max(map(len, texts(near))) > 9000
    ends, total = {}, {}
    for r in packed.collect():
        ends[r.sequence_id] = max(ends.get(r.sequence_id, 0), r.offset + r.length)
        total[r.sequence_id] = total.get(r.sequence_id, 0) + r.length
    assert ends == total and max(ends.values()) <= 1024
    assert packed.where("doc_id is not null").select("doc_id").distinct().count() == mixed.where("doc_id is not null").select("doc_id").distinct().count()


def test_the_chain_on_an_empty_table(spark, empty, folder, scratch):
    assert [df.count() for df in chain(spark, empty, folder, scratch)] == [0] * 6
