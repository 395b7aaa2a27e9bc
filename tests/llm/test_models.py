import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from zonereach.llm import backoff, importance, toxicity
from zonereach.llm.base import least_by_hash
from zonereach.llm.text_arrays import Words

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
SF = "/root/testdata/sf0.01"


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


def held_out(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 10 == 0


def test_words_of_arrays():
    texts = ["", None, "a", " A b\t\nÉc ", "\x0b", "x" * 70_000, "1a!! |%% b"]
    found = Words(pa.array(texts), lower=True)
    own = [bytes(found.data[s:e]).decode() for s, e in zip(found.starts, found.ends)]
    assert own == [w for t in texts for w in words(t)]
    assert np.diff(found.first).tolist() == [len(words(t)) for t in texts]
    runs = Words(pa.array(["1a!! |%% bé2", ""]), lower=False, runs=True)
    assert [bytes(runs.data[s:e]).decode() for s, e in zip(runs.starts, runs.ends)] == ["1", "a", "!!", "|%%", "bé", "2"]
    hashes = Words(pa.array(["ab abc ab", "abc"]), lower=True).hashes(2)
    assert hashes[0][0] == hashes[0][2] and hashes[0][1] == hashes[0][3] != hashes[0][0]
    assert len(set(hashes[1].tolist())) == 1


def brute_scores(rows):
    tokens = [words(r.text) + ["</end>"] for r in rows]
    train = [t for t, r in zip(tokens, rows) if not held_out(r.doc_id)]
    c, pairs = Counter(w for t in train for w in t), Counter(p for t in train for p in zip(["<begin>"] + t, t))
    n, v = sum(c.values()), len(c)
    seen = dict(c) | {"<begin>": len(train)}

    def unigram(w):
        freed = backoff.DISCOUNT * v / n / (v + 1) if n else 1 / (v + 1)
        return max(c[w] - backoff.DISCOUNT, 0) / max(n, 1) + freed

    out = []
    for r, t in zip(rows, tokens):
        base = sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in t)
        score = 0.0
        for h, w in zip(["<begin>"] + t, t):
            m = backoff.PSEUDO * seen.get(h, 0) ** backoff.GROWTH
            score += math.log10((pairs[h, w] + m * unigram(w)) / (seen[h] + m) if seen.get(h) else unigram(w))
        out.append((str(r.doc_id), held_out(r.doc_id), len(t), sum(c[w] > 0 for w in t), n, round(base, 7), round(score, 7)))
    return sorted(out)


def brute_scores_of_three(rows):
    tokens = [words(r.text) + ["</end>"] for r in rows]
    train = [["<begin>"] + t for t, r in zip(tokens, rows) if not held_out(r.doc_id)]
    grams = [Counter(tuple(t[i : i + k]) for t in train for i in range(len(t) - k + 1)) for k in (1, 2, 3)]
    n = sum(c for g, c in grams[0].items() if g != ("<begin>",))
    v = sum(1 for g in grams[0] if g != ("<begin>",))

    def p(context, w):
        if not context:
            freed = backoff.DISCOUNT * v / n / (v + 1) if n else 1 / (v + 1)
            return max(grams[0][(w,)] - backoff.DISCOUNT, 0) / max(n, 1) + freed
        seen = grams[len(context) - 1][context]
        if not seen:
            return p(context[1:], w)
        m = backoff.PSEUDO * seen**backoff.GROWTH
        return (grams[len(context)][(*context, w)] + m * p(context[1:], w)) / (seen + m)

    out = []
    for r, t in zip(rows, tokens):
        before = ["<begin>"] + t
        out.append((str(r.doc_id), round(sum(math.log10(p(tuple(before[max(0, i - 1) : i + 1]), w)) for i, w in enumerate(t)), 6)))
    return sorted(out)


@pytest.mark.parametrize("run", [1, 2, 256])
def test_scores_of_order_three_match_brute_force(spark, cases, monkeypatch, run):
    texts = [r.text or "" for r in cases.select("text").collect() if len(r.text or "") < 4000]
    block = backoff.Block(pa.array(texts))
    tables = []
    for _, keys, _ in block.keys(3):
        tables += backoff._counted(keys, np.ones(len(keys)))
    auto = backoff.Automaton(*tables[:4], int(tables[1].sum()), len(tables[0]), *tables[4:])
    monkeypatch.setattr(backoff, "RUN", 10_000)
    whole = auto.traverse(block.tokens, block.first)
    monkeypatch.setattr(backoff, "RUN", run)
    assert np.allclose(auto.traverse(block.tokens, block.first), whole)
    if run == 256:
        for block_bytes in (3000, 10**9):
            got = backoff.backoff_scores(cases, block_bytes=block_bytes, order=3).collect()
            assert sorted((str(r.doc_id), round(r.score, 6)) for r in got) == brute_scores_of_three(cases.select("doc_id", "text").collect())
    with pytest.raises(ValueError):
        backoff.backoff_scores(cases, order=4)


def results(df):
    return sorted(
        (str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 7), round(r.score, 7)) for r in df.collect()
    )


@pytest.mark.parametrize("block_bytes", [500, 20_000, 10**9])
def test_scores_match_brute_force(cases, block_bytes):
    assert results(backoff.backoff_scores(cases, block_bytes=block_bytes)) == brute_scores(cases.select("doc_id", "text").collect())


def test_scores_without_training_or_documents(spark, empty):
    assert backoff.backoff_scores(empty).count() == 0
    only = [i for i in range(200) if held_out(i)][:3]
    df = spark.createDataFrame([(i, "a b") for i in only], "doc_id long, text string")
    assert results(backoff.backoff_scores(df)) == brute_scores(df.collect())


def test_weights_of_a_state_sum_to_one():
    texts = pa.array(["a b a c", "a b", "c c b"])
    block = backoff.Block(texts)
    keys, counts = backoff._counted(block.tokens, np.ones(len(block.tokens)))
    pairs, pair_counts = backoff._counted(backoff.pair_keys(block.context, block.tokens), np.ones(len(block.tokens)))
    auto = backoff.Automaton(keys, counts, pairs, pair_counts, int(counts.sum()), len(keys))
    unknown = backoff.DISCOUNT * auto.v / auto.n / (auto.v + 1)
    assert abs(auto.root.sum() + unknown - 1) < 1e-12
    for state in range(1, len(auto.seen)):
        if auto.state_hash[state] == backoff.END:
            continue
        total = unknown * auto.share[state]
        for w in range(len(keys)):
            at = np.searchsorted(pairs, backoff.pair_keys(auto.state_hash[[state]], keys[[w]]))[0]
            hit = at < len(pairs) and pairs[at] == backoff.pair_keys(auto.state_hash[[state]], keys[[w]])[0]
            p = auto.share[state] * auto.root[w]
            total += p + ((1 - auto.share[state]) * pair_counts[at] / auto.seen[state] if hit else 0)
        assert abs(total - 1) < 1e-9


def test_runs_carry_the_state(monkeypatch):
    rng = np.random.default_rng(1)
    texts = pa.array([" ".join(rng.choice(list("abcde"), n)) for n in (0, 1, 5, 700)])
    block = backoff.Block(texts)
    words_, counts = backoff._counted(block.tokens, np.ones(len(block.tokens)))
    pairs, pair_counts = backoff._counted(backoff.pair_keys(block.context, block.tokens), np.ones(len(block.tokens)))
    auto = backoff.Automaton(words_, counts, pairs, pair_counts, int(counts.sum()), len(words_))
    whole = auto.traverse(block.tokens, block.first)
    for run in (1, 3, 10_000):
        monkeypatch.setattr(backoff, "RUN", run)
        assert np.allclose(auto.traverse(block.tokens, block.first), whole)


def test_tokens_are_numbered_once_and_never_searched(monkeypatch):
    rng = np.random.default_rng(3)
    texts = pa.array([" ".join(rng.choice(list("abcdefgh"), n)) for n in (0, 1, 5, 700)] + ["a b a", None])
    table = pa.table({"doc_id": pa.array(range(len(texts))), "text": texts, "training": [True, False, True, True, False, True]})
    answers = backoff._answer(backoff._count(1)((pa.scalar(0),), table))
    block = backoff.Block(texts)
    for name, keys, which, _ in block.tables(3):
        own = {n: k for n, k, _ in block.keys(3)}[name]
        assert (np.diff(keys.astype(object)) > 0).all() and (keys[which] == own).all() and set(which) == set(range(len(keys)))
    counts = [np.concatenate([backoff._numbers(x.as_py(), "<u8") for x in answers.column(f"{n}_counts")]).astype(np.int64) for n in ("word", "pair")]
    auto = backoff.Automaton(*[x for t, c in zip(block.tables(2), counts) for x in (t[1], c)], int(counts[0].sum()), int((counts[0] > 0).sum()))
    searched = auto.traverse(block.tokens, block.first)
    monkeypatch.setattr(backoff.Automaton, "_found", None)
    got = backoff._score((pa.scalar(0),), table, answers)
    assert got.column("score").to_pylist() == searched.tolist()


def test_words_with_one_polynomial_hash_are_two(spark):
    """Two letters by the parity of set bits: polynomials modulo a power of two cannot tell such words apart."""
    twins = ["".join("ab"[(bin(i).count("1") + k) % 2] for i in range(1024)) for k in (0, 1)]
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 10 == 0)
    train = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 10)
    df = spark.createDataFrame([(train, f"{twins[0]} and {twins[0]}"), (held, f"{twins[1]} and")], "doc_id long, text string")
    assert results(backoff.backoff_scores(df)) == brute_scores(df.collect())
    assert {r.doc_id: r.n_known for r in backoff.backoff_scores(df).collect()} == {train: 4, held: 2}


def test_words_that_share_64_bits_are_two(spark, monkeypatch):
    digest = backoff.xxhash.xxh3_128_digest
    block = backoff.Block(pa.array(["one two three one", "", None]))
    assert len(block.words) == 4 and len(block.marks) == 4
    # Blocks that bring different words under the same first half: their counts stay apart by the second half.
    monkeypatch.setattr(backoff.xxhash, "xxh3_128_digest", lambda w: b"\x07" * 8 + digest(w)[8:] if w in (b"one", b"two") else digest(w))
    rows = []
    for k, word in enumerate(("one", "two", "one")):
        out = backoff._count(1)((pa.scalar(k),), pa.table({"text": [word], "training": [True]}))
        rows.append(out)
    answers = backoff._answer(pa.concat_tables(rows))
    got = [backoff._numbers(x.as_py(), "<u8").tolist() for x in answers.column("word_counts")]
    assert [sorted(g) for g in got] == [[2, 3], [1, 3], [2, 3]]


def toy(rng, n):
    """Texts of harmless words; label 1 has a marked word, of a stem that never comes alone."""
    plain = ["the", "of", "sun", "tree", "walk", "house", "and", "green", "river"]
    texts, labels = [], []
    for i in range(n):
        t = list(rng.choice(plain, rng.integers(5, 60)))
        y = int(i % 3 == 0)
        if y:
            t.insert(rng.integers(0, len(t)), rng.choice(["stupid,", "scum", "lowei" + rng.choice(["a", "b", "ch"])]))
        texts.append(" ".join(t))
        labels.append(y)
    return texts, np.array(labels)


def test_toxicity_learns_and_holds():
    rng = np.random.default_rng(2)
    model = toxicity.train(pa.array(toy(rng, 900)[0], pa.large_string()), toy(np.random.default_rng(2), 900)[1], toxicity.Settings(buckets=4096))
    texts, labels = toy(rng, 300)
    scores = model.scores(toxicity.Texts(pa.array(texts), model.settings))
    assert ((scores >= 0.5) == labels).mean() > 0.95
    assert scores.min() >= 0 and scores.max() <= 1
    one = toxicity.train(pa.array(["a", "b"]), np.array([1, 1]), toxicity.Settings(buckets=64))
    assert one.scores(toxicity.Texts(pa.array(["", "x"]), one.settings)).min() > 0.5


def test_pooling_is_the_definition():
    model = toxicity.Model.fresh(toxicity.Settings(buckets=128, dimension=3, filters=2))
    texts = toxicity.Texts(pa.array(["a bb ccc dd", "", "x"]), model.settings)
    got = model.pooled(texts.ids, texts.first)
    for t, (a, b) in enumerate(zip(texts.first, texts.first[1:])):
        x = model.embeddings[texts.ids[a:b]].sum(axis=1)
        want = []
        for w, kernel in zip(model.settings.widths, model.kernels):
            rows = np.vstack([x, np.zeros((w, 3))])
            want.append(np.max([rows[i : i + w].ravel() @ kernel for i in range(len(x))], axis=0))
        assert np.allclose(got[t], np.concatenate(want), atol=1e-5)


def test_languages_and_thresholds_come_from_the_text():
    texts = toxicity.Texts(pa.array(["the end of the day", "der Hund und die Katze", "le chat et les oiseaux", "los dos y el perro", "", "zzz"]), toxicity.Settings())
    assert [toxicity.LANGUAGES[i] for i in texts.language] == ["en", "de", "fr", "es", "other", "other"]


def test_toxicity_scores_of_cases(spark, cases, empty):
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, None), (None, 1), (99999, 0)], "doc_id long, toxic int")
    model = toxicity.learn(cases, labels)
    got = toxicity.score(cases, model).collect()
    assert len(got) == cases.count() and all(0 <= r.score <= 1 for r in got)
    by = {}
    texts = {r.doc_id: r.text for r in cases.select("doc_id", "text").collect() if r.doc_id is not None}
    for r in got:
        if r.doc_id is not None:
            assert by.setdefault(texts[r.doc_id] or "", r.score) == r.score
    assert toxicity.score(empty, model).count() == 0
    assert toxicity.learn(empty, labels.limit(0)).bias < 0


def test_toxicity_on_held_out_documents(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    rows = toxicity.score(docs, toxicity.learn(docs, labels)).where(toxicity.fold() == 0).join(labels, "doc_id").collect()
    y, p = np.array([r.toxic for r in rows]), np.array([r.score >= 0.5 for r in rows])
    assert p[y == 0].mean() < 0.03 and p[y == 1].mean() > 0.75


def test_grams_count_shapes():
    a = importance.Grams(pa.array(["Word word word", "", None, "A | b | C"]))
    assert a.texts == 4 and a.counts().sum() == len(a.bucket) == (3 + 2 + 1) + (5 + 4 + 3)
    weights = np.arange(importance.BUCKETS, dtype=float)
    assert a.sums(weights).tolist() == [sum(weights[b] for b, t in zip(a.bucket, a.text) if t == i) for i in range(4)]


def test_corpus_counts_cover_all_texts(spark, cases):
    texts = pa.array([r.text for r in cases.select("text").collect()])
    assert (importance.corpus_counts(cases) == importance.Grams(texts).counts()).all()


def test_draw_is_the_top_k(spark, cases, empty, scratch):
    weights = importance.Weights(np.random.default_rng(1).normal(0, 0.1, importance.BUCKETS), 0.0)
    rows = importance.resample(cases, scratch, weights).collect()
    texts = {(r.doc_id, r.text) for r in cases.select("doc_id", "text").collect()}
    want = sorted(round(float(importance.Grams(pa.array([t])).sums(weights.ratio)[0]), 9) for _, t in texts)
    assert sorted({(r.doc_id, round(r.log_weight, 9)) for r in rows}, key=lambda x: x[1])[0][1] == want[0]
    k = sum(r.log_weight >= 0 for r in rows)
    ranked = sorted(rows, key=lambda r: r.rank)
    assert [r.rank for r in ranked] == list(range(len(rows))) and sum(r.kept for r in rows) == k
    assert all(a.key >= b.key for a, b in zip(ranked, ranked[1:])) and all(r.kept == (r.rank < k) for r in rows)
    assert importance.resample(empty, scratch, weights).count() == 0


def test_good_texts_stay_and_junk_goes(spark, scratch):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    kept = importance.keep_good(spark, docs, labels, scratch).select("doc_id").withColumnRenamed("doc_id", "kept_id")
    rows = labels.join(kept, labels.doc_id == kept.kept_id, "left").collect()
    good = [r.kept_id is not None for r in rows if r.quality == 1]
    junk = [r.kept_id is not None for r in rows if r.quality == 0]
    assert np.mean(good) > 0.995 and np.mean(junk) < 0.02


def test_each_text_counts_once(spark, cases, empty):
    texts = sorted({r.text or "" for r in cases.select("text").collect()})
    assert sorted(r.text for r in importance.distinct_texts(cases).collect()) == texts
    assert importance.distinct_texts(empty).count() == 0


def test_copies_without_labels_stay(spark, scratch):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    known = docs.join(labels.where("quality = 1"), "doc_id").groupBy("text").agg(F.min("doc_id").alias("doc_id"))
    picked = known.where("length(text) > 500").orderBy("doc_id").limit(5)
    copies = picked.crossJoin(spark.range(1, 301)).select((F.col("doc_id") + F.col("id") * 10**9).alias("doc_id"), "text")
    kept = importance.keep_good(spark, docs.select("doc_id", "text").union(copies), labels, scratch)
    assert kept.where(f"doc_id >= {10**9}").count() == copies.count() == 1500


def test_driver_gets_no_texts(spark, cases, monkeypatch):
    """The labelled sample and the sums stay with the executors: the driver gets counts and weights alone."""
    taken, collect = [], type(cases).collect

    def noted(df):
        rows = collect(df)
        taken.append((df.columns, len(rows)))
        return rows

    def refused(df):
        raise AssertionError("texts come to the driver")

    kind = type(cases)
    monkeypatch.setattr(kind, "toArrow", refused)
    monkeypatch.setattr(kind, "collect", noted)
    labels = cases.where("doc_id is not null").select("doc_id", F.lit(1).alias("quality")).distinct()
    learnt = importance.learn(cases, labels)
    assert learnt.ratio.any() and learnt.level < 0
    assert all("text" not in columns and (n <= 1 or columns == ["total"]) for columns, n in taken)


def test_quality_without_labels(spark, cases, empty, scratch):
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert importance.keep_good(spark, cases, none, scratch).count() == cases.count()
    assert importance.keep_good(spark, empty, none, scratch).count() == 0


def test_a_sample_by_hash_is_the_smallest_hashes(spark):
    df = spark.range(20_000).selectExpr("id as doc_id", "id % 2 as y").repartition(7)
    for rows in (1, 50, 9_999, 30_000):
        got = [r.doc_id for r in least_by_hash(df, "doc_id", rows).collect()]
        assert got == [r.doc_id for r in df.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows).collect()]
    # Little more than the sample is put in order.
    plan = least_by_hash(df, "doc_id", 50)._jdf.queryExecution().optimizedPlan().toString()
    assert "Filter (xxhash64(" in plan and least_by_hash(df.limit(0), "doc_id", 5).count() == 0
