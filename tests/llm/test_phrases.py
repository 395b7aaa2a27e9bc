import random
import re
from collections import Counter

import numpy as np
import pytest

from zonereach.llm import phrases
from zonereach.llm.phrases import Suffixes, collocations, cut_text, phrase_counts, quicksort

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def pieces(text):
    return [re.findall(r"[^ \t]+", p) for p in re.split(r"[.,;:!?\n\x0b\x0c\r]", (text or "").translate(LOWER))]


def counted(rows, longest):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = lang or "und"
        for words in pieces(text):
            n[lang] += len(words)
            for k in range(1, longest + 1):
                for i in range(len(words) - k + 1):
                    f[lang, " ".join(words[i : i + k])] += 1
    return f, n


def brute(rows, low=2, longest=3, least=10, cover=50, top=2000):
    f, n = counted(rows, longest)
    own = {k: v for k, v in f.items() if v >= least and low <= k[1].count(" ") + 1}
    longer = Counter()
    for (lang, phrase), a in own.items():
        w = phrase.split(" ")
        for k in range(low, len(w)):
            for i in range(len(w) - k + 1):
                inner = lang, " ".join(w[i : i + k])
                longer[inner] = max(longer[inner], a)
    out = {}
    for (lang, phrase), a in own.items():
        if 100 * longer[lang, phrase] >= cover * a:
            continue
        w = phrase.split(" ")
        cuts = []
        for k in range(1, len(w)):
            left, right = f[lang, " ".join(w[:k])], f[lang, " ".join(w[k:])]
            cuts.append((1000000 * a * a // (left * right), k, left, right))
        score, _, left, right = min(cuts)
        out.setdefault(lang, []).append((-score, -a, phrase.encode(), left, right))
    return sorted(
        (lang, rank, p.decode(), -a, left, right, n[lang], -s)
        for lang, found in out.items()
        for rank, (s, a, p, left, right) in enumerate(sorted(found)[:top], 1)
    )


def corpus(seed, documents=150):
    rng = random.Random(seed)
    words = ["The", "of", "é", "b-c", "x_y", "日本", "q", "zz", "a(", "''"]
    weights = [30, 9, 5, 4, 3, 2, 2, 1, 1, 1]
    rows = []
    for _ in range(documents):
        body = "".join(w + rng.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n"]) for w in rng.choices(words, weights, k=rng.randint(0, 80)))
        rows.append((rng.choice(["en", "en", "fr", None]), rng.choice([body, body, body, None, "", "the of é", " \t "])))
    return rows


def got(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("route_bytes", [10_000_000, 900])
def test_against_brute_force(spark, scratch, monkeypatch, route_bytes):
    monkeypatch.setattr(phrases, "RUN_BYTES", 2000)
    rows = corpus(1)
    df = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "lang string, text string, phrase int").repartition(3)
    assert got(collocations(df, scratch, route_bytes=route_bytes)) == brute(rows)
    assert got(collocations(df, scratch, top=7, min_count=3, cover_percent=80, route_bytes=route_bytes)) == brute(rows, least=3, cover=80, top=7)
    assert got(collocations(df, scratch, max_words=5, min_count=4, top=None, route_bytes=route_bytes)) == brute(rows, longest=5, least=4, top=10**9)
    assert got(collocations(df, scratch, min_words=3, max_words=4, route_bytes=route_bytes)) == brute(rows, low=3, longest=4)


def test_a_word_that_is_half_of_all_is_dealt_out(spark, scratch, monkeypatch):
    monkeypatch.setattr(phrases, "RUN_BYTES", 1500)
    rows = [("en", "the " * 40 + f"w{i % 9} of the w{i % 4}") for i in range(200)]
    df = spark.createDataFrame(rows, "lang string, text string").repartition(4)
    f, totals = phrase_counts(df, scratch, route_bytes=1000)
    want, n = counted(rows, 3)
    assert {(r.lang, r.phrase): r.f for r in f.collect()} == {k: v for k, v in want.items() if v >= 10}
    assert {r.lang: r.n for r in totals.collect()} == dict(n)


def test_cases(spark, scratch, cases, empty):
    rows = [(r.lang, r.text) for r in cases.collect()]
    assert got(collocations(cases, scratch)) == brute(rows)
    assert got(collocations(cases.unionByName(cases), scratch)) == brute(rows + rows)
    assert got(collocations(empty, scratch)) == []
    nothing = spark.createDataFrame([("en", None), (None, ""), ("en", " .,\t")], "lang string, text string")
    assert got(collocations(nothing, scratch)) == []
    with pytest.raises(ValueError):
        collocations(cases, scratch, min_words=1)


def test_long_texts_are_cut_without_loss(spark, scratch, monkeypatch):
    monkeypatch.setattr(phrases, "RUN_BYTES", 200)
    rng = random.Random(3)
    texts = [" ".join(rng.choices(["a", "bb", "ccc"], k=400)), "a b. " * 300, "x" * 900 + " y z " + "x" * 900 + ". a b", "w " * 500, "\t" * 700 + "a b c"]
    rows = [("en", t) for t in texts]
    df = spark.createDataFrame(rows, "lang string, text string")
    assert got(collocations(df, scratch, min_count=2)) == brute(rows, least=2)
    for text in texts:
        segments = cut_text(text.encode(), 200, 3)
        assert sum(own for _, own in segments) == len(text)
        found = Counter()
        for segment in segments:
            s = Suffixes([segment], np.zeros(1, np.int32), 3)
            words = [None, *s.words.to_pylist()]
            for row, weight in zip(s.matrix.tolist(), s.weights.tolist()):
                found[tuple(words[c] for c in row)] += weight
        whole = Counter()
        for w in pieces(text):
            for i in range(len(w)):
                whole[tuple((w[i + k].encode() if i + k < len(w) else None) for k in range(3))] += 1
        assert found == whole


@pytest.mark.parametrize("least", [1, 4])
def test_quicksort_counts_prefixes(least):
    rng = np.random.default_rng(least)
    codes = np.where(np.arange(3) < rng.integers(1, 4, (3000, 1)), rng.geometric(0.25, (3000, 3)), 0).astype(np.int32)
    weights = rng.integers(1, 4, 3000)
    want = Counter()
    for row, weight in zip(codes.tolist(), weights.tolist()):
        for k in range(1, 4):
            if row[k - 1]:
                want[tuple(row[:k])] += weight
    seen = {}
    for pointer, depth, weight in quicksort(codes, weights, least):
        for p, d, w in zip(pointer.tolist(), depth.tolist(), weight.tolist()):
            prefix = tuple(codes[p, :d].tolist())
            assert prefix not in seen
            seen[prefix] = w
    assert seen == {k: v for k, v in want.items() if v >= least}
    assert list(quicksort(codes[:0], weights[:0], 1)) == []
