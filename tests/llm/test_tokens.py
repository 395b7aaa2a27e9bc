import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from zonereach.llm.codes import Codes, TokenFiles, pack
from zonereach.llm.packing import best_fit, pack_documents, sequences, token_pieces
from zonereach.llm.packing import pack as pack_items
from zonereach.llm.tokens import Encoder

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)


def ids(text, end=2):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids + [end]


def check(encoder, texts):
    want = [x.ids for x in LIBRARY.encode_batch(texts, add_special_tokens=False)]
    assert [x.tolist() for x in encoder.encode(texts)] == want


def test_encoder_agrees_with_the_library():
    encoder = Encoder(PATH)
    signs = " \n\t 'strevemlld　 aZé1٣²½_-!?<|>́\U0001f600中ʼ’\r\x0b\x1c\x85​ ՘წ6"
    rng = random.Random(1)
    texts = ["".join(rng.choices(signs, k=rng.randint(0, 40))) for _ in range(4000)]
    check(encoder, [*texts, "", "<|endoftext|>", "a<|endoftext|> b", " " * 3000, "'s" * 900, "it's we'll 'll ''re \n's"])
    # Every kind of code point among letters, numbers and signs.
    check(encoder, [f"a{chr(p)}a 1{chr(p)}1 !{chr(p)}!" for p in range(0, 0x3000, 1) if not 0xD800 <= p < 0xE000])


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(max_size=60), max_size=5))
def test_encoder_on_any_text(texts):
    check(Encoder_shared, texts)


Encoder_shared = Encoder(PATH)


def test_forgetting_changes_nothing(monkeypatch):
    import zonereach.llm.tokens as tokens

    monkeypatch.setattr(tokens, "MEMORY", 5)
    monkeypatch.setattr(tokens, "BATCH_POINTS", 50)
    check(Encoder(PATH), [f"some words {i} and others {i * 7}, again" for i in range(60)])


# Words of two letters by the parity of set bits: a polynomial hash modulo a power of two cannot tell them apart.
TWINS = ["".join("ab"[(bin(i).count("1") + k) % 2] for i in range(1024)) for k in (0, 1)]


@pytest.mark.parametrize("texts", [[f"{TWINS[0]} and {TWINS[1]}"], TWINS, [f"x {TWINS[1]} y", "z", f"x {TWINS[0]} {TWINS[0]}"]])
def test_words_with_one_hash(texts):
    check(Encoder(PATH), texts)
    encoder = Encoder(PATH)
    for t in [*texts, *texts[::-1]]:
        check(encoder, [t])


def test_long_texts_in_parts(monkeypatch):
    import zonereach.llm.tokens as tokens

    rng = random.Random(9)
    words = ["the", "é", "it's", "日本語", "12", "a,b", "x_y.", "<|endoftext|>", "\n\n", "  ", "'ll", "(", "_", "\x1c", "e\u0301", "'s", "—"]
    texts = ["".join(w + rng.choice(["", " ", " "]) for w in rng.choices(words, k=n)) for n in (1, 40, 400, 400, 400)]
    texts += ["q" * 300, "日本。" * 100, " " * 200, "a\n\n b\t c " * 40, "(a)[b]" * 50]
    monkeypatch.setattr(tokens, "BATCH_POINTS", 30)
    assert sum(len(tokens.edges(t, 30)) for t in texts) > 60
    check(Encoder(PATH), texts)


def test_a_long_text_takes_bounded_memory():
    import tracemalloc

    text = " ".join(f"word{i % 5000}, and" for i in range(300_000))
    encoder = Encoder(PATH)
    encoder.encode(["warm up"])
    tracemalloc.start()
    found = encoder.encode([text])[0]
    assert tracemalloc.get_traced_memory()[1] < 12 * len(text) + 120_000_000
    tracemalloc.stop()
    assert found.tolist() == LIBRARY.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("n", [0, 1, 7, 511, 512, 513, 5000])
def test_codes_round_trip(n):
    rng = np.random.default_rng(n)
    values = np.where(rng.random(n) < 0.5, rng.integers(0, 300, n), rng.integers(0, 1 << 32, n)).astype(np.uint32)
    codes = Codes(pack(values))
    assert len(codes) == n and codes.tokens(0, n).tolist() == values.tolist()
    assert [codes.token(i) for i in range(n)] == values.tolist()
    for a, b in ((0, 0), (n // 3, n // 2), (n // 2, n), (n, n)):
        assert codes.tokens(a, b).tolist() == values[a:b].tolist()


def test_token_files(spark, cases, empty, scratch):
    files = TokenFiles(spark, scratch.path("tokens")).write(cases, PATH, 2, block_tokens=300)
    rows = sorted(cases.select("doc_id", "text").collect(), key=lambda r: (r.doc_id is None, r.doc_id or 0))
    got = sorted(files.documents().collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == [r.doc_id for r in rows]
    start = 0
    for r in got:
        assert r.start == start
        start += r.n_tokens
    assert sorted((str(r.doc_id), bytes(r.ids)) for r in got) == sorted((str(r.doc_id), np.array(ids(r.text), "<u4").tobytes()) for r in rows)
    assert files.blocks().count() > 3
    whole = np.concatenate([np.frombuffer(r.ids, "<u4") for r in got])
    asked = [0, 1, 299, 300, 301, len(whole) - 1, len(whole) // 2]
    places = spark.createDataFrame([(p,) for p in [*asked, len(whole), -1, None, 0]], "place long")
    assert {r.place: r.token for r in files.tokens_at(places).collect()} == {p: int(whole[p]) for p in asked}
    nothing = TokenFiles(spark, scratch.path("none")).write(empty, PATH, 2)
    assert nothing.documents().count() == 0


def test_pieces_cover_the_documents(spark, cases):
    rows = token_pieces(cases, PATH, 2, 64).collect()
    by = {}
    for r in rows:
        by.setdefault((r.doc_id, r.length == 64 or r.piece == 0), []).append(r)
        assert r.length == len(r.ids) // 4 and 0 < r.length <= 64
        assert (r.start == 0) == (r.piece == 0) and (r.piece == 0 or r.length == 64)
    total = sum(len(ids(r.text)) for r in cases.select("text").collect())
    assert sum(r.length for r in rows) == total
    assert sum(1 for r in token_pieces(cases, PATH, None, 64).collect() if r.doc_id == 200) == 0


def test_best_fit_is_best_fit_decreasing():
    rng = np.random.default_rng(2)
    sizes = rng.integers(1, 101, 500)
    bins = best_fit(sizes, 100)
    room, want = [], np.empty(500, int)
    for i in np.argsort(-sizes, kind="stable"):
        fits = [(r, b) for b, r in enumerate(room) if r >= sizes[i]]
        best = min(r for r, _ in fits) if fits else None
        if fits:
            b = [b for r, b in fits if r == best][-1]
        else:
            room.append(100)
            b = len(room) - 1
        room[b] -= sizes[i]
        want[i] = b
    assert len(set(bins)) == len(room)
    assert sorted(np.bincount(bins, sizes)) == sorted(100 - r for r in room)


def test_packing_in_rounds(spark, scratch):
    rng = random.Random(4)
    lengths = [rng.choice([rng.randint(1, 100), 60, 100]) for _ in range(3000)]
    items = spark.createDataFrame([(i % 2900, n) for i, n in enumerate(lengths)], "doc_id long, length long").repartition(7)
    placed = pack_items(items, scratch, 100, task_bins=150, fan_in=4, slack=2).collect()
    assert sorted((r.doc_id, r.length) for r in placed) == sorted((i % 2900, n) for i, n in enumerate(lengths))
    by = {}
    for r in placed:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in by.values():
        at = 0
        for offset, n in sorted(own):
            assert offset == at
            at += n
        assert at <= 100
    alone = len(set(best_fit(np.array(lengths), 100)))
    assert len(by) <= 1.02 * alone + 1


def test_items_that_never_fit_together_end(spark, scratch):
    items = spark.range(400).selectExpr("id as doc_id", "60L as length")
    placed = pack_items(items, scratch, 100, task_bins=50, fan_in=4)
    assert placed.select("sequence_id").distinct().count() == 400


def test_pack_documents(spark, cases, empty, scratch):
    placed = pack_documents(cases, scratch, PATH, 2, 64)
    want = sorted(zlib.crc32(r.ids) for r in token_pieces(cases, PATH, 2, 64).collect())
    rows = placed.collect()
    assert sorted(r.ids_crc32 for r in rows) == want
    ends = {}
    for r in rows:
        ends[r.sequence_id] = max(ends.get(r.sequence_id, 0), r.offset + r.length)
    unique = cases.where("doc_id < 100")
    own = pack_documents(unique, scratch, PATH, 2, 64)
    packed = sequences(token_pieces(unique, PATH, 2, 64), own).collect()
    assert sum(len(r.ids) // 4 for r in packed) == sum(len(ids(r.text)) for r in unique.select("text").collect())
    assert all(len(r.ids) <= 256 for r in packed)
    assert pack_documents(empty, scratch, PATH, 2, 64).count() == 0


def test_wrong_items(spark, scratch):
    with pytest.raises(ValueError):
        pack_items(spark.range(3).selectExpr("id", "id as length"), scratch, 10)
    with pytest.raises(ValueError):
        pack_items(spark.range(3).selectExpr("id as offset", "5L as length"), scratch, 10)
