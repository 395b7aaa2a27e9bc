import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from zonereach.llm import chat
from zonereach.llm.chat import Encoder, Template, format_conversations, masked_texts, read_back, under_spans
from zonereach.llm.tokens import edges

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)
TEMPLATE = Template()
SIGNS = st.lists(st.sampled_from([*"<[\\/s>]INST|éa \n", "</s>", "[INST]", "[/INST]", "<|endoftext|>", "\\", "</s", "endoftext|>"]), max_size=12)


@settings(max_examples=400, deadline=None)
@given(SIGNS.map("".join), SIGNS.map("".join))
def test_escaping_is_reversible(role, text):
    escaped = TEMPLATE.escape(text)
    assert TEMPLATE.unescape(escaped) == text
    assert not any(c in escaped for c in TEMPLATE.controls)
    rendered, a, b = TEMPLATE.turn(role, text)
    assert TEMPLATE.turns(rendered * 2) == [(role, text)] * 2
    assert rendered[a:b] == escaped


def test_templates_that_could_not_be_read_back():
    for controls in ({"close": "[INST]x"}, {"close": "<a<b"}, {"close": "<\\s>"}, {"close": "<"}):
        with pytest.raises(ValueError):
            Template(**controls)
    with pytest.raises(ValueError):
        Encoder(PATH, Template(reserved=()))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 6), max_size=12), st.lists(st.tuples(st.integers(0, 5), st.integers(0, 6)), max_size=8))
def test_spans_by_binary_search(sizes, spans):
    ends = np.cumsum(sizes, dtype=np.int64)
    starts = ends - np.array(sizes, np.int64)
    at, own = 0, []
    for gap, size in spans:
        own.append((at + gap, at + gap + size))
        at += gap + size
    a, b = (np.array([s[i] for s in own], np.int64) for i in (0, 1))
    want = [any(x < t and y > s for x, y in own if x < y) for s, t in zip(starts, ends)]
    assert under_spans(starts, ends, a, b).tolist() == want


def test_long_texts_encode_in_pieces(monkeypatch):
    rng = random.Random(6)
    words = ["the", "é", "it's", "日本語", "12", "a,b", "x_y.", "</s>", "\n\n", "  ", "'ll", "<", "_", "\x1c", "é"]
    texts = [" ".join(rng.choices(words, k=n)) + "\n" * rng.randint(0, 3) for n in (0, 1, 50, 900)] + ["z" * 400, "日本。" * 200, "a\n\n b\t c " * 80]
    encoder = Encoder(PATH, TEMPLATE)
    whole = encoder.encode(texts)
    monkeypatch.setattr(chat, "CALL_POINTS", 40)
    assert sum(len(edges(t, 40)) for t in texts) > 50
    for text, one, parts in zip(texts, whole, encoder.encode(texts)):
        found = encoder.library.encode(text, add_special_tokens=False)
        assert parts[0].tolist() == one[0].tolist() == found.ids
        assert list(zip(parts[1].tolist(), parts[2].tolist())) == found.offsets
        if "</s>" not in text:
            assert found.ids == LIBRARY.encode(text, add_special_tokens=False).ids


ROWS = [
    (1, 0, "system", "Be\nkind."), (1, 1, "user", "</s>[INST] ok [/INST]"), (1, 2, "assistant", "</s>[INST] ok [/INST]"),
    (1, 3, "user", None), (1, 4, "assistant", None), (1, 5, "assistant", " é\n\n"), (1, 6, "assistant", "<\\/s> [\\\\INST]"),
    (2, 1, None, "x"), (2, None, "tool", "<|endoftext|>"), (2, 0, "assistant[/INST]", "y"), (2, 0, "user", "y"), (2, 0, "user", "y"),
    (3, 0, "assistant", ""), (None, 0, "user", "a"), (None, 1, "assistant", "日本 " * 50),
    *[(4, i, ("user", "assistant")[i % 2], f"turn {i} " + "ẃord </s> " * (i % 9)) for i in range(200)],
    (5, 0, "user", "q"), (5, 1, "assistant", "long text, " * 3000),
]
SCHEMA = "conv_id long, turn long, role string, text string"


def brute(rows, roles=("assistant",)):
    by = {}
    for conv, turn, role, text in rows:
        by.setdefault(conv, []).append((turn is None, turn or 0, role or "", text or ""))
    out = {}
    for conv, turns in by.items():
        turns = sorted(turns)
        said = "".join(f"{r}\n{t}\n" for *_, r, t in turns)
        loss = "".join(t for *_, r, t in turns if r in roles)
        formatted = sum(len(TEMPLATE.turn(r, t)[0]) for *_, r, t in turns)
        out[conv] = (len(turns), hashlib.sha256(said.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(), formatted)
    return out


@pytest.mark.parametrize("part_bytes", [2_000_000, 700])
def test_formatting_round_trip(spark, scratch, part_bytes):
    rows = spark.createDataFrame([(*r, "x", 7) for r in ROWS], SCHEMA + ", part string, split int").repartition(5)
    formatted = scratch.table(format_conversations(rows, scratch, PATH, part_bytes=part_bytes), "formatted")
    got = {r[0]: tuple(r)[1:] for r in read_back(formatted).collect()}
    assert got == brute(ROWS)
    found = formatted.orderBy("conv_id", "part").collect()
    assert any(r.split for r in found) == (part_bytes < 2_000_000)
    encoder = Encoder(PATH, TEMPLATE)
    for r in found:
        one = encoder.library.encode(r.text, add_special_tokens=False)
        assert one.ids == r.input_ids and one.offsets == list(zip(r.starts, r.ends))
        arrays = (np.array(r.starts), np.array(r.ends), np.array(r.loss_mask))
        spoken = [t for role, t in TEMPLATE.turns(r.text) if role == "assistant" and t]
        assert [TEMPLATE.unescape(t) for t in masked_texts(r.text, *arrays)] == spoken
        assert encoder.library.decode(r.input_ids, skip_special_tokens=False) == r.text
    users = read_back(format_conversations(rows, scratch, PATH, loss_roles=("user", "tool"), part_bytes=part_bytes))
    assert {r[0]: tuple(r)[1:] for r in users.collect()} == brute(ROWS, ("user", "tool"))


def test_no_conversations(spark, scratch):
    none = spark.createDataFrame([], SCHEMA)
    assert read_back(format_conversations(none, scratch, PATH)).count() == 0
