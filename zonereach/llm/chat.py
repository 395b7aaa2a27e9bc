"""Conversations as one text each, with a loss mask over its tokens.

A template marks the turns; a text that holds a marker or another control string is escaped, and reading back restores
it. The whole rendered text is encoded once with offsets, and a token is under the loss mask if its span meets that of an
assistant's text; the turns' spans are in order, so that a binary search finds the one to compare with.
"""

from __future__ import annotations

import functools
import hashlib
import os
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import Scratch, running
from .tokens import edges

# Text of a part, and code points that the library encodes in one call, whose result it holds as objects.
PART_BYTES = 2_000_000
CALL_POINTS = 300_000

FORMATTED = (
    "conv_id long, part long, split boolean, n_turns long, text string,"
    " input_ids array<int>, starts array<int>, ends array<int>, loss_mask array<boolean>"
)
READ = (
    "conv_id long, part long, n_turns long, loss_chars long, formatted_chars long, turns_sha256 string, loss_sha256 string,"
    " turns binary, loss binary"
)
DIGESTS = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


@dataclass(frozen=True)
class Template:
    """A turn is ``open`` role ``body`` text ``close``; ``reserved`` are further control strings of the tokenizer.

    Where role or text has a control string with any number of escape signs after its first sign, one more is put in.
    So no control string is left inside, and taking one out again restores the text. For that, the first signs stand
    nowhere else in a control string, and none is the beginning of another.
    """

    open: str = "[INST]"
    body: str = "[/INST]"
    close: str = "</s>"
    reserved: tuple[str, ...] = ("<|endoftext|>",)
    escape_sign: str = "\\"

    def __post_init__(self):
        firsts = {c[0] for c in self.controls}
        for c in self.controls:
            if len(c) < 2 or self.escape_sign in c or any(f in c[1:] for f in firsts):
                raise ValueError(f"{c} cannot be a control string here")
            if any(o != c and o.startswith(c) for o in self.controls):
                raise ValueError(f"{c} begins another control string")

    @property
    def controls(self) -> tuple[str, ...]:
        return (self.open, self.body, self.close, *self.reserved)

    def _found(self, signs: str) -> re.Pattern:
        sign, by_first = re.escape(self.escape_sign), {}
        for c in self.controls:
            by_first.setdefault(c[0], []).append(re.escape(c[1:]))
        return re.compile("|".join(f"{re.escape(f)}{signs}(?={sign}*(?:{'|'.join(rest)}))" for f, rest in by_first.items()))

    @functools.cached_property
    def _bare(self) -> re.Pattern:
        return self._found("")

    @functools.cached_property
    def _signed(self) -> re.Pattern:
        return self._found(re.escape(self.escape_sign))

    def escape(self, text: str) -> str:
        return self._bare.sub(lambda m: m[0] + self.escape_sign, text)

    def unescape(self, text: str) -> str:
        return self._signed.sub(lambda m: m[0][0], text)

    def turn(self, role: str, text: str) -> tuple[str, int, int]:
        """The rendered turn, and where the text in it begins and ends."""
        head = f"{self.open}{self.escape(role)}{self.body}"
        own = self.escape(text)
        return f"{head}{own}{self.close}", len(head), len(head) + len(own)

    def turns(self, rendered: str) -> list[tuple[str, str]]:
        """Roles and texts of a rendered conversation."""
        out, at = [], 0
        while at < len(rendered):
            body = rendered.index(self.body, at)
            close = rendered.index(self.close, body)
            if not rendered.startswith(self.open, at):
                raise ValueError("not a rendered conversation")
            role, text = rendered[at + len(self.open) : body], rendered[body + len(self.body) : close]
            out.append((self.unescape(role), self.unescape(text)))
            at = close + len(self.close)
        return out


def under_spans(starts: np.ndarray, ends: np.ndarray, span_starts: np.ndarray, span_ends: np.ndarray) -> np.ndarray:
    """Which tokens meet a span; spans are in order and apart. A binary search finds the first that ends behind a token's start."""
    some = span_starts < span_ends
    span_starts, span_ends = span_starts[some], span_ends[some]
    if not len(span_starts):
        return np.zeros(len(starts), bool)
    at = np.searchsorted(span_ends, starts, side="right")
    return (at < len(span_starts)) & (span_starts[np.minimum(at, len(span_starts) - 1)] < ends)


class Encoder:
    """A tokenizer to which the template's control strings are tokens by themselves."""

    def __init__(self, path: str, template: Template):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import AddedToken, Tokenizer

        self.library = Tokenizer.from_file(path)
        own = {t.content for t in self.library.get_added_tokens_decoder().values()}
        if own - set(template.controls):
            raise ValueError(f"the template must reserve {sorted(own - set(template.controls))}")
        self.library.add_special_tokens([AddedToken(c, normalized=False, special=True) for c in template.controls])

    def encode(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Ids, starts and ends (in code points) of the tokens of each text.

        A long text goes to the library in pieces cut where a token begins for sure.
        """
        pieces, owner, shift = [], [], []
        for i, text in enumerate(texts):
            cuts = [0, *edges(text, CALL_POINTS), len(text)]
            for a, b in zip(cuts, cuts[1:]):
                pieces.append(text[a:b])
                owner.append(i)
                shift.append(a)
        out = [([], [], []) for _ in texts]
        at = 0
        while at < len(pieces):
            stop, size = at, 0
            while stop < len(pieces) and (stop == at or size + len(pieces[stop]) <= CALL_POINTS):
                size += len(pieces[stop])
                stop += 1
            for k, found in enumerate(self.library.encode_batch(pieces[at:stop], add_special_tokens=False), at):
                spans = np.array(found.offsets, np.int32).reshape(-1, 2) + np.int32(shift[k])
                for column, values in zip(out[owner[k]], (np.array(found.ids, np.int32), spans[:, 0], spans[:, 1])):
                    column.append(values)
            at = stop
        return [tuple(np.concatenate(c) if c else np.empty(0, np.int32) for c in columns) for columns in out]


@functools.lru_cache(maxsize=2)
def _encoder(path: str, template: Template) -> Encoder:
    """One a worker process, kept from task to task."""
    return Encoder(path, template)


def _lists(columns: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    offsets = pa.array(np.append(0, np.cumsum([len(c) for c in columns])), pa.int32())
    return pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(columns) if columns else [], kind))


def _format(tokenizer: str, template: Template, loss_roles: tuple[str, ...]):
    """Rows in order of conversation, part and turn to one row a conversation and part."""

    def flush(done: list) -> pa.RecordBatch:
        encoded = _encoder(tokenizer, template).encode([text for _, text, _, _ in done])
        masks = []
        for (_, text, _, spans), (_, starts, ends) in zip(done, encoded):
            own = np.array(spans, np.int64).reshape(-1, 2)
            masks.append(under_spans(starts, ends, own[:, 0], own[:, 1]))
        keys = list(zip(*(key for key, *_ in done)))
        return pa.RecordBatch.from_arrays(
            [
                pa.array(keys[0], pa.int64()),
                pa.array(keys[1], pa.int64()),
                pa.array(keys[2], pa.bool_()),
                pa.array([n for _, _, n, _ in done], pa.int64()),
                pa.array([text for _, text, _, _ in done], pa.string()),
                *(_lists([e[i] for e in encoded], pa.int32()) for i in range(3)),
                _lists(masks, pa.bool_()),
            ],
            ["conv_id", "part", "split", "n_turns", "text", "input_ids", "starts", "ends", "loss_mask"],
        )

    def run(batches):
        key, pieces, spans, size, turns = None, [], [], 0, 0
        done, held = [], 0
        for batch in batches:
            for conv, part, split, role, text in zip(*(batch.column(i).to_pylist() for i in range(5))):
                if key is not None and key[:2] != (conv, part):
                    done.append((key, "".join(pieces), turns, spans))
                    held += size
                    pieces, spans, size, turns = [], [], 0, 0
                    if held > CALL_POINTS:
                        yield flush(done)
                        done, held = [], 0
                key = (conv, part, split)
                rendered, a, b = template.turn(role, text)
                if role in loss_roles:
                    spans.append((size + a, size + b))
                pieces.append(rendered)
                size += len(rendered)
                turns += 1
        if key is not None:
            done.append((key, "".join(pieces), turns, spans))
            yield flush(done)

    return run


def format_conversations(
    rows: DataFrame,
    scratch: Scratch,
    tokenizer: str,
    template: Template = Template(),
    loss_roles: tuple[str, ...] = ("assistant",),
    part_bytes: int = PART_BYTES,
) -> DataFrame:
    """One row a conversation: conv_id, part, split, n_turns, text, input_ids, starts, ends, loss_mask.

    ``rows`` has conv_id, turn, role and text; other columns are not read. Turns go by ``turn`` (null last), equal ones
    by role and a hash of the text; repeated rows are turns of their own. Null roles and texts are empty; rows without
    a conv_id are one conversation. ``starts`` and ``ends`` are the tokens' places in ``text`` in code points. A
    conversation with more than ``part_bytes`` of text comes in several rows (``split``), in the order of ``part``,
    whose texts and tokens put together are those of the whole, so that no task holds a hot conversation. An empty table
    gives no rows.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    turns = rows.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        role.alias("role"),
        F.xxhash64(text).alias("hash"),
        text.alias("text"),
    )
    size = F.octet_length("text") + F.octet_length("role") + 32
    long_ones = scratch.table(
        turns.groupBy("conv_id").agg(F.sum(size).alias("size")).where(F.col("size") > part_bytes).select(F.col("conv_id").alias("id")),
        "long",
    )
    same = F.col("conv_id").eqNullSafe(F.col("id"))
    parts = turns.withColumns({"part": F.lit(0).cast("long"), "split": F.lit(False)})
    if long_ones.take(1):
        placed = running(scratch, turns.join(long_ones, same, "left_semi"), ["conv_id"], ["turn", "role", "hash"], size, "before")
        cut = placed.select(*turns.columns, F.floor(F.col("before") / part_bytes).alias("part"), F.lit(True).alias("split"))
        parts = parts.join(long_ones, same, "left_anti").unionByName(cut)
    order = [F.col(c).asc_nulls_last() for c in ("conv_id", "part", "turn", "role", "hash")]
    ordered = parts.repartition("conv_id", "part").sortWithinPartitions(*order)
    return ordered.select("conv_id", "part", "split", "role", "text").mapInArrow(_format(tokenizer, template, loss_roles), FORMATTED)


def masked_texts(text: str, starts: np.ndarray, ends: np.ndarray, mask: np.ndarray) -> list[str]:
    """The stretches of a rendered text that lie under the mask."""
    level = np.zeros(len(text) + 1, np.int32)
    np.add.at(level, starts[mask], 1)
    np.add.at(level, ends[mask], -1)
    edge = np.flatnonzero(np.diff(np.cumsum(level) > 0, prepend=False, append=False))
    return [text[a:b] for a, b in zip(edge[::2].tolist(), edge[1::2].tolist())]


def read_back(formatted: DataFrame, template: Template = Template()) -> DataFrame:
    """What formatted conversations hold: conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars.

    ``turns_sha256`` is over role, line end, text, line end of all turns, ``loss_sha256`` over all text under the mask,
    both unescaped. Of a conversation in several parts, the texts go on to the task that hashes them in order.
    """

    def read(batches):
        kinds = [pa.int64()] * 5 + [pa.string()] * 2 + [pa.binary()] * 2
        for batch in batches:
            column = {f.name: batch.column(i) for i, f in enumerate(batch.schema)}
            rows = []
            for i in range(batch.num_rows):
                text = column["text"][i].as_py()
                arrays = (column[c][i].values.to_numpy(zero_copy_only=False) for c in ("starts", "ends", "loss_mask"))
                loss = "".join(template.unescape(t) for t in masked_texts(text, *arrays))
                turns = template.turns(text)
                said = "".join(f"{r}\n{t}\n" for r, t in turns).encode()
                spoken = loss.encode()
                split = column["split"][i].as_py()
                hashes = (None, None, said, spoken) if split else (hashlib.sha256(said).hexdigest(), hashlib.sha256(spoken).hexdigest(), None, None)
                rows.append((column["conv_id"][i].as_py(), column["part"][i].as_py(), len(turns), len(loss), len(text), *hashes))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], [c.split()[0] for c in READ.split(", ")])

    def joined(batches):
        names = [c.split()[0] for c in DIGESTS.split(", ")]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        key, sums, hashes, rows = None, [0, 0, 0], None, []

        def row():
            said, spoken = (h if isinstance(h, str) else h.hexdigest() for h in hashes)
            return key[0], sums[0], said, sums[1], spoken, sums[2]

        def emitted():
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

        for batch in batches:
            for i in range(batch.num_rows):
                r = {f.name: batch.column(j)[i].as_py() for j, f in enumerate(batch.schema)}
                if key is not None and key[0] != r["conv_id"]:
                    rows.append(row())
                    key = None
                if key is None:
                    key, sums = (r["conv_id"],), [0, 0, 0]
                    hashes = (hashlib.sha256(), hashlib.sha256()) if r["turns_sha256"] is None else (r["turns_sha256"], r["loss_sha256"])
                sums = [a + r[c] for a, c in zip(sums, ("n_turns", "loss_chars", "formatted_chars"))]
                if r["turns"] is not None:
                    hashes[0].update(r["turns"])
                    hashes[1].update(r["loss"])
            if rows:
                yield emitted()
                rows = []
        if key is not None:
            rows.append(row())
            yield emitted()

    found = formatted.select("conv_id", "part", "split", "text", "starts", "ends", "loss_mask").mapInArrow(read, READ)
    return found.repartition("conv_id").sortWithinPartitions("conv_id", "part").mapInArrow(joined, DIGESTS)
