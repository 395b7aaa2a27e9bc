"""Whole texts to token ids with a byte-level BPE of the tokenizers library.

A byte-level BPE first cuts a text into words by a fixed pattern and then encodes each word by itself. The words of a
batch are found and hashed as arrays, and the library encodes each distinct word once; the ids of a text are those of
its words in order. The tests hold the result against the library's own encoding of whole texts.
"""

from __future__ import annotations

import functools
import os
import re
import sys

import numpy as np

# Classes of code points in the word pattern; the separator stands between two texts.
SPACE, LETTER, NUMBER, OTHER, SEPARATOR, UNKNOWN = range(6)
SEPARATOR_POINT = 0x110000
SEPARATOR_BYTES = SEPARATOR_POINT.to_bytes(4, "little")
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
# Distinct words a worker keeps; beyond it the memory starts anew, which costs time and changes no result.
MEMORY = 600_000
BATCH_POINTS = 500_000
KEPT_POWERS = 1 << 20
# Words the library encodes in one call, whose result it holds as objects.
CALL_WORDS = 20_000


# Between a letter or number and one of these signs a word of the pattern ends for sure, whatever stands around them.
SURE_EDGE = re.compile(r"(?<=[^\W_])(?=[ \n\t\r.,;:!?\"#$%&()*+\-/<=@\[\\^{}~。，、；：！？])")


def edges(text: str, most: int) -> list[int]:
    """Places about every ``most`` code points at which a text can be cut and encoded in parts.

    A text without any such place behind ``most`` signs is not cut there.
    """
    out, at = [], 0
    while len(text) - at > most:
        found = SURE_EDGE.search(text, at + most)
        if not found or found.start() >= len(text):
            break
        at = found.start()
        out.append(at)
    return out


class Classes:
    """Class of each code point, asked of the library when a code point is first met, so that both always agree."""

    def __init__(self, words):
        self.words = words
        self.table = np.full(SEPARATOR_POINT + 1, UNKNOWN, np.uint8)
        self.table[SEPARATOR_POINT] = SEPARATOR

    def __call__(self, points: np.ndarray) -> np.ndarray:
        kind = self.table[points]
        new = kind == UNKNOWN
        if not new.any():
            return kind
        for p in np.unique(points[new]).tolist():
            # A letter goes on after "a", a number after "1", another sign after "!"; the rest is white space.
            joined = [len(self.words(f"{left}{chr(p)}")) == 1 for left in "a1!"]
            self.table[p] = (LETTER, NUMBER, OTHER)[joined.index(True)] if any(joined) else SPACE
        return self.table[points]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the multiplier and of its inverse; only a table for a usual batch is kept."""
    return _kept_powers(n) if n <= KEPT_POWERS else _new_powers(n)


def _new_powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = np.full(n, MULTIPLIER), np.full(n, INVERSE)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


_kept_powers = functools.lru_cache(maxsize=2)(_new_powers)


def word_spans(points: np.ndarray, classes: Classes) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words of separated texts: contractions, letters, numbers or other signs with one blank
    before them, and runs of white space without their last blank."""
    kind = classes(points)
    before, after = np.empty_like(kind), np.empty_like(kind)
    before[0], before[1:] = SEPARATOR, kind[:-1]
    after[-1], after[:-1] = SEPARATOR, kind[1:]
    blank = kind == SPACE
    start = np.where(blank, (before != SPACE) | ((after != SPACE) & (after != SEPARATOR)), before != kind)
    start[1:] &= blank[1:] | (points[:-1] != 0x20) | (kind[1:] == SEPARATOR)
    start |= kind == SEPARATOR
    quotes = np.flatnonzero((points == 0x27) & start)
    if len(quotes):
        padded = np.append(points, np.full(3, SEPARATOR_POINT, points.dtype))
        one, two = padded[quotes + 1], padded[quotes + 2]
        short = np.isin(one, [ord(c) for c in "stmd"])
        long = (((one == ord("r")) | (one == ord("v"))) & (two == ord("e"))) | ((one == ord("l")) & (two == ord("l")))
        for at, length in ((quotes[short], 2), (quotes[long], 3)):
            start[at + 1] = False
            ends = at + length
            start[ends[ends < len(start)]] = True
    starts = np.flatnonzero(start)
    ends = np.append(starts[1:], len(points))
    real = kind[starts] != SEPARATOR
    return starts[real], ends[real]


def _ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers start .. start + length - 1 of all ranges in a row."""
    total = int(lengths.sum())
    if not total:
        return np.empty(0, np.int64)
    at = np.cumsum(lengths) - lengths
    return np.arange(total) + np.repeat(starts - at, lengths)


def _same(a: np.ndarray, a_starts: np.ndarray, a_sizes: np.ndarray, b: np.ndarray, b_starts: np.ndarray, b_sizes: np.ndarray) -> bool:
    """Whether each word of ``a`` is the one of ``b`` in its place, sign by sign."""
    return np.array_equal(a_sizes, b_sizes) and np.array_equal(a[_ranges(a_starts, a_sizes)], b[_ranges(b_starts, b_sizes)])


class Encoder:
    """Encodes batches of texts; remembers the words it has met, and their ids, in the order of a 64-bit hash.

    A hash only finds a word: every word of a batch is compared with the first of its hash, and that with the remembered
    one. Where two words share a hash, the library encodes the batch's texts whole.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        # Strings of special tokens in a text stand for those tokens, as in the library's default.
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.classes = Classes(self.library.pre_tokenizer.pre_tokenize_str)
        self.forget()

    def forget(self) -> None:
        self.hashes = np.empty(0, np.uint64)
        self.at = np.empty(0, np.int64)
        self.lengths = np.empty(0, np.int32)
        self.ids = np.empty(0, np.uint32)
        self.points = np.empty(0, np.uint32)
        self.begins = np.empty(0, np.int64)
        self.sizes = np.empty(0, np.int64)

    def _learn(self, hashes: np.ndarray, points: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> None:
        if len(self.hashes) > MEMORY:
            self.forget()
        sizes = ends - starts
        signs = points[_ranges(starts, sizes)]
        text = signs.tobytes().decode("utf-32-le")
        cuts = np.append(0, np.cumsum(sizes)).tolist()
        words = [text[a:b] for a, b in zip(cuts, cuts[1:])]
        ids, lengths = [self.ids], []
        for a in range(0, len(words), CALL_WORDS):
            own = words[a : a + CALL_WORDS]
            done = self.library.encode(own, is_pretokenized=True, add_special_tokens=False)
            ids.append(np.array(done.ids, np.uint32))
            lengths.append(np.bincount(np.array(done.word_ids, np.int64), minlength=len(own)).astype(np.int32))
        lengths = np.concatenate(lengths)
        at = len(self.ids) + np.cumsum(lengths) - lengths
        self.ids = np.concatenate(ids)
        begins = len(self.points) + np.cumsum(sizes) - sizes
        self.points = np.append(self.points, signs)
        order = np.searchsorted(self.hashes, hashes)
        self.hashes = np.insert(self.hashes, order, hashes)
        self.begins = np.insert(self.begins, order, begins)
        self.sizes = np.insert(self.sizes, order, sizes)
        self.at = np.insert(self.at, order, at)
        self.lengths = np.insert(self.lengths, order, lengths)

    def _known(self, hashes: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.hashes, hashes)
        return (at < len(self.hashes)) & (self.hashes[np.minimum(at, len(self.hashes) - 1)] == hashes) if len(self.hashes) else np.zeros(len(hashes), bool)

    def _whole(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids = [np.array(e.ids, np.uint32) for e in self.library.encode_batch(texts, add_special_tokens=False)]
        return np.concatenate(ids), np.array([len(i) for i in ids])

    def _batch(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        parts = [t.encode("utf-32-le") for t in texts]
        points = np.frombuffer(SEPARATOR_BYTES.join(parts) + SEPARATOR_BYTES, np.uint32)
        ends_of_texts = np.cumsum([len(p) // 4 + 1 for p in parts]) - 1
        starts, ends = word_spans(points, self.classes)
        if not len(starts):
            return np.empty(0, np.uint32), np.zeros(len(texts), np.int64)
        up, down = _powers(1 << max(19, int(len(points)).bit_length()))
        total = np.empty(len(points) + 1, np.uint64)
        total[0] = 0
        np.cumsum((points.astype(np.uint64) + np.uint64(1)) * up[: len(points)], out=total[1:])
        h = (total[ends] - total[starts]) * down[starts]
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(32)
        distinct, first, inverse = np.unique(h, return_index=True, return_inverse=True)
        sizes = ends - starts
        again = np.ones(len(h), bool)
        again[first] = False
        model = first[inverse[again]]
        if not _same(points, starts[again], sizes[again], points, starts[model], sizes[model]):
            return self._whole(texts)
        new = ~self._known(distinct)
        met = first[~new]
        place = np.searchsorted(self.hashes, distinct[~new])
        if not _same(points, starts[met], sizes[met], self.points, self.begins[place], self.sizes[place]):
            return self._whole(texts)
        if new.any():
            if len(self.hashes) > MEMORY:
                self.forget()
                new[:] = True
            self._learn(distinct[new], points, starts[first[new]], ends[first[new]])
        place = np.searchsorted(self.hashes, distinct)
        lengths = self.lengths[place][inverse].astype(np.int64)
        ids = self.ids[_ranges(self.at[place][inverse], lengths)]
        words_before = np.searchsorted(starts, ends_of_texts)
        tokens_before = np.append(0, np.cumsum(lengths))[words_before]
        return ids, np.diff(tokens_before, prepend=0)

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """Ids of each text; null is empty."""
        out: list[np.ndarray] = []
        group: list[str] = []
        points = 0

        def flush() -> None:
            if group:
                ids, counts = self._batch(group)
                out.extend(np.split(ids, np.cumsum(counts)[:-1]))
                group.clear()

        for t in texts:
            t = t or ""
            special = any(s in t for s in self.special)
            if special or len(t) > BATCH_POINTS:
                flush()
                points = 0
                cuts = [0, *edges(t, BATCH_POINTS), len(t)]
                parts = [t[a:b] for a, b in zip(cuts, cuts[1:])]
                # A word as long as a batch is the library's alone.
                out.append(np.concatenate([(self._whole if special or len(p) > 2 * BATCH_POINTS else self._batch)([p])[0] for p in parts]))
                continue
            if points + len(t) > BATCH_POINTS:
                flush()
                points = 0
            group.append(t)
            points += len(t) + 1
        flush()
        return out


@functools.lru_cache(maxsize=1)
def encoder(path: str) -> Encoder:
    """One encoder a worker process, kept from task to task."""
    return Encoder(path)


def encoded(path: str, texts: list[str | None], end: int | None) -> list[np.ndarray]:
    """Ids of each text, followed by ``end``."""
    found = encoder(path).encode(texts)
    return found if end is None else [np.append(x, np.uint32(end)) for x in found]


def slices(texts, most: int = BATCH_POINTS):
    """Cut a pyarrow column into (from, to) runs of about ``most`` bytes, so a worker holds little at a time."""
    import pyarrow.compute as pc

    sizes = np.asarray(pc.fill_null(pc.binary_length(texts), 0))
    which = (np.cumsum(sizes) // most) if len(sizes) else sizes
    cuts = [0, *(np.flatnonzero(np.diff(which)) + 1).tolist(), len(sizes)]
    return [(a, b) for a, b in zip(cuts, cuts[1:]) if b > a]


assert sys.byteorder == "little"
