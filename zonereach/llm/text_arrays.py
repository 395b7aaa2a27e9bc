"""Words of many texts as arrays over their UTF-8 bytes."""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa

BLANK = np.zeros(256, bool)
BLANK[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32
LETTER = np.zeros(256, bool)
LETTER[[*range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1), *range(0x80, 0x100)]] = True
DIGIT = np.zeros(256, bool)
DIGIT[ord("0") : ord("9") + 1] = True
# Blank 0, letters 1 (every byte of other scripts too), digits 2, other signs 3.
KIND = np.where(BLANK, 0, np.where(LETTER, 1, np.where(DIGIT, 2, 3))).astype(np.uint8)
RUN_BYTES = 1 << 19
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


@functools.lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    up = np.full(n, MULTIPLIER)
    down = np.full(n, np.uint64(pow(int(MULTIPLIER), -1, 1 << 64)))
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (the finalizer of a common 64-bit generator)."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a column with a blank after each text, and the first byte of each text; null is empty."""
    column = column.cast(pa.large_binary()) if not pa.types.is_large_binary(column.type) else column
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2], np.uint8) if column.buffers()[2] else np.empty(0, np.uint8)
    data = data[offsets[0] : offsets[-1]]
    ends = offsets[1:] - offsets[0]
    return np.insert(data, ends, 0x20), np.append(0, ends + np.arange(1, len(column) + 1))


class Words:
    """Words of a run of texts: ``data`` (all bytes, a blank after each text), starts, ends, and each text's first word.

    Words are what stands between blanks; with ``runs`` they are runs of letters, of digits and of other signs.
    """

    def __init__(self, column: pa.Array, lower: bool, runs: bool = False):
        self.data, edges = _flat(column)
        if lower:
            self.data = LOWER[self.data]
        kind = KIND[self.data] if runs else (~BLANK[self.data]).astype(np.uint8)
        change = np.append(kind, 0) != np.append(0, kind)
        self.starts = np.flatnonzero(change[:-1] & (kind > 0))
        self.ends = np.flatnonzero(change & (np.append(0, kind) > 0))
        self.kind = kind[self.starts]
        self.first = np.searchsorted(self.starts, edges)

    def distinct(self) -> tuple[list[bytes], np.ndarray]:
        """The distinct words, told apart by their bytes, and the place of each word among them."""
        inside = np.zeros(len(self.data) + 1, np.int8)
        inside[self.starts] += 1
        inside[self.ends] -= 1
        own = np.cumsum(inside[:-1], dtype=np.int8) > 0
        offsets = np.append(0, np.cumsum(self.ends - self.starts)).astype(np.int64)
        packed = np.ascontiguousarray(self.data[own])
        words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(self.starts), [None, pa.py_buffer(offsets), pa.py_buffer(packed)])
        coded = words.dictionary_encode()
        return coded.dictionary.to_pylist(), coded.indices.to_numpy(zero_copy_only=False)

    def hashes(self, *prefixes: int):
        """A 64-bit hash of each word, and of its first bytes for each of ``prefixes``.

        Sums over the bytes are built up for a run of words at a time, which bounds what they take.
        """
        out = [np.empty(len(self.starts), np.uint64) for _ in range(1 + len(prefixes))]
        cuts = np.searchsorted(self.starts, np.arange(0, len(self.data) + RUN_BYTES, RUN_BYTES))
        for a, b in zip(cuts.tolist(), cuts[1:].tolist()):
            if a == b:
                continue
            low = int(self.starts[a])
            own = self.data[low : int(self.ends[b - 1])]
            up, down = _powers(1 << max(20, len(own).bit_length()))
            total = np.empty(len(own) + 1, np.uint64)
            total[0] = 0
            np.cumsum((own.astype(np.uint64) + np.uint64(1)) * up[: len(own)], out=total[1:])
            starts, all_ends = self.starts[a:b] - low, self.ends[a:b] - low
            for found, ends in zip(out, [all_ends, *(np.minimum(starts + p, all_ends) for p in prefixes)]):
                found[a:b] = mixed((total[ends] - total[starts]) * down[starts] ^ (ends - starts).astype(np.uint64))
        return out if prefixes else out[0]
