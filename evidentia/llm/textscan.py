"""Words of whole Arrow columns of text as numpy arrays, without a Python object for each word."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

#: Bytes of words `[^\x20\x09-\x0D]+`.
SPACED = np.ones(256, dtype=bool)
SPACED[[9, 10, 11, 12, 13, 32]] = False

#: Bytes of words `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+` after A-Z are lower-cased.
ALNUM = np.zeros(256, dtype=bool)
ALNUM[48:58] = ALNUM[97:123] = ALNUM[128:] = True

#: Words are hashed by so many blocks of eight bytes, longer ones' rests by bytes.
BLOCKS = 8
_FIRST = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every input bit over the output."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def keys(n: int, seed: int = 1) -> np.ndarray:
    """n fixed pseudo-random 64-bit odd numbers."""
    with np.errstate(over="ignore"):
        return mix((np.arange(n, dtype=np.uint64) + np.uint64(seed) * np.uint64(1 << 32)) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def utf8(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts in a row (null: empty), and where each text starts; the last offset is the end."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    body = np.frombuffer(data, dtype=np.uint8)[at[0] : at[-1]] if data is not None and len(column) else np.zeros(0, np.uint8)
    return body, at - at[0]


class Words:
    """starts, ends: byte ranges of words; of: number of words before each text, and at last of all; hashes: 64 bits for each word."""

    def __init__(self, body: np.ndarray, at: np.ndarray, kept: np.ndarray = SPACED):
        low = _LOWER[body]
        inside = kept[low]
        n = len(low)
        begins = np.zeros(n + 1, dtype=bool)
        begins[at] = True
        before = np.empty(n, dtype=bool)
        if n:
            before[0] = False
            before[1:] = inside[:-1]
        first = inside & (~before | begins[:n])
        self.starts = np.flatnonzero(first)
        after = np.empty(n, dtype=bool)
        if n:
            after[-1] = False
            after[:-1] = inside[1:]
        self.ends = np.flatnonzero(inside & (~after | begins[1:])) + 1
        self.of = np.searchsorted(self.starts, at)
        self._low, self._inside = low, inside

    @property
    def hashes(self) -> np.ndarray:
        """Each word's bytes mixed in by eights, with its length; of words over BLOCKS eights the rest by a multilinear hash."""
        lengths = self.ends - self.starts
        out = lengths.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
        if not len(lengths):
            return out
        padded = np.concatenate([self._low, np.zeros(8, np.uint8)])
        eights = np.ndarray(len(self._low) + 1, "<u8", padded, strides=(1,))
        active = np.arange(len(lengths))
        for k in range(BLOCKS):
            left = lengths[active] - 8 * k
            out[active] = mix(out[active] ^ eights[self.starts[active] + 8 * k] & _FIRST[np.minimum(left, 8)])
            active = active[left > 8]
            if not len(active):
                return out
        starts, rest = self.starts[active] + 8 * BLOCKS, lengths[active] - 8 * BLOCKS
        heads = np.concatenate(([0], np.cumsum(rest)[:-1]))
        place = np.arange(int(rest.sum()), dtype=np.int64) - np.repeat(heads, rest)
        value = self._low[np.repeat(starts, rest) + place].astype(np.uint64) + np.uint64(1)
        value *= keys(int(rest.max()))[place]
        out[active] = mix(out[active] ^ np.add.reduceat(value, heads))
        return out
