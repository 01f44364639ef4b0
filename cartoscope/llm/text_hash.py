"""Vectorised words and 64-bit hashes of whole Arrow batches of texts (numpy only, inside tasks)."""

from __future__ import annotations

import secrets
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa

U = np.uint64

SPACES = np.zeros(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True
#: ASCII characters that are neither letters nor digits.
SEPARATORS = np.zeros(256, bool)
SEPARATORS[:128] = [not chr(c).isalnum() for c in range(128)]
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of uint64 values (wrapping arithmetic)."""
    x = x ^ (x >> U(31))
    x = x * U(0x9E3779B97F4A7C15)
    x = x ^ (x >> U(29))
    x = x * U(0xD6E8FEB86659FD93)
    return x ^ (x >> U(32))


def draw_keys() -> tuple[int, int]:
    """Keys of two independent hashes, drawn for one run: words that collide under them cannot be prepared."""
    return secrets.randbits(64), secrets.randbits(64)


def _blocks(words: np.ndarray, key: int) -> np.ndarray:
    """Distinct random offsets of the blocks 0, 1, ... of a word."""
    return mix(words.astype(U) * U(0xA24BAED4963EE407) + U((0x9FB21C651E98DF25 + key) % (1 << 64)))


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, key: int = 0) -> np.ndarray:
    """64-bit hash of each data[start:end] under a key.

    A word is cut into blocks of eight bytes; each block is scrambled together with its number and the key, so that no
    algebraic relation between blocks carries over to the sum, and the length is mixed in.
    """
    if not len(starts):
        return np.zeros(0, U)
    size = ends - starts
    padded = np.zeros(len(data) + 8, np.uint8)
    padded[: len(data)] = data
    at_each = np.ndarray((len(data),), np.dtype("<u8"), padded, 0, (1,))  # the eight bytes from each byte on
    if size.max() <= 8:
        total = mix(_cut(at_each[starts], size) ^ _blocks(np.zeros(1), key))
    else:
        count = (size + 7) >> 3
        head = np.cumsum(count) - count
        number = np.arange(head[-1] + count[-1]) - np.repeat(head, count)
        value = _cut(at_each[np.repeat(starts, count) + 8 * number], np.repeat(size, count) - 8 * number)
        total = np.add.reduceat(mix(value ^ _blocks(number, key)), head, dtype=U)
    return mix(total + size.astype(U))


def _cut(value: np.ndarray, left: np.ndarray) -> np.ndarray:
    """Eight bytes of which only the first left ones count."""
    return value & (U(0xFFFFFFFFFFFFFFFF) >> (U(64) - U(8) * np.minimum(left, 8).astype(U)))


def window_hashes(h: np.ndarray, width: int) -> np.ndarray:
    """Hash of h[i:i + width] for each i where it fits, by doubling: halves are scrambled before they are joined."""
    out, at, power, size = None, 0, h, 1
    while True:
        if width & size:
            part = power[at : len(h) - width + 1 + at] if len(h) >= width else power[:0]
            out = part if out is None else mix(out * U(3) + mix(part + U(at)))
            at += size
        if 2 * size > width:
            return mix(out + U(width))
        power = mix(mix(power[: max(0, len(power) - size)] + U(size)) * U(5) + power[size:])
        size *= 2


class Texts:
    """Words of consecutive texts: hash of each word, and where each text's words begin."""

    def __init__(self, ids: np.ndarray, data: np.ndarray, offsets: np.ndarray, lower: bool, spaces: np.ndarray = SPACES, known: np.ndarray | None = None, keys: tuple[int, int] = (0, 1)):
        self.keys, self.ids, self.data, self.offsets = keys, ids, data, offsets
        self.known = np.ones(len(ids), bool) if known is None else known  # ids that are not null
        low = LOWER[data] if lower else data
        word = ~spaces[data]
        starts, ends = word.copy(), word.copy()
        if len(data):
            starts[1:] &= ~word[:-1]
            ends[:-1] &= ~word[1:]
            first = offsets[:-1][offsets[:-1] < offsets[1:]]
            starts[first] = word[first]
            last = offsets[1:][offsets[:-1] < offsets[1:]] - 1
            ends[last] = word[last]
        self.starts, self.ends = np.flatnonzero(starts), np.flatnonzero(ends) + 1
        self.low = low
        self.at = np.searchsorted(self.starts, offsets)  # of text i: words at[i]:at[i + 1]

    @cached_property
    def hash(self) -> np.ndarray:
        return word_hashes(self.low, self.starts, self.ends, self.keys[0])

    @cached_property
    def second(self) -> np.ndarray:
        """Hashes of the words under the other key."""
        return word_hashes(self.low, self.starts, self.ends, self.keys[1])


def chunks(batch: pa.RecordBatch, lower: bool, limit: int = 2 << 20, spaces: np.ndarray = SPACES, keys: tuple[int, int] = (0, 1)) -> Iterator[tuple[Texts, int, int]]:
    """Parts (texts, first row, last row + 1) of a batch (id, text, ...) of about limit bytes of text each.

    A null text counts as empty. One text of any length stays whole. Integer ids stay integers; known tells
    which are not null.
    """
    ids = batch.column(0)
    known = ids.is_valid().to_numpy(zero_copy_only=False)
    ids = (ids.fill_null(0) if pa.types.is_integer(ids.type) else ids).to_numpy(zero_copy_only=False)
    column = batch.column(1)
    if not len(column):
        return
    _, offs, data = column.buffers()
    offs = np.frombuffer(offs, np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    i = 0
    while i < len(ids):
        j = max(i + 1, int(np.searchsorted(offs, offs[i] + limit, "right")) - 1)
        j = min(j, len(ids))
        yield Texts(ids[i:j], data[offs[i] : offs[j]], offs[i : j + 1] - offs[i], lower, spaces, known[i:j], keys), i, j
        i = j
