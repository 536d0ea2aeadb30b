"""Words of many texts at once, as numpy arrays over the UTF-8 bytes of an Arrow column.

A word is a maximal run of bytes of one class.  Both word classes in use are unions of
ASCII characters and all non-ASCII ones, so cutting bytes and cutting characters agree.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Bytes of text worked on at a time; one longer text is still taken whole.
CHUNK_BYTES = 1 << 21
#: Bytes of a word up to which it is named by a polynomial.
LONG = 256

_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_U64 = 1 << 64


def byte_class(separators: bytes) -> np.ndarray:
    """256 booleans: true for the bytes of words."""
    table = np.ones(256, bool)
    table[list(separators)] = False
    return table


#: Words `[^\x20\x09-\x0D]+`.
PLAIN = byte_class(b"\x20\x09\x0a\x0b\x0c\x0d")
#: Words `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`, for lower-cased text.
ALNUM = byte_class(bytes([*range(0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base % _U64, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


class _Powers:
    """Powers of the base and of its inverse, grown on demand and kept by the worker."""

    def __init__(self) -> None:
        self.up = self.down = np.zeros(0, np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, CHUNK_BYTES + 1)
            self.up, self.down = _powers(_BASE, size), _powers(pow(_BASE, -1, _U64), size)
        return self.up, self.down


_POWERS = _Powers()
_BYTE_VALUES = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit (the finaliser of splitmix64)."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def prefix_hashes(values: np.ndarray) -> np.ndarray:
    """Prefix sums by which `span_hash` names any span of the sequence in constant time."""
    up, _ = _POWERS.get(len(values) + 1)
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[: len(values)], dtype=np.uint64, out=out[1:])
    return out


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit names of spans: equal spans get equal names wherever they stand.

    Polynomials modulo 2**64 name some long sequences of two values alike, from 512 values on;
    for spans of more than ``LONG`` see ``digest`` and ``window_hash``.
    """
    _, down = _POWERS.get(len(prefix))
    return mix((prefix[end] - prefix[start]) * down[start])


def digest(data: bytes) -> tuple[int, int]:
    """Two 64-bit names of any bytes, by a cryptographic hash."""
    found = hashlib.blake2b(data, digest_size=16).digest()
    return int.from_bytes(found[:8], "little"), int.from_bytes(found[8:], "little")


def window_hash(names: np.ndarray, window: int) -> np.ndarray:
    """A 64-bit name of the ``window`` names that start at each place.

    Windows of twice the size are named by the names of their halves, and one of any size by
    two such that cover it.  At places with fewer names left, the value means nothing.
    """
    out, size = names, 1
    while 2 * size <= window:
        out, size = _both(out, _ahead(out, size)), 2 * size
    return _both(out, _ahead(out, window - size)) if size < window else out


def _both(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A name for two names, in this order."""
    return mix(mix(a + np.uint64(_BASE)) + b * np.uint64(0xD6E8FEB86659FD93))


def _ahead(values: np.ndarray, places: int) -> np.ndarray:
    out = np.zeros_like(values)
    out[: max(0, len(values) - places)] = values[places:]
    return out


@dataclass
class Chunk:
    """Some texts and their words.  first[i]:first[i + 1] are the words of text i."""

    row: int  # place of the first text in the column
    data: np.ndarray  # bytes of the texts, one after another
    offset: np.ndarray  # byte offset of each text, and the end
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    def __len__(self) -> int:
        return len(self.offset) - 1

    def names(self) -> np.ndarray:
        """A 64-bit name for each word."""
        out = span_hash(prefix_hashes(_BYTE_VALUES[self.data]), self.start, self.end)
        for i in np.flatnonzero(self.end - self.start > LONG).tolist():
            out[i] = digest(self.data[self.start[i] : self.end[i]].tobytes())[0]
        return out

    def contents(self, names: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Two 64-bit names of the words of each text as a whole."""
        found = [digest(names[a:b].tobytes()) for a, b in zip(self.first[:-1], self.first[1:], strict=True)]
        both = np.array(found, np.uint64).reshape(-1, 2)
        return both[:, 0], both[:, 1]

    def text(self, i: int) -> bytes:
        return self.data[self.offset[i] : self.offset[i + 1]].tobytes()


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20


def _cut(row: int, data: np.ndarray, offset: np.ndarray, table: np.ndarray) -> Chunk:
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = table[data]
    begins = inside[1:] & ~inside[:-1]  # begins[i]: byte i starts a run
    ends = inside[:-1] & ~inside[1:]  # ends[i]: a run ends before byte i
    cuts = offset[1:-1]
    cuts = cuts[inside[cuts] & inside[cuts + 1]]  # runs that go on into the next text
    begins[cuts] = True
    ends[cuts] = True
    start, end = np.flatnonzero(begins), np.flatnonzero(ends)
    return Chunk(row, data, offset, start, end, np.searchsorted(start, offset, "left"))


def chunks(texts: pa.Array, table: np.ndarray, lower: bool = False) -> Iterator[Chunk]:
    """The column in pieces of some 2 MB; a null text has no bytes."""
    texts = texts.cast(pa.large_string()) if not pa.types.is_large_string(texts.type) else texts
    if texts.null_count:
        texts = texts.fill_null("")
    _, where, bytes_ = texts.buffers()
    offset = np.frombuffer(where, np.int64, len(texts) + 1, texts.offset * 8)
    data = np.frombuffer(bytes_ or b"", np.uint8)
    row = 0
    while row < len(texts):
        end = max(row + 1, int(np.searchsorted(offset, offset[row] + CHUNK_BYTES, "right")) - 1)
        piece = data[offset[row] : offset[end]]
        yield _cut(row, _LOWER[piece] if lower else piece, offset[row : end + 1] - offset[row], table)
        row = end
