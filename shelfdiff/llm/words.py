"""Words, their hashes and shingle sets, inside Python tasks.

Hashes are 64 bits of a fixed function, equal on all machines. Caches live as long as
their worker process and start anew when they are full.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

CACHE_WORDS = 300_000
CACHE_BYTES = 64

SHINGLE = 5

# Odd factors of a polynomial over word hashes, one for each place of a window, from a
# fixed generator.
_FACTORS = np.random.default_rng(20).integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


# glibc keeps what was freed unless it is told to give it back; other C libraries have no
# such call.
_LIBC = ctypes.CDLL(None)
_LIBC = _LIBC if hasattr(_LIBC, "malloc_trim") else None

# How to empty each kind of cache, by the name of its owner.
_CLEAR: dict[str, Callable[[], object]] = {}


def register(owner: str, clear: Callable[[], object]) -> None:
    _CLEAR[owner] = clear


def keep_only(*owners: str) -> None:
    """Empties the caches that tasks of other operators left in this worker process, so
    that it holds those of one operator at a time, and gives what they took back."""
    for owner, clear in _CLEAR.items():
        if owner not in owners:
            clear()
    pa.default_memory_pool().release_unused()
    if _LIBC is not None:
        _LIBC.malloc_trim(0)


class WordHashes(dict):
    """Word (bytes) to 64-bit hash; `normal` maps a word to what is hashed."""

    def __init__(self, normal=None):
        super().__init__()
        self.normal = normal

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(self.normal(word) if self.normal else word)
        if len(word) <= CACHE_BYTES:
            if len(self) >= CACHE_WORDS:
                self.clear()
            self[word] = value
        return value


PLAIN = WordHashes()
register("words", PLAIN.clear)


def lower_words(text: str | None) -> list[bytes]:
    """Words between ASCII white space, A-Z in lower case; none of a null text."""
    return text.encode().lower().split() if text else []


def word_hashes(words: list[bytes], cache: WordHashes = PLAIN) -> np.ndarray:
    return np.fromiter(map(cache.__getitem__, words), np.uint64, len(words))


# The white space between words, and A-Z in lower case.
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_WORDS_AT_ONCE = 100_000

# Constants of xxh3 (64 bits, no seed) for inputs of up to 3, 8 and 16 bytes.
_FLIP_3 = np.uint64(0x396CFEB8 ^ 0xBE4BA423)
_FLIP_8 = np.uint64(0x1CAD21F72C81017C ^ 0xDB979083E96DD4DE)
_FLIP_16 = np.uint64(0x1F67B3B7A4A44072 ^ 0x78E5C0CC4EE679CB), np.uint64(0x2172FFCC7DD05A82 ^ 0x8E2443F7744608B8)
_LOW = np.uint64(0xFFFFFFFF)


def _folded(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The low half of 128-bit products, xor the high half."""
    a0, a1, b0, b1 = a & _LOW, a >> np.uint64(32), b & _LOW, b >> np.uint64(32)
    one, two = a0 * b1, a1 * b0
    middle = (a0 * b0 >> np.uint64(32)) + (one & _LOW) + (two & _LOW)
    return a * b ^ (a1 * b1 + (one >> np.uint64(32)) + (two >> np.uint64(32)) + (middle >> np.uint64(32)))


def _xxh3(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """xxh3 of pieces of `data`, which has 8 bytes more at its end; none is empty. Pieces of
    up to 16 bytes are hashed together, others one by one."""
    out = np.empty(len(starts), np.uint64)
    n = len(data) - 7
    by_4 = np.ndarray(n, "<u4", data, strides=(1,))
    by_8 = np.ndarray(n, "<u8", data, strides=(1,))
    some = np.flatnonzero(sizes <= 3)
    at, size = starts[some], sizes[some]
    first, inner, last = (data[x].astype(np.uint64) for x in (at, at + (size >> 1), at + size - 1))
    h = (first << np.uint64(16) | inner << np.uint64(24) | last | size.astype(np.uint64) << np.uint64(8)) ^ _FLIP_3
    h = (h ^ h >> np.uint64(33)) * np.uint64(0xC2B2AE3D27D4EB4F)
    h = (h ^ h >> np.uint64(29)) * np.uint64(0x165667B19E3779F9)
    out[some] = h ^ h >> np.uint64(32)
    some = np.flatnonzero((sizes > 3) & (sizes <= 8))
    at, size = starts[some], sizes[some]
    h = (by_4[at + size - 4].astype(np.uint64) + (by_4[at].astype(np.uint64) << np.uint64(32))) ^ _FLIP_8
    h ^= (h << np.uint64(49) | h >> np.uint64(15)) ^ (h << np.uint64(24) | h >> np.uint64(40))
    h *= np.uint64(0x9FB21C651E98DF25)
    h = (h ^ (h >> np.uint64(35)) + size.astype(np.uint64)) * np.uint64(0x9FB21C651E98DF25)
    out[some] = h ^ h >> np.uint64(28)
    some = np.flatnonzero((sizes > 8) & (sizes <= 16))
    at, size = starts[some], sizes[some]
    low, high = by_8[at] ^ _FLIP_16[0], by_8[at + size - 8] ^ _FLIP_16[1]
    h = size.astype(np.uint64) + low.byteswap() + high + _folded(low, high)
    h = (h ^ h >> np.uint64(37)) * np.uint64(0x165667919E3779F9)
    out[some] = h ^ h >> np.uint64(32)
    for j in np.flatnonzero(sizes > 16).tolist():
        out[j] = xxhash.xxh3_64_intdigest(data[starts[j] : starts[j] + sizes[j]])
    return out


def ranges(starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The places in ranges, one range after another, and where each begins among them."""
    at = np.cumsum(sizes) - sizes
    return np.arange(int(sizes.sum())) + np.repeat(starts - at, sizes), at


class Texts:
    """The words of a column of texts, found in its bytes: `starts` and `ends` of all of
    them, and `first`, the number of each text's first word, the number of all at its end.
    Words are those of `lower_words`; nulls have none."""

    def __init__(self, column: pa.Array):
        column = pc.fill_null(column, "")
        wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
        _, offsets, data = column.buffers()
        kind = np.dtype(np.int64 if wide else np.int32)
        bounds = np.frombuffer(offsets, kind, len(column) + 1, kind.itemsize * column.offset) if len(column) else np.zeros(1, kind)
        lo, hi = int(bounds[0]), int(bounds[-1])
        self.data = np.frombuffer(data, np.uint8, hi - lo, lo) if hi > lo else np.empty(0, np.uint8)
        self.bounds = bounds.astype(np.int64) - lo
        inside = ~_SPACE[self.data]
        follows, leads = np.zeros(hi - lo, bool), np.zeros(hi - lo, bool)
        follows[1:], leads[:-1] = inside[:-1], inside[1:]
        edges = self.bounds[(self.bounds > 0) & (self.bounds < hi - lo)]
        follows[edges] = leads[edges - 1] = False
        self.starts = np.flatnonzero(inside & ~follows)
        self.ends = np.flatnonzero(inside & ~leads) + 1
        self.first = np.searchsorted(self.starts, self.bounds)

    def hashes(self) -> np.ndarray:
        """What `word_hashes` gives for every word."""
        data = np.zeros(len(self.data) + 8, np.uint8)
        data[:-8] = _LOWER[self.data]
        out = np.empty(len(self.starts), np.uint64)
        for i in range(0, len(out), _WORDS_AT_ONCE):
            part = slice(i, i + _WORDS_AT_ONCE)
            out[part] = _xxh3(data, self.starts[part], self.ends[part] - self.starts[part])
        return out

    def names(self, which: np.ndarray) -> pa.Array:
        """Some of the words, in lower case."""
        starts = self.starts[which]
        sizes = self.ends[which] - starts
        place, at = ranges(starts, sizes)
        letters = _LOWER[self.data[place]]
        offsets = np.append(at, len(letters)).astype(np.int32)
        return pa.Array.from_buffers(pa.binary(), len(at), [None, pa.py_buffer(offsets), pa.py_buffer(letters)])

    def lines(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Where every line of the texts begins and ends among the words, and the number of
        each text's first line, the number of all at the end."""
        breaks = np.flatnonzero(self.data == 10)
        before = np.searchsorted(breaks, self.bounds)
        first = before + np.arange(len(self.bounds))
        cuts = np.sort(np.concatenate([np.searchsorted(self.starts, breaks), self.first]))
        # Every text ends a line, whether or not it ends with a line break.
        starts, ends = cuts[:-1], cuts[1:]
        return starts, ends, first


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit values; one to one."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def windows(hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash of every run of `size` words, in order; empty if there are fewer words."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    total = hashes[:n] * _FACTORS[0]
    for k in range(1, size):
        total += hashes[k : k + n] * _FACTORS[k]
    return mix(total + np.uint64(size))


def shingles(hashes: np.ndarray, size: int = SHINGLE) -> np.ndarray:
    """Distinct shingle hashes in ascending order. Fewer words than `size` are one shingle,
    no words none."""
    if len(hashes) >= size:
        return np.unique(windows(hashes, size))
    return windows(hashes, len(hashes)) if len(hashes) else np.empty(0, np.uint64)


def shared(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two ascending sets."""
    if len(a) > len(b):
        a, b = b, a
    if not len(a):
        return 0
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int(np.count_nonzero(b[at] == a))
