"""Subword ids of many words at once, by the merges of a byte-level BPE model.

Words of lower-case letters, digits and marks are cut into the parts that the tokenizer's
first steps give, and parts of about one size are merged together: in each round every part
merges its pair of the lowest rank, the leftmost of equals, as the library does.
"""

from __future__ import annotations

import json

import numpy as np

# Parts of up to so many bytes are merged together; longer ones are left to the library.
_WIDTHS = (1, 2, 3, 4, 6, 8, 11, 16, 32)
MOST_BYTES = _WIDTHS[-1]
_SLOTS = 18
_FACTOR = np.uint32(0x9E3779B1)
_NONE = np.int32(2**30)

# Kinds of bytes: letters, digits (each a part of its own), marks; -1 for all others. An
# apostrophe may begin a part of its own kind, "<" a special token.
_KIND = np.full(256, -1, np.int8)
_KIND[33:127] = 2
_KIND[[ord("'"), ord("<")]] = -1
_KIND[65:91] = -1
_KIND[48:58] = 1
_KIND[97:123] = 0
# Small letters of Latin-1: this byte, then one of these.
_LEAD = 0xC3
_TRAIL = np.zeros(256, bool)
_TRAIL[0x9F:0xC0] = True
_TRAIL[0xB7] = False


class Merges:
    def __init__(self, ranked: list[tuple[str, str]], vocabulary: dict[str, int], characters: dict[int, str]):
        names = [chr(b) if b not in characters else characters[b] for b in range(256)]
        self.inner = np.array([vocabulary[c] for c in names], np.int32)
        self.last = np.array([vocabulary[c + "</w>"] for c in names], np.int32)
        pairs = {(vocabulary[a] << 16) | vocabulary[b]: vocabulary[a + b] for a, b in ranked}
        self.made = np.array(list(pairs.values()), np.int32)
        # Open addressing: a pair lies in the first free slot from its own.
        self.keys = np.zeros(2**_SLOTS, np.uint32)
        self.ranks = np.full(2**_SLOTS, _NONE, np.int32)
        keys = np.array(list(pairs), np.uint32)
        slot = self._slot(keys)
        left = np.arange(len(keys))
        while len(left):
            free = left[self.ranks[slot[left]] == _NONE]
            _, first = np.unique(slot[free], return_index=True)
            put = free[first]
            self.keys[slot[put]], self.ranks[slot[put]] = keys[put], put
            left = np.setdiff1d(left, put, assume_unique=True)
            taken = left[self.ranks[slot[left]] != _NONE]
            slot[taken] = (slot[taken] + 1) % 2**_SLOTS

    @staticmethod
    def _slot(keys: np.ndarray) -> np.ndarray:
        return ((keys * _FACTOR) >> np.uint32(32 - _SLOTS)).astype(np.int64)

    def rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The ranks of pairs of ids; `_NONE` for those that do not merge."""
        keys = (a.astype(np.uint32) << np.uint32(16)) | b.astype(np.uint32)
        slot = self._slot(keys)
        out = self.ranks.take(slot)
        other = np.flatnonzero((out != _NONE) & (self.keys.take(slot) != keys))
        while len(other):
            at = slot[other] = (slot[other] + 1) % 2**_SLOTS
            out[other] = found = self.ranks.take(at)
            other = other[(found != _NONE) & (self.keys.take(at) != keys[other])]
        return out

    def merged(self, ids: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Merges rows of so many first ids; -1 after their ends, and where an id went into
        the one before it."""
        n, width = ids.shape
        if width == 1:
            return ids
        out = np.full((n, width), -1, np.int32)
        rows = np.arange(n)
        # Places of the next and the previous id of each.
        after = np.tile(np.arange(1, width + 1, dtype=np.int8), (n, 1))
        before = np.tile(np.arange(-1, width - 1, dtype=np.int8), (n, 1))
        ranks = np.full((n, width), _NONE, np.int32)
        paired = np.arange(1, width) < sizes[:, None]
        ranks[:, :-1][paired] = self.rank(ids[:, :-1][paired], ids[:, 1:][paired])
        while True:
            at = ranks.argmin(1)
            base = np.arange(len(rows)) * width
            least = ranks.ravel().take(base + at)
            done = least == _NONE
            if done.any():
                out[rows[done]] = ids[done]
                keep = np.flatnonzero(~done)
                if not len(keep):
                    return out
                held = rows, sizes, ids, after, before, ranks
                rows, sizes, ids, after, before, ranks = (x.take(keep, axis=0) for x in held)
                at, least, base = at[keep], least[keep], np.arange(len(keep)) * width
            flat, next_, previous, rank = ids.reshape(-1), after.reshape(-1), before.reshape(-1), ranks.reshape(-1)
            place = base + at
            gone = next_.take(place)
            then = next_.take(base + gone)
            new = self.made.take(least)
            flat[place] = new
            flat[base + gone] = -1
            rank[base + gone] = rank[place] = _NONE
            next_[place] = then
            inner = np.flatnonzero(then < sizes)
            right = base[inner] + then[inner]
            previous[right] = at[inner]
            rank[place[inner]] = self.rank(new[inner], flat.take(right))
            first = previous.take(place)
            inner = np.flatnonzero(first >= 0)
            left = base[inner] + first[inner]
            rank[left] = self.rank(flat.take(left), new[inner])

    def find(self, data: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The ids of words, whose bytes lie one after another in `data`, how many each
        has, and which words are left to the library; these have none here."""
        starts = np.cumsum(sizes) - sizes
        if not len(data):
            return np.empty(0, np.int32), np.zeros(len(sizes), np.int64), np.ones(len(sizes), bool)
        kind = _KIND.take(data)
        lead = np.flatnonzero((data[:-1] == _LEAD) & _TRAIL.take(data[1:]))
        kind[lead] = kind[lead + 1] = 0
        opens = np.ones(len(data), bool)
        opens[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == 1)
        opens[starts[sizes > 0]] = True
        part = np.flatnonzero(opens)
        part_sizes = np.diff(part, append=len(data))
        left = sizes == 0
        word = np.repeat(np.arange(len(sizes)), sizes)
        left[word[np.flatnonzero(kind < 0)]] = True
        left[word[part[part_sizes > MOST_BYTES]]] = True
        usual = ~left[word[part]]
        part, part_sizes = part[usual], part_sizes[usual]
        ids = np.full(len(data), -1, np.int32)
        for fewest, width in zip((1, *(w + 1 for w in _WIDTHS)), _WIDTHS, strict=False):
            some_parts = np.flatnonzero((part_sizes >= fewest) & (part_sizes <= width))
            if not len(some_parts):
                continue
            first, own = part[some_parts], part_sizes[some_parts]
            inside = np.arange(width) < own[:, None]
            place = (first[:, None] + np.arange(width))[inside]
            rows = np.full(inside.shape, -1, np.int32)
            rows[inside] = self.inner.take(data.take(place))
            rows[np.arange(len(own)), own - 1] = self.last.take(data.take(first + own - 1))
            ids[place] = self.merged(rows, own)[inside]
        own = ids >= 0
        return ids[own], np.bincount(word[own], minlength=len(sizes)), left


def read(path: str, characters: dict[int, str]) -> Merges | None:
    """The merges of a tokenizer's file, if its model is of the kind that is known here."""
    with open(path) as f:
        model = json.load(f)["model"]
    usual = model.get("type") == "BPE" and model.get("end_of_word_suffix") == "</w>"
    odd = any(model.get(x) for x in ("dropout", "continuing_subword_prefix", "ignore_merges"))
    if not usual or odd or max(model["vocab"].values()) >= 2**16:
        return None
    ranked = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    try:
        return Merges(ranked, model["vocab"], characters)
    except KeyError:
        return None


def together(found: tuple[np.ndarray, np.ndarray, np.ndarray], others: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all words and how many each has, with those of the words that were left."""
    ids, sizes, left = found
    if not others:
        return ids, sizes
    more = np.frombuffer(b"".join(others), "<u4").astype(np.int32)
    counts = sizes.copy()
    counts[left] = np.fromiter(map(len, others), np.int64, len(others)) // 4
    of_left = np.repeat(left, counts)
    out = np.empty(int(counts.sum()), np.int32)
    out[~of_left], out[of_left] = ids, more
    return out, counts
