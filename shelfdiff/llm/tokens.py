"""Subword ids of whole texts by a public tokenizer, inside Python tasks."""

from __future__ import annotations

import json
import os
import re
import struct

import numpy as np

from shelfdiff.llm import words

CACHE_PARTS = 500_000
CACHE_CHARACTERS = 64

# Texts of Latin-1 characters without any that the tokenizer's first steps treat in ways
# of their own (odd white space, letters and numbers outside the usual ranges, the start of
# a special token) are cut here as the tokenizer would cut them.
_UNUSUAL = re.compile(r"[^\x00-\x84\x86-\x9f\xa1-\xa9\xab-\xb1\xb4\xb6-\xb8\xbb\xbf-\xff]|<\|")
_MARKS = (b".", b",", b";", b":", b"!", b"?")
_PARTS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z\xdf-\xf6\xf8-\xff]+|[0-9]|[^ \t-\ra-z\xdf-\xf6\xf8-\xff0-9]+")


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class Encoder(dict):
    """Ids of texts as little-endian unsigned 32-bit integers.

    Where the tokenizer's first steps are known, usual texts are put in lower case and cut
    into the parts that its model gets, and each distinct part goes through that model
    once; the dictionary keeps their ids. All other texts go to the library whole.
    """

    def __init__(self, path: str):
        super().__init__()
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.known_steps = _known_steps(path)
        self.characters = _byte_characters()

    def __missing__(self, part: str) -> bytes:
        # Printable ASCII characters stand for their own bytes.
        usual = part.isascii() and part.isprintable()
        plain = part if usual else part.encode().decode("latin-1").translate(self.characters)
        found = self.model.tokenize(plain)
        ids = struct.pack(f"<{len(found)}I", *[x.id for x in found])
        if len(part) <= CACHE_CHARACTERS:
            if len(self) >= CACHE_PARTS:
                self.clear()
            self[part] = ids
        return ids

    def word_ids(self, word: bytes) -> bytes:
        """The ids of one word without white space, in lower case."""
        if self.known_steps and word.isalpha():
            return self[word.decode()]
        if self.known_steps and word[-1:] in _MARKS and word[:-1].isalpha():
            return self[word[:-1].decode()] + self[word[-1:].decode()]
        return self.ids(word.decode())

    def ids(self, text: str | None) -> bytes:
        """The ids of a text; none of a null text."""
        if not text:
            return b""
        usual = "<|" not in text if text.isascii() else not _UNUSUAL.search(text)
        if self.known_steps and usual:
            return b"".join(map(self.__getitem__, _PARTS.findall(text.lower())))
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def _byte_characters() -> dict[int, str]:
    """The usual character for each byte: printable ones stand for themselves, the others
    follow after 255 in their order."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(printable)]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(others)}


# The steps of the tokenizer that `_PARTS` was written for.
_NORMALIZERS = ["NFC", "Replace", "Lowercase"]
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def _known_steps(path: str) -> bool:
    with open(path) as f:
        parts = json.load(f)
    normalizers = [x.get("type") for x in (parts.get("normalizer") or {}).get("normalizers") or []]
    steps = (parts.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
    split = steps[0]
    pattern = (split.get("pattern") or {}).get("Regex", "")
    drops = split.get("behavior") == "Removed" and split.get("invert") is True
    return drops and pattern == _PATTERN and normalizers == _NORMALIZERS


_ENCODERS: dict[str, Encoder] = {}
words.register("tokens", lambda: [e.clear() for e in _ENCODERS.values()])


def encoder(path: str) -> Encoder:
    """The encoder of this worker process."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]
